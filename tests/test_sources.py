import gzip
import random
import zipfile

import pytest
from pyspark.sql import functions as F

from helixmill.sources import readers, schemas, writers

GENBANK = """LOCUS       REC1 30 bp
VERSION     REC1.1
FEATURES             Location/Qualifiers
     CDS             1..9
                     /product="x"
     CDS             complement(10..15)
                     /product="y"
ORIGIN
        1 atggcctaaa aacccgggtt
//
"""


def test_fasta_and_back(spark, tmp_path):
    (tmp_path / "x.fna").write_text(">a one\nACGT\nAC\n>b\nTT\n")
    (tmp_path / "x.txt").write_text(">c\nAA\n")
    rows = readers.fasta(spark, str(tmp_path))
    assert sorted((r.id, r.description, r.seq) for r in rows.collect()) == [("a", "a one", "ACGTAC"), ("b", "b", "TT")]
    writers.fasta(rows.drop("description"), str(tmp_path / "out"))
    again = readers.fasta(spark, str(tmp_path / "out"), "part-*")
    assert sorted((r.id, r.seq) for r in again.collect()) == [("a", "ACGTAC"), ("b", "TT")]
    with pytest.raises(ValueError):
        readers.single_record(rows)


def test_fastq_is_strictly_longer(spark, tmp_path):
    (tmp_path / "x.fastq").write_text("@a\nACGT\n+\n@III\n@b\nAC\n+\nII\n")
    assert [(r.id, r.qual) for r in readers.fastq(spark, str(tmp_path), longer_than=2).collect()] == [("a", "@III")]


def test_tables_with_missing(spark, tmp_path):
    (tmp_path / "t.tsv").write_text("accession\tlabel\na\tN/A\n")
    assert readers.table(spark, str(tmp_path / "t.tsv"), schemas.LABELS).first()["label"] is None
    (tmp_path / "h.tsv").write_text("q\ts\t100\t9\t0\t0\t1\t9\t30\t20\t0\t1\nq\ts\t99\t9\t1\t0\t1\t9\t3\t9\t0\t1\n")
    hits = readers.perfect_hits(readers.bare(spark, str(tmp_path / "h.tsv"), schemas.BLAST12)).collect()
    assert [(r.start, r.end) for r in hits] == [(20, 30)]


def test_sam(spark, tmp_path):
    (tmp_path / "x.sam").write_text("@SQ\tSN:c\tLN:99\nq\t0\tc\t5\t42\t3M1D2M1I\t*\t0\t0\tACGTAC\t*\n")
    rows = readers.sam_intervals(readers.sam(spark, str(tmp_path / "x.sam"))).collect()
    assert [tuple(r) for r in rows] == [("c", 4, 10)]


def test_zips(spark, tmp_path):
    with zipfile.ZipFile(tmp_path / "g.zip", "w") as z:
        z.writestr("ncbi/data/ASM1/genomic.gbff", GENBANK)
        z.writestr("readme.txt", "x")
    assert readers.zip_members(spark, str(tmp_path / "g.zip")).count() == 2
    cds = {r.start: (r.assembly, r.record_id, r.end, r.seq) for r in readers.genbank_zip(spark, str(tmp_path / "g.zip")).collect()}
    assert cds == {0: ("ASM1", "REC1.1", 9, "ATGGCCTAA"), 9: ("ASM1", "REC1.1", 15, "GGGTTT")}
    members = readers.zip_members(spark, str(tmp_path / "g.zip")).withColumn("archive", F.lit("new"))
    writers.zipped(members, str(tmp_path / "z"))
    assert sorted(zipfile.ZipFile(tmp_path / "z" / "new.zip").namelist()) == ["ncbi/data/ASM1/genomic.gbff", "readme.txt"]
    again = readers.zip_members(spark, str(tmp_path / "z" / "new.zip"), r"\.gbff$")
    assert bytes(again.first()["content"]).decode() == GENBANK
    proteins = readers.translated(readers.genbank_zip(spark, str(tmp_path / "g.zip")))
    assert sorted(r.protein for r in proteins.collect()) == ["GF", "MA*"]


def test_given_hits_and_matrices(spark, tmp_path):
    """Search results given as a file without header, by the ten columns' schema; tables as Parquet."""
    (tmp_path / "h.tsv").write_text("p|F\ts1\t18\t1\t18\t40\t57\tACGT\t900\ttitle one\nq|R\ts2\t17\t1\t18\t90\t73\tAC\t80\tt\n")
    hits = readers.bare(spark, str(tmp_path / "h.tsv"), schemas.BLAST10).orderBy("qseqid").collect()
    assert [tuple(r) for r in hits] == [("p|F", "s1", 18, 1, 18, 40, 57, "ACGT", 900, "title one"), ("q|R", "s2", 17, 1, 18, 90, 73, "AC", 80, "t")]
    matrix = spark.createDataFrame([(0, "ACGT", 1, 5), (-1, "TTTT", 0, None)], schemas.MATRIX)
    matrix.write.parquet(str(tmp_path / "m"))
    again = spark.read.schema(schemas.MATRIX).parquet(str(tmp_path / "m"))
    assert sorted(map(tuple, again.collect()), key=str) == sorted(map(tuple, matrix.collect()), key=str)


def test_records_by_cluster_and_filtered(spark, tmp_path):
    records = spark.createDataFrame([("a", "one", "ACGT", 1), ("b", None, "GG", 1), ("c", "", "TT", 2)], "id string, description string, seq string, cluster int")
    writers.fasta(records, str(tmp_path / "c"), by="cluster")
    for cluster, want in ((1, {("a", "ACGT"), ("b", "GG")}), (2, {("c", "TT")})):
        assert {(r.id, r.seq) for r in readers.fasta(spark, str(tmp_path / "c" / f"cluster={cluster}"), "*").collect()} == want
    writers.fasta(records.filter("cluster = 1"), str(tmp_path / "f"))
    assert {(r.id, r.description) for r in readers.fasta(spark, str(tmp_path / "f"), "*").collect()} == {("a", "a one"), ("b", "b")}


def test_zips_by_ranges(spark, tmp_path, monkeypatch):
    """Many members over many partitions, equal names, folders, an archive without members; and
    the same rows where only Spark reaches the files."""
    rng = random.Random(1)
    want = []
    for a in ("a", "b"):
        with zipfile.ZipFile(tmp_path / f"{a}.zip", "w", zipfile.ZIP_DEFLATED) as z:
            z.writestr("dir/", "")
            for i in range(12):
                name, data = f"dir/{i % 10}.txt", rng.randbytes(rng.choice([0, 10, 5000]))
                z.writestr(name, data)
                want.append((a, name, data))
    zipfile.ZipFile(tmp_path / "c.zip", "w").close()
    rows = lambda df: sorted((r.archive.rsplit("/", 1)[-1][0], r.member, bytes(r["content"])) for r in df.collect())
    assert rows(readers.zip_members(spark, str(tmp_path))) == sorted(want)
    split = readers.zips.by_members(spark, [f"file:{tmp_path}/a.zip", f"{tmp_path.as_uri()}/b.zip"], r"[0-4]\.txt$", 6000)
    assert rows(split) == sorted(x for x in want if x[1][4] in "01234") and split.rdd.getNumPartitions() > 2
    assert readers.zip_members(spark, str(tmp_path / "c.zip")).count() == 0
    monkeypatch.setattr(readers.zips, "opened", lambda uri: None)
    assert rows(readers.zip_members(spark, str(tmp_path))) == sorted(want)


def test_exclusive_json(spark, tmp_path):
    lists = spark.createDataFrame([("x", [["a", "b"]]), ("y", [])], "label string, primers array<array<string>>")
    writers.exclusive_json(lists, str(tmp_path / "j"))
    rows = readers.exclusive_json(spark, str(tmp_path / "j")).collect()
    assert sorted((r.label, r.id) for r in rows) == [("x", "a"), ("x", "b")]


def test_places_on_both_strands():
    parts = lambda place: list(readers._parts(place))
    assert parts("1..9") == [(0, 9, 1)] and parts("complement(<10..>15)") == [(9, 15, -1)] and parts("join(1..3,7)") == [(0, 3, 1), (6, 7, 1)]
    assert parts("complement(join(1..3,7..9))") == [(6, 9, -1), (0, 3, -1)] == parts("join(complement(7..9),complement(1..3))")
    assert parts("join(1..3,complement(7..9))") == [(0, 3, 1), (6, 9, -1)]


def test_joined_complements(spark, tmp_path):
    text = GENBANK.replace("complement(10..15)", "join(complement(13..15),complement(10..12))")
    with zipfile.ZipFile(tmp_path / "g.zip", "w") as z:
        z.writestr("ncbi/data/ASM1/genomic.gbff", text)
    cds = {r.start: r.seq for r in readers.genbank_zip(spark, str(tmp_path / "g.zip")).collect()}
    assert cds == {0: "ATGGCCTAA", 9: "GGGTTT"}


def test_text_before_the_first_header(spark, tmp_path):
    (tmp_path / "x.fna").write_text("junk line\n>a one\nACGT\n>b\nTT\n")
    (tmp_path / "y.fna").write_text(">c\nGG\n")
    assert sorted(r.id for r in readers.fasta(spark, str(tmp_path), leading=True).collect()) == ["a", "b", "c"]


def test_recursive_folders(spark, tmp_path):
    (tmp_path / "deep" / "er").mkdir(parents=True)
    (tmp_path / "deep" / "er" / "x.fasta").write_text(">a\nAC\n")
    assert [r.id for r in readers.fasta(spark, str(tmp_path), recursive=True).collect()] == ["a"]


@pytest.mark.parametrize("split", [200, 1 << 20])
def test_fastq_in_splits(spark, tmp_path, split):
    """Quality lines that begin with @, splits anywhere, empty reads, compressed files."""
    rng = random.Random(3)
    reads = [(f"r{i}", "".join(rng.choices("ACGT", k=(n := rng.choice([0, 1, 30])))), "".join(rng.choices("@+IA", k=n))) for i in range(60)]
    text = "".join(f"@{i} more\n{s}\n+\n{q}\n" for i, s, q in reads)
    (tmp_path / "x.fastq").write_text(text)
    with gzip.open(tmp_path / "y.fastq.gz", "wt") as f:
        f.write(text)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes"), spark.conf.get("spark.sql.files.openCostInBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", split)
    spark.conf.set("spark.sql.files.openCostInBytes", 0)
    try:
        got = sorted((r.id, r.seq, r.qual) for r in readers.fastq(spark, str(tmp_path), longer_than=-1).collect())
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before[0])
        spark.conf.set("spark.sql.files.openCostInBytes", before[1])
    assert got == sorted(reads + reads)


def test_tables_and_lists(spark, tmp_path):
    rows = spark.createDataFrame([("x", ["a", "b"], None), ("y", [], 2)], "label string, failure_acc array<string>, n int")
    writers.table(rows, str(tmp_path / "t"), by="label")
    lines = {f.parent.name: f.read_text().splitlines() for f in (tmp_path / "t").rglob("*.csv")}
    assert lines == {"label=x": ["failure_acc\tn", "a,b\tN/A"], "label=y": ["failure_acc\tn", '""\t2']}
    writers.accession_lists(spark.createDataFrame([("x", 1), ("x", 2)], "label string, accession int"), str(tmp_path / "m"))
    assert sorted("".join(f.read_text() for f in (tmp_path / "m").rglob("*.txt")).split()) == ["1", "2"]


def test_bed_and_sam_files(spark, tmp_path):
    rows = spark.createDataFrame([("b", 1, 2), ("a", 5, 9), ("a", 3, 4)], "chrom string, start long, end long")
    writers.bed(rows, str(tmp_path / "b"))
    back = readers.bare(spark, str(tmp_path / "b"), "chrom string, start long, end long")
    assert [tuple(r) for r in back.collect()] == [("a", 3, 4), ("a", 5, 9), ("b", 1, 2)]
    hits = spark.createDataFrame([("q", 0, "c", 5, 42, "3M", "*", 0, 0, "ACG", "*")], schemas.SAM)
    writers.sam(hits, spark.createDataFrame([("c", 99)], "chrom string, size long"), str(tmp_path / "s"))
    assert [tuple(r) for r in readers.sam(spark, str(tmp_path / "s")).collect()] == [tuple(hits.first())]


def test_labels_of_files(spark, tmp_path):
    (tmp_path / "x.fa").write_text(">a\nAC\n>b\nAC\n")
    (tmp_path / "y.fa").write_text(">c\nAC\n")
    rows = readers.file_labels(spark, [str(tmp_path / "x.fa"), str(tmp_path / "y.fa")], ["one", "two"])
    assert sorted(map(tuple, rows.collect())) == [("a", "one"), ("b", "one"), ("c", "two")]
    with pytest.raises(ValueError):
        readers.file_labels(spark, ["x"], [])
