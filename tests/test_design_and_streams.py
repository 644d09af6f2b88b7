import random

from pyspark.sql import functions as F

from helixmill.operators import design
from helixmill.streaming import kmers


def test_candidates_and_pairs(spark):
    rng = random.Random(1)
    seq = "".join(rng.choice("ACGT") for _ in range(400))
    seqs = spark.createDataFrame([("c", seq)], "chrom string, seq string")
    regions = spark.createDataFrame([("c", 20, 60), ("c", 220, 260)], "chrom string, start long, end long")
    got = design.candidates(regions, seqs, (18, 19), (0, 99), "R").cache()
    for r in got.collect():
        piece = seq[r.start : r.end]
        piece = piece if r.strand == "+" else piece[::-1].translate(str.maketrans("ACGT", "TGCA"))
        assert r.oligo == piece and piece[0] in "AG"
    inside = design.inside(got, spark.createDataFrame([("c", 0, 100)], "chrom string, start long, end long"))
    assert inside.count() == got.filter("end <= 100").count() > 0
    pairs = design.primer_pairs(got, 150, 250).collect()
    rows = got.collect()
    assert len(pairs) == sum(f.strand == "+" and r.strand == "-" and 150 <= r.end - f.start <= 250 for f in rows for r in rows) > 0


def bonds(x, y):
    return {"AT": 2, "TA": 2, "CG": 3, "GC": 3}.get(x + y, 0)


def test_folds_by_all_stems(spark):
    rng = random.Random(2)
    rows = [("".join(rng.choices("ACGTN", [5, 5, 5, 5, 1], k=rng.choice([0, 1, 4, 8, 20]))), "".join(rng.choices("ACGTa", k=rng.choice([0, 3, 12])))) for _ in range(150)]
    rows += [("GGGGAAAACCCC", "GGGGTTTT"), (None, "ACGT"), ("GGGCCC", None)]
    got = spark.createDataFrame(rows, "a string, b string").select("a", "b", design.hairpin("a").alias("h"), design.dimer("a", "b").alias("d")).collect()
    for r in got:
        a, b = (r.a or "").upper(), (r.b or "").upper()
        stem = lambda x, y, i, j: 0 if i >= len(x) or j < 0 or not bonds(x[i], y[j]) else bonds(x[i], y[j]) + stem(x, y, i + 1, j - 1)

        def fold(i, j):  # a stem from the outside in, while the loop is long enough
            return 0 if j - i <= 3 or not bonds(a[i], a[j]) else bonds(a[i], a[j]) + fold(i + 1, j - 1)

        assert r.h == max([fold(i, j) for i in range(len(a)) for j in range(i, len(a))], default=0)
        assert r.d == max([stem(a, b, i, j) for i in range(len(a)) for j in range(len(b))], default=0)
    assert got[-3].h == 12 and got[-3].d == 20


def test_pairs_with_interior_oligos(spark):
    rng = random.Random(3)
    rows = [(rng.choice("xy"), s := rng.randrange(900), s + rng.randint(15, 25), rng.choice("+-"), f"o{i}", 55 + rng.random() * 10) for i in range(160)]
    oligos = spark.createDataFrame(rows, "chrom string, start long, end long, strand string, oligo string, tm double")
    want = {}
    for f in rows:
        for r in rows:
            if f[0] == r[0] and f[3] == "+" and r[3] == "-" and 150 <= r[2] - f[1] <= 250:
                io = [(abs(o[5] - 60), o[1], o[2], o[3], o[4]) for o in rows if o[0] == f[0] and o[1] >= f[2] and o[2] <= r[1]]
                if io:
                    want[f[4], r[4]] = (min(io)[4], len(io))
    got = {(r.fp, r.rp): (r.io, r.n_io) for r in design.with_interior(design.primer_pairs(oligos), oligos).collect()}
    assert got == want and len(want) > 20


def test_designed_primers(spark):
    rng = random.Random(9)
    seqs = spark.createDataFrame([("c", "".join(rng.choices("ACGT", k=600))), ("d", "ACGT" * 150)], "chrom string, seq string")
    regions = spark.createDataFrame([("c", 0, 60), ("c", 120, 300), ("d", 0, 300)], "chrom string, start long, end long")
    every = design.designed(regions, seqs, lengths=(18, 19), tm=(40.0, 80.0), io_lengths=(18, 18), io_tm=(40.0, 80.0), fold=16)
    rows = every.collect()
    assert rows and all(r.chrom == "c" and r.fp_end <= r.io_start and r.io_end <= r.rp_start and 150 <= r.amplicon_len <= 250 for r in rows)
    cds = spark.createDataFrame([("c", 10, 290)], "chrom string, start long, end long")
    limited = design.designed(regions, seqs, cds=cds, lengths=(18, 19), tm=(40.0, 80.0), io_lengths=(18, 18), io_tm=(40.0, 80.0), fold=16)
    assert limited.count() == sum(r.start >= 10 and r.end <= 290 for r in rows)
    assert design.designed(regions, seqs, regions.filter("start = 120"), lengths=(18, 18), tm=(40.0, 80.0), io_tm=(40.0, 80.0)).filter("io_start < 120").count() == 0


def test_stream_of_kmers(spark, tmp_path):
    spark.createDataFrame([("a", "ACGTT"), ("b", "acgtt")], "id string, seq string").write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema("id string, seq string").parquet(str(tmp_path / "in"))
    query = kmers.distinct_kmers(stream, 4).writeStream.format("memory").queryName("kmers_once").outputMode("append").start()
    query.processAllAvailable()
    query.stop()
    assert sorted(r.kmer for r in spark.table("kmers_once").collect()) == ["AACG", "ACGT", "CGTT"]


def test_windowed_counts_in_batch(spark):
    rows = spark.createDataFrame([("2024-01-01 00:00:01", "AAAA"), ("2024-01-01 00:10:00", "AAA")], "t string, seq string").withColumn("t", F.to_timestamp("t"))
    got = kmers.windowed_counts(rows, 3, "t", "5 minutes", "1 minute").collect()
    assert sorted(r.n for r in got) == [1, 2]
