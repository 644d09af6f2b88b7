import itertools
import random
import re
import tracemalloc
from collections import Counter
from fractions import Fraction

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from helixmill.functions import sequence as S
from helixmill.operators import align, archives, cluster, evaluate, intervals, kmers, mapping, pcr, tables
from helixmill.plans import queries

COMP = str.maketrans("ACGT", "TGCA")


def rc(s):
    return s[::-1].translate(COMP)


def records(spark, rows):
    return spark.createDataFrame(rows, "id string, asm string, seq string")


ROWS = [("a", "x", "ACGTACGTTT"), ("b", "x", "ACGTA"), ("c", "y", "TTACGTAGG"), ("d", "y", "AC")]


def test_canonical_counts(spark):
    want = {}
    for _, _, s in ROWS:  # as a counter does: both strands get one, a palindrome one less overall
        for i in range(len(s) - 4):
            k = s[i : i + 4]
            for x in (k, rc(k)):
                want[x] = want.get(x, 0) + 1
    want = {k: n - (k == rc(k)) for k, n in want.items()}
    got = {r.kmer: r.n for r in kmers.canonical_counts(records(spark, ROWS), 4).collect()}
    assert got == want


def test_conserved_counts_short_groups(spark):
    rows = records(spark, ROWS)
    assert sorted(r.kmer for r in kmers.conserved(rows, 5, "asm").collect()) == ["ACGTA", "TACGT"]
    assert kmers.conserved(rows, 5, "id").count() == 0  # a record too short for any k-mer counts


def test_difference_and_lengths(spark):
    a = spark.createDataFrame([("AC",), ("GT",), ("AC",)], "kmer string")
    b = spark.createDataFrame([("GT",)], "kmer string")
    assert [tuple(r) for r in kmers.difference(a, b).collect()] == [("marker_0", "AC")]
    kmers.check_length(a, 2)
    with pytest.raises(ValueError):
        kmers.check_length(a, 3)


def test_bins_are_strict(spark):
    rows = spark.createDataFrame([(i, "A" * n) for i, n in enumerate((75, 76, 100, 124, 125, 200))], "i int, seq string")
    refs = spark.createDataFrame([(0, 100), (1, 105)], "ref_idx int, ref_len int")
    got = {len(r.seq): r.bin for r in kmers.replicon_bins(rows, refs, 0.25).collect()}
    assert got == {75: -1, 76: 0, 100: 0, 124: 0, 125: 1, 200: -1}


def test_bins_at_decimal_bounds(spark):
    """Lengths at a tenth more or less are outside, also where a double's product isn't exact."""
    rows = spark.createDataFrame([(i, "A" * n) for i, n in enumerate((62, 63, 64, 76, 77, 78))], "i int, seq string")
    refs = spark.createDataFrame([(0, 70)], "ref_idx int, ref_len int")
    got = {len(r.seq): r.bin for r in kmers.replicon_bins(rows, refs).collect()}
    assert got == {62: -1, 63: -1, 64: 0, 76: 0, 77: -1, 78: -1}


def test_replicon_bin_is_its_sql(spark, tmp_path):
    """Ids on several texts, missing ids, texts and sources, lengths at the bounds."""
    rows = [(1, 70, "s0"), (2, 30, "s1"), (2, 130, "s1"), (None, 5, "s1"), (-5, None, "s2"), (3, 100, "s2"), (4, 20, None)]
    rows += [(10 + i, n, "s0") for i, n in enumerate((63, 64, 76, 77, 78, 27, 28, 32, 33, 90, 91, 109, 110, 18, 19, 21, 22))]
    table = [(i, n and "a" * n, "en", source) for i, n, source in rows]
    spark.createDataFrame(table, "doc_id long, text string, lang string, source string").coalesce(1).write.parquet(f"{tmp_path}/documents.parquet")
    got = [tuple(r) for r in queries.replicon_bin(spark, str(tmp_path)).collect()]
    con = duckdb.connect()
    con.sql(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/documents.parquet/*.parquet'")
    want = con.sql(queries.SQL["replicon_bin"]).fetchall()
    assert sorted(got, key=str) == sorted(want, key=str) and len({b for _, b in got}) == 5


def test_resample_repeats(spark):
    m = spark.createDataFrame([("g", "a"), ("g", "b"), ("h", "c")], "groups string, accession string")
    one = sorted(map(tuple, kmers.stratified_resample(m, 200).collect()))
    assert one == sorted(map(tuple, kmers.stratified_resample(m, 200).collect())) and len(one) == 200
    assert 60 < sum(r[1] == "h" for r in one) < 140


def naive_merge(rows):
    out = []
    for a, b in sorted(rows):
        if out and a <= out[-1][1]:
            out[-1][1] = max(out[-1][1], b)
        else:
            out.append([a, b])
    return [tuple(x) for x in out]


def test_merge_and_complement_tile(spark):
    rng = random.Random(1)
    rows = [(c, a, a + rng.randint(1, 9)) for c in "pq" for a in (rng.randint(0, 90) for _ in range(15))]
    df = spark.createDataFrame(rows, "chrom string, start long, end long")
    merged = intervals.merge(df)
    for c in "pq":
        got = sorted((r.start, r.end) for r in merged.filter(F.col("chrom") == c).collect())
        assert got == naive_merge([(a, b) for x, a, b in rows if x == c])
    sizes = spark.createDataFrame([("p", 120), ("q", 120), ("r", 50)], "chrom string, size long")
    left = intervals.complement(df, sizes)
    assert [(r.start, r.end) for r in left.filter("chrom = 'r'").collect()] == [(0, 50)]
    total = left.unionByName(merged).filter("chrom <> 'r'").agg(F.sum(F.col("end") - F.col("start"))).first()[0]
    assert total == 240


def naive_collapse(rows):
    code = {"A": 1, "C": 2, "G": 4, "T": 8, "M": 3, "R": 5, "W": 9, "S": 6, "Y": 10, "K": 12, "V": 7, "H": 11, "D": 13, "B": 14, "N": 15}
    back = {v: k for k, v in code.items()}
    out, cur = [], None
    for s, e, n in sorted(rows):
        if cur is None:
            cur = (s, e, n)
        elif (s, e) == cur[:2]:
            continue
        elif cur[1] > s and cur[1] < e:
            o = s - cur[0]
            m = "".join(back[code[x] | code[y]] for x, y in zip(cur[2][o:], n, strict=False))
            cur = (cur[0], e, cur[2][:o] + m + n[len(cur[2]) - o :])
        else:
            out.append(cur)
            cur = (s, e, n)
    return out + [cur]


def test_collapse_is_the_fold(spark):
    rng = random.Random(2)
    fixed = [(0, 5), (3, 7), (3, 7), (6, 12), (7, 12), (8, 9)]
    cases = [fixed] + [[(a, a + rng.randint(1, 6)) for a in (rng.randint(0, 25) for _ in range(9))] for _ in range(12)]
    rows = [(str(i), a, b, "".join(rng.choice("ACGT") for _ in range(b - a))) for i, c in enumerate(cases) for a, b in c]
    got = intervals.collapse(spark.createDataFrame(rows, "chrom string, start long, end long, name string")).collect()
    for i in range(len(cases)):
        want = naive_collapse([r[1:] for r in rows if r[0] == str(i)])
        assert sorted((r.start, r.end, r.name) for r in got if r.chrom == str(i)) == sorted(want)


def test_collapse_of_a_long_island(spark):
    """One island of many intervals, nulls and odd letters; a fold in one pass."""
    n = 60_000
    rows = spark.range(n).select(F.lit(None).cast("int").alias("chrom"), (F.col("id") * 2).alias("start"), (F.col("id") * 2 + 3).alias("end"), F.lit("ACR").alias("name"))
    got = intervals.collapse(rows).collect()
    assert len(got) == 1 and (got[0].chrom, got[0].start, got[0].end, len(got[0].name)) == (None, 0, 2 * n + 1, 2 * n + 1)
    assert got[0].name[:5] == "ACRCR" and got[0].name[-3:] == "RCR"
    odd = spark.createDataFrame([("c", 0, 4, "acgt"), ("c", 2, 6, "gxAA"), ("c", 9, 9, None), ("c", 10, 12, None), ("c", None, 5, "A"), ("c", 11, 14, "ACG")], "chrom string, start long, end long, name string")
    assert sorted(map(tuple, intervals.collapse(odd).collect())) == [("c", 0, 6, "acgNAA"), ("c", 9, 9, None), ("c", 10, 14, "ACG")]
    assert intervals.collapse(odd.limit(0)).count() == 0


@pytest.mark.parametrize("chunk", [7, 1 << 15])
def test_motifs_by_brute_force(spark, monkeypatch, chunk):
    monkeypatch.setattr(mapping, "CHUNK", chunk)
    monkeypatch.setattr(mapping, "LOT", 60)
    rng = random.Random(3)
    motifs = ["ACRT", "GGNCC", "A", "NN", "ACGTN", "TTYAGRNNA", "XAC", "cwsa", "", "NNNNNNNNNNNNNNNNNNNNNN", "AC-GT"]
    rows = [(i, "".join(rng.choices("ACGTNacX-é", [9, 9, 9, 9, 1, 1, 1, 1, 1, 1], k=rng.choice([0, 1, 4, 30, 90])))) for i in range(40)] + [(99, None), (3, "ACGTACGTA")]
    df = spark.createDataFrame(rows, "id int, seq string").withColumns({"number": F.lit(1), "motif": F.lit("x")}).repartition(3)
    fits = lambda m, w: all(b in S.IUPAC.get(c, c) for c, b in zip(m.upper(), w, strict=True))
    comp = lambda s: "".join(S.COMPLEMENT.get(c, S.COMPLEMENT.get(c.upper(), c.upper()).lower() if c.islower() else c) for c in reversed(s))
    want = Counter()
    for i, seq in rows:
        for strand, s in (("+", seq or ""), ("-", comp(seq or ""))):
            want.update((m, i, at, strand) for m in motifs if m for at in range(len(s) - len(m) + 1) if fits(m, s[at : at + len(m)]))
    got = Counter((r.motif, r.id, r.start, r.strand) for r in mapping.motif_hits(motifs, df, "id", True).collect())
    assert got == want
    plus = {(m, i) for m, i, _, s in want if s == "+"}
    scores = {r.motif: r.n_records for r in mapping.motif_scores(motifs, df, "id").collect()}
    assert scores == Counter(m for m, _ in plus)


def test_a_thousand_motifs(spark):
    """Many motifs on a long record, found by the places of four letters."""
    rng = random.Random(1)
    motifs = sorted({"".join(rng.choices("ACGTRYN", [5, 5, 5, 5, 1, 1, 1], k=12)) for _ in range(1000)})
    record = spark.range(1).select("id", F.lit("".join(rng.choices("ACGT", k=200_000))).alias("seq"))
    seq = record.first().seq
    hits = mapping.motif_hits(motifs, record, "id").collect()
    found = Counter(r.motif for r in hits)
    for m in motifs[::97]:
        assert found[m] == len(re.findall(f"(?=({S.iupac_pattern(m)}))", seq))


def test_mapping_both_strands(spark):
    refs = spark.createDataFrame([("r", "AACCTTGGTT")], "chrom string, seq string")
    table = spark.createDataFrame([("1", "AACC"), ("2", "AACC")], "id string, kmer string")
    hits = mapping.map_kmers(table, refs, 4)
    assert sorted((r.id, r.start, r.strand) for r in hits.collect()) == [("2", 0, "+"), ("2", 6, "-")]
    sam = {r.flag: (r.pos, r.seq) for r in mapping.as_sam(hits, 4).collect()}
    assert sam == {0: (1, "AACC"), 16: (7, "GGTT")}
    assert [(r.start, r.end) for r in mapping.as_regions(hits, 4).orderBy("start").collect()] == [(0, 4), (6, 10)]


def test_amplicons_binned_as_naive(spark):
    rng = random.Random(5)
    rows = [(f"o{i % 3}", rng.choice("st"), rng.randint(0, 3000), rng.choice(["plus", "minus"])) for i in range(300)]
    hits = spark.createDataFrame(rows, "qseqid string, sseqid string, sstart long, strand string")
    got = Counter((r.FP_ID, r.RP_ID, r.sseqid, r.Start, r.End) for r in pcr.amplicons(hits, 40, 170).collect())
    want = Counter((f[0], r[0], f[1], f[2], r[2]) for f in rows for r in rows if f[1] == r[1] and f[3] == "plus" and r[3] == "minus" and 40 <= r[2] - f[2] <= 170)
    assert got == want


def test_seed_search_as_naive(spark):
    rng = random.Random(6)
    seq = "".join(rng.choice("ACGT") for _ in range(300))
    oligo = seq[40:52]
    bad = oligo[:3] + ("A" if oligo[3] != "A" else "C") + oligo[4:]
    oligos = spark.createDataFrame([("x", oligo), ("y", bad), ("z", rc(seq[100:112]))], "id string, seq string")
    got = {(r.qseqid, r.sstart, r.send, r.nident) for r in pcr.seed_search(oligos, spark.createDataFrame([("s", seq)], "sseqid string, seq string"), 2).collect()}
    want = set()
    for name, o in (("x", oligo), ("y", bad), ("z", rc(seq[100:112]))):
        for p, minus in ((o, False), (rc(o), True)):
            for i in range(len(seq) - 11):
                d = sum(a != b for a, b in zip(p, seq[i : i + 12], strict=True))
                if d <= 2:
                    want.add((name, i + 12 if minus else i + 1, i + 1 if minus else i + 12, 12 - d))
    assert got == want


def test_exclusive_and_failures(spark):
    hits = spark.createDataFrame([("s1", "x", "a"), ("s2", "x", "a"), ("s2", "y", "b")], "primer_set string, label string, accession string")
    orgs = spark.createDataFrame([("x",), ("y",), ("z",)], "label string")
    good, bad = evaluate.exclusive_sets(hits, orgs)
    assert sorted(map(tuple, good.collect())) == [("x", "s1")]
    assert {(r.label, r.primer_set): r.failure_acc for r in evaluate.failure_lists(bad).collect()}[("x", "s2")] == ["b"]
    lists = {r.label: r.primers for r in evaluate.exclusive_json(good, orgs).collect()}
    assert lists == {"x": ["s1"], "y": [], "z": []}


def test_coverage_keeps_labels_without_hits(spark):
    hits = spark.createDataFrame([("x", "a"), ("x", "a"), ("x", "b")], "label string, accession string")
    totals = spark.createDataFrame([("x", "a"), ("x", "b"), ("x", "c"), ("y", "d")], "label string, accession string")
    got = {r.label: (r.hits, r.coverage) for r in evaluate.coverage(hits, totals).collect()}
    assert got == {"x": (2, 2 / 3), "y": (0, None)}
    assert sorted(map(tuple, evaluate.missing(hits, totals).collect())) == [("x", "c"), ("y", "d")]


def test_composition_off_target(spark):
    rows = spark.createDataFrame([("p", "x", "1", "AAACCC"), ("p", "y", "2", "AAACCC"), ("p", "x", "3", "GGGTTT"), ("q", "z", "4", "AAACCC")], "primer_set string, label string, accession string, AmpliconSeq string")
    got = {(r.label, r.accession): r.failure_acc for r in evaluate.off_target_by_composition(rows).collect()}
    assert got == {("x", "1"): ["2"], ("y", "2"): ["1"]}


@pytest.mark.parametrize(("k", "full", "strands"), [(3, True, False), (4, False, True), (31, True, True), (33, True, True)])
def test_packed_windows_by_counting(spark, monkeypatch, k, full, strands):
    monkeypatch.setattr(kmers, "LOT", 90)
    rng = random.Random(k)
    rows = [(rng.choice(["x", "y", None]), rng.randrange(3), "".join(rng.choices("ACGTacNRé"[: rng.choice([4, 8, 9])], k=rng.choice([0, 2, 3, 30, 70])))) for _ in range(60)] + [("x", 1, None)]
    df = spark.createDataFrame(rows, "g string, h int, seq string").repartition(3)
    want = Counter()
    for g, h, s in rows:
        s = (s or "") if full else (s or "")[:-1]
        for i in range(len(s) - k + 1):
            w = s[i : i + k]
            want[g, h, w] += 1
            if strands:
                want[g, h, "".join(S.COMPLEMENT.get(c, c) for c in reversed(w))] += 1
    got = kmers.packed(df, k, full, keep=("g", "h"), strands=strands).groupBy("g", "h", kmers.unpacked(k).alias("kmer")).agg(F.sum("n").alias("n"))
    assert {(r.g, r.h, r.kmer): r.n for r in got.collect()} == want


def test_exclusive_kmers_and_document_frequency(spark, monkeypatch):
    monkeypatch.setattr(kmers, "CHUNK", 20)
    rng = random.Random(8)
    rows = [(i, rng.choice(["en", "de", None]), "".join(rng.choices("ACGTN", [9, 9, 9, 9, 1], k=rng.choice([3, 15, 60])))) for i in range(50)]
    for many in (rows, [*rows, (7, "en", "ACGTACGTAC"), (None, "en", "ACGT"), (None, "en", "ACGT")]):
        df = spark.createDataFrame(many, "id long, lang string, seq string").repartition(3)
        sets = {}
        for i, lang, s in many:
            sets.setdefault(i, set()).update(s[j : j + 4] for j in range(len(s) - 3))
        want = Counter(w for x in sets.values() for w in x if set(w) <= set("ACGT"))
        assert {r.kmer: r.n for r in kmers.document_frequency(df, 4, "id").collect()} == want
        own = {s[j : j + 4] for _, x, s in many if x == "en" for j in range(len(s) - 3)} - {s[j : j + 4] for _, x, s in many if x != "en" for j in range(len(s) - 3)}
        assert sorted(map(tuple, kmers.exclusive(df, 4, F.col("lang") == "en").collect())) == sorted((f"marker_{i}", w) for i, w in enumerate(sorted(own)))
        assert {r.kmer for r in kmers.union(df, 4, True).collect()} == {x for w in set().union(*sets.values()) for x in (w, rc(w) if "N" not in w else "".join(S.COMPLEMENT.get(c, c) for c in reversed(w)))}


def off_target_lists(rows, profile):
    """By the definition: every accession with all those of other labels under its profiles."""
    got = {}
    for p, x, a, s in rows:
        for q, y, b, t in rows:
            if s is not None and t is not None and p == q and x != y and profile(s) == profile(t):
                got.setdefault((p, x, a), set()).add(b)
    return {k: sorted(v) for k, v in got.items()}


@pytest.mark.parametrize("exact", [False, True])
def test_off_target_members_by_brute_force(spark, exact):
    rng = random.Random(21)
    seqs = ["AAACCC", "CCCAAA", "AAACCCA", "GGGTTT", "TTTGGGT", None, "AC"]
    rows = [(rng.choice("pq"), rng.choice(["x", "y", "z", None]), f"acc{rng.randrange(25)}", rng.choice(seqs)) for _ in range(160)]
    df = spark.createDataFrame(rows, "primer_set string, label string, accession string, AmpliconSeq string").withColumn("own", F.lit(1)).repartition(3)
    windows = lambda s: Counter(s[i : i + 3] for i in range(len(s) - 2))
    profile = (lambda s: s) if exact else windows
    want = off_target_lists(rows, profile)
    assert {(r.primer_set, r.label, r.accession): r.failure_acc for r in evaluate.off_target_by_composition(df, exact=exact).collect()} == want
    members = evaluate.off_target_members(df, exact=exact).collect()
    keyed = {(p, str(sorted(profile(s).items()) if not exact else s), x, a) for p, x, a, s in rows if s is not None}
    groups = Counter(k[:2] for k in keyed)
    own = Counter(k[:3] for k in keyed)
    several = {k for k in groups if len({x for x in own if x[:2] == k}) > 1}
    assert sorted((r.primer_set, str(r.label), r.accession, r.others) for r in members) == sorted((p, str(x), a, groups[p, s] - own[p, s, x]) for p, s, x, a in keyed if (p, s) in several)


def test_off_target_members_are_linear(spark):
    """Ten thousand accessions of one profile: a row each, and a list a label."""
    rows = spark.range(10_000).select(F.lit("p").alias("primer_set"), (F.col("id") % 2).cast("string").alias("label"), F.col("id").cast("string").alias("accession"), F.lit("ACGTACGTT").alias("AmpliconSeq"))
    members = evaluate.off_target_members(rows)
    assert members.groupBy("label", "others").count().orderBy("label").collect() == [("0", 5000, 5000), ("1", 5000, 5000)]
    assert evaluate.off_target_failures(members).groupBy("label").count().orderBy("label").collect() == [("0", 5000), ("1", 5000)]


def test_lineage_by_walking(spark):
    rng = random.Random(5)
    taxa = {i: (rng.choice([i // 2, i - 1, i - 3, None, 10**6, i]), rng.choice(["species", "genus", "clade", None])) for i in range(1, 400)}
    taxa |= {500: (501, "clade"), 501: (502, "genus"), 502: (500, "clade"), 600: (601, "clade"), 601: (600, "clade")}
    taxa |= {1000 + i: (999 + i, "clade") for i in range(1, 300)} | {1000: (None, "species")}
    rows = [(i, p, r) for i, (p, r) in taxa.items()] + [(None, 1, "species"), (7, *taxa[7])]
    want = set()
    for i in taxa:
        for rank in ("species", "genus"):
            at, seen = i, set()
            while at in taxa and at not in seen and taxa[at][1] != rank:
                seen.add(at)
                at = taxa[at][0]
            if at in taxa and taxa[at][1] == rank:
                want.add((i, rank, at))
    df = spark.createDataFrame(rows, "taxid long, parent long, rank string").withColumn("name", F.lit("x"))
    assert {tuple(r) for r in evaluate.lineage(df, ["species", "genus"]).collect()} == want
    hits = spark.createDataFrame([("a", 1299), ("b", 601), ("c", 77777), ("d", None)], "accession string, taxid long")
    labels = {r.accession: r.label for r in evaluate.with_taxon(hits.select("accession"), hits, evaluate.lineage(df, ["species"])).collect()}
    assert labels == {"a": "1000", "b": "0", "c": "0", "d": "0"}
    assert evaluate.lineage(df.limit(0), ["species"]).count() == 0


def test_best_hits_and_representatives(spark):
    hits = spark.createDataFrame([("q", "s", 5.0, 9, 1), ("q", "s", 7.0, 8, 2), ("q", "s", 7.0, 3, 4), ("q", "t", 1.0, 1, 1), ("r", "s", 2.0, 1, 1)], "qseqid string, sseqid string, bitscore double, sstart int, send int")
    assert sorted((r.qseqid, r.sseqid, r.sstart) for r in pcr.best_hits(hits).collect()) == [("q", "s", 3), ("q", "t", 1), ("r", "s", 1)]
    assert sorted(r.sstart for r in pcr.best_hits(hits.filter("qseqid = 'q' AND sseqid = 's'"), 2).collect()) == [3, 8]
    clusters = spark.createDataFrame([(f"r{i}", i % 3) for i in range(30)], "record string, cluster int")
    chosen = {r.cluster: r.record for r in cluster.representatives(clusters, 4).collect()}
    assert chosen == {r.cluster: r.record for r in cluster.representatives(clusters.repartition(5), 4).collect()}
    assert all(int(v[1:]) % 3 == k for k, v in chosen.items()) and len(chosen) == 3
    counts = kmers.document_frequency(spark.createDataFrame([(1, "ACGTT"), (2, "ACGAA")], "id long, seq string"), 3, "id", singletons=False)
    assert [tuple(r) for r in counts.collect()] == [("ACG", 2)]
    thin = cluster.sketch(spark.createDataFrame([("a", "ACGTTGCATGTCAGT" * 20)], "rec string, seq string"), 11, "rec", 4)
    whole = cluster.sketch(spark.createDataFrame([("a", "ACGTTGCATGTCAGT" * 20)], "rec string, seq string"), 11, "rec")
    kept = {(r.hash, r.abund) for r in thin.collect()}
    assert kept == {(r.hash, r.abund) for r in whole.collect() if (r.hash % 2**64) >> 1 < 2**63 // 4}


def test_labelled_without_default_and_names(spark):
    rows = spark.createDataFrame([("a", 1), ("b", 2), (None, 3)], "accession string, n int")
    labels = spark.createDataFrame([("a", "x"), ("a", "y"), ("c", "z")], "accession string, label string")
    assert sorted(map(tuple, evaluate.labelled(rows, labels).collect())) == [("a", 1, "x"), ("a", 1, "y")]
    assert {(r.accession, r.label) for r in evaluate.labelled(rows, labels, "Off Target").collect()} == {("a", "x"), ("a", "y"), ("b", "Off Target"), (None, "Off Target")}
    named = rows.select("n", evaluate.taxon_name(F.col("accession"), {"a": "yeast"}).alias("name")).collect()
    assert {r.n: r.name for r in named} == {1: "yeast", 2: "Unknown", 3: "Unknown"}
    assert rows.select(evaluate.taxon_name(F.col("accession"), {}).alias("name")).distinct().collect() == [("Unknown",)]


def test_hamming_clusters_whole(spark):
    rng = random.Random(8)
    words = sorted({"".join(rng.choice("AC") for _ in range(6)) for _ in range(25)})
    df = spark.createDataFrame([(w,) for w in words], "kmer string")
    d = lambda a, b: sum(x != y for x, y in zip(a, b, strict=True))
    got = {(r.a, r.b): r.d for r in cluster.hamming_pairs(df, 6, 2).collect()}
    assert got == {(a, b): d(a, b) for a in words for b in words if a < b and d(a, b) <= 2}
    assert sorted(r.kmer for r in cluster.hamming_clusters(df, 6, 1).collect()) == words


def test_greedy_motifs(spark):
    counts = spark.createDataFrame([("AAAA", 9), ("AAAC", 5), ("AACC", 4), ("TTTT", 3)], "kmer string, n long")
    got = {r.kmer: r.cluster for r in cluster.greedy_motifs(counts, 4, 1).collect()}
    assert got == {"AAAA": "AAAA", "AAAC": "AAAA", "AACC": "AACC", "TTTT": "TTTT"}
    motifs = {r.cluster: r.motif for r in cluster.consensus(cluster.greedy_motifs(counts, 4, 1), "cluster").collect()}
    assert motifs["AAAA"] == "AAAM"


def test_archives(spark):
    a = spark.createDataFrame([("a", "1", b"x"), ("a", "2", b"y")], "archive string, member string, content binary")
    b = spark.createDataFrame([("b", "2", b"z")], "archive string, member string, content binary")
    assert [r.member for r in archives.subtract(a, b).collect()] == ["1"]
    assert archives.add(a, b).count() == 3


def test_components(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(20)] + [(50, 40), (40, 45), (9, 9)], "u long, v long")
    got = {r.node: r.component for r in cluster.components(edges, "u", "v").collect()}
    assert got == {i: 0 for i in range(21)} | {40: 40, 45: 40, 50: 40}
    assert cluster.components(edges.limit(0), "u", "v").count() == 0


@pytest.mark.parametrize("lot", [7, 1000])
def test_joined_records_have_the_joined_windows(spark, lot):
    rng = random.Random(lot)
    rows = [(i, rng.choice("xy"), "".join(rng.choice("ACGT") for _ in range(rng.choice([0, 1, 1, 2, 5, 30])))) for i in range(80)]
    df = spark.createDataFrame(rows, "i long, r string, seq string").repartition(5)
    want = Counter()
    for r in "xy":
        whole = "".join(s for _, g, s in rows if g == r)
        want.update((r, whole[i : i + 7]) for i in range(len(whole) - 6))
    got = cluster.joined_records(df, 7, "r", "i", lot).collect()
    assert Counter((r, s[i : i + 7]) for r, s in got for i in range(len(s) - 6)) == want


def test_groups_are_not_joined_in_one_row(spark, tmp_path):
    rows = [(i, w * 9, "en", "s") for i, w in enumerate(("alpha", "beta", "gamma"))]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string").write.parquet(f"{tmp_path}/documents.parquet")
    out = queries.minhash_jaccard(spark, str(tmp_path))
    assert "collect_list" not in out._jdf.queryExecution().optimizedPlan().toString()
    assert [tuple(r) for r in out.collect()] == [("en/s", "en/s", 1.0)]


def test_ward_by_brute_force(spark):
    """Merges of mutual neighbours give the tree of one merge at a time, over several blocks."""
    rng = np.random.default_rng(4)
    n = 23
    sim = np.clip(np.add.outer(rng.random(n), rng.random(n)) / 2 * (rng.random((n, n)) < 0.6), 0, 1)
    sim = np.maximum(sim, sim.T)
    np.fill_diagonal(sim, 1.0)
    names = [f"r{i:02d}" for i in range(n)]
    rows = [(names[i], names[j], float(sim[i, j])) for i in range(n) for j in range(i, n) if sim[i, j] > 0]
    pairs = spark.createDataFrame(rows, "a string, b string, sim double")
    records, distances = cluster.row_distances(pairs, block=7)
    square = ((sim[:, None] - sim[None]) ** 2).sum(axis=2)
    got = {(r.i - 1, r.j - 1): r.e for r in distances.collect()}
    assert len(got) == n * (n - 1) // 2 and all(abs(square[k] - e) < 1e-9 for k, e in got.items())
    merges = cluster.ward_merges(distances, records).persist()
    for clusters, distance in ((1, None), (4, None), (n, None), (None, 1.5)):
        found = {r.record: r.cluster for r in cluster.ward_cut(merges, records, clusters, distance).collect()}
        assert [found[x] for x in names] == cluster.ward_linkage(sim, clusters, distance).tolist()
    labels = cluster.label_table(cluster.ward_cut(merges, records, 2), "run_")
    assert labels.columns == ["accession", "label"] and {r.label for r in labels.collect()} == {"run_cluster_1", "run_cluster_2"}


@pytest.mark.parametrize("abundance", [False, True])
def test_similarity_by_brute_force(spark, monkeypatch, abundance):
    """Blocks of few records, few keys at a time, sums passed on early; a hash that all have."""
    monkeypatch.setattr(cluster.gram, "__defaults__", (False, 7))
    monkeypatch.setattr(cluster, "KEYS", 5)
    monkeypatch.setattr(cluster, "HELD", 3)
    rng = random.Random(4)
    sets = {f"r{i:02}": {rng.randrange(60): rng.randint(1, 9) for _ in range(rng.choice([1, 6, 15]))} for i in range(30)}
    for i, s in enumerate(sets.values()):
        if i % 4:
            s[999] = 3
    rows = [(r, h, n) for r, s in sets.items() for h, n in s.items()]
    got = {(r.a, r.b): r.sim for r in cluster.similarity(spark.createDataFrame(rows, "rec string, hash long, abund long").repartition(3), "rec", abundance).collect()}
    want = {}
    for a, b in itertools.combinations_with_replacement(sorted(sets), 2):
        x, y = sets[a], sets[b]
        if both := x.keys() & y.keys():
            cosine = sum(x[h] * y[h] for h in both) / (sum(v * v for v in x.values()) * sum(v * v for v in y.values())) ** 0.5
            want[a, b] = 1 - 2 * np.arccos(min(1.0, cosine)) / np.pi if abundance else len(both) / len(x.keys() | y.keys())
    assert got.keys() == want.keys() and all(abs(got[k] - want[k]) < 1e-7 for k in want)


def test_islands_across_bins(spark):
    """Intervals that span many bins, touch, nest, or stand in bins of their own."""
    rng = random.Random(6)
    rows = [(c, s := rng.randrange(4000), s + rng.choice([1, 3, 10, 900])) for c in ("a", "b", None) for _ in range(60)]
    df = spark.createDataFrame(rows, "chrom string, start long, end long")
    want = set()
    for c in ("a", "b", None):
        runs = []
        for s, e in sorted((s, e) for x, s, e in rows if x == c):
            if runs and s <= runs[-1][1]:
                runs[-1][1] = max(runs[-1][1], e)
            else:
                runs.append([s, e])
        want |= {(c, s, e) for s, e in runs}
    for width in (1, 50, 1 << 16):
        island = intervals.islands(df.distinct(), ("chrom",), ("start", "end"), True, width)
        got = island.groupBy("chrom", "__island").agg(F.min("start").alias("s"), F.max("end").alias("e"))
        assert {(r.chrom, r.s, r.e) for r in got.collect()} == want


def test_translated_search(spark):
    rng = random.Random(9)
    genome = "".join(rng.choices("ACGT", k=500))
    markers, want = [], set()
    for i, (at, minus) in enumerate(((0, False), (100, True), (101, False), (302, True), (476, False))):
        part = genome[at : at + 24]
        part = part[::-1].translate(str.maketrans("ACGT", "TGCA")) if minus else part
        protein = "".join(S.CODONS[part[j : j + 3]] for j in range(0, 24, 3))
        markers.append((f"m{i}", protein))
        want.add((f"m{i}", "g", (-1 if minus else 1) * (at % 3 + 1), at + (24 if minus else 1), at + (1 if minus else 24)))
    marker_rows = spark.createDataFrame(markers + [("none", "WWWWWWWW")], "id string, protein string")
    genomes = spark.createDataFrame([("g", genome), ("h", None), ("i", "AC")], "sseqid string, seq string")
    assert {tuple(r) for r in pcr.translated_search(marker_rows, genomes).collect()} == want
    assert pcr.translated_search(marker_rows.limit(0), genomes).count() == 0


def test_guards_and_filters(spark):
    rows = [("p|x", "q|y", "io", 1, 2, "hit", "gb|AC.1|", 50, 90, 41), ("r|x", "s|y", None, 0, 0, "hit", "AC.2", 1, 20, 20)]
    amplicons = spark.createDataFrame(rows, "FP_ID string, RP_ID string, ProbeID string, FP_mismatches int, RP_mismatches int, HitName string, Full_Hit_ID string, Start long, End long, amplicon_len int")
    assert [r.FP_ID for r in evaluate.longer_than(amplicons, 20).collect()] == ["p|x"]
    with_probe, without_probe = evaluate.by_probe(amplicons)
    assert [r.FP_ID for r in with_probe.collect()] == ["p|x"] and [r.FP_ID for r in without_probe.collect()] == ["r|x"]
    assert sorted(r.position for r in pcr.position_range(amplicons).collect()) == ["1-20", "50-90"]
    assert {(r.primer_pair, r.primer, r.accession_num, r.primer_set) for r in evaluate.packaged(amplicons).collect()} == {("p|x_q|y", "p", "AC.1", "io,p,q"), ("r|x_s|y", "r", "AC.2", "r,s")}
    meta = spark.createDataFrame([("a", 1), ("b", 2)], "accession string, v int")
    assert [r.v for r in evaluate.restricted(meta, spark.createDataFrame([("a",)], "id string")).collect()] == [1]
    hits = spark.createDataFrame([("plus",), ("minus",)], "strand string")
    assert pcr.both_strands(hits).count() == 2
    with pytest.raises(ValueError):
        pcr.both_strands(hits.limit(1))
    none = spark.createDataFrame([], "id string, seq string")
    assert pcr.seed_search(none, spark.createDataFrame([("s", "ACGT")], "sseqid string, seq string")).count() == 0


def test_resampled_matrix(spark):
    records = spark.createDataFrame([("b", "s1", "ACGTT"), ("b", "s2", "ACGAA"), ("c", "s3", "TTTTT")], "bin string, sample string, seq string")
    matrix, index = kmers.sample_matrix(records, 3, "bin", "sample"), kmers.sample_index(records, "bin", "sample")
    draws = spark.createDataFrame([(0, "s2"), (1, "s2"), (2, "s3")], "draw int, accession string")
    one = {(r.bin, r.kmer): r.n for r in matrix.filter("bin = 'b' AND sample_idx = 1").collect()}
    got = kmers.resampled_matrix(matrix, index, draws)
    for draw in (0, 1):
        assert {(r.bin, r.kmer): r.n for r in got.filter(F.col("draw") == draw).collect()} == one
    assert {r.bin for r in got.filter("draw = 2").collect()} == {"c"}


def test_long_record_in_time(spark):
    """A record of a million letters: windows and translation are linear in its length."""
    import time

    seq = "".join(random.Random(1).choices("ACGT", k=1_000_000))
    df = spark.createDataFrame([(1, seq)], "id int, seq string")
    began = time.time()
    assert kmers.exploded(df, 18).count() == 1_000_000 - 17
    assert kmers.protein_kmers(df, 4, "id").count() > 100_000
    assert time.time() - began < 60


@pytest.mark.parametrize(("letters", "k", "most", "n"), [("ACGT", 6, 2, 90), ("ACGTN", 5, 1, 120)])
def test_hamming_clusters_by_brute_force(spark, letters, k, most, n):
    """One merge at a time, the nearest pair first, with exact fractions."""
    rng = random.Random(12 + k)
    words = sorted({"".join(rng.choices(letters, k=k)) for _ in range(n)})
    df = spark.createDataFrame([(w,) for w in [*words, None, words[0]]], "kmer string")
    pairs = spark.createDataFrame(list(itertools.combinations(words, 2)), "i string, j string")
    tie = {(r.i, r.j): r.h for r in pairs.select("i", "j", F.xxhash64("i", "j").alias("h")).collect()}
    groups = {w: [w] for w in words}
    far = {(a, b): sum(x != y for x, y in zip(a, b, strict=True)) for a in words for b in words}
    sums = {p: far[p] for p in itertools.combinations(words, 2)}
    while sums:
        d, _, i, j = min((Fraction(s, len(groups[i]) * len(groups[j])), tie[i, j], i, j) for (i, j), s in sums.items())
        if d > most:
            break
        groups[i] += groups.pop(j)
        sums = {(a, b): sum(far[x, y] for x in groups[a] for y in groups[b]) if i in (a, b) else sums[a, b] for a, b in itertools.combinations(sorted(groups), 2)}
    got = {}
    for r in cluster.hamming_clusters(df, k, most).collect():
        got.setdefault(r.cluster, []).append(r.kmer)
    assert {c: sorted(x) for c, x in got.items()} == {min(x): sorted(x) for x in groups.values()} and max(map(len, got.values())) > (letters == "ACGT")


def test_hamming_clusters_of_little(spark):
    none = spark.createDataFrame([], "kmer string")
    assert cluster.hamming_clusters(none, 4, 1).count() == 0
    two = spark.createDataFrame([("AAAA",), ("TTTT",), ("AAAA",)], "kmer string")
    assert sorted(map(tuple, cluster.hamming_clusters(two, 4, 1).collect())) == [("AAAA", "AAAA"), ("TTTT", "TTTT")]


@pytest.mark.parametrize("masks", [0, 10**6])
def test_hamming_pairs_by_masks_and_by_pieces(spark, monkeypatch, masks):
    monkeypatch.setattr(cluster, "MASKS", masks)
    rng = random.Random(3)
    words = sorted({"".join(rng.choices("ACGT", k=7)) for _ in range(300)})
    df = spark.createDataFrame([(w,) for w in words], "kmer string")
    for most in (1, 3):
        got = sorted(map(tuple, cluster.hamming_pairs(df, 7, most).collect()))
        want = [(a, b, d) for a, b in itertools.combinations(words, 2) if (d := sum(x != y for x, y in zip(a, b, strict=True))) <= most]
        assert got == want
    assert cluster.hamming_pairs(df, 7, 0).count() == 0


@pytest.mark.parametrize(("most", "n", "letters", "k", "size"), [(2, 4, "ACGT", 5, 60), (None, 20, "AC", 6, 50)])
def test_greedy_motifs_by_brute_force(spark, most, n, letters, k, size):
    rng = random.Random(13)
    counts = {"".join(rng.choices(letters, k=k)): rng.randrange(4) for _ in range(size)}
    df = spark.createDataFrame(list(counts.items()), "kmer string, n long")
    tie = {r.kmer: r.h for r in df.select("kmer", F.xxhash64("kmer").alias("h")).collect()}
    far = lambda a, b: sum(x != y for x, y in zip(a, b, strict=True))
    near = {a: sorted((far(a, b), b) for b in counts if b != a and far(a, b) <= (k if most is None else most))[:n] for a in counts}
    got = {}
    for r in cluster.nearest(df, k, most, n).orderBy("a", "rank").collect():
        got.setdefault(r.a, []).append((r.d, r.b))
    assert got == {a: x for a, x in near.items() if x}
    key = lambda x: (-counts[x], tie[x], x)
    owner = {}
    for a in sorted(counts, key=key):
        if a not in owner:
            owner[a] = a
            for _, b in near[a]:
                if key(a) < key(b):
                    owner.setdefault(b, a)
    motifs = cluster.greedy_motifs(df, k, most, n)
    assert {(r.cluster, r.kmer) for r in motifs.collect()} == {(v, x) for x, v in owner.items()}
    # Parts of a seed's k-mers: one merge at a time, the first nearest pair first.
    want = set()
    for seed in {*owner.values()}:
        groups = [[x] for x in sorted(owner) if owner[x] == seed]
        while len(groups) > 1:
            d, i, j = min((Fraction(sum(far(x, y) for x in a for y in b), len(a) * len(b)), i, j) for (i, a), (j, b) in itertools.combinations(enumerate(groups), 2))
            if d > 1:
                break
            groups[i] += groups.pop(j)
        want |= {(seed, min(g), x) for g in groups for x in g}
    assert {tuple(r) for r in cluster.sub_clusters(motifs, 1.0).collect()} == want


def test_nearest_of_little(spark):
    none = spark.createDataFrame([], "kmer string")
    assert cluster.nearest(none, 4).count() == 0 and cluster.nearest(spark.createDataFrame([("ACGT",)], "kmer string"), 4).count() == 0
    two = spark.createDataFrame([("AAAA",), ("TTTT",), (None,)], "kmer string")
    assert sorted(map(tuple, cluster.nearest(two, 4).collect())) == [("AAAA", "TTTT", 4, 1), ("TTTT", "AAAA", 4, 1)]


def test_alignment_on_frames(spark):
    """Probes by prefix and over the whole panel, primers on both ends, against one by one."""
    rng = random.Random(14)
    letters = lambda n: "".join(rng.choices("ACGT", k=n))
    panel = [(f"a{i % 3}|{i}", letters(9) + rng.choice("ACGTRYN") + letters(4)) for i in range(6)]
    rows = []
    for i in range(25):
        site = list(align.expanded(rng.choice(panel)[1])[0])
        site[rng.randrange(len(site))] = rng.choice("ACGT")
        fp, rp = letters(12), letters(12)
        seq = fp + letters(20) + "".join(site) + letters(15) + align.complemented(rp)
        rows.append((i, f"a{i % 4}|F", fp[:5] + rng.choice("ACGTN") + fp[6:], rp[:-1] + rng.choice("ACGT"), seq))
    rows.append((99, "a1|F", "ACGT", "ACGT", None))
    df = spark.createDataFrame(rows, "id long, FP_ID string, FP_seq string, RP_seq string, AmpliconSeq string")
    probes = spark.createDataFrame(panel, "id string, seq string")
    for mux in (False, True):
        for r in align.align_probes(df, probes, 2, mux).collect():
            best = None
            for name, seq in sorted(panel):
                if r.AmpliconSeq and (mux or name.split("|")[0] == r.FP_ID.split("|")[0]):
                    site = align.probe_site(seq, r.AmpliconSeq, 2)
                    if site and (best is None or site[0] < best[1]):
                        best = name, *site
            assert (r.ProbeID, r.Probe_mismatches, r.Probe_startOnAmplicon, r.ProbeStrand) == (best or (None,) * 4)
    want = set()
    for i, _, fp, rp, seq in rows:
        f, r = align.primer_site(fp, seq or ""), align.primer_site(rp, align.complemented(seq or ""))
        if max(f[0], r[0]) <= 1 and f[1] == r[1] == 0:
            want.add((i, f[0], r[0]))
    got = {(r.id, r.FP_mismatches, r.RP_mismatches) for r in align.realign_primers(df, 1, 0).collect()}
    assert got == want and want
    with pytest.raises(ValueError):
        align.expanded("N" * 9)


def test_oligo_summary(spark):
    """Lengths, melting temperatures by the model's definition, the first row's position."""
    import math

    def tm(seq):
        h, s = (sum(x) for x in zip(*[S.END_AT if c in "AT" else S.END_GC for c in (seq[0], seq[-1])], strict=True))
        for a, b in zip(seq, seq[1:], strict=False):
            x, y = S.PAIRS.get(a + b) or S.PAIRS[rc(a + b)]
            h, s = h + x, s + y
        return h * 1000 / (s + 1.987 * math.log(12.5e-9)) - 273.15 + 11.7 * math.log10((50 + 120 * math.sqrt(0.9)) * 1e-3)

    rows = [(2, "f", "r", "ACGTACGTTA", "GGCCTTAACCAT", "the Hit", 7, 90), (1, "f", "r", "ACGTACGTTA", "GGCCTTAACCAT", "a hit", 5, 80), (3, "g", None, "ACGT", None, "hit", 1, 2), (4, "h", "r", "ACGTA", "CCC", "other", 1, 2)]
    df = spark.createDataFrame(rows, "row_id int, FP_ID string, RP_ID string, FP_seq string, RP_seq string, HitName string, Start int, End int")
    (one,) = evaluate.summary(df, reference="HIT").collect()
    assert (one.FP_ID, one.FP_len, one.RP_len, one.len_diff, one.Start, one.End) == ("f", 10, 12, 2, 5, 80)
    assert abs(one.FP_Tm - tm("ACGTACGTTA")) < 1e-6 and abs(one.RP_Tm - tm("GGCCTTAACCAT")) < 1e-6 and abs(one.Tm_diff - abs(one.FP_Tm - one.RP_Tm)) < 1e-9
    assert evaluate.summary(df).count() == 2


def test_a_cluster_needs_a_shared_folder():
    class Conf(dict):
        set = dict.__setitem__

    class Session:
        conf = Conf({"spark.master": "yarn"})

    with pytest.raises(ValueError, match="checkpoint"):
        tables.shared_dir(Session)
    Session.conf["spark.master"] = "local[2]"
    assert tables.shared_dir(Session) == Session.conf["spark.checkpoint.dir"]


def test_spread_deals_out_single_row_groups(spark, tmp_path):
    spark.range(100).coalesce(1).write.parquet(str(tmp_path / "t"))
    rows = tables.spread(spark.read.parquet(str(tmp_path / "t")))
    assert rows.rdd.getNumPartitions() >= 2 * spark.sparkContext.defaultParallelism and rows.count() == 100
    assert tables.spread(rows) is rows


def test_sums_are_held_over_batches(spark, monkeypatch):
    """One row a group and window however many batches a task reads, also when counts are handed on early."""
    rng = random.Random(3)
    texts = [(f"g{i % 3}" if i % 7 else None, "".join(rng.choice("ACGT" if i % 2 else "ACGTNa") for _ in range(rng.randint(0, 400)))) for i in range(40)]
    frame = spark.createDataFrame(texts, "g string, seq string").coalesce(1)
    flip = str.maketrans("ACGT", "TGCA")
    want = Counter()
    for g, t in texts:
        for i in range(len(t) - 2):
            want[g, t[i : i + 3]] += 1
            want[g, t[i : i + 3][::-1].translate(flip)] += 1
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "5")
    try:
        for held in (1 << 22, 2 * 64):
            monkeypatch.setattr(kmers, "HELD", held)
            rows = kmers.packed(frame, 3, keep=("g",), strands=True).select("g", kmers.unpacked(3).alias("kmer"), "other", "n").collect()
            got = Counter()
            for r in rows:
                got[r.g, r.kmer] += r.n
            assert got == want
            plain = [(r.g, r.kmer) for r in rows if r.other is None]
            assert held < 1 << 22 or len(plain) == len(set(plain))
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_counting_holds_little_of_long_sequences(spark, monkeypatch):
    """Rows handed to Python stay short however long the sequences are, and a lot's windows are never all held."""
    given, whole = [], "ACGTTGCAAC" * 20_000
    frame = spark.createDataFrame([(g, whole) for g in "abcd"], "g string, seq string")
    plain = type(frame).mapInArrow
    monkeypatch.setattr(kmers, "HELD", 1 << 14)
    monkeypatch.setattr(type(frame), "mapInArrow", lambda df, f, schema: given.append((df, f)) or plain(df, f, schema))
    sums = kmers.packed(frame, 5, keep=("g",), strands=True)
    assert {(r.g, r.n) for r in sums.groupBy("g").agg(F.sum("n").alias("n")).collect()} == {(g, 2 * (len(whole) - 4)) for g in "abcd"}
    pieces, count = given[0]
    assert pieces.agg(F.max(F.length("__piece"))).first()[0] < 1 << 11
    rows = [(g, whole[i : i + 1000]) for i in range(0, len(whole), 1000) for g in "abcd"]
    batch = pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*rows, strict=True)], ["g", "__piece"])
    tracemalloc.start()
    try:
        found = sum(sum(b.column("n").to_pylist()) for b in count(iter([batch])))
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert found == 2 * 996 * len(rows) and peak < 16 * batch.nbytes


def test_highest_counts_of_assemblies(spark, monkeypatch):
    """Whole records hand on the highest counts a batch; long records and those of several rows too."""
    rng = random.Random(5)
    for size, repeat in ((1 << 15, 1), (30, 1), (1 << 15, 2)):
        monkeypatch.setattr(kmers, "CHUNK", size)
        rows = [(f"a{i % 2}", i // repeat, "".join(rng.choice("ACGTN" if i == 3 else "AACGT") for _ in range(rng.randint(20, 90)))) for i in range(0, 24)]
        counts = {}
        flip = str.maketrans("ACGT", "TGCA")
        for a, r, t in rows:
            c = counts.setdefault((a, r), Counter())
            for i in range(len(t) - 3):
                c[t[i : i + 3]] += 1
                c[t[i : i + 3][::-1].translate(flip)] += 1
        best = {}
        for (a, _), c in counts.items():
            for w, n in c.items():
                n -= w == w[::-1].translate(flip)
                best.setdefault(w, {})[a] = max(n, best.get(w, {}).get(a, 0))
        want = {(w, min(x.values()), max(x.values())) for w, x in best.items() if len(x) == 2}
        out = kmers.assembly_conserved(spark.createDataFrame(rows, "a string, r int, seq string"), 3, "r", "a")
        assert {tuple(r) for r in out.collect()} == want
        frame = spark.createDataFrame([r for r in rows if r[0] == "a0"], "a string, r int, seq string").coalesce(1).withColumn("own", F.lit(True))
        alone = kmers.packed(frame, 3, False, keep=("a", "own"), strands=True, alone="own").collect()
        if size > 30 and repeat == 1:
            assert len({(r.code, r.other) for r in alone}) == len(alone)


def test_sketches_and_similarities_are_read_once(spark, tmp_path):
    """K-mers are counted as numbers, and what is read several times is written once."""
    rows = spark.createDataFrame([("r1", "ACGTACGTTT"), ("r2", "ACGTTTTACG"), ("r1", "GGGACGT")], "r string, seq string")
    sketch = cluster.sketch(rows, 3, "r")
    want = Counter()
    flip = str.maketrans("ACGT", "TGCA")
    for r in rows.collect():
        for i in range(len(r.seq) - 2):
            w = r.seq[i : i + 3]
            want[r.r, min(w, w[::-1].translate(flip))] += 1
    assert Counter(x.abund for x in sketch.collect()) == Counter(want.values())
    assert "MapInArrow" in sketch._jdf.queryExecution().optimizedPlan().toString()
    records, distances = cluster.row_distances(cluster.similarity(sketch, "r"))
    assert "MapInArrow" not in records._jdf.queryExecution().optimizedPlan().toString()
    assert str(distances._jdf.queryExecution().optimizedPlan().toString()).count("xxhash64") == 0


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_seed_search_looks_places_up_without_a_row_a_window(spark):
    """few seeds are looked up in the pieces; hits are those of brute force over pieces, lengths and letters."""
    rng = random.Random(9)
    seqs = {"s": "".join(rng.choice("ACGT") for _ in range(70_000)), "é": "ACéGT" + "".join(rng.choice("ACGT") for _ in range(300)), "t": "AC", "n": None}
    at = (1 << 15) - 5  # across two pieces
    oligos = {"a": seqs["s"][at : at + 12], "b": seqs["s"][20:29], "c": seqs["é"][2:14], "d": "AC", "e": ""}
    want = set()
    for name, oligo in oligos.items():
        for minus in (False, True):
            probe = oligo if not minus else "".join({"A": "T", "C": "G", "G": "C", "T": "A"}.get(c, c) for c in reversed(oligo))
            for sid, seq in seqs.items():
                for i in range(len(seq or "") - len(probe) + 1 if len(probe) > 1 else 0):
                    off = sum(x != y for x, y in zip(probe, seq[i : i + len(probe)], strict=True))
                    if off <= 1:
                        want.add((name, sid, len(probe) - off, i + len(probe) if minus else i + 1, i + 1 if minus else i + len(probe)))
    rows = spark.createDataFrame(list(oligos.items()), "id string, seq string")
    found = pcr.seed_search(rows, spark.createDataFrame(list(seqs.items()), "sseqid string, seq string"), 1)
    got = [tuple(r) for r in found.select("qseqid", "sseqid", "nident", "sstart", "send").collect()]
    assert len(got) == len(set(got)) and set(got) == want
    assert "Join" not in _plan(found)


def test_present_kmers_of_records(spark):
    """a row a record and k-mer, however often it occurs; nothing is shuffled."""
    panel = spark.createDataFrame([(1, "ACG"), (2, "ACG"), (3, "TTTT"), (4, "éA"), (5, ""), (6, None)], "id long, kmer string")
    records = spark.createDataFrame([("x", "ACGACG"), ("x", "ACGTTTTT"), ("y", "GéA"), ("z", None), (None, "ACG"), ("w", "AC")], "doc string, seq string")
    found = mapping.present(panel, records, ("doc",))
    got = sorted((tuple(r) for r in found.collect()), key=str)
    assert got == sorted([(1, "x"), (2, "x"), (1, "x"), (2, "x"), (3, "x"), (4, "y"), (1, None), (2, None)], key=str)
    assert "Exchange" not in _plan(found) and "Generate" not in _plan(found)


def test_composition_keys_and_profiles_once(spark):
    """keys are equal just for equal compositions; sequences are read once."""
    rng = random.Random(10)
    texts = ["".join(rng.choice("ACG") for _ in range(rng.randint(0, 9))) for _ in range(400)] + ["Aé", "Aéé", "éAé", "AéA", "é" * 5, "AC", "", "ACGTACGT" * 400, "CGTACGTA" * 400]
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(texts)] + [(-1, None)], "id long, seq string").repartition(3)
    keys = {r.id: (r.key.a, r.key.b) for r in rows.select("id", S.composition_key(F.col("seq"), 3).alias("key")).collect()}
    profiles = [tuple(sorted(Counter(t[i : i + 3] for i in range(len(t) - 2)).items())) for t in texts]
    assert keys[-1] == (0, 0)
    assert len({(keys[i], p) for i, p in enumerate(profiles)}) == len(set(profiles)) == len({keys[i] for i in range(len(texts))})
    amplicons = rows.select(F.lit("p").alias("primer_set"), (F.col("id") % 2).cast("string").alias("label"), F.col("id").alias("accession"), F.col("seq").alias("AmpliconSeq"))
    assert "AmpliconSeq" not in _plan(evaluate.off_target_members(amplicons))


def test_complement_reads_intervals_once(spark, tmp_path):
    """the gaps between merged intervals, from one scan and one shuffle of the rows."""
    rng = random.Random(15)
    rows = [(rng.choice("abc"), at, at + rng.randint(0, 90_000)) for at in (rng.randint(-10, 3_000_000) for _ in range(120))]
    rows += [("d", 5, 9), ("d", 9, 12), ("d", 200_000, 200_001), ("e", 0, 4), ("f", 3, 100), ("g", None, None), ("x", 1, 2), (None, 1, 2)]
    rows += [("h", 5, 9), ("h", 70_000, None), ("h", 140_000, 140_002), ("i", 7, None), ("i", 80_000, 80_003), ("j", 3, 5), ("j", 90_000, None)]
    kind = "chrom string, start long, end long"
    spark.createDataFrame(rows + rows[:30], kind).write.parquet(str(tmp_path / "the-intervals"))
    sizes = [(c, 3_100_000) for c in "abcdeghijz"] + [("f", 50), ("e", 9)]
    found = intervals.complement(spark.read.parquet(str(tmp_path / "the-intervals")), spark.createDataFrame(sizes, "chrom string, size long"))
    con = duckdb.connect()
    con.execute("CREATE TABLE lineitem AS SELECT * FROM (VALUES " + ", ".join(f"({'NULL' if c is None else repr(c)}, {'NULL' if a is None else a}::BIGINT, {'NULL' if b is None else b}::BIGINT)" for c, a, b in rows if c) + ") t(chrom, a, b)")
    merged = queries._MERGED[queries._MERGED.index(", o AS") :]
    sql = queries.SQL["interval_complement"]
    tail = sql[sql.index(", e AS") :]
    values = ", ".join(f"('{c}', {n}::BIGINT)" for c, n in sizes)
    want = con.execute(f'WITH iv AS (SELECT chrom, a AS "start", b AS "end" FROM lineitem){merged}, sizes AS (SELECT * FROM (VALUES {values}) s(chrom, size)){tail}').fetchall()
    assert Counter(tuple(r) for r in found.collect()) == Counter(want)
    again = intervals.complement(spark.read.parquet(str(tmp_path / "the-intervals")), spark.createDataFrame(sizes, "chrom string, size long"))
    assert _plan(again).count("ReadSchema: struct<chrom:string,start:bigint,end:bigint>") == 1


@pytest.mark.parametrize("k", [3, 12, 25, 31])
def test_document_frequency_sums_where_records_are_read(spark, k):
    """a task hands on a row a k-mer, not one for every record that has it; letters that are
    no base only break the windows that hold them."""
    rng = random.Random(11)
    part = "".join(rng.choice("ACGT") for _ in range(60))
    rows = [(i, part[rng.randint(0, 20) :] + rng.choice(["", "N", "é", "acgt"]) + part[: rng.randint(0, 60)]) for i in range(60)]
    rows += [(100, "".join(rng.choice("AC") for _ in range(40_000)) + part), (101, None), (102, ""), (103, "AC")]
    for more in ([], [(5, part)]):
        every = rows + more
        want = Counter(w for i in {r[0] for r in every} for w in {s[j : j + k] for x, s in every if x == i and s for j in range(len(s) - k + 1)} if set(w) <= set("ACGT"))
        got = kmers.document_frequency(spark.createDataFrame(every, "doc long, seq string"), k, "doc")
        assert {r.kmer: r.n for r in got.collect()} == want
    import pyarrow as pa

    batch = pa.RecordBatch.from_arrays([pa.array([True] * 500), pa.nulls(500, pa.int64()), pa.array([part] * 500)], ["a", "r", "p"])
    assert sum(x.num_rows for x in kmers._distinct(k)(iter([batch]))) == len({part[j : j + k] for j in range(61 - k)})
