"""One query per operator over the given tables, and the SQL that gives the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from helixmill.functions import sequence as S
from helixmill.operators import align, archives, cluster, design, evaluate, intervals, kmers, mapping, pcr
from helixmill.operators.tables import ranked
from helixmill.plans import adapters as A
from helixmill.sources import readers

K = A.K
MOTIFS = ["ACRT", "GGNCC", "TTYAG", "CWSA"]

_SEQ = "translate(regexp_replace(lower(text), '[^a-z]', '', 'g'), 'abcdefghijklmnopqrstuvwxyz', 'ACGTACGTACGTACGTACGTACGTAC')"
_CODES = "translate(regexp_replace(lower(text), '[^a-z]', '', 'g'), 'abcdefghijklmnopqrstuvwxyz', 'ACGTACRACGTACYACGTACNACGTA')"
_RC = "reverse(translate({0}, 'ACGTRYSWKMBDHVN', 'TGCAYRSWMKVHDBN'))"
_DOCS = f"seqs AS (SELECT doc_id, lang, source, {_SEQ} AS seq FROM documents)"


def _windows(k: int, full: bool = True, keep: str = "doc_id, lang, source", source: str = "seqs") -> str:
    n = f"length(seq) - {k - 1 if full else k}"
    return f"SELECT {keep}, unnest(list_transform(range(1, greatest({n}, 0) + 1), lambda i: substr(seq, i, {k}))) AS kmer FROM {source}"


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return add


@query(f"WITH {_DOCS}, k AS (SELECT DISTINCT lang, kmer FROM ({_windows(K)})) SELECT kmer FROM k GROUP BY kmer HAVING count(*) = (SELECT count(DISTINCT lang) FROM documents)")
def kmer_conserved(spark: SparkSession, sf: str) -> DataFrame:
    return kmers.conserved(A.sequences(spark, sf), K, "lang")


_CANON = "SELECT {keep}, kmer, CAST(sum(n) AS BIGINT) - CASE WHEN kmer = " + _RC.format("kmer") + " THEN 1 ELSE 0 END AS n FROM (SELECT {keep}, kmer, 1 AS n FROM w UNION ALL SELECT {keep}, " + _RC.format("kmer") + ", 1 FROM w) GROUP BY {keep}, kmer"


@query(f"WITH {_DOCS}, w AS ({_windows(6, False)}), c AS ({_CANON.format(keep='lang, doc_id')}), b AS (SELECT lang, kmer, max(n) AS n FROM c GROUP BY ALL) SELECT kmer, min(n) AS n_min, max(n) AS n_max FROM b GROUP BY kmer HAVING count(*) = (SELECT count(DISTINCT lang) FROM documents)")
def kmer_conserved_assembly(spark: SparkSession, sf: str) -> DataFrame:
    return kmers.assembly_conserved(A.sequences(spark, sf), 6, "doc_id", "lang")


@query(f"WITH {_DOCS}, w AS ({_windows(K, False)}) SELECT kmer, n FROM ({_CANON.format(keep='1 AS x').replace('GROUP BY 1 AS x, kmer', 'GROUP BY kmer').replace('SELECT 1 AS x, kmer, CAST', 'SELECT kmer, CAST')})")
def kmer_counts_canonical(spark: SparkSession, sf: str) -> DataFrame:
    return kmers.canonical_counts(A.sequences(spark, sf), K)


_DOCFREQ = f"SELECT kmer, count(DISTINCT doc_id) AS n FROM ({_windows(K)}) GROUP BY kmer"


@query(f"WITH {_DOCS} {_DOCFREQ}")
def kmer_docfreq(spark: SparkSession, sf: str) -> DataFrame:
    return kmers.document_frequency(A.sequences(spark, sf), K, "doc_id")


@query(f"WITH {_DOCS}, w AS (SELECT DISTINCT kmer FROM ({_windows(K, False)})) SELECT kmer FROM w UNION SELECT {_RC.format('kmer')} FROM w")
def kmer_union(spark: SparkSession, sf: str) -> DataFrame:
    return kmers.union(A.sequences(spark, sf), K)


@query(f"WITH {_DOCS}, w AS ({_windows(12)}), d AS (SELECT kmer FROM w WHERE lang = 'en' EXCEPT SELECT kmer FROM w WHERE lang <> 'en') SELECT 'marker_' || (row_number() OVER (ORDER BY kmer) - 1) AS id, kmer FROM d")
def kmer_difference(spark: SparkSession, sf: str) -> DataFrame:
    return kmers.exclusive(A.sequences(spark, sf).filter("lang IS NOT NULL"), 12, F.col("lang") == "en")


@query(f"WITH {_DOCS}, w AS ({_windows(5, False)}), c AS ({_CANON.format(keep='lang, source')}), s AS (SELECT lang, source, row_number() OVER (PARTITION BY lang ORDER BY source) - 1 AS sample_idx FROM (SELECT DISTINCT lang, source FROM documents)) SELECT c.lang AS bin, kmer, sample_idx, n FROM c JOIN s USING (lang, source)")
def kmer_matrix_triplets(spark: SparkSession, sf: str) -> DataFrame:
    return kmers.sample_matrix(A.sequences(spark, sf), 5, "lang", "source")


@query(f"WITH {_DOCS}, w AS ({_windows(5, False)}) SELECT lang AS bin, kmer, count(DISTINCT source) AS n FROM (SELECT lang, source, kmer FROM w UNION ALL SELECT lang, source, {_RC.format('kmer')} FROM w) GROUP BY ALL")
def kmer_samples(spark: SparkSession, sf: str) -> DataFrame:
    return kmers.samples_per_kmer(kmers.sample_matrix(A.sequences(spark, sf), 5, "lang", "source"))


@query(f"WITH {_DOCS}, f AS ({_DOCFREQ}) SELECT kmer, n FROM f WHERE n > (SELECT quantile_cont(n, 0.9) FROM f)")
def kmer_quantile_filter(spark: SparkSession, sf: str) -> DataFrame:
    return kmers.above_quantile(kmers.document_frequency(A.sequences(spark, sf), K, "doc_id"), 0.9)


@query(f"WITH {_DOCS}, r AS (SELECT row_number() OVER (ORDER BY source) - 1 AS i, arg_min(length(seq), {{'id': doc_id, 'n': length(seq)}}) FILTER (doc_id IS NOT NULL AND seq IS NOT NULL) AS n FROM seqs GROUP BY source) SELECT doc_id, CAST(coalesce((SELECT min(i) FROM r WHERE length(seq) > n * (1 - 0.1) AND length(seq) < n * (1 + 0.1)), -1) AS INTEGER) AS bin FROM seqs")
def replicon_bin(spark: SparkSession, sf: str) -> DataFrame:
    rows = A.sequences(spark, sf)
    n = F.length("seq")
    # A source's first text by id; of equal ids the shortest; sources by name, null last.
    first = F.when(F.col("doc_id").isNotNull() & n.isNotNull(), F.struct("doc_id", n.alias("n")))
    firsts = rows.groupBy("source").agg(F.min_by(n, first).alias("ref_len"))
    refs = ranked(firsts, F.col("source").asc_nulls_last()).select((F.col("rank") - 1).alias("ref_idx"), "ref_len")
    return kmers.replicon_bins(rows, refs).select("doc_id", "bin")


@query(f"WITH {_DOCS} SELECT doc_id, {_RC.format('seq')} AS rc FROM seqs")
def revcomp(spark: SparkSession, sf: str) -> DataFrame:
    return A.sequences(spark, sf).select("doc_id", S.reverse_complement(F.col("seq")).alias("rc"))


@query(f"WITH {_DOCS} SELECT doc_id, CASE WHEN length(seq) > 0 THEN (length(seq) - length(translate(seq, 'GCgcSs', ''))) * 100.0::DOUBLE / length(seq) ELSE 0.0 END AS gc FROM seqs")
def gc_percent(spark: SparkSession, sf: str) -> DataFrame:
    return A.sequences(spark, sf).select("doc_id", S.gc_percent(F.col("seq")).alias("gc"))


@query(f"SELECT doc_id, CAST(length(regexp_replace({_CODES}, '[ACGT]', '', 'g')) AS INTEGER) AS n FROM documents")
def degenerate_count(spark: SparkSession, sf: str) -> DataFrame:
    return A.degenerate(spark, sf).select("doc_id", S.degenerate_count(F.col("seq")).alias("n"))


@query("SELECT o_orderkey, CASE WHEN o_orderkey % 3 = 0 THEN 'o' || o_orderkey ELSE 'c' || o_custkey END AS acc, CASE WHEN o_orderkey % 3 = 0 THEN 'o' || o_orderkey ELSE 'gb' END AS prefix, regexp_extract('gb|NC_' || o_orderkey || '.1|', '[A-Z]{1,2}_{0,1}[A-Z]*[0-9]+\\.[0-9]+') AS versioned FROM orders")
def accession_split(spark: SparkSession, sf: str) -> DataFrame:
    o = A.table(spark, sf, "orders")
    key, cust = F.col("o_orderkey").cast("string"), F.col("o_custkey").cast("string")
    name = F.when(F.col("o_orderkey") % 3 == 0, F.concat(F.lit("o"), key)).otherwise(F.concat(F.lit("gb|c"), cust, F.lit("|x")))
    versioned = S.accession_by_pattern(F.concat(F.lit("gb|NC_"), key, F.lit(".1|")))
    return o.select("o_orderkey", S.accession(name).alias("acc"), S.id_prefix(name).alias("prefix"), versioned.alias("versioned"))


_HITS = "SELECT 'p' || l_partkey AS qseqid, l_suppkey AS sseqid, CAST(l_linenumber AS VARCHAR) AS primer_group, 20 - CAST(floor(l_tax * 100) AS INTEGER) AS nident, CASE WHEN l_returnflag = 'R' THEN l_partkey + l_linenumber * 37 + CAST(l_quantity AS BIGINT) ELSE l_partkey + l_linenumber * 37 END AS sstart, CASE WHEN l_returnflag = 'R' THEN l_partkey + l_linenumber * 37 ELSE l_partkey + l_linenumber * 37 + CAST(l_quantity AS BIGINT) END AS send FROM lineitem"


@query(f"WITH h AS ({_HITS}) SELECT sseqid, CASE WHEN sstart > send THEN 'minus' ELSE 'plus' END AS strand, count(*) AS n, min(least(sstart, send)) AS first, max(greatest(sstart, send)) AS last FROM h GROUP BY ALL")
def strand_label(spark: SparkSession, sf: str) -> DataFrame:
    h = A.oligo_hits(spark, sf).withColumn("strand", S.strand(F.col("sstart"), F.col("send")))
    return h.groupBy("sseqid", "strand").agg(F.count("*").alias("n"), F.min(F.least("sstart", "send")).alias("first"), F.max(F.greatest("sstart", "send")).alias("last"))


@query(f"WITH h AS ({_HITS}) SELECT qseqid, sseqid, 20 - nident AS n_mismatches, CASE WHEN sstart > send THEN 'minus' ELSE 'plus' END AS strand, sstart FROM h WHERE 20 - nident <= 3")
def hit_budget(spark: SparkSession, sf: str) -> DataFrame:
    parts = A.table(spark, sf, "part").select(F.concat(F.lit("p"), F.col("p_partkey").cast("string")).alias("id"), F.lit("A" * 20).alias("seq"))
    return pcr.with_mismatches(A.oligo_hits(spark, sf), parts, 3.0).select("qseqid", "sseqid", "n_mismatches", "strand", "sstart")


@query(f"WITH {_DOCS}, p AS (SELECT substr(seq, 1, 12) AS kmer, max(item_id) AS id FROM (SELECT item_id, {_SEQ} AS seq FROM benchmark) WHERE length(seq) >= 12 GROUP BY 1), w AS (SELECT doc_id, unnest(range(0, greatest(length(seq) - 11, 0))) AS start, unnest(list_transform(range(1, greatest(length(seq) - 11, 0) + 1), lambda i: substr(seq, i, 12))) AS win FROM seqs) SELECT id, kmer, doc_id AS chrom, start, '+' AS strand FROM w JOIN p ON win = kmer UNION ALL SELECT id, kmer, doc_id, start, '-' FROM w JOIN p ON win = {_RC.format('kmer')}")
def kmer_map_both_strands(spark: SparkSession, sf: str) -> DataFrame:
    refs = A.sequences(spark, sf).withColumnRenamed("doc_id", "chrom")
    return mapping.map_kmers(A.panel(spark, sf, 12), refs, 12)


_IV = "iv AS (SELECT l_suppkey AS chrom, l_partkey * 7 + l_linenumber * 3 AS \"start\", l_partkey * 7 + l_linenumber * 3 + CAST(l_quantity AS BIGINT) AS \"end\" FROM lineitem)"
_MERGED = _IV + ", o AS (SELECT *, CASE WHEN \"start\" > max(\"end\") OVER (PARTITION BY chrom ORDER BY \"start\", \"end\" ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) THEN 1 ELSE 0 END AS f FROM iv), g AS (SELECT *, sum(f) OVER (PARTITION BY chrom ORDER BY \"start\", \"end\" ROWS UNBOUNDED PRECEDING) AS i FROM o), merged AS (SELECT chrom, min(\"start\") AS \"start\", max(\"end\") AS \"end\" FROM g GROUP BY chrom, i)"


@query(f'WITH {_MERGED} SELECT chrom, "start", "end" FROM merged')
def interval_merge(spark: SparkSession, sf: str) -> DataFrame:
    return intervals.merge(A.intervals(spark, sf))


@query(f'WITH {_MERGED}, sizes AS (SELECT s_suppkey AS chrom, (SELECT max(p_partkey) * 7 + 1000 FROM part) AS size FROM supplier), e AS (SELECT chrom, "end" AS a, lead("start") OVER (PARTITION BY chrom ORDER BY "start") AS b FROM merged UNION ALL SELECT chrom, 0, min("start") FROM merged GROUP BY chrom) SELECT e.chrom, a AS "start", coalesce(b, size) AS "end" FROM e JOIN sizes USING (chrom) WHERE a < coalesce(b, size) UNION ALL SELECT chrom, 0, size FROM sizes WHERE chrom NOT IN (SELECT chrom FROM merged)')
def interval_complement(spark: SparkSession, sf: str) -> DataFrame:
    return intervals.complement(A.intervals(spark, sf), A.chrom_sizes(spark, sf))


@query()
def interval_collapse(spark: SparkSession, sf: str) -> DataFrame:
    rows = A.intervals(spark, sf)
    name = F.substring(F.translate(F.conv((F.col("start") * 2654435761 % 4294967296).cast("string"), 10, 4), "0123", "ACGT"), 1, 16)
    filled = F.rpad(name, 50, "ACGT")
    return intervals.collapse(rows.filter(F.col("end") > F.col("start")).withColumn("name", F.substring(filled, F.lit(1), (F.col("end") - F.col("start")).cast("int"))))


@query(f"WITH {_DOCS}, iv AS (SELECT l_orderkey AS k, l_partkey AS chrom, CAST(l_linenumber * 3 AS BIGINT) AS \"start\", CAST(l_linenumber * 3 + l_quantity AS BIGINT) AS \"end\" FROM lineitem) SELECT k, chrom, \"start\", \"end\", substr(seq, CAST(\"start\" + 1 AS INTEGER), CAST(\"end\" - \"start\" AS INTEGER)) AS slice FROM iv JOIN seqs ON chrom = doc_id")
def interval_slice(spark: SparkSession, sf: str) -> DataFrame:
    start = (F.col("l_linenumber") * 3).cast("long")
    rows = A.table(spark, sf, "lineitem").select(F.col("l_orderkey").alias("k"), F.col("l_partkey").alias("chrom"), start.alias("start"), (start + F.col("l_quantity").cast("long")).alias("end"))
    return intervals.sliced(rows, A.sequences(spark, sf).withColumnRenamed("doc_id", "chrom"))


@query(f"WITH {_DOCS} " + " UNION ALL ".join(f"SELECT '{m}' AS motif, doc_id, len(list_filter(range(1, greatest(length(seq) - {len(m) - 1}, 0) + 1), lambda i: regexp_full_match(substr(seq, i, {len(m)}), '{S.iupac_pattern(m)}'))) AS n FROM seqs" for m in MOTIFS))
def motif_count(spark: SparkSession, sf: str) -> DataFrame:
    rows = A.sequences(spark, sf)
    counts = F.array(*[F.struct(F.lit(m).alias("motif"), S.motif_count(F.col("seq"), m).cast("long").alias("n")) for m in MOTIFS])
    return rows.select("doc_id", F.explode(counts).alias("c")).select("c.motif", "doc_id", "c.n")


@query(f"WITH {_DOCS} " + " UNION ALL ".join(f"SELECT '{m}' AS motif, doc_id, unnest(list_filter(range(0, greatest(length(seq) - {len(m) - 1}, 0)), lambda i: regexp_full_match(substr(seq, i + 1, {len(m)}), '{S.iupac_pattern(m)}'))) AS start FROM seqs" for m in MOTIFS))
def motif_positions(spark: SparkSession, sf: str) -> DataFrame:
    return mapping.motif_hits(MOTIFS, A.sequences(spark, sf), "doc_id")


@query(f"WITH {_DOCS}, t AS (SELECT count(DISTINCT doc_id) AS t FROM documents), " + "m AS (" + " UNION ALL ".join(f"SELECT '{m}' AS motif, count(DISTINCT doc_id) AS n_records FROM seqs WHERE regexp_matches(seq, '{S.iupac_pattern(m)}')" for m in MOTIFS) + ") SELECT motif, n_records, CAST(round_even(n_records / t * 1000, 0) AS INTEGER) AS score FROM m, t WHERE n_records > 0")
def motif_score(spark: SparkSession, sf: str) -> DataFrame:
    return mapping.motif_scores(MOTIFS, A.sequences(spark, sf), "doc_id")


_CODE_SQL = "substr('?ACMGRSVTWYHKDBN', CAST(m AS INTEGER) + 1, 1)"


@query(f"WITH {_DOCS}, w AS (SELECT DISTINCT kmer FROM ({_windows(K)})), b AS (SELECT substr(kmer, 1, 5) AS prefix, unnest(range(0, {K})) AS pos, unnest(string_split(kmer, '')) AS base FROM w), c AS (SELECT prefix, pos, bit_or(CASE base WHEN 'A' THEN 1 WHEN 'C' THEN 2 WHEN 'G' THEN 4 ELSE 8 END) AS m FROM b GROUP BY ALL) SELECT prefix, string_agg({_CODE_SQL}, '' ORDER BY pos) AS motif FROM c GROUP BY prefix")
def iupac_consensus(spark: SparkSession, sf: str) -> DataFrame:
    words = kmers.exploded(A.sequences(spark, sf), K).distinct()
    return cluster.consensus(words.withColumn("prefix", F.substring("kmer", 1, 5)), "prefix")


_PAIR = "WITH {docs}, w AS (SELECT doc_id, lang, unnest(range(1, greatest(length(seq) - 7, 0) + 1)) AS p, unnest(list_transform(range(1, greatest(length(seq) - 7, 0) + 1), lambda i: substr(seq, i, 8))) AS k FROM seqs), f AS (SELECT * FROM w WHERE k = 'AAATTAAA'), r AS (SELECT * FROM w WHERE k = 'ACAACACA') "


@query(_PAIR.format(docs=_DOCS) + "SELECT f.doc_id AS sseqid, f.lang AS primer_group, f.p AS \"Start\", r.p AS \"End\", r.p - f.p + 1 AS amplicon_len FROM f JOIN r ON f.doc_id = r.doc_id AND f.lang = r.lang AND r.p - f.p BETWEEN 40 AND 400")
def amplicon_paired(spark: SparkSession, sf: str) -> DataFrame:
    hits = A.seed_pairs(spark, sf, "AAATTAAA", "ACAACACA", True)
    return pcr.amplicons(hits, 40, 400, "primer_group").select("sseqid", "primer_group", "Start", "End", "amplicon_len")


@query(f"WITH h AS (SELECT *, CASE WHEN sstart > send THEN 'minus' ELSE 'plus' END AS strand FROM ({_HITS}) WHERE 20 - nident <= 3) SELECT f.qseqid AS FP_ID, r.qseqid AS RP_ID, f.sseqid, f.sstart AS \"Start\", r.sstart AS \"End\", r.sstart - f.sstart + 1 AS amplicon_len FROM h f JOIN h r ON f.sseqid = r.sseqid AND f.strand = 'plus' AND r.strand = 'minus' AND r.sstart - f.sstart BETWEEN 40 AND 100")
def amplicon_mux(spark: SparkSession, sf: str) -> DataFrame:
    parts = A.table(spark, sf, "part").select(F.concat(F.lit("p"), F.col("p_partkey").cast("string")).alias("id"), F.lit("A" * 20).alias("seq"))
    hits = pcr.with_mismatches(A.oligo_hits(spark, sf), parts, 3.0)
    return pcr.amplicons(hits, 40, 100).select("FP_ID", "RP_ID", "sseqid", "Start", "End", "amplicon_len")


@query(f"WITH {_DOCS}, a AS (SELECT doc_id, seq FROM seqs WHERE length(seq) >= 1) SELECT doc_id, unnest(CASE WHEN length(seq) > 250 THEN [substr(seq, 1, 150), substr({_RC.format('seq')}, 1, 150)] ELSE [seq] END) AS read FROM a")
def amplicon_trim(spark: SparkSession, sf: str) -> DataFrame:
    rows = A.sequences(spark, sf).filter(F.length("seq") >= 1).select("doc_id", F.col("seq").alias("AmpliconSeq"))
    return pcr.read_ends(rows, 150, 250).select("doc_id", F.col("AmpliconSeq").alias("read"))


@query(f"WITH {_DOCS}, w AS (SELECT doc_id, lang, unnest(list_transform(range(1, length(seq) - 1), lambda i: substr(seq, i, 3))) AS k FROM seqs WHERE length(seq) >= 3), c AS (SELECT doc_id, lang, k, count(*) AS n FROM w GROUP BY ALL), p AS (SELECT doc_id, lang AS primer_set, CAST(doc_id % 4 AS VARCHAR) AS label, string_agg(k || ':' || n, ',' ORDER BY k) AS sig FROM c GROUP BY doc_id, lang) SELECT a.primer_set, a.label, a.doc_id AS accession, string_agg(DISTINCT b.doc_id::VARCHAR, ',' ORDER BY b.doc_id::VARCHAR) AS failures FROM p a JOIN p b ON a.primer_set = b.primer_set AND a.sig = b.sig AND a.label <> b.label GROUP BY 1, 2, 3")
def amplicon_composition_offtarget(spark: SparkSession, sf: str) -> DataFrame:
    out = evaluate.off_target_by_composition(_amplicon_rows(spark, sf).withColumn("accession", F.col("accession").cast("string")))
    return out.select("primer_set", "label", F.col("accession").cast("long").alias("accession"), F.array_join("failure_acc", ",").alias("failures"))


_PROFILES = f"WITH {_DOCS}, w AS (SELECT doc_id, lang, unnest(list_transform(range(1, length(seq) - 1), lambda i: substr(seq, i, 3))) AS k FROM seqs WHERE length(seq) >= 3), c AS (SELECT doc_id, lang, k, count(*) AS n FROM w GROUP BY ALL), p AS (SELECT doc_id AS accession, lang AS primer_set, CAST(doc_id % 4 AS VARCHAR) AS label, string_agg(k || ':' || n, ',' ORDER BY k) AS sig FROM c GROUP BY doc_id, lang), g AS (SELECT primer_set, sig, label, count(*) AS own FROM p GROUP BY ALL), t AS (SELECT primer_set, sig, sum(own) AS n FROM g GROUP BY ALL HAVING count(*) > 1)"


def _amplicon_rows(spark: SparkSession, sf: str) -> DataFrame:
    rows = A.sequences(spark, sf).filter(F.length("seq") >= 3)
    return rows.select(F.col("lang").alias("primer_set"), (F.col("doc_id") % 4).cast("string").alias("label"), F.col("doc_id").alias("accession"), F.col("seq").alias("AmpliconSeq"))


@query(f"{_PROFILES} SELECT p.primer_set, p.label, p.accession, CAST(t.n - g.own AS BIGINT) AS others FROM p JOIN g USING (primer_set, sig, label) JOIN t USING (primer_set, sig)")
def offtarget_members(spark: SparkSession, sf: str) -> DataFrame:
    return evaluate.off_target_members(_amplicon_rows(spark, sf)).drop("profile")


@query(f"{_PROFILES} SELECT g.primer_set, g.label, p.accession AS failure_acc FROM g JOIN t USING (primer_set, sig) JOIN p ON p.primer_set = g.primer_set AND p.sig = g.sig AND p.label <> g.label")
def offtarget_failures(spark: SparkSession, sf: str) -> DataFrame:
    return evaluate.off_target_failures(evaluate.off_target_members(_amplicon_rows(spark, sf))).drop("profile")


_TAXA = "taxa AS (SELECT p_partkey AS taxid, p_partkey - p_size AS parent, CASE p_size % 5 WHEN 0 THEN 'species' WHEN 1 THEN 'genus' WHEN 2 THEN 'subspecies' ELSE 'clade' END AS rank FROM part)"


@query(f"WITH RECURSIVE {_TAXA}, up AS (SELECT taxid, taxid AS at, 0 AS d FROM taxa UNION ALL SELECT up.taxid, t.parent, d + 1 FROM up JOIN taxa t ON t.taxid = up.at WHERE t.parent IN (SELECT taxid FROM taxa)), met AS (SELECT up.taxid, t.rank, arg_min(up.at, d) AS ancestor FROM up JOIN taxa t ON t.taxid = up.at WHERE t.rank IN ('species', 'genus', 'subspecies') GROUP BY ALL) SELECT taxid, rank, ancestor FROM met")
def taxon_lineage(spark: SparkSession, sf: str) -> DataFrame:
    return evaluate.lineage(A.taxa(spark, sf), ["species", "genus", "subspecies"])


@query(f"WITH RECURSIVE {_TAXA}, up AS (SELECT taxid, taxid AS at, 0 AS d FROM taxa UNION ALL SELECT up.taxid, t.parent, d + 1 FROM up JOIN taxa t ON t.taxid = up.at WHERE t.parent IN (SELECT taxid FROM taxa)), met AS (SELECT up.taxid, t.rank, arg_min(up.at, d) AS ancestor FROM up JOIN taxa t ON t.taxid = up.at GROUP BY ALL), l AS (SELECT coalesce(b.ancestor, s.ancestor, 0) AS label FROM lineitem LEFT JOIN met s ON s.taxid = l_partkey AND s.rank = 'species' LEFT JOIN met b ON b.taxid = l_partkey AND b.rank = 'subspecies') SELECT CAST(label AS VARCHAR) AS label, count(*) AS n FROM l WHERE label NOT IN (0, 32630) GROUP BY label")
def taxon_hits(spark: SparkSession, sf: str) -> DataFrame:
    rows = A.table(spark, sf, "lineitem").select(F.col("l_partkey").cast("string").alias("accession"))
    accessions = A.table(spark, sf, "part").select(F.col("p_partkey").cast("string").alias("accession"), F.col("p_partkey").alias("taxid"))
    hits = evaluate.with_taxon(rows, accessions, evaluate.lineage(A.taxa(spark, sf), ["species", "subspecies"]), subspecies=True)
    return evaluate.on_target_labels(hits).groupBy("label").agg(F.count("*").alias("n"))


_EVAL = f"seqs AS (SELECT doc_id, lang, source, {_SEQ} AS seq FROM documents), p AS (SELECT item_id AS id, substr({_SEQ}, 1, 8) AS kmer FROM benchmark WHERE length({_SEQ}) >= 8), hits AS (SELECT DISTINCT lang AS label, doc_id AS accession, 'g' || (id % 4) AS primer_group, 'set' || id AS primer_set FROM ({_windows(8)}) JOIN p USING (kmer))"


@query(f"WITH {_EVAL}, orgs AS (SELECT DISTINCT lang AS org FROM documents) SELECT org AS label, ps AS primer_set FROM orgs, (SELECT DISTINCT primer_set FROM hits) AS s(ps) WHERE ps NOT IN (SELECT primer_set FROM hits WHERE label <> org)")
def primer_set_exclusive(spark: SparkSession, sf: str) -> DataFrame:
    hits = A.evaluation_hits(spark, sf)
    orgs = A.table(spark, sf, "documents").select(F.col("lang").alias("label")).distinct()
    return evaluate.exclusive_sets(hits, orgs)[0]


@query(f"WITH {_EVAL}, orgs AS (SELECT DISTINCT lang AS org FROM documents) SELECT org AS label, primer_set, string_agg(accession::VARCHAR, ',' ORDER BY accession) AS failure_acc FROM orgs JOIN (SELECT DISTINCT primer_set, label AS l, accession FROM hits) ON l <> org GROUP BY ALL")
def primer_set_failures(spark: SparkSession, sf: str) -> DataFrame:
    hits = A.evaluation_hits(spark, sf)
    orgs = A.table(spark, sf, "documents").select(F.col("lang").alias("label")).distinct()
    lists = evaluate.failure_lists(evaluate.exclusive_sets(hits, orgs)[1])
    return lists.select("label", "primer_set", F.array_join(F.col("failure_acc").cast("array<string>"), ",").alias("failure_acc"))


@query(f"WITH {_EVAL}, orgs AS (SELECT DISTINCT lang AS org FROM documents), good AS (SELECT org, ps FROM orgs, (SELECT DISTINCT primer_set FROM hits) AS s(ps) WHERE ps NOT IN (SELECT primer_set FROM hits WHERE label <> org)) SELECT org AS label, coalesce((SELECT string_agg(ps, ',' ORDER BY ps) FROM good WHERE good.org = orgs.org), '') AS primers FROM orgs")
def exclusive_lists(spark: SparkSession, sf: str) -> DataFrame:
    orgs = A.table(spark, sf, "documents").select(F.col("lang").alias("label")).distinct()
    good, _ = evaluate.exclusive_sets(A.evaluation_hits(spark, sf), orgs)
    return evaluate.exclusive_json(good, orgs).select("label", F.array_join("primers", ",").alias("primers"))


@query(f"WITH {_EVAL}, t AS (SELECT lang AS label, count(DISTINCT doc_id) AS t FROM documents GROUP BY 1), c AS (SELECT label, count(DISTINCT accession) AS h FROM hits GROUP BY 1) SELECT t.label, coalesce(h, 0) AS hits, CAST(h AS DOUBLE) / t AS coverage FROM t LEFT JOIN c USING (label)")
def coverage_by_label(spark: SparkSession, sf: str) -> DataFrame:
    return evaluate.coverage(A.evaluation_hits(spark, sf), A.totals(spark, sf))


@query(f"WITH {_EVAL}, t AS (SELECT lang AS label, count(DISTINCT doc_id) AS t FROM documents GROUP BY 1), c AS (SELECT label, primer_group, count(DISTINCT accession) AS h FROM hits GROUP BY 1, 2) SELECT t.label, primer_group, coalesce(h, 0) AS hits, CAST(h AS DOUBLE) / t AS coverage FROM t LEFT JOIN c USING (label)")
def coverage_by_pair(spark: SparkSession, sf: str) -> DataFrame:
    return evaluate.coverage(A.evaluation_hits(spark, sf), A.totals(spark, sf), ("primer_group",))


@query(f"WITH {_EVAL} SELECT label, " + ", ".join(f"count(*) FILTER (primer_group = 'g{i}') AS g{i}" for i in range(4)) + " FROM hits GROUP BY label")
def hits_pivot(spark: SparkSession, sf: str) -> DataFrame:
    return evaluate.hit_pivot(A.evaluation_hits(spark, sf), [f"g{i}" for i in range(4)])


@query(f"WITH {_EVAL} SELECT DISTINCT lang AS label, doc_id AS accession FROM documents WHERE doc_id NOT IN (SELECT accession FROM hits)")
def missing_accessions(spark: SparkSession, sf: str) -> DataFrame:
    return evaluate.missing(A.evaluation_hits(spark, sf), A.totals(spark, sf))


@query("SELECT o_orderkey AS accession, coalesce(lang, 'Off Target') AS label FROM orders LEFT JOIN documents ON o_orderkey = doc_id")
def label_default(spark: SparkSession, sf: str) -> DataFrame:
    rows = A.table(spark, sf, "orders").select(F.col("o_orderkey").alias("accession"))
    return evaluate.labelled(rows, A.totals(spark, sf), "Off Target").select("accession", "label")


@query("SELECT c_custkey AS accession, CASE WHEN n_regionkey = 0 THEN CASE WHEN n_nationkey % 2 = 0 THEN CAST(n_nationkey + 100 AS VARCHAR) ELSE '1000' END ELSE CAST(n_regionkey + 1000 AS VARCHAR) END AS label FROM customer JOIN nation ON c_nationkey = n_nationkey")
def taxonomy_label(spark: SparkSession, sf: str) -> DataFrame:
    nation = A.table(spark, sf, "nation")
    accessions = A.table(spark, sf, "customer").select(F.col("c_custkey").alias("accession"), F.col("c_nationkey").cast("long").alias("taxid"))
    species = nation.select(F.col("n_nationkey").cast("long").alias("taxid"), F.lit("species").alias("rank"), (F.col("n_regionkey") + 1000).cast("long").alias("ancestor"))
    below = F.when((F.col("n_regionkey") == 0) & (F.col("n_nationkey") % 2 == 0), F.col("n_nationkey") + 100).otherwise(0).cast("long")
    subspecies = nation.select(F.col("n_nationkey").cast("long").alias("taxid"), F.lit("subspecies").alias("rank"), below.alias("ancestor"))
    rows = accessions.select("accession")
    return evaluate.with_taxon(rows, accessions, species.unionByName(subspecies), True)


@query(f"WITH {_DOCS}, w AS (SELECT DISTINCT kmer FROM ({_windows(6, True)})), p AS (SELECT a.kmer AS a, b.kmer AS b, hamming(a.kmer, b.kmer) AS d FROM w a JOIN w b ON a.kmer < b.kmer) SELECT a, b, CAST(d AS INTEGER) AS d FROM p WHERE d <= 1")
def hamming_pairs(spark: SparkSession, sf: str) -> DataFrame:
    return cluster.hamming_pairs(kmers.exploded(A.sequences(spark, sf), 6).distinct(), 6, 1)


@query(f"WITH s AS (SELECT lang || '/' || source AS r, string_agg({_SEQ}, '' ORDER BY doc_id) AS seq FROM documents GROUP BY 1), w AS (SELECT DISTINCT r, least(kmer, {_RC.format('kmer')}) AS c FROM ({_windows(7, True, 'r', 's')})), n AS (SELECT r, count(*) AS n FROM w GROUP BY r), i AS (SELECT a.r AS a, b.r AS b, count(*) AS c FROM w a JOIN w b ON a.c = b.c AND a.r <= b.r GROUP BY 1, 2) SELECT a, b, CAST(c AS DOUBLE) / (x.n + y.n - c) AS sim FROM i JOIN n x ON x.r = a JOIN n y ON y.r = b")
def minhash_jaccard(spark: SparkSession, sf: str) -> DataFrame:
    rows = A.sequences(spark, sf)
    groups = cluster.joined_records(rows.withColumn("r", F.concat_ws("/", "lang", "source")), 7, "r", "doc_id")
    return cluster.similarity(cluster.sketch(groups, 7, "r"), "r")


@query("SELECT l_suppkey, l_orderkey, l_partkey FROM lineitem WHERE l_returnflag = 'A' AND l_orderkey NOT IN (SELECT l_orderkey FROM lineitem WHERE l_returnflag = 'R')")
def archive_subtract(spark: SparkSession, sf: str) -> DataFrame:
    rows = A.table(spark, sf, "lineitem").withColumn("member", F.col("l_orderkey"))
    out = archives.subtract(rows.filter("l_returnflag = 'A'"), rows.filter("l_returnflag = 'R'"))
    return out.select("l_suppkey", "l_orderkey", "l_partkey")


@query("SELECT o_orderkey AS member, o_orderstatus AS archive FROM orders WHERE o_orderstatus = 'F' UNION ALL SELECT o_orderkey, o_orderstatus FROM orders WHERE o_orderstatus = 'O'")
def archive_add(spark: SparkSession, sf: str) -> DataFrame:
    rows = A.table(spark, sf, "orders").select(F.col("o_orderkey").alias("member"), F.col("o_orderstatus").alias("archive"))
    return archives.add(rows.filter("archive = 'F'"), rows.filter("archive = 'O'"))


@query()
def hamming_clusters(spark: SparkSession, sf: str) -> DataFrame:
    return cluster.hamming_clusters(kmers.exploded(A.sequences(spark, sf), 9).distinct(), 9, 1)


@query()
def degenerate_motifs(spark: SparkSession, sf: str) -> DataFrame:
    counts = kmers.document_frequency(A.sequences(spark, sf), K, "doc_id", singletons=False)
    parts = cluster.sub_clusters(cluster.greedy_motifs(counts, K), 1.0)
    return cluster.consensus(parts, "sub")


@query()
def ward_clusters(spark: SparkSession, sf: str) -> DataFrame:
    groups = minhash_jaccard(spark, sf)
    return cluster.ward_clusters(groups, 4)


@query()
def probe_align(spark: SparkSession, sf: str) -> DataFrame:
    rows = A.sequences(spark, sf).select("doc_id", F.concat(F.lit("a|"), F.col("doc_id").cast("string")).alias("FP_ID"), F.col("seq").alias("AmpliconSeq"))
    probes = A.panel(spark, sf, 18).select(F.concat(F.lit("p"), F.col("id").cast("string")).alias("id"), F.col("kmer").alias("seq"))
    return align.align_probes(pcr.usable(rows), probes, 6, mux=True).drop("AmpliconSeq")


_OLIGOS = "o AS (SELECT DISTINCT l_suppkey AS chrom, l_partkey * 7 + l_linenumber * 3 AS a, l_partkey * 7 + l_linenumber * 4 + 18 AS b, CASE l_returnflag WHEN 'R' THEN '+' WHEN 'A' THEN '-' ELSE 'io' END AS strand, 'o' || l_partkey AS oligo, CAST(60 + round(l_discount * 100) AS DOUBLE) AS tm FROM lineitem)"
_PAIRED = "p AS (SELECT f.chrom, f.oligo AS fp, r.oligo AS rp, f.a AS \"start\", r.b AS \"end\", f.b AS fp_end, r.a AS rp_start, r.b - f.a AS amplicon_len, abs(f.tm - r.tm) AS tm_diff FROM o f JOIN o r ON f.chrom = r.chrom AND f.strand = '+' AND r.strand = '-' AND r.b - f.a BETWEEN 150 AND 250)"


@query(f"WITH {_OLIGOS}, {_PAIRED} SELECT chrom, fp, rp, \"start\", \"end\", fp_end, rp_start, amplicon_len, tm_diff FROM p")
def primer_pairs(spark: SparkSession, sf: str) -> DataFrame:
    return design.primer_pairs(A.placed_oligos(spark, sf))


@query(f"WITH {_OLIGOS}, {_PAIRED}, m AS (SELECT p.*, i.oligo AS io, i.a AS io_start, i.b AS io_end, i.strand AS io_strand, row_number() OVER (PARTITION BY p.* ORDER BY abs(i.tm - 60), i.a, i.b, i.strand, i.oligo) AS k, count(*) OVER (PARTITION BY p.*) AS n_io FROM p JOIN o i ON i.chrom = p.chrom AND i.strand = 'io' AND i.a >= p.fp_end AND i.b <= p.rp_start) SELECT chrom, fp, rp, \"start\", \"end\", fp_end, rp_start, amplicon_len, tm_diff, io, io_start, io_end, io_strand, n_io FROM m WHERE k = 1".replace("PARTITION BY p.*", "PARTITION BY p.chrom, p.fp, p.rp, p.start, p.end, p.fp_end, p.rp_start, p.amplicon_len, p.tm_diff"))
def primer_pairs_interior(spark: SparkSession, sf: str) -> DataFrame:
    oligos = A.placed_oligos(spark, sf)
    return design.with_interior(design.primer_pairs(oligos), oligos.filter("strand = 'io'"))


@query()
def oligo_folds(spark: SparkSession, sf: str) -> DataFrame:
    """Every 18-letter window of every benchmark item with its fold scores."""
    items = A.sequences(spark, sf, "benchmark", "item_id", ())
    oligos = items.select("item_id", F.posexplode(S.windows(F.col("seq"), 18)).alias("start", "oligo"))
    return oligos.select("item_id", "start", "oligo", design.hairpin("oligo").alias("hairpin"), design.dimer("oligo", "oligo").alias("dimer"))


@query()
def primer_design(spark: SparkSession, sf: str) -> DataFrame:
    """Pairs with interior oligos round all places of two motifs in all documents."""
    rows = A.sequences(spark, sf)
    hits = mapping.motif_hits(["GGNCCA", "TTYAGC"], rows, "doc_id").select(F.col("doc_id").alias("chrom"), F.greatest(F.col("start") - 10, F.lit(0)).alias("start"), (F.col("start") + 16).alias("end"))
    seqs = rows.select(F.col("doc_id").alias("chrom"), "seq")
    return design.designed(intervals.merge(hits), seqs, lengths=(18, 18), tm=(50.0, 64.0), io_lengths=(18, 18), io_tm=(50.0, 63.0), fold=20)


@query()
def primer_realign(spark: SparkSession, sf: str) -> DataFrame:
    rows = A.sequences(spark, sf).filter(F.length("seq") >= 40)
    primers = rows.select(
        "doc_id", F.substring("seq", 3, 18).alias("FP_seq"), F.left(S.reverse_complement(F.col("seq")), F.lit(18)).alias("RP_seq"), F.col("seq").alias("AmpliconSeq"),
    )
    return align.realign_primers(primers, 3, 0).drop("AmpliconSeq")


_TM_SUM = "list_sum(list_transform(range(1, 18), lambda i: CASE substr(s, i, 2) {cases} ELSE 0.0::DOUBLE END)) + CASE WHEN substr(s, 1, 1) IN ('A', 'T') THEN {at} ELSE {gc} END + CASE WHEN substr(s, 18, 1) IN ('A', 'T') THEN {at} ELSE {gc} END"


def _tm_sql(i: int) -> str:
    cases = []
    for pair, v in S.PAIRS.items():
        for p in sorted({pair, "".join(S.COMPLEMENT[b] for b in reversed(pair))}):
            cases.append(f"WHEN '{p}' THEN {v[i]}::DOUBLE")
    return _TM_SUM.format(cases=" ".join(cases), at=f"{S.END_AT[i]}::DOUBLE", gc=f"{S.END_GC[i]}::DOUBLE")


@query(f"WITH {_DOCS}, o AS (SELECT doc_id, substr(seq, 1, 18) AS s FROM seqs WHERE length(seq) >= 18) SELECT doc_id, s AS oligo, round(({_tm_sql(0)}) * 1000 / (({_tm_sql(1)}) + 1.987 * ln(12.5e-9)) - 273.15 + 11.7 * log10((50 + 120 * sqrt(0.9)) * 1e-3), 4) AS tm FROM o")
def tm_nn(spark: SparkSession, sf: str) -> DataFrame:
    rows = A.sequences(spark, sf).filter(F.length("seq") >= 18).select("doc_id", F.substring("seq", 1, 18).alias("oligo"))
    return rows.withColumn("tm", F.round(S.melting_temperature(F.col("oligo")), 4))


_AMINO = "CASE substr(seq, i * 3 + 1, 3) " + " ".join(f"WHEN '{c}' THEN '{a}'" for c, a in S.CODONS.items()) + " ELSE 'X' END"


@query(f"WITH {_DOCS} SELECT doc_id, array_to_string(list_transform(range(0, CAST(length(seq) // 3 AS BIGINT)), lambda i: {_AMINO}), '') AS protein FROM seqs")
def translate_cds(spark: SparkSession, sf: str) -> DataFrame:
    return A.sequences(spark, sf).select("doc_id", S.translate_cds(F.col("seq")).alias("protein"))


_PROTEIN = f"WITH {_DOCS}, t AS (SELECT lang, array_to_string(list_transform(range(0, CAST(length(seq) // 3 AS BIGINT)), lambda i: {_AMINO}), '') AS seq FROM seqs), w AS (SELECT DISTINCT lang, kmer FROM ({_windows(3, True, 'lang', 't')})) "


@query(_PROTEIN + "SELECT kmer FROM w GROUP BY kmer HAVING count(*) = (SELECT count(DISTINCT lang) FROM documents)")
def amino_inner(spark: SparkSession, sf: str) -> DataFrame:
    return kmers.protein_intersection(A.sequences(spark, sf), 3, "lang")


@query(_PROTEIN + "SELECT DISTINCT kmer FROM w")
def amino_outer(spark: SparkSession, sf: str) -> DataFrame:
    return kmers.protein_union(A.sequences(spark, sf), 3, "lang")


@query(f"WITH {_DOCS} SELECT source, count(DISTINCT doc_id) AS n FROM ({_windows(K)}) WHERE kmer IN (SELECT substr({_SEQ}, 1, 8) FROM benchmark WHERE length({_SEQ}) >= 8) GROUP BY source")
def records_with_panel(spark: SparkSession, sf: str) -> DataFrame:
    rows = kmers.exploded(A.sequences(spark, sf), K, keep=("source", "doc_id"))
    return rows.join(F.broadcast(A.panel(spark, sf).select("kmer").distinct()), "kmer", "left_semi").distinct().groupBy("source").agg(F.countDistinct("doc_id").alias("n"))


@query()
def oligo_seed_search(spark: SparkSession, sf: str) -> DataFrame:
    oligos = A.panel(spark, sf, 18).select(F.col("id").cast("string").alias("id"), F.col("kmer").alias("seq"))
    refs = A.sequences(spark, sf).select(F.col("doc_id").alias("sseqid"), "seq")
    return pcr.seed_search(oligos, refs, 1)


@query()
def stratified_resample(spark: SparkSession, sf: str) -> DataFrame:
    members = A.table(spark, sf, "documents").select(F.col("lang").alias("groups"), F.col("doc_id").alias("accession"))
    return kmers.stratified_resample(members, 1000)


@query()
def oligo_summary(spark: SparkSession, sf: str) -> DataFrame:
    rows = A.sequences(spark, sf).filter(F.length("seq") >= 60)
    amplicons = rows.select(
        F.concat(F.col("lang"), F.lit("|F")).alias("FP_ID"), F.concat(F.col("lang"), F.lit("|R")).alias("RP_ID"), F.substring("seq", 1, 18).alias("FP_seq"),
        F.left(S.reverse_complement(F.col("seq")), F.lit(20)).alias("RP_seq"), F.col("source").alias("HitName"), F.lit(1).alias("Start"), F.length("seq").alias("End"), F.col("doc_id").alias("row_id"),
    )
    return evaluate.summary(amplicons)


@query(f"WITH {_DOCS}, a AS (SELECT l_orderkey, l_linenumber, l_partkey AS sseqid, l_linenumber * 5 AS s, l_linenumber * 5 + CAST(l_quantity AS BIGINT) AS e FROM lineitem), c AS (SELECT l_orderkey, l_linenumber, sseqid, s || '-' || e AS position, e - s + 1 AS amplicon_len, substr(seq, s, e - s + 1) AS AmpliconSeq FROM a JOIN seqs ON sseqid = doc_id) SELECT * FROM c WHERE amplicon_len > 10 AND NOT contains(AmpliconSeq, 'N')")
def amplicon_sequences(spark: SparkSession, sf: str) -> DataFrame:
    start = (F.col("l_linenumber") * 5).cast("long")
    pairs = A.table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", F.col("l_partkey").alias("sseqid"), start.alias("Start"), (start + F.col("l_quantity").cast("long")).alias("End")
    )
    pairs = evaluate.longer_than(pairs.withColumn("amplicon_len", F.col("End") - F.col("Start") + 1), 10)
    cut = pcr.usable(pcr.with_sequence(pcr.position_range(pairs), A.sequences(spark, sf).withColumnRenamed("doc_id", "sseqid")))
    return cut.select("l_orderkey", "l_linenumber", "sseqid", "position", "amplicon_len", "AmpliconSeq")


@query(f"WITH {_DOCS} SELECT doc_id, CASE WHEN doc_id % 2 = 1 THEN {_RC.format('seq')} ELSE seq END AS AmpliconSeq, CASE WHEN doc_id % 2 = 0 THEN 'd' || doc_id END AS primer_set FROM seqs")
def amplicon_orientation(spark: SparkSession, sf: str) -> DataFrame:
    name = F.concat(F.lit("d"), F.col("doc_id").cast("string"), F.when(F.col("doc_id") % 2 == 1, "|R").otherwise("|F"))
    rows = pcr.forward(A.sequences(spark, sf).select("doc_id", name.alias("FP_ID"), F.col("seq").alias("AmpliconSeq")))
    single = pcr.single_primer(rows).select("doc_id", F.array_join("primer_set", ",").alias("primer_set"))
    return rows.join(single, "doc_id", "left").select("doc_id", "AmpliconSeq", "primer_set")


@query("SELECT o_orderkey, CAST(o_custkey % 3 AS VARCHAR) AS label FROM orders WHERE o_custkey % 3 <> 0 AND NOT regexp_matches(CAST(o_orderkey AS VARCHAR), '77') AND NOT regexp_matches(CAST(o_orderkey AS VARCHAR), '^1')")
def label_filters(spark: SparkSession, sf: str) -> DataFrame:
    o = A.table(spark, sf, "orders").select("o_orderkey", F.col("o_orderkey").cast("string").alias("name"), (F.col("o_custkey") % 3).cast("string").alias("label"))
    return evaluate.on_target_labels(evaluate.without(o, "name", ["77", "^1"])).select("o_orderkey", "label")


@query("WITH t AS (SELECT 'c' || o_custkey || '|F' AS FP_ID, 'o' || o_orderkey || '|R' AS RP_ID, o_orderkey FROM orders), ids AS (SELECT 'c' || c_custkey AS id FROM customer WHERE c_custkey % 5 = 0 UNION SELECT 'o' || l_orderkey FROM lineitem WHERE l_linenumber = 7) SELECT o_orderkey, FP_ID, RP_ID FROM t WHERE split_part(FP_ID, '|', 1) IN (SELECT id FROM ids) OR split_part(RP_ID, '|', 1) IN (SELECT id FROM ids)")
def only_exclusive(spark: SparkSession, sf: str) -> DataFrame:
    id_of = lambda letter, column: F.concat(F.lit(letter), F.col(column).cast("string"))
    rows = A.table(spark, sf, "orders").select("o_orderkey", F.concat(id_of("c", "o_custkey"), F.lit("|F")).alias("FP_ID"), F.concat(id_of("o", "o_orderkey"), F.lit("|R")).alias("RP_ID"))
    ids = A.table(spark, sf, "customer").filter("c_custkey % 5 = 0").select(id_of("c", "c_custkey").alias("id"))
    more = A.table(spark, sf, "lineitem").filter("l_linenumber = 7").select(id_of("o", "l_orderkey").alias("id"))
    return evaluate.only_exclusive(rows, ids.unionByName(more))


@query("WITH a AS (SELECT o_custkey AS id, CAST(count(*) AS BIGINT) AS n FROM orders WHERE o_orderkey % 2 = 0 GROUP BY 1), b AS (SELECT c_custkey AS id, c_nationkey AS nation FROM customer WHERE c_custkey % 3 = 0) SELECT id, n, nation FROM a FULL JOIN b USING (id)")
def summary_with_inclusivity(spark: SparkSession, sf: str) -> DataFrame:
    table = A.table(spark, sf, "orders").filter("o_orderkey % 2 = 0").groupBy(F.col("o_custkey").alias("id")).agg(F.count("*").alias("n"))
    inclusivity = A.table(spark, sf, "customer").filter("c_custkey % 3 = 0").select(F.col("c_custkey").alias("id"), F.col("c_nationkey").alias("nation"))
    return evaluate.with_inclusivity(table, inclusivity, "id")


@query('SELECT l_orderkey, l_linenumber, l_partkey AS "start", l_partkey + CAST(l_quantity AS BIGINT) AS "end" FROM lineitem WHERE l_discount = 0 AND l_linenumber = 1')
def perfect_hits(spark: SparkSession, sf: str) -> DataFrame:
    a, b = F.col("l_partkey"), F.col("l_partkey") + F.col("l_quantity").cast("long")
    minus = F.col("l_returnflag") == "R"
    hits = A.table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", (F.lit(100.0) - F.col("l_discount") * 100).alias("pident"), (F.col("l_linenumber") - 1).alias("gapopen"),
        F.when(minus, b).otherwise(a).alias("sstart"), F.when(minus, a).otherwise(b).alias("send"),
    )
    return readers.perfect_hits(hits).select("l_orderkey", "l_linenumber", "start", "end")


@query(f"WITH {_DOCS}, w AS (SELECT DISTINCT kmer FROM ({_windows(6, True)})), p AS (SELECT a.kmer AS a, b.kmer AS b, CAST(hamming(a.kmer, b.kmer) AS INTEGER) AS d FROM w a JOIN w b ON a.kmer <> b.kmer), r AS (SELECT a, b, d, CAST(row_number() OVER (PARTITION BY a ORDER BY d, b) AS INTEGER) AS rank FROM p WHERE d <= 1) SELECT * FROM r WHERE rank <= 5")
def nearest_kmers(spark: SparkSession, sf: str) -> DataFrame:
    return cluster.nearest(kmers.exploded(A.sequences(spark, sf), 6).distinct(), 6, 1, 5)


@query("SELECT p_partkey, length(p_name) * 0.2::DOUBLE AS budget, CAST(length(p_name) - round_even(length(p_name) * 0.15::DOUBLE, 0) AS INTEGER) AS least FROM part")
def oligo_budgets(spark: SparkSession, sf: str) -> DataFrame:
    return A.table(spark, sf, "part").select("p_partkey", S.mismatch_budget(F.col("p_name"), 0.2).alias("budget"), S.match_floor(F.col("p_name"), 0.15).alias("least"))


@query(f"WITH {_DOCS}, w AS (SELECT DISTINCT kmer FROM ({_windows(K)})) SELECT CAST(row_number() OVER (ORDER BY kmer) - 1 + 10 AS BIGINT) AS id, kmer FROM w")
def kmer_ordinal(spark: SparkSession, sf: str) -> DataFrame:
    return kmers.ordinal(kmers.exploded(A.sequences(spark, sf), K), 10)


@query()
def translated_hits(spark: SparkSession, sf: str) -> DataFrame:
    markers = A.panel(spark, sf, 24).select("id", S.translate_cds(F.col("kmer")).alias("protein"))
    return pcr.translated_search(markers, A.sequences(spark, sf).select(F.col("doc_id").alias("sseqid"), "seq"))


@query()
def resampled_matrix(spark: SparkSession, sf: str) -> DataFrame:
    rows = A.sequences(spark, sf).withColumn("sample", F.concat_ws("/", "lang", "source"))
    matrix, index = kmers.sample_matrix(rows, 5, "lang", "sample"), kmers.sample_index(rows, "lang", "sample")
    members = rows.select(F.col("lang").alias("groups"), F.col("sample").alias("accession"))
    return kmers.resampled_matrix(matrix, index, kmers.stratified_resample(members, 100))


@query()
def ward_labels(spark: SparkSession, sf: str) -> DataFrame:
    return cluster.label_table(ward_clusters(spark, sf), "docs_")
