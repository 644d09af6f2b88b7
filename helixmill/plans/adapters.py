"""The given tables in the roles of the tools' inputs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from helixmill.functions import sequence as S
from helixmill.operators import mapping
from helixmill.operators.tables import spread

LETTERS = "abcdefghijklmnopqrstuvwxyz"
BASES = "ACGTACGTACGTACGTACGTACGTAC"
#: Every seventh letter is a code, the others are bases.
CODES = "ACGTACRACGTACYACGTACNACGTA"
K = 8


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def letters(text: str = "text"):
    return F.regexp_replace(F.lower(text), "[^a-z]", "")


def sequences(spark: SparkSession, sf_dir: str, name: str = "documents", key: str = "doc_id", also: tuple[str, ...] = ("lang", "source")) -> DataFrame:
    """Documents as sequence records: the letters of the text as bases."""
    return spread(table(spark, sf_dir, name).select(key, *also, "text")).select(key, *also, F.translate(letters(), LETTERS, BASES).alias("seq"))


def degenerate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as sequences with ambiguity codes."""
    return spread(table(spark, sf_dir, "documents").select("doc_id", "text")).select("doc_id", F.translate(letters(), LETTERS, CODES).alias("seq"))


def panel(spark: SparkSession, sf_dir: str, k: int = K) -> DataFrame:
    """(id, kmer): the first k bases of every benchmark item."""
    items = sequences(spark, sf_dir, "benchmark", "item_id", ()).filter(F.length("seq") >= k)
    return items.select(F.col("item_id").alias("id"), F.substring("seq", 1, k).alias("kmer"))


def intervals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items as intervals on their supplier."""
    start = F.col("l_partkey") * 7 + F.col("l_linenumber") * 3
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_suppkey").alias("chrom"), start.alias("start"), (start + F.col("l_quantity").cast("long")).alias("end")
    )


def chrom_sizes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every supplier's length; each end is below it."""
    parts = table(spark, sf_dir, "part").agg((F.max("p_partkey") * 7 + 1000).alias("size"))
    return table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("chrom")).crossJoin(F.broadcast(parts))


def oligo_hits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items as alignment hits: the part is the oligo, the order the subject."""
    start = F.col("l_partkey") + F.col("l_linenumber") * 37
    length = F.col("l_quantity").cast("long")
    minus = F.col("l_returnflag") == "R"
    return table(spark, sf_dir, "lineitem").select(
        F.concat(F.lit("p"), F.col("l_partkey").cast("string")).alias("qseqid"), F.col("l_suppkey").alias("sseqid"),
        F.col("l_linenumber").cast("string").alias("primer_group"),
        (F.lit(20) - (F.col("l_tax") * 100).cast("int")).alias("nident"),
        F.when(minus, start + length).otherwise(start).alias("sstart"), F.when(minus, start).otherwise(start + length).alias("send"),
    )


def seed_pairs(spark: SparkSession, sf_dir: str, forward: str, backward: str, group: bool) -> DataFrame:
    """Two k-mers' places in the documents as hits of a forward and a reverse oligo."""
    seqs = sequences(spark, sf_dir)
    k = len(forward)
    found = F.transform(S.windows(F.col("seq"), k), lambda w, i: F.when(w == forward, F.struct(F.lit("plus").alias("s"), i.alias("p"))).when(w == backward, F.struct(F.lit("minus").alias("s"), i.alias("p"))))
    rows = seqs.select("doc_id", "lang", F.explode(F.filter(found, lambda h: h.isNotNull())).alias("h"))
    return rows.select(
        F.when(F.col("h.s") == "plus", "oligo|F").otherwise("oligo|R").alias("qseqid"), F.col("doc_id").alias("sseqid"),
        (F.col("h.p") + 1).cast("long").alias("sstart"), F.col("h.s").alias("strand"), *([F.col("lang").alias("primer_group")] if group else []),
    )


def evaluation_hits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(label, accession, primer_group, primer_set): documents hit by the panel's k-mers."""
    rows = sequences(spark, sf_dir)
    found = mapping.present(panel(spark, sf_dir), rows.select("doc_id", "lang", "seq"), ("doc_id", "lang"))
    group = F.concat(F.lit("g"), (F.col("id") % 4).cast("string"))
    return found.select(F.col("lang").alias("label"), F.col("doc_id").alias("accession"), group.alias("primer_group"), F.concat(F.lit("set"), F.col("id").cast("string")).alias("primer_set"))


def totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select(F.col("lang").alias("label"), F.col("doc_id").alias("accession"))


def taxa(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts as taxa: the parent's key is less by the size, the size also gives the rank."""
    size = F.col("p_size") % 5
    rank = F.when(size == 0, "species").when(size == 1, "genus").when(size == 2, "subspecies").otherwise("clade")
    return table(spark, sf_dir, "part").select(F.col("p_partkey").alias("taxid"), (F.col("p_partkey") - F.col("p_size")).alias("parent"), rank.alias("rank"))


def placed_oligos(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items as oligos on their supplier: strand by return flag, temperature by discount."""
    start = F.col("l_partkey") * 7 + F.col("l_linenumber") * 3
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_suppkey").alias("chrom"), start.alias("start"), (start + 18 + F.col("l_linenumber")).alias("end"),
        F.when(F.col("l_returnflag") == "R", "+").when(F.col("l_returnflag") == "A", "-").otherwise("io").alias("strand"),
        F.concat(F.lit("o"), F.col("l_partkey").cast("string")).alias("oligo"), (F.lit(60) + F.round(F.col("l_discount") * 100)).cast("double").alias("tm"),
    ).distinct()
