"""From raw documents to a training mix: filter, clean, deduplicate, decontaminate, mix.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; the driver writes it as Parquet
and reads it as the next stage's docs. All but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from helixmill.llm import dart_minhash, decontamination, line_dedup, mixing, toxicity
from helixmill.llm.queries import TOXIC_AT, training_rows
from helixmill.llm.shared import unused, written


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Trains on labelled documents and drops those that score as toxic; without labelled
    documents of both classes there is no model and all stay."""
    model = toxicity.fit(docs, _table(spark, sf_dir, "labels"), training_rows(4, 2))
    if not model.trained:
        return docs
    score = unused(docs.columns, "__score")
    return toxicity.score(docs, model, out=score).filter(F.col(score) < TOXIC_AT).select(*docs.columns)


def drop_boilerplate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops lines that too many of a source's documents share; n_chars follows the text.

    A document that would lose all of its lines keeps them, so that of a group of copies one
    is left after near-dedup.
    """
    n_lines, n_dropped = (unused(docs.columns, x) for x in ("__n_lines", "__n_dropped"))
    clean = line_dedup.without_boilerplate(docs, keep_whole=True, n_lines=n_lines, n_dropped=n_dropped)
    length = F.when(F.col(n_dropped) > 0, F.length("text").cast("long")).otherwise(F.col("n_chars"))
    return clean.withColumn("n_chars", length).select(*docs.columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the document of the least id in each class of near duplicates."""
    return dart_minhash.deduplicated(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that contain an item of the benchmark."""
    return decontamination.clean(docs, _table(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeats documents until each source has its share of the words."""
    return mixing.mixed(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("line dedup", drop_boilerplate),
    ("near dedup", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("mixing", mix_sources),
]

#: Compression lengths and MinHash have no SQL form; tests hold each stage to brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    for i, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i + 1 < len(STAGES):
            docs = written(docs)
    return docs
