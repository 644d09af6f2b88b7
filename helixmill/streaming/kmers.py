"""K-mer tables over streams of records: an extension, as the reference reads whole files."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from helixmill.functions import sequence as S


def distinct_kmers(records: DataFrame, k: int, seq: str = "seq") -> DataFrame:
    """Each k-mer of both strands once, when it is first seen. The state is one key per k-mer."""
    both = F.flatten(F.transform(S.windows(F.upper(seq), k), lambda x: F.array(x, S.reverse_complement(x))))
    return records.select(F.explode(F.array_distinct(both)).alias("kmer")).dropDuplicates(["kmer"])


def windowed_counts(records: DataFrame, k: int, time: str, window: str, late: str, seq: str = "seq") -> DataFrame:
    """(window, kmer, n) per tumbling window of event time; rows later than `late` are left out
    and their windows' state is dropped."""
    rows = records.withWatermark(time, late).select(time, F.explode(S.windows(F.col(seq), k)).alias("kmer"))
    return rows.groupBy(F.window(time, window).alias("window"), "kmer").agg(F.count("*").alias("n"))
