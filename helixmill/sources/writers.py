"""Writers. Directories of part files, written by the tasks; nothing passes the driver."""

from __future__ import annotations

import io
import zipfile

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def fasta(records: DataFrame, path: str, by: str | None = None) -> None:
    """>id description, then the sequence; with `by` a directory for each of its values."""
    described = F.when(F.coalesce(F.col("description"), F.lit("")) != "", F.concat(F.lit(" "), "description")) if "description" in records.columns else F.lit(None)
    text = F.concat(F.lit(">"), F.col("id").cast("string"), F.coalesce(described, F.lit("")), F.lit("\n"), "seq")
    out = records.select(text.alias("value"), *([by] if by else []))
    writer = out.write.mode("overwrite")
    (writer.partitionBy(by) if by else writer).text(path)


def table(rows: DataFrame, path: str, by: str | None = None) -> None:
    """Tab-separated with a header; nulls as N/A, arrays as their members with commas between."""
    lists = {f.name for f in rows.schema if f.dataType.typeName() == "array"}
    plain = rows.select(*[F.array_join(F.col(c).cast("array<string>"), ",").alias(c) if c in lists else F.col(c) for c in rows.columns])
    writer = plain.write.mode("overwrite")
    (writer.partitionBy(by) if by else writer).csv(path, sep="\t", header=True, nullValue="N/A")


def bed(intervals: DataFrame, path: str) -> None:
    """Without a header, sorted by chromosome and start."""
    intervals.orderBy("chrom", "start").write.mode("overwrite").csv(path, sep="\t", header=False)


def sam(alignments: DataFrame, sizes: DataFrame, path: str) -> None:
    """SAM text: header lines from sizes (chrom, size) as one file, then the alignments'."""
    head = sizes.select(F.concat(F.lit("@SQ\tSN:"), F.col("chrom").cast("string"), F.lit("\tLN:"), F.col("size").cast("string")).alias("value"))
    body = alignments.select(F.concat_ws("\t", *[F.col(c).cast("string") for c in alignments.columns]).alias("value"))
    head.coalesce(1).write.mode("overwrite").text(path)
    body.write.mode("append").text(path)


def exclusive_json(lists: DataFrame, path: str) -> None:
    """{label: [[id, ...], ...]} with every label; lists has label and primers."""
    entry = F.concat(F.to_json(F.array("label")), F.lit(": "), F.to_json("primers"))
    cleaned = F.regexp_replace(entry, r"^\[(.*?)\]: ", "$1: ")
    lists.select(cleaned.alias("e")).agg(F.concat(F.lit("{"), F.array_join(F.array_sort(F.collect_list("e")), ", "), F.lit("}"))).coalesce(1).write.mode("overwrite").text(path)


def accession_lists(missing: DataFrame, path: str) -> None:
    """Text files of accessions without a hit, a directory for each label."""
    missing.select("label", F.col("accession").cast("string").alias("value")).write.mode("overwrite").partitionBy("label").text(path)


def zipped(members: DataFrame, path: str) -> None:
    """A file <archive>.zip (deflate level 6) in the directory `path` per value of `archive`.

    Archives are packed by the tasks; the finished files pass the driver one at a time, as
    Spark's writers know no such format, and go to any store that Hadoop knows. An archive
    must fit into a task's memory (2 GB at most).
    """

    def pack(part: pd.DataFrame) -> pd.DataFrame:
        raw = io.BytesIO()
        with zipfile.ZipFile(raw, "w", zipfile.ZIP_DEFLATED, compresslevel=6) as z:
            for name, content in zip(part["member"], part["content"], strict=True):
                z.writestr(name, bytes(content))
        return pd.DataFrame([(str(part["archive"].iloc[0]), raw.getvalue())], columns=["archive", "content"])

    packed = members.groupBy("archive").applyInPandas(pack, "archive string, content binary")
    spark = members.sparkSession
    hadoop = spark._jvm.org.apache.hadoop.fs
    for row in packed.toLocalIterator():
        target = hadoop.Path(path, row["archive"].rsplit("/", 1)[-1].removesuffix(".zip") + ".zip")
        stream = target.getFileSystem(spark._jsc.hadoopConfiguration()).create(target, True)
        try:
            stream.write(bytes(row["content"]))
        finally:
            stream.close()
