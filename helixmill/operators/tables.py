"""Tables written to the folder that the cluster shares, and ranks over whole tables."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share, from spark.checkpoint.dir.

    Where none is set and the session runs in one process (master local), a new folder; on a
    cluster ValueError, as other hosts would not see it.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        master = spark.conf.get("spark.master", "")
        if master.split("[")[0] != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        root = tempfile.mkdtemp(prefix="helixmill-")
        spark.conf.set("spark.checkpoint.dir", root)
    return root.rstrip("/")


def discarded(spark: SparkSession, *paths: str) -> None:
    """Deletes written tables that nothing reads any more."""
    for path in paths:
        folder = spark._jvm.org.apache.hadoop.fs.Path(path)
        folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def written(df: DataFrame) -> DataFrame:
    """df as a Parquet table in the shared folder: computed once, without lineage.

    The table stays until it is `released`.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/table-{uuid.uuid4().hex}"
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out.written_to = path
    return out


def released(*tables: DataFrame) -> None:
    """Deletes what `written` wrote for these tables, once nothing reads them any more."""
    for df in tables:
        if path := df.__dict__.pop("written_to", None):
            discarded(df.sparkSession, path)


def spread(df: DataFrame) -> DataFrame:
    """A scan over twice as many partitions as there are cores, for work that multiplies its rows.

    A file of one row group is read by one task, whatever the number of splits; dealing out its
    compact rows costs little next to their windows. A table of more partitions stays as it is.
    """
    least = 2 * df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(least) if df.rdd.getNumPartitions() < least else df


def ranked(df: DataFrame, *keys, name: str = "rank") -> DataFrame:
    """df with a column `name`: 1 for the first row in the order of the keys.

    Rows are dealt by ranges of the keys and written; each range's count then shifts the
    ranks inside it. The shifts are one row per range, so they may be broadcast.
    """
    ranges = written(df.repartitionByRange(*keys).withColumn("__range", F.spark_partition_id()))
    counts = ranges.groupBy("__range").agg(F.count("*").alias("__count"))
    before = Window.orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)
    shifts = counts.select("__range", F.coalesce(F.sum("__count").over(before), F.lit(0)).alias("__shift"))
    inside = F.row_number().over(Window.partitionBy("__range").orderBy(*keys))
    return (
        ranges.withColumn("__inside", inside)
        .join(F.broadcast(shifts), "__range")
        .withColumn(name, F.col("__inside") + F.col("__shift"))
        .drop("__inside", "__shift", "__range")
    )
