"""Intervals (chrom, start, end), 0-based and half-open: merge, complement, collapse, slice."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import product

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from helixmill.functions import sequence as S
from helixmill.operators.tables import written


#: Letters of a chromosome whose intervals meet in one task.
BIN = 1 << 16


def islands(rows: DataFrame, by: tuple[str, ...], order: tuple[str, ...], touching: bool, width: int = BIN) -> DataFrame:
    """rows with __island: one number for each run of overlapping intervals, counted per `by`.

    touching puts intervals that only touch into one island. Rows are sorted inside bins of
    `width` letters by their start; what earlier bins hand on (the greatest end, the number of
    islands so far) is summed over one row a bin, so a chromosome is never sorted in one task.
    """
    binned = rows.withColumn("__bin", F.floor(F.col("start") / width))
    inside = Window.partitionBy(*by, "__bin").orderBy(*order)
    across = Window.partitionBy(*by).orderBy("__bin").rowsBetween(Window.unboundedPreceding, -1)
    ends = binned.groupBy(*by, "__bin").agg(F.max("end").alias("__end")).withColumn("__reached", F.max("__end").over(across)).drop("__end")
    joined = _beside(binned, ends, by)
    before = F.greatest("__reached", F.max("end").over(inside.rowsBetween(Window.unboundedPreceding, -1)))
    gap = F.col("start") > before if touching else F.col("start") >= before
    opened = joined.withColumn("__open", F.when(gap, 1).otherwise(0)).drop("__reached")
    counts = opened.groupBy(*by, "__bin").agg(F.sum("__open").alias("__n"))
    counts = counts.withColumn("__so_far", F.coalesce(F.sum("__n").over(across), F.lit(0))).drop("__n")
    numbered = _beside(opened.withColumn("__island", F.sum("__open").over(inside)), counts, by)
    return numbered.withColumn("__island", F.col("__island") + F.col("__so_far")).drop("__open", "__so_far", "__bin")


def _beside(rows: DataFrame, bins: DataFrame, by: tuple[str, ...]) -> DataFrame:
    """rows with their bin's columns; a null in `by` is a value like others."""
    named = bins.select(*[F.col(c).alias(f"__b{i}") for i, c in enumerate((*by, "__bin"))], *[c for c in bins.columns if c not in (*by, "__bin")])
    same = [rows[c].eqNullSafe(named[f"__b{i}"]) for i, c in enumerate((*by, "__bin"))]
    return rows.join(named, same, "left").drop(*[f"__b{i}" for i in range(len(by) + 1)])


def merge(intervals: DataFrame, by: tuple[str, ...] = ("chrom",)) -> DataFrame:
    """(by..., start, end): overlapping and touching intervals as one.

    Equal intervals are dropped before the sort; an interval opens an island if it starts
    after every end before it.
    """
    rows = intervals.select(*by, "start", "end").distinct()
    island = islands(rows, by, ("start", "end"), touching=True)
    return island.groupBy(*by, "__island").agg(F.min("start").alias("start"), F.max("end").alias("end")).drop("__island")


def complement(intervals: DataFrame, sizes: DataFrame) -> DataFrame:
    """(chrom, start, end): what the intervals leave of [0, size) of every chromosome.

    sizes has chrom and size; chromosomes without intervals are emitted whole. A gap opens before
    an interval that starts after every end before it, so the intervals aren't merged: they are
    shuffled once into bins of their starts, sorted there, and what earlier bins hand on is summed
    over one row a bin. Intervals without a start are left out; one without an end closes the gap
    before it, and what follows it up to the next island is unknown and no gap.
    """
    rows = intervals.filter("start IS NOT NULL AND chrom IS NOT NULL").select("chrom", "start", "end", F.floor(F.col("start") / BIN).alias("__bin"))
    reach, endless = F.max("end").alias("__reach"), F.max(F.when(F.col("end").isNull(), F.col("start"))).alias("__endless")
    bins = written(rows.groupBy("chrom", "__bin").agg(reach, endless))
    times = sizes.groupBy("chrom").agg(F.count("*").alias("__times"))
    across = Window.partitionBy("chrom").orderBy("__bin").rowsBetween(Window.unboundedPreceding, -1)
    handed = bins.select("chrom", "__bin", F.max("__reach").over(across).alias("__r"), F.max("__endless").over(across).alias("__e")).join(times, "chrom")
    # In the rows' partitions by bin, which the window then needs no shuffle for.
    inside = Window.partitionBy("chrom", "__bin").orderBy("start", "end").rowsBetween(Window.unboundedPreceding, -1)
    seen = rows.join(handed, ["chrom", "__bin"]).select(
        "chrom", F.col("start").alias("end"), "__times",
        F.greatest("__r", F.max("end").over(inside)).alias("__reach"), F.greatest("__e", F.max(F.when(F.col("end").isNull(), F.col("start"))).over(inside)).alias("__endless"),
    )
    known = F.col("__endless").isNull() | (F.col("__endless") <= F.col("__reach"))
    first = F.col("__reach").isNull() & F.col("__endless").isNull()
    zero = F.lit(0).cast("long")
    gaps = seen.select("chrom", F.when(first, zero).when(known, F.col("__reach")).alias("start"), "end", "__times").filter("start < end")
    gaps = gaps.select("chrom", "start", "end", F.explode(F.array_repeat(F.lit(0), F.col("__times").cast("int"))).alias("__copy")).drop("__copy")
    last = bins.groupBy("chrom").agg(F.max("__reach").alias("__reach"), F.max("__endless").alias("__endless"))
    tails = last.filter(known).join(sizes, "chrom").select("chrom", F.col("__reach").alias("start"), F.col("size").alias("end"))
    empty = sizes.join(bins.select("chrom").distinct(), "chrom", "left_anti").select("chrom", zero.alias("start"), F.col("size").alias("end"))
    return gaps.unionByName(tails).unionByName(empty).filter("start < end")


_UNION = np.full((256, 256), ord("N"), np.uint8)
np.fill_diagonal(_UNION, np.arange(256))
for _a, _b in product(S.MASK, S.MASK):
    _UNION[ord(_a), ord(_b)] = ord(S.CODE[S.MASK[_a] | S.MASK[_b]])


class _Fold:
    """The current interval of a fold, its sequence growing in place."""

    def __init__(self, start: int, end: int, name: str | None):
        self.start, self.end, self.missing = start, end, name is None
        self.letters = bytearray((name or "").encode("ascii", "replace"))

    def extend(self, start: int, end: int, name: str | None) -> None:
        at, more = start - self.start, (name or "").encode("ascii", "replace")
        both = max(0, min(len(self.letters) - at, len(more)))
        if both:
            own = np.frombuffer(self.letters, np.uint8)[at : at + both].copy()
            self.letters[at : at + both] = _UNION[own, np.frombuffer(more, np.uint8)[:both]].tobytes()
        self.letters += more[both:]
        self.end, self.missing = end, self.missing and name is None

    def row(self) -> tuple[int, int, str | None]:
        return self.start, self.end, None if self.missing else self.letters.decode("ascii")


def _folded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Folds islands that follow each other in order; one current interval is all it holds."""
    key, cur, kind = None, None, None
    for batch in batches:
        kind = batch.schema.field(0).type
        out: list[tuple] = []
        for chrom, island, start, end, name in zip(*[c.to_pylist() for c in batch.columns], strict=True):
            if cur is None or key != (chrom, island):
                if cur is not None:
                    out.append((key[0], *cur.row()))
                key, cur = (chrom, island), _Fold(start, end, name)
            elif (start, end) != (cur.start, cur.end):
                if start < cur.end < end:
                    cur.extend(start, end, name)
                else:
                    out.append((chrom, *cur.row()))
                    cur = _Fold(start, end, name)
        yield _intervals(out, kind)
    if cur is not None:
        yield _intervals([(key[0], *cur.row())], kind)


def _intervals(rows: list[tuple], kind: pa.DataType) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) or [[]] * 4
    kinds = [kind, pa.int64(), pa.int64(), pa.string()]
    return pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(columns, kinds, strict=True)], ["chrom", "start", "end", "name"])


def collapse(intervals: DataFrame, by: str = "chrom") -> DataFrame:
    """(chrom, start, end, name) after folding each chromosome's intervals in order of start.

    An interval equal to the current one is skipped; one that starts inside it and ends later
    extends it, its sequence merged base by base at its offset; any other one closes it. What
    an interval does depends on where the current one began, so this is a fold over the
    ordered intervals. Islands of overlapping intervals are folded apart, as a gap always closes
    the current one: they are dealt out and sorted by Spark, and streamed through the fold,
    which holds one current interval however many an island has, in time that grows with its rows.

    Intervals without start or end are left out; a missing sequence is empty where it is merged;
    letters that are no code stay where both have the same, else they become N.
    """
    rows = intervals.filter("start IS NOT NULL AND end IS NOT NULL").select(by, F.col("start").cast("long").alias("start"), F.col("end").cast("long").alias("end"), F.col("name").cast("string").alias("name"))
    island = islands(rows, (by,), ("start", "end", "name"), touching=False).select(by, "__island", "start", "end", "name")
    ordered = island.repartition(by, "__island").sortWithinPartitions(by, "__island", "start", "end", "name")
    kind = island.schema[by].dataType.simpleString()
    return ordered.mapInArrow(_folded, f"chrom {kind}, start long, end long, name string").withColumnRenamed("chrom", by)


def sliced(intervals: DataFrame, sequences: DataFrame) -> DataFrame:
    """intervals with `slice`, the part of their chromosome's sequence (chrom, seq)."""
    cut = F.substring("seq", F.col("start").cast("int") + 1, (F.col("end") - F.col("start")).cast("int"))
    return intervals.join(sequences.select("chrom", "seq"), "chrom").withColumn("slice", cut).drop("seq")
