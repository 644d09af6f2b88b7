"""Filter interaction audit with wide packed counters.

Every document has a mask, the set of filters that it fails. A mask fixes what happens to the
document in every order of the filters: after which step it is gone, where its failures are
redundant, where it is the last filter that could have caught it. So each mask is mapped once
to a big integer with a 64-bit field for each order, step and measure (n! x n steps, six
measures), and the audit is the sum of those integers per part. A task adds the integers of
its rows; the tasks' sums, one integer a part, are added in two rounds and then unpacked.
Fields are non-negative and hold counts below 2^64, so no field runs into the next.

Copies: a text that a smaller id has too is a filter like the others, but no join and no group
of copies is needed for it. Rows are first counted per (text digest, id, part, mask, label) and
then per (digest, part, mask, label), both with map-side sums; the least id's rows of a digest
are told from the rest by a minimum over those few rows. A digest with a third of all documents
is a few rows after the map side.

Defined results: a null text is empty; a null part is the empty string; a document without id
is no copy of any and none is a copy of it (and has no label); repeated rows of one id and text
are documents of their own, none of them a copy of another; several label rows of one id count
as one, which is good or toxic if any of them is; documents without a label are neither; other
columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from helixmill.llm.shared import WORD

FIELD = 8
MEASURES = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost")
#: Parts whose sums a task holds at a time (30 KB each); more are passed on early.
HELD = 512
#: Sums of a part that meet in one task of the first round, about.
FAN = 64


@dataclass(frozen=True)
class Filters:
    """Names of the filters by their letters, and the condition under which a text fails each;
    `copies` is the letter of the filter that the copies of a smaller id fail, if there is one."""

    fails: dict[str, Column]
    copies: str | None = None

    @property
    def letters(self) -> str:
        return "".join(sorted([*self.fails, *([self.copies] if self.copies else [])]))


def orders(letters: str) -> list[str]:
    return ["".join(x) for x in itertools.permutations(letters)]


def packed(letters: str, failed: str, good: bool, toxic: bool) -> int:
    """What one document that fails the filters `failed` adds to every field."""
    fields = []
    for order in orders(letters):
        gone = False
        for step in order:
            fails = step in failed
            now = fails and not gone
            redundant = fails and gone
            gone = gone or fails
            fields += [not gone, now, redundant, failed == step, now and good, now and toxic]
    return int.from_bytes(np.array(fields, dtype="<u8").tobytes(), "little")


def _unpacked(total: int, letters: str) -> np.ndarray:
    """Counts by order, step and measure."""
    n = len(orders(letters)) * len(letters) * len(MEASURES)
    return np.frombuffer(total.to_bytes(n * FIELD, "little"), dtype="<u8").reshape(-1, len(letters), len(MEASURES))


def masks(docs: DataFrame, filters: Filters, part: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, part, digest, mask): a row a document; bit i of mask is the i-th letter's filter."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    one = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(part).cast("string"), F.lit("")).alias("part"), text.alias("text"))
    mask = F.lit(0)
    for i, letter in enumerate(filters.letters):
        if letter in filters.fails:
            mask = mask + F.when(filters.fails[letter], 1 << i).otherwise(0)
    digest = F.unhex(F.sha2(F.col("text").cast("binary"), 256)) if filters.copies else F.lit(None).cast("binary")
    return one.withColumn("words", F.regexp_extract_all("text", F.lit(WORD), F.lit(0))).select("id", "part", digest.alias("digest"), mask.alias("mask"))


def counted(docs: DataFrame, labels: DataFrame, filters: Filters, part: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(part, mask, good, toxic, n): numbers of documents, copies told apart.

    Rows are summed per digest at most, not over all of them, so they grow with the number of
    different texts and no key is large.
    """
    one = labels.filter(F.col("doc_id").isNotNull()).groupBy(F.col("doc_id").alias("id"))
    known = one.agg(F.max(F.coalesce(F.col("quality") == 1, F.lit(False))).alias("good"), F.max(F.coalesce(F.col("toxic") == 1, F.lit(False))).alias("toxic"))
    rows = masks(docs, filters, part, id_col, text_col)
    # Documents meet their labels at their id; those without id are dealt by their digests.
    deal = F.when(F.col("id").isNull(), F.xxhash64("digest", "part", "mask")).otherwise(0)
    per_id = rows.groupBy("id", "digest", "part", "mask").agg(F.count("*").alias("n")).withColumn("deal", deal)
    per_id = per_id.join(known.withColumn("deal", F.lit(0).cast("long")), ["id", "deal"], "left")
    per_id = per_id.withColumns({c: F.coalesce(F.col(c), F.lit(False)) for c in ("good", "toxic")})
    group = ["part", "mask", "good", "toxic"]
    if not filters.copies:
        return per_id.select(*group, "n")
    with_id = F.col("id").isNotNull()
    per_text = per_id.groupBy("digest", *group).agg(
        F.sum("n").alias("all"),
        F.sum(F.when(~with_id, F.col("n"))).alias("without"),
        F.min(F.when(with_id, F.struct("id", "n"))).alias("least"),
    )
    # Documents of the least id may differ in part only: each of them is first.
    least = F.min("least.id").over(Window.partitionBy("digest"))
    first = F.coalesce(F.when(F.col("least.id") == F.col("__least"), F.col("least.n")), F.lit(0)) + F.coalesce("without", F.lit(0))
    told = per_text.withColumn("__least", least).withColumn("first", first)
    copy = 1 << filters.letters.index(filters.copies)
    both = F.array(
        F.struct(F.col("mask").alias("mask"), F.col("first").alias("n")),
        F.struct((F.col("mask") + copy).alias("mask"), (F.col("all") - F.col("first")).alias("n")),
    )
    return told.select("part", "good", "toxic", F.explode(both).alias("x")).select("part", "x.mask", "good", "toxic", "x.n").filter("n > 0")


_SUMS = "part string, total binary"


def _rows(sums: dict[str, int], width: int) -> pa.RecordBatch:
    total = pa.array([x.to_bytes(width, "little") for x in sums.values()], pa.binary())
    return pa.RecordBatch.from_arrays([pa.array(list(sums), pa.string()), total], ["part", "total"])


def _summed(letters: str):
    """Adds the packed integers of a task's rows by part."""
    width = len(orders(letters)) * len(letters) * len(MEASURES) * FIELD

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        integers: dict[tuple, int] = {}
        sums: dict[str, int] = {}
        for batch in batches:
            # Rows of the same mask are counted before their integer is multiplied.
            per = pa.Table.from_batches([batch]).group_by(["part", "mask", "good", "toxic"]).aggregate([("n", "sum")])
            for row in per.to_pylist():
                kind = row["mask"], row["good"], row["toxic"]
                if kind not in integers:
                    failed = "".join(x for i, x in enumerate(letters) if kind[0] >> i & 1)
                    integers[kind] = packed(letters, failed, *kind[1:])
                sums[row["part"]] = sums.get(row["part"], 0) + row["n_sum"] * integers[kind]
                if len(sums) >= HELD:
                    yield _rows(sums, width)
                    sums = {}
        if sums:
            yield _rows(sums, width)

    return run


def _added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Adds integers of the same part that follow each other."""
    part, total, width = None, 0, 0
    for batch in batches:
        for now, x in zip(batch["part"].to_pylist(), batch["total"], strict=True):
            raw = x.as_buffer()
            width = raw.size
            if part is not None and now != part:
                yield _rows({part: total}, width)
                total = 0
            part, total = now, total + int.from_bytes(raw, "little")
    if part is not None:
        yield _rows({part: total}, width)


def audit(docs: DataFrame, labels: DataFrame, filters: Filters, part: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """For each part, each order of the filters and each step the counts of documents.

    Columns: part, filter_order, step (from 1), kept, removed, redundant, unique_fails,
    good_lost, toxic_lost, shapley; the last is the removals of the step's filter summed over
    all orders.
    """
    letters = filters.letters
    sums = counted(docs, labels, filters, part, id_col, text_col).mapInArrow(_summed(letters), _SUMS)
    lots = sums.withColumn("lot", F.spark_partition_id() % F.lit(FAN))
    first = lots.repartition("part", "lot").sortWithinPartitions("part").select("part", "total").mapInArrow(_added, _SUMS)
    totals = first.repartition("part").sortWithinPartitions("part").mapInArrow(_added, _SUMS)
    names = orders(letters)
    schema = "part string, filter_order string, step int, " + ", ".join(f"{m} long" for m in (*MEASURES, "shapley"))

    def unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at = np.array([[letters.index(x) for x in order] for order in names])
        steps = np.tile(np.arange(1, len(letters) + 1, dtype=np.int32), len(names))
        labels_of = pa.array(np.repeat(names, len(letters)), pa.string())
        for batch in batches:
            for name, x in zip(batch["part"], batch["total"], strict=True):
                counts = _unpacked(int.from_bytes(x.as_buffer(), "little"), letters).astype(np.int64)
                removed = np.zeros(len(letters), np.int64)
                np.add.at(removed, at, counts[:, :, MEASURES.index("removed")])
                columns = [counts[:, :, i].ravel() for i in range(len(MEASURES))]
                part_of = pa.array([name.as_py()] * len(steps), pa.string())
                yield pa.RecordBatch.from_arrays(
                    [part_of, labels_of, pa.array(steps), *map(pa.array, columns), pa.array(removed[at].ravel())],
                    ["part", "filter_order", "step", *MEASURES, "shapley"],
                )

    return totals.mapInArrow(unpack, schema)


def text_filters() -> Filters:
    """Five filters over `text` and its `words`: A few words, B repeated words, C capitals,
    D symbols, E copies of a smaller id."""
    n, words = F.size("words").cast("long"), F.col("words")
    return Filters(
        {
            "A": n < 200,
            "B": 100 * F.size(F.array_distinct(words)).cast("long") < 50 * n,
            "C": 100 * F.regexp_count("text", F.lit("[A-Z]")).cast("long") > 3 * F.length("text").cast("long"),
            "D": F.col("text").rlike("[#$%&*|]"),
        },
        copies="E",
    )
