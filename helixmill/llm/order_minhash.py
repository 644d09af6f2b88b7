"""Order MinHash fingerprints: sketches of texts that are sensitive to edit distance.

Every k-mer of code points is numbered by its occurrence in the text, and (k-mer, number) is
hashed. The hash's leading bits deal the numbered k-mers to `bins` lots; each lot keeps its
`take` least, puts them back into the order of the text, and hashes that tuple into 32 bits.
The bins of a text are its fingerprint. Two texts agree in a bin only if the same k-mers are
least there and stand in the same order, so moved passages cost likeness as edits do.

Neighbours (the next document by descending id) are found without sorting everything in one
place and without any number of ranges at the driver: Spark deals the rows to ranges of
descending id (rows of equal id by a hash of the text) and sorts each range, spilling if it
must; a task then streams through its rows. Only the last row of each range looks into the
next one: the ranges' first and last rows, one of each, are joined by range number.

Defined results: null text is empty; a text shorter than k code points is one k-mer; an empty
text has an empty fingerprint and likeness 1 to an empty one, 0 to others; a single document
is its own next; null ids come after all others, rows of equal id in the order of their texts'
hashes, then of the texts; equal texts have equal fingerprints; other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from helixmill.llm.shared import U, mix

K, BINS, TAKE = 9, 64, 2
#: Bytes of text in a range that are aimed at; small tables have as many ranges as other shuffles.
RANGE_BYTES = 64 << 20


def points(text: str | None) -> np.ndarray:
    return np.frombuffer((text or "").encode("utf-32-le", "surrogatepass"), dtype=np.uint32)


def _lots(hashes: np.ndarray, bins: int) -> np.ndarray:
    return (hashes >> U(64 - (bins - 1).bit_length())).astype(np.int64) % bins


def _least(hashes: np.ndarray, values: np.ndarray, bins: int, take: int) -> np.ndarray:
    """Of values sorted by hash, the first `take` of each lot. bins is a power of two."""
    lot = _lots(hashes, bins)
    return values[np.arange(len(lot)) - np.searchsorted(lot, lot) < take]


def sketch(text: np.ndarray, k: int = K, bins: int = BINS, take: int = TAKE) -> np.ndarray:
    """A uint32 for each bin; 0 marks a bin without k-mers."""
    out = np.zeros(bins, dtype=np.uint32)
    n = max(1, len(text) - k + 1) if len(text) else 0
    if not n:
        return out
    h = np.zeros(n, dtype=np.uint64)
    for i in range(min(k, len(text))):
        h *= U(0x9E3779B97F4A7C15)
        h += text[i : i + n].astype(np.uint64) + U(1)
    h = mix(h)
    # Sorting hash and place as one number keeps equal k-mers in the order of the text.
    low = U(max(20, n.bit_length()))
    packed = (h >> low << low) | np.arange(n, dtype=np.uint64)
    packed.sort()
    order = (packed & ((U(1) << low) - U(1))).astype(np.int64)
    same = np.concatenate(([False], packed[1:] >> low == packed[:-1] >> low))
    if same.any():
        index = np.arange(n)
        number = index - np.maximum.accumulate(np.where(same, 0, index))
        later = order[same]
        h[later] = mix(h[later] + number[same].astype(np.uint64) * U(0xD6E8FEB86659FD93))
        order = order[~same]
        later = later[np.argsort(h[later], kind="stable")]
        order = np.concatenate((_least(h[order], order, bins, take), _least(h[later], later, bins, take)))
        order = order[np.argsort(h[order], kind="stable")]
    order = _least(h[order], order, bins, take)
    lot = _lots(h[order], bins)
    have = np.zeros((bins, take), dtype=bool)
    nth = np.arange(len(order)) - np.searchsorted(lot, lot)
    place = np.full((bins, take), n)
    place[lot, nth] = order
    have[lot, nth] = True
    place.sort(axis=1)
    full = have[:, 0]
    chain = np.zeros(bins, dtype=np.uint64)
    for j in range(take):
        there = place[:, j] < n
        step = h[np.minimum(place[:, j], n - 1)]
        chain = np.where(there, mix(chain * U(0x2545F4914F6CDD1D) + step), chain)
    out[full] = (chain[full] >> U(32)).astype(np.uint32) | np.uint32(1)
    return out


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """The share of bins that agree among those with k-mers in either; 1 for two empty ones."""
    used = (a != 0) | (b != 0)
    return float((a[used] == b[used]).mean()) if used.any() else 1.0


NAMES = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]
KINDS = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]
SCHEMA = """doc_id bigint, n_chars bigint, edited_sha256 string, fingerprint string,
    edited_fingerprint string, near_edited double, near_next double"""


def judged(doc_id: int | None, text: np.ndarray, mine: np.ndarray, following: np.ndarray, theirs: np.ndarray) -> tuple:
    """One row of the result: the text and its sketch, the next text and its sketch."""
    cut = len(text) // 3
    edited = np.concatenate((text[: len(text) - cut], following[:cut])) if cut else text
    other = sketch(edited)
    digest = hashlib.sha256(edited.tobytes().decode("utf-32-le", "surrogatepass").encode("utf-8", "surrogatepass")).hexdigest()
    return doc_id, len(text), digest, mine.tobytes().hex(), other.tobytes().hex(), likeness(mine, other), likeness(mine, theirs)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    columns = zip(*rows, strict=True) if rows else [()] * len(NAMES)
    return pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(columns, KINDS, strict=True)], names=NAMES)


def _inside(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """All rows of a sorted range but its last, each with the row behind it."""
    before = None
    for batch in batches:
        rows = []
        for doc_id, raw in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            text = points(raw)
            now = doc_id, text, sketch(text)
            if before is not None:
                rows.append(judged(*before, *now[1:]))
            before = now
        yield _batch(rows)


def _at_ends(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The last rows of ranges, with the next range's first text beside them."""
    for batch in batches:
        rows = []
        for doc_id, raw, following in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            text, behind = points(raw), points(following)
            rows.append(judged(doc_id, text, sketch(text), behind, sketch(behind)))
        yield _batch(rows)


def with_next(docs: DataFrame, range_bytes: int = RANGE_BYTES, least_ranges: int | None = None) -> DataFrame:
    """For each document its fingerprint, that of its edited text, and its likeness to that
    and to the next document's.

    The edited text has the last third of the code points replaced by as many of the next
    document's first (or all of them).
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    total = rows.agg(F.sum(F.octet_length("text")).alias("n")).first()["n"] or 0
    least_ranges = least_ranges or int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranges = max(least_ranges, -(-int(total) // range_bytes))
    order = [F.col("doc_id").desc_nulls_last(), F.col("tie"), F.col("text")]
    # A range's bounds are taken from ids and hashes, never from texts.
    dealt = rows.withColumn("tie", F.xxhash64("text")).repartitionByRange(ranges, *order[:2])
    inside = dealt.sortWithinPartitions(*order).select("doc_id", "text").mapInArrow(_inside, SCHEMA)
    # Both readers of `dealt` ask for all of its columns, so that they share one exchange and its
    # bounds. The bounds are keys of rows: only the last range can be empty. Range r's last row
    # and range r+1's first meet under r; the two that are left over close the circle.
    place = F.struct(F.col("doc_id").isNull().alias("none"), F.bitwise_not("doc_id").alias("down"), "tie", "text", "doc_id")
    ends = dealt.groupBy(F.spark_partition_id().alias("range")).agg(F.min(place).alias("first"), F.max(place).alias("last"))
    last = F.struct(F.col("range").alias("at"), F.struct("last.doc_id", "last.text").alias("last"), F.lit(None).cast("struct<text:string>").alias("first"))
    first = F.struct((F.col("range") - 1).alias("at"), F.lit(None).cast("struct<doc_id:bigint,text:string>").alias("last"), F.struct("first.text").alias("first"))
    both = F.max("last").alias("last"), F.max("first").alias("first")
    met = ends.select(F.explode(F.array(last, first)).alias("e")).select("e.*").groupBy("at").agg(*both)
    at = F.when(F.col("last").isNull() | F.col("first").isNull(), -1).otherwise(F.col("at"))
    closed = met.groupBy(at.alias("at")).agg(*both).select("last.doc_id", "last.text", F.col("first.text").alias("behind"))
    return inside.unionByName(closed.mapInArrow(_at_ends, SCHEMA))
