"""Benchmark decontamination: size-partitioned MinHash containment search, then exact checks.

Documents are partitioned by their number of shingles, in powers of two. Within a partition
of at most s shingles a signature has 64*s bins; a bin keeps the least hash that falls into
it (one-permutation MinHash). A test item has one signature per partition, with that
partition's bins, so that a short item meets a long document at a resolution at which almost
every one of its shingles is its bin's least: a document that holds 80 % of an item's shingles
shares a bin with it unless all of those lose their bins, each with a chance of at most 1/128.
Items of up to three shingles are compared with all hashes of a document instead.

A candidate (document, item) is then verified on words: the share of the item's distinct
shingles that occur in the document must reach the threshold.

Documents are read once, whole, and never shuffled. Items go to the tasks in blocks of at
most `block` items, one pass for each block, so that what is broadcast stays bounded. A Python
worker indexes a block once, and only for the partitions that its documents fall into.

Defined results: null and empty texts hold no item; an item without words is found nowhere;
an item of fewer words than a shingle is one shingle, found as that run of words between a
document's words; repeated item rows count once by (item_id, text); repeated documents give
repeated rows; an item without id is an item like others, found under a null item_id; other
columns pass through `clean`, whatever their names, and aren't read by `leaks`. Words are lower-cased (A-Z) and split at white space.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from helixmill.llm.shared import U, Words, pieces, words_of

SHINGLE = 5
THRESHOLD = 0.8
BINS = 64
FEW = 3


def bin_minima(hashes: np.ndarray, bits: int) -> np.ndarray:
    """The least of the sorted distinct hashes in each of 2**bits bins by leading bits."""
    bins = hashes >> U(64 - bits)
    return hashes[np.concatenate(([True], bins[1:] != bins[:-1]))] if len(hashes) else hashes


def size_bits(n: int) -> int:
    """Bits of bins for a document of n shingles: BINS times the next power of two."""
    return min(60, max(1, n - 1).bit_length() + BINS.bit_length() - 1)


class Items:
    """The test items of one block, with their signatures for every partition."""

    def __init__(self, rows: list[tuple[int, str]], size: int):
        self.size, self.ids, self.shingles, sets = size, [], [], []
        self.short: set[int] = set()
        for item, text in rows:
            words = _words(text)
            if not words:
                continue
            self.ids.append(item)
            self.shingles.append(shingles(words, size))
            if len(words) < size:
                self.short.add(len(words))
            _, tokens = next(iter(words_of(pa.array([text]), lower=True)))
            sets.append(np.unique(tokens.grams(size)[0]))
        self.sets, self.by_bits = sets, {}
        few = [(s, i) for i, s in enumerate(sets) if len(s) <= FEW]
        self.few = np.unique(np.concatenate([s for s, _ in few])) if few else np.zeros(0, np.uint64)

    def signatures(self, bits: int) -> tuple[np.ndarray, np.ndarray]:
        """All items' sorted signatures in the partition of these bits, and their owners; made
        when the first document of the partition comes."""
        if bits not in self.by_bits:
            keys = [s if len(s) <= FEW else bin_minima(s, bits) for s in self.sets]
            flat = np.concatenate(keys)
            order = np.argsort(flat, kind="stable")
            self.by_bits[bits] = flat[order], np.repeat(np.arange(len(keys)), [len(k) for k in keys])[order]
        return self.by_bits[bits]

    def candidates(self, hashes: np.ndarray) -> set[int]:
        """Items that share a bin's least hash with a document of these distinct sorted hashes."""
        if not len(hashes):
            return set()
        bits = size_bits(len(hashes))
        keys, owner = self.signatures(bits)
        own = bin_minima(hashes, bits)
        if len(self.few):
            own = np.union1d(own, hashes[_among(hashes, self.few)])
        shared = own[_among(own, keys)]
        spans = zip(np.searchsorted(keys, shared), np.searchsorted(keys, shared, side="right"), strict=True)
        return {int(j) for low, high in spans for j in owner[low:high]}


#: The block of items that this Python worker has indexed last, for its next tasks.
_LAST: dict[str, Items] = {}


def indexed(name: str, shared, size: int) -> Items:
    """The index of a broadcast block, made once in a worker; one block is held at a time."""
    if name not in _LAST:
        _LAST.clear()
        _LAST[name] = Items(shared.value, size)
    return _LAST[name]


def _among(values: np.ndarray, keys: np.ndarray) -> np.ndarray:
    at = np.minimum(np.searchsorted(keys, values), len(keys) - 1)
    return keys[at] == values


def _words(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "surrogatepass").lower().split()


def shingles(words: list[bytes], size: int) -> set[tuple[bytes, ...]]:
    """Distinct runs of `size` words; all words where there are fewer; none without words."""
    if not words:
        return set()
    return {tuple(words[i : i + size]) for i in range(max(1, len(words) - size + 1))}


def item_blocks(benchmark: DataFrame, block: int) -> Iterator[list[tuple[int, str]]]:
    """The distinct items in lists of about `block`, each collected by itself."""
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").alias("__text")).filter(F.col("__text").isNotNull()).distinct()
    blocks = max(1, -(-items.count() // block))
    for i in range(blocks):
        part = items.filter(F.pmod(F.xxhash64("item_id", "__text"), F.lit(blocks)) == i)
        rows = [(r["item_id"], r["__text"]) for r in part.collect()]
        yield sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, r[1]))


def leaks(
    docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
    threshold: float = THRESHOLD, size: int = SHINGLE, block: int = 20_000,
) -> DataFrame:
    """(doc_id, item_id, n_shingles, containment) for each item that a document contains."""
    kind = docs.schema[id_col].dataType.simpleString()
    schema = f"`{id_col}` {kind}, item_id bigint, n_shingles bigint, containment double"
    found = None
    for rows in item_blocks(benchmark, block):
        shared, name = docs.sparkSession.sparkContext.broadcast(rows), uuid.uuid4().hex

        def search(batches: Iterator[pa.RecordBatch], shared=shared, name=name) -> Iterator[pa.RecordBatch]:
            index = indexed(name, shared, size)
            for batch in batches:
                hits = list(_hits(batch.column(1), index, threshold))
                row, item, total, share = zip(*hits, strict=True) if hits else ((), (), (), ())
                ids = batch.column(0).take(pa.array(row, pa.int64()))
                numbers = [pa.array(item, pa.int64()), pa.array(total, pa.int64()), pa.array(share, pa.float64())]
                yield pa.RecordBatch.from_arrays([ids, *numbers], names=[id_col, "item_id", "n_shingles", "containment"])

        hits = docs.select(id_col, F.col(text_col).cast("string").alias("__text")).mapInArrow(search, schema)
        found = hits if found is None else found.unionByName(hits)
    return found


def clean(
    docs: DataFrame, benchmark: DataFrame, text_col: str = "text",
    threshold: float = THRESHOLD, size: int = SHINGLE, block: int = 20_000,
) -> DataFrame:
    """docs without the rows whose text contains an item; decided in place, without a join."""
    place = docs.columns.index(text_col)
    for rows in item_blocks(benchmark, block):
        shared, name = docs.sparkSession.sparkContext.broadcast(rows), uuid.uuid4().hex

        def keep(batches: Iterator[pa.RecordBatch], shared=shared, name=name) -> Iterator[pa.RecordBatch]:
            index = indexed(name, shared, size)
            for batch in batches:
                good = np.ones(batch.num_rows, dtype=bool)
                good[[hit[0] for hit in _hits(batch.column(place), index, threshold)]] = False
                yield batch.filter(pa.array(good))

        docs = docs.mapInArrow(keep, docs.schema)
    return docs


def _hits(texts: pa.Array, index: Items, threshold: float) -> Iterator[tuple[int, int, int, float]]:
    """(row, item, the item's shingles, containment) for the items that the texts contain."""
    if not index.ids:
        return
    for start, data, offsets in pieces(texts):
        tokens = Words(data, offsets, lower=True)
        hashes, at = tokens.grams(index.size)
        short = [tokens.grams(n) for n in index.short]
        for i in range(len(tokens)):
            near = set()
            for h, first in [(hashes, at), *short]:
                near |= index.candidates(np.unique(h[first[i] : first[i + 1]]))
            if near:
                words, runs = bytes(tokens.data[offsets[i] : offsets[i + 1]]).split(), {}
                for j in sorted(near):
                    wanted = index.shingles[j]
                    n = len(next(iter(wanted)))
                    if n not in runs:
                        runs[n] = shingles(words, n)
                    share = len(wanted & runs[n]) / len(wanted)
                    if share >= threshold:
                        yield start + i, index.ids[j], len(wanted), share
