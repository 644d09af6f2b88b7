"""Removal of repeated word windows, exact, behind a count-min prefilter.

Three passes over documents in blocks (about 2 MB of text, dealt by hash):

1. Each block sends, per shard of the hash space, a partial count-min sketch of its windows:
   two rows of cell numbers, compressed as gaps and offsets, with a mark for windows that
   the block itself repeats. A shard sums the partial sketches of all blocks and answers
   each with one bit per window: both cells have a count of two or more. Counts are never
   underestimated, so no repeated window is lost.
2. Blocks send the 128-bit hashes of the windows so marked, and only those, to be grouped
   exactly by shard; the answer is again a bit per window.
3. Blocks remove the words that repeated windows cover.

The numbers of shards and blocks grow with the table, and so do their sizes with its square
root, so that the rows which they exchange grow with the table and not with its square. A
window that occurs a million times costs its shard one entry a block. The sketch's two rows
share the upper bits of their cells (all but LOW_BITS), which makes the second one cheap to
send; inside 2**LOW_BITS cells they are independent. Collisions only send more windows to
the exact pass.

Defined results: null and empty texts have no words; a text of fewer words than a window keeps
all; windows overlap freely and may repeat within one text; what is left is joined by single
spaces; repeated rows (equal id and text) repeat each other's windows and lose their words.
Windows are equal if their words' 128-bit hashes are. Other columns are not read.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from helixmill.llm.shared import U, blocked, grown, mix, words_of

WINDOW = 35
BLOCK_BYTES = 2 << 20
#: Windows per shard that are aimed at, and cells in each of the sketch's two rows.
SHARD_WINDOWS, CELL_BITS = 1 << 20, 24
#: Cells of a sketch row at most (large shards have fewer cells a window).
MOST_CELL_BITS = 28
#: The second row's cell differs from the first's in its low bits only.
LOW_BITS = 16


def window_hashes(tokens, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Two 64-bit hashes of each window and the place of its first word."""
    counts = np.maximum(np.diff(tokens.first) - length + 1, 0)
    offsets = np.cumsum(counts) - counts
    start = np.repeat(tokens.first[:-1] - offsets, counts) + np.arange(int(counts.sum()))
    if not len(start):
        return np.zeros(0, np.uint64), np.zeros(0, np.uint64), start
    pair = []
    for words, step in ((tokens.hashes, 0x9E3779B97F4A7C15), (mix(tokens.hashes + U(7)), 0xC2B2AE3D27D4EB4F)):
        # Doubling: a hash of the first 2, 4, 8, ... words, put together to `length` words.
        total, power, have = np.zeros(len(words), np.uint64), words.copy(), 1
        left, done = length, 0
        weight = step
        while left:
            if left & 1:
                total[: len(words) - done] = total[: len(words) - done] * U(weight) + power[done:]
                done += have
            left >>= 1
            if left:
                longer = power.copy()
                longer[: len(words) - have] = power[: len(words) - have] * U(weight) + power[have:]
                power, have, weight = longer, have * 2, (weight * weight) % 2**64
        pair.append(mix(total[start]))
    return pair[0], pair[1], start


class Block:
    """The windows of one block's documents."""

    def __init__(self, group: pa.Table, length: int):
        self.number = group.column("__block")[0].as_py()
        #: Per run of rows: tokens, hashes, second hashes, first words.
        self.runs = [(t, *window_hashes(t, length)) for _, t in words_of(group.column("__text"), limit=1 << 19)]
        every = np.concatenate([r[1] for r in self.runs])
        every.sort()
        at = np.flatnonzero(_news(every))
        self.hashes, self.twice = every[at], np.diff(np.append(at, len(every))) > 1

    def suspects(self, keep: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Sorted distinct (hash, second hash) of windows whose hash is in keep; repeated here?"""
        parts = []
        for _, h, g, _ in self.runs:
            here = _in(h, keep)
            part = np.empty(int(here.sum()), _PAIR)
            part["h"], part["g"] = h[here], g[here]
            parts.append(part)
        every = np.concatenate(parts)
        every = every[np.lexsort((every["g"], every["h"]))]
        at = np.flatnonzero(_news(every))
        return every[at], np.diff(np.append(at, len(every))) > 1


_PAIR = np.dtype([("h", np.uint64), ("g", np.uint64)])


def _news(ordered: np.ndarray) -> np.ndarray:
    new = np.ones(len(ordered), bool)
    new[1:] = ordered[1:] != ordered[:-1]
    return new


def _in(values: np.ndarray, keys: np.ndarray) -> np.ndarray:
    if not len(keys):
        return np.zeros(len(values), bool)
    return keys[np.minimum(np.searchsorted(keys, values), len(keys) - 1)] == values


def _pair_in(pairs: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Whether each pair is among the sorted keys; equal first hashes are looked at in turn."""
    at = np.searchsorted(keys["h"], pairs["h"])
    found = np.zeros(len(pairs), bool)
    while len(keys):
        live = np.minimum(at, len(keys) - 1)
        same = (at < len(keys)) & (keys["h"][live] == pairs["h"]) & ~found
        found |= same & (keys["g"][live] == pairs["g"])
        if not (same & ~found).any():
            break
        at = np.where(same & ~found, at + 1, len(keys))
    return found


def _cells(h: np.ndarray, shard_bits: int, cell_bits: int) -> tuple[np.ndarray, np.ndarray]:
    first = ((h << U(shard_bits)) >> U(64 - cell_bits)).astype(np.int64)
    return first, (first >> LOW_BITS << LOW_BITS) | (h & U(2**LOW_BITS - 1)).astype(np.int64)


def _spans(h: np.ndarray, shard_bits: int) -> list[tuple[int, int, int]]:
    """(shard, begin, end) of the runs of sorted hashes that share their leading bits."""
    shard = (h >> U(64 - shard_bits)).astype(np.int64) if shard_bits else np.zeros(len(h), np.int64)
    at = np.flatnonzero(_news(shard))
    return [] if not len(h) else [(int(shard[a]), int(a), int(b)) for a, b in zip(at, np.append(at[1:], len(h)), strict=True)]


def _bits(mask: np.ndarray) -> bytes:
    return np.packbits(mask).tobytes()


def _mask(raw: bytes, n: int) -> np.ndarray:
    return np.unpackbits(np.frombuffer(raw, np.uint8), count=n).astype(bool)


_SKETCH = "__block int, __shard int, __n int, __gaps binary, __low binary, __twice binary"
_ANSWER = "__block int, __shard int, __n int, __bits binary"


def _sketches(shard_bits: int, cell_bits: int, length: int):
    def send(group: pa.Table) -> pa.Table:
        block = Block(group, length)
        rows = []
        for shard, a, b in _spans(block.hashes, shard_bits):
            first, second = _cells(block.hashes[a:b], shard_bits, cell_bits)
            gaps = np.diff(first, prepend=0)
            kind = np.uint16 if gaps.max() < 2**16 else np.uint32
            low = (second & (2**LOW_BITS - 1)).astype(np.uint16)
            rows.append((block.number, shard, b - a, gaps.astype(kind).tobytes(), low.tobytes(), _bits(block.twice[a:b])))
        return _table(rows, _SKETCH)

    return send


def _merge_sketches(cell_bits: int):
    def merge(group: pa.Table) -> pa.Table:
        """Sums the partial sketches of a shard; answers each block which windows may repeat."""
        rows = group.sort_by("__block").to_pylist()
        one, two = np.zeros(2**cell_bits, np.uint8), np.zeros(2**cell_bits, np.uint8)

        def cells(r):
            width = np.uint16 if len(r["__gaps"]) == 2 * r["__n"] else np.uint32
            first = np.cumsum(np.frombuffer(r["__gaps"], width).astype(np.int64))
            return first, (first >> LOW_BITS << LOW_BITS) | np.frombuffer(r["__low"], np.uint16)

        for r in rows:
            first, second = cells(r)
            step = _mask(r["__twice"], r["__n"]).astype(np.uint8) + np.uint8(1)
            for counts, at in ((one, first), (two, second)):
                np.add.at(counts, at, step)
                counts[at] = np.minimum(counts[at], 2)
        out = []
        for r in rows:
            first, second = cells(r)
            out.append((r["__block"], r["__shard"], r["__n"], _bits((one[first] > 1) & (two[second] > 1))))
        return _table(out, _ANSWER)

    return merge


def _marked(answers: pa.Table, stage: int, h: np.ndarray, shard_bits: int) -> np.ndarray:
    """Per sorted hash whether its shard answered in this stage that it repeats."""
    said = {r["__shard"]: r["__bits"] for r in answers.to_pylist() if r["__stage"] == stage}
    mask = np.zeros(len(h), dtype=bool)
    for shard, a, b in _spans(h, shard_bits):
        mask[a:b] = _mask(said[shard], b - a)
    return mask


_EXACT = "__block int, __shard int, __n int, __keys binary, __twice binary"


def _exact(shard_bits: int, length: int):
    def send(group: pa.Table, answers: pa.Table) -> pa.Table:
        if not group.num_rows:
            return _table([], _EXACT)
        block = Block(group, length)
        keys, twice = block.suspects(block.hashes[_marked(answers, 1, block.hashes, shard_bits)])
        spans = _spans(keys["h"], shard_bits)
        return _table([(block.number, s, b - a, keys[a:b].tobytes(), _bits(twice[a:b])) for s, a, b in spans], _EXACT)

    return send


def _merge_exact(group: pa.Table) -> pa.Table:
    """Counts the windows of a shard over all blocks; answers each block which do repeat."""
    rows = group.sort_by("__block").to_pylist()
    keys = np.concatenate([np.frombuffer(r["__keys"], _PAIR) for r in rows])
    twice = np.concatenate([_mask(r["__twice"], r["__n"]) for r in rows])
    order = np.lexsort((keys["g"], keys["h"]))
    number = np.cumsum(_news(keys[order])) - 1
    total = np.bincount(number, weights=1.0 + twice[order])
    repeated = np.empty(len(keys), bool)
    repeated[order] = (total > 1)[number]
    ends = np.cumsum([r["__n"] for r in rows])
    out = [(r["__block"], r["__shard"], r["__n"], _bits(repeated[e - r["__n"] : e])) for r, e in zip(rows, ends, strict=True)]
    return _table(out, _ANSWER)


def _removal(shard_bits: int, length: int, kind: pa.DataType, with_text: bool):
    names = ["doc_id", "n_words", "n_removed", "kept"]
    kinds = [kind, pa.int64(), pa.int64(), pa.string()]

    def remove(group: pa.Table, answers: pa.Table) -> pa.Table:
        total, removed, kept = [], [], []
        if not group.num_rows:
            return pa.table([pa.array([], k) for k in kinds], names=names)
        block = Block(group, length)
        keys, _ = block.suspects(block.hashes[_marked(answers, 1, block.hashes, shard_bits)])
        sure = keys[_marked(answers, 2, keys["h"], shard_bits)]
        for tokens, h, g, start in block.runs:
            here = np.flatnonzero(_in(h, sure["h"]))
            pairs = np.empty(len(here), _PAIR)
            pairs["h"], pairs["g"] = h[here], g[here]
            here = start[here[_pair_in(pairs, sure)]]
            edges = np.zeros(len(tokens.hashes) + 1, np.int64)
            np.add.at(edges, here, 1)
            np.add.at(edges, here + length, -1)
            left = np.cumsum(edges[:-1]) == 0
            raw, first = tokens.data.tobytes(), tokens.first
            for a, b in zip(first[:-1].tolist(), first[1:].tolist(), strict=True):
                at = a + np.flatnonzero(left[a:b])
                words = [raw[s:e] for s, e in zip(tokens.starts[at].tolist(), tokens.ends[at].tolist(), strict=True)]
                text = b" ".join(words)
                total.append(b - a)
                removed.append(b - a - len(words))
                kept.append(text.decode("utf-8", "replace") if with_text else hashlib.sha256(text).hexdigest())
        ids = group.column("__id").combine_chunks()
        return pa.table([ids, *[pa.array(x, k) for x, k in zip((total, removed, kept), kinds[1:], strict=True)]], names=names)

    return remove


_TYPES = {"int": pa.int32(), "binary": pa.binary()}


def _table(rows: list[tuple], schema: str) -> pa.Table:
    fields = [x.split() for x in schema.split(", ")]
    columns = zip(*rows, strict=True) if rows else [[] for _ in fields]
    return pa.table({name: pa.array(list(c), _TYPES[t]) for (name, t), c in zip(fields, columns, strict=True)})


def shards_for(total: int) -> tuple[int, int]:
    """Bits of the shards' number and of a sketch row's cells for a table of `total` bytes.

    A word takes at least two bytes with its separator; six are usual. A shard is as large as
    three blocks, if that is more than SHARD_WINDOWS.
    """
    aim = max(SHARD_WINDOWS, 3 * grown(BLOCK_BYTES, total) // 6)
    shard_bits = max(0, (max(1, total // 6) - 1).bit_length() - aim.bit_length() + 1)
    return shard_bits, min(max(CELL_BITS, MOST_CELL_BITS), CELL_BITS + aim.bit_length() - SHARD_WINDOWS.bit_length())


def without_repeats(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW, with_text: bool = True
) -> DataFrame:
    """(id, n_words, n_removed, kept) per row: kept is the text left, or its SHA-256."""
    blocks, total = blocked(docs, id_col, text_col, BLOCK_BYTES)
    shard_bits, cell_bits = shards_for(total)
    sketches = blocks.groupBy("__block").applyInArrow(_sketches(shard_bits, cell_bits, window), _SKETCH)
    maybe = sketches.groupBy("__shard").applyInArrow(_merge_sketches(cell_bits), _ANSWER)
    first = maybe.withColumn("__stage", F.lit(1))
    suspects = blocks.groupBy("__block").cogroup(first.groupBy("__block")).applyInArrow(_exact(shard_bits, window), _EXACT)
    second = suspects.groupBy("__shard").applyInArrow(_merge_exact, _ANSWER).withColumn("__stage", F.lit(2))
    answers = first.unionByName(second)
    kind = docs.schema[id_col].dataType
    remove = _removal(shard_bits, window, to_arrow_type(kind), with_text)
    out = blocks.groupBy("__block").cogroup(answers.groupBy("__block")).applyInArrow(
        remove, f"doc_id {kind.simpleString()}, n_words bigint, n_removed bigint, kept string"
    )
    return out.withColumnRenamed("doc_id", id_col)
