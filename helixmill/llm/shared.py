"""Helpers that several corpus operators share: word hashes, blocks of documents."""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from helixmill.operators.tables import ranked, shared_dir, written

__all__ = ["SEPARATORS", "U", "WORD", "Words", "blocked", "grown", "mix", "pieces", "ranked", "shared_dir", "unused", "words_of", "written"]

#: The bytes that separate words: space and 0x09 to 0x0D.
SEPARATORS = np.zeros(256, dtype=bool)
SEPARATORS[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
#: The same rule as a regular expression for Spark and DuckDB.
WORD = r"[^\x20\x09-\x0D]+"

U = np.uint64
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_BASE = 0x9E3779B97F4A7C15


def unused(columns: list[str], name: str) -> str:
    """The name, with underscores behind it until no column has it (Spark ignores case)."""
    taken = {c.lower() for c in columns}
    while name.lower() in taken:
        name += "_"
    return name


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit numbers (the splitmix64 finaliser)."""
    x = x ^ (x >> U(30))
    x *= U(0xBF58476D1CE4E5B9)
    x ^= x >> U(27)
    x *= U(0x94D049BB133111EB)
    x ^= x >> U(31)
    return x


class Words:
    """The words of some texts: hashes, byte spans, and where each text's words begin."""

    __slots__ = ("data", "ends", "first", "hashes", "offsets", "starts")

    def __init__(self, data: np.ndarray, offsets: np.ndarray, lower: bool = False, seed: int = 0):
        data = _LOWER[data] if lower else data
        n = len(data)
        inside = ~SEPARATORS[data]
        edges = offsets[1:-1]
        edges = edges[(edges > 0) & (edges < n)]
        before = np.zeros(n, dtype=bool)
        before[1:] = inside[:-1]
        before[edges] = False
        after = np.zeros(n, dtype=bool)
        after[:-1] = inside[1:]
        after[edges - 1] = False
        self.starts = np.flatnonzero(inside & ~before)
        self.ends = np.flatnonzero(inside & ~after) + 1
        self.data, self.offsets = data, offsets
        self.first = np.searchsorted(self.starts, offsets)
        self.hashes = self._hash(seed)

    def _hash(self, seed: int) -> np.ndarray:
        lengths = self.ends - self.starts
        if not len(lengths):
            return np.zeros(0, dtype=np.uint64)
        powers = np.full(int(lengths.max()) + 1, _BASE | 1, dtype=np.uint64)
        powers[0] = 1
        powers = np.multiply.accumulate(powers)
        total = int(lengths.sum())
        begin = np.cumsum(lengths) - lengths
        index = np.arange(total) - np.repeat(begin, lengths)
        place = index + np.repeat(self.starts, lengths)
        terms = (self.data[place].astype(np.uint64) + U(1)) * powers[index]
        sums = np.add.reduceat(terms, begin)
        return mix(sums + lengths.astype(np.uint64) * U(0xD6E8FEB86659FD93) + U(seed))

    def __len__(self) -> int:
        return len(self.offsets) - 1

    def grams(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        """Hashes of all runs of n words inside one text, and the offset of each text's runs.

        A text with 1 to n-1 words has one run, all its words; an empty text has none.
        """
        counts = np.diff(self.first)
        runs = np.where(counts >= n, counts - n + 1, np.minimum(counts, 1))
        offsets = np.concatenate(([0], np.cumsum(runs)))
        at = np.repeat(self.first[:-1] - offsets[:-1], runs) + np.arange(offsets[-1])
        last = np.repeat(self.first[1:], runs) - 1
        out = np.zeros(len(at), dtype=np.uint64)
        for i in range(n):
            place = at + i
            here = place <= last
            step = self.hashes[np.minimum(place, len(self.hashes) - 1)] if len(self.hashes) else out
            out = np.where(here, mix(out * U(0x2545F4914F6CDD1D) + step + U(i + 1)), out)
        return out, offsets


def pieces(texts: pa.Array, limit: int = 1 << 20):
    """Yields (first row, bytes, offsets) for runs of rows of about limit bytes; null is empty."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    offsets = np.frombuffer(texts.buffers()[1], dtype=np.int64)[texts.offset : texts.offset + len(texts) + 1]
    buffer = texts.buffers()[2]
    data = np.frombuffer(buffer, dtype=np.uint8) if buffer is not None and buffer.size else np.zeros(0, np.uint8)
    row = 0
    while row < len(texts):
        end = max(row + 1, int(np.searchsorted(offsets, offsets[row] + limit, side="right")) - 1)
        yield row, data[offsets[row] : offsets[end]], offsets[row : end + 1] - offsets[row]
        row = end


def words_of(texts, lower: bool = False, limit: int = 1 << 20):
    """Yields (first row, Words) for runs of rows of a text column."""
    for row, data, offsets in pieces(texts, limit):
        yield row, Words(data, offsets, lower)


#: Bytes of text for each row that blocks and shards exchange, at least.
ROW_BYTES = 1536


def grown(block_bytes: int, total: int) -> int:
    """The bytes of a block for a table of `total` bytes."""
    return max(block_bytes, math.isqrt(total * ROW_BYTES))


def blocked(docs: DataFrame, id_col: str, text_col: str, block_bytes: int, *more: str) -> tuple[DataFrame, int]:
    """(__block, __id, __text, and more columns) of all rows, and the bytes of the texts.

    Rows are dealt evenly to blocks of about block_bytes, or more in large tables: blocks
    exchange rows with shards, and blocks that grow with the square root of the table keep the
    number of those rows in proportion to it (at 30 GB 7 MB a block, at 1 TB 39 MB, at 100 TB
    0.4 GB). The block comes from a hash of id and text alone, so that a lost task's rows return to
    the same blocks; the number of blocks grows with the table.
    """
    total = docs.agg(F.sum(F.octet_length(F.col(text_col).cast("string"))).alias("n")).first()["n"] or 0
    blocks = max(16, -(-int(total) // grown(block_bytes, int(total))))
    block = F.pmod(F.xxhash64(F.col(id_col), F.col(text_col)), F.lit(blocks)).cast("int")
    named = block.alias("__block"), F.col(id_col).alias("__id"), F.col(text_col).cast("string").alias("__text")
    return docs.select(*named, *more), int(total)
