"""Toxicity by compression distance: two zstandard dictionaries, one for each kind of text.

A window (a few consecutive words) is compressed twice, with a dictionary of toxic text and
with one of ordinary text. The two lengths, each less that of an empty window, are its place
on a small grid. Calibration texts, which neither dictionary has seen, say how much likelier
each place is in toxic texts; those log-odds are the thresholds. A text's highest window then
goes through a logistic curve fitted on the same texts.

Training takes a bounded sample of labelled rows to the driver: at most `max_per_class` labels
of each class, chosen by hash, of these texts of at most `max_text` bytes, and of these the
first by hash up to `max_bytes` in all. The dictionaries hold at most TOXIC_BYTES and
ORDINARY_BYTES. The classes' shares are counted over all usable labels, and the curve's
intercept is set back from the sample's shares to those, so that scores mean the same at every
size of the table. Scoring reads every window of every text and shuffles nothing.

Windows are one word long by default. Insults are words; in longer windows the lengths' noise
(a byte or two for each word, by chance matches) drowns a single word's difference.

Defined results: a null or empty text has one empty window and gets a score; texts of any
length are scored whole; equal texts have equal scores; without labelled rows of both classes
every score is the share of toxic rows (0.5 without any label) and the model isn't `trained`.
Null ids are scored too and are never used for training; a doc_id with several labels is toxic
if any says so. Other columns pass through `score`; its column takes the place of an equal one.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import zstandard
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Follows every window: zstandard looks for no match in a block's last bytes.
TAIL = b" . . . . . . . . "
TOP = 15
#: Bytes of the two dictionaries at most.
TOXIC_BYTES, ORDINARY_BYTES = 6000, 8192
#: A task forgets the windows that it has measured beyond this number.
REMEMBERED = 400_000


def windows(text: str | None, words: int) -> set[str]:
    """The distinct windows of a text: runs of `words` words, lower-cased, without overlap."""
    tokens = (text or "").lower().split()
    if words == 1:
        return set(tokens) or {""}
    return {" ".join(tokens[i : i + words]) for i in range(0, len(tokens), words)} or {""}


def compressor(content: bytes) -> zstandard.ZstdCompressor:
    """Compresses with a dictionary of this content; frames carry no header fields."""
    content = content + TAIL
    held = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
    how = zstandard.ZstdCompressionParameters(
        window_log=14, chain_log=11, hash_log=11, search_log=4, min_match=4, target_length=16,
        strategy=zstandard.STRATEGY_LAZY2, write_content_size=False, write_checksum=False,
        write_dict_id=False, format=zstandard.FORMAT_ZSTD1_MAGICLESS,
    )
    held.precompute_compress(compression_params=how)
    return zstandard.ZstdCompressor(dict_data=held, compression_params=how)


@dataclass
class Model:
    """The dictionaries, the log-odds of each place on the grid, and the logistic curve."""

    toxic: bytes = b""
    ordinary: bytes = b""
    odds: dict[tuple[int, int], float] = field(default_factory=dict)
    slope: float = 0.0
    intercept: float = 0.0
    words: int = 1

    @property
    def trained(self) -> bool:
        """Whether there were texts of both classes to learn from."""
        return bool(self.odds)

    def scorer(self):
        """A function from texts to scores that remembers the windows it has measured."""
        toxic, ordinary = compressor(self.toxic), compressor(self.ordinary)
        empty = len(toxic.compress(b" " + TAIL)), len(ordinary.compress(b" " + TAIL))
        known: dict[str, tuple[int, int]] = {}

        def place(window: str) -> tuple[int, int]:
            raw = f" {window} ".encode("utf-8", "surrogatepass") + TAIL
            a = len(toxic.compress(raw)) - empty[0]
            b = len(ordinary.compress(raw)) - empty[1]
            return min(TOP, max(0, a)), min(TOP, max(0, b))

        def places(text: str | None) -> set[tuple[int, int]]:
            found = set()
            for window in windows(text, self.words):
                if (at := known.get(window)) is None:
                    if len(known) >= REMEMBERED:
                        known.clear()
                    at = known[window] = place(window)
                found.add(at)
            return found

        return places

    def raw(self, places: set[tuple[int, int]]) -> float:
        return max((self.odds.get(x, 0.0) for x in places), default=0.0)

    def score(self, places: set[tuple[int, int]]) -> float:
        z = self.slope * self.raw(places) + self.intercept
        return 1 / (1 + math.exp(-min(50.0, max(-50.0, z))))


def contexts(texts: list[str], words: int) -> Counter:
    """In how many settings each window occurs: distinct windows that stand before it.

    Copies of a text, near or exact, add no setting, so that what they share counts little.
    """
    pairs = set()
    for text in texts:
        tokens = text.lower().split()
        runs = [" ".join(tokens[i : i + words]) for i in range(0, len(tokens), words)]
        pairs.update(zip(["", *runs], runs, strict=False))
    return Counter(w for _, w in pairs)


def dictionary(texts: list[str], others: list[str], words: int, size: int, least: float, ratio: float) -> bytes:
    """Content for a dictionary: windows in many settings that are far rarer in the others.

    The likeliest windows stand last, where matches cost least.
    """
    own, other = contexts(texts, words), contexts(others, words)
    floor = max(2, math.ceil(least * len(texts)))
    total, rest = sum(own.values()), max(1, sum(other.values()))
    kept = [w for w, n in own.items() if n >= floor and n / total >= ratio * other[w] / rest]
    content = b""
    for w in sorted(kept, key=lambda w: (-own[w], w)):
        piece = f" {w}".encode("utf-8", "surrogatepass")
        if len(content) + len(piece) > size:
            break
        content = piece + content
    return content + b" "


def odds(one: int, ones: int, nil: int, nils: int) -> float:
    """Log-odds of a place seen in `one` of the toxic and `nil` of the other texts, less one
    standard error, so that places seen a few times only don't decide."""
    value = math.log((one + 0.5) / (ones + 1)) - math.log((nil + 0.5) / (nils + 1))
    return value - math.sqrt(1 / (one + 0.5) + 1 / (nil + 0.5))


def train(rows: list[tuple[str, int]], words: int = 1, toxic_share: float | None = None) -> Model:
    """A model from (text, label) rows; two of three rows make the dictionaries, one calibrates.

    toxic_share is that of the whole table where the rows are a sample with other shares.
    """
    toxic = sorted({t for t, y in rows if y == 1})
    ordinary = sorted({t for t, y in rows if y != 1})
    share = (sum(y == 1 for _, y in rows) + 0.5) / (len(rows) + 1) if toxic_share is None else toxic_share
    prior = math.log(share / (1 - share))
    if not toxic or not ordinary:
        return Model(intercept=prior, words=words)
    part = lambda x: ([t for i, t in enumerate(x) if i % 3], [t for i, t in enumerate(x) if i % 3 == 0])
    (toxic_fit, toxic_held), (ordinary_fit, ordinary_held) = part(toxic), part(ordinary)
    model = Model(
        dictionary(toxic_fit, ordinary_fit, words, TOXIC_BYTES, 0.02, 10),
        dictionary(ordinary_fit, toxic_fit, words, ORDINARY_BYTES, 0.01, 0),
        words=words,
    )
    places = model.scorer()
    one, nil = [places(t) for t in toxic_held], [places(t) for t in ordinary_held]
    n_one, n_nil = Counter(x for p in one for x in p), Counter(x for p in nil for x in p)
    model.odds = {x: odds(n_one[x], len(one), n_nil[x], len(nil)) for x in {*n_one, *n_nil}}
    x = np.array([model.raw(p) for p in one + nil])
    y = np.array([1.0] * len(one) + [0.0] * len(nil))
    a = np.column_stack([x, np.ones(len(x))])
    weights = np.array([0.0, prior])
    for _ in range(50):  # Newton's method with a small ridge
        p = 1 / (1 + np.exp(-np.clip(a @ weights, -30, 30)))
        grad = a.T @ (p - y) + 1e-2 * weights * [1, 0]
        hess = (a * (p * (1 - p) + 1e-9)[:, None]).T @ a + 1e-2 * np.diag([1, 1e-6])
        step = np.linalg.solve(hess, grad)
        weights = weights - step
        if np.abs(step).max() < 1e-8:
            break
    shift = prior - math.log(len(one) / len(nil))  # from the calibration texts' shares to the table's
    model.slope, model.intercept = float(max(0.0, weights[0])), float(weights[1]) + shift
    return model


def fit(
    docs: DataFrame, labels: DataFrame, usable: Column, words: int = 1, max_per_class: int = 3000,
    max_text: int = 1 << 20, max_bytes: int = 64 << 20,
) -> Model:
    """Trains on labelled rows for which `usable`, an expression on doc_id, holds.

    The sample is the lowest by a hash of doc_id (see above for its bounds); its ids, at most
    twice max_per_class, are broadcast to fetch the texts.
    """
    known = (
        labels.filter(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull() & usable)
        .groupBy("doc_id")
        .agg(F.max("toxic").alias("__toxic"))
    )
    toxic = F.coalesce(F.sum((F.col("__toxic") == 1).cast("long")), F.lit(0))
    counts = known.agg(toxic.alias("toxic"), F.count("*").alias("n")).first()
    order = F.xxhash64(F.lit(11), "doc_id")
    ids = None
    for value in (F.col("__toxic") == 1, F.col("__toxic") != 1):
        part = known.filter(value).orderBy(order, "doc_id").limit(max_per_class)
        ids = part if ids is None else ids.unionByName(part)
    size = F.octet_length("__text")
    so_far = Window.partitionBy(F.col("__toxic") == 1).orderBy(order, "doc_id", "__text")
    rows = (
        docs.select(F.col("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("__text"))
        .filter(size <= max_text)
        .join(F.broadcast(ids), "doc_id")
        .dropDuplicates(["doc_id", "__text"])
        .withColumn("__sum", F.sum(size).over(so_far))
        .filter(F.col("__sum") <= max_bytes // 2)
        .orderBy(order, "doc_id", "__text")
        .collect()
    )
    share = (counts["toxic"] + 0.5) / (counts["n"] + 1)
    return train([(r["__text"], int(r["__toxic"] == 1)) for r in rows], words, share)


def score(docs: DataFrame, model: Model, text_col: str = "text", out: str = "score") -> DataFrame:
    """docs with a double column `out`: 0 to 1, higher for likelier toxic."""

    @F.pandas_udf("double")
    def scored(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        places = model.scorer()
        for texts in batches:
            yield pd.Series([model.score(places(t)) for t in texts], dtype="float64")

    return docs.withColumn(out, scored(F.col(text_col).cast("string")))
