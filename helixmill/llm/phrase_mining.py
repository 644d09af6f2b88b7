"""Phrase collocation mining by dynamic itemset counting.

Texts are cut into words once and written as blocks: the block's distinct words and its tokens
as numbers into them, with 0 between pieces that no phrase crosses. Blocks are dealt to a few
shards, and shards are scanned in a cycle, one a step. Words are counted in the first cycle.
A longer phrase becomes active at the step after both of its subphrases (all words but the
last, all but the first) reached the threshold, wherever in the cycle that is, and is counted
for one full cycle from there; so phrases of all lengths are counted side by side, and each
sees every shard once. The scans end when the last active phrase has its cycle behind it.
Every phrase that reaches the threshold has subphrases that do, so none is missed, and a full
cycle makes its count exact.

A scan emits the active phrases of a shard as tuples of word keys, Spark sums them, and each
step's sums are written. A phrase that reaches the threshold within a cycle of S steps has a
sum of at least threshold/S in one of them; only such phrases are added up between steps. The
reached phrases go to the tasks as arrays while a length has at most `held` of them. Beyond
that the scan emits all phrases of the next length, and a join of their sums with the reached
ones, which are a table, tells which are active: the same rows by a slower way.

Word keys are 64-bit hashes of language and word; all words are checked for equal keys, and
mining starts again with another seed if there are any, so counts are exact.

Defined results: a null text has no words; a null language is `und`; repeated rows count each;
languages without phrases have no rows; other columns are ignored; an empty table gives no
rows. Very long texts are one block. Scores are whole numbers from decimals, as products pass
64 bits.
"""

from __future__ import annotations

import itertools
import uuid
import zlib
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from helixmill.llm.shared import U, Words, mix, pieces, shared_dir
from helixmill.operators.tables import discarded

SHARDS = 4
#: Bytes of text a block is made from, about.
BLOCK = 1 << 22
#: Reached phrases of one length that tasks are given as arrays (42 bytes each).
HELD = 4_000_000
#: Hashes (8 bytes each), rows of fixed width (some numbers) and bytes of words up to which a
#: join's side is broadcast; larger ones are joined by a shuffle.
BROADCAST_HASHES = 2_000_000
BROADCAST_ROWS = 200_000
BROADCAST_BYTES = 1 << 26

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
#: 0: part of a word, 1: between words, 2: between pieces.
_KIND = np.zeros(256, dtype=np.uint8)
_KIND[[0x20, 0x09]] = 1
_KIND[[*b".,;:!?\n\x0b\x0c\r"]] = 2

KEYS = ("size", "a1", "a2", "a3", "a4")
LONGEST = 4
_BLOCKS = "lang string, shard int, total long, words array<string>, hashes array<long>, counts array<long>, tokens array<int>"
_GRAMS = "size byte, a1 long, a2 long, a3 long, a4 long, n long, step int"
_WORDS = "lang string, word string, a1 long, n long, step int"
_REACHED = "size byte, a1 long, a2 long, a3 long, a4 long, step int"


def tokens(data: np.ndarray, offsets: np.ndarray) -> tuple[pa.Array, np.ndarray]:
    """The distinct words of some texts, and all of their words as numbers from 1 with a 0
    between pieces."""
    data = _LOWER[data]
    kind = _KIND[data]
    inside = kind == 0
    n = len(data)
    edges = offsets[1:-1]
    edges = edges[(edges > 0) & (edges < n)]
    before, after = np.zeros(n, dtype=bool), np.zeros(n, dtype=bool)
    before[1:] = inside[:-1]
    before[edges] = False
    after[:-1] = inside[1:]
    after[edges - 1] = False
    starts = np.flatnonzero(inside & ~before)
    ends = np.flatnonzero(inside & ~after) + 1
    cuts = np.cumsum(kind == 2)[starts] + np.searchsorted(offsets, starts, side="right")
    lengths = np.concatenate(([0], np.cumsum(ends - starts)))
    words = pa.LargeStringArray.from_buffers(len(starts), pa.py_buffer(lengths.astype(np.int64)), pa.py_buffer(data[inside]))
    coded = words.dictionary_encode()
    new = np.concatenate(([0], np.cumsum(np.diff(cuts) != 0))) if len(starts) else np.zeros(0, np.int64)
    out = np.zeros(len(starts) + (int(new[-1]) if len(new) else 0), dtype=np.int32)
    out[np.arange(len(starts)) + new] = coded.indices.to_numpy(zero_copy_only=False) + 1
    return coded.dictionary, out


def word_keys(words: pa.Array, lang: str, seed: int) -> np.ndarray:
    data = np.frombuffer(" ".join(words.to_pylist()).encode(), dtype=np.uint8)
    start = zlib.crc32(lang.encode()) << 32 | zlib.crc32(lang.encode()[::-1] + b"%d" % seed)
    return mix(Words(data, np.array([0, len(data)])).hashes * U(0x9FB21C651E98DF25) + U(start)).astype(np.int64)


def _list(values, kind) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), pa.array(values, kind))


def _block(shards: int, seed: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard = TaskContext.get().partitionId()
        for batch in batches:
            for lang in pc.unique(batch["lang"]).to_pylist():
                texts = batch.filter(pc.equal(batch["lang"], lang))["text"]
                for _, data, offsets in pieces(texts, BLOCK):
                    words, numbers = tokens(data, offsets)
                    if not len(words):
                        continue
                    shard = (shard + 1) % shards
                    counts = np.bincount(numbers, minlength=len(words) + 1)[1:]
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array([lang]), pa.array([shard], pa.int32()), pa.array([int(counts.sum())]), _list(words.cast(pa.string()), pa.string()),
                            _list(word_keys(words, lang, seed), pa.int64()), _list(counts, pa.int64()), _list(numbers, pa.int32()),
                        ],
                        ["lang", "shard", "total", "words", "hashes", "counts", "tokens"],
                    )

    return run


class Reached:
    """Phrases of one length with the step that each reached the threshold at."""

    def __init__(self, keys: list[np.ndarray], steps: np.ndarray):
        self.keys, self.steps = keys, steps
        self.mask = (1 << max(4, (4 * len(steps)).bit_length())) - 1
        self.slots = np.full(self.mask + 1, -1, dtype=np.int32)
        place, todo = self._place(keys), np.arange(len(steps))
        while len(todo):
            free = todo[self.slots[place[todo]] < 0]
            self.slots[place[free]] = free
            todo = todo[self.slots[place[todo]] != todo]
            place[todo] = (place[todo] + 1) & self.mask

    def _place(self, keys: list[np.ndarray]) -> np.ndarray:
        h = keys[0].astype(np.uint64)
        for k in keys[1:]:
            h = mix(h * U(0x2545F4914F6CDD1D) + k.astype(np.uint64))
        return (h & U(self.mask)).astype(np.int64)

    def find(self, keys: list[np.ndarray]) -> np.ndarray:
        """The step of each phrase, -1 for those that aren't reached."""
        out = np.full(len(keys[0]), -1, dtype=np.int32)
        place, todo = self._place(keys), np.arange(len(out))
        while len(todo):
            at = self.slots[place[todo]]
            todo, at = todo[at >= 0], at[at >= 0]
            same = np.ones(len(todo), dtype=bool)
            for mine, asked in zip(self.keys, keys, strict=True):
                same &= mine[at] == asked[todo]
            out[todo[same]] = self.steps[at[same]]
            todo = todo[~same]
            place[todo] = (place[todo] + 1) & self.mask
        return out


def _scan(known, step: int, shards: int):
    """Emits the phrases of a shard that are active at the step. known: a broadcast list of
    (keys, steps) by length, or None for a length whose reached phrases are too many."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        levels = [x if x is None else Reached(*x) for x in known.value]
        for batch in batches:
            for hashes, numbers in zip(batch["hashes"], batch["tokens"], strict=True):
                keys = np.concatenate(([0], hashes.values.to_numpy()))
                at_words = numbers.values.to_numpy()
                key = keys[at_words]
                steps = np.full(len(keys), -1, dtype=np.int32)
                steps[1:] = 0 if levels[0] is None else levels[0].find([keys[1:]])
                steps = steps[at_words]
                at = np.flatnonzero(steps >= 0)
                steps = steps[at]
                for size in range(2, LONGEST + 1):
                    i = np.flatnonzero(np.diff(at) == 1)
                    at, begin = at[i], np.maximum(steps[i], steps[i + 1]) + 1
                    active = at if levels[size - 2] is None else at[(begin <= step) & (step < begin + shards)]
                    if len(active):
                        columns = [pa.array(key[active + j]) if j < size else pa.array(np.zeros(len(active), np.int64)) for j in range(LONGEST)]
                        yield pa.RecordBatch.from_arrays([pa.array(np.full(len(active), size, np.int8)), *columns], list(KEYS))
                    if size == LONGEST or not len(at):
                        break
                    if levels[size - 1] is None:
                        steps = np.zeros(len(at), dtype=np.int32)
                    else:
                        steps = levels[size - 1].find([key[at + j] for j in range(size)])
                        at, steps = at[steps >= 0], steps[steps >= 0]

    return run


def _active(sums: DataFrame, reached: DataFrame, step: int, shards: int) -> DataFrame:
    """The sums of phrases that are active at the step, by joins with both subphrases."""
    a = [F.col(f"a{i}") for i in range(1, LONGEST + 1)]
    zero = F.lit(0).cast("long")
    head = [F.when(F.col("size") > i + 1, a[i]).otherwise(zero) for i in range(LONGEST)]
    tail = [F.when(F.col("size") > i + 1, a[i + 1]).otherwise(zero) if i + 1 < LONGEST else zero for i in range(LONGEST)]
    named = lambda cols, x: [c.alias(f"{x}{i}") for i, c in enumerate(cols)]
    asked = sums.select("*", (F.col("size") - 1).cast("byte").alias("sub"), *named(head, "h"), *named(tail, "t"))
    side = lambda x: reached.select(F.col("size").alias("sub"), *named(a, x), F.col("step").alias(f"{x}_step"))
    both = asked.join(side("h"), ["sub", *[f"h{i}" for i in range(LONGEST)]]).join(side("t"), ["sub", *[f"t{i}" for i in range(LONGEST)]])
    begin = F.greatest("h_step", "t_step") + 1
    return both.filter((begin <= step) & (begin + shards > step)).select(*KEYS, "n")


def _small(df: DataFrame, most: int) -> DataFrame:
    """df, of fixed width, broadcast in a join if it has few rows."""
    return F.broadcast(df) if df.count() <= most else df


def _among(sums: DataFrame, wanted: DataFrame) -> DataFrame:
    """The rows of sums whose phrase is among the wanted, and maybe a few others with the hash of
    one: the caller's threshold leaves those out, as the wanted are all that can pass it."""
    hashes = wanted.select(F.xxhash64(*KEYS).alias("h")).distinct()
    return sums.withColumn("h", F.xxhash64(*KEYS)).join(_small(hashes, BROADCAST_HASHES), "h", "left_semi").drop("h")


class _Mine:
    """The tables of one run: blocks, the sums of each step, the reached phrases."""

    def __init__(self, spark: SparkSession, least: int, shards: int, held: int):
        self.spark, self.least, self.shards, self.held = spark, least, shards, held
        self.reset()

    def reset(self) -> None:
        self.root = f"{shared_dir(self.spark)}/phrases-{uuid.uuid4().hex}"
        self.known: list = [([np.zeros(0, np.int64)] * n, np.zeros(0, np.int32)) for n in range(1, LONGEST)]
        self.last = 0

    def table(self, name: str, schema: str, steps: range) -> DataFrame:
        folders = [f"{self.root}/{name}/step={t}" for t in steps]
        return self.spark.read.schema(schema).option("basePath", f"{self.root}/{name}").parquet(*folders)

    def save(self, df: DataFrame, name: str, step: int) -> None:
        df.write.parquet(f"{self.root}/{name}/step={step}")

    def blocks(self) -> DataFrame:
        return self.spark.read.schema(_BLOCKS).parquet(f"{self.root}/blocks")

    def words(self, steps: range) -> DataFrame:
        """The words' sums, as those of phrases of one word."""
        more = [F.lit(0).cast("long").alias(f"a{i}") for i in range(2, LONGEST + 1)]
        return self.table("words", _WORDS, steps).select("lang", "word", F.lit(1).cast("byte").alias("size"), "a1", *more, "n", "step")

    def step(self, t: int) -> None:
        """Scans shard t mod S, adds up what may have reached the threshold, and passes it on."""
        shard = self.blocks().filter(F.col("shard") == t % self.shards)
        sums, last = [], range(max(0, t - self.shards + 1), t + 1)
        if t < self.shards:
            each = shard.select("lang", F.explode(F.arrays_zip("words", "hashes", "counts")).alias("x"))
            words = each.groupBy("lang", F.col("x.words").alias("word"), F.col("x.hashes").alias("a1")).agg(F.sum("x.counts").alias("n"))
            self.save(words, "words", t)
            sums.append(self.words(last).drop("lang", "word"))
        if t:
            shipped = self.spark.sparkContext.broadcast(self.known)
            found = shard.select("hashes", "tokens").mapInArrow(_scan(shipped, t, self.shards), "size byte, a1 long, a2 long, a3 long, a4 long")
            grams = found.groupBy(*KEYS).agg(F.count("*").alias("n"))
            loose = [n + 1 for n, x in enumerate(self.known, 1) if x is None]
            if loose:
                reached = self.table("reached", _REACHED, range(0, t))
                grams = grams.filter(~F.col("size").isin(loose)).unionByName(_active(grams.filter(F.col("size").isin(loose)), reached, t, self.shards))
            self.save(grams, "grams", t)
            shipped.destroy()
            sums.append(self.table("grams", _GRAMS, range(max(1, last.start), t + 1)))
        many = [x.filter((F.col("step") == t) & (F.col("n") >= -(-self.least // self.shards))).select(*KEYS) for x in sums]
        self.save(reduce(DataFrame.unionByName, many), "often", t)
        self.save(self.newly(sums, last), "reached", t)
        self.learn(t)

    def newly(self, sums: list[DataFrame], last: range) -> DataFrame:
        """The phrases that reach the threshold at the last step. What was counted there had all
        of its cycle so far within the last S steps."""
        t = last.stop - 1
        often = self.table("often", _REACHED, last)
        recent = reduce(DataFrame.unionByName, [_among(x, often) for x in sums])
        now = F.coalesce(F.sum(F.when(F.col("step") == t, F.col("n"))), F.lit(0))
        both = recent.groupBy(*KEYS).agg(F.sum("n").alias("n"), now.alias("now"))
        return both.filter(f"n >= {self.least} AND now > 0 AND n - now < {self.least}").select(*KEYS)

    def learn(self, t: int) -> None:
        new = self.table("reached", _REACHED, range(t, t + 1))
        counts = {r["size"]: r["n"] for r in new.filter(F.col("size") < LONGEST).groupBy("size").agg(F.count("*").alias("n")).collect()}
        if counts:
            self.last = t
        for size, n in counts.items():
            if self.known[size - 1] is not None and len(self.known[size - 1][1]) + n > self.held:
                self.known[size - 1] = None
        wanted = [s for s in counts if self.known[s - 1] is not None]
        got = new.filter(F.col("size").isin(wanted)).select(*KEYS).toArrow() if wanted else None
        for size in wanted:
            rows = got.filter(pc.equal(got["size"], size))
            keys, steps = self.known[size - 1]
            more = [rows[f"a{i}"].to_numpy() for i in range(1, size + 1)]
            self.known[size - 1] = [np.concatenate(x) for x in zip(keys, more, strict=True)], np.concatenate((steps, np.full(rows.num_rows, t, np.int32)))

    def clash(self) -> bool:
        """Whether two words have one key."""
        own = F.xxhash64("lang", "word")
        ranges = self.words(range(self.shards)).groupBy("a1").agg(F.min(own).alias("a"), F.max(own).alias("b"))
        return not ranges.filter("a <> b").isEmpty()

    def run(self, docs: DataFrame, lang: str, text: str) -> tuple[DataFrame, DataFrame, DataFrame]:
        named = F.coalesce(F.col(lang).cast("string"), F.lit("und")).alias("lang"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text")
        for seed in itertools.count():
            rows = docs.select(*named).mapInArrow(_block(self.shards, seed), _BLOCKS)
            rows.write.partitionBy("shard").parquet(f"{self.root}/blocks")
            self.step(0)
            t = 1
            while t < max(self.shards, self.last + 1 + self.shards):
                self.step(t)
                t += 1
            if not self.clash():
                break
            discarded(self.spark, self.root)
            self.reset()
        reached = self.table("reached", _REACHED, range(t)).select(*KEYS)
        words = _among(self.words(range(self.shards)), reached.filter("size = 1"))
        words = words.groupBy("lang", "word", "a1").agg(F.sum("n").alias("n")).filter(F.col("n") >= self.least)
        grams = _among(self.table("grams", _GRAMS, range(1, t)), reached.filter("size > 1"))
        sums = grams.groupBy(*KEYS).agg(F.sum("n").alias("n")).filter(F.col("n") >= self.least)
        words.write.parquet(f"{self.root}/all-words")
        sums.write.parquet(f"{self.root}/all-grams")
        self.blocks().groupBy("lang").agg(F.sum("total").alias("n")).write.parquet(f"{self.root}/totals")
        # Everything else is done with; what follows reads these three.
        discarded(self.spark, *[f"{self.root}/{x}" for x in ("blocks", "words", "grams", "often", "reached")])
        read = lambda name, schema: self.spark.read.schema(schema).parquet(f"{self.root}/{name}")
        return (
            read("all-words", "lang string, word string, a1 long, n long"),
            read("all-grams", "size byte, a1 long, a2 long, a3 long, a4 long, n long"),
            read("totals", "lang string, n long"),
        )


def collocations(
    docs: DataFrame, lang: str = "lang", text: str = "text", least: int = 30, top: int = 2000, covered: int = 80, shards: int = SHARDS, held: int = HELD,
) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): each language's `top` phrases of 2 to 4 words
    with at least `least` occurrences, less those of which `covered` percent are inside a
    longer one; a phrase's score is its lowest over all cuts."""
    words, grams, totals = _Mine(docs.sparkSession, least, shards, held).run(docs, lang, text)
    key = F.slice(F.array("a1", "a2", "a3", "a4"), F.lit(1), F.col("size").cast("int"))
    long = grams.select(key.alias("key"), F.col("size").cast("int").alias("size"), F.col("n").alias("a"))
    counts = _small(long.select("key", "a").unionByName(words.select(F.array("a1").alias("key"), F.col("n").alias("a"))), BROADCAST_ROWS)
    cuts = long.select("key", "size", "a", F.explode(F.sequence(F.lit(1), F.col("size") - 1)).alias("k"))
    cuts = cuts.select("key", "a", "k", F.slice("key", F.lit(1), F.col("k")).alias("left"), F.slice("key", F.col("k") + 1, F.col("size") - F.col("k")).alias("right"))
    cuts = cuts.join(counts.select(F.col("key").alias("left"), F.col("a").alias("l")), "left").join(counts.select(F.col("key").alias("right"), F.col("a").alias("r")), "right")
    value = F.expr("(cast(a as decimal(19,0)) * 2000000) div (l + r)").alias("score")
    lowest = cuts.select("key", value, "k", "a", "l", "r").groupBy("key").agg(F.min(F.struct("score", "k", "a", "l", "r")).alias("x")).select("key", "x.*")
    # All parts of two and more words of the longer phrases, with the count of the most frequent.
    spans = F.flatten(F.transform(F.sequence(F.lit(2), F.col("size") - 1), lambda n: F.transform(F.sequence(F.lit(1), F.col("size") - n + 1), lambda i: F.slice("key", i, n))))
    inside = long.filter("size > 2").select("a", F.explode(spans).alias("key")).groupBy("key").agg(F.max("a").alias("longer"))
    free = lowest.join(_small(inside, BROADCAST_ROWS), "key", "left").filter(f"longer IS NULL OR cast(longer AS decimal(19,0)) * 100 < cast(a AS decimal(19,0)) * {covered}")
    size = words.agg(F.coalesce(F.sum(F.octet_length("word") + 48), F.lit(0)).alias("n")).first()["n"]
    for i in range(LONGEST):
        names = words.select(F.col("a1").alias(f"w{i}"), F.col("word").alias(f"word{i}"), *([F.col("lang")] if i == 0 else []))
        free = free.withColumn(f"w{i}", F.get("key", F.lit(i))).join(F.broadcast(names) if size <= BROADCAST_BYTES else names, f"w{i}", "left").drop(f"w{i}")
    named = free.select("lang", F.concat_ws(" ", *[f"word{i}" for i in range(LONGEST)]).alias("phrase"), "a", "l", "r", "score")
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    # The best of each of many lots first, so that no language is sorted by one task.
    lots = Window.partitionBy("lang", "lot").orderBy(*order)
    best = named.withColumn("lot", F.pmod(F.xxhash64("phrase"), F.lit(64))).withColumn("i", F.row_number().over(lots)).filter(F.col("i") <= top)
    ranks = best.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long")).filter(F.col("rank") <= top)
    return ranks.join(totals, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
