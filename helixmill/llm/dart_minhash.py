"""Near duplicates by DartMinHash: sparse weighted signatures, banded and verified.

A text is the multiset of its five-word shingles. Hashing throws darts at every shingle: unit
density over (weight, rank), cell by cell, the same darts wherever the shingle occurs. Darts
below the shingle's weight hit; of all hits the one of least rank in each of bands*rows
coordinates is kept. Two texts agree in a coordinate with the probability of their weighted
Jaccard similarity. Only about k ln k darts of a text are looked at, whatever its length.

Signatures are cut into bands; texts that share a band are candidates. Every text of a band
is compared with the band's centre, the text that shares most bands with others, and exact
similarity decides. Linked texts form components.

Where a centre's texts then still stand in several components, links between these are looked
for without comparing all with all. The comparison with the centre has left each text's
difference: the shingles that it has more or fewer of. If x isn't linked to the centre, a link
of x and y asks for a certain overlap of their differences, by the triangle inequality; the
differences' shingles that no other component has can't be part of it, and of the others the
rarest must meet (a prefix filter). Both conditions are exact: no pair that is similar enough
is left out, and a group of n copies costs about n comparisons, not n squared. What passes is
compared in full like the first pairs.

Exact copies are found by digest beforehand and have one signature row among them. Texts of a
comparison travel by (centre, lot) in lots of bounded number and bytes, so that a huge group
is spread over many tasks.

With 25 bands of 5 rows a pair of similarity 0.8 is missed with a probability of 5e-5.

Defined results: null and empty texts (or those of white space) are linked to exact copies
only; a text of 1 to 4 words is one shingle; each row's class is the least id of its text's
component, so rows of one id have the same class if their texts are linked, else their own;
a null id has a null class and is linked to nothing. Words are lower-cased (A-Z) and split at
white space. Extra columns are not read, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from helixmill.llm.shared import U, Words, mix, pieces, unused, words_of, written
from helixmill.operators.cluster import components

SHINGLE, THRESHOLD, BANDS, ROWS = 5, 0.8, 25, 5
#: Rank levels: the first reaches 2**LOWEST, each further one doubles that.
LOWEST = -8
#: Texts compared with one centre in one lot, and their bytes.
LOT, LOT_BYTES = 200, 16 << 20
#: Up to this number, candidates' ids (8 bytes each) are broadcast, so that only their texts
#: are shuffled; with more ids the join shuffles all texts.
BROADCAST_IDS = 1_000_000


def multiset(tokens: Words, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text number, shingle hash, count), sorted, of all texts of a run."""
    grams, offsets = tokens.grams(size)
    text = np.repeat(np.arange(len(tokens)), np.diff(offsets))
    order = np.lexsort((grams, text))
    grams, text = grams[order], text[order]
    new = np.ones(len(grams), dtype=bool)
    new[1:] = (grams[1:] != grams[:-1]) | (text[1:] != text[:-1])
    at = np.flatnonzero(new)
    return text[at], grams[at], np.diff(np.append(at, len(grams)))


def _poisson_table(mean: float) -> np.ndarray:
    """Cumulative probabilities of 0, 1, 2, ... events."""
    n = int(mean + 12 * np.sqrt(mean) + 30)
    logs = -mean + np.arange(n) * np.log(mean) - np.concatenate(([0.0], np.cumsum(np.log(np.arange(1, n)))))
    return np.cumsum(np.exp(logs))


def _unit(h: np.ndarray) -> np.ndarray:
    return (h >> U(11)).astype(np.float64) * 2.0**-53


def darts(elements: np.ndarray, weights: np.ndarray, level: int, seed: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(element index, rank, hash) of the darts that hit on one rank level."""
    rank_from = 0.0 if level == LOWEST else 2.0 ** (level - 1)
    rank_span = 2.0**level - rank_from
    band, top = 0, int(weights.max(initial=0))
    while True:
        weight_from = 0.0 if band == 0 else 2.0 ** (band - 1)
        if weight_from >= top:
            return
        weight_span = 1.0 if band == 0 else weight_from
        inside = np.flatnonzero(weights > weight_from)
        salt = ((seed * 1_000_003 + (level - LOWEST) * 1009 + band) * 0x9E3779B97F4A7C15) % 2**64
        cell = mix(elements[inside] + U(salt))
        table = _poisson_table(rank_span * weight_span)
        counts = np.searchsorted(table, _unit(cell), side="right")
        hit = np.repeat(np.arange(len(inside)), counts)
        number = np.arange(len(hit)) - np.repeat(np.cumsum(counts) - counts, counts)
        h = mix(cell[hit] + (number.astype(np.uint64) + U(1)) * U(0xD6E8FEB86659FD93))
        if weight_span == 1.0 and band == 0:
            below = slice(None)  # every weight is 1 at least
        else:
            below = weight_from + weight_span * _unit(mix(h + U(1))) < weights[inside[hit]]
        h, owner = h[below], inside[hit[below]]
        yield owner, rank_from + rank_span * _unit(mix(h + U(2))), h
        band += 1


def signatures(tokens: Words, size: int, k: int, seed: int = 1) -> tuple[np.ndarray, np.ndarray]:
    """The least ranks (as 64-bit patterns) of each text's k coordinates, and which texts have any."""
    text, element, weight = multiset(tokens, size)
    best = np.full(len(tokens) * k, np.inf)
    used = np.diff(tokens.first) > 0
    open_texts = used.copy()
    level = LOWEST
    while open_texts.any():
        live = np.flatnonzero(open_texts[text])
        for owner, rank, h in darts(element[live], weight[live], level, seed):
            coordinate = (mix(h + U(3)) % U(k)).astype(np.int64)
            np.minimum.at(best, text[live[owner]] * k + coordinate, rank)
        filled = np.isfinite(best.reshape(-1, k)).all(axis=1)
        # A dart of a later level has a higher rank than all before: filled texts are done.
        open_texts &= ~filled
        level += 1
    return best.view(np.uint64).reshape(-1, k), used


def band_keys(signature: np.ndarray, bands: int, rows: int) -> np.ndarray:
    keys = np.zeros((len(signature), bands), dtype=np.uint64)
    for r in range(rows):
        keys = mix(keys * U(0x2545F4914F6CDD1D) + signature[:, r::rows][:, :bands] + np.arange(bands, dtype=np.uint64))
    return keys.view(np.int64)


def text_key(text: Column) -> Column:
    """16 bytes that stand for a text: its MD5; null is empty."""
    return F.unhex(F.md5(F.coalesce(text.cast("string"), F.lit("")).cast("binary")))


def signed(docs: DataFrame, id_col: str, text_col: str, size: int, bands: int, rows: int) -> DataFrame:
    """(id, key, bytes, bands, row) of every row of docs; no bands for empty texts."""

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = []
            for _, tokens in words_of(batch.column(3), lower=True, limit=1 << 19):
                signature, used = signatures(tokens, size, bands * rows)
                found = band_keys(signature, bands, rows)
                keys += [k if u else None for k, u in zip(found, used, strict=True)]
            columns = [*batch.columns[:3], pa.array(keys, pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays(columns, names=["id", "key", "bytes", "bands"])

    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    rows_in = docs.select(F.col(id_col).alias("id"), text_key(text).alias("key"), F.octet_length(text).alias("bytes"), text.alias("text"))
    out = rows_in.mapInArrow(sign, "id bigint, key binary, bytes int, bands array<bigint>")
    return out.withColumn("row", F.monotonically_increasing_id())


def difference(head: tuple[np.ndarray, np.ndarray], other: tuple[np.ndarray, np.ndarray]) -> tuple[int, np.ndarray]:
    """Shingles in common, and the others as 32-bit tokens: one for each shingle that one of
    the two has more, told apart by which of them and by number."""
    (grams, counts), (g, c) = head, other
    at = np.minimum(np.searchsorted(grams, g), len(grams) - 1)
    same = grams[at] == g
    both = int(np.minimum(counts[at[same]], c[same]).sum())
    less = counts.copy()
    less[at[same]] -= c[same]
    element = np.concatenate((grams[less > 0], grams[less < 0], g[~same]))
    more = np.concatenate((less[less > 0], -less[less < 0], c[~same]))
    sign = np.repeat(np.array([0, 1], np.uint64), [int((less > 0).sum()), len(element) - int((less > 0).sum())])
    number = np.arange(int(more.sum())) - np.repeat(np.cumsum(more) - more, more)
    tokens = mix(np.repeat(mix(element + sign), more) + number.astype(np.uint64) * U(0xD6E8FEB86659FD93))
    return both, (tokens >> U(32)).astype(np.uint32).view(np.int32)


def compared(
    pairs: DataFrame, reps: DataFrame, docs: DataFrame, id_col: str, text_col: str, size: int, threshold: float, rest: bool
) -> DataFrame:
    """The pairs (head, other) of text keys with `linked`, whether their texts reach the threshold.

    With `rest` also the shingles of each (n_head, n_other) and the tokens of their difference.
    A head's others are dealt to lots; its text goes once to each lot. reps has key, id, bytes.
    """
    pairs = written(pairs)
    keys = pairs.select(F.col("head").alias("key")).unionByName(pairs.select(F.col("other").alias("key"))).distinct()
    chosen = written(reps.join(keys, "key").select("key", "id", "bytes"))
    sized = pairs.join(chosen.select(F.col("key").alias("other"), "bytes"), "other")
    full = F.greatest(F.count("*") / LOT, F.sum("bytes") / LOT_BYTES)
    lots = sized.groupBy("head").agg(F.ceil(full).cast("int").alias("lots"))
    lot = F.pmod(F.xxhash64("other"), F.greatest("lots", F.lit(1))).cast("int")
    others = pairs.join(lots, "head").select("head", lot.alias("lot"), F.col("other").alias("key"))
    heads = lots.select("head", F.explode(F.sequence(F.lit(0), F.greatest(F.col("lots"), F.lit(1)) - 1)).alias("lot"), F.col("head").alias("key"))
    ids = chosen.select("id").distinct()
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    few = chosen.count() <= BROADCAST_IDS
    texts = texts.join(F.broadcast(ids) if few else ids, "id", "left_semi")
    texts = texts.select(text_key(F.col("text")).alias("key"), "text").dropDuplicates(["key"])
    with_text = others.unionByName(heads).join(texts, "key")
    fields = [("head", pa.binary()), ("other", pa.binary()), ("linked", pa.bool_())]
    if rest:
        fields += [("n_head", pa.int64()), ("n_other", pa.int64()), ("rest", pa.list_(pa.int32()))]

    def judge(group: pa.Table) -> pa.Table:
        group = group.combine_chunks()
        head, keys = group.column("head")[0].as_py(), group.column("key").to_pylist()
        own, found = None, []
        if head in keys:
            tokens = next(iter(words_of(group.column("text").slice(keys.index(head), 1), lower=True)))[1]
            own = multiset(tokens, size)[1:]
        if own is not None and len(own[0]):
            for start, data, offsets in pieces(group.column("text")):
                tokens = Words(data, offsets, lower=True)
                text, grams, counts = multiset(tokens, size)
                cuts = np.searchsorted(text, np.arange(len(tokens) + 1))
                for i in range(len(tokens)):
                    span = slice(cuts[i], cuts[i + 1])
                    if keys[start + i] != head and cuts[i] < cuts[i + 1]:
                        both, left = difference(own, (grams[span], counts[span]))
                        n, m = int(own[1].sum()), int(counts[span].sum())
                        found.append((head, keys[start + i], both >= threshold * (n + m - both), n, m, left)[: len(fields)])
        columns = zip(*found, strict=True) if found else [()] * len(fields)
        return pa.table({name: pa.array(list(c), kind) for (name, kind), c in zip(fields, columns, strict=True)})

    schema = "head binary, other binary, linked boolean" + ", n_head bigint, n_other bigint, rest array<int>" * rest
    return with_text.groupBy("head", "lot").applyInArrow(judge, schema)


def with_centres(keyed: DataFrame) -> DataFrame:
    """(bucket, key, centre) of the buckets that several texts share.

    A text's weight is the number of texts in its buckets together. A bucket's centre is its
    heaviest text (then the greatest key): in a group of near copies the text that most of them
    resemble, so that comparing all with it links nearly all of them at once.
    """
    full = keyed.groupBy("bucket").agg(F.count("*").alias("n")).filter("n > 1")
    shared = written(keyed.join(full, "bucket"))
    weights = shared.groupBy("key").agg(F.sum("n").alias("weight"))
    centres = shared.join(weights, "key").groupBy("bucket").agg(F.max(F.struct("weight", "key")).alias("best"))
    return shared.select("bucket", "key").join(centres.select("bucket", F.col("best.key").alias("centre")), "bucket")


def across(met: DataFrame, classes: DataFrame, threshold: float) -> DataFrame:
    """Pairs (head, other) of one centre's texts in different components that may be linked.

    Let c be the centre, d(x) the size of x's difference from c, n(x) the number of x's shingles
    and g = (1-t)/(1+t) for the threshold t: x and y are linked if d(x, y) <= g*(n(x)+n(y)). The
    overlap of their differences is (d(x)+d(y)-d(x, y))/2, so a link needs one of at least
    (d(x)+d(y)-g*(n(x)+n(y)))/2. For x not linked to c, with the excess e = d(x)-g*(n(x)+n(c)),
    that is e/(1+g) or more, and as many as (1-g)/2*d(y). A difference's tokens that occur in one
    component only aren't in any overlap with another; of its k others, in the order of how
    many texts have them, one of the first k-need+1 must be in the other text's first ones too.
    """
    g = (1 - threshold) / (1 + threshold)
    of = lambda name: classes.select(F.col("node").alias(name), F.col("component").alias(f"{name}_part"))
    parts = met.select("head", "other").join(of("other"), "other", "left").join(of("head"), "head", "left")
    parts = written(parts.select("head", "other", F.coalesce("other_part", "other").alias("part"), F.coalesce("head_part", "head").alias("home")))
    mixed = parts.filter("part <> home").select("head").distinct()
    rows = met.join(parts.join(mixed, "head", "left_semi").select("head", "other", "part"), ["head", "other"])
    size = F.size("rest")
    excess = size - F.lit(g) * (F.col("n_head") + F.col("n_other"))
    texts = rows.select("head", "other", "part", size.alias("d"), F.col("n_other").alias("n"), excess.alias("e"), F.explode("rest").alias("token"))
    tokens = written(texts)
    spread = tokens.groupBy("head", "token").agg(F.min("part").alias("a"), F.max("part").alias("b"), F.count("*").alias("texts"))
    held = tokens.join(spread.filter("a <> b").select("head", "token", "texts"), ["head", "token"])
    own = Window.partitionBy("head", "other")
    held = held.withColumn("k", F.count("*").over(own)).withColumn("rank", F.row_number().over(own.orderBy("texts", "token")))
    slack = F.lit(1e-6)
    first = lambda need: F.col("rank") <= F.col("k") - F.greatest(F.lit(1), F.ceil(need - slack)) + 1
    as_stray = (F.col("e") > 0) & first(F.col("e") / F.lit(1 + g))
    as_partner = first(F.col("d") * F.lit((1 - g) / 2))
    held = written(held.select("*", as_stray.alias("stray"), as_partner.alias("partner")).filter("stray OR partner"))
    side = lambda flag, x: held.filter(flag).select("head", "token", *[F.col(c).alias(f"{x}_{c}") for c in ("other", "part", "d", "n", "k")])
    needed = (F.col("x_d") + F.col("y_d") - F.lit(g) * (F.col("x_n") + F.col("y_n"))) / 2
    met_again = side("stray", "x").join(side("partner", "y"), ["head", "token"])
    able = met_again.filter((F.col("x_part") != F.col("y_part")) & (needed <= F.least("x_k", "y_k") + slack))
    return able.select(F.greatest("x_other", "y_other").alias("head"), F.least("x_other", "y_other").alias("other")).distinct()


def classed(docs: DataFrame, id_col: str, text_col: str, size: int, threshold: float, bands: int, rows: int) -> tuple[DataFrame, DataFrame]:
    """All rows as (id, key, row), and each text's class: (key, class_id, class_key, class_row),
    the class's least id with its text's key and row."""
    table = written(signed(docs, id_col, text_col, size, bands, rows))
    least = F.min(F.struct("id", "row", "bytes")).alias("r")
    exact = written(table.filter(F.col("id").isNotNull()).groupBy("key").agg(least).select("key", "r.id", "r.row", "r.bytes"))
    # One row for each distinct text: that of its least id.
    reps = table.filter(F.col("bands").isNotNull()).join(exact.select("key", "row"), ["key", "row"])
    shared = written(with_centres(reps.select("key", F.explode("bands").alias("bucket"))))
    compare = lambda pairs, rest: compared(pairs, exact, docs, id_col, text_col, size, threshold, rest)
    first = shared.filter("key <> centre").select(F.col("centre").alias("head"), F.col("key").alias("other")).distinct()
    met = written(compare(first, True))
    edges = lambda x: x.filter("linked").select(F.col("head").alias("u"), F.col("other").alias("v"))
    classes = written(components(edges(met), "u", "v"))
    more = written(edges(compare(across(met, classes, threshold), False)))
    if not more.isEmpty():
        known = classes.select(F.col("node").alias("u"), F.col("component").alias("v"))
        classes = written(components(known.unionByName(more), "u", "v"))
    placed = exact.join(classes.withColumnRenamed("node", "key"), "key", "left").withColumn("component", F.coalesce("component", "key"))
    best = placed.groupBy("component").agg(F.min(F.struct("id", "key", "row")).alias("best"))
    named = placed.select("key", "component").join(best, "component")
    named = named.select("key", F.col("best.id").alias("class_id"), F.col("best.key").alias("class_key"), F.col("best.row").alias("class_row"))
    return table.select("id", "key", "row"), named


def near_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = SHINGLE,
    threshold: float = THRESHOLD, bands: int = BANDS, rows: int = ROWS,
) -> DataFrame:
    """(doc_id, class_id) for every row of docs: the least id among its near duplicates."""
    table, named = classed(docs, id_col, text_col, size, threshold, bands, rows)
    out = table.join(named, "key", "left")
    return out.select(F.col("id").alias(id_col), F.when(F.col("id").isNotNull(), F.col("class_id")).alias("class_id"))


def deduplicated(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = SHINGLE,
    threshold: float = THRESHOLD, bands: int = BANDS, rows: int = ROWS,
) -> DataFrame:
    """docs with one row of each class: that of the least id, of its texts the one of the least
    MD5, of rows equal in both one by a hash of all columns. Rows without id all stay."""
    table, named = classed(docs, id_col, text_col, size, threshold, bands, rows)
    key, other_id, other_key, number = (unused(docs.columns, x) for x in ("__key", "__other_id", "__other_key", "__number"))
    placed = table.filter(F.col("id").isNotNull()).join(named, "key")
    leads = (F.col("id") == F.col("class_id")) & (F.col("key") == F.col("class_key"))
    pair = lambda x: x.select(F.col("id").alias(other_id), F.col("key").alias(other_key)).distinct()
    gone, twice = pair(placed.filter(~leads)), pair(placed.filter(leads & (F.col("row") != F.col("class_row"))))
    keyed = docs.withColumn(key, text_key(F.col(text_col)))
    same = (F.col(id_col) == F.col(other_id)) & (F.col(key) == F.col(other_key))
    kept = keyed.join(gone, same, "left_anti")
    twice = written(twice)
    if not twice.isEmpty():
        order = Window.partitionBy(id_col, key).orderBy(F.xxhash64(*docs.columns))
        again = kept.join(twice, same, "left_semi").withColumn(number, F.row_number().over(order)).filter(F.col(number) == 1).drop(number)
        kept = kept.join(twice, same, "left_anti").unionByName(again)
    return kept.select(*docs.columns)
