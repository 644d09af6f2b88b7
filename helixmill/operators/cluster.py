"""Clusters of k-mers and of sequences: Hamming pairs, linkage, motifs, MinHash similarity."""

from __future__ import annotations

import itertools
import math
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F

from helixmill.functions import sequence as S
from helixmill.operators.kmers import packed, unpacked
from helixmill.operators.tables import ranked, released, written


#: Up to so many ways to mask letters, pairs meet at masked k-mers.
MASKS = 256


def masked(k: int, radius: int) -> Column:
    """All ways to put a dot for `radius` letters of `kmer`: (form, the letters) structs."""

    def one(dots: tuple[int, ...]) -> Column:
        form = F.concat_ws(".", *[F.substring("kmer", a + 2, b - a - 1) for a, b in itertools.pairwise([-1, *dots, k])])
        return F.struct(form.alias("form"), F.concat_ws("", *[F.substring("kmer", x + 1, 1) for x in dots]).alias("own"))

    return F.array(*[one(dots) for dots in itertools.combinations(range(k), radius)])


def pairs_at(kmers: DataFrame, k: int, radius: int, other: DataFrame | None = None) -> DataFrame:
    """(a, b, d): pairs of k-mers with exactly `radius` differing letters, a < b; with `other`,
    pairs of one of kmers and one of other.

    Such a pair has exactly one masked form in common in which all masked letters differ. A
    masked form stands for at most (number of letters)^radius k-mers, so its lists are short
    whatever the table's size, and a table costs its rows times the masks and its pairs.
    """

    def forms(df: DataFrame) -> DataFrame:
        rows = df.filter("kmer IS NOT NULL").select("kmer").distinct().select("kmer", F.explode(masked(k, radius)).alias("m"))
        return rows.select(F.col("m.form").alias("form"), F.struct("kmer", "m.own").alias("x"))

    lists = forms(kmers if other is None else other).groupBy("form").agg(F.collect_list("x").alias("ys"))
    if other is None:
        met = lists.filter(F.size("ys") > 1).select(F.explode("ys").alias("x"), "ys")
    else:
        met = forms(kmers).join(lists, "form")
    met = met.select("x", F.explode("ys").alias("y"))
    if other is None:
        met = met.filter("x.kmer < y.kmer")
    apart = [F.substring("x.own", i + 1, 1) != F.substring("y.own", i + 1, 1) for i in range(radius)]
    return met.filter(reduce(lambda a, b: a & b, apart, F.lit(True))).select(F.col("x.kmer").alias("a"), F.col("y.kmer").alias("b"), F.lit(radius).alias("d"))


def hamming_pairs(kmers: DataFrame, k: int, most: int) -> DataFrame:
    """(a, b, d), a < b: all pairs of k-mers with at most `most` differing letters.

    While there are few ways to mask `most` letters, pairs meet at masked forms. Else they are
    found by pieces: two such k-mers agree in one of most+1 pieces (pigeonhole), so pairs come
    from an equi-join per piece and are then verified. No pair matrix is made.
    """
    if sum(math.comb(k, r) for r in range(1, most + 1)) <= MASKS:
        found = [pairs_at(kmers, k, r) for r in range(1, most + 1)]
        return reduce(DataFrame.unionByName, found) if found else pairs_at(kmers, k, 0).limit(0)
    cuts = [round(i * k / (most + 1)) for i in range(most + 2)]
    pieces = F.array(*[F.struct(F.lit(i).alias("i"), F.substring("kmer", a + 1, b - a).alias("s")) for i, (a, b) in enumerate(zip(cuts, cuts[1:], strict=False))])
    parts = kmers.select("kmer").distinct().select("kmer", F.explode(pieces).alias("p")).select("kmer", "p.i", "p.s")
    other = parts.select(F.col("kmer").alias("b"), "i", "s")
    met = parts.withColumnRenamed("kmer", "a").join(other, ["i", "s"]).filter("a < b")
    found = met.withColumn("d", S.hamming(F.col("a"), F.col("b"))).filter(F.col("d") <= most)
    # A pair that agrees in several pieces is kept for the first of them.
    same = [F.substring("a", a + 1, b - a) == F.substring("b", a + 1, b - a) for a, b in zip(cuts, cuts[1:], strict=False)]
    first = F.coalesce(*[F.when(c, i) for i, c in enumerate(same)])
    return found.filter(F.col("i") == first).select("a", "b", "d")


def _stars(edges: DataFrame, large: bool) -> DataFrame:
    """Ties each node's neighbours to the least of them and the node itself: those above it
    (large, over both directions), or all of them and the node too (small)."""
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v"))) if large else edges
    least = both.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("n"), F.least("u", "m").alias("m"))
    tied = both.join(least, F.col("u") == F.col("n"))
    if large:
        return tied.filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    own = least.select(F.col("n").alias("u"), F.col("m").alias("v"))
    return tied.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(own).filter("u > v")


def components(pairs: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component) for every node of the pairs; a component is its least node.

    Alternating large and small stars shrink the edges to one star per component in a few
    rounds (logarithmic in practice). Each round is written to the shared folder, and only its
    count and checksum come to the driver, observed while it is written. A hub's edges are
    summed on the map side before its minimum is shuffled.
    """
    now = pairs.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).filter("u <> v").distinct()
    seen = before = None
    while True:
        watch = Observation()
        sums = F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("sum")
        now = written(now.observe(watch, *sums))
        if before is not None:
            released(before)
        mark = watch.get["n"], watch.get["sum"]
        if not mark[0] or mark == seen:
            break
        seen, before, now = mark, now, _stars(_stars(now, True), False).distinct()
    roots = now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return now.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(roots)


def average_linkage(distance: np.ndarray, cut: float) -> np.ndarray:
    """Cluster numbers by average linkage up to distance `cut`; the first closest pair merges."""
    n = len(distance)
    label = np.arange(n)
    d = distance.astype(float).copy()
    np.fill_diagonal(d, np.inf)
    size = np.ones(n)
    while n > 1:
        flat = int(d.argmin())
        i, j = divmod(flat, len(d))
        if not d[i, j] <= cut + 1e-12:
            break
        i, j = min(i, j), max(i, j)
        joined = (size[i] * d[i] + size[j] * d[j]) / (size[i] + size[j])
        d[i], d[:, i] = joined, joined
        d[i, i] = np.inf
        d[j], d[:, j] = np.inf, np.inf
        size[i] += size[j]
        label[label == j] = i
        n -= 1
    return label


def ward_linkage(points: np.ndarray, clusters: int | None, distance: float | None) -> np.ndarray:
    """Cluster numbers (from 1, by first member) of Ward linkage on rows of a matrix, cut at a
    number of clusters or at a distance."""
    n = len(points)
    label = np.arange(n)
    square = ((points[:, None, :] - points[None, :, :]) ** 2).sum(axis=2)
    np.fill_diagonal(square, np.inf)
    size, left = np.ones(n), n
    while left > (clusters or 1):
        i, j = divmod(int(square.argmin()), n)
        if not np.isfinite(square[i, j]) or (distance is not None and math.sqrt(square[i, j]) > distance):
            break
        i, j = min(i, j), max(i, j)
        total = size[i] + size[j] + size
        with np.errstate(invalid="ignore"):
            joined = ((size[i] + size) * square[i] + (size[j] + size) * square[j] - size * square[i, j]) / total
        joined[~np.isfinite(square[i])] = np.inf
        square[i], square[:, i] = joined, joined
        square[i, i] = np.inf
        square[j], square[:, j] = np.inf, np.inf
        size[i] += size[j]
        label[label == j] = i
        left -= 1
    order = {x: i + 1 for i, x in enumerate(dict.fromkeys(label.tolist()))}
    return np.array([order[x] for x in label.tolist()])


def consensus(members: DataFrame, by: str, seq: str = "kmer") -> DataFrame:
    """(by, motif): the code of all bases at each position of a cluster's sequences."""
    letters = F.filter(F.split(seq, ""), lambda c: c != "")
    rows = members.select(by, F.posexplode(letters).alias("pos", "base"))
    masks = rows.groupBy(by, "pos").agg(F.bit_or(S.iupac_mask(F.col("base"))).alias("mask"))
    placed = masks.groupBy(by).agg(F.array_sort(F.collect_list(F.struct("pos", S.iupac_code(F.col("mask")).alias("code")))).alias("codes"))
    return placed.select(by, F.array_join(F.transform("codes", lambda c: c["code"]), "").alias("motif"))


def hamming_clusters(kmers: DataFrame, k: int, most: int) -> DataFrame:
    """(cluster, kmer): average linkage on Hamming distance, cut at `most` letters; a cluster is
    named by its least k-mer.

    A cluster is kept as its letter counts by position, from which the mean distance of two
    clusters follows, so no distances of members are kept and no group is in one task. Clusters
    that are each other's nearest merge at once: average linkage then gives the same tree as one
    merge at a time. Among equally near pairs a hash of the two names decides, so that ties
    don't make the rounds wait for each other; a merged cluster keeps the lesser name.

    Only pairs of clusters within the cut are kept. The mean distance of a merged cluster to
    another is between its parts', so a pair within the cut always comes from one that was, and
    at first those are the Hamming pairs. Each round is a few joins over these pairs, which
    shrink fast, and is written; about the logarithm of the k-mers are needed. Distances are
    quotients of whole numbers, exact while clusters have fewer than some ten million members.
    Null k-mers are left out, repeated ones count once, any letters may occur.
    """
    names = written(kmers.filter("kmer IS NOT NULL").select("kmer").distinct())
    letters = sorted(r["c"] for r in names.select(F.explode(F.split("kmer", "")).alias("c")).filter("c <> ''").distinct().collect())
    ones = F.flatten(F.transform(F.split(F.col("kmer"), ""), lambda c: F.array(*[F.when(c == x, 1).otherwise(0).cast("long") for x in letters])))
    clusters = written(names.select(F.col("kmer").alias("id"), F.lit(1).cast("long").alias("size"), ones.alias("counts")))
    edges = written(hamming_pairs(names, k, most).select(F.col("a").alias("i"), F.col("b").alias("j"), F.col("d").cast("double").alias("d")))
    rounds = []
    while True:
        place = F.struct("d", F.xxhash64("i", "j").alias("tie"), "i", "j").alias("p")
        best = edges.select(F.explode(F.array("i", "j")).alias("id"), place).groupBy("id").agg(F.min("p").alias("p"))
        mutual = written(best.groupBy("p").agg(F.count("*").alias("n")).filter("n = 2").select("p.i", "p.j"))
        if mutual.isEmpty():
            break
        rounds.append(mutual)
        of = lambda x: clusters.select(F.col("id").alias(x), F.col("size").alias(f"s{x}"), F.col("counts").alias(f"c{x}"))  # noqa: B023, E731
        both = mutual.join(of("i"), "i").join(of("j"), "j")
        whole = both.select(F.col("i").alias("id"), (F.col("si") + F.col("sj")).alias("size"), F.zip_with("ci", "cj", lambda x, y: x + y).alias("counts"))
        moved = mutual.select(F.explode(F.array(F.struct(F.col("i").alias("id"), F.col("i").alias("to")), F.struct(F.col("j").alias("id"), F.col("i").alias("to")))).alias("m")).select("m.*")
        to = lambda x: moved.select(F.col("id").alias(x), F.col("to").alias(f"t{x}"))  # noqa: B023, E731
        drawn = edges.join(to("i"), "i", "left").join(to("j"), "j", "left").select(F.coalesce("ti", "i").alias("x"), F.coalesce("tj", "j").alias("y"))
        drawn = written(drawn.filter("x <> y").select(F.least("x", "y").alias("i"), F.greatest("x", "y").alias("j")).distinct())
        # Only clusters with a pair go on.
        ends = drawn.select(F.explode(F.array("i", "j")).alias("id")).distinct()
        old_clusters, old_edges = clusters, edges
        clusters = written(clusters.join(moved, "id", "left_anti").unionByName(whole).join(ends, "id", "left_semi"))
        equal = F.aggregate(F.zip_with("ci", "cj", lambda x, y: x * y), F.lit(0).cast("long"), lambda s, x: s + x)
        members = F.col("si") * F.col("sj")
        mean = (k * members - equal).cast("double") / members.cast("double")
        edges = written(drawn.join(of("i"), "i").join(of("j"), "j").select("i", "j", mean.alias("d")).filter(F.col("d") <= most))
        released(old_clusters, old_edges, drawn)
    released(mutual, clusters, edges)
    if not rounds:
        return names.select(F.col("kmer").alias("cluster"), "kmer")
    # Every merged name points to the one that took it; pointers double until all are at a root.
    roots = written(reduce(DataFrame.unionByName, rounds).select(F.col("j").alias("kmer"), F.col("i").alias("root")))
    released(*rounds)
    while True:
        watch = Observation()
        ahead = roots.select(F.col("kmer").alias("root"), F.col("root").alias("next"))
        moved = roots.join(ahead, "root", "left").select("kmer", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved"))
        old, roots = roots, written(moved.observe(watch, F.count_if("moved").alias("n")).drop("moved"))
        released(old)
        if not watch.get["n"]:
            break
    return names.join(roots, "kmer", "left").select(F.coalesce("root", "kmer").alias("cluster"), "kmer")


def nearest(kmers: DataFrame, k: int, most: int | None = None, n: int = 20) -> DataFrame:
    """(a, b, d, rank): the n nearest others of each k-mer, exactly, ties in order of b; only those
    within `most` letters if it is given, else every k-mer has n (or all others of fewer).

    Without a bound the radius grows by a letter a round, and only k-mers that lack neighbours
    go on, so few are asked at wide radii. Pairs of a round are those at exactly its radius.
    """
    order = Window.partitionBy("a").orderBy("d", "b")
    best = lambda pairs: pairs.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= n)
    if most is not None:
        pairs = hamming_pairs(kmers, k, most)
        return best(pairs.unionByName(pairs.select(F.col("b").alias("a"), F.col("a").alias("b"), "d")))
    names = written(kmers.filter("kmer IS NOT NULL").select("kmer").distinct())
    wanted = min(n, names.count() - 1)
    pending, found = names, None
    for radius in range(1, k + 1):
        if radius == 1:
            at = pairs_at(names, k, radius)
            at = at.unionByName(at.select(F.col("b").alias("a"), F.col("a").alias("b"), "d"))
        else:
            at = pairs_at(pending, k, radius, names)
        # Ranks only fall behind nearer ones, so more than n at one radius are never needed.
        now = written(best(at).drop("rank") if found is None else found.unionByName(best(at).drop("rank")))
        full = now.groupBy("a").agg(F.count("*").alias("n")).filter(F.col("n") >= wanted).select(F.col("a").alias("kmer"))
        rest = written(pending.join(full, "kmer", "left_anti"))
        released(*[x for x in (found, pending) if x is not None and x is not names])
        found, pending = now, rest
        if wanted <= 0 or pending.isEmpty():
            break
    return best(found)


def greedy_motifs(counts: DataFrame, k: int, most: int | None = None, n: int = 20) -> DataFrame:
    """(cluster, kmer): the most frequent k-mer takes its nearest neighbours that no seed has
    taken before, and so on down the frequencies; a hash decides between equal frequencies.

    counts has kmer and n. A k-mer is a seed unless a more frequent seed among those that have
    it as a neighbour took it; seeds are found in rounds over the whole table. The hash keeps
    the rounds few where many k-mers are equally frequent.
    """
    near = nearest(counts, k, most, n).select("a", "b")
    ranks = counts.select(F.col("kmer"), F.struct((-F.col("n")).alias("n"), F.xxhash64("kmer").alias("tie"), "kmer").alias("order"))
    # Edges from a would-be seed to a later neighbour.
    a, b = ranks.select(F.col("kmer").alias("a"), F.col("order").alias("oa")), ranks.select(F.col("kmer").alias("b"), F.col("order").alias("ob"))
    edges = written(near.join(a, "a").join(b, "b").filter("oa < ob").select("a", "b", "oa"))
    state = written(counts.select("kmer").withColumn("seed", F.lit(None).cast("boolean")))
    while True:
        known = edges.join(state.select(F.col("kmer").alias("a"), F.col("seed").alias("sa")), "a")
        told = known.groupBy("b").agg(F.bool_or(F.coalesce("sa", F.lit(False))).alias("taken"), F.bool_or(F.col("sa").isNull()).alias("open"))
        joined = state.join(told.withColumnRenamed("b", "kmer"), "kmer", "left")
        decided = F.when(F.col("seed").isNotNull(), F.col("seed")).when(F.coalesce("taken", F.lit(False)), False).when(~F.coalesce("open", F.lit(False)), True)
        watch = Observation()
        old, state = state, written(joined.select("kmer", decided.alias("seed")).observe(watch, F.count(F.when(F.col("seed").isNull(), 1)).alias("open")))
        released(old)
        if not watch.get["open"]:
            break
    seeds = state.filter("seed").select(F.col("kmer").alias("a"))
    owner = edges.join(seeds, "a").groupBy("b").agg(F.min_by("a", "oa").alias("cluster"))
    taken = state.filter("NOT seed").join(owner.withColumnRenamed("b", "kmer"), "kmer").select("cluster", "kmer")
    return taken.unionByName(seeds.select(F.col("a").alias("cluster"), F.col("a").alias("kmer")))


def sub_clusters(clusters: DataFrame, cut: float = 1.0) -> DataFrame:
    """(cluster, sub, kmer): each seed's k-mers by average linkage on Hamming distance, cut at
    `cut` letters; sub is the least k-mer of its part.

    A seed has at most its n neighbours, so a group is small. Groups lie behind each other in
    sorted partitions and are split as they stream by.
    """

    def split(seed: str | None, names: list[str]) -> list[tuple]:
        letters = np.array([list(x) for x in names])
        label = average_linkage((letters[:, None] != letters[None]).sum(axis=2), cut).tolist() if len(names) > 1 else [0]
        first = {}
        return [(seed, first.setdefault(x, name), name) for x, name in zip(label, names, strict=True)]

    def streamed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seed, names = None, []
        for batch in batches:
            out = []
            for now, name in zip(batch["cluster"].to_pylist(), batch["kmer"].to_pylist(), strict=True):
                if names and now != seed:
                    out += split(seed, names)
                    names = []
                seed = now
                names.append(name)
            yield _parts(out)
        if names:
            yield _parts(split(seed, names))

    rows = clusters.select("cluster", "kmer").repartition("cluster").sortWithinPartitions("cluster", "kmer")
    return rows.mapInArrow(streamed, "cluster string, sub string, kmer string")


def _parts(rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) or [()] * 3
    return pa.RecordBatch.from_arrays([pa.array(c, pa.string()) for c in columns], ["cluster", "sub", "kmer"])


#: So many ranks make one task's lot in joined_records.
LOT = 100_000


def joined_records(parts: DataFrame, k: int, record: str, order: str, lot: int = LOT) -> DataFrame:
    """(record, seq) with the same k-long windows, as often, as each record's parts joined in order.

    No record is put together: the parts stay as they are, and each part's last k-1 letters
    with the k-1 that follow it add the windows across its end. Only those short strings are
    ranked; lots of neighbouring ranks look ahead, so a record of many parts is dealt out too.
    """
    n = k - 1
    filled = parts.filter(F.length("seq") > 0).select(record, order, "seq")
    ends = filled.select(record, order, F.left("seq", F.lit(n)).alias("__head"), F.right("seq", F.lit(n)).alias("__tail"))
    rows = ranked(ends, record, order, "__head", "__tail", name="__rank").withColumn("__lot", F.floor(F.col("__rank") / lot))
    # A lot's first n rows are also seen from the lot before.
    lots = F.when(F.col("__rank") % lot < n, F.array(F.col("__lot"), F.col("__lot") - 1)).otherwise(F.array("__lot"))
    seen = rows.select(record, "__head", "__tail", "__rank", F.col("__lot").alias("__own"), F.explode(lots).alias("__lot"))
    ahead = Window.partitionBy("__lot").orderBy("__rank")
    heads = [F.when(F.lead(record, i).over(ahead).eqNullSafe(F.col(record)), F.lead("__head", i).over(ahead)) for i in range(1, n + 1)]
    across = seen.select(record, "__own", "__lot", F.concat("__tail", F.left(F.concat_ws("", *heads), F.lit(n))).alias("seq"))
    return filled.select(record, "seq").unionByName(across.filter("__own = __lot").select(record, "seq"))


def sketch(records: DataFrame, k: int, record: str, scaled: int = 1) -> DataFrame:
    """(record, hash, abund): canonical k-mers of plain bases whose hash is in the lowest
    1/scaled of all values; scaled=1 keeps all. K-mers are counted as numbers first, so only
    a record's distinct ones are letters."""
    sums = packed(records, k, keep=(record,)).groupBy(record, "code", "other").agg(F.sum("n").alias("n"))
    rows = sums.select(record, unpacked(k).alias("kmer"), "n").filter(F.col("kmer").rlike("^[ACGT]+$"))
    canonical = F.least("kmer", S.reverse_complement(F.col("kmer")))
    hashed = rows.select(record, F.xxhash64(canonical).alias("hash"), "n")
    if scaled > 1:
        hashed = hashed.filter(F.shiftrightunsigned("hash", 1) < (2**63 // scaled))
    return hashed.groupBy(record, "hash").agg(F.sum("n").alias("abund"))


#: Records in one block of a Gram product's rows and columns.
BLOCK = 256
#: Keys whose values are multiplied at once, cells of all rows' values then (fewer keys for many
#: rows), and blocks of sums that a task holds at a time.
KEYS, CELLS, HELD = 1024, 1 << 25, 256
#: Clusters (some numbers each) up to this number are broadcast to their pairs.
BROADCAST_RECORDS = 100_000


def gram(entries: DataFrame, n: int, every: bool = False, block: int = BLOCK) -> DataFrame:
    """(i, j, dot), i <= j: the scalar products of a sparse matrix's rows, zeros left out unless
    `every`; entries are (i, key, x), i from 0 to n-1.

    Entries meet by key. A task multiplies the values of many keys at once, block of rows by
    block of rows, and adds the products to dense blocks; those of all tasks are summed by
    their place. So what is shuffled are the entries, once, and blocks of sums, not a row for
    every pair and key, and a key that all rows have is n values in one product.
    """
    dealt = entries.select(F.col("i").cast("long").alias("i"), "key", F.col("x").cast("double").alias("x")).repartition("key").sortWithinPartitions("key")

    def multiplied(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[tuple[int, int], np.ndarray] = {}
        rows, columns, values, last, used = [], [], [], None, 0
        most = max(1, min(KEYS, CELLS // max(n, 1)))

        def add() -> Iterator[pa.RecordBatch]:
            i, c, x = np.concatenate(rows), np.concatenate(columns), np.concatenate(values)
            order = np.argsort(i // block, kind="stable")
            i, c, x = i[order], c[order], x[order]
            blocks, first = np.unique(i // block, return_index=True)
            parts = []
            for p, low, high in zip(blocks.tolist(), first, [*first[1:], len(i)], strict=True):
                dense = np.zeros((block, used))
                np.add.at(dense, (i[low:high] - p * block, c[low:high]), x[low:high])
                parts.append((p, dense))
            for k, (p, left) in enumerate(parts):
                for q, right in parts[k:]:
                    product = left @ right.T
                    sums[p, q] = sums[p, q] + product if (p, q) in sums else product
                    if len(sums) >= HELD:
                        yield _blocks(sums)
                        sums.clear()

        for batch in batches:
            i, x = batch["i"].to_numpy(), batch["x"].to_numpy()
            codes = batch["key"].dictionary_encode()
            # Sorted, so a new key begins where the code changes.
            code = codes.indices.to_numpy(zero_copy_only=False)
            begin = np.flatnonzero(np.concatenate(([True], code[1:] != code[:-1]))) if len(code) else np.zeros(0, np.int64)
            for low, high in zip(begin, [*begin[1:], len(code)], strict=True):
                key = codes.dictionary[int(code[low])].as_py()
                if key != last or not used:
                    if used == most:
                        yield from add()
                        rows, columns, values, used = [], [], [], 0
                    last, used = key, used + 1
                rows.append(i[low:high])
                columns.append(np.full(high - low, used - 1))
                values.append(x[low:high])
        if used:
            yield from add()
        if sums:
            yield _blocks(sums)

    products = dealt.mapInArrow(multiplied, "p int, q int, cells binary")
    if every:
        last = max(0, (n - 1) // block)
        places = entries.sparkSession.range(last + 1).select(F.col("id").cast("int").alias("p"), F.explode(F.sequence(F.col("id").cast("int"), F.lit(last))).alias("q"))
        products = products.unionByName(places.withColumn("cells", F.lit(None).cast("binary")))

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place, total = None, None
        for batch in batches:
            for p, q, cells in zip(batch["p"].to_pylist(), batch["q"].to_pylist(), batch["cells"], strict=True):
                if place != (p, q):
                    if place:
                        yield _cells(place, total, n, every, block)
                    place, total = (p, q), np.zeros((block, block))
                if cells.is_valid:
                    total = total + np.frombuffer(cells.as_buffer(), np.float64).reshape(block, block)
        if place:
            yield _cells(place, total, n, every, block)

    return products.repartition("p", "q").sortWithinPartitions("p", "q").mapInArrow(summed, "i long, j long, dot double")


def _blocks(sums: dict[tuple[int, int], np.ndarray]) -> pa.RecordBatch:
    p, q = (pa.array([k[x] for k in sums], pa.int32()) for x in (0, 1))
    return pa.RecordBatch.from_arrays([p, q, pa.array([v.tobytes() for v in sums.values()], pa.binary())], ["p", "q", "cells"])


def _cells(place: tuple[int, int], total: np.ndarray, n: int, every: bool, block: int) -> pa.RecordBatch:
    x, y = (np.ones_like(total, bool) if every else total != 0).nonzero()
    i, j, dot = x + place[0] * block, y + place[1] * block, total[x, y]
    keep = (i <= j) & (j < n)
    return pa.RecordBatch.from_arrays([pa.array(i[keep]), pa.array(j[keep]), pa.array(dot[keep])], ["i", "j", "dot"])


def similarity(sketches: DataFrame, record: str, abundance: bool = False) -> DataFrame:
    """(a, b, sim), a <= b: Jaccard of the hash sets, or angular similarity of abundances, of the
    records that share a hash; from a blocked Gram product of the sketches (see gram), which
    are written, as they are read twice."""
    sketches = written(sketches.select(record, "hash", "abund"))
    sizes = sketches.groupBy(record).agg(F.count("*").alias("size"), F.sum(F.col("abund") * F.col("abund")).alias("norm"))
    records = written(ranked(sizes, record, name="id").withColumn("id", F.col("id") - 1))
    ids = records.select(F.col(record).alias("__record"), F.col("id").alias("i"))
    same = F.col(record).eqNullSafe(F.col("__record"))
    entries = sketches.join(ids, same).select("i", F.col("hash").alias("key"), (F.col("abund") if abundance else F.lit(1.0)).alias("x"))
    of = lambda at, name, x: records.select(F.col("id").alias(at), F.col(record).alias(name), F.col("size").alias(f"s_{x}"), F.col("norm").alias(f"n_{x}"))
    joined = gram(entries, records.count()).join(of("i", "a", "a"), "i").join(of("j", "b", "b"), "j")
    jaccard = F.col("dot") / (F.col("s_a") + F.col("s_b") - F.col("dot"))
    cosine = F.least(F.lit(1.0), F.col("dot") / F.sqrt(F.col("n_a").cast("double") * F.col("n_b")))
    angular = 1 - 2 * F.acos(cosine) / math.pi
    return joined.select("a", "b", (angular if abundance else jaccard).alias("sim"))


def row_distances(similarities: DataFrame, block: int = BLOCK) -> tuple[DataFrame, DataFrame]:
    """The records numbered in order, (id, record), and (i, j, e), i < j: the squared Euclidean
    distance of their rows in the similarity matrix, for all pairs, as Ward's method takes them.

    Distances come from the rows' scalar products, a Gram product over the matrix's columns.
    The similarities are written, as they are read several times.
    """
    similarities = written(similarities.select("a", "b", "sim"))
    both = similarities.select("a", "b", "sim").unionByName(similarities.filter("a <> b").select(F.col("b").alias("a"), F.col("a").alias("b"), "sim"))
    records = written(ranked(both.select(F.col("a").alias("record")).distinct(), "record", name="id"))
    n = records.count()
    of = lambda x, y: records.select(F.col("record").alias(x), (F.col("id") - 1).alias(y))
    cells = both.join(of("a", "i"), "a").join(of("b", "key"), "b").select("i", "key", F.col("sim").alias("x"))
    norms = written(cells.groupBy("i").agg(F.sum(F.col("x") * F.col("x")).alias("norm")))
    norm = lambda x: norms.select(F.col("i").alias(x), F.col("norm").alias(f"n{x}"))
    pairs = gram(cells, n, True, block).filter("i < j").join(norm("i"), "i").join(norm("j"), "j")
    square = F.greatest(F.col("ni") + F.col("nj") - 2 * F.col("dot"), F.lit(0.0))
    return records, pairs.select((F.col("i") + 1).alias("i"), (F.col("j") + 1).alias("j"), square.alias("e"))


def ward_merges(distances: DataFrame, records: DataFrame) -> DataFrame:
    """(i, j, height): the merges of Ward's method, j's cluster into i's; height is squared.

    Clusters that are each other's nearest merge at once: for Ward's method that gives the same
    tree as one merge at a time. The table holds squared distances of centroids, so that two
    merged clusters' distance is a weighted sum over their parts', less a term for each. Every
    round is a few joins and sums over the pairs; about the logarithm of the records are needed.
    """
    clusters = written(records.select("id", F.lit(1.0).alias("size")))
    pairs, merges = written(distances), None
    # The pairs are the square of the clusters, which are sent to them while they are few.
    sent = F.broadcast if clusters.count() <= BROADCAST_RECORDS else lambda x: x
    while True:
        size = lambda x: sent(clusters.select(F.col("id").alias(x), F.col("size").alias(f"s{x}")))
        sized = pairs.join(size("i"), "i").join(size("j"), "j").withColumn("d", 2 * F.col("si") * F.col("sj") / (F.col("si") + F.col("sj")) * F.col("e"))
        place = F.struct("d", "i", "j", "e", "si", "sj")
        ends = sized.select(F.explode(F.array("i", "j")).alias("id"), place.alias("p"))
        nearest_ = ends.groupBy("id").agg(F.min("p").alias("p"))
        mutual = written(nearest_.groupBy("p").agg(F.count("*").alias("n")).filter("n = 2").select("p.*"))
        if mutual.isEmpty():
            break
        step = mutual.select("i", "j", F.col("d").alias("height"))
        merges = step if merges is None else merges.unionByName(step)
        # Each cluster's new number, its weight there, and what its cluster's merge takes off.
        total = F.col("si") + F.col("sj")
        off = F.col("si") * F.col("sj") / (total * total) * F.col("e")
        moved = mutual.select(F.explode(F.array(
            F.struct(F.col("i").alias("id"), F.col("i").alias("to"), (F.col("si") / total).alias("w"), off.alias("off"), total.alias("size")),
            F.struct(F.col("j").alias("id"), F.col("i").alias("to"), (F.col("sj") / total).alias("w"), off.alias("off"), total.alias("size")),
        )).alias("m")).select("m.*")
        state = clusters.join(moved.withColumnRenamed("size", "whole"), "id", "left")
        state = state.select("id", F.coalesce("to", "id").alias("to"), F.coalesce("w", F.lit(1.0)).alias("w"), F.coalesce("off", F.lit(0.0)).alias("off"), F.coalesce("whole", "size").alias("size"))
        state = written(state)
        of = lambda x: sent(state.select(F.col("id").alias(x), F.col("to").alias(f"t{x}"), F.col("w").alias(f"w{x}"), F.col("off").alias(f"o{x}")))
        parts = pairs.join(of("i"), "i").join(of("j"), "j").filter("ti <> tj")
        summed = parts.groupBy(F.least("ti", "tj").alias("i"), F.greatest("ti", "tj").alias("j")).agg(
            F.sum(F.col("wi") * F.col("wj") * F.col("e")).alias("e"), F.max(F.col("oi") + F.col("oj")).alias("off")
        )
        pairs = written(summed.select("i", "j", F.greatest(F.col("e") - F.col("off"), F.lit(0.0)).alias("e")))
        clusters = state.filter("id = to").select("id", "size")
    return merges if merges is not None else distances.select("i", "j", F.col("e").alias("height")).limit(0)


def ward_clusters(similarities: DataFrame, clusters: int | None = 2, distance: float | None = None) -> DataFrame:
    """(record, cluster): Ward linkage on the rows of the similarity matrix, cut at a number of
    clusters or at a distance; clusters are numbered from 1 by their first record."""
    records, distances = row_distances(similarities)
    return ward_cut(written(ward_merges(distances, records)), records, clusters, distance)


def ward_cut(merges: DataFrame, records: DataFrame, clusters: int | None = 2, distance: float | None = None) -> DataFrame:
    """(record, cluster) of a tree of merges, cut at a number of clusters or at a distance."""
    if distance is not None:
        merges = merges.filter(F.sqrt("height") <= distance)
    else:
        merges = merges.orderBy("height", "i", "j").limit(max(0, records.count() - (clusters or 1)))
    linked = components(merges, "i", "j").withColumnRenamed("node", "id")
    placed = written(records.join(linked, "id", "left").select("record", F.coalesce("component", "id").alias("first")))
    numbers = ranked(placed.select("first").distinct(), "first", name="cluster")
    return placed.join(numbers, "first").select(F.col("record").cast("string").alias("record"), F.col("cluster").cast("int").alias("cluster"))


def label_table(clusters: DataFrame, prefix: str = "") -> DataFrame:
    """(accession, label): each record with the name of its cluster, <prefix>cluster_<number>."""
    return clusters.select(F.col("record").alias("accession"), F.concat(F.lit(f"{prefix}cluster_"), F.col("cluster").cast("string")).alias("label"))


def representatives(clusters: DataFrame, seed: int = 0) -> DataFrame:
    """One member of each cluster, by a seeded hash."""
    order = F.struct(F.xxhash64(F.lit(seed), "record"), "record")
    return clusters.groupBy("cluster").agg(F.min_by("record", order).alias("record"))
