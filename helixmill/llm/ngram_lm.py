"""N-gram language-model scores of whole texts, from an Elias-Fano trie in shards.

1. Every task counts its training words and sends them by ranges of their hash. The distinct
   words and their total are summed by Spark. Words so frequent that one shard should not hold
   their n-grams come to the driver: those with more than a quarter of a shard's share of all
   words, so at most four for each shard, whatever the number of distinct words.
2. Documents are dealt to blocks. A block sends its distinct n-grams, as a small trie of
   sorted ids with training counts (0 for n-grams that only held-out texts have), to the
   shards of their first words. A frequent first word's n-grams are spread over as many shards
   as its share of all words asks for.
3. A shard sums the counts of all blocks, builds the trie (monotone pointers, discounted
   probabilities as bytes) and looks every n-gram that was sent up in it. Back go, per block,
   the words' counts and one or two bytes for each longer n-gram.
4. Blocks put the answers to their texts' positions and sum the logarithms.

The model interpolates by absolute discounting: P(w|c) = max(n(cw) - D, 0)/n(c) +
D*kinds(c)/n(c) * P(w|shorter c); unseen contexts leave the shorter one's P; the shortest P is
the base. Probabilities and backoff weights are quantised to bytes, on a scale that begins at the
least value that counts of so many training tokens can give. Words on deeper levels are
known by 32 bits of their hash; level 1 and the base's counts are by 64 bits.

Nothing is collected but the numbers of step 1; all tables grow with the input and are dealt
by hash. Counts over the corpus have 64 bits. Blocks and shards grow with the square root of
the table, so that the rows between them grow with the table and not with its square. Base: log10((c + 0.5)/(N + 0.5*(V + 1))) summed over a text's words and one end.

Defined results: null and empty texts are one end token; without training rows all counts are
0; rows with null ids are held out from training if the caller's rule says null; repeated rows
count as often as they occur; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from helixmill.llm.elias_fano import Trie, floor_of, values_of
from helixmill.llm.shared import U, Words, blocked, grown, words_of, written

ORDER, DISCOUNT = 2, 0.4
BLOCK_BYTES = 4 << 20
#: Words per shard that are aimed at.
SHARD_WORDS = 1 << 21
#: Hashes of the tokens that are no words.
BEGIN, END, PAD = (U(x) for x in (0x1F3D5B79A2C4E687, 0x2E4C6A8091B3D5F7, 0x3D5B7991A2C4E6F8))


@dataclass(frozen=True)
class Vocabulary:
    """What step 1 finds: training tokens, distinct ones, shards, and the (sorted) frequent words
    with the number of shards of each."""

    tokens: int
    distinct: int
    shards: int
    frequent: np.ndarray
    spread: np.ndarray

    def base(self, counts: np.ndarray) -> np.ndarray:
        return (counts + 0.5) / (self.tokens + 0.5 * (self.distinct + 1))

    def shards_of(self, words: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
        """(first shard, number of shards) of each first word."""
        home = (words % U(self.shards)).astype(np.int64)
        many = np.ones(len(words), np.int64)
        if len(self.frequent):
            at = np.minimum(np.searchsorted(self.frequent, words), len(self.frequent) - 1)
            many = np.where(self.frequent[at] == words, self.spread[at], 1)
        return home, many


def token_counts(docs: DataFrame, text_col: str, training: Column, ranges: int, shards: int) -> DataFrame:
    """(distinct, tokens, words, counts): a row for each range of word hashes, with the words
    that have more than a quarter of a shard's share of the range's tokens."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parts, n = [np.full(batch.num_rows, END)], 0
            for _, tokens in words_of(batch.column(0), lower=True):
                parts.append(tokens.hashes)
                n += len(tokens)
            words, counts = np.unique(np.concatenate(parts), return_counts=True)
            cut = np.searchsorted(words, (np.arange(1, ranges) * (2**64 // ranges)).astype(np.uint64))
            pairs = zip(np.split(words, cut), np.split(counts, cut), strict=True)
            rows = [(i, w.tobytes(), c.astype(np.int64).tobytes()) for i, (w, c) in enumerate(pairs) if len(w)]
            columns = list(zip(*rows, strict=True)) or [(), (), ()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(columns[0], pa.int32()), pa.array(columns[1], pa.binary()), pa.array(columns[2], pa.binary())],
                names=["range", "words", "counts"],
            )

    def merge(group: pa.Table) -> pa.Table:
        words = np.concatenate([np.frombuffer(x, np.uint64) for x in group.column("words").to_pylist()])
        counts = np.concatenate([np.frombuffer(x, np.int64) for x in group.column("counts").to_pylist()])
        words, at = np.unique(words, return_inverse=True)
        sums = np.bincount(at, weights=counts).astype(np.int64)
        top = np.flatnonzero(sums * shards * 4 > sums.sum())
        return pa.table({
            "distinct": pa.array([len(words)], pa.int64()), "tokens": pa.array([int(sums.sum())], pa.int64()),
            "words": pa.array([words[top].view(np.int64).tolist()], pa.list_(pa.int64())),
            "counts": pa.array([sums[top].tolist()], pa.list_(pa.int64())),
        })

    texts = docs.filter(training).select(F.col(text_col).cast("string").alias("text"))
    sent = texts.mapInArrow(count, "range int, words binary, counts binary")
    return sent.groupBy("range").applyInArrow(merge, "distinct bigint, tokens bigint, words array<bigint>, counts array<bigint>")


def shards_for(total: int) -> int:
    """Shards for a table of `total` bytes; one is as large as three blocks, if that is more."""
    return max(1, -(-total // (6 * max(SHARD_WORDS, 3 * grown(BLOCK_BYTES, total) // 6))))


def vocabulary(docs: DataFrame, text_col: str, training: Column, total_bytes: int) -> Vocabulary:
    shards = shards_for(total_bytes)
    rows = written(token_counts(docs, text_col, training, max(8, shards // 2), shards))
    sums = rows.agg(F.sum("tokens").alias("tokens"), F.sum("distinct").alias("distinct")).first()
    tokens, distinct = sums["tokens"] or 0, sums["distinct"] or 0
    pairs = rows.select(F.explode(F.arrays_zip("words", "counts")).alias("p")).select("p.words", "p.counts")
    frequent = pairs.filter(F.col("counts").cast("decimal(38,0)") * (shards * 4) > tokens).collect()
    many = {r["words"] % 2**64: min(shards, -(-r["counts"] * shards * 4 // tokens)) for r in frequent}
    words = np.array(sorted(many), np.uint64)
    return Vocabulary(tokens, distinct, shards, words, np.array([many[int(w)] for w in words], np.int64))


class Grams:
    """The n-grams of one run of texts: words, levels, and each position's place in them."""

    def __init__(self, tokens: Words, training: np.ndarray, order: int):
        counts = np.diff(tokens.first)
        # order-1 begins, the words, one end, order-1 pads
        size = counts + 1 + 2 * (order - 1)
        start = np.cumsum(size) - size
        line = np.full(int(size.sum()), PAD)
        for i in range(order - 1):
            line[start + i] = BEGIN + U(i)  # each its own, or a context of fewer would count twice
        shift = np.repeat(start + order - 1 - tokens.first[:-1], counts)
        line[shift + np.arange(len(tokens.hashes))] = tokens.hashes
        line[start + order - 1 + counts] = END
        windows = counts + order  # one per begin, word and end; none begins with a pad
        first = np.repeat(start - (np.cumsum(windows) - windows), windows) + np.arange(int(windows.sum()))
        self.columns = [line[first + i] for i in range(order)]
        self.train = np.repeat(training, windows)
        #: Windows that begin at a real token, and the text of each.
        text = np.repeat(np.arange(len(counts)), windows)
        place = np.arange(len(first)) - np.repeat(np.cumsum(windows) - windows, windows)
        self.real, self.text = place >= order - 1, text


class Packed:
    """Distinct n-grams of a block as sorted levels, made from its runs of texts."""

    def __init__(self, runs: list[Grams], order: int):
        columns = [np.concatenate([r.columns[i] for r in runs]) for i in range(order)]
        train = np.concatenate([r.train for r in runs])
        self.words, at = np.unique(columns[0], return_inverse=True)
        self.counts = np.bincount(at, weights=train, minlength=len(self.words)).astype(np.int64)
        #: Per level: parent, id, training count; and each window's place on it.
        self.levels, self.places = [], [at]
        for column in columns[1:]:
            key = (at.astype(np.uint64) << U(32)) | (column >> U(32))
            keys, at = np.unique(key, return_inverse=True)
            own = np.bincount(at, weights=train, minlength=len(keys)).astype(np.int64)
            self.levels.append(((keys >> U(32)).astype(np.int64), (keys & U(2**32 - 1)).astype(np.uint32), own))
            self.places.append(at)

    def split(self, vocabulary: Vocabulary) -> Iterator[tuple[int, list[np.ndarray]]]:
        """(shard, index of its nodes on each level) for the shards that get n-grams."""
        home, many = vocabulary.shards_of(self.words)
        parent, ids, _ = self.levels[0]
        shard2 = (home[parent] + ids % many[parent]) % vocabulary.shards
        shard1 = [home] + [np.where(many > i, (home + i) % vocabulary.shards, -1) for i in range(1, int(many.max(initial=1)))]
        shards = [shard2]
        for parent, _, _ in self.levels[1:]:
            shards.append(shards[-1][parent])
        owner = np.concatenate(shard1)
        node = np.tile(np.arange(len(home)), len(shard1))
        first = _by_shard(owner, node)
        rest = [_by_shard(s, np.arange(len(s))) for s in shards]
        for shard in sorted(first):
            if shard >= 0:
                yield shard, [np.sort(first[shard]), *[r.get(shard, np.zeros(0, np.int64)) for r in rest]]


def _by_shard(shard: np.ndarray, node: np.ndarray) -> dict[int, np.ndarray]:
    order = np.argsort(shard, kind="stable")
    values, at = np.unique(shard[order], return_index=True)
    return dict(zip(values.tolist(), np.split(node[order], at[1:]), strict=True))


def _small(values: np.ndarray) -> bytes:
    """Counts as one byte each, or four if any needs more; the first byte tells."""
    wide = int(values.max(initial=0) > 255)
    return bytes([wide]) + values.astype(np.uint32 if wide else np.uint8).tobytes()


def _large(raw: bytes) -> np.ndarray:
    return np.frombuffer(raw, np.uint32 if raw[0] else np.uint8, offset=1).astype(np.int64)


def _fields(order: int, answer: bool) -> str:
    if answer:
        more = ", ".join(f"__p{i} binary, __b{i} binary" for i in range(1, order))
        return f"__block int, __shard int, __counts binary, __kinds binary, {more}"
    more = ", ".join(f"__deg{i} binary, __id{i} binary, __n{i} binary" for i in range(1, order))
    return f"__block int, __shard int, __words binary, __counts binary, {more}"


def _table(rows: list[tuple], schema: str) -> pa.Table:
    kinds = {"int": pa.int32(), "binary": pa.binary()}
    fields = [x.split() for x in schema.split(", ")]
    columns = list(zip(*rows, strict=True)) if rows else [()] * len(fields)
    return pa.table({n: pa.array(list(c), kinds[t]) for (n, t), c in zip(fields, columns, strict=True)})


def _runs(group: pa.Table, order: int) -> list[tuple[int, Grams]]:
    training = group.column("__train").to_numpy(zero_copy_only=False).astype(bool)
    return [(row, Grams(t, training[row : row + len(t)], order)) for row, t in words_of(group.column("__text"), lower=True)]


def _send(vocabulary: Vocabulary, order: int):
    def send(group: pa.Table) -> pa.Table:
        packed = Packed([g for _, g in _runs(group, order)], order)
        rows = []
        for shard, nodes in packed.split(vocabulary):
            row = [group.column("__block")[0].as_py(), shard, packed.words[nodes[0]].tobytes(), _small(packed.counts[nodes[0]])]
            for i, (parent, ids, own) in enumerate(packed.levels):
                at = nodes[i + 1]
                degrees = np.bincount(np.searchsorted(nodes[i], parent[at]), minlength=len(nodes[i]))
                row += [_small(degrees), ids[at].tobytes(), _small(own[at])]
            rows.append(tuple(row))
        return _table(rows, _fields(order, False))

    return send


def _answer(order: int, discount: float, floor: float):
    def answer(group: pa.Table) -> pa.Table:
        rows = group.to_pylist()
        words = np.concatenate([np.frombuffer(r["__words"], np.uint64) for r in rows])
        counts = np.concatenate([_large(r["__counts"]) for r in rows])
        every, at = np.unique(words, return_inverse=True)
        total = np.bincount(at, weights=counts, minlength=len(every)).astype(np.int64)
        ends = [np.cumsum([len(r["__words"]) // 8 for r in rows])]
        seen = total > 0
        # Nodes are numbered among all that were sent; the trie has those with counts.
        levels, sent, place, renumber = [], [], at, np.cumsum(seen) - 1
        for i in range(1, order):
            degrees = np.concatenate([_large(r[f"__deg{i}"]) for r in rows])
            ids = np.concatenate([np.frombuffer(r[f"__id{i}"], np.uint32) for r in rows])
            own = np.concatenate([_large(r[f"__n{i}"]) for r in rows])
            ends.append(np.cumsum([len(r[f"__id{i}"]) // 4 for r in rows]))
            key = (np.repeat(place, degrees).astype(np.uint64) << U(32)) | ids
            keys, place = np.unique(key, return_inverse=True)
            sums = np.bincount(place, weights=own, minlength=len(keys)).astype(np.int64)
            parent, ids = (keys >> U(32)).astype(np.int64), (keys & U(2**32 - 1)).astype(np.uint32)
            kept = sums > 0
            levels.append((renumber[parent[kept]], ids[kept], sums[kept]))
            sent.append((parent, ids, place))
            renumber = np.cumsum(kept) - 1
        trie = Trie(every[seen], total[seen], levels, discount, floor)
        node = trie.roots(every)
        known = np.maximum(node, 0)
        kinds = np.where(node >= 0, _take(trie.children[0], known), 0)
        back = [(total[at], kinds[at])]
        for i, (parent, ids, place) in enumerate(sent):
            node = trie.find(i, node[parent], ids)
            known = np.maximum(node, 0)
            code = np.where(node >= 0, _take(trie.codes[i], known), 0).astype(np.uint8)
            last = i + 2 == order
            weight = np.zeros(0, np.uint8) if last else np.where(node >= 0, _take(trie.backoffs[i + 1], known), 0).astype(np.uint8)
            back.append((code[place], weight if last else weight[place]))
        out = []
        for j, r in enumerate(rows):
            span = [slice(int(e[j - 1]) if j else 0, int(e[j])) for e in ends]
            row = [r["__block"], r["__shard"], back[0][0][span[0]].astype(np.int64).tobytes(), _small(back[0][1][span[0]])]
            for i in range(1, order):
                code, weight = back[i]
                row += [code[span[i]].tobytes(), weight[span[i]].tobytes() if len(weight) else b""]
            out.append(tuple(row))
        return _table(out, _fields(order, True))

    return answer


def _take(values: np.ndarray, at: np.ndarray) -> np.ndarray:
    return values[at] if len(values) else np.zeros(len(at), np.int64)


def _score(vocabulary: Vocabulary, order: int, discount: float, kind: pa.DataType):
    names = ["doc_id", "n_tokens", "n_known", "base_score", "score"]
    kinds = [kind, pa.int64(), pa.int64(), pa.float64(), pa.float64()]
    values = values_of(floor_of(vocabulary.tokens, discount))

    def score(group: pa.Table, answers: pa.Table) -> pa.Table:
        if not group.num_rows:
            return pa.table([pa.array([], k) for k in kinds], names=names)
        runs = _runs(group, order)
        packed = Packed([g for _, g in runs], order)
        said = {r["__shard"]: r for r in answers.to_pylist()}
        counts, contexts = np.zeros(len(packed.words), np.int64), np.zeros(len(packed.words), np.int64)
        codes = [np.zeros(len(x[0]), np.uint8) for x in packed.levels]
        weights = [np.zeros(len(x[0]), np.uint8) for x in packed.levels]
        for shard, nodes in packed.split(vocabulary):
            r = said[shard]
            counts[nodes[0]] = np.frombuffer(r["__counts"], np.int64)
            contexts[nodes[0]] += _large(r["__kinds"])
            for i in range(1, order):
                codes[i - 1][nodes[i]] = np.frombuffer(r[f"__p{i}"], np.uint8)
                if r[f"__b{i}"]:
                    weights[i - 1][nodes[i]] = np.frombuffer(r[f"__b{i}"], np.uint8)
        # Nodes of level 1: base probability and the weight of what lies below their context.
        base = vocabulary.base(counts)
        backoff = [np.where(counts > 0, discount * contexts / np.maximum(counts, 1), 1.0)]
        backoff += [np.where(w > 0, values[w], 1.0) for w in weights[:-1]]
        known_gram = [values[c] for c in codes]
        text = np.concatenate([g.text + row for row, g in runs])
        real = np.concatenate([g.real for _, g in runs])
        where = np.flatnonzero(real)
        place = packed.places
        p = base[place[0][where]]
        logs = np.log10(p)
        for i in range(1, order):  # contexts of i words: windows that begin i earlier
            p = known_gram[i - 1][place[i][where - i]] + backoff[i - 1][place[i - 1][where - i]] * p
        n = group.num_rows
        tally = lambda w=None: np.bincount(text[where], weights=w, minlength=n)
        known = tally((counts[place[0][where]] > 0).astype(float))
        ids = group.column("__id").combine_chunks()
        columns = [tally().astype(np.int64), known.astype(np.int64), tally(logs), tally(np.log10(p))]
        return pa.table([ids, *[pa.array(c, k) for c, k in zip(columns, kinds[1:], strict=True)]], names=names)

    return score


def scored(
    docs: DataFrame, training: Column, id_col: str = "doc_id", text_col: str = "text",
    order: int = ORDER, discount: float = DISCOUNT,
) -> DataFrame:
    """(id, n_tokens, n_known, train_tokens, base_score, score) of every row; `training` is an
    expression on docs that says which rows the model learns from."""
    rule = F.coalesce(training, F.lit(False))
    flagged = docs.select(F.col(id_col), F.col(text_col), rule.alias("__train"))
    blocks, total = blocked(flagged, id_col, text_col, BLOCK_BYTES, "__train")
    known = vocabulary(flagged, text_col, F.col("__train"), total)
    sent = blocks.groupBy("__block").applyInArrow(_send(known, order), _fields(order, False))
    answers = sent.groupBy("__shard").applyInArrow(_answer(order, discount, floor_of(known.tokens, discount)), _fields(order, True))
    kind = docs.schema[id_col].dataType
    out = blocks.groupBy("__block").cogroup(answers.groupBy("__block")).applyInArrow(
        _score(known, order, discount, to_arrow_type(kind)),
        f"doc_id {kind.simpleString()}, n_tokens bigint, n_known bigint, base_score double, score double",
    )
    return out.withColumn("train_tokens", F.lit(known.tokens).cast("long")).withColumnRenamed("doc_id", id_col)
