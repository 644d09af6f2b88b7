"""Where k-mers and motifs occur in reference sequences."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import product

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from helixmill.functions import sequence as S
from helixmill.operators.intervals import merge
from helixmill.operators.kmers import CHUNK
from helixmill.operators.tables import written

#: K-mer tables of up to this number of rows are broadcast.
BROADCAST_KMERS = 200_000


def map_kmers(kmers: DataFrame, references: DataFrame, k: int) -> DataFrame:
    """(id, kmer, chrom, start, strand): exact hits of k-mers on both strands.

    kmers has id and kmer, references chrom and seq. Of equal k-mers the last id counts.
    Reference windows are looked up once as they are and once complemented; the k-mers are
    broadcast while few, else both sides are shuffled by k-mer.
    """
    table = written(kmers.groupBy("kmer").agg(F.max("id").alias("id")))
    pieces = references.select("chrom", F.posexplode(S.chunks(F.col("seq"), CHUNK, k - 1)).alias("__number", "__piece"))
    cut = pieces.select("chrom", "__number", F.posexplode(S.windows(F.col("__piece"), k)).alias("__at", "window"))
    windows = cut.select("chrom", (F.col("__number").cast("long") * CHUNK + F.col("__at")).alias("start"), "window")
    both = table.select("id", "kmer", F.col("kmer").alias("window"), F.lit("+").alias("strand")).unionByName(
        table.select("id", "kmer", S.reverse_complement(F.col("kmer")).alias("window"), F.lit("-").alias("strand"))
    )
    both = F.broadcast(both) if table.count() <= BROADCAST_KMERS else both
    return windows.join(both, "window").select("id", "kmer", "chrom", "start", "strand")


def as_sam(hits: DataFrame, k: int, compat: bool = False) -> DataFrame:
    """The eleven mandatory SAM columns of hits.

    Positions are 1-based and sequences on the forward strand; compat adds the reference's
    shift of one and keeps reverse hits as the k-mer reads.
    """
    shift = 2 if compat else 1
    seq = F.col("kmer") if compat else F.when(F.col("strand") == "-", S.reverse_complement(F.col("kmer"))).otherwise(F.col("kmer"))
    return hits.select(
        F.col("id").cast("string").alias("qname"), F.when(F.col("strand") == "-", 16).otherwise(0).alias("flag"),
        F.col("chrom").cast("string").alias("rname"), (F.col("start") + shift).alias("pos"), F.lit(42).alias("mapq"),
        F.lit(f"{k}M").alias("cigar"), F.lit("*").alias("rnext"), F.lit(0).alias("pnext"), F.lit(0).alias("tlen"),
        seq.alias("seq"), F.lit("*").alias("qual"),
    )


def as_regions(hits: DataFrame, k: int) -> DataFrame:
    """Hits as merged intervals."""
    return merge(hits.select("chrom", "start", (F.col("start") + k).alias("end")))


class Motifs:
    """Many motifs looked up in one text at once.

    The text's places are sorted by their four letters, once for all motifs; a motif looks where
    its least ambiguous four letters can be and checks its other letters there. Letters that
    are no code stand for themselves, and only plain upper-case bases match a code.
    """

    Q = 4

    def __init__(self, motifs: list[str]):
        self.entries = []
        for number, motif in enumerate(motifs):
            letters = [np.array([ord(b) for b in S.IUPAC.get(c, c)], np.uint8) for c in motif.upper()]
            wide = [(int(np.prod([len(x) for x in letters[i : i + self.Q]])), i) for i in range(len(letters) - self.Q + 1) if all(c in S.IUPAC for c in motif.upper()[i : i + self.Q])]
            at, words = None, np.zeros(0, np.int64)
            if wide:
                _, at = min(wide)
                words = np.array([sum(_BASE[x] << 2 * (self.Q - 1 - i) for i, x in enumerate(w)) for w in product(*letters[at : at + self.Q])])
            self.entries.append((number, letters, at, words))

    def find(self, text: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
        """(motif, its places), for every motif that occurs."""
        code = _BASE[text]
        n, q = len(text), self.Q
        word, plain = np.zeros(max(0, n - q + 1), np.int64), np.ones(max(0, n - q + 1), bool)
        for i in range(q):
            part = code[i : i + len(word)]
            word = word << 2 | part & 3
            plain &= part < 4
        places = np.flatnonzero(plain)
        places = places[np.argsort(word[places], kind="stable")]
        bounds = np.searchsorted(word[places], np.arange(4**q + 1))
        for number, letters, at, words in self.entries:
            k = len(letters)
            if not k or k > n:
                continue
            here = np.arange(n - k + 1) if at is None else np.concatenate([places[bounds[w] : bounds[w + 1]] for w in words]) - at
            here = here[(here >= 0) & (here <= n - k)]
            for i, bases in enumerate(letters):
                if at is None or not at <= i < at + q:
                    here = here[np.isin(text[here + i], bases) if len(bases) > 1 else text[here + i] == bases[0]]
            if len(here):
                yield number, np.sort(here)


def letters_of(text: str) -> np.ndarray:
    """A text's code points, as bytes where it is plain ASCII."""
    return np.frombuffer(text.encode(), np.uint8) if text.isascii() else np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)


def spelled(words: list[str]) -> np.ndarray:
    """Words of one length as rows of code points."""
    return np.array([[ord(c) for c in w] for w in words], np.uint32)


class Seeds:
    """Words of one length looked up in one text at once.

    The text's windows become 64-bit numbers; a table of flags tells most that are no word, the
    others are searched among the words' sorted numbers and compared letter by letter.
    """

    MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)
    #: Candidates that are compared at once.
    CANDIDATES = 1 << 16

    def __init__(self, letters: np.ndarray):
        """letters: a row of code points for each word."""
        self.k = letters.shape[1]
        number = self.numbers(letters.ravel())[:: self.k]
        self.order = np.argsort(number, kind="stable")
        self.letters, self.number = letters[self.order], number[self.order]
        self.shift = np.uint64(64 - max(16, min(24, (64 * len(letters)).bit_length())))
        self.flags = np.zeros(1 << (64 - int(self.shift)), bool)
        self.flags[self.number >> self.shift] = True

    def numbers(self, text: np.ndarray) -> np.ndarray:
        """The number of every window."""
        out = np.zeros(len(text) - self.k + 1, np.uint64)
        for i in range(self.k):
            out *= self.MULTIPLIER
            out += text[i : i + len(out)]
        out *= self.MULTIPLIER
        out ^= out >> np.uint64(29)
        out *= self.MULTIPLIER
        return out

    def find(self, text: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(places, words): the places of the words, by their numbers in the given list, in lots."""
        if len(text) < self.k:
            return
        number = self.numbers(text)
        places = np.flatnonzero(self.flags[number >> self.shift])
        number = number[places]
        low, high = np.searchsorted(self.number, number), np.searchsorted(self.number, number, "right")
        places, low, n = places[high > low], low[high > low], (high - low)[high > low]
        ends = np.cumsum(n)
        at = 0
        while at < len(places):
            to = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + self.CANDIDATES, "right")))
            count = n[at:to]
            row = np.repeat(np.arange(at, to), count)
            entry = low[row] + np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count)
            same = (text[places[row][:, None] + np.arange(self.k)] == self.letters[entry]).all(axis=1)
            yield places[row[same]], self.order[entry[same]]
            at = to


def joined_texts(texts: list[str], lot: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first, letters, begins): lots of texts of about `lot` letters, one behind the other with a
    zero after each; begins has one entry more than the lot has texts."""
    low = 0
    while low < len(texts):
        high, letters = low, 0
        while high < len(texts) and (high == low or letters + len(texts[high]) < lot):
            letters += len(texts[high]) + 1
            high += 1
        begin = np.cumsum([0] + [len(t) + 1 for t in texts[low:high]])
        yield low, letters_of("\0".join(texts[low:high]) + "\0"), begin
        low = high


def present(kmers: DataFrame, records: DataFrame, kept: tuple[str, ...]) -> DataFrame:
    """(id, kept...): the ids of the k-mers that a record holds, a row for each id of a record.

    kmers (id, kmer) are a panel, sent along as a broadcast value, of any lengths; records have
    kept and seq. Records go through one by one, so nothing is shuffled.
    """
    panel = kmers.select("id", "kmer").filter("length(kmer) > 0").collect()
    shared = records.sparkSession.sparkContext.broadcast(panel)
    id_kind, own = to_arrow_type(kmers.schema["id"].dataType), len(kept)

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids = pa.array([r["id"] for r in shared.value], id_kind)
        indexes = []
        for k in sorted({len(r["kmer"]) for r in shared.value}):
            numbers = [i for i, r in enumerate(shared.value) if len(r["kmer"]) == k]
            indexes.append((np.array(numbers), Seeds(spelled([shared.value[i]["kmer"] for i in numbers]))))
        for batch in batches:
            texts = [x or "" for x in batch.column(own).to_pylist()]
            for low, text, begin in joined_texts(texts, LOT):
                for numbers, index in indexes:
                    pairs = [np.zeros(0, np.int64)]
                    for places, words in index.find(text):
                        pairs.append(np.unique((np.searchsorted(begin, places, "right") - 1) * len(ids) + numbers[words]))
                    pair = np.unique(np.concatenate(pairs))
                    if len(pair):
                        row = pa.array(low + pair // len(ids))
                        yield pa.RecordBatch.from_arrays([ids.take(pa.array(pair % len(ids))), *[batch.column(i).take(row) for i in range(own)]], ["id", *kept])

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in records.select(*kept).schema.fields)
    return records.select(*kept, "seq").mapInArrow(found, f"id {kmers.schema['id'].dataType.simpleString()}, {fields}")


_BASE = np.full(256, 4, np.int64)
_BASE[[*b"ACGT"]] = range(4)
#: Letters of the pieces that are searched together, about.
LOT = 1 << 20


def _motif_places(motifs: list[str], records: DataFrame, record: str, both_strands: bool) -> DataFrame:
    """(record, number, start): each motif's places; minus strands have numbers behind the motifs."""
    every = [*motifs, *[_complement(m) for m in motifs]] if both_strands else list(motifs)
    longest = max((len(m) for m in motifs), default=1)
    size = CHUNK
    pieces = records.select(record, F.length("seq").cast("long").alias("__length"), F.posexplode(S.chunks(F.col("seq"), size, max(0, longest - 1))).alias("__at", "__piece"))
    sizes = np.array([len(m) for m in every], np.int64)

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = Motifs(every)
        for batch in batches:
            texts = [(x.as_py() or "").encode("ascii", "replace") for x in batch.column(3)]
            lengths, at = batch.column(1).to_numpy(zero_copy_only=False), batch.column(2).to_numpy().astype(np.int64)
            low = 0
            while low < len(texts):
                high, letters = low, 0
                while high < len(texts) and (high == low or letters + len(texts[high]) < LOT):
                    letters += len(texts[high]) + 1
                    high += 1
                begin = np.cumsum([0] + [len(t) + 1 for t in texts[low : high - 1]])
                for number, places in index.find(np.frombuffer(b"\0".join(texts[low:high]), np.uint8)):
                    row = np.searchsorted(begin, places, "right") - 1
                    inside = places - begin[row]
                    own = inside < size  # what begins in the overlap is the next piece's, if there is one
                    own |= at[low + row] == np.maximum(lengths[low + row] - longest, 0) // size
                    row, inside = low + row[own], inside[own]
                    start = at[row] * size + inside
                    if number >= len(motifs):
                        start = lengths[row] - sizes[number] - start
                    if len(row):
                        numbers = pa.array(np.full(len(row), number, np.int32))
                        yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(row)), numbers, pa.array(start)], [record, "number", "start"])
                low = high

    kind = records.schema[record].dataType.simpleString()
    return pieces.mapInArrow(found, f"`{record}` {kind}, number int, start long")


def _complement(motif: str) -> str:
    return "".join(S.COMPLEMENT.get(c, c) for c in reversed(motif.upper()))


def motif_hits(motifs: list[str], records: DataFrame, record: str, both_strands: bool = False) -> DataFrame:
    """(motif, record, start): every place of every motif in every record, from 0 (on the minus
    strand counted along it); all motifs are looked up in one pass over pieces of the records."""
    hits = _motif_places(motifs, records, record, both_strands)
    names = F.array(*[F.lit(m) for m in motifs]) if motifs else F.array().cast("array<string>")
    motif = F.get(names, F.col("number") % F.lit(max(1, len(motifs))))
    strand = [F.when(F.col("number") < len(motifs), "+").otherwise("-").alias("strand")] if both_strands else []
    return hits.select(motif.alias("motif"), record, "start", *strand)


def motif_scores(motifs: list[str], records: DataFrame, record: str, least: int = 0) -> DataFrame:
    """(motif, n_records, score): completeness of each motif over all records, 0 to 1000."""
    present = motif_hits(motifs, records, record).select("motif", record).distinct().groupBy("motif").agg(F.count("*").alias("n_records"))
    total = records.select(record).distinct().agg(F.count("*").alias("__total"))
    score = S.set_score(F.col("n_records"), F.col("__total"))
    return present.crossJoin(F.broadcast(total)).select("motif", "n_records", score.alias("score")).filter(F.col("score") >= least)
