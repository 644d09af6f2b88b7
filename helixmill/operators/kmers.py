"""K-mer tables: counting, conservation, set algebra, samples.

Counting works on packed k-mers: windows of plain bases are numbers of two bits a letter, made
and summed for each Arrow batch before anything is shuffled, so that a shuffled row is a number
and a count instead of a string, and repeats inside a batch are one row. Windows with other
letters, and k above 31, go the same way as strings.
"""

from __future__ import annotations

from collections.abc import Iterator
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from helixmill.functions import sequence as S
from helixmill.operators.tables import ranked


#: Letters of a sequence that are cut into windows at once: a genome's windows never stand in one row.
CHUNK = 1 << 15


def exploded(records: DataFrame, k: int, full: bool = True, seq: str = "seq", keep: tuple[str, ...] = ()) -> DataFrame:
    """(keep..., kmer), a row per window. Other columns don't reach the explosion.

    Sequences are first cut into overlapping pieces, so that neither time nor a row's size
    grows faster than the sequence.
    """
    whole = F.col(seq) if full else F.left(F.col(seq), F.length(seq) - 1)
    pieces = records.select(*keep, F.explode(S.chunks(whole, CHUNK, k - 1)).alias("__piece"))
    return pieces.select(*keep, F.explode(S.windows(F.col("__piece"), k)).alias("kmer"))


#: Letters of a row where rows are only summed: a batch counts rows, so that long sequences would fill it with hundreds of MB.
PIECE = 1 << 10
#: Letters whose windows are summed together in one batch, about.
LOT = 1 << 20
#: Counts (8 bytes each) that a task holds at most where groups are few next to their windows.
HELD = 1 << 22
_CODE = np.full(256, 4, np.uint8)
_CODE[[*b"ACGT"]] = range(4)


_COMPLEMENT = np.arange(256, dtype=np.uint8)
_COMPLEMENT[[ord(c) for c in S.COMPLEMENT]] = [ord(c) for c in S.COMPLEMENT.values()]


class _Lot:
    """Windows of some rows, summed by row group. Letters are held, and windows made of a group at a time."""

    def __init__(self, k: int, strands: bool):
        self.k, self.strands = k, strands
        self.texts: dict[int, list[bytes]] = {}
        self.plain: list[tuple[np.ndarray, np.ndarray]] = []
        self.lettered: list[tuple[np.ndarray, np.ndarray]] = []
        self.other: dict[tuple[int, str], int] = {}
        self.letters = 0

    def add(self, group: int, seq: str) -> None:
        k = self.k
        self.letters += len(seq)
        if len(seq) < k:
            return
        if not seq.isascii():
            for i in range(len(seq) - k + 1):
                self._string(group, seq[i : i + k], 1)
            return
        self.texts.setdefault(group, []).append(seq.encode())

    def number(self, cells: np.ndarray | None = None, place: np.ndarray | None = None) -> None:
        """Makes the windows; with `cells`, plain ones are added up in the row `place` of their group."""
        k = self.k
        for group, texts in self.texts.items():
            data = np.frombuffer(b"\0".join(texts), np.uint8)
            end = np.zeros(len(data), bool)
            end[np.cumsum([len(t) + 1 for t in texts[:-1]], dtype=np.int64) - 1] = True
            code = _CODE[data]
            plain = _without(code > 3, k)
            if k > 31:
                plain[:] = False
            other = np.flatnonzero(_without(end, k) & ~plain)
            code &= 3
            for back in (False, True)[: 2 if self.strands else 1]:
                if not plain.any():
                    break
                number = np.zeros(len(plain), np.int32 if k <= 15 else np.int64)
                for j in range(k):
                    number <<= 2
                    number |= 3 - code[k - 1 - j :][: len(number)] if back else code[j:][: len(number)]
                number = number[plain]
                if cells is None:
                    self.plain.append((np.full(len(number), group, np.int32), number))
                else:
                    cells[place[group]] += np.bincount(number, minlength=cells.shape[1])
            if len(other):
                windows = np.lib.stride_tricks.sliding_window_view(data, k)[other]
                for letters in (windows, _COMPLEMENT[windows[:, ::-1]])[: 2 if self.strands else 1]:
                    self.lettered.append((np.full(len(letters), group), np.ascontiguousarray(letters).view(f"S{k}").ravel()))
        self.texts = {}

    def _string(self, group: int, word: str, n: int) -> None:
        for w in (word, "".join(S.COMPLEMENT.get(c, c) for c in reversed(word)))[: 2 if self.strands else 1]:
            self.other[group, w] = self.other.get((group, w), 0) + n

    def sums(self, into: np.ndarray | None = None) -> tuple[np.ndarray, pa.Array, pa.Array, pa.Array]:
        """(group, code, other, n); with `into`, the group that each goes into, the highest of
        the sums of the groups that go into one."""
        group, code, n = _counted(self.plain, np.int64, into)
        # Windows with other letters, by their number among the lot's.
        words, at = np.zeros(0, f"S{self.k}"), []
        if self.lettered:
            words, number = _numbered(np.concatenate([w for _, w in self.lettered]), self.k)
            at = [(np.concatenate([g for g, _ in self.lettered]), number)]
        other_group, number, other_n = _counted(at, np.int64, into)
        texts = dict(self.other)
        if into is not None:
            texts = {}
            for (g, w), count in self.other.items():
                texts[int(into[g]), w] = max(count, texts.get((int(into[g]), w), 0))
        more = len(number) + len(texts)
        code = pa.concat_arrays([pa.array(code, pa.int64()), pa.nulls(more, pa.int64())])
        named = pa.array(words[number].astype(f"U{self.k}"), pa.string())
        other = pa.concat_arrays([pa.nulls(len(group), pa.string()), named, pa.array([w for _, w in texts], pa.string())])
        counts = pa.array(np.concatenate((n, other_n, np.fromiter(texts.values(), np.int64, len(texts)))), pa.int64())
        return np.concatenate((group, other_group, np.fromiter((g for g, _ in texts), np.int64, len(texts)))), code, other, counts


def _without(marked: np.ndarray, k: int) -> np.ndarray:
    """Which windows of k letters hold no marked one."""
    n = np.zeros(len(marked) + 1, np.int32)
    np.cumsum(marked, dtype=np.int32, out=n[1:])
    return n[k:] == n[:-k]


def _numbered(words: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The distinct words and each one's number among them; up to 8 letters are sorted as one integer."""
    if k > 8:
        return np.unique(words, return_inverse=True)
    keys, first, number = np.unique(words.astype("S8").view(">u8").astype(np.uint64), return_index=True, return_inverse=True)
    return words[first], number


def _counted(parts: list[tuple[np.ndarray, np.ndarray]], kind: type, into: np.ndarray | None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(group, code, n) of the parts' (group, code) rows, by group and code; see _Lot.sums for `into`."""
    if not parts:
        return (np.zeros(0, kind),) * 3
    group, code = (np.concatenate(x) for x in zip(*parts, strict=True))
    order = np.lexsort((code, group))
    group, code = group[order], code[order]
    first = _changes(group, code)
    n = np.diff(np.append(first, len(group)))
    group, code = group[first], code[first]
    if into is not None:
        group = into[group]
        order = np.lexsort((code, group))
        group, code, n = group[order], code[order], n[order]
        first = _changes(group, code)
        group, code, n = group[first], code[first], np.maximum.reduceat(n, first)
    return group, code, n


def _changes(group: np.ndarray, code: np.ndarray) -> np.ndarray:
    return np.flatnonzero(np.concatenate(([True], (group[1:] != group[:-1]) | (code[1:] != code[:-1]))))


def packed(
    records: DataFrame, k: int, full: bool = True, seq: str = "seq", keep: tuple[str, ...] = (), strands: bool = False, alone: str | None = None
) -> DataFrame:
    """(keep..., code, other, n): windows with their numbers, in sums that a batch has made of
    rows with equal `keep`; so a window stands in several rows, and n has to be summed.

    code is the window in two bits a letter, other the window itself where it has other letters
    than plain bases (one of the two is null). strands also counts every reverse complement.
    Null sequences and those shorter than k have no windows. Where the column `alone` of `keep`
    holds, rows are summed one by one and n is the highest of those sums.
    """
    whole = F.col(seq) if full else F.left(F.col(seq), F.length(seq) - 1)
    flag = keep.index(alone) if alone else None
    pieces = records.select(*keep, F.explode(S.chunks(whole, max(PIECE, 16 * k) if flag is None else CHUNK, k - 1)).alias("__piece"))

    # Groups with many windows have a row of counts, which a task holds over its batches.
    width = 4**k if k <= 10 and flag is None else HELD + 1
    kinds = [f.dataType for f in pieces.schema.fields[:-1]]

    def counted(slots: dict[tuple, int], cells: np.ndarray) -> Iterator[pa.RecordBatch]:
        held, step = list(slots), max(1, LOT // 4 // width)
        for low in range(0, len(held), step):
            slot, code = cells[low : min(low + step, len(held))].nonzero()
            columns = [pa.array([name[c] for name in held[low : low + step]], to_arrow_type(t)).take(pa.array(slot)) for c, t in enumerate(kinds)]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(code), pa.nulls(len(code), pa.string()), pa.array(cells[low + slot, code])], [*keep, "code", "other", "n"])

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        slots: dict[tuple, int] = {}
        cells = np.zeros((max(1, HELD // width), width) if width <= HELD else (0, 0), np.int64)
        for batch in batches:
            names = list(zip(*[batch.column(i).to_pylist() for i in range(len(keep))], strict=True)) if keep else [()] * batch.num_rows
            lot, groups, rows, into = _Lot(k, strands), {}, [], []
            for i, piece in enumerate(batch.column(len(keep))):
                group = groups.get(names[i], -1)
                if group < 0 or flag is not None and names[i][flag]:
                    into.append(len(rows) if group < 0 else group)
                    group = len(rows)
                    groups.setdefault(names[i], group)
                    rows.append(i)
                lot.add(group, piece.as_py() or "")
                if lot.letters >= LOT or i == batch.num_rows - 1:
                    if len(groups) <= len(cells) and len(groups) * width <= 4 * lot.letters:
                        if len(slots.keys() | groups.keys()) > len(cells):
                            yield from counted(slots, cells)
                            slots.clear()
                            cells[:] = 0
                        lot.number(cells, np.array([slots.setdefault(name, len(slots)) for name in groups], np.int64))
                    else:
                        lot.number()
                    group, *columns = lot.sums(None if flag is None else np.array(into, np.int64))
                    at = pa.array(np.array(rows, np.int64)[group])
                    yield pa.RecordBatch.from_arrays([*[batch.column(c).take(at) for c in range(len(keep))], *columns], [*keep, "code", "other", "n"])
                    lot, groups, rows, into = _Lot(k, strands), {}, [], []
        yield from counted(slots, cells)

    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in pieces.schema.fields[:-1]]
    return pieces.mapInArrow(summed, ", ".join([*fields, "code long", "other string", "n long"]))


def unpacked(k: int) -> Column:
    """The window of `code` or `other`."""
    if k > 31:
        return F.col("other")
    letter = lambda i: F.substring(F.lit("ACGT"), F.shiftright("code", 2 * (k - 1 - i)).bitwiseAND(3).cast("int") + 1, F.lit(1))
    return F.coalesce("other", F.concat(*[letter(i) for i in range(k)]))


def canonical_counts(records: DataFrame, k: int, by: tuple[str, ...] = (), full: bool = False, compat: bool = True) -> DataFrame:
    """(by..., kmer, n): each window counts for itself and for its reverse complement.

    compat counts a palindrome once less (2n-1), as the reference's counters do.
    """
    sums = packed(records, k, full, keep=by, strands=True).groupBy(*by, "code", "other").agg(F.sum("n").alias("n"))
    out = sums.select(*by, unpacked(k).alias("kmer"), "n")
    if compat:
        out = out.withColumn("n", F.when(F.col("kmer") == S.reverse_complement(F.col("kmer")), F.col("n") - 1).otherwise(F.col("n")))
    return out


def conserved(records: DataFrame, k: int, group: str, full: bool = True, seq: str = "seq") -> DataFrame:
    """K-mers that occur in every group: a count of groups instead of one join for each.

    All groups count, also those too short for any k-mer, which leave nothing conserved.
    """
    groups = records.select(group).distinct().agg(F.count("*").alias("__groups"))
    once = packed(records, k, full, seq, (group,)).groupBy(group, "code", "other").agg(F.lit(1).alias("__one"))
    found = once.groupBy("code", "other").agg(F.count("*").alias("__n"))
    return found.join(F.broadcast(groups), F.col("__n") == F.col("__groups")).select(unpacked(k).alias("kmer"))


def assembly_conserved(records: DataFrame, k: int, record: str, assembly: str, full: bool = False) -> DataFrame:
    """(kmer, n_min, n_max) of the k-mers in every assembly; an assembly's count is the
    highest of its records.

    A record of one row and one piece is counted whole in its batch, which hands on the highest
    counts of its assemblies; longer records, and all of them if any record has several rows,
    are told apart until their pieces are together.
    """
    several = not records.groupBy(assembly, record).agg(F.count("*").alias("n")).filter("n > 1").isEmpty()
    alone = F.lit(False) if several else F.coalesce(F.length("seq") <= CHUNK, F.lit(True))
    cut = records.select(F.col(assembly).alias("__assembly"), alone.alias("__alone"), F.when(~alone, F.col(record)).alias("__record"), "seq")
    counts = packed(cut, k, full, keep=("__assembly", "__alone", "__record"), strands=True, alone="__alone")
    n = F.when(F.col("__alone"), F.max("n")).otherwise(F.sum("n")).alias("n")
    whole = counts.groupBy("__assembly", "__alone", "__record", "code", "other").agg(n)
    best = whole.groupBy("__assembly", "code", "other").agg(F.max("n").alias("n"))
    groups = records.select(assembly).distinct().agg(F.count("*").alias("__groups"))
    shared = best.groupBy("code", "other").agg(F.count("*").alias("__n"), F.min("n").alias("n_min"), F.max("n").alias("n_max"))
    found = shared.join(F.broadcast(groups), F.col("__n") == F.col("__groups")).select(unpacked(k).alias("kmer"), "n_min", "n_max")
    # A palindrome counts 2n-1 in every record.
    less = F.when(F.col("kmer") == S.reverse_complement(F.col("kmer")), 1).otherwise(0)
    return found.select("kmer", (F.col("n_min") - less).alias("n_min"), (F.col("n_max") - less).alias("n_max"))


def document_frequency(records: DataFrame, k: int, record: str, singletons: bool = True) -> DataFrame:
    """(kmer, n): records that contain a k-mer of plain bases; singletons=False drops n = 1.

    A record of one row and one piece has its k-mers made distinct where it is read, and records
    are summed there, so only numbers and counts are shuffled. Longer records, and all of them if
    any record has several rows, are told apart until their pieces are together.
    """
    several = not records.groupBy(record).agg(F.count("*").alias("n")).filter("n > 1").isEmpty()
    alone = F.lit(False) if several else F.length("seq") <= CHUNK
    cut = records.select(alone.alias("__alone"), F.when(~alone, F.col(record)).alias("__record"), F.explode(S.chunks(F.col("seq"), CHUNK, k - 1)).alias("__piece"))
    kind = records.schema[record].dataType.simpleString()
    once = cut.mapInArrow(_distinct(k), f"__alone boolean, __record {kind}, code long, n long").groupBy("__alone", "__record", "code").agg(F.sum("n").alias("n"))
    out = once.groupBy("code").agg(F.sum(F.when(F.col("__alone"), F.col("n")).otherwise(1)).alias("n"))
    out = out.withColumn("other", F.lit(None).cast("string")).select(unpacked(k).alias("kmer"), "n")
    return out if singletons else out.filter("n > 1")


def _distinct(k: int):
    """Emits (alone, record, code, n) for pieces (alone, record, piece): the numbers of pieces that
    stand alone with each plain window, and the distinct plain windows of every other piece."""
    width = 4**k if 4**k <= HELD else 0

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cells, kind = np.zeros(width, np.int64), None

        def rows(alone: bool, record: pa.Array, code: np.ndarray, n: np.ndarray) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(np.full(len(code), alone)), record, pa.array(code, pa.int64()), pa.array(n, pa.int64())], ["__alone", "__record", "code", "n"])

        for batch in batches:
            kind = batch.column(1).type
            texts = [x.encode("ascii", "replace") for x in batch.column(2).to_pylist()]
            single = np.array(batch.column(0).to_pylist(), bool)
            low = 0
            while low < len(texts):
                high, letters = low, 0
                while high < len(texts) and (high == low or letters + len(texts[high]) < LOT):
                    letters += len(texts[high]) + 1
                    high += 1
                row, code = _windows(texts[low:high], k)
                row += low
                own = single[row]
                codes = code[own]
                if width:
                    cells += np.bincount(codes, minlength=width)
                elif len(codes):
                    codes, n = np.unique(codes, return_counts=True)
                    yield rows(True, pa.nulls(len(codes), kind), codes, n)
                if not own.all():
                    yield rows(False, batch.column(1).take(pa.array(row[~own])), code[~own], np.ones(int((~own).sum()), np.int64))
                low = high
        if kind is not None:
            code = np.flatnonzero(cells)
            yield rows(True, pa.nulls(len(code), kind), code, cells[code])

    return run


def _windows(texts: list[bytes], k: int) -> tuple[np.ndarray, np.ndarray]:
    """(text, code) of each text's distinct windows of plain bases."""
    code = _CODE[np.frombuffer(b"\0".join(texts), np.uint8)]
    if k > 31 or len(code) < k:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    bad = np.concatenate(([0], np.cumsum(code > 3)))
    at = np.flatnonzero(bad[k:] == bad[:-k])
    code, number = code.astype(np.int64) & 3, np.zeros(len(code) - k + 1, np.int64)
    for j in range(k):
        number <<= 2
        number |= code[j : j + len(number)]
    number = number[at]
    row = np.repeat(np.arange(len(texts)), [len(t) + 1 for t in texts])[at]
    if 2 * k + len(texts).bit_length() > 62:
        row, number, _ = _counted([(row, number)], np.int64, None)
        return row, number
    key = np.sort(row << 2 * k | number)
    key = key[np.concatenate((np.ones(min(len(key), 1), bool), key[1:] != key[:-1]))]
    return key >> 2 * k, key & (1 << 2 * k) - 1


def union(records: DataFrame, k: int, full: bool = False) -> DataFrame:
    """The distinct upper-case k-mers of both strands."""
    rows = packed(records.withColumn("seq", F.upper("seq")), k, full, strands=True)
    return rows.select("code", "other").distinct().select(unpacked(k).alias("kmer"))


def exclusive(records: DataFrame, k: int, own: Column, full: bool = True) -> DataFrame:
    """(id, kmer): k-mers of the records for which `own` holds that no other record has, numbered
    in their order as marker_0, ...: one scan and one shuffle of two flags a k-mer."""
    flagged = records.select(F.coalesce(own, F.lit(False)).alias("__own"), "seq")
    found = packed(flagged, k, full, keep=("__own",)).groupBy("code", "other").agg(F.bool_and("__own").alias("__only")).filter("__only")
    return ranked(found.select(unpacked(k).alias("kmer")), "kmer").select(F.concat(F.lit("marker_"), F.col("rank") - 1).alias("id"), "kmer")


def check_length(kmers: DataFrame, k: int) -> None:
    """Raises ValueError if a k-mer has another length than k."""
    row = kmers.agg(F.min(F.length("kmer")).alias("a"), F.max(F.length("kmer")).alias("b")).first()
    if row["a"] is not None and (row["a"], row["b"]) != (k, k):
        raise ValueError(f"k-mers of {row['a']} to {row['b']} letters, not {k}")


def difference(a: DataFrame, b: DataFrame) -> DataFrame:
    """(id, kmer): k-mers of a that b lacks, numbered in their order as marker_0, marker_1, ..."""
    left = a.select("kmer").distinct().join(b.select("kmer"), "kmer", "left_anti")
    return ranked(left, "kmer").select(F.concat(F.lit("marker_"), F.col("rank") - 1).alias("id"), "kmer")


def above_quantile(counts: DataFrame, q: float, n: str = "n") -> DataFrame:
    """Rows whose count is above (not at) the interpolated quantile of all counts.

    The quantile is exact: Spark sums equal counts first, so its state is one entry for each
    distinct count.
    """
    bound = counts.agg(F.percentile(n, F.lit(q)).alias("__bound"))
    return counts.join(F.broadcast(bound), F.col(n) > F.col("__bound")).drop("__bound")


def replicon_bins(records: DataFrame, references: DataFrame, p: float = 0.1) -> DataFrame:
    """records with bin: the lowest ref_idx with ref_len*(1-p) < length < ref_len*(1+p), or -1.

    references (ref_idx, ref_len) are the replicons of one genome, some tens of rows. The bounds
    are decimals, so that a length exactly at one is outside it.
    """
    share = Decimal(str(p))
    refs = references.agg(F.sort_array(F.collect_list(F.struct("ref_idx", "ref_len"))).alias("__refs"))
    n = F.length("seq")
    of = lambda r: r["ref_len"].cast("decimal(19,0)")
    fits = lambda r: (n > of(r) * F.lit(1 - share)) & (n < of(r) * F.lit(1 + share))
    first = F.get(F.filter("__refs", fits), 0)["ref_idx"]
    return records.crossJoin(F.broadcast(refs)).withColumn("bin", F.coalesce(first, F.lit(-1)).cast("int")).drop("__refs")


def sample_matrix(records: DataFrame, k: int, bin_col: str, sample: str) -> DataFrame:
    """(bin, kmer, sample_idx, n): the sparse k-mer by sample matrix as rows.

    Samples are numbered in order within their bin; k-mers with ambiguity codes are left out.
    """
    counts = canonical_counts(records, k, (bin_col, sample)).filter(~F.col("kmer").rlike("[HVYWDKBNMSR]"))
    numbered = sample_index(records, bin_col, sample).select(F.col("bin").alias(bin_col), F.col("accession").alias(sample), "sample_idx")
    return counts.join(numbered, [bin_col, sample]).select(F.col(bin_col).alias("bin"), "kmer", "sample_idx", "n")


def samples_per_kmer(matrix: DataFrame) -> DataFrame:
    """(bin, kmer, n): samples with the k-mer."""
    return matrix.groupBy("bin", "kmer").agg(F.countDistinct("sample_idx").alias("n"))


def stratified_resample(members: DataFrame, n: int, group: str = "groups", member: str = "accession", seed: int = 0) -> DataFrame:
    """(draw, group, member): n draws with replacement, a group first, then one of its members.

    Draws are hashed from seed and number, so a rerun draws the same. Members are numbered
    inside their group, and a draw joins its (group, number).
    """
    rows = members.select(group, member).distinct()
    sizes = ranked(rows.groupBy(group).agg(F.count("*").alias("__size")), group, name="__group")
    number = F.row_number().over(Window.partitionBy(group).orderBy(member)).alias("__number")
    count = sizes.count()
    pick = lambda salt, size: F.pmod(F.xxhash64(F.lit(seed), F.lit(salt), "draw"), size) + 1
    draws = members.sparkSession.range(n).withColumnRenamed("id", "draw").withColumn("__group", pick(1, F.lit(max(1, count))))
    drawn = draws.join(sizes, "__group").withColumn("__number", pick(2, F.col("__size")))
    return drawn.join(rows.select(group, member, number), [group, "__number"]).select("draw", group, member)


def resampled_matrix(matrix: DataFrame, samples: DataFrame, draws: DataFrame) -> DataFrame:
    """(bin, kmer, draw, n): the sample matrix's columns as the draws take them, with repeats.

    matrix: bin, kmer, sample_idx, n; samples: bin, sample_idx, accession; draws: draw, accession.
    """
    taken = draws.select("draw", "accession").join(samples.select("bin", "sample_idx", "accession"), "accession")
    return matrix.join(taken, ["bin", "sample_idx"]).select("bin", "kmer", "draw", "n")


def sample_index(records: DataFrame, bin_col: str, sample: str) -> DataFrame:
    """(bin, sample_idx, accession): the samples of each bin, numbered in order from 0."""
    index = (F.row_number().over(Window.partitionBy(bin_col).orderBy(sample)) - 1).alias("sample_idx")
    return records.select(bin_col, sample).distinct().select(F.col(bin_col).alias("bin"), index, F.col(sample).alias("accession"))


def ordinal(kmers: DataFrame, start: int = 0) -> DataFrame:
    """(id, kmer) with ids from start in the order of the k-mers."""
    return ranked(kmers.select("kmer").distinct(), "kmer").select((F.col("rank") - 1 + start).alias("id"), "kmer")


def protein_kmers(cds: DataFrame, k: int, group: str, seq: Column | None = None) -> DataFrame:
    """(group, kmer): distinct overlapping peptides of each group's translated sequences."""
    protein = S.translate_cds(F.col("seq") if seq is None else seq)
    return exploded(cds.select(group, protein.alias("protein")), k, seq="protein", keep=(group,)).distinct()


def protein_intersection(cds: DataFrame, k: int, group: str) -> DataFrame:
    """Peptides that every group has."""
    return conserved(cds.withColumn("protein", S.translate_cds(F.col("seq"))), k, group, seq="protein")


def protein_union(cds: DataFrame, k: int, group: str) -> DataFrame:
    return protein_kmers(cds, k, group).select("kmer").distinct()
