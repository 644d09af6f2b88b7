"""Column functions on nucleotide and protein sequences.

All but translation, compositions' keys and melting temperature are built from Spark's own functions, so they stay in the JVM. Sequences
are strings; null gives null unless stated.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType

#: IUPAC nucleotide codes and the bases that each stands for.
IUPAC = {
    "A": "A", "C": "C", "G": "G", "T": "T",
    "R": "AG", "Y": "CT", "S": "CG", "W": "AT", "K": "GT", "M": "AC",
    "B": "CGT", "D": "AGT", "H": "ACT", "V": "ACG", "N": "ACGT",
}
BIT = {"A": 1, "C": 2, "G": 4, "T": 8}
MASK = {code: sum(BIT[b] for b in bases) for code, bases in IUPAC.items()}
CODE = {mask: code for code, mask in MASK.items()}
_SET = {frozenset(bases): code for code, bases in IUPAC.items()}
_PARTNER = {"A": "T", "C": "G", "G": "C", "T": "A"}
#: A code's complement stands for the partners of its bases.
COMPLEMENT = {code: _SET[frozenset(_PARTNER[b] for b in bases)] for code, bases in IUPAC.items()}
_FROM = "".join(COMPLEMENT) + "".join(COMPLEMENT).lower()
_TO = "".join(COMPLEMENT.values()) + "".join(COMPLEMENT.values()).lower()

#: The standard genetic code, codons in the order TCAG.
AMINO = "FFLLSSSSYY**CC*WLLLLPPPPHHQQRRRRIIIMTTTTNNKKSSRRVVVVAAAADDEEGGGG"
CODONS = {a + b + c: AMINO[16 * i + 4 * j + k] for i, a in enumerate("TCAG") for j, b in enumerate("TCAG") for k, c in enumerate("TCAG")}

#: Nearest-neighbour enthalpy (kcal/mol) and entropy (cal/mol K) of DNA pairs
#: (Allawi and SantaLucia 1997), and the terms for a duplex's ends.
PAIRS = {
    "AA": (-7.9, -22.2), "AT": (-7.2, -20.4), "TA": (-7.2, -21.3), "CA": (-8.5, -22.7), "GT": (-8.4, -22.4),
    "CT": (-7.8, -21.0), "GA": (-8.2, -22.2), "CG": (-10.6, -27.2), "GC": (-9.8, -24.4), "GG": (-8.0, -19.9),
}
END_AT, END_GC = (2.3, 4.1), (0.1, -2.8)


def reverse_complement(seq: Column) -> Column:
    """The other strand, read in its own direction; case stays; all IUPAC codes."""
    return F.reverse(F.translate(seq, _FROM, _TO))


def _bound(value: Column, body: Callable[[Column], Column]) -> Column:
    """body(value) with value computed once for a row, also where body uses it inside lambdas."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _slices(seq: Column, starts: Callable[[Column], Column], length: int) -> Column:
    """Substrings of `length` letters at the 0-based `starts`, a function of the letters' number.

    Letters are cut out of bytes of one width, so that a slice's cost doesn't grow with its place:
    one byte a letter in plain ASCII, four in other texts.
    """
    plain = lambda s: F.octet_length(s) == F.length(s)
    coded = lambda s: F.struct(
        F.when(plain(s), s.cast("binary")).otherwise(F.encode(s, "UTF-32")).alias("raw"), F.when(plain(s), 1).otherwise(4).alias("width")
    )

    def cut(c: Column) -> Column:
        part = lambda i: F.substring(c["raw"], i * c["width"] + 1, c["width"] * length)
        one = lambda i: F.when(c["width"] == 1, part(i).cast("string")).otherwise(F.decode(part(i), "UTF-32"))
        return F.transform(starts((F.octet_length(c["raw"]) / c["width"]).cast("int")), one)

    return _bound(seq, lambda s: _bound(coded(s), cut))


def windows(seq: Column, k: int, full: bool = True) -> Column:
    """The array of all k-long substrings in order; linear in the sequence's length.

    full=False leaves out the last one, as the reference's counters do.
    """

    def starts(length: Column) -> Column:
        n = length - (k - 1 if full else k)
        return F.when(n > 0, F.sequence(F.lit(0), F.greatest(n, F.lit(1)) - 1))

    return F.coalesce(_slices(seq, starts, k), F.array().cast("array<string>"))


def chunks(seq: Column, size: int, overlap: int) -> Column:
    """The sequence in pieces of `size` letters, each with the next `overlap` letters behind it.

    Pieces together have each window of overlap+1 letters once; a sequence shorter than such a
    window is one piece. Null has none.
    """
    last = lambda length: F.greatest(length - overlap - 1, F.lit(0))
    pieces = _slices(seq, lambda length: F.sequence(F.lit(0), last(length), F.lit(size)), size + overlap)
    return F.when(seq.isNotNull(), pieces)


def gc_percent(seq: Column) -> Column:
    """Percentage of G, C and S (any case); 0 for an empty sequence."""
    gc = F.length(seq) - F.length(F.translate(seq, "GCgcSs", ""))
    return F.when(F.length(seq) > 0, gc * 100.0 / F.length(seq)).otherwise(F.when(seq.isNotNull(), 0.0))


def degenerate_count(seq: Column) -> Column:
    """How many positions are no plain base."""
    return F.length(F.regexp_replace(F.upper(seq), "[ACGT]", ""))


#: Concrete sequences that expand_degenerates makes of one sequence at most.
MOST_VARIANTS = 65_536


def expand_degenerates(seq: Column) -> Column:
    """All concrete sequences that a degenerate one stands for, as an array; more than
    MOST_VARIANTS raise an error before any is made."""
    table = F.create_map(*[F.lit(x) if i % 2 == 0 else F.array(*map(F.lit, x)) for pair in IUPAC.items() for i, x in enumerate(pair)])
    letters = F.filter(F.split(F.upper(seq), ""), lambda c: c != "")
    start = F.array(F.lit(""))
    grown = lambda acc, c: F.flatten(F.transform(acc, lambda a: F.transform(F.coalesce(F.try_element_at(table, c), F.array(c)), lambda b: F.concat(a, b))))
    ways = F.aggregate(letters, F.lit(1.0), lambda n, c: n * F.size(F.coalesce(F.try_element_at(table, c), F.array(c))))
    error = F.raise_error(F.concat(seq, F.lit(f" stands for more than {MOST_VARIANTS} sequences")))
    return F.when(ways > MOST_VARIANTS, error).otherwise(F.aggregate(letters, start, grown))


def iupac_pattern(motif: str) -> str:
    """A regular expression for a motif; letters that are no code stand for themselves."""
    return "".join(f"[{IUPAC[c]}]" if len(IUPAC.get(c, c)) > 1 else c for c in motif.upper())


def motif_starts(seq: Column, motif: str) -> Column:
    """0-based starts of a motif on the forward strand, overlapping ones too."""
    k = len(motif)
    hits = F.transform(windows(seq, k), lambda w, i: F.when(w.rlike(f"^{iupac_pattern(motif)}$"), i))
    return F.filter(hits, lambda i: i.isNotNull())


def motif_count(seq: Column, motif: str) -> Column:
    return F.regexp_count(seq, F.lit(f"(?=({iupac_pattern(motif)}))"))


def iupac_mask(base: Column) -> Column:
    """A code's bases as bits (A 1, C 2, G 4, T 8); 0 for other letters."""
    return reduce(lambda c, m: c.when(base == m[0], m[1]), list(MASK.items())[1:], F.when(base == "A", 1)).otherwise(0)


def iupac_code(mask: Column) -> Column:
    return reduce(lambda c, m: c.when(mask == m[0], m[1]), list(CODE.items())[1:], F.when(mask == 1, "A"))


def iupac_union(a: Column, b: Column) -> Column:
    """The code for the bases of both codes."""
    return iupac_code(iupac_mask(a).bitwiseOR(iupac_mask(b)))


def merge_at(left: Column, right: Column, offset: Column) -> Column:
    """Two overlapping fragments as one: right starts `offset` letters into left."""
    overlap = F.least(F.length(left) - offset, F.length(right))
    a = F.filter(F.split(F.substring(left, offset + 1, overlap), ""), lambda c: c != "")
    b = F.filter(F.split(F.substring(right, F.lit(1), overlap), ""), lambda c: c != "")
    middle = F.array_join(F.zip_with(a, b, iupac_union), "")
    rest = F.substring(left, offset + overlap + 1, F.length(left))
    return F.concat(F.substring(left, F.lit(1), offset), middle, rest, F.substring(right, overlap + 1, F.length(right)))


def encode_digits(seq: Column) -> Column:
    """G, T, C, A as 0, 1, 2, 3."""
    return F.translate(seq, "GTCA", "0123")


def decode_digits(seq: Column) -> Column:
    return F.translate(seq, "0123", "GTCA")


_AMINO = np.frombuffer((AMINO + "X").encode(), np.uint8)
_CODON = np.full(256, 64, np.int16)
_CODON[[*b"TCAGtcag"]] = [*range(4), *range(4)]


def protein_of(seq: str) -> str:
    """One sequence's protein, see translate_cds."""
    if not seq.isascii():
        seq = seq.upper()
        return "".join(CODONS.get(seq[i : i + 3], "X") for i in range(0, len(seq) - 2, 3))
    code = _CODON[np.frombuffer(seq.encode(), np.uint8)[: len(seq) // 3 * 3]]
    return _AMINO[np.minimum(code[::3] * 16 + code[1::3] * 4 + code[2::3], 64)].tobytes().decode()


@F.pandas_udf(StringType())
def _proteins(seqs: pd.Series) -> pd.Series:
    return seqs.map(protein_of, na_action="ignore")


def translate_cds(seq: Column) -> Column:
    """Protein of a coding sequence: standard code, stops as *, unknown codons X, a partial
    last codon left out."""
    return _proteins(seq)


def hamming(a: Column, b: Column) -> Column:
    """Differing positions of two sequences of equal length."""
    pairs = F.zip_with(F.split(a, ""), F.split(b, ""), lambda x, y: F.when(x == y, 0).otherwise(1))
    return F.aggregate(pairs, F.lit(0), lambda s, x: s + x)


def composition(seq: Column, k: int = 3) -> Column:
    """A sequence's k-mers with their counts as one string, equal for equal profiles."""

    def counted(ordered: Column, distinct: Column) -> Column:
        # A k-mer's count is the way from its first place to the next one's.
        first = lambda x: F.array_position(ordered, x)
        after = lambda i: F.coalesce(first(F.get(distinct, i + 1)), F.size(ordered) + 1)
        return F.array_join(F.transform(distinct, lambda x, i: F.concat(x, F.lit(":"), (after(i) - first(x)).cast("string"))), ",")

    return _bound(F.sort_array(windows(seq, k)), lambda ordered: _bound(F.array_distinct(ordered), lambda distinct: counted(ordered, distinct)))


def _mixed(x: np.ndarray, salt: int) -> np.ndarray:
    x = x + np.uint64(salt)
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        x = (x ^ x >> np.uint64(shift)) * np.uint64(factor)
    return x ^ x >> np.uint64(31)


def _composition_sums(texts: list[str], k: int) -> np.ndarray:
    """The two sums of each text's k-mers, as rows."""
    out = np.zeros((2, len(texts)), np.uint64)
    low = 0
    while low < len(texts):
        high, n = low, 0
        while high < len(texts) and (high == low or n + len(texts[high]) < 1 << 20):
            n += len(texts[high])
            high += 1
        text = "".join(texts[low:high])
        letters = np.frombuffer(text.encode(), np.uint8) if text.isascii() else np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
        word = np.zeros(max(0, len(letters) - k + 1), np.uint64)
        for i in range(k):
            word *= np.uint64(0x9E3779B97F4A7C15)
            word += letters[i : i + len(word)]
        begin = np.cumsum([0] + [len(t) for t in texts[low:high]])
        end = np.maximum(begin[1:] - k + 1, begin[:-1])
        for row, salt in enumerate((0x2545F4914F6CDD1D, 0x9FB21C651E98DF25)):
            # Sums wrap round, so a text's is the difference of two of all windows so far.
            sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(_mixed(word, salt), dtype=np.uint64)))
            out[row, low:high] = sums[np.minimum(end, len(word))] - sums[np.minimum(begin[:-1], len(word))]
        low = high
    return out


def composition_key(seq: Column, k: int = 3) -> Column:
    """Two 64-bit sums over a sequence's k-mers that are equal for equal compositions (and for
    others with a negligible chance), in time linear in the sequence."""

    @F.pandas_udf("a long, b long")
    def keys(seqs: pd.Series) -> pd.DataFrame:
        a, b = _composition_sums([x or "" for x in seqs], k).astype(np.int64)
        return pd.DataFrame({"a": a, "b": b})

    return keys(seq)


def strand(start: Column, end: Column) -> Column:
    return F.when(start > end, "minus").otherwise("plus")


def id_prefix(name: Column) -> Column:
    return F.split_part(name, F.lit("|"), F.lit(1))


def accession(name: Column, column: int = 1) -> Column:
    """The column-th part (from 0) of an id with bars; an id without bars as it is."""
    return F.when(F.instr(name, "|") > 0, F.split_part(name, F.lit("|"), F.lit(column + 1))).otherwise(name)


def accession_by_pattern(name: Column) -> Column:
    """The first accession with a version in an id, empty if there is none."""
    return F.regexp_extract(name, r"[A-Z]{1,2}_{0,1}[A-Z]*[0-9]+\.[0-9]+", 0)


def marker_name(name: Column) -> Column:
    """The text after the first "prot" up to the next."""
    return F.when(F.instr(name, "prot") > 0, F.split_part(name, F.lit("prot"), F.lit(2))).otherwise(name)


def set_score(n: Column, total: Column) -> Column:
    """Completeness from 0 to 1000, halves to even."""
    return F.bround(n / total * 1000, 0).cast("int")


def mismatch_budget(oligo: Column, limit: float) -> Column:
    """Allowed mismatches: a whole number as given, a fraction of the length below one."""
    if limit < 1:
        return F.length(oligo) * F.lit(limit)
    if limit != int(limit):
        raise ValueError("mismatches above 1 must be a whole number")
    return F.lit(float(limit))


def match_floor(oligo: Column, fraction: float) -> Column:
    """Length less the rounded (half to even) fraction of it."""
    return (F.length(oligo) - F.bround(F.length(oligo) * F.lit(fraction), 0)).cast("int")


def primer_set(*ids: Column) -> Column:
    """One key for a set of oligos: the distinct prefixes in order."""
    return F.array_sort(F.array_distinct(F.array_compact(F.array(*[id_prefix(i) for i in ids]))))


def melting_temperature(
    seq: Column, na: float = 50.0, mg: float = 1.5, dntps: float = 0.6, dnac1: float = 25.0, dnac2: float = 25.0
) -> Column:
    """Nearest-neighbour melting temperature in degrees Celsius, with the monovalent
    equivalent of magnesium in an 11.7*log10 salt term. Concentrations are in mM, of strands
    in nM. Pairs with other letters than A, C, G, T add nothing."""
    strands = (dnac1 - dnac2 / 2) * 1e-9
    mono = (na + 120 * math.sqrt(max(0.0, mg - dntps))) * 1e-3
    # Enthalpy and entropy by a pair's two letters and by an end's letter.
    pairs, ends = np.zeros((2, 256, 256)), np.zeros((2, 256))
    for pair, values in PAIRS.items():
        for a, b in (pair, "".join(_PARTNER[b] for b in reversed(pair))):
            pairs[:, ord(a), ord(b)] = values
    ends[:, [*b"AT"]], ends[:, [*b"GC"]] = np.array(END_AT)[:, None], np.array(END_GC)[:, None]

    def temperatures(seqs: pd.Series) -> pd.Series:
        texts = [(x or "").upper().encode("ascii", "replace") for x in seqs]
        width = max([len(x) for x in texts], default=0) + 2
        letters = np.frombuffer(b"".join(x.ljust(width, b"\0") for x in texts), np.uint8).reshape(len(texts), width)
        total = np.zeros((2, len(texts)))
        for i in range(width - 1):
            total += pairs[:, letters[:, i], letters[:, i + 1]]
        last = letters[np.arange(len(texts)), [max(len(x) - 1, 0) for x in texts]] if texts else np.zeros(0, np.uint8)
        total = total + ends[:, letters[:, 0]] + ends[:, last]
        out = pd.Series(total[0] * 1000 / (total[1] + 1.987 * math.log(strands)) - 273.15 + 11.7 * math.log10(mono))
        return out.mask(seqs.isna().to_numpy())

    return F.pandas_udf(temperatures, DoubleType())(seq)
