"""Primers and probes: candidates inside marker regions, pairs, interior oligos, folds.

Candidates come from regions by length, melting temperature and 5' end; pairs of a forward and a
reverse one, and pairs with an interior oligo between them, are range joins over bins; a fold
score leaves out oligos that pair with themselves or each other.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType

from helixmill.functions import sequence as S
from helixmill.operators.tables import written


def candidates(
    regions: DataFrame, sequences: DataFrame, lengths: tuple[int, int], tm: tuple[float, float], starts_with: str = "N"
) -> DataFrame:
    """(chrom, start, end, strand, oligo, tm): all oligos inside the regions that fit.

    regions: chrom, start, end (0-based, half-open); sequences: chrom, seq. starts_with is an
    IUPAC motif for the 5' end. A region's windows are made where its row is.
    """
    part = F.substring("seq", F.col("start").cast("int") + 1, (F.col("end") - F.col("start")).cast("int"))
    rows = regions.join(sequences.select("chrom", "seq"), "chrom").select("chrom", F.col("start").alias("__from"), part.alias("__part"))
    sizes = range(lengths[0], lengths[1] + 1)

    def cut(n: int) -> Column:
        return F.transform(S.windows(F.col("__part"), n), lambda w, i: F.struct(i.alias("at"), F.lit(n).alias("n"), w.alias("w")))

    every = rows.select("chrom", "__from", F.explode(F.concat(*map(cut, sizes))).alias("c")).select("chrom", (F.col("__from") + F.col("c.at")).alias("start"), "c.n", "c.w")
    both = F.array(F.struct(F.lit("+").alias("strand"), F.col("w").alias("oligo")), F.struct(F.lit("-").alias("strand"), S.reverse_complement(F.col("w")).alias("oligo")))
    oligos = every.select("chrom", "start", (F.col("start") + F.col("n")).alias("end"), F.explode(both).alias("o")).select("chrom", "start", "end", "o.*")
    fits = F.col("oligo").rlike("^[ACGT]+$") & F.col("oligo").rlike(f"^{S.iupac_pattern(starts_with)}")
    return oligos.filter(fits).withColumn("tm", S.melting_temperature(F.col("oligo"))).filter(F.col("tm").between(*tm)).distinct()


def inside(oligos: DataFrame, features: DataFrame) -> DataFrame:
    """Oligos that lie within a feature (chrom, start, end), e.g. a coding region.

    Features are offered to every bin of 10,000 letters that they touch, oligos to the bin of
    their start: an equi-join on (chrom, bin) with the bounds as a residual.
    """
    size = 10_000
    bins = F.sequence(F.floor(F.col("fs") / size), F.floor((F.col("fe") - 1) / size))
    f = features.select("chrom", F.col("start").alias("fs"), F.col("end").alias("fe")).filter("fs < fe").withColumn("__bin", F.explode(bins))
    keyed = oligos.withColumn("__bin", F.floor(F.col("start") / size))
    kept = (keyed["chrom"] == f["chrom"]) & (keyed["__bin"] == f["__bin"]) & (keyed["start"] >= f["fs"]) & (keyed["end"] <= f["fe"])
    return keyed.join(f, kept, "left_semi").drop("__bin")


def primer_pairs(oligos: DataFrame, least: int = 150, most: int = 250) -> DataFrame:
    """(chrom, fp, rp, start, end, fp_end, rp_start, amplicon_len, tm_diff): forward and reverse
    candidates whose product is of the asked length; starts are binned by `most`, as hits are
    in pcr.amplicons."""
    f = oligos.filter("strand = '+'").select("chrom", F.col("oligo").alias("fp"), "start", F.col("end").alias("fp_end"), F.col("tm").alias("ft"), F.floor(F.col("start") / most).alias("__bin"))
    here = F.floor(F.col("end") / most)
    minus = oligos.filter("strand = '-'")
    r = minus.select("chrom", F.col("oligo").alias("rp"), F.col("start").alias("rp_start"), "end", F.col("tm").alias("rt"), F.explode(F.array(here, here - 1)).alias("__bin"))
    size = F.col("end") - F.col("start")
    paired = f.join(r, ["chrom", "__bin"]).filter(size.between(least, most))
    return paired.select("chrom", "fp", "rp", "start", "end", "fp_end", "rp_start", size.alias("amplicon_len"), F.abs(F.col("ft") - F.col("rt")).alias("tm_diff"))


def with_interior(pairs: DataFrame, oligos: DataFrame, opt_tm: float = 60.0, width: int = 250) -> DataFrame:
    """pairs with io, io_start, io_end, io_strand and n_io: of the oligos that lie between the two
    primers the one whose melting temperature is nearest to the optimum (then the least start,
    end, strand and letters), and how many there are. Pairs without one are left out.

    A pair is offered to the bins from its forward primer's end to its reverse primer's start,
    one or two while products are no longer than a bin, and oligos to the bin of their start:
    a three-way containment as one equi-join on (chrom, bin) with the bounds as a residual.
    """
    bins = F.sequence(F.floor(F.col("fp_end") / width), F.floor(F.col("rp_start") / width))
    offered = pairs.filter("fp_end <= rp_start").withColumn("__bin", F.explode(bins))
    io = oligos.select("chrom", F.col("oligo").alias("io"), F.col("start").alias("io_start"), F.col("end").alias("io_end"), F.col("strand").alias("io_strand"), F.col("tm").alias("__io_tm"))
    met = offered.join(io.withColumn("__bin", F.floor(F.col("io_start") / width)), ["chrom", "__bin"]).filter("io_start >= fp_end AND io_end <= rp_start")
    best = F.min(F.struct(F.abs(F.col("__io_tm") - opt_tm).alias("off"), "io_start", "io_end", "io_strand", "io")).alias("x")
    rows = met.groupBy(*pairs.columns).agg(best, F.count("*").alias("n_io"))
    return rows.select(*pairs.columns, "x.io", "x.io_start", "x.io_end", "x.io_strand", "n_io")


#: Letters of a hairpin's loop at least.
LOOP = 3
_BONDS = {"AT": 2, "TA": 2, "CG": 3, "GC": 3}
_PAIRING = np.zeros((256, 256), np.int16)
for _pair, _n in _BONDS.items():
    _PAIRING[ord(_pair[0]), ord(_pair[1])] = _n


def _letters(seqs: pd.Series) -> np.ndarray:
    """Rows of letters, 0 behind the end."""
    texts = [(s or "").upper().encode("ascii", "replace") for s in seqs]
    width = max([len(t) for t in texts], default=0) or 1
    return np.frombuffer(b"".join(t.ljust(width, b"\0") for t in texts), np.uint8).reshape(len(texts), width)


def _stems(a: np.ndarray, b: np.ndarray, loop: int | None) -> np.ndarray:
    """For each row the most hydrogen bonds of a run of pairs, a's letters forward, b's backward;
    with a loop b is a itself and a pair's letters are more than that apart."""
    best = np.zeros(len(a), np.int16)
    before = np.zeros((len(a), b.shape[1] + 1), np.int16)
    for i in range(a.shape[1]):
        bonds = _PAIRING[a[:, i : i + 1], b]
        if loop is not None:
            bonds[:, : i + loop + 1] = 0
        now = np.zeros_like(before)
        now[:, :-1] = np.where(bonds > 0, before[:, 1:] + bonds, 0)
        best = np.maximum(best, now.max(axis=1))
        before = now
    return best


@F.pandas_udf(IntegerType())
def hairpin(seq: pd.Series) -> pd.Series:
    """Hydrogen bonds (A-T 2, C-G 3) of an oligo's best stem: a run of pairs of its letters round
    a loop of three or more. 0 for null and for oligos without one; codes don't pair."""
    letters = _letters(seq)
    return pd.Series(_stems(letters, letters, LOOP).astype(np.int32))


@F.pandas_udf(IntegerType())
def dimer(a: pd.Series, b: pd.Series) -> pd.Series:
    """Hydrogen bonds of the best run of pairs between two oligos in opposite directions."""
    return pd.Series(_stems(_letters(a), _letters(b), None).astype(np.int32))


def unfolded(oligos: DataFrame, most: int = 18) -> DataFrame:
    """Oligos whose hairpin and dimer with themselves have at most so many hydrogen bonds."""
    return oligos.filter((hairpin("oligo") <= most) & (dimer("oligo", "oligo") <= most))


def designed(
    regions: DataFrame, sequences: DataFrame, markers: DataFrame | None = None, cds: DataFrame | None = None,
    lengths: tuple[int, int] = (15, 25), tm: tuple[float, float] = (56.0, 64.0), product: tuple[int, int] = (150, 250),
    io_lengths: tuple[int, int] = (18, 28), io_tm: tuple[float, float] = (57.0, 63.0), io_start: str = "N", fold: int = 18,
) -> DataFrame:
    """Primer pairs of mapped k-mers' regions, each with its interior oligo from the markers.

    regions, markers: chrom, start, end; sequences: chrom, seq; cds limits products to lie
    within a feature. Without markers (the gene variant, for small genomes) the interior oligos
    come from the regions too. Primers that fold or pair with each other are left out. Primers
    are written, as both sides of the pairs read them.
    """
    primers = written(unfolded(candidates(regions, sequences, lengths, tm), fold))
    pairs = primer_pairs(primers, *product)
    if cds is not None:
        pairs = inside(pairs, cds)
    pairs = pairs.filter(dimer("fp", "rp") <= fold)
    io = unfolded(candidates(regions if markers is None else markers, sequences, io_lengths, io_tm, io_start), fold)
    return with_interior(pairs, io, sum(io_tm) / 2, product[1])
