"""In-silico PCR: oligo hits, their pairing into amplicons, and trimming to reads."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from helixmill.functions import sequence as S
from helixmill.operators.kmers import CHUNK
from helixmill.operators.mapping import LOT, Seeds, joined_texts, spelled


def with_mismatches(hits: DataFrame, oligos: DataFrame, limit: float = 3.0) -> DataFrame:
    """Hits with qseq_len, n_mismatches (length less identical letters) and strand, within
    the budget of their oligo (id, seq; a panel of some hundred rows)."""
    panel = oligos.select(
        F.col("id").alias("qseqid"), F.col("seq").alias("oligo_seq"), F.length("seq").alias("qseq_len"),
        S.mismatch_budget(F.col("seq"), limit).alias("__budget"),
    )
    joined = hits.join(panel, "qseqid")
    named = joined.withColumn("n_mismatches", F.col("qseq_len") - F.col("nident")).filter(F.col("n_mismatches") <= F.col("__budget"))
    return named.withColumn("strand", S.strand(F.col("sstart"), F.col("send"))).drop("__budget")


#: Pieces of oligos up to this number (some MB) are sent to the tasks; more are joined by a shuffle.
BROADCAST_SEEDS = 100_000


def seed_search(oligos: DataFrame, sequences: DataFrame, limit: int = 3) -> DataFrame:
    """(qseqid, sseqid, nident, sstart, send): ungapped hits of oligos on both strands with at
    most `limit` mismatches. It stands in for an external search and finds no gapped hits.

    An oligo is cut into limit+1 pieces; a hit has one of them without mismatch. The places of
    the pieces are looked up in the sequences, and the whole oligo is then compared there.
    """
    both = oligos.select("id", F.col("seq").alias("probe"), F.lit(False).alias("minus")).unionByName(
        oligos.select("id", S.reverse_complement(F.col("seq")).alias("probe"), F.lit(True).alias("minus"))
    )
    n = F.length("probe")
    size = F.greatest(F.floor(n / (limit + 1)), F.lit(1)).cast("int")
    starts = F.transform(F.sequence(F.lit(0), F.lit(limit)), lambda i: i * size)
    seeds = both.withColumn("__size", size).select("id", "probe", "minus", "__size", F.explode(starts).alias("__at"))
    seeds = seeds.withColumn("seed", F.substring("probe", F.col("__at") + 1, F.col("__size"))).filter(F.length("seed") == F.col("__size"))
    if seeds.count() <= BROADCAST_SEEDS:
        found = _seeded(seeds, sequences, limit)
    else:
        found = _joined(seeds, sequences, limit)
    rows = found.distinct()
    first, last = F.col("__begin") + 1, F.col("__begin") + F.col("len")
    return rows.select(
        F.col("id").alias("qseqid"), "sseqid", (F.col("len") - F.col("__n")).alias("nident"),
        F.when(F.col("minus"), last).otherwise(first).cast("long").alias("sstart"),
        F.when(F.col("minus"), first).otherwise(last).cast("long").alias("send"),
    )


def _seeded(seeds: DataFrame, sequences: DataFrame, limit: int) -> DataFrame:
    """(id, sseqid, minus, __begin, __n, len) of the hits of seeds that tasks hold as arrays: the
    sequences' pieces are searched as numbers, and no window becomes a row."""
    panel = seeds.collect()
    shared = sequences.sparkSession.sparkContext.broadcast(panel)
    longest = max((len(r["probe"]) for r in panel), default=1)
    pieces = sequences.select("sseqid", F.posexplode(S.chunks(F.col("seq"), CHUNK, longest - 1)).alias("__number", "__piece"))
    id_kind, sseqid = to_arrow_type(seeds.schema["id"].dataType), sequences.schema["sseqid"].dataType.simpleString()

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, minus = pa.array([r["id"] for r in shared.value], id_kind), pa.array([r["minus"] for r in shared.value], pa.bool_())
        at, length = np.array([r["__at"] for r in shared.value], np.int64), np.array([len(r["probe"]) for r in shared.value], np.int64)
        probes, slot = {}, np.zeros(len(length), np.int64)
        for n in np.unique(length).tolist():
            own = np.flatnonzero(length == n)
            probes[n], slot[own] = spelled([shared.value[i]["probe"] for i in own]), np.arange(len(own))
        indexes = []
        for k in sorted({r["__size"] for r in shared.value}):
            numbers = np.flatnonzero([r["__size"] == k for r in shared.value])
            indexes.append((numbers, Seeds(spelled([shared.value[i]["seed"] for i in numbers]))))
        for batch in batches:
            texts, number = [x or "" for x in batch.column(2).to_pylist()], batch.column(1).to_numpy().astype(np.int64)
            for low, text, begin in joined_texts(texts, LOT):
                for numbers, index in indexes:
                    for places, words in index.find(text):
                        seed = numbers[words]
                        row, place = np.searchsorted(begin, places, "right") - 1, places - at[seed]
                        fits = (place >= begin[row]) & (place + length[seed] < begin[row + 1])
                        seed, row, place = seed[fits], row[fits], place[fits]
                        for n in np.unique(length[seed]).tolist():
                            own = np.flatnonzero(length[seed] == n)
                            apart = (text[place[own][:, None] + np.arange(n)] != probes[n][slot[seed[own]]]).sum(axis=1)
                            own, apart = own[apart <= limit], apart[apart <= limit]
                            if len(own):
                                s, r = pa.array(seed[own]), row[own]
                                start = number[low + r] * CHUNK + place[own] - begin[r]
                                columns = [ids.take(s), batch.column(0).take(pa.array(low + r)), minus.take(s), pa.array(start), pa.array(apart.astype(np.int32)), pa.array(np.full(len(own), n, np.int32))]
                                yield pa.RecordBatch.from_arrays(columns, ["id", "sseqid", "minus", "__begin", "__n", "len"])

    return pieces.mapInArrow(found, f"id {seeds.schema['id'].dataType.simpleString()}, sseqid {sseqid}, minus boolean, __begin long, __n int, len int")


def _joined(seeds: DataFrame, sequences: DataFrame, limit: int) -> DataFrame:
    """As _seeded, for more seeds than a task should hold: windows meet them by a shuffle."""
    n = F.length("probe")
    found = None
    for k in [r["__size"] for r in seeds.select("__size").distinct().collect()]:
        windows = sequences.select("sseqid", "seq", F.posexplode(S.windows(F.col("seq"), k)).alias("__pos", "seed"))
        part = windows.join(seeds.filter(F.col("__size") == k), "seed")
        begin = F.col("__pos") - F.col("__at")
        fits = (begin >= 0) & (begin + n <= F.length("seq"))
        site = F.substring("seq", begin + 1, n)
        hit = part.filter(fits).withColumn("__begin", begin.cast("long")).withColumn("__n", S.hamming(site, F.col("probe"))).filter(F.col("__n") <= limit)
        found = hit if found is None else found.unionByName(hit)
    return found.select("id", "sseqid", "minus", "__begin", "__n", n.alias("len"))


def best_hits(hits: DataFrame, n: int = 1) -> DataFrame:
    """The n best-scoring hits of each oligo on each sequence."""
    from pyspark.sql import Window

    order = Window.partitionBy("qseqid", "sseqid").orderBy(F.col("bitscore").desc(), "sstart", "send")
    return hits.withColumn("__n", F.row_number().over(order)).filter(F.col("__n") <= n).drop("__n")


def amplicons(hits: DataFrame, least: int = 40, most: int = 1000, group: str | None = None) -> DataFrame:
    """Pairs of a forward and a reverse hit on one sequence whose distance is in bounds.

    hits: qseqid, sseqid, sstart, strand, and the group column for pairing within groups
    (without it every forward oligo pairs with every reverse one). Positions are binned by
    `most`: a reverse hit is offered to its own bin and the one before, so the join is an
    equi-join on (sequence, bin) and a long sequence doesn't meet itself as a whole.
    """
    keys = ["sseqid", "__bin", *([group] if group else [])]
    f = hits.filter("strand = 'plus'").select(
        F.col("qseqid").alias("FP_ID"), "sseqid", F.col("sstart").alias("Start"), F.floor(F.col("sstart") / most).alias("__bin"), *([group] if group else [])
    )
    here = F.floor(F.col("sstart") / most)
    r = hits.filter("strand = 'minus'").select(
        F.col("qseqid").alias("RP_ID"), "sseqid", F.col("sstart").alias("End"), F.explode(F.array(here, here - 1)).alias("__bin"), *([group] if group else [])
    )
    span = F.col("End") - F.col("Start")
    paired = f.join(r, keys).filter(span.between(least, most))
    return paired.withColumn("amplicon_len", span + 1).drop("__bin")


def with_sequence(pairs: DataFrame, sequences: DataFrame) -> DataFrame:
    """Amplicons with AmpliconSeq, cut from sequences (sseqid, seq) by 1-based Start and End."""
    cut = F.substring("seq", F.col("Start").cast("int"), (F.col("End") - F.col("Start") + 1).cast("int"))
    return pairs.join(sequences.select("sseqid", "seq"), "sseqid").withColumn("AmpliconSeq", cut).drop("seq")


def usable(pairs: DataFrame) -> DataFrame:
    """Amplicons with a sequence that has no N."""
    return pairs.filter(F.col("AmpliconSeq").isNotNull() & ~F.col("AmpliconSeq").contains("N"))


def read_ends(pairs: DataFrame, read_length: int, most: int) -> DataFrame:
    """Amplicons longer than `most` become two reads, one from each end; others stay."""
    seq = F.col("AmpliconSeq")
    ends = F.array(F.left(seq, F.lit(read_length)), F.left(S.reverse_complement(seq), F.lit(read_length)))
    return pairs.withColumn("AmpliconSeq", F.explode(F.when(F.length(seq) > most, ends).otherwise(F.array(seq))))


def forward(pairs: DataFrame) -> DataFrame:
    """Amplicons read from the forward primer: those of a |R primer are complemented."""
    seq = F.when(F.col("FP_ID").endswith("|R"), S.reverse_complement(F.col("AmpliconSeq"))).otherwise(F.col("AmpliconSeq"))
    return pairs.withColumn("AmpliconSeq", seq)


def single_primer(pairs: DataFrame) -> DataFrame:
    """Single-primer extension: amplicons of |F primers only, keyed by that primer."""
    return pairs.filter(F.col("FP_ID").endswith("|F")).withColumn("primer_set", S.primer_set(F.col("FP_ID")))


def both_strands(hits: DataFrame) -> DataFrame:
    """hits, if there are some on either strand; else ValueError: no pair could be made."""
    found = {r["strand"] for r in hits.select("strand").distinct().limit(3).collect()}
    if not {"plus", "minus"} <= found:
        raise ValueError("hits on both strands are needed")
    return hits


def position_range(pairs: DataFrame) -> DataFrame:
    """Amplicons with `position`, their place as Start-End."""
    return pairs.withColumn("position", F.concat_ws("-", F.col("Start").cast("string"), F.col("End").cast("string")))


def translated_search(markers: DataFrame, genomes: DataFrame, k: int | None = None) -> DataFrame:
    """(id, sseqid, frame, sstart, send): exact places of protein markers in six-frame translations.

    markers: id, protein; genomes: sseqid, seq. It stands in for an external translated search
    as far as full-length hits without gaps go. Genomes are cut into overlapping pieces, whose
    six translations' windows of the markers' lengths meet the markers by an equi-join.
    Positions are 1-based on the forward strand, sstart > send for minus frames (-1 to -3).
    """
    known = markers.select("id", "protein").filter(F.length("protein") > 0)
    lengths = [k] if k else sorted(r["n"] for r in known.select(F.length("protein").alias("n")).distinct().collect())
    found = genomes.sparkSession.createDataFrame([], f"id {markers.schema['id'].dataType.simpleString()}, sseqid {genomes.schema['sseqid'].dataType.simpleString()}, frame int, sstart long, send long")
    size = CHUNK // 3 * 3
    for n in lengths:
        pieces = genomes.select("sseqid", F.posexplode(S.chunks(F.col("seq"), size, 3 * n - 1)).alias("__number", "__piece"))
        shifts = F.explode(F.array(*[F.struct(F.lit(i).alias("shift"), F.lit(m).alias("minus")) for i in range(3) for m in (False, True)])).alias("f")
        cut = pieces.select("sseqid", "__number", F.length("__piece").alias("__length"), shifts, "__piece")
        strand = F.when(F.col("f.minus"), S.reverse_complement(F.col("__piece"))).otherwise(F.col("__piece"))
        protein = S.translate_cds(F.substring(strand, F.col("f.shift") + 1, F.length("__piece")))
        windows = cut.select("sseqid", "__number", "__length", "f", F.posexplode(S.windows(protein, n)).alias("__at", "protein"))
        hit = windows.join(known.filter(F.length("protein") == n), "protein")
        begin = F.col("f.shift") + 3 * F.col("__at")
        # A window's first letter on the forward strand, from 0.
        low = F.col("__number").cast("long") * size + F.when(F.col("f.minus"), F.col("__length") - begin - 3 * n).otherwise(begin)
        frame = (low % 3 + 1).cast("int")
        rows = hit.select(
            "id", "sseqid", F.when(F.col("f.minus"), -frame).otherwise(frame).alias("frame"),
            F.when(F.col("f.minus"), low + 3 * n).otherwise(low + 1).alias("sstart"), F.when(F.col("f.minus"), low + 1).otherwise(low + 3 * n).alias("send"),
        )
        found = found.unionByName(rows.distinct())
    return found
