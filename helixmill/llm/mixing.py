"""Mixing sources to target weights, with DataFrame functions only.

Words are counted once per document and summed per source with map-side partial sums. Each
source's target is its weighted share of all words, at most `most` times its own words; the
excess goes back to the others by weight until none is above its limit. A document is then
taken floor(rate) times, rate being its source's target over its source's words, plus once
more if a number in [0, 1) hashed from seed and doc_id is below the rate's fraction.

Defined results: a null text has size 0 and is taken like any row of its source; null sources
are one source, last in order; a source without words has target 0 and copies 0; repeated
rows of one doc_id share a hash and so a decision; an empty table gives no rows. Other columns
pass through, whatever their names; the names of the added ones are parameters.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from helixmill.llm.shared import WORD, ranked, unused, written

#: Sources up to this number (some MB) are broadcast; more are joined by a shuffle.
BROADCAST_SOURCES = 50_000


def word_count(text: Column) -> Column:
    """Number of words, 0 for null, as long."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def unit_hash(seed: str, key: Column) -> Column:
    """A double in [0, 1): the first 52 bits of an MD5 of seed and key."""
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(key.cast("string"), F.lit("null")))
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, 13), 16, 10).cast("long").cast("double") / F.lit(float(2**52))


def targets(docs: DataFrame, most: int = 3) -> DataFrame:
    """(__source, __source_size, __weight, __target), a row per source of docs.

    Each round is one sum over the sources: those whose limit is below their share get the
    limit, and the rest is dealt anew by weight. A round only adds limited sources, so the
    rounds end; they are few.
    """
    sizes = docs.select(F.col("source").alias("__source"), word_count(F.col("text")).alias("__size"))
    per_source = sizes.groupBy("__source").agg(F.sum("__size").alias("__source_size"))
    numbered = ranked(per_source, F.col("__source").isNull(), F.col("__source"), name="__rank")
    weighted = written(numbered.withColumn("__weight", (F.col("__rank") - 1) % 3 + 1).drop("__rank"))
    limit = F.lit(most) * F.col("__source_size")
    all_of = weighted.agg(F.sum("__source_size").alias("words"), F.sum("__weight").alias("weight")).first()
    words, weight = all_of["words"] or 0, all_of["weight"] or 0
    rest, free, held, limited = words, weight, 0, F.lit(False)
    while free:
        limited = limit * F.lit(free) < F.lit(rest) * F.col("__weight")
        now = weighted.filter(limited).agg(
            F.sum(limit).alias("words"), F.sum("__weight").alias("weight"), F.count("*").alias("n")
        ).first()
        if now["n"] == held:
            break
        held, rest, free = now["n"], words - now["words"], weight - now["weight"]
    share = F.lit(float(rest)) * F.col("__weight") / F.lit(float(free or 1))
    return weighted.withColumn("__target", F.when(limited, limit.cast("double")).otherwise(share))


def with_copies(
    docs: DataFrame, seed: str = "mix", most: int = 3, source_size: str = "__source_size", target: str = "__target", copies: str = "__copies"
) -> DataFrame:
    """docs with the columns source_size and target of the row's source, and copies, 0 to `most`.

    One pass counts words per source; the second reads docs with the targets at hand and
    needs no shuffle while the sources are few enough to broadcast.
    """
    name, words, share = (unused(docs.columns, x) for x in ("__mix_source", "__mix_words", "__mix_share"))
    per_source = written(targets(docs, most)).select(F.col("__source").alias(name), F.col("__source_size").alias(words), F.col("__target").alias(share))
    if per_source.count() <= BROADCAST_SOURCES:
        per_source = F.broadcast(per_source)
    joined = docs.join(per_source, docs["source"].eqNullSafe(F.col(name)))
    rate = F.when(F.col(words) > 0, F.col(share) / F.col(words)).otherwise(F.lit(0.0))
    more = (unit_hash(seed, docs["doc_id"]) < rate - F.floor(rate)).cast("int")
    times = F.least(F.floor(rate) + more, F.lit(most)).cast("int")
    return joined.select(*[docs[c] for c in docs.columns], F.col(words).alias(source_size), F.col(share).alias(target), times.alias(copies))


def mixed(docs: DataFrame, seed: str = "mix", most: int = 3) -> DataFrame:
    """Every row of docs as often as the mix takes it, with `copy` counting from 1 (`copy_`
    where docs has such a column)."""
    added = [unused(docs.columns, x) for x in ("__source_size", "__target", "__copies")]
    name, copies = unused(docs.columns, "copy"), added[2]
    taken = with_copies(docs, seed, most, *added).filter(F.col(copies) > 0)
    return taken.select(*docs.columns, F.explode(F.sequence(F.lit(1), F.col(copies))).alias(name))
