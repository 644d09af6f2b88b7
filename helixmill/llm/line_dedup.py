"""Line dedup by site-relative frequency, with DataFrame functions only.

A line's frequency is the share of its host's pages that contain it. Lines above `ratio`,
found on at least `least` pages, are boilerplate there and are dropped from every page of
that host. Lines are compared without surrounding blanks; blank lines are always kept.

Counting shuffles (host, line hash, count) rows after map-side sums. The boilerplate of a
host is bounded by its mean number of lines a page over `ratio`, so each host's list is
collected and joined once with the pages: broadcast if all lists are small, else by a
shuffle. Pages are then filtered where they are, line by line, in one projection.

Defined results: null text stays null with 0 lines; empty text is one blank line; null hosts
are one host; a line repeated on a page counts once for its frequency and each of its
occurrences is dropped; a host with few pages (less than `least`) keeps all; a page whose
every line is boilerplate keeps its row, with empty text, or with all of its lines if
`keep_whole` is set: such a page is a copy of others, and near-dedup decides which copy stays.
Lines are equal if their 64-bit hashes are. Other columns pass through, whatever their names;
the names of the added ones are parameters.

A host with a list too large to broadcast is one key of the last join, whose other side Spark
splits over tasks (AQE's skew join); its pages aren't moved while the lists are broadcast.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from helixmill.llm.shared import unused, written

RATIO = 0.02
LEAST = 5
#: Lists with at most this many lines altogether (8 bytes each) are broadcast.
BROADCAST_LINES = 1_000_000


def line_key(line: Column) -> Column:
    return F.xxhash64(F.trim(line))


def boilerplate(pages: DataFrame, host: str, text: str, ratio: float = RATIO, least: int = LEAST) -> DataFrame:
    """(__host, __lines): for each host with boilerplate the hashes of those lines."""
    totals = pages.groupBy(F.col(host).alias("__host")).agg(F.count("*").alias("__pages"))
    lines = F.split(F.col(text), "\n", -1)
    kept = F.filter(lines, lambda x: F.trim(x) != "")
    keys = F.array_distinct(F.transform(kept, line_key))
    counts = (
        pages.select(F.col(host).alias("__host"), F.explode(keys).alias("__line"))
        .groupBy("__host", "__line")
        .agg(F.count("*").alias("__n"))
        .filter(F.col("__n") >= least)
    )
    both = counts.alias("c").join(totals.alias("t"), F.col("c.__host").eqNullSafe(F.col("t.__host")))
    frequent = both.filter(F.col("__n") > F.lit(ratio) * F.col("__pages"))
    return frequent.groupBy(F.col("c.__host").alias("__host")).agg(F.sort_array(F.collect_list("__line")).alias("__lines"))


def without_boilerplate(
    pages: DataFrame, host: str = "source", text: str = "text", ratio: float = RATIO, least: int = LEAST, keep_whole: bool = False,
    n_lines: str = "__n_lines", n_dropped: str = "__n_dropped",
) -> DataFrame:
    """pages with `text` less its boilerplate, and the columns n_lines and n_dropped.

    A page's lines are matched with its host's list by one hash intersection, so a page costs
    its lines and the list, not their product.
    """
    lists = written(boilerplate(pages, host, text, ratio, least))
    size = lists.agg(F.coalesce(F.sum(F.size("__lines") + 1), F.lit(0)).alias("n")).first()["n"]
    list_host, bad, kept, marks = (unused(pages.columns, x) for x in ("__list_host", "__lines", "__kept", "__marks"))
    lists = lists.select(F.col("__host").alias(list_host), F.col("__lines").alias(bad))
    lists = F.broadcast(lists) if size <= BROADCAST_LINES else lists
    joined = pages.join(lists, pages[host].eqNullSafe(F.col(list_host)), "left")
    lines = F.split(F.col(text), "\n", -1)
    blank = lambda x: F.trim(x) == ""
    hits = F.array_intersect(F.transform(lines, line_key), F.col(bad))
    rest = F.filter(lines, lambda x: blank(x) | ~F.array_contains(F.col(marks), line_key(x)))
    rest = F.when(F.coalesce(F.size(marks), F.lit(0)) <= 0, lines).otherwise(rest)
    if keep_whole:
        rest = F.when(F.exists(rest, lambda x: ~blank(x)), rest).otherwise(lines)
    number = F.when(F.col(text).isNull(), F.lit(0)).otherwise(F.size(lines)).cast("long")
    fewer = F.when(F.col(text).isNull(), F.lit(0)).otherwise(F.size(lines) - F.size(kept)).cast("long")
    own = lambda c: F.array_join(kept, "\n").alias(text) if c.lower() == text.lower() else joined[c]
    marked = joined.withColumn(marks, F.when(F.col(bad).isNotNull(), hits))
    joined = marked.withColumn(kept, rest)
    return joined.select(*[own(c) for c in pages.columns], number.alias(n_lines), fewer.alias(n_dropped))
