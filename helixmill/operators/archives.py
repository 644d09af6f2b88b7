"""Set operations on archives as tables (archive, member, content)."""

from __future__ import annotations

from pyspark.sql import DataFrame


def subtract(a: DataFrame, b: DataFrame) -> DataFrame:
    """a's members whose name b has not; contents are not compared."""
    return a.join(b.select("member").distinct(), "member", "left_anti")


def add(*archives: DataFrame) -> DataFrame:
    """All members of all archives; equal names stay side by side."""
    out = archives[0]
    for other in archives[1:]:
        out = out.unionByName(other)
    return out
