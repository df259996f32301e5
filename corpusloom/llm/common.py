"""Small pieces that several text operators share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def latest(df: DataFrame, key: str, order: str, *columns: str) -> DataFrame:
    """One row per ``key``: the one with the greatest ``order``, then the greatest ``columns``.

    Rows with a null key are left out.  Repeats are folded before the shuffle, so a key that holds a third of all rows costs
    one row per task.
    """
    rows = df.where(F.col(key).isNotNull()).groupBy(key).agg(F.max(F.struct(order, *columns)).alias("kept"))
    return rows.select(key, *[F.col(f"kept.{c}").alias(c) for c in columns])


def joined_text(texts: Column, heading: Column | None = None) -> Column:
    """Heading and texts joined by a newline, nulls skipped; an empty string where nothing is left."""
    parts = F.coalesce(F.array_compact(texts), F.array().cast("array<string>"))
    if heading is not None:
        parts = F.concat(F.array_compact(F.array(heading)), parts)
    return F.array_join(parts, "\n")


def expand_pairs(pairs: DataFrame, members: DataFrame, left: str, right: str, group: str, key: str) -> DataFrame:
    """Pairs of groups (columns ``left``, ``right``) turned into pairs of member keys, the smaller key first.

    ``members`` has (``group``, ``key``).  Both joins are equality joins, so Spark splits a hot group itself.
    """
    a = members.select(F.col(group).alias(left), F.col(key).alias("__a"))
    b = members.select(F.col(group).alias(right), F.col(key).alias("__b"))
    both = pairs.select(left, right).join(a, left).join(b, right)
    return both.select(F.least("__a", "__b").alias("key_a"), F.greatest("__a", "__b").alias("key_b"))
