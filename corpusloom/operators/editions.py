"""Editions of sources: what is accepted, what is in force, what happened to each record from edition to edition."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def latest_versions(rows: DataFrame, source: str, version: str, at: str | None = None) -> DataFrame:
    """(source, version): the greatest version of each source, or the one seen last at ``at`` (ties: the greatest version)."""
    pick = F.max(version) if at is None else F.max(F.struct(at, version)).getField(version)
    return rows.where(F.col(source).isNotNull()).groupBy(source).agg(pick.alias(version))


def last_known_good(previous: DataFrame, fetched: DataFrame, key: str, *values: str) -> DataFrame:
    """Every previous record with its fetched values, or the previous ones where a fetch failed (no row, or null values).

    A failed fetch never removes a record; records that are only fetched are added.
    """
    new = fetched.select(key, F.struct(*values).alias("__new"))
    old = previous.select(key, F.struct(*values).alias("__old"))
    both = old.join(new, key, "full_outer")
    return both.select(key, *[F.coalesce(F.col(f"__new.{v}"), F.col(f"__old.{v}")).alias(v) for v in values])


def transitions(rows: DataFrame, key: str | list[str], edition: str, value: str) -> DataFrame:
    """(key, edition, previous_edition, change): what each edition did to a record: first, same, changed.

    ``key`` may be several columns.
    """
    keys = [key] if isinstance(key, str) else key
    order = Window.partitionBy(*keys).orderBy(edition)
    before, was = F.lag(edition).over(order), F.lag(value).over(order)
    change = F.when(before.isNull(), "first").when(was.eqNullSafe(F.col(value)), "same").otherwise("changed")
    return rows.select(*keys, edition, before.alias("previous_edition"), change.alias("change"))


def as_of(facts: DataFrame, editions: DataFrame, by: str, at: str, since: str, *values: str) -> DataFrame:
    """Facts with the edition in force at their time: the last one of the same ``by`` that took effect at or before ``at``.

    Both sides are sorted once by (by, time) and the last edition is carried forward, so no pair of rows is formed.  A fact
    before the first edition, or with a null time, gets nulls.  Of editions of the same time the one with the greatest values
    counts.
    """
    edition = editions.groupBy(by, since).agg(F.max(F.struct(*values)).alias("__edition")).select(F.col(by), F.col(since).alias("__at"), F.lit(0).alias("__kind"), F.struct(F.col(since), "__edition").alias("__e"))
    names = facts.columns
    fact = facts.select(F.struct(*names).alias("__fact"), F.col(by), F.col(at).alias("__at"), F.lit(1).alias("__kind"))
    both = edition.unionByName(fact, allowMissingColumns=True)
    order = Window.partitionBy(by).orderBy(F.col("__at").asc_nulls_first(), "__kind").rowsBetween(Window.unboundedPreceding, 0)
    carried = both.withColumn("__e", F.last("__e", ignorenulls=True).over(order)).where("__kind = 1")
    return carried.select("__fact.*", F.col(f"__e.{since}").alias(since), *[F.col(f"__e.__edition.{v}").alias(v) for v in values])


def source_status(registry: DataFrame, states: DataFrame, source: str, version: str, at: str) -> DataFrame:
    """One row per registered source: its version checked last, 'not yet ingested' without any."""
    last = states.groupBy(source).agg(F.max_by(version, F.struct(at, version)).alias("__v"))
    return registry.join(last, source, "left").select(source, F.coalesce("__v", F.lit("not yet ingested")).alias("current_through"))


def set_difference(known: DataFrame, found: DataFrame, on: str) -> DataFrame:
    """(on, problem): names that only one side has, as 'missing' (known only) or 'unknown' (found only)."""
    known, found = known.select(on).distinct(), found.select(on).distinct()
    missing, unknown = known.join(found, on, "left_anti"), found.join(known, on, "left_anti")
    return missing.withColumn("problem", F.lit("missing")).unionByName(unknown.withColumn("problem", F.lit("unknown")))


def change_counts(changes: DataFrame, *by: str) -> DataFrame:
    """Counts per edition step and kind of change, with subtotals (nulls) from the finest to the whole."""
    return changes.rollup(*by).agg(F.count(F.lit(1)).alias("n"), F.grouping_id().alias("level"))


def gate(name: str, ok: Column) -> Column:
    """Aggregate: how many rows break a condition; null counts as broken."""
    return F.count_if(~F.coalesce(ok, F.lit(False))).alias(name)


def assert_gates(df: DataFrame, **conditions: Column) -> dict[str, int]:
    """Run all conditions in one pass, before anything is published; raises with the counts if any row breaks one."""
    counts = df.agg(*[gate(name, ok) for name, ok in conditions.items()]).first().asDict()
    if broken := {name: n for name, n in counts.items() if n}:
        raise ValueError(f"gates not passed: {broken}")
    return counts
