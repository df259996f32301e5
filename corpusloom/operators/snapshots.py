"""What changed between consecutive full snapshots.

A full snapshot is kept as a *generation*: its rows reduced to key -> (version, hash), written once, bucketed by key.  The
generation of the last snapshot is the index; a new snapshot is bucketed the same way and probes it bucket against bucket,
without a shuffle.  Old values are fetched for the changed keys only, and swapping the index is a change of the pointer to
the generation last written.  A history that lies there as a whole is one such table, in which each snapshot probes the one
before it.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from corpusloom.scratch import fixed, new_path

KEYS = ("source", "id")
ROWS_A_BUCKET, ROWS_A_TASK, MOST_BUCKETS = 500_000, 50_000, 20_000
OUT = ("source", "id", "prev_version", "next_version", "change", "old_hash", "new_hash")
CHANGES = "source string, id string, prev_version string, next_version string, change string, old_hash string, new_hash string"


def plain_source(source: Column) -> Column:
    """Source name in lower case without blanks around it."""
    return F.lower(F.trim(source))


def plain_hash(value: Column) -> Column:
    """Hash in lower case, without blanks around it and without the ``sha256:`` in front."""
    return F.regexp_replace(F.lower(F.trim(value)), "^sha256:", "")


def deliveries(sections: DataFrame) -> DataFrame:
    """One row per (source, version, id): the row with the latest ``fetched_at``.

    Rows with a null source, id or version belong to no snapshot and are left out.  A null ``fetched_at`` counts as the
    earliest; of rows with the same time the one with the greatest hash counts (a null hash as the least), so the result does
    not depend on the order of rows.  Repeats of one key are folded before the shuffle.
    """
    rows = sections.select(
        plain_source(F.col("source")).alias("source"),
        F.col("id"),
        F.col("source_version").alias("version"),
        F.struct(F.col("fetched_at"), plain_hash(F.col("canonical_hash")).alias("hash")).alias("row"),
    ).where("source is not null and id is not null and version is not null")
    return rows.groupBy(*KEYS, "version").agg(F.max("row").alias("row")).select(*KEYS, "version", "row.hash")


def steps(sections: DataFrame) -> DataFrame:
    """(source, version, prev_version, next_version, step, rows): the place of each version among those of its source, from 1.

    There is one row per snapshot, not per section; the window runs over that list only.
    """
    pairs = (
        sections.select(plain_source(F.col("source")).alias("source"), F.col("source_version").alias("version"))
        .where("source is not null and version is not null")
        .groupBy("source", "version")
        .agg(F.count(F.lit(1)).alias("rows"))
    )
    in_order = Window.partitionBy("source").orderBy("version")
    return pairs.select(
        "source", "version", F.lag("version").over(in_order).alias("prev_version"), F.lead("version").over(in_order).alias("next_version"),
        F.row_number().over(in_order).alias("step"), "rows",
    )


def buckets_for(rows: int, parallelism: int) -> int:
    """Buckets by the number of rows: few files for few rows, enough tasks for many."""
    return max(1, min(MOST_BUCKETS, max(-(-rows // ROWS_A_BUCKET), min(parallelism, -(-rows // ROWS_A_TASK)))))


class SnapshotIndex:
    """Bucketed key-to-hash index of the last snapshot of every source.

    ``probe`` compares a written generation with the current one, ``swap`` makes it the current one.  ``feed`` does both for a
    snapshot as it is delivered.
    """

    def __init__(self, spark: SparkSession, buckets: int | None = None):
        self.spark = spark
        self.buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
        self.current: DataFrame | None = None

    def write(self, rows: DataFrame) -> DataFrame:
        """Write rows (source, id, version, hash, ...) bucketed and sorted by key, one file per bucket."""
        table = f"snapshot_generation_{uuid.uuid4().hex}"
        path = new_path(self.spark, "generation", table)
        writer = rows.repartition(self.buckets, *KEYS).write.format("parquet").option("path", path)
        writer.bucketBy(self.buckets, *KEYS).sortBy(*KEYS).saveAsTable(table)
        return self.spark.table(table)

    def probe(self, new: DataFrame, old: DataFrame | None = None, by: str | None = None) -> DataFrame:
        """(source, id, prev_version, next_version, change, old_hash, new_hash) from ``old`` (the current generation) to ``new``, bucket against bucket.

        With ``by``, a number in both, each row only meets the row of the key whose number is one less: a whole history is probed
        at once.  The difference of the numbers is no join key, so the buckets need no shuffle; a key has as many rows as
        there are snapshots.  ``prev_version`` and ``next_version`` come from the columns of that name, if the sides have them.
        """
        old = self.current if old is None else old
        side = lambda df, was, other: df.select(
            *KEYS, F.col("hash").alias(f"{was}_hash"), F.col("version").alias(f"{was}_version"),
            (F.col(other) if other in df.columns else F.lit(None).cast("string")).alias(f"{was}_{other}"), F.lit(True).alias(f"{was}"), *([F.col(by)] if by else []),
        )
        o, n = side(old, "old", "next_version").alias("o"), side(new, "new", "prev_version").alias("n")
        same = (F.col("o.source") == F.col("n.source")) & (F.col("o.id") == F.col("n.id"))
        if by:
            same = same & ((F.col(f"n.{by}") - F.col(f"o.{by}")) == 1)
        met = o.join(n, same, "full_outer")
        change = F.when(F.col("old").isNull(), "added").when(F.col("new").isNull(), "removed").when(F.col("old_hash") != F.col("new_hash"), "changed")
        return met.select(
            *[F.coalesce(f"o.{k}", f"n.{k}").alias(k) for k in KEYS],
            F.coalesce("old_version", "new_prev_version").alias("prev_version"), F.coalesce("old_next_version", "new_version").alias("next_version"),
            change.alias("change"), "old_hash", "new_hash",
        ).where("change is not null")

    def swap(self, new: DataFrame) -> None:
        """Make ``new`` the index of the last snapshot."""
        self.current = new

    def feed(self, snapshot: DataFrame) -> DataFrame:
        """Take one delivered snapshot (rows of the section table): returns its changes and swaps the index.

        Only sources that the snapshot delivers are compared; a source that sent nothing has removed nothing and keeps its
        last snapshot in the index.
        """
        new = self.write(deliveries(snapshot))
        if self.current is None:
            self.swap(new)
            return self.spark.createDataFrame([], CHANGES)
        before = self.current.groupBy("source").agg(F.max("version").alias("prev_version"))
        after = new.groupBy("source").agg(F.max("version").alias("next_version"))
        found = self.probe(new).drop("prev_version", "next_version")
        changes = found.join(before.join(after, "source"), "source").select(*OUT)
        silent = self.current.join(new.select("source").distinct(), "source", "left_anti")
        self.swap(self.write(new.unionByName(silent)))
        return changes


def snapshot_changes(sections: DataFrame, buckets: int | None = None) -> DataFrame:
    """Changes between each two consecutive versions of every source (columns of ``CHANGES``).

    The whole history is written once as an index bucketed by key, in which every snapshot but the first of its source probes
    the one before it: one join, whatever the number of snapshots.  The first version of a source yields nothing; a source with
    one version, or an empty table, gives no row.  ``changed`` needs two hashes that are not null.  Extra columns of the input
    are never read.
    """
    spark = sections.sparkSession
    order = fixed(steps(sections))
    last, rows = order.agg(F.max("step"), F.sum("rows")).first()
    if (last or 0) < 2:
        return spark.createDataFrame([], CHANGES)
    index = SnapshotIndex(spark, buckets or buckets_for(rows, int(spark.conf.get("spark.sql.shuffle.partitions"))))
    history = index.write(deliveries(sections).join(order.drop("rows"), ["source", "version"]))
    return index.probe(history.where("prev_version is not null"), history.where("next_version is not null"), by="step").select(*OUT)


def fed_changes(sections: DataFrame) -> DataFrame:
    """The same from snapshots that are fed one after the other, as they are delivered: the n-th ones of all sources together."""
    spark = sections.sparkSession
    order = fixed(steps(sections))
    last, rows = order.agg(F.max("step"), F.max("rows")).first()
    index = SnapshotIndex(spark, buckets_for(rows or 0, int(spark.conf.get("spark.sql.shuffle.partitions"))))
    found = spark.createDataFrame([], CHANGES)
    for step in range(1, (last or 0) + 1):
        now = order.where(F.col("step") == step).select(F.col("source").alias("__source"), F.col("version").alias("source_version"))
        snapshot = sections.join(now, "source_version").where(plain_source(F.col("source")) == F.col("__source")).drop("__source")
        found = found.unionByName(index.feed(snapshot))
    return found


def snapshot_change_values(sections: DataFrame, *values: str, buckets: int | None = None) -> DataFrame:
    """The changes with the old and new ``values`` columns, fetched for changed keys only.

    The values come from the row that counts in its snapshot; ``old_x`` is null for an added section, ``new_x`` for a removed one.
    """
    changes = fixed(snapshot_changes(sections, buckets))
    touched = changes.select(
        F.explode(F.array(F.struct("source", "id", F.col("prev_version").alias("version")), F.struct("source", "id", F.col("next_version").alias("version")))).alias("k")
    ).select("k.*").distinct()
    rows = sections.select(
        plain_source(F.col("source")).alias("source"), "id", F.col("source_version").alias("version"),
        F.struct(F.col("fetched_at"), plain_hash(F.col("canonical_hash")).alias("hash"), *[F.col(v) for v in values]).alias("row"),
    )
    kept = rows.join(touched, ["source", "id", "version"], "left_semi").groupBy("source", "id", "version").agg(F.max("row").alias("row"))
    old = kept.select("source", "id", F.col("version").alias("prev_version"), *[F.col(f"row.{v}").alias(f"old_{v}") for v in values])
    new = kept.select("source", "id", F.col("version").alias("next_version"), *[F.col(f"row.{v}").alias(f"new_{v}") for v in values])
    return changes.join(old, ["source", "id", "prev_version"], "left").join(new, ["source", "id", "next_version"], "left")
