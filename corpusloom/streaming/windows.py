"""Windows over event streams; every function takes a batch or a streaming DataFrame and gives the same rows."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _marked(events: DataFrame, at: str, late: str) -> DataFrame:
    return events.withWatermark(at, late) if events.isStreaming else events


def windowed_counts(events: DataFrame, at: str, by: str, width: str, slide: str | None = None, late: str = "10 minutes", value: str | None = None) -> DataFrame:
    """Counts (and sums of ``value``) per window and ``by``; tumbling, or sliding if ``slide`` is given.  Null times are left out."""
    window = F.window(at, width, slide) if slide else F.window(at, width)
    sums = [F.sum(value).alias("total")] if value else []
    rows = _marked(events, at, late).groupBy(window.alias("w"), by).agg(F.count(F.lit(1)).alias("n"), *sums)
    return rows.select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), by, "n", *(["total"] if value else []))


def sessions(events: DataFrame, at: str, by: str, gap: str, late: str = "10 minutes") -> DataFrame:
    """Sessions of each ``by``: events less than ``gap`` apart."""
    rows = _marked(events, at, late).where(F.col(by).isNotNull()).groupBy(F.session_window(at, gap).alias("w"), by).agg(F.count(F.lit(1)).alias("n"))
    return rows.select(by, F.col("w.start").alias("session_start"), F.col("w.end").alias("session_end"), "n")


def once(events: DataFrame, at: str, *key: str, late: str = "10 minutes") -> DataFrame:
    """Events without repeats of their key; in a stream, repeats within the allowed lateness."""
    return _marked(events, at, late).dropDuplicatesWithinWatermark(list(key)) if events.isStreaming else events.dropDuplicates(list(key))


def accepted_editions(deliveries: DataFrame, source: str, version: str) -> DataFrame:
    """Stream of (source, version, accepted, seen): each delivery against the greatest version accepted so far.

    The state of a source is one version and a count, so it does not grow; a version is accepted if it is greater.
    """

    def step(key: tuple, batches: Iterator[pd.DataFrame], state) -> Iterator[pd.DataFrame]:
        best, seen = state.get if state.exists else ("", 0)
        for pdf in batches:
            out = []
            for v in sorted(pdf[version].dropna()):
                accepted, seen = v > best, seen + 1
                best = max(best, v)
                out.append((key[0], v, accepted, seen))
            if out:
                yield pd.DataFrame(out, columns=["source", "version", "accepted", "seen"])
        state.update((best, seen))

    return deliveries.groupBy(source).applyInPandasWithState(
        step, "source string, version string, accepted boolean, seen long", "best string, seen long", "append", "NoTimeout"
    )
