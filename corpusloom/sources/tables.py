"""Parquet tables of a data folder."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def load(spark: SparkSession, folder: str, name: str, *columns: str) -> DataFrame:
    """Table ``name`` of ``folder``; with ``columns`` only these are read from the files."""
    df = spark.read.parquet(f"{folder}/{name}.parquet")
    return df.select(*columns) if columns else df
