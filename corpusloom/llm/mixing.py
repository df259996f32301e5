"""Mixing sources to target weights."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.llm.tokens import token_sizes
from corpusloom.scratch import cut


def repetition_rates(sizes: DataFrame, targets: DataFrame, mix_tokens: int | None = None) -> DataFrame:
    """``targets`` with (documents, source_tokens, rate): how often a document of that source is used on average.

    Each mix is as large as its sources allow, at most ``mix_tokens``: its size is the least, over its sources with tokens, of what the source can
    give at ``max_repeats`` divided by its weight.  A source without tokens, weight or repeats contributes nothing (rate 0)
    and does not bound the mix; the others keep their weights relative to each other.  Duplicate target rows count once.
    """
    held = sizes.where("source is not null").groupBy("source").agg(F.count(F.lit(1)).alias("documents"), F.sum("n_tokens").alias("source_tokens"))
    rows = targets.select("mix_name", "source", "target_weight", "max_repeats").distinct().join(held, "source", "left").fillna(0, ["documents", "source_tokens"])
    usable = (F.col("source_tokens") > 0) & (F.col("target_weight") > 0) & (F.col("max_repeats") > 0)
    most = F.when(usable, F.col("source_tokens") * F.col("max_repeats") / F.col("target_weight"))
    total = rows.groupBy("mix_name").agg(F.least(F.min(most), F.lit(mix_tokens).cast("double")).alias("mix_tokens"))
    rate = F.least(F.col("mix_tokens") * F.col("target_weight") / F.col("source_tokens"), F.col("max_repeats").cast("double"))
    return rows.join(total, "mix_name").withColumn("rate", F.when(usable, rate).otherwise(0.0))


def mix(sizes: DataFrame, rates: DataFrame, seed: int = 11) -> DataFrame:
    """(mix_name, source, doc_id, copy_no, n_tokens): every use of every document.

    A document is used floor(rate) times, and once more if a number drawn from the seed, the mix and its key is below the
    rest; never more than max_repeats times, and the draw does not depend on the order of rows or on the cluster.  ``rates`` has one
    row per row of the table of targets, a parameter of some dozen rows, and is broadcast: documents are not moved.
    """
    drawn = F.pmod(F.xxhash64(F.lit(seed), "mix_name", "doc_id"), F.lit(1 << 52)) / F.lit(float(1 << 52))
    copies = (F.floor("rate") + F.when(drawn < F.col("rate") - F.floor("rate"), 1).otherwise(0)).cast("int")
    used = sizes.join(F.broadcast(rates.where("rate > 0").select("mix_name", "source", "rate")), "source").withColumn("copies", copies).where("copies > 0")
    return used.select("mix_name", "source", "doc_id", F.explode(F.sequence(F.lit(1), F.col("copies"))).alias("copy_no"), "n_tokens")


def measured(documents: DataFrame, vocabulary: str | None = None) -> DataFrame:
    """(doc_id, source, n_tokens) of rows (doc_id, source, text), measured once and written."""
    return cut(token_sizes(documents.select("doc_id", "source", "text"), vocabulary), "sizes")


def shares(sizes: DataFrame, targets: DataFrame, seed: int = 11) -> DataFrame:
    """Per mix and source: target and rate, documents used, copies, tokens and the share of all tokens actually reached.

    ``deviation`` is the standard deviation of that share that the draw has: large where a source has few long documents.
    """
    rates = repetition_rates(sizes, targets)
    used = mix(sizes, rates, seed).groupBy("mix_name", "source").agg(
        F.count_if(F.col("copy_no") == 1).alias("used"), F.count(F.lit(1)).alias("copies"), F.max("copy_no").alias("most_copies"), F.sum("n_tokens").alias("tokens")
    )
    rows = rates.join(used, ["mix_name", "source"], "left").fillna(0, ["used", "copies", "most_copies", "tokens"])
    part = F.col("rate") - F.floor("rate")
    spread = sizes.join(F.broadcast(rates.where("rate > 0").select("mix_name", "source", "rate")), "source").groupBy("mix_name", "source")
    spread = spread.agg(F.sqrt(F.sum(F.col("n_tokens").cast("double") * F.col("n_tokens") * part * (1 - part))).alias("spread"))
    rows = rows.join(spread, ["mix_name", "source"], "left").fillna(0.0, ["spread"])
    total = rows.groupBy("mix_name").agg(F.sum("tokens").alias("all_tokens"))
    share = F.when(F.col("all_tokens") > 0, F.col("tokens") / F.col("all_tokens")).otherwise(0.0)
    return rows.join(total, "mix_name").select(
        "mix_name", "source", "target_weight", "max_repeats", "rate", "documents", "used", "copies", "most_copies", "tokens", share.alias("share"),
        F.when(F.col("all_tokens") > 0, F.col("spread") / F.col("all_tokens")).otherwise(0.0).alias("deviation"),
    )
