"""Lexically related records: exact top-k by cosine of TF-IDF weights above a floor."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from corpusloom.operators import cosine
from corpusloom.scratch import drop_tables, free_shuffles, new_path

# Name and version of this provider of related records.
PROVIDER = ("lexical-tfidf", "1")


def weights(texts: DataFrame, key: str, records: int, word: str = "[a-z][a-z]+") -> DataFrame:
    """(key, token, w): (1 + ln tf) * (ln((n + 1) / (df + 1)) + 1), each record's weights of length 1.

    Rows are (key, text), one per key; null and empty texts have no weights.
    """
    tokens = texts.select(key, F.explode(F.regexp_extract_all(F.lower("text"), F.lit(word), F.lit(0))).alias("token"))
    tf = tokens.groupBy(key, "token").agg(F.count(F.lit(1)).alias("tf"))
    df = tf.groupBy("token").agg(F.count(F.lit(1)).alias("df"))
    raw = tf.join(df, "token").select(key, "token", ((1 + F.log("tf")) * (F.log((F.lit(records) + 1) / (F.col("df") + 1)) + 1)).alias("raw"))
    norm = raw.groupBy(key).agg(F.sqrt(F.sum(F.col("raw") * F.col("raw"))).alias("norm"))
    return raw.join(norm, key).select(key, "token", (F.col("raw") / F.col("norm")).alias("w"))


def related(texts: DataFrame, key: str, group: str, queries, records: int, k: int = 5, floor: float = 0.25, block: int | None = None, rows_at_once: int = 4096) -> DataFrame:
    """(src, dst, same_group, rank, score): for each query record the ``k`` most similar of its own group and of the others.

    ``queries`` is a condition on ``key``, a whole number, that picks the query records, or None for all; all records are searched.
    Records of equal text and group are one node with all their keys, so only different texts meet.  Nodes are written once to
    the shared folder as counts of numbered tokens; a task takes a block of them as queries, reads all in lots and keeps each
    query's best: tokens of a thirtieth of the records meet as a matrix product, the others by token.  All that can be among the
    ``k`` best by these sums in single precision and their error bound gets its full cosine, rounded to 6 digits; ties go to the
    least key.  Pairs are neither moved nor written.  Nothing is capped.
    """
    spark = texts.sparkSession
    asks = F.col(key) if queries is None else F.when(F.expr(queries), F.col(key))
    dictionary, path, once = (new_path(spark, name) for name in ("dictionary", "nodes", "texts"))
    texts.select(F.col(key).cast("long").alias("key"), asks.cast("long").alias("asks"), F.col(group).cast("string").alias("grp"), "text").write.parquet(once)
    texts = spark.read.schema("key long, asks long, grp string, text string").parquet(once)
    free_shuffles(spark)
    tokens = F.regexp_extract_all(F.lower("text"), F.lit("[a-z][a-z]+"), F.lit(0))
    df = texts.select(F.explode(F.array_distinct(tokens)).alias("token")).groupBy("token").agg(F.count(F.lit(1)).alias("df"))
    df.where("df > 1").write.parquet(dictionary)
    hashed = texts.select("key", "asks", "grp", F.unhex(F.sha2("text", 256)).alias("text"), tokens.alias("tokens")).where("key is not null and size(tokens) > 0")
    counted = hashed.mapInArrow(cosine.counted(dictionary), "key long, asks long, grp string, text binary, vector binary, tokens int")
    same = counted.groupBy("text", "grp").agg(F.sort_array(F.collect_list("key")).alias("keys"), F.sort_array(F.collect_list("asks")).alias("asks"), F.first("vector").alias("vector"), F.first("tokens").alias("tokens"))
    same.drop("text").write.parquet(path)
    drop_tables(once)
    nodes, longest = spark.read.schema("tokens int").parquet(path).agg(F.count("tokens"), F.coalesce(F.max("tokens"), F.lit(0))).first()
    block = block or min(4608, max(256, -(-nodes // 24)))  # large blocks read all others less often
    blocks = max(1, -(-nodes // block))
    search = cosine.nearest(dictionary, path, records, longest, k, floor, block, rows_at_once)
    return spark.range(0, blocks, 1, blocks).mapInArrow(search, "src long, dst long, same_group boolean, rank int, score double")


def indexed(suggestions: DataFrame, provider: tuple[str, str] = PROVIDER) -> DataFrame:
    """Suggestions with name and version of their provider; any provider gives rows (src, dst, rank, score)."""
    return suggestions.withColumns({"provider_id": F.lit(provider[0]), "provider_version": F.lit(provider[1])})


def nearest_vectors(vectors: DataFrame, key: str, vector: str, queries, k: int = 5, block: int = 256, rows_at_once: int = 8192) -> DataFrame:
    """(src, dst, rank, score): the ``k`` nearest of all records by cosine, exactly, for each query record.

    The query vectors are written once to the shared folder.  Records stay where they are read: each task takes its own in
    lots, reads the queries block by block, and forms one matrix product for a lot and a block; a lot keeps its ``k`` best for
    each query before they meet.  Null vectors and vectors of length 0 take no part; vectors of different lengths are an error.
    """
    import pyarrow as pa

    rows = vectors.select(F.col(key).cast("long").alias("id"), F.col(vector).cast("array<double>").alias("v")).where("id is not null and v is not null and exists(v, x -> x <> 0)")
    path = new_path(vectors.sparkSession, "queries")
    rows.where(queries).write.parquet(path)

    def best(batches):
        import numpy as np
        from pyarrow import dataset, fs

        store, place = fs.FileSystem.from_uri("file:///" + path[5:].lstrip("/") if path.startswith("file:") else path)
        asked = dataset.dataset(place, filesystem=store, format="parquet")

        def unit(batch):
            v = batch.column("v").combine_chunks() if isinstance(batch, pa.Table) else batch.column("v")
            v = np.asarray(v.flatten()).reshape(batch.num_rows, -1)
            return np.asarray(batch.column("id")), v / np.linalg.norm(v, axis=1)[:, None]

        def nearest(lot: pa.Table):
            ids, v = unit(lot)
            for own in asked.to_batches(batch_size=block):
                if own.num_rows == 0:
                    continue
                src, q = unit(own)
                score = np.round(q @ v.T, 6)
                score[src[:, None] == ids[None, :]] = -np.inf
                if len(ids) > k:
                    i, j = np.nonzero(score >= np.partition(score, -k, axis=1)[:, -k][:, None])
                else:
                    i, j = np.nonzero(score > -np.inf)
                order = np.lexsort((ids[j], -score[i, j], i))
                i, j = i[order], j[order]
                kept = (np.arange(len(i)) - np.searchsorted(i, i) < k) & (score[i, j] > -np.inf)
                i, j = i[kept], j[kept]
                yield pa.RecordBatch.from_arrays([pa.array(src[i], pa.int64()), pa.array(ids[j], pa.int64()), pa.array(score[i, j])], names=["src", "dst", "score"])

        held: list[pa.RecordBatch] = []
        for batch in batches:
            held.append(batch)
            if sum(b.num_rows for b in held) >= rows_at_once:
                yield from nearest(pa.Table.from_batches(held))
                held = []
        if any(b.num_rows for b in held):
            yield from nearest(pa.Table.from_batches(held))

    found = rows.mapInArrow(best, "src long, dst long, score double")
    order = Window.partitionBy("src").orderBy(F.desc("score"), "dst")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("src", "dst", "rank", "score")
