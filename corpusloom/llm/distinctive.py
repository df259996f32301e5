"""How distinctive a word is for a record."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.llm.common import joined_text, latest
from corpusloom.llm.forms import one_form
from corpusloom.scratch import cut

WORD = r"[\p{L}\p{N}]+"


def unit_texts(units: DataFrame) -> DataFrame:
    """(unit_key, text): heading and texts of each unit, in the one form and in lower case."""
    rows = latest(units, "unit_key", "collected_at", "heading", "texts")
    rows = rows.select("unit_key", joined_text(F.col("texts"), F.col("heading")).alias("text"))
    return one_form(rows, "text", "unit_key").withColumn("text", F.lower("text"))


def distinctive_words(texts: DataFrame, key: str, records: int, word: str = WORD) -> DataFrame:
    """(key, word, tf, df, score) of rows (key, text), one row per key; ``records`` is the number of all records.

    score = tf / words of the record * (ln((1 + records) / (1 + df)) + 1).  A null or empty text has no word and gives no row,
    but counts among the records.  Counts of (record, word) are distinct before the word counts, so a word counts once per
    record; both are folded before the shuffle.
    """
    words = F.regexp_extract_all("text", F.lit(word), F.lit(0))
    rows = texts.select(key, words.alias("words")).select(key, F.size("words").alias("words_in"), F.explode("words").alias("word"))
    tf = cut(rows.groupBy(key, "words_in", "word").agg(F.count(F.lit(1)).alias("tf")), "word-counts")
    df = tf.groupBy("word").agg(F.count(F.lit(1)).alias("df"))
    idf = F.log((1 + F.lit(records)) / (1 + F.col("df"))) + 1
    return tf.join(df, "word").select(key, "word", "tf", "df", (F.col("tf") / F.col("words_in") * idf).alias("score"))
