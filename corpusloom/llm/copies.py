"""Near copies of units and of glossary terms: classes of equal texts, links between classes, groups and pairs."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.llm.common import expand_pairs, joined_text, latest
from corpusloom.llm.forms import one_form
from corpusloom.llm.near_duplicates import groups_of, similar_sets, similar_strings
from corpusloom.scratch import cut, free_shuffles

WORD = r"[\p{L}\p{N}]+"


@dataclass(frozen=True)
class Copies:
    """``members``: (item, key), every key with its class; ``links``: (a, b), a < b, between classes of different texts."""

    members: DataFrame
    links: DataFrame

    def pairs(self) -> DataFrame:
        """(key_a, key_b): all pairs of keys, in one class or in two linked ones."""
        across = expand_pairs(self.links, self.members, "a", "b", "item", "key")
        l, r = self.members.alias("l"), self.members.alias("r")
        within = l.join(r, (F.col("l.item") == F.col("r.item")) & (F.col("l.key") < F.col("r.key")))
        return across.unionByName(within.select(F.col("l.key").alias("key_a"), F.col("r.key").alias("key_b")))

    def linked_classes(self) -> DataFrame:
        """(class_a, class_b): linked classes of different texts, each pair once; with ``groups`` this is all of ``pairs`` unexpanded."""
        return self.links.select(F.col("a").alias("class_a"), F.col("b").alias("class_b"))

    def groups(self) -> DataFrame:
        """(key, class_id, group_id, links): one row per key; ``links`` counts the other texts that its text is linked with."""
        ends = self.links.select(F.explode(F.array("a", "b")).alias("item")).groupBy("item").agg(F.count(F.lit(1)).alias("links"))
        return (
            self.members.join(groups_of(self.links), "item", "left")
            .join(ends, "item", "left")
            .select("key", F.col("item").alias("class_id"), F.coalesce("group", "item").alias("group_id"), F.coalesce("links", F.lit(0).cast("long")).alias("links"))
        )


def _classes(rows: DataFrame, key: str, *content: str) -> tuple[DataFrame, DataFrame]:
    """Members (item, key) and one row per class (item, content...) of rows (key, same, content...); a class is named by its least key."""
    classes = rows.groupBy("same").agg(F.min(key).alias("item"), *[F.min(c).alias(c) for c in content])
    members = rows.select(F.col(key).alias("key"), "same").join(classes.select("same", "item"), "same").select("item", "key")
    return members, classes.drop("same")


def unit_copies(units: DataFrame, least: float = 0.5, run: int = 3, words: int = 50) -> Copies:
    """Units whose texts share at least ``least`` of their distinct runs of ``run`` words.

    Texts are joined by a newline (heading left out) in their one form and in lower case; a word is a run of letters and
    digits.  Units with fewer than ``words`` words, or with null or empty texts, belong to no class.  Several rows of a unit
    count once; a null key is left out.
    """
    texts = latest(units, "unit_key", "collected_at", "texts").select("unit_key", joined_text(F.col("texts")).alias("text"))
    spoken = one_form(texts, "text", "unit_key").select("unit_key", F.regexp_extract_all(F.lower("text"), F.lit(WORD), F.lit(0)).alias("words"))
    # words hold no blank, so they travel as one string, which is a fraction of their array or of the hashes of their runs
    spoken = spoken.where(F.size("words") >= max(words, run)).select("unit_key", F.array_join("words", " ").alias("words"))
    spoken = cut(spoken, "unit-words")
    free_shuffles(units.sparkSession)
    members, classes = _classes(spoken.withColumn("same", F.sha2("words", 256)), "unit_key", "words")
    members, classes = cut(members, "unit-members"), cut(classes.select("item", "words"), "unit-classes")
    free_shuffles(units.sparkSession)

    def runs(held):
        at = lambda w, i: F.xxhash64(*[F.get(w, i + j) for j in range(run)])
        of = lambda w: F.array_distinct(F.transform(F.sequence(F.lit(0), F.size(w) - run), lambda i: at(w, i)))
        return F.get(F.transform(F.array(F.split(held, " ")), of), F.lit(0))  # split once, not at each run

    links = cut(similar_sets(classes, least, runs).select("a", "b"), "unit-links")
    free_shuffles(units.sparkSession)
    return Copies(members, links)


def term_copies(terms: DataFrame, edits: int = 2, least: int = 8) -> Copies:
    """Glossary entries whose terms are equal, at most ``edits`` edits apart, or the same words in another order.

    Terms are taken in their one form and in lower case; null terms and those of fewer than ``least`` characters belong to no
    class.  Terms without any word are compared by edits only.  Several rows of an entry count once.
    """
    rows = latest(terms, "term_key", "fetched_at", "term").where("term is not null")
    rows = one_form(rows, "term", "term_key").select("term_key", F.lower("term").alias("text"))
    rows = rows.where(F.length("text") >= least).withColumn("same", F.col("text"))
    members, classes = _classes(rows, "term_key", "text")
    classes = cut(classes, "terms")
    members = cut(members, "term-members")
    edited = similar_strings(classes, edits)
    words = F.regexp_extract_all("text", F.lit(WORD), F.lit(0))
    bags = classes.where(F.size(words) > 0).select("item", F.array_join(F.array_sort(words), " ").alias("bag"))
    l, r = bags.alias("l"), bags.alias("r")
    moved = l.join(r, (F.col("l.bag") == F.col("r.bag")) & (F.col("l.item") < F.col("r.item"))).select(F.col("l.item").alias("a"), F.col("r.item").alias("b"))
    links = cut(edited.unionByName(moved).distinct(), "term-links")
    free_shuffles(terms.sparkSession)
    return Copies(members, links)


def spelling_pairs(rows: DataFrame, key: str) -> DataFrame:
    """(key_a, key_b): rows (key, form, spelt) of one form that are spelt in different characters.

    Rows of one form and one spelling are a class; only forms with several spellings are paired, class by class.
    """
    rows = rows.select(key, F.sha2("form", 256).alias("form"), F.sha2("spelt", 256).alias("spelt"))
    rows = cut(rows, "spellings")
    kinds = rows.select("form", "spelt").distinct()
    l, r = kinds.alias("l"), kinds.alias("r")
    pairs = l.join(r, (F.col("l.form") == F.col("r.form")) & (F.col("l.spelt") < F.col("r.spelt"))).select(F.col("l.spelt").alias("a"), F.col("r.spelt").alias("b"))
    return expand_pairs(pairs, rows, "a", "b", "spelt", key)


def unit_spellings(units: DataFrame) -> DataFrame:
    """Units (key_a, key_b) with the same number of texts that look alike one by one, at least one in other characters.

    Null texts and empty arrays have no case; a null element only equals a null element.
    """
    rows = latest(units, "unit_key", "collected_at", "texts").where(F.size("texts") > 0)
    parts = rows.select("unit_key", F.posexplode("texts").alias("at", "text"))
    formed = one_form(parts, "text", "unit_key", "at").groupBy("unit_key").agg(F.array_sort(F.collect_list(F.struct("at", "text"))).alias("parts"))
    both = formed.join(rows, "unit_key").select("unit_key", F.to_json("parts.text").alias("form"), F.to_json("texts").alias("spelt"))
    return spelling_pairs(both, "unit_key")


def term_spellings(terms: DataFrame) -> DataFrame:
    """Glossary entries (key_a, key_b) whose terms look alike but differ in their characters; null terms have no case."""
    rows = latest(terms, "term_key", "fetched_at", "term").where("term is not null").withColumn("spelt", F.col("term"))
    return spelling_pairs(one_form(rows, "term", "term_key").withColumnRenamed("term", "form"), "term_key")
