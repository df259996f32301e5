"""Defined terms in texts: an equality join of word runs with a dictionary, and the scopes of definitions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpusloom.scratch import cut


def variants(term: Column) -> Column:
    """Forms under which a term is matched: itself, its plurals, without its bracketed part, and that part alone."""
    bare = F.trim(F.regexp_replace(F.regexp_replace(term, r"\s*[(\[][^)\]]*[)\]]", " "), r"\s+", " "))
    inner = F.regexp_extract(term, r"[(\[]([^)\]]*)[)\]]", 1)
    ies = lambda x: F.when(x.rlike("[^aeiouAEIOU][yY]$"), F.regexp_replace(x, "[yY]$", "ies"))
    forms = F.array(term, F.concat(term, F.lit("s")), F.concat(term, F.lit("es")), ies(term), bare, F.concat(bare, F.lit("s")), F.concat(bare, F.lit("es")), ies(bare), inner)
    return F.array_distinct(F.filter(forms, lambda x: x.isNotNull() & (F.length(x) > 0)))


ACRONYM = "^[A-Z0-9]{1,5}s?$"
WORDS = r"[\p{L}\p{M}0-9]+(?:[-'/][\p{L}\p{M}0-9]+)*"


def multiword_or_listed(terms: DataFrame, term: str, gate: DataFrame) -> DataFrame:
    """Terms that may be linked: those of several words, acronyms, and of the others those that the gate (column of the same name) lists in any case."""
    words = F.size(F.regexp_extract_all(term, F.lit(WORDS), F.lit(0)))
    listed = gate.select(F.lower(term).alias("__term")).distinct().withColumn("__listed", F.lit(True))
    rows = terms.withColumn("__term", F.lower(term)).join(listed, "__term", "left")
    return rows.where((words >= 2) | F.col(term).rlike(ACRONYM) | F.col("__listed")).drop("__term", "__listed")


FEW = 200_000  # first words of a dictionary up to which they are broadcast (some MB)


def matched_terms(texts: DataFrame, key: str, terms: DataFrame, term_key: str) -> DataFrame:
    """(key, term_key): the terms (term_key, term) that occur in the texts (key, text), each once.

    Terms are matched by words, in any case; a term of one word in capitals, of at most five letters, only as written.  A run of
    words is formed only where a word begins a form of the dictionary, and only as long as the forms that begin so, whatever
    their length: all else of a text never leaves its task, unless the dictionary has more than ``FEW`` first words.  These are
    counted first; fewer are broadcast, more are joined by word.  The driver collects that count and the longest form's.
    """
    forms = terms.where("term is not null").select(term_key, F.explode(variants(F.col("term"))).alias("form"))
    split = forms.select(term_key, "form", F.col("form").rlike(ACRONYM).alias("exact"), F.regexp_extract_all("form", F.lit(WORDS), F.lit(0)).alias("words")).where("size(words) > 0")
    split = split.withColumns({"first": F.lower(F.get("words", F.lit(0))), "n": F.size("words")})
    run = F.when(F.col("exact"), F.col("form")).otherwise(F.lower(F.array_join("words", " ")))
    firsts = cut(split.groupBy("first").agg(F.collect_set("n").alias("lengths")), "first-words")
    count, longest = firsts.agg(F.count(F.lit(1)), F.max(F.array_max("lengths"))).first()
    words = texts.where("text is not null").select(key, F.regexp_extract_all("text", F.lit(WORDS), F.lit(0)).alias("words"))
    ahead = F.transform("words", lambda w, i: F.struct(F.lower(w).alias("first"), F.slice("words", i + 1, longest or 1).alias("ahead")))
    begun = words.select(key, F.inline(ahead)).join(F.broadcast(firsts) if count <= FEW else firsts, "first")
    fits = F.filter("lengths", lambda n: n <= F.size("ahead"))
    runs = begun.select(key, F.explode(F.transform(fits, lambda n: F.array_join(F.slice("ahead", 1, n), " "))).alias("run"))
    written = F.when(F.col("run").rlike(ACRONYM), F.struct(F.lit(True).alias("exact"), F.col("run")))
    both = runs.select(key, F.explode(F.array_compact(F.array(F.struct(F.lit(False).alias("exact"), F.lower("run").alias("run")), written))).alias("r"))
    return both.select(key, "r.exact", "r.run").join(split.select(term_key, "exact", run.alias("run")).distinct(), ["exact", "run"]).select(key, term_key).distinct()


def in_scope(uses: DataFrame, scopes: DataFrame, at: str, *on: str, width: int = 64) -> DataFrame:
    """Uses (with a number ``at``) joined with every scope (lo, hi) that holds that number and is equal in the columns ``on``.

    Both sides meet on buckets of ``width`` numbers, so there is no nested loop; a scope is repeated for each bucket that it
    touches.  Null bounds or numbers match nothing.
    """
    buckets = F.explode(F.sequence(F.floor(F.col("lo") / width), F.floor(F.col("hi") / width))).alias("__bucket")
    wide = scopes.where("lo <= hi").select("*", buckets)
    placed = uses.withColumn("__bucket", F.floor(F.col(at) / width))
    return placed.join(wide, ["__bucket", *on]).where(F.col(at).between(F.col("lo"), F.col("hi"))).drop("__bucket")


def narrowest(found: DataFrame, *by: str) -> DataFrame:
    """Of several definitions in scope the one of the narrowest scope; ties go to the least ``lo``, then ``scope_id``."""
    order = Window.partitionBy(*by).orderBy(F.col("hi") - F.col("lo"), "lo", "scope_id")
    return found.withColumn("__n", F.row_number().over(order)).where("__n = 1").drop("__n")
