"""Queries of the text problems, and the SQL of those that SQL can express on whole tables."""

from pyspark.sql import functions as F

from corpusloom.llm import copies, distinctive, mixing, packing, pieces, truncation
from corpusloom.llm.common import joined_text, latest
from corpusloom.llm.forms import one_form
from corpusloom.plans import Registry
from corpusloom.sources.tables import load

REGISTRY = Registry()


def _units(spark, folder):
    return load(spark, folder, "units", "unit_key", "heading", "texts", "layer", "collected_at")


def _terms(spark, folder):
    return load(spark, folder, "pcg_term", "term_key", "term", "fetched_at")


def _of(tbl, rows):
    return rows.select(F.lit(tbl).alias("tbl"), *rows.columns)


@REGISTRY.add("p1_found")
def p1_found(spark, folder):
    """Pairs of units and of glossary entries with nearly the same content."""
    units, terms = copies.unit_copies(_units(spark, folder)), copies.term_copies(_terms(spark, folder))
    return _of("units", units.pairs()).unionByName(_of("pcg_term", terms.pairs()))


@REGISTRY.add("p1_groups")
def p1_groups(spark, folder):
    """Class, group and number of links of every unit and glossary entry that takes part."""
    units, terms = copies.unit_copies(_units(spark, folder)), copies.term_copies(_terms(spark, folder))
    return _of("units", units.groups()).unionByName(_of("pcg_term", terms.groups()))


@REGISTRY.add("p1_links")
def p1_links(spark, folder):
    """Pairs of linked classes; p1_groups says which records are in them."""
    units, terms = copies.unit_copies(_units(spark, folder)), copies.term_copies(_terms(spark, folder))
    return _of("units", units.linked_classes()).unionByName(_of("pcg_term", terms.linked_classes()))


@REGISTRY.add("p2_found")
def p2_found(spark, folder):
    """Pairs of units and of glossary entries that look the same but differ in their characters."""
    units, terms = copies.unit_spellings(_units(spark, folder)), copies.term_spellings(_terms(spark, folder))
    return _of("units", units).unionByName(_of("pcg_term", terms))


@REGISTRY.add("p2_terms")
def p2_terms(spark, folder):
    """Every glossary entry's term in its one form."""
    rows = latest(_terms(spark, folder), "term_key", "fetched_at", "term")
    return one_form(rows, "term", "term_key")


@REGISTRY.add("p2_texts")
def p2_texts(spark, folder):
    """Every text of every unit in its one form."""
    rows = latest(_units(spark, folder), "unit_key", "collected_at", "texts")
    return one_form(rows.select("unit_key", F.posexplode("texts").alias("at", "text")), "text", "unit_key", "at")


def _pieces(spark, folder):
    units = latest(_units(spark, folder), "unit_key", "collected_at", "layer", "heading", "texts")
    texts = units.select("unit_key", "layer", joined_text(F.col("texts"), F.col("heading")).alias("text"))
    return pieces.split_texts(texts.join(load(spark, folder, "split_rule"), "layer", "left"), "unit_key")


@REGISTRY.add(
    "p3_found",
    """
    SELECT DISTINCT unit_key FROM units JOIN split_rule USING (layer)
    WHERE length(array_to_string(list_concat(CASE WHEN heading IS NULL THEN [] ELSE [heading] END, list_filter(coalesce(texts, []), lambda x: x IS NOT NULL)), chr(10))) > max_chars
    """,
)
def p3_found(spark, folder):
    """Units that were cut: those with a second piece."""
    return _pieces(spark, folder).where("piece_no = 2").select("unit_key")


@REGISTRY.add("p3_pieces")
def p3_pieces(spark, folder):
    """The pieces of every unit text."""
    return _pieces(spark, folder)


def _scores(spark, folder, word=distinctive.WORD):
    units = _units(spark, folder)
    records = units.where("unit_key is not null").select("unit_key").distinct().count()
    return distinctive.distinctive_words(distinctive.unit_texts(units), "unit_key", records, word)


@REGISTRY.add("p5_found")
def p5_found(spark, folder):
    """Words of at least five letters that occur three times in a unit and in two to eight units."""
    return _scores(spark, folder, r"\p{L}{5,}").where("tf >= 3 and df between 2 and 8").select("unit_key", "word")


@REGISTRY.add("p5_scores")
def p5_scores(spark, folder):
    """Score of every word of every unit."""
    return _scores(spark, folder)


def _documents(spark, folder, *columns):
    return load(spark, folder, "documents", "doc_id", "source", "text", *columns)


@REGISTRY.add("p8_found")
def p8_found(spark, folder):
    """Documents whose text was cut off."""
    return truncation.truncation_scores(_documents(spark, folder)).where("score > 0").select("doc_id")


@REGISTRY.add("p8_scores")
def p8_scores(spark, folder):
    """Every document with its limit, the posterior there, and the log odds of its ending."""
    return truncation.truncation_scores(_documents(spark, folder))


@REGISTRY.add("p8_evidence")
def p8_evidence(spark, folder):
    """Documents whose length decides: at the base rate of their ending alone they would be judged otherwise."""
    return truncation.truncation_scores(_documents(spark, folder)).where("by_length").select("doc_id", "source", "at_limit", "censored", "ending", "score")


@REGISTRY.add("p8_rates")
def p8_rates(spark, folder):
    """How many texts each source has, and how many and which share of them were cut."""
    scores = truncation.truncation_scores(_documents(spark, folder))
    cut = F.count_if(F.col("score") > 0)
    return scores.groupBy("source").agg(F.count(F.lit(1)).alias("texts"), cut.alias("truncated"), (cut / F.count(F.lit(1))).alias("rate"))


@REGISTRY.add("p6_containers")
def p6_containers(spark, folder):
    """The container of every document, or of its parts, for each capacity."""
    return packing.pack(load(spark, folder, "documents", "doc_id", "text"), load(spark, folder, "container_spec"))


@REGISTRY.add("p6_fill")
def p6_fill(spark, folder):
    """How full the containers are."""
    return packing.fill_rates(p6_containers(spark, folder))


@REGISTRY.add("p7_mix")
def p7_mix(spark, folder):
    """Every use of every document in each mix."""
    sizes = mixing.measured(_documents(spark, folder))
    return mixing.mix(sizes, mixing.repetition_rates(sizes, load(spark, folder, "mix_target")))


@REGISTRY.add("p7_shares")
def p7_shares(spark, folder):
    """The shares that each mix reaches."""
    return mixing.shares(mixing.measured(_documents(spark, folder)), load(spark, folder, "mix_target"))
