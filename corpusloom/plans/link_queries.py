"""Queries: references, terms, similarity and graphs."""

from pyspark.sql import functions as F

from corpusloom.functions import ids, markdown
from corpusloom.operators import graph, links, notes, related, terms
from corpusloom.plans import Registry
from corpusloom.sources.tables import load

REGISTRY = Registry()


def _unit_rows(spark, folder):
    """One row per unit: its repeats are equal but for the time of collection."""
    return load(spark, folder, "units", "unit_key", "layer", "part", "citation", "heading", "texts").dropDuplicates(["unit_key"])


_UNITS = "SELECT DISTINCT ON (unit_key) unit_key, layer, part, citation, heading, texts FROM units"
_TEXT = "array_to_string(list_concat(CASE WHEN heading IS NULL THEN [] ELSE [heading] END, list_filter(coalesce(texts, []), lambda x: x IS NOT NULL)), chr(10))"


def _unit_texts(spark, folder):
    heading = F.array_compact(F.array("heading"))
    texts = F.coalesce(F.array_compact("texts"), F.array().cast("array<string>"))
    return _unit_rows(spark, folder).withColumn("text", F.array_join(F.concat(heading, texts), "\n"))


@REGISTRY.add("unit_text", f"SELECT unit_key, sha256({_TEXT}) AS hash, length({_TEXT}) AS chars FROM ({_UNITS})")
def unit_text(spark, folder):
    return _unit_texts(spark, folder).select("unit_key", F.sha2("text", 256).alias("hash"), F.length("text").alias("chars"))


# The SQL takes lists apart in its own way: all that can stand in a list, then the numbers in it.
_S, _SOUP = r"[0-9]+[a-z]?\.[0-9]+[a-z]?", r"[\s,;§]|and/or |and |or |through |to "
_REFS = rf"""
    WITH u AS (SELECT unit_key, coalesce(nullif(regexp_extract(citation, '{_S}'), ''), regexp_extract(citation, '^AIM (.*)$', 1)) AS own, {_TEXT} AS text FROM ({_UNITS})),
    l AS (
      SELECT unit_key, own, 'section' AS kind, unnest(list_concat(regexp_extract_all(text, '§\s*{_S}'), regexp_extract_all(text, '(?:§§|[Ss]ections|14 CFR(?: sections?| ?§+)?)\s*{_S}(?:{_SOUP}|\([0-9A-Za-z]+\)|{_S})*'))) AS listed, '{_S}' AS form FROM u
      UNION ALL SELECT unit_key, own, 'part', unnest(list_concat(list_concat(regexp_extract_all(text, '\b[Pp]art\s+([0-9]+[a-z]?)\b', 1), regexp_extract_all(text, '\b[Pp]arts\s+((?:(?:{_SOUP})*[0-9]+[a-z]?)+)\b', 1)),
        regexp_extract_all(text, '\b[Pp]art\s+((?:(?:{_SOUP})*[0-9]+[a-z]?)+)\s+of\s+this', 1))), '[0-9]+[a-z]?' FROM u
      UNION ALL SELECT unit_key, own, 'aim', unnest(regexp_extract_all(text, '\bAIM,?\s+(?:[Pp]ara(?:graphs?|s|\.)?\s+|[Ss]ections?\s+)?((?:(?:{_SOUP})*[0-9]+(?:-[0-9]+)+)+)', 1)), '[0-9]+(?:-[0-9]+)+' FROM u
    ), r AS (SELECT unit_key, own, kind, unnest(regexp_extract_all(listed, form)) AS target FROM l),
    refs AS (SELECT DISTINCT unit_key, CASE WHEN kind <> 'aim' THEN kind WHEN len(string_split(target, '-')) = 3 THEN 'paragraph' ELSE 'aim_section' END AS kind, target FROM r
      WHERE (own IS NULL OR own <> target) AND (kind <> 'aim' OR regexp_matches(target, '^[0-9]{{1,2}}-[0-9]{{1,2}}(-[0-9]{{1,3}})?$')))
"""


def _refs(spark, folder):
    own = F.coalesce(F.nullif(F.regexp_extract("citation", links.SECTION, 0), F.lit("")), F.regexp_extract("citation", "^AIM (.*)$", 1))
    return links.references(_unit_texts(spark, folder).withColumn("number", own), "unit_key", "text", own="number")


_PARAGRAPH = r"^AIM ([0-9]{1,2}-[0-9]{1,2}-[0-9]{1,3})$"


def _targets(spark, folder):
    """What a reference of each kind can point at: sections, parts and sections of the AIM (which have no title of their own) and paragraphs of the AIM."""
    rows = load(spark, folder, "cfr_section", "section", "part", "title")
    sections = rows.where("section is not null").groupBy("section").agg(F.min("title").alias("title"))
    sections = sections.select(F.lit("section").alias("kind"), F.col("section").alias("target"), "title")
    untitled = lambda df, kind, target: df.select(F.lit(kind).alias("kind"), target.alias("target"), F.lit(None).cast("string").alias("title")).distinct()
    parts = untitled(rows.where("part is not null"), "part", F.col("part"))
    number = F.regexp_extract("citation", _PARAGRAPH, 1)
    units = _unit_rows(spark, folder).where("layer = 'aim'").select(number.alias("target"), "heading").where("target <> ''")
    paragraphs = units.groupBy("target").agg(F.min("heading").alias("title")).select(F.lit("paragraph").alias("kind"), "target", "title")
    chapters = untitled(units, "aim_section", F.substring_index("target", "-", 2))
    return sections.unionByName(parts).unionByName(paragraphs).unionByName(chapters)


_TARGETS = """
    once AS (SELECT citation, heading FROM units WHERE layer = 'aim' AND regexp_matches(citation, '^AIM [0-9]{1,2}-[0-9]{1,2}-[0-9]{1,3}$') AND unit_key IS NOT NULL),
    targets AS (SELECT 'section' AS kind, section AS target, min(title) AS title FROM cfr_section WHERE section IS NOT NULL GROUP BY section
      UNION ALL SELECT DISTINCT 'part', part, NULL FROM cfr_section WHERE part IS NOT NULL
      UNION ALL SELECT 'paragraph', citation[5:], min(heading) FROM once GROUP BY citation
      UNION ALL SELECT DISTINCT 'aim_section', split_part(citation[5:], '-', 1) || '-' || split_part(citation, '-', 2), NULL FROM once)
"""


@REGISTRY.add("explicit_refs", _REFS + "SELECT * FROM refs")
def explicit_refs(spark, folder):
    return _refs(spark, folder)


@REGISTRY.add("link_resolve", _REFS + f", {_TARGETS} SELECT unit_key, kind, target, title FROM refs JOIN targets USING (kind, target)")
def link_resolve(spark, folder):
    """References with the title of their target; those without a target are in dangling_links."""
    edges = _refs(spark, folder).withColumn("to", F.struct("kind", "target"))
    targets = _targets(spark, folder).select(F.struct("kind", "target").alias("to"), "title")
    return links.resolve(edges, targets, "to").select("unit_key", "kind", "target", "title")


@REGISTRY.add("dangling_links", _REFS + f", {_TARGETS} SELECT unit_key, target FROM refs ANTI JOIN targets USING (kind, target)")
def dangling_links(spark, folder):
    """References of every kind; the form of the target tells its kind (91.155, 91, 5-4-3, 5-4)."""
    return links.dangling(_refs(spark, folder), _targets(spark, folder), "kind", "target").select("unit_key", "target")


@REGISTRY.add("backlinks", _REFS + "SELECT kind, target, array_to_string(list_sort(list(DISTINCT unit_key)), ',') AS sources, count(DISTINCT unit_key) AS n FROM refs GROUP BY ALL")
def backlinks(spark, folder):
    rows = _refs(spark, folder).withColumn("to", F.struct("kind", "target"))
    return links.backlinks(rows, "unit_key", "to").select("to.kind", "to.target", F.array_join("sources", ",").alias("sources"), "n")


@REGISTRY.add("reference_list", _REFS + """
    SELECT unit_key, string_agg(target, '; ' ORDER BY list_position(['section', 'paragraph', 'aim_section', 'part'], kind), try_cast(regexp_extract(target, '^[0-9]+') AS BIGINT), try_cast(regexp_extract(target, '^[0-9]+[^0-9]+([0-9]+)', 1) AS BIGINT) NULLS FIRST, target) AS listed FROM refs GROUP BY unit_key""")  # fmt: skip
def reference_list(spark, folder):
    """References of a note in their order: sections by number, then the AIM, parts last."""
    place = F.array_position(F.lit(["section", "paragraph", "aim_section", "part"]), F.col("kind"))
    order = [place, *notes.natural(F.col("target"))]
    return _refs(spark, folder).groupBy("unit_key").agg(notes.in_order(F.col("target"), *order, separator="; ").alias("listed"))


_SEE = r"""
    WITH t AS (SELECT DISTINCT ON (term_key) term_key, term, see_also FROM pcg_term),
    items AS (SELECT DISTINCT term_key, unnest(see_also) AS item FROM t),
    keyed AS (SELECT term_key, item, nullif(trim(regexp_replace(lower(item), '[^a-z0-9]+', '-', 'g'), '-'), '') AS slug FROM items WHERE item IS NOT NULL),
    targets AS (SELECT nullif(trim(regexp_replace(lower(term), '[^a-z0-9]+', '-', 'g'), '-'), '') AS slug, min(term) AS target FROM t WHERE term IS NOT NULL GROUP BY 1)
"""


def _see_also(spark, folder):
    rows = load(spark, folder, "pcg_term", "term_key", "term", "see_also").dropDuplicates(["term_key"])
    items = rows.select("term_key", F.explode("see_also").alias("item")).where("item is not null").distinct().withColumn("slug", ids.slug(F.col("item")))
    targets = rows.where("term is not null").select(ids.slug(F.col("term")).alias("slug"), "term").where("slug is not null").groupBy("slug").agg(F.min("term").alias("target"))
    return items, targets


@REGISTRY.add("see_also_resolve", _SEE + r"""
    SELECT term_key, item, target IS NOT NULL AS resolved, coalesce('[[' || translate(target, '[]', '()') || '|' || replace(translate(target, '[]', ''), '|', '/') || ']]', item) AS shown FROM keyed LEFT JOIN targets USING (slug)""")  # fmt: skip
def see_also_resolve(spark, folder):
    items, targets = _see_also(spark, folder)
    targets = targets.select("slug", markdown.wikilink(F.translate("target", "[]", "()"), F.col("target")).alias("link"))
    return links.resolve_or_keep(items, targets, "slug", "link", "item").select("term_key", "item", "resolved", "shown")


@REGISTRY.add("linked_stems", _SEE + r"""
    SELECT term_key, array_to_string(list_sort(list(DISTINCT replace(replace(replace(item, '[', '('), ']', ')'), '|', '/'))), '; ') AS stems FROM items WHERE item IS NOT NULL GROUP BY term_key""")  # fmt: skip
def linked_stems(spark, folder):
    items, _ = _see_also(spark, folder)
    text = markdown.wikilink(F.translate("item", "[]|", "()/"), F.col("item"), F.lit("top"))
    notes = items.groupBy("term_key").agg(F.array_join(F.collect_list(text), "\n").alias("text"))
    return notes.select("term_key", F.array_join(F.array_sort(F.array_distinct(markdown.wikilink_stems(F.col("text")))), "; ").alias("stems"))


_WORD = r"[\p{L}\p{M}0-9]+(?:[-''/][\p{L}\p{M}0-9]+)*"
_RUNS = r"""
    WITH u AS ({texts}),
    t AS ({terms}),
    b AS (SELECT term_key, term, trim(regexp_replace(regexp_replace(term, '\s*[(\[][^)\]]*[)\]]', ' ', 'g'), '\s+', ' ', 'g')) AS bare, regexp_extract(term, '[(\[]([^)\]]*)[)\]]', 1) AS inner_part FROM t),
    f AS (SELECT term_key, unnest([term, term || 's', term || 'es', CASE WHEN regexp_matches(term, '[^aeiouAEIOU][yY]$') THEN regexp_replace(term, '[yY]$', 'ies') END,
      bare, bare || 's', bare || 'es', CASE WHEN regexp_matches(bare, '[^aeiouAEIOU][yY]$') THEN regexp_replace(bare, '[yY]$', 'ies') END, inner_part]) AS form FROM b),
    forms AS (SELECT DISTINCT term_key, regexp_matches(form, '^[A-Z0-9]{{1,5}}s?$') AS exact, len(regexp_extract_all(form, '{word}')) AS n,
      CASE WHEN regexp_matches(form, '^[A-Z0-9]{{1,5}}s?$') THEN form ELSE lower(array_to_string(regexp_extract_all(form, '{word}'), ' ')) END AS run FROM f WHERE form IS NOT NULL AND form <> ''),
    w AS (SELECT unit_key, regexp_extract_all(text, '{word}', 0) AS words FROM u),
    p AS (SELECT unit_key, words, unnest(range(1, len(words) + 1)) AS i FROM w),
    runs AS (SELECT DISTINCT unit_key, array_to_string(words[i:i + n - 1], ' ') AS run FROM p, (SELECT DISTINCT n FROM forms WHERE n > 0) WHERE i + n - 1 <= len(words)),
    found AS (SELECT DISTINCT unit_key, term_key FROM (
      SELECT unit_key, term_key FROM runs JOIN forms ON exact AND runs.run = forms.run UNION ALL
      SELECT unit_key, term_key FROM (SELECT DISTINCT unit_key, lower(run) AS run FROM runs) r JOIN forms ON NOT exact AND r.run = forms.run))
"""


def _found(texts, terms):
    return _RUNS.format(texts=texts, terms=terms, word=_WORD)


# A section defines what its title is about: all behind the article.
_TITLE = r"^.* the (.+)$"
_DEFINED = f"SELECT DISTINCT regexp_extract(title, '{_TITLE}', 1) AS term, regexp_extract(title, '{_TITLE}', 1) AS term_key FROM cfr_section WHERE regexp_matches(title, '{_TITLE}')"
_UNIT_TEXTS = f"SELECT unit_key, {_TEXT} AS text FROM ({_UNITS})"


def _definitions(spark, folder):
    rows = load(spark, folder, "cfr_section", "id", "part", "title").where(F.col("title").rlike(_TITLE))
    return rows.select("id", "part", F.regexp_extract("title", _TITLE, 1).alias("term")).distinct()


@REGISTRY.add("defined_terms", _found(_UNIT_TEXTS, _DEFINED) + "SELECT * FROM found")
def defined_terms(spark, folder):
    dictionary = _definitions(spark, folder).select("term", F.col("term").alias("term_key")).distinct()
    return terms.matched_terms(_unit_texts(spark, folder).select("unit_key", "text"), "unit_key", dictionary, "term_key")


# Parts whose definitions reach further than the part itself.
_REACH = {1: (1, 199), 110: (110, 139), 401: (400, 460)}
_REACH_SQL = "CASE " + " ".join(f"WHEN number = {p} THEN {{{i}}}" for i, p in enumerate(_REACH)) + " ELSE number END"
_LO, _HI = (_REACH_SQL.format(*[r[i] for r in _REACH.values()]) for i in (0, 1))


@REGISTRY.add("scoped_terms", _found(_UNIT_TEXTS, _DEFINED) + f"""
    , defined AS (SELECT DISTINCT id, try_cast(part AS INT) AS number, regexp_extract(title, '{_TITLE}', 1) AS term FROM cfr_section WHERE regexp_matches(title, '{_TITLE}')),
    scoped AS (SELECT id, term, {_LO} AS lo, {_HI} AS hi FROM defined WHERE number IS NOT NULL),
    uses AS (SELECT DISTINCT ON (unit_key) unit_key, unit_id, try_cast(part AS INT) AS number FROM units WHERE layer = 'cfr'),
    best AS (SELECT f.unit_key, s.term, s.id, u.unit_id FROM found f JOIN uses u USING (unit_key) JOIN scoped s ON s.term = f.term_key AND u.number BETWEEN s.lo AND s.hi
      QUALIFY row_number() OVER (PARTITION BY f.unit_key, s.term ORDER BY s.hi - s.lo, s.lo, s.id) = 1)
    SELECT unit_key, term, id AS defined_in FROM best WHERE id <> unit_id""")  # fmt: skip
def scoped_terms(spark, folder):
    """Defined terms of each section's text with the one definition that holds there: in scope, the narrowest, and not the section itself."""
    defined = _definitions(spark, folder).withColumn("number", F.col("part").try_cast("int")).where("number is not null")
    scopes = defined.select(F.col("id").alias("scope_id"), "term", F.expr(_LO).alias("lo"), F.expr(_HI).alias("hi"))
    uses = load(spark, folder, "units", "unit_key", "unit_id", "layer", "part").where("layer = 'cfr'").dropDuplicates(["unit_key"]).select("unit_key", "unit_id", F.col("part").try_cast("int").alias("number"))
    found = defined_terms(spark, folder).withColumnRenamed("term_key", "term").join(uses, "unit_key").where("number is not null")
    best = terms.narrowest(terms.in_scope(found, scopes, "number", "term"), "unit_key", "term")
    return best.where("scope_id <> unit_id").select("unit_key", "term", F.col("scope_id").alias("defined_in"))


_GLOSSARY = _found("SELECT DISTINCT term_key AS unit_key, text FROM pcg_term", "SELECT DISTINCT ON (term_key) term_key, term FROM pcg_term WHERE term IS NOT NULL")


@REGISTRY.add("glossary_terms", _GLOSSARY + "SELECT * FROM found")
def glossary_terms(spark, folder):
    entries = load(spark, folder, "pcg_term", "term_key", "term", "text").dropDuplicates(["term_key"])
    return terms.matched_terms(entries.select(F.col("term_key").alias("unit_key"), "text"), "unit_key", entries.select("term_key", "term"), "term_key")


@REGISTRY.add("glossary_multiword", _GLOSSARY + f"""
    SELECT unit_key, term_key FROM found JOIN t USING (term_key) WHERE len(regexp_extract_all(term, '{_WORD}')) >= 2 OR regexp_matches(term, '^[A-Z0-9]{{1,5}}s?$')
      OR lower(term) IN (SELECT lower(item) FROM (SELECT unnest(see_also) AS item FROM pcg_term) WHERE item IS NOT NULL)""")  # fmt: skip
def glossary_multiword(spark, folder):
    """Glossary terms of several words, acronyms, and single words only if some entry refers to them."""
    entries = load(spark, folder, "pcg_term", "term_key", "term", "text", "see_also").dropDuplicates(["term_key"])
    gate = load(spark, folder, "pcg_term", "see_also").select(F.explode("see_also").alias("term"))
    dictionary = terms.multiword_or_listed(entries.select("term_key", "term"), "term", gate)
    return terms.matched_terms(entries.select(F.col("term_key").alias("unit_key"), "text"), "unit_key", dictionary, "term_key")


@REGISTRY.add("term_gate", _GLOSSARY + "SELECT unit_key, term_key FROM found WHERE unit_key <> term_key AND term_key NOT IN (SELECT term_key FROM t WHERE length(term) < 5)")
def term_gate(spark, folder):
    """Matches without those of gated (here: short) terms, and without a definition's own term."""
    gated = load(spark, folder, "pcg_term", "term_key", "term").where("length(term) < 5")
    return links.without(glossary_terms(spark, folder), gated, "term_key").where("unit_key <> term_key").select("unit_key", "term_key")


_PARTS = "(SELECT DISTINCT try_cast(part AS INT) AS number FROM cfr_section WHERE try_cast(part AS INT) IS NOT NULL)"
_SCOPES = "(SELECT p_partkey AS scope_id, p_partkey % 200 AS lo, p_partkey % 200 + p_size * (p_partkey % 7) AS hi FROM part)"


def _scoped(spark, folder):
    parts = load(spark, folder, "cfr_section", "part").select(F.col("part").try_cast("int").alias("number")).where("number is not null").distinct()
    lo = F.col("p_partkey") % 200
    scopes = load(spark, folder, "part", "p_partkey", "p_size").select(F.col("p_partkey").alias("scope_id"), lo.alias("lo"), (lo + F.col("p_size") * (F.col("p_partkey") % 7)).alias("hi"))
    return terms.in_scope(parts, scopes, "number")


@REGISTRY.add("scope_range_join", f"SELECT number, scope_id, lo, hi FROM {_PARTS} JOIN {_SCOPES} ON number BETWEEN lo AND hi")
def scope_range_join(spark, folder):
    return _scoped(spark, folder).select("number", "scope_id", "lo", "hi")


@REGISTRY.add("scope_shadow", f"SELECT number, scope_id, lo, hi FROM {_PARTS} JOIN {_SCOPES} ON number BETWEEN lo AND hi QUALIFY row_number() OVER (PARTITION BY number ORDER BY hi - lo, lo, scope_id) = 1")
def scope_shadow(spark, folder):
    return terms.narrowest(_scoped(spark, folder), "number").select("number", "scope_id", "lo", "hi")


_WEIGHTS = f"""
    WITH u AS (SELECT unit_key, layer, {_TEXT} AS text FROM ({_UNITS})),
    tf AS (SELECT unit_key, token, count(*) AS tf FROM (SELECT unit_key, unnest(regexp_extract_all(lower(text), '[a-z][a-z]+', 0)) AS token FROM u) GROUP BY ALL),
    df AS (SELECT token, count(*) AS df FROM tf GROUP BY token),
    raw AS (SELECT unit_key, token, (1 + ln(tf)) * (ln(((SELECT count(*) FROM u) + 1) / (df + 1)) + 1) AS raw FROM tf JOIN df USING (token)),
    w AS (SELECT unit_key, token, raw / sqrt(sum(raw * raw) OVER (PARTITION BY unit_key)) AS w FROM raw),
    scored AS (SELECT a.unit_key AS src, b.unit_key AS dst, round(sum(a.w * b.w), 6) AS score FROM w a JOIN w b ON a.token = b.token AND a.unit_key <> b.unit_key GROUP BY ALL HAVING score >= 0.25),
    top AS (SELECT src, dst, x.layer = y.layer AS same_group, score, row_number() OVER (PARTITION BY src, x.layer = y.layer ORDER BY score DESC, dst) AS rank
      FROM scored JOIN u x ON x.unit_key = src JOIN u y ON y.unit_key = dst QUALIFY rank <= 5)
"""


def _related(spark, folder):
    texts = _unit_texts(spark, folder).select("unit_key", "layer", "text")
    return related.related(texts, "unit_key", "layer", None, texts.count())


@REGISTRY.add("tfidf_related_topk", _WEIGHTS + "SELECT src, dst, same_group, rank, score FROM top")
def tfidf_related_topk(spark, folder):
    return _related(spark, folder)


@REGISTRY.add("related_index", _WEIGHTS + "SELECT src, dst, same_group, rank, score, 'lexical-tfidf' AS provider_id, '1' AS provider_version FROM top")
def related_index(spark, folder):
    """The suggestions as a provider gives them: with its name and version in every row."""
    return related.indexed(_related(spark, folder))


@REGISTRY.add("related_minus_explicit", f"""
    SELECT src, dst, score FROM ({_WEIGHTS} SELECT src, dst, score FROM top) WHERE NOT EXISTS (
      SELECT 1 FROM ({_REFS} SELECT * FROM refs) r JOIN (SELECT DISTINCT unit_key, layer, citation FROM units) x
        ON x.layer || ' ' || x.citation = CASE r.kind WHEN 'section' THEN 'cfr 14 CFR § ' WHEN 'paragraph' THEN 'aim AIM ' END || r.target
      WHERE r.unit_key = src AND x.unit_key = dst)""")  # fmt: skip
def related_minus_explicit(spark, folder):
    """Suggestions whose target the unit does not cite.  A section or AIM paragraph is the units of exactly that citation; a
    part is a note of its own, of no unit, so citing it links none of its sections."""
    units = _unit_rows(spark, folder).select(F.col("unit_key").alias("dst"), "layer", "citation")
    number = lambda layer, form: F.when(F.col("layer") == layer, F.regexp_extract("citation", form, 1))
    sections = units.select(F.lit("section").alias("kind"), number("cfr", r"^14 CFR § ([0-9]+[a-z]?\.[0-9]+[a-z]?)$").alias("target"), "dst")
    paragraphs = units.select(F.lit("paragraph").alias("kind"), number("aim", _PARAGRAPH).alias("target"), "dst")
    linked = _refs(spark, folder).withColumnRenamed("unit_key", "src").join(sections.unionByName(paragraphs).where("target <> ''"), ["kind", "target"])
    return links.without(_related(spark, folder), linked, "src", "dst").select("src", "dst", "score")


@REGISTRY.add("review_filter", _WEIGHTS + "SELECT src, dst, score FROM top WHERE NOT EXISTS (SELECT 1 FROM lineitem WHERE l_returnflag = 'R' AND l_orderkey = src AND l_partkey = dst)")
def review_filter(spark, folder):
    """Suggestions without those that a review rejects; lineitem stands for the table of verdicts (order: source, part: target, flag: verdict)."""
    verdicts = load(spark, folder, "lineitem", F.col("l_orderkey").alias("src"), F.col("l_partkey").alias("dst"), F.col("l_returnflag").alias("verdict"))
    return links.reviewed(_related(spark, folder), verdicts, "R").select("src", "dst", "score")


@REGISTRY.add("vector_topk", """
    WITH n AS (SELECT vec_id, embedding::DOUBLE[] AS v FROM embeddings),
    s AS (SELECT a.vec_id AS src, b.vec_id AS dst, round(list_cosine_similarity(a.v, b.v), 6) AS score FROM n a JOIN n b ON a.vec_id <> b.vec_id WHERE a.vec_id % 50 = 0)
    SELECT src, dst, score, row_number() OVER (PARTITION BY src ORDER BY score DESC, dst) AS rank FROM s QUALIFY rank <= 5""")  # fmt: skip
def vector_topk(spark, folder):
    return related.nearest_vectors(load(spark, folder, "embeddings", "vec_id", "embedding"), "vec_id", "embedding", "id % 50 = 0")


@REGISTRY.add("token_tf", f"SELECT unit_key, token, count(*) AS tf FROM (SELECT unit_key, unnest(regexp_extract_all(lower({_TEXT}), '[a-z]+', 0)) AS token FROM ({_UNITS})) GROUP BY ALL")
def token_tf(spark, folder):
    rows = _unit_texts(spark, folder).select("unit_key", F.explode(F.regexp_extract_all(F.lower("text"), F.lit("[a-z]+"), F.lit(0))).alias("token"))
    return rows.groupBy("unit_key", "token").agg(F.count(F.lit(1)).alias("tf"))


@REGISTRY.add("token_df", "SELECT token, count(DISTINCT doc_id) AS df FROM (SELECT doc_id, unnest(regexp_extract_all(lower(text), '[a-z]+', 0)) AS token FROM documents) GROUP BY token")
def token_df(spark, folder):
    rows = load(spark, folder, "documents", "doc_id", "text").select("doc_id", F.explode(F.array_distinct(F.regexp_extract_all(F.lower("text"), F.lit("[a-z]+"), F.lit(0)))).alias("token"))
    return rows.groupBy("token").agg(F.count(F.lit(1)).alias("df"))


_TREE = "(SELECT p_partkey AS child, p_partkey // 2 AS parent FROM part WHERE p_partkey > 1)"
_CLOSURE = f"WITH RECURSIVE a AS (SELECT child, parent AS ancestor, 1 AS depth FROM {_TREE} UNION ALL SELECT a.child, e.parent, depth + 1 FROM a JOIN {_TREE} e ON e.child = a.ancestor)"


def _tree(spark, folder):
    return load(spark, folder, "part", "p_partkey").where("p_partkey > 1").select(F.col("p_partkey").alias("child"), F.floor(F.col("p_partkey") / 2).alias("parent"))


@REGISTRY.add("ancestors", _CLOSURE + " SELECT child, ancestor, depth FROM a")
def ancestors(spark, folder):
    return graph.ancestors(_tree(spark, folder), "child", "parent")


@REGISTRY.add("prereq_levels", _CLOSURE + " SELECT p_partkey, coalesce(max(depth), 0) AS level FROM part LEFT JOIN a ON a.child = p_partkey GROUP BY 1")
def prereq_levels(spark, folder):
    return graph.prerequisite_levels(load(spark, folder, "part", "p_partkey"), _tree(spark, folder), "p_partkey", "child", "parent")


@REGISTRY.add("cycle_check", """
    WITH RECURSIVE below AS (SELECT 3::BIGINT AS node UNION ALL SELECT p_partkey FROM part JOIN below ON p_partkey // 2 = node WHERE p_partkey > 3)
    SELECT node FROM below UNION ALL SELECT unnest([-1, -2, -3])""")  # fmt: skip
def cycle_check(spark, folder):
    """The whole tree with node 3 hung on a loop instead of 1: the loop, 3 and all descendants of 3."""
    loop = spark.createDataFrame([(-1, -2), (-2, -3), (-3, -1), (3, -1)], "child long, parent long")
    return graph.cyclic_nodes(_tree(spark, folder).where("child <> 3").unionByName(loop), "child", "parent")
