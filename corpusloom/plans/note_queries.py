"""Queries: rendering of notes."""

from pyspark.sql import functions as F

from corpusloom.functions import markdown, pages
from corpusloom.operators import notes
from corpusloom.operators.related import PROVIDER
from corpusloom.plans import Registry
from corpusloom.sources.tables import load

REGISTRY = Registry()

_SECTIONS = "SELECT DISTINCT ON (id) id, part, section, title, citation FROM cfr_section WHERE title IS NOT NULL ORDER BY id, title, source_version"


def _sections(spark, folder):
    rows = load(spark, folder, "cfr_section", "id", "part", "section", "title", "source_version", "citation").where("title is not null")
    kept = rows.groupBy("id").agg(F.min(F.struct("title", "source_version", "part", "section", "citation")).alias("r"))
    return kept.select("id", "r.part", "r.section", "r.title", "r.citation")


@REGISTRY.add("indent", "SELECT doc_id, sha256(regexp_replace(text, '(^|\n)([^\n])', '\\1    \\2', 'g')) AS hash FROM documents")
def indent(spark, folder):
    return load(spark, folder, "documents", "doc_id", "text").select("doc_id", F.sha2(markdown.indent(F.col("text")), 256).alias("hash"))


@REGISTRY.add("list_items", """
    SELECT doc_id, sha256(repeat('    ', (doc_id % 3)::INT) || '- ' || regexp_replace(text, '\n([^\n])', '\n    ' || repeat('    ', (doc_id % 3)::INT) || '\\1', 'g')) AS hash FROM documents WHERE trim(text) <> ''""")  # fmt: skip
def list_items(spark, folder):
    rows = load(spark, folder, "documents", "doc_id", "text").where("trim(text) <> ''")
    return rows.select("doc_id", F.sha2(markdown.list_item(F.col("text"), (F.col("doc_id") % 3).cast("int")), 256).alias("hash"))


@REGISTRY.add("nested_items", """
    WITH d AS (SELECT n_nationkey, n_regionkey, '- ' || n_name || coalesce(chr(10) || chr(10) || (SELECT string_agg('    - ' || s_name, chr(10) ORDER BY s_suppkey) FROM supplier WHERE s_nationkey = n_nationkey), '') AS item FROM nation)
    SELECT r_regionkey, '- ' || r_name || (SELECT string_agg(chr(10) || chr(10) || '    ' || regexp_replace(item, '\\n([^\\n])', chr(10) || '    \\1', 'g'), '' ORDER BY n_nationkey) FROM d WHERE n_regionkey = r_regionkey) AS item FROM region""")  # fmt: skip
def nested_items(spark, folder):
    """A list of three levels from the inside out: each item carries the finished items below it."""
    supplier = load(spark, folder, "supplier", "s_suppkey", "s_name", F.col("s_nationkey").alias("n_nationkey"))
    lists = supplier.groupBy("n_nationkey").agg(notes.in_order(F.concat(F.lit("- "), F.col("s_name")), F.col("s_suppkey")).alias("inner"))
    nation = load(spark, folder, "nation").join(lists, "n_nationkey", "left")
    nation = nation.select("n_nationkey", F.col("n_regionkey").alias("r_regionkey"), markdown.list_item(F.col("n_name"), F.lit(0), F.array("inner")).alias("item"))
    below = nation.groupBy("r_regionkey").agg(F.transform(F.array_sort(F.collect_list(F.struct("n_nationkey", "item"))), lambda x: x["item"]).alias("below"))
    region = load(spark, folder, "region", "r_regionkey", "r_name").join(below, "r_regionkey", "left")
    return region.select("r_regionkey", markdown.list_item(F.col("r_name"), F.lit(0), F.col("below")).alias("item"))


@REGISTRY.add("md_escape", r"SELECT id, regexp_replace('* ' || title || ' [' || section || ']', '([\[*])', '\\\1', 'g') AS escaped FROM (" + _SECTIONS + ")")
def md_escape(spark, folder):
    text = F.concat(F.lit("* "), F.col("title"), F.lit(" ["), F.col("section"), F.lit("]"))
    return _sections(spark, folder).select("id", markdown.escaped(text).alias("escaped"))


@REGISTRY.add("link_display", "SELECT DISTINCT term_key, '[[' || translate(term, '[]/', '()-') || '|' || replace(translate(term, '[]', ''), '|', '/') || ']]' AS link FROM pcg_term WHERE term IS NOT NULL")
def link_display(spark, folder):
    rows = load(spark, folder, "pcg_term", "term_key", "term").where("term is not null").distinct()
    return rows.select("term_key", markdown.wikilink(markdown.stem(F.col("term")), F.col("term")).alias("link"))


@REGISTRY.add("stem_map", "SELECT DISTINCT term_key, translate(term, '[]/', '()-') AS stem, CASE WHEN translate(term, '[]/', '()-') <> term THEN term END AS alias FROM pcg_term")
def stem_map(spark, folder):
    rows = load(spark, folder, "pcg_term", "term_key", "term").distinct().withColumn("stem", markdown.stem(F.col("term")))
    return rows.select("term_key", "stem", F.when(F.col("stem") != F.col("term"), F.col("term")).alias("alias"))


@REGISTRY.add("folder_name", "SELECT DISTINCT part, 'Part ' || repeat('0', greatest(3 - length(regexp_extract(part, '^[0-9]*', 0)), 0)::INT) || part AS folder FROM cfr_section")
def folder_name(spark, folder):
    return load(spark, folder, "cfr_section", "part").distinct().select("part", markdown.folder("Part", F.col("part")).alias("folder"))


@REGISTRY.add("folder_chapter", "SELECT DISTINCT split_part(citation[5:], '-', 1) AS chapter, 'Chapter ' || lpad(split_part(citation[5:], '-', 1), 2, '0') AS folder FROM units WHERE layer = 'aim' AND citation LIKE 'AIM %'")
def folder_chapter(spark, folder):
    rows = load(spark, folder, "units", "layer", "citation").where("layer = 'aim' and startswith(citation, 'AIM ')")
    rows = rows.select(F.split_part(F.substring("citation", 5, 100), F.lit("-"), F.lit(1)).alias("chapter")).distinct()
    return rows.select("chapter", markdown.folder("Chapter", F.col("chapter"), 2).alias("folder"))


@REGISTRY.add("reserved_ranges", r"SELECT DISTINCT id, regexp_extract(section, '^(.*[0-9])-([0-9].*)$', 1) AS first_section, regexp_extract(section, '^(.*[0-9])-([0-9].*)$', 2) AS last_section FROM cfr_section WHERE regexp_matches(section, '^.*[0-9]-[0-9].*$')")
def reserved_ranges(spark, folder):
    span = r"^(.*[0-9])-([0-9].*)$"
    rows = load(spark, folder, "cfr_section", "id", "section").where(F.col("section").rlike(span)).distinct()
    return rows.select("id", F.regexp_extract("section", span, 1).alias("first_section"), F.regexp_extract("section", span, 2).alias("last_section"))


@REGISTRY.add("alias_unique", f"WITH s AS ({_SECTIONS}) SELECT id, title, count(*) OVER (PARTITION BY lower(title)) = 1 AS is_alias FROM s")
def alias_unique(spark, folder):
    rows = _sections(spark, folder)
    counts = rows.groupBy(F.lower("title").alias("k")).agg(F.count(F.lit(1)).alias("n"))
    return rows.join(counts, F.lower("title") == F.col("k")).select("id", "title", (F.col("n") == 1).alias("is_alias"))


@REGISTRY.add("aliases", f"WITH s AS ({_SECTIONS}) SELECT id, '§ ' || section || '; 14 CFR ' || section || CASE WHEN count(*) OVER (PARTITION BY lower(title)) = 1 THEN '; ' || title ELSE '' END AS aliases FROM s")
def aliases(spark, folder):
    always = [F.concat(F.lit("§ "), F.col("section")), F.concat(F.lit("14 CFR "), F.col("section"))]
    return notes.alias_list(_sections(spark, folder), "id", F.col("title"), *always).select("id", F.array_join("aliases", "; ").alias("aliases"))


@REGISTRY.add("render_concat", "SELECT l_orderkey, string_agg(l_linenumber || ':' || l_partkey, chr(10) ORDER BY l_linenumber, l_partkey) AS body FROM lineitem GROUP BY 1")
def render_concat(spark, folder):
    rows = load(spark, folder, "lineitem", "l_orderkey", "l_linenumber", "l_partkey").withColumn("t", F.concat_ws(":", "l_linenumber", "l_partkey"))
    return rows.groupBy("l_orderkey").agg(notes.in_order(F.col("t"), F.col("l_linenumber"), F.col("l_partkey")).alias("body"))


@REGISTRY.add("sibling_ordinal", f"WITH s AS ({_SECTIONS}) SELECT id, row_number() OVER (PARTITION BY part ORDER BY try_cast(regexp_extract(section, '^([0-9]*)', 1) AS BIGINT) NULLS FIRST, try_cast(regexp_extract(section, '^[0-9]*[^0-9]*([0-9]*)', 1) AS BIGINT) NULLS FIRST, section, id) AS ordinal FROM s")
def sibling_ordinal(spark, folder):
    return notes.ordinals(_sections(spark, folder), "part", *notes.natural(F.col("section")), F.col("id")).select("id", "ordinal")


@REGISTRY.add("toc_render", """
    WITH inner_list AS (SELECT n_nationkey, n_regionkey, n_name, (SELECT string_agg('  - ' || s_name, chr(10) ORDER BY s_suppkey) FROM supplier WHERE s_nationkey = n_nationkey) AS items FROM nation)
    SELECT r_name, (SELECT string_agg('- ' || n_name || coalesce(chr(10) || items, ''), chr(10) ORDER BY n_nationkey) FROM inner_list WHERE n_regionkey = r_regionkey) AS contents FROM region""")  # fmt: skip
def toc_render(spark, folder):
    nation = load(spark, folder, "nation")
    supplier = load(spark, folder, "supplier", "s_suppkey", "s_name", F.col("s_nationkey").alias("n_nationkey"))
    listed = notes.nested_contents(nation, supplier, "n_nationkey", "n_regionkey", F.col("n_name"), F.col("s_name"), F.col("n_nationkey"), F.col("s_suppkey"))
    return load(spark, folder, "region").join(listed, F.col("r_regionkey") == F.col("n_regionkey"), "left").select("r_name", "contents")


@REGISTRY.add("title_index", f"WITH s AS ({_SECTIONS}) SELECT part, string_agg('- [[' || section || '|§ ' || section || ' — ' || replace(translate(title, '[]', ''), '|', '/') || ']]', chr(10) ORDER BY section, id) AS contents FROM s GROUP BY part")
def title_index(spark, folder):
    display = F.concat(F.lit("§ "), F.col("section"), F.lit(" — "), F.col("title"))
    return notes.contents(_sections(spark, folder), "part", markdown.wikilink(F.col("section"), display), F.col("section"), F.col("id"))


@REGISTRY.add("front_matter", f"""
    WITH s AS ({_SECTIONS}) SELECT id, '---' || chr(10) || 'id: "' || id || '"' || chr(10) || 'title_number: 14' || chr(10) || 'generated: true' || chr(10) || 'title: "' || title || '"' || chr(10) || 'tags:' || chr(10) || '  - "part"' || chr(10) || '  - "' || part || '"' || chr(10) || '---' AS front FROM s""")  # fmt: skip
def front_matter(spark, folder):
    rows = _sections(spark, folder)
    front = markdown.front_matter([("id", F.col("id"), "string"), ("title_number", F.lit(14), "bare"), ("generated", F.lit(True), "bare"), ("title", F.col("title"), "string"), ("nothing", F.lit(None).cast("string"), "string"), ("tags", F.array(F.lit("part"), F.col("part")), "list")])
    return rows.select("id", front.alias("front"))


@REGISTRY.add("callouts", "SELECT doc_id, sha256('> [!' || ['note', 'cite', 'example', 'note'][doc_id % 4 + 1] || '] T' || chr(10) || '> ' || replace(text, chr(10), chr(10) || '> ')) AS hash FROM documents")
def callouts(spark, folder):
    kind = F.element_at(F.array(*map(F.lit, ["odd", "cite", "example", "note"])), (F.col("doc_id") % 4 + 1).cast("int"))
    return load(spark, folder, "documents", "doc_id", "text").select("doc_id", F.sha2(markdown.callout(kind, F.lit("T"), F.col("text")), 256).alias("hash"))


@REGISTRY.add("table_rows", "SELECT c_custkey, CASE WHEN c_custkey % 3 > 0 THEN 'html' ELSE 'pipe' END AS style, '| ' || c_name || ' | ' || c_mktsegment || ' |' AS pipe_row, '<tr><td>' || c_name || '</td><td>' || c_mktsegment || '</td></tr>' AS html_row FROM customer")
def table_rows(spark, folder):
    cells = F.array("c_name", "c_mktsegment")
    return load(spark, folder, "customer", "c_custkey", "c_name", "c_mktsegment").select(
        "c_custkey", markdown.table_style(F.col("c_custkey") % 3, cells).alias("style"), markdown.pipe_row(cells).alias("pipe_row"), markdown.html_row(cells).alias("html_row")
    )


@REGISTRY.add("hard_breaks", "SELECT doc_id, sha256(replace(text, chr(10), chr(92) || chr(10))) AS hash FROM documents")
def hard_breaks(spark, folder):
    return load(spark, folder, "documents", "doc_id", "text").select("doc_id", F.sha2(markdown.hard_breaks(F.col("text")), 256).alias("hash"))


@REGISTRY.add("anchors_figures", "SELECT p_partkey, ' ^' || replace(lower('PA.I.' || p_brand), '.', '-') AS anchor, '![[' || p_partkey || '.png|' || replace(p_name, '|', '/') || ']]' AS figure FROM part")
def anchors_figures(spark, folder):
    code = F.concat(F.lit("PA.I."), F.col("p_brand"))
    file = F.concat(F.col("p_partkey").cast("string"), F.lit(".png"))
    return load(spark, folder, "part", "p_partkey", "p_brand", "p_name").select("p_partkey", markdown.block_anchor(code).alias("anchor"), markdown.figure(file, F.col("p_name")).alias("figure"))


@REGISTRY.add("note_assembly", """
    SELECT c_custkey, string_agg(body, chr(10) || chr(10) ORDER BY rank) AS text FROM (
      SELECT c_custkey, 1 AS rank, '# ' || c_name AS body FROM customer UNION ALL SELECT c_custkey, 3, c_mktsegment FROM customer UNION ALL
      SELECT o_custkey, 7, string_agg('- ' || o_orderkey, chr(10) ORDER BY o_orderkey) FROM orders WHERE o_custkey IN (SELECT c_custkey FROM customer) GROUP BY o_custkey) GROUP BY c_custkey""")  # fmt: skip
def note_assembly(spark, folder):
    customer = load(spark, folder, "customer", "c_custkey", "c_name", "c_mktsegment")
    part = lambda section, body: customer.select("c_custkey", F.lit(section).alias("section"), body.alias("body"))
    orders = load(spark, folder, "orders", F.col("o_custkey").alias("c_custkey"), "o_orderkey").join(customer.select("c_custkey"), "c_custkey", "left_semi")
    listed = notes.contents(orders, "c_custkey", F.col("o_orderkey").cast("string"), F.col("o_orderkey")).select("c_custkey", F.lit("related").alias("section"), F.col("contents").alias("body"))
    return notes.assemble(listed.unionByName(part("source", F.concat(F.lit("# "), F.col("c_name")))).unionByName(part("text", F.col("c_mktsegment"))), "c_custkey", "section", "body")


@REGISTRY.add("related_section", """
    SELECT o_custkey, '## Related' || chr(10) || chr(10) || '> [!info] Suggested by lexical-tfidf, version 1; not reviewed' || chr(10) || chr(10) || string_agg('- [[' || o_orderkey || '|' || o_orderpriority || ']]', chr(10) ORDER BY o_totalprice, o_orderkey) AS text FROM orders GROUP BY 1""")  # fmt: skip
def related_section(spark, folder):
    rows = load(spark, folder, "orders", "o_custkey", "o_orderkey", "o_orderpriority", "o_totalprice").withColumn("place", F.struct("o_totalprice", "o_orderkey"))
    return notes.related_section(rows, "o_custkey", "place", F.col("o_orderkey").cast("string"), F.col("o_orderpriority"), "## Related", "Suggested by {}, version {}; not reviewed".format(*PROVIDER))


_ELEMENTS = "SELECT 'PA.I.' || chr((65 + p_partkey % 20)::INT) || '.K' || p_size || CASE WHEN p_partkey % 2 = 0 THEN 'a' ELSE '' END AS code, p_partkey FROM part"
_MAPPED = "SELECT DISTINCT code, 'task' AS source FROM (SELECT 'PA.I.' || chr(65 + n_nationkey % 12) AS code FROM nation) UNION ALL SELECT DISTINCT 'PA.I.' || chr(65 + n_nationkey % 15) || '.K' || n_nationkey, 'element' FROM nation UNION ALL SELECT DISTINCT 'PA.I.' || chr(65 + n_nationkey % 20) || '.K' || n_nationkey || 'a', 'sub' FROM nation"


@REGISTRY.add("coverage_inherit", rf"""
    WITH e AS ({_ELEMENTS}), m AS ({_MAPPED})
    SELECT e.p_partkey, e.code, coalesce(a.source, b.source, c.source) AS source, CASE WHEN a.code IS NOT NULL THEN 'element' WHEN b.code IS NOT NULL THEN 'parent' WHEN c.code IS NOT NULL THEN 'task' END AS covered_by
    FROM e LEFT JOIN m a ON a.code = e.code LEFT JOIN m b ON b.code = regexp_replace(e.code, '[a-z]$', '') LEFT JOIN m c ON c.code = split_part(e.code, '.', 1) || '.' || split_part(e.code, '.', 2) || '.' || split_part(e.code, '.', 3)""")  # fmt: skip
def coverage_inherit(spark, folder):
    load(spark, folder, "part").createOrReplaceTempView("corpusloom_part")
    load(spark, folder, "nation").createOrReplaceTempView("corpusloom_nation")
    elements = spark.sql(_ELEMENTS.replace("FROM part", "FROM corpusloom_part"))
    mapped = spark.sql(_MAPPED.replace("FROM nation", "FROM corpusloom_nation"))
    return notes.coverage(elements, mapped, "code", "source").select("p_partkey", "code", "source", "covered_by")


@REGISTRY.add("study_callouts", "SELECT c_custkey, coalesce('**Gist:** ' || o_orderpriority, '') AS gist, coalesce(n, 0) AS n FROM customer LEFT JOIN (SELECT o_custkey, arg_min(o_orderpriority, o_orderkey) AS o_orderpriority, count(*) AS n FROM orders GROUP BY 1) ON o_custkey = c_custkey")
def study_callouts(spark, folder):
    study = load(spark, folder, "orders", "o_custkey", "o_orderkey", "o_orderpriority").groupBy("o_custkey").agg(F.min_by("o_orderpriority", "o_orderkey").alias("p"), F.count(F.lit(1)).alias("n"))
    rows = load(spark, folder, "customer", "c_custkey").join(study, F.col("c_custkey") == F.col("o_custkey"), "left")
    return rows.select("c_custkey", F.coalesce(F.concat(F.lit("**Gist:** "), F.col("p")), F.lit("")).alias("gist"), F.coalesce("n", F.lit(0)).alias("n"))


@REGISTRY.add("acs_backrefs", "SELECT l_suppkey, string_agg(DISTINCT '[[' || l_partkey || '#^k' || l_linenumber || '|' || l_partkey || ']]', ', ' ORDER BY '[[' || l_partkey || '#^k' || l_linenumber || '|' || l_partkey || ']]') AS refs FROM lineitem GROUP BY 1")
def acs_backrefs(spark, folder):
    rows = load(spark, folder, "lineitem", "l_suppkey", "l_partkey", "l_linenumber").distinct()
    key = F.col("l_partkey").cast("string")
    link = markdown.wikilink(key, key, F.concat(F.lit("k"), F.col("l_linenumber").cast("string")))
    return rows.groupBy("l_suppkey").agg(F.array_join(F.array_sort(F.collect_list(link)), ", ").alias("refs"))


@REGISTRY.add("paragraph_labels", r"""
    WITH l AS (SELECT doc_id, unnest(regexp_extract_all(text, '(?m)^(\([0-9A-Za-z]{1,4}\))', 1)) AS label FROM documents)
    SELECT doc_id, label, count(*) AS n, CASE WHEN regexp_matches(label, '^\([ivx]+\)$') THEN 'roman' WHEN regexp_matches(label, '^\([a-z]\)$') THEN 'lower' WHEN regexp_matches(label, '^\([0-9]+\)$') THEN 'number' WHEN regexp_matches(label, '^\([A-Z]\)$') THEN 'upper' ELSE 'other' END AS kind,
      list_position(['lower', 'number', 'roman', 'upper'], kind) AS depth FROM l GROUP BY doc_id, label""")  # fmt: skip
def paragraph_labels(spark, folder):
    rows = load(spark, folder, "documents", "doc_id", "text").select("doc_id", F.explode(F.regexp_extract_all("text", F.lit(r"(?:^|\n)(\([0-9A-Za-z]{1,4}\))"), F.lit(1))).alias("label"))
    label = F.col("label")
    kind = F.when(label.rlike(r"^\([ivx]+\)$"), "roman").when(label.rlike(r"^\([a-z]\)$"), "lower").when(label.rlike(r"^\([0-9]+\)$"), "number").when(label.rlike(r"^\([A-Z]\)$"), "upper").otherwise("other")
    return rows.groupBy("doc_id", "label").agg(F.count(F.lit(1)).alias("n")).withColumn("kind", kind).withColumn("depth", F.nullif(F.array_position(F.lit(["lower", "number", "roman", "upper"]), F.col("kind")), F.lit(0).cast("long")))


@REGISTRY.add("amendments", r"SELECT doc_id, regexp_extract(note, 'Docket No\. ([0-9]+)', 1) AS docket, regexp_extract(note, 'Amdt\. ([0-9-]+)', 1) AS amendment FROM (SELECT doc_id, unnest(regexp_extract_all(text, '\[(Docket No\.[^\]]*)\]', 1)) AS note FROM documents)")
def amendments(spark, folder):
    rows = load(spark, folder, "documents", "doc_id", "text").select("doc_id", F.explode(F.regexp_extract_all("text", F.lit(r"\[(Docket No\.[^\]]*)\]"), F.lit(1))).alias("note"))
    return rows.select("doc_id", F.regexp_extract("note", r"Docket No\. ([0-9]+)", 1).alias("docket"), F.regexp_extract("note", r"Amdt\. ([0-9-]+)", 1).alias("amendment"))


@REGISTRY.add("table_shapes", r"SELECT doc_id, count(*) AS table_rows, min(cells) AS cells FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line, length(regexp_replace(line, '[^|]', '', 'g')) - 1 AS cells FROM documents) WHERE starts_with(line, '|') GROUP BY 1")
def table_shapes(spark, folder):
    rows = load(spark, folder, "documents", "doc_id", "text").select("doc_id", F.explode(F.split("text", "\n")).alias("line")).where("startswith(line, '|')")
    return rows.groupBy("doc_id").agg(F.count(F.lit(1)).alias("table_rows"), F.min(F.length(F.regexp_replace("line", "[^|]", "")) - 1).alias("cells"))


@REGISTRY.add("casefold_sort", "SELECT letter, string_agg(term, '; ' ORDER BY lower(term), term) AS terms FROM (SELECT DISTINCT letter, term FROM pcg_term WHERE term IS NOT NULL) GROUP BY letter")
def casefold_sort(spark, folder):
    rows = load(spark, folder, "pcg_term", "letter", "term").where("term is not null").distinct()
    return rows.groupBy("letter").agg(notes.in_order(F.col("term"), F.lower("term"), F.col("term"), separator="; ").alias("terms"))


@REGISTRY.add("acs_task_note", f"""
    WITH e AS (SELECT p_partkey, {'{}'.format("'PA.I.' || chr((65 + p_partkey % 20)::INT)")} AS task, ['K', 'R', 'S'][p_partkey % 3 + 1] AS kind, p_size AS number, p_name FROM part)
    SELECT task, kind, string_agg('- **' || task || '.' || kind || number || '** ' || p_name || ' ^' || replace(lower(task || '.' || kind || number), '.', '-'), chr(10) ORDER BY number, p_partkey) AS body FROM e GROUP BY task, kind""")  # fmt: skip
def acs_task_note(spark, folder):
    task = F.concat(F.lit("PA.I."), F.chr((F.lit(65) + F.col("p_partkey") % 20).cast("int")))
    kind = F.element_at(F.array(*map(F.lit, "KRS")), (F.col("p_partkey") % 3 + 1).cast("int"))
    rows = load(spark, folder, "part", "p_partkey", "p_size", "p_name").withColumns({"task": task, "kind": kind})
    code = F.concat(F.col("task"), F.lit("."), F.col("kind"), F.col("p_size").cast("string"))
    item = F.concat(F.lit("- **"), code, F.lit("** "), F.col("p_name"), markdown.block_anchor(code))
    return rows.groupBy("task", "kind").agg(notes.in_order(item, F.col("p_size"), F.col("p_partkey")).alias("body"))


_CAPTION = "'**' || ['TBL', 'FIG', 'BOX'][p_partkey % 3 + 1] || ' ' || p_size || '-' || p_partkey || '**' || CASE WHEN p_partkey % 5 > 0 THEN ' *' || p_name || '*' ELSE '' END || chr(10) || '**FIG 1-1** *End*'"


@REGISTRY.add("captions", f"""
    SELECT p_partkey, CASE WHEN p_partkey % 3 = 0 THEN 'TBL' ELSE 'FIG' END AS kind, p_size || '-' || p_partkey AS number, CASE WHEN p_partkey % 5 > 0 THEN p_name END AS caption FROM part WHERE p_partkey % 3 < 2
    UNION ALL SELECT p_partkey, 'FIG', '1-1', 'End' FROM part""")  # fmt: skip
def captions(spark, folder):
    rows = load(spark, folder, "part", "p_partkey", "p_size", "p_name")
    kind = F.element_at(F.array(*map(F.lit, ["TBL", "FIG", "BOX"])), (F.col("p_partkey") % 3 + 1).cast("int"))
    named = F.when(F.col("p_partkey") % 5 > 0, F.concat(F.lit(" *"), F.col("p_name"), F.lit("*"))).otherwise("")
    text = F.concat(F.lit("**"), kind, F.lit(" "), F.concat_ws("-", "p_size", "p_partkey"), F.lit("**"), named, F.lit("\n**FIG 1-1** *End*"))
    return rows.select("p_partkey", F.explode(pages.captions(text)).alias("c")).select("p_partkey", "c.kind", "c.number", "c.caption")


@REGISTRY.add("curated_order", "SELECT DISTINCT term_key, i AS place, see_also[i] AS item FROM (SELECT term_key, see_also, unnest(range(1, len(see_also) + 1)) AS i FROM pcg_term)")
def curated_order(spark, folder):
    rows = load(spark, folder, "pcg_term", "term_key", "see_also").select("term_key", F.posexplode("see_also").alias("place", "item"))
    return rows.select("term_key", (F.col("place") + 1).alias("place"), "item").distinct()


_KINDS = "['" + "', '".join(markdown.SOURCE_NOTES) + "']"


@REGISTRY.add("source_notes", f"""
    SELECT o_custkey, string_agg('**' || {_KINDS}[place] || ':** ' || items, chr(10) || chr(10) ORDER BY place) AS notes FROM (
      SELECT o_custkey, o_orderkey % 9 + 1 AS place, string_agg(o_orderkey, '; ' ORDER BY o_orderkey) AS items FROM orders GROUP BY ALL) GROUP BY o_custkey""")  # fmt: skip
def source_notes(spark, folder):
    kind = F.element_at(F.array(*map(F.lit, markdown.SOURCE_NOTES)), (F.col("o_orderkey") % 9 + 1).cast("int"))
    rows = load(spark, folder, "orders", "o_custkey", "o_orderkey").withColumn("kind", kind)
    each = rows.groupBy("o_custkey", "kind").agg(notes.in_order(F.col("o_orderkey").cast("string"), F.col("o_orderkey"), separator="; ").alias("items"))
    text, place = F.concat(F.lit("**"), F.col("kind"), F.lit(":** "), F.col("items")), F.array_position(F.lit(markdown.SOURCE_NOTES), F.col("kind"))
    return each.groupBy("o_custkey").agg(notes.in_order(text, place, separator="\n\n").alias("notes"))


@REGISTRY.add("study_fields", """
    SELECT c_custkey, '> [!study] Study' || chr(10) || array_to_string(list_filter(['> **Gist:** ' || c_name, '> **Why:** ' || CASE WHEN c_custkey % 2 = 0 THEN c_mktsegment END, '> **Numbers:** ' || c_nationkey,
      '> **Mnemonic:** ' || CASE WHEN c_custkey % 3 = 0 THEN 'M' END, '> **Stage:** ' || (c_custkey % 5)], lambda x: x IS NOT NULL), chr(10)) AS callout FROM customer""")  # fmt: skip
def study_fields(spark, folder):
    """A study callout of every field that a record has."""
    key = F.col("c_custkey")
    fields = {
        "Stage": (key % 5).cast("string"), "Gist": F.col("c_name"), "Why": F.when(key % 2 == 0, F.col("c_mktsegment")), "Numbers": F.col("c_nationkey").cast("string"),
        "Watch out": F.lit(None).cast("string"), "Mnemonic": F.when(key % 3 == 0, "M"),
    }
    return load(spark, folder, "customer", "c_custkey", "c_name", "c_mktsegment", "c_nationkey").select("c_custkey", markdown.study_callout(fields).alias("callout"))


@REGISTRY.add("register_citations", """
    SELECT p_partkey, 10 + p_size AS volume, (p_partkey * 7)::INT AS page FROM part UNION ALL SELECT p_partkey, 60, 1 FROM part WHERE p_partkey % 2 = 0""")  # fmt: skip
def register_citations(spark, folder):
    """Citations of the Federal Register in amendment notes."""
    rows = load(spark, folder, "part", "p_partkey", "p_size")
    more = F.when(F.col("p_partkey") % 2 == 0, F.lit(", as amended at 60 FR 1")).otherwise("")
    note = F.concat(F.lit("[Amdt. 91-235, "), (F.col("p_size") + 10).cast("string"), F.lit(" FR "), (F.col("p_partkey") * 7).cast("string"), more, F.lit("]"))
    return rows.select("p_partkey", F.inline(pages.register_citations(note)))


@REGISTRY.add("oral_prep", """
    SELECT l_orderkey, '## ' || o_orderpriority || chr(10) || string_agg('- ' || l_partkey || ': ' || p_name, chr(10) ORDER BY l_linenumber, l_partkey) AS note
    FROM lineitem JOIN orders ON o_orderkey = l_orderkey JOIN part ON p_partkey = l_partkey GROUP BY l_orderkey, o_orderpriority""")  # fmt: skip
def oral_prep(spark, folder):
    items = load(spark, folder, "lineitem", "l_orderkey", "l_linenumber", "l_partkey").join(load(spark, folder, "part", "p_partkey", "p_name"), F.col("p_partkey") == F.col("l_partkey"))
    listed = notes.contents(items, "l_orderkey", F.concat_ws(": ", "l_partkey", "p_name"), F.col("l_linenumber"), F.col("l_partkey"))
    rows = listed.join(load(spark, folder, "orders", "o_orderkey", "o_orderpriority"), F.col("o_orderkey") == F.col("l_orderkey"))
    return rows.select("l_orderkey", F.concat(F.lit("## "), F.col("o_orderpriority"), F.lit("\n"), F.col("contents")).alias("note"))
