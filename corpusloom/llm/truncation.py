"""Texts that were cut off, and how often each source cuts.

Two kinds of evidence meet as log odds.  Lengths: for each source and each candidate limit (in characters and in bytes) a
right-censored log-normal distribution of lengths is fitted by maximum likelihood; the texts found at a limit beyond what the
fit expects there were censored, which gives a posterior for every text of that length.  Endings: what the last line looks
like, held against the lines before the last one of all texts, which are whole: which first words begin sentences or open
ended lines, which words end the latter, after which words a number goes on behind its point.  A text that ends whole is whole at
any length.  All other endings are log odds counted in the same texts; the length adds its own, so an unclear ending is decided
by the length.
"""

from __future__ import annotations

import math

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpusloom.scratch import cut, fixed

# What is put at a break; closing quotes and brackets; abbreviations that end no sentence.
MARK = r"(?:\s*(?:\[(?:\.{3}|…)\]|\((?:\.{3}|…)\)|\.{3}|…|\x{FFFD}+))+\s*$"
CLOSED = r"[.!?][\"'”’»)\]]*$"
ABBREVIATION = r"(?i)(?:^|[\s(])(?:e\.g|i\.e|e|i|no|nos|amdt|fig|sec|para|vol|mr|mrs|dr|st|art|cf|p|pp)\.$"
BETWEEN = r"\s+(?<=[.!?][\"'”’»)\]]{0,2}\s{1,8})"
BLANKS = " \t\n\r\f\v\u00a0"
LIST = r"^\s*[-*•]\s+"
LABEL = r"^\s*(?:\(?[0-9A-Za-z]{1,4}[.)]\s+|#+\s+)+"
SURE = 12.0  # log odds of a whole ending, and of a text that is nothing but the mark of a break
WINDOW = 4  # lengths up to this many below a limit count as at the limit: a cut may drop blanks or a part of a character


def _words(line: Column) -> Column:
    return F.filter(F.split(line, r"\s+"), lambda w: w != "")


def _kind(line: Column) -> Column:
    return F.when(line.rlike(LIST), "list").when(line.rlike(r"^\s*#"), "head").otherwise("text")


def _content(line: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(line, LIST, ""), LABEL, "")


def _size(sentence: Column) -> Column:
    """Length in characters, in steps of a half of the next power of two."""
    return F.floor(2 * F.log2(1.0 + F.length(sentence))).cast("string")


def line_facts(texts: DataFrame) -> DataFrame:
    """(fact, key, yes, no): what all lines before the last of all rows (text) say about lines.

    ``start2``: sentences with this kind of line and first two words that end open / closed; ``size``: the same by length;
    ``end2``: this pair of words at the end of / inside an open line; ``number``: numbers after this word that go on behind a point /
    that end there.
    """
    lines = F.split("text", "\n")
    whole = F.slice(lines, F.lit(1), F.size(lines) - 1)
    rows = texts.where(F.col("text").isNotNull()).select(F.explode(F.filter(whole, lambda x: F.length(F.trim(x)) > 0)).alias("line"))
    rows = rows.where(~F.col("line").rlike(r"^\s*\|")).withColumns({
        "closed": F.rtrim("line").rlike(CLOSED), "kind": _kind(F.col("line")), "sentences": F.split(F.rtrim(_content(F.col("line"))), BETWEEN),
    })
    fact = lambda kind, key, yes: F.struct(F.lit(kind).alias("fact"), key.alias("key"), yes.cast("int").alias("yes"))
    none = F.array().cast("array<struct<fact:string,key:string,yes:int>>")
    opened = lambda i: ~F.col("closed") & (i == F.size("sentences") - 1)
    starts = F.transform("sentences", lambda x, i: fact("start2", F.concat_ws(" ", "kind", F.substring_index(F.ltrim(x), " ", 2)), opened(i)))
    sizes = F.transform("sentences", lambda x, i: fact("size", F.concat_ws(" ", "kind", _size(x)), opened(i)))
    rows = rows.withColumn("words", F.when(~F.col("closed"), _words(F.element_at("sentences", -1))))
    pair = lambda w, i: F.lower(F.concat_ws(" ", F.get("words", i - 1), w))
    ends = F.coalesce(F.transform("words", lambda w, i: fact("end2", pair(w, i), i == F.size("words") - 1)), none)
    numbers = F.regexp_extract_all("line", F.lit(r"(?<!\S)\S++ \d[\d,]*+\.(?:\d|\s|$)"), F.lit(0))
    numbers = F.transform(numbers, lambda m: fact("number", F.lower(F.split_part(m, F.lit(" "), F.lit(1))), m.rlike(r"\d$")))
    return (
        rows.select(F.explode(F.concat(starts, sizes, ends, numbers)).alias("f"))
        .groupBy("f.fact", "f.key")
        .agg(F.sum("f.yes").alias("yes"), F.sum(1 - F.col("f.yes")).alias("no"))
    )


def endings(documents: DataFrame) -> DataFrame:
    """(doc_id, named, source, chars, bytes and features of the last line) of rows (doc_id, source, text); null is as empty."""
    text = F.coalesce("text", F.lit(""))
    body = F.rtrim(text, F.lit(BLANKS))
    rows = documents.select(
        "doc_id", F.col("source").alias("named"), F.coalesce("source", F.lit("")).alias("source"),
        F.length(text).alias("chars"), F.octet_length(text).alias("bytes"), body.alias("body"),
    )
    last = F.substring_index("body", "\n", -1)
    rows = rows.withColumn("raw", last).withColumn("marked", F.col("raw").rlike(MARK))
    rows = rows.withColumn("before", F.split_part(F.substring_index("body", "\n", -2), F.lit("\n"), F.lit(1)))
    rows = rows.drop("body").withColumn("line", F.when(F.col("marked"), F.regexp_replace("raw", MARK, "")).otherwise(F.col("raw")))
    line = F.col("line")
    opened = lambda o, c: F.length(F.regexp_replace(line, f"[^{o}]", "")) > F.length(F.regexp_replace(line, f"[^{c}]", ""))
    pipes = lambda x: F.length(F.regexp_replace(x, r"[^|]", ""))
    sentence = F.element_at(F.split(_content(line), BETWEEN), -1)
    words = _words(sentence)
    labelled = line.rlike(r"^\p{L}[\p{L} ]{1,24}: \S") & (F.length("line") < 200)
    return rows.select(
        "doc_id", "named", "source", "chars", "bytes", "marked",
        (F.length("line") == 0).alias("empty"),
        line.rlike(CLOSED).alias("closed"),
        (opened(r"(", r")") | opened(r"\[", r"\]")).alias("unbalanced"),
        line.rlike(ABBREVIATION).alias("abbreviated"),
        F.when(line.rlike(r"^\s*\|"), line.rlike(r"\|\s*$") & (~F.col("before").rlike(r"^\s*\|") | (pipes(F.col("before")) == pipes(line)))).alias("row_whole"),
        (line.rlike(r"^\s*(?:\[[^\[\]]*\]|\([^()]{5,}\))$") | line.rlike(r"\[[^\[\]]*\]$")).alias("bracketed"),
        *[F.concat_ws(" ", _kind(line), F.substring_index(F.ltrim(sentence), " ", n)).alias(f"start{n}") for n in (1, 2)],
        F.concat_ws(" ", _kind(line), _size(sentence)).alias("size"),
        F.lower(F.get(words, F.size(words) - 1)).alias("end1"),
        F.lower(F.concat_ws(" ", F.get(words, F.size(words) - 2), F.get(words, F.size(words) - 1))).alias("end2"),
        F.when(labelled, F.split_part("line", F.lit(":"), F.lit(1))).alias("label"),
        F.when(labelled, F.regexp_replace("line", r"\d+", "9")).alias("shape"),
        F.nullif(F.lower(F.regexp_extract("line", r"(\S+) \d[\d,]*\.$", 1)), F.lit("")).alias("number"),
    )


def _censored_fit(n: float, s1: float, s2: float, censored: float, limit: float) -> tuple[float, float]:
    """Mean and deviation of log lengths, by expectation maximisation, of n seen values (sums s1, s2) and censored ones above limit."""
    if n < 2:
        return limit, 1.0
    mean, sd = s1 / n, max(math.sqrt(max(s2 / n - (s1 / n) ** 2, 0)), 0.05)
    for _ in range(200):
        z = (limit - mean) / sd
        above = max(0.5 * math.erfc(z / math.sqrt(2)), 1e-300)
        hazard = math.exp(-z * z / 2) / math.sqrt(2 * math.pi) / above if z < 35 else z
        e1, e2 = mean + sd * hazard, mean * mean + sd * sd + sd * hazard * (limit + mean)
        new = (s1 + censored * e1) / (n + censored)
        var = (s2 + censored * e2) / (n + censored) - new * new
        new_sd = max(math.sqrt(max(var, 0)), 0.05)
        done = abs(new - mean) + abs(new_sd - sd) < 1e-9
        mean, sd = new, new_sd
        if done:
            break
    return mean, sd


def _posteriors(batches):
    for pdf in batches:
        out = []
        for r in pdf.itertuples(index=False):
            limit = math.log(r.length)
            mean, sd = _censored_fit(r.n - r.at, r.s1, r.s2, r.at, limit)
            cdf = lambda x: 0.5 * math.erfc((mean - x) / sd / math.sqrt(2))  # noqa: B023, E731
            low = math.log(max(r.length - WINDOW, 0.5))
            out.append((r.source, r.unit, r.length, mean, sd, min(max(1 - r.n * (cdf(limit) - cdf(low)) / r.at, 0.0), 0.9995)))
        yield pd.DataFrame(out, columns=["source", "unit", "length", "mean", "sd", "censored"])


def length_limits(lengths: DataFrame, least: int = 5, deviations: float = 6.0) -> DataFrame:
    """(source, unit, length, mean, sd, censored): candidate limits of rows (source, chars, bytes) and the posterior of texts there.

    A length is a candidate if at least ``least`` texts lie at most ``WINDOW`` below it, ``deviations`` standard deviations of a
    Poisson count above what the lengths before lead one to expect and above those just beyond it, at least a quarter of the
    excess at the length itself.  That holds alike for sources of any size.  Lengths are counted before they meet, so the
    window sees one row per source and length.
    """
    unit = F.explode(F.array(*[F.struct(F.lit(u).alias("unit"), F.col(u).alias("length")) for u in ("chars", "bytes")]))
    counts = lengths.select("source", unit.alias("u")).where("u.length > 0").groupBy("source", "u.unit", "u.length").agg(F.count(F.lit(1)).alias("n"))
    by = Window.partitionBy("source", "unit").orderBy("length")
    near = lambda a, b: F.coalesce(F.sum("n").over(by.rangeBetween(a, b)), F.lit(0))
    log = F.log(F.col("length"))
    at = by.rangeBetween(1 - WINDOW, 0)
    rows = counts.withColumns({
        "at": near(1 - WINDOW, 0), "under": near(-10 * WINDOW, -WINDOW), "over": near(1, WINDOW),
        "at1": F.sum(F.col("n") * log).over(at), "at2": F.sum(F.col("n") * log * log).over(at),
    })
    all_ = counts.groupBy("source", "unit").agg(F.sum("n").alias("all"), F.sum(F.col("n") * log).alias("all1"), F.sum(F.col("n") * log * log).alias("all2"))
    rows = rows.join(all_, ["source", "unit"])
    usual = F.col("under") * WINDOW / (9 * WINDOW + 1)
    above = lambda count: F.col("at") >= count + deviations * F.sqrt(count + 1)
    excess = F.col("n") - usual / WINDOW >= (F.col("at") - usual) / 4
    rows = rows.where((F.col("at") >= least) & above(usual) & above(F.col("over")) & excess)
    rows = rows.select("source", "unit", "length", F.col("all").alias("n"), F.col("at"), (F.col("all1") - F.col("at1")).alias("s1"), (F.col("all2") - F.col("at2")).alias("s2"))
    return rows.mapInPandas(_posteriors, "source string, unit string, length long, mean double, sd double, censored double")


def _known(ends: DataFrame, facts: DataFrame) -> DataFrame:
    """``ends`` with the counts ``x_yes`` and ``x_no`` of what whole lines say about them, null where no line says anything.

    The keys of all facts of a row meet the facts in one join, absent keys in none; sizes are at most some hundred by their making, so they are broadcast.
    """
    folded = {"start1": ("start2", F.substring_index("key", " ", 2)), "end1": ("end2", F.substring_index("key", " ", -1))}
    ones = [facts.where(F.col("fact") == two).groupBy(F.lit(one).alias("fact"), key.alias("key")).agg(F.sum("yes").alias("yes"), F.sum("no").alias("no")) for one, (two, key) in folded.items()]
    words = facts.where("fact <> 'size'").unionByName(ones[0]).unionByName(ones[1])
    names = ["start1", "start2", "end1", "end2", "number"]
    keys = F.array(*[F.when(F.col(x).isNotNull(), F.struct(F.lit(x).alias("fact"), F.col(x).alias("key"))) for x in names])
    met = ends.select("row", F.explode(F.array_compact(keys)).alias("k")).select("row", "k.fact", "k.key").join(words, ["fact", "key"])
    count = lambda x, side: F.max(F.when(F.col("fact") == x, F.col(side))).alias(f"{x}_{side}")
    told = met.groupBy("row").agg(*[count(x, side) for x in names for side in ("yes", "no")])
    sizes = facts.where("fact = 'size'").select(F.col("key").alias("size"), F.col("yes").alias("size_yes"), F.col("no").alias("size_no"))
    return ends.join(told, "row", "left").join(F.broadcast(sizes), "size", "left")


def truncation_scores(documents: DataFrame) -> DataFrame:
    """(doc_id, source, at_limit, censored, ending, score, by_length) of rows (doc_id, source, text); above 0 a text counts as cut.

    ``at_limit`` and ``censored`` give the limit that the length lies at, if any, and the posterior there (elsewhere the share of
    open endings among texts at no limit); ``ending`` the log odds of the ending; ``by_length`` whether the text would be judged
    otherwise at another length.  A text that ends with a whole sentence, title, list entry, table row, reference or bracketed
    line scores below 0 at any length, and so does a null or empty text.  A null source is a source of its own.
    """
    facts = fixed(line_facts(documents))
    ends = cut(endings(documents).withColumn("row", F.monotonically_increasing_id()), "endings")
    # limits: a row for each length at a limit
    limits = length_limits(ends)
    spread = limits.select("source", "unit", F.col("length").alias("limit"), "censored", F.explode(F.sequence(F.col("length") - WINDOW + 1, F.col("length"))).alias("length"))
    best = fixed(spread.groupBy("source", "unit", "length").agg(F.max(F.struct("censored", "limit")).alias("best")))
    # counts of the whole: how rare a word at an end, an open bracket, a mark or a row without its end are in what is whole
    end1 = facts.where("fact = 'end2'").groupBy(F.substring_index("key", " ", -1).alias("word")).agg(F.sum("yes").alias("yes"), F.sum("no").alias("no"))
    n = end1.agg(F.coalesce(F.sum("yes"), F.lit(0)).alias("ends"), F.count_if((F.col("yes") == 1) & (F.col("no") == 0)).alias("once")).first()
    closed = F.col("closed")
    c = ends.agg(
        F.count_if(closed & ~F.col("unbalanced")).alias("balanced"), F.count_if(closed & F.col("unbalanced")).alias("unbalanced"),
        F.count_if(closed & ~F.col("abbreviated")).alias("plain"), F.count_if(closed & F.col("abbreviated")).alias("abbreviated"),
        F.count_if(closed & ~F.col("marked")).alias("unmarked"), F.count_if(closed & F.col("marked")).alias("marked"),
        F.count_if("row_whole").alias("rows"), F.count_if(~F.col("row_whole")).alias("broken"),
    ).first()
    ratio = lambda yes, no: F.lit(math.log((yes + 0.5) / (no + 0.5)))
    # what whole lines say about this one
    rows = _known(ends, facts)
    for unit in ("chars", "bytes"):
        own = best.where(F.col("unit") == unit).select("source", F.col("length").cast("int").alias(unit), F.col("best").alias(f"of_{unit}"))
        rows = rows.join(own, ["source", unit], "left")
    shapes = ends.where("label is not null").groupBy("label", "shape").agg(F.count(F.lit(1)).alias("same"))
    labels = shapes.groupBy("label").agg(F.sum("same").alias("labelled"), F.max("same").alias("usual"))
    rows = rows.join(shapes.join(labels, "label"), ["label", "shape"], "left")
    zero = lambda c: F.coalesce(F.col(c), F.lit(0))
    odds = lambda yes, no: F.log((yes + 0.5) / (no + 0.5))

    def told(fact: str, least: int, otherwise: Column) -> Column:
        """Log odds that a line with this fact is closed (an open one: goes on), if it was seen often enough."""
        yes, no = zero(f"{fact}_yes"), zero(f"{fact}_no")
        return F.when(yes + no >= least, odds(no, yes)).otherwise(otherwise)

    # a word that whole lines never have: as rare at their ends as words seen there once
    ender = told("end2", 3, told("end1", 1, ratio(n.ends, n.once)))
    starter = told("start2", 3, told("start1", 3, told("size", 0, F.lit(0.0))))
    # the facts about open lines speak for a sentence being cut, not against it
    words = starter + F.when(starter > 0, F.greatest(ender, F.lit(0.0))).otherwise(ender) + F.when(F.col("marked"), ratio(c.unmarked, c.marked)).otherwise(0.0)
    ending = (
        F.when(F.col("empty"), F.when(F.col("marked"), SURE).otherwise(-SURE))
        .when(F.col("row_whole").isNotNull(), F.when(F.col("row_whole"), -SURE).otherwise(ratio(c.rows, c.broken)))
        .when(F.col("bracketed"), -SURE)
        .when(F.col("closed") & F.col("unbalanced"), ratio(c.balanced, c.unbalanced))
        .when(F.col("closed") & F.col("abbreviated"), ratio(c.plain, c.abbreviated))
        .when(F.col("closed") & (zero("number_yes") > zero("number_no")), odds(zero("number_yes"), zero("number_no")))
        .when(F.col("closed"), -SURE)
        .when(F.col("unbalanced"), F.greatest(words, F.lit(0.0)) + ratio(c.balanced, c.unbalanced))
        .when((F.col("labelled") >= 5) & (F.col("same") * 5 >= F.col("usual")), -SURE)
        .when(F.col("labelled") >= 5, odds(F.col("labelled"), F.col("same") - 1))
        .otherwise(words)
    )
    where = F.greatest("of_chars", "of_bytes")
    rows = cut(rows.select("doc_id", F.col("named").alias("source"), where["limit"].alias("at_limit"), where["censored"].alias("posterior"), ending.alias("ending")), "judged")
    off = rows.where("at_limit is null").agg(F.count_if(F.col("ending") > 0).alias("open"), F.count(F.lit(1)).alias("all")).first()
    base = (off.open + 1) / (off.all + 2)
    prior = F.greatest(F.coalesce("posterior", F.lit(base)), F.lit(base))
    score = F.log(prior / (1 - prior)) + F.col("ending")
    elsewhere = math.log(base / (1 - base)) + F.col("ending")
    return rows.select("doc_id", "source", "at_limit", prior.alias("censored"), "ending", score.alias("score"), ((score > 0) != (elsewhere > 0)).alias("by_length"))
