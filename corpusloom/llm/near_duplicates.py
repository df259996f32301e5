"""Groups of records that share most of their content, found without comparing all pairs.

Signature trees, one below each root.  A root is what two similar records must have in common: for sets one of the rarest
tokens of a record, as many as a partner cannot all miss; for short strings one of the segments that two edits cannot all touch.
Below a root the records hang in nodes by size; a node holds the OR of its members' token bitmaps, the range of their
sizes, their least number of bits and the most that any of them can still share from this root on.  Every pair of nodes of a
root (a node with itself included) is met once and followed down to its records only if the greatest overlap that any two
members can have is enough.  A pair of records must pass the same test and meet at as many roots as two similar ones
must have in common; what remains is compared exactly.  Equal records are one class beforehand.

The trees are built for every root at every size, and nothing is capped: every bound is a proof that a pair cannot qualify.

Each record is written once with its roots, and ``walk`` builds and walks the trees of blocks of records within tasks.  The same
trees as tables (``ranked_records``, ``forest_of``, ``nodes_of``, ``met_nodes``, ``followed``) serve to count and to compare.
"""

from __future__ import annotations

from dataclasses import dataclass
from typing import TYPE_CHECKING

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.llm import walk
from corpusloom.scratch import cut, drop_tables, fixed, free_shuffles, new_path

if TYPE_CHECKING:
    from collections.abc import Callable

WORDS = 4  # 64-bit words of a bitmap
NODE = 16  # records that a node holds on average at most
MEET = 6  # roots at which two similar sets meet at least, or at all they share if these are fewer
BITS = [f"b{i}" for i in range(WORDS)]
BUCKETS = 1 << 22  # counters by which tokens are ranked; tokens that share one only rank as more frequent
ROWS = 1024  # sets ranked at once


def bit_columns(token: Column) -> list[Column]:
    """Aggregates that OR the bit of each token into the words of a bitmap."""
    bit = F.pmod(token, F.lit(64 * WORDS))
    one = F.expr("1L")
    word = F.floor(bit / 64)
    at = F.call_function("shiftleft", one, F.pmod(bit, F.lit(64)).cast("int"))
    return [F.coalesce(F.bit_or(F.when(word == i, at)), F.lit(0).cast("long")).alias(b) for i, b in enumerate(BITS)]


def ones(*sides: str) -> Column:
    """Number of bits in a bitmap, or in the AND of two."""
    total = None
    for b in BITS:
        word = F.col(f"{sides[0]}.{b}") if len(sides) == 1 else F.col(f"{sides[0]}.{b}").bitwiseAND(F.col(f"{sides[1]}.{b}"))
        total = F.bit_count(word) if total is None else total + F.bit_count(word)
    return total


@dataclass(frozen=True)
class SetOverlap:
    """Shared tokens / all tokens of both is at least ``least``."""

    least: float

    def needed(self, together: Column) -> Column:
        """Tokens that two sets of so many tokens together must share."""
        return F.ceil(F.lit(self.least / (1 + self.least)) * together - 1e-9)

    def at_least(self, size: Column) -> Column:
        """Tokens that a set of at least this size shares with any similar one that is no larger."""
        return F.ceil(F.lit(self.least) * size - 1e-9)

    def possible(self, left: str, right: str) -> Column:
        """For nodes or records: the greatest possible overlap is enough.

        From its first root on a similar pair shares all it needs, from its last counted one on all but what it met before.
        A bit that one side has and the other lacks stands for at least one token that is not shared.
        """
        col = lambda side, name: F.col(f"{side}.{name}")
        t, slack, both = F.lit(self.least), F.lit(1e-9), ones(left, right)
        missed = lambda side: F.greatest(col(side, "bits") - both, F.lit(0))
        fits = lambda a, b: col(a, "most") - (1 + t) * missed(a) + slack >= t * col(b, "least")
        reach = F.least(col(left, "reach"), col(right, "reach")) + (MEET - 1)
        far = (1 + t) * reach + slack >= t * (col(left, "least") + col(right, "least"))
        ratio = (col(left, "most") + slack >= t * col(right, "least")) & (col(right, "most") + slack >= t * col(left, "least"))
        return far & ratio & fits(left, right) & fits(right, left)

    def band(self, size: Column) -> Column:
        """Sizes of one band differ by at most a quarter."""
        return F.floor(F.log(size.cast("double")) / F.log(F.lit(1.25)))

    def may(self, l, r, i, j):
        """``possible`` for the pairs (i, j) of two levels of a walk: those of them that pass."""
        import numpy as np

        t, slack = self.least, 1e-9
        reach = np.minimum(l.reach[i], r.reach[j]) + (MEET - 1)
        fit = (1 + t) * reach + slack >= t * (l.least[i] + r.least[j])
        fit &= (l.most[i] + slack >= t * r.least[j]) & (r.most[j] + slack >= t * l.least[i])
        i, j = i[fit], j[fit]
        both = np.bitwise_count(l.marks[i] & r.marks[j]).sum(axis=1, dtype=np.int64)
        fit = l.most[i] - (1 + t) * np.maximum(l.bits[i] - both, 0) + slack >= t * r.least[j]
        fit &= r.most[j] - (1 + t) * np.maximum(r.bits[j] - both, 0) + slack >= t * l.least[i]
        return i[fit], j[fit]

    def bands(self, size):
        """``band`` of many sizes."""
        import numpy as np

        return np.floor(np.log(size) / np.log(1.25)).astype(np.int64)

    def meetings(self, together):
        """Roots at which two similar sets of so many tokens together meet at least."""
        import numpy as np

        return np.minimum(MEET, np.ceil(self.least / (1 + self.least) * together - 1e-9))

    def roots(self, size, shared):
        """How many of the ``shared`` ranked tokens of a set are roots; negative if too few are shared for any partner.

        The first ``MEET`` tokens that two similar sets share cannot lie so far back in either that fewer than the needed ones would
        follow, so a record needs no roots behind that place.
        """
        import numpy as np

        need = np.ceil(self.least * size - 1e-9).astype(np.int64)
        return np.where(shared < need, -1, np.minimum(shared, shared - need + MEET))


@dataclass(frozen=True)
class Edits:
    """At most ``most`` insertions, deletions or replacements of one character; tokens are pairs of characters.

    One edit touches two pairs, so it can cost a side at most two bits.
    """

    most: int

    def possible(self, left: str, right: str) -> Column:
        """For nodes or records: no two members differ by too much in length or in bits."""
        col = lambda side, name: F.col(f"{side}.{name}")
        both = ones(left, right)
        return (
            (col(left, "least") <= col(right, "most") + self.most)
            & (col(right, "least") <= col(left, "most") + self.most)
            & (col(left, "bits") - both <= 2 * self.most)
            & (col(right, "bits") - both <= 2 * self.most)
        )

    def band(self, size: Column) -> Column:
        """Four lengths."""
        return F.floor(size / 4)

    def may(self, l, r, i, j):
        """``possible`` for the pairs (i, j) of two levels of a walk: those of them that pass."""
        import numpy as np

        fit = (l.least[i] <= r.most[j] + self.most) & (r.least[j] <= l.most[i] + self.most)
        i, j = i[fit], j[fit]
        both = np.bitwise_count(l.marks[i] & r.marks[j]).sum(axis=1, dtype=np.int64)
        fit = (l.bits[i] - both <= 2 * self.most) & (r.bits[j] - both <= 2 * self.most)
        return i[fit], j[fit]

    def bands(self, size):
        """``band`` of many sizes."""
        return size // 4

    def meetings(self, together):
        """One root is enough."""
        return 1


MEMBER = ["item", "least", "most", "reach", "bits", *BITS]


def nodes_of(forest: DataFrame, test: SetOverlap | Edits) -> DataFrame:
    """The nodes below every root of rows (root, most_members, item, size, reach, bits, b0...), with their records.

    A root's records are split by band of size, and within it into as many slots as its greatest number of members
    (``most_members``, known beforehand) asks for, so that a node has about ``NODE`` records at most.
    """
    slots = F.ceil(F.col("most_members") / NODE)
    rows = forest.select(
        "root", test.band(F.col("size")).cast("int").alias("band"), F.pmod(F.xxhash64("item"), slots).cast("int").alias("slot"),
        "item", F.col("size").alias("least"), F.col("size").alias("most"), "reach", "bits", *BITS,
    )
    range_ = [F.min("least").alias("least"), F.max("most").alias("most"), F.max("reach").alias("reach"), F.min("bits").alias("bits")]
    # what is grouped is moved as it is: partial lists of so few rows would only cost
    placed = rows.repartition("root", "band", "slot").groupBy("root", "band", "slot")
    return placed.agg(*range_, *[F.bit_or(b).alias(b) for b in BITS], F.collect_list(F.struct(*MEMBER)).alias("members"))


def met_nodes(left: DataFrame, right: DataFrame | None) -> DataFrame:
    """Pairs of nodes l and r of one root, each once; ``right`` is None for a forest met with itself, a node of one record is not."""
    own = right is None
    same = F.col("l.root") == F.col("r.root")
    if own:
        same = same & ((F.struct("l.band", "l.slot") < F.struct("r.band", "r.slot")) | (F.col("l.band") == F.col("r.band")) & (F.col("l.slot") == F.col("r.slot")) & (F.size("l.members") > 1))
    return left.alias("l").join((left if own else right).hint("merge").alias("r"), same)


def followed(met: DataFrame, test: SetOverlap | Edits) -> DataFrame:
    """Of pairs of nodes those that may hold a qualifying pair of records."""
    return met.where(test.possible("l", "r"))


def forest_of(records: DataFrame, test: SetOverlap) -> DataFrame:
    """Roots of records (item, size, bits, b0..., ranked), ``ranked`` their shared tokens (df, token) from the rarest on.

    The first ``MEET`` tokens that two similar sets share cannot lie so far back in either that fewer than the needed ones would
    follow, so a record needs no roots behind that place.  ``reach`` counts the shared tokens from a root on.
    """
    need, s = test.at_least(F.col("size")), F.size("ranked")
    first = F.least(s, (s - need + MEET).cast("int"))
    plain = ["item", "size", "bits", *BITS]
    rows = records.select(*plain, s.alias("s"), F.posexplode(F.slice("ranked", F.lit(1), first)).alias("at", "x"))
    return rows.select(F.col("x.token").alias("root"), F.col("x.df").alias("most_members"), (F.col("s") - F.col("at")).alias("reach"), *plain)


def ranked_records(sets: DataFrame, test: SetOverlap) -> DataFrame:
    """(item, size, bits, b0..., ranked) of the sets (item, size, tokens exploded to rows) that share enough tokens to have a partner."""
    rows = sets.where(F.size("tokens") > 0).select("item", F.size("tokens").alias("size"), F.explode("tokens").alias("token"))
    shared = rows.groupBy("token").agg(F.count(F.lit(1)).alias("df")).where("df > 1")
    ranked = rows.join(shared, "token").repartition("item").groupBy("item", "size").agg(F.array_sort(F.collect_list(F.struct("df", "token"))).alias("ranked"), *bit_columns(F.col("token")))
    bits = None
    for b in BITS:
        bits = F.bit_count(b) if bits is None else bits + F.bit_count(b)
    # tokens outside ``ranked`` are shared with nobody: each counts as a bit that no other has
    records = ranked.where(F.size("ranked") >= test.at_least(F.col("size")))
    return records.select("item", "size", (bits + F.col("size") - F.size("ranked")).alias("bits"), *BITS, "ranked")


def counted_tokens(tokens: DataFrame) -> str:
    """Place of the counters (bucket, n) of a table of tokens: in how many sets those of a bucket occur."""
    path = new_path(tokens.sparkSession, "counters")
    counts = tokens.groupBy(F.col("token").bitwiseAND(BUCKETS - 1).cast("int").alias("bucket")).agg(F.count(F.lit(1)).alias("n"))
    counts.select("bucket", F.least("n", F.lit(2**31 - 1)).cast("int").alias("n")).write.option("compression", "zstd").parquet(path)
    return path


def ranked_roots(sets: DataFrame, counters: str, test: SetOverlap) -> DataFrame:
    """(item, size, shared, bits, b0..., roots) of the sets (item, tokens) that may have a partner.

    Tokens are ranked from the rarest on by the count of their bucket, then by themselves: one order for all sets, whatever else is
    in a bucket.  A token alone in its bucket is shared with nobody: it is left out and counts as a bit that no other has.
    Roots are 32 bits of the token; two of one value only add meetings.
    """

    def ranked(batches):
        import numpy as np
        import pyarrow as pa
        from pyarrow import dataset

        store, place = walk.opened(counters)
        counts = np.zeros(BUCKETS, np.int32)
        for part in dataset.dataset(place, filesystem=store, format="parquet").to_batches():
            counts[np.asarray(part.column("bucket"))] = np.asarray(part.column("n"))

        for batch in (b.slice(at, ROWS) for b in batches for at in range(0, b.num_rows, ROWS)):
            sizes = np.asarray(batch.column("tokens").value_lengths()).astype(np.int64)
            token, n = np.asarray(batch.column("tokens").flatten()), len(sizes)
            record, count = np.repeat(np.arange(n), sizes), counts[token & (BUCKETS - 1)]
            known = count > 1
            token, record, count = token[known], record[known], count[known]
            order = np.lexsort((token, count, record))
            token, record = token[order], record[order]
            shared = np.bincount(record, minlength=n)
            places = np.zeros((n, 64 * WORDS), bool)
            places[record, token & (64 * WORDS - 1)] = True
            marks = np.packbits(places, axis=1, bitorder="little").view(np.int64)
            bits = places.sum(axis=1) + sizes - shared
            most = test.roots(sizes, shared)
            at = np.arange(len(token)) - np.repeat(np.cumsum(shared) - shared, shared)
            roots = (token >> 32 ^ token).astype(np.int32)[at < most[record]]
            lists = pa.ListArray.from_arrays(pa.array(np.r_[0, np.cumsum(np.maximum(most, 0))].astype(np.int32)), pa.array(roots))
            columns = [batch.column("item"), *[pa.array(x.astype(np.int32)) for x in (sizes, shared, bits)], *[pa.array(marks[:, k].copy()) for k in range(WORDS)], lists]
            yield pa.RecordBatch.from_arrays(columns, names=["item", "size", "shared", "bits", *BITS, "roots"]).filter(pa.array(most > 0))

    kinds = "item long, size int, shared int, bits int, " + ", ".join(f"{b} long" for b in BITS) + ", roots array<int>"
    return sets.where(F.size("tokens") > 0).mapInArrow(ranked, kinds)


def walked(left: str, right: str | None, test: SetOverlap | Edits, like: DataFrame) -> DataFrame:
    """(a, b), a < b, written once, of planted records that may satisfy ``test``; what was planted is dropped."""
    met = cut(walk.met_often(like.sparkSession, left, right, BITS, test, NODE), "candidates")
    drop_tables(*filter(None, (left, right)))
    return met


def similar_sets(sets: DataFrame, least: float, tokens: Callable[[Column], Column] = lambda held: held) -> DataFrame:
    """Pairs (a, b, overlap) with a < b of sets whose shared tokens / all tokens of both are at least ``least``.

    ``sets`` has (item BIGINT, tokens ARRAY<BIGINT>): a set per row, tokens distinct hashes.  Its second column may hold anything
    shorter from which ``tokens`` makes them; this is then what joins move.  Empty and null sets have no partner, and a set whose
    tokens occur nowhere else takes no further part.
    """
    test, held = SetOverlap(least), sets.columns[1]
    rows = sets.select("item", tokens(F.col(held)).alias("tokens"))
    counters = counted_tokens(rows.select(F.explode("tokens").alias("token")))
    free_shuffles(sets.sparkSession)
    candidates = walked(walk.planted(ranked_roots(rows, counters, test), "records"), None, test, sets)
    drop_tables(counters)
    a = sets.select(F.col("item").alias("a"), F.col(held).alias("held_a"))
    b = sets.select(F.col("item").alias("b"), F.col(held).alias("held_b"))
    both = candidates.join(a, "a").join(b, "b").select("a", "b", tokens(F.col("held_a")).alias("tokens_a"), tokens(F.col("held_b")).alias("tokens_b"))
    both = both.withColumn("overlap", F.size(F.array_intersect("tokens_a", "tokens_b")))
    enough = F.col("overlap") >= F.lit(least) * (F.size("tokens_a") + F.size("tokens_b") - F.col("overlap")) - 1e-9
    return both.where(enough).select("a", "b", "overlap")


def similar_strings(strings: DataFrame, edits: int = 2) -> DataFrame:
    """Pairs (a, b) with a < b of different strings that at most ``edits`` changes of one character turn into each other.

    ``strings`` has (item BIGINT, text STRING), texts distinct and longer than ``edits`` characters; shorter ones, empty and
    null ones have no partner.  A text is cut into ``edits`` + 1 segments: one of them is whole in any partner, at most
    ``edits`` places off.
    """
    k = edits + 1
    texts = strings.where(F.length("text") > edits)
    grams = F.transform(F.sequence(F.lit(1), F.length("text") - 1), lambda i: F.xxhash64(F.substring("text", i, F.lit(2))))
    marked = (
        texts.select("item", F.length("text").alias("size"), F.explode(F.when(F.length("text") > 1, grams).otherwise(F.array(F.xxhash64("text")))).alias("token"))
        .groupBy("item", "size")
        .agg(*bit_columns(F.col("token")))
    )
    bits = None
    for b in BITS:
        bits = F.bit_count(b) if bits is None else bits + F.bit_count(b)
    marked = marked.withColumn("bits", bits).drop("size")
    n = F.length("text")

    def seg(length: Column, i: Column) -> tuple[Column, Column]:
        """Start (from 1) and length of segment i (from 0) of a text of this length; the last ones take the rest."""
        base, rest = F.floor(length / k), length % k
        longer = F.greatest(i - (k - rest), F.lit(0))
        return (i * base + longer + 1).cast("int"), (base + F.when(i >= k - rest, 1).otherwise(0)).cast("int")

    parts = F.sequence(F.lit(0), F.lit(edits))

    def root(*of: Column) -> Column:
        return F.shiftright(F.xxhash64(*of), 32).cast("int")

    def kept(i: Column) -> Column:
        start, size = seg(n, i)
        return root(n, i, F.substring("text", start, size))

    shifts = F.sequence(F.lit(-edits), F.lit(edits))

    def probed(less: Column) -> Column:
        length = n - less

        def at(i: Column) -> Column:
            start, size = seg(length, i)
            inside = F.filter(shifts, lambda s: (start + s >= 1) & (start + s + size - 1 <= n))
            return F.transform(inside, lambda s: root(length, i, F.substring("text", (start + s).cast("int"), size)))

        return F.flatten(F.transform(parts, at))

    def planted(roots: Column, name: str) -> str:
        """Place of the texts with these roots."""
        rows = texts.select("item", n.alias("size"), F.lit(0).alias("shared"), F.array_distinct(roots).alias("roots")).join(marked, "item")
        return walk.planted(rows.select(*walk.RECORD, *BITS), name)

    marked = cut(marked, "marked").hint("merge")
    test = Edits(edits)
    probe = planted(F.flatten(F.transform(F.sequence(F.lit(0), F.lit(edits)), probed)), "probe")
    candidates = walked(probe, planted(F.transform(parts, kept), "index"), test, strings).distinct()
    free_shuffles(strings.sparkSession)
    a = texts.select(F.col("item").alias("a"), F.col("text").alias("text_a"))
    b = texts.select(F.col("item").alias("b"), F.col("text").alias("text_b"))
    both = candidates.join(a, "a").join(b, "b")
    return both.where(F.levenshtein("text_a", "text_b", edits).between(0, edits)).select("a", "b")


def groups_of(links: DataFrame) -> DataFrame:
    """Connected groups: (item, group) for every item of a link (a, b); a group is named by its least item.

    Labels are halved towards the least one by joining each item's label with its label's label; every round is written to
    the shared folder, and the loop ends when no label changes.
    """
    edges = cut(links.select(F.col("a").alias("x"), F.col("b").alias("y")).unionByName(links.select(F.col("b").alias("x"), F.col("a").alias("y"))).distinct(), "links")
    labels = edges.groupBy("x").agg(F.min(F.least("x", "y")).alias("label"))
    labels = fixed(labels)
    while True:
        near = edges.join(labels.select(F.col("x").alias("y"), "label"), "y").groupBy("x").agg(F.min("label").alias("near"))
        lower = labels.join(near, "x").select("x", F.least("label", "near").alias("next"), "label")
        jump = labels.select(F.col("x").alias("next"), F.col("label").alias("far"))
        after = fixed(lower.join(jump, "next", "left").select("x", F.least("next", "far").alias("next"), "label"))
        if after.where("next <> label").limit(1).count() == 0:
            return after.select(F.col("x").alias("item"), F.col("label").alias("group"))
        labels = after.select("x", F.col("next").alias("label"))
