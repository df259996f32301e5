"""Signature trees walked block by block, so that neither roots nor pairs are ever moved.

The records of a forest lie once in the shared folder, each with its size, its bitmap and its roots.  A task takes one block of
records and some others, builds the nodes below the roots of both, meets every pair of nodes of a root, follows those that
may hold a qualifying pair, and counts at how many roots two records meet.  All meetings of two records fall into one task, so
only pairs that met often enough leave it.  A block is bounded by its roots and pairs are formed in lots, so what a task holds does not depend
on the size of the input.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import pairwise
from typing import TYPE_CHECKING

from pyspark.sql import DataFrame, SparkSession

from corpusloom.scratch import new_path

if TYPE_CHECKING:
    import numpy as np

POSTINGS = 1 << 20  # roots of a block at most, if it has more than one record
FILE_ROWS = 1 << 14  # records of a file
LOT = 1 << 18  # pairs formed at once
HELD = 1 << 22  # meetings held before they are counted
RECORD = ["item", "size", "shared", "bits", "roots"]


def opened(path: str):
    """File system and place of a path in the shared folder."""
    from pyarrow import fs

    return fs.FileSystem.from_uri("file:///" + path[5:].lstrip("/") if path.startswith("file:") else path)


@dataclass
class Level:
    """Nodes or, where least and most are one, single records at a root."""

    least: np.ndarray
    most: np.ndarray
    reach: np.ndarray
    bits: np.ndarray
    marks: np.ndarray


@dataclass
class Forest:
    """Nodes below the roots of a block: ``members[start:start + count]`` of each, in the order of ``root``."""

    item: np.ndarray
    size: np.ndarray
    root: np.ndarray
    start: np.ndarray
    count: np.ndarray
    nodes: Level
    record: np.ndarray
    members: Level


def forest(item, size, shared, bits, marks, lengths, roots, test, node: int) -> Forest:
    """The forest of records with ``lengths[k]`` roots each; a root's records are split by band of size and into nodes of ``node``."""
    import numpy as np

    record = np.repeat(np.arange(len(item)), lengths)
    reach = shared[record] - (np.arange(len(roots)) - np.repeat(np.cumsum(lengths) - lengths, lengths))
    key = (roots.astype(np.int64) << 12) | np.minimum(test.bands(size), 4095)[record]
    order = np.argsort(key, kind="stable")
    key, record, reach = key[order], record[order], reach[order]
    at = np.arange(len(key))
    new = np.r_[True, key[1:] != key[:-1]][: len(key)]
    first = np.maximum.accumulate(np.where(new, at, 0)) if len(key) else at
    start = np.flatnonzero((at - first) % node == 0)
    members = Level(size[record], size[record], reach, bits[record], marks[record])
    fold = lambda how, x: how.reduceat(x, start) if len(start) else x
    nodes = Level(fold(np.minimum, members.least), fold(np.maximum, members.most), fold(np.maximum, reach), fold(np.minimum, members.bits), fold(np.bitwise_or, members.marks))
    return Forest(item, size, key[start] >> 12, start, np.diff(np.r_[start, len(key)]), nodes, record, members)


def lots(count) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(i, k): for every i the numbers 0 to ``count[i]`` - 1, some ``LOT`` at once."""
    import numpy as np

    upto = np.cumsum(count)
    ends = np.searchsorted(upto, np.arange(LOT, (upto[-1] if len(upto) else 0) + LOT, LOT), "left") + 1
    for lo, hi in pairwise([0, *np.unique(np.minimum(ends, len(count)))]):
        i = np.repeat(np.arange(lo, hi), count[lo:hi])
        yield i, np.arange(len(i)) - np.repeat(upto[lo:hi] - count[lo:hi] - (upto[lo] - count[lo]), count[lo:hi])


def walk(left: Forest, right: Forest, test, tally: dict | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Records (of the left, of the right block) that meet often enough; a forest is walked with itself if both are one object.

    ``tally`` gets the numbers of pairs of nodes met and followed, and of pairs of records below those followed.
    """
    import numpy as np

    own, wide = left is right, max(1, len(right.item))
    start = np.arange(len(left.root)) if own else np.searchsorted(right.root, left.root, "left")
    seen, times, held, n = np.empty(0, np.int64), np.empty(0, np.int64), [], 0

    def counted():
        codes, where = np.unique(np.concatenate([seen, *held]), return_inverse=True)
        return codes, np.bincount(where, np.concatenate([times, np.ones(len(where) - len(times), np.int64)]), len(codes)).astype(np.int64)

    for p, k in lots(np.searchsorted(right.root, left.root, "right") - start):
        q = start[p] + k
        if own:
            pair = (p != q) | (left.count[p] > 1)
            p, q = p[pair], q[pair]
        met = len(p)
        p, q = test.may(left.nodes, right.nodes, p, q)
        if tally is not None:
            for name, value in (("met", met), ("followed", len(p)), ("below", int((left.count[p] * right.count[q]).sum()))):
                tally[name] = tally.get(name, 0) + value
        for i, k in lots(left.count[p] * right.count[q]):
            x, y = left.start[p[i]] + k // right.count[q[i]], right.start[q[i]] + k % right.count[q[i]]
            if own:
                pair = x < y
                x, y = x[pair], y[pair]
            x, y = test.may(left.members, right.members, x, y)
            a, b = left.record[x], right.record[y]
            if own:
                a, b = np.minimum(a, b), np.maximum(a, b)
            differ = left.item[a] != right.item[b]
            held.append(a[differ] * wide + b[differ])
            n += len(held[-1])
            if n > HELD:
                (seen, times), held, n = counted(), [], 0
    codes, times = counted()
    a, b = codes // wide, codes % wide
    enough = times >= test.meetings(left.size[a] + right.size[b])
    return a[enough], b[enough]


def planted(records: DataFrame, name: str) -> str:
    """Write records (item, size, shared, bits, b0..., roots) to the shared folder; returns the place."""
    path = new_path(records.sparkSession, name)
    records.write.option("maxRecordsPerFile", FILE_ROWS).option("compression", "zstd").parquet(path)
    return path


def blocks(path: str) -> list[list[tuple[str, int, int]]]:
    """Ranges of rows (file, from, to) that hold at most ``POSTINGS`` roots together, or a single record."""
    import numpy as np
    import pyarrow.compute as pc
    from pyarrow import dataset

    store, place = opened(path)
    found, room = [], 0
    for part in dataset.dataset(place, filesystem=store, format="parquet").get_fragments():
        roots = np.asarray(pc.list_value_length(part.to_table(columns=["roots"]).column("roots").combine_chunks()))
        at = 0
        while at < len(roots):
            upto = at + int(np.searchsorted(np.cumsum(roots[at:]), room, "right"))
            if upto == at:
                found.append([])
                room = POSTINGS
                upto = max(at + 1, at + int(np.searchsorted(np.cumsum(roots[at:]), room, "right")))
            found[-1].append((part.path, at, upto))
            room -= int(roots[at:upto].sum())
            at = upto
    return found


def load(store, ranges: list[tuple[str, int, int]], words: list[str], test, node: int) -> Forest:
    """The forest of one block."""
    import numpy as np
    import pyarrow as pa
    import pyarrow.compute as pc
    from pyarrow import parquet

    table = pa.concat_tables([parquet.read_table(file, filesystem=store, columns=[*RECORD, *words]).slice(lo, hi - lo) for file, lo, hi in ranges])
    column = lambda c: np.asarray(table.column(c)).astype(np.int64)
    roots = table.column("roots")
    marks = np.stack([column(b).view(np.uint64) for b in words], axis=1)
    lengths = np.asarray(pc.list_value_length(roots)).astype(np.int64)
    return forest(column("item"), column("size"), column("shared"), column("bits"), marks, lengths, np.asarray(pc.list_flatten(roots)), test, node)


def met_often(spark: SparkSession, left: str, right: str | None, words: list[str], test, node: int) -> DataFrame:
    """(a, b), a < b: items of the planted records ``left`` and ``right`` (None: of ``left`` alone) that meet often enough.

    With two sides a pair may come out twice.
    """
    mine, others = blocks(left), blocks(right or left)
    at_once = max(1, len(others) // 16)
    tasks = [(i, j, min(j + at_once, len(others))) for i in range(len(mine)) for j in range(0 if right else i, len(others), at_once)]
    own = right is None
    jobs = spark.range(0, len(tasks), 1, max(1, len(tasks)))

    def walked(batches):
        import numpy as np
        import pyarrow as pa

        store, _ = opened(left)
        for batch in batches:
            for task in batch.column("id").to_pylist():
                i, lo, hi = tasks[task]
                one = load(store, mine[i], words, test, node)
                for j in range(lo, hi):
                    other = one if own and i == j else load(store, others[j], words, test, node)
                    a, b = walk(one, other, test)
                    a, b = one.item[a], other.item[b]
                    yield pa.RecordBatch.from_arrays([pa.array(np.minimum(a, b)), pa.array(np.maximum(a, b))], names=["a", "b"])

    return jobs.mapInArrow(walked, "a long, b long")
