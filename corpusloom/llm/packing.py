"""Filling containers of fixed capacity with texts, neighbours on a space-filling curve together."""

from __future__ import annotations

from bisect import bisect_left, insort
from collections import defaultdict
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.llm.tokens import token_sizes
from corpusloom.scratch import cut

BLOCK = 2048  # items that are placed together; they are neighbours on the curve
PACKED = "spec_name string, capacity_tokens int, container string, doc_id bigint, part_no int, first_token bigint, n_tokens bigint"


class Packer:
    """Best fit by falling size, block by block along the curve, for one capacity.

    A container stays open as long as it has room.  Memory is that of the block and a number per open container of this range
    of the curve; open containers are kept by their room, so finding one takes as long as there are different rooms.
    """

    def __init__(self, spec: str, capacity: int, prefix: str):
        self.spec, self.capacity, self.prefix = spec, capacity, prefix
        self.block: list[tuple[int, int, int, int]] = []  # size, document, part, first token
        self.rooms: list[int] = []  # rooms that open containers have, in order
        self.free: dict[int, list[int]] = defaultdict(list)  # their numbers
        self.made = 0
        self.out: list[tuple] = []

    def _put(self, number: int, item: tuple[int, int, int, int]) -> None:
        size, doc, part, first = item
        self.out.append((self.spec, self.capacity, f"{self.prefix}-{number}", doc, part, first, size))

    def add(self, doc: int, size: int) -> None:
        """Take a text; one above the capacity fills containers of its own, and its rest is an item like others."""
        part = first = 0
        while size - first > self.capacity:
            self._put(self.made, (self.capacity, doc, part, first))
            self.made += 1
            part, first = part + 1, first + self.capacity
        self.block.append((size - first, doc, part, first))
        if len(self.block) >= BLOCK:
            self.place()

    def place(self) -> None:
        """Place the items of the block."""
        for item in sorted(self.block, key=lambda x: (-x[0], x[1])):
            at = bisect_left(self.rooms, item[0])
            if at < len(self.rooms):
                room = self.rooms[at]
                number = self.free[room].pop()
                if not self.free[room]:
                    del self.free[room], self.rooms[at]
            else:
                room, number = self.capacity, self.made
                self.made += 1
            self._put(number, item)
            if left := room - item[0]:
                if left not in self.free:
                    insort(self.rooms, left)
                self.free[left].append(number)
        self.block = []

    def rows(self) -> pd.DataFrame:
        """What was placed since the last call."""
        rows, self.out = self.out, []
        return pd.DataFrame(rows, columns=["spec_name", "capacity_tokens", "container", "doc_id", "part_no", "first_token", "n_tokens"])


def _pack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    from pyspark import TaskContext

    task = TaskContext.get().partitionId()
    packer: Packer | None = None
    for pdf in batches:
        for spec, capacity, doc, size in zip(pdf.spec_name, pdf.capacity_tokens, pdf.doc_id, pdf.n_tokens, strict=True):
            if packer is None or (packer.spec, packer.capacity) != (spec, capacity):
                if packer is not None:
                    packer.place()
                    yield packer.rows()
                packer = Packer(spec, int(capacity), f"{spec}-{capacity}-{task}")
            packer.add(int(doc), int(size))
        if packer is not None:
            yield packer.rows()
    if packer is not None:
        packer.place()
        yield packer.rows()


def pack(documents: DataFrame, specs: DataFrame, vocabulary: str | None = None) -> DataFrame:
    """Containers (columns of ``PACKED``) of rows (doc_id, text) for each row (spec_name, capacity_tokens) of ``specs``.

    Every document comes out once per spec, in parts only if it has more tokens than the capacity; a null or empty text takes
    no room but is placed.  Texts are measured once and written; only sizes and curve places are sorted.  Each range of the
    curve is packed by itself, so a spec has one run of unfilled containers per range.  Rows with a null doc_id are left out.
    A spec with a null or no capacity packs nothing; a name with several capacities is packed for each of them.
    """
    sizes = token_sizes(documents.select("doc_id", "text").where("doc_id is not null"), vocabulary, curve=True)
    sizes = cut(sizes, "sizes")
    wanted = specs.where("capacity_tokens > 0 and spec_name is not null").select("spec_name", "capacity_tokens").distinct()
    # the list of specs is a parameter table; a row of documents is repeated for each of them within its task
    listed = [F.struct(F.lit(r.spec_name).alias("spec_name"), F.lit(r.capacity_tokens).alias("capacity_tokens")) for r in wanted.collect()]
    if not listed:
        return documents.sparkSession.createDataFrame([], PACKED)
    rows = sizes.select(F.explode(F.array(*listed)).alias("s"), "doc_id", "n_tokens", "curve")
    rows = rows.select("s.spec_name", "s.capacity_tokens", "doc_id", "n_tokens", "curve")
    order = ["spec_name", "capacity_tokens", "curve", "doc_id"]
    return rows.repartitionByRange(*order).sortWithinPartitions(*order).mapInPandas(_pack, PACKED)


def fill_rates(packed: DataFrame) -> DataFrame:
    """(spec_name, capacity_tokens, containers, tokens, fill): how full the containers of each spec are."""
    each = packed.groupBy("spec_name", "capacity_tokens", "container").agg(F.sum("n_tokens").alias("tokens"))
    full = F.sum("tokens") / (F.count(F.lit(1)) * F.col("capacity_tokens"))
    return each.groupBy("spec_name", "capacity_tokens").agg(F.count(F.lit(1)).alias("containers"), F.sum("tokens").alias("tokens"), full.alias("fill"))
