"""All cosines of token counts that can be among the best: blocks of nodes against all nodes, in the tasks that ask.

A node is a text with the keys of all records that have it.  Nodes and the tokens of more than one record lie in the shared
folder; the place of a token by falling number of records is its number.  A node's vector is a run of numbers in bytes of 7
bits: how many of its tokens are shared, the steps between their numbers in order, then the counts of all its tokens, those
of other tokens last.
"""

from __future__ import annotations

NO_KEY = 2**63 - 1


def _open(path: str):
    from pyarrow import dataset, fs

    store, place = fs.FileSystem.from_uri("file:///" + path[5:].lstrip("/") if path.startswith("file:") else path)
    return dataset.dataset(place, filesystem=store, format="parquet")


def _tokens(path: str):
    return _open(path).to_table(columns=["token", "df"]).sort_by([("df", "descending"), ("token", "ascending")])


def packed(numbers):
    """Numbers of at least 0 in bytes of 7 bits, the lowest first; all but the last byte of a number have the top bit.  Also how many bytes each takes."""
    import numpy as np

    numbers = np.asarray(numbers, np.int64)
    used = 1 + sum((numbers >= 1 << 7 * i).astype(np.int64) for i in range(1, 5))
    ends = np.cumsum(used)
    row = np.repeat(np.arange(len(numbers)), used)
    within = np.arange(len(row)) - (ends - used)[row]
    return ((numbers[row] >> 7 * within & 127) | np.where(within < used[row] - 1, 128, 0)).astype(np.uint8), used


def unpacked(data):
    """The numbers of packed bytes, and the place behind the last byte of each."""
    import numpy as np

    ends = np.flatnonzero(data < 128) + 1
    if len(ends) == len(data):
        return data.astype(np.int64), ends
    starts = np.concatenate([[0], ends[:-1]])
    within = np.arange(len(data)) - np.repeat(starts, ends - starts)
    return np.add.reduceat((data & 127).astype(np.int64) << 7 * within, starts), ends


def counted(dictionary: str):
    """For mapInArrow: batches of (key, asks, grp, text, tokens) with their tokens as ``vector`` and the number of different ones."""

    def count(batches):
        import numpy as np
        import pyarrow as pa
        import pyarrow.compute as pc

        known = _tokens(dictionary).column("token").combine_chunks()
        for batch in batches:
            if not batch.num_rows:
                continue
            tokens = batch.column("tokens")
            sizes = np.asarray(pc.fill_null(pc.list_value_length(tokens), 0))
            flat = tokens.flatten().dictionary_encode()
            number = np.asarray(pc.fill_null(pc.index_in(flat.dictionary, known).cast("int64"), -1))
            number = np.where(number < 0, len(known) + np.arange(len(number)), number)
            width = len(known) + len(number) + 1
            cells, tf = np.unique(np.repeat(np.arange(batch.num_rows), sizes) * width + number[np.asarray(flat.indices)], return_counts=True)
            row, number = np.divmod(cells, width)
            ends = np.searchsorted(row, np.arange(batch.num_rows + 1))
            shared = np.bincount(row[number < len(known)], minlength=batch.num_rows)
            step = np.diff(number, prepend=0)
            step[ends[:-1][shared > 0]] = number[ends[:-1][shared > 0]]
            parts = [np.concatenate([[s], step[a : a + s], tf[a:b]]) for a, b, s in zip(ends[:-1], ends[1:], shared, strict=True)]
            data, used = packed(np.concatenate(parts))
            until = np.cumsum(used)[np.cumsum([len(p) for p in parts]) - 1]
            made = [pa.array([data[a:b].tobytes() for a, b in zip([0, *until[:-1]], until, strict=True)], pa.binary()), pa.array(np.diff(ends), pa.int32())]
            yield pa.RecordBatch.from_arrays([batch.column(c) for c in ("key", "asks", "grp", "text")] + made, names=["key", "asks", "grp", "text", "vector", "tokens"])

    return count


class _Lot:
    """Nodes in the order of their groups: their weights by row and token, those of common tokens as a matrix too."""

    def __init__(self, table, places, groups: dict, idf, alone: float, dense: int) -> None:
        import numpy as np

        encoded = table.column("grp").combine_chunks().dictionary_encode("encode")
        code = np.array([groups.setdefault(g, len(groups)) for g in encoded.dictionary.to_pylist()], np.int64)[np.asarray(encoded.indices)]
        order = np.argsort(code, kind="stable")
        self.table, self.code, self.places, self.n = table.take(order), code[order], places[order], table.num_rows
        vector = self.table.column("vector").combine_chunks()
        bounds = np.frombuffer(vector.buffers()[1], np.int32)[vector.offset : vector.offset + self.n + 1].astype(np.int64)
        data, until = unpacked(np.frombuffer(vector.buffers()[2], np.uint8)[bounds[0] : bounds[-1]])
        at = np.searchsorted(until, bounds - bounds[0], side="right")
        shared = data[at[:-1]]
        total = np.diff(at) - 1 - shared
        self.starts, ends = np.concatenate([[0], np.cumsum(shared)]), np.concatenate([[0], np.cumsum(total)])
        self.row, of = np.repeat(np.arange(self.n), shared), np.repeat(np.arange(self.n), total)
        steps = np.cumsum(np.concatenate([[0], data[np.arange(len(self.row)) - self.starts[self.row] + at[self.row] + 1]]))
        self.number = steps[1:] - steps[self.starts[self.row]]
        within = np.arange(len(of)) - ends[of]
        raw = 1 + np.log(data[within + (at[:-1] + 1 + shared)[of]])
        known = within < shared[of]
        raw[known] *= idf[self.number]
        raw[~known] *= alone
        norm = np.sqrt(np.add.reduceat(raw * raw, ends[:-1]))
        self.weight = raw[known] / norm[self.row]
        self.common = self.number < dense
        self.matrix = np.zeros((self.n, dense), np.float32)
        self.matrix[self.row[self.common], self.number[self.common]] = self.weight[self.common]

    def keys(self, most: int):
        """The least keys of each node."""
        import numpy as np

        column = self.table.column("keys").combine_chunks()
        sizes = np.asarray(column.value_lengths()).astype(np.int64)
        row = np.repeat(np.arange(self.n), sizes)
        within = np.arange(len(row)) - (np.cumsum(sizes) - sizes)[row]
        out = np.full((self.n, most), NO_KEY)
        out[row[within < most], within[within < most]] = np.asarray(column.flatten())[within < most]
        return out


def _spread(counts, starts):
    """All places of runs of ``counts`` from ``starts``, one run behind the other."""
    import numpy as np

    return np.arange(counts.sum()) + np.repeat(starts - np.cumsum(counts) + counts, counts)


class _Block:
    """Query nodes with their best so far, for the other groups (0) and their own (1)."""

    def __init__(self, lot: _Lot, tokens: int, dense: int, k: int, floor: float, error: float) -> None:
        import numpy as np

        self.lot, self.tokens, self.dense, self.k, self.floor, self.error = lot, tokens, dense, k, floor, error
        self.exact = np.zeros((lot.n, dense))
        self.exact[lot.row[lot.common], lot.number[lot.common]] = lot.weight[lot.common]
        self.rare_row, self.rare, self.rare_weight = lot.row[~lot.common], lot.number[~lot.common], lot.weight[~lot.common]
        self.cells = self.rare_row * tokens + self.rare
        self.scores = np.full((2, lot.n, k), -np.inf)
        self.keys = np.full((2, lot.n, k, k + 1), NO_KEY)
        self.least = np.full((2, lot.n), floor - error)
        code, at = np.unique(lot.code, return_index=True)
        self.groups = list(zip(code, at, [*at[1:], lot.n], strict=True))

    def meet(self, other: _Lot) -> None:
        import numpy as np

        met = self.lot.matrix @ other.matrix.T
        by = np.flatnonzero(~other.common)
        by = by[np.argsort(other.number[by], kind="stable")]
        lo, hi = (np.searchsorted(other.number[by], self.rare, side=side) for side in ("left", "right"))
        for a in range(0, len(lo), 1 << 14):
            some = (hi - lo)[a : a + (1 << 14)]
            at, mine = by[_spread(some, lo[a : a + (1 << 14)])], a + np.repeat(np.arange(len(some)), some)
            np.add.at(met.reshape(-1), self.rare_row[mine] * other.n + other.row[at], (self.rare_weight[mine] * other.weight[at]).astype(np.float32))
        _, i, j = np.intersect1d(self.lot.places, other.places, return_indices=True)
        met[i, j] = -np.inf
        keys = other.keys(self.k + 1)
        for code, r0, r1 in self.groups:
            c0, c1 = np.searchsorted(other.code, [code, code + 1])
            for own, x0, x1 in ((1, c0, c1), (0, 0, c0), (0, c1, other.n)):
                if x0 < x1:
                    self.take(own, r0, x0, met[r0:r1, x0:x1], other, keys)

    def take(self, own: int, r0: int, x0: int, part, other: _Lot, keys) -> None:
        """Add what may be among the best: all within the error of single precision of a score that is enough."""
        import numpy as np

        k, rows, columns = self.k, *part.shape
        bound = self.least[own, r0 : r0 + rows].astype(np.float32)[:, None]
        mask = part >= bound
        if columns > k and np.count_nonzero(mask) > 2 * k * rows:
            mask = part >= np.maximum(bound, np.partition(part, columns - k, axis=1)[:, columns - k, None] - np.float32(2 * self.error))
        i, j = np.divmod(np.flatnonzero(mask), columns)
        i, j = i + r0, j + x0
        score = np.concatenate([[], *(self.cosines(i[a : a + 4096], j[a : a + 4096], other) for a in range(0, len(i), 4096))])
        enough = score >= self.floor
        i, j, score = i[enough], j[enough], score[enough]
        hit = np.unique(i)
        i = np.concatenate([i, np.repeat(hit, k)])
        score = np.concatenate([score, self.scores[own, hit].reshape(-1)])
        found = np.concatenate([keys[j], self.keys[own, hit].reshape(-1, k + 1)])
        order = np.lexsort((found[:, 0], -score, i))
        i, score, found = i[order], score[order], found[order]
        rank = np.arange(len(i)) - np.searchsorted(i, i)
        top = rank < k
        self.scores[own, i[top], rank[top]], self.keys[own, i[top], rank[top]] = score[top], found[top]
        self.least[own, hit] = np.maximum(self.floor, self.scores[own, hit, k - 1]) - self.error

    def cosines(self, i, j, other: _Lot):
        """In double precision, to 6 digits."""
        import numpy as np

        some = other.starts[j + 1] - other.starts[j]
        at, pair = _spread(some, other.starts[j]), np.repeat(np.arange(len(i)), some)
        number, row = other.number[at], i[pair]
        weight, common = np.zeros(len(at)), number < self.dense
        weight[common] = self.exact[row[common], number[common]]
        if len(self.cells):
            cell = row[~common] * self.tokens + number[~common]
            place = np.minimum(np.searchsorted(self.cells, cell), len(self.cells) - 1)
            weight[~common] = np.where(self.cells[place] == cell, self.rare_weight[place], 0)
        return np.round(np.bincount(pair, weight * other.weight[at], len(i)), 6)

    def best(self):
        """(src, dst, same_group, rank, score) of each key that asks; a node's other keys have its own text."""
        import numpy as np

        keys = self.lot.table.column("keys").to_pylist()
        for i, asks in enumerate(self.lot.table.column("asks").to_pylist()):
            for own in (1, 0):
                score, dst = np.repeat(self.scores[own, i], self.k + 1), self.keys[own, i].reshape(-1)
                if own:
                    mine = keys[i][: self.k + 1]
                    score, dst = np.concatenate([np.ones(len(mine)), score]), np.concatenate([mine, dst])
                score, dst = score[dst != NO_KEY], dst[dst != NO_KEY]
                order = np.lexsort((dst, -score))[: self.k + 1]
                found = list(zip(dst[order].tolist(), score[order].tolist(), strict=True))
                for src in asks:
                    for rank, (d, s) in enumerate([x for x in found if x[0] != src][: self.k], 1):
                        yield src, d, bool(own), rank, s


def nearest(dictionary: str, path: str, records: int, longest: int, k: int, floor: float, block: int, rows_at_once: int):
    """For mapInArrow: batches of (id), each a block of ``block`` nodes in the order of the files, to the best of its keys."""

    def search(batches):
        import numpy as np
        import pyarrow as pa
        import pyarrow.compute as pc

        df = np.asarray(_tokens(dictionary).column("df"))
        idf, alone = np.log((records + 1) / (df + 1)) + 1, np.log((records + 1) / 2) + 1
        dense = min(int(np.count_nonzero(df >= records / 30)), 4096)  # the rest meet by token
        error = (dense + longest + 8) * 2.0**-23 + 1.1e-6
        files = [(f, f.count_rows()) for f in sorted(_open(path).get_fragments(), key=lambda f: f.path)]
        groups: dict = {}

        def lots():
            at, held = 0, None
            for fragment, _ in files:
                held = pa.concat_tables([held, fragment.to_table()]) if held is not None else fragment.to_table()
                while held.num_rows >= rows_at_once:
                    yield at, held.slice(0, rows_at_once)
                    at, held = at + rows_at_once, held.slice(rows_at_once)
            if held is not None and held.num_rows:
                yield at, held

        def asked(start):
            at, parts = 0, []
            for fragment, n in files:
                if at < start + block and at + n > start:
                    own = fragment.to_table()
                    parts.append(own.slice(max(0, start - at), start + block - max(start, at)))
                at += n
            return pa.concat_tables(parts) if parts else None

        def lot(table, places):
            return _Lot(table, places, groups, idf, alone, dense)

        kinds = (pa.int64(), pa.int64(), pa.bool_(), pa.int32(), pa.float64())
        for id_ in (i for batch in batches for i in batch.column("id").to_pylist()):
            table = asked(id_ * block)
            asking = np.flatnonzero(np.asarray(pc.list_value_length(table.column("asks")))) if table is not None else ()
            if not len(asking):
                continue
            own = _Block(lot(table.take(asking), id_ * block + asking), len(df), dense, k, floor, error)
            for at, other in lots():
                own.meet(lot(other, at + np.arange(other.num_rows)))
            rows = list(own.best())
            for a in range(0, len(rows), 1 << 16):
                columns = zip(*rows[a : a + (1 << 16)], strict=True)
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], names=["src", "dst", "same_group", "rank", "score"])

    return search
