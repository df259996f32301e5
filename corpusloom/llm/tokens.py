"""Sizes of texts in tokens of a public byte-level BPE, and their place on a space-filling curve."""

from __future__ import annotations

import base64
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

# Fixed value: how the public tokenizer splits text before merging.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
DIMENSIONS, LEVELS = 3, 10  # of the curve: dimensions and bits of each
BUCKETS = 4096  # of a hashed document vector


def default_vocabulary() -> str:
    """Path of the default vocabulary file (token in base 64 and rank on each line)."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.tiktoken")


@lru_cache(maxsize=2)
def encoder(vocabulary: str):
    """The encoder of a vocabulary file, which every executor must see at this path; one for each Python worker."""
    import tiktoken

    with open(vocabulary, "rb") as lines:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
    return tiktoken.Encoding("public", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


@lru_cache(maxsize=1)
def projection(tokens: int) -> np.ndarray:
    """For each token the row of a fixed random projection that its hash bucket has."""
    rows = np.random.Generator(np.random.PCG64(7)).standard_normal((BUCKETS, DIMENSIONS)).astype(np.float32)
    ids = np.arange(tokens, dtype=np.uint64)
    return rows[((ids * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(40)).astype(np.int64) % BUCKETS]


def hilbert(points: np.ndarray, bits: int) -> np.ndarray:
    """Place on the Hilbert curve of points with integer coordinates of ``bits`` bits (one row per point)."""
    x = points.astype(np.int64).T.copy()
    n = len(x)
    top = 1 << (bits - 1)
    q = top
    while q > 1:  # undo the turns of each level, from the coarsest
        low = q - 1
        for i in range(n):
            turned = (x[i] & q) != 0
            swap = np.where(turned, 0, (x[0] ^ x[i]) & low)
            x[0] = np.where(turned, x[0] ^ low, x[0] ^ swap)
            x[i] ^= swap
        q >>= 1
    for i in range(1, n):
        x[i] ^= x[i - 1]
    gray = np.zeros_like(x[0])
    q = top
    while q > 1:
        gray = np.where(x[n - 1] & q, gray ^ (q - 1), gray)
        q >>= 1
    x ^= gray
    key = np.zeros_like(x[0])
    for b in range(bits - 1, -1, -1):
        for i in range(n):
            key = (key << 1) | ((x[i] >> b) & 1)
    return key


def curve_keys(token_lists: list[list[int]], tokens: int) -> np.ndarray:
    """Curve place of each list of tokens: its hashed vector, by length, projected to few dimensions; 0 for an empty list."""
    sizes = np.fromiter(map(len, token_lists), np.int64, len(token_lists))
    keys = np.zeros(len(token_lists), np.int64)
    some = sizes > 0
    if some.any():
        ids = np.fromiter(chain.from_iterable(token_lists), np.int64, int(sizes.sum()))
        starts = np.concatenate([[0], np.cumsum(sizes[some])[:-1]])
        means = np.add.reduceat(projection(tokens)[ids], starts, axis=0) / sizes[some][:, None]
        # a mean of n standard normal rows lies within +-1 but for the shortest texts
        grid = np.clip((means + 1) * (1 << (LEVELS - 1)), 0, (1 << LEVELS) - 1)
        keys[some] = hilbert(grid, LEVELS)
    return keys


def token_sizes(texts: DataFrame, vocabulary: str | None = None, curve: bool = False) -> DataFrame:
    """``texts`` with its column ``text`` replaced by ``n_tokens`` and, if asked for, ``curve``.

    A null or empty text has 0 tokens.  Texts are encoded whole, in Arrow batches; strings of special tokens are ordinary text.
    """
    vocabulary = vocabulary or default_vocabulary()
    kept = [f for f in texts.schema.fields if f.name != "text"]

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = encoder(vocabulary)
        for batch in batches:
            columns = [batch.column(f.name) for f in kept]
            values = batch.column("text").to_pylist()
            step = 256  # lists of tokens that are held at once
            sizes: list[int] = []
            keys = []
            for i in range(0, len(values), step):
                lists = [own.encode_ordinary(x) if x else [] for x in values[i : i + step]]
                sizes += map(len, lists)
                if curve:
                    keys.append(curve_keys(lists, own.n_vocab))
            columns.append(pa.array(sizes, pa.int64()))
            if curve:
                columns.append(pa.array(np.concatenate(keys) if keys else np.zeros(0, np.int64)))
            yield pa.RecordBatch.from_arrays(columns, names=[f.name for f in kept] + ["n_tokens"] + ["curve"] * curve)

    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in kept] + ["n_tokens bigint"] + ["curve bigint"] * curve)
    return texts.mapInArrow(encode, schema)
