"""Content hashes without provenance."""

from __future__ import annotations

import hashlib
import json

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Keys that say where a record came from, not what it is.
PROVENANCE = ("source", "canonical_hash")


# Control characters whose escape has a letter among its digits, which JSON here has in lower case.
ESCAPED = ("0b", "0e", "0f", "1a", "1b", "1c", "1d", "1e", "1f")


def stripped(value: Column, kind: T.DataType) -> Column:
    """``value`` without provenance fields at any depth of structs, arrays and maps, fields and keys in the order of their names."""
    if isinstance(kind, T.StructType):
        fields = sorted((f for f in kind.fields if f.name not in PROVENANCE), key=lambda f: f.name)
        return F.when(value.isNotNull(), F.struct(*[stripped(value.getField(f.name), f.dataType).alias(f.name) for f in fields]))
    if isinstance(kind, T.ArrayType) and isinstance(kind.elementType, (T.StructType, T.ArrayType, T.MapType)):
        return F.transform(value, lambda x: stripped(x, kind.elementType))
    if isinstance(kind, T.MapType):
        keys = F.array_sort(F.map_keys(value))
        kept = F.filter(keys, lambda k: ~k.isin(*PROVENANCE)) if isinstance(kind.keyType, T.StringType) else keys
        return F.map_from_arrays(kept, F.transform(kept, lambda k: stripped(F.element_at(value, k), kind.valueType)))
    return value


def _holds(kind: T.DataType, *types: type) -> bool:
    if isinstance(kind, T.StructType):
        return any(_holds(f.dataType, *types) for f in kind.fields)
    if isinstance(kind, T.ArrayType):
        return _holds(kind.elementType, *types)
    if isinstance(kind, T.MapType):
        return _holds(kind.keyType, *types) or _holds(kind.valueType, *types)
    return isinstance(kind, types)


def _lower_escapes(text: Column) -> Column:
    done = text
    for x in ESCAPED:
        done = F.regexp_replace(done, r"(?<!\\)((?:\\\\)*)\\u00" + x.upper(), r"$1\\u00" + x)
    return F.when(F.contains(text, F.lit("\\u00")), done).otherwise(text)


def canonical_json(value: Column, kind: T.DataType) -> Column:
    """Compact JSON with sorted keys, characters as they are, nulls kept.

    Numbers with a fraction are written as Python writes them (1e+20, not 1.0E20), by a batch function and only for records that
    have such fields; all else stays in the JVM.
    """
    text = F.to_json(stripped(value, kind), {"ignoreNullFields": "false"})
    return _python_json(text) if _holds(kind, T.FloatType, T.DoubleType) else _lower_escapes(text)


def canonical_hash(value: Column, kind: T.DataType) -> Column:
    """sha256:<hex> of the canonical JSON: rows that differ only in provenance or in the order of fields hash alike."""
    return F.concat(F.lit("sha256:"), F.sha2(canonical_json(value, kind), 256))


def _dumps(value) -> str:
    return json.dumps(value, sort_keys=True, ensure_ascii=False, separators=(",", ":"))


def _python_json(text: Column) -> Column:
    @F.pandas_udf(T.StringType())
    def rewritten(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: None if t is None else _dumps(json.loads(t)))

    return rewritten(text)


def canonical_hash_json(text: Column) -> Column:
    """The same for JSON text of any shape (a Pandas UDF, for records without a schema); null for null or broken JSON."""
    @F.pandas_udf(T.StringType())
    def hashed(texts: pd.Series) -> pd.Series:
        def bare(x):
            if isinstance(x, dict):
                return {k: bare(v) for k, v in x.items() if k not in PROVENANCE}
            return [bare(v) for v in x] if isinstance(x, list) else x

        def one(t):
            try:
                content = _dumps(bare(json.loads(t)))
            except (TypeError, ValueError):
                return None
            return "sha256:" + hashlib.sha256(content.encode()).hexdigest()

        return texts.map(one)

    return hashed(text)


def tree_hashes(files: DataFrame, group: str, path: Column, checksum: Column, digits: int = 2) -> DataFrame:
    """(group, hash): one hash over path and checksum of every file of a group, whatever the order of rows.

    Files are hashed in branches by the first ``digits`` hex digits of the hash of their path, then the branches, so a group of
    any size needs no list of all its files: a branch holds one in 16 ** ``digits`` of them.
    """
    line = F.concat_ws(" ", checksum, path)
    folded = lambda lines: F.sha2(F.array_join(F.array_sort(F.collect_list(lines)), "\n"), 256)
    branch = F.substring(F.sha2(path, 256), 1, digits)
    branches = files.select(group, branch.alias("__branch"), line.alias("__line")).groupBy(group, "__branch").agg(folded(F.col("__line")).alias("__hash"))
    return branches.groupBy(group).agg(F.concat(F.lit("sha256:"), folded(F.concat_ws(" ", "__branch", "__hash"))).alias("hash"))
