"""Landed files of sources: where they lie, how they are read, and how results are published."""

from __future__ import annotations

import json
import logging
import os
import shutil
import tempfile
import uuid
from contextlib import contextmanager
from dataclasses import dataclass
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.scratch import cut


@dataclass(frozen=True)
class Layout:
    """All paths below one root."""

    root: Path

    @classmethod
    def at(cls, root: str | Path | None = None) -> Layout:
        """Layout of ``root``, the current folder by default."""
        return cls(Path(root or Path.cwd()).resolve())

    def raw(self, source: str) -> Path:
        """Archive of fetched files."""
        return self.root / "data" / "raw" / source

    def normalized(self, source: str, edition: str) -> Path:
        """Canonical records of one edition."""
        return self.root / "data" / "normalized" / f"source={source}" / f"edition={edition}"

    def enrichment(self, name: str) -> Path:
        """Curated or derived layer."""
        return self.root / "data" / "enrichment" / f"{name}.json"

    def registry(self) -> Path:
        """The registry of sources."""
        return self.root / "data" / "manifests" / "sources.json"


def log_level(verbosity: int) -> int:
    """Warnings, with 1 also information, with 2 everything."""
    return {1: logging.INFO}.get(verbosity, logging.DEBUG if verbosity > 1 else logging.WARNING)


def xml_rows(spark: SparkSession, path: str, row_tag: str, schema: str) -> DataFrame:
    """One row per ``row_tag`` element, streamed by Spark's own XML reader; a broken file stops the query."""
    return spark.read.format("xml").option("rowTag", row_tag).option("mode", "FAILFAST").schema(schema).load(path)


def title_version(spark: SparkSession, path: str, number: int) -> DataFrame:
    """(latest_issue_date) of one title in a landed list of titles; no row if the list does not name it."""
    schema = "titles array<struct<number: int, latest_issue_date: string>>"
    rows = spark.read.schema(schema).option("mode", "FAILFAST").option("multiLine", "true").json(path)
    return rows.select(F.explode("titles").alias("t")).where(F.col("t.number") == number).select("t.latest_issue_date")


def json_layer(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A curated or derived JSON layer under a fixed schema; a missing file is an empty layer."""
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    if not hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(hadoop):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).option("mode", "FAILFAST").option("multiLine", "true").json(path)


def files(spark: SparkSession, path: str, pattern: str = "*") -> DataFrame:
    """(path, length, checksum) of all files below ``path``."""
    rows = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", pattern).load(path)
    return rows.select("path", "length", F.concat(F.lit("sha256:"), F.sha2("content", 256)).alias("checksum"))


def notes(spark: SparkSession, path: str) -> DataFrame:
    """(stem, folders, text) of all notes below ``path``."""
    rows = spark.read.text(path, wholetext=True, recursiveFileLookup=True)
    name = F.url_decode(F.regexp_replace(F.col("_metadata.file_path"), r"\+", "%2B"))
    parts = F.split(name, "/")
    return rows.select(
        F.regexp_replace(F.element_at(parts, -1), r"\.md$", "").alias("stem"), F.slice(parts, 1, F.size(parts) - 1).alias("folders"), F.col("value").alias("text")
    ).where(F.col("stem") != "")


def pdf_texts(spark: SparkSession, path: str) -> DataFrame:
    """(path, page, text) of PDF files with a text layer, if the optional reader pypdf is installed."""
    try:
        import pypdf  # noqa: F401
    except ImportError as missing:
        raise RuntimeError("reading PDF files needs the optional package pypdf") from missing

    def pages(batches):
        import io

        import pandas as pd
        from pypdf import PdfReader

        for pdf in batches:
            for name, content in zip(pdf.path, pdf.content, strict=True):
                texts = [p.extract_text() for p in PdfReader(io.BytesIO(content)).pages]
                yield pd.DataFrame({"path": name, "page": range(1, len(texts) + 1), "text": texts})

    rows = spark.read.format("binaryFile").option("pathGlobFilter", "*.pdf").load(path).select("path", "content")
    return rows.mapInPandas(pages, "path string, page int, text string")


# Fields of a source's state in the registry and their kinds.
STATE = {"last_checked_at": str, "effective_date": str, "change": int, "raw_hash": str, "canonical_hash": str, "accepted_version": str}


class RegistryError(ValueError):
    """The registry of sources is not valid."""


class SourceRegistry:
    """States of a fixed set of sources, as strict JSON (schema version 1)."""

    def __init__(self, states: dict[str, dict]):
        self.states = states

    @classmethod
    def parse(cls, text: str, known: set[str]) -> SourceRegistry:
        """The registry in ``text``; anything unknown, missing or of a wrong kind is an error."""
        try:
            data = json.loads(text)
        except ValueError as broken:
            raise RegistryError(f"registry is not valid JSON: {broken}") from None
        if not isinstance(data, dict):
            raise RegistryError("registry is no JSON object")
        version = data.get("schema_version")
        if type(version) is not int or version != 1:
            raise RegistryError(f"schema_version must be the integer 1, not {version!r}")
        sources = data.get("sources")
        problems = {
            "unknown top-level fields": sorted(data.keys() - {"schema_version", "sources"}),
            "unknown sources": sorted(sources.keys() - known) if isinstance(sources, dict) else ["sources is no object"],
            "missing sources": sorted(known - sources.keys()) if isinstance(sources, dict) else [],
        }
        for what, names in problems.items():
            if names:
                raise RegistryError(f"{what}: {', '.join(names)}")
        for name, state in sources.items():
            if not isinstance(state, dict):
                raise RegistryError(f"state of {name} is no object")
            if extra := sorted(state.keys() - STATE.keys()):
                raise RegistryError(f"unknown fields of {name}: {', '.join(extra)}")
            for field, value in state.items():
                if value is not None and type(value) is not STATE[field]:
                    kind = "an integer" if STATE[field] is int else "a string"
                    raise RegistryError(f"{field} of {name} must be {kind}")
        return cls({name: {k: v for k, v in state.items() if v is not None} for name, state in sources.items()})

    @classmethod
    def load(cls, path: Path, known: set[str]) -> SourceRegistry:
        """The registry in a file."""
        try:
            text = Path(path).read_bytes().decode("utf-8")
        except (OSError, UnicodeDecodeError) as broken:
            raise RegistryError(f"cannot read manifest {path}: {broken}") from None
        return cls.parse(text, known)

    def to_json(self) -> str:
        """Sorted, without null fields, with a newline at the end."""
        states = {name: {k: v for k, v in state.items() if v is not None} for name, state in self.states.items()}
        return json.dumps({"schema_version": 1, "sources": states}, sort_keys=True, indent=2, ensure_ascii=False) + "\n"

    def save(self, path: Path) -> None:
        """Replace the file in one step; on failure the old one stays and no other file is left."""
        path = Path(path)
        handle, name = tempfile.mkstemp(dir=path.parent, suffix=".tmp")
        try:
            with os.fdopen(handle, "w", encoding="utf-8") as out:
                out.write(self.to_json())
                out.flush()
                os.fsync(out.fileno())
            os.replace(name, path)
            folder = os.open(path.parent, os.O_RDONLY)
            try:
                os.fsync(folder)
            finally:
                os.close(folder)
        except BaseException:
            Path(name).unlink(missing_ok=True)
            raise


def _hadoop(spark: SparkSession, path: str):
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), place


class Locked(RuntimeError):
    """Another process publishes to the same place."""


@contextmanager
def exclusive(spark: SparkSession, path: str):
    """Exclusion of other processes that publish to ``path``: a lock file beside it, created only if it is not there.

    It goes away with the block, also on failure; after a killed process it must be removed by hand.
    """
    store, lock = _hadoop(spark, path.rstrip("/") + ".lock")
    try:
        store.create(lock, False).close()
    except Exception as held:
        raise Locked(f"{path} is being published to (or {lock} was left behind)") from held
    try:
        yield
    finally:
        store.delete(lock, False)


MANIFEST = "_current.json"


def _manifest(spark: SparkSession, path: str) -> dict[str, str]:
    """Version folder of each partition of a published table; an unpartitioned one has the partition ''."""
    store, place = _hadoop(spark, f"{path}/{MANIFEST}")
    if not store.exists(place):
        return {}
    stream = store.open(place)
    try:
        return json.loads(spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
    finally:
        stream.close()


def published(spark: SparkSession, path: str) -> DataFrame:
    """The table that was published to ``path`` last: each partition from the version that holds it."""
    found: DataFrame | None = None
    parts = _manifest(spark, path)
    for version in sorted(set(parts.values())):
        base = f"{path}/{version}"
        df = spark.read.option("basePath", base).parquet(*[f"{base}/{p}".rstrip("/") for p, v in parts.items() if v == version])
        found = df if found is None else found.unionByName(df, allowMissingColumns=True)
    if found is None:
        raise FileNotFoundError(f"nothing was published to {path}")
    return found


def publish(df: DataFrame, path: str, *partitions: str, checks=None) -> None:
    """Write ``df`` as a new version below ``path``, check what was written, and only then make it the current one.

    ``checks`` gets the written DataFrame and raises if it must not be published.  Versions are never overwritten; what readers
    see is a manifest, replaced by one rename, so a failure at any time leaves the table as it was.  With ``partitions`` only
    those that ``df`` holds change; others, such as curated ones, stay with their version.  Two publishers exclude each other.
    """
    spark = df.sparkSession
    version = f"v-{uuid.uuid4().hex}"
    with exclusive(spark, path):
        writer = df.write
        if partitions:
            writer = writer.partitionBy(*partitions)
        writer.parquet(f"{path}/{version}")
        written = spark.read.schema(df.schema).parquet(f"{path}/{version}")
        if checks is not None:
            checks(written)
        current = _manifest(spark, path) if partitions else {}
        if partitions:
            store, held = _hadoop(spark, f"{path}/{version}" + "/*=*" * len(partitions))
            current |= {str(x.getPath().toString()).split(f"/{version}/", 1)[1]: version for x in store.globStatus(held) or []}
        else:
            current = {"": version}
        store, part = _hadoop(spark, f"{path}/.{version}.json")
        out = store.create(part, True)
        out.write(bytearray(json.dumps(current, sort_keys=True).encode()))
        out.hsync()
        out.close()
        jvm = spark.sparkContext._jvm
        over = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 1)
        over[0] = jvm.org.apache.hadoop.fs.Options.Rename.OVERWRITE
        context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(store.makeQualified(part).toUri(), spark.sparkContext._jsc.hadoopConfiguration())
        context.rename(store.makeQualified(part), store.makeQualified(jvm.org.apache.hadoop.fs.Path(f"{path}/{MANIFEST}")), over)


# Folders of notes that are written by hand.
CURATED = ("Collections", "Topics", "Study")


def write_notes(notes: DataFrame, folder: str, curated: tuple[str, ...] = CURATED) -> None:
    """One text file per row (path, body), written by the executors; ``folder`` must be on storage that all of them mount.

    All notes are written to a staging folder inside first and only moved, file by file, when every one is there; a failure
    before that changes nothing.  A path outside the folder or in a ``curated`` one, a missing body and two notes of one path
    are errors.
    """
    bad = notes.where(F.col("path").isNull() | F.col("path").rlike(r"(^/|(^|/)\.\.?(/|$))") | F.col("body").isNull() | F.split_part("path", F.lit("/"), F.lit(1)).isin(*curated))
    if not bad.isEmpty():
        raise ValueError("a note has no body, no path, or a path outside the folder or in a curated one")
    if notes.groupBy("path").count().where("count > 1").limit(1).count():
        raise ValueError("two notes have one path")
    staging = Path(folder) / f".staging-{uuid.uuid4().hex}"

    def stage(batches):
        import pandas as pd

        for pdf in batches:
            for path, body in zip(pdf.path, pdf.body, strict=True):
                target = staging / path
                target.parent.mkdir(parents=True, exist_ok=True)
                part = target.with_name(f".{target.name}.{uuid.uuid4().hex}.tmp")
                part.write_text(body, encoding="utf-8")
                os.replace(part, target)
            yield pd.DataFrame({"path": pdf.path})

    def move(batches):
        import pandas as pd

        for pdf in batches:
            for path in pdf.path:
                target = Path(folder) / path
                target.parent.mkdir(parents=True, exist_ok=True)
                try:
                    os.replace(staging / path, target)
                except FileNotFoundError:  # a task that runs again finds it moved
                    if not target.exists():
                        raise
            yield pd.DataFrame({"n": [len(pdf)]})

    try:
        staged = cut(notes.select("path", "body").mapInPandas(stage, "path string"), "staged")
        staged.mapInPandas(move, "n long").agg(F.sum("n")).collect()
    finally:
        shutil.rmtree(staging, ignore_errors=True)
