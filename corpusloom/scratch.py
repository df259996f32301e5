"""Tables written between stages, in the folder that all executors share.

The folder is the session's ``spark.checkpoint.dir``.  Only a purely local session (tests) may leave it unset; it then gets
a temporary folder.  On a cluster an unset folder is an error, since a machine-local one would not survive a lost executor.
"""

from __future__ import annotations

import atexit
import gc
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_WRITTEN: list[tuple[SparkSession, str, str | None]] = []
_KEPT: list[tuple[SparkSession, str, str | None]] = []  # small fixed tables that stay until the interpreter ends


def scratch_root(spark: SparkSession) -> str:
    """Folder for intermediate tables; raises on a cluster without ``spark.checkpoint.dir``."""
    root = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    if spark.sparkContext.getCheckpointDir():
        return spark.sparkContext.getCheckpointDir().rstrip("/")
    if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
        raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
    spark.sparkContext.setCheckpointDir("file://" + tempfile.mkdtemp(prefix="corpusloom-"))
    return spark.sparkContext.getCheckpointDir().rstrip("/")


def new_path(spark: SparkSession, name: str, table: str | None = None, keep: bool = False) -> str:
    """A fresh path below the scratch folder; removed by ``drop_scratch`` (unless ``keep``) and when the interpreter ends."""
    path = f"{scratch_root(spark)}/corpusloom/{name}-{uuid.uuid4().hex}"
    if not _WRITTEN and not _KEPT:
        atexit.register(drop_scratch, everything=True)
    (_KEPT if keep else _WRITTEN).append((spark, path, table))
    return path


def cut(df: DataFrame, name: str = "stage", keep: bool = False) -> DataFrame:
    """Write ``df`` once as Parquet into the shared folder and read it back: cuts lineage and survives lost executors."""
    spark = df.sparkSession
    path = new_path(spark, name, keep=keep)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def fixed(df: DataFrame) -> DataFrame:
    """A reliable checkpoint that keeps the partitioning, for small intermediate results."""
    scratch_root(df.sparkSession)
    return df.checkpoint(eager=True)


def free_shuffles(spark: SparkSession) -> None:
    """Let Spark delete the shuffle files behind what has been written; else they stay until the driver collects its garbage."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def drop_tables(*paths: str) -> None:
    """Delete single tables that nothing reads any more, and the shuffle files behind them."""
    for spark, path, table in [w for w in _WRITTEN if w[1] in paths]:
        _WRITTEN.remove((spark, path, table))
        hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(hadoop, True)
        free_shuffles(spark)


def drop_scratch(everything: bool = False) -> None:
    """Delete the tables written here; results that still read them become unreadable.  Call it when a query's result is stored."""
    for written in (_WRITTEN, _KEPT) if everything else (_WRITTEN,):
        while written:
            spark, path, table = written.pop()
            try:
                if table:
                    spark.sql(f"DROP TABLE IF EXISTS {table}")
                hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
                hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(hadoop, True)
            except Exception:  # the session may be gone already
                continue
