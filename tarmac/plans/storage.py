"""Written stage tables in the folder shared by the cluster."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """Folder named by ``spark.checkpoint.dir``; a local folder only for a local master."""
    path = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if path:
        return path.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
    path = tempfile.mkdtemp(prefix="tarmac-")
    spark.conf.set("spark.checkpoint.dir", path)
    return path


def keep_rounds(spark: SparkSession) -> None:
    """Let iterative trainers cut their lineage in the shared folder every few rounds; without it a thousand rounds are one chain."""
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(shared_dir(spark))


#: Stage tables by the scope that made them; "" is the scope of code that opened none.
_made: dict[str, list[str]] = {"": []}
_scope: ContextVar[str] = ContextVar("tarmac_stages", default="")


def stage_path(spark: SparkSession, label: str) -> str:
    """A new path in the shared folder, remembered for ``drop_stages``."""
    path = f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"
    _made.setdefault(_scope.get(), []).append(path)
    return path


@contextmanager
def stages(spark: SparkSession) -> Iterator[str]:
    """Scope whose stage tables are deleted at its end, and no others: results that read them are to be written inside it.

    Code that runs in other threads or scopes keeps its tables.
    """
    name = uuid.uuid4().hex
    token = _scope.set(name)
    try:
        yield name
    finally:
        _scope.reset(token)
        drop_stages(spark, name)


def drop_stages(spark: SparkSession, scope: str | None = None) -> int:
    """Delete the stage tables of a scope, by default the current one. Call it once the results that read them are written."""
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    made = _made.get(_scope.get() if scope is None else scope, [])
    count = len(made)
    while made:
        target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(made.pop())
        target.getFileSystem(conf).delete(target, True)
    if scope:
        _made.pop(scope, None)
    return count


def materialize(df: DataFrame, label: str = "stage", partition_by: list[str] | None = None) -> DataFrame:
    """Write ``df`` once as parquet and read it back.

    Cuts the lineage, survives lost executors, and lets each later reader prune columns.
    """
    spark = df.sparkSession
    path = stage_path(spark, label)
    writer = df.write.mode("errorifexists")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
