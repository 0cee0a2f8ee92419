"""Session settings, shared storage and tables that cut lineage."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession


def build_session(app: str = "fabspark", master: str | None = None, **conf: str) -> SparkSession:
    """A session for local work; on a cluster use the session the cluster gives."""
    b = (SparkSession.builder.appName(app)
         .config("spark.sql.session.timeZone", "UTC")
         .config("spark.sql.adaptive.enabled", "true")
         .config("spark.sql.adaptive.skewJoin.enabled", "true")
         .config("spark.ui.enabled", "false"))
    if master:
        b = b.master(master)
    for k, v in conf.items():
        b = b.config(k, v)
    return b.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """Folder that every executor can reach, as named by ``spark.checkpoint.dir``.

    Only a local master may go without the setting; it then gets a new temporary
    folder. Tables written here live under the application id, so the folder of
    a finished application can be dropped as a whole.
    """
    sc = spark.sparkContext
    base = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not base:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="fabspark-"))
        base = sc.getCheckpointDir()
    return os.path.join(base, "fabspark", sc.applicationId)


def new_path(spark: SparkSession, name: str = "t") -> str:
    return os.path.join(shared_dir(spark), f"{name}-{uuid.uuid4().hex}")


_SCRATCH: ContextVar[list[str] | None] = ContextVar("scratch", default=None)


def drop_path(spark: SparkSession, path: str) -> None:
    """Remove a folder on whatever file system it lies."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Drop the tables settled inside when the block ends.

    For work that writes its own results, such as a micro-batch: a long-running
    stream would otherwise fill the shared folder.
    """
    made: list[str] = []
    token = _SCRATCH.set(made)
    try:
        yield
    finally:
        _SCRATCH.reset(token)
        for path in made:
            drop_path(spark, path)


def settled(df: DataFrame, name: str = "t") -> DataFrame:
    """Write ``df`` once to shared storage and read it back.

    Cuts lineage in a way that survives lost executors, fixes results of
    non-deterministic steps, and gives the planner the true size of the table,
    so a small table is broadcast by size and a large one is not.
    """
    spark = df.sparkSession
    path = new_path(spark, name)
    df.write.parquet(path)
    made = _SCRATCH.get()
    if made is not None:
        made.append(path)
    return spark.read.schema(df.schema).parquet(path)
