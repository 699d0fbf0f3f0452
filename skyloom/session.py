"""Session and table helpers shared by every query."""

from __future__ import annotations

import atexit
import re
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark import SparkContext
from pyspark.sql import DataFrame, SparkSession


def local_session(cores: str = "8", **conf: str) -> SparkSession:
    """A session for tests and the bench; clusters bring their own."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
    )
    for key, value in conf.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One input table; only Spark's reader touches the path."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir, or the one set on the context.

    Where neither is set, a session on one machine gets a temporary folder; on a
    cluster that is an error, as executors would not see it.
    """
    context = spark.sparkContext
    known = context.getCheckpointDir()
    where = spark.conf.get("spark.checkpoint.dir", None) or known
    if where is None:
        if not re.fullmatch(r"local(\[.*\])?", context.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
        where = tempfile.mkdtemp(prefix="skyloom-")
    if known is None:
        context.setCheckpointDir(where)
    return where


#: Folders that materialize() wrote since the innermost scratch() block began.
_written: ContextVar[list[str] | None] = ContextVar("written", default=None)


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """A block whose materialized tables are deleted at its end; what it returns must not read them."""
    mine: list[str] = []
    token = _written.set(mine)
    try:
        yield
    finally:
        _written.reset(token)
        for path in mine:
            where, system = hadoop_path(spark, path)
            system.delete(where, True)


def hadoop_path(spark: SparkSession, path: str):
    """A path and its file system, as Spark's readers see them."""
    jvm = spark.sparkContext._jvm
    where = jvm.org.apache.hadoop.fs.Path(path)
    return where, where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def _forget(spark: SparkSession, path: str) -> None:
    if SparkContext._active_spark_context is not None:
        where, system = hadoop_path(spark, path)
        system.delete(where, True)


def materialize(df: DataFrame) -> DataFrame:
    """Write a table to the shared folder and read it again.

    Cuts the lineage: a lost executor costs a re-read, not a recomputation. The
    folder goes at the end of the scratch() block, or else of the application.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/skyloom-{uuid.uuid4().hex}"
    written = _written.get()
    if written is None:
        where, system = hadoop_path(spark, path)
        system.deleteOnExit(where)  # when the JVM ends
        atexit.register(_forget, spark, path)  # when Python ends first
    else:
        written.append(path)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
