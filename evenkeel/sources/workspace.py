"""Where intermediate tables go.

Results that later steps read again are written as Parquet to the shared
folder the cluster names in ``spark.checkpoint.dir``.  A written table
survives the loss of any executor, cuts the lineage, and gives the optimizer a
true size for the next join.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar
from functools import cache

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_DIR = "spark.checkpoint.dir"


def is_local(spark: SparkSession) -> bool:
    """Whether all tasks run in this process."""
    master = spark.sparkContext.master
    return master == "local" or master.startswith("local[")


def shared_folder(spark: SparkSession) -> str:
    """The configured checkpoint folder; a temporary one only on a local master."""
    folder = spark.conf.get(CHECKPOINT_DIR, None)
    if folder:
        return folder
    if not is_local(spark):
        raise ValueError(f"set {CHECKPOINT_DIR} to a folder that all executors share")
    return _local_folder(spark.sparkContext.applicationId)


@cache
def _local_folder(application: str) -> str:
    return tempfile.mkdtemp(prefix=f"evenkeel-{application}-")


_RUN: ContextVar[str | None] = ContextVar("run", default=None)


@contextmanager
def workspace(spark: SparkSession) -> Iterator[str]:
    """A folder of its own for all tables written inside, removed at the end.

    Frames that read those tables are of no use after that: write what is to
    stay to a place of your own.
    """
    folder = f"{shared_folder(spark).rstrip('/')}/run-{uuid.uuid4().hex}"
    token = _RUN.set(folder)
    try:
        yield folder
    finally:
        _RUN.reset(token)
        remove(spark, folder)


def current_workspace() -> str | None:
    """The folder of the workspace that tables go to now; None outside of one."""
    return _RUN.get()


def remove(spark: SparkSession, path: str) -> None:
    """Remove a table or folder, wherever Spark writes to."""
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).delete(hadoop, True)


def exists(spark: SparkSession, path: str) -> bool:
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).exists(hadoop)


def new_table_path(spark: SparkSession, name: str) -> str:
    folder = _RUN.get() or shared_folder(spark).rstrip("/")
    return f"{folder}/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and return it as a scan of that table."""
    spark = df.sparkSession
    path = new_table_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
