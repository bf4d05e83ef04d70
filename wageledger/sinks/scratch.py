"""Intermediate tables in the shared folder of the cluster."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

SETTING = "spark.checkpoint.dir"
# The folder of the job that runs, if it cleans up.
_run: ContextVar[str | None] = ContextVar("run", default=None)


def scratch_folder(spark: SparkSession) -> str:
    """The shared folder the cluster names.

    A single-machine session without one gets a temporary folder; a cluster
    must name one, since its machines do not see each other's disks.
    """
    folder = spark.conf.get(SETTING, None) or spark.sparkContext.getConf().get(SETTING)
    if not folder:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise ValueError(f"set {SETTING} to a folder that driver and executors share")
        folder = tempfile.mkdtemp(prefix="wageledger-")
        spark.conf.set(SETTING, folder)
    return folder


def new_path(spark: SparkSession, name: str) -> str:
    """A path in the shared folder that nothing else uses."""
    folder = _run.get() or scratch_folder(spark).rstrip("/")
    return f"{folder}/{name}-{uuid.uuid4().hex}"


@contextmanager
def cleaned(spark: SparkSession) -> Iterator[None]:
    """What is stored inside goes to a folder of its own, which is deleted at the end.

    For jobs that are done with all they stored; not around what returns a DataFrame.
    """
    folder = f"{scratch_folder(spark).rstrip('/')}/run-{uuid.uuid4().hex}"
    before = _run.set(folder)
    try:
        yield
    finally:
        _run.reset(before)
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    Cuts the lineage, survives lost executors, and tells the optimizer the
    true size, so a small table is broadcast and a large one is not.
    """
    spark = df.sparkSession
    path = new_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
