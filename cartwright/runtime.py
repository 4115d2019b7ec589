"""Where intermediate tables live.

Some jobs must read an intermediate result more than once and need it to be
the same each time (a sampled range partitioning, for example). They write it
as a Parquet table below the folder that ``spark.checkpoint.dir`` names, so a
lost executor costs a re-read and nothing else.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from urllib.parse import urlparse

from pyspark.sql import DataFrame, SparkSession

#: Most bytes of rows that a Python worker gets at once inside ``small_batches``; a larger row goes alone.
BATCH_BYTES = 1 << 20

#: Paths of the tables made inside each open ``temporary_tables``.
_temporary: list[list[str]] = []


def work_dir(spark: SparkSession) -> str:
    """Shared folder for intermediate tables of this application.

    ``spark.checkpoint.dir`` names it. Where that is unset, the tables go below
    the warehouse, which all executors of a session share as well; a warehouse
    on a machine's own disk is refused if there is more than one machine.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        root = spark.conf.get("spark.sql.warehouse.dir")
        if not spark.sparkContext.master.startswith("local") and urlparse(root).scheme in ("", "file"):
            raise RuntimeError(f"executors may not share {root}: set spark.checkpoint.dir to a folder that they do")
    return f"{root.rstrip('/')}/cartwright-{spark.sparkContext.applicationId}"


def clear_work_dir(spark: SparkSession) -> None:
    """Delete the intermediate tables of this application; call it when its results are stored."""
    delete(spark, work_dir(spark))


def delete(spark: SparkSession, path: str) -> None:
    """Remove a folder of this job's own, if it is there."""
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


@contextmanager
def temporary_tables(spark: SparkSession) -> Iterator[None]:
    """Tables that are materialized inside are deleted at the end; store what is made of them before."""
    _temporary.append([])
    try:
        yield
    finally:
        for path in _temporary.pop():
            delete(spark, path)


@contextmanager
def small_batches(spark: SparkSession) -> Iterator[None]:
    """Jobs that are run inside hand texts to Python in batches of ``BATCH_BYTES``.

    Spark's own limit lets a task's share of a table be one batch: executor,
    worker and pandas then hold it once each, for every core.
    """
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, str(BATCH_BYTES))
    try:
        yield
    finally:
        spark.conf.set(name, before)


def fresh_path(spark: SparkSession, label: str) -> str:
    return f"{work_dir(spark)}/{label}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to the shared folder and return a scan of what was written."""
    spark = df.sparkSession
    path = fresh_path(spark, label)
    if _temporary:
        _temporary[-1].append(path)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
