"""Distributed forms against plain windows, with ties, NULLs and few rows."""

import random
from decimal import Decimal

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from cartwright.operators.percentiles import distributed_percentiles
from cartwright.operators.ranking import (
    distributed_ntile,
    distributed_running_sum,
    grouped_running_sum,
)
from cartwright.runtime import materialize, work_dir


@pytest.fixture(autouse=True)
def many_partitions(spark):
    """Keep the small range partitions apart so that borders are exercised."""
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    yield
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def _rows(spark, n, seed):
    rng = random.Random(seed)
    data = [
        (
            i,
            # A third of all rows share one value.
            7 if rng.random() < 0.34 else rng.randrange(-5, 40),
            None if rng.random() < 0.1 else Decimal(rng.randrange(0, 500)) / 100,
        )
        for i in range(n)
    ]
    df = spark.createDataFrame(data, "id bigint, a int, b decimal(10,2)")
    return materialize(df, "rows")


def ntile_window(df, tiles, orders, key):
    return df.withColumns(
        {
            name: F.ntile(tiles).over(Window.orderBy(*columns, F.col(key)))
            for name, columns in orders.items()
        }
    )


def running_share_window(df, order, value, *, running, total, rank):
    by_order = Window.orderBy(F.col(order).desc_nulls_first())
    up_to_peers = by_order.rangeBetween(Window.unboundedPreceding, Window.currentRow)
    return df.withColumns(
        {
            running: F.sum(value).over(up_to_peers),
            total: F.sum(value).over(Window.partitionBy()),
            rank: F.dense_rank().over(by_order),
        }
    )


def percentile_columns(value, wanted):
    return [F.percentile(value, p).alias(name) for name, p in wanted.items()]


def _same(left, right):
    assert sorted(map(tuple, left.collect()), key=repr) == sorted(
        map(tuple, right.collect()), key=repr
    )


def test_shared_folder_is_the_configured_one(spark):
    assert work_dir(spark).startswith(spark.conf.get("spark.checkpoint.dir"))


@pytest.mark.parametrize("n", [0, 1, 4, 5, 23, 700])
def test_ntile(spark, n):
    df = _rows(spark, n, n)
    orders = {
        "down": [-F.col("a")],
        "nulls_last": [F.col("b").isNull().cast("int"), F.coalesce("b", F.lit(0))],
    }
    _same(distributed_ntile(df, 5, orders, "id"), ntile_window(df, 5, orders, "id"))


@pytest.mark.parametrize("n", [1, 23, 700])
def test_running_share(spark, n):
    df = _rows(spark, n, n + 1)
    names = dict(running="run", total="whole", rank="place")
    columns = ["id", "run", "whole", "place"]
    _same(
        distributed_running_sum(df, "b", "b", **names).select(columns),
        running_share_window(df, "b", "b", **names).select(columns),
    )


@pytest.mark.parametrize("n", [1, 23, 700])
def test_grouped_running_sum(spark, n):
    df = _rows(spark, n, n + 2)
    upto = Window.partitionBy("a").orderBy("id").rowsBetween(Window.unboundedPreceding, 0)
    _same(
        grouped_running_sum(df, "a", ["id"], "id", "upto").select("id", "upto"),
        df.select("id", F.sum("id").over(upto).alias("upto")),
    )


def test_percentiles(spark):
    df = _rows(spark, 700, 9).withColumn("b", F.col("b").cast("double"))
    wanted = {"p50": 0.5, "p90": 0.9}

    def rounded(frame):
        return frame.select("a", *[F.round(c, 9).alias(c) for c in wanted])

    _same(
        rounded(distributed_percentiles(df, "a", "b", wanted)),
        rounded(df.groupBy("a").agg(*percentile_columns("b", wanted))),
    )


def test_no_rows_in_one_partition(spark):
    """The numbered table never passes through a single-partition exchange."""
    df = _rows(spark, 300, 3)
    out = grouped_running_sum(df, "a", ["id"], "id", "upto")
    assert "SinglePartition" not in out._jdf.queryExecution().executedPlan().toString()


def test_percentiles_with_sums(spark):
    """Sums cover rows without a value; a group without any value has no row."""
    df = _rows(spark, 700, 10).withColumn("b", F.col("b").cast("double"))
    lone = spark.range(3).select("id", F.lit(999).alias("a"), F.lit(None).cast("double").alias("b"))
    both = df.unionByName(lone)
    out = distributed_percentiles(both, "a", "b", {"p0": 0.0, "p100": 1.0}, {"ids": F.col("id")})
    plain = df.groupBy("a").agg(F.min("b").alias("p0"), F.max("b").alias("p100"), F.sum("id").alias("ids"))
    columns = ["a", "p0", "p100", "ids"]
    _same(out.select(columns), plain.select(columns))
