"""The skew-proof ordered scan equals plain windows, for any slicing."""

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from conftest import SF01
from strata.operators.sequence import PID, ordered_scan, slice_by_range


def _events(spark):
    return spark.read.parquet(f"{SF01}/events.parquet").select("event_id", "ts", "user_id", "value")


def _expected(df, keys, measure):
    w = Window.partitionBy(*keys).orderBy("ts", "event_id")
    run = w.rowsBetween(Window.unboundedPreceding, 0)
    bad = (F.col(measure) > 100).cast("int")
    return df.select(
        "event_id",
        F.lag(measure, 1).over(w).alias("p1"),
        F.lag(measure, 3).over(w).alias("p3"),
        F.coalesce(F.sum(bad).over(run), F.lit(0)).alias("c"),
    )


@pytest.mark.parametrize("parts", [1, 3, 8, 37])
@pytest.mark.parametrize("skew", ["none", "all", "half"])
@pytest.mark.parametrize("strategy", ["auto", "slices"])
def test_scan_equals_window(spark, parts, skew, strategy):
    df = _events(spark)
    if skew == "all":  # one key holds every row: the window would be a single task
        df = df.withColumn("user_id", F.lit(7).cast("long"))
    elif skew == "half":  # one hot key next to many ordinary ones
        df = df.withColumn("user_id", F.when(F.col("event_id") % 2 == 0, F.lit(7).cast("long")).otherwise(F.col("user_id")))
    got = ordered_scan(
        df, ["user_id"], ["ts", "event_id"],
        lags={"p1": ("value", 1), "p3": ("value", 3)},
        running={"c": (F.col("value") > 100).cast("int")},
        num_partitions=parts, strategy=strategy,
    ).select("event_id", "p1", "p3", "c")
    exp = _expected(df, ["user_id"], "value")
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, exp.collect()))


def test_global_order_without_key(spark):
    df = _events(spark)
    got = ordered_scan(df, [], ["ts", "event_id"], lags={"p1": ("value", 1)},
                       running={"c": F.lit(1)}, num_partitions=5).select("event_id", "p1", "c")
    w = Window.orderBy("ts", "event_id")
    exp = df.select("event_id", F.lag("value").over(w).alias("p1"), F.row_number().over(w).cast("long").alias("c"))
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, exp.collect()))


def test_hot_key_is_spread_over_slices(spark):
    df = _events(spark).withColumn("user_id", F.lit(1).cast("long"))
    sliced = slice_by_range(df, ["user_id"], ["ts", "event_id"], 8)
    sizes = [r["count"] for r in sliced.groupBy(PID).count().collect()]
    assert len(sizes) == 8 and max(sizes) < 2 * df.count() / 8
