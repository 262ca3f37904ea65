"""Plan-shape checks: the physical plans are the ones we designed for scale."""

import re

import pytest

from conftest import SF01
from strata.plans.catalog import queries


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def q():
    return queries()


@pytest.mark.parametrize("name", ["near_events_1h", "extreme_news_1h", "following_2h", "shared_terms_near_in_time",
                                  "cross_source_inner", "mentions_vs_measure", "zscore_spikes"])
def test_no_quadratic_joins(spark, q, name):
    p = _plan(q[name](spark, SF01))
    assert "BroadcastNestedLoopJoin" not in p and "CartesianProduct" not in p


@pytest.mark.parametrize("name", ["top10_by_measure", "latest10", "topics_top15", "word_frequency_top15", "recent_top30"])
def test_top_n_is_bounded(spark, q, name):
    assert "TakeOrderedAndProject" in _plan(q[name](spark, SF01))


@pytest.mark.parametrize("name", ["topic_frequency", "word_frequency_top15", "category_stats", "key_statistics",
                                  "current_state", "dedup_effect"])
def test_partial_aggregation_before_shuffle(spark, q, name):
    p = _plan(q[name](spark, SF01))
    assert re.search(r"partial_(count|max_by|sum|avg|max|min)", p), p


def test_scan_prunes_columns_and_pushes_filters(spark, q):
    p = _plan(q["category_distribution"](spark, SF01))
    assert "ReadSchema: struct<lang:string>" in p
    assert "PushedFilters: [IsNotNull(lang)]" in p


@pytest.mark.parametrize("hot", [False, True])
def test_series_windows_split_hot_keys(spark, hot):
    """Without hot keys the plan is a plain per-entity window; with one entity
    holding half the rows, that entity's rows go through windows keyed by
    (slice, entity), and any window keyed by the entity alone reads only the
    filtered boundary rows (<= 4K per slice)."""
    from pyspark.sql import functions as F
    from strata.operators import series

    ev = spark.read.parquet(f"{SF01}/events.parquet").select("user_id", "ts", "event_id", "value")
    if hot:
        ev = ev.withColumn("user_id", F.when(F.col("event_id") % 2 == 0, F.lit(7).cast("long")).otherwise(F.col("user_id")))
    p = _plan(series.velocity(ev, "user_id", "ts", "event_id", "value"))
    assert ("windowspecdefinition(_sq_pid" in p) == hot
    if hot:
        lines = p.splitlines()
        for i, line in enumerate(lines):
            m = re.search(r"Window \[.*\], \[([^\]]*)\], \[", line)
            if not m or "_sq_pid" in m.group(1) or "_sq_last" in m.group(1) or not m.group(1).strip():
                continue
            below = "\n".join(lines[i:i + 14])
            if "_sq_" in below:  # a window of the sliced branch
                assert "Filter" in below and "_sq_pos" in below, below


def test_current_state_uses_aggregation_not_window(spark, q):
    p = _plan(q["current_state"](spark, SF01))
    assert "Window" not in p and "partial_max(struct(" in p


def test_hot_key_of_the_baseline_join_is_split(spark):
    """A key with a third of the rows, no broadcast: the join reads its partition in several parts."""
    from pyspark.sql import functions as F
    from strata.operators import series

    old = {}
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64k",
            "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5", "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64k", "spark.sql.shuffle.partitions": "16"}
    for k, v in conf.items():
        old[k] = spark.conf.get(k, None)
        spark.conf.set(k, v)
    try:
        ev = spark.range(0, 200_000, 1, 8).select(F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") % 997).alias("k"), F.rand(1).alias("v"), F.sha2(F.col("id").cast("string"), 256).alias("pad"))
        out = series.zscore_spikes(ev, "k", "v", threshold=1.5)
        out.write.format("noop").mode("overwrite").save()
        rows = out.collect()
        plan = _plan(out)
        assert rows and "SortMergeJoin(skew=true)" in plan, plan
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
