"""Change, velocity, trend and anomaly operators over ``(entity, time, measure)`` series.

WN1-WN6 and AG5/AG13. Every "previous observation" comes from
``sequence.ordered_scan``: entities holding more than ``1/P`` of the rows are
range-sliced, all others use a plain per-entity window, so no entity ever lands
in one task with a third of the data. The order is ``(ts, tie)``: ``tie`` is a
unique id, so results are deterministic.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.operators.sequence import ordered_scan
from strata.session import pinned


def with_previous(df: DataFrame, key: str, ts: str, tie: str, measure: str, k: int = 1,
                  name: str = "prev_value", by=()) -> DataFrame:
    """WN1 building block: ``name`` = measure ``k`` observations earlier (per key and ``by``)."""
    return ordered_scan(df, [key, *by], [ts, tie], lags={name: (measure, k)})


def velocity(df: DataFrame, key: str, ts: str, tie: str, measure: str, carry=(), by=()) -> DataFrame:
    """WN1 + AG5: gain between consecutive observations per entity.

    Rows without a previous observation are dropped (as the Gold table does),
    then per entity: max measure, total gain, mean gain, observations.
    Runs on the observation *history*: on a one-row-per-entity current table it
    is empty by construction. ``by`` splits the series further (e.g. per source,
    whose measures must not be mixed).
    """
    prev = with_previous(df, key, ts, tie, measure, by=by)
    gains = prev.filter(F.col("prev_value").isNotNull()).withColumn(
        "gain", F.col(measure) - F.col("prev_value")
    )
    return gains.groupBy(key, *by, *carry).agg(
        F.max(measure).alias("current_value"),
        F.sum("gain").alias("total_gain"),
        F.avg("gain").alias("avg_gain"),
        F.count(F.lit(1)).alias("observation_count"),
    )


def velocity_dict_agg(df: DataFrame, key: str, ts: str, tie: str, measure: str) -> DataFrame:
    """AG22: the keep-first-rows variant with generated ``sum(gain)`` / ``max(x)`` names."""
    prev = with_previous(df, key, ts, tie, measure)
    gains = prev.withColumn("gain", F.col(measure) - F.col("prev_value"))
    return gains.groupBy(key).agg({"gain": "sum", measure: "max"})


def trend_counts(df: DataFrame, key: str, ts: str, tie: str, measure: str, threshold: float = 5.0,
                 labels=("rising", "falling", "stable")) -> DataFrame:
    """WN2: change > t / < -t / else per step, counted per entity.

    First observations (null change) land in the "stable" class, as in the
    specification's ``otherwise``.
    """
    up, down, flat = labels
    prev = with_previous(df, key, ts, tie, measure)
    change = F.col(measure) - F.col("prev_value")
    trend = F.when(change > threshold, up).when(change < -threshold, down).otherwise(flat)
    return prev.groupBy(F.col(key), trend.alias("trend")).agg(F.count(F.lit(1)).alias("count"))


def pct_change_alerts(df: DataFrame, key: str, ts: str, tie: str, measure: str, threshold: float = 5.0,
                      labels=("rise", "drop", "normal")) -> DataFrame:
    """WN3: percent change vs the previous observation; non-normal rows kept.

    A previous value of 0 gives a null change (``try_divide``), hence "normal".
    """
    up, down, normal = labels
    prev = with_previous(df, key, ts, tie, measure)
    pct = F.try_divide(F.col(measure) - F.col("prev_value"), F.col("prev_value")) * 100
    out = prev.withColumn("pct_change", pct).withColumn(
        "alert", F.when(F.col("pct_change") > threshold, up).when(F.col("pct_change") < -threshold, down)
        .otherwise(normal)
    )
    return out.filter(F.col("alert") != normal)


def rise_over(df: DataFrame, key: str, ts: str, tie: str, measure: str, n: int = 3,
              min_rise: float = 0.05) -> DataFrame:
    """WN4: rise over the last ``n`` observations above ``min_rise``; short prefixes dropped."""
    prev = with_previous(df, key, ts, tie, measure, k=n, name="value_n_back")
    rise = F.try_divide(F.col(measure) - F.col("value_n_back"), F.col("value_n_back"))
    return prev.withColumn("rise", rise).filter(F.col("rise") > min_rise)


def longest_run(df: DataFrame, key: str, ts: str, tie: str, bad: Column) -> DataFrame:
    """WN5: longest run of consecutive ``bad`` observations per entity (0 if none).

    Gaps and islands with a running count instead of two row numbers: every
    non-bad row (a null condition counts as non-bad and breaks the run) opens a
    group; the run following it is the number of bad rows in that group. The
    running count is skew-proof and the final step is a partial aggregation.
    """
    flagged = df.select(key, ts, tie, F.coalesce(bad, F.lit(False)).cast("int").alias("_bad"))
    scanned = ordered_scan(flagged, [key], [ts, tie], running={"_grp": 1 - F.col("_bad")})
    runs = scanned.groupBy(key, "_grp").agg(F.sum("_bad").alias("run"))
    return runs.groupBy(key).agg(F.max("run").cast("long").alias("longest_run"))


def rolling_mean(df: DataFrame, key: str, ts: str, tie: str, measure: str, n: int = 3) -> DataFrame:
    """WN6: mean of the current and ``n-1`` previous observations (shorter at start).

    Equal to ``avg(x) OVER (... ROWS BETWEEN n-1 PRECEDING AND CURRENT ROW)``:
    nulls are skipped in both the sum and the count.
    """
    lagged = ordered_scan(df, [key], [ts, tie], lags={f"_rm{k}": (measure, k) for k in range(1, n)})
    vals = [F.col(measure)] + [F.col(f"_rm{k}") for k in range(1, n)]
    total = sum((F.coalesce(v, F.lit(0.0)) for v in vals), F.lit(0.0))
    cnt = sum((v.isNotNull().cast("int") for v in vals), F.lit(0))
    out = lagged.withColumn("rolling_mean", F.try_divide(total, cnt))
    return out.drop(*[f"_rm{k}" for k in range(1, n)])


def zscore_spikes(df: DataFrame, key: str, measure: str, threshold: float = 2.0) -> DataFrame:
    """JN1 + AG13: rows whose |z| against their key's baseline exceeds ``threshold``.

    The baseline is a partial aggregation (one row per key), written to the
    checkpoint folder and joined back on the key. AQE broadcasts it when its
    measured size allows and otherwise sort-merges; because it comes from storage
    and not from an aggregate above the shuffle, AQE can split the partition of a
    hot key. A stddev of null or 0 gives null z.
    """
    base = pinned(df.groupBy(key).agg(F.avg(measure).alias("mean_value"), F.stddev_samp(measure).alias("std_value")))
    z = F.try_divide(F.col(measure) - F.col("mean_value"), F.col("std_value"))
    return df.join(base, key).withColumn("z_score", z).filter(F.abs(F.col("z_score")) > threshold)


def change_by_hour(df: DataFrame, key: str, ts: str, tie: str, measure: str) -> DataFrame:
    """AG14 input: per row the change against the previous observation."""
    prev = with_previous(df, key, ts, tie, measure)
    return prev.withColumn("change", F.col(measure) - F.col("prev_value"))
