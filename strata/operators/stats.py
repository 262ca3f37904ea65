"""Distributions, per-key statistics and one-row summaries (AG1/2/6-9/12/14-17/20).

Every aggregate here is algebraic (count, sum, avg, min, max, stddev, count_if,
max_by/min_by), so Spark computes a partial aggregate per task before the
shuffle and a key holding a third of the rows costs one row per task, not one
task. Nothing is collected to the driver; a one-row summary is a DataFrame.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# --- fixed values: must equal the reference for equal results -----------------
# Comfort bands of the simplified heat index, upper bounds exclusive, in order;
# values at or above the last bound fall in the last label.
HEAT_BAND_BOUNDS = (27, 32, 41)
HEAT_BAND_LABELS = ("Nyaman", "Perlu Hati-hati", "Berbahaya", "Sangat Berbahaya")
# Simplified heat index: -8.78 + 1.61*T + 2.34*RH - 0.146*T*RH
HEAT_INDEX_COEFFS = (-8.78, 1.61, 2.34, -0.146)
# -------------------------------------------------------------------------------


def distribution(df: DataFrame, key: str, alias: str = "count", drop_null: bool = True) -> DataFrame:
    """AG1 / AG9 / AG20: rows per category (nulls excluded unless asked)."""
    src = df.filter(F.col(key).isNotNull()) if drop_null else df
    return src.groupBy(key).agg(F.count(F.lit(1)).alias(alias))


def category_stats(df: DataFrame, key: str, measure: str, names=("total", "avg", "max")) -> DataFrame:
    """AG2: ``count(*)``, ``avg`` and ``max`` of a measure per category; null is a class."""
    n, a, m = names
    return df.groupBy(key).agg(
        F.count(F.lit(1)).alias(n), F.avg(measure).alias(a), F.max(measure).alias(m)
    )


def key_statistics(df: DataFrame, key: str, measure: str) -> DataFrame:
    """AG12: mean, sample stddev, min, max, count per key."""
    return df.groupBy(key).agg(
        F.count(F.col(measure)).alias("n"),
        F.avg(measure).alias("mean"),
        F.stddev_samp(measure).alias("stddev"),
        F.min(measure).alias("min"),
        F.max(measure).alias("max"),
    )


def histograms(df: DataFrame, dims: Sequence[str]) -> DataFrame:
    """AG9: several one-dimension histograms as one long table (dimension, value, count).

    One ``groupBy`` over an ``explode`` of (dimension, value) pairs: one scan,
    one shuffle, instead of one job per dimension.
    """
    pairs = F.explode(
        F.array(*[F.struct(F.lit(d).alias("dimension"), F.col(d).cast("string").alias("value")) for d in dims])
    )
    return (
        df.select(pairs.alias("p"))
        .groupBy("p.dimension", "p.value")
        .agg(F.count(F.lit(1)).alias("count"))
    )


def dedup_effect(df: DataFrame, key: str, digest: bool = True) -> DataFrame:
    """AG8: rows before and after de-duplication on ``key`` (null counts once).

    With ``digest`` the distinct count runs over SHA-256 digests of the key: the
    shuffle then moves 32 bytes per distinct value instead of whole texts (up to
    hundreds of KB each); a collision is cryptographically negligible.
    """
    k = F.sha2(F.col(key).cast("string"), 256) if digest else F.col(key)
    return df.agg(
        F.count(F.lit(1)).alias("rows_before"),
        (F.count_distinct(k) + F.max(F.when(F.col(key).isNull(), 1).otherwise(0))).alias("rows_after"),
    ).withColumn("duplicates_removed", F.col("rows_before") - F.col("rows_after"))


def summary_row(df: DataFrame, key: str, category: str, measure: str, articles: DataFrame | None = None) -> DataFrame:
    """AG6/AG7: total entities, highest measure, top category, categories, article count.

    ``df`` is a current-state table (one row per ``key``).
    Two-level aggregation: counts per category first (partial aggregation), then
    one tiny global aggregate. The top category breaks count ties by name.
    ``articles`` is the list of latest articles (its reader limits it); its rows are counted.
    ``last_updated`` is the time at which the row is made.
    """
    per_cat = df.groupBy(category).agg(F.max(measure).alias("_max"), F.count(F.lit(1)).alias("_rows"))
    named = F.col(category).isNotNull()
    out = per_cat.agg(
        F.sum("_rows").alias("total_entities"),
        F.max("_max").alias("highest_measure"),
        F.min_by(F.col(category), F.when(named, F.struct(-F.col("_rows"), F.col(category))))
        .alias("top_category"),
        F.count(F.col(category)).alias("total_categories"),
    )
    if articles is not None:
        out = out.withColumn("total_articles", articles.select(F.count(F.lit(1))).scalar().cast("long"))
    return out.withColumn("last_updated", F.current_timestamp())


def hourly_means(df: DataFrame, ts: str, measure: str, change: str | None = None) -> DataFrame:
    """AG14: mean measure per hour of day, and mean absolute change if given."""
    aggs = [F.avg(measure).alias("mean_value")]
    if change:
        aggs.append(F.avg(F.abs(F.col(change))).alias("mean_abs_change"))
    return df.groupBy(F.hour(ts).alias("hour")).agg(*aggs)


def extreme_counts(df: DataFrame, key: str, condition: Column) -> DataFrame:
    """AG15: per key, rows meeting an extreme condition and all rows."""
    return df.groupBy(key).agg(
        F.count_if(condition).alias("extreme_count"), F.count(F.lit(1)).alias("total_count")
    )


def heat_index(t: Column, rh: Column) -> Column:
    c0, c1, c2, c3 = HEAT_INDEX_COEFFS
    return F.lit(c0) + F.lit(c1) * t + F.lit(c2) * rh + F.lit(c3) * t * rh


def band(value: Column, bounds=HEAT_BAND_BOUNDS, labels=HEAT_BAND_LABELS) -> Column:
    """PRJ15: CASE banding with bounds and labels given as data."""
    expr = None
    for b, lab in zip(bounds, labels):
        expr = F.when(value < b, lab) if expr is None else expr.when(value < b, lab)
    return expr.otherwise(labels[len(bounds)])


def band_distribution(df: DataFrame, key: str, value: Column) -> DataFrame:
    """AG16: rows per (key, band)."""
    return df.groupBy(F.col(key), band(value).alias("band")).agg(F.count(F.lit(1)).alias("count"))


def risk_score(df: DataFrame, key: str, measure: str, condition: Column) -> DataFrame:
    """AG17: frequency x mean x (1 + share of rows meeting ``condition``)."""
    out = df.groupBy(key).agg(
        F.count(F.lit(1)).alias("frequency"),
        F.avg(measure).alias("avg_measure"),
        (F.count_if(condition) / F.count(F.lit(1))).alias("conditional_share"),
    )
    return out.withColumn(
        "risk_score", F.col("frequency") * F.col("avg_measure") * (1 + F.col("conditional_share"))
    )


def risk_adjusted(df: DataFrame, key: str, measure: str) -> DataFrame:
    """AG18: avg / sample stddev per key; a single row or constant key gives null."""
    out = df.groupBy(key).agg(F.avg(measure).alias("avg_measure"), F.stddev_samp(measure).alias("risk"))
    return out.withColumn("ratio", F.try_divide(F.col("avg_measure"), F.col("risk")))


def return_volatility(df: DataFrame, key: str, ts: str, tie: str, measure: str) -> DataFrame:
    """AG19: first/last by time (ties by ``tie``), return %, stddev per key."""
    order = F.struct(F.col(ts), F.col(tie))
    out = df.groupBy(key).agg(
        F.min_by(F.col(measure), order).alias("first_value"),
        F.max_by(F.col(measure), order).alias("last_value"),
        F.stddev_samp(measure).alias("volatility"),
        F.count(F.lit(1)).alias("observations"),
    )
    return out.withColumn(
        "return_pct",
        F.try_divide(F.col("last_value") - F.col("first_value"), F.col("first_value")) * 100,
    )


def mean_per_period(df: DataFrame, ts: str, measure: str, period: str = "month") -> DataFrame:
    """AG19: mean measure per truncated period."""
    return df.groupBy(F.date_trunc(period, F.col(ts)).cast("timestamp_ntz").alias("period")).agg(
        F.avg(measure).alias("mean_value"), F.count(F.lit(1)).alias("observations")
    )
