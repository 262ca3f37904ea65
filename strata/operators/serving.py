"""Serving views over Gold tables (PRJ14, PRJ16, AG7 Gold variant, AG10).

The page in the reference collects whole Gold tables to the driver and shapes
them in Python; here the shaping is a DataFrame transformation and only the
(small, bounded) served rows would ever leave the cluster.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.functions.text import short_text, title_case
from strata.operators.snapshots import NoVersion
from strata.operators.terms import top_terms_over_groups

# Fixed value: how a summary names its source.
GOLD_SOURCE = "Gold Layer"


def serve_languages(lang_dist: DataFrame, lower_col: str = "language_lower", count_col: str = "total",
                    avg_col: str = "avg", max_col: str = "max") -> DataFrame:
    """PRJ14: title-cased name (``Objective-C``, not ``Objective-c``), int count,
    average rounded to one decimal, max with 0 for missing."""
    return lang_dist.select(
        title_case(F.coalesce(F.col(lower_col), F.lit("Unknown"))).alias("language"),
        F.coalesce(F.col(count_col), F.lit(0)).cast("long").alias("count"),
        F.round(F.coalesce(F.col(avg_col).cast("double"), F.lit(0.0)), 1).alias("avg_value"),
        F.coalesce(F.col(max_col), F.lit(0)).cast("long").alias("max_value"),
    )


def serve_top(top: DataFrame, name: str = "full_name", measure: str = "stargazers_count",
              category: str = "language", url: str = "html_url", text: str = "description", source: str = "_source") -> DataFrame:
    """PRJ14: served top list with defaults, an 80-character description and the source."""
    return top.select(
        F.coalesce(F.col(name), F.lit("")).alias(name),
        F.coalesce(F.col(measure), F.lit(0)).cast("long").alias(measure),
        F.coalesce(F.col(category), F.lit("")).alias(category),
        F.coalesce(F.col(url), F.lit("#")).alias(url),
        short_text(text).alias("short_description"),
        F.coalesce(F.col(source), F.lit("")).alias(source),
    )


def serve_topics(topics: DataFrame, n: int = 15) -> DataFrame:
    """AG10: one row per word (max over sources), top ``n``."""
    return top_terms_over_groups(topics, n, "frequency")


def serve_velocity(velocity: DataFrame, key: str, n: int = 10, category: str = "language_lower") -> DataFrame:
    """PRJ14: top ``n`` entities by total gain (ties by key), with the title-cased category, ``Unknown`` for none."""
    top = velocity.orderBy(F.desc("total_gain"), F.asc(key)).limit(n)
    return top.select(
        key, title_case(F.coalesce(F.col(category), F.lit("Unknown"))).alias("language"),
        F.coalesce("current_value", F.lit(0)).alias("current_value"), F.coalesce("total_gain", F.lit(0)).alias("total_gain"),
    )


def serve_summary(lang_dist: DataFrame, top: DataFrame, category: str, count_col: str, measure: str) -> DataFrame:
    """AG7, Gold variant: total = sum of category counts, highest = top list max,
    top category by count (ties by name), number of categories, articles 0, the
    time at which the row is made and where the data came from."""
    cats = lang_dist.agg(
        F.sum(count_col).cast("long").alias("total_entities"),
        F.min_by(F.col(category), F.struct(-F.col(count_col), F.col(category))).alias("top_category"),
        F.count(F.lit(1)).alias("total_categories"),
    )
    highest = top.select(F.coalesce(F.max(measure), F.lit(0)).cast("long")).scalar()
    return cats.select(
        "total_entities", highest.alias("highest_measure"), "top_category", "total_categories",
        F.lit(0).cast("long").alias("total_articles"),
        F.current_timestamp().alias("last_updated"), F.lit(GOLD_SOURCE).alias("data_source"),
    )


def first_available(readers: Sequence[Callable[[], DataFrame | None]]) -> DataFrame | None:
    """PRJ16: the first reader that returns a non-empty DataFrame (Gold, else Clean).

    A reader without data returns None or finds no path or version; any other
    error is raised. ``isEmpty`` reads at most one row, so probing is cheap.
    """
    for read in readers:
        try:
            df = read()
            if df is not None and not df.isEmpty():
                return df
        except NoVersion:
            continue
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
    return None
