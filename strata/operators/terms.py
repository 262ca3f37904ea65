"""Term frequencies, top terms and time-based term dynamics (AG3/4/10/21, WN7/8).

Scale notes: ``explode`` is followed directly by a grouped count, so Spark runs a
partial (map-side) ``HashAggregate`` before the shuffle; a hot word such as
"the" is reduced to one row per task before it moves. Stop lists are small fixed
sets and become an ``InSet`` predicate, not a join. Top-N uses a total order and
``limit`` so Catalyst plans ``TakeOrderedAndProject`` (a bounded heap per task).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.functions.text import (
    TOPIC_STOPWORDS,
    TOPIC_WORD_PATTERN,
    tokens_compat,
    tokens_space,
)


def word_frequency(df: DataFrame, text: str, min_len: int = 4, alias: str = "count") -> DataFrame:
    """AG3: lower -> split on one space -> words longer than ``min_len - 1``."""
    words = (
        df.filter(F.col(text).isNotNull())
        .select(F.explode(tokens_space(text)).alias("word"))
        .filter(F.length("word") >= min_len)
    )
    return words.groupBy("word").agg(F.count(F.lit(1)).alias(alias))


def topic_frequency(
    df: DataFrame,
    text: str,
    by: Sequence[str] = (),
    stopwords: Sequence[str] = TOPIC_STOPWORDS,
    pattern: str = TOPIC_WORD_PATTERN,
    tokenizer=tokens_compat,
    alias: str = "frequency",
) -> DataFrame:
    """AG4: cleaned words matching ``pattern``, minus a stop list, counted per ``by``."""
    words = (
        df.filter(F.col(text).isNotNull())
        .select(*by, F.explode(tokenizer(text)).alias("word"))
    )
    if pattern == TOPIC_WORD_PATTERN:
        # Same rows: the pattern needs four characters; the cheap test runs first.
        words = words.filter((F.length("word") >= 4) & F.col("word").rlike(pattern))
    else:
        words = words.filter(F.col("word").rlike(pattern))
    if stopwords:
        words = words.filter(~F.col("word").isin(list(stopwords)))
    return words.groupBy("word", *by).agg(F.count(F.lit(1)).alias(alias))


def top_n(df: DataFrame, n: int, order: Sequence) -> DataFrame:
    """TK1-TK4: total order then limit -> ``TakeOrderedAndProject``."""
    return df.orderBy(*order).limit(n)


def top_terms_over_groups(freq: DataFrame, n: int = 15, value: str = "frequency") -> DataFrame:
    """AG10: per word the *max* over groups (not the sum), top ``n``, ties by word."""
    best = freq.groupBy("word").agg(F.max(value).alias(value))
    return top_n(best, n, [F.desc(value), F.asc("word")])


def terms_per_period(df: DataFrame, ts: str, term: str, period: str = "hour") -> DataFrame:
    """AG21: term counts per truncated period."""
    # date_trunc returns a session-zone timestamp; back to wall-clock ntz.
    return df.groupBy(
        F.date_trunc(period, F.col(ts)).cast("timestamp_ntz").alias("period"), F.col(term).alias("term")
    ).agg(F.count(F.lit(1)).alias("count"))


def term_velocity(df: DataFrame, ts: str, term: str, hours: int = 2) -> DataFrame:
    """WN7: counts in ``(now-h, now]`` and ``(now-2h, now-h]`` per term, and their change.

    ``now`` is the input's own ``max(ts)`` (a scalar subquery, computed once), so
    the result is reproducible. Both windows are conditional sums of one grouped
    pass; no dense hour grid and no join are needed.
    """
    now = df.select(F.max(ts)).scalar()
    h = F.make_dt_interval(F.lit(0), F.lit(hours))
    t = F.col(ts)
    recent = (t > now - h) & (t <= now)
    previous = (t > now - h - h) & (t <= now - h)
    out = (
        df.filter(t > now - h - h)
        .groupBy(F.col(term).alias("term"))
        .agg(
            F.count_if(recent).alias("recent"),
            F.count_if(previous).alias("previous"),
        )
    )
    return out.withColumn("velocity", F.col("recent") - F.col("previous"))


def emerging_terms(df: DataFrame, ts: str, term: str, horizon_hours: int = 3) -> DataFrame:
    """WN8: terms first seen within ``(now - horizon, now]`` and never before."""
    now = df.select(F.max(ts)).scalar()
    first = df.groupBy(F.col(term).alias("term")).agg(
        F.min(ts).alias("first_seen"), F.count(F.lit(1)).alias("occurrences")
    )
    return first.filter(F.col("first_seen") > now - F.make_dt_interval(F.lit(0), F.lit(horizon_hours)))
