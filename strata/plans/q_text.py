"""Catalog entries for term frequencies and top-N (AG3, AG4, AG10, TK3)."""

from __future__ import annotations

from pyspark.sql import functions as F

from strata.functions.text import TOPIC_STOPWORDS
from strata.operators import terms
from strata.plans.catalog import register
from strata.sources.tables import table

_STOP_SQL = ", ".join(f"'{w}'" for w in TOPIC_STOPWORDS)

_TOPIC_WORDS_SQL = f"""
    SELECT source, word FROM (
        SELECT source, unnest(string_split(lower(regexp_replace(text, '[^a-zA-Z0-9 ]', '', 'g')), ' ')) AS word
        FROM documents WHERE text IS NOT NULL)
    WHERE regexp_matches(word, '^[a-z]{{4,}}') AND word NOT IN ({_STOP_SQL})
"""


def _topic_frequency(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("text", "source")
    return terms.topic_frequency(docs, "text", by=["source"])


@register(
    "topic_frequency",
    sql=f"SELECT word, source, count(*) AS frequency FROM ({_TOPIC_WORDS_SQL}) GROUP BY word, source",
)
def topic_frequency(spark, sf_dir):
    return _topic_frequency(spark, sf_dir)


@register(
    "topics_top15",
    sql=f"""
    SELECT word, max(frequency) AS frequency FROM (
        SELECT word, source, count(*) AS frequency FROM ({_TOPIC_WORDS_SQL}) GROUP BY word, source)
    GROUP BY word ORDER BY frequency DESC, word LIMIT 15
    """,
)
def topics_top15(spark, sf_dir):
    return terms.top_terms_over_groups(_topic_frequency(spark, sf_dir), 15)


@register(
    "word_frequency_top15",
    sql="""
    SELECT word, count(*) AS count FROM (
        SELECT unnest(string_split(lower(text), ' ')) AS word FROM documents WHERE text IS NOT NULL)
    WHERE length(word) > 3 GROUP BY word ORDER BY count DESC, word LIMIT 15
    """,
)
def word_frequency_top15(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("text")
    freq = terms.word_frequency(docs, "text")
    return terms.top_n(freq, 15, [F.desc("count"), F.asc("word")])


@register(
    "terms_per_hour",
    sql="""
    SELECT date_trunc('hour', ts) AS period, event_type AS term, count(*) AS count
    FROM events GROUP BY ALL
    """,
)
def terms_per_hour(spark, sf_dir):
    ev = table(spark, sf_dir, "events").select("ts", "event_type")
    return terms.terms_per_period(ev, "ts", "event_type", "hour")


@register(
    "terms_per_hour_sorted",
    sql="""
    SELECT CAST(hour(ts) AS INTEGER) AS hour, event_type AS term, count(*) AS count
    FROM events GROUP BY ALL ORDER BY hour ASC, count DESC, term
    """,
)
def terms_per_hour_sorted(spark, sf_dir):
    ev = table(spark, sf_dir, "events").select("ts", "event_type")
    out = ev.groupBy(F.hour("ts").alias("hour"), F.col("event_type").alias("term")).agg(
        F.count(F.lit(1)).alias("count")
    )
    return out.orderBy(F.asc("hour"), F.desc("count"), F.asc("term"))


@register(
    "term_velocity_2h",
    sql="""
    WITH n AS (SELECT max(ts) AS now FROM events)
    SELECT event_type AS term,
           count(*) FILTER (WHERE ts > now - INTERVAL 2 HOUR AND ts <= now) AS recent,
           count(*) FILTER (WHERE ts > now - INTERVAL 4 HOUR AND ts <= now - INTERVAL 2 HOUR) AS previous,
           recent - previous AS velocity
    FROM events, n WHERE ts > now - INTERVAL 4 HOUR GROUP BY event_type
    """,
)
def term_velocity_2h(spark, sf_dir):
    ev = table(spark, sf_dir, "events").select("ts", "event_type")
    return terms.term_velocity(ev, "ts", "event_type", hours=2)


@register(
    "emerging_terms",
    sql="""
    WITH n AS (SELECT max(ts) AS now FROM events),
    f AS (SELECT user_id AS term, min(ts) AS first_seen, count(*) AS occurrences FROM events GROUP BY user_id)
    SELECT term, first_seen, occurrences FROM f, n WHERE first_seen > now - INTERVAL 696 HOUR
    """,
)
def emerging_terms(spark, sf_dir):
    # Horizon 29 days: the test series starts every entity within its first two
    # days, so shorter horizons are empty on it (parameter, not a row cap).
    ev = table(spark, sf_dir, "events").select("ts", "user_id")
    return terms.emerging_terms(ev, "ts", "user_id", horizon_hours=696)
