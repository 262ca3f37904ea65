"""Catalog entries: joins (JN2-JN7)."""

from __future__ import annotations

from pyspark.sql import functions as F

from strata.operators import joins, series, terms
from strata.functions.text import tokens_words
from strata.plans.catalog import register
from strata.sources.tables import table


def _events(spark, sf_dir):
    return table(spark, sf_dir, "events").select("event_id", "ts", "user_id", "event_type", "value")


def _range_sql(anchor_where, event_where, lo, hi, extra_cols="", extra_on="", name="match_count", having=""):
    return f"""
        SELECT a.event_id, a.ts{extra_cols}, count(e.event_id) AS {name}
        FROM (SELECT * FROM events WHERE {anchor_where}) a
        LEFT JOIN (SELECT * FROM events WHERE {event_where}) e
          ON e.ts >= a.ts - INTERVAL {lo} SECOND AND e.ts <= a.ts + INTERVAL {hi} SECOND {extra_on}
        GROUP BY ALL {having}"""


@register(
    "near_events_1h",
    sql=_range_sql("event_type = 'error'", "event_type = 'click'", 3600, 3600, name="near_count"),
)
def near_events_1h(spark, sf_dir):
    """JN3: per spike-like anchor (errors), events of another stream (clicks) within +-1 h; 0 kept."""
    ev = _events(spark, sf_dir)
    anchors = ev.filter(F.col("event_type") == "error").select("event_id", "ts")
    news = ev.filter(F.col("event_type") == "click").select("event_id", "ts")
    return joins.range_count(anchors, news, "ts", "ts", 3600, 3600, name="near_count")


@register(
    "extreme_news_1h",
    sql=_range_sql("value > 150", "event_type = 'view'", 3600, 3600, extra_cols=", a.value", name="news_count"),
)
def extreme_news_1h(spark, sf_dir):
    """JN6: extreme-condition rows with the count of 'news' rows within +-1 h."""
    ev = _events(spark, sf_dir)
    anchors = ev.filter(F.col("value") > 150).select("event_id", "ts", "value")
    news = ev.filter(F.col("event_type") == "view").select("event_id", "ts")
    return joins.range_count(anchors, news, "ts", "ts", 3600, 3600, name="news_count")


@register(
    "following_2h",
    sql=_range_sql("value > 200", "event_type = 'view'", 0, 7200, extra_cols=", a.value", name="following_count"),
)
def following_2h(spark, sf_dir):
    """JN4: significant rows (measure above a threshold) and the count in the following 2 h."""
    ev = _events(spark, sf_dir)
    anchors = ev.filter(F.col("value") > 200).select("event_id", "ts", "value")
    news = ev.filter(F.col("event_type") == "view").select("event_id", "ts")
    return joins.range_count(anchors, news, "ts", "ts", 0, 7200, name="following_count")


@register(
    "shared_terms_near_in_time",
    sql=_range_sql(
        "event_type = 'click'", "event_type = 'view'", 1800, 1800, extra_cols=", a.user_id",
        extra_on="AND e.user_id = a.user_id", name="near_count", having="HAVING count(e.event_id) > 0",
    ),
)
def shared_terms_near_in_time(spark, sf_dir):
    """JN7: the same entity in both streams within +-30 min (equi key + time range)."""
    ev = _events(spark, sf_dir)
    a = ev.filter(F.col("event_type") == "click").select("event_id", "ts", "user_id")
    b = ev.filter(F.col("event_type") == "view").select("event_id", "ts", "user_id")
    out = joins.range_count(a, b, "ts", "ts", 1800, 1800, keys=["user_id"], name="near_count")
    return out.filter(F.col("near_count") > 0)


_SIDES_SQL = """
    WITH e AS (SELECT user_id || '@' || strftime(ts, '%Y-%m-%d') AS entity, event_type FROM events),
         l AS (SELECT entity, count(*) AS left_count FROM e WHERE event_type IN ('click', 'view') GROUP BY entity),
         r AS (SELECT entity, count(*) AS right_count FROM e WHERE event_type NOT IN ('click', 'view') GROUP BY entity)
"""


def _sides(spark, sf_dir):
    """Two sources out of all events: the entity is a user's day."""
    ev = _events(spark, sf_dir)
    ev = ev.withColumn("entity", F.concat_ws("@", F.col("user_id").cast("string"), F.date_format("ts", "yyyy-MM-dd")))
    own = F.col("event_type").isin("click", "view")
    left = joins.entity_counts(ev.filter(own), "entity", "left_count")
    right = joins.entity_counts(ev.filter(~own), "entity", "right_count")
    return left, right


@register("cross_source_inner", sql=_SIDES_SQL + "SELECT entity, left_count, right_count FROM l JOIN r USING (entity)")
def cross_source_inner(spark, sf_dir):
    """JN2 inner: entities in both sources, with their per-source counts."""
    left, right = _sides(spark, sf_dir)
    return joins.cross_source(left, right, "entity", "inner")


@register(
    "cross_source_only_left",
    sql=_SIDES_SQL + "SELECT entity, left_count FROM l WHERE entity NOT IN (SELECT entity FROM r)",
)
def cross_source_only_left(spark, sf_dir):
    """JN2 anti: entities only the left source has seen."""
    left, right = _sides(spark, sf_dir)
    return joins.cross_source(left, right, "entity", "left_anti")


_MENTION_SQL = """
    WITH v AS (SELECT DISTINCT t AS word FROM (
                 SELECT unnest(regexp_extract_all(lower(text), '([\\p{L}\\p{N}]+)', 1)) AS t FROM benchmark)),
         w AS (SELECT source, t AS word FROM (
                 SELECT source, unnest(regexp_extract_all(lower(text), '([\\p{L}\\p{N}]+)', 1)) AS t FROM documents)),
         m AS (SELECT source, count(*) AS mentions, count(DISTINCT w.word) AS distinct_terms FROM w JOIN v ON w.word = v.word GROUP BY source),
         s AS (SELECT source, avg(n_chars) AS avg_n_chars FROM documents GROUP BY source)
"""


@register(
    "mentions_vs_measure",
    sql=_MENTION_SQL + "SELECT s.source, m.mentions, m.distinct_terms, round(s.avg_n_chars, 6) AS avg_n_chars FROM s JOIN m ON s.source = m.source",
)
def mentions_vs_measure(spark, sf_dir):
    """JN5: benchmark-vocabulary mentions per source next to the source's mean measure."""
    return _mentions(spark, sf_dir)


def _mention_parts(spark, sf_dir):
    """(mentions per source, mean measure per source)."""
    raw = table(spark, sf_dir, "documents")
    texts = raw.select("source", "text")
    vocab = joins.vocabulary(table(spark, sf_dir, "benchmark").select("text"), "text")
    m = joins.term_mentions(texts, "text", "source", vocab, "term")
    s = raw.select("source", "n_chars").groupBy("source").agg(F.avg("n_chars").alias("avg_n_chars"))
    return m, s


def _mentions(spark, sf_dir):
    m, s = _mention_parts(spark, sf_dir)
    return s.join(m, "source").select(
        "source", "mentions", "distinct_terms", F.round("avg_n_chars", 6).alias("avg_n_chars")
    )


@register(
    "mention_correlation",
    sql=_MENTION_SQL + "SELECT round(corr(m.mentions, s.avg_n_chars), 6) AS correlation, count(*) AS groups FROM s JOIN m ON s.source = m.source",
)
def mention_correlation(spark, sf_dir):
    """JN5: correlation of mentions and the mean measure over groups lacking neither."""
    m, s = _mention_parts(spark, sf_dir)
    j = s.join(m, "source")
    return j.agg(
        F.round(F.corr(F.col("mentions").cast("double"), F.col("avg_n_chars")), 6).alias("correlation"),
        F.count(F.lit(1)).alias("groups"),
    )


_SPIKES_SQL = """
    WITH b AS (SELECT user_id, avg(value) AS m, stddev_samp(value) AS s FROM events GROUP BY user_id),
         a AS (SELECT e.event_id, e.ts, e.user_id FROM events e JOIN b USING (user_id) WHERE s <> 0 AND abs((e.value - m) / s) > 2)
    SELECT a.event_id, a.ts, a.user_id, count(n.event_id) AS news_count
    FROM a LEFT JOIN (SELECT * FROM events WHERE event_type = 'view') n
      ON n.ts >= a.ts - INTERVAL 3600 SECOND AND n.ts <= a.ts + INTERVAL 3600 SECOND GROUP BY ALL"""


@register("spike_news_1h", sql=_SPIKES_SQL)
def spike_news_1h(spark, sf_dir):
    """JN3 with AG13: z-score spikes as anchors, the news within +-1 h of each."""
    ev = _events(spark, sf_dir)
    spikes = series.zscore_spikes(ev.select("event_id", "ts", "user_id", "value"), "user_id", "value")
    news = ev.filter(F.col("event_type") == "view").select("ts")
    return joins.range_count(spikes.select("event_id", "ts", "user_id"), news, "ts", "ts", 3600, 3600, name="news_count")


_REPEATED_SQL = """
    WITH a AS (SELECT 'u' || user_id AS name, CASE WHEN user_id % 7 <> 0 THEN date_trunc('hour', ts) END AS noted FROM events),
         e AS (SELECT CASE WHEN user_id % 5 <> 0 THEN 'u' || user_id END AS name, CASE WHEN user_id % 11 <> 0 THEN ts END AS noted FROM events),
         d AS (SELECT DISTINCT name, noted FROM a),
         c AS (SELECT d.name, d.noted, count(e.noted) AS n FROM d JOIN e ON e.name = d.name AND e.noted >= d.noted AND e.noted <= d.noted + INTERVAL 7200 SECOND GROUP BY ALL)
    SELECT a.name, a.noted, coalesce(c.n, 0) AS following_count FROM a LEFT JOIN c ON a.name = c.name AND a.noted = c.noted"""


@register("following_repeated_anchors", sql=_REPEATED_SQL)
def following_repeated_anchors(spark, sf_dir):
    """JN4 with text keys, repeated anchors, and anchors and events without time or key."""
    ev = _events(spark, sf_dir)
    name = F.concat(F.lit("u"), F.col("user_id").cast("string"))
    anchors = ev.select(name.alias("name"), F.when(F.col("user_id") % 7 != 0, F.date_trunc("hour", "ts").cast("timestamp_ntz")).alias("noted"))
    events = ev.select(F.when(F.col("user_id") % 5 != 0, name).alias("name"), F.when(F.col("user_id") % 11 != 0, F.col("ts")).alias("noted"))
    return joins.range_count(anchors, events, "noted", "noted", 0, 7200, keys=["name"], name="following_count")


#: The documents carry no time; theirs is derived from doc_id, the same in both engines: 977 seconds apart from the start of the events' month.
_DOC_TS_SQL = "TIMESTAMP '2024-01-01' + INTERVAL (doc_id * 977 % 2592000) SECOND"
_WORDS_SQL = "unnest(regexp_extract_all(lower(text), '([\\p{L}\\p{N}]+)', 1))"


def _timed_documents(spark, sf_dir):
    seconds = F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), (F.col("doc_id") * 977 % 2592000).cast("int"))
    d = table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    return d.withColumn("ts", F.lit("2024-01-01 00:00:00").cast("timestamp_ntz") + seconds)


@register(
    "hourly_mention_correlation",
    sql=f"""
    WITH v AS (SELECT DISTINCT {_WORDS_SQL} AS word FROM benchmark),
         w AS (SELECT date_trunc('hour', {_DOC_TS_SQL}) AS hour, {_WORDS_SQL} AS word FROM documents),
         m AS (SELECT hour, count(*) AS mentions FROM w JOIN v USING (word) GROUP BY hour),
         p AS (SELECT date_trunc('hour', ts) AS hour, avg(value) AS mean_value FROM events GROUP BY 1)
    SELECT round(corr(mentions, mean_value), 6) AS correlation, count(*) AS hours FROM m JOIN p USING (hour)""",
)
def hourly_mention_correlation(spark, sf_dir):
    """JN5: mentions per hour in the documents against the hourly mean of the events' measure."""
    docs = _timed_documents(spark, sf_dir).withColumn("hour", F.date_trunc("hour", "ts").cast("timestamp_ntz"))
    vocab = joins.vocabulary(table(spark, sf_dir, "benchmark").select("text"), "text")
    mentions = joins.term_mentions(docs.select("hour", "text"), "text", "hour", vocab, "term")
    measures = _events(spark, sf_dir).groupBy(F.date_trunc("hour", "ts").cast("timestamp_ntz").alias("hour")).agg(F.avg("value").alias("mean_value"))
    return joins.hourly_mentions_vs_measure(mentions, measures).withColumn("correlation", F.round("correlation", 6))


@register(
    "words_near_in_time",
    sql=f"""
    WITH w AS (SELECT {_DOC_TS_SQL} AS ts, source IN ('src0', 'src1', 'src2', 'src3', 'src4') AS own, {_WORDS_SQL} AS word FROM documents),
         l AS (SELECT word, ts, count(*) AS left_count FROM w WHERE own GROUP BY ALL),
         r AS (SELECT word, ts, count(*) AS n FROM w WHERE NOT own GROUP BY ALL)
    SELECT l.word, l.ts, l.left_count, sum(r.n)::BIGINT AS near_count FROM l JOIN r ON l.word = r.word
      AND r.ts >= l.ts - INTERVAL 1800 SECOND AND r.ts <= l.ts + INTERVAL 1800 SECOND GROUP BY ALL""",
)
def words_near_in_time(spark, sf_dir):
    """JN7: the same word in two groups of sources within +-30 minutes."""
    docs = _timed_documents(spark, sf_dir)
    own = F.col("source").isin("src0", "src1", "src2", "src3", "src4")
    return joins.words_near_in_time(docs.filter(own), docs.filter(~own), "text", "ts", 1800)


@register(
    "words_per_hour",
    sql=f"""SELECT date_trunc('hour', ts) AS period, word AS term, count(*) AS count
            FROM (SELECT {_DOC_TS_SQL} AS ts, {_WORDS_SQL} AS word FROM documents) GROUP BY ALL""",
)
def words_per_hour(spark, sf_dir):
    """AG21 from text: words per hour."""
    words = _timed_documents(spark, sf_dir).select("ts", F.explode(tokens_words("text")).alias("word"))
    return terms.terms_per_period(words, "ts", "word")


@register(
    "following_rows_2h",
    sql="""SELECT a.event_id AS alert_id, a.ts AS alert_ts, b.event_id AS article_id, b.ts AS article_ts, b.value AS article_value
           FROM events a JOIN events b ON b.ts >= a.ts AND b.ts <= a.ts + INTERVAL 7200 SECOND
           WHERE a.event_type = 'error' AND b.event_type = 'purchase'""",
)
def following_rows_2h(spark, sf_dir):
    """JN4: the rows themselves that follow each alert within two hours."""
    side = lambda kind, name: _events(spark, sf_dir).filter(F.col("event_type") == kind).select(
        F.col("event_id").alias(f"{name}_id"), F.col("ts").alias(f"{name}_ts"), F.col("value").alias(f"{name}_value")
    )
    alerts = side("error", "alert").drop("alert_value")
    return joins.range_join(alerts, side("purchase", "article"), "alert_ts", "article_ts", 0, 7200)


# Names of two and three words: the openings of all documents, so that many overlap and share first words.
_PHRASES_SQL = r"""
    WITH d AS (SELECT doc_id, source, regexp_extract_all(lower(text), '[\p{L}\p{N}]+') AS ws FROM documents),
         n AS (SELECT DISTINCT array_to_string(ws[1:k], ' ') AS name, k AS n FROM d, (VALUES (2), (3)) AS v(k) WHERE len(ws) >= k),
         w AS (SELECT doc_id, source, ws, unnest(range(len(ws))) AS pos FROM d),
         h AS (SELECT doc_id, source, pos, v.k AS n, array_to_string(ws[pos + 1:pos + v.k], ' ') AS name FROM w, (VALUES (2), (3)) AS v(k) WHERE pos + v.k <= len(ws)),
         m AS (SELECT h.* FROM h JOIN n USING (name, n)),
         k AS (SELECT *, max(pos + n) OVER (PARTITION BY doc_id ORDER BY pos, n DESC ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS before FROM m)
    SELECT source, name, count(*) AS mentions, count(DISTINCT doc_id) AS documents FROM k WHERE before IS NULL OR pos + n > before GROUP BY source, name
"""


@register("phrase_mentions", sql=_PHRASES_SQL)
def phrase_mentions(spark, sf_dir):
    """JN5: names of several words mentioned per source, the longest name at each place."""
    raw = table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    # Only the first three words are looked for, from the text's beginning, and by a generator, which finds them once a text and not once a use.
    opening = F.regexp_extract(F.lower("text"), r"^(?:[^\p{L}\p{N}]*+[\p{L}\p{N}]++){1,3}", 0)
    first = raw.select(F.explode(F.array(F.regexp_extract_all(opening, F.lit(r"([\p{L}\p{N}]+)"), 1))).alias("ws"))
    names = first.select(F.explode(F.array(*[F.when(F.size("ws") >= k, F.array_join(F.slice("ws", 1, k), " ")) for k in (2, 3)])).alias("name"))
    found = joins.phrase_mentions(raw, "text", names.filter("name IS NOT NULL").distinct(), "name", ["doc_id", "source"])
    return found.groupBy("source", "name").agg(F.count(F.lit(1)).alias("mentions"), F.count_distinct("doc_id").alias("documents"))
