"""Catalog entries: Silver cleaning, sources, sinks, serving and the layer run
(ST1/ST2, WN9, PRJ1-PRJ14, SRC1/2/6/7/8, SNK1/4/8, PL1-PL3, AG7/AG10)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from strata.functions.text import TOPIC_STOPWORDS
from strata.operators import clean, serving, snapshots, stats
from strata.plans import medallion
from strata.plans.catalog import register, updated_since
from strata.session import scratch_path
from strata.sinks import writers
from strata.sources import html, landing
from strata.sources.tables import table
from strata.streaming import batches

ISO = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"
ISO_SQL = "%Y-%m-%dT%H:%M:%S.%f"


@register(
    "current_state",
    sql="""SELECT user_id, ts, event_id, event_type, value FROM (
             SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn FROM events)
           WHERE rn = 1""",
)
def current_state(spark, sf_dir):
    """WN9 / ST2: latest observation per entity, total order (ts, id)."""
    ev = table(spark, sf_dir, "events").select("user_id", "ts", "event_id", "event_type", "value")
    return clean.latest_per_key(ev, ["user_id"], ["ts", "event_id"]).select(
        "user_id", "ts", "event_id", "event_type", "value"
    )


@register(
    "union_sources",
    sql="""SELECT doc_id, text, lang, source, NULL::BIGINT AS conv_id, NULL::BIGINT AS turn, NULL AS role, 'documents' AS _source FROM documents
           UNION ALL
           SELECT NULL, text, NULL, NULL, conv_id, turn, role, 'conversations' FROM conversations""",
)
def union_sources(spark, sf_dir):
    """ST1 + PRJ1 (source tag): union by name with null fill."""
    d = table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source").withColumn(
        "_source", F.lit("documents"))
    c = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").withColumn(
        "_source", F.lit("conversations"))
    return clean.union_sources([d, c]).select("doc_id", "text", "lang", "source", "conv_id", "turn", "role", "_source")


def _bronze_like_events(spark, sf_dir):
    """Stand-in Bronze rows from ``events``: measure and times as strings, some
    categories null, ``updated_at`` missing for one source type."""
    ev = table(spark, sf_dir, "events").select("user_id", "ts", "event_type", "props")
    iso = F.date_format("ts", ISO)
    k = F.get_json_object("props", "$.k").try_cast("bigint")
    return ev.select(
        F.concat(F.lit("u"), F.col("user_id").cast("string")).alias("full_name"),
        F.col("props").alias("description"),
        F.nullif(F.col("event_type"), F.lit("signup")).alias("language"),
        (k - 10).cast("string").alias("stargazers_count"),
        F.when(F.col("event_type") != "view", iso).alias("updated_at"),
        iso.alias("timestamp"),
        F.when(F.col("event_type").isin("click", "view"), "api").otherwise("rss").alias("_source"),
    )


@register(
    "silver_clean",
    sql=f"""WITH b AS (
              SELECT 'u' || CAST(user_id AS VARCHAR) AS full_name, props AS description,
                     nullif(event_type, 'signup') AS language,
                     CAST(TRY_CAST(json_extract_string(props, '$.k') AS BIGINT) - 10 AS VARCHAR) AS stargazers_count,
                     CASE WHEN event_type <> 'view' THEN strftime(ts, '{ISO_SQL}') END AS updated_at,
                     strftime(ts, '{ISO_SQL}') AS timestamp,
                     CASE WHEN event_type IN ('click', 'view') THEN 'api' ELSE 'rss' END AS _source
              FROM events),
            t AS (SELECT *, TRY_CAST(stargazers_count AS BIGINT) AS m,
                     coalesce(TRY_CAST(updated_at AS TIMESTAMP), TRY_CAST(timestamp AS TIMESTAMP)) AS event_time,
                     CASE WHEN TRY_CAST(updated_at AS TIMESTAMP) IS NOT NULL THEN 'updated_at'
                          WHEN TRY_CAST(timestamp AS TIMESTAMP) IS NOT NULL THEN 'timestamp' ELSE 'ingest' END AS _time_source,
                     CASE WHEN language IS NOT NULL THEN 'OK' ELSE 'PARTIAL_DATA' END AS _quality_flag
                  FROM b WHERE full_name IS NOT NULL)
            SELECT full_name, description, _source, coalesce(m, 0) AS stargazers_count,
                   coalesce(language, 'Unknown') AS language, lower(coalesce(language, 'Unknown')) AS language_lower,
                   event_time, CAST(hour(event_time) AS INTEGER) AS event_hour, strftime(event_time, '%Y-%m-%d') AS event_date,
                   _time_source, _quality_flag, true AS processed_since_start
            FROM t WHERE coalesce(m, 0) >= 0""",
)
def silver_clean(spark, sf_dir):
    """PRJ2-PRJ11: Silver cleaning (flag before imputation, try-casts, time fallback)."""
    obs = clean.silver_observations(_bronze_like_events(spark, sf_dir))
    return updated_since(obs, "_processed_at", "processed_since_start").drop("_ingested_at", "html_url", "topics", "timestamp")


@register(
    "recent_top30",
    sql="""SELECT o_orderkey, o_custkey, o_orderdate, o_totalprice FROM orders
           WHERE o_orderdate > CAST((SELECT max(o_orderdate) FROM orders) AS DATE) - INTERVAL 7 DAY AND o_totalprice > 0
           ORDER BY o_totalprice DESC, o_orderkey LIMIT 30""",
)
def recent_top30(spark, sf_dir):
    """SRC7: recency search (last 7 days before the newest row), top 30 by measure."""
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate", "o_totalprice")
    return landing.recent_top(o, "o_orderdate", "o_totalprice", "o_orderkey", days=7, n=30)


_UNESC = "replace(replace(replace(replace(replace({x}, '&lt;', '<'), '&gt;', '>'), '&quot;', '\"'), '&#39;', ''''), '&amp;', '&')"


@register(
    "html_links",
    sql=r"""WITH p AS (SELECT page_id, list_filter(regexp_extract_all(html, '(?is)<a\b[^>]*>.*?</a>'),
                               lambda x: regexp_matches(x, '(?is)^<a\b[^>]*?\bhref\s*=')) AS a FROM pages)
           SELECT page_id, CAST(i AS INTEGER) AS position, regexp_extract(a[i], '(?is)^<a\b[^>]*?\bhref\s*=\s*["'']([^"'']*)', 1) AS href,
                  regexp_replace(a[i], '<[^>]*>', '', 'g') AS anchor_text
           FROM (SELECT *, unnest(range(1, len(a) + 1)) AS i FROM p)""",
)
def html_links(spark, sf_dir):
    """SRC8 (links): every anchor of every page with position and text."""
    return html.page_links(table(spark, sf_dir, "pages").select("page_id", "html"))


@register(
    "html_articles",
    sql=f"""WITH a AS (SELECT page_id, regexp_extract(html, '<title>(.*?)</title>', 1) AS title,
                             unnest(regexp_extract_all(html, '(?s)<article>(.*?)</article>', 1)) AS item FROM pages)
            SELECT page_id, {_UNESC.format(x='title')} AS title,
                   {_UNESC.format(x="trim(regexp_replace(regexp_extract(item, '(?s)<h[1-6][^>]*>(.*?)</h[1-6]>', 1), '<[^>]*>', '', 'g'))")} AS heading,
                   {_UNESC.format(x="trim(regexp_replace(regexp_extract(item, '(?s)<p>(.*?)</p>', 1), '<[^>]*>', '', 'g'))")} AS description,
                   CAST(len(regexp_extract_all(item, '<p>')) AS INTEGER) AS paragraphs
            FROM a""",
)
def html_articles(spark, sf_dir):
    """SRC8 (items): one row per article with title, heading, first paragraph, paragraph count."""
    return html.page_articles(table(spark, sf_dir, "pages").select("page_id", "html"))


@register(
    "search_page_records",
    sql=f"""SELECT source || '/' || CAST(doc_id AS VARCHAR) AS full_name, text AS description, lang AS language,
                  CAST(n_chars AS VARCHAR) AS stargazers_count,
                  CASE WHEN lang = 'en' THEN []::VARCHAR[] ELSE [lang] END AS topics,
                  '/' || source || '/' || CAST(doc_id AS VARCHAR) AS html_url,
                  strftime(TIMESTAMP '2024-01-01' + INTERVAL (doc_id % 86400) SECOND, '{ISO_SQL}') AS timestamp
           FROM documents""",
)
def search_page_records(spark, sf_dir):
    """SRC6: raw search responses (one JSON page per document, built by Spark) parsed
    back into 7-field observations; missing topics default to ``[]``."""
    d = table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source", "n_chars")
    name = F.concat(F.col("source"), F.lit("/"), F.col("doc_id").cast("string"))
    item = F.struct(
        name.alias("full_name"), F.col("text").alias("description"), F.col("lang").alias("language"),
        F.col("n_chars").alias("stargazers_count"),
        F.when(F.col("lang") != "en", F.array(F.col("lang"))).alias("topics"),
        F.concat(F.lit("/"), name).alias("html_url"),
    )
    seen = F.lit("2024-01-01 00:00:00").cast("timestamp_ntz") + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), F.col("doc_id") % 86400)
    pages = d.select(F.to_json(F.struct(F.array(item).alias("items"))).alias("raw"), seen.alias("observed_at"))
    return landing.search_page_records(pages, "raw", observed_at="observed_at")


@register(
    "message_key_value",
    sql="""SELECT md5(source || '/' || CAST(doc_id AS VARCHAR)) AS key,
                  CAST(to_json({'doc_id': doc_id, 'lang': lang, 'source': source, 'n_chars': n_chars}) AS VARCHAR) AS value
           FROM documents""",
)
def message_key_value(spark, sf_dir):
    """SNK1: keyed JSON messages, key = md5 of the entity name."""
    d = table(spark, sf_dir, "documents").select("doc_id", "lang", "source", "n_chars")
    name = F.concat(F.col("source"), F.lit("/"), F.col("doc_id").cast("string"))
    return writers.keyed_messages(d, name, hash_key=True)


@register(
    "message_plain_key",
    sql="""SELECT source || '/' || CAST(doc_id AS VARCHAR) AS key,
                  CAST(to_json({'doc_id': doc_id, 'lang': lang}) AS VARCHAR) AS value FROM documents""",
)
def message_plain_key(spark, sf_dir):
    """SNK1: keyed JSON messages, key = the entity name itself, chosen value columns."""
    d = table(spark, sf_dir, "documents").select("doc_id", "lang", "source")
    return writers.keyed_messages(d, F.concat(F.col("source"), F.lit("/"), F.col("doc_id").cast("string")), value_cols=["doc_id", "lang"])


@register(
    "json_landing_scan",
    sql="SELECT doc_id, lang, source, n_chars FROM documents",
)
def json_landing_scan(spark, sf_dir):
    """SNK4 + SRC1/SRC2: results written as JSON, read back with a declared schema."""
    from pyspark.sql import types as T

    d = table(spark, sf_dir, "documents").select("doc_id", "lang", "source", "n_chars")
    path = scratch_path(spark, "landing")
    writers.overwrite_json(d, path)
    schema = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("lang", T.StringType()),
                           T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType())])
    return landing.read_landing(spark, path, schema, multiline=False).drop(landing.CORRUPT)


_RECORD_SQL = """CAST(to_json({'full_name': source || '/' || CAST(doc_id AS VARCHAR), 'description': text, 'language': lang,
    'stargazers_count': CAST(n_chars AS VARCHAR)}) AS VARCHAR)"""


@register(
    "json_quarantine",
    sql=f"""WITH r AS (SELECT *, {_RECORD_SQL} AS raw FROM documents)
            SELECT 'good' AS part, source || '/' || CAST(doc_id AS VARCHAR) AS full_name, lang AS language, CAST(n_chars AS VARCHAR) AS stargazers_count, NULL AS raw_chars
            FROM r WHERE doc_id % 7 <> 3
            UNION ALL SELECT 'quarantined', NULL, NULL, NULL, length(raw) - 2 FROM r WHERE doc_id % 7 = 3""",
)
def json_quarantine(spark, sf_dir):
    """SRC2: every seventh record lands cut off at its end; the tolerant scan goes to Bronze, its broken lines to quarantine as they came."""
    d = table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source", "n_chars")
    name = F.concat(F.col("source"), F.lit("/"), F.col("doc_id").cast("string"))
    record = F.struct(name.alias("full_name"), F.col("text").alias("description"), F.col("lang").alias("language"), F.col("n_chars").cast("string").alias("stargazers_count"))
    raw = d.select("doc_id", F.to_json(record).alias("value"))
    cut = F.when(F.col("doc_id") % 7 == 3, F.substring("value", F.lit(1), F.char_length("value") - 2)).otherwise(F.col("value"))
    root = scratch_path(spark, "quarantine")
    raw.select(cut.alias("value")).write.option("compression", "none").text(f"{root}/landing")
    landing.read_landing(spark, f"{root}/landing", landing.API_SCHEMA, multiline=False, glob="*.txt").write.parquet(f"{root}/bronze")
    bronze = spark.read.schema(landing.landing_schema(landing.API_SCHEMA)).parquet(f"{root}/bronze")
    good, bad = landing.split_corrupt(bronze)
    good = good.select(F.lit("good").alias("part"), "full_name", "language", "stargazers_count", F.lit(None).cast("long").alias("raw_chars"))
    none = [F.lit(None).cast("string").alias(c) for c in ("full_name", "language", "stargazers_count")]
    return good.union(bad.select(F.lit("quarantined"), *none, F.char_length(landing.CORRUPT).cast("long")))


@register(
    "serving_languages",
    sql="""SELECT array_to_string(list_transform(regexp_extract_all(lower(lang), '(\\p{L}+|\\P{L}+)', 1),
                                  lambda x: upper(x[1]) || lower(x[2:])), '') AS language,
                  count(*) AS count, round(avg(n_chars), 1) AS avg_value, max(n_chars) AS max_value
           FROM documents GROUP BY lang""",
)
def serving_languages(spark, sf_dir):
    """PRJ14: served category table (title case, int count, 1-decimal average)."""
    d = table(spark, sf_dir, "documents").select("lang", "n_chars").withColumn("language_lower", F.lower("lang"))
    dist = stats.category_stats(d, "language_lower", "n_chars")
    return serving.serve_languages(dist)


@register(
    "serving_summary",
    sql="""WITH c AS (SELECT lang, count(*) AS n FROM documents GROUP BY lang)
           SELECT CAST(sum(n) AS BIGINT) AS total_entities,
                  (SELECT max(n_chars) FROM documents) AS highest_measure,
                  (SELECT lang FROM c ORDER BY n DESC, lang LIMIT 1) AS top_category,
                  count(*) AS total_categories, CAST(0 AS BIGINT) AS total_articles,
                  true AS updated_since_start, 'Gold Layer' AS data_source FROM c""",
)
def serving_summary(spark, sf_dir):
    """AG7 (Gold variant) over a category table and a top-10 list."""
    d = table(spark, sf_dir, "documents").select("doc_id", "lang", "n_chars")
    dist = stats.distribution(d, "lang", drop_null=False)
    top = d.orderBy(F.desc("n_chars"), F.asc("doc_id")).limit(10)
    return updated_since(serving.serve_summary(dist, top, "lang", "count", "n_chars"))


def _observation_records(spark, sf_dir):
    """Stand-in observations, one per event (entity, time, type); description, category and measure are those of the
    document whose id is the event's modulo the number of documents, so every event has one."""
    ev = table(spark, sf_dir, "events").select("event_id", "ts", "user_id", "event_type")
    d = table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "n_chars")
    n = d.select(F.count(F.lit(1))).scalar()
    j = ev.withColumn("_doc", F.pmod("event_id", n)).join(d, F.col("_doc") == d.doc_id, "left")
    iso = F.date_format("ts", ISO)
    return j.select(
        F.concat(F.lit("user/"), F.col("user_id").cast("string")).alias("full_name"),
        F.col("text").alias("description"),
        F.col("lang").alias("language"),
        F.col("n_chars").cast("string").alias("stargazers_count"),
        F.array(F.col("event_type")).alias("topics"),
        F.concat(F.lit("/user/"), F.col("user_id").cast("string")).alias("html_url"),
        iso.alias("timestamp"),
        iso.alias("updated_at"),
        F.when(F.col("event_type").isin("click", "view"), "api").otherwise("rss").alias("_src"),
    )


_OBS_SQL = """
    j AS (SELECT e.event_id, e.ts, e.user_id, e.event_type, d.text, d.lang, d.n_chars,
                 CASE WHEN e.event_type IN ('click', 'view') THEN 'api' ELSE 'rss' END AS src
          FROM events e LEFT JOIN documents d ON e.event_id % (SELECT count(*) FROM documents) = d.doc_id),
    cur AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, src DESC) AS rn FROM j)
            WHERE rn = 1)"""

_STOP_SQL = ", ".join(f"'{w}'" for w in TOPIC_STOPWORDS)
_TOPICS_SQL = f"""
    w AS (SELECT word, src, count(*) AS n FROM (
            SELECT src, unnest(string_split(lower(regexp_replace(text, '[^a-zA-Z0-9 ]', '', 'g')), ' ')) AS word FROM cur)
          WHERE regexp_matches(word, '^[a-z]{{4,}}') AND word NOT IN ({_STOP_SQL}) GROUP BY ALL),
    g AS (SELECT user_id, src, n_chars, n_chars - lag(n_chars) OVER (PARTITION BY user_id, src ORDER BY ts) AS gain FROM j),
    vel AS (SELECT user_id, src, max(n_chars) AS current_value, sum(gain) AS total_gain, count(*) AS n FROM g WHERE gain IS NOT NULL GROUP BY ALL),
    lg AS (SELECT lower(lang) AS lang, count(*) AS n, max(n_chars) AS mx FROM cur GROUP BY ALL),
    top AS (SELECT * FROM cur ORDER BY n_chars DESC, 'user/' || user_id LIMIT 10)"""


#: Records of a landed file.
LANDED_ROWS = 50_000


def _layer_run(spark, sf_dir):
    """Two landing rounds, the older half of the events last, each followed by a run, which removes the files that Bronze has taken; then the layers' tables."""
    # Not kept: the records with their texts are many times the tables, and each part joins its own events only.
    rec = _observation_records(spark, sf_dir).withColumn("_late", F.col("timestamp") < F.lit("2024-01-16"))
    root = scratch_path(spark, "medallion")
    places = {s: f"{root}/landing/{s}" for s in ("api", "rss")}
    for late in (False, True):
        part = rec.filter(F.col("_late") == late).drop("_late")
        api = part.filter(F.col("_src") == "api").drop("_src", "updated_at")
        rss = part.filter(F.col("_src") == "rss").drop("_src", "topics").withColumn("source", F.lit("trending"))
        with batches.adaptive(spark):
            writers.overwrite_json(api, f"{places['api']}/round-{late}", "gzip", LANDED_ROWS)
            writers.overwrite_json(rss, f"{places['rss']}/round-{late}", "gzip", LANDED_ROWS)
        status = medallion.run(spark, places, root, multiline=False, keep_landing=False)
        failed = status.filter(F.col("status") != "OK").collect()
        if failed:
            raise RuntimeError(f"medallion run failed: {failed}")
    return medallion.tables(spark, root), root


@register(
    "medallion_run",
    sql=f"""WITH {_OBS_SQL}, {_TOPICS_SQL}
            SELECT 'bronze_api' AS "table", count(*) FILTER (WHERE src = 'api') AS rows FROM j
            UNION ALL SELECT 'bronze_rss', count(*) FILTER (WHERE src = 'rss') FROM j
            UNION ALL SELECT 'silver_observations', count(*) FROM j
            UNION ALL SELECT 'silver_current', count(*) FROM cur
            UNION ALL SELECT 'gold_language_dist', count(*) FROM lg
            UNION ALL SELECT 'gold_top_repos', count(*) FROM top
            UNION ALL SELECT 'gold_star_velocity', count(*) FROM vel
            UNION ALL SELECT 'gold_emerging_topics', count(*) FROM w""",
)
def medallion_run(spark, sf_dir):
    """PL1 + SNK8: land two sources as JSON in two rounds, run Bronze -> Silver -> Gold after each, count every layer."""
    return writers.layer_counts(_layer_run(spark, sf_dir)[0])


@register(
    "medallion_contents",
    sql=f"""WITH {_OBS_SQL}, {_TOPICS_SQL}
            SELECT 'observations' AS "table", 'user/' || user_id AS name, src, strftime(ts, '{ISO_SQL}') AS detail, n_chars AS number FROM j
            UNION ALL SELECT 'current', 'user/' || user_id, src, strftime(ts, '{ISO_SQL}'), n_chars FROM cur
            UNION ALL SELECT 'language_dist', lang, NULL, CAST(mx AS VARCHAR), n FROM lg
            UNION ALL SELECT 'top_repos', 'user/' || user_id, src, lang, n_chars FROM top
            UNION ALL SELECT 'star_velocity', 'user/' || user_id, src, CAST(total_gain AS VARCHAR) || ' ' || CAST(n AS VARCHAR), current_value FROM vel
            UNION ALL SELECT 'emerging_topics', word, src, NULL, n FROM w""",
)
def medallion_contents(spark, sf_dir):
    """PL1: what the layers hold after two rounds, not only how much."""
    t, _ = _layer_run(spark, sf_dir)
    null = F.lit(None).cast("string")
    iso = F.date_format("event_time", ISO)

    def rows(name, of, key, source, detail, number):
        return t[of].select(F.lit(name).alias("table"), F.col(key).alias("name"), source.alias("src"), detail.alias("detail"), F.col(number).cast("long").alias("number"))

    src = F.col("_source")
    parts = [
        rows("observations", "silver_observations", "full_name", src, iso, "stargazers_count"),
        rows("current", "silver_current", "full_name", src, iso, "stargazers_count"),
        rows("language_dist", "gold_language_dist", "language_lower", null, F.col("max_stars").cast("string"), "total_repos"),
        rows("top_repos", "gold_top_repos", "full_name", src, F.col("language"), "stargazers_count"),
        rows("star_velocity", "gold_star_velocity", "full_name", src, F.concat_ws(" ", F.col("total_gain").cast("long").cast("string"), F.col("observation_count").cast("string")), "current_value"),
        rows("emerging_topics", "gold_emerging_topics", "word", src, null, "frequency"),
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


@register(
    "medallion_log",
    sql="""SELECT unnest(['bronze', 'silver', 'gold', 'bronze', 'silver', 'gold']) AS stage, 'OK' AS status, true AS finished_since_start
           FROM (SELECT 1 WHERE EXISTS (SELECT 1 FROM events))""",
)
def medallion_log(spark, sf_dir):
    """PL2: the run log after two rounds."""
    start = F.lit(dt.datetime.now(dt.timezone.utc)).cast("timestamp")
    _, root = _layer_run(spark, sf_dir)
    log = snapshots.read_latest(spark, f"{root}/run_log")
    return log.select("stage", "status", (F.col("finished_at") >= start).alias("finished_since_start"))


@register(
    "medallion_metrics",
    sql=f"""WITH {_OBS_SQL}, {_TOPICS_SQL},
            n AS (SELECT (SELECT count(*) FROM j) AS obs, (SELECT count(*) FROM lg) + (SELECT count(*) FROM top) + (SELECT count(*) FROM vel) + (SELECT count(*) FROM w) AS gold)
            SELECT 'bronze' AS stage, obs AS rows_in, obs AS rows_out, true AS timed FROM n
            UNION ALL SELECT 'silver', obs, obs, true FROM n UNION ALL SELECT 'gold', obs, gold, true FROM n""",
)
def medallion_metrics(spark, sf_dir):
    """PL1 / SNK8: rows in and out per stage, counted by the stages' own jobs: both rounds of the incremental layers, the last of Gold."""
    _, root = _layer_run(spark, sf_dir)
    log = snapshots.read_latest(spark, f"{root}/run_log").withColumn("last", F.struct("finished_at", "rows_in", "rows_out"))
    total = log.groupBy("stage").agg(F.sum("rows_in").alias("a"), F.sum("rows_out").alias("b"), F.max("last").alias("last"), (F.min("seconds") > 0).alias("timed"))
    gold = F.col("stage") == "gold"
    return total.select("stage", F.when(gold, F.col("last.rows_in")).otherwise(F.col("a")).alias("rows_in"), F.when(gold, F.col("last.rows_out")).otherwise(F.col("b")).alias("rows_out"), "timed")


def _cycle(spark, sf_dir):
    rec = _observation_records(spark, sf_dir)
    return medallion.clean_cycle(rec.drop("_src"), rec.filter(F.col("_src") == "rss"))


@register(
    "analysis_cycle_summary",
    sql=f"""WITH {_OBS_SQL},
            a AS (SELECT * FROM cur)
            SELECT count(*) AS total_entities, max(n_chars) AS highest_measure,
                   (SELECT lang FROM (SELECT lang, count(*) AS n FROM a WHERE lang IS NOT NULL GROUP BY lang) ORDER BY n DESC, lang LIMIT 1) AS top_category,
                   count(DISTINCT lang) AS total_categories,
                   least((SELECT count(*) FROM j WHERE src = 'rss'), 10) AS total_articles, true AS updated_since_start
            FROM a""",
)
def analysis_cycle_summary(spark, sf_dir):
    """PL3: the one-row summary of a generation-1 analysis cycle (api = all sources
    de-duplicated per entity; articles = newest-10 list of the rss rows)."""
    return updated_since(_cycle(spark, sf_dir)["summary"])


@register(
    "analysis_cycle_outputs",
    sql=f"""WITH {_OBS_SQL},
            words AS (SELECT word, count(*) AS n FROM (SELECT unnest(string_split(lower(text), ' ')) AS word FROM cur) WHERE length(word) > 3 GROUP BY word)
            SELECT 'language_dist' AS output, lang AS name, count(*) AS number FROM cur WHERE lang IS NOT NULL GROUP BY lang
            UNION ALL SELECT 'top_repos', 'user/' || user_id, n_chars FROM (SELECT * FROM cur ORDER BY n_chars DESC, 'user/' || user_id LIMIT 10)
            UNION ALL SELECT 'word_freq', word, n FROM (SELECT * FROM words ORDER BY n DESC, word LIMIT 15)
            UNION ALL SELECT 'rss_latest', 'user/' || user_id, n_chars FROM (SELECT * FROM j WHERE src = 'rss' ORDER BY ts DESC, 'user/' || user_id LIMIT 10)""",
)
def analysis_cycle_outputs(spark, sf_dir):
    """PL3: the other four outputs of the cycle."""
    out = _cycle(spark, sf_dir)
    named = {"language_dist": ("language", "count"), "top_repos": ("full_name", "stargazers_count"), "word_freq": ("word", "count"), "rss_latest": ("full_name", "stargazers_count")}
    parts = [out[o].select(F.lit(o).alias("output"), F.col(n).alias("name"), F.col(v).cast("long").alias("number")) for o, (n, v) in named.items()]
    return parts[0].unionByName(parts[1]).unionByName(parts[2]).unionByName(parts[3])


@register("json_array_landing", sql="SELECT doc_id, lang, source, n_chars FROM documents")
def json_array_landing(spark, sf_dir):
    """SRC1 + SRC2: a directory of multi-line JSON arrays, beside a cut-off file, an empty array and a file of another kind."""
    d = table(spark, sf_dir, "documents").select("doc_id", "lang", "source", "n_chars")
    path = scratch_path(spark, "arrays")
    files = d.groupBy(F.floor(F.col("doc_id") / 100).alias("_file")).agg(F.collect_list(F.struct(*d.columns)).alias("items"))
    arrays = files.select(F.replace(F.to_json("items"), F.lit("},{"), F.lit("},\n{")).alias("value"), F.col("_file").cast("string").alias("_file"))
    arrays.write.partitionBy("_file").text(f"{path}/in")
    spark.range(1).select(F.lit('[{"doc_id":').alias("value")).coalesce(1).write.text(f"{path}/in/_file=cut")
    spark.range(1).select(F.lit("[]").alias("value")).coalesce(1).write.text(f"{path}/in/_file=empty")
    d.limit(1).write.json(f"{path}/in/_file=other")
    raw = landing.read_landing(spark, f"{path}/in", d.schema, multiline=True, glob="*.txt")
    raw.write.parquet(f"{path}/bronze")
    bronze = spark.read.schema(raw.schema).parquet(f"{path}/bronze")
    return bronze.filter(F.col(landing.CORRUPT).isNull()).drop(landing.CORRUPT)


@register(
    "json_fallback_ingest",
    sql="SELECT doc_id, lang, 'documents' AS _source, true AS ingested_since_start FROM documents",
)
def json_fallback_ingest(spark, sf_dir):
    """SNK7 + PRJ1: tagged rows as JSON, the ingest time as an ISO string, read back."""
    start = F.lit(dt.datetime.now(dt.timezone.utc)).cast("timestamp")
    d = clean.add_ingest_metadata(table(spark, sf_dir, "documents").select("doc_id", "lang"), "documents")
    path = scratch_path(spark, "fallback")
    writers.overwrite_json(d, path)
    back = spark.read.schema("doc_id long, lang string, _source string, _ingested_at string").json(path)
    return back.select("doc_id", "lang", "_source", (F.to_timestamp("_ingested_at") >= F.date_trunc("second", start)).alias("ingested_since_start"))


@register("gold_else_clean", sql="SELECT lang, count(*) AS count FROM documents WHERE lang IS NOT NULL GROUP BY lang")
def gold_else_clean(spark, sf_dir):
    """PRJ16: Gold tables if any has rows, else the Clean result; here one Gold table is missing and one is empty."""
    d = table(spark, sf_dir, "documents").select("lang")
    path = scratch_path(spark, "gold")
    snapshots.commit(d.limit(0), f"{path}/language_dist")
    readers = [lambda: snapshots.read_latest(spark, f"{path}/top_repos"), lambda: spark.read.parquet(f"{path}/none"),
               lambda: snapshots.read_latest(spark, f"{path}/language_dist"), lambda: stats.distribution(d, "lang")]
    return serving.first_available(readers)


@register(
    "repo_items",
    sql=f"""SELECT page_id, 'site/' || page_id AS full_name, 'https://host/site/' || page_id AS html_url,
                   {_UNESC.format(x=r"regexp_replace(regexp_replace(regexp_extract(html, '<title>(.*?)</title>', 1), '<[^>]*>', '', 'g'), '^\s+|\s+$', '', 'g')")} AS description,
                   CASE WHEN page_id % 3 = 0 THEN 'Unknown' ELSE 'Lang' || page_id % 7 END AS language,
                   CASE WHEN page_id % 5 = 0 THEN 0 ELSE page_id * 37 END AS stargazers_count
            FROM pages""",
)
def repo_items(spark, sf_dir):
    """SRC8: repository rows of listing pages; each page is rewrapped in the layout of a listing, with nested elements and decoys."""
    p = table(spark, sf_dir, "pages").select("page_id", "html")
    i = F.col("page_id").cast("string")
    language = F.when(F.col("page_id") % 3 != 0, F.concat(F.lit('<span class="d" itemprop="programmingLanguage">Lang'), (F.col("page_id") % 7).cast("string"), F.lit("</span>"))).otherwise("")
    stars = F.when(F.col("page_id") % 5 != 0, F.concat(F.lit('<span class="s"><svg a="b"><path/></svg> <span>'), F.format_number(F.col("page_id") * 37, 0), F.lit("</span>\n stars today</span>"))).otherwise("<span>no count</span>")
    page = F.concat(
        F.lit('<article class="ad Box-rows"><h2 class="h3"><a href="/ad">x</a></h2></article><article class="x Box-row y"><h2>no class</h2></article>'),
        F.lit('<article class="Box-row d-flex"><h2 class="lh h3"><a class="Link" data-x="1"\n href="/site/'), i, F.lit('"><b>site</b> / '), i, F.lit("</a></h2>"),
        F.lit('<p class="col-8">decoy</p><p class="my-1 col-9">\n '), F.regexp_extract("html", "<title>(.*?)</title>", 1), F.lit(" \n</p>"),
        language, F.lit("<span>1</span>"), stars, F.lit("<span>9 stars in all</span></article>"),
    )
    # The last span is a decoy where an earlier one has the word; pages without a count have none after all.
    page = F.when(F.col("page_id") % 5 == 0, F.replace(page, F.lit("<span>9 stars in all</span>"), F.lit(""))).otherwise(page)
    return html.repo_items(p.select("page_id", page.alias("html")), base_url="https://host", keep=["page_id"])


@register(
    "repo_items_nested",
    sql="""SELECT page_id, 'outer/' || page_id AS full_name, 'https://host/outer/' || page_id AS html_url, 'a b ' || page_id || ' c' AS description, 'Rust ' || page_id AS language, page_id + 1000 AS stargazers_count FROM pages
           UNION ALL SELECT page_id, 'inner/' || page_id, 'https://host/inner/' || page_id, '', 'Unknown', page_id + 7 FROM pages""",
)
def repo_items_nested(spark, sf_dir):
    """SRC8: an item inside an item, spans three deep, comments and scripts with markup in them, a stray closing tag."""
    p = table(spark, sf_dir, "pages").select("page_id", "html")
    n = F.col("page_id").cast("string")
    count = lambda more: F.format_string("%,d", F.col("page_id") + more)
    inner = F.concat(
        F.lit('<ARTICLE class="Box-row x"><h2 class="h3"><a href="/inner/'), n, F.lit('">i</a></h2><span><span>'), count(7), F.lit(" <b>stars</b></span></span></ARTICLE>")
    )
    page = F.concat(
        F.lit('</article></span><!-- <article class="Box-row"><h2 class="h3"><a href="/no">x</a></h2></article> -->'),
        F.lit('<script>var t = "<article class=\\"Box-row\\">";</script><article class="Box-row"><h2 class="h3"><a href="/outer/'), n,
        F.lit('">o</a></h2><p class="col-9">a <b>b <i>'), n, F.lit('</i></b> <!-- hidden <p> -->c</p><span itemprop="programmingLanguage"><span><span>Rust</span> '), n,
        F.lit('</span></span><span><span title="a > b"><span>'), count(1000), F.lit("</span> stars</span> today</span>"), inner, F.lit("</article>"), F.col("html"),
    )
    return html.repo_items(p.select("page_id", page.alias("html")), base_url="https://host", keep=["page_id"])


@register(
    "serving_top",
    sql="""SELECT coalesce(source || '/' || CAST(doc_id AS VARCHAR), '') AS full_name, coalesce(n_chars, 0) AS stargazers_count,
                  coalesce(lang, '') AS language, coalesce('/' || source, '#') AS html_url,
                  CASE WHEN coalesce(substring(text, 1, 80), '') = '' THEN '—' ELSE substring(text, 1, 80) END AS short_description,
                  source AS _source
           FROM documents ORDER BY n_chars DESC, doc_id LIMIT 10""",
)
def serving_top(spark, sf_dir):
    """PRJ14: the served top-10 list (defaults, int measure, 80-character description)."""
    d = table(spark, sf_dir, "documents").select("doc_id", "source", "n_chars", "lang", "text")
    top = d.orderBy(F.desc("n_chars"), F.asc("doc_id")).limit(10).select(
        F.concat(F.col("source"), F.lit("/"), F.col("doc_id").cast("string")).alias("full_name"),
        F.col("n_chars").alias("stargazers_count"), F.col("lang").alias("language"),
        F.concat(F.lit("/"), F.col("source")).alias("html_url"), F.col("text").alias("description"),
        F.col("source").alias("_source"),
    )
    return serving.serve_top(top)


@register(
    "serving_velocity",
    sql="""WITH p AS (SELECT user_id, value, lag(value) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS prev_value FROM events),
                v AS (SELECT user_id, max(value) AS current_value, round(sum(value - prev_value), 6) AS total_gain
                      FROM p WHERE prev_value IS NOT NULL GROUP BY user_id)
           SELECT user_id, current_value, total_gain, CASE user_id % 3 WHEN 0 THEN 'Objective-C' WHEN 1 THEN 'Go' ELSE 'Unknown' END AS language
           FROM v ORDER BY total_gain DESC, user_id LIMIT 10""",
)
def serving_velocity(spark, sf_dir):
    """Served velocity list: the 10 entities with the largest total gain (ties by key)."""
    from strata.operators import series

    ev = table(spark, sf_dir, "events").select("user_id", "ts", "event_id", "value")
    vel = series.velocity(ev, "user_id", "ts", "event_id", "value").select(
        "user_id", "current_value", F.round("total_gain", 6).alias("total_gain"))
    of = F.col("user_id") % 3
    vel = vel.withColumn("language_lower", F.when(of == 0, "objective-c").when(of == 1, "go"))
    return serving.serve_velocity(vel, "user_id", 10)
