"""Catalog entries: distributions, statistics, summaries, top-N (AG1/2/6-9/12/15-20, TK, PRJ7/12/13/15)."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from strata.functions.text import short_text
from strata.operators import stats
from strata.operators.terms import top_n
from strata.plans.catalog import register, updated_since
from strata.session import scratch_path
from strata.sinks import ordered
from strata.sources.tables import table


def _r(c, name=None, digits=6):
    return F.round(F.col(c), digits).alias(name or c)


@register("category_distribution", sql="SELECT lang, count(*) AS count FROM documents WHERE lang IS NOT NULL GROUP BY lang")
def category_distribution(spark, sf_dir):
    return stats.distribution(table(spark, sf_dir, "documents").select("lang"), "lang")


@register(
    "category_stats",
    sql="""SELECT lang, count(*) AS total, round(avg(n_chars), 6) AS avg_n_chars, max(n_chars) AS max_n_chars
           FROM documents GROUP BY lang""",
)
def category_stats(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("lang", "n_chars")
    out = stats.category_stats(docs, "lang", "n_chars", names=("total", "avg_n_chars", "max_n_chars"))
    return out.select("lang", "total", _r("avg_n_chars"), "max_n_chars")


@register(
    "top10_by_measure",
    sql="""SELECT doc_id, lang, n_chars, source,
                  CASE WHEN coalesce(substring(text, 1, 80), '') = '' THEN '—' ELSE substring(text, 1, 80) END AS short_text
           FROM documents ORDER BY n_chars DESC, doc_id LIMIT 10""",
)
def top10_by_measure(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "lang", "n_chars", "source", "text")
    top = top_n(docs, 10, [F.desc("n_chars"), F.asc("doc_id")])
    return top.select("doc_id", "lang", "n_chars", "source", short_text("text").alias("short_text"))


@register(
    "latest10",
    sql="SELECT event_id, ts, user_id, event_type, value FROM events ORDER BY ts DESC, event_id LIMIT 10",
)
def latest10(spark, sf_dir):
    ev = table(spark, sf_dir, "events").select("event_id", "ts", "user_id", "event_type", "value")
    return top_n(ev, 10, [F.desc("ts"), F.asc("event_id")])


@register(
    "top5_categories",
    sql="SELECT lang, count(*) AS count FROM documents WHERE lang IS NOT NULL GROUP BY lang ORDER BY count DESC, lang LIMIT 5",
)
def top5_categories(spark, sf_dir):
    dist = stats.distribution(table(spark, sf_dir, "documents").select("lang"), "lang")
    return top_n(dist, 5, [F.desc("count"), F.asc("lang")])


@register(
    "predicate_filters",
    sql="""SELECT source, count(*) AS matching,
                  count(*) FILTER (WHERE nullif(lang, 'de') IS NULL OR lang = 'Unknown') AS unknown_or_null
           FROM documents
           WHERE text IS NOT NULL AND length(text) > 3 AND regexp_matches(text, '^[A-Z]')
             AND lang NOT IN ('es')
           GROUP BY source""",
)
def predicate_filters(spark, sf_dir):
    """PRJ13: not-null, length, rlike, not-in and an ``is null or = 'Unknown'`` disjunction."""
    docs = table(spark, sf_dir, "documents").select("source", "lang", "text")
    kept = docs.filter(
        F.col("text").isNotNull()
        & (F.length("text") > 3)
        & F.col("text").rlike("^[A-Z]")
        & ~F.col("lang").isin("es")
    )
    lang = F.nullif(F.col("lang"), F.lit("de"))
    return kept.groupBy("source").agg(
        F.count(F.lit(1)).alias("matching"),
        F.count_if(lang.isNull() | (lang == "Unknown")).alias("unknown_or_null"),
    )


@register(
    "hour_date_counts",
    sql="""SELECT strftime(ts, '%Y-%m-%d') AS date, CAST(hour(ts) AS INTEGER) AS hour, count(*) AS count
           FROM events GROUP BY ALL""",
)
def hour_date_counts(spark, sf_dir):
    """PRJ7: derived hour (int) and date string."""
    ev = table(spark, sf_dir, "events").select("ts")
    return ev.groupBy(F.date_format("ts", "yyyy-MM-dd").alias("date"), F.hour("ts").alias("hour")).agg(
        F.count(F.lit(1)).alias("count")
    )


@register(
    "key_statistics",
    sql="""SELECT user_id, count(value) AS n, round(avg(value), 6) AS mean, round(stddev_samp(value), 6) AS stddev,
                  min(value) AS min, max(value) AS max FROM events GROUP BY user_id""",
)
def key_statistics(spark, sf_dir):
    ev = table(spark, sf_dir, "events").select("user_id", "value")
    out = stats.key_statistics(ev, "user_id", "value")
    return out.select("user_id", "n", _r("mean"), _r("stddev"), "min", "max")


@register(
    "extreme_counts",
    sql="""SELECT user_id, count(*) FILTER (WHERE value > 150) AS extreme_count, count(*) AS total_count
           FROM events GROUP BY user_id""",
)
def extreme_counts(spark, sf_dir):
    ev = table(spark, sf_dir, "events").select("user_id", "value")
    return stats.extreme_counts(ev, "user_id", F.col("value") > 150)


_HEAT_SQL = "(-8.78 + 1.61 * (l_tax * 100) + 2.34 * l_quantity - 0.146 * (l_tax * 100) * l_quantity)"


@register(
    "band_distribution",
    sql=f"""SELECT l_returnflag, CASE WHEN {_HEAT_SQL} < 27 THEN 'Nyaman'
                                     WHEN {_HEAT_SQL} < 32 THEN 'Perlu Hati-hati'
                                     WHEN {_HEAT_SQL} < 41 THEN 'Berbahaya'
                                     ELSE 'Sangat Berbahaya' END AS band, count(*) AS count
            FROM lineitem GROUP BY ALL ORDER BY l_returnflag DESC, count DESC""",
)
def band_distribution(spark, sf_dir):
    """PRJ15 + AG16: a derived index (heat-index formula over tax% and quantity), banded, per key."""
    li = table(spark, sf_dir, "lineitem").select("l_returnflag", "l_tax", "l_quantity")
    idx = stats.heat_index(F.col("l_tax") * 100, F.col("l_quantity"))
    out = stats.band_distribution(li, "l_returnflag", idx)
    return out.orderBy(F.desc("l_returnflag"), F.desc("count"))


@register(
    "risk_score",
    sql="""SELECT user_id, count(*) AS frequency, round(avg(value), 6) AS avg_measure,
                  round(count(*) FILTER (WHERE value < 20) / count(*), 6) AS conditional_share,
                  round(count(*) * avg(value) * (1 + count(*) FILTER (WHERE value < 20) / count(*)), 6) AS risk_score
           FROM events GROUP BY user_id""",
)
def risk_score(spark, sf_dir):
    ev = table(spark, sf_dir, "events").select("user_id", "value")
    out = stats.risk_score(ev, "user_id", "value", F.col("value") < 20)
    return out.select("user_id", "frequency", _r("avg_measure"), _r("conditional_share"), _r("risk_score"))


@register(
    "risk_adjusted_return",
    sql="""SELECT o_custkey, round(avg(o_totalprice), 6) AS avg_measure, round(stddev_samp(o_totalprice), 6) AS risk,
                  round(avg(o_totalprice) / nullif(stddev_samp(o_totalprice), 0), 6) AS ratio
           FROM orders GROUP BY o_custkey""",
)
def risk_adjusted_return(spark, sf_dir):
    o = table(spark, sf_dir, "orders").select("o_custkey", "o_totalprice")
    out = stats.risk_adjusted(o, "o_custkey", "o_totalprice")
    return out.select("o_custkey", _r("avg_measure"), _r("risk"), _r("ratio"))


@register(
    "return_volatility",
    sql="""SELECT o_custkey, arg_min(o_totalprice, (o_orderdate, o_orderkey)) AS first_value,
                  arg_max(o_totalprice, (o_orderdate, o_orderkey)) AS last_value,
                  round(stddev_samp(o_totalprice), 6) AS volatility, count(*) AS observations,
                  round((arg_max(o_totalprice, (o_orderdate, o_orderkey)) - arg_min(o_totalprice, (o_orderdate, o_orderkey)))
                        / nullif(arg_min(o_totalprice, (o_orderdate, o_orderkey)), 0) * 100, 6) AS return_pct
           FROM orders GROUP BY o_custkey""",
)
def return_volatility(spark, sf_dir):
    o = table(spark, sf_dir, "orders").select("o_custkey", "o_orderdate", "o_orderkey", "o_totalprice")
    out = stats.return_volatility(o, "o_custkey", "o_orderdate", "o_orderkey", "o_totalprice")
    return out.select("o_custkey", "first_value", "last_value", _r("volatility"), "observations", _r("return_pct"))


@register(
    "mean_per_period",
    sql="""SELECT date_trunc('month', o_orderdate) AS period, round(avg(o_totalprice), 6) AS mean_value,
                  count(*) AS observations FROM orders GROUP BY ALL""",
)
def mean_per_period(spark, sf_dir):
    o = table(spark, sf_dir, "orders").select("o_orderdate", "o_totalprice")
    out = stats.mean_per_period(o, "o_orderdate", "o_totalprice", "month")
    return out.select("period", _r("mean_value"), "observations")


@register(
    "rank_by_activity",
    sql="""SELECT n_name, count(*) AS orders,
                  CAST(rank() OVER (ORDER BY count(*) DESC, n_name) AS INTEGER) AS activity_rank
           FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
           GROUP BY n_name""",
)
def rank_by_activity(spark, sf_dir):
    """AG20: volume per region, ranked. Orders are pre-aggregated per customer
    before the join, so the shuffle carries one row per customer, not per order."""
    o = table(spark, sf_dir, "orders").select("o_custkey")
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    n = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    per_cust = o.groupBy("o_custkey").agg(F.count(F.lit(1)).alias("orders"))
    joined = per_cust.join(c, per_cust.o_custkey == c.c_custkey).join(n, F.col("c_nationkey") == n.n_nationkey)
    per_nation = joined.groupBy("n_name").agg(F.sum("orders").alias("orders"))
    # One row per nation (a dimension table), so a single ordered window is bounded.
    w = Window.orderBy(F.desc("orders"), F.asc("n_name"))
    return per_nation.withColumn("activity_rank", F.rank().over(w))


@register(
    "quality_histogram",
    sql="""WITH j AS (
             SELECT d.source, d.lang,
                    CASE WHEN l.quality = 1 AND d.lang IS NOT NULL THEN 'OK' ELSE 'PARTIAL_DATA' END AS quality_flag
             FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id)
           SELECT 'quality_flag' AS dimension, quality_flag AS value, count(*) AS count FROM j GROUP BY ALL
           UNION ALL SELECT 'source', source, count(*) FROM j GROUP BY ALL
           UNION ALL SELECT 'lang', lang, count(*) FROM j GROUP BY ALL""",
)
def quality_histogram(spark, sf_dir):
    """PRJ9 + AG9: quality flag from values *before* any imputation, then histograms."""
    d = table(spark, sf_dir, "documents").select("doc_id", "source", "lang")
    lab = table(spark, sf_dir, "labels").select("doc_id", "quality")
    j = d.join(lab, "doc_id", "left").withColumn(
        "quality_flag",
        F.when((F.col("quality") == 1) & F.col("lang").isNotNull(), "OK").otherwise("PARTIAL_DATA"),
    )
    return stats.histograms(j, ["quality_flag", "source", "lang"])


@register(
    "dedup_effect",
    sql="""SELECT count(*) AS rows_before,
                  count(DISTINCT text) + max(CASE WHEN text IS NULL THEN 1 ELSE 0 END) AS rows_after,
                  count(*) - (count(DISTINCT text) + max(CASE WHEN text IS NULL THEN 1 ELSE 0 END)) AS duplicates_removed
           FROM documents""",
)
def dedup_effect(spark, sf_dir):
    return stats.dedup_effect(table(spark, sf_dir, "documents").select("text"), "text")


@register(
    "summary_row",
    sql="""WITH c AS (SELECT lang, count(*) AS n, max(n_chars) AS mx FROM documents GROUP BY lang)
           SELECT CAST(sum(n) AS BIGINT) AS total_entities, max(mx) AS highest_measure,
                  (SELECT lang FROM c WHERE lang IS NOT NULL ORDER BY n DESC, lang LIMIT 1) AS top_category,
                  count(lang) AS total_categories,
                  (SELECT count(*) FROM conversations) AS total_articles, true AS updated_since_start
           FROM c""",
)
def summary_row(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "lang", "n_chars")
    conv = table(spark, sf_dir, "conversations").select("conv_id")
    return updated_since(stats.summary_row(docs, "doc_id", "lang", "n_chars", articles=conv))


def _sorted_events(spark, sf_dir, order):
    path = scratch_path(spark, "sorted")
    ordered.write_sorted(table(spark, sf_dir, "events").select("event_id", "event_type", "value"), path, order)
    return path


@register("sorted_table", sql="SELECT event_id, event_type, value, row_number() OVER (ORDER BY event_type, value DESC, event_id) - 1 AS place FROM events")
def sorted_table(spark, sf_dir):
    """TK5: a table written in order (few distinct first values, each over many files); every row's place read back from file and row number."""
    path = _sorted_events(spark, sf_dir, [F.col("event_type"), F.desc("value"), F.col("event_id")])
    return ordered.places(spark, path)


@register("sorted_top", sql="SELECT event_id, event_type, value FROM events ORDER BY value DESC, event_id LIMIT 100")
def sorted_top(spark, sf_dir):
    """TK5: the first 100 rows of a table in order of its measure, from the files that hold them."""
    order = [F.desc("value"), F.col("event_id")]
    return ordered.read_first(spark, _sorted_events(spark, sf_dir, order), 100, order)
