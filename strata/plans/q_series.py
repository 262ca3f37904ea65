"""Catalog entries: change, velocity, trend, anomaly (WN1-WN6, AG5, AG13, AG14, AG22)."""

from __future__ import annotations

from pyspark.sql import functions as F

from strata.operators import series, stats
from strata.plans.catalog import register
from strata.sources.tables import table

_EV = "user_id", "ts", "event_id", "value"
_OR = "o_custkey", "o_orderdate", "o_orderkey", "o_totalprice"
_LAG_EV = "lag(value) OVER (PARTITION BY user_id ORDER BY ts, event_id)"
_LAG_OR = "lag(o_totalprice{n}) OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey)"


def _r(c, name=None, digits=6):
    return F.round(F.col(c), digits).alias(name or c)


def _events(spark, sf_dir, *extra):
    return table(spark, sf_dir, "events").select(*_EV, *extra)


def _orders(spark, sf_dir):
    return table(spark, sf_dir, "orders").select(*_OR)


@register(
    "velocity",
    sql=f"""WITH p AS (SELECT user_id, value, {_LAG_EV} AS prev_value FROM events)
            SELECT user_id, max(value) AS current_value, round(sum(value - prev_value), 6) AS total_gain,
                   round(avg(value - prev_value), 6) AS avg_gain, count(*) AS observation_count
            FROM p WHERE prev_value IS NOT NULL GROUP BY user_id""",
)
def velocity(spark, sf_dir):
    out = series.velocity(_events(spark, sf_dir), *_EV)
    return out.select("user_id", "current_value", _r("total_gain"), _r("avg_gain"), "observation_count")


@register(
    "velocity_dict_agg",
    sql=f"""WITH p AS (SELECT user_id, value, value - {_LAG_EV} AS gain FROM events)
            SELECT user_id, round(sum(gain), 6) AS "sum(gain)", max(value) AS "max(value)" FROM p GROUP BY user_id""",
)
def velocity_dict_agg(spark, sf_dir):
    out = series.velocity_dict_agg(_events(spark, sf_dir), *_EV)
    return out.select("user_id", F.round(F.col("`sum(gain)`"), 6).alias("sum(gain)"), F.col("`max(value)`"))


@register(
    "trend_counts",
    sql=f"""WITH p AS (SELECT user_id, value - {_LAG_EV} AS change FROM events)
            SELECT user_id, CASE WHEN change > 5 THEN 'rising' WHEN change < -5 THEN 'falling' ELSE 'stable' END AS trend,
                   count(*) AS count FROM p GROUP BY ALL""",
)
def trend_counts(spark, sf_dir):
    return series.trend_counts(_events(spark, sf_dir), *_EV, threshold=5.0)


@register(
    "pct_change_alerts",
    sql=f"""WITH p AS (SELECT *, {_LAG_OR.format(n='')} AS prev_value FROM orders),
            q AS (SELECT *, (o_totalprice - prev_value) / nullif(prev_value, 0) * 100 AS pct FROM p)
            SELECT o_custkey, o_orderdate, o_orderkey, o_totalprice, prev_value, round(pct, 6) AS pct_change,
                   CASE WHEN pct > 5 THEN 'rise' ELSE 'drop' END AS alert
            FROM q WHERE pct > 5 OR pct < -5""",
)
def pct_change_alerts(spark, sf_dir):
    out = series.pct_change_alerts(_orders(spark, sf_dir), *_OR, threshold=5.0)
    return out.select(*_OR, "prev_value", _r("pct_change"), "alert")


@register(
    "rise_over_3",
    sql=f"""WITH p AS (SELECT *, {_LAG_OR.format(n=', 3')} AS value_n_back FROM orders),
            q AS (SELECT *, (o_totalprice - value_n_back) / nullif(value_n_back, 0) AS rise FROM p)
            SELECT o_custkey, o_orderdate, o_orderkey, o_totalprice, value_n_back, round(rise, 6) AS rise
            FROM q WHERE rise > 0.05""",
)
def rise_over_3(spark, sf_dir):
    out = series.rise_over(_orders(spark, sf_dir), *_OR, n=3, min_rise=0.05)
    return out.select(*_OR, "value_n_back", _r("rise"))


@register(
    "longest_run",
    sql="""WITH f AS (SELECT user_id, ts, event_id, CASE WHEN coalesce(value > 100, false) THEN 1 ELSE 0 END AS bad FROM events),
           g AS (SELECT *, sum(1 - bad) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS grp FROM f),
           r AS (SELECT user_id, grp, sum(bad) AS run FROM g GROUP BY ALL)
           SELECT user_id, CAST(max(run) AS BIGINT) AS longest_run FROM r GROUP BY user_id""",
)
def longest_run(spark, sf_dir):
    ev = table(spark, sf_dir, "events").select("user_id", "ts", "event_id", "value")
    return series.longest_run(ev, "user_id", "ts", "event_id", F.col("value") > 100)


@register(
    "rolling_avg_3",
    sql="""SELECT event_id, user_id, ts, value,
                  round(avg(value) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN 2 PRECEDING AND CURRENT ROW), 6)
                  AS rolling_mean FROM events""",
)
def rolling_avg_3(spark, sf_dir):
    out = series.rolling_mean(_events(spark, sf_dir), *_EV, n=3)
    return out.select("event_id", "user_id", "ts", "value", _r("rolling_mean"))


@register(
    "zscore_spikes",
    sql="""WITH b AS (SELECT user_id, avg(value) AS m, stddev_samp(value) AS s FROM events GROUP BY user_id),
           z AS (SELECT e.event_id, e.user_id, e.ts, e.value, b.m, (e.value - b.m) / nullif(b.s, 0) AS z
                 FROM events e JOIN b ON e.user_id = b.user_id)
           SELECT event_id, user_id, ts, value, round(m, 6) AS mean_value, round(z, 6) AS z_score FROM z WHERE abs(z) > 2""",
)
def zscore_spikes(spark, sf_dir):
    ev = table(spark, sf_dir, "events").select("event_id", "user_id", "ts", "value")
    out = series.zscore_spikes(ev, "user_id", "value", threshold=2.0)
    return out.select("event_id", "user_id", "ts", "value", _r("mean_value"), _r("z_score"))


@register(
    "hourly_mean_abs_change",
    sql=f"""WITH p AS (SELECT ts, value, value - {_LAG_EV} AS change FROM events)
            SELECT CAST(hour(ts) AS INTEGER) AS hour, round(avg(value), 6) AS mean_value,
                   round(avg(abs(change)), 6) AS mean_abs_change FROM p GROUP BY ALL""",
)
def hourly_mean_abs_change(spark, sf_dir):
    ch = series.change_by_hour(_events(spark, sf_dir), *_EV)
    out = stats.hourly_means(ch, "ts", "value", change="change")
    return out.select("hour", _r("mean_value"), _r("mean_abs_change"))
