"""Catalog entries: Structured Streaming jobs run to completion (SM1-SM7).

Each query lands the ``events`` table as several polls, out of order, and streams them one file per micro-batch
(``trigger(availableNow=True)``) into sinks and state under a fresh folder of the shared checkpoint dir. It returns a
batch read of the final state, which is compared with the batch SQL of the same result.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from strata.plans.catalog import register
from strata.plans.q_joins import _range_sql
from strata.session import scratch_path
from strata.streaming import jobs, stateful
from strata.sources import polls
from strata.sources.tables import table


COLUMNS = ("event_id", "ts", "user_id", "event_type", "value")


#: Files of a poll, which a micro-batch takes together.
FILES = 4


def _polls(spark, sf_dir, root, columns=COLUMNS, n=4):
    """All events landed as ``n`` folders of ``FILES`` files, one per micro-batch, the last period first: half of them come late."""
    ev = table(spark, sf_dir, "events").select(*columns)
    first, last = (ev.select(f("ts")).scalar() for f in (F.min, F.max))
    span = F.unix_micros(last.cast("timestamp")) - F.unix_micros(first.cast("timestamp")) + 1
    at = F.floor(n * (F.unix_micros(F.col("ts").cast("timestamp")) - F.unix_micros(first.cast("timestamp"))) / span)
    tagged = ev.withColumn("_poll", at.cast("int")).persist()
    try:
        for k, poll in enumerate([n - 1, *range(n - 1)]):
            tagged.filter(F.col("_poll") == poll).drop("_poll").repartition(FILES).write.parquet(f"{root}/landing/poll{k}")
    finally:
        tagged.unpersist()
    return jobs.file_stream(spark, f"{root}/landing/*", ev.schema, max_files=FILES)


#: A delay longer than the whole table: its polls come in any order and no row is late.
ALL_S = 400 * 86400


def _heartbeat(spark, sf_dir, root, schema, poll, ahead_s):
    """A last poll of one row without an entity, far enough ahead for the watermark to pass every record."""
    last = table(spark, sf_dir, "events").agg((F.max("ts").cast("timestamp") + F.make_dt_interval(secs=F.lit(ahead_s))).alias("t"))
    value = lambda f: (F.col("t") if f.name == "ts" else F.lit(None)).cast(f.dataType).alias(f.name)
    last.select(*map(value, schema.fields)).write.parquet(f"{root}/landing/poll{poll}")


PERIODS = 5
#: Watermark delay and heartbeat of the streams below: rows come at most one period (about six days) late.
DELAY_S = 8 * 86400


def _disordered_polls(spark, sf_dir, root, columns=COLUMNS):
    """All events as ``PERIODS`` + 1 polls: each holds its period, but every third record comes with the next one, beside newer rows.

    A last poll is a heartbeat without an entity, far enough ahead for the watermark to pass every record.
    """
    ev = table(spark, sf_dir, "events").select(*columns)
    first, last = (ev.select(f("ts")).scalar() for f in (F.min, F.max))
    micros = lambda c: F.unix_micros(c.cast("timestamp"))
    period = F.floor(PERIODS * (micros(F.col("ts")) - micros(first)) / (micros(last) - micros(first) + 1)).cast("int")
    tagged = ev.withColumn("_poll", period + (F.pmod(F.xxhash64("event_id"), F.lit(3)) == 0).cast("int")).persist()
    try:
        for k in range(PERIODS + 1):
            tagged.filter(F.col("_poll") == k).drop("_poll").repartition(FILES).write.parquet(f"{root}/landing/poll{k}")
    finally:
        tagged.unpersist()
    _heartbeat(spark, sf_dir, root, ev.schema, PERIODS + 1, 2 * DELAY_S)
    return jobs.file_stream(spark, f"{root}/landing/*", ev.schema, max_files=FILES)


@register(
    "stream_ingest",
    sql="SELECT event_id, ts, user_id, event_type, value, props, 'events' AS _source FROM events",
)
def stream_ingest(spark, sf_dir):
    """SM1 / SNK2: checkpointed append of every record with ingest metadata."""
    root = scratch_path(spark, "stream-ingest")
    st = _polls(spark, sf_dir, root, (*COLUMNS, "props"))
    jobs.ingest(st, "events", f"{root}/sink", f"{root}/_checkpoint")
    return spark.read.parquet(f"{root}/sink").drop("_ingested_at")


@register(
    "stream_live30",
    sql="SELECT event_id, ts, user_id, event_type, value FROM events ORDER BY ts DESC, event_id DESC LIMIT 30",
)
def stream_live30(spark, sf_dir):
    """SM2 / SNK3: the newest 30 records, maintained batch by batch."""
    root = scratch_path(spark, "stream-live")
    st = _polls(spark, sf_dir, root)
    jobs.live_latest(st, f"{root}/live", f"{root}/_checkpoint", [F.desc("ts"), F.desc("event_id")], n=30)
    return jobs.read_live(spark, f"{root}/live", st.schema)


@register(
    "stream_dedup",
    sql="SELECT event_id, ts, user_id, event_type, value FROM events",
)
def stream_dedup(spark, sf_dir):
    """SM4: every record polled twice, the repeats in later micro-batches and some batches late."""
    root = scratch_path(spark, "stream-dedup")
    st = _polls(spark, sf_dir, root, n=3)
    for k in range(3):
        spark.read.parquet(f"{root}/landing/poll{k}").repartition(FILES).write.parquet(f"{root}/landing/poll{k}-again")
    st = jobs.event_time(st, "ts").drop("ts")
    kept = stateful.deduplicate(st, ["event_id"], "event_ts", ALL_S)
    stateful.append_to(kept, f"{root}/sink", f"{root}/_checkpoint")
    done = spark.read.schema(kept.schema).parquet(f"{root}/sink")
    return done.select("event_id", F.col("event_ts").cast("timestamp_ntz").alias("ts"), "user_id", "event_type", "value")


_HOURLY_COLUMNS = "date_trunc('hour', ts) AS period, event_type AS term, count(*) AS count, round(avg(value), 6) AS mean_value"


def _hourly_out(df):
    return df.filter("event_type IS NOT NULL").select(
        F.col("window.start").cast("timestamp_ntz").alias("period"), F.col("event_type").alias("term"), "count", F.round("mean_value", 6).alias("mean_value")
    )


@register(
    "stream_hourly",
    sql=f"SELECT {_HOURLY_COLUMNS} FROM events GROUP BY ALL",
)
def stream_hourly(spark, sf_dir):
    """SM5 / SM3: hourly counts and means per type, restated as a whole after each micro-batch (complete mode on the state store)."""
    root = scratch_path(spark, "stream-hourly")
    st = jobs.event_time(_polls(spark, sf_dir, root), "ts")
    counts = stateful.windowed(st, "event_ts", ["event_type"], "1 hour", ALL_S, "value")
    stateful.complete_to(counts, f"{root}/table", f"{root}/_checkpoint")
    return _hourly_out(stateful.read_complete(spark, f"{root}/table", counts.schema))


@register(
    "stream_velocity",
    sql="""WITH p AS (SELECT user_id, value, lag(value) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS prev_value FROM events)
           SELECT user_id, max(value) AS current_value, round(sum(value - prev_value), 6) AS total_gain,
                  round(avg(value - prev_value), 6) AS avg_gain, count(*) AS observation_count
           FROM p WHERE prev_value IS NOT NULL GROUP BY user_id""",
)
def stream_velocity(spark, sf_dir):
    """SM6: velocity over four micro-batches, three of them older than the first."""
    root = scratch_path(spark, "stream-velocity")
    st = _polls(spark, sf_dir, root, ("user_id", "ts", "event_id", "value"))
    _heartbeat(spark, sf_dir, root, st.schema, "zz", 2 * ALL_S)
    out = stateful.gains(jobs.event_time(st, "ts").drop("ts"), "user_id", "event_ts", "event_id", "value", ALL_S)
    stateful.append_to(out, f"{root}/sink", f"{root}/_checkpoint")
    g = spark.read.schema(out.schema).parquet(f"{root}/sink").filter(F.col("prev_value").isNotNull())
    return g.groupBy("user_id").agg(
        F.max("value").alias("current_value"),
        F.round(F.sum("gain"), 6).alias("total_gain"),
        F.round(F.avg("gain"), 6).alias("avg_gain"),
        F.count(F.lit(1)).alias("observation_count"),
    )


@register(
    "stream_near",
    sql=_range_sql("event_type = 'error'", "event_type = 'click'", 3600, 3600, name="near_count"),
)
def stream_near(spark, sf_dir):
    """SM7: events around each anchor, counted as both arrive on a stream."""
    root = scratch_path(spark, "stream-near")
    base = _polls(spark, sf_dir, root)
    st = base.select("ts", (F.col("event_type") == "error").alias("anchor"), (F.col("event_type") == "click").alias("event"))
    jobs.near_counts(st, "ts", "anchor", "event", 3600, f"{root}/state", f"{root}/_checkpoint")
    counts = jobs.read_near(spark, f"{root}/state", "ts", st.schema)
    a = table(spark, sf_dir, "events").filter(F.col("event_type") == "error").select("event_id", "ts")
    return a.join(counts, "ts", "left").select("event_id", "ts", F.coalesce("near_count", F.lit(0)).cast("long").alias("near_count"))


@register(
    "stream_cycle",
    sql="""WITH c AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn FROM events) WHERE rn = 1)
           SELECT 'by_type' AS output, event_type AS name, count(*)::DOUBLE AS number FROM c GROUP BY event_type
           UNION ALL SELECT 'top', user_id::VARCHAR, value FROM (SELECT * FROM c ORDER BY value DESC, user_id LIMIT 10)""",
)
def stream_cycle(spark, sf_dir):
    """SM3: the analysis cycle repeated after each micro-batch, on the latest row per entity."""
    root = scratch_path(spark, "stream-cycle")

    def cycle(current):
        by_type = current.groupBy(F.col("event_type").alias("name")).agg(F.count(F.lit(1)).cast("double").alias("number"))
        top = current.orderBy(F.desc("value"), "user_id").limit(10).select(F.col("user_id").cast("string").alias("name"), F.col("value").alias("number"))
        return {"by_type": by_type, "top": top}

    jobs.cycle_stream(_polls(spark, sf_dir, root), cycle, ["user_id"], ["ts", "event_id"], f"{root}/out", f"{root}/_checkpoint")
    schema = spark.createDataFrame([], "name string, number double").schema
    parts = [jobs.read_cycle(spark, f"{root}/out", n, schema).select(F.lit(n).alias("output"), "name", "number") for n in ("by_type", "top")]
    return parts[0].unionByName(parts[1])


def _follow_sql(anchor, event, after):
    return f"""SELECT a.event_id AS alert_id, a.ts AS alert_ts, b.event_id AS article_id, b.ts AS article_ts, b.value AS article_value
        FROM events a JOIN events b ON b.ts BETWEEN a.ts AND a.ts + INTERVAL {after} SECOND WHERE a.{anchor} AND b.{event}"""


@register("stream_pairs", sql=_follow_sql("event_type = 'error'", "event_type = 'click'", 900))
def stream_pairs(spark, sf_dir):
    """SM7: alerts and the articles that follow within a quarter of an hour, joined as two watermarked streams over six disordered polls."""
    root = scratch_path(spark, "stream-pairs")
    st = jobs.event_time(_disordered_polls(spark, sf_dir, root), "ts").drop("ts")
    side = lambda kind, name: st.filter(F.col("event_type").isNull() | (F.col("event_type") == kind)).select(
        F.col("event_id").alias(f"{name}_id"), F.col("event_ts").alias(f"{name}_ts"), F.col("value").alias(f"{name}_value")
    )
    pairs = stateful.interval_join(side("error", "alert"), side("click", "article"), "alert_ts", "article_ts", 0, 900, DELAY_S, salt=2)
    stateful.append_to(pairs, f"{root}/sink", f"{root}/_checkpoint")
    out = spark.read.schema(pairs.schema).parquet(f"{root}/sink").filter("alert_id IS NOT NULL AND article_id IS NOT NULL")
    times = [F.col(c).cast("timestamp_ntz").alias(c) for c in ("alert_ts", "article_ts")]
    return out.select("alert_id", times[0], "article_id", times[1], "article_value")


@register(
    "stream_gains",
    sql="""SELECT user_id, ts, event_id, value, lag(value) OVER w AS prev_value, round(value - lag(value) OVER w, 6) AS gain
           FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)""",
)
def stream_gains(spark, sf_dir):
    """SM6: the gain of every observation over its entity's one before, from keyed state, over six disordered polls and a heartbeat."""
    root = scratch_path(spark, "stream-gains")
    st = jobs.event_time(_disordered_polls(spark, sf_dir, root), "ts").drop("ts")
    out = stateful.gains(st, "user_id", "event_ts", "event_id", "value", DELAY_S)
    stateful.append_to(out, f"{root}/sink", f"{root}/_checkpoint")
    done = spark.read.schema(out.schema).parquet(f"{root}/sink")
    return done.select("user_id", F.col("event_ts").cast("timestamp_ntz").alias("ts"), "event_id", "value", "prev_value", F.round("gain", 6).alias("gain"))


@register("stream_repeats", sql="SELECT event_id, user_id, event_type, value FROM events")
def stream_repeats(spark, sf_dir):
    """SM4: records observed again on other dates, in the same and in later micro-batches: one row each from the state store."""
    root = scratch_path(spark, "stream-repeats")
    ev = table(spark, sf_dir, "events").select(*COLUMNS)
    first = ev.select(F.min("ts")).scalar().cast("timestamp")
    seen = lambda poll, day: (first + F.make_dt_interval(days=F.lit(poll) + day)).alias("seen")
    part = F.pmod(F.xxhash64("event_id"), F.lit(3)).cast("int")
    copies = F.explode(F.array(F.lit(0), F.lit(1), F.lit(2))).alias("copy")
    # Three copies: in its poll, in the same poll under another date, and in a later poll.
    for k in range(4):
        all_copies = ev.select(*COLUMNS, part.alias("part"), copies).withColumn("poll", F.col("part") + (F.col("copy") == 2).cast("int"))
        rows = all_copies.filter(F.col("poll") == k).select(*COLUMNS, seen(k, F.col("copy")))
        rows.repartition(FILES).write.parquet(f"{root}/landing/poll{k}")
    st = jobs.file_stream(spark, f"{root}/landing/*", rows.schema, max_files=FILES)
    kept = stateful.deduplicate(st, ["event_id"], "seen", 10 * 86400).select("event_id", "user_id", "event_type", "value")
    stateful.append_to(kept, f"{root}/sink", f"{root}/_checkpoint")
    return spark.read.schema(kept.schema).parquet(f"{root}/sink")


_OPEN_S = 9 * 86400


@register(
    "stream_hourly_closed",
    sql=f"""SELECT {_HOURLY_COLUMNS} FROM events
            WHERE date_trunc('hour', ts) + INTERVAL 1 HOUR <= (SELECT max(ts) - INTERVAL {_OPEN_S} SECOND FROM events) GROUP BY ALL""",
)
def stream_hourly_closed(spark, sf_dir):
    """SM5: hourly results in append mode, each once, as the watermark closes its hour; the hours still open are not emitted."""
    root = scratch_path(spark, "stream-closed")
    st = jobs.event_time(_disordered_polls(spark, sf_dir, root), "ts").filter("event_id IS NOT NULL")
    counts = stateful.windowed(st, "event_ts", ["event_type"], "1 hour", _OPEN_S, "value")
    stateful.append_to(counts, f"{root}/sink", f"{root}/_checkpoint")
    return _hourly_out(spark.read.schema(counts.schema).parquet(f"{root}/sink"))


FLUSH_RECORDS = 4000


@register("stream_flush", sql="SELECT event_id, ts, user_id, event_type, value, true AS within_limit FROM events")
def stream_flush(spark, sf_dir):
    """SNK2 / SRC3: landed polls in flushes of ``FLUSH_RECORDS`` records, each flush one file, many in a micro-batch; the rest by time."""
    root = scratch_path(spark, "stream-flush")
    ev = table(spark, sf_dir, "events").select(*COLUMNS)
    for k in range(2):
        ev.filter(F.pmod(F.xxhash64("event_id"), F.lit(2)) == k).write.parquet(f"{root}/landing/poll{k}")
    st = polls.poll_stream(spark, f"{root}/landing", ev.schema, f"{root}/offsets", FLUSH_RECORDS, max_seconds=0, flushes=512)
    polls.flush_to(st, f"{root}/sink", f"{root}/_checkpoint", max_records=FLUSH_RECORDS)
    landed = spark.read.schema(ev.schema).parquet(f"{root}/sink").withColumn("file", F.input_file_name())
    sizes = landed.groupBy("file").agg((F.count(F.lit(1)) <= FLUSH_RECORDS).alias("within_limit"))
    return landed.join(sizes, "file").drop("file")
