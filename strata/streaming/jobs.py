"""Structured Streaming jobs without a state store: ingestion, the live list, proximity counts, repeated cycles (SM1-SM3, SM7, SRC3, SNK2, SNK3).

Every job is a ``readStream`` -> transformations -> ``writeStream`` with a
``checkpointLocation`` in the shared checkpoint folder, so a restarted or
re-run query resumes exactly where it stopped (a rerun over the same input adds
nothing). Tests and the catalog drive them with ``trigger(availableNow=True)``;
production uses ``processingTime``.

Results are partials that can be merged, or restated, one set per micro-batch, so rows that arrive late, in
whatever order, are counted like any others. A micro-batch reads only the partitions of earlier data that its own rows touch. Operators
that keep state between micro-batches (joins, velocity, deduplication, windows) are in ``stateful``, on Spark's state store.
"""

from __future__ import annotations

import datetime as dt
import math
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.operators import clean, joins
from strata.streaming import batches


def file_stream(spark: SparkSession, path: str, schema: T.StructType, fmt: str = "parquet",
                max_files: int | None = None) -> DataFrame:
    """A file source with a declared schema (``maxFilesPerTrigger`` bounds a batch)."""
    r = spark.readStream.schema(schema).format(fmt)
    if max_files:
        r = r.option("maxFilesPerTrigger", max_files)
    return r.load(path)


def kafka_stream(spark: SparkSession, servers: str, topics: str, schema: T.StructType) -> DataFrame:
    """SRC3: subscribe from earliest and decode the JSON value (needs the Kafka
    connector on the classpath; not available in the test image)."""
    raw = (
        spark.readStream.format("kafka").option("kafka.bootstrap.servers", servers)
        .option("subscribe", topics).option("startingOffsets", "earliest").load()
    )
    return raw.select(
        F.col("key").cast("string").alias("key"),
        F.from_json(F.col("value").cast("string"), schema).alias("v"),
        F.col("topic"),
        F.col("timestamp").alias("_kafka_ts"),
    ).select("key", "v.*", "topic", "_kafka_ts")


def event_time(df: DataFrame, col: str, out: str = "event_ts") -> DataFrame:
    return df.withColumn(out, F.col(col).cast("timestamp"))


def _run(writer, available_now: bool = True, processing_time: str | None = None):
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime=processing_time)
    q = writer.start()
    q.awaitTermination()
    if q.exception():
        raise q.exception()
    return q


def ingest(stream: DataFrame, source: str, sink: str, checkpoint: str, fmt: str = "parquet",
           available_now: bool = True, processing_time: str = "60 seconds", compression: str | None = None):
    """SM1 / SNK2: append every record with ingest metadata to a file sink."""
    tagged = clean.add_ingest_metadata(stream, source)
    w = tagged.writeStream.format(fmt).option("path", sink).option("checkpointLocation", checkpoint).outputMode("append")
    if compression:
        w = w.option("compression", compression)
    return _run(w, available_now, processing_time)


def each_batch(stream: DataFrame, step, checkpoint: str, available_now: bool, keep: bool = True):
    """Run ``step(rows, epoch)`` for each micro-batch; its rows are kept while several actions use them.

    Without ``keep`` each action reads from the source the columns that it needs: for batches of any size, and wide rows.
    """

    def run(batch: DataFrame, epoch: int) -> None:
        rows = batch.persist() if keep else batch  # bounded by maxFilesPerTrigger / maxOffsetsPerTrigger
        try:
            with batches.adaptive(batch.sparkSession):
                step(rows, epoch)
        finally:
            if keep:
                rows.unpersist()

    return _run(stream.writeStream.foreachBatch(run).option("checkpointLocation", checkpoint), available_now)


def live_latest(stream: DataFrame, table: str, checkpoint: str, order: Sequence, n: int = 30,
                available_now: bool = True):
    """SM2 / SNK3: newest ``n`` records across all batches.

    Each batch: previous list union batch, top ``n`` (``TakeOrderedAndProject``), written to the other of two slots:
    storage stays at two lists, and a replayed batch starts from the same previous list.
    """

    def step(rows: DataFrame, epoch: int) -> None:
        slots = batches.Slots(rows.sparkSession, table, rows.schema)
        before, slot = slots.before(epoch)
        slots.write(before.unionByName(rows).orderBy(*order).limit(n), epoch, slot)

    return each_batch(stream, step, checkpoint, available_now)


def read_live(spark: SparkSession, table: str, schema: T.StructType) -> DataFrame:
    return batches.Slots(spark, table, schema).latest()


def _values(rows: DataFrame, col: str) -> list:
    """The distinct values of a partition column in a micro-batch: days or buckets, a few per batch."""
    return [r[0] for r in rows.select(col).distinct().collect()]


def _sum_near(counts: DataFrame, ts: str) -> DataFrame:
    return counts.groupBy(ts).agg(F.sum("n").alias("n"))


def near_counts(stream: DataFrame, ts: str, anchor: str, event: str, seconds: int, root: str, checkpoint: str,
                available_now: bool = True, compact_every: int = 16):
    """SM7: per anchor the events within +-``seconds``, on a stream of both (boolean columns ``anchor`` and ``event``).

    Rows land in partitions of their day. Each batch adds two partial counts: its events around all anchors so far, and the
    events of earlier batches around its anchors. Both come from one ordered scan over the rows within reach of the batch's
    time span, so no (anchor, event) pair is formed or kept, whatever a burst holds. ``read_near`` sums the partials; every
    ``compact_every`` batches those before are merged into one per anchor time, so there are never more folders of them than that.
    """
    day = F.floor(F.unix_seconds(F.col(ts).cast("timestamp")) / 86400).cast("long")

    def step(batch: DataFrame, epoch: int) -> None:
        spark = batch.sparkSession
        rows = batch.filter(F.col(ts).isNotNull()).select(ts, anchor, event, day.alias("_day"))
        first, last = rows.agg(F.min(ts), F.max(ts)).first()
        if first is None:
            return
        batches.put(rows, f"{root}/rows", epoch, ["_day"])
        reach = dt.timedelta(seconds=seconds)
        days = [math.floor(t.replace(tzinfo=dt.timezone.utc).timestamp() / 86400) for t in (first - reach, last + reach)]
        past = batches.get(spark, f"{root}/rows", rows.schema, ["_day"])
        # One day more on both sides: the session's time zone may shift the bounds; the exact cut is by time.
        past = past.filter(F.col("_day").between(days[0] - 1, days[1] + 1) & F.col(ts).between(first - reach, last + reach) & (F.col(batches.BATCH) <= epoch))
        own = F.col(batches.BATCH) == epoch
        # An anchor time that came before and comes again has had the earlier events counted.
        times = past.filter(F.col(anchor)).groupBy(ts).agg(F.min(own.cast("int")).alias("_fresh"))
        sums = {"_new": own.cast("long"), "_old": (~own).cast("long")}
        found = joins.range_sums(times, past.filter(F.col(event)), ts, ts, seconds, seconds, sums)
        counted = found.select(ts, (F.col("_new") + F.col("_fresh") * F.col("_old")).alias("n"))
        if epoch and epoch % compact_every == 0:
            batches.compact(spark, f"{root}/counts", _near_schema(ts, rows.schema), epoch - 1, lambda counts: _sum_near(counts, ts))
        batches.put(counted.filter("n > 0"), f"{root}/counts", epoch)

    return each_batch(stream, step, checkpoint, available_now)


def _near_schema(ts: str, schema: T.StructType) -> T.StructType:
    return T.StructType([schema[ts], T.StructField("n", T.LongType())])


def read_near(spark: SparkSession, root: str, ts: str, schema: T.StructType) -> DataFrame:
    """(anchor time, near_count); anchors without events have no row."""
    return _sum_near(batches.merged(spark, f"{root}/counts", _near_schema(ts, schema)), ts).withColumnRenamed("n", "near_count")


def cycle_stream(stream: DataFrame, cycle, keys: Sequence[str], order: Sequence[str], root: str, checkpoint: str,
                 available_now: bool = True, buckets: int = 8):
    """SM3: a repeated analysis cycle: after each batch ``cycle(current)`` (name -> DataFrame) replaces its outputs under ``root``.

    ``current`` is the latest row per key of all batches so far, in ``buckets`` by key: a batch rewrites the buckets of its own
    keys. Each output has two slots, so a reader always finds one (``read_cycle``).
    """

    def step(rows: DataFrame, epoch: int) -> None:
        spark = rows.sparkSession
        current = batches.Buckets(spark, f"{root}/current", rows.schema, keys, buckets)
        current.merge(rows, epoch, lambda both: clean.latest_per_key(both, list(keys), list(order)))
        for name, out in cycle(current.latest()).items():
            slots = batches.Slots(spark, f"{root}/{name}", out.schema)
            slots.write(out, epoch, slots.before(epoch)[1])

    return each_batch(stream, step, checkpoint, available_now)


def read_cycle(spark: SparkSession, root: str, name: str, schema: T.StructType) -> DataFrame:
    """The newest output ``name`` of a repeated cycle."""
    return batches.Slots(spark, f"{root}/{name}", schema).latest()
