"""Streaming operators on Spark's own state store: interval join, keyed velocity, deduplication, windowed aggregation.

State lives in the RocksDB store of each query's checkpoint, so a query that was killed goes on from its last finished
micro-batch and a lost executor's state is read again from the shared folder. A watermark bounds the state: ``delay`` is
how late a row may come. A row that is later than that may be left out by the operator; ``late_rows`` keeps such rows in a table of
their own, so that nothing is lost without a trace, and ``progress`` reports state sizes and dropped rows per micro-batch.

Event times are ``timestamp`` columns (``jobs.event_time`` casts). Rows without an event time take no part in joins and windows.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator, Sequence
from contextlib import contextmanager
from functools import reduce
from itertools import islice, pairwise

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from strata.streaming import batches
from strata.streaming.jobs import each_batch

# Processors travel to the Python workers by value: executors need no copy of this repository.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

_ROCKSDB = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    # A micro-batch uploads what it changed, not the whole store.
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


@contextmanager
def _rocksdb(spark: SparkSession):
    """The store for queries started inside; each query's checkpoint remembers it."""
    before = {k: spark.conf.get(k, None) for k in _ROCKSDB}
    for k, v in _ROCKSDB.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def append_to(stream: DataFrame, sink: str, checkpoint: str, available_now: bool = True, processing_time: str = "60 seconds") -> StreamingQuery:
    """Append what a stateful query emits to a Parquet folder, each row once, also after restarts."""
    with _rocksdb(stream.sparkSession):
        w = stream.writeStream.format("parquet").option("path", sink).option("checkpointLocation", checkpoint).outputMode("append")
        q = (w.trigger(availableNow=True) if available_now else w.trigger(processingTime=processing_time)).start()
    q.awaitTermination()
    if q.exception():
        raise q.exception()
    return q


def progress(q: StreamingQuery) -> list[dict]:
    """Per micro-batch and stateful operator: input rows, rows and bytes in state, rows dropped behind the watermark."""
    return [
        {
            "batch": p["batchId"], "input_rows": p["numInputRows"], "watermark": (p["eventTime"] or {}).get("watermark"), "operator": s["operatorName"],
            "state_rows": s["numRowsTotal"], "state_bytes": s["memoryUsedBytes"], "dropped_rows": s["numRowsDroppedByWatermark"],
        }
        for p in q.recentProgress for s in p["stateOperators"]
    ]


def late_rows(stream: DataFrame, ts: str, delay_s: int, root: str, checkpoint: str, available_now: bool = True) -> StreamingQuery:
    """Keep the rows that come more than ``delay_s`` seconds behind the newest row of earlier micro-batches.

    These are the rows that an operator with this delay may leave out (Spark itself drops them one micro-batch later at the earliest).
    """
    horizon = T.StructType([T.StructField("newest", T.TimestampType())])

    def step(rows: DataFrame, epoch: int) -> None:
        slots = batches.Slots(rows.sparkSession, f"{root}/horizon", horizon)
        before, slot = slots.before(epoch)
        newest = before.agg(F.max("newest")).first()[0]
        late = rows.filter(F.col(ts) < F.lit(newest) - F.make_dt_interval(secs=F.lit(delay_s))) if newest else rows.limit(0)
        batches.put(late, f"{root}/late", epoch)
        slots.write(before.unionByName(rows.select(F.col(ts).alias("newest"))).agg(F.max("newest").alias("newest")), epoch, slot)

    return each_batch(stream, step, checkpoint, available_now)


def read_late(spark: SparkSession, root: str, schema: T.StructType) -> DataFrame:
    return batches.get(spark, f"{root}/late", schema).drop(batches.BATCH)


def _seconds(n: int) -> Column:
    return F.make_dt_interval(secs=F.lit(n))


#: Rows that ``interval_join`` sorts into blocks at a time, and rows of a block.
PACK, PACK_BLOCK = 100_000, 1000


def _pack(batches_: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(_b, _s, _h, _micros, _row) to blocks (_b, _s, _h, _micros, _rows): rows of equal (_b, _s, _h) as an array, with their latest time."""

    def packed(held: list[pa.RecordBatch]) -> pa.RecordBatch:
        t = pa.Table.from_batches(held).combine_chunks()
        of = {c: t[c].to_numpy() for c in ("_b", "_s", "_h", "_micros")}
        order = np.lexsort((of["_micros"], of["_h"], of["_s"], of["_b"]))
        of = {c: v[order] for c, v in of.items()}
        changes = np.flatnonzero(np.any([v[1:] != v[:-1] for c, v in of.items() if c != "_micros"], axis=0)) + 1
        edges = np.concatenate([[0], changes, [len(order)]])
        starts = np.concatenate([np.arange(i, j, PACK_BLOCK) for i, j in pairwise(edges)])
        ends = np.append(starts[1:], len(order))
        rows = t["_row"].combine_chunks().take(pa.array(order))
        rows = rows.combine_chunks() if isinstance(rows, pa.ChunkedArray) else rows
        arrays = [*(pa.array(of[c][starts]) for c in ("_b", "_s", "_h")), pa.array(of["_micros"][ends - 1])]
        arrays.append(pa.ListArray.from_arrays(pa.array(np.append(starts, len(order)).astype("int32")), rows))
        return pa.RecordBatch.from_arrays(arrays, names=["_b", "_s", "_h", "_micros", "_rows"])

    held, n = [], 0
    for batch in batches_:
        if batch.num_rows:
            held, n = [*held, batch], n + batch.num_rows
        if n >= PACK:
            yield packed(held)
            held, n = [], 0
    if held:
        yield packed(held)


def _blocks_of(rows: DataFrame, name: str, delay: str) -> DataFrame:
    """The rows (_b, _s, _h, _micros, _row) in blocks: columns ``_b``, ``_s``, ``_h``, ``_at`` (watermarked) and ``_rows``, each with ``name`` before it."""
    of = {f.name: f.dataType for f in rows.schema.fields}
    schema = T.StructType([T.StructField(c, of[c]) for c in ("_b", "_s", "_h", "_micros")] + [T.StructField("_rows", T.ArrayType(of["_row"]))])
    blocks = rows.mapInArrow(_pack, schema).withColumn("_at", F.timestamp_micros("_micros")).drop("_micros")
    return blocks.withColumnsRenamed({c: name + c for c in blocks.columns}).withWatermark(f"{name}_at", delay)


def interval_join(left: DataFrame, right: DataFrame, left_ts: str, right_ts: str, before_s: int, after_s: int, delay_s: int, keys: Sequence[str] = (), salt: int = 1) -> DataFrame:
    """SM7: pairs with ``right_ts`` in [left_ts - before, left_ts + after], both sides streams (or both batch).

    Spark's symmetric stateful join: each side's rows wait in state for partners of the other side. The equality it needs is a time
    bucket as wide as the interval: a left row goes to the at most two buckets that its interval touches, a right row to its own, so each pair meets
    once. With ``salt`` a bucket is spread over that many sub-buckets: right rows go to one by a hash, left rows to all.

    What waits and meets are blocks of up to ``PACK_BLOCK`` rows of one bucket (and hash of the keys) that came together, so that the store is asked per block
    and not per pair; the rows of two blocks are compared outside the store. A block's time is its latest row's. The range condition on these watermarked times, wider by
    the time that a block's rows lie apart, lets Spark evict blocks that can find no more partners. A block is late when all its rows are.
    Columns but ``keys`` must have distinct names; the keys come from the left.
    """
    width = max(before_s + after_s, 1)
    delay = f"{delay_s} seconds"
    at = lambda c: F.unix_micros(c) / 1_000_000
    bucket = F.sequence(F.floor((at(F.col(left_ts)) - before_s) / width), F.floor((at(F.col(left_ts)) + after_s) / width))
    spread = F.pmod(F.xxhash64(*[c for c in right.columns]), F.lit(salt)).cast("int")
    hashed = F.xxhash64(*keys) if keys else F.lit(0).cast("long")

    def side(df: DataFrame, ts: str, b: Column, s: Column, name: str) -> DataFrame:
        complete = df.filter(reduce(lambda x, y: x & y, [F.col(c).isNotNull() for c in (ts, *keys)]))
        rows = complete.select(F.struct(*[c for c in df.columns if c != "_bucket"]).alias("_row"), b.alias("_b"), hashed.alias("_h"), F.unix_micros(ts).alias("_micros"), s.alias("_each"))
        return _blocks_of(rows.select("_b", F.explode("_each").alias("_s"), "_h", "_micros", "_row"), name, delay)

    a = side(left.withColumn("_bucket", F.explode(bucket)), left_ts, F.col("_bucket"), F.sequence(F.lit(0), F.lit(salt - 1)), "l")
    b = side(right, right_ts, F.floor(at(F.col(right_ts)) / width), F.array(spread), "r")
    on = (F.col("l_b") == F.col("r_b")) & (F.col("l_s") == F.col("r_s")) & (F.col("l_h") == F.col("r_h"))
    # The left rows of a bucket lie at most two widths apart, the right rows one.
    on &= (F.col("r_at") >= F.col("l_at") - _seconds(before_s + 2 * width)) & (F.col("r_at") <= F.col("l_at") + _seconds(after_s + width))
    pairs = a.join(b, on).select(F.explode("l_rows").alias("l"), "r_rows").select("l", F.explode("r_rows").alias("r"))
    of = lambda n, c: F.col(n).getField(c)
    near = (of("r", right_ts) >= of("l", left_ts) - _seconds(before_s)) & (of("r", right_ts) <= of("l", left_ts) + _seconds(after_s))
    for k in keys:
        near &= of("l", k) == of("r", k)
    return pairs.filter(near).select(*[of("l", c).alias(c) for c in left.columns], *[of("r", c).alias(c) for c in right.columns if c not in keys])


#: Groups of entities whose observations share the state of ``gains``, and observations in an element of its lists.
GROUPS, BLOCK = 1024, 1000


class Gains(StatefulProcessor):
    """Per group of entities: each entity's last value, and the observations that wait for the watermark, both as list state.

    A timer at the oldest waiting observation fires once the watermark has passed it. Then all observations up to the
    watermark are taken per entity in order of (time, tie), each with the gain over the one before it, and the last of them is kept. The
    order of arrival has no influence, and an observation is emitted once.

    Every call of the state is a message to the JVM, so an element of a list is a block of observations, and a group's calls do not grow with its
    entities. Last values are appended; the list is written anew once it has more than twice as many entries as entities.
    """

    def __init__(self, names: Sequence[str], waiting: T.StructType, last: T.StructType):
        self.out, self.schemas = Row(*names), (waiting, last)

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        waiting, last = (T.StructType([T.StructField("rows", T.ArrayType(s))]) for s in self.schemas)
        self.waiting = handle.getListState("waiting", waiting)
        self.last = handle.getListState("last", last)

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        # Rows without an entity only move the watermark.
        given = ((entity, micros, tie, measure) for _, _, entity, micros, tie, measure in rows if entity is not None and micros is not None)
        while new := list(islice(given, 64 * BLOCK)):
            self.waiting.appendList(_blocks(new))
            self.handle.registerTimer(_millis(min(r[1] for r in new)))
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        passed = timerValues.getCurrentWatermarkInMs() * 1000
        due, later = {}, []
        for (block,) in self.waiting.get():
            for r in block:
                if r[1] <= passed:
                    due.setdefault(_same(r[0]), []).append(r)
                else:
                    later.append(tuple(r))
        if not due:  # an earlier timer took them
            return
        last, entries = {}, 0
        for (block,) in self.last.get():
            last.update((_same(r[0]), tuple(r)) for r in block)
            entries += len(block)
        for same, observed in due.items():
            before = last[same][1] if same in last else None
            for entity, micros, tie, measure in sorted(observed, key=lambda r: (r[1], r[2] is None, r[2])):
                gain = measure - before if before is not None and measure is not None else None
                yield self.out(entity, micros, tie, measure, before, gain)
                before = measure
            last[same] = (entity, before)
        if entries + len(due) > 2 * len(last):
            self.last.put(_blocks(list(last.values())))
        else:
            self.last.appendList(_blocks([last[same] for same in due]))
        self.waiting.clear()
        if later:
            self.waiting.put(_blocks(later))
            self.handle.registerTimer(_millis(min(r[1] for r in later)))

    def close(self) -> None:
        pass


def _blocks(rows: list[tuple]) -> list[tuple]:
    return [(rows[k : k + BLOCK],) for k in range(0, len(rows), BLOCK)]


def _same(entity):
    """An entity as a key of a dict: equal where grouping finds it equal."""
    if isinstance(entity, bytearray):
        return bytes(entity)
    return entity if entity == entity else "NaN"


def _millis(micros: int) -> int:
    """A time as the store compares it: rounded up, so that a timer is not due before its row."""
    return -(-micros // 1000)


def gains(stream: DataFrame, key: str, ts: str, tie: str, measure: str, delay_s: int, processor: type[Gains] = Gains) -> DataFrame:
    """SM6: (key, ts, tie, measure, prev_value, gain) per observation once the watermark has passed it.

    A row without a key moves the watermark only (a heartbeat, which closes a stream that ended). Entities share the state in ``GROUPS`` groups
    by a hash; a task holds the waiting observations of one group at a time.
    """
    group = F.pmod(F.xxhash64(key), F.lit(GROUPS)).cast("int").alias("_g_group")
    at = F.col(ts).cast("timestamp")
    cols = stream.select(group, at.alias("_g_ts"), F.col(key).alias("_g_key"), F.unix_micros(at).alias("_g_micros"), F.col(tie).alias("_g_tie"), F.col(measure).alias("_g_measure"))
    fields = [T.StructField(f.name, f.dataType) for f in cols.schema.fields[2:]]
    change = [T.StructField(c, fields[3].dataType) for c in ("prev_value", "gain")]
    out = T.StructType(fields + change)
    made = processor(out.names, T.StructType(fields), T.StructType([fields[0], fields[3]]))
    found = cols.withWatermark("_g_ts", f"{delay_s} seconds").groupBy("_g_group").transformWithState(made, out, outputMode="append", timeMode="eventTime")
    names = [F.col("_g_key").alias(key), F.timestamp_micros("_g_micros").alias(ts), F.col("_g_tie").alias(tie), F.col("_g_measure").alias(measure)]
    return found.select(*names, "prev_value", "gain")


def deduplicate(stream: DataFrame, keys: Sequence[str], seen: str, delay_s: int) -> DataFrame:
    """SM4: the first copy of each record, by ``keys`` alone whatever its other columns or dates say.

    ``seen`` is when a copy was observed. A record's key stays in the state for ``delay_s`` after its first copy, which is how far apart copies may be
    to be known as such; the state holds the keys of that time only. Copies differ in ``seen``, so results should not carry it.
    """
    return stream.withWatermark(seen, f"{delay_s} seconds").dropDuplicatesWithinWatermark(list(keys))


def windowed(stream: DataFrame, ts: str, by: Sequence[str], width: str, delay_s: int, measure: str | None = None) -> DataFrame:
    """SM5: (window, by, count, mean_value) as window state; append mode emits a window once the watermark has passed its end."""
    mean = F.avg(measure) if measure else F.lit(None).cast("double")
    return stream.withWatermark(ts, f"{delay_s} seconds").groupBy(F.window(ts, width).alias("window"), *by).agg(F.count(F.lit(1)).alias("count"), mean.alias("mean_value"))


def complete_to(counts: DataFrame, table: str, checkpoint: str, available_now: bool = True) -> StreamingQuery:
    """Complete mode: after each micro-batch the whole result replaces ``table`` (two slots, so a reader always finds one)."""

    def step(rows: DataFrame, epoch: int) -> None:
        slots = batches.Slots(rows.sparkSession, table, rows.schema)
        slots.write(rows, epoch, slots.before(epoch)[1])

    with _rocksdb(counts.sparkSession):
        w = counts.writeStream.foreachBatch(step).outputMode("complete").option("checkpointLocation", checkpoint)
        q = (w.trigger(availableNow=True) if available_now else w.trigger(processingTime="60 seconds")).start()
    q.awaitTermination()
    if q.exception():
        raise q.exception()
    return q


def read_complete(spark: SparkSession, table: str, schema: T.StructType) -> DataFrame:
    return batches.Slots(spark, table, schema).latest()
