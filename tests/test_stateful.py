"""Streaming operators on the state store: bounded state, late rows, restarts, independence of how the input is cut."""

import datetime as dt
import random
import sys

import pytest
from pyspark import cloudpickle
from pyspark.sql import Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from strata.session import scratch_path
from strata.streaming import batches, jobs, stateful

cloudpickle.register_pickle_by_value(sys.modules[__name__])  # a processor of this module goes to the workers

START = dt.datetime(2024, 1, 1)
SCHEMA = "id long, key long, ts timestamp, value double"


def at(minutes):
    return START + dt.timedelta(minutes=minutes)


def land(spark, root, poll, rows):
    """A poll as a folder of one file, with a modification time of its own."""
    spark.createDataFrame(rows, SCHEMA).coalesce(1).write.parquet(f"{root}/landing/poll{poll:03d}")


def polls(seed, n=8, per=60, width=60, disorder=45):
    """Polls of ``width`` minutes each, whose rows come up to ``disorder`` minutes late."""
    draw = random.Random(seed)
    rows = [(k, draw.randint(1, 5), at(draw.randint(0, n * width * 10 - 1) / 10), float(draw.randint(0, 99))) for k in range(n * per)]
    out = [[] for _ in range(n + 1)]
    for r in rows:
        minutes = (r[2] - START).total_seconds() / 60 + draw.randint(0, disorder)
        out[min(int(minutes // width), n)].append(r)
    return rows, [p for p in out if p]


def stream(spark, root, schema, files=1):
    return jobs.file_stream(spark, f"{root}/landing/*", schema, max_files=files)


def beat(minutes):
    return [(None, None, at(minutes), None)]


def test_interval_join_evicts_its_state_and_late_rows_are_kept_aside(spark):
    rows, parts = polls(1, n=7)
    root = scratch_path(spark, "t-join")
    late = [(1000 + k, 1, at(k), 1.0) for k in range(5)]  # hours late
    for k, p in enumerate([*parts, late, [(2000, 1, at(900), 1.0)]]):
        land(spark, root, k, p)
    st = stream(spark, root, spark.createDataFrame([], SCHEMA).schema)
    side = lambda odd, n: st.filter(F.col("id") % 2 == odd).select(F.col("id").alias(n), F.col("key"), F.col("ts").alias(f"{n}_ts"))
    pairs = stateful.interval_join(side(1, "a"), side(0, "b"), "a_ts", "b_ts", 300, 600, 3600, keys=["key"], salt=3)
    q = stateful.append_to(pairs, f"{root}/sink", f"{root}/ck")
    got = sorted((r["a"], r["b"]) for r in spark.read.parquet(f"{root}/sink").collect())
    near = lambda a, b: a[1] == b[1] and -300 <= (b[2] - a[2]).total_seconds() <= 600
    assert got == sorted((a[0], b[0]) for a in rows if a[0] % 2 for b in rows if b[0] % 2 == 0 and near(a, b))
    report = stateful.progress(q)
    # In all, a left row has a copy per salt and bucket touched (900 s wide, so one or two); the state keeps those of a few hours.
    copies = len(rows) / 2 * (3 * 1.5 + 1)
    assert len(report) >= 6 and max(r["state_rows"] for r in report) < copies / 2 and report[-1]["state_rows"] < copies / 4
    assert sum(r["dropped_rows"] for r in report) >= len(late)
    stateful.late_rows(st, "ts", 3600, f"{root}/aside", f"{root}/ck-aside")
    assert sorted(r["id"] for r in stateful.read_late(spark, f"{root}/aside", st.schema).collect()) == [r[0] for r in late]
    # Run once more: nothing new, nothing twice.
    stateful.append_to(pairs, f"{root}/sink", f"{root}/ck")
    stateful.late_rows(st, "ts", 3600, f"{root}/aside", f"{root}/ck-aside")
    assert spark.read.parquet(f"{root}/sink").count() == len(got) and stateful.read_late(spark, f"{root}/aside", st.schema).count() == len(late)


def test_interval_join_keeps_blocks_of_a_dense_bucket(spark, monkeypatch):
    monkeypatch.setattr(stateful, "PACK_BLOCK", 64, raising=False)
    draw, root = random.Random(6), scratch_path(spark, "t-dense")
    rows = [(k, draw.choice([1, 2, None]), at(draw.randint(0, 450) / 10), 1.0) for k in range(900)] + [(5000, 1, None, 1.0), (5001, 1, None, 1.0)]
    for k in range(3):
        land(spark, root, k, rows[k::3])
    st = stream(spark, root, spark.createDataFrame([], SCHEMA).schema)
    side = lambda odd, n: st.filter(F.col("id") % 2 == odd).select(F.col("id").alias(n), F.col("key"), F.col("ts").alias(f"{n}_ts"))
    pairs = stateful.interval_join(side(1, "a"), side(0, "b"), "a_ts", "b_ts", 0, 900, 3600, keys=["key"])
    assert pairs.columns == ["a", "key", "a_ts", "b", "b_ts"]
    q = stateful.append_to(pairs, f"{root}/sink", f"{root}/ck")
    known = [r for r in rows if r[1] and r[2]]
    near = lambda a, b: a[1] == b[1] and 0 <= (b[2] - a[2]).total_seconds() <= 900
    expected = sorted((a[0], b[0]) for a in known if a[0] % 2 for b in known if b[0] % 2 == 0 and near(a, b))
    assert sorted((r["a"], r["b"]) for r in spark.read.parquet(f"{root}/sink").collect()) == expected
    # A block a bucket, key and poll, not a state row per row and bucket.
    assert max(r["state_rows"] for r in stateful.progress(q)) < 100


def test_interval_join_of_tables_meets_each_pair_once(spark):
    rows, _ = polls(2)
    t = spark.createDataFrame(rows + [(None, 1, None, 0.0)], SCHEMA)
    side = lambda odd, n: t.filter(F.col("id") % 2 == odd).select(F.col("id").alias(n), F.col("ts").alias(f"{n}_ts"))
    for before, after in ((0, 0), (0, 900), (900, 0), (120, 60)):
        expected = side(1, "a").join(side(0, "b"), F.expr(f"b_ts BETWEEN a_ts - INTERVAL {before} SECOND AND a_ts + INTERVAL {after} SECOND")).select("a", "b")
        for salt in (1, 4):
            got = stateful.interval_join(side(1, "a"), side(0, "b"), "a_ts", "b_ts", before, after, 60, salt=salt).select("a", "b")
            assert sorted(map(tuple, got.collect())) == sorted(map(tuple, expected.collect()))


def batch_gains(spark, rows):
    w = Window.partitionBy("key").orderBy("ts", "id")
    df = spark.createDataFrame(rows, SCHEMA).withColumn("prev_value", F.lag("value").over(w))
    return sorted((r["id"], r["prev_value"], r["gain"]) for r in df.withColumn("gain", F.col("value") - F.col("prev_value")).collect())


def run_gains(spark, root, processor=stateful.Gains) -> StreamingQuery:
    st = stream(spark, root, spark.createDataFrame([], SCHEMA).schema)
    return stateful.append_to(stateful.gains(st, "key", "ts", "id", "value", 3600, processor), f"{root}/sink", f"{root}/ck")


def read_gains(spark, root):
    return sorted((r["id"], r["prev_value"], r["gain"]) for r in spark.read.parquet(f"{root}/sink").collect())


class Killed(stateful.Gains):
    """Breaks off in the middle of a micro-batch."""

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        for n, r in enumerate(super().handleExpiredTimer(key, timerValues, expiredTimerInfo)):
            if n > 3:
                raise RuntimeError("killed")
            yield r


def test_keyed_gains_equal_batch_after_a_kill_and_restarts(spark):
    rows, parts = polls(3)
    root = scratch_path(spark, "t-gains")
    for k, p in enumerate(parts[:4]):
        land(spark, root, k, p)
    q = run_gains(spark, root)
    early = read_gains(spark, root)
    assert early and set(early) < set(batch_gains(spark, rows))  # what the watermark has passed is final
    assert {r["operator"] for r in stateful.progress(q)} == {"transformWithStateInPySparkExec"}
    for k, p in enumerate([*parts[4:], beat(10_000)], 4):
        land(spark, root, k, p)
    with pytest.raises(Exception, match="killed"):
        run_gains(spark, root, Killed)
    run_gains(spark, root)
    assert read_gains(spark, root) == batch_gains(spark, rows)
    run_gains(spark, root)
    assert read_gains(spark, root) == batch_gains(spark, rows)


def test_gains_of_a_row_behind_the_watermark_are_left_out(spark):
    root = scratch_path(spark, "t-late-gains")
    rows = [(1, 1, at(0), 1.0), (2, 1, at(30), 4.0), (3, 1, at(300), 9.0), (4, 1, at(301), 2.0), (5, 1, at(400), None)]
    for k, p in enumerate([rows[:2], rows[2:3], rows[3:4], [(9, 1, at(10), 5.0)], rows[4:], beat(10_000), beat(10_001)]):
        land(spark, root, k, p)
    run_gains(spark, root)
    assert read_gains(spark, root) == [(1, None, None), (2, 1.0, 3.0), (3, 4.0, 5.0), (4, 9.0, -7.0), (5, 2.0, None)]


def test_gains_keep_the_state_of_many_entities_in_few_groups(spark, monkeypatch):
    monkeypatch.setattr(stateful, "GROUPS", 8, raising=False)
    monkeypatch.setattr(stateful, "BLOCK", 70, raising=False)
    root = scratch_path(spark, "t-groups")
    rows = [(k * 1000 + e, e, at(20 * k + e % 7), None if (k + e) % 11 == 0 else float((k * e) % 13)) for k in range(8) for e in range(400)]
    rows += [(None, 5, at(500), 1.0), (None, 6, at(500), None), (9001, 6, at(500), 3.0)]  # a missing id comes last, as in the SQL
    for k in range(4):
        land(spark, root, k, [r for r in rows if (r[2] - START).total_seconds() // 2400 == min(k, 3) or (k == 3 and r[2] >= at(160))])
    land(spark, root, 4, beat(10_000))
    q = run_gains(spark, root)
    order = lambda found: sorted(found, key=str)
    got = order((r["id"], r["key"], r["prev_value"], r["gain"]) for r in spark.read.parquet(f"{root}/sink").collect())
    w = Window.partitionBy("key").orderBy("ts", F.col("id").asc_nulls_last())
    df = spark.createDataFrame(rows, SCHEMA).withColumn("prev", F.lag("value").over(w))
    assert got == order(map(tuple, df.select("id", "key", "prev", F.col("value") - F.col("prev")).collect()))
    # Not a state row per entity and observation, but blocks, timers and last values of 8 groups.
    assert max(r["state_rows"] for r in stateful.progress(q)) < 200


@pytest.mark.parametrize("files", [1, 2, 100])
def test_repeats_give_one_row_however_the_input_is_cut(spark, files):
    draw = random.Random(4)
    root = scratch_path(spark, "t-dedup")
    copies = [(k, k % 5, at(draw.randint(0, 2000)), float(k)) for k in range(100) for _ in range(3)]
    draw.shuffle(copies)
    for k in range(6):
        land(spark, root, k, copies[k::6])
    st = stream(spark, root, spark.createDataFrame([], SCHEMA).schema, files)
    kept = stateful.deduplicate(st, ["id"], "ts", 3 * 86400).drop("ts")
    for _ in range(2):
        stateful.append_to(kept, f"{root}/sink", f"{root}/ck")
        assert sorted(map(tuple, spark.read.schema(kept.schema).parquet(f"{root}/sink").collect())) == [(k, k % 5, float(k)) for k in range(100)]


def test_windows_complete_equals_batch_and_append_those_closed(spark):
    rows, parts = polls(5)
    root = scratch_path(spark, "t-windows")
    for k, p in enumerate([*parts, [(5000, 1, at(3), 7.0)]]):  # the last row is too late for append mode
        land(spark, root, k, p)
    st = stream(spark, root, spark.createDataFrame([], SCHEMA).schema)
    counts = stateful.windowed(st, "ts", ["key"], "10 minutes", 3600, "value")
    batch = lambda own: sorted(
        (r["window"]["start"], r["key"], r["count"], round(r["mean_value"], 9)) for r in stateful.windowed(spark.createDataFrame(own, SCHEMA), "ts", ["key"], "10 minutes", 3600, "value").collect()
    )
    read = lambda df: sorted((r["window"]["start"], r["key"], r["count"], round(r["mean_value"], 9)) for r in df.collect())
    stateful.complete_to(counts, f"{root}/complete", f"{root}/ck-complete")
    assert read(stateful.read_complete(spark, f"{root}/complete", counts.schema)) == batch([*rows, (5000, 1, at(3), 7.0)])
    q = stateful.append_to(counts, f"{root}/append", f"{root}/ck-append")
    closed = max(r[2] for r in rows) - dt.timedelta(hours=1)
    assert read(spark.read.schema(counts.schema).parquet(f"{root}/append")) == [r for r in batch(rows) if r[0] + dt.timedelta(minutes=10) <= closed]
    assert sum(r["dropped_rows"] for r in stateful.progress(q)) == 1


def test_a_day_with_a_third_of_the_rows_is_written_by_several_tasks(spark):
    n = 60_000
    rows = spark.range(n).select(F.col("id"), F.md5(F.col("id").cast("string")).alias("text"), F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 50).cast("int").alias("day"))
    root, before = scratch_path(spark, "t-put"), spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "200k")
    try:
        batches.put(rows.repartition(8), root, 0, ["day"])
    finally:
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", before)
    written = spark.read.parquet(root).withColumn("file", F.input_file_name()).groupBy("day").agg(F.count(F.lit(1)).alias("n"), F.count_distinct("file").alias("files"))
    files = {r["day"]: (r["n"], r["files"]) for r in written.collect()}
    assert files[0][0] > n / 3 and files[0][1] >= 4 and sum(x for d, (_, x) in files.items() if d) <= 2 * 49
