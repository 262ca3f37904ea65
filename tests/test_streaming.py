"""Streaming properties: exactly-once reruns and order-independent velocity."""

from pyspark.sql import functions as F

from conftest import SF01
from strata.session import scratch_path
from strata.streaming import jobs, stateful

def heartbeat(ev, days):
    """One row without an entity, ``days`` after the last."""
    last = ev.agg((F.max("ts") + F.make_dt_interval(days=F.lit(days))).alias("t"))
    return last.select(*[(F.col("t") if f.name == "ts" else F.lit(None)).cast(f.dataType).alias(f.name) for f in ev.schema.fields])


def test_rerun_with_same_checkpoint_adds_nothing(spark):
    ev = spark.read.parquet(f"{SF01}/events.parquet")
    root = scratch_path(spark, "t-ingest")
    for _ in range(2):
        jobs.ingest(jobs.file_stream(spark, f"{SF01}/event[s].parquet", ev.schema), "events", f"{root}/sink",
                    f"{root}/ck")
    assert spark.read.parquet(f"{root}/sink").count() == ev.count()


def test_velocity_stream_out_of_order_equals_batch(spark):
    """Files arrive newest first (every batch is late for every entity after the
    first): the gains still equal the batch result."""
    ev = spark.read.parquet(f"{SF01}/events.parquet").select("user_id", "ts", "event_id", "value")
    root = scratch_path(spark, "t-vel")
    # Three landing folders written newest-first, read one folder per batch.
    parts = ev.withColumn("_q", F.when(F.col("ts") >= "2024-01-20", 0).when(F.col("ts") >= "2024-01-10", 1).otherwise(2))
    for q in (0, 1, 2):
        parts.filter(F.col("_q") == q).drop("_q").coalesce(1).write.parquet(f"{root}/landing/q{q}")
    heartbeat(ev, 800).write.parquet(f"{root}/landing/q3")
    src = jobs.event_time(jobs.file_stream(spark, f"{root}/landing/*", ev.schema, max_files=1), "ts")
    out = stateful.gains(src, "user_id", "event_ts", "event_id", "value", 400 * 86400)
    stateful.append_to(out, f"{root}/sink", f"{root}/ck")
    g = spark.read.parquet(f"{root}/sink")
    got = {r["user_id"]: (r["n"], round(r["s"], 6)) for r in g.filter(F.col("prev_value").isNotNull())
           .groupBy("user_id").agg(F.count(F.lit(1)).alias("n"), F.sum("gain").alias("s")).collect()}
    from pyspark.sql import Window
    w = Window.partitionBy("user_id").orderBy("ts", "event_id")
    exp_df = ev.withColumn("p", F.lag("value").over(w)).filter(F.col("p").isNotNull())
    exp = {r["user_id"]: (r["n"], round(r["s"], 6)) for r in exp_df.groupBy("user_id").agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.col("value") - F.col("p")).alias("s")).collect()}
    assert got == exp


def test_a_replayed_epoch_changes_nothing(spark):
    """Slots and epoch folders after a batch is run twice, as after a crash before its checkpoint."""
    from strata.streaming import batches

    root = scratch_path(spark, "t-replay")
    rows = lambda *v: spark.createDataFrame([(x,) for x in v], "v int").coalesce(1)
    for epoch, batch in ((0, rows(5, 1)), (0, rows(5, 1)), (3, rows(9)), (3, rows(9)), (4, rows(2))):
        slots = batches.Slots(spark, f"{root}/slots", batch.schema)
        before, slot = slots.before(epoch)
        slots.write(before.unionByName(batch), epoch, slot)
        batches.put(batch, f"{root}/rows", epoch)
    assert sorted(r["v"] for r in slots.latest().collect()) == [1, 2, 5, 9]
    assert sorted(r["v"] for r in batches.get(spark, f"{root}/rows", batch.schema).collect()) == [1, 2, 5, 9]


def test_an_empty_state_replaces_one_with_rows(spark):
    from strata.streaming import batches

    root, rows = scratch_path(spark, "t-empty"), spark.createDataFrame([(1,)], "v int")
    for epoch, batch in ((0, rows), (1, rows.limit(0))):
        slots = batches.Slots(spark, f"{root}/s", rows.schema)
        slots.write(batch, epoch, slots.before(epoch)[1])
    assert slots.epoch() == 1 and slots.latest().count() == 0


def test_buckets_rewrite_only_those_of_the_batch(spark):
    """A replayed epoch starts from the same state; buckets without rows of the batch keep their files."""
    import glob

    from strata.operators import clean
    from strata.streaming import batches

    root = scratch_path(spark, "t-buckets")
    rows = lambda *v: spark.createDataFrame(v, "k long, t long, v string")
    newest = lambda both: clean.latest_per_key(both, ["k"], ["t"])
    table = lambda: batches.Buckets(spark, f"{root}/t", rows((1, 1, "x")).schema, ["k"], 4)
    state = lambda: {r["k"]: (r["t"], r["v"]) for r in table().latest().collect()}
    assert table().latest().count() == 0
    everyone = table().merge(rows(*[(k, 0, "a") for k in range(40)], (None, 3, "n")), 0, newest)
    assert everyone == [0, 1, 2, 3] and len(state()) == 41
    files = set(glob.glob(f"{root}/t/_bucket=*/_slot=*/*.parquet"))
    for _ in range(2):  # the second time as after a crash before the checkpoint
        touched = table().merge(rows((7, 5, "b"), (7, 4, "old"), (100, 1, "new")), 1, newest)
        assert state() == {**{k: (0, "a") for k in range(40)}, None: (3, "n"), 7: (5, "b"), 100: (1, "new")}
    now = set(glob.glob(f"{root}/t/_bucket=*/_slot=*/*.parquet"))
    assert files < now and len(touched) < 4 and {int(f.split("_bucket=")[1].split("/")[0]) for f in now - files} == set(touched)
    # A late row changes nothing; the bucket goes back to its first slot.
    table().merge(rows((7, 1, "late")), 2, newest)
    assert state()[7] == (5, "b") and len(state()) == 42
    plan = table()._read({0: 1, 2: 0})._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and "_bucket" in plan.split("PartitionFilters")[1]


def test_merged_partials_count_once(spark, monkeypatch):
    """Partials of past epochs become one table; a crash before their removal, or a second run, changes nothing."""
    import glob

    from strata.streaming import batches

    root = scratch_path(spark, "t-compact")
    rows = lambda *v: spark.createDataFrame(v, "t long, n long")
    schema = rows((1, 1)).schema
    summed = lambda df: df.groupBy("t").agg(F.sum("n").alias("n"))
    read = lambda: {r["t"]: r["n"] for r in summed(batches.merged(spark, f"{root}/p", schema)).collect()}
    assert read() == {}
    expected = {}
    for epoch in range(7):
        if epoch in (3, 6):
            with monkeypatch.context() as m:
                m.setattr(batches, "_remove_epochs", lambda *a: (_ for _ in ()).throw(RuntimeError("crash")))
                try:
                    batches.compact(spark, f"{root}/p", schema, epoch - 1, summed)
                except RuntimeError:
                    pass
            assert read() == expected
            batches.compact(spark, f"{root}/p", schema, epoch - 1, summed)
            assert read() == expected and not glob.glob(f"{root}/p/_batch=*/*.parquet")
        batches.put(rows((1, epoch), (epoch, 10)), f"{root}/p", epoch)
        for t, n in ((1, epoch), (epoch, 10)):
            expected[t] = expected.get(t, 0) + n
        assert read() == expected
    assert len(glob.glob(f"{root}/p/_batch=*")) == 1


def test_near_counts_are_the_same_when_merged(spark):
    ev = spark.read.parquet(f"{SF01}/events.parquet")
    rows = ev.select("ts", (F.col("event_type") == "error").alias("anchor"), (F.col("event_type") == "click").alias("event"))
    root = scratch_path(spark, "t-near")
    part = rows.withColumn("_p", F.pmod(F.xxhash64("ts", "anchor"), F.lit(5)))
    for k in range(5):
        part.filter(F.col("_p") == k).drop("_p").coalesce(1).write.parquet(f"{root}/landing/p{k}")
    got = []
    for name, every in (("a", 2), ("b", 100)):
        st = jobs.file_stream(spark, f"{root}/landing/*", rows.schema, max_files=1)
        jobs.near_counts(st, "ts", "anchor", "event", 3600, f"{root}/{name}", f"{root}/ck-{name}", compact_every=every)
        got.append(sorted((r["ts"], r["near_count"]) for r in jobs.read_near(spark, f"{root}/{name}", "ts", rows.schema).collect()))
    assert got[0] and got[0] == got[1]
