"""Property tests on random small fixtures, checked against brute force in plain Python."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from strata.operators import clean, joins, snapshots, stats
from strata.operators.sequence import ordered_scan
from strata.session import scratch_path

T0 = dt.datetime(2024, 1, 1)


def _rand_events(seed, n, keys, span_s, hot=None):
    rnd = random.Random(seed)
    rows = []
    for i in range(n):
        k = hot if hot is not None and rnd.random() < 0.5 else rnd.randrange(keys)
        # Coarse times make exact ties at the range bounds common.
        rows.append((i, k, T0 + dt.timedelta(seconds=rnd.randrange(span_s) // 60 * 60), rnd.choice([None, 1.0, 2.5, 7.0, -3.0])))
    return rows


@pytest.mark.parametrize("seed", range(4))
def test_range_count_matches_brute_force(spark, seed):
    rnd = random.Random(seed)
    a_rows = [(i, rnd.randrange(3), T0 + dt.timedelta(minutes=rnd.randrange(600))) for i in range(60)]
    e_rows = [(100 + i, rnd.randrange(3), T0 + dt.timedelta(minutes=rnd.randrange(600))) for i in range(200)]
    before, after = rnd.choice([0, 600, 3600]), rnd.choice([0, 1800, 3600])
    schema = "id long, k long, ts timestamp_ntz"
    a, e = spark.createDataFrame(a_rows, schema), spark.createDataFrame(e_rows, schema)
    for keys in ([], ["k"]):
        got = {r["id"]: r["n"] for r in joins.range_count(a, e, "ts", "ts", before, after, keys=keys, name="n").collect()}
        exp = {
            ai: sum(1 for _, ek, et in e_rows
                    if (not keys or ek == ak) and at - dt.timedelta(seconds=before) <= et <= at + dt.timedelta(seconds=after))
            for ai, ak, at in a_rows
        }
        assert got == exp


def test_range_count_with_repeated_and_incomplete_anchors(spark):
    """Text ids, equal anchors, and nulls in times and keys of both sides."""
    t = lambda m: None if m is None else T0 + dt.timedelta(minutes=m)
    a_rows = [("x", "k", t(5)), ("x", "k", t(5)), (None, "k", t(9)), ("y", None, t(5)), ("z", "k", None), ("w", "l", t(5))]
    e_rows = [("k", t(5)), ("k", t(6)), ("k", None), (None, t(5)), (None, None), ("l", t(90))]
    a = spark.createDataFrame(a_rows, "id string, k string, ts timestamp_ntz")
    e = spark.createDataFrame(e_rows, "k string, ets timestamp_ntz")
    with_key = joins.range_count(a, e, "ts", "ets", 240, 60, keys=["k"], name="n")
    assert with_key.columns == ["id", "k", "ts", "n"]
    got = sorted(((r["id"], r["k"], r["ts"], r["n"]) for r in with_key.collect()), key=repr)
    assert got == sorted([("x", "k", t(5), 2), ("x", "k", t(5), 2), (None, "k", t(9), 2), ("y", None, t(5), 0), ("z", "k", None, 0), ("w", "l", t(5), 0)], key=repr)
    plain = sorted(((r["id"], r["n"]) for r in joins.range_count(a, e, "ts", "ets", 0, 60, name="n").collect()), key=repr)
    assert plain == sorted([("x", 3), ("x", 3), (None, 0), ("y", 3), ("z", 0), ("w", 3)], key=repr)


@pytest.mark.parametrize("seed", range(3))
def test_range_join_pairs_match_brute_force(spark, seed):
    rnd = random.Random(seed)
    a_rows = [(i, T0 + dt.timedelta(minutes=rnd.randrange(300))) for i in range(40)]
    e_rows = [(100 + i, T0 + dt.timedelta(minutes=rnd.randrange(300))) for i in range(80)]
    a = spark.createDataFrame(a_rows, "id long, ts timestamp_ntz")
    e = spark.createDataFrame(e_rows, "eid long, ets timestamp_ntz")
    exp = sorted((ai, ei) for ai, at in a_rows for ei, et in e_rows
                 if at - dt.timedelta(seconds=1800) <= et <= at + dt.timedelta(seconds=3600))
    for salt in (None, 1, 4):
        got = sorted((r["id"], r["eid"]) for r in joins.range_join(a, e, "ts", "ets", 1800, 3600, salt=salt).collect())
        assert got == exp


@pytest.mark.parametrize("seed,hot", [(0, None), (1, 3), (2, 0)])
def test_ordered_scan_matches_brute_force(spark, seed, hot):
    rows = _rand_events(seed, 300, 6, 5000, hot)
    df = spark.createDataFrame(rows, "id long, k long, ts timestamp_ntz, v double")
    got = {r["id"]: (r["p1"], r["p2"], r["c"]) for r in ordered_scan(
        df, ["k"], ["ts", "id"], lags={"p1": ("v", 1), "p2": ("v", 2)},
        running={"c": F.coalesce(F.col("v"), F.lit(0.0))}, num_partitions=5).collect()}
    exp = {}
    by_k = {}
    for r in sorted(rows, key=lambda r: (r[1], r[2], r[0])):
        by_k.setdefault(r[1], []).append(r)
    for seq in by_k.values():
        run = 0.0
        for i, (rid, _, _, v) in enumerate(seq):
            run += v or 0.0
            exp[rid] = (seq[i - 1][3] if i >= 1 else None, seq[i - 2][3] if i >= 2 else None, run)
    assert got == exp


def test_latest_per_key_properties(spark):
    rows = _rand_events(7, 400, 25, 4000, hot=5)
    df = spark.createDataFrame(rows, "id long, k long, ts timestamp_ntz, v double")
    once = clean.latest_per_key(df, ["k"], ["ts", "id"])
    twice = clean.latest_per_key(once, ["k"], ["ts", "id"])
    assert once.count() == df.select("k").distinct().count()
    assert sorted(map(tuple, once.collect())) == sorted(map(tuple, twice.collect()))  # idempotent
    latest = {}
    for r in rows:
        if r[1] not in latest or (r[2], r[0]) > (latest[r[1]][2], latest[r[1]][0]):
            latest[r[1]] = r
    assert {r["k"]: r["id"] for r in once.collect()} == {k: r[0] for k, r in latest.items()}


def test_distribution_sums_to_rows(spark):
    df = spark.createDataFrame(_rand_events(3, 500, 9, 1000), "id long, k long, ts timestamp_ntz, v double")
    dist = stats.distribution(df, "k", drop_null=False)
    assert dist.agg(F.sum("count")).collect()[0][0] == 500


def test_as_of_is_stable_after_later_commits(spark):
    path = scratch_path(spark, "prop")
    v0 = spark.createDataFrame([(i, i % 3) for i in range(50)], "id long, g long")
    snapshots.commit(v0, path)
    before = sorted(map(tuple, snapshots.read_as_of(spark, path, 0).collect()))
    snapshots.update(spark, path, {"g": F.lit(9)}, F.col("id") < 10)
    snapshots.delete(spark, path, F.col("id") > 40)
    snapshots.commit(v0.limit(5), path, "append")
    assert sorted(map(tuple, snapshots.read_as_of(spark, path, 0).collect())) == before
    assert snapshots.read_latest(spark, path).count() == 41 + 5


def test_range_join_splits_a_hot_bucket(spark):
    """A third of the rows in one bucket: measured splits spread it over several tasks, on either side."""
    from strata.operators.joins import _bucket_splits

    hot = [(i, T0 + dt.timedelta(seconds=i % 600)) for i in range(400)]
    rest = [(1000 + i, T0 + dt.timedelta(hours=3 * i)) for i in range(800)]
    a = spark.createDataFrame(hot + rest, "id long, ts timestamp_ntz")
    few = [(i, T0 + dt.timedelta(minutes=7 * i)) for i in range(60)]
    e = spark.createDataFrame(few, "eid long, ets timestamp_ntz")
    buckets = a.select(F.floor(F.unix_micros(F.col("ts").cast("timestamp")) / 1_000_000 / 3600).alias("_rj_b"))
    split = _bucket_splits(buckets, ["_rj_b"], "n", 8).collect()
    assert len(split) == 1 and split[0]["n"] == 3 and len(split) < 8
    near = lambda at, et: at - dt.timedelta(seconds=900) <= et <= at + dt.timedelta(seconds=2700)
    exp = sorted((ai, ei) for ai, at in hot + rest for ei, et in few if near(at, et))
    joined = joins.range_join(a, e, "ts", "ets", 900, 2700)
    assert sorted((r["id"], r["eid"]) for r in joined.collect()) == exp
    back = joins.range_join(e, a, "ets", "ts", 2700, 900)
    assert sorted((r["id"], r["eid"]) for r in back.collect()) == exp
    plan = joined._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastNestedLoopJoin" not in plan and "CartesianProduct" not in plan
    keyed = joins.range_join(a.withColumn("k", F.lit(1)), e.withColumn("k", F.lit(1)), "ts", "ets", 900, 2700, keys=["k"])
    assert keyed.count() == len(exp)


def test_range_join_pairs_leave_in_runs(spark):
    """Neighbouring pairs share their right row, so that a file of all pairs of a dense bucket stays small; null times and keys meet nothing."""
    a = spark.createDataFrame([(i, 1, T0 + dt.timedelta(seconds=i * 7 % 1201)) for i in range(1100)] + [(-1, None, T0), (-2, 1, None)], "id long, k long, ts timestamp_ntz")
    e = spark.createDataFrame([(i, 1, T0 + dt.timedelta(seconds=1200 + i * 11 % 601)) for i in range(40)] + [(-1, None, T0), (-2, 1, None)], "eid long, k long, ets timestamp_ntz")
    rows = joins.range_join(a, e, "ts", "ets", 0, 3600, keys=["k"]).select("id", "eid").collect()
    assert sorted(map(tuple, rows)) == [(i, j) for i in range(1100) for j in range(40)]
    runs = 1 + sum(x["eid"] != y["eid"] for x, y in zip(rows, rows[1:]))
    assert runs <= 40 * 12  # at most two buckets, with few blocks and parts each


@pytest.mark.parametrize("seed", range(3))
def test_phrase_mentions_match_brute_force(spark, seed):
    rnd = random.Random(seed)
    words = ["gold", "Crude", "oil", "É", "x1"]
    names = sorted({" ".join(rnd.choices(words, k=rnd.randint(1, 4))) for _ in range(12)})
    texts = [(k, rnd.choice([", ", " ", "-"]).join(rnd.choices([*words, "the"], k=rnd.randint(0, 25)))) for k in range(30)] + [(99, None), (98, ""), (5, "gold")]
    exp = []
    for i, t in texts:
        own, end = [w.lower() for w in (t or "").replace(",", " ").replace("-", " ").split()], 0
        for at in range(len(own)):
            for n in (4, 3, 2, 1):
                hit = [m for m in names if len(m.split()) == n and m.lower().split() == own[at : at + n]]
                if hit and at + n > end:
                    exp.append((i, at, n, min(hit)))
                    end = at + n
                    break
    docs = spark.createDataFrame(texts, "id long, text string")
    got = joins.phrase_mentions(docs, "text", spark.createDataFrame([(n,) for n in names] + [("--",), (None,), (names[0].upper(),)], "name string"), "name", ["id"])
    low = lambda rows: sorted((i, at, n, m.lower()) for i, at, n, m in rows)
    assert low(tuple(r) for r in got.collect()) == low(exp)
    assert joins.phrase_mentions(docs, "text", spark.createDataFrame([], "name string"), "name", ["id"]).count() == 0
