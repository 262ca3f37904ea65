"""Bounds on what jobs keep on disk and move, and results that do not change for it."""

import datetime as dt
import gzip
import json
import os

from pyspark.sql import functions as F

from strata.operators import clean, joins
from strata.plans import medallion
from strata.session import scratch_path
from strata.streaming import batches


def _record(name, stars, at, text="d"):
    return {"full_name": name, "description": text, "html_url": f"https://x/{name}", "stargazers_count": stars, "language": "Go", "updated_at": at, "timestamp": at}


def _land(path, name, rows):
    os.makedirs(path, exist_ok=True)
    with gzip.open(os.path.join(path, name), "wt") as f:
        f.write("\n".join(map(json.dumps, rows)))


def _shuffle_files(spark):
    files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return {files.apply(k).getName() for k in range(files.size()) if files.apply(k).getName().startswith("shuffle_")}


def test_shuffle_files_of_an_epoch_are_removed_with_its_write(spark):
    path, before = scratch_path(spark, "t-put"), _shuffle_files(spark)
    batches.put(spark.range(1000).withColumn("day", F.col("id") % 5), path, 0, ["day"])
    assert not _shuffle_files(spark) - before
    assert spark.read.parquet(path).count() == 1000


def test_layer_run_on_compressed_landing_with_repeats(spark, tmp_path):
    """Gzip files are landed too; a key that comes twice in a batch, and one that the history has, gives one observation: the same as by comparing whole rows."""
    d, root = str(tmp_path / "landing" / "api"), str(tmp_path / "lake")
    _land(d, "p1.json.gz", [_record("o/a", "5", "2024-01-01T10:00:00", t) for t in ("x", "z", "y")] + [_record("o/b", "1", "2024-01-01T10:00:00")])
    log = {r["stage"]: (r["rows_in"], r["rows_out"]) for r in medallion.run(spark, {"api": d}, root, multiline=False).collect()}
    assert log["bronze"] == (4, 4) and log["silver"] == (4, 2)
    _land(d, "p2.json.gz", [_record("o/a", "7", "2024-01-01T10:00:00", "zz"), _record("o/b", "2", "2024-01-02T10:00:00"), _record("o/c", "3", "2024-01-02T10:00:00")])
    log = {r["stage"]: (r["rows_in"], r["rows_out"]) for r in medallion.run(spark, {"api": d}, root, multiline=False).collect()}
    assert log["silver"] == (3, 2)
    read = lambda t: sorted((r["full_name"], r["description"], r["stargazers_count"]) for r in t.collect())
    t = medallion.tables(spark, root)
    assert read(t["silver_observations"]) == [("o/a", "z", 5), ("o/b", "d", 1), ("o/b", "d", 2), ("o/c", "d", 3)]
    assert read(t["silver_current"]) == [("o/a", "z", 5), ("o/b", "d", 2), ("o/c", "d", 3)]
    files = [f for _, _, names in os.walk(medallion._generation(spark, root)) for f in names if f.endswith(".parquet")]
    assert files and all(".zstd." in f for f in files if "current" in f or "observations" in f)


def test_layer_run_removes_what_bronze_has_taken(spark, tmp_path):
    """Without ``keep_landing`` landed files go once Bronze holds them, other files and those that no run has taken stay; by default all stay."""
    d, root = str(tmp_path / "landing" / "api"), str(tmp_path / "lake")
    there = lambda: sorted(f for _, _, names in os.walk(d) for f in names)
    run = lambda **how: [r["status"] for r in medallion.run(spark, {"api": d}, root, multiline=False, **how).collect()]
    _land(d, "p 1.json.gz", [_record("o/a", "5", "2024-01-01T10:00:00")])
    _land(d, "notes.txt", [])
    assert run() == ["OK"] * 3 and there() == ["notes.txt", "p 1.json.gz"]
    _land(os.path.join(d, "round-2"), "p2.json.gz", [_record("o/b", "6", "2024-01-01T11:00:00")])
    assert run(keep_landing=False) == ["OK"] * 3 and there() == ["notes.txt"]
    _land(d, "p3.json.gz", [_record("o/b", "7", "2024-01-02T11:00:00")])
    assert there() == ["notes.txt", "p3.json.gz"] and run(keep_landing=False) == ["OK"] * 3 and there() == ["notes.txt"]
    counts = {name: df.count() for name, df in medallion.tables(spark, root).items()}
    assert (counts["bronze_api"], counts["silver_observations"], counts["silver_current"]) == (3, 3, 2)


def test_rows_put_within_an_order_do_not_move(spark):
    """Each task writes its own rows, in order, so the files of a value are as many as the input's parts that hold it; a replay replaces them."""
    path = scratch_path(spark, "t-put")
    rows = spark.range(0, 400, 1, 4).select((F.col("id") % 2).alias("day"), F.concat(F.lit("w"), (F.col("id") * 7 % 5).cast("string")).alias("kind"), "id")
    for _ in range(2):
        batches.put(rows, path, 3, ["day"], within=["kind"])
    found = spark.read.parquet(path)
    assert sorted((r["day"], r["kind"], r["id"]) for r in found.collect()) == sorted(map(tuple, rows.collect()))
    files = [f for f in found.inputFiles()]
    assert len(files) == 4 * 2
    for f in files:
        kinds = [r["kind"] for r in spark.read.parquet(f).coalesce(1).collect()]
        assert len(kinds) == 50 and kinds == sorted(kinds)


def test_newest_rows_of_many_keys_move_alone(spark):
    """Where the newest orders are too many to be broadcast, rows that cannot be the newest are dropped before the join."""
    df = spark.range(5000).select(F.concat(F.lit("k"), (F.col("id") % 100).cast("string")).alias("k"), "id", F.repeat(F.lit("x"), 50).alias("text"))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        found, kept = clean.newest_per_key(df, ["k"], ["id"])
        assert sorted(r["id"] for r in found.collect()) == list(range(4900, 5000))
        plan = found._jdf.queryExecution().executedPlan().toString()
        moved = [n for n in plan.splitlines() if "Exchange hashpartitioning" in n and "_n_" not in n]
        assert "SortMergeJoin" in plan and moved
        below = plan[plan.index(moved[-1]) :]
        assert "BroadcastHashJoin" in below and "getbit" in below
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
        kept.unpersist()


def test_newest_of_stored_rows_is_the_newest_of_whole_rows(spark):
    rows = [("a", 1, None, "t1"), ("a", 1, None, "t2"), ("a", None, 9, "t9"), (None, 2, 1, "u"), (None, 2, 2, None), ("b", None, None, None), ("b", None, None, "w")]
    df = spark.createDataFrame(rows, "k string, at int, m int, text string")
    found, kept = clean.newest_per_key(df, ["k"], ["at", "m"])
    whole = clean.latest_per_key(df, ["k"], ["at", "m"])
    assert sorted(map(str, found.collect())) == sorted(map(str, whole.collect())) and found.columns == whole.columns
    kept.unpersist()


def test_places_without_a_name_do_not_move(spark):
    """Of many places whose words start a name but go on otherwise, nearly none reach the shuffle before the exact join; results are exact."""
    docs = spark.range(2000).select("id", F.concat_ws(" ", F.lit("aa bb"), *[F.concat(F.lit("aa x"), (F.col("id") * 50 + k).cast("string")) for k in range(40)]).alias("text"))
    names = spark.createDataFrame([("Aa, bb",), ("aa x7 AA",), ("nowhere at all",), ("",)], "name string")
    found = joins.phrase_mentions(docs, "text", names, "name", ["id"])
    assert found.groupBy("name").count().sort("name").collect() == [("Aa, bb", 2000), ("aa x7 AA", 1)]
    places = [n for n in _nodes(found._jdf.queryExecution().optimizedPlan()) if "LeftSemi" in n]
    assert places  # the filter is part of the plan, under the exact join
    assert joins.phrase_mentions(docs, "text", names.limit(0), "name", ["id"]).count() == 0
    passed = spark.range(1 << 16).select(F.concat(F.lit("p"), "id").alias("_pm_phrase"))
    bits = joins._phrase_bits(passed.filter("_pm_phrase LIKE '%7'"))
    through = passed.withColumn("_pm_hash", F.xxhash64("_pm_phrase")).join(F.broadcast(bits), joins._has_bit(), "left_semi")
    own = passed.filter("_pm_phrase LIKE '%7'").count()
    assert own == through.filter("_pm_phrase LIKE '%7'").count() and through.count() < 1.05 * own


def _nodes(plan):
    return plan.toString().splitlines()


def test_words_near_in_time_moves_each_word_and_time_few_times(spark):
    """Words of both sides are counted once: the plan after that reads storage, and no join brings the left rows back."""
    at = F.timestamp_seconds(F.col("id") * 600).cast("timestamp_ntz")
    left = spark.range(50).select(F.concat_ws(" ", F.lit("Hot"), F.lit("hot"), F.concat(F.lit("w"), (F.col("id") % 7).cast("string"))).alias("text"), F.when(F.col("id") != 3, at).alias("at"))
    right = spark.range(60).select(F.concat_ws(" ", F.lit("hot"), F.concat(F.lit("w"), (F.col("id") % 5).cast("string"))).alias("text"), F.when(F.col("id") != 4, at).alias("at"))
    found = joins.words_near_in_time(left, right, "text", "at", 1800)
    expected = {}
    for i in range(50):
        for word, n in (("hot", 2), (f"w{i % 7}", 1)):
            near = sum(1 for j in range(60) if j != 4 and abs(i - j) <= 3 and word in ("hot", f"w{j % 5}"))
            if i != 3 and near:
                expected[word, i * 600] = (n, near)
    got = {(r["word"], int((r["ts"] - dt.datetime(1970, 1, 1)).total_seconds())): (r["left_count"], r["near_count"]) for r in found.collect()}
    assert got == expected and found.columns == ["word", "ts", "left_count", "near_count"]
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert "regexp_extract_all" not in plan and "LeftOuter, ((word" not in plan and "Scan ExistingRDD" in found._jdf.queryExecution().executedPlan().toString()


def test_range_join_pairs_cost_no_time_arithmetic_and_leave_from_many_tasks(spark):
    """Pairs are compared with bounds found once a left row, two small blocks at a time, in a number of tasks that does not shrink with the
    size of the input; nulls in other columns, repeated rows and names that both sides have stay."""
    at = lambda c: F.timestamp_seconds(F.lit(1_700_000_000) + c).cast("timestamp_ntz")
    a = spark.range(1300).select(F.when(F.col("id") % 3 != 0, F.col("id")).alias("id"), at(F.col("id") * 5 % 3001).alias("at"))
    e = spark.range(70).select(F.when(F.col("id") % 2 != 0, F.col("id")).alias("id"), at(F.col("id") * 37).alias("at"), F.lit(None).cast("string").alias("text"))
    found = joins.range_join(a.unionByName(a), e, "AT", "at", 60, 600)
    assert found.columns == ["id", "at", "id", "at", "text"]
    left, right = [(i if i % 3 else None, i * 5 % 3001) for i in range(1300)], [(i if i % 2 else None, i * 37) for i in range(70)]
    expected = sorted(((i, j, s, t) for i, s in left for j, t in right if s - 60 <= t <= s + 600 for _ in range(2)), key=repr)
    seconds = lambda t: int((t - dt.datetime(1970, 1, 1)).total_seconds()) - 1_700_000_000
    assert sorted(((r[0], r[2], seconds(r[1]), seconds(r[3])) for r in found.collect()), key=repr) == expected
    assert found.rdd.getNumPartitions() >= int(spark.conf.get("spark.sql.shuffle.partitions"))
    plan = _nodes(found._jdf.queryExecution().optimizedPlan())
    above = plan[: next(k for k, n in enumerate(plan) if "Join" in n)]  # what runs per pair
    assert not any("INTERVAL" in n for n in above) and joins.BLOCK * joins.RIGHT_BLOCK <= 10_000


def test_phrase_mentions_read_their_names_once_and_fold_no_arrays(spark):
    """Names that are made of the texts are not made again for the bits and the join, and a text's matches are not gathered in one array;
    of overlapping matches those count that end beyond all before them."""
    docs = spark.createDataFrame([(1, "b c d, a B c"), (2, "a b; c d"), (3, None), (4, "--"), (5, "c"), (1, "a b")], "id long, text string")
    names = docs.filter("id = 2").select(F.explode(F.array(F.lit("A b"), F.lit("b c d"), F.lit("c"), F.lit("a b c d e"))).alias("name"))
    found = joins.phrase_mentions(docs, "text", names, "name", ["id"])
    assert found.columns == ["id", "position", "words", "name"]
    expected = [(1, 0, 3, "b c d"), (1, 3, 2, "A b"), (1, 5, 1, "c"), (2, 0, 2, "A b"), (2, 1, 3, "b c d"), (5, 0, 1, "c"), (1, 0, 2, "A b")]
    assert sorted(map(tuple, found.collect())) == sorted(expected)
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("regexp_extract_all") == 1 and "aggregate(" not in plan and "transform(sequence(1, size" not in plan
