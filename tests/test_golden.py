"""Golden micro-fixtures: hand-written records for each edge case (FIXTURES.md section 4)."""

import glob
import json
import os

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from strata.functions.text import title_case, tokens_compat, tokens_safe
from strata.operators import clean, joins, series, snapshots, stats
from strata.plans import medallion
from strata.streaming import batches
from strata.session import scratch_path
from strata.sources import html, landing


def _write(dirpath, name, content):
    os.makedirs(dirpath, exist_ok=True)
    with open(os.path.join(dirpath, name), "w") as f:
        f.write(content if isinstance(content, str) else json.dumps(content))


def _api(name, stars, ts, **kw):
    r = {"full_name": name, "description": kw.get("description", "a tool"), "language": kw.get("language", "Python"),
         "stargazers_count": stars, "topics": [], "html_url": f"/{name}", "timestamp": ts}
    r.update({k: v for k, v in kw.items() if k not in ("description", "language")})
    return r


def test_current_and_velocity_on_history(spark):
    """a/x: api 5 @10:00, api 9 @11:00, rss 7 @12:00 -> current = rss 7; api-only gain 4 (F1, F2)."""
    rows = [("a/x", 5, "2024-01-01T10:00:00", "api"), ("a/x", 9, "2024-01-01T11:00:00", "api"),
            ("a/x", 7, "2024-01-01T12:00:00", "rss")]
    df = spark.createDataFrame(rows, "full_name string, stargazers_count string, timestamp string, _source string")
    df = df.withColumn("language", F.lit("Go")).withColumn("_ingested_at", F.current_timestamp())
    obs = clean.dedup_observations(clean.silver_observations(df))
    cur = clean.current_state(obs).collect()
    assert len(cur) == 1 and cur[0]["stargazers_count"] == 7 and cur[0]["_source"] == "rss"
    api = obs.filter(F.col("_source") == "api")
    v = series.velocity(api, "full_name", "event_time", "_source", "stargazers_count").collect()
    assert v[0]["total_gain"] == 4 and v[0]["observation_count"] == 1
    # A one-row-per-entity table has no previous observation: velocity is empty by construction.
    assert series.velocity(clean.current_state(obs), "full_name", "event_time", "_source",
                           "stargazers_count").count() == 0


def test_silver_edge_rows(spark):
    """F3, F4, PRJ2-PRJ5, ANSI-safe parsing."""
    schema = "full_name string, language string, stargazers_count string, updated_at string, timestamp string"
    rows = [
        (None, "Go", "1", None, "2024-01-01T00:00:00"),          # dropped: null key
        ("n/null", "Go", None, None, "2024-01-01T00:00:00"),      # measure -> 0
        ("n/neg", "Go", "-1", None, "2024-01-01T00:00:00"),       # dropped: negative
        ("n/big", "Go", "3000000000", None, "2024-01-01T00:00:00"),  # kept, no overflow
        ("n/lang", None, "2", None, "2024-01-01T00:00:00"),       # Unknown + PARTIAL_DATA
        ("n/api", "Go", "3", None, "2024-01-02T05:06:07"),        # no updated_at -> timestamp
        ("n/bad", "Go", "abc", "garbage", "2024-01-03T00:00:00"),  # bad time + bad measure
    ]
    df = spark.createDataFrame(rows, schema).withColumn("_ingested_at", F.current_timestamp())
    out = {r["full_name"]: r for r in clean.silver_observations(df).collect()}
    assert set(out) == {"n/null", "n/big", "n/lang", "n/api", "n/bad"}
    assert out["n/null"]["stargazers_count"] == 0
    assert out["n/big"]["stargazers_count"] == 3000000000
    assert out["n/lang"]["language"] == "Unknown" and out["n/lang"]["_quality_flag"] == "PARTIAL_DATA"
    assert out["n/api"]["_quality_flag"] == "OK" and out["n/api"]["_time_source"] == "timestamp"
    assert out["n/api"]["event_hour"] == 5 and out["n/api"]["event_date"] == "2024-01-02"
    assert out["n/bad"]["_time_source"] == "timestamp" and out["n/bad"]["stargazers_count"] == 0


def test_tokenisers(spark):
    """F8, F9: compatible rule glues across newlines; safe rule does not; no end anchor."""
    df = spark.createDataFrame([("Real-time\nData tool",), ("abcd1 1abcd abc",)], "d string")
    compat = [r[0] for r in df.select(F.explode(tokens_compat("d"))).collect()]
    assert "realtimedata" in compat
    safe = [r[0] for r in df.select(F.explode(tokens_safe("d"))).collect()]
    assert "data" in safe and "realtime" not in safe and "real" in safe
    freq = {r["word"] for r in
            __import__("strata.operators.terms", fromlist=["x"]).topic_frequency(df, "d").collect()}
    assert "abcd1" in freq and "1abcd" not in freq and "abc" not in freq and "tool" not in freq


def test_title_case(spark):
    df = spark.createDataFrame([("objective-c",), ("c++",), ("f#",), ("jupyter notebook",)], "l string")
    got = [r[0] for r in df.select(title_case("l")).collect()]
    assert got == ["Objective-C", "C++", "F#", "Jupyter Notebook"]


def test_tolerant_landing_scan(spark, tmp_path):
    """SRC2: array file, single object, [], truncated file, a .txt; measure as string."""
    d = str(tmp_path / "api")
    _write(d, "a.json", [_api("o/a", "7", "2024-01-01T00:00:00"), _api("o/b", "abc", "2024-01-01T00:00:00")])
    _write(d, "b.json", _api("o/c", 3, "2024-01-01T00:00:00"))
    _write(d, "c.json", "[]")
    _write(d, "d.json", '{"full_name":')
    _write(d, "e.txt", "not json")
    raw = landing.read_landing(spark, d, landing.API_SCHEMA)
    path = scratch_path(spark, "bronze")
    raw.write.parquet(path)  # quarantine from a written table, never from raw JSON
    good, bad = landing.split_corrupt(spark.read.parquet(path))
    names = sorted(r["full_name"] for r in good.collect())
    assert names == ["o/a", "o/b", "o/c"] and bad.count() == 1
    stars = {r["full_name"]: r["stargazers_count"] for r in good.collect()}
    assert stars["o/a"] == "7" and stars["o/b"] == "abc"


def test_landing_null_column_and_missing_dir(spark, tmp_path):
    """a column null in every record needs no inference; a missing dir is empty."""
    d = str(tmp_path / "rss")
    _write(d, "a.json", [{"full_name": "x/y", "description": None}])
    assert landing.read_landing(spark, d, landing.RSS_SCHEMA).count() == 1
    assert landing.read_landing(spark, str(tmp_path / "nope"), landing.RSS_SCHEMA).count() == 0


def test_medallion_with_one_source(spark, tmp_path):
    """only the api directory exists -> Silver and Gold are still produced."""
    d = str(tmp_path / "landing" / "api")
    _write(d, "p1.json", [_api("o/a", "5", "2024-01-01T10:00:00", description="Streaming engine for graphs"),
                          _api("o/b", "2", "2024-01-01T10:00:00", language=None)])
    _write(d, "p2.json", [_api("o/a", "9", "2024-01-01T11:00:00", description="Streaming engine for graphs")])
    root = str(tmp_path / "lake")
    res = {r["stage"]: r["status"] for r in medallion.run(spark, {"api": d, "rss": str(tmp_path / "none")}, root).collect()}
    assert res == {"bronze": "OK", "silver": "OK", "gold": "OK"}
    t = medallion.tables(spark, root)
    assert t["silver_observations"].count() == 3 and t["silver_current"].count() == 2
    vel = t["gold_star_velocity"].collect()
    assert len(vel) == 1 and vel[0]["total_gain"] == 4
    # Bronze takes each landing file once.
    for _ in range(2):
        assert medallion.bronze(spark, {"api": d, "rss": str(tmp_path / "none")}, root) == ["api"]
        assert medallion.read_bronze(spark, root, "api").count() == 3


def test_zero_stddev_and_zero_previous(spark):
    """AG13, AG18, WN3: single value / constant key give null, never an exception."""
    df = spark.createDataFrame([("a", 1, 5.0), ("b", 1, 3.0), ("b", 2, 3.0), ("c", 1, 0.0), ("c", 2, 4.0)],
                               "k string, t int, v double")
    ra = {r["k"]: r["ratio"] for r in stats.risk_adjusted(df, "k", "v").collect()}
    assert ra["a"] is None and ra["b"] is None
    assert series.zscore_spikes(df, "k", "v").count() == 0
    alerts = series.pct_change_alerts(df, "k", "t", "t", "v").collect()
    assert alerts == []  # previous 0 -> null change -> normal


def test_range_count_bounds(spark):
    """JN3: news at t-60 min and t+60 min count, t+60 min 1 s does not; spike without news -> 0."""
    a = spark.createDataFrame([(1, "2024-01-01 12:00:00"), (2, "2024-01-05 00:00:00")], "id long, ts string") \
        .withColumn("ts", F.to_timestamp_ntz("ts"))
    n = spark.createDataFrame([(10, "2024-01-01 11:00:00"), (11, "2024-01-01 13:00:00"), (12, "2024-01-01 13:00:01")],
                              "id long, ts string").withColumn("ts", F.to_timestamp_ntz("ts"))
    got = {r["id"]: r["n"] for r in joins.range_count(a, n, "ts", "ts", 3600, 3600, name="n").collect()}
    assert got == {1: 2, 2: 0}
    pairs = joins.range_join(a, n.withColumnRenamed("id", "nid").withColumnRenamed("ts", "nts"), "ts", "nts", 3600, 3600)
    assert sorted(r["nid"] for r in pairs.collect()) == [10, 11]


def test_top_n_ties_by_id(spark):
    """equal measures around rank 10 are ordered by id."""
    df = spark.createDataFrame([(i, 100 if i < 15 else i) for i in range(20)], "id long, m long")
    from strata.operators.terms import top_n
    got = [r["id"] for r in top_n(df, 10, [F.desc("m"), F.asc("id")]).collect()]
    assert got == list(range(10))  # 15 rows tie at 100: the first 10 ids win


def test_versions_time_travel(spark):
    """F5, F6, VR2, VR3, VR5: version 0 keeps its null after the update."""
    path = scratch_path(spark, "t")
    v0 = spark.createDataFrame([("a", None), ("b", "Go")], "name string, language string")
    snapshots.commit(v0, path)
    snapshots.update(spark, path, {"language": F.lit("Unknown")}, "language IS NULL")
    assert snapshots.read_as_of(spark, path, 0).filter("language IS NULL").count() == 1
    assert snapshots.read_latest(spark, path).filter("language = 'Unknown'").count() == 1
    snapshots.commit(spark.createDataFrame([("c", "C", 3)], "name string, language string, stars int"), path, "append")
    latest = {r["name"]: r["stars"] for r in snapshots.read_latest(spark, path).collect()}
    assert latest == {"a": None, "b": None, "c": 3}
    ops = [r["operation"] for r in snapshots.history(spark, path).orderBy("version").collect()]
    assert ops == ["WRITE", "UPDATE", "APPEND"]


def test_html_repo_items(spark):
    """SRC8: link-less item skipped, defaults, comma-separated star count."""
    page = (
        '<article class="Box-row"><h2 class="h3"><a href="/o/r1">o / r1</a></h2>'
        '<p class="col-9">Fast thing</p><span itemprop="programmingLanguage">Rust</span>'
        '<span>1,234 stars today</span></article>'
        '<article class="Box-row"><h2 class="h3"><a href="/o/r2">o / r2</a></h2></article>'
        '<article class="Box-row"><h2>no link</h2></article>'
    )
    rows = html.repo_items(spark.createDataFrame([(page,)], "html string"), base_url="https://example.org").collect()
    assert [r["full_name"] for r in rows] == ["o/r1", "o/r2"]
    assert rows[0]["stargazers_count"] == 1234 and rows[0]["language"] == "Rust"
    assert rows[1]["description"] == "" and rows[1]["language"] == "Unknown" and rows[1]["stargazers_count"] == 0


def test_first_available_falls_back(spark):
    """PRJ16: Gold when any table has rows, else the Clean result."""
    from strata.operators.serving import first_available

    empty = spark.createDataFrame([], "word string")
    clean_ = spark.createDataFrame([("x",)], "word string")

    def no_path():
        return spark.read.parquet("/tmp/no-such-gold-table")

    def no_version():
        return snapshots.read_latest(spark, "/tmp/no-such-gold-table")

    def broken():
        return empty.select("no_such_column")

    assert first_available([no_path, no_version, lambda: empty, lambda: clean_]).collect()[0]["word"] == "x"
    with pytest.raises(AnalysisException):
        first_available([broken, lambda: clean_])
    assert first_available([lambda: empty]) is None


def test_failed_stage_stops_dependents(spark, tmp_path):
    """stage results are values; a failed stage skips the stages after it."""
    root = str(tmp_path / "lake")
    res = {r["stage"]: (r["status"], r["error"]) for r in medallion.run(spark, {}, root).collect()}
    assert res["bronze"][0] == "OK" and res["silver"][0] == "FAILED" and res["gold"] == ("SKIPPED", None)
    assert "no Bronze source" in res["silver"][1]
    res2 = {r["stage"]: r["status"] for r in medallion.run(spark, {}, root, continue_on_failure=True).collect()}
    assert res2["gold"] == "FAILED"
    assert len(snapshots.history(spark, f"{root}/run_log").collect()) == 2


def _values(df):
    return sorted((r["full_name"], r["stargazers_count"]) for r in df.collect())


def test_layer_run_takes_new_files_survives_a_crash_and_rebuilds(spark, tmp_path, monkeypatch):
    d = str(tmp_path / "landing" / "api")
    _write(d, "p1.json", [_api("o/a", "5", "2024-01-01T10:00:00"), _api("o/b", "2", "2024-01-01T10:00:00")])
    root = str(tmp_path / "lake")
    medallion.run(spark, {"api": d}, root)
    # The second round repeats a record; its current state is lost in a crash after the observations are written.
    _write(d, "p2.json", [_api("o/a", "9", "2024-01-01T11:00:00"), _api("o/b", "2", "2024-01-01T10:00:00"), _api("o/c", "1", "2024-01-01T12:00:00")])
    with monkeypatch.context() as m:
        m.setattr(medallion, "refresh_current", lambda *a: (_ for _ in ()).throw(RuntimeError("crash " + "x" * 400)))
        log = {r["stage"]: r for r in medallion.run(spark, {"api": d}, root).collect()}
    assert log["silver"]["status"] == "FAILED" and log["silver"]["error"].endswith("x" * 400) and log["gold"]["status"] == "SKIPPED"
    assert _values(medallion.read_current(spark, root)) == [("o/a", 5), ("o/b", 2)]
    medallion.run(spark, {"api": d}, root)  # no new file: the observations of the crashed run reach the current state
    t = medallion.tables(spark, root)
    assert t["bronze_api"].count() == 5
    obs, cur = [("o/a", 5), ("o/a", 9), ("o/b", 2), ("o/c", 1)], [("o/a", 9), ("o/b", 2), ("o/c", 1)]
    assert _values(t["silver_observations"]) == obs and _values(t["silver_current"]) == cur
    assert {r["full_name"]: r["total_gain"] for r in t["gold_star_velocity"].collect()} == {"o/a": 4}
    before = _files(f"{medallion._generation(spark, root)}/current")
    medallion.silver(spark, root, ("api",))  # nothing new: nothing written
    assert before and _files(f"{medallion._generation(spark, root)}/current") == before
    # A rebuild reads Bronze, not the old Silver: a wrong observation there does not survive.
    wrong = medallion.read_observations(spark, root).limit(1).withColumn("full_name", F.lit("o/wrong")).drop("_batch")
    batches.put(wrong, f"{medallion._generation(spark, root)}/observations", 99, medallion.PARTITIONS)
    assert _values(medallion.read_observations(spark, root)) != obs
    medallion.silver(spark, root, ("api",), rebuild=True)
    assert _values(medallion.read_observations(spark, root)) == obs and _values(medallion.read_current(spark, root)) == cur


def test_declared_schema_of_observations(spark):
    none = [spark.createDataFrame([], medallion._bronze_schema(source)) for source in medallion.SCHEMAS]
    made = clean.silver_observations(clean.union_sources(none)).schema
    assert [(f.name, f.dataType) for f in made] == [(f.name, f.dataType) for f in medallion.OBSERVATION_SCHEMA]


def _files(path):
    return set(glob.glob(f"{path}/**/*.parquet", recursive=True))


def test_current_rewrites_the_buckets_of_new_observations_only(spark, tmp_path, monkeypatch):
    d, root = str(tmp_path / "landing" / "api"), str(tmp_path / "lake")
    _write(d, "p1.json", [_api(f"o/{k}", str(k), "2024-01-01T10:00:00") for k in range(40)])
    medallion.run(spark, {"api": d}, root, buckets=16)
    home = medallion._generation(spark, root)
    files, was = _files(f"{home}/current"), _values(medallion.read_current(spark, root))
    assert len(was) == 40 and len({f.split("_bucket=")[1].split("/")[0] for f in files}) > 8
    # The refresh breaks off after its buckets are written: readers see the state before.
    _write(d, "p2.json", [_api("o/7", "70", "2024-01-02T10:00:00")])
    with monkeypatch.context() as m:
        commit = snapshots.commit
        m.setattr(snapshots, "commit", lambda df, path, *a, **kw: 1 / 0 if path.endswith("/held") else commit(df, path, *a, **kw))
        assert {r["stage"]: r["status"] for r in medallion.run(spark, {"api": d}, root).collect()}["silver"] == "FAILED"
    assert len(_files(f"{home}/current") - files) == 1 and _values(medallion.read_current(spark, root)) == was
    # The next run merges the lost batch and its own; buckets without new rows keep their files, an older row changes nothing.
    _write(d, "p3.json", [_api("o/7", "5", "2023-01-01T10:00:00"), _api("o/new", "1", "2024-01-03T10:00:00")])
    medallion.run(spark, {"api": d}, root, buckets=2)  # a generation keeps its number of buckets
    assert files < _files(f"{home}/current") and len(_files(f"{home}/current") - files) <= 2
    expected = sorted([(n, 70 if n == "o/7" else s) for n, s in was] + [("o/new", 1)])
    assert _values(medallion.read_current(spark, root)) == expected
    medallion.silver(spark, root, ("api",), rebuild=True, buckets=1)
    assert _values(medallion.read_current(spark, root)) == expected


def test_versions_are_partitions_and_a_broken_write_is_not_read(spark, tmp_path):
    path = str(tmp_path / "t")
    for k in range(3):
        snapshots.commit(spark.range(10 * k, 10 * k + 10).withColumn("v", F.lit(k)), path, "append")
    snapshots.update(spark, path, {"v": F.lit(9)}, F.col("id") == 15)
    snapshots.delete(spark, path, F.col("id") == 25)
    snapshots.delete(spark, path, F.col("id") == 1000)
    expected = [(i, 9 if i == 15 else i // 10) for i in range(30) if i != 25]
    read = lambda df: sorted((r["id"], r["v"]) for r in df.collect())
    assert read(snapshots.read_latest(spark, path)) == expected and snapshots.read_as_of(spark, path, 1).count() == 20
    # A write that broke off before its mark: invisible, and its number is taken by the next one.
    spark.range(5).withColumn("v", F.lit(0)).write.parquet(f"{path}/_version=6/_operation=WRITE")
    os.remove(f"{path}/_version=6/_operation=WRITE/_SUCCESS")
    assert snapshots.latest_version(spark, path) == 5 and read(snapshots.read_latest(spark, path)) == expected
    assert snapshots.restore(spark, path, 2) == 6 and read(snapshots.read_latest(spark, path)) == [(i, i // 10) for i in range(30)]
    with pytest.raises(snapshots.NoVersion):
        snapshots.read_as_of(spark, path, 7)


def test_layer_run_counts_rows_with_the_write(spark, tmp_path):
    """Rows in and out come from the stages' own jobs: no job of a run only counts."""
    d, root = str(tmp_path / "landing" / "api"), str(tmp_path / "lake")
    _write(d, "p1.json", [_api("o/a", "5", "2024-01-01T10:00:00"), _api("o/b", "2", "2024-01-01T10:00:00"), _api("o/b", "2", "2024-01-01T10:00:00")])
    first = {r["stage"]: (r["rows_in"], r["rows_out"]) for r in medallion.run(spark, {"api": d}, root).collect()}
    assert first["bronze"] == (3, 3) and first["silver"] == (3, 2) and first["gold"][0] == 2
    second = {r["stage"]: (r["rows_in"], r["rows_out"]) for r in medallion.run(spark, {"api": d}, root).collect()}
    assert second["bronze"] == (0, 0) and second["silver"] == (0, 0) and second["gold"] == first["gold"]
    tables = medallion.tables(spark, root)
    assert first["gold"][1] == sum(tables[f"gold_{g}"].count() for g in medallion.GOLD)


def test_anchors_with_nested_tags_and_other_attributes(spark):
    page = '<a class="c" href="/1">one <b>bold</b></a><a name="x">no target</a><A HREF=\'/2\'>two</A><a href="/3"></a>'
    rows = html.page_links(spark.createDataFrame([(1, page)], "page_id int, html string")).collect()
    assert [(r["position"], r["href"], r["anchor_text"]) for r in rows] == [(1, "/1", "one bold"), (2, "/2", "two"), (3, "/3", "")]


def test_scratch_needs_a_shared_folder_on_a_cluster():
    from strata import session

    for master in ("yarn", "spark://host:7077", "k8s://host", "local-cluster[2,1,1024]", ""):
        with pytest.raises(RuntimeError):
            session._local_folder(master)
    assert session._local_folder("local[4]") and session._local_folder("local")
