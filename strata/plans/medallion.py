"""Bronze -> Silver -> Gold in one session, and the generation-1 analysis cycle (PL1-PL3).

* Bronze: a file stream per landing directory that exists (declared schema, ``availableNow``) appends the files that
  came since the last run, tagged with ``_ingested_at`` / ``_source``. A missing source is skipped, not fatal.
* Silver: a stream over each Bronze table cleans the new rows and appends those that the history does not hold yet to
  ``observations``, partitioned by date: a batch is compared with its own dates only. ``current`` (latest per entity, in
  buckets by entity) is then brought up by the observations of batches that it does not hold yet, in the buckets of their
  entities only; which it holds is written after it, so a crash between the two leaves nothing out and readers see the
  state before. ``rebuild`` starts a new generation from all of Bronze, with its own number of buckets.
* Gold: category stats and top-10 on ``current``; velocity on the
  *observations* (it needs several observations per entity); topic frequency
  on ``current`` descriptions per source; recently emerged topics.

Each stage returns its result as a value; a failed stage stops its dependents
unless ``continue_on_failure``. The run log is itself a snapshot table.
"""

from __future__ import annotations

import os
import time

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.functions.text import short_text
from strata.operators import clean, series, snapshots, stats, terms
from strata.sources.landing import API_SCHEMA, CORRUPT, RSS_SCHEMA, landing_schema
from strata.streaming import batches, jobs

SCHEMAS = {"api": API_SCHEMA, "rss": RSS_SCHEMA}
GOLD = ("language_dist", "top_repos", "star_velocity", "emerging_topics")
KEYS = ["full_name", "event_time", "_source"]
PARTITIONS = ["_source", "event_date"]
_S, _T = T.StringType(), T.TimestampType()
#: What ``clean.silver_observations`` makes of the union of all sources, also where one of them has no data.
OBSERVATION_SCHEMA = T.StructType([T.StructField(name, kind) for name, kind in (
    ("full_name", _S), ("description", _S), ("html_url", _S), ("topics", T.ArrayType(_S)), ("_source", _S), ("timestamp", _S), ("source", _S),
    ("stargazers_count", T.LongType()), ("language", _S), ("language_lower", _S), ("event_time", T.TimestampNTZType()), ("event_hour", T.IntegerType()),
    ("event_date", _S), ("_time_source", _S), ("_quality_flag", _S), ("_ingested_at", _T), ("_processed_at", _T),
)])


def _p(root: str, *names: str) -> str:
    return os.path.join(root, *names)


def _bronze_schema(source: str) -> T.StructType:
    tags = [T.StructField("_ingested_at", T.TimestampType()), T.StructField("_source", T.StringType())]
    return T.StructType(landing_schema(SCHEMAS.get(source, API_SCHEMA)).fields + tags)


def _count(df: DataFrame, seen: Observation) -> DataFrame:
    """``df``, whose rows the job that reads it counts on the way."""
    return df.observe(seen, F.count(F.lit(1)).alias("n"))


def bronze(spark: SparkSession, landing: dict[str, str], root: str, multiline: bool = True) -> list[str]:
    """Append the landing files not taken yet; returns the sources that exist."""
    return list(take_landing(spark, landing, root, multiline))


def take_landing(spark: SparkSession, landing: dict[str, str], root: str, multiline: bool = True, keep_landing: bool = True) -> dict[str, int]:
    """As ``bronze``; returns the rows taken per source that exists.

    Without ``keep_landing`` the files that lay there when it began, which Bronze holds at its end, are removed then.
    """
    taken = {}
    there = [s for s, path in landing.items() if batches.exists(spark, path)]
    for source in there:
        def landed(reader):
            return (
                reader.schema(landing_schema(SCHEMAS.get(source, API_SCHEMA)))
                .option("multiLine", multiline).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", CORRUPT)
                .option("pathGlobFilter", "*.{json,json.gz}").option("recursiveFileLookup", True).json(landing[source])
            )

        before = [] if keep_landing else landed(spark.read).inputFiles()
        with batches.adaptive(spark):
            q = jobs.ingest(landed(spark.readStream), source, _p(root, f"bronze_{source}"), _p(root, "_checkpoints", f"bronze_{source}"), compression=batches.CODEC)
        taken[source] = sum(p["numInputRows"] for p in q.recentProgress)  # one batch per run
        batches.remove(spark, before)
    return taken


def read_bronze(spark: SparkSession, root: str, source: str) -> DataFrame | None:
    path = _p(root, f"bronze_{source}")
    return spark.read.schema(_bronze_schema(source)).parquet(path) if batches.exists(spark, path) else None


def _generation(spark: SparkSession, root: str) -> str:
    """The folder of the newest Silver generation."""
    done = snapshots.commits(spark, _p(root, "silver_generations"))
    return _p(root, f"silver_{done[-1]['version'] if done else 0}")


def read_observations(spark: SparkSession, root: str, home: str | None = None) -> DataFrame:
    """The history of the newest generation, or of the one at ``home``."""
    return batches.get(spark, _p(home or _generation(spark, root), "observations"), OBSERVATION_SCHEMA, PARTITIONS)


def _observe(spark: SparkSession, root: str, home: str, source: str) -> tuple[int, int]:
    """Clean the Bronze rows that came since the last run and append the new observations; returns the rows read and appended.

    Keys alone decide what is new: those of the batch are counted and compared with the history. The whole rows do not move, but are written
    where they are read; only those whose key comes more than once in the batch are compared with each other before.
    """
    path, counts = _p(home, "observations"), []

    def step(rows: DataFrame, epoch: int) -> None:
        read, written = Observation(), Observation()
        other = [rows.sparkSession.createDataFrame([], _bronze_schema(s)) for s in SCHEMAS if s != source]
        observations = lambda rows: clean.silver_observations(clean.union_sources([rows, *other]).drop(CORRUPT))
        cleaned = observations(rows).select(*OBSERVATION_SCHEMA.fieldNames())
        # Counted rows keep all their columns, so this scan goes without the long ones.
        counted = observations(_count(rows.drop("description", "html_url", "topics"), read))
        dates = [r[0] or "" for r in counted.select("event_date").distinct().collect()]
        known = batches.get(rows.sparkSession, path, OBSERVATION_SCHEMA, PARTITIONS).filter(
            (F.col("_source") == source) & F.coalesce("event_date", F.lit("")).isin(dates) & (F.col(batches.BATCH) < epoch)
        )
        found = cleaned.groupBy(*KEYS).agg((F.count(F.lit(1)) > 1).alias("repeated"))
        found = found.join(known.select(*KEYS).distinct().withColumn("known", F.lit(True)), KEYS, "left").filter("repeated OR known")
        found = found.persist()  # keys only; counted first, so the planner knows whether they can be broadcast
        try:
            fresh = cleaned
            if found.count():
                repeated = cleaned.join(found.filter("known IS NULL").select(*KEYS), KEYS, "left_semi")
                fresh = cleaned.join(found.select(*KEYS), KEYS, "left_anti").unionByName(clean.dedup_observations(repeated).select(*cleaned.columns))
            batches.put(_count(fresh, written), path, epoch, PARTITIONS, within=["language_lower"])
            counts.append((read.get["n"], written.get["n"]))
        finally:
            found.unpersist()

    stream = spark.readStream.schema(_bronze_schema(source)).parquet(_p(root, f"bronze_{source}"))
    jobs.each_batch(stream, step, _p(home, "_checkpoints", source), True, keep=False)
    return sum(r for r, _ in counts), sum(w for _, w in counts)


def _current(spark: SparkSession, home: str, buckets: int = 1) -> batches.Buckets:
    return batches.Buckets(spark, _p(home, "current"), OBSERVATION_SCHEMA, ["full_name"], buckets)


def refresh_current(spark: SparkSession, root: str, home: str, buckets: int) -> None:
    """Bring ``current`` up to the observations: from the batches that it holds (``held``, written after it) by those after that.

    Only the buckets of the new observations' entities are rewritten. After a crash between the two writes the same batches, and any
    since, are merged into the same state as before under the same number, so every bucket that the broken attempt wrote is written again.
    """
    marks = _p(home, "held")
    obs = read_observations(spark, root, home)
    newest = obs.groupBy("_source").agg(F.max(batches.BATCH).alias("epoch"))
    epochs = {r["_source"]: r["epoch"] for r in newest.collect()}  # one row per source
    last = snapshots.latest_version(spark, marks)
    held = {} if last is None else {r["_source"]: r["epoch"] for r in snapshots.read_as_of(spark, marks, last).collect()}
    if epochs == held:
        return
    later = F.lit(False)
    for source, epoch in epochs.items():
        later = later | ((F.col("_source") == source) & (F.col(batches.BATCH) > held.get(source, -1)))
    kept = []

    def newest_rows(rows: DataFrame) -> DataFrame:
        state, best = clean.current_of_stored(rows)
        kept.append(best)
        return state

    with batches.adaptive(spark):
        try:
            _current(spark, home, buckets).merge(obs.filter(later).drop(batches.BATCH), 0 if last is None else last + 1, newest_rows)
        finally:
            for best in kept:
                best.unpersist()
    snapshots.commit(spark.createDataFrame(list(epochs.items()), "_source string, epoch long"), marks)


def silver(spark: SparkSession, root: str, sources=("api", "rss"), rebuild: bool = False, buckets: int = 8) -> tuple[int, int]:
    """Clean new Bronze rows into Silver; with ``rebuild`` all of them, into a new generation. Returns the rows read and appended.

    A generation keeps the number of ``buckets`` of ``current`` that it started with; choose it so that one is a few files.
    """
    sources = [s for s in sources if batches.exists(spark, _p(root, f"bronze_{s}"))]
    if not sources:
        raise RuntimeError("no Bronze source available")
    generations = _p(root, "silver_generations")
    if rebuild or not snapshots.commits(spark, generations):
        snapshots.commit(spark.createDataFrame([(buckets,)], "buckets int"), generations, operation="REBUILD")
    home = _generation(spark, root)
    counts = [_observe(spark, root, home, source) for source in sources]
    refresh_current(spark, root, home, snapshots.read_latest(spark, generations).first()["buckets"])
    return sum(r for r, _ in counts), sum(w for _, w in counts)


def read_current(spark: SparkSession, root: str, home: str | None = None) -> DataFrame:
    """The latest row per entity after the last whole refresh; valid until the second refresh after that."""
    home = home or _generation(spark, root)
    last = snapshots.latest_version(spark, _p(home, "held"))
    return _current(spark, home).latest(-1 if last is None else last)


def gold_tables(obs: DataFrame, cur: DataFrame) -> dict[str, DataFrame]:
    lang = stats.category_stats(cur, "language_lower", "stargazers_count", names=("total_repos", "avg_stars", "max_stars"))
    top = terms.top_n(
        cur.select("full_name", "stargazers_count", "language", "html_url", "description", "_source"),
        10, [F.desc("stargazers_count"), F.asc("full_name")],
    )
    # Per entity *and source*: sources measure different things (a total vs a
    # daily count), so their values are never differenced against each other.
    # (entity, _source, event_time) is unique after dedup: a total order.
    vel = series.velocity(obs, "full_name", "event_time", "_source", "stargazers_count", by=("_source",))
    vel = vel.join(cur.select("full_name", "language_lower"), "full_name", "left")
    topics = terms.topic_frequency(cur, "description", by=["_source"])
    return {"language_dist": lang, "top_repos": top, "star_velocity": vel, "emerging_topics": topics}


def gold(spark: SparkSession, root: str) -> tuple[int, int]:
    """Write the Gold tables; returns the observations read and the rows written, as the writes count them."""
    home = _generation(spark, root)
    read = Observation()
    # Without the texts: counted rows keep all their columns, also those that no one reads later.
    obs = _count(read_observations(spark, root, home).select("full_name", "event_time", "_source", "stargazers_count"), read)
    written = []
    with batches.adaptive(spark):
        for name, df in gold_tables(obs, read_current(spark, root, home)).items():
            written.append(Observation())
            snapshots.commit(df, _p(root, f"gold_{name}"), rows=written[-1])
    return read.get["n"], sum(w.get["n"] for w in written)


def run(spark: SparkSession, landing: dict[str, str], root: str, multiline: bool = True,
        continue_on_failure: bool = False, rebuild: bool = False, buckets: int = 8, keep_landing: bool = True) -> DataFrame:
    """PL1 + PL2: run the three layers; returns (stage, status, error, rows_in, rows_out, seconds, finished_at) rows,
    also appended to ``<root>/run_log``. Rows are counted by the jobs that move them (``DataFrame.observe``), not by second scans.
    Without ``keep_landing`` the landed files are removed once Bronze holds them."""
    steps = [
        ("bronze", lambda: (sum(take_landing(spark, landing, root, multiline, keep_landing).values()),) * 2),
        ("silver", lambda: silver(spark, root, tuple(landing), rebuild, buckets)),
        ("gold", lambda: gold(spark, root)),
    ]
    log, failed = [], False
    for stage, fn in steps:
        if failed and not continue_on_failure:
            log.append((stage, "SKIPPED", None, None, None, None))
            continue
        start = time.perf_counter()
        try:
            log.append((stage, "OK", None, *fn(), time.perf_counter() - start))
        except Exception as e:  # recorded, then dependents stop
            failed = True
            log.append((stage, "FAILED", f"{type(e).__name__}: {e}", None, None, time.perf_counter() - start))
    result = spark.createDataFrame(log, "stage string, status string, error string, rows_in long, rows_out long, seconds double").withColumn(
        "finished_at", F.current_timestamp()
    )
    snapshots.commit(result, _p(root, "run_log"), "append")
    return result


def tables(spark: SparkSession, root: str) -> dict[str, DataFrame]:
    out = {f"bronze_{s}": df for s in SCHEMAS if (df := read_bronze(spark, root, s)) is not None}
    if snapshots.commits(spark, _p(root, "silver_generations")):
        out["silver_observations"] = read_observations(spark, root).drop(batches.BATCH)
        out["silver_current"] = read_current(spark, root)
    for g in GOLD:
        if snapshots.commits(spark, _p(root, f"gold_{g}")):
            out[f"gold_{g}"] = snapshots.read_latest(spark, _p(root, f"gold_{g}"))
    return out


def clean_cycle(api: DataFrame, rss: DataFrame | None) -> dict[str, DataFrame]:
    """PL3: the five outputs of one generation-1 analysis cycle.

    ``api`` rows are de-duplicated per ``full_name`` (latest observation wins);
    language distribution (nulls excluded), top 10 by stars, top 15 words of
    descriptions, newest 10 ``rss`` rows, and a one-row summary.
    """
    order = [c for c in ("timestamp", "updated_at") if c in api.columns]
    api = api.withColumn("stargazers_count", F.col("stargazers_count").cast("string").try_cast("bigint"))
    api = clean.latest_per_key(api.filter(F.col("full_name").isNotNull()), ["full_name"], order)
    lang = stats.distribution(api, "language")
    top = terms.top_n(api, 10, [F.desc("stargazers_count"), F.asc("full_name")]).select(
        "full_name", "language", "stargazers_count", "html_url", short_text("description").alias("short_description")
    )
    words = terms.top_n(terms.word_frequency(api, "description"), 15, [F.desc("count"), F.asc("word")])
    latest = rss.orderBy(F.desc("timestamp"), F.asc("full_name")).limit(10) if rss is not None else None
    summary = stats.summary_row(api, "full_name", "language", "stargazers_count", articles=latest)
    return {"language_dist": lang, "top_repos": top, "word_freq": words, "rss_latest": latest, "summary": summary}
