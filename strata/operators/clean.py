"""Bronze -> Silver cleaning (PRJ1-PRJ11, ST1, ST2/WN9).

Silver is two tables: ``observations`` (the history, one row per entity and
observation time) and ``current`` (latest observation per entity). Keeping the
history is what lets velocity have data at all (a one-row-per-entity table has
no previous observation).

Choices that differ from a naive port, each for correct and deterministic
results:
* measures and times are landed as strings and converted with ``try_cast`` /
  ``try_to_timestamp``: under ANSI mode a plain cast raises on bad input;
* the quality flag is computed from the values *before* imputation;
* event time = ``updated_at``, else the record's own ``timestamp``, else ingest
  time, and ``_time_source`` records which one was used;
* "latest" is a total order (time, source, id): the ``max`` of a struct, which
  is a partial aggregation, so an entity holding a third of the rows is reduced
  per task before the shuffle.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.operators.joins import hash_bits, where_hashed

UNKNOWN = "Unknown"


def add_ingest_metadata(df: DataFrame, source: str) -> DataFrame:
    """PRJ1: ``_ingested_at`` and ``_source``."""
    return df.withColumns({"_ingested_at": F.current_timestamp(), "_source": F.lit(source)})


def union_sources(frames: Sequence[DataFrame]) -> DataFrame | None:
    """ST1: union by name, missing columns null; works with any subset of sources."""
    frames = [f for f in frames if f is not None]
    if not frames:
        return None
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    return out


def parse_time(c: Column) -> Column:
    """PRJ6 helper: ISO-8601 string -> wall-clock ``timestamp_ntz``; bad input -> null."""
    return F.try_to_timestamp(c).cast("timestamp_ntz")


def latest_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """WN9 / ST2: the row with the greatest ``order`` per key (deterministic dedup).

    Ties on ``order`` are broken by the rest of the row, so the pick never depends
    on arrival order or partitioning. The row travels once, as one ordered struct.
    """
    first = [c for c in order if c not in keys]
    rest = [c for c in df.columns if c not in keys and c not in first]
    best = F.max(F.struct(*first, *rest))
    return df.groupBy(*keys).agg(best.alias("_row")).select(*keys, "_row.*").select(*df.columns)


def newest_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """As ``latest_per_key`` for wide rows that are read from storage: (the rows, a small table kept for them; unpersist it after use).

    The greatest ``order`` of each key is found from these columns alone, and only the rows that have it are compared as a whole. The
    table of greatest orders is kept and counted first, so that the planner knows whether it can be broadcast. Where there are too many keys
    for that, hardly another wide row moves either: before the join all rows are looked up in the hashes of that table (``joins.hash_bits``).
    """
    cols = [*keys, *[c for c in order if c not in keys]]
    best = df.groupBy(*keys).agg(F.max(F.struct(*cols[len(keys) :])).alias("_best"))
    best = best.select(*[F.col(c).alias(f"_n_{c}") for c in keys], *[F.col(f"_best.{c}").alias(f"_n_{c}") for c in cols[len(keys) :]]).persist()
    best.count()
    maybe = where_hashed(df, F.xxhash64(*cols), hash_bits(best.select(F.xxhash64(*[f"_n_{c}" for c in cols]).alias("h"))))
    same = reduce(lambda a, b: a & b, [maybe[c].eqNullSafe(best[f"_n_{c}"]) for c in cols])
    return latest_per_key(maybe.join(best, same, "left_semi"), keys, order), best


def silver_observations(
    bronze: DataFrame,
    key: str = "full_name",
    measure: str = "stargazers_count",
    category: str = "language",
    time_cols: Sequence[str] = ("updated_at", "timestamp"),
    ingest_time: str = "_ingested_at",
    keep: Sequence[str] = ("description", "html_url", "topics", "_source", "timestamp", "source"),
) -> DataFrame:
    """PRJ2-PRJ11: clean, type and enrich; one row per (entity, event time, source).

    ``topics``, the record's own ``timestamp`` and ``source`` are kept when present
    (they were lost at this step before, F17).
    """
    present = set(bronze.columns)
    keep = [c for c in keep if c in present]
    times = [parse_time(F.col(c).cast("string")) for c in time_cols if c in present]
    ingest = F.col(ingest_time).cast("timestamp_ntz") if ingest_time in present else F.lit(None).cast("timestamp_ntz")
    time_source = F.lit("ingest")
    for c in reversed([c for c in time_cols if c in present]):
        time_source = F.when(parse_time(F.col(c).cast("string")).isNotNull(), F.lit(c)).otherwise(time_source)

    m = F.col(measure).cast("string")
    typed = bronze.filter(F.col(key).isNotNull()).select(
        F.col(key),
        *[F.col(c) for c in keep],
        m.try_cast("bigint").alias("_m"),
        F.col(category).alias("_cat"),
        F.coalesce(*times, ingest).alias("event_time"),
        time_source.alias("_time_source"),
        (F.col(ingest_time) if ingest_time in present else F.lit(None).cast("timestamp")).alias("_ingested_at"),
    )
    flagged = typed.withColumn(
        "_quality_flag",
        F.when(F.col(key).isNotNull() & F.col("_cat").isNotNull(), "OK").otherwise("PARTIAL_DATA"),
    )
    filled = (
        flagged.withColumn(measure, F.coalesce(F.col("_m"), F.lit(0).cast("bigint")))
        .filter(F.col(measure) >= 0)
        .withColumn(category, F.coalesce(F.col("_cat"), F.lit(UNKNOWN)))
        .withColumn(f"{category}_lower", F.lower(F.col(category)))
        .withColumn("event_hour", F.hour("event_time"))
        .withColumn("event_date", F.date_format("event_time", "yyyy-MM-dd"))
        .withColumn("_processed_at", F.current_timestamp())
    )
    return filled.select(
        key, *[c for c in keep], measure, category, f"{category}_lower", "event_time", "event_hour",
        "event_date", "_time_source", "_quality_flag", "_ingested_at", "_processed_at",
    )


def dedup_observations(obs: DataFrame, key: str = "full_name", source: str = "_source") -> DataFrame:
    """History without repeated polls: one row per (entity, event time, source)."""
    keys = [key, "event_time"] + ([source] if source in obs.columns else [])
    return latest_per_key(obs, keys, ["_ingested_at"])


def _state_order(obs: DataFrame, source: str) -> list[str]:
    return ["event_time"] + ([source] if source in obs.columns else []) + ["_ingested_at"]


def current_state(obs: DataFrame, key: str = "full_name", source: str = "_source") -> DataFrame:
    """Latest observation per entity; ties on time go to the greatest source name."""
    return latest_per_key(obs, [key], _state_order(obs, source))


def current_of_stored(obs: DataFrame, key: str = "full_name", source: str = "_source") -> tuple[DataFrame, DataFrame]:
    """As ``current_state`` of a stored history, by ``newest_per_key``."""
    return newest_per_key(obs, [key], _state_order(obs, source))
