"""Sinks (SNK1, SNK4, SNK7, SNK8). Streaming sinks live in ``strata.streaming``,
snapshot commits in ``strata.operators.snapshots``.

Results leave by distributed writes, never by ``collect()`` on the driver.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def keyed_messages(df: DataFrame, key, hash_key: bool = False, value_cols=None) -> DataFrame:
    """SNK1: (key, value) message rows: key = the entity name (a column or an
    expression) or its md5 hex, value = the row (or ``value_cols``) as JSON.
    Write with ``format("kafka")`` where the connector is on the classpath; the
    shape is the same for any sink."""
    name = F.col(key) if isinstance(key, str) else key
    k = F.md5(name.cast("string")) if hash_key else name.cast("string")
    cols = list(value_cols) if value_cols is not None else df.columns
    return df.select(k.alias("key"), F.to_json(F.struct(*[F.col(c) for c in cols])).alias("value"))


def write_kafka(messages: DataFrame, servers: str, topic: str) -> None:
    """SNK1 transport (needs the Kafka connector jar; not available in tests)."""
    messages.write.format("kafka").option("kafka.bootstrap.servers", servers).option("topic", topic).save()


def overwrite_json(df: DataFrame, path: str, compression: str = "none", rows_per_file: int = 0) -> None:
    """SNK4/SNK7: overwrite a result as JSON (times as ISO strings, no driver collect).

    A compressed file is read by one task, so bound its rows (``rows_per_file``, 0: no bound) where there may be many.
    """
    w = df.write.mode("overwrite").option("timestampFormat", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    w.option("maxRecordsPerFile", rows_per_file).json(path, compression=compression)


def layer_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """SNK8: one row per table with its row count, as a single union of aggregates
    (each table is scanned once, in one job)."""
    parts = [df.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(name).alias("table"), "rows")
             for name, df in tables.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
