"""Versioned tables as plain Parquet partitions (VR1-VR6, SRC4/5, SNK5/6).

A version is a pair of partition folders, ``<path>/_version=<n>/_operation=<what>``, written by one Spark job; Spark's own ``_SUCCESS`` mark says that it is
whole, so a write that broke off is never read and its number is used again. An append holds the new rows only, every other
operation the whole table: the table as of a version is the newest whole one up to there and the appends since. There is no log, part list or schema beside the
folders. Update, delete and restore are DataFrame jobs over the newest version whose result is written as the next one.

Rows of older appends without a later column read back with nulls (schemas are merged where a version has several folders). A single
writer is assumed; streaming sinks do not commit here, see ``streaming/jobs.py``.
"""

from __future__ import annotations

import re
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

VERSION, OPERATION = "_version", "_operation"
APPEND = "APPEND"
_FOLDER = re.compile(rf"{VERSION}=(\d+)/{OPERATION}=(\w+)/_SUCCESS$")


class NoVersion(ValueError):
    """The table has no such version."""


def _folder(path: str, version: int, operation: str) -> str:
    return f"{path.rstrip('/')}/{VERSION}={version}/{OPERATION}={operation}"


def commits(spark: SparkSession, path: str) -> list[dict]:
    """(version, operation, timestamp in ms) of the whole versions, oldest first: one file status per version."""
    jvm = spark._jvm
    place = jvm.org.apache.hadoop.fs.Path(f"{path.rstrip('/')}/{VERSION}=*/{OPERATION}=*/_SUCCESS")
    found = place.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(place) or []
    named = [(_FOLDER.search(s.getPath().toString()), s.getModificationTime()) for s in found]
    return sorted(({"version": int(m[1]), "operation": m[2], "timestamp": t} for m, t in named if m), key=lambda c: c["version"])


def history(spark: SparkSession, path: str) -> DataFrame:
    """VR1: one row per version (version, operation, timestamp)."""
    rows = [(c["version"], c["operation"], c["timestamp"]) for c in commits(spark, path)]
    return spark.createDataFrame(rows, "version long, operation string, ms long").select("version", "operation", F.timestamp_millis("ms").alias("timestamp"))


def latest_version(spark: SparkSession, path: str) -> int | None:
    c = commits(spark, path)
    return c[-1]["version"] if c else None


def read_as_of(spark: SparkSession, path: str, version: int) -> DataFrame:
    """VR3 / SRC5: the table as of ``version``."""
    done = [c for c in commits(spark, path) if c["version"] <= version]
    if not done or done[-1]["version"] != version:
        raise NoVersion(f"{path}: no version {version}")
    whole = max((k for k, c in enumerate(done) if c["operation"] != APPEND), default=0)
    folders = [_folder(path, c["version"], c["operation"]) for c in done[whole:]]
    return spark.read.option("mergeSchema", len(folders) > 1).parquet(*folders)


def read_latest(spark: SparkSession, path: str) -> DataFrame:
    """SRC4: the newest version."""
    version = latest_version(spark, path)
    if version is None:
        raise NoVersion(f"{path}: empty table")
    return read_as_of(spark, path, version)


def commit(df: DataFrame, path: str, mode: str = "overwrite", operation: str | None = None, rows: Observation | None = None) -> int:
    """SNK5 / SNK6: write ``df`` as the next version, or its rows beside the newest one (``append``); returns the version number.

    ``rows`` receives the number of rows as ``n``, counted by the write itself.
    """
    if mode not in ("append", "overwrite"):
        raise ValueError(mode)
    last = latest_version(df.sparkSession, path)
    version = 0 if last is None else last + 1
    out = df.observe(rows, F.count(F.lit(1)).alias("n")) if rows else df
    out.write.mode("overwrite").parquet(_folder(path, version, APPEND if mode == "append" else operation or "WRITE"))
    return version


def _true(where: Column | str) -> Column:
    return F.coalesce(F.expr(where) if isinstance(where, str) else where, F.lit(False))


def update(spark: SparkSession, path: str, assignments: Mapping[str, Column | str], where: Column | str) -> int:
    """VR2: ``SET col = expr WHERE cond`` as a new version (null condition = not matched)."""
    hit = _true(where)
    new = {c: F.when(hit, F.expr(v) if isinstance(v, str) else v).otherwise(F.col(c)) for c, v in assignments.items()}
    return commit(read_latest(spark, path).withColumns(new), path, operation="UPDATE")


def delete(spark: SparkSession, path: str, where: Column | str) -> int:
    """VR6: drop rows where the condition is true (null condition keeps the row)."""
    return commit(read_latest(spark, path).filter(~_true(where)), path, operation="DELETE")


def restore(spark: SparkSession, path: str, version: int) -> int:
    """VR4: the rows of ``version`` as the newest version."""
    return commit(read_as_of(spark, path, version), path, operation="RESTORE")


def compare_counts(before: DataFrame, after: DataFrame, key: str) -> DataFrame:
    """AG11: rows per ``key`` value in two versions, side by side (full outer join)."""
    a = before.groupBy(key).agg(F.count(F.lit(1)).alias("count_before"))
    b = after.groupBy(key).agg(F.count(F.lit(1)).alias("count_after"))
    j = a.alias("a").join(b.alias("b"), F.col(f"a.{key}") == F.col(f"b.{key}"), "full")
    return j.select(
        F.coalesce(F.col(f"a.{key}"), F.col(f"b.{key}")).alias(key), "count_before", "count_after"
    )
