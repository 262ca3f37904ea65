"""Sorted tables (TK5): the rows of a table in one total order over its files.

``write_sorted`` range-partitions the rows by the sort columns and the tie columns, sorts each range and writes it as a file of its own, so
the files' ranges are disjoint and their names sort like their ranges. The tie columns make rows unique, so a sort value that very many rows
share is cut into several ranges like any other stretch of rows. Readers that know the order need not sort: ``read_first`` opens only the files that hold the first rows,
``places`` numbers all rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def write_sorted(df: DataFrame, path: str, order: Sequence[Column], files: int | None = None) -> None:
    """Write ``df`` to ``files`` files (as many as shuffle partitions, unless given) in ``order``, whose last columns must make rows unique."""
    n = files or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    df.repartitionByRange(n, *order).sortWithinPartitions(*order).write.mode("overwrite").option("maxRecordsPerFile", 0).parquet(path)


def file_offsets(spark: SparkSession, path: str) -> list[tuple[str, str, int, int]]:
    """(name, path, rows before, rows) per file in order. No column is read, so this takes the files' footers only; one row per file."""
    counted = spark.read.parquet(path).groupBy(F.col("_metadata.file_name").alias("name"), F.col("_metadata.file_path").alias("path")).agg(F.count(F.lit(1)).alias("n"))
    out, before = [], 0
    for r in sorted(counted.collect(), key=lambda r: r["name"]):
        out.append((r["name"], r["path"], before, r["n"]))
        before += r["n"]
    return out


def read_first(spark: SparkSession, path: str, n: int, order: Sequence[Column]) -> DataFrame:
    """The first ``n`` rows, from the files that hold them."""
    table = spark.read.parquet(path)
    needed = [p for _, p, before, _ in file_offsets(spark, path) if before < n]
    rows = spark.read.schema(table.schema).parquet(*needed) if needed else table
    return rows.orderBy(*order).limit(n)


def places(spark: SparkSession, path: str, name: str = "place") -> DataFrame:
    """All rows with their place in the table's order, from 0: the rows of the files before, and the place in the file. Nothing is sorted."""
    before = spark.createDataFrame([(f, b) for f, _, b, _ in file_offsets(spark, path)], "_file string, _before long")
    table = spark.read.parquet(path)
    rows = table.select("*", F.col("_metadata.file_name").alias("_file"), F.col("_metadata.row_index").alias("_row"))
    placed = rows.join(F.broadcast(before), "_file")  # one row per file
    return placed.select(*table.columns, (F.col("_before") + F.col("_row")).alias(name))
