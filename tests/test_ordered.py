"""Sorted tables: total order over the files, split hot values, and reads of the needed files only."""

from pyspark.sql import functions as F

from strata.session import scratch_path
from strata.sinks import ordered


def test_files_are_disjoint_ranges_also_for_a_hot_value(spark):
    path = scratch_path(spark, "t-sorted")
    df = spark.range(9000).select(F.col("id"), F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 100 - 50).alias("v"))
    order = [F.col("v").desc(), F.col("id")]
    ordered.write_sorted(df.repartition(5), path, order, files=12)
    files = ordered.file_offsets(spark, path)
    assert len(files) == 12 and max(n for *_, n in files) < 3 * 9000 / 12
    rows = [(r["v"], r["id"]) for _, p, _, _ in files for r in spark.read.parquet(p).collect()]
    assert rows == sorted(rows, key=lambda r: (-r[0], r[1])) and len(rows) == 9000
    got = {r["id"]: r["place"] for r in ordered.places(spark, path).collect()}
    assert all(got[i] == k for k, (_, i) in enumerate(rows))


def test_first_rows_come_from_the_needed_files(spark):
    path = scratch_path(spark, "t-first")
    df = spark.range(1000).select("id", (F.col("id") * 7 % 1000).alias("v"))
    order = [F.col("v").desc(), F.col("id")]
    ordered.write_sorted(df, path, order, files=10)
    top = ordered.read_first(spark, path, 20, order)
    assert [r["v"] for r in top.collect()] == list(range(999, 979, -1)) and len(top.inputFiles()) == 1
    assert ordered.read_first(spark, path, 5000, order).count() == 1000
    ordered.write_sorted(df.limit(0), path, order)
    assert ordered.read_first(spark, path, 5, order).count() == 0 and ordered.places(spark, path).count() == 0
