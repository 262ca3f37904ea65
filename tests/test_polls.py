"""The count-or-time flush: files of at most n records, each record once, restarts, and the waiting time."""

import os
import time

from pyspark.sql import functions as F

from strata.session import scratch_path
from strata.sources import polls


def land(spark, root, poll, first, n, files=1):
    spark.range(first, first + n).withColumn("text", F.concat(F.lit("t"), "id")).repartition(files).write.parquet(f"{root}/landing/poll{poll:03d}")


def drain(spark, root, n=10, seconds=0):
    st = polls.poll_stream(spark, f"{root}/landing", spark.range(0).withColumn("text", F.lit("")).schema, f"{root}/state", n, seconds)
    polls.flush_to(st, f"{root}/sink", f"{root}/ck")
    got = spark.read.schema(st.schema).parquet(f"{root}/sink").withColumn("file", F.input_file_name())
    return sorted(r["id"] for r in got.collect()), sorted(r["count"] for r in got.groupBy("file").count().collect())


def test_files_of_at_most_ten_records_and_restarts(spark):
    root = scratch_path(spark, "t-polls")
    land(spark, root, 0, 0, 23, files=3)
    land(spark, root, 1, 23, 4)
    ids, sizes = drain(spark, root)
    assert ids == list(range(27)) and sizes == [7, 10, 10]
    assert drain(spark, root) == (ids, sizes)  # nothing new, nothing twice
    land(spark, root, 2, 27, 12)
    land(spark, root, 3, 39, 0)
    ids, sizes = drain(spark, root)
    assert ids == list(range(39)) and max(sizes) <= 10 and sum(sizes) == 39


def test_fewer_records_wait_for_their_time(spark):
    root = scratch_path(spark, "t-wait")
    land(spark, root, 0, 0, 14)
    assert drain_sizes(spark, root, 3600) == [10]  # four are left waiting
    old = time.time() - 7200
    for folder, _, names in os.walk(f"{root}/landing"):
        for n in names:
            os.utime(os.path.join(folder, n), (old, old))
    assert drain_sizes(spark, root, 3600) == [4, 10]


def drain_sizes(spark, root, seconds):
    return drain(spark, root, 10, seconds)[1]


def test_a_killed_flush_goes_on(spark):
    """A micro-batch that was planned but not written is written after a restart, once."""
    root = scratch_path(spark, "t-killed")
    land(spark, root, 0, 0, 25)
    st = polls.poll_stream(spark, f"{root}/landing", spark.range(0).withColumn("text", F.lit("")).schema, f"{root}/state", 10, 0)
    broken = st.withColumn("text", F.when(F.col("id") == 15, F.raise_error(F.lit("killed")).cast("string")).otherwise(F.col("text")))
    try:
        polls.flush_to(broken, f"{root}/sink", f"{root}/ck")
        raise AssertionError("not killed")
    except Exception as e:
        assert "killed" in str(e) and "not killed" not in str(e)
    ids, sizes = drain(spark, root)
    assert ids == list(range(25)) and sizes == [5, 10, 10]


def test_a_backlog_is_many_flushes_of_one_micro_batch(spark):
    """Whole flushes first, across files; what remains is a flush by time. One file each, each record once, few micro-batches."""
    root = scratch_path(spark, "t-backlog")
    schema = spark.range(0).withColumn("text", F.lit("")).schema
    land(spark, root, 0, 0, 233, files=3)
    land(spark, root, 1, 233, 0)
    land(spark, root, 2, 233, 64)

    def drain(seconds):
        st = polls.poll_stream(spark, f"{root}/landing", schema, f"{root}/state", 10, seconds, flushes=20, task_flushes=3)
        q = polls.flush_to(st, f"{root}/sink", f"{root}/ck", max_records=10)
        got = spark.read.schema(schema).parquet(f"{root}/sink").withColumn("file", F.input_file_name())
        return sorted(r["id"] for r in got.collect()), sorted(r["count"] for r in got.groupBy("file").count().collect()), [p["numInputRows"] for p in q.recentProgress if p["numInputRows"]]

    ids, sizes, batches = drain(3600)
    assert len(ids) == len(set(ids)) == 290 and sizes == [10] * 29 and batches == [200, 90]
    ids, sizes, batches = drain(0)
    assert ids == list(range(297)) and sizes == [7] + [10] * 29 and batches == [7]


def test_runs_cut_slices_into_whole_flushes():
    cut = polls.runs([polls.Slice("a", 5, 12), polls.Slice("b", 0, 3), polls.Slice("c", 0, 9)], 4)
    assert [[(s.path, s.first, s.last) for s in r.slices] for r in cut] == [[("a", 5, 9)], [("a", 9, 12), ("b", 0, 1)], [("b", 1, 3), ("c", 0, 2)], [("c", 2, 6)], [("c", 6, 9)]]
