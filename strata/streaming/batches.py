"""Folders that micro-batches write to, without a commit log.

A micro-batch writes its rows under ``_batch=<epoch>`` partitions, replacing what an earlier attempt of the same
epoch wrote there, so a replay changes nothing and late rows are rows like any others. The engine's own checkpoint
says which epochs are done. Small running state goes to one of two slots in turn (``Slots``), a large one to buckets of
its keys with two slots each (``Buckets``). ``compact`` merges the partials of past epochs.
"""

from __future__ import annotations

import os
from collections.abc import Callable, Sequence
from contextlib import contextmanager

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

BATCH = "_batch"
BUCKET, SLOT, MARK = "_bucket", "_slot", "_mark"
#: Histories of long texts take about half the space that they take by the default codec, at this level a twelfth less than at its default.
CODEC, LEVEL = "zstd", "6"


def exists(spark: SparkSession, path: str) -> bool:
    """Whether a path exists in the store it names."""
    jvm = spark._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p)


def remove(spark: SparkSession, files: Sequence[str]) -> None:
    """Delete files, as ``DataFrame.inputFiles`` names them."""
    for name in files:
        p = spark._jvm.org.apache.hadoop.fs.Path(spark._jvm.java.net.URI(name))
        p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, False)


#: Adaptive execution, also in the session of a stream, which has it off; shuffle files go when the query that made them ends.
_CONF = {"spark.sql.adaptive.enabled": "true", "spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true", "parquet.compression.codec.zstd.level": LEVEL}


@contextmanager
def adaptive(spark: SparkSession):
    """Adaptive execution on, and the shuffle files of each query inside removed at its end, not when the driver next collects garbage."""
    before = {k: spark.conf.get(k, None) for k in _CONF}
    for k, v in _CONF.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def put(rows: DataFrame, path: str, epoch: int, by: Sequence[str] = (), within: Sequence[str] = ()) -> None:
    """Write the rows of an epoch, partitioned by ``by`` and the epoch; a replay replaces the partitions it writes.

    Rows are gathered by partition value, so that each has few files, and a value with very many rows is split over several tasks.
    With ``within`` they are not: wide rows do not move, each task writes its own rows in the order of these columns, and a value has at
    most as many files as the input has splits. Rows alike side by side compress better.
    """
    tagged = rows.withColumn(BATCH, F.lit(epoch).cast("long"))
    if within:
        tagged = tagged.sortWithinPartitions(*by, BATCH, *within)
    elif by:
        tagged = tagged.hint("rebalance", *by)
    with adaptive(rows.sparkSession):
        tagged.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*by, BATCH).parquet(path, compression=CODEC)


def get(spark: SparkSession, path: str, schema: T.StructType, by: Sequence[str] = ()) -> DataFrame:
    """All rows under ``path`` with their epoch; none where it does not exist yet. ``schema`` has the ``by`` columns."""
    plain = [f for f in schema.fields if f.name not in by]
    full = T.StructType([*plain, *[schema[c] for c in by], T.StructField(BATCH, T.LongType())])
    try:
        return spark.read.schema(full).parquet(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], full)


class Slots:
    """A small table that every epoch replaces: two folders, written in turn, each with the epoch it was made in.

    One row of each folder only marks its epoch, so that a table without rows has one too.
    """

    def __init__(self, spark: SparkSession, path: str, schema: T.StructType):
        self.spark, self.path = spark, path
        self.schema = T.StructType([*schema.fields, T.StructField(BATCH, T.LongType()), T.StructField(MARK, T.BooleanType())])

    def _slot(self, k: int) -> DataFrame:
        try:
            return self.spark.read.schema(self.schema).parquet(f"{self.path}/slot-{k}")
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
            return self.spark.createDataFrame([], self.schema)

    def _epochs(self) -> list[int]:
        """The epoch of each slot, -1 if it is empty."""
        return [-1 if (m := self._slot(k).agg(F.max(BATCH)).first()[0]) is None else m for k in (0, 1)]

    def _rows(self, slot: int) -> DataFrame:
        return self._slot(slot).filter(F.col(MARK).isNull()).drop(BATCH, MARK)

    def before(self, epoch: int) -> tuple[DataFrame, int]:
        """The newest state older than ``epoch``, and the slot to write ``epoch``'s to."""
        done = self._epochs()
        older = [k for k in (0, 1) if done[k] < epoch]
        newest = max(older, key=lambda k: done[k])
        return self._rows(newest), 1 - newest

    def write(self, rows: DataFrame, epoch: int, slot: int) -> None:
        mark = self.spark.range(1).select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in rows.schema.fields], F.lit(True).alias(MARK))
        marked = rows.withColumn(MARK, F.lit(None).cast("boolean")).unionByName(mark).withColumn(BATCH, F.lit(epoch).cast("long"))
        marked.write.mode("overwrite").parquet(f"{self.path}/slot-{slot}")

    def epoch(self) -> int:
        """The newest epoch, -1 if there is none."""
        return max(self._epochs())

    def latest(self) -> DataFrame:
        done = self._epochs()
        return self._rows(done.index(max(done)))


class Buckets:
    """A large table of one state per key, in buckets by a hash of the keys: an epoch rewrites the buckets of its own keys only.

    Each bucket has two slots, written in turn, as a table of ``Slots`` has; a slot's rows carry the epoch they were made in. The
    driver sees at most two rows a bucket. Choose ``buckets`` so that one of them is a few files.
    """

    def __init__(self, spark: SparkSession, path: str, schema: T.StructType, keys: Sequence[str], buckets: int):
        self.spark, self.path, self.schema = spark, path, schema
        self.bucket = F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")

    def _all(self) -> DataFrame:
        places = [T.StructField(c, T.IntegerType()) for c in (BUCKET, SLOT)]
        return get(self.spark, self.path, T.StructType([*self.schema.fields, *places]), [BUCKET, SLOT])

    def _newest(self, before: int | None = None) -> dict[int, int]:
        """Bucket -> the slot of its newest state, of those older than epoch ``before``."""
        done = self._all().groupBy(BUCKET, SLOT).agg(F.max(BATCH).alias("epoch"))
        if before is not None:
            done = done.filter(F.col("epoch") < before)
        return {r[BUCKET]: r["slot"] for r in done.groupBy(BUCKET).agg(F.max_by(SLOT, "epoch").alias("slot")).collect()}

    def _read(self, slots: dict[int, int]) -> DataFrame:
        """The given slots: a filter on partition columns alone, so other folders are not read."""
        of = [(F.col(SLOT) == k) & F.col(BUCKET).isin([b for b, s in slots.items() if s == k]) for k in (0, 1)]
        return self._all().filter(of[0] | of[1]).select(*self.schema.fieldNames())

    def merge(self, rows: DataFrame, epoch: int, combine: Callable[[DataFrame], DataFrame]) -> list[int]:
        """Replace the state of the buckets of ``rows`` by ``combine`` of their state before ``epoch`` and the rows; returns these buckets."""
        touched = sorted(r[0] for r in rows.select(self.bucket.alias(BUCKET)).distinct().collect())
        newest = self._newest(epoch)
        was = {b: newest[b] for b in touched if b in newest}
        out = combine(self._read(was).unionByName(rows.select(*self.schema.fieldNames())))
        slot = F.when(F.col(BUCKET).isin([b for b, s in was.items() if s == 0]), 1).otherwise(0)
        tagged = out.withColumn(BUCKET, self.bucket).withColumns({SLOT: slot, BATCH: F.lit(epoch).cast("long")})
        with adaptive(rows.sparkSession):
            tagged.hint("rebalance", BUCKET).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(BUCKET, SLOT).parquet(self.path, compression=CODEC)
        return touched

    def latest(self, upto: int | None = None) -> DataFrame:
        """The newest state, or that after epoch ``upto``, which stays readable while the epoch after it is written."""
        return self._read(self._newest(None if upto is None else upto + 1))


def merged(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The partials under ``path``: those merged by ``compact`` and those of later epochs."""
    base = Slots(spark, f"{path}-base", schema)
    return base.latest().unionByName(get(spark, path, schema).filter(F.col(BATCH) > base.epoch()).drop(BATCH))


def compact(spark: SparkSession, path: str, schema: T.StructType, upto: int, merge: Callable[[DataFrame], DataFrame]) -> None:
    """Merge the partials of the epochs up to ``upto``, all committed, into one table beside ``path``, then remove their folders.

    The table carries ``upto``, and ``merged`` reads only later folders beside it: a crash before the removal, or a second run, changes nothing.
    """
    base = Slots(spark, f"{path}-base", schema)
    done = base.epoch()
    if done < upto:
        before, slot = base.before(upto)
        later = get(spark, path, schema).filter(F.col(BATCH).between(done + 1, upto)).drop(BATCH)
        base.write(merge(before.unionByName(later)), upto, slot)
    _remove_epochs(spark, path, upto)


def _remove_epochs(spark: SparkSession, path: str, upto: int) -> None:
    if not exists(spark, path):
        return
    root = spark._jvm.org.apache.hadoop.fs.Path(path)
    store = root.getFileSystem(spark._jsc.hadoopConfiguration())
    for status in store.listStatus(root):
        name, _, epoch = os.path.basename(status.getPath().toString()).partition("=")
        if name == BATCH and epoch.isdigit() and int(epoch) <= upto:
            store.delete(status.getPath(), True)
