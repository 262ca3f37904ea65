"""SRC3 / SNK2: landed polls as a streaming source that admits at most n records, or what has waited t seconds.

``format("landed_polls")`` reads Parquet files below ``path`` in the order of their paths (a poll's name must sort after those of
earlier polls). A micro-batch gets ``max_records`` records as soon as so many are there, and fewer only once the oldest of
them has waited ``max_seconds`` since it landed: the count-or-time flush of a collector, with the micro-batch as the buffer. The offset is (file, row), so that a file may be
spread over micro-batches and a restarted query goes on where it stopped.

A backlog is taken up many flushes at a time: a micro-batch has up to ``flushes`` whole ones, and each task reads some that follow each other
and writes one file for each (``maxRecordsPerFile``). So the cost of a micro-batch is not paid for every flush.

Spark asks a Python source for its newest offset without telling the one it is at; the reader keeps that in the folder ``state``, written when a
micro-batch is planned, that is after Spark logged its offsets and before a later one is asked for.
"""

from __future__ import annotations

import json
import sys
import time
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs as fs
import pyarrow.parquet as pq
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition
from pyspark.sql.streaming import StreamingQuery

# The source travels to the Python workers by value: executors need no copy of this repository.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

FORMAT = "landed_polls"


def _store(path: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(path if "://" in path or path.startswith("file:") else f"file://{path}")


class Slice(InputPartition):
    """Rows [first, last) of a file."""

    def __init__(self, path: str, first: int, last: int):
        self.path, self.first, self.last = path, first, last


class Run(InputPartition):
    """Slices that follow each other: the whole flushes of one task."""

    def __init__(self, slices: list[Slice]):
        self.slices = slices


def runs(slices: list[Slice], size: int) -> list[Run]:
    """``slices`` cut into runs of ``size`` records, the last one with the rest."""
    out, own, room = [], [], size
    for s in slices:
        first = s.first
        while first < s.last:
            last = min(s.last, first + room)
            own.append(Slice(s.path, first, last))
            first, room = last, room - (last - first)
            if not room:
                out.append(Run(own))
                own, room = [], size
    return [*out, Run(own)] if own else out


class PollReader(DataSourceStreamReader):
    def __init__(self, options: dict, schema: T.StructType):
        self.path, self.names = options["path"], schema.fieldNames()
        self.max_records, self.max_seconds = int(options["max_records"]), float(options["max_seconds"])
        self.flushes, self.task_flushes = int(options.get("flushes", 1)), int(options.get("task_flushes", 1))
        self.state = options["state"]
        self.rows: dict[str, int] = {}
        self.at: dict | None = None

    def initialOffset(self) -> dict:
        return {"file": "", "row": 0}

    def _files(self, after: str) -> list[fs.FileInfo]:
        store, folder = _store(self.path)
        found = store.get_file_info(fs.FileSelector(folder, recursive=True, allow_not_found=True))
        # Names that start with _ or . are Spark's own: files of a write that has not ended, and its marks.
        shown = lambda f: not any(p[0] in "_." for p in f.path[len(folder) :].split("/") if p)
        return sorted((f for f in found if f.type == fs.FileType.File and f.path.endswith(".parquet") and shown(f) and f.path >= after), key=lambda f: f.path)

    def _count(self, path: str) -> int:
        if path not in self.rows:
            store, _ = _store(self.path)
            with store.open_input_file(path) as f:
                self.rows[path] = pq.ParquetFile(f).metadata.num_rows
        return self.rows[path]

    def _kept(self) -> dict:
        store, folder = _store(self.state)
        if store.get_file_info(f"{folder}/offset").type == fs.FileType.NotFound:
            return self.initialOffset()
        with store.open_input_stream(f"{folder}/offset") as f:
            return json.loads(f.read())

    def _keep(self, offset: dict) -> None:
        store, folder = _store(self.state)
        store.create_dir(folder)
        with store.open_output_stream(f"{folder}/offset.new") as f:
            f.write(json.dumps(offset).encode())
        store.move(f"{folder}/offset.new", f"{folder}/offset")

    def slices(self, start: dict, end: dict) -> list[Slice]:
        out = []
        for f in self._files(start["file"]):
            if f.path > end["file"]:
                break
            first = start["row"] if f.path == start["file"] else 0
            last = end["row"] if f.path == end["file"] else self._count(f.path)
            if last > first:
                out.append(Slice(f.path, first, last))
        return out

    def latestOffset(self) -> dict:
        self.at = self.at or self._kept()
        # Of the flush that is being filled: its room, its oldest record; ``end`` is behind all records seen, ``full`` behind the last whole flush.
        flushes, room, oldest = self.flushes, self.max_records, None
        end = full = self.at
        for f in self._files(self.at["file"]):
            first, last = (self.at["row"] if f.path == self.at["file"] else 0), self._count(f.path)
            if last - first >= room and flushes:
                whole = min(flushes, 1 + (last - first - room) // self.max_records)
                first += room + (whole - 1) * self.max_records
                full = end = {"file": f.path, "row": first}
                flushes, room, oldest = flushes - whole, self.max_records, None
            if not flushes:
                break
            if last > first:
                oldest = f.mtime.timestamp() if oldest is None else min(oldest, f.mtime.timestamp())
                end, room = {"file": f.path, "row": last}, room - (last - first)
        if full != self.at:
            return full  # the rest is the next micro-batch, once it is full or has waited
        if oldest is not None and time.time() - oldest < self.max_seconds:
            return self.at  # neither full nor waited long enough
        return end

    def partitions(self, start: dict, end: dict) -> list[Run]:
        self.at = end
        self._keep(end)
        return runs(self.slices(start, end), self.max_records * self.task_flushes)

    def read(self, partition: Run) -> Iterator[pa.RecordBatch]:
        for s in partition.slices:
            yield from self._rows(s)

    def _rows(self, s: Slice) -> Iterator[pa.RecordBatch]:
        store, _ = _store(self.path)
        with store.open_input_file(s.path) as f:
            file, groups, at, skipped = pq.ParquetFile(f), [], 0, 0
            for k in range(file.metadata.num_row_groups):  # the row groups that hold the slice
                n = file.metadata.row_group(k).num_rows
                if at + n <= s.first:
                    skipped = at + n
                elif at < s.last:
                    groups.append(k)
                at += n
            at = skipped
            for batch in file.iter_batches(columns=self.names, row_groups=groups):
                own = batch.slice(max(0, s.first - at), max(0, min(s.last - at, batch.num_rows) - max(0, s.first - at)))
                if own.num_rows:
                    yield own.select(self.names)
                at += batch.num_rows
                if at >= s.last:
                    return

    def commit(self, end: dict) -> None:
        pass


class LandedPolls(DataSource):
    @classmethod
    def name(cls) -> str:
        return FORMAT

    def streamReader(self, schema: T.StructType) -> PollReader:
        return PollReader(self.options, schema)


def poll_stream(spark: SparkSession, path: str, schema: T.StructType, state: str, max_records: int = 10, max_seconds: float = 60,
                flushes: int = 1, task_flushes: int = 16) -> DataFrame:
    """Records landed below ``path`` in flushes of at most ``max_records``; ``state`` is a folder of this stream's own.

    A micro-batch has up to ``flushes`` of them, a task up to ``task_flushes``; write it by ``flush_to`` with the same ``max_records`` then.
    """
    spark.dataSource.register(LandedPolls)
    r = spark.readStream.format(FORMAT).schema(schema).option("state", state)
    r = r.option("max_records", max_records).option("max_seconds", max_seconds)
    return r.option("flushes", flushes).option("task_flushes", task_flushes).load(path)


def flush_to(stream: DataFrame, sink: str, checkpoint: str, until_drained: bool = True, interval: str = "0 seconds",
             max_records: int = 0) -> StreamingQuery:
    """One file per flush of a ``poll_stream`` (its size is bounded by ``max_records``), each record once.

    Without ``max_records`` a micro-batch is one flush. ``until_drained`` stops once everything due is written; otherwise the query goes on until it is stopped.
    """
    w = (stream if max_records else stream.coalesce(1)).writeStream.format("parquet").option("path", sink).option("checkpointLocation", checkpoint)
    q = w.option("maxRecordsPerFile", max_records).trigger(processingTime=interval).start()
    try:
        if until_drained:
            q.processAllAvailable()
        else:
            q.awaitTermination()
    finally:
        q.stop()
    return q
