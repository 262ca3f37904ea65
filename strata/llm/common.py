"""Helpers shared by the operators: shared scratch tables, text columns, Arrow maps."""

from __future__ import annotations

import sys
import types
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.session import scratch_path

ASCII_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
ASCII_LOWER = ASCII_UPPER.lower()
#: The white space of the contracts, `[\x20\x09-\x0D]`; bytes.split() splits at the same characters.
SPACES = " \t\n\x0b\x0c\r"
#: Rows that a task holds as Python objects at a time.
SLICE_ROWS = 256
#: About the bytes that a task sends to Python at a time. Spark's own bound is 64 MB, of which the executor holds
#: several copies in each task and its worker, and gives back little of them afterwards.
BATCH_BYTES = 2 << 20
BATCH_SETTING = "spark.sql.execution.arrow.maxBytesPerBatch"


def shared_table(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` below spark.checkpoint.dir and read it back: a cut of lineage that survives lost executors."""
    path = scratch_path(df.sparkSession, f"llm-{label}")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


#: Bytes of ASCII letters and digits and of characters beyond ASCII, A-Z lower-cased; all others become a space.
_PLAIN = bytes(c if chr(c).isalnum() else 0x20 for c in range(0x80)) + bytes(range(0x80, 0x100))
_FOLD = _PLAIN.translate(bytes.maketrans(ASCII_UPPER.encode(), ASCII_LOWER.encode()))


def plain_words(text: str | None) -> list[bytes]:
    """Maximal runs of ASCII letters, digits and characters beyond ASCII as UTF-8, A-Z lower-cased."""
    return (text or "").encode("utf-8", "surrogatepass").translate(_FOLD).split()


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def lower_ascii(c: Column) -> Column:
    """A-Z lower-cased, all other characters as they are (``lower`` alone would change É too)."""
    only_ascii = F.octet_length(c) == F.char_length(c)
    return F.when(only_ascii, F.lower(c)).otherwise(F.translate(c, ASCII_UPPER, ASCII_LOWER))


def free_name(df: DataFrame, name: str) -> str:
    """``name``, or with underscores before it, such that no column of ``df`` has it (case is ignored)."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = "_" + name
    return name


def kept(key: tuple, make: Callable[[], object]) -> object:
    """What ``make`` returns, made once a Python worker: tasks that run in it later find it again.

    Functions travel by value, so that their modules' globals do not outlive a task; a module of its own name does.
    """
    place = vars(sys.modules.setdefault("strata_llm_kept", types.ModuleType("strata_llm_kept")))
    if key not in place:
        place[key] = make()
    return place[key]


def slices(batches: Iterator[pa.RecordBatch], rows: int = SLICE_ROWS) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def map_in_arrow(df: DataFrame, run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: T.StructType | str) -> DataFrame:
    """``df.mapInArrow`` in batches of about ``BATCH_BYTES``.

    Spark reads the bound from the session when the result is computed, so it is set there; a session that has its own keeps it.
    """
    conf = df.sparkSession.conf
    conf.set(BATCH_SETTING, conf.get(BATCH_SETTING, str(BATCH_BYTES)))
    return df.mapInArrow(run, schema)


def add_struct(df: DataFrame, text_col: str, name: str, fields: T.StructType, make: Callable[[], Callable[[str | None], dict]]) -> DataFrame:
    """All columns of ``df`` and a struct column ``name`` that ``make()`` computes from the text.

    ``make`` runs once a task and returns the function of one text.
    """
    kept = df.schema.fields
    schema = T.StructType([*kept, T.StructField(name, fields)])
    at = df.columns.index(text_col)

    def run(batches):
        from pyspark.sql.pandas.types import to_arrow_type

        kind, of = to_arrow_type(fields), make()
        for part in slices(batches):
            made = pa.array([of(x) for x in part.column(at).to_pylist()], type=kind)
            yield pa.RecordBatch.from_arrays([*part.columns, made], names=[*[f.name for f in kept], name])

    return map_in_arrow(df, run, schema)


def bounded_sample(df: DataFrame, key: str, max_rows: int) -> DataFrame:
    """About ``max_rows`` rows at most, picked by a hash of ``key``: the same rows each time, no sort.

    All rows where the table has no more than that; else each with the probability max_rows / rows,
    so that the count exceeds max_rows by a few standard deviations at the most.
    """
    n = df.count()
    if n <= max_rows:
        return df
    share = int(max_rows / n * 2**31)
    return df.where(F.pmod(F.xxhash64(F.lit(77), F.col(key)), F.lit(2**31)) < share)
