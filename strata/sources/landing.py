"""Landing-zone readers: JSON observation files and raw search responses (SRC1, SRC2, SRC6, SRC7).

Reads are distributed ``spark.read`` scans with a *declared* schema: no file is
opened on the driver and no schema is inferred (inference over a column that is
null in every record fails, and inference itself is a full extra pass).
Measures and times are declared as strings so one badly typed value cannot
turn a whole file into a corrupt record; they are converted in Silver with
``try_cast`` / ``try_to_timestamp``.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

CORRUPT = "_corrupt_record"

API_SCHEMA = T.StructType([
    T.StructField("full_name", T.StringType()),
    T.StructField("description", T.StringType()),
    T.StructField("language", T.StringType()),
    T.StructField("stargazers_count", T.StringType()),
    T.StructField("topics", T.ArrayType(T.StringType())),
    T.StructField("html_url", T.StringType()),
    T.StructField("timestamp", T.StringType()),
])

RSS_SCHEMA = T.StructType([
    T.StructField("full_name", T.StringType()),
    T.StructField("html_url", T.StringType()),
    T.StructField("description", T.StringType()),
    T.StructField("language", T.StringType()),
    T.StructField("stargazers_count", T.StringType()),
    T.StructField("updated_at", T.StringType()),
    T.StructField("source", T.StringType()),
    T.StructField("timestamp", T.StringType()),
])

# A raw search response: {"items": [{...repository fields...}, ...]}
SEARCH_ITEM = T.StructType([
    T.StructField("full_name", T.StringType()),
    T.StructField("description", T.StringType()),
    T.StructField("language", T.StringType()),
    T.StructField("stargazers_count", T.LongType()),
    T.StructField("topics", T.ArrayType(T.StringType())),
    T.StructField("html_url", T.StringType()),
    T.StructField("created_at", T.StringType()),
])
SEARCH_PAGE = T.StructType([T.StructField("items", T.ArrayType(SEARCH_ITEM))])


def landing_schema(schema: T.StructType) -> T.StructType:
    """``schema`` with the column for unparsable records."""
    if CORRUPT in schema.fieldNames():
        return schema
    return T.StructType(schema.fields + [T.StructField(CORRUPT, T.StringType())])


def read_landing(spark: SparkSession, path: str, schema: T.StructType, multiline: bool = True, glob: str = "*.json") -> DataFrame:
    """SRC1/SRC2: tolerant scan of a landing directory.

    ``multiline=True`` reads files that each hold a JSON array (one row per
    element) or a single object (one row); ``[]`` yields no row; files that do not
    match ``glob`` are ignored; a truncated file yields one row with ``_corrupt_record``
    set (quarantine it from Bronze with ``split_corrupt``). ``multiline=False``
    reads JSON Lines. A missing directory yields an empty DataFrame.
    """
    full = landing_schema(schema)
    reader = (
        spark.read.schema(full)
        .option("multiLine", multiline)
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", CORRUPT)
        .option("pathGlobFilter", glob)
        .option("recursiveFileLookup", True)
    )
    try:
        return reader.json(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":  # no folder yet: no data, not an error
            raise
        return spark.createDataFrame([], full)


def split_corrupt(bronze: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(good rows, quarantined rows). Call on a *written* Bronze table: Spark
    refuses queries over raw JSON that reference only the corrupt column."""
    bad = F.col(CORRUPT).isNotNull() & F.col("full_name").isNull()
    return bronze.filter(~bad), bronze.filter(bad)


def search_page_records(pages: DataFrame, raw: str = "raw", observed_at: str | None = None) -> DataFrame:
    """SRC6: raw search responses -> one 7-field observation per item.

    ``topics`` defaults to ``[]``; the observation time is the page's own
    ``observed_at`` column when given, else the current time.
    """
    parsed = pages.select(
        F.from_json(F.col(raw), SEARCH_PAGE).alias("_p"),
        (F.col(observed_at) if observed_at else F.current_timestamp()).alias("_obs"),
    )
    items = parsed.select(F.explode("_p.items").alias("it"), "_obs")
    return items.select(
        F.col("it.full_name").alias("full_name"),
        F.col("it.description").alias("description"),
        F.col("it.language").alias("language"),
        F.col("it.stargazers_count").cast("string").alias("stargazers_count"),
        F.coalesce(F.col("it.topics"), F.array().cast("array<string>")).alias("topics"),
        F.col("it.html_url").alias("html_url"),
        F.date_format(F.col("_obs"), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").alias("timestamp"),
    )


def recent_top(df: DataFrame, created: str, measure: str, tie: str, days: int = 7, n: int = 30) -> DataFrame:
    """SRC7: created within the last ``days`` (before the data's own max), measure > 0,
    top ``n`` by measure, ties by ``tie``."""
    newest = df.select(F.max(created)).scalar()
    recent = df.filter((F.col(created) > F.date_sub(newest, days)) & (F.col(measure) > 0))
    return recent.orderBy(F.desc(measure), F.asc(tie)).limit(n)
