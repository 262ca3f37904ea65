"""Query catalog: one Spark query per operator, each with its DuckDB oracle.

``register(name, sql=...)`` adds a ``(spark, sf_dir) -> DataFrame`` function.
Table stand-ins (see SURVEY 7.4): entity series = ``events`` (entity
``user_id``, time ``ts``, id ``event_id``, class ``event_type``, measure
``value``); repositories = ``documents`` (id ``doc_id``, category ``lang``,
source ``source``, measure ``n_chars``, description ``text``); prices =
``orders`` (``o_custkey``, ``o_orderdate``, ``o_totalprice``, id ``o_orderkey``).

Doubles are rounded to 6 decimals in both engines: sums in a different order
differ in the last bits.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

QueryFn = Callable[[SparkSession, str], DataFrame]

_QUERIES: dict[str, QueryFn] = {}
_SQL: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn: QueryFn) -> QueryFn:
        if name in _QUERIES:
            raise ValueError(f"duplicate query {name}")
        _QUERIES[name] = fn
        if sql is not None:
            _SQL[name] = sql.strip()
        return fn

    return deco


def updated_since(df: DataFrame, col: str = "last_updated", out: str = "updated_since_start") -> DataFrame:
    """``col``, a wall-clock time, as a checkable column: not null and not before this call."""
    start = dt.datetime.now(dt.timezone.utc)
    return df.withColumn(out, F.coalesce(F.col(col) >= F.lit(start).cast("timestamp"), F.lit(False))).drop(col)


def _load_all() -> None:
    # Import for registration side effects.
    from strata.plans import q_text, q_stats, q_series, q_joins, q_clean, q_versions, q_stream  # noqa: F401


def queries() -> dict[str, QueryFn]:
    _load_all()
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    _load_all()
    return dict(_SQL)
