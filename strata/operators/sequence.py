"""Skew-proof ordered scans per key: ``lag`` and running sums.

``Window.partitionBy(key).orderBy(ts)`` sends every row of a key to one task, so
a key holding a third of the rows becomes a third of the job in one task, and
the job can never use more tasks than there are keys. AQE splits skewed *joins*,
not windows. Here the rows are instead range-partitioned on ``(key, order)``
(``repartitionByRange`` samples the data, so a hot key is cut into many
contiguous slices), the windows run per ``(slice, key)``, and the few rows at
slice boundaries are repaired from two small tables:

* lag fixes: for each slice, the first ``K`` rows of its first key, recomputed
  over the boundary rows of all slices (at most ``4*K`` rows per slice);
* running-sum offsets: per slice, the sum carried in from earlier slices of its
  first key (one row per slice).

Both tables hold at most ``P * 4K`` rows for ``P`` range partitions, a bound
fixed by configuration and independent of the data size, so they are broadcast
up to ``BROADCAST_SLICES`` slices.
The sliced rows are written once with a reliable ``checkpoint()`` (shared
checkpoint folder), so every branch reads the same slice ids; this is the one
eager step of the operator.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strata.session import pinned

PID, POS, CNT, KEY = "_sq_pid", "_sq_pos", "_sq_cnt", "_sq_key"
#: Boundary tables have at most 4 * K rows a slice (K: largest lag), so up to here 80,000 * K rows are broadcast.
BROADCAST_SLICES = 20_000


def _num_partitions(df: DataFrame, n: int | None) -> int:
    if n:
        return n
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def slice_by_range(df: DataFrame, keys: Sequence[str], order: Sequence[str], n: int) -> DataFrame:
    """Range-partition on ``(keys, order)`` into ``n`` slices, tag the slice id, checkpoint."""
    return pinned(df.repartitionByRange(n, *keys, *order).withColumn(PID, F.spark_partition_id()))


def _small(boundary: DataFrame, n: int) -> DataFrame:
    """A boundary table as a broadcast while the slices, which bound its rows, are few enough; beyond that AQE decides."""
    return F.broadcast(boundary) if n <= BROADCAST_SLICES else boundary


def ordered_scan(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    lags: Mapping[str, tuple[Column | str, int]] | None = None,
    running: Mapping[str, Column | str] | None = None,
    num_partitions: int | None = None,
    strategy: str = "auto",
) -> DataFrame:
    """Add ``lags`` and ``running`` columns computed per key in ``order``.

    ``strategy="auto"`` splits hot groups: rows per key are counted first (a
    partial aggregation); keys holding more than ``1/P`` of all rows (fewer
    than ``P`` keys by construction, so the list has a proven bound and is
    broadcast) go through the range-sliced scan, every other key through a
    plain ``Window.partitionBy(key)``, where no key can exceed one task's fair
    share. Without hot keys no slicing, checkpoint or boundary repair runs.
    ``"slices"`` always slices; ``"window"`` never does (only for inputs known
    to be free of hot keys).

    ``order`` must make rows unique within a key (add an id as last column).
    ``lags``: name -> (column, k); the result is that column's value ``k`` rows
    earlier in the key, null when there is no such row.
    ``running``: name -> column; the result is the inclusive running sum
    (nulls ignored, zero before the first non-null, like SQL ``sum() OVER``...
    except that an all-null prefix gives 0 rather than null).
    """
    lags = dict(lags or {})
    running = dict(running or {})
    if strategy not in ("auto", "slices", "window"):
        raise ValueError(strategy)
    if strategy == "window" and keys:
        return _window_scan(df, list(keys), list(order), lags, running)
    if strategy == "auto" and keys:
        n = _num_partitions(df, num_partitions)
        counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_sq_n"))
        total = counts.select(F.sum("_sq_n")).scalar()
        hot = counts.filter(F.col("_sq_n") * n > total).select(*keys).collect()  # < n rows
        if not hot:
            return _window_scan(df, list(keys), list(order), lags, running)
        spark = df.sparkSession
        hot_df = spark.createDataFrame(hot, df.select(*keys).schema).toDF(*[f"_sq_h{i}" for i in range(len(keys))])
        cond = reduce(lambda a, c: a & c, [F.col(k).eqNullSafe(F.col(f"_sq_h{i}")) for i, k in enumerate(keys)])
        cold = df.join(F.broadcast(hot_df), cond, "left_anti")
        warm = df.join(F.broadcast(hot_df), cond, "left_semi")
        return _window_scan(cold, list(keys), list(order), lags, running).unionByName(
            ordered_scan(warm, keys, order, lags, running, num_partitions, strategy="slices")
        )
    if not keys:
        df = df.withColumn(KEY, F.lit(0))
        keys = [KEY]
    keys = list(keys)
    order = list(order)
    kmax = max([k for _, k in lags.values()], default=0)
    n = _num_partitions(df, num_partitions)

    # Value columns ride along as plain columns named by their output name.
    staged = df
    for name, (c, _) in lags.items():
        staged = staged.withColumn(f"_sq_v_{name}", F.col(c) if isinstance(c, str) else c)
    for name, c in running.items():
        staged = staged.withColumn(f"_sq_s_{name}", F.col(c) if isinstance(c, str) else c)

    # The slices come from a sampled range partitioner. Branches that read them
    # must see the *same* slice ids, and column pruning would otherwise give each
    # branch its own (re-sampled) exchange. A reliable checkpoint into the shared
    # checkpoint folder pins them once and also cuts lineage, so a lost executor
    # re-reads the checkpoint instead of re-running the scan and shuffle.
    r0 = slice_by_range(staged, keys, order, n)
    key_struct = F.struct(*[F.col(k) for k in keys])

    w = Window.partitionBy(PID, *keys).orderBy(*order)
    cum = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    r = r0.withColumn(POS, F.row_number().over(w)).withColumn(
        CNT, F.count(F.lit(1)).over(Window.partitionBy(PID, *keys))
    )
    for name, (_, k) in lags.items():
        r = r.withColumn(f"_sq_l_{name}", F.lag(F.struct(F.col(f"_sq_v_{name}").alias("v")), k).over(w))
    for name in running:
        r = r.withColumn(f"_sq_c_{name}", F.coalesce(F.sum(f"_sq_s_{name}").over(cum), F.lit(0)))

    # Per slice: its first and last key (P rows).
    bounds = r0.groupBy(PID).agg(F.min(key_struct).alias("_sq_first"), F.max(key_struct).alias("_sq_last"))

    out = r
    if lags:
        b = r.join(_small(bounds, n), PID)
        is_first = key_struct.eqNullSafe(F.col("_sq_first"))
        is_last = key_struct.eqNullSafe(F.col("_sq_last"))
        b = b.filter((is_first & (F.col(POS) <= kmax)) | (is_last & (F.col(CNT) - F.col(POS) < kmax)))
        wb = Window.partitionBy(*keys).orderBy(*order)
        fix_cols = [
            F.lag(F.struct(F.col(f"_sq_v_{name}").alias("v")), k).over(wb).alias(f"_sq_f_{name}")
            for name, (_, k) in lags.items()
        ]
        fixes = (
            b.select(PID, POS, *keys, *order, *[f"_sq_v_{nm}" for nm in lags], is_first.alias("_sq_head"))
            .select(PID, POS, *keys, "_sq_head", *fix_cols)
            .filter(F.col("_sq_head") & (F.col(POS) <= kmax))
            .select(
                F.col(PID).alias("_sq_fpid"),
                F.col(POS).alias("_sq_fpos"),
                *[F.col(k).alias(f"_sq_fk_{i}") for i, k in enumerate(keys)],
                *[f"_sq_f_{nm}" for nm in lags],
                F.lit(True).alias("_sq_fixed"),
            )
        )
        cond = reduce(
            lambda a, c: a & c,
            [F.col(PID) == F.col("_sq_fpid"), F.col(POS) == F.col("_sq_fpos")]
            + [F.col(k).eqNullSafe(F.col(f"_sq_fk_{i}")) for i, k in enumerate(keys)],
        )
        out = out.join(_small(fixes, n), cond, "left")
        for name in lags:
            out = out.withColumn(
                name,
                F.when(F.col("_sq_fixed"), F.col(f"_sq_f_{name}.v")).otherwise(F.col(f"_sq_l_{name}.v")),
            )

    if running:
        # Sum of each running column over the *last* key block of every slice.
        per_block = r0.groupBy(PID, *keys).agg(
            *[F.coalesce(F.sum(f"_sq_s_{nm}"), F.lit(0)).alias(f"_sq_t_{nm}") for nm in running]
        )
        tail = per_block.groupBy(PID).agg(
            F.max_by(F.struct(*[F.col(f"_sq_t_{nm}") for nm in running]), key_struct).alias("_sq_tail"),
        )
        t = bounds.join(tail, PID)
        w_last = Window.partitionBy("_sq_last").orderBy(PID).rowsBetween(Window.unboundedPreceding, 0)
        w_all = Window.orderBy(PID)  # one row per slice: P rows in one task
        for nm in running:
            t = t.withColumn(f"_sq_cl_{nm}", F.sum(F.col(f"_sq_tail._sq_t_{nm}")).over(w_last))
        t = t.withColumn("_sq_prev_last", F.lag("_sq_last").over(w_all))
        offs = [
            F.when(F.col("_sq_prev_last").eqNullSafe(F.col("_sq_first")), F.lag(f"_sq_cl_{nm}").over(w_all))
            .otherwise(F.lit(0))
            .alias(f"_sq_o_{nm}")
            for nm in running
        ]
        t = t.select(F.col(PID).alias("_sq_opid"), F.col("_sq_first").alias("_sq_ofirst"), *offs)
        out = out.join(_small(t, n), F.col(PID) == F.col("_sq_opid"), "left")
        first_key = key_struct.eqNullSafe(F.col("_sq_ofirst"))
        for nm in running:
            out = out.withColumn(
                nm, F.col(f"_sq_c_{nm}") + F.when(first_key, F.col(f"_sq_o_{nm}")).otherwise(F.lit(0))
            )

    helper = [c for c in out.columns if c.startswith("_sq_")]
    return out.drop(*helper)


def _window_scan(df: DataFrame, keys: list[str], order: list[str], lags: dict, running: dict) -> DataFrame:
    """Plain per-key windows (for inputs without hot keys); same output contract."""
    w = Window.partitionBy(*keys).orderBy(*order)
    cum = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    out = df
    for name, (c, k) in lags.items():
        out = out.withColumn(name, F.lag(F.col(c) if isinstance(c, str) else c, k).over(w))
    for name, c in running.items():
        out = out.withColumn(name, F.coalesce(F.sum(F.col(c) if isinstance(c, str) else c).over(cum), F.lit(0)))
    return out
