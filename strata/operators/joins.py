"""Joins: cross-source equi-joins, time-proximity counts and mention joins (JN1-JN7).

Time proximity without pairs
----------------------------
"How many events fall within [t - before, t + after] of each anchor" is answered
without ever forming (anchor, event) pairs:

    count(anchor) = #events(ts <= t + after) - #events(ts < t - before)

Anchors become two probe rows (``t - before`` sorted *before* equal event times,
``t + after`` sorted *after* them) in one union with the events per distinct time,
and a single running count per key over ``(time, kind)`` gives both terms. The running
count is the skew-proof ``ordered_scan``, so neither a burst of events in one
hour nor one key holding a third of the rows lands in one task, and the cost is
a sort of the distinct event times and twice the distinct anchor times instead of a join whose candidate set
grows with the square of the density. Nested-loop and cartesian plans never
appear.

``range_join`` (bucketed equi-join plus exact residual, hot buckets split by measured counts)
gives the matching rows themselves.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strata.functions.text import tokens_words
from strata.operators.sequence import ordered_scan
from strata.session import pinned


def _interval(seconds: int) -> Column:
    return F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), F.lit(seconds))


def range_count(
    anchors: DataFrame,
    events: DataFrame,
    anchor_ts: str,
    event_ts: str,
    before_s: int,
    after_s: int,
    keys: Sequence[str] = (),
    name: str = "match_count",
) -> DataFrame:
    """Anchors (all columns kept) with the count of events in ``[ts-before, ts+after]``."""
    return range_sums(anchors, events, anchor_ts, event_ts, before_s, after_s, {name: F.lit(1).cast("long")}, keys)


def range_sums(
    anchors: DataFrame,
    events: DataFrame,
    anchor_ts: str,
    event_ts: str,
    before_s: int,
    after_s: int,
    sums: Mapping[str, Column],
    keys: Sequence[str] = (),
) -> DataFrame:
    """Anchors (all columns kept) with sums of whole-number columns over the events in ``[ts-before, ts+after]``.

    Bounds are inclusive; anchors without events get 0 (left-join semantics), as do
    anchors without a time or, with ``keys`` (equi + range condition), without a key.
    Rows without time or key count nowhere. Anchors may repeat: the sums are
    computed per distinct (key, time) and joined back, so no id is needed.
    """
    keys, names = list(keys), list(sums)
    held = {n: f"_rc_w{i}" for i, n in enumerate(names)}
    complete = [F.col(k).isNotNull() for k in keys]
    asked = _where(anchors, [F.col(anchor_ts).isNotNull(), *complete]).select(*keys, F.col(anchor_ts).alias("_rc_ts")).distinct()
    # One row per distinct time: a burst is summed before it is sorted.
    times = _where(events, [F.col(event_ts).isNotNull(), *complete]).groupBy(*keys, F.col(event_ts).alias("_rc_t"))
    times = times.agg(*[F.sum(sums[n]).cast("long").alias(held[n]) for n in names])

    def probe(shift: Column, kind: int) -> DataFrame:
        nothing = [F.lit(0).cast("long").alias(w) for w in held.values()]
        return asked.select(*keys, (F.col("_rc_ts") + shift).alias("_rc_t"), F.lit(kind).alias("_rc_kind"), *nothing, "_rc_ts")

    no_ts = F.lit(None).cast(asked.schema["_rc_ts"].dataType).alias("_rc_ts")
    both = probe(-_interval(before_s), 0).unionByName(probe(_interval(after_s), 2))
    u = both.unionByName(times.select(*keys, "_rc_t", F.lit(1).alias("_rc_kind"), *held.values(), no_ts))
    # Probes of one kind and time come from one anchor time, so the order is total.
    scanned = ordered_scan(u, keys, ["_rc_t", "_rc_kind"], running={f"_rc_c{w}": F.col(w) for w in held.values()})
    signed = lambda c: F.when(F.col("_rc_kind") == 2, F.col(c)).otherwise(-F.col(c))
    found = scanned.filter(F.col("_rc_ts").isNotNull()).groupBy(*keys, "_rc_ts")
    found = found.agg(*[F.sum(signed(f"_rc_c{w}")).cast("long").alias(f"_rc_n{w}") for w in held.values()])
    # From storage, so that AQE can split a time that very many anchors share.
    found = pinned(found)
    found = found.withColumnsRenamed({k: f"_rc_k{i}" for i, k in enumerate(keys)})
    cond = reduce(lambda a, c: a & c, [anchors[k] == found[f"_rc_k{i}"] for i, k in enumerate(keys)], anchors[anchor_ts] == found["_rc_ts"])
    out = [F.coalesce(f"_rc_n{held[n]}", F.lit(0)).cast("long").alias(n) for n in names]
    return anchors.join(found, cond, "left").select(*[anchors[c] for c in anchors.columns], *out)


def _where(df: DataFrame, conditions: Sequence[Column]) -> DataFrame:
    return df.filter(reduce(lambda a, c: a & c, conditions))


def _bucket_splits(buckets: DataFrame, by: Sequence[str], name: str, tasks: int) -> DataFrame:
    """(by, name) of the buckets with more than a task's fair share of rows: into how many parts each is split.

    The parts beyond the first add up to at most ``tasks`` over all buckets, so there are fewer rows than that.
    """
    counts = pinned(buckets.groupBy(*by).agg(F.count(F.lit(1)).alias("_rj_n")))
    total = counts.agg(F.coalesce(F.sum("_rj_n"), F.lit(0))).first()[0]
    share = max(1, -(-total // tasks))
    return counts.filter(F.col("_rj_n") > share).select(*by, F.ceil(F.col("_rj_n") / share).cast("int").alias(name))


#: Rows of a block of ``range_join`` on the left and on the right. A task holds the pairs of two blocks at a time, so their product stays small.
BLOCK, RIGHT_BLOCK = 512, 16


def _time_blocks(rows: DataFrame, columns: Sequence[str], by: Sequence[str], ts: str, ends: tuple[str, str], size: int, name: str) -> DataFrame:
    """(by, name_from, name_to, name_0, name_1, ...): the rows of equal ``by`` in order of time, up to ``size`` as one array per column, with the
    smallest of the first and the greatest of the second of ``ends``. Pairs are read from arrays of plain values without an object per row."""
    at = F.row_number().over(Window.partitionBy(*by).orderBy(ts)) - 1
    cut = rows.withColumn("_rj_c", F.floor(at / size)).groupBy(*by, "_rj_c")
    held = cut.agg(F.collect_list(F.struct(*columns)).alias("_rj_rows"), F.min(ends[0]).alias(f"{name}_from"), F.max(ends[1]).alias(f"{name}_to"))
    return held.select(*by, f"{name}_from", f"{name}_to", *[F.col("_rj_rows").getField(c).alias(f"{name}_{i}") for i, c in enumerate(columns)])


def range_join(
    left: DataFrame,
    right: DataFrame,
    left_ts: str,
    right_ts: str,
    before_s: int,
    after_s: int,
    keys: Sequence[str] = (),
    salt: int | None = None,
) -> DataFrame:
    """Matching pairs with ``right.ts`` in ``[left.ts - before, left.ts + after]``.

    Bucket width ``w = before + after``; each left row is replicated into the
    buckets its range touches (at most 2) and equi-joined with the right rows of
    that bucket (plus ``keys``), with the exact range as residual. Every pair meets
    in exactly one bucket (the right row's own), so there are no duplicates.

    A hot bucket is split by measured counts. The rows of both sides are counted per bucket (a partial
    aggregation); a bucket with more than its fair share of a side's rows gets that many parts of this side, its rows
    go to one part by a hash and the other side's rows to all of them. The list of split buckets has fewer rows than there are
    shuffle partitions and is broadcast. ``salt`` instead splits every bucket of the right side into so many parts.

    Within a part the rows go in blocks of ``BLOCK`` (right: ``RIGHT_BLOCK``) in order of time. Blocks meet, and their rows are compared then: pairs leave block by
    block, so that neighbouring pairs share their rows and a columnar file of them compresses well.
    """
    w = max(before_s + after_s, 1)
    by = ["_rj_b", *[f"_rj_k{i}" for i in range(len(keys))]]
    left, right = (_where(df, [F.col(c).isNotNull() for c in (ts, *keys)]) for df, ts in ((left, left_ts), (right, right_ts)))
    sec = lambda c: F.unix_micros(F.col(c).cast("timestamp")) / 1_000_000
    own = lambda df: df.withColumns({f"_rj_k{i}": F.col(k) for i, k in enumerate(keys)})
    touched = F.sequence(F.floor((sec(left_ts) - before_s) / w), F.floor((sec(left_ts) + after_s) / w))
    lb = own(left.withColumn("_rj_b", F.explode(touched)))
    rb = own(right.withColumn("_rj_b", F.floor(sec(right_ts) / w)))
    tasks = int(left.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    if salt is None:
        splits = {n: _bucket_splits(df.select(*by), by, n, tasks) for n, df in (("_rj_l", lb), ("_rj_r", rb))}
        for name, few in splits.items():
            few = F.broadcast(few)
            lb, rb = (df.join(few, by, "left").withColumn(name, F.coalesce(name, F.lit(1))) for df in (lb, rb))
    else:
        lb, rb = (df.withColumns({"_rj_l": F.lit(1), "_rj_r": F.lit(salt)}) for df in (lb, rb))
    part = lambda df, name: F.pmod(F.xxhash64(*[F.col(c) for c in df.columns]), F.col(name)).cast("int")
    each = lambda name: F.explode(F.sequence(F.lit(0), F.col(name) - 1))
    lb = lb.withColumn("_rj_i", part(left, "_rj_l")).withColumn("_rj_j", each("_rj_r"))
    rb = rb.withColumn("_rj_j", part(right, "_rj_r")).withColumn("_rj_i", each("_rj_l"))
    meet = [*by, "_rj_i", "_rj_j"]
    # A given number of tasks, not one found from the size of the rows: what a task makes of them grows with their square.
    lb, rb = (df.repartition(4 * tasks, *meet) for df in (lb, rb))
    # The bounds are found once a left row: arithmetic on times costs more than all else that a pair does.
    bounds = {"_rj_least": F.col(left_ts) - _interval(before_s), "_rj_most": F.col(left_ts) + _interval(after_s)}
    lb = _time_blocks(lb.withColumns(bounds), [*left.columns, *bounds], meet, left_ts, tuple(bounds), BLOCK, "_rj_l")
    rb = _time_blocks(rb.withColumn("_rj_at", F.col(right_ts)), [*right.columns, "_rj_at"], meet, right_ts, ("_rj_at", "_rj_at"), RIGHT_BLOCK, "_rj_r")
    overlap = (rb["_rj_r_to"] >= lb["_rj_l_from"]) & (rb["_rj_r_from"] <= lb["_rj_l_to"])
    blocks = rb.join(lb, reduce(lambda x, y: x & y, [rb[c] == lb[c] for c in meet], overlap))
    *own_l, least, most = [f"_rj_l_{i}" for i in range(len(left.columns) + 2)]
    *own_r, at = [f"_rj_r_{i}" for i in range(len(right.columns) + 1)]
    nth = lambda c: F.get(c, F.col("_rj_n")).alias(c)
    # The right row outside: its columns stay the same over a run of pairs, and those of the left row repeat from run to run.
    outer = blocks.select(*own_l, least, most, *own_r, F.posexplode(at).alias("_rj_n", "_rj_at"))
    outer = outer.select(*own_l, least, most, "_rj_at", *map(nth, own_r))
    pairs = outer.select(*own_l, most, "_rj_at", *own_r, F.posexplode(least).alias("_rj_n", "_rj_least"))
    near = pairs.filter((F.col("_rj_at") >= F.col("_rj_least")) & (F.col("_rj_at") <= nth(most)))
    return near.select(*map(nth, own_l), *own_r).toDF(*left.columns, *right.columns)


def entity_counts(df: DataFrame, key: str, name: str) -> DataFrame:
    """Pre-aggregate one side per entity before a cross-source join."""
    return df.groupBy(key).agg(F.count(F.lit(1)).alias(name))


def cross_source(left: DataFrame, right: DataFrame, key: str, how: str = "inner") -> DataFrame:
    """JN2: entities seen by both sources (inner), or only by the left (left_anti).

    Both sides are pre-aggregated per entity, so the join moves one row per
    entity and side however skewed the raw observations are.
    """
    if how not in ("inner", "left_semi", "left_anti", "full"):
        raise ValueError(how)
    return left.join(right, key, how)


def term_mentions(docs: DataFrame, text: str, group: str, vocabulary: DataFrame, term: str) -> DataFrame:
    """JN5: mentions of vocabulary terms in documents, per ``group`` (a source or an hour).

    Whole lower-cased words are matched. Tokens are counted per (group, word)
    first (partial aggregation: a hot word is one row per task), and only the
    counted distinct words meet the vocabulary in the join; AQE picks broadcast
    or shuffle from the measured size.
    """
    words = docs.select(F.col(group), F.explode(tokens_words(text)).alias("word"))
    counted = words.groupBy(group, "word").agg(F.count(F.lit(1)).alias("n"))
    vocab = vocabulary.select(F.col(term).alias("word")).distinct()
    hits = counted.join(vocab, "word")
    return hits.groupBy(group).agg(F.sum("n").alias("mentions"), F.count(F.lit(1)).alias("distinct_terms"))


#: Bits of a filter of hashes: 2 ** BITS, 8 MB as a whole, in rows of 2 ** ROW_BITS.
BITS, ROW_BITS = 26, 12


def _bit_row(hashed: Column) -> Column:
    return F.shiftright(hashed, ROW_BITS).bitwiseAND(F.lit((1 << (BITS - ROW_BITS)) - 1)).cast("int")


def hash_bits(hashed: DataFrame) -> DataFrame:
    """(_pm_row, _pm_longs): one bit per hash in column ``h``, as rows of longs; at most 2 ** (BITS - ROW_BITS) rows, however many hashes."""
    at = F.shiftright("h", 6).bitwiseAND(F.lit((1 << (ROW_BITS - 6)) - 1)).cast("int")
    bit = F.expr("shiftleft(1L, CAST(h & 63 AS INT))")
    longs = hashed.groupBy(_bit_row(F.col("h")).alias("_pm_row"), at.alias("at")).agg(F.bit_or(bit).alias("bits"))
    rows = longs.groupBy("_pm_row").agg(F.map_from_entries(F.collect_list(F.struct("at", "bits"))).alias("m"))
    dense = F.transform(F.sequence(F.lit(0), F.lit((1 << (ROW_BITS - 6)) - 1)), lambda k: F.coalesce(F.col("m")[k], F.lit(0).cast("long")))
    return rows.select("_pm_row", dense.alias("_pm_longs"))


def _phrase_bits(known: DataFrame) -> DataFrame:
    """``hash_bits`` of each ``_pm_phrase``."""
    return hash_bits(known.select(F.xxhash64("_pm_phrase").alias("h")))


def _has_bit() -> Column:
    """Whether the bit of ``_pm_hash`` is set: true for every hash of the filter, by chance for few others."""
    h = F.col("_pm_hash")
    at = F.shiftright(h, 6).bitwiseAND(F.lit((1 << (ROW_BITS - 6)) - 1)).cast("int")
    return (_bit_row(h) == F.col("_pm_row")) & (F.getbit(F.get("_pm_longs", at), h.bitwiseAND(F.lit(63)).cast("int")) == 1)


def where_hashed(df: DataFrame, hashed: Column, bits: DataFrame) -> DataFrame:
    """The rows whose hash is in the filter ``bits`` (``hash_bits``), and few others; the filter is broadcast, no row moves."""
    return df.withColumn("_pm_hash", hashed).join(F.broadcast(bits), _has_bit(), "left_semi").drop("_pm_hash")


def phrase_mentions(docs: DataFrame, text: str, names: DataFrame, name: str, keep: Sequence[str] = ()) -> DataFrame:
    """JN5: places where names of one or more words stand in the texts, each name as a whole.

    Rows (keep, word position from 0, words, name). Words are lower-cased runs of letters and digits, in texts and names
    alike; names that differ in other characters only are one, under the least of them. The number of words of the longest name is read first. Of the names that start at one place the longest counts, and a
    name inside a longer name's place does not.

    A place is looked up once per length that a name has, by the equality of the whole slice of words, one row per name. So no pairs of places
    and names with a common first word are formed, however many there are. Before that the hash of the slice is looked up in the names'
    bits (``_phrase_bits``), which have a fixed size and are broadcast: of the places without a name few move. A text carries only its matches to the last step, a running maximum over them.
    """
    known = names.select(tokens_words(name).alias("_pm_words"), F.col(name).alias("_pm_name")).filter(F.size("_pm_words") > 0)
    # Written once: the lengths, the bits and the join read the names again, which may be made of all the texts.
    known = pinned(known.groupBy("_pm_words").agg(F.min("_pm_name").alias("_pm_name")))
    lengths = [r[0] for r in known.select(F.size("_pm_words").alias("n")).distinct().sort("n").collect()]  # at most as many as the longest name has words
    bits = _phrase_bits(known.select(F.col("_pm_words").alias("_pm_phrase")))
    known = known.select(F.array_join("_pm_words", " ").alias("_pm_phrase"), F.size("_pm_words").alias("_pm_n"), "_pm_name")
    words = docs.select(*keep, F.monotonically_increasing_id().alias("_pm_doc"), tokens_words(text).alias("_pm_words")).filter(F.size("_pm_words") > 0)
    # Each place once per length; its words are cut out of the text's for the look-up, and joined only where that finds a bit.
    places = words.select(*keep, "_pm_doc", "_pm_words", F.posexplode("_pm_words").alias("_pm_at", "_pm_word"))
    places = places.withColumn("_pm_n", F.explode(F.array(*map(F.lit, lengths)).cast("array<int>"))).filter(F.col("_pm_at") + F.col("_pm_n") <= F.size("_pm_words"))
    places = places.select(*keep, "_pm_doc", "_pm_at", F.slice("_pm_words", F.col("_pm_at") + 1, F.col("_pm_n")).alias("_pm_phrase"))
    places = where_hashed(places, F.xxhash64("_pm_phrase"), bits).withColumn("_pm_phrase", F.array_join("_pm_phrase", " "))
    hits = places.join(known.select("_pm_phrase", "_pm_n", "_pm_name"), "_pm_phrase")
    # In order of start, longest first: a match counts if it ends beyond all before it.
    ends = F.col("_pm_at") + F.col("_pm_n")
    before = Window.partitionBy("_pm_doc").orderBy("_pm_at", F.desc("_pm_n")).rowsBetween(Window.unboundedPreceding, -1)
    kept = hits.withColumn("_pm_before", F.max(ends).over(before)).filter(F.col("_pm_before").isNull() | (ends > F.col("_pm_before")))
    return kept.select(*keep, F.col("_pm_at").alias("position"), F.col("_pm_n").alias("words"), F.col("_pm_name").alias("name"))


def vocabulary(df: DataFrame, text: str) -> DataFrame:
    """Distinct lower-cased words of a text column."""
    return df.select(F.explode(tokens_words(text)).alias("term")).distinct()


def hourly_mentions_vs_measure(mentions: DataFrame, measures: DataFrame, hour: str = "hour") -> DataFrame:
    """JN5: correlation of hourly mentions with the hourly mean measure; hours lacking a side drop out.

    Both sides are one row per hour. ``mentions`` has ``mentions``, ``measures`` has ``mean_value``.
    """
    return mentions.join(measures, hour).agg(
        F.corr(F.col("mentions").cast("double"), F.col("mean_value")).alias("correlation"), F.count(F.lit(1)).alias("hours")
    )


def words_near_in_time(left: DataFrame, right: DataFrame, text: str, ts: str, seconds: int, name: str = "near_count") -> DataFrame:
    """JN7: per word and time of the left source, occurrences of the same word in the right source within ``seconds``.

    Both sides are reduced to distinct (word, time) with counts first, once (from storage then). As in ``range_sums`` a left row asks
    before and after its time for the running count of the right side; here it takes its own count along, so that it need not be joined back.
    """
    words = lambda df, own: df.select(F.explode(tokens_words(text)).alias("word"), F.col(ts).alias("ts"), F.lit(own).alias("own"))
    every = words(left, True).unionByName(words(right, False)).filter(F.col("ts").isNotNull())
    counted = pinned(every.groupBy("word", "ts").agg(F.count_if("own").alias("l"), F.count_if(~F.col("own")).alias("r")))
    # (word, t, kind, n): n is the right count of an event (kind 1), the left count of a question (0 before equal times, 2 after them).
    kinds = [(0, F.col("ts") - _interval(seconds), "l"), (1, F.col("ts"), "r"), (2, F.col("ts") + _interval(seconds), "l")]
    rows = F.filter(F.array(*[F.struct(t.alias("t"), F.lit(k).alias("kind"), F.col(n).alias("n")) for k, t, n in kinds]), lambda s: s["n"] > 0)
    u = counted.select("word", F.explode(rows).alias("s")).select("word", "s.t", "s.kind", "s.n")
    right_n = F.when(F.col("kind") == 1, F.col("n")).otherwise(F.lit(0).cast("long"))
    scanned = ordered_scan(u, ["word"], ["t", "kind"], running={"c": right_n}).filter(F.col("kind") != 1)
    after = F.col("kind") == 2
    asked = F.when(after, F.col("t") - _interval(seconds)).otherwise(F.col("t") + _interval(seconds))
    signed = F.when(after, F.col("c")).otherwise(-F.col("c"))
    found = scanned.groupBy("word", asked.cast(counted.schema["ts"].dataType).alias("ts")).agg(F.max("n").alias("left_count"), F.sum(signed).cast("long").alias(name))
    return found.filter(F.col(name) > 0)
