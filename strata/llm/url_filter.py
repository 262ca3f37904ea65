"""URL filters: captures against dated lists, as the lists were when the page was fetched.

Method: dated events (an entry is added or removed) become validity intervals [from, to) per entry; a temporal
as-of join then gives every capture the entries that were active on its day. An entry names a host, a domain (the
host itself or any host below it), a path prefix (whole segments) or a whole URL without query. The
most specific active entry decides, the one with the longest value; of equally long ones an allowing entry wins.

Scale: a capture's URL becomes its keys (its host, the domains above it and its path prefixes of the lengths that the list has),
which meet the entries by equality, with the interval as a further condition, so there is no scan of the list per capture. Only distinct (URL, day) pairs
are looked up. Events are distinct per entry and day before they are ordered, so an entry has no more rows than days. Both sides of the
join with the entries, keys and intervals, are written tables, so that adaptive execution can split a hot host.

Defined results: a null or unparsable URL and a null day match nothing (blocked is false). Host and scheme are compared in lower
case, ports, user names, queries and fragments are ignored, paths keep their case. Of several events of an entry on
one day the addition counts. Repeated captures are judged each. Empty list: nothing is blocked. Columns of the
captures are carried along, the verdict is one struct column with a free name.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strata.llm.common import free_name, shared_table

#: Kinds of entries.
HOST, DOMAIN, PATH = "host", "domain", "path"


def intervals(events: DataFrame) -> DataFrame:
    """(action, kind, value, since, until) from events (action, kind, value, on, added); until is null while an entry lasts."""
    daily = events.where("on IS NOT NULL AND value IS NOT NULL").groupBy("action", "kind", "value", "on").agg(F.max("added").alias("added"))
    until = F.lead("on").over(Window.partitionBy("action", "kind", "value").orderBy("on"))
    return daily.withColumn("until", until).where("added").select("action", "kind", "value", F.col("on").alias("since"), "until")


def host(url: Column) -> Column:
    """The lower-case host without user and port; null where there is none."""
    authority = F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)", 1)
    name = F.lower(F.regexp_replace(F.regexp_replace(authority, r"^.*@", ""), r":[0-9]*$", ""))
    return F.when(name != "", name)


def path(url: Column) -> Column:
    """The path without the slashes at its ends, query and fragment."""
    return F.regexp_replace(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)", 1), r"^/+|/+$", "")


def _depths(entries: DataFrame) -> DataFrame:
    """(host, depths): the numbers of path segments of the path entries below a host."""
    paths = entries.where(F.col("kind") == PATH)
    depth = F.size(F.split("value", "/")) - 1
    return paths.groupBy(F.split_part("value", F.lit("/"), F.lit(1)).alias("host")).agg(F.collect_set(depth).alias("depths"))


def keys(asked: DataFrame, entries: DataFrame) -> DataFrame:
    """The (kind, value) pairs under which entries may concern each (url, day, host, path): those of a length that occurs in the list.

    Only these are spelled out, so a URL of very many segments costs no more than its length times the few depths listed for its host.
    """
    key = lambda kind, value: F.struct(F.lit(kind).alias("kind"), value.alias("value"))
    sizes = entries.where(F.col("kind") == DOMAIN).select(F.size(F.split("value", r"\.")).alias("n")).distinct()
    labels, listed = F.split("host", r"\."), [r["n"] for r in sizes.collect()]  # one number per length of a listed domain
    own = asked.join(_depths(entries), "host", "left")
    parts = F.split("path", "/+")
    domains = F.array(*[F.when(F.size(labels) >= n, key(DOMAIN, F.array_join(F.slice(labels, F.greatest(F.size(labels) - n + 1, F.lit(1)), F.lit(n)), "."))) for n in listed]) if listed else F.array()
    fit = F.filter("depths", lambda d: (d <= F.size(parts)) & (F.col("path") != ""))
    prefixes = F.transform(fit, lambda d: key(PATH, F.concat(F.col("host"), F.lit("/"), F.array_join(F.slice(parts, F.lit(1), d), "/"))))
    kind = "array<struct<kind:string,value:string>>"
    found = F.concat(F.array(key(HOST, F.col("host"))), F.array_compact(domains.cast(kind)), F.coalesce(prefixes, F.array().cast(kind)))
    return own.select("url", "day", F.explode(found).alias("key")).select("url", "day", "key.*")


def judge(captures: DataFrame, entries: DataFrame, url_col: str = "url", day_col: str = "fetched_on") -> tuple[DataFrame, str]:
    """``captures`` and a struct (host, n_entries, entry, blocked); also its name. ``entries`` are intervals."""
    asked = captures.select(F.col(url_col).alias("url"), F.col(day_col).alias("day")).where("url IS NOT NULL AND day IS NOT NULL").distinct()
    asked = asked.withColumns({"host": host(F.col("url")), "path": path(F.col("url"))}).where("host IS NOT NULL")
    entries = shared_table(entries, "list-intervals")
    asked = shared_table(keys(asked, entries), "url-keys")
    active = asked.join(entries, ["kind", "value"]).where("day >= since AND (until IS NULL OR day < until)")
    rank = F.struct(F.char_length("value").alias("length"), (F.col("action") == "allow").alias("allow"), "value")
    verdicts = active.groupBy("url", "day").agg(F.count("*").alias("n_entries"), F.max(rank).alias("best"))
    names = [free_name(captures, n) for n in ("asked_url", "asked_day", "asked_verdict")]
    verdicts = shared_table(verdicts.select(F.col("url").alias(names[0]), F.col("day").alias(names[1]), F.struct("n_entries", "best").alias(names[2])), "url-verdicts")
    joined = captures.join(verdicts, (captures[url_col] == F.col(names[0])) & (captures[day_col] == F.col(names[1])), "left")
    found, name = F.col(names[2]), free_name(captures, "filter")
    verdict = F.struct(
        host(F.col(url_col)).alias("host"),
        F.coalesce(found["n_entries"], F.lit(0)).cast("long").alias("n_entries"),
        found["best"]["value"].alias("entry"),
        F.coalesce(~found["best"]["allow"], F.lit(False)).alias("blocked"),
    )
    return joined.select(*[F.col(c) for c in captures.columns], verdict.alias(name)), name
