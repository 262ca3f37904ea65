"""One query ``opN_<name>`` per operator, and the pipeline: digests of the operators' real outputs.

``oracle_sql`` holds DuckDB SQL where SQL can express a query; the others are tested against brute force.
"""

from __future__ import annotations

from collections.abc import Callable
from fractions import Fraction

import corpus_pipeline
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.llm import chat, decontaminate, lattice_lm, license_scan, line_dedup, near_dup, packing, pii, quality_rules, ranked_search, repair, site_bayes, url_filter
from strata.llm.common import read

_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
_SQL: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def keep(fn):
        _QUERIES[name] = fn
        if sql:
            _SQL[name] = sql.strip()
        return fn

    return keep


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(_SQL)


@register("op1_pigeonhole")
def op1_pigeonhole(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.leaks(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


_OP2_SQL = r"""
WITH r AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'),
e AS (SELECT *, length(regexp_replace(text, '([<\[])(\\*)(\||/?s>|/?INST\]|</?SYS>>)', '\1\\\2\3', 'g')) AS chars FROM r)
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn)) AS turns_sha256,
  coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn) FILTER (role = 'assistant'), '')) AS loss_sha256,
  sum(17 + length(role) + chars)::BIGINT AS formatted_chars
FROM e GROUP BY conv_id
"""


@register("op2_reply_trees", _OP2_SQL)
def op2_reply_trees(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = read(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    control = "</s>[INST] ok [/INST]"
    own = spark.sql(f"SELECT * FROM VALUES (-7L, 0L, 'user', '{control}'), (-7L, 1L, 'assistant', '{control}') AS t(conv_id, turn, role, text)")
    done = chat.format_paths(chat.conversation_paths(rows.union(own)))
    # Read back from the formatted text.
    back = done.select("tree", "formatted", chat.read_turns(F.col("formatted")).alias("turns"))
    loss = F.array_join(F.transform(F.filter("turns", lambda t: t["role"] == chat.LOSS_ROLE), lambda t: t["text"]), "")
    said = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return back.select(
        chat.conv_id(F.col("tree")).alias("conv_id"),
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(said, 256).alias("turns_sha256"),
        F.char_length(loss).cast("long").alias("loss_chars"),
        F.sha2(loss, 256).alias("loss_sha256"),
        F.char_length("formatted").cast("long").alias("formatted_chars"),
    )


_OP3_SQL = r"""
WITH c AS (SELECT page_id, url, DATE '2024-01-01' + (page_id * 7919 % 365)::INT AS fetched_on,
  nullif(lower(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://([^/?#:]*)', 1)), '') AS host,
  regexp_replace(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)', 1), '^/+|/+$', '', 'g') AS path FROM pages),
v AS (SELECT DISTINCT 'block' AS action, 'host' AS kind, host AS value FROM c WHERE host IS NOT NULL
  UNION SELECT 'block', 'domain', regexp_replace(host, '^[^.]*[.]', '') FROM c WHERE host IS NOT NULL
  UNION SELECT 'allow', 'path', host || '/' || split_part(path, '/', 1) FROM c WHERE host IS NOT NULL AND path <> ''),
h AS (SELECT *, ('0x' || substr(md5(kind || ':' || value), 1, 6))::INT AS n FROM v),
i AS (SELECT action, kind, value, DATE '2024-01-01' + (n % 200) AS since, DATE '2024-01-01' + (n % 200 + 60) AS until FROM h WHERE n % 3 = 0
  UNION ALL SELECT action, kind, value, DATE '2024-01-01' + (n % 200 + 100), NULL FROM h WHERE n % 3 = 0),
m AS (SELECT page_id, i.* FROM c JOIN i ON fetched_on >= since AND (until IS NULL OR fetched_on < until) AND (
  kind = 'host' AND host = value OR kind = 'domain' AND (host = value OR ends_with(host, '.' || value))
  OR kind = 'path' AND (host || '/' || path = value OR starts_with(host || '/' || path, value || '/')))),
b AS (SELECT page_id, count(*) AS n_entries, arg_max(value, (length(value), action = 'allow', value)) AS entry,
  arg_max(action, (length(value), action = 'allow', value)) AS action FROM m GROUP BY page_id)
SELECT c.page_id, c.fetched_on, c.host, coalesce(b.n_entries, 0) AS n_entries, b.entry, coalesce(b.action = 'block', false) AS blocked
FROM c LEFT JOIN b ON c.page_id = b.page_id
"""


def list_events(captures: DataFrame) -> DataFrame:
    """The tables hold no dated list, so its events are derived from the captures' own hosts, the domains above them and their first path segments:
    every third by a digest is added on a day of the digest's, removed after 60 days and added again after 100."""
    host, path = url_filter.host(F.col("url")), url_filter.path(F.col("url"))
    seen = captures.select(host.alias("host"), F.split_part(path, F.lit("/"), F.lit(1)).alias("first")).where("host IS NOT NULL").distinct()
    entry = lambda action, kind, value: F.struct(F.lit(action).alias("action"), F.lit(kind).alias("kind"), value.alias("value"))
    start = F.when(F.col("first") != "", F.concat("host", F.lit("/"), "first"))
    named = seen.select(F.inline(F.array(entry("block", "host", F.col("host")), entry("block", "domain", F.regexp_replace("host", r"^[^.]*[.]", "")), entry("allow", "path", start))))
    named = named.where("value IS NOT NULL").distinct().withColumn("n", F.conv(F.substring(F.md5(F.concat_ws(":", "kind", "value")), 1, 6), 16, 10).cast("int"))
    days = F.explode(F.array(*[F.struct(F.lit(d).alias("after"), F.lit(a).alias("added")) for d, a in ((0, True), (60, False), (100, True))])).alias("event")
    events = named.where("n % 3 = 0").select("action", "kind", "value", "n", days)
    return events.select("action", "kind", "value", F.date_add(F.lit("2024-01-01").cast("date"), (F.col("n") % 200 + F.col("event.after")).cast("int")).alias("on"), "event.added")


@register("op3_temporal_lists", _OP3_SQL)
def op3_temporal_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A capture's day is derived from its page_id, as the table has none."""
    day = F.date_add(F.lit("2024-01-01").cast("date"), (F.col("page_id") * 7919 % 365).cast("int"))
    captures = read(spark, sf_dir, "pages").select("page_id", "url", day.alias("fetched_on"))
    judged, name = url_filter.judge(captures, url_filter.intervals(list_events(captures)))
    return judged.select("page_id", "fetched_on", f"{name}.*")


@register("op4_lattice_lm")
def op4_lattice_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lattice_lm.score(read(spark, sf_dir, "documents").select("doc_id", "text")).withColumnRenamed("doc", "doc_id")


@register("op5_superminhash")
def op5_superminhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    found = near_dup.find_components(docs, width=3, threshold=Fraction(85, 100))
    return found.select(F.col("doc").alias("doc_id"), F.col("n").alias("n_shingles"), F.col("component").alias("component_id"), "kept")


@register("op6_site_bayes")
def op6_site_bayes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``source`` is the host and ``lang`` the path below it. Losing a good document weighs four times a bad one kept."""
    found = site_bayes.classify(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))
    toxic, good = F.col("toxic_posterior") > 0.6, F.col("quality_posterior") >= 0.2
    rates = [F.round(f"{t}_{k}", 6).alias(f"{t}_{k}") for t in site_bayes.TARGETS for k in ("own", "site", "posterior")]
    return found.select(F.col("id").alias("doc_id"), "host", "path", *rates, toxic.alias("toxic"), (good & ~toxic).alias("kept"))


@register("op7_packing")
def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = packing.pack(read(spark, sf_dir, "documents").select("doc_id", "text"))
    return pieces.select("doc_id", "start", "length", F.crc32("token_ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


def _spans(c: Column) -> Column:
    return F.array_join(F.transform(c, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def _count(c: Column, kind: str) -> Column:
    return F.size(F.filter(c, lambda s: s["kind"] == kind)).cast("long")


@register("op8_pii")
def op8_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found, name = pii.add_spans(read(spark, sf_dir, "documents").select("doc_id", "text"))
    base, added = F.col(name)["base"], F.col(name)["added"]
    place = lambda s: F.struct(s["start"], F.array_position(F.array(*map(F.lit, pii.KINDS)), s["kind"]), s["end"], s["kind"])
    both = F.transform(F.array_sort(F.transform(F.concat(base, added), place)), lambda s: F.struct(s["kind"].alias("kind"), s["start"].alias("start"), s["end"].alias("end")))
    return found.select(
        "doc_id",
        *[_count(base, kind).alias(f"n_{kind}") for kind in pii.KINDS],
        F.sha2(_spans(base), 256).alias("base_sha256"),
        _spans(both).alias("spans"),
    )


_OP9_SQL = r"""
WITH d AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents),
l AS (SELECT doc_id, unnest(ls) AS line, generate_subscripts(ls, 1) AS pos FROM d),
k AS (SELECT doc_id, line, pos, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
  'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM l),
c AS (SELECT key, max(doc_id) AS holder FROM k WHERE length(key) >= 40 GROUP BY key HAVING count(DISTINCT doc_id) >= 5)
SELECT k.doc_id, count(*) AS n_lines, count(c.key) FILTER (k.doc_id <> c.holder) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (c.key IS NULL OR k.doc_id = c.holder), '')) AS kept_sha256
FROM k LEFT JOIN c ON k.key = c.key GROUP BY k.doc_id
"""


@register("op9_line_dedup", _OP9_SQL)
def op9_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = line_dedup.dedup_lines(read(spark, sf_dir, "documents").select("doc_id", "text"))
    return cut.select("doc_id", "n_lines", "n_dropped", F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"))


@register("op10_quality_rules")
def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    judged, name = quality_rules.judge(docs, quality_rules.learn(docs, read(spark, sf_dir, "labels")))
    numbers = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    return judged.select("doc_id", *[f"{name}.{c}" for c in (*numbers, "base_failed", "kept", "rule")])


_OP11_SQL = r"""
WITH RECURSIVE o AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
  coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ') AS name FROM conversations),
h AS (SELECT *, xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(name, ''), lambda c: ascii(c)::BIGINT)), lambda crc, b:
  list_reduce(list_prepend(xor(crc, b), range(8)), lambda x, i: xor(x >> 1, 3988292384 * (x & 1)))), 4294967295::BIGINT) % 20 AS d FROM o),
g AS (SELECT conv_id, turn, CASE d WHEN 4 THEN 'user' ELSE role END AS role,
  CASE d WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text
  FROM h, (VALUES (1), (2)) AS c(copy) WHERE d <> 0 AND (copy = 1 OR d = 3)),
p AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS pos FROM g),
f AS (SELECT *, substr(role, 1, 1) AS first, lag(substr(role, 1, 1)) OVER (PARTITION BY conv_id ORDER BY pos) AS before,
  CASE WHEN NOT regexp_matches(text, '[^\x20\x09-\x0D]') THEN 'b'
    WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY pos) > 1 THEN 'd'
    WHEN NOT regexp_matches(text, '[.!?][\x20\x09-\x0D]*\z') THEN 't' ELSE '' END AS fault FROM p),
ins(q, j, p) AS (VALUES (0, 0, 0), (0, 1, 2), (0, 2, 3), (1, 0, 1), (1, 1, 2), (1, 2, 3), (2, 0, 2), (2, 1, 3), (2, 2, 2), (3, 0, 3), (3, 1, 2), (3, 2, 3)),
edit(letter, price, p, first, nq) AS (VALUES ('K', 0, 0, 's', 1), ('K', 0, 0, 'u', 2), ('K', 0, 1, 'u', 2), ('K', 0, 3, 'u', 2), ('K', 0, 2, 'a', 3),
  ('R', 1, 0, NULL, 2), ('R', 1, 1, NULL, 2), ('R', 1, 2, NULL, 3), ('R', 1, 3, NULL, 2), ('D', 2, 0, NULL, 0), ('D', 2, 1, NULL, 1), ('D', 2, 2, NULL, 2), ('D', 2, 3, NULL, 3)),
said AS (SELECT q, j, p, list_transform(range(j), lambda i: CASE WHEN (q = 2) = (i % 2 = 0) THEN 'assistant:' ELSE 'user:' END) AS parts FROM ins),
dp AS (SELECT DISTINCT conv_id, 0::BIGINT AS pos, 0 AS q, 0::BIGINT AS cost, '' AS audit, []::VARCHAR[] AS parts FROM f
  UNION ALL SELECT conv_id, pos, nq, min(cost), arg_min(audit, (cost, audit)), arg_min(parts, (cost, audit)) FROM (
    SELECT f.conv_id, f.pos, e.nq, dp.cost + 5 * s.j + e.price + CASE WHEN f.fault = 't' AND e.letter <> 'D' THEN 5 ELSE 0 END AS cost,
      dp.audit || repeat('I', s.j::INT) || e.letter AS audit, dp.parts || s.parts || CASE e.letter WHEN 'D' THEN []::VARCHAR[]
        WHEN 'K' THEN [f.role || ':' || f.text] ELSE [CASE e.nq WHEN 2 THEN 'user:' ELSE 'assistant:' END || f.text] END AS parts
    FROM dp JOIN f ON f.conv_id IS NOT DISTINCT FROM dp.conv_id AND f.pos = dp.pos + 1 JOIN said s ON s.q = dp.q
      JOIN edit e ON e.p = s.p AND (e.letter <> 'K' OR e.first = f.first) AND (e.letter = 'D' OR f.fault NOT IN ('b', 'd'))) GROUP BY ALL),
n AS (SELECT conv_id, max(pos) AS n, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (fault = 'b') AS blank,
  count(*) FILTER (fault = 'd') AS duplicate, count(*) FILTER (fault = 't') AS truncated,
  count(*) FILTER (pos > 1 AND before || first NOT IN ('su', 'ua', 'au')) AS illegal FROM f GROUP BY conv_id),
z AS (SELECT dp.conv_id, arg_min((cost + 5 * j, audit || repeat('I', j::INT), dp.parts || s.parts), (cost + 5 * j, audit || repeat('I', j::INT))) AS r
  FROM dp JOIN n ON n.conv_id IS NOT DISTINCT FROM dp.conv_id AND n.n = dp.pos JOIN said s ON s.q = dp.q AND s.p IN (0, 3) GROUP BY dp.conv_id)
SELECT c.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated,
  coalesce(illegal, 0) AS illegal, coalesce(r[1], 0)::BIGINT AS cost, coalesce(r[2], '') AS audit, sha256(coalesce(array_to_string(r[3], chr(10)), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) c LEFT JOIN n ON n.conv_id IS NOT DISTINCT FROM c.conv_id LEFT JOIN z ON z.conv_id IS NOT DISTINCT FROM c.conv_id
"""


def damage(rows: DataFrame) -> DataFrame:
    """The contract's damage, decided by a checksum of each row's conversation and turn."""
    space, name = F.lit(" "), lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    kind = F.crc32(F.concat(name("conv_id"), F.lit(":"), name("turn"))) % 20
    text, role = F.coalesce("text", space), F.coalesce("role", space)
    text = F.when(kind == 1, "").when(kind == 2, F.regexp_replace(text, "[.!?]", "")).otherwise(text)
    copies = F.when(kind == 0, F.array().cast("array<int>")).when(kind == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return rows.select("conv_id", "turn", F.when(kind == 4, "user").otherwise(role).alias("role"), text.alias("text"), F.explode(copies).alias("copy")).drop("copy")


@register("op11_structure_repair", _OP11_SQL)
def op11_structure_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = read(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    repaired, by_conv = repair.repair(damage(rows))
    fault = lambda kind: F.count_if(F.col("fault") == kind).alias(kind)
    gap = F.coalesce(F.max("turn") - F.min("turn") + 1 - F.count_distinct("turn"), F.lit(0)).cast("long")
    faults = repaired.groupBy("conv").agg(gap.alias("gaps"), *map(fault, ("blank", "duplicate", "truncated")), F.count_if("illegal").alias("illegal"))
    done = repair.digests(repaired, by_conv)
    all_ids = rows.select("conv_id").distinct()
    found = all_ids.join(faults, all_ids["conv_id"].eqNullSafe(faults["conv"]), "left").drop("conv")
    found = found.join(done, found["conv_id"].eqNullSafe(done["conv"]), "left")
    numbers = [F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    return found.select("conv_id", *numbers, F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("repaired_sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256"))


_OP12_SQL = r"""
WITH d AS (SELECT doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS ts FROM documents),
s AS (SELECT count(*)::BIGINT AS docs, sum(len(ts))::BIGINT AS total FROM d WHERE len(ts) > 0),
p AS (SELECT doc_id, n, term, count(*)::BIGINT AS tf FROM (SELECT doc_id, len(ts) AS n, unnest(ts) AS term FROM d) GROUP BY ALL),
v AS (SELECT term, floor(1000 * ln((2 * docs + 2) / (2 * count(*) + 1)))::BIGINT AS w FROM p, s GROUP BY term, docs),
q AS (SELECT item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark),
r AS (SELECT item_id, doc_id, sum(w * ((1000000000 * tf) // (1000 * tf + 12 * (75 + (25 * n * docs) // total))))::BIGINT AS score
  FROM q JOIN p USING (term) JOIN v USING (term), s GROUP BY item_id, doc_id)
SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id)::INT AS rank, doc_id, score FROM r WHERE score > 0
QUALIFY rank <= 20
"""


@register("op12_ranked_search", _OP12_SQL)
def op12_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    index, documents, _ = ranked_search.build(read(spark, sf_dir, "documents"))
    return ranked_search.search(index, documents, read(spark, sf_dir, "benchmark"))


_OP13_TEMPLATES = ", ".join(f"({k}, '{t.label}', {t.scale}, {t.need}, {len(t.words)}, '{w.decode()}')" for k, t in enumerate(license_scan.prepare(license_scan.TEMPLATES, license_scan.PERCENT)) for w in t.words)
_OP13_SQL = rf"""
WITH d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM documents),
w AS (SELECT doc_id, unnest(ws) AS word, generate_subscripts(ws, 1) - 1 AS pos FROM d),
p AS (SELECT doc_id, word, pos, lead(word, 1) OVER o AS next, lead(word, 2) OVER o AS third FROM w WINDOW o AS (PARTITION BY doc_id ORDER BY pos)),
b AS (SELECT doc_id, pos, CASE WHEN word = 'cc' AND next = 'by' THEN 'cc-by' WHEN word = 'general' AND next = 'public' AND third = 'license' THEN 'gpl'
  WHEN word = 'all' AND next = 'rights' AND third = 'reserved' THEN 'reserved' END AS label FROM p),
t(template, label, scale, need, size, word) AS (VALUES {_OP13_TEMPLATES}),
h AS (SELECT doc_id, template, label, need, size, word, unnest([pos // scale - 1, pos // scale]) AS block FROM w JOIN t USING (word)),
m AS (SELECT doc_id, label, count(DISTINCT word) / size AS containment FROM h WHERE block >= 0 GROUP BY doc_id, template, label, need, size, block HAVING count(DISTINCT word) >= need),
ls AS (SELECT doc_id, string_agg(DISTINCT label, ',' ORDER BY label) AS labels FROM (SELECT doc_id, label FROM b WHERE label IS NOT NULL UNION SELECT doc_id, label FROM m) GROUP BY doc_id),
bs AS (SELECT doc_id, count(*) AS n, min(pos) AS lo, max(pos) AS hi, string_agg(DISTINCT label, ',' ORDER BY label) AS labels FROM b WHERE label IS NOT NULL GROUP BY doc_id),
ms AS (SELECT doc_id, max(containment) AS best FROM m GROUP BY doc_id)
SELECT doc_id, len(ws) AS n_words, coalesce(bs.n, 0) AS n_base, lo AS first_word, hi AS last_word, coalesce(bs.labels, '') AS base_labels, coalesce(ls.labels, '') AS labels,
  greatest(coalesce(best, 0.0), CASE WHEN bs.n > 0 THEN 1.0 ELSE 0.0 END)::DOUBLE AS score
FROM d LEFT JOIN bs USING (doc_id) LEFT JOIN ls USING (doc_id) LEFT JOIN ms USING (doc_id)
"""


@register("op13_license_scan", _OP13_SQL)
def op13_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found, name = license_scan.scan(read(spark, sf_dir, "documents").select("doc_id", "text"))
    places, matches = F.col(name)["places"], F.col(name)["matches"]
    sorted_labels = lambda c: F.array_join(F.array_sort(F.array_distinct(c)), ",")
    best = F.coalesce(F.array_max(matches["containment"]), F.lit(0.0))
    return found.select(
        "doc_id",
        F.col(name)["n_words"].alias("n_words"),
        F.size(places).cast("long").alias("n_base"),
        F.array_min(places["start"]).alias("first_word"),
        F.array_max(places["start"]).alias("last_word"),
        sorted_labels(places["label"]).alias("base_labels"),
        sorted_labels(F.concat(places["label"], matches["label"])).alias("labels"),
        F.when(F.size(places) > 0, 1.0).otherwise(best).alias("score"),
    )


register("pipeline", corpus_pipeline.ORACLE_SQL)(corpus_pipeline.run)
