"""Nulls, empty and very long texts, ties, repeated rows, empty tables and clashing columns, for every operator and stage."""

import collections

import brute
import corpus_pipeline
import pytest
from odd_rows import LINE, LONG, ODD, benchmark, labels, none, odd  # noqa: F401
from pyspark.sql import functions as F

from strata.llm import chat, decontaminate, lattice_lm, line_dedup, near_dup, packing, pii, quality_rules, site_bayes, url_filter

COUNT = len(ODD)


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_line_dedup(odd, none):  # noqa: F811
    cut = line_dedup.dedup_lines(odd)
    assert cut.columns == [*odd.columns, "_n_lines", "n_dropped"]
    got = collections.defaultdict(list)
    for r in cut.collect():
        got[r["doc_id"]].append((r["text"], r["_n_lines"], r["n_dropped"]))
    assert sum(map(len, got.values())) == COUNT
    assert got[1] == [(None, 1, 0)] and got[2] == [("", 1, 0)]
    assert got[20] == [("own line 0", 3, 2)] and got[25] == [("own line 5", 3, 2)]
    assert got[30] == [("\n".join([LINE] * 50), 50, 0)]  # the largest id holds the line
    assert ("", 1, 1) in got[None] and (None, 1, 0) in got[None]
    assert len(got[5]) == 2 and {t for t, *_ in got[6]} == {"short text", "another text with the same id"}
    assert line_dedup.dedup_lines(none).count() == 0


def test_near_dup(odd, none):  # noqa: F811
    found = near_dup.find_components(odd, width=3, threshold=near_dup.Fraction(85, 100)).collect()
    assert len(found) == COUNT
    by = {(r["doc"], r["n"]): (r["component"], r["kept"]) for r in found}
    assert by[1, 0] == (1, True) and by[3, 0] == (3, True) and by[None, 0] == (None, True)
    assert by[7, 1] == (7, True) and by[8, 1] == (7, False) and by[9, 1] == (7, False)
    assert by[5, len(brute.shingles(LONG, 3))] == (5, True)
    kept = near_dup.keep_one(odd)
    assert kept.columns == odd.columns
    ids = collections.Counter(r["doc_id"] for r in kept.collect())
    assert ids[5] == 1 and ids[7] == 1 and ids[8] == 0 and ids[6] == 2 and ids[1] == ids[2] == 1
    assert near_dup.find_components(none).count() == 0 and near_dup.keep_one(none).count() == 0


def test_decontaminate(spark, odd, none, benchmark):  # noqa: F811
    got = rows_of(decontaminate.leaks(odd, benchmark).select("doc_id", "item_id", "distance"))
    assert (20, 1, 0) in got and (20, 2, 1) in got and (None, 1, 0) in got and not any(r[1] in (3, 4, None) for r in got)
    assert collections.Counter(r[0] for r in got)[30] == 2  # once per item, however often it occurs
    left = decontaminate.drop_leaks(odd, benchmark)
    assert left.columns == odd.columns and left.count() == COUNT - 8
    assert decontaminate.leaks(none, benchmark).count() == 0
    no_items = spark.createDataFrame([], benchmark.schema)
    assert decontaminate.leaks(odd, no_items).count() == 0 and decontaminate.drop_leaks(odd, no_items).count() == COUNT
    parts = decontaminate.add_matches(odd, benchmark, shard_chars=30)[0]
    assert rows_of(parts.select("doc_id", F.explode("_leaks").alias("x")).select("doc_id", "x.item_id", "x.distance")) == got


def test_packing(odd, none):  # noqa: F811
    pieces = packing.pack(odd).collect()
    encode = packing.Encoder(packing.vocabulary_path())
    sizes = collections.Counter()
    for p in pieces:
        sizes[p["doc_id"]] += p["length"]
    expected = collections.Counter()
    for i, t in ODD:
        expected[i] += len(encode(t or "")) // 4 + 1
    assert sizes == expected and sizes[1] == 1
    for p in pieces:
        if p["doc_id"] == 32:
            whole = encode.by_library(ODD[-1][1]) + b"\1\0\0\0"
            assert p["token_ids"] == whole[4 * p["start"] : 4 * (p["start"] + p["length"])]
    assert packing.pack(none).count() == 0


def test_pii(odd, none):  # noqa: F811
    found, name = pii.add_spans(odd)
    assert name == "_pii" and found.columns == [*odd.columns, name] and found.count() == COUNT
    assert all(not r[0]["base"] and not r[0]["added"] for r in found.select(name).collect())
    assert pii.add_spans(none)[0].count() == 0


def test_quality_rules(spark, odd, none, labels):  # noqa: F811
    rules = quality_rules.learn(odd, labels)
    assert rules == []
    judged, name = quality_rules.judge(odd, rules)
    assert name == "_quality" and judged.columns == [*odd.columns, name]
    got = {(r["doc_id"], r[name]["n_words"]): r[name]["kept"] for r in judged.collect()}
    assert got[1, 0] is False and got[5, 30_000] is True
    assert rows_of(quality_rules.keep_good(odd, labels).select("doc_id")) == [(5,), (5,)]  # LINE 50 times repeats all its words
    empty_labels = spark.createDataFrame([], labels.schema)
    assert quality_rules.learn(odd, empty_labels) == [] and quality_rules.learn(none, labels) == []
    assert quality_rules.keep_good(none, empty_labels).count() == 0


def test_lattice_lm(odd, none):  # noqa: F811
    got = lattice_lm.score(odd, rounds=1, hot_share=50).collect()
    assert len(got) == COUNT
    for r in got:
        assert r["score"] < 0 and r["n_tokens"] >= 1 and r["n_known"] <= r["n_tokens"]
    assert collections.Counter(r["n_tokens"] for r in got)[30_001] == 2
    assert lattice_lm.score(none, rounds=1).count() == 0


def test_lattice_lm_splits_words_between_broadcast_and_join_alike(odd):  # noqa: F811
    runs = [rows_of(lattice_lm.score(odd, rounds=1, hot_share=h).select("doc", "n_tokens", "n_known", F.round("base_score", 6), F.round("score", 6))) for h in (3, 100_000)]
    assert runs[0] == runs[1]


def test_site_bayes(spark, odd, none, labels):  # noqa: F811
    got = site_bayes.classify(odd, labels).collect()
    assert len(got) == COUNT and {r["host"] for r in got} == {"", "src0"}
    assert all(0 < r[f"{t}_posterior"] < 1 for r in got for t in site_bayes.TARGETS)
    empty_labels = spark.createDataFrame([], labels.schema)
    assert {round(r["quality_posterior"], 6) for r in site_bayes.classify(odd, empty_labels).collect()} == {0.5}
    assert site_bayes.classify(none, labels).count() == 0


def test_chat(spark):
    rows = [
        (1, 0, "user", None), (1, 1, "assistant", "\\</s> <\\| <|end|>\n[/INST] <|turn|>"), (1, 1, "assistant", "other branch"), (1, 2, None, "reply"), (1, 2, None, "reply"),
        (None, None, "user", "x"), (None, 5, "assistant", ""), (2, 7, "a\nb<|turn|>", "<<SYS>> é\U0001f600"),
    ]
    table = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumns({"tree": F.lit("t"), "n_turns": F.lit(9)})
    done = chat.format_paths(chat.conversation_paths(table))
    got = sorted((tuple(r) for r in done.select(chat.conv_id(F.col("tree")), "n_turns", chat.read_turns(F.col("formatted")), "formatted", "loss_spans").collect()), key=repr)
    turns = {r[0]: [] for r in got}
    for conv, n, read, text, spans in got:
        turns[conv].append([tuple(t) for t in read])
        assert n == len(read)
        masked = [text[s["start"] : s["end"]] for s in spans]
        assert [spark.range(1).select(chat.unescape(F.lit(m))).first()[0] for m in masked] == [t for r, t in read if r == "assistant"]
    assert turns[2] == [[("a\nb<|turn|>", "<<SYS>> é\U0001f600")]] and turns[None] == [[("user", "x"), ("assistant", "")]]
    # Equal turns go by role and text; repeated rows stay.
    assert turns[1] == [[("user", ""), ("assistant", rows[1][3]), ("assistant", "other branch"), ("", "reply"), ("", "reply")]]
    assert chat.format_paths(chat.conversation_paths(table.limit(0))).count() == 0


def test_url_filter(spark):
    events = [("block", "host", "a.b.c", "2024-01-05", True), ("block", "host", "a.b.c", "2024-01-09", False), ("block", "host", "a.b.c", "2024-01-09", False),
              ("block", "domain", "b.c", "2024-01-20", True), ("allow", "path", "a.b.c/x", "2024-01-01", True), ("block", "host", "tie.c", "2024-01-03", False),
              ("block", "host", "tie.c", "2024-01-03", True), ("block", "host", None, "2024-01-03", True), ("block", "host", "n.c", None, True)]
    events = spark.createDataFrame(events, "action string, kind string, value string, on string, added boolean").withColumn("on", F.col("on").cast("date"))
    asked = [("http://u:p@A.b.c:80/q?x=/x#y", "2024-01-05", 1), ("http://a.b.c/q", "2024-01-09", 0), ("http://a.b.c/x/y", "2024-01-06", 0), ("http://a.b.c/xy", "2024-01-06", 1),
             ("http://z.a.b.c/", "2024-02-01", 1), ("http://b.c", "2024-01-20", 1), ("http://eb.c", "2024-01-20", 0), ("http://tie.c", "2024-01-03", 1), (None, "2024-01-06", 0),
             ("no url", "2024-01-06", 0), ("http://a.b.c/q", None, 0), ("http://a.b.c/xy", "2024-01-06", 1), ("http://", "2024-01-06", 0), ("", "2024-01-06", 0)]
    captures = spark.createDataFrame(asked, "url string, fetched_on string, filter int").withColumn("fetched_on", F.col("fetched_on").cast("date"))
    judged, name = url_filter.judge(captures, url_filter.intervals(events))
    assert name == "_filter" and judged.columns == [*captures.columns, name]
    got = judged.collect()
    assert len(got) == len(asked) and all(r[name]["blocked"] == bool(r["filter"]) for r in got), got
    nothing, name = url_filter.judge(captures, url_filter.intervals(events.limit(0)))
    assert not any(r[name]["blocked"] for r in nothing.collect())
    assert url_filter.judge(captures.limit(0), url_filter.intervals(events))[0].count() == 0


@pytest.mark.parametrize("name, stage", corpus_pipeline.STAGES)
def test_stages(spark, odd, none, labels, benchmark, tmp_path, name, stage):  # noqa: F811
    labels.write.parquet(f"{tmp_path}/labels.parquet")
    benchmark.write.parquet(f"{tmp_path}/benchmark.parquet")
    for docs in (odd, none):
        out = stage(spark, docs, str(tmp_path))
        n = out.count()
        if name != "packing":
            assert out.columns == docs.columns and n <= docs.count()
        assert n or docs is none
