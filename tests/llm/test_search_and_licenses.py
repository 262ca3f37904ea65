"""Ranked search and license scans against plain versions, and their hard cases."""

import collections
import math
import random
import re

import numpy as np
import pytest
from odd_rows import LINE, ODD, none, odd  # noqa: F401
from pyspark.sql import functions as F

from strata.llm import license_scan, ranked_search
from strata.llm.common import plain_words

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def low(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")


def ranking(docs, items, top=20):
    """(item place, rank, doc id, score) by scoring every document."""
    found = [TERM.findall(low(t)) for _, t in docs]
    documents, total = sum(map(bool, found)), sum(map(len, found))
    counts = [collections.Counter(f) for f in found]
    df = collections.Counter(t for c in counts for t in c)
    out = []
    for place, (_, text) in enumerate(items):
        scored = []
        for (doc, _), c, f in zip(docs, counts, found, strict=True):
            m = 100 - 25 + (25 * len(f) * documents) // total if total else 0
            score = sum(
                math.floor(1000 * math.log((2 * documents + 2) / (2 * df[t] + 1))) * ((1_000_000_000 * c[t]) // (1000 * c[t] + 12 * m)) for t in TERM.findall(low(text)) if c[t]
            )
            if score > 0:
                scored.append((-score, doc is None, doc or 0, doc))
        out += [(place, k, s[3], -s[0]) for k, s in enumerate(sorted(scored)[:top], 1)]
    return out


def test_words_are_the_contract_s():
    for text in ("A_b c9É 　x\x7f\x80y[z]`{~}", "", None, "ǅ İ ß", "a\ud800b"):
        assert [w.decode("utf-8", "surrogatepass") for w in plain_words(text)] == [w for w in TERM.findall(low(text))]


@pytest.mark.parametrize("seed", range(6))
def test_treap_keeps_every_point_and_finds_the_best(seed):
    draw = np.random.default_rng(seed)
    side = int(draw.integers(1, 60))
    cells = draw.choice(side * side, size=int(draw.integers(1, side * side + 1)), replace=False)
    rows, columns, values = cells // side, cells % side, draw.integers(1, 6 if seed % 2 else 10**6, size=len(cells))
    grid = ranked_search.Treap.unpacked(ranked_search.Treap.of(rows, columns, values).packed())
    dense = np.zeros((side, side), dtype=np.int64)
    dense[rows, columns] = values
    for _ in range(20):
        own = np.unique(draw.integers(0, side, size=5))
        own = own[dense[own].any(axis=1)]
        if not len(own):
            continue
        weights, k = draw.integers(1, 5, size=len(own)), int(draw.integers(1, 8))
        score = weights @ dense[own]
        expected = sorted(((int(s), c) for c, s in enumerate(score) if s), key=lambda x: (-x[0], x[1]))[:k]
        for width in (1, 4, 128):
            got = sorted(grid.search(own, weights, side, [], k, width), key=lambda x: (-x[0], x[1]))[:k]
            assert got == expected


def test_search_equals_scoring_every_document(spark):
    draw = random.Random(3)
    words = [f"w{k}" for k in range(60)] + ["É", "né", "Zz"]
    docs = [(draw.choice([k, k % 7, None]), " ".join(draw.choices(words, [1 / (1 + j) for j in range(len(words))], k=draw.randint(0, 40)))) for k in range(150)]
    docs += [(500 + k, docs[3][1]) for k in range(30)] + [(900, None), (901, "")]
    items = [(k, " ".join(draw.choices(words, k=draw.randint(0, 8)))) for k in range(20)] + [(None, "w1 w1 É"), (77, None), (78, "unknown")]
    docs_df = spark.createDataFrame(docs, "doc_id long, text string").withColumn("rank", F.lit(1)).repartition(3)
    items_df = spark.createDataFrame(items, "item_id long, text string")
    expected = sorted((repr(items[p][0]), r, s) for p, r, _, s in ranking(docs, items))
    index, documents, total = ranked_search.build(docs_df)
    assert documents == sum(1 for _, t in docs if t)
    for chars in (1, 10**6):
        got = ranked_search.search(index, documents, items_df, item_chars=chars).collect()
        assert sorted((repr(r["item_id"]), r["rank"], r["score"]) for r in got) == expected
    # Ids are told apart where they are distinct.
    own = [(i, t) for i, t in docs if i is not None and i >= 150]
    table = spark.createDataFrame(own, "doc_id long, text string").repartition(4)
    index, documents, _ = ranked_search.build(table)
    got = ranked_search.search(index, documents, spark.createDataFrame(items[:5], "item_id long, text string")).collect()
    assert sorted((r["item_id"], r["rank"], r["doc_id"], r["score"]) for r in got) == sorted((items[p][0], r, d, s) for p, r, d, s in ranking(own, items[:5]))


def test_shards_are_cut_and_read_back():
    shard = ranked_search.Shard(3, 30)
    for k in range(3):
        shard.add([5, None, 2][k], [b"a", b"a", f"b{k}".encode()])
    packed = shard.packed()
    assert packed["ids"] == [2, 5, None] and not shard.full()
    grid = ranked_search.Treap.unpacked(packed["cells"])
    names = ranked_search._names(packed["names"])
    assert names[0] == b"a" and len(grid.search(np.array([0]), np.array([1]), 3, [], 3)) == 3


def test_search_hard_rows(spark, odd, none):  # noqa: F811
    index, documents, _ = ranked_search.build(odd)
    items = spark.createDataFrame([(1, LINE), (1, LINE), (2, "tie"), (3, "É"), (None, "short")], "item_id long, text string")
    got = collections.defaultdict(list)
    for r in ranked_search.search(index, documents, items).orderBy("rank").collect():
        got[r["item_id"]].append(r["doc_id"])
    assert got[2] == [7, 8, 9] and got[None] == [6] and len(got[1]) == len(set(got[1])) and got[3] == [31]
    index, documents, _ = ranked_search.build(none)
    assert documents == 0 and ranked_search.search(index, documents, items).count() == 0
    index, documents, _ = ranked_search.build(odd)
    assert ranked_search.search(index, documents, items.limit(0)).count() == 0


def contained(text, templates, percent):
    """(label, start, containment) of all blocks of all templates, without any filter."""
    words, out = plain_words(text), set()
    for label, template in templates:
        own, s = set(plain_words(template)), license_scan.scale(len(plain_words(template)))
        for start in range(0, max(len(words), 1), s):
            both = len(own.intersection(words[start : start + 2 * s]))
            if own and 100 * both >= percent * len(own):
                out.add((label, start, both / len(own)))
    return out


def test_scan_equals_containment_of_all_blocks(spark):
    draw = random.Random(9)
    words = [f"t{k}" for k in range(25)]
    templates = [(f"l{k % 5}", " ".join(draw.choices(words, k=draw.randint(1, 30)))) for k in range(12)] + [("empty", " - ")]
    weights = [1 / (1 + k) for k in range(len(words))]
    texts = [" ".join(draw.choices([*words, "x", "y"], [*weights, 1, 1], k=draw.randint(0, 120))) for _ in range(60)] + [None, "", " ".join(t for _, t in templates)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    for percent in (60, 80, 100):
        found, name = license_scan.scan(docs, templates, percent, [])
        for r in found.collect():
            got = {(m["label"], m["start"], m["containment"]) for m in r[name]["matches"]}
            assert got == contained(texts[r["doc_id"]], templates, percent)


def test_scan_hard_rows(spark, odd, none):  # noqa: F811
    wide = odd.withColumns({"licenses": F.lit("x"), "blocks": F.lit(1), "matches": F.lit(2), "row": F.lit(3)})
    found, name = license_scan.scan(wide)
    assert name == "_licenses" and found.columns == [*[c for c in wide.columns if c != "text"], name]
    rows = found.collect()
    assert len(rows) == len(ODD) and all(not r[name]["matches"] and not r[name]["places"] for r in rows)
    assert {r[name]["n_words"] for r in rows if r["doc_id"] == 5} == {30_000}
    assert license_scan.scan(none)[0].count() == 0
    assert all(not r[name]["matches"] for r in license_scan.scan(wide, [])[0].collect())


def test_labels(spark):
    texts = {
        1: "x\nReleased under the MIT License.\ny", 2: "Licensed under the Apache License, Version 2.0.", 3: "Licensed under CC BY-NC 4.0.", 4: "All rights reserved. all rights, reserved!",
        5: "This work is licensed under the GNU General Public License, version 3.", 6: "released under the license", 7: "word " * 5000 + license_scan.TEMPLATES[2][1] + " word" * 5000,
    }
    found, name = license_scan.scan(spark.createDataFrame(list(texts.items()), "doc_id long, text string"))
    got = {r["doc_id"]: ({m["label"] for m in r[name]["matches"]}, [(p["label"], p["start"]) for p in r[name]["places"]]) for r in found.collect()}
    assert got[1] == ({"mit"}, []) and got[2] == ({"apache-2.0"}, []) and got[3] == ({"cc-by", "cc-by-nc"}, [("cc-by", 2)])
    assert got[4] == (set(), [("reserved", 0), ("reserved", 3)]) and got[5] == ({"gpl"}, [("gpl", 7)]) and got[6] == (set(), []) and got[7] == ({"mit"}, [])
