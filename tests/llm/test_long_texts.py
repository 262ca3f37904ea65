"""Very long texts: linear time, no cuts, and the same spans as the plain patterns."""

import random
import time

import pytest
from pyspark.sql import functions as F

from strata.llm import lattice_lm, pii, url_filter


def seconds(f, *args):
    best = 9e9
    for _ in range(2):
        t = time.perf_counter()
        f(*args)
        best = min(best, time.perf_counter() - t)
    return best


LONG = [
    lambda n: "7" * n, lambda n: "a" * n + "@", lambda n: "a" * (n // 2) + " at " + "b" * (n // 2) + " dot !", lambda n: "1." * (n // 2), lambda n: " " * n + "[at] dot", lambda n: "a@" * (n // 2) + "dot",
    lambda n: "x at y dot " * (n // 11), lambda n: "(" + " " * n + "at dot", lambda n: "x" + " " * n + "at" + " " * n, lambda n: "a@b" + ".b" * (n // 2), lambda n: "one dot " * (n // 8),
]


@pytest.mark.parametrize("make", LONG)
def test_pii_time_is_linear(make):
    small, large = seconds(pii.find, make(10_000)), seconds(pii.find, make(100_000))
    assert large < 40 * small + 0.3, (small, large)


@pytest.mark.parametrize("make", LONG[:4])
def test_pii_takes_a_megabyte(make):
    assert seconds(pii.find, make(1_000_000)) < 20


def test_base_spans_equal_the_patterns_on_random_texts():
    draw = random.Random(8)
    for alphabet in ("a1.@-", "1.2 -", "ab@.+ ", "12345.", "@.a", "0.0@a1-"):
        for _ in range(1500):
            text = "".join(draw.choices(alphabet, k=draw.randint(0, 30)))
            expected = [("email", *m.span()) for m in pii.EMAIL.finditer(text)] + [("ip", *m.span()) for m in pii.IP.finditer(text) if pii._is_ip(m[0])]
            assert [s for s in pii.identifiers(text) if s[0] in ("email", "ip")] == sorted(expected, key=lambda s: (s[1], pii.KINDS.index(s[0]))), text


@pytest.mark.parametrize(
    "text, kind, part",
    [
        ("write name at host dot international now", "email", "name at host dot international"), ("x john     [at]     host.com y", "email", "john     [at]     host.com"),
        ("ann      at      mail      dot      example      dot      org", "email", "ann      at      mail      dot      example      dot      org"), ("at at at dot com", "email", "at at at dot com"),
        ("bob @ site dot co.uk dot net", "email", "bob @ site dot co.uk dot net"), ("ip one nine two     dot     one six eight dot one dot one", "ip", "one nine two     dot     one six eight dot one dot one"),
    ],
)
def test_any_run_of_blanks_may_surround_a_disguise(text, kind, part):
    found = [(s["kind"], text[s["start"] : s["end"]]) for s in pii.find(text)["added"]]
    assert (kind, part) in found, found


def test_a_long_training_word_counts_whole():
    """The expected counts of a word do not depend on its length class: no cut, and the same numbers by either way."""
    logs = {bytes([b]): -6.0 for b in range(256)} | {b" a": -2.0, b"ab": -1.5, b"abc": -2.5, b"bca": -3.0, b"ca": -2.2}
    lattice, draw = lattice_lm.Lattice(logs), random.Random(2)
    for n in (1, 7, 600, 5000):
        word = b" " + bytes(draw.choices(b"abc", k=n))
        short, long = {}, {}
        before, lattice_lm.LONG_BYTES = lattice_lm.LONG_BYTES, 10**9
        try:
            lattice.expect(word, 3.0, short)
        finally:
            lattice_lm.LONG_BYTES = before
        lattice.expect_long(word, 3.0, long)
        assert short.keys() == long.keys() and all(abs(short[k] - long[k]) < 1e-6 * (1 + short[k]) for k in short)
        # Each byte of the word lies in just one piece of every segmentation.
        assert sum(len(k) * v for k, v in long.items()) == pytest.approx(3.0 * len(word), rel=1e-6)


def test_urls_of_very_many_segments(spark):
    events = [("block", "path", "h.c/a/a", "2024-01-01", True), ("allow", "path", "h.c/" + "a/" * 2999 + "a", "2024-01-01", True), ("block", "domain", "c", "2024-01-01", True)]
    events = spark.createDataFrame(events, "action string, kind string, value string, on string, added boolean").withColumn("on", F.col("on").cast("date"))
    urls = ["http://h.c/" + "a/" * 100_000, "http://h.c/a", "http://x.c/" + "b/" * 100_000, "http://h.c/a/b/" + "c" * 10**6, "http://" + "s." * 50_000 + "c/"]
    captures = spark.createDataFrame([(u, "2024-02-01") for u in urls], "url string, fetched_on string").withColumn("fetched_on", F.col("fetched_on").cast("date"))
    judged, name = url_filter.judge(captures, url_filter.intervals(events))
    got = {r["url"]: (r[name]["n_entries"], r[name]["blocked"]) for r in judged.collect()}
    assert [got[u] for u in urls] == [(3, False), (1, True), (1, True), (1, True), (1, True)]


def test_shrinking_without_spread_gives_the_prior(spark):
    import math

    from strata.llm import site_bayes

    groups = spark.createDataFrame([(2.0, 4), (1.0, 2), (4.0, 8)], "total double, n long")
    assert math.isinf(site_bayes.strength(groups, "total", "n", F.lit(0.5)))
    spread = spark.createDataFrame([(100.0, 100), (0.0, 100), (50.0, 100)], "total double, n long")
    k = site_bayes.strength(spread, "total", "n", F.lit(0.5))
    assert 1.0 <= k < 3
    row = spread.select(site_bayes.shrunk(F.col("total"), F.col("n"), F.lit(0.5), math.inf).alias("a"), site_bayes.shrunk(F.col("total"), F.col("n"), F.lit(0.5), k).alias("b")).first()
    assert row["a"] == 0.5 and row["b"] == pytest.approx((100 + k / 2) / (100 + k))
