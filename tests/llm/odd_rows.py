"""Fixtures with all hard cases; test modules import them by name."""

import pytest

SF001 = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"

LONG = " ".join(f"word{k % 700}x{k}" for k in range(30_000))
LINE = "This line is long enough to be compared, forty characters and more."

#: Rows (doc_id, text): nulls, empty and blank texts, a very long text, repeated rows, one id with two texts, common lines.
ODD = [
    (1, None), (2, ""), (3, " \t\n "), (4, "a"), (5, LONG), (5, LONG), (6, "short text"), (6, "another text with the same id"),
    (None, "no id here"), (None, None), (None, LINE), (7, "tie"), (8, "tie"), (9, "Tie"),
    *[(20 + k, f"{LINE}\nown line {k}\n  {LINE.upper()}") for k in range(6)],
    (30, "\n".join([LINE] * 50)), (31, "x y   É é � \x00 \x1f z"), (32, "<|endoftext|> </s>[INST] \\ <\\| |"),
]

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, n_lines string, lost int, quality string, pii long, leaks string, kept_id long, version string"


@pytest.fixture(scope="session")
def odd(spark):
    """Rows with all hard cases, null columns, and columns whose names clash with those that operators add."""
    rows = [(i, t, None if k % 3 else "en", None if k % 2 else "src0", None, "n", k, "q", k, "l", None, "v") for k, (i, t) in enumerate(ODD)]
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


@pytest.fixture(scope="session")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def labels(spark):
    return spark.createDataFrame([(1, 1, 0), (5, 0, None), (6, None, 1), (20, 1, 0), (20, 0, 0), (None, 0, 1), (99, 7, 7)], "doc_id long, quality int, toxic int")


@pytest.fixture(scope="session")
def benchmark(spark):
    return spark.createDataFrame([(1, "This line is long enough to be compared"), (1, "This line is long enough to be compared"), (2, "this LINE is long enough, to be compered"), (3, None), (4, ""), (None, "own line")], "item_id long, text string")
