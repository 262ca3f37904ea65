"""Quality rules: a decision list learned from labelled statistics.

Method: sequential covering. Each rule is a conjunction of thresholds on document statistics. It is grown
on two thirds of the labelled rows by FOIL gain, pruned on the other third, kept if it is precise enough
there, and the rows it covers are taken out before the next rule is grown. The result is an ordered list that is
applied as one Spark ``CASE`` expression, so a reader can see why a document went.

The labelled rows for training are a sample of at most about ``MAX_TRAINING_ROWS`` rows, picked by a hash of the
id and joined as a broadcast of that bound. The statistics of all documents are computed over whole texts.

Defined results: a null or empty text has zero words and fails the base rules. Labels that are null or
neither 0 nor 1 are not used; of a repeated label row one counts, and a document with both labels is not used.
No labels, or none of one kind: the list is empty and the base rules alone decide. Repeated documents are
judged one by one and alike. Extra columns are carried along; the statistics are one struct column with a free name.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.llm.common import SPACES, add_struct, bounded_sample, free_name

MIN_WORDS = 50
MAX_REPEATED_PERCENT = 50
MAX_TRAINING_ROWS = 20_000
MAX_RULES = 12
MAX_CONDITIONS = 4
#: Least share of rejected rows among the pruning rows that a rule covers.
MIN_PRECISION = 0.9
#: Least number of low-quality growing rows that a rule covers.
MIN_COVER = 5

STATS = T.StructType(
    [T.StructField(n, T.LongType()) for n in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_distinct_words", "n_lines")]
)
_SPACE_BYTES = SPACES.encode()
_SYMBOLS = b"#*$%&|<>"


def repeated_words(ids: np.ndarray) -> int:
    """Words in 3-word windows that occur at least twice; ``ids`` numbers the words of one text."""
    if len(ids) < 4:
        return 0
    a, b, c = ids[:-2], ids[1:-1], ids[2:]
    top = int(ids.max()) + 1
    if top < 1 << 21:
        keys = (a * top + b) * top + c
    else:  # number the pairs first
        _, pairs = np.unique(a * top + b, return_inverse=True)
        keys = pairs.astype(np.int64) * top + c
    order = np.argsort(keys, kind="stable")
    same = keys[order][1:] == keys[order][:-1]
    again = np.zeros(len(keys), dtype=bool)
    again[order[1:][same]] = True
    again[order[:-1][same]] = True
    at = np.flatnonzero(again)
    inside = np.zeros(len(ids), dtype=bool)
    for k in range(3):
        inside[at + k] = True
    return int(inside.sum())


def text_statistics(text: str | None) -> dict:
    text = text or ""
    raw = text.encode("utf-8", "surrogatepass")
    words = raw.split()
    number: dict[bytes, int] = {}
    ids = np.fromiter((number.setdefault(w, len(number)) for w in words), dtype=np.int64, count=len(words))
    seen, dup = set(), 0
    lines = text.split("\n")
    for line in lines:
        if line in seen:
            dup += bool(line.strip(SPACES))
        else:
            seen.add(line)
    spaces = len(raw) - len(raw.translate(None, _SPACE_BYTES))
    return {
        "n_words": len(words),
        "word_chars": len(text) - spaces,
        "n_symbols": len(raw) - len(raw.translate(None, _SYMBOLS)),
        "n_dup_lines": dup,
        "n_repeat_words": repeated_words(ids),
        "n_distinct_words": len(number),
        "n_lines": len(lines),
    }


def add_statistics(docs: DataFrame, name: str, text_col: str = "text") -> DataFrame:
    return add_struct(docs, text_col, name, STATS, lambda: text_statistics)


def base_failed(stats: str, min_words: int = MIN_WORDS, max_repeated: int = MAX_REPEATED_PERCENT) -> Column:
    s = F.col(stats)
    return (s["n_words"] < min_words) | (100 * s["n_repeat_words"] > max_repeated * s["n_words"])


def features(stats: str) -> dict[str, Column]:
    """Ratios that the rules test; 0 where a text has no words."""
    s = F.col(stats)
    per = lambda n, d: F.coalesce(F.try_divide(s[n], s[d]), F.lit(0.0))
    return {
        "symbols_per_word": per("n_symbols", "n_words"),
        "chars_per_word": per("word_chars", "n_words"),
        "dup_line_share": per("n_dup_lines", "n_lines"),
        "repeated_share": per("n_repeat_words", "n_words"),
        "distinct_share": per("n_distinct_words", "n_words"),
        "words_per_line": per("n_words", "n_lines"),
    }


@dataclass(frozen=True)
class Condition:
    feature: str
    above: bool
    threshold: float

    def holds(self, x: dict[str, np.ndarray]) -> np.ndarray:
        v = x[self.feature]
        return v > self.threshold if self.above else v <= self.threshold


Rule = tuple[Condition, ...]


def covers(rule: Rule, x: dict[str, np.ndarray], n: int) -> np.ndarray:
    held = np.ones(n, dtype=bool)
    for c in rule:
        held &= c.holds(x)
    return held


def _best_condition(x: dict[str, np.ndarray], bad: np.ndarray) -> tuple[float, Condition | None]:
    """The condition with the largest FOIL gain over the rows of ``x``."""
    p0, n0 = int(bad.sum()), int((~bad).sum())
    best, found = 1e-9, None
    now = np.log2(p0 / (p0 + n0))
    for name in sorted(x):
        order = np.argsort(x[name], kind="stable")
        v, y = x[name][order], bad[order]
        ends = np.flatnonzero(v[1:] > v[:-1])  # the last row of each value but the largest
        if not len(ends):
            continue
        low_p = np.cumsum(y)[ends]
        low_n = ends + 1 - low_p
        for above, p, n in ((False, low_p, low_n), (True, p0 - low_p, n0 - low_n)):
            with np.errstate(divide="ignore", invalid="ignore"):
                gain = np.where(p > 0, p * (np.log2(p / np.maximum(p + n, 1)) - now), -1.0)
            k = int(np.argmax(gain))
            if gain[k] > best:
                best, found = float(gain[k]), Condition(name, above, float((v[ends[k]] + v[ends[k] + 1]) / 2))
    return best, found


def _grow(x: dict[str, np.ndarray], bad: np.ndarray, max_conditions: int) -> Rule:
    rule: Rule = ()
    while len(rule) < max_conditions and bad.any() and not bad.all():
        _, c = _best_condition(x, bad)
        if c is None:
            break
        rule += (c,)
        held = c.holds(x)
        x, bad = {k: v[held] for k, v in x.items()}, bad[held]
    return rule


def _prune(rule: Rule, x: dict[str, np.ndarray], bad: np.ndarray) -> Rule:
    """The prefix of the rule with the best (p - n) / (p + n); the shorter one of equals."""
    best, kept = -2.0, rule
    for k in range(1, len(rule) + 1):
        held = covers(rule[:k], x, len(bad))
        p, n = int((held & bad).sum()), int((held & ~bad).sum())
        if p + n and (p - n) / (p + n) > best:
            best, kept = (p - n) / (p + n), rule[:k]
    return kept


def learn_rules(x: dict[str, np.ndarray], bad: np.ndarray, max_rules: int = MAX_RULES, max_conditions: int = MAX_CONDITIONS, min_precision: float = MIN_PRECISION, min_cover: int = MIN_COVER) -> list[Rule]:
    """Ordered rules that reject; every third row prunes, the others grow."""
    pruning = np.arange(len(bad)) % 3 == 2
    rules: list[Rule] = []
    left = np.ones(len(bad), dtype=bool)
    while len(rules) < max_rules:
        grow, check = left & ~pruning, left & pruning
        if (bad & grow).sum() < min_cover or not (~bad & grow).any():
            break
        rule = _grow({k: v[grow] for k, v in x.items()}, bad[grow], max_conditions)
        rule = _prune(rule, {k: v[check] for k, v in x.items()}, bad[check])
        held = covers(rule, x, len(bad)) & left
        precise = lambda rows: (bad & rows).sum() >= min_precision * max(rows.sum(), 1)
        if not rule or (held & bad & grow).sum() < min_cover or not precise(held & grow) or not precise(held & check):
            break
        rules.append(rule)
        left &= ~held
    return rules


def training_rows(docs: DataFrame, labels: DataFrame, max_rows: int = MAX_TRAINING_ROWS, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality") -> tuple[dict[str, np.ndarray], np.ndarray]:
    """Features and labels of the sample, of rows that pass the base rules; at most about ``max_rows`` rows reach the driver."""
    y = labels.select(F.col(id_col).alias("id"), F.col(label_col).alias("y")).where(F.col("y").isin(0, 1) & F.col("id").isNotNull())
    y = y.groupBy("id").agg(F.min("y").alias("y"), F.max("y").alias("z")).where("y = z").select("id", "y")
    y = bounded_sample(y, "id", max_rows)
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).join(F.broadcast(y), "id")
    rows = add_statistics(texts, "stats").where(~base_failed("stats"))
    got = rows.select("id", "y", *[c.alias(n) for n, c in features("stats").items()]).dropDuplicates(["id"]).toPandas().sort_values("id", kind="stable")
    order = np.random.default_rng(0).permutation(len(got))
    return {n: got[n].to_numpy(dtype=float)[order] for n in features("stats")}, got["y"].to_numpy()[order] == 0


def learn(docs: DataFrame, labels: DataFrame, max_rows: int = MAX_TRAINING_ROWS, **columns) -> list[Rule]:
    x, bad = training_rows(docs, labels, max_rows, **columns)
    return learn_rules(x, bad)


def verdict(rules: list[Rule], stats: str) -> Column:
    """The number of the first rule that rejects, from 1; 0 if none does. One ordered conditional expression."""
    of = features(stats)
    out = None
    for k, rule in enumerate(rules, 1):
        held = F.lit(True)
        for c in rule:
            held = held & (of[c.feature] > c.threshold if c.above else of[c.feature] <= c.threshold)
        out = F.when(held, k) if out is None else out.when(held, k)
    return F.lit(0) if out is None else out.otherwise(0)


def as_text(rules: list[Rule]) -> list[str]:
    return [" and ".join(f"{c.feature} {'>' if c.above else '<='} {c.threshold:.6g}" for c in r) for r in rules]


def judge(docs: DataFrame, rules: list[Rule], text_col: str = "text") -> tuple[DataFrame, str]:
    """``docs`` and a struct column: the statistics, base_failed, rule (0: none) and kept. Also its name."""
    name = free_name(docs, "quality")
    judged = add_statistics(docs, name, text_col)
    failed, rule = base_failed(name), verdict(rules, name)
    return judged.withColumn(name, F.struct(f"{name}.*", failed.alias("base_failed"), rule.cast("int").alias("rule"), (~failed & (rule == 0)).alias("kept"))), name


def keep_good(docs: DataFrame, labels: DataFrame, max_rows: int = MAX_TRAINING_ROWS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents that neither the base rules nor the learned list rejects, with their columns."""
    judged, name = judge(docs, learn(docs, labels, max_rows, id_col=id_col, text_col=text_col), text_col)
    return judged.where(F.col(name)["kept"]).select(*[F.col(c) for c in docs.columns])
