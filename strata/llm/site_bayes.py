"""Quality classifier: document evidence combined with host and path posteriors by hierarchical empirical Bayes.

Method: a document classifier (Bernoulli naive Bayes over hashed words and binned statistics, then a logistic
calibration on other labelled rows) gives every document a probability. Sums of these, with known labels in their place, are grouped by
host and by path. A host's rate is shrunk towards the global rate, a path's rate towards its host's, with the
strength that the spread between the groups implies (method of moments), so a sparse site stays near the
prior. A document's posterior odds are its own odds times the ratio of its path's odds (without the document itself) to the global odds.

Labelled rows for the classifier are a sample of about ``MAX_TRAINING_ROWS`` at most, broadcast by id; what reaches the driver are counts per
hash bucket, the calibration sample and one row of moments. All documents are scored whole, and all labels count in the groups.

Defined results: a null or empty text has the evidence of no words. A null host or path is the empty name. Labels other than 0 and 1
or contradictory are not used. Without labels of both kinds every posterior is the global rate, 1/2 without any label.
Repeated rows count repeatedly. Empty table: no rows. Columns of the documents other than id, host and path are not returned.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.llm.common import bounded_sample, shared_table, slices
from strata.llm.quality_rules import text_statistics

MAX_TRAINING_ROWS = 20_000
BUCKETS = 1 << 18
#: A bucket counts as evidence from so many documents and standard errors on.
MIN_DOCUMENTS = 5
MIN_Z = 4.0
#: Weaker evidence is left out: common words are many and depend on each other, so that their sum would drown the rest.
MIN_LOG_ODDS = 1.0
TARGETS = ("quality", "toxic")
#: Bytes of a word's beginning that count as evidence of their own, and levels of a ratio.
PREFIXES = (4, 6)
LEVELS = 10
_EDGES = b".,;:!?()[]{}\"'"


def buckets(text: str | None) -> np.ndarray:
    """Distinct hash buckets of the words, of their first letters, and of the levels that the statistics of a text reach."""
    words = {w.strip(_EDGES) for w in (text or "").encode("utf-8", "surrogatepass").lower().split()}
    found = words | {b"\1" + w[:n] for n in PREFIXES for w in words if len(w) > n}
    s = text_statistics(text)
    per = lambda a, b: int(LEVELS * s[a] / max(s[b], 1))
    for name, level in (("symbols", per("n_symbols", "n_words")), ("dup", per("n_dup_lines", "n_lines")), ("repeat", per("n_repeat_words", "n_words")), ("same", LEVELS - per("n_distinct_words", "n_words"))):
        found.update(f"\0{name}{k}".encode() for k in range(1, min(level, LEVELS) + 1))
    return np.unique(np.fromiter((zlib.crc32(w) % BUCKETS for w in found), dtype=np.int64, count=len(found)))


def clean_labels(labels: DataFrame, id_col: str) -> DataFrame:
    """(id, quality, toxic) with one row per id; a target is null where it is unknown or contradictory."""
    known = [F.when(F.col(t).isin(0, 1), F.col(t).cast("int")).alias(t) for t in TARGETS]
    rows = labels.select(F.col(id_col).cast("long").alias("id"), *known).where("id IS NOT NULL").groupBy("id")
    return rows.agg(*[F.when(F.min(t) == F.max(t), F.min(t)).alias(t) for t in TARGETS])


def evidence_weights(docs: DataFrame, sample: DataFrame) -> dict[str, np.ndarray]:
    """Log odds per bucket and target from the sample's rows of fold 0; zero where they are not significant."""

    def run(batches: Iterator[pa.RecordBatch]):
        # Per target and label: documents, and documents by bucket.
        seen = np.zeros((len(TARGETS), 2, BUCKETS + 1), dtype=np.int64)
        for part in slices(batches):
            for text, *known in zip(*[c.to_pylist() for c in part.columns]):
                own = np.append(buckets(text), BUCKETS)
                for t, y in enumerate(known):
                    if y is not None:
                        seen[t, y, own] += 1
        b = np.flatnonzero(seen.any(axis=(0, 1)))
        yield pa.RecordBatch.from_arrays([pa.array(b), *[pa.array(x[b]) for x in seen.reshape(-1, BUCKETS + 1)]], names=["b", *counts])

    counts = [f"n_{t}_{y}" for t in TARGETS for y in (0, 1)]
    texts = docs.join(F.broadcast(sample.where("fold = 0")), "id").select("text", *TARGETS)
    rows = texts.mapInArrow(run, "b long, " + ", ".join(f"{c} long" for c in counts))
    rows = rows.groupBy("b").agg(*[F.sum(c).alias(c) for c in counts]).toPandas()  # at most one row a bucket
    seen = np.zeros((len(TARGETS), 2, BUCKETS + 1))
    seen.reshape(-1, BUCKETS + 1)[:, rows["b"]] = rows[counts].to_numpy().T
    out = {}
    for t, target in enumerate(TARGETS):
        n0, n1 = seen[t, 0, BUCKETS], seen[t, 1, BUCKETS]
        k0, k1 = seen[t, :, :BUCKETS]
        p0, p1 = (k0 + 0.5) / (n0 + 1), (k1 + 0.5) / (n1 + 1)
        p = (k0 + k1 + 1) / (n0 + n1 + 2)
        z = (p1 - p0) / np.sqrt(p * (1 - p) * (1 / max(n0, 1) + 1 / max(n1, 1)))
        good = (np.abs(z) >= MIN_Z) & (k0 + k1 >= MIN_DOCUMENTS) & (min(n0, n1) > 0)
        weight = np.log(p1 / p0)
        out[target] = np.where(good & (np.abs(weight) >= MIN_LOG_ODDS), weight, 0.0)
    return out


def calibrate(score: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """(slope, intercept) of a logistic fit on asinh(score), which tames the sums of very long texts; a weak pull to (0, base rate), no negative slope."""
    rate = (y.sum() + 0.5) / (len(y) + 1)
    base = float(np.log(rate / (1 - rate)))
    x, a, b = np.arcsinh(score), 0.0, base
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(a * x + b, -30, 30)))
        w = p * (1 - p)
        gradient = np.array([(x * (y - p)).sum() - 0.1 * a, (y - p).sum() - 0.1 * (b - base)])
        hessian = np.array([[(w * x * x).sum() + 0.1, (w * x).sum()], [(w * x).sum(), w.sum() + 0.1]])
        step = np.clip(np.linalg.solve(hessian, gradient), -1, 1)
        a, b = a + step[0], b + step[1]
        if np.abs(step).max() < 1e-6:
            break
    return (float(a), float(b)) if a > 0 else (0.0, base)


def score_documents(docs: DataFrame, weights: dict[str, np.ndarray]) -> DataFrame:
    """(id, host, path) and the summed evidence per target."""
    table = docs.sparkSession.sparkContext.broadcast(np.stack([weights[t] for t in TARGETS]))

    def run(batches: Iterator[pa.RecordBatch]):
        for part in slices(batches):
            sums = [table.value[:, buckets(x)].sum(axis=1) for x in part.column(3).to_pylist()]
            made = [pa.array([s[t] for s in sums], pa.float64()) for t in range(len(TARGETS))]
            yield pa.RecordBatch.from_arrays([*part.columns[:3], *made], names=["id", "host", "path", *[f"{t}_evidence" for t in TARGETS]])

    return docs.select("id", "host", "path", "text").mapInArrow(run, "id long, host string, path string, " + ", ".join(f"{t}_evidence double" for t in TARGETS))


def logit(p: Column) -> Column:
    p = F.least(F.greatest(p, F.lit(1e-9)), F.lit(1 - 1e-9))
    return F.log(p / (1 - p))


def sigmoid(x: Column) -> Column:
    return 1 / (1 + F.exp(-x))


def strength(groups: DataFrame, total: str, n: str, towards: Column) -> float:
    """Pseudo-documents that the rate ``towards`` is worth for a group: the method of moments on the spread of group rates.

    Infinite where the groups spread no more than documents drawn at that rate would, or there are none: then the groups tell nothing and the rate itself
    stands (``shrunk``). At least one: a group's prior is worth a document.
    """
    p = F.least(F.greatest(towards, F.lit(1e-6)), F.lit(1 - 1e-6))
    own = F.col(total) / F.col(n)
    row = groups.agg(F.sum(n).alias("n"), F.sum(F.col(n) * F.pow(own - p, 2)).alias("spread"), F.sum(p * (1 - p)).alias("noise"), F.sum(F.col(n) * p * (1 - p)).alias("room")).first()
    if not row["n"] or row["spread"] <= row["noise"]:
        return math.inf
    return max(row["room"] / (row["spread"] - row["noise"]) - 1, 1.0)


def shrunk(total: Column, n: Column, towards: Column, strength: float) -> Column:
    """The rate total / n, shrunk ``towards`` a prior of the given strength."""
    return towards if math.isinf(strength) else (total + strength * towards) / (n + strength)


def classify(docs: DataFrame, labels: DataFrame, max_rows: int = MAX_TRAINING_ROWS, id_col: str = "doc_id", text_col: str = "text", host_col: str = "source", path_col: str = "lang") -> DataFrame:
    """(id, host, path) and per target its evidence's probability, the path's rate and the posterior."""
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.coalesce(host_col, F.lit("")).alias("host"), F.coalesce(path_col, F.lit("")).alias("path"), F.col(text_col).alias("text"))
    known = clean_labels(labels, id_col)
    sample = shared_table(bounded_sample(known, "id", max_rows).withColumn("fold", F.pmod(F.xxhash64(F.lit(5), "id"), F.lit(2))), "labelled-sample")
    scored = shared_table(score_documents(rows, evidence_weights(rows.select("id", "text"), sample)), "evidence")
    fitted = scored.join(F.broadcast(sample.where("fold = 1")), "id").select(*TARGETS, *[f"{t}_evidence" for t in TARGETS]).toPandas()
    for t in TARGETS:
        own = fitted[fitted[t].notna()]
        slope, intercept = calibrate(own[f"{t}_evidence"].to_numpy(dtype=float), own[t].to_numpy(dtype=float))
        scored = scored.withColumn(f"{t}_own", sigmoid(F.asinh(f"{t}_evidence") * slope + intercept))
    scored = scored.join(known.select("id", *[F.col(t).alias(f"{t}_known") for t in TARGETS]), "id", "left")
    counted = {t: F.coalesce(F.col(f"{t}_known").cast("double"), F.col(f"{t}_own")) for t in TARGETS}
    scored = shared_table(scored.withColumns({f"{t}_counted": c for t, c in counted.items()}).drop(*[f"{t}_known" for t in TARGETS], *[f"{t}_evidence" for t in TARGETS]), "site-evidence")
    paths = shared_table(scored.groupBy("host", "path").agg(F.count("*").alias("n"), *[F.sum(f"{t}_counted").alias(f"{t}_sum") for t in TARGETS]), "paths")
    hosts = paths.groupBy("host").agg(F.sum("n").alias("host_n"), *[F.sum(f"{t}_sum").alias(f"{t}_host_sum") for t in TARGETS])
    whole = hosts.agg(F.sum("host_n").alias("n"), *[F.sum(f"{t}_host_sum").alias(t) for t in TARGETS]).first()
    rate = {t: (whole[t] + 0.5) / (whole["n"] + 1) if whole["n"] else 0.5 for t in TARGETS}
    shrink = {t: strength(hosts, f"{t}_host_sum", "host_n", F.lit(rate[t])) for t in TARGETS}
    hosts = hosts.withColumns({f"{t}_host_rate": shrunk(F.col(f"{t}_host_sum"), F.col("host_n"), F.lit(rate[t]), shrink[t]) for t in TARGETS})
    paths = shared_table(paths.join(hosts.select("host", *[f"{t}_host_rate" for t in TARGETS]), "host"), "path-rates")
    inner = {t: strength(paths, f"{t}_sum", "n", F.col(f"{t}_host_rate")) for t in TARGETS}
    out = scored.join(paths, ["host", "path"])
    for t in TARGETS:
        # The document itself is taken out of its path's sum.
        others = shrunk(F.greatest(F.col(f"{t}_sum") - F.col(f"{t}_counted"), F.lit(0.0)), F.col("n") - 1, F.col(f"{t}_host_rate"), inner[t])
        out = out.withColumn(f"{t}_site", others).withColumn(f"{t}_posterior", sigmoid(logit(F.col(f"{t}_own")) + logit(others) - logit(F.lit(rate[t]))))
    return out.select("id", "host", "path", *[f"{t}_{k}" for t in TARGETS for k in ("own", "site", "posterior")])
