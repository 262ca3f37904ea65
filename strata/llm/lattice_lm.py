"""LM scoring: marginal probability of a text over all segmentations into subwords.

Method: the pieces of an existing vocabulary, each word marked at its start, form a lattice over the word's bytes.
A text is a sequence of words and one end; its probability is the product over words of the sum over all
segmentations of the product of piece probabilities, found by a forward recursion in log space, so the model needs no
single best segmentation. The vocabulary stays as it is; its scores give the prior weights (the weight of a piece falls with the rank
of its score), and expected piece counts over all training words (expectation-maximisation) update them, round after round, until the log likelihood of
the training words gains less than ``TOLERANCE`` of itself.
Each of the 256 bytes is a piece, so every text has a positive probability.

Scale: words are counted in each task before they are shuffled. Expected counts and lattice scores are computed once per
distinct word, not per occurrence. The words that make up at least 1 / HOT_SHARE of all tokens, thus at most
HOT_SHARE words, are broadcast and scored inside the pass over the texts; only the others, none of them frequent,
are shuffled to be joined with their counts. At most one row per vocabulary piece and per hot word reaches the driver.

Beside the model's score there is the add-1/2 unigram score of the words, ``base``.

Defined results: a null or empty text has the end token only. A null id counts as the empty text for the fold. Rows are
scored one by one; repeated rows count repeatedly. No training rows: counts are zero and the prior weights are used.
Words of any length count whole, in time and memory linear in their length.
"""

from __future__ import annotations

import math
from array import array
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.llm.common import shared_table, slices

VOCABULARY = "piece_bpe_32k.model"
#: Rounds go on until one gains less than this share of the log likelihood, and end at ROUNDS in any case.
TOLERANCE = 0.005
ROUNDS = 20
HOT_SHARE = 1_000_000
#: Words that a task counts before it passes the counts on.
COUNTED_WORDS = 200_000
#: From so many bytes on, a word's lattice is walked twice instead of being held.
LONG_BYTES = 4096
#: Pseudo-tokens that the vocabulary's scores are worth.
PRIOR_TOKENS = 10_000.0
#: The word that stands for the end of a text; no real word is empty.
END = b""
#: Fixed value: the start of a word, as in the vocabulary (there a special character).
MARK = b" "
#: Words read at a time, and how many of one length are worth taking together; (place, place, word) cells held at a time.
COUNTED_TOGETHER = 16_384
TOGETHER = 32
CELLS = 1 << 20


def vocabulary_path(name: str = VOCABULARY) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def prior_weights(path: str) -> dict[bytes, float]:
    """Piece bytes -> weight, summing to 1; a blank marks the start of a word. Zipf's law over the ranks of the scores."""
    from sentencepiece import SentencePieceProcessor

    model = SentencePieceProcessor(model_file=path)
    scored = []
    for i in range(model.get_piece_size()):
        if not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i) or model.is_unused(i)):
            scored.append((-model.get_score(i), i, model.id_to_piece(i).replace("▁", " ").encode()))
    out: dict[bytes, float] = {}
    for rank, (_, _, piece) in enumerate(sorted(scored), 1):
        if b" " not in piece[1:]:
            out[piece] = out.get(piece, 0.0) + 1 / (rank + 2.7)
    for b in range(256):
        out.setdefault(bytes([b]), 1 / (len(scored) + 2.7))
    total = sum(out.values())
    return {k: v / total for k, v in out.items()}


class Lattice:
    """``logs``: piece -> natural log of its probability, with all single bytes.

    Words of one length go through the recursions together, as columns of arrays (place, place, word); the pieces at a
    place are found by walking a trie. Few words of a length, or very long ones, are taken one by one.
    """

    def __init__(self, logs: dict[bytes, float]):
        self.get, self.longest = logs.get, max(map(len, logs))
        self.pieces = sorted(logs)
        # Trie: node 0 is dead, node 1 the root.
        nodes: dict[bytes, int] = {b"": 1}
        for piece in self.pieces:
            for k in range(1, len(piece) + 1):
                nodes.setdefault(piece[:k], len(nodes) + 1)
        self.next = np.zeros((len(nodes) + 1, 256), dtype=np.int32)
        for prefix, node in nodes.items():
            if prefix:
                self.next[nodes[prefix[:-1]], prefix[-1]] = node
        self.nodes = np.array([nodes[p] for p in self.pieces])
        self.logp = np.full(len(nodes) + 1, -np.inf)
        self.logp[self.nodes] = [logs[p] for p in self.pieces]

    def log_probability(self, word: bytes) -> float:
        """Of one marked word, over all its segmentations."""
        text, get, longest, exp, log = word, self.get, self.longest, math.exp, math.log
        alpha = [0.0]
        for end in range(1, len(text) + 1):
            start = end - longest if end > longest else 0
            paths = [a + p for a, p in zip(alpha[start:], [get(text[k:end]) for k in range(start, end)]) if p is not None]
            top = max(paths)
            alpha.append(top + log(sum([exp(x - top) for x in paths])) if len(paths) > 1 else top)
        return alpha[-1]

    def expect(self, text: bytes, times: float, into: dict[bytes, float]) -> float:
        """Add the expected piece counts of one marked word, seen so many times; returns its log likelihood."""
        get, longest, exp, log = self.get, self.longest, math.exp, math.log
        n = len(text)
        if n >= LONG_BYTES:
            return self.expect_long(text, times, into)
        alpha, edges = [0.0], [[]]
        for end in range(1, n + 1):
            found = []
            for start in range(end - longest if end > longest else 0, end):
                piece = text[start:end]
                p = get(piece)
                if p is not None:
                    found.append((start, piece, alpha[start] + p))
            edges.append(found)
            top = max(f[2] for f in found)
            alpha.append(top + log(sum([exp(f[2] - top) for f in found])))
        # Share of the probability that passes through each place, from the end to the start.
        share = [0.0] * n + [times]
        for end in range(n, 0, -1):
            if here := share[end]:
                for start, piece, path in edges[end]:
                    part = here * exp(path - alpha[end])
                    share[start] += part
                    into[piece] = into.get(piece, 0.0) + part
        return times * alpha[n]

    def expect_long(self, text: bytes, times: float, into: dict[bytes, float]) -> float:
        """As ``expect``, with one number held per place of the word."""
        get, longest, exp, log = self.get, self.longest, math.exp, math.log

        def ending(end: int) -> list[tuple[int, bytes, float]]:
            pieces = [(start, text[start:end]) for start in range(max(0, end - longest), end)]
            return [(start, piece, alpha[start] + p) for start, piece in pieces if (p := get(piece)) is not None]

        alpha = array("d", [0.0])
        for end in range(1, len(text) + 1):
            found = ending(end)
            top = max(f[2] for f in found)
            alpha.append(top + log(sum([exp(f[2] - top) for f in found])))
        share = array("d", bytes(8 * len(text))) + array("d", [times])
        for end in range(len(text), 0, -1):
            if here := share[end]:
                for start, piece, path in ending(end):
                    part = here * exp(path - alpha[end])
                    share[start] += part
                    into[piece] = into.get(piece, 0.0) + part
        return times * alpha[len(text)]

    @staticmethod
    def by_length(words: list[bytes]) -> Iterator[tuple[int, np.ndarray]]:
        """(length, places of the words of that length), in parts that fit ``CELLS``."""
        lengths = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
        order = np.argsort(lengths, kind="stable")
        for part in np.split(order, np.flatnonzero(np.diff(lengths[order])) + 1):
            if len(part):
                n = int(lengths[part[0]])
                step = max(CELLS // (n * n), 1)
                for at in range(0, len(part), step):
                    yield n, part[at : at + step]

    def walk(self, words: list[bytes], n: int) -> np.ndarray:
        """Trie node of the stretch [start, end) of each word, 0 if no piece begins so: (start, end - 1, word)."""
        text = np.frombuffer(b"".join(words), dtype=np.uint8).reshape(len(words), n).T
        out = np.zeros((n, n, len(words)), dtype=np.int32)
        for start in range(n):
            node = np.ones(len(words), dtype=np.int32)
            for end in range(start, min(n, start + self.longest)):
                node = self.next[node, text[end]]
                if not node.any():
                    break
                out[start, end] = node
        return out

    def forward(self, logp: np.ndarray) -> np.ndarray:
        """Log probability of reaching each place (place, word), over all segmentations of what is before it."""
        n = len(logp)
        alpha = np.zeros((n + 1, logp.shape[2]))
        for end in range(1, n + 1):
            alpha[end] = log_sum(alpha[:end] + logp[:end, end - 1])
        return alpha

    def log_probabilities(self, words: list[bytes]) -> np.ndarray:
        out = np.empty(len(words))
        for n, places in self.by_length(words):
            own = [words[k] for k in places]
            if len(own) < TOGETHER:
                out[places] = [self.log_probability(w) for w in own]
            else:
                out[places] = self.forward(self.logp[self.walk(own, n)])[-1]
        return out

    def expectations(self, words: list[bytes], times: np.ndarray, into: np.ndarray, alone: dict[bytes, float]) -> float:
        """Add the expected piece counts: of words taken together by trie node, of the others by piece; returns the log likelihood."""
        likelihood = 0.0
        for n, places in self.by_length(words):
            own = [words[k] for k in places]
            if len(own) < TOGETHER:
                likelihood += sum(self.expect(w, float(t), alone) for w, t in zip(own, times[places]))
                continue
            nodes = self.walk(own, n)
            logp = self.logp[nodes]
            alpha = self.forward(logp)
            beta = np.zeros((n + 1, len(own)))
            for start in range(n - 1, -1, -1):
                beta[start] = log_sum(beta[start + 1 :] + logp[start, start:])
            share = np.exp(alpha[:-1, None] + logp + beta[None, 1:] - alpha[-1]) * times[places]
            into += np.bincount(nodes.ravel(), weights=share.ravel(), minlength=len(into))
            likelihood += float(alpha[-1] @ times[places])
        return likelihood


def log_sum(x: np.ndarray) -> np.ndarray:
    """log of the sum of exp over the first axis; every column has a finite value."""
    top = x.max(axis=0)
    return top + np.log(np.exp(x - top).sum(axis=0))


def held_out(id_col: Column) -> Column:
    return F.pmod(F.crc32(F.coalesce(id_col.cast("string"), F.lit("")).cast("binary")), F.lit(5)) == 1


def words_of(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "surrogatepass").lower().split()


def marked(words: pa.Array) -> list[bytes]:
    return [MARK + w for w in words.to_pylist()]


def count_words(docs: DataFrame) -> DataFrame:
    """(word, trained, seen): occurrences in training texts and in all; the end token is the empty word."""

    def run(batches: Iterator[pa.RecordBatch]):
        counts: list[Counter] = [Counter(), Counter()]

        def out():
            words = list(counts[0].keys() | counts[1].keys())
            trained = [counts[0][w] for w in words]
            seen = [t + counts[1][w] for t, w in zip(trained, words)]
            for c in counts:
                c.clear()
            for at in range(0, len(words), 50_000):
                to = at + 50_000
                yield pa.RecordBatch.from_arrays([pa.array(words[at:to], pa.binary()), pa.array(trained[at:to], pa.int64()), pa.array(seen[at:to], pa.int64())], names=["word", "trained", "seen"])

        for part in slices(batches):
            for held, text in zip(part.column(0).to_pylist(), part.column(1).to_pylist()):
                own = counts[bool(held)]
                own.update(words_of(text))
                own[END] += 1
                if len(own) > COUNTED_WORDS:
                    yield from out()
        yield from out()

    counts = docs.select("held", "text").mapInArrow(run, "word binary, trained long, seen long")
    return counts.groupBy("word").agg(F.sum("trained").alias("trained"), F.sum("seen").alias("seen"))


def fit(counts: DataFrame, ends: int, path: str | None = None, rounds: int = ROUNDS, tolerance: float = TOLERANCE) -> tuple[dict[bytes, float], float]:
    """Natural logs of the piece probabilities and of the end's, after at most ``rounds`` rounds over all training words."""
    prior = prior_weights(path or vocabulary_path())
    sc, weights, end = counts.sparkSession.sparkContext, prior, 1 / PRIOR_TOKENS
    trained, likelihood = counts.where(F.col("trained") > 0).where(F.col("word") != F.lit(END)).select("word", "trained"), None
    for _ in range(rounds):
        logs = sc.broadcast({k: math.log(v) for k, v in weights.items()})

        def run(batches: Iterator[pa.RecordBatch], logs=logs):
            lattice = Lattice(logs.value)
            found, sums, own = {}, np.zeros(len(lattice.next)), 0.0
            for part in slices(batches, COUNTED_TOGETHER):
                own += lattice.expectations(marked(part.column(0)), part.column(1).to_numpy().astype(float), sums, found)
            for piece, n in zip(lattice.pieces, sums[lattice.nodes].tolist()):
                if n:
                    found[piece] = found.get(piece, 0.0) + n
            # The row without a piece holds the log likelihood.
            yield pa.RecordBatch.from_arrays([pa.array([None, *found], pa.binary()), pa.array([own, *found.values()], pa.float64())], names=["piece", "n"])

        # One row a piece and one more: no more than the vocabulary has.
        rows = trained.mapInArrow(run, "piece binary, n double").groupBy("piece").agg(F.sum("n").alias("n")).collect()
        expected = {bytes(r["piece"]): r["n"] for r in rows if r["piece"] is not None}
        before, likelihood = likelihood, sum(r["n"] for r in rows if r["piece"] is None)
        total = sum(expected.values()) + ends + PRIOR_TOKENS
        end = (ends + 1) / (total + 1)
        weights = {k: (1 - end) * (expected.get(k, 0.0) + PRIOR_TOKENS * p) / (total - ends) for k, p in prior.items()}
        if before is not None and likelihood - before < tolerance * -before or not likelihood:
            break
    return {k: math.log(v) for k, v in weights.items()}, math.log(end)


def score_words(counts: DataFrame, logs: dict[bytes, float], log_end: float) -> DataFrame:
    """``counts`` and ``logp``, the natural log of each word's probability."""
    own = counts.sparkSession.sparkContext.broadcast(logs)

    def run(batches: Iterator[pa.RecordBatch]):
        lattice = Lattice(own.value)
        for part in slices(batches, COUNTED_TOGETHER):
            words = marked(part.column(0))
            logp = np.where([w == MARK for w in words], log_end, lattice.log_probabilities(words))
            yield pa.RecordBatch.from_arrays([*part.columns, pa.array(logp, pa.float64())], names=["word", "trained", "seen", "logp"])

    return counts.select("word", "trained", "seen").mapInArrow(run, "word binary, trained long, seen long, logp double")


def score(docs: DataFrame, path: str | None = None, rounds: int = ROUNDS, hot_share: int = HOT_SHARE, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc, held_out, n_tokens, n_known, train_tokens, base_score, score) per row; scores are log10 probabilities."""
    rows = docs.select(F.col(id_col).cast("long").alias("doc"), held_out(F.col(id_col)).alias("held"), F.col(text_col).alias("text"))
    counts = shared_table(count_words(rows), "word-counts")
    totals = counts.agg(
        F.sum("trained").alias("n"), F.count_if(F.col("trained") > 0).alias("v"), F.sum("seen").alias("seen"), F.max(F.when(F.col("word") == F.lit(END), F.col("trained"))).alias("ends")
    ).first()
    n, v, seen, ends = (totals[k] or 0 for k in ("n", "v", "seen", "ends"))
    smooth = n + 0.5 * (v + 1)
    words = shared_table(score_words(counts, *fit(counts, ends, path, rounds)), "word-scores")
    frequent = words.where(F.col("seen") * hot_share >= seen).select("word", "trained", "logp")
    hot = rows.sparkSession.sparkContext.broadcast(
        {bytes(r["word"]): (bool(r["trained"]), math.log10((r["trained"] + 0.5) / smooth), r["logp"] / math.log(10)) for r in frequent.toLocalIterator()}
    )

    def run(batches: Iterator[pa.RecordBatch]):
        from pyspark import TaskContext

        context = TaskContext.get()
        row = (context.partitionId() if context else 0) << 33
        table = hot.value
        place = {w: k for k, w in enumerate(table)}.get
        numbers = np.array(list(table.values()), dtype=float).reshape(-1, 3)
        for part in slices(batches, 128):
            rows, sums, rare, tokens = [], [], [], []
            for text in part.column(2).to_pylist():
                found = Counter(words_of(text))
                found[END] += 1
                words, times = list(found), np.fromiter(found.values(), dtype=np.int64, count=len(found))
                at = np.fromiter((place(w, -1) for w in words), dtype=np.int64, count=len(words))
                common = at >= 0
                sums.append(times[common] @ numbers[at[common]])
                left = np.flatnonzero(~common)
                rare.append([{"word": words[k], "times": n} for k, n in zip(left, times[left].tolist())])
                tokens.append(int(times.sum()))
                rows.append(row)
                row += 1
            sums = np.array(sums).reshape(-1, 3)
            kind = pa.list_(pa.struct([("word", pa.binary()), ("times", pa.int64())]))
            columns = [pa.array(rows, pa.int64()), *part.columns[:2], pa.array(tokens, pa.int64()), pa.array(sums[:, 0].astype(np.int64)), pa.array(sums[:, 1]), pa.array(sums[:, 2]), pa.array(rare, kind)]
            yield pa.RecordBatch.from_arrays(columns, names=["row", "doc", "held", "n_tokens", "n_known", "base", "score", "rare"])

    schema = "row long, doc long, held boolean, n_tokens long, n_known long, base double, score double, rare array<struct<word: binary, times: long>>"
    parts = shared_table(rows.mapInArrow(run, schema), "text-parts")
    rest = parts.select("row", F.inline("rare")).join(words.select("word", "trained", "logp"), "word")
    rest = rest.groupBy("row").agg(
        F.sum(F.when(F.col("trained") > 0, F.col("times")).otherwise(0)).alias("n_known"),
        F.sum(F.col("times") * F.log10((F.col("trained") + 0.5) / F.lit(smooth))).alias("base"),
        F.sum(F.col("times") * F.col("logp") / math.log(10)).alias("score"),
    )
    heads = parts.drop("rare")
    both = heads.unionByName(rest, allowMissingColumns=True).groupBy("row").agg(
        F.max("doc").alias("doc"), F.max("held").alias("held_out"), F.max("n_tokens").alias("n_tokens"), *[F.sum(c).alias(c) for c in ("n_known", "base", "score")]
    )
    return both.select("doc", "held_out", "n_tokens", "n_known", F.lit(n).cast("long").alias("train_tokens"), F.col("base").alias("base_score"), "score")
