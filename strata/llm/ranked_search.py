"""Ranked lexical search: a K2-treap over the grid of terms and documents, descended jointly by an item's terms.

Method. The documents are dealt into shards. The grid of a shard has a row per term, a column per document and the
impact of the term in the document as the value of a point. A K2-treap holds the grid as a quadtree of which only cells with a point exist:
four bits per cell say which quarters do, and each cell stores the largest impact inside it, as the difference to the cell above.
A query follows the rows of its terms through the quadtree together: a step halves a range of documents, and the weighted sum of the
terms' cell maxima bounds the score of every document in it. Ranges are taken best first, several at a time, until the
lowest of the k best documents beats every bound that is left, so the ranking is exact. Columns are in order of document id, so that
among equal scores the smaller id comes first.

Impacts. A document of ``n`` terms with repeats (N documents with a term, L terms in all) has m = 75 + (25 n N) div L, a term that occurs tf
times in it the impact (10^9 tf) div (1000 tf + 12 m). A term's weight, floor(1000 ln((2N + 2) / (2 df + 1))), depends on the whole corpus and is applied
at query time, so one index serves any query. All of it is 64-bit integer arithmetic.

Scale. ``build`` reads the texts twice (N and L first) and shuffles nothing; a shard holds at most ``SHARD_POINTS`` points (or
one document) and is one row of the index, a table of compressed cells. Document frequencies are summed over the shards for the
terms of the items only. Items go through the index in blocks of at most ``ITEM_CHARS`` characters, which bounds what a broadcast holds; the rows of each
block are written before the next. A task keeps the k best of each item over all its shards, whose lowest score prunes the next shard, and the k best of all
tasks are ranked at the end. No text, posting list or score of other documents is shuffled.

Terms are the maximal runs of ASCII letters, digits and characters beyond ASCII, with only A-Z lower-cased.

Defined results: a null or empty text has no term and is never found; an item without a known term has no result. Rows are
documents each, also with one id; among equal scores a null id comes last. Items with the same id and text are one item; a null item id is an id. Very long texts are one
document like others. Empty tables: empty result. Other columns are not carried, so their names cannot clash.
"""

from __future__ import annotations

import heapq
import math
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from strata.llm.common import plain_words, shared_table, slices

TOP = 20
SHARD_POINTS = 1 << 20
SHARD_DOCUMENTS = 1 << 13
ITEM_CHARS = 1_000_000
#: Ranges that a step of the descent opens at a time.
WIDTH = 128
_ONES = np.array([bin(k).count("1") for k in range(16)], dtype=np.int64)


def totals(docs: DataFrame, text_col: str = "text") -> tuple[int, int]:
    """The number of documents with a term, and of all terms with repeats."""

    def run(batches):
        for part in slices(batches):
            found = [n for text in part.column(0).to_pylist() if (n := len(plain_words(text)))]
            yield pa.RecordBatch.from_arrays([pa.array([len(found)], pa.int64()), pa.array([sum(found)], pa.int64())], names=["documents", "terms"])

    counted = docs.select(text_col).mapInArrow(run, "documents long, terms long")
    return tuple(counted.agg(*[F.coalesce(F.sum(c), F.lit(0)) for c in counted.columns]).first())


def impacts(tf: np.ndarray, n: np.ndarray, documents: int, total: int) -> np.ndarray:
    return (1_000_000_000 * tf) // (1000 * tf + 12 * (75 + (25 * n * documents) // total))


def weight(documents: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * documents + 2) / (2 * df + 1)))


def _interleave(x: np.ndarray) -> np.ndarray:
    """The bits of x at the even places."""
    x = x.astype(np.uint64)
    for shift, mask in ((16, 0x0000FFFF0000FFFF), (8, 0x00FF00FF00FF00FF), (4, 0x0F0F0F0F0F0F0F0F), (2, 0x3333333333333333), (1, 0x5555555555555555)):
        x = (x | (x << np.uint64(shift))) & np.uint64(mask)
    return x


def _narrow(x: np.ndarray) -> np.ndarray:
    top = int(x.max(initial=0))
    return x.astype(np.uint8 if top < 1 << 8 else np.uint16 if top < 1 << 16 else np.uint32)


class Treap:
    """Cells by level from the whole grid (level 0) to single points (level ``depth``), in Z-order.

    ``kids[l]`` has four bits per cell of level l, ``tops[l]`` the largest impact in each cell.
    """

    def __init__(self, depth: int, kids: list[np.ndarray], tops: list[np.ndarray]):
        self.depth, self.kids, self.tops = depth, kids, tops
        # The first child of each cell in the next level.
        self.first = [np.cumsum(_ONES[k]) - _ONES[k] for k in kids]

    @classmethod
    def of(cls, rows: np.ndarray, columns: np.ndarray, values: np.ndarray) -> Treap:
        side = int(max(rows.max(initial=0), columns.max(initial=0))) + 1
        depth = max(1, (side - 1).bit_length())
        codes = _interleave(rows) << np.uint64(1) | _interleave(columns)
        order = np.argsort(codes, kind="stable")
        codes, tops, kids = codes[order], [values[order].astype(np.int64)], []
        for _ in range(depth):
            above = codes >> np.uint64(2)
            starts = np.flatnonzero(np.concatenate(([True], above[1:] != above[:-1])))
            quarter = np.left_shift(1, (codes & np.uint64(3)).astype(np.int64))
            kids.insert(0, np.bitwise_or.reduceat(quarter, starts).astype(np.uint8))
            tops.insert(0, np.maximum.reduceat(tops[0], starts))
            codes = above[starts]
        return cls(depth, kids, tops)

    def packed(self) -> bytes:
        """Depth, the largest impact, and per level the bits and the differences to the cell above."""
        parts = [np.array([self.depth, self.tops[0][0]], dtype=np.int64)]
        for level in range(self.depth):
            drop = _narrow(np.repeat(self.tops[level], _ONES[self.kids[level]]) - self.tops[level + 1])
            parts += [np.array([len(self.kids[level]), len(drop), drop.itemsize], dtype=np.int64), self.kids[level], drop]
        return zlib.compress(b"".join(p.tobytes() for p in parts), 1)

    @classmethod
    def unpacked(cls, data: bytes) -> Treap:
        data, at = zlib.decompress(data), 16
        depth, top = np.frombuffer(data, np.int64, 2)
        kids, tops = [], [np.array([top], dtype=np.int64)]
        for _ in range(depth):
            cells, below, size = np.frombuffer(data, np.int64, 3, at)
            bits = np.frombuffer(data, np.uint8, cells, at + 24)
            drop = np.frombuffer(data, f"u{size}", below, at + 24 + cells).astype(np.int64)
            kids.append(bits)
            tops.append(np.repeat(tops[-1], _ONES[bits]) - drop)
            at += 24 + int(cells) + int(below) * int(size)
        return cls(int(depth), kids, tops)

    def search(self, rows: np.ndarray, weights: np.ndarray, columns: int, best: list[tuple[int, int]], k: int, width: int = WIDTH) -> list[tuple[int, int]]:
        """(score, column) of the documents that may belong to the ``k`` best, given ``best`` scores known elsewhere.

        ``best`` holds the k highest scores so far as a heap of (score, order); a document that only ties
        with the lowest of them is reported too, since ids decide.
        """
        found: list[tuple[int, int]] = []
        floor = best[0][0] if len(best) >= k else 1
        # Ranges to open by level: first column, bound, and the cell of each term (-1: no point of the term there).
        heap: list[tuple[int, int, int, np.ndarray]] = [(-int((weights * self.tops[0][0]).sum()), 0, 0, np.zeros(len(rows), dtype=np.int64))]
        scores: list[int] = [s for s, _ in best]
        heapq.heapify(scores)
        while heap and -heap[0][0] >= floor:
            opened: dict[int, list] = {}
            for _ in range(min(width, len(heap))):
                bound, level, at, cells = heapq.heappop(heap)
                if -bound < floor:
                    break
                opened.setdefault(level, []).append((at, cells))
            for level, ranges in opened.items():
                at = np.array([a for a, _ in ranges], dtype=np.int64)
                cells = np.stack([c for _, c in ranges])
                bit = (rows >> (self.depth - level - 1)) & 1
                here = np.where(cells >= 0, self.kids[level][cells], 0)
                start = np.where(cells >= 0, self.first[level][cells], 0)
                for half in (0, 1):
                    quarter = 2 * bit + half
                    there = (here >> quarter) & 1
                    child = np.where(there == 1, start + _ONES[here & ((1 << quarter) - 1)], -1)
                    top = np.where(there == 1, self.tops[level + 1][child], 0) @ weights
                    begin = at + (half << (self.depth - level - 1))
                    for j in np.flatnonzero((top >= floor) & (begin < columns)):
                        if level + 1 < self.depth:
                            heapq.heappush(heap, (-int(top[j]), level + 1, int(begin[j]), child[j]))
                        else:
                            found.append((int(top[j]), int(begin[j])))
                            heapq.heappush(scores, int(top[j]))
                            if len(scores) > k:
                                heapq.heappop(scores)
            floor = max(floor, scores[0]) if len(scores) >= k else floor
        return [x for x in found if x[0] >= floor]


class Shard:
    """Documents gathered until the grid is full."""

    def __init__(self, documents: int, total: int):
        self.documents, self.total = documents, total
        self.rows: dict[bytes, int] = {}
        self.at: list[np.ndarray] = []
        self.tf: list[np.ndarray] = []
        self.ids: list[int | None] = []
        self.lengths: list[int] = []
        self.points = 0

    def add(self, doc_id: int | None, words: list[bytes]) -> None:
        counted, rows = Counter(words), self.rows
        self.at.append(np.fromiter((rows.setdefault(t, len(rows)) for t in counted), dtype=np.int64, count=len(counted)))
        self.tf.append(np.fromiter(counted.values(), dtype=np.int64, count=len(counted)))
        self.ids.append(doc_id)
        self.lengths.append(len(words))
        self.points += len(counted)

    def full(self) -> bool:
        return self.points >= SHARD_POINTS or len(self.ids) >= SHARD_DOCUMENTS

    def packed(self) -> dict:
        """Rows are numbered by falling document frequency, so that frequent terms share the upper cells; columns by id."""
        order = sorted(range(len(self.ids)), key=lambda k: (self.ids[k] is None, self.ids[k] or 0))
        column = np.empty(len(order), dtype=np.int64)
        column[order] = np.arange(len(order))
        sizes = [len(a) for a in self.at]
        found, tf = np.concatenate(self.at), np.concatenate(self.tf)
        df = np.bincount(found, minlength=len(self.rows))
        names = list(self.rows)
        by_df = np.argsort(-df, kind="stable")
        rank = np.empty(len(names), dtype=np.int64)
        rank[by_df] = np.arange(len(names))
        values = impacts(tf, np.repeat(np.array(self.lengths, dtype=np.int64), sizes), self.documents, self.total)
        grid = Treap.of(rank[found], np.repeat(column, sizes), values)
        return {
            "ids": [self.ids[k] for k in order],
            "names": zlib.compress(b" ".join(names[k] for k in by_df), 1),
            "df": zlib.compress(df[by_df].astype(np.int64).tobytes(), 1),
            "cells": grid.packed(),
        }


INDEX = "ids array<long>, names binary, df binary, cells binary"


def build(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> tuple[DataFrame, int, int]:
    """The index, one row per shard, and N and L. A document without terms is in no shard: it can have no score."""
    own = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    documents, total = totals(own)

    def run(batches):
        kind = pa.schema([("ids", pa.list_(pa.int64())), ("names", pa.binary()), ("df", pa.binary()), ("cells", pa.binary())])
        shard = Shard(documents, total)
        for part in slices(batches):
            for doc_id, text in zip(part.column("id").to_pylist(), part.column("text").to_pylist(), strict=True):
                if words := plain_words(text):
                    shard.add(doc_id, words)
                    if shard.full():
                        yield pa.RecordBatch.from_pylist([shard.packed()], schema=kind)
                        shard = Shard(documents, total)
        if shard.ids:
            yield pa.RecordBatch.from_pylist([shard.packed()], schema=kind)

    return shared_table(own.mapInArrow(run, INDEX), "search-index"), documents, total


def _names(data: bytes) -> list[bytes]:
    return zlib.decompress(data).split(b" ")


def frequencies(index: DataFrame, asked: set[bytes]) -> dict[bytes, int]:
    """Document frequencies of the asked terms over all shards; ``asked`` is bounded by a block of items."""
    known = index.sparkSession.sparkContext.broadcast(asked)

    def run(batches):
        total: Counter = Counter()
        for batch in batches:
            for names, df in zip(batch.column("names"), batch.column("df"), strict=True):
                counts = np.frombuffer(zlib.decompress(df.as_py()), np.int64)
                for name, n in zip(_names(names.as_py()), counts.tolist(), strict=True):
                    if name in known.value:
                        total[name] += n
        yield pa.RecordBatch.from_arrays([pa.array(list(total), pa.binary()), pa.array(list(total.values()), pa.int64())], names=["term", "df"])

    counted = index.select("names", "df").mapInArrow(run, "term binary, df long").groupBy("term").agg(F.sum("df").alias("df"))
    return {bytes(t): n for t, n in counted.collect()}  # at most one row per term of the block


def _best(index: DataFrame, queries: list[tuple[int, list[bytes], list[int]]], top: int) -> DataFrame:
    """(item, doc, score): per task the ``top`` best documents of each item, ties with the last included by id."""
    asked = index.sparkSession.sparkContext.broadcast(queries)

    def run(batches):
        # Per item the best so far as (score, order, id): the order of an id falls, so that the heap's least is the worst.
        best: list[list] = [[] for _ in asked.value]
        for batch in batches:
            for k in range(batch.num_rows):
                row = batch.slice(k, 1)
                rank = {name: r for r, name in enumerate(_names(row.column("names")[0].as_py()))}
                grid, ids = Treap.unpacked(row.column("cells")[0].as_py()), row.column("ids")[0].as_py()
                for heap, (_, words, weights) in zip(best, asked.value, strict=True):
                    own = [(rank[t], w) for t, w in zip(words, weights, strict=True) if t in rank]
                    if not own:
                        continue
                    rows, factor = (np.array(x, dtype=np.int64) for x in zip(*own, strict=True))
                    for score, column in grid.search(rows, factor, len(ids), [(s, 0) for s, *_ in heap], top):
                        one = (score, (ids[column] is not None, -(ids[column] or 0)), ids[column])
                        if len(heap) < top:
                            heapq.heappush(heap, one)
                        elif one[:2] > heap[0][:2]:
                            heapq.heapreplace(heap, one)
        found = [(item, doc, score) for (item, *_), heap in zip(asked.value, best, strict=True) for score, _, doc in heap]
        items, docs, scores = zip(*found, strict=True) if found else ((), (), ())
        yield pa.RecordBatch.from_arrays([pa.array(items, pa.int64()), pa.array(docs, pa.int64()), pa.array(scores, pa.int64())], names=["item", "doc", "score"])

    return index.select("ids", "names", "cells").mapInArrow(run, "item long, doc long, score long")


def search(index: DataFrame, documents: int, items: DataFrame, top: int = TOP, item_col: str = "item_id", item_text: str = "text", item_chars: int = ITEM_CHARS) -> DataFrame:
    """(item_id, rank, doc_id, score): the ``top`` documents of each item with a score above 0."""
    spark = index.sparkSession
    asked = shared_table(items.select(F.col(item_col).cast("long").alias("id"), F.col(item_text).alias("text")).distinct().withColumn("item", F.monotonically_increasing_id()), "search-items")
    parts, block, held = [], [], 0

    def flush() -> None:
        df = frequencies(index, {t for _, words in block for t in words})
        queries = []
        for item, words in block:
            weights = {t: c * weight(documents, df[t]) for t, c in words.items() if t in df}
            weights = {t: w for t, w in weights.items() if w}
            if weights:
                queries.append((item, list(weights), list(weights.values())))
        if queries:
            parts.append(shared_table(_best(index, queries, top), "search-found"))

    for row in asked.toLocalIterator():
        block.append((row["item"], Counter(plain_words(row["text"]))))
        held += len(row["text"] or "")
        if held >= item_chars:
            flush()
            block, held = [], 0
    if block:
        flush()
    found = parts[0] if parts else spark.createDataFrame([], "item long, doc long, score long")
    for part in parts[1:]:
        found = found.union(part)
    # Spark keeps the first ``top`` of each item before the shuffle as well.
    place = F.row_number().over(Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc")))
    ranked = found.withColumn("rank", place).where(F.col("rank") <= top)
    return ranked.join(asked.select("item", "id"), "item").select(F.col("id").alias("item_id"), "rank", F.col("doc").alias("doc_id"), "score")
