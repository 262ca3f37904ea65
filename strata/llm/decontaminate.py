"""Benchmark decontamination: approximate occurrences of test items in documents by pigeonhole edit matching.

Method: with a budget of k edits an item is cut into k + 1 pieces; an occurrence with at most k edits holds at least one
piece unchanged. One automaton finds all pieces in a document in one pass. Each hit tells where the item would lie;
these windows are joined where they overlap and verified with Myers' bit-parallel edit distance (the item against any part of the
window). Every occurrence within the budget is found, and nothing else is reported.

Texts are compared in lower case, with runs of characters other than letters and digits as one blank.

The items reach the tasks as a broadcast of about ``SHARD_CHARS`` characters. A larger benchmark is worked through in
as many shards as it needs, one after another: each passes over the documents in one Python step, writes what it found to shared storage and
gives its broadcast back, so memory does not grow with the benchmark. No text is shuffled, unless ``add_matches`` or ``drop_leaks`` has to bring the findings
of several shards together: then the rows meet them once, by a digest of the text. A task holds one document at a time.

Defined results: an item too short to have an edit budget (12 normalised characters or less at the usual rate) matches whole words only. an item or text that is null, empty or has no letter or digit matches nothing. Items with one id and text count
once; the same text under several ids is reported for each. Repeated documents are reported each. No items: no matches. Matches
come by item id; of equal distances the first end counts. An item without id cannot be named, so ``leaks`` does not list it; ``drop_leaks``
removes its documents as those of any other item.
"""

from __future__ import annotations

import re
from collections.abc import Callable
from functools import reduce

from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.llm.common import add_struct, free_name, shared_table

#: Edits allowed per character of an item.
ERROR_RATE = 0.08
#: Characters of items that are broadcast at a time.
SHARD_CHARS = 4_000_000

MATCHES = T.StructType(
    [T.StructField("items", T.ArrayType(T.StructType([T.StructField(n, T.LongType()) for n in ("item_id", "distance", "item_chars", "end")])))]
)
_GAP = re.compile(r"[\W_]+")


def normalise(text: str | None) -> str:
    return _GAP.sub(" ", (text or "").lower()).strip()


def pieces(item: str, edits: int) -> list[tuple[int, str]]:
    """``edits`` + 1 consecutive pieces of about equal length, with their offsets."""
    bounds = [k * len(item) // (edits + 1) for k in range(edits + 2)]
    return [(a, item[a:b]) for a, b in zip(bounds, bounds[1:]) if b > a]


def masks(item: str) -> dict[str, int]:
    out: dict[str, int] = {}
    for k, c in enumerate(item):
        out[c] = out.get(c, 0) | 1 << k
    return out


def best_match(of: dict[str, int], m: int, text: str, limit: int) -> tuple[int, int] | None:
    """(least distance, its first end) of the item against any part of ``text``; None beyond ``limit``. Myers' algorithm."""
    full, last = (1 << m) - 1, 1 << (m - 1)
    up, down, score, best, end = full, 0, m, min(m, limit + 1), 0
    for at, c in enumerate(text, 1):
        eq = of.get(c, 0)
        vertical = eq | down
        across = (((eq & up) + up) ^ up) | eq
        more, less = down | (full & ~(across | up)), up & across
        if more & last:
            score += 1
        elif less & last:
            score -= 1
        more, less = (more << 1) & full, (less << 1) & full
        up, down = less | (full & ~(vertical | more)), more & vertical
        if score < best:
            best, end = score, at
    return (best, end) if best <= limit else None


def _by_id(item_id: int | None) -> tuple[bool, int]:
    return item_id is not None, item_id or 0


class Matcher:
    """All items of a shard; ``matches(text)`` lists (item_id, distance, item_chars, end in the normalised text)."""

    def __init__(self, items: list[tuple[int, str]], error_rate: float):
        import ahocorasick

        self.items: list[tuple[list[int | None], str, int]] = []
        ids: dict[str, set] = {}
        for item_id, text in items:
            ids.setdefault(normalise(text), set()).add(item_id)
        self.find = ahocorasick.Automaton()
        places: dict[str, list] = {}
        for text in sorted(t for t in ids if t):
            edits = int(len(text) * error_rate)
            for offset, piece in pieces(text, edits):
                places.setdefault(piece, []).append((len(self.items), offset))
            self.items.append((sorted(ids[text], key=_by_id), text, edits))
        for piece, at in places.items():
            self.find.add_word(piece, (len(piece), at))
        self.find.make_automaton()
        self.masks: dict[int, dict[str, int]] = {}

    def windows(self, text: str) -> dict[int, list[list[int]]]:
        """Per item the parts of the text in which it may lie, in order and apart from each other."""
        starts: dict[int, set] = {}
        for end, (length, at) in self.find.iter(text):
            for item, offset in at:
                starts.setdefault(item, set()).add(end + 1 - length - offset)
        out: dict[int, list[list[int]]] = {}
        for item, found in starts.items():
            _, pattern, edits = self.items[item]
            if not edits:
                out[item] = [[s, s + len(pattern)] for s in sorted(found) if f" {text} "[s : s + len(pattern) + 2 : len(pattern) + 1] == "  "]
                continue
            joined: list[list[int]] = []
            for s in sorted(found):
                a, b = max(0, s - edits), min(len(text), s + len(pattern) + edits)
                if joined and a <= joined[-1][1]:
                    joined[-1][1] = max(joined[-1][1], b)
                else:
                    joined.append([a, b])
            out[item] = joined
        return out

    def matches(self, text: str | None) -> dict:
        found = []
        if self.items:
            text = normalise(text)
            for item, parts in self.windows(text).items():
                ids, pattern, edits = self.items[item]
                of = self.masks.get(item) or self.masks.setdefault(item, masks(pattern))
                best = None
                for a, b in parts:
                    if b - a < len(pattern) - edits:
                        continue
                    got = best_match(of, len(pattern), text[a:b], edits if best is None else best[0] - 1)
                    if got:
                        best = got[0], a + got[1]
                        if not best[0]:
                            break
                if best:
                    found += [{"item_id": i, "distance": best[0], "item_chars": len(pattern), "end": best[1]} for i in ids]
        return {"items": sorted(found, key=lambda x: _by_id(x["item_id"]))}


def item_shards(benchmark: DataFrame, shard_chars: int = SHARD_CHARS, item_col: str = "item_id", item_text: str = "text", unnamed: bool = False) -> list[DataFrame]:
    """(id, text) of the items, in as many parts as keep each to about ``shard_chars`` characters."""
    items = benchmark.select(F.col(item_col).cast("long").alias("id"), F.col(item_text).alias("text")).where("text IS NOT NULL").distinct()
    if not unnamed:
        items = items.where("id IS NOT NULL")
    total = items.agg(F.sum(F.char_length("text"))).first()[0] or 0
    shards = int(-(-total // shard_chars)) or 1
    if shards == 1:
        return [items]
    items = shared_table(items, "leak-items")
    return [items.where(F.pmod(F.xxhash64("id", "text"), F.lit(shards)) == k) for k in range(shards)]


def _find(docs: DataFrame, shard: DataFrame, error_rate: float, text_col: str, name: str) -> tuple[DataFrame, Broadcast]:
    """``docs`` and an array column with the items of one shard found in each; also the broadcast that it needs."""
    own = docs.sparkSession.sparkContext.broadcast([tuple(r) for r in shard.collect()])
    found = add_struct(docs, text_col, name, MATCHES, lambda: Matcher(own.value, error_rate).matches)
    return found.withColumn(name, F.col(f"{name}.items")), own


def _one_by_one(shards: list[DataFrame], find: Callable[[DataFrame], tuple[DataFrame, Broadcast]]) -> DataFrame:
    """The union of what ``find`` makes of each shard, written before the next one starts."""
    parts = []
    for shard in shards:
        found, own = find(shard)
        parts.append(shared_table(found, "leaks-of-shard"))
        own.destroy()
    return reduce(DataFrame.union, parts)


def add_matches(docs: DataFrame, benchmark: DataFrame, error_rate: float = ERROR_RATE, shard_chars: int = SHARD_CHARS, text_col: str = "text", item_col: str = "item_id", item_text: str = "text", unnamed: bool = False) -> tuple[DataFrame, str]:
    """``docs`` and an array column with the items found in each; also its name. ``unnamed``: items without id too, under a null item_id."""
    name, shards = free_name(docs, "leaks"), item_shards(benchmark, shard_chars, item_col, item_text, unnamed)
    if len(shards) == 1:
        return _find(docs, shards[0], error_rate, text_col, name)[0], name
    texts = docs.select(F.unhex(F.md5(text_col)).alias("key"), F.col(text_col).alias("text"))

    def of_texts(shard: DataFrame) -> tuple[DataFrame, Broadcast]:
        found, own = _find(texts, shard, error_rate, "text", "found")
        return found.where(F.size("found") > 0).select("key", "found").dropDuplicates(["key"]), own

    # Written, so that the join can split a text with very many copies.
    found = _one_by_one(shards, of_texts).groupBy("key").agg(F.array_sort(F.flatten(F.collect_list("found"))).alias("found"))
    found = shared_table(found, "leaks-by-text")
    key = free_name(docs, "leaks_key")
    keyed = docs.withColumn(key, F.unhex(F.md5(text_col)))
    both = keyed.join(found.select(F.col("key").alias(f"{key}_of"), F.col("found").alias(name)), F.col(key) == F.col(f"{key}_of"), "left")
    return both.select(*[keyed[c] for c in docs.columns], F.coalesce(F.col(name), F.array().cast(MATCHES["items"].dataType)).alias(name)), name


def leaks(docs: DataFrame, benchmark: DataFrame, error_rate: float = ERROR_RATE, id_col: str = "doc_id", text_col: str = "text", shard_chars: int = SHARD_CHARS) -> DataFrame:
    """One row per document and item found in it."""
    docs = docs.select(id_col, text_col)
    name, shards = free_name(docs, "leaks"), item_shards(benchmark, shard_chars)

    def of_docs(shard: DataFrame) -> tuple[DataFrame, Broadcast]:
        found, own = _find(docs, shard, error_rate, text_col, name)
        return found.select(id_col, F.explode(name).alias("leak")).select(id_col, "leak.*"), own

    return of_docs(shards[0])[0] if len(shards) == 1 else _one_by_one(shards, of_docs)


def drop_leaks(docs: DataFrame, benchmark: DataFrame, error_rate: float = ERROR_RATE, text_col: str = "text", shard_chars: int = SHARD_CHARS) -> DataFrame:
    """The documents in which no item is found, with or without id, with their columns."""
    found, name = add_matches(docs, benchmark, error_rate, shard_chars, text_col, unnamed=True)
    return found.where(F.size(name) == 0).select(*[F.col(c) for c in docs.columns])
