"""License scans: an exact set-similarity join of text blocks with license templates.

Method. A template and a block of a text are sets of words. A block matches a template if it contains at least ``percent`` of the template's words.
Words are put into one global order, the rarest in all documents first, and the join takes three filters before it verifies:

* prefix: a block with the needed overlap ``o`` of template T holds one of the first |T| - o + 1 words of T in the global order, and that word is among its own first
  |B| - o + 1 words;
* length: the block has at least ``o`` words that occur in templates;
* position: after the first common word, at places i of T and j of B, there are still o - 1 words left on both sides.

The pair is kept at its first common word only, so that each is verified once, by the size of the intersection.
Words that occur in no template cannot count and are left out of the sets beforehand.

Blocks. A template of n words belongs to the scale s, the least power of two with s >= n. A text is cut into blocks of 2 s words at every
multiple of s, so any s consecutive words lie in one block whole, and long texts cannot gather a template's words from all over.

Scale. Texts are read twice (word frequencies, then blocks) and never shuffled. The frequencies are one row per template word and task. Only blocks that hold
a prefix word of a template of their scale leave the reading task. Templates are given by the caller as a list of at
most ``TEMPLATE_CHARS`` characters, the bound of what is broadcast. Matches, not blocks or texts, are grouped by document row, and meet the rows by a key that was
written with them.

Defined results: a null or empty text has no words and no matches. Rows with the same id or text are judged each by itself. Templates without words are left out,
equal word sets count once a label. Empty table: empty result. All columns but the text are carried along, with a struct column added under a free name (``licenses`` unless the table has it).
"""

from __future__ import annotations

from collections import Counter

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.llm.common import free_name, plain_words, shared_table, slices

PERCENT = 90
TEMPLATE_CHARS = 4_000_000
MIN_SCALE = 8

#: Phrases of the contract, each with the label that it gives.
PHRASES = [("cc by", "cc-by"), ("general public license", "gpl"), ("all rights reserved", "reserved")]

#: Statements and notices of well-known public licenses.
TEMPLATES = [
    ("mit", "Released under the MIT License."),
    ("mit", "Licensed under the MIT License."),
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software"),
    ("apache-2.0", "Licensed under the Apache License, Version 2.0"),
    ("apache-2.0", "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied."),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"),
    ("isc", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies."),
    ("gpl", "licensed under the GNU General Public License"),
    ("gpl", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation"),
    ("lgpl", "licensed under the GNU Lesser General Public License"),
    ("lgpl", "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation"),
    ("agpl", "licensed under the GNU Affero General Public License"),
    ("mpl-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("cc-by", "Licensed under CC BY 4.0"),
    ("cc-by", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("cc-by-nc", "Licensed under CC BY-NC 4.0"),
    ("cc-by-nc", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    ("cc-by-sa", "Licensed under CC BY-SA 4.0"),
    ("cc-by-sa", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    ("cc0", "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work."),
    ("unlicense", "This is free and unencumbered software released into the public domain."),
    ("reserved", "No part of this publication may be reproduced, stored in a retrieval system, or transmitted in any form or by any means without the prior written permission of the publisher."),
]


def scale(words: int) -> int:
    return max(MIN_SCALE, 1 << (words - 1).bit_length())


class Template:
    """One template: its label, scale, distinct words, and how many of them a block needs."""

    def __init__(self, label: str, text: str, percent: int):
        found = plain_words(text)
        self.label, self.words, self.scale = label, sorted(set(found)), scale(len(found))
        self.need = -(-len(self.words) * percent // 100)


def prepare(templates: list[tuple[str, str]], percent: int) -> list[Template]:
    if sum(len(t) for _, t in templates) > TEMPLATE_CHARS:
        raise ValueError(f"templates of more than {TEMPLATE_CHARS} characters: scan in several runs")
    made = [Template(label, text, percent) for label, text in templates]
    return list({(t.label, *t.words): t for t in made if t.words}.values())


def word_order(docs: DataFrame, vocabulary: set[bytes], text_col: str = "text") -> dict[bytes, int]:
    """Word -> place in the global order: number of documents that hold it, rarest first."""

    def run(batches):
        total: Counter = Counter()
        for part in slices(batches):
            for text in part.column(0).to_pylist():
                total.update(vocabulary.intersection(plain_words(text)))
        yield pa.RecordBatch.from_arrays([pa.array(list(total), pa.binary()), pa.array(list(total.values()), pa.int64())], names=["word", "n"])

    counted = docs.select(text_col).mapInArrow(run, "word binary, n long").groupBy("word").agg(F.sum("n").alias("n"))
    found = {bytes(w): n for w, n in counted.collect()}  # at most one row per template word
    return {w: k for k, w in enumerate(sorted(vocabulary, key=lambda w: (found.get(w, 0), w)))}


class Reader:
    """Words, phrases and candidate blocks of a text."""

    def __init__(self, order: dict[bytes, int], prefixes: dict[int, frozenset[int]], phrases: list[tuple[str, str]]):
        self.order, self.prefixes = order, prefixes
        self.phrases: dict[bytes, list[tuple[list[bytes], str]]] = {}
        for phrase, label in phrases:
            own = plain_words(phrase)
            self.phrases.setdefault(own[0], []).append((own, label))

    def read(self, text: str | None) -> dict:
        words, find = plain_words(text), self.order.get
        hits = [(at, k) for at, w in enumerate(words) if (k := find(w)) is not None]
        places = []
        if not self.phrases.keys().isdisjoint(words):
            for at, w in enumerate(words):
                places += [{"label": label, "start": at} for own, label in self.phrases.get(w, ()) if words[at : at + len(own)] == own]
        return {"n_words": len(words), "places": places, "blocks": self.blocks(hits)}

    def blocks(self, hits: list[tuple[int, int]]) -> list[dict]:
        present, out = {k for _, k in hits}, []
        for s, prefix in self.prefixes.items():
            if prefix.isdisjoint(present):
                continue
            asked: dict[int, set[int]] = {}
            for at, k in hits:
                if k in prefix:
                    for b in (at // s - 1, at // s):
                        if b >= 0:
                            asked.setdefault(b, set())
            for at, k in hits:
                for b in (at // s - 1, at // s):
                    if b in asked:
                        asked[b].add(k)
            out += [{"scale": s, "start": b * s, "words": sorted(own)} for b, own in sorted(asked.items())]
        return out


_BLOCK = T.StructType([T.StructField("scale", T.IntegerType()), T.StructField("start", T.LongType()), T.StructField("words", T.ArrayType(T.IntegerType()))])
_PLACE = T.StructType([T.StructField("label", T.StringType()), T.StructField("start", T.LongType())])
_READ = [T.StructField("n_words", T.LongType()), T.StructField("places", T.ArrayType(_PLACE)), T.StructField("blocks", T.ArrayType(_BLOCK))]
_MATCH = "array<struct<label:string,start:long,words:long,containment:double>>"


def _read_all(docs: DataFrame, text_col: str, read: Reader, names: list[str]) -> DataFrame:
    kept = [f for f in docs.schema.fields if f.name != text_col]
    schema = T.StructType([*kept, *[T.StructField(n, f.dataType) for n, f in zip(names, _READ, strict=True)]])
    at, text_at = [docs.columns.index(f.name) for f in kept], docs.columns.index(text_col)

    def run(batches):
        from pyspark.sql.pandas.types import to_arrow_type

        kinds = [to_arrow_type(f.dataType) for f in _READ]
        for part in slices(batches):
            found = [read.read(x) for x in part.column(text_at).to_pylist()]
            made = [pa.array([r[f.name] for r in found], type=kind) for f, kind in zip(_READ, kinds, strict=True)]
            yield pa.RecordBatch.from_arrays([*[part.column(k) for k in at], *made], names=schema.names)

    return docs.mapInArrow(run, schema)


def join_blocks(blocks: DataFrame, templates: DataFrame) -> DataFrame:
    """The pairs of ``blocks`` (scale, words) and ``templates`` (scale, words, need) with at least ``need`` common words, each once.

    ``words`` are sorted numbers in the global order. Both sides keep their columns, those of the templates under ``t_`` names.
    """
    right = templates.select(*[F.col(c).alias(f"t_{c}") for c in templates.columns])
    least = right.groupBy(F.col("t_scale").alias("scale")).agg(F.min("t_need").alias("least"))
    right = right.select("*", F.posexplode(F.slice("t_words", 1, F.size("t_words") - F.col("t_need") + 1)).alias("t_at", "t_word"))
    left = blocks.join(F.broadcast(least), "scale").where(F.size("words") >= F.col("least"))  # one row a scale
    left = left.select(*blocks.columns, F.posexplode(F.slice("words", 1, F.size("words") - F.col("least") + 1)).alias("at", "word"))
    pairs = left.join(F.broadcast(right), (left["scale"] == right["t_scale"]) & (left["word"] == right["t_word"]))  # bounded by TEMPLATE_CHARS
    enough = F.size("words") >= F.col("t_need")
    rest = F.least(F.size("t_words") - F.col("t_at"), F.size("words") - F.col("at")) >= F.col("t_need")
    pairs = pairs.where(enough & rest).withColumn("common", F.array_intersect("words", "t_words"))
    pairs = pairs.where((F.size("common") >= F.col("t_need")) & (F.array_min("common") == F.col("word")))
    return pairs.select(*blocks.columns, *[f"t_{c}" for c in templates.columns], F.size("common").alias("overlap"))


def scan(docs: DataFrame, templates: list[tuple[str, str]] | None = None, percent: int = PERCENT, phrases: list[tuple[str, str]] | None = None, text_col: str = "text") -> tuple[DataFrame, str]:
    """``docs`` without the text, and a struct column: n_words, places (label, start) of the phrases, matches (label, start, words, containment).

    Also the name of that column.
    """
    spark, made = docs.sparkSession, prepare(TEMPLATES if templates is None else templates, percent)
    order = word_order(docs, {w for t in made for w in t.words}, text_col)
    rows = [(t.label, t.scale, t.need, sorted(order[w] for w in t.words)) for t in made]
    prefixes: dict[int, frozenset[int]] = {}
    for _, s, need, words in rows:
        prefixes[s] = prefixes.get(s, frozenset()).union(words[: len(words) - need + 1])
    key, *names = (free_name(docs, n) for n in ("row", "n_words", "places", "blocks"))
    read = _read_all(docs, text_col, Reader(order, prefixes, PHRASES if phrases is None else phrases), names)
    read = shared_table(read.withColumn(key, F.monotonically_increasing_id()), "license-blocks")
    blocks = read.select(F.col(key).alias("row"), F.explode(names[2]).alias("block")).select("row", "block.*")
    table = spark.createDataFrame(rows, "label string, scale int, need int, words array<int>")
    pairs = join_blocks(blocks, table)
    match = F.struct(F.col("t_label").alias("label"), "start", (2 * F.col("scale")).cast("long").alias("words"), (F.col("overlap") / F.size("t_words")).alias("containment"))
    matched = free_name(docs, "matches")
    by_row = pairs.select("row", match.alias("match")).groupBy("row").agg(F.array_sort(F.collect_list("match")).alias(matched))
    out = read.join(by_row.withColumnRenamed("row", f"{matched}_row"), read[key] == F.col(f"{matched}_row"), "left")
    name = free_name(docs, "licenses")
    found = F.coalesce(F.col(matched), F.array().cast(_MATCH)).alias("matches")
    struct = F.struct(F.col(names[0]).alias("n_words"), F.col(names[1]).alias("places"), found).alias(name)
    return out.select(*[F.col(c) for c in docs.columns if c != text_col], struct), name
