"""Harmonic packing of tokenised documents into sequences of a fixed capacity.

Method: lengths fall into reciprocal-capacity classes (class j: capacity/(j+1) < length <= capacity/j)
and a bin of class j takes j documents, so that each worker fills its bins alone, without a shuffle or
a count of other workers. Documents may be cut, which the method uses as follows:

* Of a document of at least the capacity, whole sequences are cut off first.
* A rest that fits its class (j of its length fill all but ``slack`` of the capacity) stays whole.
* Any other rest is cut at the bound of the next class; what is left, and lengths below the
  last class, form the class of small pieces. It tops up closing bins and is otherwise filled in order.
* At the end of a partition the open bins are joined and cut at the capacity. The last part, shorter than
  the capacity, becomes sequences whose lengths are powers of two, which need no padding.

A task holds at most one open bin per class and the small pieces, a few thousand tokens. The
result depends only on the rows of the partition in their order, which a file scan repeats exactly
when a lost task is run again; sequence numbers are unique through the partition's number.

Ids are those of the ``tokenizers`` library. That library encodes about 1.3 MB/s here, so words are
encoded once per Python worker and kept in a bounded cache, and plain Latin-1 words take the same merge table
through ``tiktoken``. The two agree: a run of byte-pair merges inside a stretch of symbols, as long as no
merge crosses its ends, is the run on the stretch alone; so if each vocabulary entry is rebuilt from its own
bytes through its own last merge, two neighbours whose bytes make up an entry are always the pair that its
merge names. A test checks that condition for the whole vocabulary, others compare whole tables.

Defined results: a null or empty text has only the end id. Rows are packed as they are: repeated rows are
packed again, a null doc_id is kept. Empty table: no rows. Only the id and text columns are read.
"""

from __future__ import annotations

import json
import re
import struct
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

from strata.llm.common import kept, map_in_arrow

CAPACITY = 2048
END_ID = 1
VOCABULARY = "word_bpe_49k.json"
#: Classes with a fixed count; shorter lengths are small pieces.
CLASSES = 16
#: Part of the capacity that a bin of whole documents may lack before small pieces fill it.
SLACK = 128
#: A worker keeps its words from task to task: about 15 MB.
CACHED_WORDS = 50_000
#: Rows, or bytes of ids, that a task returns at a time.
OUT_ROWS = 2000
OUT_BYTES = 1 << 20

SCHEMA = "doc_id long, start long, length long, token_ids binary, doc_tokens long, sequence_id long, offset long"
_WORD_END = b"\xff"  # no byte of UTF-8
_PLAIN = re.compile("[\x21-\x7e\xa1-\xac\xae-\xff]+")


def vocabulary_path(name: str = VOCABULARY) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def byte_tokens(path: str) -> dict[bytes, int]:
    """Vocabulary as bytes -> id; the mark of a word's end is one byte that UTF-8 does not use."""
    with open(path, encoding="utf-8") as f:
        vocab = json.load(f)["model"]["vocab"]
    shown = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
    hidden = [b for b in range(256) if b not in shown]
    of = {chr(b): b for b in shown} | {chr(256 + k): b for k, b in enumerate(hidden)}
    return {bytes(of[c] for c in t.removesuffix("</w>")) + _WORD_END * t.endswith("</w>"): i for t, i in vocab.items() if i < len(vocab) and all(c in of for c in t.removesuffix("</w>"))}


class Encoder:
    """Text -> ids as little-endian unsigned 32-bit values."""

    def __init__(self, path: str, cached_words: int = CACHED_WORDS):
        import regex
        import tiktoken
        from tokenizers import Tokenizer

        self.full = Tokenizer.from_file(path)
        ranks = byte_tokens(path)  # ids rise in the order of the merges
        self.merge = tiktoken.Encoding("words", pat_str=r"\S+", mergeable_ranks=ranks, special_tokens={})._core_bpe.encode_single_piece
        # Fixed value: the pattern of the vocabulary's pre-tokenizer.
        self.parts = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+").findall
        # Special tokens, and what str.split takes for white space but the vocabulary does not.
        self.odd = [*"\x1c\x1d\x1e\x1f", *(t.content for t in self.full.get_added_tokens_decoder().values())]
        self.cache: dict[str, bytes] = {}
        self.cached_words = cached_words

    def by_library(self, text: str) -> bytes:
        return self._bytes(self.full.encode(text, add_special_tokens=False).ids)

    @staticmethod
    def _bytes(ids: list[int]) -> bytes:
        return struct.pack(f"<{len(ids)}I", *ids)

    def word(self, word: str) -> bytes:
        if not (word.isascii() and word.isprintable() or _PLAIN.fullmatch(word)):
            return self.by_library(word)
        word = word.lower()
        if word.isalpha():
            return self._bytes(self.merge(word.encode() + _WORD_END))
        return self._bytes([i for part in self.parts(word) for i in self.merge(part.encode() + _WORD_END)])

    def __call__(self, text: str) -> bytes:
        if any(x in text for x in self.odd):
            return self.by_library(text)
        words, cache = text.split(), self.cache
        new = set(words).difference(cache)
        if new:
            if len(cache) + len(new) > self.cached_words:
                cache.clear()
                new = set(words)
            for w in new:
                cache[w] = self.word(w)
        return b"".join(map(cache.__getitem__, words))


class HarmonicBins:
    """The bins of one worker. A piece is [doc, start, length, doc_tokens, ids]; ``add`` and ``close`` yield finished sequences."""

    def __init__(self, capacity: int = CAPACITY, classes: int = CLASSES, slack: int = SLACK):
        self.capacity, self.classes, self.slack = capacity, classes, slack
        self.open: dict[int, list] = {j: [] for j in range(2, classes + 1)}
        self.small: list = []
        self.small_tokens = 0

    @staticmethod
    def split(piece: list, length: int) -> tuple[list, list]:
        doc, start, n, total, ids = piece
        return [doc, start, length, total, ids[: 4 * length]], [doc, start + length, n - length, total, ids[4 * length :]]

    def take(self, tokens: int) -> list:
        """Small pieces of ``tokens`` tokens together, the last one cut if need be."""
        got = []
        while tokens and self.small:
            piece = self.small.pop()
            if piece[2] > tokens:
                piece, rest = self.split(piece, tokens)
                self.small.append(rest)
            got.append(piece)
            tokens -= piece[2]
            self.small_tokens -= piece[2]
        return got

    def add(self, piece: list) -> Iterator[list]:
        while piece[2] >= self.capacity:
            whole, piece = self.split(piece, self.capacity)
            yield [whole]
        if not piece[2]:
            return
        j = self.capacity // piece[2]
        if j <= self.classes and j * piece[2] < self.capacity - self.slack:
            j += 1
            if j <= self.classes:
                piece, rest = self.split(piece, self.capacity // j)
                self.small.append(rest)
                self.small_tokens += rest[2]
        if j > self.classes:
            self.small.append(piece)
            self.small_tokens += piece[2]
        elif j == 1:
            yield [piece, *self.take(self.capacity - piece[2])]
        else:
            filled = self.open[j]
            filled.append(piece)
            if len(filled) == j:
                self.open[j] = []
                yield filled + self.take(self.capacity - sum(p[2] for p in filled))
        while self.small_tokens >= 2 * self.capacity:
            yield self.take(self.capacity)

    def close(self) -> Iterator[list]:
        for filled in self.open.values():
            self.small += filled
            self.small_tokens += sum(p[2] for p in filled)
        while self.small_tokens:
            yield self.take(self.capacity if self.small_tokens >= self.capacity else 1 << (self.small_tokens.bit_length() - 1))


def pack(docs: DataFrame, path: str | None = None, capacity: int = CAPACITY, end_id: int = END_ID, classes: int = CLASSES, slack: int = SLACK, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per piece: its document, place, ids (little-endian unsigned 32-bit) and place in a sequence.

    ``path`` is the vocabulary's place on the executors; where it is None they look it up.
    """

    def run(batches):
        from pyspark import TaskContext

        context = TaskContext.get()
        number = (context.partitionId() if context else 0) << 33
        place_of = path or vocabulary_path()
        encode, bins = kept(("encoder", place_of), lambda: Encoder(place_of)), HarmonicBins(capacity, classes, slack)
        end = int(end_id).to_bytes(4, "little")
        rows: list = []
        held = 0

        def place(sequence):
            nonlocal number, held
            at = 0
            for doc, start, n, total, ids in sequence:
                rows.append((doc, start, n, ids, total, number, at))
                at += n
                held += len(ids)
            number += 1

        def full():
            return len(rows) >= OUT_ROWS or held >= OUT_BYTES

        def out():
            nonlocal held
            columns = list(zip(*rows)) or [[]] * 7
            rows.clear()
            held = 0
            kinds = [pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.int64()]
            return pa.RecordBatch.from_arrays([pa.array(c, type=k) for c, k in zip(columns, kinds)], names=[x.split()[0] for x in SCHEMA.split(", ")])

        for batch in batches:
            for doc, text in zip(batch.column(0), batch.column(1)):
                ids = encode(text.as_py() or "") + end
                for sequence in bins.add([doc.as_py(), 0, len(ids) // 4, len(ids) // 4, ids]):
                    place(sequence)
                    if full():
                        yield out()
        for sequence in bins.close():
            place(sequence)
            if full():
                yield out()
        yield out()

    return map_in_arrow(docs.select(docs[id_col].cast("long"), docs[text_col]), run, SCHEMA)
