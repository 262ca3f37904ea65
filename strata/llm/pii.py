"""PII: identifiers in the text as it is, and in a deobfuscated form of it mapped back to the source.

Method: transducers rewrite disguises and keep, for each character they write, the span of source
characters it came from. They run in this order:

1. homoglyphs: full-width forms, other scripts' decimal digits, Cyrillic and Greek letters that look Latin,
   other at signs and dots become ASCII; zero-width characters vanish;
2. at and dot: ``[at]``, ``(dot)`` and so on in any bracket, the bare words in the order
   name at host dot domain, and a bare dot between digits, spelled or not;
3. spelled digits: dotted quads in which a digit is spelled as an English word, and runs of at least seven digits,
   single or as numerals of several digits, of which most (or at least seven) are spelled. A run of 9 to 15 digits counts
   as a phone, with or without plus. A run that is neither phone nor card as a whole is cut at line ends, commas,
   sentence ends and between numerals and words such that the fewest digits are left over; a run that cannot be
   cut so stays unfound.

Identifiers are found in the text itself (the base spans) and in the rewritten text; a span of the latter that a
transducer changed is added under its source characters. Base spans always stay. An added span that equals a base
span of its kind is left out. Offsets are code points, ends are exclusive.

Defined results: a null or empty text has no spans. Repeated rows and extra columns pass through. Each text is
handled alone, in time linear in its length: patterns start at their rare part (an at sign, the first digit of a run) and go left and right
from there. Any run of blanks may surround a disguise; a bare top-level domain has 2 to 63 letters.
"""

from __future__ import annotations

import re
import sys
import unicodedata

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from strata.llm.common import add_struct, free_name

#: Kinds in the order in which spans with one start are listed.
KINDS = ("email", "ip", "card", "phone")

#: The patterns of the contract.
EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(?:\.[0-9]+)(?:\.[0-9]+)(?:\.[0-9]+)")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")

SPAN = T.StructType([T.StructField("kind", T.StringType()), T.StructField("start", T.LongType()), T.StructField("end", T.LongType())])
FOUND = T.StructType([T.StructField("base", T.ArrayType(SPAN)), T.StructField("added", T.ArrayType(SPAN))])


def luhn(digits: str) -> bool:
    total = 0
    for k, d in enumerate(reversed(digits)):
        n = int(d) * (1 + k % 2)
        total += n - 9 * (n > 9)
    return total % 10 == 0


def _digits(s: str) -> str:
    return "".join(c for c in s if "0" <= c <= "9")


def _is_ip(s: str) -> bool:
    return all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in s.split("."))


def _is_card(s: str) -> bool:
    return 12 <= len(d := _digits(s)) <= 19 and luhn(d)


def _is_phone(s: str) -> bool:
    return 9 <= len(_digits(s)) <= 15


_HAS_DIGIT = re.compile("[0-9]").search


#: A dotted quad begins at the first digit of a run: from inside it, it could only match if it did from there.
_QUADS = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)+")


def emails(text: str) -> list[tuple[int, int]]:
    """The spans of ``EMAIL.finditer``, in linear time: from each at sign to the left and to the right."""
    out, free, at = [], 0, text.find("@")
    while at >= 0:
        if at > free and text[at - 1] in _LOCAL and (m := _DOMAIN.match(text, at)):
            start = at - 1
            while start > free and text[start - 1] in _LOCAL:
                start -= 1
            out.append((start, m.end()))
            free = m.end()
        at = text.find("@", at + 1)
    return out


def identifiers(text: str) -> list[tuple[str, int, int]]:
    """(kind, start, end) by start, then kind; per kind leftmost and without overlap, failing matches dropped."""
    found = []
    if "@" in text:
        found += [("email", a, b) for a, b in emails(text)]
    if _HAS_DIGIT(text):
        found += [("ip", *m.span()) for m in _QUADS.finditer(text) if _is_ip(m[0])]
        found += [("card", *m.span()) for m in CARD.finditer(text) if _is_card(m[0])]
        if "+" in text:
            found += [("phone", *m.span()) for m in PHONE.finditer(text) if _is_phone(m[0])]
    return sorted(found, key=lambda s: (s[1], KINDS.index(s[0])))


#: Cyrillic and Greek letters and the ASCII letters that they look like.
LOOKALIKES = dict(zip("АВЕКМНОРСТУХЅІЈаеорсухѕіјԁһԛԝΑΒΕΖΗΙΚΜΝΟΡΤΥΧο", "ABEKMHOPCTYXSIJaeopcyxsijdhqwABEZHIKMNOPTYXo"))
#: Signs read as at and dot, and characters without width.
AT_SIGNS = "＠﹫"
DOTS = "．｡。․﹒"
NO_WIDTH = "​‌‍⁠﻿­"
_HYPHENS = "‐‑‒–−－"


def _fold(c: str) -> str | None:
    """The ASCII form of a disguised character; None if it is none."""
    if c in NO_WIDTH:
        return ""
    if c in AT_SIGNS:
        return "@"
    if c in DOTS:
        return "."
    if c in _HYPHENS:
        return "-"
    if c in LOOKALIKES:
        return LOOKALIKES[c]
    if 0xFF01 <= ord(c) <= 0xFF5E:
        return chr(ord(c) - 0xFEE0)
    if (d := unicodedata.decimal(c, None)) is not None:
        return str(d)
    if "MATHEMATICAL" in unicodedata.name(c, "") and len(n := unicodedata.normalize("NFKC", c)) == 1 and n.isascii():
        return n
    return None


#: All characters beyond ASCII that ``_fold`` rewrites, and their forms.
_ODD = {c: f for c in map(chr, range(128, sys.maxunicode + 1)) if (f := _fold(c)) is not None}


class Tape:
    """A rewritten text; ``start[i]``, ``end[i]`` are the source span of its character i, ``changed[i]`` if a transducer wrote it."""

    def __init__(self, text: str):
        self.text = text
        self.start = np.arange(len(text))
        self.end = self.start + 1
        self.changed = np.zeros(len(text), dtype=bool)

    def rewrite(self, edits: list[tuple[int, int, str]]) -> None:
        """Replace each [a, b) of the present text; edits come in order and do not overlap."""
        if not edits:
            return
        parts, lengths, firsts, lasts, at = [], [], [], [], 0
        for a, b, new in edits:
            parts += [self.text[at:a], new]
            lengths += [a - at, len(new)]
            firsts += [at, a]
            lasts += [at, b - 1]
            at = b
        parts.append(self.text[at:])
        lengths.append(len(self.text) - at)
        # Kept characters count on from the first of their stretch, written ones stay at the first and last that they replace.
        length = np.array(lengths)
        written = np.repeat(np.arange(len(lengths)) % 2 == 1, length)
        inside = np.where(written, 0, np.arange(length.sum()) - np.repeat(np.cumsum(length) - length, length))
        first = np.repeat([*firsts, at], length) + inside
        self.text = "".join(parts)
        self.end = self.end[np.repeat([*lasts, at], length) + inside]
        self.start, self.changed = self.start[first], self.changed[first] | written

    def source(self, a: int, b: int) -> tuple[int, int]:
        return int(self.start[a]), int(self.end[b - 1])


def _is_odd(text: str) -> bool:
    return not text.isascii() and not _ODD.keys().isdisjoint(text)


def homoglyphs(tape: Tape) -> None:
    if _is_odd(tape.text):
        tape.rewrite([(k, k + 1, _ODD[c]) for k, c in enumerate(tape.text) if c in _ODD])


_OPEN, _CLOSE = r"[\[({<]", r"[\])}>]"
_BRACKET_AT = re.compile(rf"{_OPEN}\s*(?:at|@)\s*{_CLOSE}", re.I)
_BRACKET_DOT = re.compile(rf"{_OPEN}\s*(?:dot|punkt|punto|point|\.)\s*{_CLOSE}", re.I)
#: name at host dot domain: the sign in the middle, which a run of blanks may surround (a run is looked at from its first blank only) ...
_AT_WORD = re.compile(r"(?<=[A-Za-z0-9._%+-])(?:\s+at(?=\s)|\s*@)", re.I)
#: ... and what follows: a host, and a last part that looks like a top-level domain (2 to 63 letters, as names on the net allow).
_DOT_DOMAIN = re.compile(r"\s*[A-Za-z0-9-]++((?:(?:\s+dot\s+|\.)[A-Za-z0-9-]++)*)(\s+dot\s+)[A-Za-z]{2,63}\b", re.I)
_DOT_WORD = re.compile(r"\s+dot\s+", re.I)
_BLANKS = re.compile(r"\s*")


def _with_blanks(text: str, pattern: re.Pattern, sign: str) -> list[tuple[int, int, str]]:
    """The places of a pattern with all blanks around them."""
    out, free = [], 0
    for m in pattern.finditer(text):
        start = m.start()
        while start > free and text[start - 1].isspace():
            start -= 1
        free = _BLANKS.match(text, m.end()).end()
        out.append((start, free, sign))
    return out


def _spelled(text: str) -> list[tuple[int, int, str]]:
    """The edits that turn ``name at host dot domain`` into an address, in linear time."""
    edits, free = [], 0
    for m in _AT_WORD.finditer(text):
        if m.start() > free and (rest := _DOT_DOMAIN.match(text, m.end())):
            host = _BLANKS.match(text, m.end()).end()
            if text[m.start() : host] != "@":
                edits.append((m.start(), host, "@"))
            edits += [(rest.start(1) + d.start(), rest.start(1) + d.end(), ".") for d in _DOT_WORD.finditer(rest[1])]
            edits.append((*rest.span(2), "."))
            free = rest.end()
    return edits


def at_and_dot(tape: Tape) -> None:
    low = tape.text.lower()
    if "at" in low or "@" in low:
        tape.rewrite(_with_blanks(tape.text, _BRACKET_AT, "@"))
    tape.rewrite(_with_blanks(tape.text, _BRACKET_DOT, "."))
    if "dot" in low:
        tape.rewrite(_spelled(tape.text))
        tape.rewrite([(*m.span(1), ".") for m in _DIGIT_DOT.finditer(tape.text)])


#: Spelled digits.
DIGIT_WORDS = {"zero": "0", "oh": "0", "one": "1", "two": "2", "three": "3", "four": "4", "five": "5", "six": "6", "seven": "7", "eight": "8", "nine": "9"}
_NAMED = "(?:" + "|".join(DIGIT_WORDS) + ")"
_TOKEN = re.compile(rf"\b(?:{_NAMED}|[0-9]+)\b", re.I)
_SEPARATOR = re.compile(r"[\s,.-]{1,4}")
_PLUS = re.compile(r"(?:\bplus[\s-]{1,3}|\+\s{0,3})\Z", re.I)
#: A bare dot between digit groups: group 1 is the word with its blanks.
_DIGIT_DOT = re.compile(rf"\b(?:{_NAMED}|[0-9]+)([\s-]+dot[\s-]+)(?=(?:{_NAMED}|[0-9]+)\b)", re.I)
_OCTET = rf"((?:{_NAMED}|[0-9]{{1,3}})\b(?:[ \t-]{{1,3}}(?:{_NAMED}|[0-9]{{1,3}})\b){{0,2}})"
_QUAD = re.compile(rf"\b{_OCTET}" + rf"(\.){_OCTET}" * 3, re.I)
_INNER = re.compile(rf"[ \t-]{{1,3}}(?:{_NAMED}|[0-9]{{1,3}})\b", re.I)
_INNER_BEFORE = re.compile(rf"\b(?:{_NAMED}|[0-9]{{1,3}})[ \t-]{{1,3}}\Z", re.I)
#: A spelled digit beside a dot that has a letter or digit on its other side; with less, no dotted quad is spelled.
_QUAD_HINT = re.compile(rf"\b{_NAMED}\.[a-z0-9]|[a-z0-9]\.{_NAMED}\b", re.I)
MIN_DIGITS, MIN_SPELLED, MANY_SPELLED = 7, 4, 7


def _value(token: str) -> str:
    return DIGIT_WORDS.get(token.lower(), token)


def _is_octet(group: str) -> bool:
    digits = "".join(map(_value, _TOKEN.findall(group)))
    return len(digits) <= 3 and int(digits) <= 255


def spelled_ips(tape: Tape, taken: list[tuple[int, int]]) -> list[tuple[int, int, bool]]:
    """Spans of dotted quads outside ``taken`` in which a digit is spelled, and whether each group ends where the quad needs it to.

    Among more than four groups, or beside further letters, only dots that were disguised themselves make a quad:
    else a phone number with a dot after each digit would be cut up.
    """
    text, out, at = tape.text, [], 0
    if not _QUAD_HINT.search(text):
        return out
    starts, ends = np.array([a for a, _ in taken]), np.array([b for _, b in taken])
    while m := _QUAD.search(text, at):
        at = _TOKEN.match(text, m.start()).end()
        a, b = m.span()
        last = m[7]
        while not _is_octet(last):
            tokens = list(_TOKEN.finditer(last))
            if len(tokens) == 1:
                break
            last = last[: tokens[-2].end()]
        b -= len(m[7]) - len(last)
        if not all(map(_is_octet, (m[1], m[3], m[5], last))) or not any(c.isalpha() for c in text[a:b]) or ((starts < b) & (ends > a)).any():
            continue
        beside = text[a - 1 : a] == "." and text[a - 2 : a - 1].isalnum() or text[b : b + 1] == "." and text[b + 1 : b + 2].isalnum()
        if beside and not all(tape.changed[m.start(k)] for k in (2, 4, 6)):
            continue
        out.append((a, b, not _INNER.match(text, b) and not _INNER_BEFORE.search(text, max(0, a - 9), a)))
        at = b
    return out


class Run:
    """Digit tokens that follow each other; ``digits[k]``, ``spelled[k]`` count up to token k."""

    def __init__(self, text: str, tokens: list[re.Match]):
        self.text, self.tokens = text, tokens
        self.values = [_value(t[0]) for t in tokens]
        self.digits, self.spelled = [0], [0]
        for t, v in zip(tokens, self.values):
            self.digits.append(self.digits[-1] + len(v))
            self.spelled.append(self.spelled[-1] + t[0].isalpha())

    def is_spelled(self, i: int, j: int) -> bool:
        n, spelled = self.digits[j] - self.digits[i], self.spelled[j] - self.spelled[i]
        return n >= MIN_DIGITS and (2 * spelled > n or spelled >= MANY_SPELLED)

    def kind(self, i: int, j: int) -> str | None:
        """What tokens i to j are if they stand for one identifier."""
        n = self.digits[j] - self.digits[i]
        if 9 <= n <= 19 and self.is_spelled(i, j):
            if n >= 12 and luhn("".join(self.values[i:j])):
                return "card"
            if n <= 15:
                return "phone"
        return None

    def gap(self, k: int) -> str:
        return self.text[self.tokens[k - 1].end() : self.tokens[k].start()]

    def cut(self, k: int) -> int:
        """How well the run can be cut before token k: 3 at a line end, 2 at a comma or sentence end, 1 between a numeral and a word, 0 not."""
        gap = self.gap(k)
        if "\n" in gap or "\r" in gap:
            return 3
        if "," in gap or re.search(r"\.\s", gap):
            return 2
        return int(self.tokens[k - 1][0].isalpha() != self.tokens[k][0].isalpha())

    def parts(self) -> list[tuple[int, int, str]]:
        """The identifiers: the whole run, or the cuts that leave the fewest digits out; of those most cards, most line ends, fewest other cuts."""
        n = len(self.tokens)
        if kind := self.kind(0, n):
            return [(0, n, kind)]
        cuts = [0, *[k for k in range(1, n) if self.cut(k)], n]
        # Per cut: (digits covered, cards, line ends, -other cuts), the cut before and the kind between the two.
        best: list[tuple] = [((0, 0, 0, 0), None, None)]
        for y in range(1, len(cuts)):
            j = cuts[y]
            level = self.cut(j) if j < n else 0
            own = (0, 0, int(level == 3), -int(level in (1, 2)))
            options = [(tuple(map(sum, zip(best[y - 1][0], own))), y - 1, None)]
            x = y - 1
            while x >= 0 and self.digits[j] - self.digits[cuts[x]] <= 19:
                if kind := self.kind(cuts[x], j):
                    gain = (self.digits[j] - self.digits[cuts[x]], int(kind == "card"), 0, 0)
                    options.append((tuple(map(sum, zip(best[x][0], own, gain))), x, kind))
                x -= 1
            best.append(max(options, key=lambda o: o[0]))
        out, y = [], len(cuts) - 1
        while y:
            _, x, kind = best[y]
            if kind:
                out.append((cuts[x], cuts[y], kind))
            y = x
        return out[::-1]

    def rewritten(self, parts: list[tuple[int, int, str]]) -> list[tuple[int, int]]:
        """The parts, and what lies between them if most of it is spelled and it is short enough to belong to an identifier."""
        bounds = [0, *[k for i, j, _ in parts for k in (i, j)], len(self.tokens)]
        return [(i, j) for x, (i, j) in enumerate(zip(bounds, bounds[1:])) if i < j and (x % 2 or self.digits[j] - self.digits[i] <= 19 and self.is_spelled(i, j))]


def _runs(text: str, taken: list[tuple[int, int]]) -> list[Run]:
    """Runs of digit tokens outside the spans of ``taken``."""
    runs, own, k = [], [], 0
    taken = sorted(taken)
    for t in _TOKEN.finditer(text):
        while k < len(taken) and taken[k][1] <= t.start():
            k += 1
        if k < len(taken) and taken[k][0] < t.end():
            runs, own = [*runs, own] if own else runs, []
            continue
        if own and not (t.start() - own[-1].end() <= 4 and _SEPARATOR.fullmatch(text, own[-1].end(), t.start())):
            runs.append(own)
            own = []
        own.append(t)
    return [r for o in [*runs, own] if sum(t[0].isalpha() for t in o) >= MIN_SPELLED and (r := Run(text, o))]


def spelled_digits(tape: Tape, taken: list[tuple[int, int]]) -> list[tuple[str, int, int]]:
    """Rewrite the runs outside ``taken``; (kind, start, end) in the rewritten text of the identifiers they stand for, of which phones need no plus."""
    if not _may_spell(tape.text):
        return []
    edits, found = [], []
    shift = 0
    for run in _runs(tape.text, taken):
        parts = run.parts()
        kinds = {(i, j): kind for i, j, kind in parts}
        for i, j in run.rewritten(parts):
            first = run.tokens[i].start()
            start = first + shift
            if i == 0 and (plus := _PLUS.search(tape.text, max(0, first - 8), first)):
                start = plus.start() + shift
                if plus[0] != "+":
                    edits.append((*plus.span(), "+"))
                    shift += 1 - len(plus[0])
            for k in range(i, j):
                t = run.tokens[k]
                if t[0].isalpha():
                    edits.append((*t.span(), run.values[k]))
                    shift += 1 - len(t[0])
                # The separators go too, so that the digits stand together; the last digit ends at its own end.
                if k + 1 < j:
                    edits.append((t.end(), run.tokens[k + 1].start(), ""))
                    shift -= len(run.gap(k + 1))
            if (i, j) in kinds:
                found.append((kinds[i, j], start, run.tokens[j - 1].end() + shift))
    tape.rewrite(edits)
    return found


def _may_spell(text: str) -> bool:
    """Whether the text may hold a run of spelled digits."""
    low = text.lower()
    return sum(map(low.count, DIGIT_WORDS)) >= MIN_SPELLED


_MAYBE = re.compile(rf"{_OPEN}\s*(?:at|@|dot|punkt|punto|point|\.)\s*{_CLOSE}", re.I)


def hidden_identifiers(text: str, base: list[tuple[str, int, int]]) -> list[tuple[str, int, int]]:
    """Spans of the source that hold an identifier only after rewriting, and are not base spans."""
    tape = Tape(text) if _suspect(text) else None
    if tape is None:
        return []
    homoglyphs(tape)
    at_and_dot(tape)
    plain = base if tape.text is text else identifiers(tape.text)
    found = [(k, a, b) for k, a, b in plain if tape.changed[a:b].any() or tape.start[b - 1] - tape.start[a] != b - 1 - a]
    quads = spelled_ips(tape, [(a, b) for k, a, b in plain if k == "ip"])
    found += [("ip", a, b) for a, b, _ in quads]
    out = {(k, *tape.source(a, b)) for k, a, b in found}
    before = tape.text
    runs = spelled_digits(tape, [*[(a, b) for k, a, b in plain if k != "email"], *[(a, b) for a, b, whole in quads if whole]])
    if tape.text is not before:
        found = [(k, a, b) for k, a, b in identifiers(tape.text) if tape.changed[a:b].any()]
        numbers = np.zeros(len(tape.text) + 1, dtype=np.int64)
        for k, a, b in found:
            if k in ("card", "phone"):
                numbers[a + 1 : b + 1] = 1
        numbers = np.cumsum(numbers)
        found += [(k, a, b) for k, a, b in runs if numbers[a] == numbers[b]]
        out |= {(k, *tape.source(a, b)) for k, a, b in found}
    return sorted(out - set(base), key=lambda s: (s[1], KINDS.index(s[0]), s[2]))


def _suspect(text: str) -> bool:
    """Whether a transducer may change the text; cheap, and never False where one would."""
    if _is_odd(text):
        return True
    return "dot" in text.lower() or _may_spell(text) or bool(_MAYBE.search(text)) or bool(_QUAD_HINT.search(text))


def find(text: str | None) -> dict:
    text = text or ""
    base = identifiers(text)
    row = lambda s: {"kind": s[0], "start": s[1], "end": s[2]}
    return {"base": [row(s) for s in base], "added": [row(s) for s in hidden_identifiers(text, base)]}


def add_spans(docs: DataFrame, text_col: str = "text") -> tuple[DataFrame, str]:
    """``docs`` and a struct column with the base and the added spans; also its name."""
    name = free_name(docs, "pii")
    return add_struct(docs, text_col, name, FOUND, lambda: find), name
