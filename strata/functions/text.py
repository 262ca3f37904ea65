"""Column-level text helpers. All built from JVM-side functions (no UDFs)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- fixed values: must equal the reference for equal results -----------------
# Stop list of the Gold "emerging topics" table, in its original order.
TOPIC_STOPWORDS = (
    "with", "that", "this", "from", "have", "been", "your", "will", "more", "some",
    "very", "also", "into", "than", "them", "then", "they", "when", "each", "made",
    "most", "over", "such", "used", "using", "based", "make", "open", "data", "code",
    "tool", "fast", "easy", "simple", "build", "support",
)
# A topic word: at least four lower-case letters at the start (no end anchor).
TOPIC_WORD_PATTERN = "^[a-z]{4,}"
# Short description length and the placeholder for an empty one.
SHORT_TEXT_CHARS = 80
EMPTY_TEXT_MARK = "—"
# -------------------------------------------------------------------------------

# Characters deleted by the compatible cleaning rule: all but [a-zA-Z0-9 ], newlines
# included, so words on both sides of a newline are glued together. ``\p{Alnum}`` is the
# US-ASCII class in Java unless UNICODE_CHARACTER_CLASS is set; deleting a whole run
# per match is several times faster than the range form on long texts.
_COMPAT_CLEAN_RUNS = r"[^\p{Alnum} ]+"


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def tokens_space(text) -> Column:
    """Lower-case, split on single spaces; punctuation stays attached."""
    return F.split(F.lower(_c(text)), " ")


def tokens_compat(text) -> Column:
    """Delete every char outside ``[a-zA-Z0-9 ]``, lower-case, split on spaces."""
    return F.split(F.lower(F.regexp_replace(_c(text), _COMPAT_CLEAN_RUNS, "")), " ")


def tokens_safe(text) -> Column:
    """Whitespace-safe variant: any run of non-alphanumerics separates words."""
    cleaned = F.regexp_replace(F.lower(_c(text)), "[^a-z0-9]+", " ")
    return F.split(F.trim(cleaned), " ")


def tokens_words(text) -> Column:
    """Lower-cased whole words (Unicode letters/digits); for mention matching."""
    return F.regexp_extract_all(F.lower(_c(text)), F.lit(r"([\p{L}\p{N}]+)"), 1)


def title_case(text) -> Column:
    """Python ``str.title`` semantics: every letter run is capitalised.

    Spark's ``initcap`` only splits on white space (``objective-c`` ->
    ``Objective-c``); splitting into letter / non-letter runs first gives
    ``Objective-C``, ``C++``, ``F#``.
    """
    runs = F.regexp_extract_all(_c(text), F.lit(r"(\p{L}+|\P{L}+)"), 1)
    return F.array_join(F.transform(runs, lambda r: F.initcap(r)), "")


def short_text(text, n: int = SHORT_TEXT_CHARS, empty: str = EMPTY_TEXT_MARK) -> Column:
    """First ``n`` characters; a placeholder when null or empty."""
    s = F.substring(_c(text), 1, n)
    return F.when(s.isNull() | (s == ""), F.lit(empty)).otherwise(s)
