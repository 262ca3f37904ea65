"""Line dedup (native): drop lines that occur in many documents, except in one of them.

Method: explode normalised lines, hash, count distinct documents per hash, drop the lines of hashes
at the threshold, reassemble the rest by position. DataFrame functions only.

* A key is hashed to two 64-bit values, together 128 bits; the hashes, not the texts, are shuffled.
* A very common line is aggregated before it is shuffled (the distinct count is a partial
  aggregation by hash and document). The join back to its occurrences reads both sides from written tables, so that
  adaptive execution can split the occurrences of a hot line.
* The texts are shuffled once, by document, to meet the positions that the document loses.

Defined results: a null or empty text is one empty line; a null text without dropped lines stays null.
Rows that share a doc_id count as one document, and each row is cut by its own lines. A row without doc_id
counts as no document and loses its repeated lines. Empty table: empty result. Ties cannot occur:
the holder is the largest doc_id. Extra columns are carried along; two columns are added under
free names (``n_lines``, ``n_dropped`` unless the table has them).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.common import SPACES, free_name, lower_ascii, shared_table

MIN_CHARS = 40
MIN_DOCUMENTS = 5


def _lines(text: str):
    return F.split(F.coalesce(F.col(text), F.lit("")), "\n", -1)


def line_occurrences(docs: DataFrame, min_chars: int = MIN_CHARS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc, version, pos, h1, h2) of each line with a key of at least ``min_chars`` code points.

    ``version`` is a hash of the text: it tells rows with the same id and other texts apart.
    """
    exploded = docs.select(
        F.col(id_col).alias("doc"), F.xxhash64(F.col(text_col)).alias("version"), F.posexplode(_lines(text_col)).alias("pos", "line")
    )
    keyed = exploded.withColumn("line", F.btrim("line", F.lit(SPACES))).where(F.char_length("line") >= min_chars)
    keyed = keyed.withColumn("line", lower_ascii(F.col("line")))
    return keyed.select("doc", "version", "pos", F.xxhash64("line").alias("h1"), F.xxhash64(F.lit(1), F.col("line")).alias("h2"))


def dedup_lines(docs: DataFrame, min_chars: int = MIN_CHARS, min_documents: int = MIN_DOCUMENTS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The columns of ``docs`` with the text cut, and the counts of lines before and dropped."""
    found = shared_table(line_occurrences(docs, min_chars, id_col, text_col), "line-occurrences")
    common = found.groupBy("h1", "h2").agg(F.count_distinct("doc").alias("docs"), F.max("doc").alias("holder"))
    common = shared_table(common.where(F.col("docs") >= min_documents).select("h1", "h2", "holder"), "common-lines")
    lost = (
        found.join(common, ["h1", "h2"])
        .where(~F.col("doc").eqNullSafe(F.col("holder")))
        .groupBy("doc", "version").agg(F.collect_set("pos").alias("lost"))
    )
    names = {n: free_name(docs, n) for n in ("n_lines", "n_dropped", "lines", "version", "lost")}
    lost = lost.select(F.col("doc").alias(f"{names['lost']}_doc"), F.col("version").alias(f"{names['lost']}_version"), F.col("lost").alias(names["lost"]))
    whole = docs.withColumns({names["lines"]: _lines(text_col), names["version"]: F.xxhash64(F.col(text_col))})
    joined = whole.join(
        lost,
        whole[id_col].eqNullSafe(lost[f"{names['lost']}_doc"]) & (whole[names["version"]] == lost[f"{names['lost']}_version"]),
        "left",
    )
    lines, gone = F.col(names["lines"]), F.col(names["lost"])
    # The set difference keeps the order and is linear, also where a document loses very many lines.
    places = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), gone)
    kept = F.array_join(F.transform(places, lambda i: F.get(lines, i)), "\n")
    text = F.when(gone.isNull(), F.col(text_col)).otherwise(kept).alias(text_col)
    return joined.select(
        *[text if c == text_col else F.col(c) for c in docs.columns],
        F.size(lines).cast("long").alias(names["n_lines"]),
        F.coalesce(F.size(gone), F.lit(0)).cast("long").alias(names["n_dropped"]),
    )
