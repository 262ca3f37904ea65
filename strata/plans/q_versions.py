"""Catalog entries: snapshot versions (VR1-VR6, AG11, SRC4, SRC5).

Each query writes a fresh snapshot table under the session's shared scratch
folder (the checkpoint dir), derived from ``documents``.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from strata.operators import snapshots as snap
from strata.plans.catalog import register
from strata.session import scratch_path
from strata.sources.tables import table


def _v0(spark, sf_dir):
    """Version 0: documents with one category still null (so the update has work)."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "lang")
    return docs.withColumn("lang", F.nullif(F.col("lang"), F.lit("de")))


def _updated(spark, sf_dir):
    path = scratch_path(spark, "snap")
    snap.commit(_v0(spark, sf_dir), path)
    snap.update(spark, path, {"lang": F.lit("Unknown")}, F.col("lang").isNull())
    return path


@register(
    "version_compare",
    sql="""WITH v0 AS (SELECT nullif(lang, 'de') AS lang FROM documents),
                v1 AS (SELECT coalesce(lang, 'Unknown') AS lang FROM v0),
                a AS (SELECT lang, count(*) AS count_before FROM v0 GROUP BY lang),
                b AS (SELECT lang, count(*) AS count_after FROM v1 GROUP BY lang)
           SELECT coalesce(a.lang, b.lang) AS lang, count_before, count_after FROM a FULL JOIN b ON a.lang = b.lang""",
)
def version_compare(spark, sf_dir):
    """VR3 + AG11: counts per category, version before the update vs now."""
    path = _updated(spark, sf_dir)
    now = snap.latest_version(spark, path)
    return snap.compare_counts(snap.read_as_of(spark, path, now - 1), snap.read_latest(spark, path), "lang")


@register(
    "conditional_update",
    sql="SELECT doc_id, coalesce(nullif(lang, 'de'), 'Unknown') AS lang FROM documents",
)
def conditional_update(spark, sf_dir):
    """VR2: ``SET lang = 'Unknown' WHERE lang IS NULL`` as a new version."""
    return snap.read_latest(spark, _updated(spark, sf_dir))


@register("delete_where", sql="SELECT doc_id, lang FROM documents WHERE lang <> 'de'")
def delete_where(spark, sf_dir):
    """VR6: delete the imputed rows again; version 2 keeps the rest."""
    path = _updated(spark, sf_dir)
    snap.delete(spark, path, F.col("lang") == "Unknown")
    return snap.read_latest(spark, path)


@register("restore", sql="SELECT doc_id, nullif(lang, 'de') AS lang FROM documents")
def restore(spark, sf_dir):
    """VR4: restore version 0 after the update; the restored table equals version 0."""
    path = _updated(spark, sf_dir)
    snap.restore(spark, path, 0)
    return snap.read_latest(spark, path)


@register(
    "schema_evolution",
    sql="""SELECT doc_id, lang, CASE WHEN lang IN ('en', 'fr') THEN NULL ELSE n_chars END AS n_chars FROM documents""",
)
def schema_evolution(spark, sf_dir):
    """VR5: an append carrying an extra column; older rows read back with nulls."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "lang", "n_chars")
    path = scratch_path(spark, "snap")
    snap.commit(docs.filter(F.col("lang").isin("en", "fr")).select("doc_id", "lang"), path)
    snap.commit(docs.filter(~F.col("lang").isin("en", "fr")), path, mode="append")
    return snap.read_latest(spark, path).select("doc_id", "lang", "n_chars")
