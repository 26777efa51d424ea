"""Exact dedup by content sort.

Texts are range-partitioned by sampled splitters, sorted externally, and
equal neighbours are found by comparing whole normalised texts. The range key
is the text's beginning, so equal texts lie in one range and are neighbours.
Only beginnings found hot (more rows than a range should have) get a salt from
the identifier as well, which spreads a text that a third of all rows share
over many ranges; the runs that this cuts meet afterwards through their
SHA-256, one row a run.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from plyspark.llm.common import lower_ascii, shuffle_partitions, staged, table

#: Characters of a text that take part in the choice of splitters.
SPLITTER_CHARS = 48
#: A beginning with fewer rows is never spread over ranges.
HOT_ROWS = 1_000


def content_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: ``_id, _at, _run_keep, _run_size, _sha``, its
    place in its run of equal neighbours and the run's largest identifier and
    size. Runs of one text are cut only by the salt of a hot beginning; at
    most one beginning a range is hot, so these are broadcast."""
    n = shuffle_partitions(docs.sparkSession)
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    rows = docs.select(
        F.col(id_col).alias("_id"),
        text.alias("_text"),
        lower_ascii(F.substring(text, 1, SPLITTER_CHARS)).alias("_head"),
    )
    most = max(HOT_ROWS, rows.count() // n)
    hot = staged(
        rows.groupBy("_head").agg(F.count(F.lit(1)).alias("_rows")).where(F.col("_rows") > most).select("_head", F.lit(True).alias("_hot")),
        "exact-hot",
    )
    salt = F.when(F.col("_hot"), F.pmod(F.xxhash64("_id"), F.lit(n))).otherwise(F.lit(0))
    ranged = rows.join(F.broadcast(hot), "_head", "left").withColumn("_salt", salt).repartitionByRange(n, "_head", "_salt").select(
        "_id", "_head", "_salt", lower_ascii(F.col("_text")).alias("_norm")
    )
    run = Window.partitionBy("_head", "_salt", "_norm").orderBy(F.col("_id").desc_nulls_last())
    whole = run.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    return ranged.select(
        "_id",
        F.row_number().over(run).alias("_at"),
        F.max("_id").over(whole).alias("_run_keep"),
        F.count(F.lit(1)).over(whole).alias("_run_size"),
        F.sha2(F.col("_norm"), 256).alias("_sha"),
    )


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: ``id_col, keep_id, group_size, kept,
    text_sha256``.

    Texts are equal when identical after lower-casing A-Z; null counts as
    empty, empty texts are equal to each other. Of equal texts the row with
    the largest identifier stays (a null identifier is smaller than any
    other); of rows repeated with that identifier exactly one stays. Other
    columns are ignored, whatever their names. No rows give no rows.
    """
    runs = staged(content_runs(docs, id_col, text_col), "exact-runs")
    groups = staged(
        runs.where("_at = 1")
        .groupBy("_sha")
        .agg(F.max("_run_keep").alias("_keep"), F.sum("_run_size").alias("_size"))
        .where("_size > 1"),
        "exact-groups",
    )
    size = F.coalesce("_size", F.lit(1).cast("long"))
    keep = F.when(F.col("_size").isNotNull(), F.col("_keep")).otherwise(F.col("_id"))
    return runs.join(groups, "_sha", "left").select(
        F.col("_id").alias(id_col),
        keep.alias("keep_id"),
        size.alias("group_size"),
        (F.col("_id").eqNullSafe(keep) & (F.col("_at") == 1)).alias("kept"),
        F.col("_sha").alias("text_sha256"),
    )


def drop_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns. Rows that
    repeat identifier and text are one row."""
    groups = exact_dedup(docs, id_col, text_col).where("kept").select(F.col(id_col).alias("_keep"), F.col("text_sha256").alias("_sha"))
    digest = F.sha2(lower_ascii(F.coalesce(F.col(text_col).cast("string"), F.lit(""))), 256)
    rows = docs.withColumn("_digest", digest)
    stay = rows.join(groups, rows[id_col].eqNullSafe(groups["_keep"]) & (rows["_digest"] == groups["_sha"]), "left_semi")
    twice = docs.groupBy(id_col).agg(F.count(F.lit(1)).alias("n")).where("n > 1").limit(1).count()
    if twice:
        stay = stay.dropDuplicates([id_col, "_digest"])
    return stay.drop("_digest")


def op8_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup(table(spark, sf_dir, "documents"))


ORACLE_SQL = """
WITH norm AS (
  SELECT doc_id, sha256(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')) AS text_sha256
  FROM documents),
grp AS (
  SELECT text_sha256, max(doc_id) AS keep_id, count(*) AS group_size
  FROM norm GROUP BY text_sha256)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, text_sha256
FROM norm JOIN grp USING (text_sha256)
"""
