"""Mixing sources to target weights by weighted fair queueing.

Every document of a source's shuffled order gets a virtual finish time: the
source's words up to and with it, divided by the source's target. Passes over
a source that must repeat follow each other in virtual time. All passes are
put in one global order of finish time and the mix is cut at the total budget.

Running sums never gather a source: rows fall into many ranges of the order,
each range's sum is a row of a small table, and only the rows of one range
are summed in one place.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from plyspark.llm.common import WORD_RE, running, shuffle_partitions, staged, table

#: Times a source (and so a document) may be taken at most.
MAX_PASSES = 3
#: Weights by position of the source among the sources, repeating.
WEIGHTS = (1, 2, 3)
#: Orders (60-bit numbers) run from 0 to this.
ORDER_SPAN = 1 << 60


def n_words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD_RE)), F.lit(0)).cast("long")


def shuffled_order(key: Column, text_hash: Column) -> Column:
    """A pseudo-random but fixed 60-bit order of the identifiers; rows without
    one are ordered by their texts' hashes, so that they spread as well."""
    digest = F.md5(F.coalesce(key.cast("string"), text_hash.cast("string"), F.lit("")))
    return F.conv(F.substring(digest, 1, 15), 16, 10).cast("long")


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MAX_PASSES) -> DataFrame:
    """Targets of ``sizes(_src, _none, _size)``, one row a source: 100 % of
    all sizes by weight, none above ``most`` times its source's size.

    With sources in order of ``most * size / weight``, the level (words a
    unit of weight) left for the others rises as long as sources are full, so
    the final level is the largest one. One row a source meets in a task;
    sources are names of data sets, far fewer than documents.
    """
    everything = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    at = F.row_number().over(Window.orderBy("_none", "_src")) - 1
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), (at % len(weights) + 1).cast("int"))
    by_fill = Window.orderBy("_fill", "_none", "_src")
    before = F.coalesce(F.sum(F.col("_size") * most).over(by_fill.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    rest = F.sum("_weight").over(by_fill.rowsBetween(0, Window.unboundedFollowing))
    return (
        sizes.withColumn("_weight", weight)
        .withColumn("_fill", F.col("_size") * F.lit(float(most)) / F.col("_weight"))
        .withColumn("_level", (F.sum("_size").over(everything) - before) / rest.cast("double"))
        .withColumn("_level", F.max("_level").over(everything))
        .select("_src", "_none", F.col("_size").alias("_source_size"),
                F.least(F.col("_size") * F.lit(float(most)), F.col("_weight") * F.col("_level")).alias("_target"))
    )


def mix_sources(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
                weights: tuple[int, ...] = WEIGHTS, most: int = MAX_PASSES) -> DataFrame:
    """One row per distinct document ``(id, source, text)``: ``_id, _src,
    _none, _digest, _n, size, source_size, target, copies``.

    ``copies`` is how often the mix takes the ``_n`` input rows that repeat the
    same document, all together: each row ``copies div _n`` times, and the
    first ``copies mod _n`` of them once more. Repeats are rows of their own:
    they follow each other in the queue, and the target and the budget cut
    between them; that is arithmetic on the one row which stands for them.
    Null text has no words; a document without words is never taken (it adds
    nothing to any target). Null identifiers and sources are values like
    others, a null source is the last one. No rows give no rows.
    """
    n = shuffle_partitions(docs.sparkSession)
    units = staged(
        docs.select(
            F.col(id_col).alias("_id"),
            F.coalesce(F.col(source_col), F.lit("")).alias("_src"),
            F.col(source_col).isNull().alias("_none"),
            F.xxhash64(text_col).alias("_digest"),
            n_words(F.col(text_col)).alias("size"),
        )
        .groupBy("_id", "_src", "_none", "_digest", "size")
        .agg(F.count(F.lit(1)).alias("_n"))
        .withColumn("_words", F.col("size") * F.col("_n"))
        .withColumn("_order", shuffled_order(F.col("_id"), F.col("_digest")))
        .withColumn("_range", F.floor(F.col("_order") / F.lit(ORDER_SPAN / n)).cast("long")),
        "mix-units",
    )
    sizes = units.groupBy("_src", "_none").agg(F.sum("_words").alias("_size"))
    targets = staged(source_targets(sizes, weights, most), "mix-targets")
    summed = running(units, ["_src", "_none"], "_range", ["_order", "_id", "_digest"], "_words", "_upto")
    passes = staged(
        summed.join(targets, ["_src", "_none"])
        .withColumn("_pass", F.explode(F.sequence(F.lit(0), F.lit(most - 1))))
        .withColumn("_before", F.col("_upto") - F.col("_words") + F.col("_pass") * F.col("_source_size"))
        # The repeats of which each begins below the target; one row where none repeats.
        .withColumn("_repeats", F.when((F.col("size") > 0) & (F.col("_before") < F.col("_target")),
                                       F.least(F.ceil((F.col("_target") - F.col("_before")) / F.col("size")), F.col("_n"))).otherwise(F.lit(0)).cast("long"))
        .withColumn("_wanted", F.col("_repeats") > 0)
        .withColumn("_upto", F.col("_before") + F.col("_repeats") * F.col("size"))
        .where("_wanted OR _pass = 0")
        .withColumn("_finish", F.when(F.col("_wanted"), F.col("_upto") / F.col("_target")))
        .withColumn("_slot", F.when(F.col("_wanted"), F.least(F.floor(F.col("_finish") * n), F.lit(n)))
                    .otherwise(-1 - F.pmod("_order", F.lit(n))).cast("long"))
        .withColumn("_add", F.col("_repeats") * F.col("size")),
        "mix-passes",
    )
    queue = running(passes, [], "_slot", ["_finish", "_none", "_src", "_pass", "_order", "_id", "_digest"], "_add", "_total")
    budget = targets.agg(F.coalesce(F.sum("_source_size"), F.lit(0)))
    cut = int(budget.first()[0])
    # Repeats that the budget cuts in two: as many as still fit.
    fitting = F.floor((F.lit(cut) - F.col("_total") + F.col("_add")) / F.col("size"))
    taken = F.when(F.col("_wanted"), F.greatest(F.lit(0), F.least(fitting, F.col("_repeats")))).otherwise(F.lit(0)).cast("long")
    return (
        queue.groupBy("_id", "_src", "_none", "_digest", "_n", "size", "_source_size", "_target")
        .agg(F.sum(taken).alias("copies"))
        .select("_id", "_src", "_none", "_digest", "_n", "size", F.col("_source_size").alias("source_size"),
                F.col("_target").alias("target"), "copies")
    )


def copies_of(repeat: Column) -> Column:
    """How often the mix takes the repeat of that number (0 and up)."""
    return F.floor(F.col("copies") / F.col("_n")) + F.when(repeat < F.col("copies") % F.col("_n"), 1).otherwise(0)


def mixed_documents(docs: DataFrame, **columns) -> DataFrame:
    """The mix itself: every row of ``docs`` as many times as it is taken."""
    id_col, text_col, source_col = (columns.get(k, v) for k, v in (("id_col", "doc_id"), ("text_col", "text"), ("source_col", "source")))
    plan = staged(mix_sources(docs, **columns).where("copies > 0").select("_id", "_src", "_none", "_digest", "_n", "copies"), "mix-plan")
    rows = docs.select(
        F.struct(*docs.columns).alias("_row"), F.col(id_col).alias("_doc"), F.xxhash64(text_col).alias("_hash"),
        F.coalesce(F.col(source_col), F.lit("")).alias("_from"), F.col(source_col).isNull().alias("_unnamed"),
        F.spark_partition_id().alias("_part"), F.monotonically_increasing_id().alias("_place"),
    )
    same = (
        rows["_doc"].eqNullSafe(plan["_id"]) & (rows["_hash"] == plan["_digest"])
        & (rows["_from"] == plan["_src"]) & (rows["_unnamed"] == plan["_none"])
    )
    found = rows.join(plan, same)
    uneven = F.col("copies") % F.col("_n") != 0
    out = found.where(~uneven).withColumn("_times", F.floor(F.col("copies") / F.col("_n")))
    if not plan.where(uneven).isEmpty():
        out = out.unionByName(_numbered(staged(found.where(uneven), "mix-uneven")).withColumn("_times", copies_of(F.col("_repeat"))).drop("_repeat"))
    again = F.explode(F.array_repeat(F.lit(1), F.col("_times").cast("int")))
    return out.withColumn("_copy", again).select("_row.*")


def _numbered(rows: DataFrame) -> DataFrame:
    """Repeats of a document numbered from 0: within the partition that each
    was read from, after those of the partitions before it. No task holds more
    of them than one partition did."""
    unit = ["_id", "_src", "_none", "_digest"]
    counts = rows.groupBy(*unit, "_part").agg(F.count(F.lit(1)).alias("_here"))
    earlier = Window.partitionBy(*unit).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select(
        *[F.col(c).alias(f"_of{c}") for c in unit], F.col("_part").alias("_of_part"), F.coalesce(F.sum("_here").over(earlier), F.lit(0)).alias("_start")
    )
    own = rows.withColumn("_at", F.row_number().over(Window.partitionBy(*unit, "_part").orderBy("_place")) - 1)
    same = F.col("_part") == F.col("_of_part")
    for c in unit:
        same &= F.col(c).eqNullSafe(F.col(f"_of{c}"))
    return own.join(starts, same).withColumn("_repeat", F.col("_start") + F.col("_at")).select(*rows.columns, "_repeat")


def op9_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    mix = mix_sources(table(spark, sf_dir, "documents"))
    repeats = mix.withColumn("_repeat", F.explode(F.sequence(F.lit(0).cast("long"), F.col("_n") - 1)))
    return repeats.select(
        F.col("_id").alias("doc_id"), "size", "source_size", "target",
        (F.col("size") * copies_of(F.col("_repeat"))).alias("taken"),
    )


ORACLE_SQL = r"""
WITH units AS (
  SELECT doc_id, coalesce(source, '') AS src, source IS NULL AS none,
    len(regexp_extract_all(coalesce(text, ''), '[^ \t-\r]+')) AS size,
    ('0x' || substr(md5(doc_id::VARCHAR), 1, 15))::BIGINT AS ord
  FROM documents),
src AS (
  SELECT src, none, sum(size)::BIGINT AS source_size,
    1 + (row_number() OVER (ORDER BY none, src) - 1) % 3 AS w
  FROM units GROUP BY src, none),
lev AS (
  SELECT *, (sum(source_size) OVER () - coalesce(sum(source_size * 3) OVER f, 0))::DOUBLE
    / (sum(w) OVER (ORDER BY source_size * 3.0::DOUBLE / w, none, src ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))::DOUBLE AS lv
  FROM src
  WINDOW f AS (ORDER BY source_size * 3.0::DOUBLE / w, none, src ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
tgt AS (
  SELECT src, none, source_size, least(source_size * 3.0::DOUBLE, w * max(lv) OVER ()) AS target FROM lev),
cum AS (
  SELECT u.*, source_size, target,
    sum(size) OVER (PARTITION BY u.src, u.none ORDER BY ord, doc_id ROWS UNBOUNDED PRECEDING) AS upto
  FROM units u JOIN tgt t ON u.src = t.src AND u.none = t.none),
pass AS (
  SELECT *, upto + p * source_size AS fin FROM cum, (VALUES (0), (1), (2)) AS v(p)
  WHERE size > 0 AND upto + p * source_size - size < target),
queue AS (
  SELECT doc_id, size,
    sum(size) OVER (ORDER BY fin / target, none, src, p, ord, doc_id ROWS UNBOUNDED PRECEDING) AS total
  FROM pass),
got AS (
  SELECT doc_id, sum(size)::BIGINT AS taken FROM queue
  WHERE total <= (SELECT sum(size) FROM units) GROUP BY doc_id)
SELECT doc_id, size, source_size, target, coalesce(taken, 0)::BIGINT AS taken
FROM cum LEFT JOIN got USING (doc_id)
"""
