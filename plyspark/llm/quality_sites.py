"""Hierarchical empirical Bayes quality classifier.

A document classifier gives each document log odds of being good. Sites and
the paths inside them get posteriors from grouped sums of the documents'
probabilities: a site is shrunk toward the global share of good documents and
a path toward its site, the more the fewer documents it has. How strongly is
estimated from the spread between groups. A document's own evidence is then
combined with its path's posterior in place of the global share.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from plyspark.llm.common import staged, table
from plyspark.llm.quality_rules import base_features
from plyspark.llm.toxicity import held_out

#: Labelled rows that the fit uses at most (an even sample by identifier hash).
MAX_TRAINING_ROWS = 20_000
#: Documents whose evidence a group's posterior at least weighs against its own.
MIN_STRENGTH = 5.0

#: SQL over the counts of ``base_features``; a text without words has null ratios, which count as 0.
FEATURES = (
    "ln(1 + n_words)", "least(n_words, 50) / 50", "word_chars / nullif(n_words, 0) / 10",
    "sqrt(n_symbols / nullif(word_chars, 0))", "sqrt(n_symbol_words / nullif(n_words, 0))", "n_symbol_lines / nullif(n_lines, 0)",
    "sqrt(n_dup_lines / nullif(n_lines, 0))", "sqrt(n_repeat_words / nullif(n_words, 0))",
    "ln(n_words / (1.0 + n_stops) + 1)", "n_distinct / nullif(n_words, 0)", "sqrt(n_distinct / nullif(n_words, 0))",
    "CAST(n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS INT)", "CAST(n_words < 20 AS INT)",
)


def fit_logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1.0, steps: int = 30) -> np.ndarray:
    """Weights of ``(x, 1)`` by Newton steps with a ridge on all but the bias."""
    x = np.concatenate([x, np.ones((len(x), 1))], 1)
    w = np.zeros(x.shape[1])
    penalty = np.full(x.shape[1], ridge)
    penalty[-1] = 1e-3
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        hessian = (x * (p * (1 - p))[:, None]).T @ x + np.diag(penalty)
        step = np.linalg.solve(hessian, x.T @ (p - y) + penalty * w)
        w -= step
        if np.abs(step).max() < 1e-8:
            break
    return w


def logit(p: Column) -> Column:
    p = F.least(F.greatest(p, F.lit(1e-4)), F.lit(1 - 1e-4))
    return F.log(p / (1 - p))


def strength(groups: DataFrame, prior: Column | str) -> float:
    """Prior documents by the method of moments: between groups, shares vary
    by ``p (1 - p) / (strength + 1)`` beyond what their sizes explain. Sums
    over groups only; one row reaches the driver."""
    share, n = F.col("_good") / F.col("_docs"), F.col("_docs")
    p = F.col(prior) if isinstance(prior, str) else prior
    spread = F.sum(n * (share - p) ** 2)
    row = groups.agg(spread, F.sum(n * p * (1 - p)), F.sum(p * (1 - p)), F.count(F.lit(1))).first()
    spread, weighted, plain, many = (float(v or 0.0) for v in row)
    if many < 2 or weighted <= 0:
        return 1e6
    between = max(spread - plain, 0.0) / weighted
    return min(1e6, max(MIN_STRENGTH, 1 / between - 1 if between > 1e-6 else 1e6))


def judge_sites(docs: DataFrame, labels: DataFrame, site: Column, path: Column, id_col: str = "doc_id", text_col: str = "text",
                threshold: float = 0.5) -> DataFrame:
    """``id_col, doc_quality, site_quality, path_quality, quality, kept`` of
    every row. ``site`` and ``path`` are expressions over ``docs`` (such as
    ``parse_url(url, 'HOST')``); null is a site or path like any other.

    Learns ``labels(doc_id, quality)`` of rows not held out, at most about
    ``MAX_TRAINING_ROWS``; without labels all documents have even odds. Null
    or empty texts are judged by having no words; repeated rows are alike and
    count each. No rows give no rows.
    """
    rows = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_in"),
                       F.coalesce(site.cast("string"), F.lit("\0")).alias("_site"), F.coalesce(path.cast("string"), F.lit("\0")).alias("_path"))
    features = F.array(*[F.coalesce(F.expr(f"CAST({f} AS DOUBLE)"), F.lit(0.0)) for f in FEATURES])
    counted = staged(base_features(rows, "_in").select("_id", "_site", "_path", features.alias("_x")), "site-features")

    usable = labels.where(F.col("quality").isNotNull() & ~held_out(F.col("doc_id"))).groupBy("doc_id").agg(F.max("quality").cast("double").alias("_y"))
    share = min(1.0, MAX_TRAINING_ROWS / max(usable.count(), 1))
    chosen = usable.where(F.pmod(F.xxhash64("doc_id", F.lit(2)), F.lit(1_000_000)) < int(share * 1_000_000)).limit(2 * MAX_TRAINING_ROWS)
    known = counted.join(F.broadcast(chosen), counted["_id"] == chosen["doc_id"]).select("_x", "_y").toArrow()
    n = len(FEATURES)
    weights = np.zeros(n + 1)
    if known.num_rows:
        x = known.column(0).combine_chunks().flatten().to_numpy().reshape(-1, n)
        y = known.column(1).to_numpy()
        weights = fit_logistic(x, y)
    odds = F.lit(float(weights[n]))
    for k in range(n):
        odds = odds + F.col("_x")[k] * float(weights[k])
    scored = counted.select("_id", "_site", "_path", odds.alias("_odds"), (1 / (1 + F.exp(-odds))).alias("_p"))

    paths = staged(scored.groupBy("_site", "_path").agg(F.sum("_p").alias("_good"), F.count(F.lit(1)).alias("_docs")), "site-paths")
    sites = paths.groupBy("_site").agg(F.sum("_good").alias("_good"), F.sum("_docs").alias("_docs"))
    total = sites.agg(F.sum("_good") / F.sum("_docs")).first()[0]
    prior = F.lit(float(total if total is not None else 0.5))
    k_site = strength(sites, prior)
    sites = staged(sites.withColumn("_site_q", (F.col("_good") + k_site * prior) / (F.col("_docs") + k_site)).select("_site", "_site_q"), "site-levels")
    paths = paths.join(sites, "_site")
    k_path = strength(paths, "_site_q")
    levels = staged(
        paths.select("_site", "_path", "_site_q", ((F.col("_good") + k_path * F.col("_site_q")) / (F.col("_docs") + k_path)).alias("_path_q")),
        "path-levels",
    )
    final = F.col("_odds") + logit(F.col("_path_q")) - logit(prior)
    return scored.join(levels, ["_site", "_path"]).select(
        F.col("_id").alias(id_col), F.col("_p").alias("doc_quality"), F.col("_site_q").alias("site_quality"),
        F.col("_path_q").alias("path_quality"), (1 / (1 + F.exp(-final))).alias("quality"), (final >= float(np.log(threshold / (1 - threshold)))).alias("kept"),
    )


def op2_site_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Over ``documents``: the source is the site, its languages the paths."""
    return judge_sites(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), F.col("source"), F.col("lang"))
