"""Quality rules as weak supervision, in DataFrame functions alone.

Each rule votes for a document, against it, or abstains. Expectation
maximisation over the counts of vote patterns estimates how reliable each
rule's votes are, and a document's posterior quality probability decides,
instead of all rules having to pass.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from plyspark.llm.common import WORD_RE, staged, table

WINDOW = 5
SYMBOL_RE = r"[#*$%&|<>]"
SEPARATOR_RE = r"[ \t-\r]+"
#: Share of good documents that the first step of the estimation assumes.
PRIOR = 0.85
STEPS = 200
START = (0.97, 0.3)


@dataclass(frozen=True)
class Rule:
    """Votes for at or under ``good``, against at or over ``bad`` (or the
    other way round where ``good`` is the larger one)."""

    name: str
    value: str
    good: float
    bad: float


#: Values are SQL over the columns of ``base_features``; ratios of empty texts are null, so the rule abstains.
RULES = (
    Rule("length", "n_words", 50, 20),
    Rule("word_length_low", "word_chars / nullif(n_words, 0)", 3.5, 2.5),
    Rule("word_length_high", "word_chars / nullif(n_words, 0)", 8.0, 11.0),
    Rule("symbols", "n_symbols / nullif(word_chars, 0)", 0.005, 0.03),
    Rule("symbol_words", "n_symbol_words / nullif(n_words, 0)", 0.01, 0.1),
    Rule("symbol_lines", "n_symbol_lines / nullif(n_lines, 0)", 0.1, 0.5),
    Rule("dup_lines", "n_dup_lines / nullif(n_lines, 0)", 0.05, 0.4),
    Rule("repeats", "n_repeat_words / nullif(n_words, 0)", 0.02, 0.18),
    Rule("sentence_words", "n_words / (1.0 + n_stops)", 25, 60),
    Rule("distinct_words", "n_distinct / nullif(n_words, 0) * sqrt(greatest(n_words, 100) / 100)", 0.5, 0.3),
)


def base_features(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` with counts of its whole texts; null text has no words."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    step = docs.withColumn("_text", text)
    step = step.withColumn("_words", F.filter(F.split("_text", SEPARATOR_RE), lambda w: w != ""))
    step = step.withColumn("_hash", F.transform("_words", lambda w: F.xxhash64(w)))
    step = step.withColumn("_lines", F.filter(F.split("_text", "\n"), lambda x: x.rlike(WORD_RE)))
    step = step.select(
        *docs.columns,
        F.size("_words").cast("long").alias("n_words"),
        F.char_length(F.array_join("_words", "")).cast("long").alias("word_chars"),
        F.regexp_count("_text", F.lit(SYMBOL_RE)).cast("long").alias("n_symbols"),
        F.regexp_count("_text", F.lit(r"[.!?](?=\s|$)")).cast("long").alias("n_stops"),
        F.size("_lines").cast("long").alias("n_lines"),
        F.size(F.filter("_words", lambda w: w.rlike(SYMBOL_RE))).cast("long").alias("n_symbol_words"),
        F.size(F.filter("_lines", lambda x: x.rlike(SYMBOL_RE))).cast("long").alias("n_symbol_lines"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
        F.size(F.array_distinct("_hash")).cast("long").alias("n_distinct"),
        F.when(
            F.size("_hash") >= WINDOW,
            F.transform(
                F.sequence(F.lit(1), F.size("_hash") - (WINDOW - 1)),
                lambda i: F.xxhash64(F.slice("_hash", i, F.lit(WINDOW))),
            ),
        ).otherwise(F.array().cast("array<bigint>")).alias("_windows"),
    )
    repeats = F.size(F.array_distinct("_windows")) < F.size("_windows")
    tagged = F.sort_array(F.transform("_windows", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    step = step.withColumn("_tagged", F.when(repeats, tagged))
    twice = F.filter(
        "_tagged",
        lambda x, i: (F.get("_tagged", i - 1)["h"] == x["h"]) | (F.get("_tagged", i + 1)["h"] == x["h"]),
    )
    places = F.sort_array(F.transform(twice, lambda x: x["i"]))
    covered = F.aggregate(
        places,
        F.struct(F.lit(0).alias("sum"), F.lit(-WINDOW).alias("last")),
        lambda acc, i: F.struct((acc["sum"] + F.least(i - acc["last"], F.lit(WINDOW))).alias("sum"), i.alias("last")),
        lambda acc: acc["sum"].cast("long"),
    )
    return step.withColumn("n_repeat_words", F.coalesce(covered, F.lit(0).cast("long"))).drop("_windows", "_tagged")


def base_failed() -> Column:
    return (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))


def vote(rule: Rule) -> Column:
    """1 for, -1 against, 0 abstains."""
    value = F.expr(f"CAST({rule.value} AS DOUBLE)")
    if rule.good < rule.bad:
        yes, no = value <= rule.good, value >= rule.bad
    else:
        yes, no = value >= rule.good, value <= rule.bad
    return F.when(yes, 1).when(no, -1).otherwise(0)


def estimate(patterns: list[tuple[tuple[int, ...], int]], prior: float = PRIOR, steps: int = STEPS):
    """``(share of good documents, [(P(for | good, votes), P(against | bad, votes))])``
    by expectation maximisation over vote patterns and their counts. A rule
    looks for one kind of bad text, so at the start it is mostly right about
    good documents and sees three in ten of the bad ones (``START``, with the
    weight of a thousandth of all documents); it stays better than chance."""
    rules = len(patterns[0][0]) if patterns else 0
    total = sum(n for _, n in patterns)
    share, right = prior, [START] * rules
    weight = 1 + total / 1000
    for _ in range(steps if total else 0):
        sums = [[START[0] * weight, weight, START[1] * weight, weight] for _ in range(rules)]
        good = 0.0
        for votes, n in patterns:
            odds = math.log(share / (1 - share)) + sum(evidence(r, v) for r, v in zip(right, votes))
            p = 1 / (1 + math.exp(-max(-700.0, min(700.0, odds))))
            good += n * p
            for s, v in zip(sums, votes):
                if v:
                    s[0] += n * p * (v > 0)
                    s[1] += n * p
                    s[2] += n * (1 - p) * (v < 0)
                    s[3] += n * (1 - p)
        share = min(0.99, max(0.01, good / total))
        right = [
            (max(min(a / b, 0.999), 1.02 - min(0.99, max(0.02, c / d))), min(0.99, max(0.02, c / d))) for a, b, c, d in sums
        ]
        right = [(min(a, 0.999), c) for a, c in right]
    return share, right


def evidence(right: tuple[float, float], v: int) -> float:
    """Log odds that a vote adds."""
    a, b = right
    return math.log(a / (1 - b)) if v > 0 else math.log((1 - a) / b) if v < 0 else 0.0


def judge(docs: DataFrame, text_col: str = "text", rules: tuple[Rule, ...] = RULES, threshold: float = 0.5) -> DataFrame:
    """``docs``'s columns without its text, the base counts, ``base_failed``,
    ``quality`` (posterior probability) and ``kept``.

    Every row is judged by itself, repeated ones alike. A null or empty text
    has no words and fails. The table of vote patterns has at most ``3 **
    rules`` rows and is all that reaches the driver. A column of ``docs``
    named like one of the results is replaced by it. No rows give no rows.
    """
    results = {"n_words", "word_chars", "n_symbols", "n_stops", "n_lines", "n_symbol_words", "n_symbol_lines", "n_dup_lines", "n_distinct", "n_repeat_words",
               "base_failed", "quality", "kept"}
    rest = [c for c in docs.columns if c != text_col and c not in results]
    given = F.struct(F.lit(0).alias("_"), *[F.col(c).alias(f"c{k}") for k, c in enumerate(rest)]).alias("_given")
    features = base_features(docs.select(given, F.col(text_col).alias("_in")), "_in").drop("_in")
    counted = staged(features.withColumn("_votes", F.array(*[vote(r) for r in rules])), "rule-votes")
    patterns = [(tuple(r["_votes"]), r["n"]) for r in counted.groupBy("_votes").agg(F.count(F.lit(1)).alias("n")).collect()]
    share, right = estimate(sorted(patterns))
    odds = F.lit(math.log(share / (1 - share)))
    for k, r in enumerate(right):
        v = F.col("_votes")[k]
        odds = odds + F.when(v > 0, evidence(r, 1)).when(v < 0, evidence(r, -1)).otherwise(0.0)
    judged = (
        counted.withColumn("base_failed", base_failed())
        .withColumn("quality", 1 / (1 + F.exp(-odds)))
        .withColumn("kept", ~F.col("base_failed") & (F.col("quality") >= threshold))
    )
    made = [c for c in judged.columns if c not in ("_given", "_votes")]
    return judged.select(*[F.col(f"_given.c{k}").alias(c) for k, c in enumerate(rest)], *made)


def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return judge(docs)
