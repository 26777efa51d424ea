"""M10: declarative data checks -> one report DataFrame.

Rule kinds (failures counted the way a failing-rows query counts them):

* ``not_null``        rows where the column is NULL
* ``accepted_values`` rows whose non-NULL value is outside the list
* ``accepted_range``  rows whose non-NULL value is outside [min, max]
                      (inclusive; either bound may be open)
* ``unique``          distinct non-NULL values that occur more than once

A refresh observes the row-level rules while it writes a table (``observed``)
and counts repeated values on the stored key column alone
(``repeated_values``), so no model is computed or read again for them.

For tables that are only given, ``run_checks`` evaluates the row-level rules of
each in a single aggregate pass (``count_if`` per rule), folded into the
table's ``unique`` pass when it has one; ``unique`` is a ``groupBy`` with
map-side partial counts, so a hot value never lands in one task unreduced.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from plyspark.schemas import CHECK_REPORT_SCHEMA


@dataclass(frozen=True)
class Rule:
    table: str
    column: str
    kind: str  # not_null | unique | accepted_values | accepted_range
    values: tuple = field(default=())
    min_value: float | None = None
    max_value: float | None = None

    @property
    def label(self) -> str:
        if self.kind == "accepted_values":
            return "accepted_values"
        if self.kind == "accepted_range":
            lo = "" if self.min_value is None else f"{self.min_value:g}"
            hi = "" if self.max_value is None else f"{self.max_value:g}"
            return f"accepted_range[{lo},{hi}]"
        return self.kind

    @property
    def key(self) -> str:
        """A name of its own for each rule."""
        return "|".join([self.table, self.column, self.label, *map(str, self.values)])


def not_null(table: str, column: str) -> Rule:
    return Rule(table, column, "not_null")


def unique(table: str, column: str) -> Rule:
    return Rule(table, column, "unique")


def accepted_values(table: str, column: str, values: list) -> Rule:
    return Rule(table, column, "accepted_values", values=tuple(values))


def accepted_range(table: str, column: str, min_value=None, max_value=None) -> Rule:
    return Rule(table, column, "accepted_range", min_value=min_value, max_value=max_value)


# ---------------------------------------------------------------------------
# The declared rules of the pipeline (20 instances).
# result: white, black, draw
# perf_type: blitz, rapid, classical, bullet, correspondence
# judgment: Blunder, Mistake, Inaccuracy, null (the text 'null')
# piece_type: pawn, knight, bishop, rook, queen, king
# ---------------------------------------------------------------------------
RESULTS = ["white", "black", "draw"]
PERF_TYPES = ["blitz", "rapid", "classical", "bullet", "correspondence"]
JUDGMENTS = ["Blunder", "Mistake", "Inaccuracy", "null"]
PIECES = ["pawn", "knight", "bishop", "rook", "queen", "king"]

PIPELINE_RULES: list[Rule] = [
    # raw sources
    unique("games", "game_id"),
    not_null("games", "game_id"),
    not_null("moves", "game_id"),
    not_null("moves", "move_offset"),
    not_null("move_evals", "game_id"),
    not_null("move_evals", "move_offset"),
    # staging
    unique("stg_games", "game_id"),
    not_null("stg_games", "game_id"),
    accepted_values("stg_games", "result", RESULTS),
    accepted_values("stg_games", "perf_type", PERF_TYPES),
    accepted_values("stg_moves", "judgment", JUDGMENTS),
    # intermediate
    accepted_values("move_features", "piece_type", PIECES),
    # marts
    unique("match_facts", "game_id"),
    not_null("match_facts", "game_id"),
    accepted_values("match_facts", "result", RESULTS),
    accepted_range("match_facts", "white_blunders", min_value=0),
    unique("player_dim", "username"),
    not_null("player_dim", "username"),
    accepted_range("player_dim", "win_rate", min_value=0, max_value=1),
    not_null("opening_dim", "opening_eco"),
]


def _failing(rule: Rule, c: Column | None = None) -> Column:
    c = F.col(rule.column) if c is None else c
    if rule.kind == "not_null":
        return c.isNull()
    if rule.kind == "accepted_values":
        return c.isNotNull() & ~c.isin(list(rule.values))
    if rule.kind == "accepted_range":
        conds = []
        if rule.min_value is not None:
            conds.append(c < F.lit(rule.min_value))
        if rule.max_value is not None:
            conds.append(c > F.lit(rule.max_value))
        if not conds:
            return F.lit(False)
        return c.isNotNull() & reduce(lambda a, b: a | b, conds)
    raise ValueError(f"not a row-level rule: {rule.kind}")


def observed(
    rules: list[Rule], table: str, made: dict[str, Column] | None = None, where: Column | None = None
) -> dict[str, Column]:
    """The row-level rules of ``table`` as named aggregates over rows being
    written. A table that is a projection of those rows gives its columns as
    ``made`` and its filter as ``where``."""
    out = {}
    for rule in rules:
        if rule.table == table and rule.kind != "unique":
            failing = _failing(rule, (made or {}).get(rule.column))
            out[rule.key] = F.count_if(F.coalesce(failing if where is None else where & failing, F.lit(False)))
    return out


def repeated_values(df: DataFrame, column: str) -> int:
    """Failures of a ``unique`` rule: distinct non-NULL values that occur more
    than once. Reads that column alone."""
    counts = df.where(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("_n"))
    return counts.agg(F.count_if(F.col("_n") > 1)).first()[0]


def report_of(spark: SparkSession, rules: list[Rule], failures: dict[str, int]) -> DataFrame:
    """The report from failures by ``Rule.key``."""
    rows = [(r.table, r.column, r.label, failures[r.key]) for r in rules]
    return spark.createDataFrame(rows, CHECK_REPORT_SCHEMA)


def _report_row(rule: Rule, failures: Column) -> list[Column]:
    return [
        F.lit(rule.table).alias("table_name"),
        F.lit(rule.column).alias("column_name"),
        F.lit(rule.label).alias("rule"),
        failures.cast("long").alias("failures"),
    ]


def _stack(rows: list[tuple[Rule, Column]]) -> Column:
    return F.explode(F.array(*[F.struct(*_report_row(r, c)) for r, c in rows])).alias("r")


def check_table(df: DataFrame, rules: list[Rule]) -> DataFrame:
    """Report for the rules of one table.

    The row-level rules and the first ``unique`` rule share one pass: a
    ``groupBy`` on the unique column (map-side partial counts) carries the
    per-key failure counts, which are then summed. Without a unique rule the
    row-level rules are one global aggregate. Further unique rules on other
    columns add one grouped pass each.
    """
    row_rules = [r for r in rules if r.kind != "unique"]
    uniques = [r for r in rules if r.kind == "unique"]
    parts: list[DataFrame] = []
    fails = [F.count_if(_failing(r)).alias(f"_f{i}") for i, r in enumerate(row_rules)]
    if uniques:
        key = uniques[0].column
        per_key = df.groupBy(key).agg(F.count(F.lit(1)).alias("_n"), *fails)
        totals = per_key.agg(
            F.count_if(F.col(key).isNotNull() & (F.col("_n") > 1)).alias("_u"),
            *[F.coalesce(F.sum(f"_f{i}"), F.lit(0)).alias(f"_f{i}") for i in range(len(row_rules))],
        )
        rows = [(uniques[0], F.col("_u"))] + [(r, F.col(f"_f{i}")) for i, r in enumerate(row_rules)]
        parts.append(totals.select(_stack(rows)).select("r.*"))
    elif row_rules:
        counts = df.agg(*fails)
        rows = [(r, F.col(f"_f{i}")) for i, r in enumerate(row_rules)]
        parts.append(counts.select(_stack(rows)).select("r.*"))
    for r in uniques[1:]:
        dupes = (
            df.where(F.col(r.column).isNotNull())
            .groupBy(r.column)
            .agg(F.count(F.lit(1)).alias("_n"))
            .where(F.col("_n") > 1)
        )
        parts.append(dupes.agg(*_report_row(r, F.count(F.lit(1)))))
    return reduce(DataFrame.unionByName, parts)


def run_checks(
    spark: SparkSession, tables: dict[str, DataFrame], rules: list[Rule] | None = None
) -> DataFrame:
    """One report row per rule: (table_name, column_name, rule, failures)."""
    rules = PIPELINE_RULES if rules is None else rules
    parts = []
    for name in dict.fromkeys(r.table for r in rules):
        if name not in tables:
            raise KeyError(f"no table named {name!r} for the checks")
        parts.append(check_table(tables[name], [r for r in rules if r.table == name]))
    if not parts:
        return spark.createDataFrame([], CHECK_REPORT_SCHEMA)
    return reduce(DataFrame.unionByName, parts)


def failed(report: DataFrame) -> DataFrame:
    return report.where(F.col("failures") > 0)
