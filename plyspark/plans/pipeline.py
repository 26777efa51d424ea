"""M11/M12: the batch refresh as layers over a versioned store.

raw: feed scan -> selection -> games as arrays of plies -> raw tables
intermediate: ply features, opening sequences, rating trajectories
marts: match facts, player and opening dimensions
checks: the report of what was observed while the tables were written

Every layer writes new versions of its tables and then makes them current all
at once (``sources.store``). One that fails leaves the old tables readable; the
same run started again skips the layers and tables that it finished. Each
layer can also be run by itself over what is stored.

The JSON is parsed once. Games stay arrays of plies (``operators.game_arrays``),
so a refresh joins, windows and shuffles no plies; only a feed that holds a game
twice takes the joined path, in which such games fan out.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import dataclass, field
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plyspark.functions.scalar import DEFAULT_PERF
from plyspark.operators.checks import PIPELINE_RULES, Rule, failed, observed, repeated_values, report_of, run_checks, unique
from plyspark.operators.features import move_features
from plyspark.operators.game_arrays import (
    evals_table,
    facts_from_arrays,
    features_from_arrays,
    games_table,
    moves_table,
    openings_from_arrays,
    parse_game_arrays,
)
from plyspark.operators.marts import match_facts, opening_dim, player_dim, short_ids
from plyspark.operators.openings import opening_patterns
from plyspark.operators.staging import is_timed, stage_games, stage_moves, staged_columns
from plyspark.operators.trajectories import player_games, rating_trajectories
from plyspark.plans.views import create_views, point_table
from plyspark.schemas import CHECK_REPORT_SCHEMA, GAMES_SCHEMA, RAW_SCHEMAS
from plyspark.session import ensure_conf, scratch_path, sized_for
from plyspark.sources.feed import is_analysed, latest_games, perf_types_for, played_by, read_feed_lines
from plyspark.sources.store import Load, Store
from plyspark.sources.tables import GAME_BUCKET_BY, GAME_SORT_BY, RAW_TABLES, write_csv

LAYERS = ("raw", "intermediate", "marts", "checks")
LAYER_TABLES = {
    "raw": RAW_TABLES,
    "intermediate": ("move_features", "opening_patterns", "rating_trajectories"),
    "marts": ("match_facts", "player_dim", "opening_dim"),
    "checks": ("checks",),
}
_SORT = {**GAME_SORT_BY, "move_features": ["game_id", "move_offset"], "opening_patterns": ["game_id"]}


def build_models(raw: dict[str, DataFrame], co_partition: bool = True) -> dict[str, DataFrame]:
    """All models from the three raw tables, as lazy DataFrames
    (``co_partition``: see ``stage_moves``)."""
    stg_games = stage_games(raw["games"])
    stg_moves = stage_moves(raw["moves"], raw["move_evals"], co_partition)
    features = move_features(stg_moves)
    openings = opening_patterns(stg_moves, stg_games)
    trajectories = rating_trajectories(stg_games)
    facts = match_facts(stg_games, features, openings)
    return {
        "stg_games": stg_games,
        "stg_moves": stg_moves,
        "move_features": features,
        "opening_patterns": openings,
        "rating_trajectories": trajectories,
        "match_facts": facts,
        "player_dim": player_dim(player_games(stg_games)),
        "opening_dim": opening_dim(facts),
    }


class BadLines(ValueError):
    """The feed has more lines that are no game than allowed."""


@dataclass
class PipelineResult:
    """The stored tables of a refresh, and its check report."""

    store: Store
    run: str
    report: DataFrame

    @property
    def out_dir(self) -> str:
        return self.store.base

    @property
    def tables(self) -> dict[str, DataFrame]:
        """The three raw tables."""
        return {name: self.store.read(name) for name in RAW_TABLES}

    def read(self, name: str) -> DataFrame:
        return self.store.read(name)

    def failures(self) -> DataFrame:
        return failed(self.report)


@dataclass
class Refresh:
    """One run over a store: which feed, which games, how to write."""

    spark: SparkSession
    out_dir: str
    feed_path: str | None = None
    perf: str = DEFAULT_PERF
    max_games: int | None = None
    game_id: str | None = None
    username: str | None = None
    ingested_at: datetime | None = None
    csv_dir: str | None = None
    label: str | None = None
    rules: list[Rule] | None = None
    strict: bool = False
    multiline: bool = False
    max_bad_lines: int = 0
    game_buckets: int | None = None
    table_prefix: str = "plyspark"
    run_id: str | None = None
    store: Store = field(init=False)

    def __post_init__(self) -> None:
        ensure_conf(self.spark)
        now = self.ingested_at or datetime.now(timezone.utc)
        self.ingested_at = now
        self.run_id = self.run_id or f"{datetime.now(timezone.utc):%Y%m%d%H%M%S}-{uuid.uuid4().hex[:8]}"
        self.rules = PIPELINE_RULES if self.rules is None else self.rules
        self.store = Store(self.spark, self.out_dir)

    # --- writing ------------------------------------------------------------

    def _write(self, load: Load, name: str, make: Callable[[], DataFrame], metrics: dict | None = None) -> DataFrame:
        """Write one table and observe its rules; count repeated values of its
        unique columns on the stored columns."""
        buckets = {}
        if self.game_buckets and name in _SORT:
            buckets = {"buckets": self.game_buckets, "by": GAME_BUCKET_BY, "sort": _SORT[name], "catalog": f"{self.table_prefix}_{name}"}
        df = load.write(name, make, RAW_SCHEMAS.get(name), {**observed(self.rules, name), **(metrics or {})}, **buckets)
        self._count_repeats(load, name, name, df)
        return df

    def _count_repeats(self, load: Load, table: str, held_by: str, df: DataFrame) -> None:
        for rule in self.rules:
            if rule.table == table and rule.kind == "unique":
                found = {**load.entry(held_by).get("repeats", {}), rule.key: repeated_values(df, rule.column)}
                load.keep(held_by, repeats=found)

    def _publish(self, layer: str) -> None:
        """Point the catalog's tables at the current versions."""
        for name in LAYER_TABLES[layer]:
            entry = self.store.entry(name)
            df = self.store.open(entry)  # a bucketed one is registered by this
            if not entry.get("buckets"):
                point_table(self.spark, f"{self.table_prefix}_{name}", entry["path"], df.schema)
        if layer == "raw":
            create_views(self.spark, self.table_prefix)

    # --- layers ---------------------------------------------------------------

    def _feed(self) -> DataFrame:
        """The wanted games as arrays of plies, and the bad lines."""
        lines = read_feed_lines(self.spark, self.feed_path, self.multiline)
        if self.game_id is not None:
            wanted = F.col("id") == self.game_id
        else:
            wanted = F.col("perf").isin(perf_types_for(self.perf))
            if self.username is not None:
                wanted &= played_by(self.username)
        bad = F.col("bad_line").isNotNull()
        usable = (~bad & is_analysed()).alias("usable")
        return parse_game_arrays(lines.where(bad | wanted), self.ingested_at, "bad_line", "bad_file", usable)

    def raw(self) -> None:
        load = self.store.load(self.run_id)
        good = F.col("bad_line").isNull()
        feed = load.write("feed", self._feed, partition_by=["usable"], metrics={
            "bad": F.count_if(~good), "parsed": F.count_if(good), "usable": F.count_if(F.col("usable")),
        })
        seen = load.entry("feed")["metrics"]
        if seen.get("bad", 0) > self.max_bad_lines:
            some = feed.where(~good).select("bad_file", "bad_line").limit(5).collect()
            raise BadLines(f"{seen['bad']} lines are no games: " + "; ".join(f"{r.bad_file}: {r.bad_line[:80]}" for r in some))
        if self.game_id is not None and not seen.get("parsed"):
            raise ValueError(f"Game {self.game_id!r} not found.")
        if not seen.get("usable"):
            raise ValueError("Game has no computer analysis." if self.game_id is not None else "No analysed games found.")
        columns = [*GAMES_SCHEMA.fieldNames(), "plies"]
        if self.max_games is None or self.game_id is not None:
            part = feed.select(*columns)
            load.keep("game_arrays", **{**load.entry("feed"), "path": load.entry("feed")["path"] + "/usable=true",
                                        "rows": seen["usable"], "schema": part.schema.jsonValue()})
        else:
            newest = lambda: latest_games(feed.where(good), self.max_games, "created_at", "game_id").where("usable")
            load.write("game_arrays", lambda: newest().select(*columns))
            if not load.entry("game_arrays")["rows"]:
                raise ValueError("No analysed games found.")
        load.write("quarantine", lambda: feed.where(~good).select("bad_file", "bad_line"))
        arrays = load.read("game_arrays")
        self._raw_tables(load, {"games": games_table(arrays), "moves": moves_table(arrays), "move_evals": evals_table(arrays)})

    def _raw_tables(self, load: Load, given: dict[str, DataFrame]) -> None:
        staged = observed(self.rules, "stg_games", staged_columns(), is_timed())
        more = {**staged, "short_ids": short_ids(), "null_ids": F.count_if(F.col("game_id").isNull())}
        raw = {name: self._write(load, name, lambda: df, more if name == "games" else None) for name, df in given.items()}
        self._count_repeats(load, "stg_games", "games", raw["games"].where(is_timed()))
        known = load.entry("games").get("repeats", {}).get(unique("games", "game_id").key)
        load.keep("games", repeated_ids=repeated_values(raw["games"], "game_id") if known is None else known)
        if self.csv_dir is not None:
            for name in RAW_TABLES:
                write_csv(raw[name], self.csv_dir, self.label or self.username or self.game_id or "export", name)
        load.commit("raw")

    def given(self, raw: dict[str, DataFrame]) -> None:
        """The raw layer from three given tables in place of a feed."""
        load = self.store.load(self.run_id)
        load.keep("game_arrays", run=self.run_id, rows=0, folder="", path=None)  # those of an older feed don't belong to them
        self._raw_tables(load, raw)

    def _joined(self, load: Load) -> bool:
        """Whether models take joins: no arrays, or games that are not told
        apart by their identifier."""
        games = load.entry("games")
        return not load.entry("game_arrays")["path"] or games["repeated_ids"] + games["metrics"].get("null_ids", 0) > 0

    def intermediate(self) -> None:
        load = self.store.load(self.run_id)
        stg_games = stage_games(load.read("games"))
        if self._joined(load):
            stg_moves = stage_moves(load.read("moves"), load.read("move_evals"), not self.game_buckets)
            # The stored features have each staged ply, so plies and evaluations are joined once.
            features, openings = lambda: move_features(stg_moves), lambda: opening_patterns(load.read("move_features"), stg_games)
        else:
            arrays = load.read("game_arrays")
            features, openings = lambda: features_from_arrays(arrays), lambda: openings_from_arrays(arrays)
        # Staged plies are the features' rows without the computed columns.
        self._write(load, "move_features", features, observed(self.rules, "stg_moves"))
        self._write(load, "opening_patterns", openings)
        self._write(load, "rating_trajectories", lambda: rating_trajectories(stg_games))
        load.commit("intermediate")

    def marts(self) -> None:
        load = self.store.load(self.run_id)
        if self._joined(load):
            stg_games = stage_games(load.read("games"))
            facts = lambda: match_facts(stg_games, load.read("move_features"), load.read("opening_patterns"))
        else:
            facts = lambda: facts_from_arrays(load.read("game_arrays"))
        stored_facts = self._write(load, "match_facts", facts)
        short = load.entry("games")["metrics"].get("short_ids", True)
        self._write(load, "player_dim", lambda: player_dim(load.read("rating_trajectories"), short))
        self._write(load, "opening_dim", lambda: opening_dim(stored_facts))
        load.commit("marts")

    def checks(self) -> None:
        """The report from what was observed; rules that no load has seen are
        evaluated over the stored tables."""
        load = self.store.load(self.run_id)
        seen: dict[str, int] = {}
        for name, entry in self.store.manifest()["tables"].items():
            seen |= entry.get("metrics", {}) | entry.get("repeats", {})
            if entry["rows"] == 0:  # nothing was observed of no rows
                models = {name, *{"games": ["stg_games"], "move_features": ["stg_moves"]}.get(name, [])}
                seen |= {r.key: 0 for r in self.rules if r.table in models and r.key not in seen}
        late = [r for r in self.rules if r.key not in seen]
        if late:
            tables = {r.table: self._model(load, r.table) for r in late}
            named = {(r.table, r.column, r.label): r.key for r in late}
            for row in run_checks(self.spark, tables, late).collect():
                seen[named[row["table_name"], row["column_name"], row["rule"]]] = row["failures"]
        report = report_of(self.spark, self.rules, seen)
        self._write(load, "checks", lambda: report.coalesce(1))
        load.commit("checks")

    def _model(self, load: Load, name: str) -> DataFrame:
        if name == "stg_games":
            return stage_games(load.read("games"))
        if name == "stg_moves":
            return stage_moves(load.read("moves"), load.read("move_evals"), not self.game_buckets)
        return load.read(name)

    def _input_bytes(self, layer: str) -> int:
        """Bytes of the feed, or of the raw tables."""
        files = self.store.files
        if layer == "raw":
            return files.size(self.feed_path) if self.feed_path else 0
        return sum(files.size(self.store.entry(name)["path"]) for name in RAW_TABLES)

    def run(self, layers: tuple[str, ...] = LAYERS, raw: dict[str, DataFrame] | None = None) -> PipelineResult:
        for layer in layers:
            if self.store.manifest()["layers"].get(layer) != self.run_id:
                with sized_for(self.spark, self._input_bytes(layer)):
                    self.given(raw) if layer == "raw" and raw is not None else getattr(self, layer)()
            self._publish(layer)
        names = self.store.names()
        report = self.store.read("checks") if "checks" in names else self.spark.createDataFrame([], CHECK_REPORT_SCHEMA)
        if self.strict and "checks" in layers and not failed(report).isEmpty():
            raise ValueError("data checks failed")
        return PipelineResult(self.store, self.run_id, report)


def run_pipeline(spark: SparkSession, feed_path: str, out_dir: str, keep: int = 2, **options) -> PipelineResult:
    """Run one full refresh; every table under ``out_dir`` is replaced.

    ``options`` (fields of ``Refresh``): ``perf``, ``max_games`` (all, unless
    given), ``game_id`` for one game, ``username`` for one user's games,
    ``ingested_at``, ``csv_dir`` and ``label`` for CSV files of the raw tables,
    ``rules``, ``strict`` (raise when a check fails), ``multiline``,
    ``max_bad_lines`` (lines that are no games beyond it fail the load; the
    others go to the table ``quarantine``), ``table_prefix`` of the catalog's
    tables and views, ``run_id`` to go on with a run that failed.

    With ``game_buckets`` the game-keyed tables are written bucketed and sorted
    by game (one bucket count for all), so ply joins, per-game windows and
    aggregates and fact joins over them run without any shuffle. Choose the
    bucket count so one ply bucket is a few hundred MB at the target scale.

    Versions that the last ``keep`` refreshes don't use are deleted. A feed
    without a usable game raises, and the old tables stay.
    """
    result = Refresh(spark, out_dir, feed_path, **options).run()
    result.store.expire((keep - 1) * len(LAYERS) + 1)  # the last state of each refresh
    return result


def refresh_from_tables(spark: SparkSession, raw: dict[str, DataFrame], out_dir: str, keep: int = 2, **options) -> PipelineResult:
    """A full refresh from given raw tables (``games``, ``moves``,
    ``move_evals``) in place of a feed; otherwise as ``run_pipeline``."""
    result = Refresh(spark, out_dir, **options).run(raw=raw)
    result.store.expire((keep - 1) * len(LAYERS) + 1)
    return result


def check_models(spark: SparkSession, raw: dict[str, DataFrame], rules: list[Rule] | None = None, co_partition: bool = True) -> DataFrame:
    """The check report of all models over given raw tables, without a refresh.

    The ply features and the facts, which most rules and models stand on, are
    computed once each: their row-level rules are observed while they are
    written to scratch tables, and what else is checked reads those. The
    scratch tables are deleted before the report is returned.
    """
    rules = PIPELINE_RULES if rules is None else rules
    store = Store(spark, scratch_path(spark, f"plyspark_checks/{uuid.uuid4().hex}"))
    load = store.load("checks")
    stg_games = stage_games(raw["games"])
    features = move_features(stage_moves(raw["moves"], raw["move_evals"], co_partition))
    of_plies = {"stg_moves", "move_features"} & {r.table for r in rules}
    tables = {**raw, "stg_games": stg_games}
    if of_plies:
        watched = {**observed(rules, "stg_moves"), **observed(rules, "move_features")}
        tables |= dict.fromkeys(of_plies, load.write("move_features", lambda: features, metrics=watched))
    facts = load.write(
        "match_facts", lambda: match_facts(stg_games, features, opening_patterns(raw["moves"], stg_games)), metrics=observed(rules, "match_facts")
    )
    seen = {key: n for entry in load.entries.values() for key, n in entry["metrics"].items()}
    held = {"match_facts", *of_plies}
    late = [r for r in rules if r.key not in seen and (r.table not in held or r.kind == "unique")]
    tables |= {"match_facts": facts, "player_dim": player_dim(player_games(stg_games)), "opening_dim": opening_dim(facts)}
    named = {(r.table, r.column, r.label): r.key for r in late}
    if late:
        for row in run_checks(spark, tables, late).collect():  # a row a rule
            seen[named[row["table_name"], row["column_name"], row["rule"]]] = row["failures"]
    store.files.delete(store.base)
    return report_of(spark, rules, {r.key: seen.get(r.key, 0) for r in rules})


def run_layer(spark: SparkSession, out_dir: str, layer: str, **options) -> PipelineResult:
    """Run one layer (not ``raw``) again over the stored tables."""
    if layer not in LAYERS[1:]:
        raise ValueError(f"no layer {layer!r} that runs over stored tables")
    return Refresh(spark, out_dir, **options).run((layer,))
