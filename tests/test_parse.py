import json
import os

import pytest
from pyspark.sql import functions as F

from plyspark.operators.parse import parse_games
from plyspark.plans.pipeline import run_pipeline
from plyspark.sources import adapter
from plyspark.sources.feed import analysed_only, latest_games, read_feed, select_perf
from plyspark.schemas import EVALS_SCHEMA, GAMES_SCHEMA, MOVES_SCHEMA
from tests.conftest import SF_SMALL

TS = "2026-06-11 00:42:39"


def _player(name, rating=1500, diff=5, acc=80.0):
    p = {"rating": rating, "ratingDiff": diff, "analysis": {"accuracy": acc}}
    if name is not None:
        p["user"] = {"name": name}
    return p


def _game(gid, **kw):
    g = {
        "id": gid, "winner": "white", "status": "mate", "perf": "rapid", "variant": "standard",
        "createdAt": 1_700_000_000_000, "lastMoveAt": 1_700_000_600_000,
        "moves": "e4 e5 Nf3", "players": {"white": _player("Alice"), "black": _player("Bob")},
        "clock": {"initial": 600, "increment": 5},
        "opening": {"eco": "C20", "name": "King's Pawn", "ply": 2},
        "analysis": [{"eval": 0.3}, {"eval": 0.2, "judgment": {"name": "Inaccuracy"}},
                     {"mate": 3, "best": "Qh5", "variation": "Qh5 g6"}],
        "clocks": [60000, 59000, 45670],
    }
    g.update(kw)
    return {k: v for k, v in g.items() if v is not _DROP}


_DROP = object()


def _write(scratch, lines):
    path = os.path.join(scratch, "feed.ndjson")
    with open(path, "w") as fh:
        fh.write("\n".join(lines) + "\n")
    return path


def _parse(spark, path):
    feed = read_feed(spark, path)
    return parse_games(feed, F.lit(TS).cast("timestamp"))


def test_edge_lines(spark, scratch):
    lines = [
        json.dumps(_game("full")),
        "",
        json.dumps(_game("anon", players={"white": _player("Alice"), "black": _player(None)})),
        json.dumps(_game("noclock", clock=_DROP)),
        json.dumps(_game("nomoves", moves=_DROP)),
        json.dumps(_game("blankmoves", moves="  ")),
        json.dumps(_game("short", analysis=[{"eval": 1.0}], clocks=[100])),
        json.dumps(_game("noopening", opening=_DROP)),
        json.dumps(_game("unanalysed", analysis=_DROP)),
        json.dumps(_game("emptyanalysis", analysis=[])),
    ]
    path = _write(scratch, lines)
    feed = read_feed(spark, path)
    assert feed.count() == 9  # blank line skipped
    kept = {r.id for r in analysed_only(feed).collect()}
    assert "unanalysed" not in kept and "emptyanalysis" not in kept and len(kept) == 7

    games, moves, evals = parse_games(feed, F.lit(TS).cast("timestamp"))
    g = {r.game_id: r for r in games.collect()}
    assert g["noclock"].time_control_initial == 0 and g["noclock"].time_control_increment == 0
    assert g["noopening"].opening_eco is None and g["noopening"].opening_ply is None
    assert g["anon"].black_username is None
    m = moves.collect()
    per_game = {}
    for r in m:
        per_game.setdefault(r.game_id, []).append(r)
    assert "nomoves" not in per_game and "blankmoves" not in per_game
    anon_black = [r for r in per_game["anon"] if r.color == "black"]
    assert anon_black and all(r.username is None for r in anon_black)
    full = sorted(per_game["full"], key=lambda r: r.move_offset)
    assert [(r.move_offset, r.move_number, r.color, r.username, r.move_san) for r in full] == [
        (0, 1, "white", "Alice", "e4"), (1, 1, "black", "Bob", "e5"), (2, 2, "white", "Alice", "Nf3")]

    e = {(r.game_id, r.move_offset): r for r in evals.collect()}
    assert e[("full", 1)].judgment == "Inaccuracy"
    assert e[("full", 2)].eval_score is None and e[("full", 2)].mate_in == 3
    assert e[("full", 2)].best_move == "Qh5" and e[("full", 2)].time_left_ratio == round(456.7 / 600, 4)
    assert e[("full", 0)].time_left_ratio == 1.0
    assert e[("short", 1)].eval_score is None and e[("short", 1)].time_left_cs is None
    assert e[("noclock", 0)].time_left_ratio is None and e[("noclock", 0)].time_left_cs == 60000
    assert {str(r.ingested_at) for r in games.collect()} == {TS}
    def shape(schema):
        return [(f.name, f.dataType) for f in schema.fields]

    assert shape(games.schema) == shape(GAMES_SCHEMA)
    assert shape(moves.schema) == shape(MOVES_SCHEMA)
    assert shape(evals.schema) == shape(EVALS_SCHEMA)


def test_all_unanalysed_fails(spark, scratch):
    path = _write(scratch, [json.dumps(_game("x", analysis=_DROP))])
    with pytest.raises(ValueError, match="No analysed games"):
        run_pipeline(spark, path, os.path.join(scratch, "out"))
    with pytest.raises(ValueError, match="No analysed games"):
        run_pipeline(spark, path, os.path.join(scratch, "out"), max_games=3)


def test_single_game_selection(spark, scratch):
    path = _write(scratch, [json.dumps(_game("a")), json.dumps(_game("b", analysis=_DROP))])
    out = os.path.join(scratch, "out")
    res = run_pipeline(spark, path, out, game_id="a")
    assert [r.game_id for r in res.read("match_facts").collect()] == ["a"]
    with pytest.raises(ValueError, match="not found"):
        run_pipeline(spark, path, out, game_id="zzz")
    with pytest.raises(ValueError, match="no computer analysis"):
        run_pipeline(spark, path, out, game_id="b")
    # an empty selection leaves the old tables
    assert [r.game_id for r in res.read("games").collect()] == ["a"]


def test_single_pretty_printed_document(spark, scratch):
    path = os.path.join(scratch, "one.json")
    with open(path, "w") as fh:
        json.dump(_game("solo"), fh, indent=2)
    feed = read_feed(spark, path, multiline=True)
    assert [r.id for r in feed.collect()] == ["solo"]


def test_perf_and_latest(spark, scratch):
    lines = [json.dumps(_game(f"g{i}", perf=p, createdAt=1_000 + i))
             for i, p in enumerate(["blitz", "rapid", "classical", "bullet", "rapid"])]
    feed = read_feed(spark, _write(scratch, lines))
    assert {r.id for r in select_perf(feed, "blitz").collect()} == {"g0"}
    assert {r.id for r in select_perf(feed, "rapid+classical").collect()} == {"g1", "g2", "g4"}
    assert {r.id for r in latest_games(select_perf(feed, "anything"), 2).collect()} == {"g4", "g2"}


def test_latest_games_by_threshold(spark):
    rows = [(5, "b"), (5, "a"), (None, "n"), (None, None), (7, "x"), (5, "c"), (5, "c"), (5, "c"), (3, None), (3, "q"), (-9, "z")]
    feed = spark.createDataFrame(rows, "createdAt long, id string")
    ranked = sorted(rows, key=lambda r: (r[0] is None, -(r[0] or 0), r[1] is not None, r[1] or ""))
    for n in range(len(rows) + 3):
        assert sorted(map(str, ((r.createdAt, r.id) for r in latest_games(feed, n).collect()))) == sorted(map(str, ranked[:n])), n


def test_latest_games_stay_where_they_are_read(spark):
    feed = read_feed(spark, adapter.stored_feed_path(spark, SF_SMALL))
    chosen = latest_games(feed, 100)
    assert chosen.count() == 100
    plan = chosen._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "TakeOrdered" not in plan and "Limit" not in plan


def test_nest_then_parse_gives_back_raw_tables(spark):
    """Raw rows nested into the JSON feed and parsed again are unchanged."""
    raw = adapter.stored_raw_tables(spark, SF_SMALL)
    feed = read_feed(spark, adapter.stored_feed_path(spark, SF_SMALL))
    games, moves, _ = parse_games(feed, F.lit(adapter.INGESTED_AT_TEXT).cast("timestamp"))
    assert games.exceptAll(raw["games"]).isEmpty() and raw["games"].exceptAll(games).isEmpty()
    assert moves.exceptAll(raw["moves"]).isEmpty() and raw["moves"].exceptAll(moves).isEmpty()
