import json
import os
import tempfile

import pytest
from pyspark.sql import functions as F

from plyspark.operators.checks import PIPELINE_RULES, accepted_range, not_null, run_checks, unique
from plyspark.operators.openings import opening_patterns
from plyspark.plans import pipeline
from plyspark.plans.pipeline import LAYERS, BadLines, build_models, check_models, run_layer, run_pipeline
from plyspark.sources import adapter
from plyspark.sources.store import Store
from plyspark.sources.tables import read_raw_csv
from tests.conftest import SF_SMALL


def _landed_feed(spark, scratch):
    """The fixture feed as one NDJSON file."""
    src = adapter.stored_feed_path(spark, SF_SMALL)
    path = os.path.join(scratch, "landing")
    spark.read.text(src).coalesce(1).write.mode("overwrite").text(path)
    return path


@pytest.fixture(scope="module")
def whole(spark):
    """One refresh over all games of the fixture."""
    scratch = tempfile.mkdtemp(prefix="plyspark-test-")
    return run_pipeline(spark, _landed_feed(spark, scratch), os.path.join(scratch, "out"), table_prefix="t_whole")


def _equal(a, b):
    return a.count() == b.count() and a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()


def _failures(report):
    return {(r.table_name, r.column_name, r.rule): r.failures for r in report.collect()}


def test_full_refresh(spark, scratch):
    feed = _landed_feed(spark, scratch)
    out, csv = os.path.join(scratch, "out"), os.path.join(scratch, "csv")
    res = run_pipeline(spark, feed, out, perf="rapid+classical", max_games=200, csv_dir=csv, label="fixture")
    report = _failures(res.report)
    assert len(report) == 20 and all(v == 0 for v in report.values())
    games = res.tables["games"]
    assert 0 < games.count() <= 200
    assert games.where(~F.col("perf_type").isin("rapid", "classical")).isEmpty()
    for name in ("move_features", "match_facts", "player_dim", "opening_dim"):
        assert res.read(name).count() > 0

    # one CSV file a table, under its name
    files = sorted(os.listdir(csv))
    assert len(files) == 3 and all(f.startswith("fixture_") and f.endswith(".csv") for f in files)
    for name in ("games", "moves", "move_evals"):
        path = os.path.join(csv, next(f for f in files if f.startswith(f"fixture_{name}_")))
        assert os.path.isfile(path) and _equal(read_raw_csv(spark, path, name), res.tables[name])

    # a one-game refresh replaces everything with that game
    one = games.orderBy("game_id").first().game_id
    res1 = run_pipeline(spark, feed, out, game_id=one)
    assert [r.game_id for r in res1.read("games").collect()] == [one]
    assert res1.failures().isEmpty()


def test_tables_equal_the_joined_models(spark, whole):
    """Arrays in the refresh, joins and windows in the models: the same rows."""
    res = whole
    models = build_models(res.tables)
    for name in ("move_features", "opening_patterns", "rating_trajectories", "match_facts", "player_dim", "opening_dim"):
        got, floats = res.read(name), [c for c, t in res.read(name).dtypes if t == "double"]
        rounded = {c: F.round(c, 9) for c in floats}
        assert got.columns == models[name].columns
        assert _equal(got.withColumns(rounded), models[name].withColumns(rounded)), name
    # what was observed is what a scan of all models finds
    tables = {**res.tables, **models}
    assert _failures(res.report) == _failures(run_checks(spark, tables, PIPELINE_RULES)) == _failures(check_models(spark, res.tables))


def test_checks_of_given_tables(spark, whole):
    """Observed on scratch tables or scanned: the same counts, also of faults."""
    k = F.hash("game_id")
    raw = {
        "games": whole.tables["games"].withColumns({
            "winner": F.when(k % 5 == 0, F.lit("x")).otherwise(F.col("winner")), "game_id": F.when(k % 7 != 0, F.col("game_id"))}),
        "moves": whole.tables["moves"],
        "move_evals": whole.tables["move_evals"].withColumn("judgment", F.when(k % 4 == 0, F.lit("Oops")).otherwise(F.col("judgment"))),
    }
    raw["games"] = raw["games"].unionByName(raw["games"].where(k % 3 == 0))
    rules = [*PIPELINE_RULES, accepted_range("match_facts", "total_plies", max_value=3)]
    got = _failures(check_models(spark, raw, rules))
    assert got == _failures(run_checks(spark, {**raw, **build_models(raw)}, rules)) and sum(v > 0 for v in got.values()) >= 6
    only = [r for r in PIPELINE_RULES if r.table == "games"]
    assert len(_failures(check_models(spark, raw, only))) == 2


def test_a_repeated_game_fans_out_as_the_joins_do(spark, scratch):
    path = os.path.join(scratch, "feed.ndjson")
    game = {"id": "g1", "perf": "rapid", "moves": "e4 e5", "clock": {"initial": 60}, "opening": {"eco": "A00", "name": "n", "ply": 1},
            "analysis": [{"eval": 1}, {"eval": 2}], "clocks": [10, 20]}
    with open(path, "w") as f:
        f.write("\n".join(json.dumps({**game, "id": i}) for i in ("g1", "g1", "g2")))
    res = run_pipeline(spark, path, os.path.join(scratch, "out"))
    assert res.read("move_features").where("game_id = 'g1'").count() == 8
    models = build_models(res.tables)
    assert _equal(res.read("match_facts"), models["match_facts"]) and _equal(res.read("opening_patterns"), models["opening_patterns"])
    assert {k for k, v in _failures(res.report).items() if v} == {
        ("games", "game_id", "unique"), ("stg_games", "game_id", "unique"), ("match_facts", "game_id", "unique")}


def test_killed_marts_keep_the_old_ones_and_go_on(spark, scratch, monkeypatch):
    feed, out = _landed_feed(spark, scratch), os.path.join(scratch, "out")
    run_pipeline(spark, feed, out, perf="blitz", table_prefix="t_killed")
    store = Store(spark, out)
    old = store.read("match_facts").count()

    def killed(*_):
        raise RuntimeError("killed")

    calls = []
    parse = pipeline.parse_game_arrays
    monkeypatch.setattr(pipeline, "parse_game_arrays", lambda *a: calls.append(1) or parse(*a))
    with monkeypatch.context() as m:
        m.setattr(pipeline, "opening_dim", killed)
        with pytest.raises(RuntimeError, match="killed"):
            run_pipeline(spark, feed, out, run_id="second", table_prefix="t_killed")
    assert store.read("match_facts").count() == old  # the marts stay together
    assert set(store.read("match_facts").select("perf_type").distinct().toPandas()["perf_type"]) == {"blitz"}
    assert store.manifest()["layers"]["intermediate"] == "second" != store.manifest()["layers"]["marts"]
    done = store.files.read(f"{out}/tables/match_facts/second.done.json")

    res = run_pipeline(spark, feed, out, run_id="second", table_prefix="t_killed")
    assert len(calls) == 1  # raw was not run again
    assert store.files.read(f"{out}/tables/match_facts/second.done.json") == done  # nor the fact table
    assert set(res.read("match_facts").select("perf_type").distinct().toPandas()["perf_type"]) == {"rapid", "classical"}
    assert set(store.manifest()["layers"].values()) == {"second"}


def test_one_layer_alone_and_old_versions(spark, scratch):
    feed, out = _landed_feed(spark, scratch), os.path.join(scratch, "out")
    first = run_pipeline(spark, feed, out, max_games=50, run_id="first")
    again = run_layer(spark, out, "marts", run_id="again")
    assert again.store.entry("match_facts")["run"] == "again" and again.store.entry("games")["run"] == "first"
    report = run_layer(spark, out, "checks", rules=[*PIPELINE_RULES, not_null("stg_games", "white_username"),
                                                    unique("moves", "game_id"), accepted_range("match_facts", "total_plies", max_value=2)]).report
    late = _failures(report)
    assert len(late) == 23 and late["moves", "game_id", "unique"] > 0 and late["match_facts", "total_plies", "accepted_range[,2]"] > 0
    with pytest.raises(ValueError):
        run_layer(spark, out, "raw")
    # versions that nothing current uses go, the others stay
    files = first.store.files
    assert files.exists(f"{out}/tables/match_facts/first")
    assert f"{out}/tables/match_facts/first" in first.store.expire(1)
    assert not files.exists(f"{out}/tables/match_facts/first.done.json") and files.exists(f"{out}/tables/games/first")
    assert len(first.store._manifests()) == 1 and again.read("match_facts").count() > 0


def test_three_refreshes_keep_two(spark, scratch):
    store = Store(spark, os.path.join(scratch, "out"))
    for run in "abc":
        for layer in LAYERS:
            load = store.load(run)
            load.write(f"of_{layer}", lambda run=run: spark.range(ord(run)), metrics={"top": F.max("id")})
            load.commit(layer)
    store.expire(len(LAYERS) + 1)
    assert [n for n in store.files.names(f"{store.base}/tables/of_raw") if not n.endswith(".json")] == ["b", "c"]
    assert len(store._manifests()) == len(LAYERS) + 1
    assert store.entry("of_raw")["rows"] == ord("c") and store.entry("of_raw")["metrics"] == {"top": ord("c") - 1}


def test_two_loads_cannot_take_one_place(spark, scratch):
    store = Store(spark, os.path.join(scratch, "out"))
    store.files.write(f"{scratch}/out/_manifest/00000001.json", "{}")
    with pytest.raises(FileExistsError):
        store.files.write(f"{scratch}/out/_manifest/00000001.json", "{}")
    with pytest.raises(KeyError, match="no table"):
        Store(spark, os.path.join(scratch, "none")).read("games")


def test_bad_lines_are_named_and_kept_apart(spark, scratch):
    path, out = os.path.join(scratch, "bad.ndjson"), os.path.join(scratch, "out")
    good = [json.dumps({"id": f"g{i}", "perf": "rapid", "moves": "e4", "analysis": [{"eval": 1}], "clock": {"initial": 60}}) for i in range(4)]
    bad = ['{"id": "g8", "pe', "no json", '{"id": "g9", "perf": "rapid", "createdAt": "soon"}']
    with open(path, "w") as f:
        f.write("\n".join([good[0], bad[0], "", good[1], bad[1], good[2], bad[2], good[3]]))
    with pytest.raises(BadLines, match="3 lines") as error:
        run_pipeline(spark, path, out)
    assert all(line in str(error.value) for line in bad) and "bad.ndjson" in str(error.value)
    assert Store(spark, out).names() == []
    res = run_pipeline(spark, path, out, max_bad_lines=3)
    assert {r.bad_line for r in res.read("quarantine").collect()} == set(bad)
    assert {r.game_id for r in res.read("match_facts").collect()} == {f"g{i}" for i in range(4)}


def test_failures_are_observed(spark, scratch):
    path = os.path.join(scratch, "feed.ndjson")
    game = {"perf": "rapid", "moves": "e4 e5", "analysis": [{"judgment": {"name": "Oops"}}, {}], "clock": {"initial": 60}}
    games = [{**game, "id": "a", "winner": "nobody"}, {**game, "id": None}, {**game, "id": "c", "clock": {"initial": 0}}]
    with open(path, "w") as f:
        f.write("\n".join(json.dumps(g) for g in games))
    res = run_pipeline(spark, path, os.path.join(scratch, "out"))
    assert {k: v for k, v in _failures(res.report).items() if v} == {
        ("games", "game_id", "not_null"): 1, ("moves", "game_id", "not_null"): 2, ("move_evals", "game_id", "not_null"): 2,
        ("stg_games", "game_id", "not_null"): 1, ("stg_games", "result", "accepted_values"): 1,
        ("stg_moves", "judgment", "accepted_values"): 2, ("match_facts", "game_id", "not_null"): 1,
        ("match_facts", "result", "accepted_values"): 1,
    }
    with pytest.raises(ValueError, match="checks failed"):
        run_pipeline(spark, path, os.path.join(scratch, "out"), strict=True)


def test_views_outlive_the_session(spark, whole):
    from plyspark.operators.staging import stage_games, stage_moves

    other, raw = spark.newSession(), whole.tables
    for name, df in [("stg_games", stage_games(raw["games"])), ("stg_moves", stage_moves(raw["moves"], raw["move_evals"]))]:
        seen = other.table(f"t_whole_{name}")
        assert seen.columns == df.columns
        assert sorted(map(str, seen.collect())) == sorted(map(str, df.collect()))
    assert other.table("t_whole_match_facts").count() == whole.read("match_facts").count()


def test_fixture_buckets_follow_the_input(spark):
    from plyspark.sources.adapter import fixture_buckets

    sizes = [fixture_buckets(spark, f"/root/testdata/sf{s}", bucket_bytes=20_000) for s in ("0.001", "0.01", "0.1")]
    assert sizes[0] < sizes[1] / 3 < sizes[2] / 9


def test_one_users_games(spark, scratch, whole):
    feed, out = _landed_feed(spark, scratch), os.path.join(scratch, "out")
    every = whole.read("games")
    name, total = every.where("white_username IS NOT NULL").first().white_username, every.count()
    mine = run_pipeline(spark, feed, out, username=name.upper(), csv_dir=os.path.join(scratch, "csv"))
    rows = mine.read("games").select("white_username", "black_username").collect()
    assert 0 < len(rows) < total and all(name.lower() in [(n or "").lower() for n in r] for r in rows)
    assert all(f.startswith(f"{name.upper()}_") for f in os.listdir(os.path.join(scratch, "csv")))


def test_truncated_line_raises(spark, scratch):
    from plyspark.sources.feed import read_feed

    path = os.path.join(scratch, "bad.ndjson")
    with open(path, "w") as f:
        f.write('{"id": "g1", "perf": "rapid"}\n{"id": "g2", "pe\n')
    with pytest.raises(Exception):
        read_feed(spark, path).collect()


def test_bucketed_refresh_has_no_ply_shuffle(spark, scratch):
    from plyspark.operators.features import move_features
    from plyspark.operators.marts import match_facts, move_aggregates
    from plyspark.operators.staging import stage_games, stage_moves

    feed = _landed_feed(spark, scratch)
    out = os.path.join(scratch, "out_bucketed")
    res = run_pipeline(spark, feed, out, max_games=300, game_buckets=4, table_prefix="t_bucketed")
    assert res.failures().isEmpty()
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        models = build_models({n: spark.table(f"t_bucketed_{n}") for n in ("games", "moves", "move_evals")}, co_partition=False)
        agg = move_aggregates(move_features(stage_moves(spark.table("t_bucketed_moves"),
                                                        spark.table("t_bucketed_move_evals"), co_partition=False)))
        plan = agg._jdf.queryExecution().executedPlan().toString()
        facts_plan = models["match_facts"]._jdf.queryExecution().executedPlan().toString()
        # the fact job of the refresh: stored game-keyed layers, co-bucketed
        stored_facts = match_facts(stage_games(spark.table("t_bucketed_games")),
                                   spark.table("t_bucketed_move_features"),
                                   spark.table("t_bucketed_opening_patterns"))
        stored_plan = stored_facts._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    assert "Exchange" not in plan, plan
    assert "Exchange" not in facts_plan, facts_plan
    assert "Exchange" not in stored_plan, stored_plan
    # same results as the unbucketed refresh
    plain_out = os.path.join(scratch, "out_plain")
    plain = run_pipeline(spark, feed, plain_out, max_games=300)
    for name in ("match_facts", "opening_dim", "move_features"):
        a, b = res.read(name), plain.read(name)
        assert a.count() > 0 and _equal(a, b)


def test_given_tables_join_plies_and_evaluations_once(spark, scratch, monkeypatch):
    """The openings of a refresh over given tables come from the stored plies,
    fanned out by a repeated evaluation as the joined plies are."""
    raw = adapter.stored_raw_tables(spark, SF_SMALL)
    raw = {**raw, "move_evals": raw["move_evals"].unionByName(raw["move_evals"].where("game_id LIKE '%3'"))}
    want, given = build_models(raw)["opening_patterns"], []
    monkeypatch.setattr(pipeline, "opening_patterns", lambda plies, games: (given.append(plies), opening_patterns(plies, games))[1])
    res = pipeline.refresh_from_tables(spark, raw, os.path.join(scratch, "out"), table_prefix="t_given")
    assert "Join" not in given[0]._jdf.queryExecution().optimizedPlan().toString()
    assert _equal(res.read("opening_patterns"), want) and not want.isEmpty()
