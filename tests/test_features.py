from pyspark.sql import functions as F

from plyspark.operators.features import move_features
from plyspark.schemas import STG_MOVES_COLUMNS

_SCHEMA = ("game_id string, move_offset long, move_number long, color string, username string, "
           "move_san string, eval_score double, mate_in long, best_move string, variation string, "
           "judgment string, time_left_cs long, time_left_ratio double")


def _plies(spark, game, evals):
    rows = [(game, i, i // 2 + 1, "white" if i % 2 == 0 else "black", "p", "e4", e, None, None,
             None, None, None, None) for i, e in enumerate(evals)]
    return spark.createDataFrame(rows, _SCHEMA).select(*STG_MOVES_COLUMNS)


def test_volatility_skips_nulls(spark):
    out = move_features(_plies(spark, "g", [1.0, 2.0, None, 4.0, 8.0])).orderBy("move_offset")
    vol = [r.eval_volatility_3 for r in out.collect()]
    assert vol[0] is None
    expected = [None, 0.7071067811865476, 0.7071067811865476, 1.4142135623730951, 2.8284271247461903]
    for got, exp in zip(vol, expected):
        assert (got is None and exp is None) or abs(got - exp) < 1e-12


def test_delta_is_sum_with_previous(spark):
    out = move_features(_plies(spark, "g", [10.0, -4.0, None, 7.0])).orderBy("move_offset")
    assert [r.eval_delta for r in out.collect()] == [None, 6.0, None, None]


def test_windows_stay_inside_a_game(spark):
    df = _plies(spark, "a", [1.0, 3.0]).unionByName(_plies(spark, "b", [5.0, 9.0]))
    out = {(r.game_id, r.move_offset): r.eval_delta for r in move_features(df).collect()}
    assert out[("b", 0)] is None and out[("b", 1)] == 14.0


def test_segmented_game_windows_equal_plain(spark):
    evals = [float((i * 37) % 11 - 5) if i % 4 else None for i in range(40)]
    df = _plies(spark, "g1", evals).unionByName(_plies(spark, "g2", evals[:7]))
    plain = move_features(df).orderBy("game_id", "move_offset").collect()
    for seg in (3, 5, 8):
        split = move_features(df, rows_per_game_range=seg).orderBy("game_id", "move_offset").collect()
        assert [tuple(r) for r in split] == [tuple(r) for r in plain]


def test_plan_shares_one_window(spark):
    df = _plies(spark, "g", [1.0, 2.0, 3.0])
    plan = move_features(df)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Window [") == 1
