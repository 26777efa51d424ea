"""Property: the segmented (hot-key) window equals the plain window for any
data and any segment size."""

from datetime import datetime, timedelta

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from plyspark.operators.trajectories import rating_trajectories
from tests.test_trajectories import _GAME, plain_rating_trajectories

PLAYERS = ["ann", "bob", None]


@st.composite
def histories(draw):
    n = draw(st.integers(min_value=1, max_value=60))
    rows = []
    t0 = datetime(2024, 1, 1)
    minute = 0
    for i in range(n):
        minute += draw(st.integers(min_value=0, max_value=90))  # bursts and gaps; equal times allowed
        white = draw(st.sampled_from(PLAYERS))
        black = draw(st.sampled_from([p for p in PLAYERS if p != white] or [None]))
        result = draw(st.sampled_from(["white", "black", "draw"]))
        rating = draw(st.one_of(st.none(), st.integers(min_value=800, max_value=2800)))
        acc = draw(st.one_of(st.none(), st.floats(min_value=0, max_value=100, allow_nan=False)))
        perf = draw(st.sampled_from(["rapid", "blitz"]))
        t = draw(st.sampled_from([t0 + timedelta(minutes=minute)] * 4 + [None, t0 - timedelta(days=9000)]))
        rows.append((f"g{i:03d}", white, black, rating, 1500, 0, 0, acc, 50.0,
                     None if result == "draw" else result, result, "mate", perf, "standard",
                     "C20", "x", 4, 600, 5, "10+5", t, t, t0))
    return rows


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(rows=histories(), seg=st.integers(min_value=1, max_value=15))
def test_segmented_equals_plain(spark, rows, seg):
    g = spark.createDataFrame(rows, _GAME)
    plain = sorted(tuple(repr(v) for v in r) for r in plain_rating_trajectories(g).collect())
    split = sorted(tuple(repr(v) for v in r)
                   for r in rating_trajectories(g, rows_per_range=seg).collect())
    assert split == plain
