from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from plyspark.operators.staging import stage_moves
from plyspark.sources import adapter, tables
from tests.conftest import SF_SMALL


def _rows(df):
    return sorted(tuple(repr(v) for v in r) for r in df.collect())


def test_stored_tables_equal_derived(spark):
    derived = adapter.raw_tables(spark, SF_SMALL)
    stored = adapter.stored_raw_tables(spark, SF_SMALL)
    for name in ("games", "moves", "move_evals"):
        assert _rows(stored[name]) == _rows(derived[name]), name


def test_without_catalog_reads_plain_parquet(spark, monkeypatch):
    key = adapter._key(spark, SF_SMALL)
    saved = adapter._memo.pop(key, None), adapter._names.pop(key, None)

    def no_catalog(*args, **kwargs):
        raise AnalysisException("catalog is read-only")

    monkeypatch.setattr(tables, "register_bucketed_table", no_catalog)
    try:
        stored = adapter.stored_raw_tables(spark, SF_SMALL)
        plan = stored["moves"]._jdf.queryExecution().executedPlan().toString()
        assert "spark_catalog" not in plan  # plain file scan
        joined = stage_moves(stored["moves"], stored["move_evals"])
        assert joined.count() == stored["moves"].count()
    finally:
        adapter._memo.pop(key, None)
        adapter._names.pop(key, None)
        if saved[0] is not None:
            adapter._memo[key], adapter._names[key] = saved


def test_buckets_are_small(spark):
    """A bucket is one task of each ply query: 8 MB of the sources or less."""
    assert adapter.fixture_buckets(spark, "/root/testdata/sf0.1", bucket_bytes=1 << 20) >= 10
    assert adapter.FIXTURE_BUCKET_BYTES <= 8 << 20


def test_stored_feed_needs_no_shuffle(spark):
    """The stored tables are co-bucketed, and the feed is nested from them as
    they lie; its files are compressed."""
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        stored = adapter.stored_raw_tables(spark, SF_SMALL)
        buckets = adapter.fixture_buckets(spark, SF_SMALL)
        moves, evals = adapter.raw_moves_and_evals(spark, SF_SMALL, stored["games"], buckets)
        plans = [df._jdf.queryExecution().executedPlan().toString() for df in (adapter.feed_lines(spark, SF_SMALL, stored), moves, evals)]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    assert [plan.count("Exchange ") for plan in plans] == [0, 1, 1], plans
    names = spark.read.text(adapter.stored_feed_path(spark, SF_SMALL)).select(F.input_file_name()).distinct().collect()
    assert names and all(n[0].endswith(".gz") for n in names)


def test_feed_moves_skip_null_sans(spark):
    games = adapter.raw_games(spark, SF_SMALL).limit(2)
    ids = [r.game_id for r in games.select("game_id").orderBy("game_id").collect()]
    moves = spark.createDataFrame(
        [(ids[0], 2, "c"), (ids[0], 0, "a"), (ids[0], 1, None), (ids[1], 0, None)], "game_id string, move_offset long, move_san string"
    )
    evals = adapter.raw_tables(spark, SF_SMALL)["move_evals"].limit(0)
    lines = adapter.feed_lines(spark, SF_SMALL, {"games": games, "moves": moves, "move_evals": evals})
    found = lines.select(F.get_json_object("value", "$.id"), F.get_json_object("value", "$.moves")).collect()
    assert {tuple(r) for r in found} == {(ids[0], "a c"), (ids[1], None)}


def _few_sources(spark, folder):
    for name, key in (("orders", "o_orderkey"), ("lineitem", "l_orderkey"), ("customer", "c_custkey")):
        spark.read.parquet(f"{SF_SMALL}/{name}.parquet").where(F.col(key) <= 200).coalesce(1).write.parquet(f"{folder}/{name}.parquet")


def test_buckets_follow_plies_of_any_compression(spark, scratch):
    """Sources that compress to almost nothing still have small buckets."""
    for name in ("orders", "customer"):
        spark.range(1).write.parquet(f"{scratch}/{name}.parquet")
    spark.range(5000).selectExpr("1L AS l_orderkey").coalesce(1).write.parquet(f"{scratch}/lineitem.parquet")
    assert adapter.fixture_buckets(spark, scratch) == adapter.LEAST_BUCKETS
    assert adapter.fixture_buckets(spark, scratch, bucket_plies=100) == 50
    assert adapter.FIXTURE_BUCKET_PLIES <= 400_000


def test_feed_is_written_by_its_first_reader(spark, scratch):
    _few_sources(spark, scratch)
    games = adapter.stored_raw_tables(spark, scratch)["games"]
    assert not adapter._committed(spark, f"{adapter.materialize(spark, scratch)}/feed")
    feed = adapter.stored_feed_path(spark, scratch)
    assert adapter._committed(spark, feed)
    ids = spark.read.text(feed).select(F.get_json_object("value", "$.id").alias("game_id"))
    assert _rows(ids) == _rows(games.select("game_id"))
