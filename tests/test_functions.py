from pyspark.sql import functions as F

from plyspark.functions.scalar import (
    clock_ratio,
    move_flags,
    outcome_for,
    piece_type,
    time_control_label,
    whole_number_text,
)


def test_time_control_label(spark):
    df = spark.createDataFrame(
        [(600, 5), (90, 0), (15, 0), (180, 2), (5400, 30), (100, 1)], "i long, inc long"
    )
    got = [r[0] for r in df.select(time_control_label(F.col("i"), F.col("inc"))).collect()]
    assert got == ["10+5", "1.5+0", "0.25+0", "3+2", "90+30", "1.6666666666666667+1"]


def test_whole_number_text(spark):
    df = spark.createDataFrame([(10.0,), (2.5,), (None,)], "x double")
    assert [r[0] for r in df.select(whole_number_text(F.col("x"))).collect()] == ["10", "2.5", None]


def test_piece_type_and_flags(spark):
    rows = [("e4",), ("Nf3",), ("Bxc3",), ("bxc3",), ("O-O",), ("O-O-O",), ("Qh5+",),
            ("Rd8#",), ("e8=Q",), ("Kxe2+",), (None,)]
    df = spark.createDataFrame(rows, "san string")
    flags = move_flags(F.col("san"))
    out = df.select("san", piece_type(F.col("san")).alias("p"), *[c.alias(k) for k, c in flags.items()])
    got = {r["san"]: r for r in out.collect()}
    assert got["O-O-O"]["p"] == "king" and got["O-O-O"]["is_castling"]
    assert got["bxc3"]["p"] == "pawn" and got["bxc3"]["is_capture"]
    assert got["Bxc3"]["p"] == "bishop"
    assert got["Nf3"]["p"] == "knight" and got["Rd8#"]["p"] == "rook" and got["Qh5+"]["p"] == "queen"
    # '#' is not a check: mating moves are not counted as checks
    assert got["Rd8#"]["is_checkmate"] and not got["Rd8#"]["is_check"]
    assert got["e8=Q"]["is_promotion"] and got["Kxe2+"]["is_check"]
    none = got[None]
    assert none["p"] == "pawn"
    assert all(none[k] is None for k in flags)


def test_outcome_for(spark):
    df = spark.createDataFrame([("white",), ("black",), ("draw",)], "result string")
    out = df.select(outcome_for("white", F.col("result")).alias("w"),
                    outcome_for("black", F.col("result")).alias("b")).collect()
    assert [(r.w, r.b) for r in out] == [("win", "loss"), ("loss", "win"), ("draw", "draw")]


def test_clock_ratio(spark):
    df = spark.createDataFrame([(6000, 600), (None, 600), (6000, 0), (4567, 90)], "cs long, i long")
    got = [r[0] for r in df.select(clock_ratio(F.col("cs"), F.col("i"))).collect()]
    assert got == [0.1, None, None, round(45.67 / 90, 4)]


def test_partition_settings_scale():
    from plyspark.session import partition_settings

    tb = 1024 ** 4
    big = partition_settings(100 * tb, total_cores=8000)
    assert int(big["spark.sql.shuffle.partitions"]) == 100_000  # capped; partitions grow
    assert int(big["spark.sql.adaptive.advisoryPartitionSizeInBytes"]) > 256 * 1024 ** 2
    mid = partition_settings(1 * tb, total_cores=1000)
    assert int(mid["spark.sql.shuffle.partitions"]) == 8 * 1024  # 2 TB / 256 MB
    small = partition_settings(10 * 1024 ** 2, total_cores=8)
    assert int(small["spark.sql.shuffle.partitions"]) == 16  # two waves of cores


def test_settings_of_a_job_are_set_back(spark):
    from plyspark.session import sized_for

    keys = ["spark.sql.shuffle.partitions", "spark.sql.adaptive.advisoryPartitionSizeInBytes"]
    before = [spark.conf.get(k) for k in keys]
    with sized_for(spark, 10 * 1024 ** 3):
        assert spark.conf.get(keys[0]) == "80"
    with sized_for(spark, 1024):
        assert [spark.conf.get(k) for k in keys] == before
    assert [spark.conf.get(k) for k in keys] == before
