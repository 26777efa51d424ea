"""CSV reads in splits and partitioned writes."""

import os

import pytest
from pyspark.sql import DataFrameWriter
from pyspark.sql import functions as F

from plyspark.schemas import GAMES_SCHEMA
from plyspark.session import settings
from plyspark.sources.tables import read_raw_csv, spans_lines, write_csv, write_table

_SETTING = "spark.sql.maxConcurrentOutputFileWriters"


def _games(spark, openings):
    rows = spark.createDataFrame(list(enumerate(openings)), "i int, opening string")
    given = {"game_id": F.col("i").cast("string"), "opening_name": F.col("opening"), "ingested_at": F.lit("2026-01-01 00:00:00.25").cast("timestamp")}
    return rows.select([given.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in GAMES_SCHEMA.fields])


def _rows(df):
    return sorted(map(str, df.collect()))


def test_a_csv_of_plain_lines_is_read_in_splits(spark, scratch):
    games = _games(spark, ['say "a", b', None, "c,d"] * 400)
    path = write_csv(games.coalesce(1), scratch, "t", "games")
    assert not spans_lines(spark, path)
    with settings(spark, {"spark.sql.files.maxPartitionBytes": "8192", "spark.sql.files.openCostInBytes": "0"}):
        back = read_raw_csv(spark, path, "games")
        assert back.rdd.getNumPartitions() > 4
        assert _rows(back) == _rows(games)


@pytest.mark.parametrize("opening", ["two\nlines", 'a "quoted\n\n" end', "a\rreturn"])
def test_line_breaks_inside_records_are_kept(spark, scratch, opening):
    games = _games(spark, ["x", opening, "y"])
    path = write_csv(games, scratch, "t", "games")
    assert spans_lines(spark, path)
    old = spark.read.option("header", True).option("escape", '"').option("multiLine", True).csv(path)
    back = read_raw_csv(spark, path, "games")
    assert back.count() == 3
    assert sorted(r[0] for r in back.select("opening_name").collect()) == sorted(r[0] for r in old.select("opening_name").collect())


def test_a_csv_with_carriage_returns_at_line_ends(spark, scratch):
    path = os.path.join(scratch, "w.csv")
    names = GAMES_SCHEMA.fieldNames()
    with open(path, "w", newline="") as f:
        f.write("".join(",".join(r) + "\r\n" for r in [names, ["g1"] + [""] * (len(names) - 1), ["g2"] + [""] * (len(names) - 1)]))
    assert not spans_lines(spark, path)
    assert [r.game_id for r in read_raw_csv(spark, path, "games").orderBy("game_id").collect()] == ["g1", "g2"]


def test_partitions_are_written_without_a_sort(spark, scratch, monkeypatch):
    seen, parquet = [], DataFrameWriter.parquet
    monkeypatch.setattr(DataFrameWriter, "parquet", lambda self, *a, **k: (seen.append(spark.conf.get(_SETTING)), parquet(self, *a, **k))[1])
    before = spark.conf.get(_SETTING)
    df = spark.range(100).withColumn("usable", F.col("id") % 3 == 0)
    write_table(df, os.path.join(scratch, "p"), partition_by=["usable"])
    assert int(seen[0]) >= 2 and spark.conf.get(_SETTING) == before
    assert spark.read.parquet(os.path.join(scratch, "p/usable=true")).count() == 34
