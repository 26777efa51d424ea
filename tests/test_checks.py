from plyspark.operators.checks import (
    PIPELINE_RULES,
    accepted_range,
    accepted_values,
    not_null,
    run_checks,
    unique,
)


def test_rule_count():
    kinds = [r.kind for r in PIPELINE_RULES]
    assert len(PIPELINE_RULES) == 20
    assert (kinds.count("unique"), kinds.count("not_null"), kinds.count("accepted_values"),
            kinds.count("accepted_range")) == (4, 9, 5, 2)


def test_failures_are_counted(spark):
    t = spark.createDataFrame(
        [("a", "white", -1, 1.2), ("a", "draw", 0, 0.5), (None, "purple", 3, None),
         ("b", None, None, 0.0), ("c", "black", 2, 1.0), ("c", "black", 2, 1.0)],
        "k string, result string, blunders long, rate double",
    )
    rules = [unique("t", "k"), not_null("t", "k"),
             accepted_values("t", "result", ["white", "black", "draw"]),
             accepted_range("t", "blunders", min_value=0),
             accepted_range("t", "rate", min_value=0, max_value=1)]
    got = {(r.column_name, r.rule): r.failures for r in run_checks(spark, {"t": t}, rules).collect()}
    assert got == {
        ("k", "unique"): 2,  # 'a' and 'c' repeat; NULL is ignored
        ("k", "not_null"): 1,
        ("result", "accepted_values"): 1,  # NULL passes
        ("blunders", "accepted_range[0,]"): 1,
        ("rate", "accepted_range[0,1]"): 1,
    }


def test_clean_table_passes(spark):
    t = spark.createDataFrame([("a", 1), ("b", 2)], "k string, v long")
    rep = run_checks(spark, {"t": t}, [unique("t", "k"), not_null("t", "v")])
    assert [r.failures for r in rep.collect()] == [0, 0]
