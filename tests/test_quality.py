"""Checks on hand-made rows."""

from tidemark.operators.quality import (
    extra_columns, has_columns, mean_near, nulls_at_most, report, rows_at_least, run_checks, run_suite, unique, within,
)


def by_name(df):
    return {(r.check, r.column): (r.observed, r.passed) for r in df.collect()}


def test_every_check(spark):
    df = spark.createDataFrame(
        [("a", 0.5, 1), ("a", float("nan"), 1), (None, None, 2), (None, 1.5, 2)], "k string, v double, n int"
    )
    found = by_name(
        run_checks(
            df,
            [
                nulls_at_most("v", 50.0), nulls_at_most("k", 49.0), within("v", 0, 1), within("n", 1, 2),
                rows_at_least(5), unique("k", "n"), has_columns("k", "z"), mean_near("n", 1.4, 0.1), mean_near("n", 1.3, 0.1),
                within("absent", 0, 1), unique("absent"),
            ],
            "t",
        ).where("NOT (check = 'distribution' AND passed)")
    )
    assert found == {
        ("nulls", "v"): (50.0, True),  # NULL and NaN
        ("nulls", "k"): (50.0, False),
        ("range", "v"): (2.0, False),  # NaN sorts above every number
        ("range", "n"): (0.0, True),
        ("row_count", None): (4.0, False),
        ("duplicates", "k,n"): (2.0, False),  # NULL keys are equal to each other
        ("schema", None): (1.0, False),
        ("distribution", "n"): (1.5, False),
        ("range", "absent"): (None, False),
        ("duplicates", "absent"): (None, False),
    }
    assert extra_columns(df, ["k"]) == ["n", "v"]


def test_empty_table(spark):
    empty = spark.createDataFrame([], "v double")
    found = by_name(run_checks(empty, [nulls_at_most("v"), within("v", 0, 1), unique("v"), mean_near("v", 0.5, 0.1)], "t"))
    assert found == {
        ("nulls", "v"): (0.0, True), ("range", "v"): (0.0, True), ("duplicates", "v"): (0.0, True),
        ("distribution", "v"): (0.0, False),
    }


def test_suite_reports_missing_tables(spark):
    df = spark.range(3).toDF("v")
    results = run_suite(spark, {"there": (df, [rows_at_least(1)]), "gone": (None, [rows_at_least(1)])}, "gold")
    totals = {r.layer: (r.total_checks, r.passed_checks, r.failed_checks, r.pass_rate) for r in report(results).collect()}
    assert totals == {"gold": (2, 1, 1, 50.0), "all": (2, 1, 1, 50.0)}
