"""Expressions on hand-made rows, at their boundaries."""

import datetime as dt
import hashlib

import pytest

from tidemark.functions import vocabulary as words
from tidemark.functions.buckets import band, change_class, ladder, lookup, position, quadrant
from tidemark.functions.hashing import beta22, digest, pick, surrogate_key, unit
from tidemark.functions.numeric import abs_zscore, literal, min_max_scale, percent, round_columns, stable_round
from tidemark.functions.timeparts import time_dimensions


def value(spark, expression):
    return spark.sql(f"SELECT {expression} AS v").first()["v"]


@pytest.mark.parametrize(
    "x, y, label",
    [
        (0.6, 0.6, "Happy_Energetic"),
        (0.6, 0.39, "Happy_Calm"),
        (0.39, 0.6, "Sad_Energetic"),
        (0.39, 0.39, "Sad_Calm"),
        (0.4, 0.4, "Neutral"),
        (0.59, 0.9, "Neutral"),
        (0.9, 0.4, "Neutral"),
        ("NULL", 0.9, "Neutral"),
    ],
)
def test_quadrant_edges(spark, x, y, label):
    assert value(spark, quadrant(f"CAST({x} AS DOUBLE)", f"CAST({y} AS DOUBLE)", words.MOOD)) == label


def test_ladder_and_band(spark):
    steps = [(0.3, "High Priority"), (0.4, "Medium Priority")]
    assert [value(spark, ladder(f"{x}D", steps, "Low Priority")) for x in (0.29, 0.3, 0.4)] == [
        "High Priority", "Medium Priority", "Low Priority",
    ]
    assert value(spark, ladder("CAST(NULL AS DOUBLE)", steps, "Low Priority")) == "Low Priority"
    assert value(spark, ladder("0.7D", [(0.7, "Strong")], "Weak", op=">")) == "Weak"
    assert value(spark, band("11", [(6, 11, "a"), (12, 17, "b")], "c")) == "a"


def test_change_class_edges(spark):
    def classify(a, b):
        return value(spark, change_class([f"{a}D", f"{b}D"]))

    assert classify(0.2, -0.2) == "Stable"
    assert classify(0.21, 0.0) == "Minor_Shift"
    assert classify(0.5, -0.5) == "Minor_Shift"
    assert classify(0.0, -0.51) == "Major_Shift"


def test_lookup_position_and_literals(spark):
    assert value(spark, lookup("'a'", {"a": "it's", "b": "back\\slash"}, "none")) == "it's"
    assert value(spark, lookup("'b'", {"a": "it's", "b": "back\\slash"}, "none")) == "back\\slash"
    assert value(spark, lookup("'z'", {"a": "x"}, "none")) == "none"
    assert value(spark, lookup("CAST(NULL AS STRING)", {"a": "x"}, "none")) == "none"
    assert [value(spark, position(f"'{p}'", ("x", "y"))) for p in "xyz"] == [1, 2, 3]
    assert value(spark, literal(None)) is None
    assert value(spark, literal(True)) is True


def test_rounding_is_half_up_both_ways(spark):
    assert value(spark, stable_round("0.4525D", 3)) == 0.453
    assert value(spark, stable_round("0.45249999999999996D", 3)) == 0.453  # the same mean, summed in another order
    assert value(spark, stable_round("-0.4525D", 3)) == -0.453
    assert str(value(spark, stable_round("-1E-17D", 3))) == "0.0"
    assert value(spark, stable_round("CAST(NULL AS DOUBLE)", 3)) is None
    rounded = round_columns(spark.sql("SELECT 1.23456D AS a, 'x' AS b"), {"a": 2})
    assert rounded.first().asDict() == {"a": 1.23, "b": "x"}


def test_division_guards(spark):
    assert value(spark, percent("1", "0")) == 0.0
    assert value(spark, percent("1", "3")) == 33.33
    assert value(spark, abs_zscore("1D", "3D", "0D")) is None
    assert value(spark, abs_zscore("1D", "3D", "CAST(NULL AS DOUBLE)")) is None
    assert value(spark, abs_zscore("1D", "3D", "0.5D")) == 4.0
    assert value(spark, min_max_scale("120D", 60, 180)) == 0.5


def test_time_dimensions_at_the_borders(spark):
    stamps = {
        "2024-01-06 05:59:59": ("night", True, 7, "Saturday"),
        "2024-01-07 06:00:00": ("morning", True, 1, "Sunday"),
        "2024-01-08 11:59:59": ("morning", False, 2, "Monday"),
        "2024-01-09 12:00:00": ("afternoon", False, 3, "Tuesday"),
        "2024-01-10 17:59:59": ("afternoon", False, 4, "Wednesday"),
        "2024-01-11 18:00:00": ("evening", False, 5, "Thursday"),
        "2024-01-12 22:59:59": ("evening", False, 6, "Friday"),
        "2024-01-12 23:00:00": ("night", False, 6, "Friday"),
    }
    rows = [(dt.datetime.fromisoformat(s),) for s in stamps]
    found = time_dimensions(spark.createDataFrame(rows, "played_at timestamp_ntz")).collect()
    assert [(r.part_of_day, r.is_weekend, r.day_of_week, r.day_name) for r in found] == list(stamps.values())
    empty = time_dimensions(spark.createDataFrame([(None,)], "played_at timestamp_ntz")).first()
    assert (empty.hour_of_day, empty.is_weekend, empty.part_of_day) == (None, False, "night")


def test_surrogate_key_treats_null_as_empty(spark):
    assert value(spark, surrogate_key(["'a'", "CAST(NULL AS STRING)", "'c'"])) == hashlib.md5(b"a||c").hexdigest()


def test_hash_values_are_in_range_and_distributed(spark):
    h = digest("id", "x")
    rows = spark.range(20000).selectExpr(f"{h} AS h").selectExpr(
        "h", f"{unit('h')} AS u", f"{beta22(unit('h', 0), unit('h', 1), unit('h', 2))} AS b", f"{pick('h', (3, 4, 5))} AS p"
    )
    s = rows.selectExpr(
        "min(u)", "max(u)", "avg(b)", "var_samp(b)", "min(p)", "max(p)", "count(DISTINCT p)", "avg(u)"
    ).first()
    assert 0 <= s[0] and s[1] < 1
    assert abs(s[2] - 0.5) < 0.01 and abs(s[3] - 0.05) < 0.003  # Beta(2, 2): mean 1/2, variance 1/20
    assert (s[4], s[5], s[6]) == (3, 5, 3)
    assert abs(s[7] - 0.5) < 0.01
