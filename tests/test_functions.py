"""Scalar expressions on the edge cases that messages bring."""

import pytest
from pyspark.sql import functions as F

from revlens import functions as fn
from revlens.functions.arrays import squared_distance
from revlens.functions.formats import decimal_text


def values(spark, rows, schema, column):
    return [r[0] for r in spark.createDataFrame(rows, schema).select(column).collect()]


@pytest.mark.parametrize("raw, clean", [
    (None, ""),
    ("", ""),
    ("  Good,  BAD!\t\n ugly ", "good bad ugly"),
    ("don't good.bad", "dont goodbad"),
    ("Très bon café", "trs bon caf"),
    ("NaN banana nan", "banana"),
    ("n.an", ""),
    ("nan", ""),
    ("a\n\n\nb", "a b"),
    ("a \n b\tc  d", "a b c d"),
    ("12345 !!", ""),
    ("nano nanny", "nano nanny"),
])
def test_cleaned(spark, raw, clean):
    assert values(spark, [(raw,)], "x string", fn.cleaned(F.col("x"))) == [clean]


def test_combined_always_has_a_blank(spark):
    rows = [("a", "b"), ("a", ""), ("", "b"), ("", "")]
    joined = values(spark, rows, "r string, s string", fn.combined(F.col("r"), F.col("s")))
    assert joined == ["a b", "a ", " b", " "]


@pytest.mark.parametrize("raw, model, sink, report", [
    ("4", 4.0, 4.0, 4.0),
    ("9", 9.0, 5.0, 5.0),
    ("0", 0.0, 1.0, 1.0),
    ("-2", -2.0, 1.0, 1.0),
    ("", 0.0, 3.0, 3.0),
    ("abc", 0.0, 3.0, 3.0),
    (None, 0.0, 3.0, 3.0),
    ("nan", 0.0, 3.0, 3.0),
    ("3.5", 3.5, 3.5, 3.5),
])
def test_three_ratings(spark, raw, model, sink, report):
    row = spark.createDataFrame([(raw,)], "x string").select(
        fn.model_rating(F.col("x")), fn.sink_rating(F.col("x")), fn.report_rating(F.col("x"))
    ).first()
    assert tuple(row) == (model, sink, report)


def test_labels_look_for_negative_first(spark):
    rows = [("Positive",), ("NEGATIVE",), ("negative, not positive",), ("neutral",), (None,), ("",)]
    assert values(spark, rows, "x string", fn.label_of(F.col("x"))) == [1, 0, 0, -1, -1, -1]


def test_prediction_and_name(spark):
    rows = [(1.0,), (0.0,), (2.0,), (None,)]
    known = fn.known_prediction(F.col("x"))
    assert values(spark, rows, "x double", known) == [1.0, 0.0, -1.0, -1.0]
    assert values(spark, rows, "x double", fn.name_of(known)) == [
        "Positive", "Negative", "Unknown", "Unknown"
    ]


def test_first_argmax(spark):
    rows = [([0.1, 0.5, 0.5],), ([0.9, 0.1],), (None,)]
    assert values(spark, rows, "x array<double>", fn.first_argmax(F.col("x"))) == [1, 0, 0]


def test_squared_distance(spark):
    rows = [([1.0, 2.0], [4.0, 6.0])]
    distance = squared_distance(F.col("a"), F.col("b"))
    assert values(spark, rows, "a array<double>, b array<double>", distance) == [25.0]


def test_formats(spark):
    rows = [(0.87651,), (None,), (1.0,)]
    assert values(spark, rows, "x double", fn.percent_text(F.col("x"))) == ["87.7%", "0.0%", "100.0%"]
    assert values(spark, rows, "x double", decimal_text(F.col("x"))) == ["0.877", "0.000", "1.000"]
    dates = [("2024-05-01T10:20:30.5",), ("2024-05-01T10:20:30Z",),
             ("2024-05-01T10:20:30+05:30",), ("some day in the month of May",)]
    assert values(spark, dates, "x string", fn.training_day(F.col("x"))) == [
        "2024-05-01 10:20", "2024-05-01 10:20", "2024-05-01 10:20", "some day in the mon"
    ]
    severities = [("High",), ("very HIGH",), ("low",), (None,)]
    assert values(spark, severities, "x string", fn.alert_level(F.col("x"))) == [
        "error", "error", "warning", "warning"
    ]
