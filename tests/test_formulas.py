"""Formula goldens: the printed report numbers that do hold, and the threshold edges."""

import pytest
from pyspark.sql import functions as F

from tidemark.functions import scalar as S


def one(spark, col):
    return spark.range(1).select(col.alias("v")).collect()[0]["v"]


@pytest.mark.parametrize("today,base,expected", [
    (4523, 4450, 1.6), (3876, 3820, 1.5), (2134, 2200, -3.0), (1742, 1620, 7.5),
    (156, 180, -13.3), (23, 18, 27.8), (8, 5, 60.0), (134, 128, 4.7),
    (423, 820, -48.4), (178, 380, -53.2), (5, 0, None), (5, None, None),
])
def test_variance_goldens(spark, today, base, expected):
    assert one(spark, S.variance_pct(F.lit(today), F.lit(base).cast("double"))) == expected


@pytest.mark.parametrize("num,den,expected", [
    (182, 263, 69.2), (41, 263, 15.6), (233, 263, 88.6), (30, 263, 11.4),     # stage %
    (30, 69, 43.5), (27, 69, 39.1), (12, 69, 17.4), (41, 91, 45.1),            # shares
    (4489, 4523, 99.2), (4398, 4523, 97.2), (4156, 4523, 91.9),               # completeness
    (2945, 3876, 76.0), (3234, 3876, 83.4), (3678, 3876, 94.9), (3512, 3876, 90.6),
    (2134, 3876, 55.1), (3876, 4523, 85.7), (2134, 4523, 47.2),               # match, conversion
])
def test_percent_goldens(spark, num, den, expected):
    assert one(spark, S.pct(F.lit(num), F.lit(den))) == expected


@pytest.mark.parametrize("v,level,label", [
    (0.0, "normal", "Normal"), (14.99, "normal", "Normal"), (15.0, "warning", "Above Average"),
    (-15.0, "warning", "Below Average"), (29.99, "warning", "Above Average"),
    (30.0, "critical", "High"), (-30.0, "critical", "Critical Drop"), (-48.4, "critical", "Critical Drop"),
    (None, None, None),
])
def test_anomaly_edges(spark, v, level, label):
    col = F.lit(v).cast("double")
    assert one(spark, S.anomaly_level(col)) == level
    assert one(spark, S.anomaly_label(S.anomaly_level(col), col)) == label


@pytest.mark.parametrize("v,trend", [(1.24, "stable"), (-1.24, "stable"), (1.25, "up"), (-1.28, "down"),
                                     (None, None)])
def test_trend_band(spark, v, trend):
    assert one(spark, S.trend_direction(F.lit(v).cast("double"))) == trend


@pytest.mark.parametrize("pct,grade", [(100.0, "Excellent"), (99.25, "Excellent"), (97.2, "Good"),
                                       (91.9, "Acceptable"), (89.9, "Poor")])
def test_completeness_grade(spark, pct, grade):
    assert one(spark, S.completeness_grade(F.lit(pct))) == grade


def test_date_to_int_is_yyyymmdd(spark):
    import datetime as dt
    assert one(spark, S.fn_date_to_int(F.lit(dt.datetime(2001, 8, 1, 23, 59)))) == 20010801
    assert one(spark, S.fn_date_to_int(F.lit(dt.date(1999, 12, 31)))) == 19991231


def test_error_text_is_null_safe_and_truncated(spark):
    assert one(spark, S.fn_error_text(F.lit("a"), F.lit(None).cast("string"), F.lit("b"))) == "ab"
    assert len(one(spark, S.fn_error_text(F.lit("x" * 500)))) == 200


def test_reopen_status(spark):
    assert one(spark, S.fn_reopen_status(F.lit("C"))) == "R"
    assert one(spark, S.fn_reopen_status(F.lit(None).cast("string"))) == "O"
    assert one(spark, S.fn_reopen_status(F.lit("O"))) == "O"
