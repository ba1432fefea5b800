"""Scalar expressions (Column -> Column) of the three workloads."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column
from pyspark.sql import functions as F

from .. import thresholds as T


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def ntz_literal(value: _dt.datetime | _dt.date) -> Column:
    """A zone-less timestamp literal built from its text, so neither the Python process
    nor the session time zone can shift it."""
    if not isinstance(value, _dt.datetime):
        value = _dt.datetime.combine(value, _dt.time())
    return F.lit(value.strftime("%Y-%m-%d %H:%M:%S.%f")).cast("timestamp_ntz")


def fn_nvl(c, default) -> Column:
    """NULL default."""
    return F.coalesce(_c(c), default if isinstance(default, Column) else F.lit(default))


def fn_date_to_int(d) -> Column:
    """date/timestamp -> yyyymmdd integer, as year·10000 + month·100 + day.

    Same value as ``date_format(d, 'yyyyMMdd')`` (``mm`` would be minutes) without
    formatting a string per row."""
    d = _c(d)
    return (F.year(d) * 10000 + F.month(d) * 100 + F.dayofmonth(d)).cast("int")


def date_int_literal(d: _dt.date) -> Column:
    return F.lit(int(d.strftime("%Y%m%d")))


def fn_reopen_status(status) -> Column:
    """'C' -> 'R', anything else (NULL included) -> 'O'."""
    return F.when(_c(status) == T.STATUS_CLOSED, F.lit(T.STATUS_REOPENED)).otherwise(F.lit(T.STATUS_OPEN))


def fn_error_text(*parts, limit: int = T.ERROR_TEXT_LIMIT) -> Column:
    """NULL-safe concatenation (NULL reads as ''), truncated to ``limit`` characters."""
    return F.substring(F.concat_ws("", *[_c(p) for p in parts]), 1, limit)


def variance_raw(today, base) -> Column:
    """Unrounded 100·(today − base)/base; NULL when base is 0 or NULL."""
    b = _c(base).cast("double")
    return F.lit(100.0) * (_c(today).cast("double") - b) / F.nullif(b, F.lit(0.0))


def variance_pct(today, base) -> Column:
    """variance in percent, 1 decimal, half-up."""
    return F.round(variance_raw(today, base), 1)


def delta_abs(today, base) -> Column:
    """F7, absolute part: signed difference."""
    return _c(today) - _c(base)


def trend_direction(v, band: float = T.TREND_STABLE_BAND_PCT) -> Column:
    """F8: 'up' / 'down' / 'stable' (|v| < band); NULL stays NULL."""
    v = _c(v)
    return (F.when(v.isNull(), F.lit(None).cast("string"))
             .when(F.abs(v) < band, F.lit("stable"))
             .when(v > 0, F.lit("up")).otherwise(F.lit("down")))


def anomaly_level(v, warn: float = T.ANOMALY_WARN_PCT, crit: float = T.ANOMALY_CRIT_PCT) -> Column:
    """'critical' at |v| >= crit, 'warning' at |v| >= warn, else 'normal'; classify unrounded."""
    v = _c(v)
    return (F.when(v.isNull(), F.lit(None).cast("string"))
             .when(F.abs(v) >= crit, F.lit("critical"))
             .when(F.abs(v) >= warn, F.lit("warning")).otherwise(F.lit("normal")))


def anomaly_label(level, v) -> Column:
    """level + sign -> report label."""
    level, v = _c(level), _c(v)
    return (F.when(level.isNull(), F.lit(None).cast("string"))
             .when(level == "normal", F.lit(T.LABEL_NORMAL))
             .when((level == "critical") & (v < 0), F.lit(T.LABEL_CRITICAL_DROP))
             .when(level == "critical", F.lit(T.LABEL_CRITICAL_HIGH))
             .when(v < 0, F.lit(T.LABEL_BELOW_AVERAGE)).otherwise(F.lit(T.LABEL_ABOVE_AVERAGE)))


def completeness_grade(pct, grades=T.COMPLETENESS_GRADES, floor=T.COMPLETENESS_FLOOR_GRADE) -> Column:
    """graded on the unrounded percent."""
    pct = _c(pct)
    out = None
    for minimum, grade in grades:
        out = F.when(pct >= minimum, F.lit(grade)) if out is None else out.when(pct >= minimum, F.lit(grade))
    return out.otherwise(F.lit(floor))


def match_grade(pct, is_all, excellent: float = T.MATCH_EXCELLENT_PCT,
                on_target: float = T.MATCH_ON_TARGET_PCT) -> Column:
    """criteria performance; the ALL row is always 'Within Range'."""
    pct = _c(pct)
    return (F.when(_c(is_all), F.lit(T.MATCH_ALL_LABEL))
             .when(pct >= excellent, F.lit("Excellent"))
             .when(pct >= on_target, F.lit("On Target")).otherwise(F.lit("Below Target")))


def freshness_bucket(last_ts, as_of: _dt.datetime, fresh_hours: float = T.FRESH_HOURS,
                     late_hours: float = T.LATE_HOURS) -> Column:
    """age of the latest data at ``as_of`` -> 'fresh' / 'late' / 'stale'; never seen -> 'unknown'.

    Compared as timestamps against precomputed cut-offs, so no time-zone or
    sub-second rounding enters the bucket."""
    ts = _c(last_ts)
    fresh_from = ntz_literal(as_of - _dt.timedelta(hours=fresh_hours))
    late_from = ntz_literal(as_of - _dt.timedelta(hours=late_hours))
    return (F.when(ts.isNull(), F.lit("unknown"))
             .when(ts >= fresh_from, F.lit("fresh"))
             .when(ts >= late_from, F.lit("late")).otherwise(F.lit("stale")))


def aging_days(d, run_date: _dt.date) -> Column:
    """F15 helper: whole days waited up to the run date."""
    return F.datediff(F.lit(run_date), _c(d))


def pct(num, den, scale: int = 1) -> Column:
    """100·num/den rounded half-up; NULL when den is 0."""
    return F.round(F.lit(100.0) * _c(num).cast("double") / F.nullif(_c(den).cast("double"), F.lit(0.0)), scale)
