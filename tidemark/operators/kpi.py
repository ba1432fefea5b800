"""KPI operators: rolling comparisons of a daily metric series, the account funnel,
quote status and product-combination volumes.

Scale notes.  Every operator first reduces the raw rows with a grouped
aggregation (partial aggregation runs map-side, so a hot account, product or
day is collapsed before the shuffle); the windows then run over the reduced
daily / per-account rows only.  Range frames over a day number implement
"previous N calendar days", so gaps in the series are handled correctly.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .. import thresholds as T
from ..functions import scalar as S

SERIES_KEYS = ["product", "metric"]


def day_number(c) -> Column:
    return F.datediff(F.col(c) if isinstance(c, str) else c, F.lit(_dt.date(1970, 1, 1)))


def _frame(lo: int, hi: int, keys=SERIES_KEYS):
    return Window.partitionBy(*keys).orderBy(day_number("report_date")).rangeBetween(lo, hi)


def rolling_avg(daily: DataFrame, days: int, col: str | None = None) -> DataFrame:
    """Mean of the previous ``days`` calendar days (today excluded; days present)."""
    col = col or f"avg_{days}d"
    return daily.withColumn(col, F.avg("value").over(_frame(-days, -1)))


def prev_day_value(daily: DataFrame, col: str = "yesterday") -> DataFrame:
    """The value of the calendar day before (NULL when that day is missing; not ``lag``)."""
    return daily.withColumn(col, F.max("value").over(_frame(-1, -1)))


def series_with_baselines(daily: DataFrame, short: int = T.ROLLING_SHORT_DAYS,
                          long: int = T.ROLLING_LONG_DAYS) -> DataFrame:
    """Every (product, metric, day) with yesterday, short and long averages."""
    return (daily.withColumn("yesterday", F.max("value").over(_frame(-1, -1)))
                 .withColumn(f"avg_{short}d", F.avg("value").over(_frame(-short, -1)))
                 .withColumn(f"avg_{long}d", F.avg("value").over(_frame(-long, -1))))


def compare_on(daily: DataFrame, run_date: _dt.date, short: int = T.ROLLING_SHORT_DAYS,
               long: int = T.ROLLING_LONG_DAYS, band: float = T.TREND_STABLE_BAND_PCT,
               expected: DataFrame | None = None) -> DataFrame:
    """K1 core: today / yesterday / short and long averages for one run date, by section, product and metric.

    A metric without rows today counts 0, so a complete drop shows; ``expected`` (section, product,
    metric) adds the series that have no row in the whole window either.

    Conditional aggregation over the daily rows of the last ``long`` days: one
    grouped pass, no window, and the date range prunes the input.
    """
    day = F.col("report_date")
    lo = run_date - _dt.timedelta(days=long)
    recent = daily.where((day >= F.lit(lo)) & (day <= F.lit(run_date)))

    def in_range(days: int) -> Column:
        return (day >= F.lit(run_date - _dt.timedelta(days=days))) & (day < F.lit(run_date))

    if expected is not None:
        recent = recent.unionByName(expected.select("section", *SERIES_KEYS), allowMissingColumns=True)
    agg = recent.groupBy("section", *SERIES_KEYS).agg(
        F.coalesce(F.max(F.when(day == F.lit(run_date), F.col("value"))), F.lit(0)).alias("today"),
        F.max(F.when(day == F.lit(run_date - _dt.timedelta(days=1)), F.col("value"))).alias("yesterday"),
        F.avg(F.when(in_range(short), F.col("value"))).alias(f"avg_{short}d"),
        F.avg(F.when(in_range(long), F.col("value"))).alias(f"avg_{long}d"))
    out = agg
    for name, base in (("yesterday", "yesterday"), (f"{short}d", f"avg_{short}d"), (f"{long}d", f"avg_{long}d")):
        raw = S.variance_raw("today", base)
        out = (out.withColumn(f"var_{name}_pct", F.round(raw, 1))
                  .withColumn(f"trend_{name}", S.trend_direction(raw, band)))
    return out


def classify(cmp: DataFrame, short: int = T.ROLLING_SHORT_DAYS, warn: float = T.ANOMALY_WARN_PCT,
             crit: float = T.ANOMALY_CRIT_PCT) -> DataFrame:
    """K2 core: anomaly level and label against the short average (on the unrounded variance)."""
    raw = S.variance_raw("today", f"avg_{short}d")
    return (cmp.withColumn("level", S.anomaly_level(raw, warn, crit))
               .withColumn("label", S.anomaly_label(S.anomaly_level(raw, warn, crit), raw)))


# --------------------------------------------------------------------------- source feeds

def source_status(feed: DataFrame, expected: DataFrame, run_date: _dt.date) -> DataFrame:
    """Per expected source — available, records received on the run date, last refresh.

    The feed is filtered to the run date before aggregating (the predicate reaches the scan);
    the expected-source list is the left side, so a silent source still appears.
    """
    start = S.ntz_literal(run_date)
    end = S.ntz_literal(run_date + _dt.timedelta(days=1))
    today = (feed.where((F.col("ts") >= start) & (F.col("ts") < end))
                 .groupBy("source").agg(F.count(F.lit(1)).alias("records"), F.max("ts").alias("last_refresh")))
    return (expected.join(today, "source", "left")
                    .select("source", (F.coalesce(F.col("records"), F.lit(0)) > 0).alias("available"),
                            F.coalesce(F.col("records"), F.lit(0)).cast("bigint").alias("records"),
                            "last_refresh"))


def availability(status: DataFrame) -> DataFrame:
    """N of m sources available, and the overall badge."""
    return (status.agg(F.count(F.when(F.col("available"), True)).alias("sources_available"),
                       F.count(F.lit(1)).alias("sources_expected"))
                  .withColumn("overall_status",
                              F.when(F.col("sources_available") == F.col("sources_expected"),
                                     F.lit("All Systems Operational")).otherwise(F.lit("Degraded"))))


# --------------------------------------------------------------------------- account funnel

# Present-expression builders of the required fields, in the order of ``T.COMPLETENESS_FIELDS``.
FIELD_CHECKS = tuple(zip(T.COMPLETENESS_FIELDS, (
    lambda: F.col("dnb_number").isNotNull(), lambda: F.col("company_type").isNotNull(),
    lambda: F.col("revenue").isNotNull(), lambda: ~F.col("risk_excluded")), strict=True))


def _rule(product_col: Column, attr: str):
    """A numeric appetite parameter of the row's product, as a CASE over the rule table."""
    out = None
    for product, rule in T.PRODUCT_RULES.items():
        val = F.lit(rule[attr])
        if out is None:
            out = F.when(product_col == product, val)
        else:
            out = out.when(product_col == product, val)
    return out


def criteria_columns() -> dict[str, Column]:
    """Targeting criteria, each a boolean column; the per-product appetite is a CASE on product."""
    p = F.col("product")
    industry = None
    for product, rule in T.PRODUCT_RULES.items():
        cond = F.col("industry_code").isin(*rule["industries"])
        industry = F.when(p == product, cond) if industry is None else industry.when(p == product, cond)
    rev = F.col("revenue")
    revenue_ok = (rev >= _rule(p, "revenue_min")) & (rev <= _rule(p, "revenue_max"))
    cols = (F.coalesce(industry, F.lit(False)),
            F.coalesce(revenue_ok, F.lit(False)),
            F.coalesce(F.col("employees") > T.MIN_EMPLOYEES, F.lit(False)),
            F.coalesce(F.col("ownership") == "private", F.lit(False)))
    return dict(zip(T.CRITERIA, cols))


def account_stages(flags: DataFrame, threshold: float = T.QUALIFICATION_THRESHOLD) -> DataFrame:
    """A8 + per-account funnel flags: qualified (share of fields present >= threshold),
    each criterion, target (all criteria), prospect (target and contactable), first rejection reason."""
    present = [f().cast("int") for _, f in FIELD_CHECKS]
    share = sum(present[1:], present[0]) / float(len(present))
    crit = criteria_columns()
    target = None
    for c in crit.values():
        target = c if target is None else target & c
    reason = F.when(F.col("dnb_number").isNull(), F.lit(T.REJECTION_REASONS[0]))
    reason = (reason.when(F.col("company_type").isNull(), F.lit(T.REJECTION_REASONS[1]))
                    .when(F.col("revenue").isNull(), F.lit(T.REJECTION_REASONS[2]))
                    .when(F.col("risk_excluded"), F.lit(T.REJECTION_REASONS[3]))
                    .otherwise(F.lit(T.REJECTION_REASONS[4])))
    out = flags.withColumn("completeness", share).withColumn("qualified", share >= threshold)
    for i, (name, c) in enumerate(crit.items()):
        out = out.withColumn(f"crit_{i}", c)
    out = out.withColumn("target", F.col("qualified") & target)
    return (out.withColumn("prospect", F.col("target") & ~F.col("email_opt_out"))
               .withColumn("rejection_reason", F.when(~F.col("qualified"), reason)))


def funnel(stages: DataFrame) -> DataFrame:
    """A4: per product — total, eligible (qualified), target, rejections (total − prospects), prospects."""
    return (stages.groupBy("product")
                  .agg(F.count(F.lit(1)).alias("total_accounts"),
                       F.count(F.when(F.col("qualified"), True)).alias("eligible_accounts"),
                       F.count(F.when(F.col("target"), True)).alias("target_accounts"),
                       F.count(F.when(F.col("prospect"), True)).alias("prospects"))
                  .withColumn("rejection_count", F.col("total_accounts") - F.col("prospects")))


def stage_pct(f: DataFrame) -> DataFrame:
    """A5: each stage as a percent of total accounts."""
    t = "total_accounts"
    return f.select("product", S.pct("eligible_accounts", t).alias("eligible_pct"),
                    S.pct("target_accounts", t).alias("target_pct"),
                    S.pct("rejection_count", t).alias("rejection_pct"),
                    S.pct("prospects", t).alias("prospect_pct"))


def funnel_total(stages: DataFrame) -> DataFrame:
    """Prospects summed over products; the account universe counted once.

    Each account is reduced to one row first (map-side), so no row is expanded for a second distinct count."""
    per = stages.groupBy("account_id").agg(F.max(F.coalesce("qualified", F.lit(False))).alias("qualified"),
                                           F.count_if("prospect").alias("prospects"))
    return per.agg(F.count("account_id").alias("total_accounts"),
                   F.count_if(F.col("account_id").isNotNull() & F.col("qualified")).alias("eligible_accounts"),
                   F.coalesce(F.sum("prospects"), F.lit(0)).cast("bigint").alias("prospects"))


def field_completeness(stages: DataFrame) -> DataFrame:
    """Per product and required field — present / total, percent, missing, grade.

    One aggregation pass counts all fields, then ``stack`` turns the columns into rows.
    """
    aggs = [F.count(F.lit(1)).alias("total")]
    for i, (_, f) in enumerate(FIELD_CHECKS):
        aggs.append(F.count(F.when(f(), True)).alias(f"f{i}"))
    wide = stages.groupBy("product").agg(*aggs)
    pairs = ", ".join(f"'{label}', f{i}" for i, (label, _) in enumerate(FIELD_CHECKS))
    long = wide.select("product", "total", F.expr(f"stack({len(FIELD_CHECKS)}, {pairs}) as (field, present)"))
    raw = F.lit(100.0) * F.col("present") / F.col("total")
    return long.select("product", "field", "present", "total", F.round(raw, 1).alias("completeness_pct"),
                       (F.col("total") - F.col("present")).alias("missing"),
                       S.completeness_grade(raw).alias("grade"))


def rejections(stages: DataFrame) -> DataFrame:
    """Rejected accounts by their first failing rule; every reason shows, zeros included."""
    wide = stages.groupBy("product").agg(F.count(F.lit(1)).alias("total_accounts"), *[
        F.count_if(F.col("rejection_reason") == r).alias(f"r{i}") for i, r in enumerate(T.REJECTION_REASONS)])
    pairs = ", ".join(f"'{r}', r{i}" for i, r in enumerate(T.REJECTION_REASONS))
    long = wide.select("product", "total_accounts", F.expr(f"stack({len(T.REJECTION_REASONS)}, {pairs}) as (rejection_reason, accounts)"))
    return long.select("product", "rejection_reason", "accounts", S.pct("accounts", "total_accounts").alias("pct_of_total"))


def criteria_match(stages: DataFrame) -> DataFrame:
    """A10: each criterion alone on the qualified accounts, plus ALL; with match grade."""
    names = list(T.CRITERIA)
    q = stages.where(F.col("qualified"))
    aggs = [F.count(F.lit(1)).alias("qualified")]
    aggs += [F.count(F.when(F.col(f"crit_{i}"), True)).alias(f"m{i}") for i in range(len(names))]
    aggs.append(F.count(F.when(F.col("target"), True)).alias("m_all"))
    wide = q.groupBy("product").agg(*aggs)
    pairs = ", ".join(f"'{n}', m{i}, false" for i, n in enumerate(names))
    pairs += ", 'All Criteria Met (Final Targets)', m_all, true"
    long = wide.select("product", "qualified",
                       F.expr(f"stack({len(names) + 1}, {pairs}) as (criterion, matching, is_all)"))
    raw = F.lit(100.0) * F.col("matching") / F.col("qualified")
    return long.select("product", "criterion", "matching", "qualified", F.round(raw, 1).alias("match_pct"),
                       (F.col("qualified") - F.col("matching")).alias("excluded"),
                       S.match_grade(raw, F.col("is_all")).alias("performance"))


def exclusions(stages: DataFrame) -> DataFrame:
    """Qualified accounts by every criterion they fail (overlapping), % of qualified."""
    wide = stages.where(F.col("qualified")).groupBy("product").agg(F.count(F.lit(1)).alias("qualified"), *[
        F.count_if(~F.col(f"crit_{i}")).alias(f"x{i}") for i in range(len(T.EXCLUSION_REASONS))])
    pairs = ", ".join(f"'{r}', x{i}" for i, r in enumerate(T.EXCLUSION_REASONS))
    long = wide.select("product", "qualified", F.expr(f"stack({len(T.EXCLUSION_REASONS)}, {pairs}) as (exclusion_reason, accounts)"))
    return long.select("product", "exclusion_reason", "accounts", S.pct("accounts", "qualified").alias("pct_of_qualified"))


def conversions(f: DataFrame) -> DataFrame:
    """qualified/total, target/qualified, target/total."""
    return f.select("product", S.pct("eligible_accounts", "total_accounts").alias("qualification_rate"),
                    S.pct("target_accounts", "eligible_accounts").alias("targeting_precision"),
                    S.pct("target_accounts", "total_accounts").alias("target_conversion"))


def share(f: DataFrame, metrics=("target_accounts", "prospects", "rejection_count")) -> DataFrame:
    """Each product's share of a metric's total across products."""
    pairs = ", ".join(f"'{m}', {m}" for m in metrics)
    long = f.select("product", F.expr(f"stack({len(metrics)}, {pairs}) as (metric, value)"))
    total = F.sum("value").over(Window.partitionBy("metric"))
    return long.select("metric", "product", F.col("value").cast("bigint").alias("value"),
                       S.pct(F.col("value"), total).alias("share_pct"))


# --------------------------------------------------------------------------- quotes

COMBO_BY_MASK = {1: "Crime", 2: "EPL", 4: "Fid", 3: "C+E", 5: "C+F", 6: "E+F", 7: "All 3"}


def product_mask(product: Column) -> Column:
    return (F.when(product == "Crime", F.lit(1)).when(product == "EPL", F.lit(2))
             .when(product == "Fiduciary", F.lit(4)).otherwise(F.lit(0)))


def combo_label(mask: Column) -> Column:
    out = None
    for m, label in COMBO_BY_MASK.items():
        out = F.when(mask == m, F.lit(label)) if out is None else out.when(mask == m, F.lit(label))
    return out


def quote_status(q: DataFrame) -> DataFrame:
    """Quotes per product and status."""
    return q.groupBy("product", "status").agg(F.count(F.lit(1)).alias("quotes"))


def _month(c: str) -> Column:
    return F.date_trunc("month", F.col(c)).cast("date")


def account_baskets(q: DataFrame) -> DataFrame:
    """Per (account, month, status): quote count, and the combination of products the account
    was quoted in that month.  The raw quotes are first reduced per (account, month, status);
    the window that spreads the month's combination then sees at most a few rows per group."""
    per = (q.withColumn("quote_month", _month("quoted_on"))
             .groupBy("account_id", "quote_month", "status")
             .agg(F.count(F.lit(1)).alias("n"), F.bit_or(product_mask(F.col("product"))).alias("m")))
    basket = F.bit_or("m").over(Window.partitionBy("account_id", "quote_month"))
    return per.withColumn("combo_mask", basket).withColumn("combo", combo_label(F.col("combo_mask")))


def combo_volume(q: DataFrame, start: _dt.date | None = None, end: _dt.date | None = None) -> DataFrame:
    """Accounts by the exclusive combination of products they were quoted between ``start`` and
    ``end`` (inclusive; all quotes by default). Each account counts once; all seven combinations are shown."""
    if start is not None:
        q = q.where(F.col("quoted_on") >= F.lit(start))
    if end is not None:
        q = q.where(F.col("quoted_on") <= F.lit(end))
    mask = q.groupBy("account_id").agg(F.bit_or(product_mask(F.col("product"))).alias("mask"))
    vol = mask.groupBy(combo_label(F.col("mask")).alias("combo")).agg(F.count(F.lit(1)).alias("accounts"))
    grid = q.sparkSession.range(1).select(F.explode(F.array(*[F.lit(c) for c in T.PRODUCT_COMBOS])).alias("combo"))
    return (grid.join(vol, "combo", "left")
                .select("combo", F.coalesce(F.col("accounts"), F.lit(0)).cast("bigint").alias("accounts")))


def combo_volume_by_month(q: DataFrame) -> DataFrame:
    """Accounts per calendar month by the combination of that month; an account counts once a month."""
    b = account_baskets(q).select("account_id", "quote_month", "combo").distinct()
    return b.groupBy("quote_month", "combo").agg(F.count(F.lit(1)).alias("accounts"))


PIVOT_NAMES = {"Crime": "crime", "EPL": "epl", "Fid": "fid", "C+E": "crime_epl", "C+F": "crime_fid",
               "E+F": "epl_fid", "All 3": "all_three"}


def status_matrix(q: DataFrame) -> DataFrame:
    """Quote status × product combination; an empty cell is NULL.  The seven pivot values
    are passed explicitly, so no extra job discovers them and the column order is fixed."""
    b = account_baskets(q)
    names = [PIVOT_NAMES[c] for c in T.PRODUCT_COMBOS]
    label = None
    for c in T.PRODUCT_COMBOS:
        label = (F.when(F.col("combo") == c, F.lit(PIVOT_NAMES[c])) if label is None
                 else label.when(F.col("combo") == c, F.lit(PIVOT_NAMES[c])))
    return (b.withColumn("combo_col", label).groupBy("status").pivot("combo_col", names).agg(F.sum("n"))
             .select("status", *[F.col(n).cast("bigint").alias(n) for n in names]))


def aging_alerts(q: DataFrame, run_date: _dt.date, days: int = T.AGING_ALERT_DAYS,
                 status: str = "Waiting Pickup") -> DataFrame:
    """items waiting more than ``days`` days on the run date."""
    waited = S.aging_days("quoted_on", run_date)
    return (q.where((F.col("status") == status) & (F.col("quoted_on") <= F.lit(run_date)) & (waited > days))
             .select("quote_id", "account_id", "product", waited.alias("days_waiting")))
