"""Daily KPI report jobs (K1-K5, T2, A16-A18): the tables behind the rendered reports.

Only the final report rows (a few per product and metric) are small; every
input is reduced by a grouped aggregation first, and no step collects to the
driver.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .. import thresholds as T
from ..functions import scalar as S
from ..operators import kpi as K


def kpi_comparison(daily: DataFrame, run_date: _dt.date, expected: DataFrame | None = None) -> DataFrame:
    """K1: per section, product and metric — today, yesterday, 7D and 30D averages, three variances, three trends."""
    return K.compare_on(daily, run_date, expected=expected)


def kpi_anomalies(daily: DataFrame, run_date: _dt.date, expected: DataFrame | None = None) -> DataFrame:
    """K2: K1 plus anomaly level and label against the 7-day average."""
    return K.classify(K.compare_on(daily, run_date, expected=expected)).select(
        "section", "product", "metric", "today", "avg_7d", "var_7d_pct", "level", "label")


def health_rollup(anomalies: DataFrame) -> DataFrame:
    """Per section, the products with a critical metric (two critical metrics of one product are
    one anomaly), and the section badge. Warnings are counted beside it and don't change the badge."""
    n = F.col("critical_products")
    return anomalies.groupBy("section").agg(
        F.count_distinct("product").alias("products"),
        F.count_distinct(F.when(F.col("level") == "critical", F.col("product"))).alias("critical_products"),
        F.count_if(F.col("level") == "critical").alias("critical_metrics"),
        F.count_if(F.col("level") == "warning").alias("warning_metrics")).withColumn(
        "status", F.when(n == 0, F.lit("Healthy")).when(n == 1, F.lit("1 Anomaly"))
                   .otherwise(F.concat(n.cast("string"), F.lit(" Anomalies"))))


def records_received(status: DataFrame) -> DataFrame:
    """Total records received over all sources."""
    return status.agg(F.sum("records").cast("bigint").alias("total_records"))


def executive_summary(status: DataFrame, anomalies: DataFrame, quotes: DataFrame,
                      quote_date: _dt.date) -> DataFrame:
    """K3: one row — source health, records, anomaly count, quotes sent on the quote run date.

    The three inputs are tagged and unioned, then one aggregation computes every figure
    (no join between the single-row summaries).
    """
    none_b, none_l, none_s = F.lit(None).cast("boolean"), F.lit(None).cast("bigint"), F.lit(None).cast("string")
    u = (status.select(F.lit("src").alias("kind"), F.col("available"), F.col("records"), none_s.alias("level"))
         .unionByName(anomalies.select(F.lit("kpi").alias("kind"), none_b.alias("available"),
                                       none_l.alias("records"), F.col("level")))
         .unionByName(quotes.where((F.col("quoted_on") == F.lit(quote_date)) & (F.col("status") == "Quotes Sent"))
                            .select(F.lit("quote").alias("kind"), none_b.alias("available"),
                                    none_l.alias("records"), none_s.alias("level"))))
    kind = F.col("kind")
    out = u.agg(F.count(F.when((kind == "src") & F.col("available"), True)).alias("sources_available"),
                F.count(F.when(kind == "src", True)).alias("sources_expected"),
                F.coalesce(F.sum("records"), F.lit(0)).cast("bigint").alias("total_records"),
                F.count(F.when(F.col("level").isin("warning", "critical"), True)).alias("anomalies"),
                F.count(F.when(kind == "quote", True)).alias("quotes_sent"))
    return out.withColumn("overall_status",
                          F.when(F.col("sources_available") == F.col("sources_expected"),
                                 F.lit("All Systems Operational")).otherwise(F.lit("Degraded")))


def action_items(anomalies: DataFrame, status: DataFrame) -> DataFrame:
    """Ranked issues by product — silent sources and critical metrics High, metrics at warning level below
    their average Medium, those above it Low — with the gap today − 7-day average; ordered by rank then |variance|."""
    src = (status.where(~F.col("available"))
                 .select(F.lit("High").alias("priority"), F.lit(1).alias("priority_rank"),
                         F.lit(None).cast("string").alias("product"), F.col("source").alias("subject"),
                         F.lit("Source data delayed - no records received").alias("issue"),
                         F.lit(None).cast("double").alias("variance_pct"),
                         F.lit(None).cast("double").alias("gap")))
    flagged = anomalies.where(F.col("level").isin("critical", "warning"))
    rank = F.when(F.col("level") == "critical", 1).when(F.col("var_7d_pct") < 0, 2).otherwise(3)
    met = flagged.select(
        F.element_at(F.array(F.lit("High"), F.lit("Medium"), F.lit("Low")), rank).alias("priority"),
        rank.alias("priority_rank"), F.col("product"),
        F.col("metric").alias("subject"),
        F.concat(F.col("metric"), F.when(F.col("var_7d_pct") < 0, F.lit(" below 7-day average"))
                 .otherwise(F.lit(" above 7-day average"))).alias("issue"),
        F.col("var_7d_pct").alias("variance_pct"),
        F.round(F.col("today") - F.col("avg_7d"), 1).alias("gap"))
    return src.unionByName(met).orderBy("priority_rank", F.abs(F.col("variance_pct")).desc_nulls_first())


def daily_funnel(quotes: DataFrame, stages: DataFrame, run_date: _dt.date,
                 long: int = T.ROLLING_LONG_DAYS) -> DataFrame:
    """Funnel per (day, product) over the accounts quoted that day, for the last ``long`` days."""
    lo = run_date - _dt.timedelta(days=long)
    q = (quotes.where((F.col("quoted_on") >= F.lit(lo)) & (F.col("quoted_on") <= F.lit(run_date)))
               .select(F.col("quoted_on").alias("report_date"), "product", "account_id").distinct())
    st = stages.select("account_id", "product", "qualified", "target", "prospect")
    j = q.join(st, ["account_id", "product"], "inner")
    return j.groupBy("report_date", "product").agg(
        F.count(F.lit(1)).alias("total_accounts"),
        F.count(F.when(F.col("qualified"), True)).alias("eligible_accounts"),
        F.count(F.when(F.col("target"), True)).alias("target_accounts"),
        F.count(F.when(F.col("prospect"), True)).alias("prospects"))


def funnel_with_averages(quotes: DataFrame, stages: DataFrame, run_date: _dt.date,
                         short: int = T.ROLLING_SHORT_DAYS, long: int = T.ROLLING_LONG_DAYS) -> DataFrame:
    """K4: today's funnel per product plus 7D / 30D averages of prospects (days present)."""
    df = daily_funnel(quotes, stages, run_date, long)
    day = F.col("report_date")

    def rng(n: int):
        return (day >= F.lit(run_date - _dt.timedelta(days=n))) & (day < F.lit(run_date))

    today = day == F.lit(run_date)
    return df.groupBy("product").agg(
        F.max(F.when(today, F.col("total_accounts"))).alias("total_accounts"),
        F.max(F.when(today, F.col("eligible_accounts"))).alias("eligible_accounts"),
        F.max(F.when(today, F.col("target_accounts"))).alias("target_accounts"),
        F.max(F.when(today, F.col("prospects"))).alias("prospects"),
        F.avg(F.when(rng(short), F.col("prospects"))).alias(f"prospects_avg_{short}d"),
        F.avg(F.when(rng(long), F.col("prospects"))).alias(f"prospects_avg_{long}d"))


def combo_volume_trend(quotes: DataFrame) -> DataFrame:
    """K5: monthly account volume per product combination against the previous calendar month."""
    vol = K.combo_volume_by_month(quotes)
    month_no = F.year("quote_month") * 12 + F.month("quote_month")
    prev = F.max("accounts").over(Window.partitionBy("combo").orderBy(month_no).rangeBetween(-1, -1))
    return (vol.withColumn("prev_accounts", prev)
               .withColumn("delta_abs", S.delta_abs("accounts", "prev_accounts"))
               .withColumn("delta_pct", S.variance_pct("accounts", "prev_accounts")))


def combo_volume_period(quotes: DataFrame, start: _dt.date, end: _dt.date) -> DataFrame:
    """K5 for one period: accounts per product combination from ``start`` to ``end``, and the change against the period of
    as many days right before it, in one pass over the quotes of both.  All seven combinations are shown, 0 where a period has none."""
    before = start - (end - start) - _dt.timedelta(days=1)
    rows = quotes.where(F.col("quoted_on").between(before, end))
    held = rows.groupBy("account_id", (F.col("quoted_on") >= F.lit(start)).alias("now")).agg(F.bit_or(K.product_mask(F.col("product"))).alias("mask"))
    vol = held.groupBy(K.combo_label(F.col("mask")).alias("combo")).agg(F.count_if("now").alias("now"), F.count_if(~F.col("now")).alias("before"))
    grid = quotes.sparkSession.range(1).select(F.explode(F.array(*[F.lit(c) for c in T.PRODUCT_COMBOS])).alias("combo"))
    zero = F.lit(0).cast("bigint")
    return (grid.join(vol, "combo", "left")
            .select("combo", F.coalesce("now", zero).alias("accounts"), F.coalesce("before", zero).alias("prev_accounts"))
            .withColumn("delta_abs", S.delta_abs("accounts", "prev_accounts"))
            .withColumn("delta_pct", S.variance_pct("accounts", "prev_accounts")))
