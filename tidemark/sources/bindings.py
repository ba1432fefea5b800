"""Fixture views: the job schemas, derived from the driver's parquet tables.

Every view is a lazy DataFrame over the whole input tables, so its size grows
with the scale factor.  Expressions are chosen to mean the same in Spark SQL
and DuckDB (1-based ``substr``, ``floor(x / 4.0)`` cast to bigint, ``%`` on
non-negative keys), which is what lets every query have an SQL oracle.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import thresholds as T
from ..functions.scalar import fn_date_to_int, ntz_literal
from .tables import dealt, read_table

KEY3 = ("originating_business_unit", "claim_number", "claimant_number")
TXN_KEY3 = ("business_unit", "claim_number", "claimant_number")

CLAIMANT_COLUMNS = tuple(c for c in T.HISTORY_COLUMNS if c not in ("valid_from_date", "sequence_number"))


def carried_type(name: str) -> str:
    """Type of a carried (unmapped) claimant column: yyyymmdd ints for dates, else strings."""
    return "int" if ("date" in name or name.startswith("bep_") or name.endswith("_bep_closed")) else "string"


def claimant_types() -> dict[str, str]:
    types = {c: carried_type(c) for c in CLAIMANT_COLUMNS}
    types.update(claimant_key="bigint", claim_number="string", claimant_number="bigint",
                 originating_business_unit="string", salvage_status="string",
                 subrogation_status="string", tp_deductible_status="string",
                 recovery_date_closed="int", recovery_status="string",
                 claimant_reserve_curr="double", claimant_type="string", claimant_name="string")
    return types


def _char_at(letters: str, idx: Column) -> Column:
    return F.lit(letters).substr(idx.cast("int"), F.lit(1))


def _claim_number(key: Column) -> Column:
    return F.floor(key / 4.0).cast("bigint").cast("string")


def _claimant_number(key: Column) -> Column:
    return (key % 4 + 1).cast("bigint")


def nations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_table(spark, sf_dir, "nation", "n_nationkey", "n_name", "n_regionkey")


def order_units(spark: SparkSession, sf_dir: str, *order_cols: str, with_name: bool = False) -> DataFrame:
    """orders ⋈ customer ⋈ nation: each order with its business unit (nation name).

    The nation side is a fixed-size dimension, broadcast behind a row-count check.
    """
    o = read_table(spark, sf_dir, "orders", "o_orderkey", "o_custkey", *order_cols)
    c = read_table(spark, sf_dir, "customer", "c_custkey", "c_nationkey", *(("c_name",) if with_name else ()))
    n = nations(spark, sf_dir).select("n_nationkey", "n_name")
    return (o.join(c, o.o_custkey == c.c_custkey)
             .join(n, F.col("c_nationkey") == F.col("n_nationkey"))
             .drop("c_custkey", "n_nationkey"))


def claimant(spark: SparkSession, sf_dir: str, wide: bool = True) -> DataFrame:
    """Master table, one row per order.  ``wide`` adds the 68 carried NULL columns."""
    base = order_units(spark, sf_dir, "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority",
                       with_name=True)
    k = F.col("o_orderkey")
    mapped = {
        "claimant_key": k,
        "claim_number": _claim_number(k),
        "claimant_number": _claimant_number(k),
        "originating_business_unit": F.col("n_name"),
        "salvage_status": F.when(k % 97 != 0, _char_at("CFWNCOX", k % 7 + 1)),
        "subrogation_status": _char_at("CFWNCFWNO", F.col("o_custkey") % 9 + 1),
        "tp_deductible_status": _char_at("NCFWR", F.col("o_custkey") % 5 + 1),
        "recovery_date_closed": (F.when(k % 3 == 0, F.lit(0))
                                  .when(k % 3 == 1, F.lit(None).cast("int"))
                                  .otherwise(fn_date_to_int(F.col("o_orderdate")))),
        "recovery_status": (F.when(F.col("o_orderstatus") == "F", F.lit("C"))
                             .when(F.col("o_orderstatus") == "O", F.lit("O"))),
        "claimant_reserve_curr": F.col("o_totalprice"),
        "claimant_type": F.col("o_orderpriority"),
        "claimant_name": F.col("c_name"),
    }
    types = claimant_types()
    cols = []
    for name in CLAIMANT_COLUMNS:
        if name in mapped:
            cols.append(mapped[name].cast(types[name]).alias(name))
        elif wide:
            cols.append(F.lit(None).cast(types[name]).alias(name))
    return base.select(*cols)


def claim_stage_consol(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Transaction log: one row per line item, keyed like its order's claimant."""
    li = read_table(spark, sf_dir, "lineitem", "l_orderkey", "l_partkey", "l_suppkey",
                    "l_linenumber", "l_shipdate")
    units = order_units(spark, sf_dir).select("o_orderkey", "n_name")
    txn_date = fn_date_to_int(F.col("l_shipdate"))
    k = F.col("l_orderkey")
    return (li.join(units, li.l_orderkey == units.o_orderkey)
              .select(F.col("n_name").alias("business_unit"),
                      _claim_number(k).alias("claim_number"),
                      _claimant_number(k).alias("claimant_number"),
                      txn_date.alias("transaction_date"),
                      (F.col("l_linenumber") + 4).cast("string").alias("transaction_code"),
                      F.when(F.col("l_partkey") % 50 != 0, txn_date).alias("accounting_dt"),
                      (F.col("l_partkey") * 1000 + F.col("l_suppkey")).alias("voucher_number")))


def wt_check_claim_iot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Work queue: claimants whose order priority is urgent or high."""
    o = order_units(spark, sf_dir, "o_orderpriority")
    k = F.col("o_orderkey")
    return (o.where(F.col("o_orderpriority").isin("1-URGENT", "2-HIGH"))
             .select(F.col("n_name").alias("originating_business_unit"),
                     _claim_number(k).alias("claim_number"),
                     _claimant_number(k).alias("claimant_number")))


def business_unit_xref(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = nations(spark, sf_dir)
    return n.select(F.col("n_name").alias("business_unit"),
                    F.when(F.col("n_regionkey") != 0, F.lit("Y")).otherwise(F.lit("N"))
                     .alias("recovery_date_closed_rqd"))


# ---------------------------------------------------------------------------
# KPI fixtures
# ---------------------------------------------------------------------------

def account_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each customer once per product (a generator over the fixed product list, not a join)."""
    c = read_table(spark, sf_dir, "customer", "c_custkey", "c_nationkey", "c_acctbal", "c_mktsegment")
    k = F.col("c_custkey")
    return c.select(
        k.alias("account_id"),
        F.explode(F.array(*[F.lit(p) for p in T.PRODUCTS])).alias("product"),
        F.when(k % 40 != 0, k).alias("dnb_number"),
        F.when(k % 31 != 0, F.col("c_mktsegment")).alias("company_type"),
        F.when(F.col("c_acctbal") >= 0, F.col("c_acctbal")).alias("revenue"),
        (k % 12 == 0).alias("risk_excluded"),
        F.col("c_nationkey").alias("industry_code"),
        (k % 20).alias("employees"),
        F.when(k % 10 == 0, F.lit("public")).otherwise(F.lit("private")).alias("ownership"),
        (k % 17 == 0).alias("email_opt_out"),
    )


#: The feed's sources and the metrics of a daily report.
EVENT_TYPES = ("view", "signup", "error", "click", "purchase")


def _day_range(col: str, start: _dt.date | None, end: _dt.date | None) -> Column | None:
    """``start <= col < end + 1 day`` on the raw timestamp, so the scan can skip files / row groups."""
    cond = None
    if start is not None:
        cond = F.col(col) >= ntz_literal(start)
    if end is not None:
        hi = F.col(col) < ntz_literal(end + _dt.timedelta(days=1))
        cond = hi if cond is None else cond & hi
    return cond


def daily_metric(spark: SparkSession, sf_dir: str, start: _dt.date | None = None,
                 end: _dt.date | None = None) -> DataFrame:
    """Events counted per (day, product, event type), product by user and section by product; partial
    aggregation shrinks it map-side.  A day without events has no row.
    ``start`` / ``end`` (inclusive days) filter the raw timestamps before the scan."""
    ev = read_table(spark, sf_dir, "events", "ts", "user_id", "event_type")
    rng = _day_range("ts", start, end)
    return daily_counts(ev if rng is None else ev.where(rng))


def on_days(col: str, days: list[_dt.date]) -> Column:
    """Whether a raw timestamp lies on one of the days, as one range for each stretch of days, so that the scan can skip the rest."""
    cond, days = F.lit(False), sorted(set(days))
    while days:
        n = next((i for i in range(1, len(days)) if days[i] - days[i - 1] > _dt.timedelta(days=1)), len(days))
        cond, days = cond | _day_range(col, days[0], days[n - 1]), days[n:]
    return cond


def daily_counts(ev: DataFrame) -> DataFrame:
    """Raw events (ts, user_id, event_type) counted per (day, product, event type)."""
    k = F.col("user_id") % 3
    product = F.when(k == 0, F.lit("Crime")).when(k == 1, F.lit("EPL")).otherwise(F.lit("Fiduciary"))
    return (ev.groupBy(F.to_date("ts").alias("report_date"), product.alias("product"), F.col("event_type").alias("metric"))
              .agg(F.count(F.lit(1)).alias("value"))
              .select("report_date", _section(F.col("product")).alias("section"), "product", "metric", "value"))


def _section(product: Column) -> Column:
    return F.when(product == "Crime", F.lit("Crime")).otherwise(F.lit("Liability"))


def expected_series(spark: SparkSession) -> DataFrame:
    """The (section, product, metric) rows that a daily report must have, with or without events: a fixed list."""
    rows = [(p, m) for p in ("Crime", "EPL", "Fiduciary") for m in EVENT_TYPES]
    return (spark.range(1).select(F.explode(F.array(*[F.struct(F.lit(p).alias("product"), F.lit(m).alias("metric")) for p, m in rows])).alias("x"))
            .select(_section(F.col("x.product")).alias("section"), "x.product", "x.metric"))


def feed_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw feed rows: one event = one received record of source ``event_type``."""
    return read_table(spark, sf_dir, "events", "ts", "event_type").select(
        F.col("event_type").alias("source"), F.col("ts"))


def expected_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The sources that must report: a small fixed list (no scan of the feed's history), one of which never does."""
    return spark.range(1).select(F.explode(F.array(*map(F.lit, (*EVENT_TYPES, "partner_feed")))).alias("source"))


def quotes(spark: SparkSession, sf_dir: str, start: _dt.date | None = None,
           end: _dt.date | None = None) -> DataFrame:
    """One quote per order: product by key, account = customer, status by priority.
    ``start`` / ``end`` (inclusive days) filter the raw order dates before the scan."""
    o = read_table(spark, sf_dir, "orders", "o_orderkey", "o_custkey", "o_orderdate", "o_orderpriority")
    rng = _day_range("o_orderdate", start, end)
    if rng is not None:
        o = o.where(rng)
    k = F.col("o_orderkey")
    pr = F.substring(F.col("o_orderpriority"), 1, 1)
    return o.select(
        k.alias("quote_id"),
        F.col("o_custkey").alias("account_id"),
        F.when(k % 3 == 0, F.lit("Crime")).when(k % 3 == 1, F.lit("EPL")).otherwise(F.lit("Fiduciary"))
         .alias("product"),
        F.when(pr.isin("1", "5"), F.lit("Quotes Sent")).when(pr == "2", F.lit("Waiting Pickup"))
         .when(pr == "3", F.lit("Failed")).otherwise(F.lit("Opt-Out")).alias("status"),
        F.to_date("o_orderdate").alias("quoted_on"),
    )


# ---------------------------------------------------------------------------
# Lineage fixtures
# ---------------------------------------------------------------------------

def _obj(key: Column) -> Column:
    return F.concat(F.lit("T"), key.cast("string"))


def lineage_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Object edges T(k) -> T(k/2) and T(k) -> T(k/3): acyclic, two parents per node."""
    p = read_table(spark, sf_dir, "part", "p_partkey", "p_size").where(F.col("p_partkey") > 0)
    k = F.col("p_partkey")
    return p.select(
        _obj(k).alias("src"),
        F.explode(F.array(_obj(F.floor(k / 2.0).cast("bigint")),
                          _obj(F.floor(k / 3.0).cast("bigint")))).alias("dst"),
        F.col("p_size"), k.alias("query_id"))


def access_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nested runtime access log: one entry per query, reads and writes as arrays of structs.

    ``writes`` = array<struct<object, columns array<struct<column, sources array<struct<object, column>>>>>>.
    """
    p = dealt(read_table(spark, sf_dir, "part", "p_partkey", "p_size").where(F.col("p_partkey") > 0), "p_partkey")
    k, names = F.col("p_partkey"), ("c1", "c2", "c3")
    src = _obj(k)

    def turned(i: int):
        return F.concat(F.lit("c"), ((F.lit(i) + F.col("p_size") % 3) % 3 + 1).cast("string"))

    def column(i: int):
        source = F.struct(src.alias("object"), F.lit(names[i]).alias("column"))
        return F.struct(turned(i).alias("column"), F.array(source).alias("sources"))

    columns = F.array(*[column(i) for i in range(3)]).alias("columns")
    half, third = (_obj(F.floor(k / d).cast("bigint")) for d in (2.0, 3.0))
    targets = F.array(F.struct(half.alias("object"), columns), F.struct(third.alias("object"), columns))
    return p.select(k.alias("query_id"),
                    (F.lit("2024-01-01 00:00:00").cast("timestamp_ntz")
                     + F.make_dt_interval(F.lit(0), F.lit(0), k.cast("int"))).alias("ts"),
                    F.array(F.struct(src.alias("object"), F.array(*map(F.lit, names)).alias("columns"))).alias("reads"),
                    targets.alias("writes"))


def query_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Procedure hierarchy from conversations: id = conv*100+turn, parent = conv*100 for turn > 0."""
    cv = read_table(spark, sf_dir, "conversations", "conv_id", "turn", "role")
    return cv.select((F.col("conv_id") * 100 + F.col("turn")).alias("query_id"),
                     F.when(F.col("turn") > 0, F.col("conv_id") * 100).alias("parent_query_id"),
                     F.col("role"), F.col("conv_id"))


def call_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Call forest over the queries of the access log: query k is called by query k / 4; 1, 2 and 3 are called by none."""
    p = read_table(spark, sf_dir, "part", "p_partkey", "p_size").where(F.col("p_partkey") > 0)
    k = F.col("p_partkey")
    role = F.when(F.col("p_size") % 3 == 0, F.lit("select")).when(F.col("p_size") % 3 == 1, F.lit("insert")).otherwise(F.lit("merge"))
    return p.select(k.alias("query_id"), F.when(k >= 4, F.floor(k / 4.0).cast("bigint")).alias("parent_query_id"), role.alias("role"))


def query_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SQL text per lineage query, built from part keys (exercises text fact extraction)."""
    p = dealt(read_table(spark, sf_dir, "part", "p_partkey", "p_size").where(F.col("p_partkey") > 0), "p_partkey")
    k = F.col("p_partkey").cast("string")
    half = F.floor(F.col("p_partkey") / 2.0).cast("bigint").cast("string")
    sz = F.col("p_size").cast("string")
    shape = F.col("p_partkey") % 6
    plain = F.concat(
        F.lit("INSERT INTO T"), half, F.lit(" SELECT a.c1, CASE WHEN a.c2 > "), sz,
        F.lit(" THEN 'big' ELSE 'small' END AS c2 FROM T"), k, F.lit(" a JOIN T"), k,
        F.lit(" b ON a.c1 = b.c1 WHERE a.c3 >= "), sz, F.lit(" AND b.c2 IS NOT NULL"))
    lower = F.concat(F.lit("insert into db.T"), half, F.lit(" select a.c1 from db.T"), k, F.lit(" as a left join db.T"), k,
                     F.lit(" as b on a.c1 = b.c2 where a.c3 < "), sz, F.lit(" group by a.c1 order by 1"))
    lines = F.concat(F.lit("SELECT a.c1\nFROM T"), k, F.lit(" a\nJOIN T"), half, F.lit(" b ON a.c1 = b.c1\nJOIN T"), k,
                     F.lit(" c\n  ON b.c2 = c.c2\nWHERE c.c3 = "), sz, F.lit("\nLIMIT 5;"))
    bare = F.concat(F.lit("SELECT * FROM T"), k, F.lit(" a JOIN s.T"), half, F.lit(" ON a.c1 = T"), half, F.lit(".c1"))
    nested = F.concat(
        F.lit("INSERT INTO T"), half, F.lit(" /* WHERE old */ SELECT s.c1, CASE WHEN s.c2 > "), sz,
        F.lit(" THEN CASE s.c3 WHEN 'END' THEN 1 ELSE 2 END ELSE 0 END FROM (SELECT c1, c2, c3 FROM T"), k, F.lit(" WHERE c3 < "), sz,
        F.lit(") s JOIN (SELECT c1 FROM T"), half, F.lit(") b USING (c1) WHERE s.c1 <> ' WHERE ' -- JOIN x ON y\n AND b.c1 > 0"))
    merge = F.concat(F.lit("MERGE INTO T"), half, F.lit(" t USING T"), k, F.lit(" s ON t.c1 = s.c1 AND s.c2 IN (SELECT c2 FROM T"), k,
                     F.lit(" WHERE c3 = "), sz, F.lit(") WHEN MATCHED AND s.c3 > 1 THEN UPDATE SET c2 = s.c2"))
    text = (F.when(shape == 0, plain).when(shape == 1, lower).when(shape == 2, lines).when(shape == 3, nested).when(shape == 4, merge)
            .otherwise(bare))
    return p.select(F.col("p_partkey").alias("query_id"), text.alias("text"))


def dq_results(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = read_table(spark, sf_dir, "events", "event_id", "ts", "user_id", "event_type", "value")
    return ev.select(_obj(F.col("user_id")).alias("object"), F.col("event_type").alias("test"),
                     F.when(F.col("value") > 200, F.lit("fail")).otherwise(F.lit("pass")).alias("status"),
                     F.col("value").alias("score"), "ts", "event_id")


def object_meta(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = read_table(spark, sf_dir, "part", "p_partkey", "p_brand")
    k = F.col("p_partkey")
    return p.select(_obj(k).alias("object"),
                    F.when(k % 3 == 0, F.lit("table")).when(k % 3 == 1, F.lit("view"))
                     .otherwise(F.lit("procedure")).alias("kind"),
                    F.col("p_brand").alias("owner"))


def object_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Catalog rows: one per (object, column)."""
    p = read_table(spark, sf_dir, "part", "p_partkey")
    return p.select(_obj(F.col("p_partkey")).alias("object"),
                    F.explode(F.array(F.lit("c1"), F.lit("c2"), F.lit("c3"))).alias("column_name"))
