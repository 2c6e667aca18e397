"""Registry of the operator queries run on the driver tables (role mapping in ``standin``).

Each entry takes ``(spark, sf_dir)`` and returns a lazy DataFrame over the whole input tables;
the matching DuckDB SQL is in ``strata.plans.oracle``.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.functions.pick import md5_index
from strata.functions.text import ckey, na, std
from strata.operators import control, partitions, prepare, quality
from strata.operators.calendar import dim_dates, dim_times
from strata.operators.keys import assign_keys, ensure_default, lookup, lookup_first, max_id
from strata.operators.latest import latest_by, map_recency
from strata.operators.pit import point_in_time_join
from strata.operators.scd2 import scd2_merge
from strata.operators.upsert import ACTION, insert_absent
from strata.operators.staging import stage_rows
from strata.operators.sequence import with_next
from strata.plans import marts, standin as S, whole_run
from strata.session import stage
from strata.sources.tables import Tables

Query = Callable[[SparkSession, str], DataFrame]


# ---- staging, latest record, union ----------------------------------------------------------

def stage_fingerprint(spark, d):
    """Required fields and the fingerprint over every column but the time."""
    f = S.sales_feed(spark, d)
    columns = ["transaction_id", "customer_id", "product_id", "employee_id", "payment_method", "card_type",
               "verification_method", "quantity", "price", "discount", "total_amount", "source_system", "event_dt"]
    rows = stage_rows(f, columns, S.BATCH1_TS, required=("transaction_id", "event_dt"), unhashed=("event_dt",))
    return rows.select("transaction_id", "event_dt", "source_system", "hash_value")


def stage_append_dedup(spark, d):
    _, r2 = S.staged(spark, d)
    return r2.table.select(*S.STAGE_COLS)


def incremental_filter(spark, d):
    """Rows staged after the batch-1 watermark (strict ``>``), read through the load table."""
    _, r2 = S.staged(spark, d)
    loads = control.touch_load(spark.createDataFrame([], control.LOADS_SCHEMA), "SP_CL_LOAD_T_MAP_PRODUCTS",
                               S.BATCH1_TS)
    mark = control.last_load(loads, "SP_CL_LOAD_T_MAP_PRODUCTS")
    return r2.table.filter(F.col("load_dt") > F.lit(mark)).select(*S.STAGE_COLS)


def latest_per_key(spark, d):
    f = S.sales_feed(spark, d)
    return latest_by(f, ["transaction_id"], S.by_recency()).select(
        "transaction_id", "event_dt", "hash_value", "product_id", "quantity", "price")


def latest_composite_key(spark, d):
    f = S.sales_feed(spark, d).withColumn("customer_product_key", ckey("customer_id", "product_id"))
    return latest_by(f, ["customer_product_key"], S.by_recency()).select(
        "customer_product_key", "customer_id", "product_id", "event_dt", "price", "hash_value")


def union_sources(spark, d):
    """Two channel feeds, ranked and padded each by itself, in one layout."""
    feed = stage(S.sales_feed(spark, d), "union-feed")
    return S.union_of_channels(feed.filter(F.col("source_system") == "SA_ONLINE"), feed.filter(F.col("source_system") == "SA_OFFLINE"))


# ---- keys --------------------------------------------------------------------------------------

def map_or_mint_q(spark, d):
    return S.product_map(spark, d)


def assign_keys_q(spark, d):
    o = Tables(spark, d).orders.select(F.col("o_custkey").cast("string").alias("customer_src_id"), "o_orderdate")
    first = o.filter(F.col("o_orderdate") < S.ts_lit(S.BATCH1_CUTOFF)).select("customer_src_id").distinct()
    first = assign_keys(first, ["customer_src_id"], "customer_id")
    later = o.select("customer_src_id").distinct().join(first.select("customer_src_id"), "customer_src_id",
                                                        "left_anti")
    later = assign_keys(later, ["customer_src_id"], "customer_id", offset=max_id(first, "customer_id"))
    return first.unionByName(later)


CE_CUSTOMER_DEFAULT = {"customer_id": -1, "customer_src_id": "N/A", "customer_name": "N/A", "segment": "N/A",
                       "source_system": "MANUAL", "source_entity": "MANUAL",
                       "insert_dt": _dt.datetime(1900, 1, 1), "update_dt": _dt.datetime(1900, 1, 1)}


def default_member(spark, d):
    c = Tables(spark, d).customer.select(F.col("c_custkey").cast("string").alias("customer_src_id"),
                                         na("c_name").alias("customer_name"), na("c_mktsegment").alias("segment"))
    ce = assign_keys(c, ["customer_src_id"], "customer_id").select(
        "customer_id", "customer_src_id", "customer_name", "segment", F.lit("SA_ONLINE").alias("source_system"),
        F.lit(S.SRC_ENTITY).alias("source_entity"), S.ts_lit(S.BATCH1_TS).alias("insert_dt"),
        S.ts_lit(S.BATCH1_TS).alias("update_dt"))
    return ensure_default(ce, CE_CUSTOMER_DEFAULT, "customer_id")


def lookup_unknown(spark, d):
    o = Tables(spark, d).orders
    known = (o.filter(F.col("o_orderdate") < S.ts_lit(S.BATCH1_CUTOFF))
             .select(F.col("o_custkey").cast("string").alias("customer_src_id")).distinct())
    ce = assign_keys(known, ["customer_src_id"], "customer_id")
    return lookup(o.select("o_orderkey", F.col("o_custkey").cast("string").alias("_ck")), ce, "_ck",
                  "customer_src_id", "customer_id", "customer_id").drop("_ck")


def lateral_top1(spark, d):
    f = S.sales_feed(spark, d)
    m = S.product_map(spark, d)
    out = lookup_first(f, m, std("product_id"), "product_src_id", "product_id", "map_product_id",
                       order=[F.col("source_system").asc(), F.col("hash_value").asc()])
    return out.select("transaction_id", "event_dt", "product_id", "map_product_id")


# ---- upsert ------------------------------------------------------------------------------------

def upsert_insert(spark, d):
    return S.customer_upsert(spark, d).inserted


def upsert_update(spark, d):
    return S.customer_upsert(spark, d).updated


def upsert_counts(spark, d):
    return S.customer_upsert(spark, d).counts()


# ---- SCD2 and point-in-time ------------------------------------------------------------------

def scd2_history(spark, d):
    return S.employee_versions(spark, d)


def scd2_late_merge(spark, d):
    """H1, H3: versions from every non-purchase event, then the purchase events arrive late and are
    folded in by the event rule."""
    ev = S.employee_events(spark, d)
    first = S.employee_versions(spark, d, exclude_type="PURCHASE")
    keys = assign_keys(first.select("employee_src_id").distinct(), ["employee_src_id"], "employee_id")
    first = first.join(keys, "employee_src_id")
    late = ev.filter(F.col("event_type") == "PURCHASE").select("employee_src_id", "ts", "event_type")
    out = scd2_merge(first, late, "employee_src_id", "ts", ["event_type"], id_col="employee_id")
    cols = ["employee_id", "employee_src_id", "event_type", "start_dt", "end_dt", "is_active"]
    untouched = first.join(late.select("employee_src_id").distinct(), "employee_src_id", "left_anti")
    return out.select(*cols).unionByName(untouched.select(*cols))


def versions_with_surrogates(spark, d):
    v = S.employee_versions(spark, d, exclude_type="PURCHASE")
    return assign_keys(v, ["employee_src_id", "start_dt"], "employee_surr_id")


def point_in_time_join_q(spark, d):
    v = versions_with_surrogates(spark, d)
    probes = S.employee_events(spark, d).filter(F.col("event_type") == "PURCHASE")
    out = point_in_time_join(probes, v, fact_key="employee_src_id", fact_ts="ts", version_key="employee_src_id",
                             take=["event_type"], id_col="employee_surr_id", out_id="employee_surr_id")
    return out.select("event_id", "employee_src_id", "ts",
                      F.coalesce("v_event_type", F.lit("N/A")).alias("version_event_type"), "employee_surr_id")


def point_in_time_join_bucketed(spark, d):
    """Same join, evaluated with month buckets on both sides (the hot-key form)."""
    v = versions_with_surrogates(spark, d)
    probes = S.employee_events(spark, d).filter(F.col("event_type") == "PURCHASE")
    out = point_in_time_join(probes, v, fact_key="employee_src_id", fact_ts="ts", version_key="employee_src_id",
                             take=["event_type"], id_col="employee_surr_id", out_id="employee_surr_id",
                             bucket_months=True)
    return out.select("event_id", "employee_src_id", "ts",
                      F.coalesce("v_event_type", F.lit("N/A")).alias("version_event_type"), "employee_surr_id")


# ---- dimensions ------------------------------------------------------------------------------

def dim_products_q(spark, d):
    return S.Star(spark, d).dim_products


def dim_locations_q(spark, d):
    return S.Star(spark, d).dim_locations


def dim_payment_details_q(spark, d):
    return S.Star(spark, d).dim_payment_details


def dim_dates_q(spark, d):
    lo, hi = S.calendar_bounds_from(Tables(spark, d).orders, "o_orderdate")
    return dim_dates(spark, lo, hi)


def dim_times_q(spark, d):
    """All 1,440 rows of the minute-of-day dimension, with the events that happened in each minute."""
    ev = Tables(spark, d).events.groupBy(
        (F.hour("ts") * 60 + F.minute("ts")).cast("smallint").alias("time_id")).agg(F.count(F.lit(1)).alias("n_events"))
    return dim_times(spark).join(ev, "time_id", "left").withColumn("n_events", F.coalesce("n_events", F.lit(0)))


# ---- fact --------------------------------------------------------------------------------------

def fact_transform(spark, d):
    star = S.Star(spark, d)
    return star.fact_rows(star.feed)


def fact_merge(spark, d):
    return S.Star(spark, d).fact_merged().table


def touched_months(spark, d):
    """A2: the months that the merge of the second batch has to rewrite."""
    return S.Star(spark, d).fact_merged().touched_months()


def insert_absent_q(spark, d):
    """U4: customers known from the first orders, then all customers offered again."""
    t = Tables(spark, d)
    offered = t.customer.select(F.col("c_custkey").cast("string").alias("customer_src_id"), na("c_name").alias("customer_name"))
    first = t.orders.filter(F.col("o_orderdate") < S.ts_lit(S.BATCH1_CUTOFF)).select(
        F.col("o_custkey").cast("string").alias("customer_src_id")).distinct()
    known = first.join(offered, "customer_src_id").select("customer_src_id", F.lit("KNOWN").alias("customer_name"))
    return insert_absent(known, offered, "customer_src_id").tagged.withColumnRenamed(ACTION, "action")


def map_latest(spark, d):
    """Per mapped id the row of the latest load (ties: source system, then hash)."""
    return latest_by(S.product_map(spark, d), ["product_id"], map_recency()).select(*S.MAP_COLS)


def rolling_window(spark, d):
    """The months of the merged fact; it needs no dimension keys."""
    return partitions.month_states(S.Star(spark, d).fact_merged(keys=()).table)


# ---- audit and data quality ----------------------------------------------------------------

def audit_counts(spark, d):
    """Log rows (processed, inserted, updated) of a two-batch run: staging twice, customers."""
    _, r2 = S.staged(spark, d)

    def tagged(rows: DataFrame, kind: str):
        load = F.when(F.col("load_dt") == S.ts_lit(S.BATCH1_TS), "#1").otherwise("#2")
        return rows.select(F.concat(F.lit("SP_SA_LOAD_SRC_RETAIL_SALES"), load).alias("procedure_name"),
                           F.lit(kind).alias("_kind"))
    rows = tagged(S.deliveries(S.sales_feed(spark, d)), "p").unionByName(tagged(r2.table, "i"))
    staged = rows.groupBy("procedure_name").agg(F.count_if(F.col("_kind") == "p").alias("rows_processed"),
                                                F.count_if(F.col("_kind") == "i").alias("rows_inserted"),
                                                F.lit(0).cast("long").alias("rows_updated"))
    cu = S.customer_upsert(spark, d).counts().select(F.lit("SP_3NF_LOAD_CE_CUSTOMERS").alias("procedure_name"),
                                                     "rows_processed", "rows_inserted", "rows_updated")
    return staged.unionByName(cu)


def run_log(spark, d):
    """The audit rows that ``RunLog`` writes for those steps, and for a step that fails."""
    log = control.RunLog(spark, _dt.datetime.fromisoformat(S.BATCH2_TS))
    for r in audit_counts(spark, d).collect():  # one row per step
        log.ok(r["procedure_name"], r["rows_processed"], r["rows_inserted"], r["rows_updated"])
    log.error("SP_3NF_LOAD_CE_SALES", "ce_sales", ValueError("first line\nsecond line"))
    return log.frame()


def dq_unique(spark, d):
    return quality.dq_unique(S.sales_feed(spark, d), ["transaction_id"])


def dq_fk(spark, d):
    """Sales dated outside the calendar (1995-01-01 .. 2000-12-31) — FK failures of the fact (Q12)."""
    sales = S.channel_sales(S.sales_feed(spark, d)).select(F.to_date("event_dt").alias("date_id"))
    return quality.dq_foreign_key(sales, "date_id", dim_dates(spark, "1995-01-01", "2000-12-31"), "date_id")


def dq_not_null(spark, d):
    """D3: NULL count of each NOT NULL column of the sales source (the report behind the check)."""
    f = S.channel_sales(S.sales_feed(spark, d))
    return quality.null_counts(f, ["sale_src_id", "event_dt", "customer_id", "product_id", "employee_id",
                                   "quantity", "price", "discount", "total_amount"])


def dq_max_length(spark, d):
    """Values longer than the declared widths (customer / product / employee keys of width 3)."""
    f = S.channel_sales(S.sales_feed(spark, d))
    return quality.dq_max_length(f, {"customer_id": 3, "product_id": 3, "employee_id": 3, "sale_src_id": 255})


def dq_scd(spark, d):
    return quality.dq_scd_report(S.employee_versions(spark, d), "employee_src_id")


# ---- preparation job -------------------------------------------------------------------------

def prep_conform_first(spark, d):
    o = Tables(spark, d).orders.select("o_orderkey", "o_custkey", "o_orderpriority")
    return prepare.conform_first(o, "o_custkey", ["o_orderpriority"], "o_orderkey")


def prep_pick_by_hash(spark, d):
    """Per part a 'subcategory' drawn from the brands seen for its type (choice list by category)."""
    p = Tables(spark, d).part
    lists = p.groupBy("p_type").agg(F.array_sort(F.collect_set("p_brand")).alias("_choices"))
    return prepare.pick_from_lists(p, lists, key="p_partkey", category="p_type", out="picked_subcategory",
                                   index_fn=md5_index).select("p_partkey", "p_type", "picked_subcategory")


YEAR_BOUNDS = [_dt.datetime(y, 1, 1) for y in range(1995, 2003)]


def prep_interval_assign(spark, d):
    """Each sale gets a supplier of the customer's nation active in the sale's year, drawn by hash;
    if none was active that year, any supplier of the nation."""
    t = Tables(spark, d)
    nr = t.nation.join(t.region, F.col("n_regionkey") == F.col("r_regionkey")).select(
        "n_nationkey", F.col("n_name").alias("city"), F.col("r_name").alias("country"))
    sales = (t.lineitem.join(t.orders, F.col("l_orderkey") == F.col("o_orderkey"))
             .join(t.customer, F.col("o_custkey") == F.col("c_custkey"))
             .join(nr, F.col("c_nationkey") == F.col("n_nationkey"))
             .select(ckey("l_orderkey", "l_linenumber").alias("transaction_id"), F.col("l_shipdate").alias("ts"),
                     "country", "city", F.lit("N/A").alias("address")))
    active = t.lineitem.select("l_suppkey", "l_shipdate").withColumn(
        "period_no", prepare.period_index("l_shipdate", YEAR_BOUNDS)).select("l_suppkey", "period_no").distinct()
    roster = (t.supplier.join(nr, F.col("s_nationkey") == F.col("n_nationkey"))
              .join(active, F.col("s_suppkey") == F.col("l_suppkey"))
              .select(F.col("s_suppkey").alias("employee_id"), "country", "city", F.lit("N/A").alias("address"),
                      "period_no"))
    out = prepare.assign_employees(sales, roster, YEAR_BOUNDS, row_key="transaction_id", ts="ts",
                                   index_fn=md5_index)
    return out.select("transaction_id", "ts", "city", "employee_id")


def prep_locations(spark, d):
    """Each customer gets a nation of its region, a city of that nation and an address of that city;
    the suppliers make up the location table."""
    t = Tables(spark, d)
    nr = t.nation.join(t.region, F.col("n_regionkey") == F.col("r_regionkey"))
    locs = t.supplier.join(nr, F.col("s_nationkey") == F.col("n_nationkey")).select(
        F.col("r_name").alias("region"), F.col("n_name").alias("country"),
        F.concat_ws(" ", "n_name", (F.col("s_suppkey") % 5).cast("string")).alias("city"), F.col("s_name").alias("address"))
    cust = t.customer.join(nr, F.col("c_nationkey") == F.col("n_nationkey")).select("c_custkey", F.col("r_name").alias("_region"))
    out = prepare.assign_locations(cust, locs, row_key="c_custkey", region="_region", index_fn=md5_index)
    return out.select("c_custkey", F.col("_region").alias("region"), "country", "city", "address")


def prep_cards(spark, d):
    """Card type and verification of orders paid by card (the priority plays the method)."""
    method = F.when(F.col("o_orderpriority").startswith("1"), "Credit Card").when(
        F.col("o_orderpriority").startswith("2"), "Debit Card").otherwise("Cash")
    o = Tables(spark, d).orders.select("o_orderkey", method.alias("payment_method"))
    return prepare.card_details(o, row_key="o_orderkey", index_fn=md5_index)


def prep_devices(spark, d):
    """E5: device and browser of each order line."""
    li = Tables(spark, d).lineitem.select(ckey("l_orderkey", "l_linenumber").alias("transaction_id"))
    return prepare.devices(li, row_key="transaction_id", index_fn=md5_index)


def prep_names(spark, d):
    """Product names by category template (books, clothing, everything else)."""
    category = F.element_at(F.array(F.lit("Books"), F.lit("Clothing"), F.lit("Electronics")), (F.col("p_partkey") % 3 + 1).cast("int"))
    p = Tables(spark, d).part.select("p_partkey", category.alias("product_category"), "p_brand", "p_type")
    out = prepare.product_names(p, key="p_partkey", category="product_category", subcategory="p_brand", manufacturer="p_type",
                                index_fn=md5_index)
    return out.select("p_partkey", "product_category", F.lower("product_name").alias("product_name"))


def prep_emails(spark, d):
    """An e-mail address for each customer."""
    c = Tables(spark, d).customer.select("c_custkey", "c_mktsegment", "c_name")
    return prepare.emails(c, key="c_custkey", first="c_mktsegment", last="c_name", out="email", index_fn=md5_index).select("c_custkey", "email")


def prep_periods(spark, d):
    """The period grid over the range of the orders, with the orders dated in each period."""
    o = Tables(spark, d).orders.select(F.to_date("o_orderdate").cast("timestamp_ntz").alias("ts"))
    lo, hi = o.agg(F.min("ts"), F.max("ts")).first()
    bounds = prepare.period_bounds(lo, hi) if lo else [_dt.datetime(1900, 1, 1)] * 2
    rows = [(i, a, b) for i, (a, b) in enumerate(zip(bounds, bounds[1:]))]  # one per quarter
    grid = spark.createDataFrame(rows, "period_no int, period_start timestamp_ntz, period_end timestamp_ntz")
    seen = o.groupBy(prepare.period_index("ts", bounds).alias("period_no")).agg(F.count(F.lit(1)).alias("n_orders"))
    return grid.join(seen, "period_no", "left").withColumn("n_orders", F.coalesce("n_orders", F.lit(0).cast("long")))


def prep_roster(spark, d):
    """Suppliers as employees of their nation, at one of its addresses per period; and per employee
    how its periods follow each other: neighbours share a bound, nothing else overlaps or is left out."""
    t = Tables(spark, d)
    o = t.orders.select(F.to_date("o_orderdate").cast("timestamp_ntz").alias("ts"))
    lo, hi = o.agg(F.min("ts"), F.max("ts")).first()
    bounds = prepare.period_bounds(lo, hi) if lo else [_dt.datetime(1900, 1, 1)] * 2
    employees = t.supplier.select(F.col("s_suppkey").alias("employee_id"), F.col("s_nationkey").alias("city"))
    places = t.supplier.select(F.col("s_nationkey").alias("city"), F.col("s_name").alias("address"))
    roster = stage(prepare.roster_periods(employees, places, bounds, index_fn=md5_index), "roster")
    follow = with_next(roster.select("employee_id", "period_start", "period_end"), "employee_id", "period_start", "_after", bucket="month")
    checks = follow.groupBy("employee_id").agg(
        F.count(F.lit(1)).alias("n_periods"), F.count_if(F.col("_after") == F.col("period_end")).alias("n_shared_bounds"),
        F.count_if(F.col("_after") != F.col("period_end")).alias("n_broken"))
    return roster.drop("city").join(checks, "employee_id").select(
        "employee_id", "period_no", "period_start", "period_end", "address", "n_periods", "n_shared_bounds", "n_broken")


def prep_split(spark, d):
    f = S.sales_feed(spark, d).withColumn("_row_key", ckey("transaction_id", "hash_value"))
    online, offline = prepare.split_half(f, row_key="_row_key")
    cols = ["transaction_id", "hash_value"]
    return (online.select(*cols, F.lit("ONLINE").alias("channel"))
            .unionByName(offline.select(*cols, F.lit("OFFLINE").alias("channel"))))


# ---- star queries ----------------------------------------------------------------------------

def mart_employee_location(spark, d):
    star = S.Star(spark, d)
    fact = star.fact_rows(star.feed, keys=("employee",))
    return marts.employee_performance(fact, star.dim_employees, star.dim_locations,
                                      dim_dates(spark, *S.calendar_bounds_from(star.t.lineitem, "l_shipdate")))


def mart_rollup_geo(spark, d):
    t = Tables(spark, d)
    li = S.latest_lineitem(t.lineitem)
    geo = (t.supplier.join(t.nation, F.col("s_nationkey") == F.col("n_nationkey"))
           .join(t.region, F.col("n_regionkey") == F.col("r_regionkey"))
           .select("s_suppkey", F.col("r_name").alias("region_name"), F.col("n_name").alias("nation_name")))
    fact = li.join(geo, F.col("l_suppkey") == F.col("s_suppkey"))
    return marts.rollup_totals(fact, ["region_name", "nation_name"], F.col("l_extendedprice").cast("decimal(12,2)"))


def mart_cube_product(spark, d):
    """Z3 as a cube: product category x brand x order status, all subtotals."""
    t = Tables(spark, d)
    li = S.latest_lineitem(t.lineitem)
    fact = (li.join(t.part.select("p_partkey", "p_type", "p_brand"), F.col("l_partkey") == F.col("p_partkey"))
            .join(t.orders.select("o_orderkey", "o_orderstatus"), F.col("l_orderkey") == F.col("o_orderkey"))
            .select(F.col("p_type").alias("product_category"), F.col("p_brand").alias("product_brand"),
                    F.col("o_orderstatus").alias("order_status"), "l_extendedprice"))
    return marts.cube_totals(fact, ["product_category", "product_brand", "order_status"],
                             F.col("l_extendedprice").cast("decimal(12,2)"))


def mart_time_of_day(spark, d):
    ev = Tables(spark, d).events
    lo, hi = S.calendar_bounds_from(ev, "ts")
    return marts.sales_by_time_of_day(ev, dim_times(spark), dim_dates(spark, lo, hi), ts="ts",
                                      amount=F.col("value").cast("decimal(12,2)"))


def mart_assignment_history(spark, d):
    return marts.assignments_at(S.employee_versions(spark, d), "2024-01-15 12:00:00")


QUERIES: dict[str, Query] = {
    "mart_category_month": S.category_month,
    "stage_fingerprint": stage_fingerprint,
    "stage_append_dedup": stage_append_dedup,
    "incremental_filter": incremental_filter,
    "latest_per_key": latest_per_key,
    "latest_composite_key": latest_composite_key,
    "union_sources": union_sources,
    "map_or_mint": map_or_mint_q,
    "assign_keys": assign_keys_q,
    "default_member": default_member,
    "lookup_unknown": lookup_unknown,
    "lateral_top1": lateral_top1,
    "upsert_insert": upsert_insert,
    "upsert_update": upsert_update,
    "upsert_counts": upsert_counts,
    "scd2_history": scd2_history,
    "scd2_late_merge": scd2_late_merge,
    "point_in_time_join": point_in_time_join_q,
    "point_in_time_join_bucketed": point_in_time_join_bucketed,
    "dim_products": dim_products_q,
    "dim_locations": dim_locations_q,
    "dim_payment_details": dim_payment_details_q,
    "dim_dates": dim_dates_q,
    "dim_times": dim_times_q,
    "fact_transform": fact_transform,
    "fact_merge": fact_merge,
    "rolling_window": rolling_window,
    "audit_counts": audit_counts,
    "run_log": run_log,
    "dq_unique": dq_unique,
    "dq_fk": dq_fk,
    "dq_scd": dq_scd,
    "dq_not_null": dq_not_null,
    "dq_max_length": dq_max_length,
    "prep_conform_first": prep_conform_first,
    "prep_pick_by_hash": prep_pick_by_hash,
    "prep_interval_assign": prep_interval_assign,
    "prep_locations": prep_locations,
    "prep_cards": prep_cards,
    "prep_devices": prep_devices,
    "prep_names": prep_names,
    "prep_emails": prep_emails,
    "prep_periods": prep_periods,
    "prep_roster": prep_roster,
    "prep_split": prep_split,
    "touched_months": touched_months,
    "insert_absent": insert_absent_q,
    "map_latest": map_latest,
    "mart_employee_location": mart_employee_location,
    "mart_rollup_geo": mart_rollup_geo,
    "mart_cube_product": mart_cube_product,
    "mart_time_of_day": mart_time_of_day,
    "mart_assignment_history": mart_assignment_history,
    "stage_parts": whole_run.stage_parts,
    "fact_store": whole_run.fact_store,
    "month_lifecycle": whole_run.month_lifecycle,
    "prep_files": whole_run.prep_files,
    "warehouse_run": whole_run.warehouse_run,
    "warehouse_resume": whole_run.warehouse_resume,
}
