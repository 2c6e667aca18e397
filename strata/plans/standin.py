"""The warehouse operators run on the driver's TPC-H-like tables.

Role mapping (who plays what):

* sale line           ``lineitem`` joined to ``orders``; ``transaction_id = l_orderkey|l_linenumber``
                      (not unique: repeated lines are later corrections of the same sale)
* event time          ``l_shipdate``; batch 1 = lines shipped before ``BATCH1_CUTOFF``,
                      batch 2 = the whole table delivered again (re-delivery is de-duplicated)
* channel             online = even ``l_orderkey``, offline = odd; both channels together are
                      the whole table
* customer            ``orders.o_custkey`` / ``customer``
* product hierarchy   ``part``: partkey > brand (subcategory) > type (category)
* location hierarchy  ``supplier`` (address) > ``nation`` (city) > ``region`` (country)
* payment detail      ``o_orderpriority`` (method) | ``l_returnflag`` (card) | ``l_linestatus``
* employee SCD2 feed  ``events``: ``user_id`` is the employee, ``event_type`` the tracked attribute
* employee moves      ``events`` again, for the star: the user, counted round the suppliers, works at the
                      address of a supplier given by the event's number, from the event's place in the
                      years of the sales on (``employee_moves``)
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from strata.functions.text import ckey, fingerprint
from strata.operators.calendar import dim_dates
from strata.operators.latest import latest_by
from strata.plans.marts import sales_by_category_month
from strata.session import stage
from strata.sources.tables import Tables
from strata.functions.dates import high_ts, low_ts, time_id
from strata.functions.text import na, std
from strata.operators import partitions
from strata.operators.keys import assign_keys, lookup, map_or_mint, max_id
from strata.operators.pit import point_in_time_join
from strata.operators.scd2 import versions_from_events
from strata.operators.staging import StageResult, stage_loads
from strata.operators.upsert import merge_fact, upsert

# Fixed parameters of the stand-in runs.
BATCH1_CUTOFF = "1998-01-01 00:00:00"
BATCH1_TS = "2024-01-01 00:00:00"
BATCH2_TS = "2024-02-01 00:00:00"


def ts_lit(s: str):
    return F.lit(s).cast("timestamp_ntz")


def latest_lineitem(li: DataFrame) -> DataFrame:
    """Latest version of each order line: by ship date, then every other column (total order)."""
    order = [F.col("l_shipdate").desc()] + [F.col(c).desc() for c in (
        "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax",
        "l_returnflag", "l_linestatus")]
    return latest_by(li, ["l_orderkey", "l_linenumber"], order)


def category_month(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flagship (Z2): latest order lines -> product category -> order month -> totals."""
    t = Tables(spark, sf_dir)
    li = latest_lineitem(t.lineitem)
    fact = li.join(t.orders.select("o_orderkey", "o_orderdate"), F.col("l_orderkey") == F.col("o_orderkey"), "left")
    return sales_by_category_month(
        fact, t.part, dim_dates(spark, *calendar_bounds_from(t.orders, "o_orderdate")),
        fact_date=F.to_date("o_orderdate"), fact_product="l_partkey", product_key="p_partkey",
        category="p_type", quantity=F.col("l_quantity").cast("decimal(10,2)"),
        amount=F.col("l_extendedprice").cast("decimal(12,2)"))


def sales_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every order line as a sale record of the retail model (text keys, typed measures)."""
    return order_feed(spark, sf_dir).drop("order_key")


def order_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same with ``order_key``. A transaction's id begins with it, so whoever groups by both needs no
    shuffle after the join of the lines with their orders."""
    t = Tables(spark, sf_dir)
    o = t.orders.select("o_orderkey", "o_custkey", "o_orderdate", "o_orderpriority", "o_orderstatus")
    li = t.lineitem.join(o, F.col("l_orderkey") == F.col("o_orderkey"))
    price = F.col("l_extendedprice").cast("decimal(12,2)")
    disc = F.col("l_discount").cast("decimal(3,2)")
    feed = li.select(
        ckey("l_orderkey", "l_linenumber").alias("transaction_id"),
        F.col("l_shipdate").alias("event_dt"),
        F.col("o_orderdate").alias("order_dt"),
        F.col("o_custkey").cast("string").alias("customer_id"),
        F.col("l_partkey").cast("string").alias("product_id"),
        F.col("l_suppkey").cast("string").alias("employee_id"),
        F.col("o_orderpriority").alias("payment_method"),
        F.col("l_returnflag").alias("card_type"),
        F.col("l_linestatus").alias("verification_method"),
        F.col("l_quantity").cast("smallint").alias("quantity"),
        price.cast("decimal(10,2)").alias("price"),
        disc.alias("discount"),
        (price * (F.lit(1) - disc)).cast("decimal(10,2)").alias("total_amount"),
        F.when(F.col("l_orderkey") % 2 == 0, F.lit("SA_ONLINE")).otherwise(F.lit("SA_OFFLINE")).alias("source_system"),
        F.col("l_orderkey").alias("order_key"),
    )
    return feed.withColumn("hash_value", fingerprint(
        "transaction_id", "customer_id", "product_id", "employee_id", "payment_method", "card_type",
        "verification_method", "quantity", "price", "discount", "total_amount", "source_system"))


def batch1(feed: DataFrame) -> DataFrame:
    return feed.filter(F.col("event_dt") < ts_lit(BATCH1_CUTOFF))


def calendar_bounds_from(df: DataFrame, date_col: str) -> tuple[str, str]:
    """Calendar bounds read from the data (two scalars)."""
    lo, hi = df.agg(F.min(F.to_date(date_col)), F.max(F.to_date(date_col))).first()
    lo = lo or _dt.date(1900, 1, 1)
    hi = hi or lo
    return lo.isoformat(), hi.isoformat()


# ---------------------------------------------------------------------------------------------
# Building blocks shared by the registered queries
# ---------------------------------------------------------------------------------------------

SRC_ENTITY = "SRC_RETAIL_SALES"
STAGE_COLS = ["hash_value", "transaction_id", "event_dt", "load_dt"]


def _empty(spark: SparkSession, like: DataFrame) -> DataFrame:
    return spark.createDataFrame([], like.schema)


def by_recency():
    return [F.col("event_dt").desc(), F.col("hash_value").desc()]


def deliveries(feed: DataFrame) -> DataFrame:
    """Every row that the two loads bring, with its ``load_dt``: load 2 delivers the whole table, so a line of
    batch 1 comes twice."""
    one, two = ts_lit(BATCH1_TS), ts_lit(BATCH2_TS)
    loads = F.when(F.col("event_dt") < ts_lit(BATCH1_CUTOFF), F.array(one, two)).otherwise(F.array(two))
    kept = feed.filter(F.col("transaction_id").isNotNull() & F.col("event_dt").isNotNull())
    return kept.select("hash_value", "transaction_id", "event_dt", F.explode(loads).alias("load_dt"))


def staged(spark: SparkSession, sf_dir: str):
    """Staging after two batch loads: batch 1 (lines shipped before the cut-off), then the
    whole table delivered again; returns (batch-1 result, batch-2 result). Both loads are one pass, so the
    lines are joined with their orders and fingerprinted once."""
    rows = deliveries(sales_feed(spark, sf_dir))
    table = stage_loads(_empty(spark, rows), rows, time_col="event_dt").table
    first, second = (table.filter(F.col("load_dt") == ts_lit(ts)) for ts in (BATCH1_TS, BATCH2_TS))
    return StageResult(new_rows=first, table=first), StageResult(new_rows=second, table=table)


def channel_columns(online) -> list:
    """The common layout of a sale; ``online`` tells the channel of a row (or of all rows, as a literal)."""
    none = F.lit("N/A")
    return [
        std("transaction_id").alias("sale_src_id"), "event_dt",
        F.when(online, na("customer_id")).otherwise(none).alias("customer_id"),
        na("product_id").alias("product_id"),
        F.when(online, none).otherwise(na("employee_id")).alias("employee_id"),
        na("payment_method").alias("payment_method"), na("card_type").alias("card_type"),
        na("verification_method").alias("verification_method"),
        "quantity", "price", "discount", "total_amount", "source_system", F.lit(SRC_ENTITY).alias("source_entity")]


def channel_sales(feed: DataFrame) -> DataFrame:
    """CE_SALES source: per channel the latest record of each transaction, standardised and
    padded to the common layout. Both channels are one pass: the channel is part of the key."""
    ch = latest_by(feed, _sale_keys(feed), by_recency())
    return ch.select(*channel_columns(F.col("source_system") == "SA_ONLINE"))


def _sale_keys(feed: DataFrame) -> list:
    """What a sale is latest of; ``order_key``, if the feed has it, is part of the transaction's id."""
    return [*[c for c in feed.columns if c == "order_key"], "source_system", std("transaction_id")]


def channel_sales_of_batches(feed: DataFrame) -> DataFrame:
    """:func:`channel_sales` of batch 1 and of the whole feed in one pass: a row tells whether it is the
    latest of batch 1 (``_first``), of the whole feed (``_last``) or, as most rows, of both."""
    first = F.coalesce(F.col("event_dt") < ts_lit(BATCH1_CUTOFF), F.lit(False))
    rows = latest_by(feed.withColumn("_first", first), [*_sale_keys(feed), "_first"], by_recency())  # two a sale at most
    place = F.row_number().over(Window.partitionBy(*_sale_keys(rows)).orderBy(*by_recency()))
    rows = rows.withColumn("_last", place == 1).filter("_first OR _last")
    return rows.select(*channel_columns(F.col("source_system") == "SA_ONLINE"), "_first", "_last")


def union_of_channels(online: DataFrame, offline: DataFrame) -> DataFrame:
    """The same from two feeds, each ranked and padded by itself and then unioned."""
    def channel(feed: DataFrame, is_online: bool) -> DataFrame:
        return latest_by(feed, [std("transaction_id")], by_recency()).select(*channel_columns(F.lit(is_online)))
    return channel(online, True).unionByName(channel(offline, False))


def product_records(feed: DataFrame, part: DataFrame) -> DataFrame:
    """Mapping transform for products: latest record per (channel, product), standardised."""
    j = feed.join(part, F.col("product_id") == F.col("p_partkey").cast("string"))
    r = latest_by(j, ["source_system", std("product_id")], by_recency())
    return r.select(std("product_id").alias("product_src_id"), na("p_name").alias("product_name"),
                    na("p_brand").alias("manufacturer"), na(F.col("p_size").cast("string")).alias("subcategory_name"),
                    na("p_type").alias("category_name"), "source_system", F.lit(SRC_ENTITY).alias("source_entity"))


MAP_COLS = ["product_id", "product_src_id", "product_name", "manufacturer", "subcategory_name", "category_name",
            "source_system", "source_entity", "hash_value", "load_dt"]


def product_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = Tables(spark, sf_dir)
    # per channel and product the latest row of each batch: all that either load can keep
    feed = sales_feed(spark, sf_dir).select("product_id", "source_system", "event_dt", "hash_value")
    one = F.coalesce(F.col("event_dt") < ts_lit(BATCH1_CUTOFF), F.lit(False))
    feed = stage(latest_by(feed.withColumn("_first", one), ["source_system", "product_id", "_first"], by_recency()).drop("_first"), "map-feed")
    attrs = ["product_name", "manufacturer", "subcategory_name", "category_name"]
    rec1 = product_records(batch1(feed), t.part)
    empty = spark.createDataFrame([], "product_id long, product_src_id string, product_name string, "
                                      "manufacturer string, subcategory_name string, category_name string, "
                                      "source_system string, source_entity string, hash_value string, "
                                      "load_dt timestamp_ntz")
    m1 = map_or_mint(rec1, empty, "product_src_id", "product_id", attrs, BATCH1_TS, offset=0)
    # the map as written by the first load (materialised, like the append in the pipeline)
    m2 = map_or_mint(product_records(feed, t.part), stage(m1.table, "t_map_products"), "product_src_id", "product_id", attrs,
                     BATCH2_TS)
    return m2.table.select(*MAP_COLS)


def customer_state(t: Tables, cutoff: str | None) -> DataFrame:
    """Customer entity as of a cut-off: name and segment, priority and status of the latest order."""
    o = t.orders
    if cutoff:
        o = o.filter(F.col("o_orderdate") < ts_lit(cutoff))
    last = latest_by(o, ["o_custkey"], [F.col("o_orderdate").desc(), F.col("o_orderkey").desc()])
    c = t.customer.select("c_custkey", "c_name", "c_mktsegment")
    return (last.join(c, F.col("o_custkey") == F.col("c_custkey"), "left")
            .select(F.col("o_custkey").cast("string").alias("customer_src_id"),
                    na("c_name").alias("customer_name"), na("c_mktsegment").alias("segment"),
                    na("o_orderpriority").alias("last_priority"), na("o_orderstatus").alias("last_status"),
                    F.lit("SA_ONLINE").alias("source_system"), F.lit(SRC_ENTITY).alias("source_entity")))


CUSTOMER_ATTRS = ["customer_name", "segment", "last_priority", "last_status"]


def customer_upsert(spark: SparkSession, sf_dir: str):
    t = Tables(spark, sf_dir)
    first = assign_keys(customer_state(t, BATCH1_CUTOFF), ["customer_src_id"], "customer_id")
    target = first.select("customer_id", "customer_src_id", *CUSTOMER_ATTRS, "source_system", "source_entity",
                          ts_lit(BATCH1_TS).alias("insert_dt"), ts_lit(BATCH1_TS).alias("update_dt"))
    target = stage(target, "customers")  # as stored by the first load
    return upsert(target, customer_state(t, None), "customer_src_id", CUSTOMER_ATTRS, BATCH2_TS,
                  id_col="customer_id")


def employee_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = Tables(spark, sf_dir).events
    return e.select("event_id", F.col("user_id").cast("string").alias("employee_src_id"), "ts",
                    na("event_type").alias("event_type"))


def employee_versions(spark: SparkSession, sf_dir: str, *, exclude_type: str | None = None) -> DataFrame:
    ev = employee_events(spark, sf_dir)
    if exclude_type:
        ev = ev.filter(F.col("event_type") != exclude_type)
    return versions_from_events(ev, "employee_src_id", "ts", ["event_type"])


MOVES_FROM, MOVES_TO, MOVES_PACE = "2024-01-01 00:00:00", "1995-01-01 00:00:00", 80


def employee_moves(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(employee_src_id, ts, address_name): every event moves an employee to a supplier's address. The
    thirty days of the events are stretched to the years of the sales."""
    t = Tables(spark, sf_dir)
    n = max(t.supplier.count(), 1)
    seconds = F.expr(f"timestampdiff(SECOND, TIMESTAMP_NTZ '{MOVES_FROM}', ts)")
    moved = t.events.select((F.col("user_id") % n).cast("string").alias("employee_src_id"), seconds.alias("_s"),
                            (F.col("event_id") * 7 % n).alias("_place"))
    moved = moved.withColumn("ts", F.expr(f"timestampadd(SECOND, _s * {MOVES_PACE}, TIMESTAMP_NTZ '{MOVES_TO}')"))
    place = t.supplier.select(F.col("s_suppkey").alias("_place"), na("s_name").alias("address_name"))
    return moved.join(place, "_place").select("employee_src_id", "ts", "address_name")


# ---- hierarchies (CE entities, then denormalised DIM rows) ----------------------------------

def _ids(df: DataFrame, key: str, id_col: str) -> DataFrame:
    return assign_keys(df, [key], id_col)


class Star:
    """The stand-in warehouse layers. Each layer is built once per run; its ids, and the layers that
    read the whole feed, are written to the shared folder — the analogue of the source writing each
    layer to a table — so later layers read a short plan instead of re-deriving every parent."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir, self.t = spark, sf_dir, Tables(spark, sf_dir)
        self._kept: dict[str, DataFrame] = {}

    def keep(self, name: str, build, write: bool = False) -> DataFrame:
        """Build a layer once per run. Dimension layers are short plans over written keys; what reads
        the whole feed is written."""
        if name not in self._kept:
            self._kept[name] = stage(build(), name) if write else build()
        return self._kept[name]

    def keep_value(self, name: str, read):
        if name not in self._kept:
            self._kept[name] = read()
        return self._kept[name]

    @property
    def feed(self) -> DataFrame:
        return order_feed(self.spark, self.sf_dir)

    # products: part > brand > type
    @property
    def ce_categories(self) -> DataFrame:
        return self.keep("ce_categories", lambda: _ids(
            self.t.part.select(na("p_type").alias("product_category_src_id")).distinct(),
            "product_category_src_id", "product_category_id")
            .withColumn("category_name", F.col("product_category_src_id")))

    @property
    def ce_subcategories(self) -> DataFrame:
        def build():
            subs = (self.t.part.select(na("p_brand").alias("subcategory_name"), na("p_type").alias("_cat")).distinct()
                    .withColumn("product_subcategory_src_id", ckey("subcategory_name", "_cat")))
            subs = _ids(subs, "product_subcategory_src_id", "product_subcategory_id")
            return lookup(subs, self.ce_categories, "_cat", "category_name", "product_category_id",
                          "product_category_id").drop("_cat")
        return self.keep("ce_subcategories", build)

    @property
    def ce_products(self) -> DataFrame:
        def build():
            prods = self.t.part.select(F.col("p_partkey").cast("string").alias("product_src_id"),
                                       na("p_name").alias("product_name"),
                                       ckey(na("p_brand"), na("p_type")).alias("_sub"))
            prods = _ids(prods, "product_src_id", "product_id")
            return lookup(prods, self.ce_subcategories, "_sub", "product_subcategory_src_id",
                          "product_subcategory_id", "product_subcategory_id").drop("_sub")
        return self.keep("ce_products", build)

    @property
    def dim_products(self) -> DataFrame:
        def build():
            d = self.ce_products.select(F.col("product_id").cast("string").alias("product_src_id"), "product_name",
                                        "product_subcategory_id")
            d = _ids(d, "product_src_id", "product_surr_id")
            sub = self.ce_subcategories.select("product_subcategory_id",
                                               F.col("subcategory_name").alias("product_subcategory_name"),
                                               "product_category_id")
            cat = self.ce_categories.select("product_category_id",
                                            F.col("category_name").alias("product_category_name"))
            d = d.join(sub, "product_subcategory_id", "left").join(cat, "product_category_id", "left")
            return d.select("product_surr_id", "product_src_id", "product_name",
                            F.coalesce("product_subcategory_id", F.lit(-1)).alias("product_subcategory_id"),
                            F.coalesce("product_subcategory_name", F.lit("N/A")).alias("product_subcategory_name"),
                            F.coalesce("product_category_id", F.lit(-1)).alias("product_category_id"),
                            F.coalesce("product_category_name", F.lit("N/A")).alias("product_category_name"))
        return self.keep("dim_products", build)

    # locations: supplier (address) > nation (city) > region (country)
    @property
    def ce_countries(self) -> DataFrame:
        return self.keep("ce_countries", lambda: _ids(
            self.t.region.select(na("r_name").alias("country_src_id")).distinct(), "country_src_id", "country_id")
            .withColumn("country_name", F.col("country_src_id")))

    def _nation_region(self) -> DataFrame:
        return self.t.nation.join(self.t.region, F.col("n_regionkey") == F.col("r_regionkey"), "left")

    @property
    def ce_cities(self) -> DataFrame:
        def build():
            cities = (self._nation_region().select(na("n_name").alias("city_name"), na("r_name").alias("_country"))
                      .distinct().withColumn("city_src_id", ckey("city_name", "_country")))
            cities = _ids(cities, "city_src_id", "city_id")
            return lookup(cities, self.ce_countries, "_country", "country_name", "country_id",
                          "country_id").drop("_country")
        return self.keep("ce_cities", build)

    @property
    def ce_addresses(self) -> DataFrame:
        def build():
            snr = self.t.supplier.join(self._nation_region(), F.col("s_nationkey") == F.col("n_nationkey"), "left")
            addrs = (snr.select(na("s_name").alias("address_name"), ckey(na("n_name"), na("r_name")).alias("_city"))
                     .withColumn("address_src_id", ckey("address_name", "_city")))
            addrs = _ids(addrs, "address_src_id", "address_id")
            return lookup(addrs, self.ce_cities, "_city", "city_src_id", "city_id", "city_id").drop("_city")
        return self.keep("ce_addresses", build)

    @property
    def dim_locations(self) -> DataFrame:
        def build():
            d = self.ce_addresses.select(F.col("address_id").cast("string").alias("location_src_id"), "address_id",
                                         "address_name", "city_id")
            d = _ids(d, "location_src_id", "location_surr_id")
            d = (d.join(self.ce_cities.select("city_id", "city_name", "country_id"), "city_id", "left")
                 .join(self.ce_countries.select("country_id", "country_name"), "country_id", "left"))
            return d.select("location_surr_id", "location_src_id", "address_id", "address_name",
                            F.coalesce("city_id", F.lit(-1)).alias("city_id"),
                            F.coalesce("city_name", F.lit("N/A")).alias("city_name"),
                            F.coalesce("country_id", F.lit(-1)).alias("country_id"),
                            F.coalesce("country_name", F.lit("N/A")).alias("country_name"))
        return self.keep("dim_locations", build)

    # payment details: priority | returnflag | linestatus
    def _payment_records(self) -> DataFrame:
        return self.keep("payment_records", lambda: self.feed.select(na("payment_method").alias("payment_method_name"),
                                na("card_type").alias("card_type_name"),
                                na("verification_method").alias("verification_method")).distinct(), write=True)

    @property
    def ce_payment_methods(self) -> DataFrame:
        return self.keep("ce_payment_methods", lambda: _ids(
            self._payment_records().select(F.col("payment_method_name").alias("payment_method_src_id")).distinct(),
            "payment_method_src_id", "payment_method_id")
            .withColumn("payment_method_name", F.col("payment_method_src_id")))

    @property
    def ce_card_types(self) -> DataFrame:
        return self.keep("ce_card_types", lambda: _ids(
            self._payment_records().select("card_type_name", "verification_method").distinct()
            .withColumn("card_type_src_id", ckey("card_type_name", "verification_method")),
            "card_type_src_id", "card_type_id"))

    @property
    def ce_payment_details(self) -> DataFrame:
        def build():
            det = self._payment_records().withColumn(
                "payment_detail_src_id", ckey("payment_method_name", "card_type_name", "verification_method"))
            det = _ids(det, "payment_detail_src_id", "payment_detail_id")
            det = lookup(det, self.ce_payment_methods, "payment_method_name", "payment_method_src_id",
                         "payment_method_id", "payment_method_id")
            det = lookup(det, self.ce_card_types, ckey("card_type_name", "verification_method"), "card_type_src_id",
                         "card_type_id", "card_type_id")
            return det.select("payment_detail_id", "payment_detail_src_id", "payment_method_id", "card_type_id")
        return self.keep("ce_payment_details", build)

    @property
    def dim_payment_details(self) -> DataFrame:
        def build():
            d = self.ce_payment_details.select(F.col("payment_detail_id").cast("string").alias("payment_detail_src_id"),
                                               "payment_method_id", "card_type_id")
            d = _ids(d, "payment_detail_src_id", "payment_detail_surr_id")
            d = (d.join(self.ce_payment_methods.select("payment_method_id", "payment_method_name"),
                        "payment_method_id", "left")
                 .join(self.ce_card_types.select("card_type_id", "card_type_name", "verification_method"),
                       "card_type_id", "left"))
            return d.select("payment_detail_surr_id", "payment_detail_src_id", "payment_method_id",
                            F.coalesce("payment_method_name", F.lit("N/A")).alias("payment_method_name"),
                            "card_type_id", F.coalesce("card_type_name", F.lit("N/A")).alias("card_type_name"),
                            F.coalesce("verification_method", F.lit("N/A")).alias("verification_method"))
        return self.keep("dim_payment_details", build)

    @property
    def ce_customers(self) -> DataFrame:
        return self.keep("ce_customers", lambda: _ids(
            self.t.customer.select(F.col("c_custkey").cast("string").alias("customer_src_id"),
                                   na("c_name").alias("customer_name")), "customer_src_id", "customer_id"))

    @property
    def dim_customers(self) -> DataFrame:
        def build():
            d = self.ce_customers.select(F.col("customer_id").cast("string").alias("customer_src_id"),
                                         "customer_name")
            return _ids(d, "customer_src_id", "customer_surr_id")
        return self.keep("dim_customers", build)

    @property
    def dim_employees(self) -> DataFrame:
        """Employees (named like suppliers) with one version per move, located at the address they moved to."""
        def build():
            emp = versions_from_events(employee_moves(self.spark, self.sf_dir), "employee_src_id", "ts", ["address_name"], bucket="month")
            emp = lookup(emp, self.dim_locations, "address_name", "address_name", "location_surr_id", "location_id")
            return assign_keys(emp.drop("address_name"), ["employee_src_id", "start_dt"], "employee_surr_id")
        return self.keep("dim_employees", build, write=True)

    def fact_rows(self, feed: DataFrame, keys: tuple[str, ...] = ("product", "customer", "payment", "employee")) -> DataFrame:
        """FN_DM_TRANSFORM_SALES on the stand-ins: date/time split, cost, six dimension keys (or only
        those of ``keys``, the others being unknown, for a query that needs no more)."""
        return self._with_keys(channel_sales(feed), keys)

    def _with_keys(self, sales: DataFrame, keys: tuple[str, ...], more: tuple[str, ...] = ()) -> DataFrame:
        if "payment" in keys:  # first: its three texts are then left behind
            sales = self._payment_key(sales)
        if "product" in keys:
            sales = self._product_key(sales)
        if "customer" in keys:
            sales = self._customer_key(sales)
        if "employee" in keys:
            sales = self._employee_key(sales)
        for c in ("customer_surr_id", "product_surr_id", "employee_surr_id", "location_surr_id", "payment_detail_surr_id"):
            if c not in sales.columns:
                sales = sales.withColumn(c, F.lit(-1).cast("long"))
        return sales.select(
            F.col("sale_src_id"), F.to_date("event_dt").alias("date_id"), time_id("event_dt").alias("time_id"),
            "customer_surr_id", "product_surr_id", "employee_surr_id", "location_surr_id", "payment_detail_surr_id",
            F.lit(-1).cast("long").alias("device_surr_id"), "quantity", "price",
            (F.col("quantity") * F.col("price")).cast("decimal(10,2)").alias("cost"), "discount", "total_amount",
            F.lit("BL_3NF").alias("source_system"), F.lit("CE_SALES").alias("source_entity"), *more)

    # The entity of a key and the dimension row of that entity are looked up once per key and written;
    # the sales, of which there are far more, are then joined once.
    def _product_key(self, sales: DataFrame) -> DataFrame:
        known = self.keep("product_keys", lambda: lookup(
            self.ce_products.select(F.col("product_src_id").alias("_src"), "product_id"), self.dim_products,
            F.col("product_id").cast("string"), "product_src_id", "product_surr_id", "_surr").drop("product_id"), write=True)
        return lookup(sales, known, "product_id", "_src", "_surr", "product_surr_id").drop("product_id")

    def _customer_key(self, sales: DataFrame) -> DataFrame:
        known = self.keep("customer_keys", lambda: lookup(
            self.ce_customers.select(F.col("customer_src_id").alias("_src"), "customer_id"), self.dim_customers,
            F.col("customer_id").cast("string"), "customer_src_id", "customer_surr_id", "_surr").drop("customer_id"), write=True)
        return lookup(sales, known, "customer_id", "_src", "_surr", "customer_surr_id").drop("customer_id")

    def _payment_key(self, sales: DataFrame) -> DataFrame:
        known = self.keep("payment_keys", lambda: lookup(
            self.ce_payment_details.select(F.col("payment_detail_src_id").alias("_src"), "payment_detail_id"), self.dim_payment_details,
            F.col("payment_detail_id").cast("string"), "payment_detail_src_id", "payment_detail_surr_id", "_surr")
            .drop("payment_detail_id"), write=True)
        return lookup(sales, known, ckey("payment_method", "card_type", "verification_method"), "_src", "_surr",
                      "payment_detail_surr_id").drop("payment_method", "card_type", "verification_method")

    def _employee_key(self, sales: DataFrame) -> DataFrame:
        located = self.keep("employee_keys", lambda: lookup(
            self.dim_employees, self.dim_locations, "location_id", "location_surr_id", "location_surr_id", "location_surr_id"), write=True)
        within = self.keep_value("ship_dates", lambda: tuple(
            _dt.date.fromisoformat(x) for x in calendar_bounds_from(self.t.lineitem, "l_shipdate")))
        sales = point_in_time_join(sales, located, fact_key="employee_id", fact_ts="event_dt",
                                   version_key="employee_src_id", take=["location_surr_id"],
                                   id_col="employee_surr_id", out_id="employee_surr_id", bucket_months=True, fact_range=within)
        return sales.withColumn("location_surr_id", F.coalesce("v_location_surr_id", F.lit(-1)).cast("long"))

    def fact_merged(self, keys: tuple[str, ...] = ("product", "customer", "payment", "employee")):
        """Fact after batch 1, then the batch-2 fact rows merged into it. The keys of a sale that both
        batches deliver alike are looked up once."""
        rows = self.keep("fct_batches", lambda: partitions.with_month(self._with_keys(
            channel_sales_of_batches(self.feed), keys, ("_first", "_last"))), write=True)

        # the numbers of the first batch are joined on the key that the merge joins on
        ids = self.keep("fct_ids", lambda: assign_keys(rows.filter("_first").select("sale_src_id"), ["sale_src_id"], "sale_surr_id"))
        target = rows.filter("_first").drop("_first", "_last").join(ids, "sale_src_id")
        target = target.select("sale_surr_id", *[c for c in rows.columns if c not in ("_first", "_last", "month_id")],
                               ts_lit(BATCH1_TS).alias("insert_dt"), ts_lit(BATCH1_TS).alias("update_dt"), "month_id")
        source = rows.filter("_last").drop("_first", "_last")
        return merge_fact(target, source, "sale_src_id", FACT_COMPARE, BATCH2_TS, id_col="sale_surr_id", offset=max_id(ids, "sale_surr_id"))


FACT_COMPARE = ["customer_surr_id", "product_surr_id", "employee_surr_id", "location_surr_id",
                "payment_detail_surr_id", "device_surr_id", "quantity", "price", "cost", "discount", "total_amount"]
