"""The data-preparation job (E1–E13) as a Spark job: conform, enrich, assign employees, split.

Every random choice of the original notebook becomes a seeded hash pick (``functions.pick``):
reproducible, computed inside the tasks, no driver dictionaries and no per-row Python.
Name/company generators of the notebook are replaced by rule-built word lists.
"""

from __future__ import annotations

import datetime as _dt
import hashlib
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strata.functions.pick import hash_index, pick
from strata.session import stage

SEED = 42

# ---- Fixed values of the source data set (value domains of the enriched columns) ----------
CATEGORY_SUBCATEGORIES = {
    "Beauty & Personal Care": ["Skincare", "Haircare", "Makeup", "Fragrances", "Bath & Body", "Personal Hygiene"],
    "Books": ["Fiction", "Non-Fiction", "Science", "History", "Biography", "Children Literature", "Academic"],
    "Clothing": ["Shirts", "Pants", "Dresses", "Outerwear", "Activewear", "Underwear", "Accessories"],
    "Sports & Outdoors": ["Fitness Equipment", "Camping Gear", "Team Sports", "Water Sports", "Hiking", "Cycling"],
    "Home & Kitchen": ["Cookware", "Appliances", "Furniture", "Bedding", "Storage", "Decor"],
    "Electronics": ["Smartphones", "Laptops", "Audio", "Gaming", "Cameras", "Accessories"],
}
CATEGORY_MANUFACTURERS = {
    "Beauty & Personal Care": ["L'Oreal", "Estee Lauder", "Procter & Gamble", "Johnson & Johnson", "Unilever",
                               "Shiseido", "Revlon"],
    "Books": ["Penguin Random House", "HarperCollins", "Simon & Schuster", "Macmillan", "Hachette", "Scholastic"],
    "Clothing": ["Nike", "Adidas", "H&M", "Zara", "Gap", "Under Armour", "Ralph Lauren", "Levi's"],
    "Sports & Outdoors": ["Columbia", "The North Face", "Patagonia", "REI", "Coleman", "Wilson", "Callaway"],
    "Home & Kitchen": ["KitchenAid", "Whirlpool", "Bosch", "Philips", "Dyson", "Cuisinart", "Breville"],
    "Electronics": ["Samsung", "Apple", "Sony", "LG", "Dell", "HP", "Lenovo", "Asus"],
}
REGION_COUNTRIES = {
    "Australia": ["Australia", "New Zealand"],
    "South America": ["Brazil", "Argentina", "Chile", "Colombia", "Peru"],
    "Europe": ["Germany", "France", "UK", "Italy", "Spain", "Netherlands"],
    "Africa": ["South Africa", "Nigeria", "Kenya", "Egypt", "Morocco"],
    "North America": ["USA", "Canada", "Mexico"],
    "Asia": ["Japan", "China", "South Korea", "India", "Singapore"],
}
CITIES_PER_COUNTRY, ADDRESSES_PER_CITY = 5, 2
CARD_TYPES = {
    "Credit Card": ["Visa", "Mastercard", "American Express", "Discover", "JCB"],
    "Debit Card": ["Visa Debit", "Mastercard Debit", "Maestro"],
}
VERIFICATION_METHODS = {
    "Credit Card": ["3D Secure", "SMS Verification", "Biometric", "PIN"],
    "Debit Card": ["PIN", "SMS Verification", "Chip and PIN"],
}
EMAIL_DOMAINS = ["gmail.com", "yahoo.com", "outlook.com", "hotmail.com", "company.com"]
DEVICE_TYPES = ["Mobile", "Desktop", "Tablet", "Smart TV"]
BROWSERS = ["Chrome", "Firefox", "Safari", "Edge", "Opera", "Brave", "Vivaldi"]
EMPLOYEE_IDS = (1000, 3000)          # ids 1000..2999
PERIOD_MONTHS, PERIOD_JITTER_DAYS = 3, 28
# ---------------------------------------------------------------------------------------------

# Rule-built word stock for generated names (syllable pairs), not a copied list.
_SYL = ["ka", "lo", "mi", "ra", "te", "vo", "sa", "ne", "ti", "po", "da", "ru"]
WORDS = [a + b for a in _SYL for b in _SYL if a != b]
COLOURS = ["red", "green", "blue", "black", "white", "grey", "brown", "yellow"]


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def _ts_lit(t: _dt.datetime) -> Column:
    return F.lit(t.isoformat(sep=" ")).cast("timestamp_ntz")


def _map_of_lists(d: dict[str, list[str]]) -> Column:
    return F.create_map(*[x for k, v in d.items() for x in (F.lit(k), F.array(*[F.lit(s) for s in v]))])


def conform_first(df: DataFrame, key: str, cols: Sequence[str], order: str) -> DataFrame:
    """One value per key — the first non-NULL value in ``order`` (file order) — written
    back to every row of the key. Per-key partial aggregates, then a join on the key."""
    firsts = df.groupBy(key).agg(*[
        F.min_by(F.col(c), F.when(F.col(c).isNotNull(), F.col(order))).alias(f"_first_{c}") for c in cols])
    out = df.join(firsts, key, "left")
    for c in cols:
        out = out.withColumn(c, F.col(f"_first_{c}")).drop(f"_first_{c}")
    return out


def pick_by_category(df: DataFrame, key: str, category: str, choices: dict[str, list[str]], out: str,
                     seed: int = SEED) -> DataFrame:
    """One value per key chosen from a list that depends on the key's category."""
    arr = F.element_at(_map_of_lists(choices), F.col(category))
    idx = hash_index(F.size(arr), key, seed=seed)
    return df.withColumn(out, F.when(arr.isNotNull(), F.element_at(arr, (idx + 1).cast("int"))))


def pick_from_lists(df: DataFrame, lists: DataFrame, *, key: str, category: str, out: str,
                    seed: int = SEED, index_fn=hash_index) -> DataFrame:
    """E2 with data-derived choice lists: ``lists`` holds (category, ``_choices`` array); one
    value per key is drawn from its category's list."""
    j = df.join(lists, category, "left")
    idx = index_fn(F.size("_choices"), key, seed=seed)
    return j.withColumn(out, F.when(F.size("_choices") > 0,
                                    F.element_at("_choices", (idx + 1).cast("int")))).drop("_choices")


def location_table(spark, seed: int = SEED) -> DataFrame:
    """The region > country > city > address table (26 countries x 5 cities x 2 addresses),
    generated by rule: city / address names are built from the word stock."""
    rows = [(r, c) for r, cs in REGION_COUNTRIES.items() for c in cs]
    base = spark.createDataFrame(rows, "region string, country string")
    cities = base.withColumn("city_no", F.explode(F.sequence(F.lit(1), F.lit(CITIES_PER_COUNTRY))))
    cities = cities.withColumn("city", F.initcap(F.concat(pick(WORDS, "country", "city_no", seed=seed),
                                                          pick(WORDS, "city_no", "country", seed=seed + 1))))
    addr = cities.withColumn("addr_no", F.explode(F.sequence(F.lit(1), F.lit(ADDRESSES_PER_CITY))))
    return addr.withColumn("address", F.concat(
        (hash_index(900, "city", "addr_no", seed=seed) + 100).cast("string"), F.lit(" "),
        F.initcap(pick(WORDS, "addr_no", "city", seed=seed)), F.lit(" Street")))


def assign_locations(df: DataFrame, locations: DataFrame, *, row_key: str, region: str,
                     seed: int = SEED, index_fn=hash_index) -> DataFrame:
    """Per row, a country of its region, a city of that country and an address of that city.
    Done with indexed candidate lists (``idx = hash mod count``) and equi joins; the planner
    broadcasts the candidates when they are small, like the job's own 260-row location table."""
    def level(out: DataFrame, parent: Column, cands: DataFrame, child: str, salt: int) -> DataFrame:
        c = (cands.select(F.col("p").alias("_lp"), F.col("c").alias("_lc")).distinct()
             .withColumn("_li", F.row_number().over(Window.partitionBy("_lp").orderBy("_lc")) - 1))
        sizes = c.groupBy(F.col("_lp").alias("_sp")).agg(F.count(F.lit(1)).alias("_ln"))
        out = (out.join(sizes, parent == F.col("_sp"), "left")
               .withColumn("_pick", index_fn(F.col("_ln"), row_key, seed=seed + salt)))
        out = out.join(c, (parent == F.col("_lp")) & (F.col("_pick") == F.col("_li")), "left")
        return out.withColumnRenamed("_lc", child).drop("_sp", "_ln", "_pick", "_lp", "_li")

    out = level(df, F.col(region), locations.select(F.col("region").alias("p"), F.col("country").alias("c")),
                "country", 0)
    out = level(out, F.col("country"), locations.select(F.col("country").alias("p"), F.col("city").alias("c")),
                "city", 1)
    return level(out, F.col("city"), locations.select(F.col("city").alias("p"), F.col("address").alias("c")),
                 "address", 2)


def card_details(df: DataFrame, *, row_key: str, method: str = "payment_method", seed: int = SEED,
                 index_fn=hash_index) -> DataFrame:
    """Card type and verification method, NULL when the payment method is not a card."""
    ct = F.element_at(_map_of_lists(CARD_TYPES), F.col(method))
    vm = F.element_at(_map_of_lists(VERIFICATION_METHODS), F.col(method))
    return (df.withColumn("card_type", F.when(ct.isNotNull(), F.element_at(
                ct, (index_fn(F.size(ct), row_key, seed=seed) + 1).cast("int"))))
              .withColumn("verification_method", F.when(vm.isNotNull(), F.element_at(
                vm, (index_fn(F.size(vm), row_key, seed=seed + 1) + 1).cast("int")))))


def devices(df: DataFrame, *, row_key: str, seed: int = SEED, index_fn=hash_index) -> DataFrame:
    """E5: uniform device type and browser per row."""
    return (df.withColumn("device_type", pick(DEVICE_TYPES, row_key, seed=seed, index_fn=index_fn))
              .withColumn("browser_used", pick(BROWSERS, row_key, seed=seed + 1, index_fn=index_fn)))


def product_names(df: DataFrame, *, key: str, category: str, subcategory: str, manufacturer: str,
                  seed: int = SEED, index_fn=hash_index) -> DataFrame:
    """Product name by category template, title-cased: books "The <word> <word>", clothing
    "<colour> <subcategory> <word>", everything else "<manufacturer> <subcategory> <word>"."""
    w1, w2 = (pick(WORDS, key, seed=seed + i, index_fn=index_fn) for i in (0, 1))
    colour = pick(COLOURS, key, seed=seed + 2, index_fn=index_fn)
    name = (F.when(F.col(category) == "Books", F.concat_ws(" ", F.lit("The"), w1, w2))
            .when(F.col(category) == "Clothing", F.concat_ws(" ", colour, F.col(subcategory), w1))
            .otherwise(F.concat_ws(" ", F.col(manufacturer), F.col(subcategory), w1)))
    return df.withColumn("product_name", F.initcap(name))


def emails(df: DataFrame, *, key: str, first: str, last: str, out: str, seed: int = SEED, index_fn=hash_index) -> DataFrame:
    """``first.last<id>@domain`` in lower case, domain picked per key."""
    return df.withColumn(out, F.concat(F.lower(F.col(first)), F.lit("."), F.lower(F.col(last)),
                                       F.col(key).cast("string"), F.lit("@"),
                                       pick(EMAIL_DOMAINS, key, seed=seed, index_fn=index_fn)))


def period_bounds(start: _dt.datetime, end: _dt.datetime, seed: int = SEED) -> list[_dt.datetime]:
    """Start, every 3rd month end between start and end shifted by a seeded +-28 days, end.
    A handful of dates (one per quarter), computed from the two data bounds."""
    def jitter(i: int) -> int:
        digest = hashlib.md5(f"{seed}|{i}".encode()).hexdigest()
        return int(digest[:15], 16) % (2 * PERIOD_JITTER_DAYS + 1) - PERIOD_JITTER_DAYS
    out = [start]
    y, m = start.year, start.month
    while True:
        m += PERIOD_MONTHS
        y, m = y + (m - 1) // 12, (m - 1) % 12 + 1
        nxt_first = _dt.date(y + (m // 12), m % 12 + 1, 1)
        month_end = _dt.datetime.combine(nxt_first - _dt.timedelta(days=1), start.time())
        if month_end > end:
            break
        out.append(month_end + _dt.timedelta(days=jitter(len(out))))
    out.append(end)
    return sorted(out)


def employee_roster(spark, locations: DataFrame, bounds: list[_dt.datetime], *, seed: int = SEED) -> DataFrame:
    """Employees 1000..2999, each placed in a (region, country, city), with one address of
    that city per period. Periods are exploded per employee (a short literal list), not joined."""
    cities = (locations.select("region", "country", "city").distinct()
              .withColumn("_ci", F.row_number().over(Window.orderBy("region", "country", "city")) - 1))
    n_cities = sum(len(cs) for cs in REGION_COUNTRIES.values()) * CITIES_PER_COUNTRY
    emp = (spark.range(*EMPLOYEE_IDS).withColumnRenamed("id", "employee_id")
           .withColumn("_ci", hash_index(n_cities, "employee_id", seed=seed))
           .join(F.broadcast(cities), "_ci").drop("_ci")
           .withColumn("employee_first_name", F.initcap(pick(WORDS, "employee_id", seed=seed + 3)))
           .withColumn("employee_last_name", F.initcap(pick(WORDS, "employee_id", seed=seed + 4))))
    return roster_periods(emp, locations, bounds, seed=seed + 5)


def roster_periods(employees: DataFrame, locations: DataFrame, bounds: list[_dt.datetime], *, seed: int = SEED,
                   index_fn=hash_index) -> DataFrame:
    """Every employee (``employee_id``, ``city``, ...) once per period (closed, neighbours share a
    bound), each time at an address of its city. Periods are exploded per employee (a short literal
    list); the addresses of a city are numbered and taken by an equi join, so no pairs are made."""
    pairs = F.array(*[F.struct(F.lit(i).alias("period_no"), _ts_lit(a).alias("period_start"),
                               _ts_lit(b).alias("period_end"))
                      for i, (a, b) in enumerate(zip(bounds[:-1], bounds[1:]))])
    roster = employees.withColumn("_p", F.explode(pairs)).select("*", "_p.*").drop("_p")
    addrs = locations.select(F.col("city").alias("_c2"), "address").distinct()
    addrs = addrs.withColumn("_ak", F.row_number().over(Window.partitionBy("_c2").orderBy("address")) - 1)
    sizes = addrs.groupBy(F.col("_c2").alias("_c3")).agg(F.count(F.lit(1)).alias("_n"))
    roster = roster.join(sizes, F.col("city") == F.col("_c3"))
    roster = roster.withColumn("_k", index_fn(F.col("_n"), "employee_id", "period_no", seed=seed))
    return (roster.join(addrs, (F.col("city") == F.col("_c2")) & (F.col("_k") == F.col("_ak")))
            .drop("_c2", "_ak", "_k", "_c3", "_n"))


def period_index(ts, bounds: list[_dt.datetime]) -> Column:
    """Index of the first period ``[b_i, b_i+1]`` (closed) holding ``ts``: the number of bounds
    strictly before ``ts``, minus one, at least 0 (a short CASE chain over the bounds)."""
    t = _c(ts)
    expr = F.when(t.isNull(), F.lit(None).cast("int")).when(t <= _ts_lit(bounds[0]), F.lit(0))
    for i, b in enumerate(bounds[1:]):
        expr = expr.when(t <= _ts_lit(b), F.lit(i))
    return expr.otherwise(F.lit(max(len(bounds) - 1, 0)))


def assign_employees(sales: DataFrame, roster: DataFrame, bounds: list[_dt.datetime], *, row_key: str,
                     ts: str = "timestamp", seed: int = SEED, index_fn=hash_index) -> DataFrame:
    """Give each sale an employee working at the sale's (country, city, address) in the
    sale's period, picked at random; if there is none, any employee of the (country, city).

    No candidate pairs are enumerated: candidates of a group are numbered, the sale draws a
    number ``hash mod group size`` and takes that candidate by an equi join — linear in the
    sales, whatever the group sizes.
    """
    cand = roster.select("employee_id", "country", "city", "address", "period_no")
    g1 = ["country", "city", "address", "period_no"]
    c1 = cand.withColumn("_n1", F.row_number().over(Window.partitionBy(*g1).orderBy("employee_id")) - 1)
    s1 = c1.groupBy(*g1).agg(F.count(F.lit(1)).alias("_size1"))
    g2 = ["country", "city"]
    c2 = (cand.select("employee_id", *g2).distinct()
          .withColumn("_n2", F.row_number().over(Window.partitionBy(*g2).orderBy("employee_id")) - 1))
    s2 = c2.groupBy(*g2).agg(F.count(F.lit(1)).alias("_size2"))
    s = (sales.withColumn("period_no", period_index(ts, bounds))
         .join(s1, g1, "left").join(s2, g2, "left")
         .withColumn("_n1", index_fn(F.col("_size1"), row_key, seed=seed))
         .withColumn("_n2", index_fn(F.col("_size2"), row_key, seed=seed + 1)))
    s = (s.join(c1.select(*g1, "_n1", F.col("employee_id").alias("_e1")), g1 + ["_n1"], "left")
         .join(c2.select(*g2, "_n2", F.col("employee_id").alias("_e2")), g2 + ["_n2"], "left"))
    return (s.withColumn("employee_id", F.coalesce("_e1", "_e2"))
            .drop("_n1", "_n2", "_size1", "_size2", "_e1", "_e2", "period_no"))


SPLIT_SMALL = 4_096  # places that may be ordered at once


def split_half(df: DataFrame, *, row_key: str, seed: int = SEED, small: int = SPLIT_SMALL):
    """Exact half split after a seeded shuffle — the first ``n // 2`` rows in the order of
    ``md5(seed|key)`` (then key) go online.

    The rows are written once with their place. The place of the last online row is found by narrowing:
    rows are counted by the next four digits of their hash, the digits that hold the middle row are
    kept, until at most ``small`` rows (or one hash) are left to be ordered. Both halves are filters on
    the written rows: no row is shuffled or ranked. ``row_key`` must be unique.
    """
    key = F.col(row_key).cast("string")
    df = stage(df.withColumn("_h", F.md5(F.concat_ws("|", F.lit(str(seed)), key))).withColumn("_k", key), "split")
    left, prefix, size = df.count() // 2, "", None
    if not left:
        return df.filter(F.lit(False)).drop("_h", "_k"), df.drop("_h", "_k")
    while size is None or size > small and len(prefix) < 32:
        here = df.filter(F.col("_h").startswith(prefix)) if prefix else df
        counts = {r[0]: r[1] for r in here.groupBy(F.substring("_h", 1, len(prefix) + 4)).count().collect()}  # 16**4 at most
        for prefix in sorted(counts):
            if left <= counts[prefix]:
                break
            left -= counts[prefix]
        size = counts[prefix]
    places = df.filter(F.col("_h").startswith(prefix)).select("_h", "_k").orderBy("_h", "_k").limit(left)
    last = places.agg(F.max(F.struct("_h", "_k")).alias("p")).first()["p"]
    online = (F.col("_h") < last["_h"]) | (F.col("_h") == last["_h"]) & (F.col("_k") <= last["_k"])
    return df.filter(online).drop("_h", "_k"), df.filter(~online).drop("_h", "_k")
