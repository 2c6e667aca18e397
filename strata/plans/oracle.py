"""DuckDB SQL computing the same results as ``driver_queries`` (the correctness oracle).

Tables ``region nation customer supplier part orders lineitem events`` are views over the same
parquet files. Every output column is aliased to the Spark name and cast to the Spark type.
Ids assigned by ``assign_keys`` are ``row_number() OVER (ORDER BY <natural key>)`` here.
"""

from __future__ import annotations

from strata.operators import prepare
from strata.sources.tables import OFFLINE_COLUMNS, ONLINE_COLUMNS

CUTOFF = "TIMESTAMP '1998-01-01 00:00:00'"
B1 = "TIMESTAMP '2024-01-01 00:00:00'"
B2 = "TIMESTAMP '2024-02-01 00:00:00'"
HIGH = "TIMESTAMP '9999-12-31 23:59:59'"
LOW = "TIMESTAMP '1900-01-01 00:00:00'"


def NA(x: str) -> str:
    return f"coalesce(upper(trim({x})), 'N/A')"


def STD(x: str) -> str:
    return f"upper(trim({x}))"


def MD5IDX(n: str, key: str, seed: int = 42) -> str:
    return f"(CAST(('0x' || substr(md5('{seed}|' || CAST({key} AS VARCHAR)), 1, 15)) AS BIGINT) % ({n}))"


LATEST_LINEITEM = """
  SELECT * FROM (
    SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber
                                 ORDER BY l_shipdate DESC, l_partkey DESC, l_suppkey DESC, l_quantity DESC,
                                          l_extendedprice DESC, l_discount DESC, l_tax DESC,
                                          l_returnflag DESC, l_linestatus DESC) AS rn
    FROM lineitem) WHERE rn = 1
"""


def calendar_from(series: str) -> str:
    """Calendar columns over ``series`` (a FROM item yielding column ``d``)."""
    return f"""
  SELECT CAST(d AS DATE) AS date_id,
         CAST(isodow(d) AS SMALLINT) AS day_of_week_number,
         rpad(upper(strftime(d, '%A')), 9, ' ') AS day_of_week_name,
         isodow(d) IN (6, 7) AS weekend_flag,
         CAST(weekofyear(d) AS SMALLINT) AS iso_week_number,
         CAST(day(d) AS SMALLINT) AS day_of_month_number,
         CAST(month(d) AS SMALLINT) AS month_value,
         rpad(upper(strftime(d, '%B')), 9, ' ') AS month_name,
         CAST(quarter(d) AS SMALLINT) AS quarter_value,
         'Q' || CAST(quarter(d) AS VARCHAR) AS quarter_name,
         CAST(year(d) AS SMALLINT) AS year_value
  FROM {series}"""


TIMES = """
  SELECT CAST(i AS SMALLINT) AS time_id, CAST(i % 60 AS SMALLINT) AS minute_value,
         CAST(i // 60 AS SMALLINT) AS hour_value,
         lpad(CAST(i // 60 AS VARCHAR), 2, '0') || ':' || lpad(CAST(i % 60 AS VARCHAR), 2, '0') AS hour_name,
         (i // 60) >= 8 AND (i // 60) < 16 AS working_hours_flag,
         CASE WHEN i // 60 >= 6 AND i // 60 < 12 THEN 'MORNING'
              WHEN i // 60 >= 12 AND i // 60 < 18 THEN 'AFTERNOON'
              WHEN i // 60 >= 18 AND i // 60 < 24 THEN 'EVENING'
              WHEN i // 60 >= 0 AND i // 60 < 6 THEN 'NIGHT' ELSE 'UNKNOWN' END AS time_of_day
  FROM range(0, 1440) AS r(i)
"""

# The sale feed: one record per order line, typed like ``standin.sales_feed``.
FEED = """
  SELECT *, md5(concat_ws('|', transaction_id, customer_id, product_id, employee_id, payment_method,
                          card_type, verification_method, CAST(quantity AS VARCHAR), CAST(price AS VARCHAR),
                          CAST(discount AS VARCHAR), CAST(total_amount AS VARCHAR), source_system)) AS hash_value
  FROM (
    SELECT concat_ws('|', CAST(l_orderkey AS VARCHAR), CAST(l_linenumber AS VARCHAR)) AS transaction_id,
           l_shipdate AS event_dt, o_orderdate AS order_dt,
           CAST(o_custkey AS VARCHAR) AS customer_id, CAST(l_partkey AS VARCHAR) AS product_id,
           CAST(l_suppkey AS VARCHAR) AS employee_id,
           o_orderpriority AS payment_method, l_returnflag AS card_type, l_linestatus AS verification_method,
           CAST(l_quantity AS SMALLINT) AS quantity,
           CAST(CAST(l_extendedprice AS DECIMAL(12,2)) AS DECIMAL(10,2)) AS price,
           CAST(l_discount AS DECIMAL(3,2)) AS discount,
           CAST(CAST(l_extendedprice AS DECIMAL(12,2)) * (1 - CAST(l_discount AS DECIMAL(3,2))) AS DECIMAL(10,2)) AS total_amount,
           CASE WHEN l_orderkey % 2 = 0 THEN 'SA_ONLINE' ELSE 'SA_OFFLINE' END AS source_system
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey)
"""

STAGED = f"""
  feedx AS (SELECT * FROM feed WHERE transaction_id IS NOT NULL AND event_dt IS NOT NULL),
  s1 AS (SELECT hash_value, transaction_id, event_dt, {B1} AS load_dt FROM (
           SELECT *, row_number() OVER (PARTITION BY hash_value ORDER BY event_dt) AS rn
           FROM feedx WHERE event_dt < {CUTOFF}) WHERE rn = 1),
  s2 AS (SELECT hash_value, transaction_id, event_dt, {B2} AS load_dt FROM (
           SELECT *, row_number() OVER (PARTITION BY hash_value ORDER BY event_dt) AS rn FROM feedx)
         WHERE rn = 1 AND hash_value NOT IN (SELECT hash_value FROM s1)),
  staged AS (SELECT * FROM s1 UNION ALL SELECT * FROM s2)
"""


def channel_sales(feed: str) -> str:
    return f"""
  SELECT {STD('transaction_id')} AS sale_src_id, event_dt,
         CASE WHEN source_system = 'SA_ONLINE' THEN {NA('customer_id')} ELSE 'N/A' END AS customer_id,
         {NA('product_id')} AS product_id,
         CASE WHEN source_system = 'SA_ONLINE' THEN 'N/A' ELSE {NA('employee_id')} END AS employee_id,
         {NA('payment_method')} AS payment_method, {NA('card_type')} AS card_type,
         {NA('verification_method')} AS verification_method,
         quantity, price, discount, total_amount, source_system, 'SRC_RETAIL_SALES' AS source_entity
  FROM (SELECT *, row_number() OVER (PARTITION BY source_system, {STD('transaction_id')}
                                     ORDER BY event_dt DESC, hash_value DESC) AS rn FROM {feed})
  WHERE rn = 1"""


PRODUCT_MAP = f"""
  rec AS (SELECT {STD('product_id')} AS product_src_id, {NA('p_name')} AS product_name,
                 {NA('p_brand')} AS manufacturer, {NA('CAST(p_size AS VARCHAR)')} AS subcategory_name,
                 {NA('p_type')} AS category_name, source_system, 'SRC_RETAIL_SALES' AS source_entity,
                 event_dt, hash_value AS feed_hash
          FROM feed JOIN part ON product_id = CAST(p_partkey AS VARCHAR)),
  r1 AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY source_system, product_src_id
                                                     ORDER BY event_dt DESC, feed_hash DESC) AS rn
                        FROM rec WHERE event_dt < {CUTOFF}) WHERE rn = 1),
  r2 AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY source_system, product_src_id
                                                     ORDER BY event_dt DESC, feed_hash DESC) AS rn
                        FROM rec) WHERE rn = 1),
  m1 AS (SELECT dense_rank() OVER (ORDER BY product_src_id) AS product_id, product_src_id, product_name,
                manufacturer, subcategory_name, category_name, source_system, source_entity,
                md5(concat_ws('|', product_src_id, product_name, manufacturer, subcategory_name, category_name,
                              source_system, source_entity)) AS hash_value, {B1} AS load_dt
         FROM r1),
  newkeys AS (SELECT product_src_id,
                     (SELECT coalesce(max(product_id), 0) FROM m1) + row_number() OVER (ORDER BY product_src_id)
                       AS product_id
              FROM (SELECT DISTINCT product_src_id FROM r2 ANTI JOIN m1 USING (product_src_id))),
  ids AS (SELECT product_src_id, min(product_id) AS product_id FROM m1 GROUP BY 1
          UNION ALL SELECT product_src_id, product_id FROM newkeys),
  h2 AS (SELECT r2.*, md5(concat_ws('|', product_src_id, product_name, manufacturer, subcategory_name,
                                    category_name, source_system, source_entity)) AS hash_value FROM r2),
  m2 AS (SELECT ids.product_id, h2.product_src_id, product_name, manufacturer, subcategory_name, category_name,
                source_system, source_entity, hash_value, {B2} AS load_dt
         FROM h2 ANTI JOIN m1 USING (hash_value) JOIN ids ON h2.product_src_id = ids.product_src_id),
  pmap AS (SELECT * FROM m1 UNION ALL SELECT * FROM m2)
"""


def customer_state(name: str, cond: str) -> str:
    return f"""
  {name} AS (SELECT CAST(o_custkey AS VARCHAR) AS customer_src_id, {NA('c_name')} AS customer_name,
                    {NA('c_mktsegment')} AS segment, {NA('o_orderpriority')} AS last_priority,
                    {NA('o_orderstatus')} AS last_status, 'SA_ONLINE' AS source_system,
                    'SRC_RETAIL_SALES' AS source_entity
             FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS rn
                   FROM orders WHERE {cond}) o
             LEFT JOIN customer ON o_custkey = c_custkey
             WHERE rn = 1)"""


CUSTOMERS = f"""
  {customer_state('cs1', f'o_orderdate < {CUTOFF}')},
  {customer_state('cs2', 'TRUE')},
  t1 AS (SELECT row_number() OVER (ORDER BY customer_src_id) AS customer_id, * FROM cs1),
  ins AS (SELECT (SELECT coalesce(max(customer_id), 0) FROM t1) + row_number() OVER (ORDER BY customer_src_id)
                   AS customer_id, customer_src_id, customer_name, segment, last_priority, last_status,
                 source_system, source_entity, {B2} AS insert_dt, {B2} AS update_dt
          FROM cs2 WHERE customer_src_id NOT IN (SELECT customer_src_id FROM t1)),
  upd AS (SELECT t1.customer_id, t1.customer_src_id, s.customer_name, s.segment, s.last_priority, s.last_status,
                 t1.source_system, t1.source_entity, {B1} AS insert_dt, {B2} AS update_dt
          FROM t1 JOIN cs2 s ON t1.customer_src_id = s.customer_src_id
          WHERE t1.customer_name <> s.customer_name OR t1.segment <> s.segment
             OR t1.last_priority <> s.last_priority OR t1.last_status <> s.last_status),
  cust_counts AS (SELECT (SELECT count(*) FROM cs2) AS rows_processed, (SELECT count(*) FROM ins) AS rows_inserted,
                         (SELECT count(*) FROM upd) AS rows_updated)
"""


def islands(name: str, high: str) -> str:
    """SCD2 versions ``<name>_v`` of the feed ``<name>_e`` (k, ts, a, h)."""
    return f"""{name}_d AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY k, ts ORDER BY h DESC) AS r
                              FROM {name}_e) WHERE r = 1),
  {name}_l AS (SELECT *, lag(a) OVER (PARTITION BY k ORDER BY ts) AS pa FROM {name}_d),
  {name}_s AS (SELECT k, a, ts AS start_dt FROM {name}_l WHERE pa IS NULL OR pa <> a),
  {name}_n AS (SELECT *, lead(start_dt) OVER (PARTITION BY k ORDER BY start_dt) AS nx FROM {name}_s),
  {name}_v AS (SELECT k, a, start_dt, CASE WHEN nx IS NULL THEN {high} ELSE nx - INTERVAL 1 MINUTE END AS end_dt,
                      nx IS NULL AS is_active FROM {name}_n)"""


def versions(name: str, cond: str) -> str:
    """Gaps-and-islands SCD2 versions of the employee feed (``events`` rows matching ``cond``)."""
    return f"""
  {name}_e AS (SELECT CAST(user_id AS VARCHAR) AS k, ts, {NA('event_type')} AS a,
                      md5({NA('event_type')}) AS h FROM events WHERE {cond}),
  {islands(name, HIGH)},
  {name} AS (SELECT k AS employee_src_id, a AS event_type, start_dt, end_dt, is_active FROM {name}_v)"""


PIT = f"""
  {versions('v', "coalesce(upper(trim(event_type)), 'N/A') <> 'PURCHASE'")},
  vs AS (SELECT *, row_number() OVER (ORDER BY employee_src_id, start_dt) AS employee_surr_id FROM v),
  probes AS (SELECT event_id, CAST(user_id AS VARCHAR) AS employee_src_id, ts FROM events
             WHERE {NA('event_type')} = 'PURCHASE')
SELECT p.event_id, p.employee_src_id, p.ts, coalesce(vs.event_type, 'N/A') AS version_event_type,
       coalesce(vs.employee_surr_id, -1) AS employee_surr_id
FROM probes p LEFT JOIN vs ON p.employee_src_id = vs.employee_src_id AND p.ts BETWEEN vs.start_dt AND vs.end_dt
"""

PRODUCTS = f"""
  cats AS (SELECT product_category_src_id, row_number() OVER (ORDER BY product_category_src_id) AS product_category_id,
                  product_category_src_id AS category_name
           FROM (SELECT DISTINCT {NA('p_type')} AS product_category_src_id FROM part)),
  subs AS (SELECT *, row_number() OVER (ORDER BY product_subcategory_src_id) AS product_subcategory_id
           FROM (SELECT subcategory_name, _cat, concat_ws('|', subcategory_name, _cat) AS product_subcategory_src_id
                 FROM (SELECT DISTINCT {NA('p_brand')} AS subcategory_name, {NA('p_type')} AS _cat FROM part))),
  subs2 AS (SELECT subs.*, coalesce(cats.product_category_id, -1) AS product_category_id
            FROM subs LEFT JOIN cats ON subs._cat = cats.category_name),
  prods AS (SELECT CAST(p_partkey AS VARCHAR) AS product_src_id, {NA('p_name')} AS product_name,
                   concat_ws('|', {NA('p_brand')}, {NA('p_type')}) AS _sub,
                   row_number() OVER (ORDER BY CAST(p_partkey AS VARCHAR)) AS product_id FROM part),
  prods2 AS (SELECT prods.*, coalesce(subs2.product_subcategory_id, -1) AS product_subcategory_id
             FROM prods LEFT JOIN subs2 ON prods._sub = subs2.product_subcategory_src_id),
  dprod AS (SELECT d.product_surr_id, d.product_src_id, d.product_name,
                   coalesce(d.product_subcategory_id, -1) AS product_subcategory_id,
                   coalesce(s.subcategory_name, 'N/A') AS product_subcategory_name,
                   coalesce(s.product_category_id, -1) AS product_category_id,
                   coalesce(c.category_name, 'N/A') AS product_category_name
            FROM (SELECT CAST(product_id AS VARCHAR) AS product_src_id, product_name, product_subcategory_id,
                         row_number() OVER (ORDER BY CAST(product_id AS VARCHAR)) AS product_surr_id FROM prods2) d
            LEFT JOIN subs2 s ON d.product_subcategory_id = s.product_subcategory_id
            LEFT JOIN cats c ON s.product_category_id = c.product_category_id)
"""

LOCATIONS = f"""
  countries AS (SELECT country_src_id, row_number() OVER (ORDER BY country_src_id) AS country_id,
                       country_src_id AS country_name
                FROM (SELECT DISTINCT {NA('r_name')} AS country_src_id FROM region)),
  nr AS (SELECT * FROM nation LEFT JOIN region ON n_regionkey = r_regionkey),
  cities AS (SELECT c.*, coalesce(co.country_id, -1) AS country_id
             FROM (SELECT *, row_number() OVER (ORDER BY city_src_id) AS city_id
                   FROM (SELECT city_name, _country, concat_ws('|', city_name, _country) AS city_src_id
                         FROM (SELECT DISTINCT {NA('n_name')} AS city_name, {NA('r_name')} AS _country FROM nr))) c
             LEFT JOIN countries co ON c._country = co.country_name),
  addrs AS (SELECT a.*, coalesce(ci.city_id, -1) AS city_id
            FROM (SELECT *, row_number() OVER (ORDER BY address_src_id) AS address_id
                  FROM (SELECT address_name, _city, concat_ws('|', address_name, _city) AS address_src_id
                        FROM (SELECT {NA('s_name')} AS address_name, concat_ws('|', {NA('n_name')}, {NA('r_name')}) AS _city
                              FROM supplier LEFT JOIN nr ON s_nationkey = n_nationkey))) a
            LEFT JOIN cities ci ON a._city = ci.city_src_id),
  dloc AS (SELECT d.location_surr_id, d.location_src_id, d.address_id, d.address_name,
                  coalesce(d.city_id, -1) AS city_id, coalesce(ci.city_name, 'N/A') AS city_name,
                  coalesce(ci.country_id, -1) AS country_id, coalesce(co.country_name, 'N/A') AS country_name
           FROM (SELECT CAST(address_id AS VARCHAR) AS location_src_id, address_id, address_name, city_id,
                        row_number() OVER (ORDER BY CAST(address_id AS VARCHAR)) AS location_surr_id FROM addrs) d
           LEFT JOIN cities ci ON d.city_id = ci.city_id
           LEFT JOIN countries co ON ci.country_id = co.country_id)
"""

PAYMENTS = f"""
  precs AS (SELECT DISTINCT {NA('payment_method')} AS payment_method_name, {NA('card_type')} AS card_type_name,
                            {NA('verification_method')} AS verification_method FROM feed),
  methods AS (SELECT payment_method_src_id, row_number() OVER (ORDER BY payment_method_src_id) AS payment_method_id,
                     payment_method_src_id AS payment_method_name
              FROM (SELECT DISTINCT payment_method_name AS payment_method_src_id FROM precs)),
  cards AS (SELECT *, row_number() OVER (ORDER BY card_type_src_id) AS card_type_id
            FROM (SELECT card_type_name, verification_method,
                         concat_ws('|', card_type_name, verification_method) AS card_type_src_id
                  FROM (SELECT DISTINCT card_type_name, verification_method FROM precs))),
  cepay AS (SELECT d.payment_detail_id, d.payment_detail_src_id, coalesce(m.payment_method_id, -1) AS payment_method_id,
                   coalesce(c.card_type_id, -1) AS card_type_id
            FROM (SELECT *, row_number() OVER (ORDER BY payment_detail_src_id) AS payment_detail_id
                  FROM (SELECT *, concat_ws('|', payment_method_name, card_type_name, verification_method)
                                    AS payment_detail_src_id FROM precs)) d
            LEFT JOIN methods m ON d.payment_method_name = m.payment_method_src_id
            LEFT JOIN cards c ON concat_ws('|', d.card_type_name, d.verification_method) = c.card_type_src_id),
  dpay AS (SELECT d.payment_detail_surr_id, d.payment_detail_src_id, d.payment_method_id,
                  coalesce(m.payment_method_name, 'N/A') AS payment_method_name, d.card_type_id,
                  coalesce(c.card_type_name, 'N/A') AS card_type_name,
                  coalesce(c.verification_method, 'N/A') AS verification_method
           FROM (SELECT CAST(payment_detail_id AS VARCHAR) AS payment_detail_src_id, payment_method_id, card_type_id,
                        row_number() OVER (ORDER BY CAST(payment_detail_id AS VARCHAR)) AS payment_detail_surr_id
                 FROM cepay) d
           LEFT JOIN methods m ON d.payment_method_id = m.payment_method_id
           LEFT JOIN cards c ON d.card_type_id = c.card_type_id)
"""

STAR = f"""
  {PRODUCTS.strip()},
  {LOCATIONS.strip()},
  {PAYMENTS.strip()},
  cecus AS (SELECT CAST(c_custkey AS VARCHAR) AS customer_src_id,
                   row_number() OVER (ORDER BY CAST(c_custkey AS VARCHAR)) AS customer_id FROM customer),
  dcus AS (SELECT CAST(customer_id AS VARCHAR) AS customer_src_id,
                  row_number() OVER (ORDER BY CAST(customer_id AS VARCHAR)) AS customer_surr_id FROM cecus),
  demp_e AS (SELECT CAST(user_id % (SELECT count(*) FROM supplier) AS VARCHAR) AS k,
                    TIMESTAMP '1995-01-01' + to_seconds(80 * date_diff('second', TIMESTAMP '2024-01-01', ts)) AS ts,
                    {NA('s_name')} AS a, md5({NA('s_name')}) AS h
             FROM events JOIN supplier ON s_suppkey = event_id * 7 % (SELECT count(*) FROM supplier)),
  {islands('demp', HIGH)},
  demp AS (SELECT e.*, row_number() OVER (ORDER BY employee_src_id, start_dt) AS employee_surr_id
           FROM (SELECT n.k AS employee_src_id, coalesce(l.location_surr_id, -1) AS location_id, start_dt, end_dt, is_active
                 FROM demp_v n LEFT JOIN dloc l ON n.a = l.address_name) e)
"""


def fact(name: str, feed: str) -> str:
    return f"""
  {name}_ch AS ({channel_sales(feed)}),
  {name} AS (
    SELECT ch.sale_src_id, CAST(ch.event_dt AS DATE) AS date_id,
           CAST(hour(ch.event_dt) * 60 + minute(ch.event_dt) AS SMALLINT) AS time_id,
           coalesce(dcus.customer_surr_id, -1) AS customer_surr_id,
           coalesce(dp.product_surr_id, -1) AS product_surr_id,
           coalesce(e.employee_surr_id, -1) AS employee_surr_id,
           coalesce(l.location_surr_id, -1) AS location_surr_id,
           coalesce(dpay.payment_detail_surr_id, -1) AS payment_detail_surr_id,
           CAST(-1 AS BIGINT) AS device_surr_id, ch.quantity, ch.price,
           CAST(ch.quantity * ch.price AS DECIMAL(10,2)) AS cost, ch.discount, ch.total_amount,
           'BL_3NF' AS source_system, 'CE_SALES' AS source_entity
    FROM {name}_ch ch
    LEFT JOIN prods2 cp ON ch.product_id = cp.product_src_id
    LEFT JOIN dprod dp ON CAST(coalesce(cp.product_id, -1) AS VARCHAR) = dp.product_src_id
    LEFT JOIN cecus cc ON ch.customer_id = cc.customer_src_id
    LEFT JOIN dcus ON CAST(coalesce(cc.customer_id, -1) AS VARCHAR) = dcus.customer_src_id
    LEFT JOIN cepay cpy ON concat_ws('|', ch.payment_method, ch.card_type, ch.verification_method) = cpy.payment_detail_src_id
    LEFT JOIN dpay ON CAST(coalesce(cpy.payment_detail_id, -1) AS VARCHAR) = dpay.payment_detail_src_id
    LEFT JOIN demp e ON ch.employee_id = e.employee_src_id AND ch.event_dt BETWEEN e.start_dt AND e.end_dt
    LEFT JOIN dloc l ON coalesce(e.location_id, -1) = l.location_surr_id)"""


CMP = ["customer_surr_id", "product_surr_id", "employee_surr_id", "location_surr_id", "payment_detail_surr_id",
       "device_surr_id", "quantity", "price", "cost", "discount", "total_amount"]
MERGED = f"""
  {STAR.strip()},
  {fact('fa', f"(SELECT * FROM feed WHERE event_dt < {CUTOFF})").strip()},
  {fact('fb', 'feed').strip()},
  f1 AS (SELECT row_number() OVER (ORDER BY sale_src_id) AS sale_surr_id, *, {B1} AS insert_dt, {B1} AS update_dt,
                CAST(year(date_id) * 100 + month(date_id) AS INTEGER) AS month_id FROM fa),
  chg AS (SELECT f1.sale_src_id FROM f1 JOIN fb ON f1.sale_src_id = fb.sale_src_id
          WHERE {' OR '.join(f'f1.{c} <> fb.{c}' for c in CMP)}),
  merged AS (
    SELECT f1.sale_surr_id, f1.sale_src_id, f1.date_id, f1.time_id,
           {', '.join(f'CASE WHEN chg.sale_src_id IS NULL THEN f1.{c} ELSE fb.{c} END AS {c}' for c in CMP)},
           f1.source_system, f1.source_entity, f1.insert_dt,
           CASE WHEN chg.sale_src_id IS NULL THEN f1.update_dt ELSE {B2} END AS update_dt, f1.month_id
    FROM f1 LEFT JOIN chg ON f1.sale_src_id = chg.sale_src_id LEFT JOIN fb ON chg.sale_src_id = fb.sale_src_id
    UNION ALL
    SELECT (SELECT coalesce(max(sale_surr_id), 0) FROM f1) + row_number() OVER (ORDER BY sale_src_id),
           sale_src_id, date_id, time_id, {', '.join(CMP)}, source_system, source_entity, {B2}, {B2},
           CAST(year(date_id) * 100 + month(date_id) AS INTEGER)
    FROM fb WHERE sale_src_id NOT IN (SELECT sale_src_id FROM f1))
"""

YEAR_BOUNDS = "[" + ", ".join(f"TIMESTAMP '{y}-01-01 00:00:00'" for y in range(1995, 2003)) + "]"


def PERIOD(ts: str) -> str:
    return f"greatest(len(list_filter({YEAR_BOUNDS}, lambda b: b < {ts})) - 1, 0)"


ORACLE_SQL: dict[str, str] = {}

ORACLE_SQL["mart_category_month"] = f"""
WITH li AS ({LATEST_LINEITEM}),
     b AS (SELECT min(CAST(o_orderdate AS DATE)) AS lo, max(CAST(o_orderdate AS DATE)) AS hi FROM orders),
     cal AS ({calendar_from("(SELECT unnest(generate_series(lo, hi, INTERVAL 1 DAY)) AS d FROM b)")})
SELECT cal.year_value, cal.month_value, COALESCE(p.p_type, 'N/A') AS product_category,
       CAST(SUM(CAST(li.l_quantity AS DECIMAL(10,2))) AS DECIMAL(18,2)) AS sum_quantity,
       CAST(SUM(CAST(li.l_extendedprice AS DECIMAL(12,2))) AS DECIMAL(18,2)) AS sum_amount,
       COUNT(*) AS n_lines
FROM li LEFT JOIN orders o ON li.l_orderkey = o.o_orderkey
        LEFT JOIN part p ON li.l_partkey = p.p_partkey
        LEFT JOIN cal ON CAST(o.o_orderdate AS DATE) = cal.date_id
GROUP BY 1, 2, 3
"""

ORACLE_SQL["stage_fingerprint"] = f"""
WITH feed AS ({FEED})
SELECT transaction_id, event_dt, source_system, hash_value FROM feed
WHERE transaction_id IS NOT NULL AND event_dt IS NOT NULL
"""

ORACLE_SQL["stage_append_dedup"] = f"""
WITH feed AS ({FEED}), {STAGED}
SELECT hash_value, transaction_id, event_dt, load_dt FROM staged
"""

ORACLE_SQL["incremental_filter"] = f"""
WITH feed AS ({FEED}), {STAGED}
SELECT hash_value, transaction_id, event_dt, load_dt FROM staged WHERE load_dt > {B1}
"""

ORACLE_SQL["latest_per_key"] = f"""
WITH feed AS ({FEED})
SELECT transaction_id, event_dt, hash_value, product_id, quantity, price FROM (
  SELECT *, row_number() OVER (PARTITION BY transaction_id ORDER BY event_dt DESC, hash_value DESC) AS rn FROM feed)
WHERE rn = 1
"""

ORACLE_SQL["latest_composite_key"] = f"""
WITH feed AS ({FEED})
SELECT customer_product_key, customer_id, product_id, event_dt, price, hash_value FROM (
  SELECT *, concat_ws('|', customer_id, product_id) AS customer_product_key,
         row_number() OVER (PARTITION BY concat_ws('|', customer_id, product_id)
                            ORDER BY event_dt DESC, hash_value DESC) AS rn FROM feed)
WHERE rn = 1
"""

ORACLE_SQL["union_sources"] = f"""
WITH feed AS ({FEED})
{channel_sales('feed')}
"""

ORACLE_SQL["map_or_mint"] = f"""
WITH feed AS ({FEED}), {PRODUCT_MAP}
SELECT * FROM pmap
"""

ORACLE_SQL["assign_keys"] = f"""
WITH o AS (SELECT CAST(o_custkey AS VARCHAR) AS customer_src_id, o_orderdate FROM orders),
     f AS (SELECT customer_src_id, row_number() OVER (ORDER BY customer_src_id) AS customer_id
           FROM (SELECT DISTINCT customer_src_id FROM o WHERE o_orderdate < {CUTOFF})),
     l AS (SELECT customer_src_id,
                  (SELECT coalesce(max(customer_id), 0) FROM f) + row_number() OVER (ORDER BY customer_src_id)
                    AS customer_id
           FROM (SELECT DISTINCT customer_src_id FROM o WHERE customer_src_id NOT IN (SELECT customer_src_id FROM f)))
SELECT customer_src_id, CAST(customer_id AS BIGINT) AS customer_id FROM f
UNION ALL SELECT customer_src_id, CAST(customer_id AS BIGINT) FROM l
"""

ORACLE_SQL["default_member"] = f"""
SELECT row_number() OVER (ORDER BY customer_src_id) AS customer_id, customer_src_id, customer_name, segment,
       'SA_ONLINE' AS source_system, 'SRC_RETAIL_SALES' AS source_entity, {B1} AS insert_dt, {B1} AS update_dt
FROM (SELECT CAST(c_custkey AS VARCHAR) AS customer_src_id, {NA('c_name')} AS customer_name,
             {NA('c_mktsegment')} AS segment FROM customer)
UNION ALL
SELECT -1, 'N/A', 'N/A', 'N/A', 'MANUAL', 'MANUAL', {LOW}, {LOW}
"""

ORACLE_SQL["lookup_unknown"] = f"""
WITH ce AS (SELECT customer_src_id, row_number() OVER (ORDER BY customer_src_id) AS customer_id
            FROM (SELECT DISTINCT CAST(o_custkey AS VARCHAR) AS customer_src_id FROM orders
                  WHERE o_orderdate < {CUTOFF}))
SELECT o_orderkey, coalesce(ce.customer_id, -1) AS customer_id
FROM orders LEFT JOIN ce ON CAST(o_custkey AS VARCHAR) = ce.customer_src_id
"""

ORACLE_SQL["lateral_top1"] = f"""
WITH feed AS ({FEED}), {PRODUCT_MAP},
     one AS (SELECT product_src_id, product_id FROM (
               SELECT *, row_number() OVER (PARTITION BY product_src_id ORDER BY source_system, hash_value) AS rn
               FROM pmap) WHERE rn = 1)
SELECT transaction_id, event_dt, feed.product_id, coalesce(one.product_id, -1) AS map_product_id
FROM feed LEFT JOIN one ON {STD('feed.product_id')} = one.product_src_id
"""

ORACLE_SQL["upsert_insert"] = f"WITH {CUSTOMERS} SELECT * FROM ins"
ORACLE_SQL["upsert_update"] = f"WITH {CUSTOMERS} SELECT * FROM upd"
ORACLE_SQL["upsert_counts"] = f"WITH {CUSTOMERS} SELECT * FROM cust_counts"

ORACLE_SQL["scd2_history"] = f"WITH {versions('v', 'TRUE')} SELECT * FROM v"

ORACLE_SQL["point_in_time_join"] = f"WITH {PIT}"
ORACLE_SQL["point_in_time_join_bucketed"] = f"WITH {PIT}"

ORACLE_SQL["dim_products"] = f"WITH {PRODUCTS} SELECT * FROM dprod"
ORACLE_SQL["dim_locations"] = f"WITH {LOCATIONS} SELECT * FROM dloc"
ORACLE_SQL["dim_payment_details"] = f"WITH feed AS ({FEED}), {PAYMENTS} SELECT * FROM dpay"

ORACLE_SQL["dim_dates"] = f"""
WITH b AS (SELECT min(CAST(o_orderdate AS DATE)) AS lo, max(CAST(o_orderdate AS DATE)) AS hi FROM orders)
{calendar_from("(SELECT unnest(generate_series(lo, hi, INTERVAL 1 DAY)) AS d FROM b)")}
"""

ORACLE_SQL["fact_transform"] = f"WITH feed AS ({FEED}), {STAR}, {fact('ft', 'feed')} SELECT * FROM ft"

ORACLE_SQL["fact_merge"] = f"WITH feed AS ({FEED}), {MERGED} SELECT * FROM merged"

ORACLE_SQL["rolling_window"] = f"""
WITH feed AS ({FEED}), {MERGED},
     pm AS (SELECT month_id, count(*) AS n_rows, max(date_id) AS mx FROM merged GROUP BY 1),
     g AS (SELECT max(mx) AS gmax FROM pm)
SELECT month_id, CAST(strptime(CAST(month_id AS VARCHAR) || '01', '%Y%m%d') AS DATE) AS month_start, n_rows,
       CAST(strptime(CAST(month_id AS VARCHAR) || '01', '%Y%m%d') AS DATE) >= (SELECT gmax FROM g) - INTERVAL 3 MONTH
         AS is_active
FROM pm
"""

ORACLE_SQL["audit_counts"] = f"""
WITH feed AS ({FEED}), {STAGED}, {CUSTOMERS}
SELECT 'SP_SA_LOAD_SRC_RETAIL_SALES#1' AS procedure_name,
       (SELECT count(*) FROM feedx WHERE event_dt < {CUTOFF}) AS rows_processed,
       (SELECT count(*) FROM s1) AS rows_inserted, CAST(0 AS BIGINT) AS rows_updated
UNION ALL
SELECT 'SP_SA_LOAD_SRC_RETAIL_SALES#2', (SELECT count(*) FROM feedx), (SELECT count(*) FROM s2), 0
UNION ALL
SELECT 'SP_3NF_LOAD_CE_CUSTOMERS', rows_processed, rows_inserted, rows_updated FROM cust_counts
"""

ORACLE_SQL["dq_unique"] = f"""
WITH feed AS ({FEED})
SELECT transaction_id, count(*) AS n_rows FROM feed GROUP BY 1 HAVING count(*) > 1
"""

ORACLE_SQL["dq_fk"] = f"""
WITH feed AS ({FEED}), ch AS ({channel_sales('feed')})
SELECT CAST(event_dt AS DATE) AS date_id, count(*) AS n_rows FROM ch
WHERE CAST(event_dt AS DATE) NOT BETWEEN DATE '1995-01-01' AND DATE '2000-12-31'
GROUP BY 1
"""

ORACLE_SQL["dq_scd"] = f"""
WITH {versions('v', 'TRUE')},
     f AS (SELECT employee_src_id,
                  CASE WHEN lead(start_dt) OVER (PARTITION BY employee_src_id ORDER BY start_dt) <= end_dt
                       THEN 1 ELSE 0 END AS ov,
                  CAST(is_active AS BIGINT) AS act, CASE WHEN end_dt < start_dt THEN 1 ELSE 0 END AS inv FROM v)
SELECT employee_src_id, count(*) AS n_versions, CAST(sum(act) AS BIGINT) AS n_active,
       CAST(sum(ov) AS BIGINT) AS n_overlaps, CAST(sum(inv) AS BIGINT) AS n_inverted
FROM f GROUP BY 1
"""

ORACLE_SQL["prep_conform_first"] = """
WITH f AS (SELECT o_custkey, arg_min(o_orderpriority, o_orderkey) FILTER (WHERE o_orderpriority IS NOT NULL) AS p
           FROM orders GROUP BY 1)
SELECT o.o_orderkey, o.o_custkey, f.p AS o_orderpriority FROM orders o LEFT JOIN f ON o.o_custkey = f.o_custkey
"""

ORACLE_SQL["prep_pick_by_hash"] = f"""
WITH l AS (SELECT p_type, list_sort(list(DISTINCT p_brand)) AS ch FROM part GROUP BY 1)
SELECT p.p_partkey, p.p_type,
       CASE WHEN len(l.ch) > 0 THEN l.ch[{MD5IDX('len(l.ch)', 'p.p_partkey')} + 1] END AS picked_subcategory
FROM part p LEFT JOIN l ON p.p_type = l.p_type
"""

ORACLE_SQL["prep_interval_assign"] = f"""
WITH nr AS (SELECT n_nationkey, n_name AS city, r_name AS country FROM nation JOIN region ON n_regionkey = r_regionkey),
     sales AS (SELECT concat_ws('|', CAST(l_orderkey AS VARCHAR), CAST(l_linenumber AS VARCHAR)) AS transaction_id,
                      l_shipdate AS ts, country, city, 'N/A' AS address, {PERIOD('l_shipdate')} AS period_no
               FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
               JOIN nr ON c_nationkey = n_nationkey),
     active AS (SELECT DISTINCT l_suppkey, {PERIOD('l_shipdate')} AS period_no FROM lineitem),
     roster AS (SELECT s_suppkey AS employee_id, country, city, 'N/A' AS address, period_no
                FROM supplier JOIN nr ON s_nationkey = n_nationkey JOIN active ON s_suppkey = l_suppkey),
     c1 AS (SELECT *, row_number() OVER (PARTITION BY country, city, address, period_no ORDER BY employee_id) - 1 AS n1
            FROM roster),
     s1 AS (SELECT country, city, address, period_no, count(*) AS size1 FROM roster GROUP BY ALL),
     r2 AS (SELECT DISTINCT employee_id, country, city FROM roster),
     c2 AS (SELECT *, row_number() OVER (PARTITION BY country, city ORDER BY employee_id) - 1 AS n2 FROM r2),
     s2 AS (SELECT country, city, count(*) AS size2 FROM r2 GROUP BY ALL),
     x AS (SELECT sales.*, {MD5IDX('s1.size1', 'sales.transaction_id', 42)} AS n1,
                  {MD5IDX('s2.size2', 'sales.transaction_id', 43)} AS n2
           FROM sales LEFT JOIN s1 ON sales.country = s1.country AND sales.city = s1.city
                                  AND sales.address = s1.address AND sales.period_no = s1.period_no
                      LEFT JOIN s2 ON sales.country = s2.country AND sales.city = s2.city)
SELECT x.transaction_id, x.ts, x.city, coalesce(c1.employee_id, c2.employee_id) AS employee_id
FROM x LEFT JOIN c1 ON x.country = c1.country AND x.city = c1.city AND x.address = c1.address
                   AND x.period_no = c1.period_no AND x.n1 = c1.n1
       LEFT JOIN c2 ON x.country = c2.country AND x.city = c2.city AND x.n2 = c2.n2
"""

ORACLE_SQL["prep_split"] = f"""
WITH feed AS ({FEED}),
     r AS (SELECT transaction_id, hash_value,
                  row_number() OVER (ORDER BY md5('42|' || concat_ws('|', transaction_id, hash_value)),
                                              concat_ws('|', transaction_id, hash_value)) AS rn,
                  count(*) OVER () AS n FROM feed)
SELECT transaction_id, hash_value, CASE WHEN rn <= n // 2 THEN 'ONLINE' ELSE 'OFFLINE' END AS channel FROM r
"""

ORACLE_SQL["mart_employee_location"] = f"""
WITH feed AS ({FEED}), {STAR}, {fact('ft', 'feed')},
     b AS (SELECT min(CAST(l_shipdate AS DATE)) AS lo, max(CAST(l_shipdate AS DATE)) AS hi FROM lineitem),
     cal AS ({calendar_from("(SELECT unnest(generate_series(lo, hi, INTERVAL 1 DAY)) AS d FROM b)")})
SELECT l.country_name, cal.year_value, count(DISTINCT ft.employee_surr_id) AS n_employee_versions,
       count(*) AS n_sales, CAST(sum(ft.total_amount) AS DECIMAL(18,2)) AS sum_amount
FROM ft LEFT JOIN demp e ON ft.employee_surr_id = e.employee_surr_id
        LEFT JOIN dloc l ON ft.location_surr_id = l.location_surr_id
        LEFT JOIN cal ON ft.date_id = cal.date_id
GROUP BY 1, 2
"""

ORACLE_SQL["mart_rollup_geo"] = f"""
WITH li AS ({LATEST_LINEITEM})
SELECT r_name AS region_name, n_name AS nation_name,
       CAST(sum(CAST(l_extendedprice AS DECIMAL(12,2))) AS DECIMAL(18,2)) AS sum_amount, count(*) AS n_lines,
       CAST(GROUPING(r_name, n_name) AS BIGINT) AS grouping_level
FROM li JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey
        JOIN region ON n_regionkey = r_regionkey
GROUP BY ROLLUP (r_name, n_name)
"""

ORACLE_SQL["mart_time_of_day"] = f"""
WITH b AS (SELECT min(CAST(ts AS DATE)) AS lo, max(CAST(ts AS DATE)) AS hi FROM events),
     cal AS ({calendar_from("(SELECT unnest(generate_series(lo, hi, INTERVAL 1 DAY)) AS d FROM b)")}),
     tm AS ({TIMES})
SELECT tm.time_of_day, tm.working_hours_flag, cal.weekend_flag, count(*) AS n_sales,
       CAST(sum(CAST(e.value AS DECIMAL(12,2))) AS DECIMAL(18,2)) AS sum_amount
FROM events e JOIN tm ON CAST(hour(e.ts) * 60 + minute(e.ts) AS SMALLINT) = tm.time_id
              JOIN cal ON CAST(e.ts AS DATE) = cal.date_id
GROUP BY 1, 2, 3
"""

ORACLE_SQL["mart_assignment_history"] = f"""
WITH {versions('v', 'TRUE')}
SELECT * FROM v WHERE start_dt <= TIMESTAMP '2024-01-15 12:00:00' AND TIMESTAMP '2024-01-15 12:00:00' <= end_dt
"""

ORACLE_SQL["dim_times"] = f"""
WITH tm AS ({TIMES})
SELECT tm.*, (SELECT count(*) FROM events e WHERE CAST(hour(e.ts) * 60 + minute(e.ts) AS SMALLINT) = tm.time_id) AS n_events
FROM tm
"""

_NN_COLS = ["sale_src_id", "event_dt", "customer_id", "product_id", "employee_id", "quantity", "price", "discount",
            "total_amount"]
ORACLE_SQL["dq_not_null"] = f"""
WITH feed AS ({FEED}), ch AS ({channel_sales('feed')}),
     c AS (SELECT {', '.join(f"CAST(sum(CASE WHEN {c} IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS {c}" for c in _NN_COLS)} FROM ch)
SELECT column_name, n_nulls FROM (
  {' UNION ALL '.join(f"SELECT '{c}' AS column_name, {c} AS n_nulls FROM c" for c in _NN_COLS)})
"""

_LEN = {"customer_id": 3, "product_id": 3, "employee_id": 3, "sale_src_id": 255}
ORACLE_SQL["dq_max_length"] = f"""
WITH feed AS ({FEED}), ch AS ({channel_sales('feed')}),
     c AS (SELECT {', '.join(f"CAST(sum(CASE WHEN length({c}) > {n} THEN 1 ELSE 0 END) AS BIGINT) AS {c}" for c, n in _LEN.items())} FROM ch)
SELECT column_name, n_too_long FROM (
  {' UNION ALL '.join(f"SELECT '{c}' AS column_name, {c} AS n_too_long FROM c" for c in _LEN)})
WHERE n_too_long > 0
"""

ORACLE_SQL["mart_cube_product"] = f"""
WITH li AS ({LATEST_LINEITEM})
SELECT p_type AS product_category, p_brand AS product_brand, o_orderstatus AS order_status,
       CAST(sum(CAST(l_extendedprice AS DECIMAL(12,2))) AS DECIMAL(18,2)) AS sum_amount, count(*) AS n_lines,
       CAST(GROUPING(p_type, p_brand, o_orderstatus) AS BIGINT) AS grouping_level
FROM li JOIN part ON l_partkey = p_partkey JOIN orders ON l_orderkey = o_orderkey
GROUP BY CUBE (p_type, p_brand, o_orderstatus)
"""


# ---- preparation operators on the driver tables -----------------------------------------------

def PICK(choices, key: str, seed: int = 42) -> str:
    items = ", ".join("'" + c.replace("'", "''") + "'" for c in choices)
    return f"[{items}][{MD5IDX(str(len(choices)), key, seed)} + 1]"


def _level(name: str, parent: str, child: str) -> str:
    return (f"{name} AS (SELECT {parent} AS p, list_sort(list(DISTINCT {child})) AS l FROM locs GROUP BY 1)")


def _at(l: str, seed: int) -> str:
    return f"{l}.l[{MD5IDX(f'len({l}.l)', 'c_custkey', seed)} + 1]"


ORACLE_SQL["prep_locations"] = f"""
WITH nr AS (SELECT * FROM nation JOIN region ON n_regionkey = r_regionkey),
     locs AS (SELECT r_name AS region, n_name AS country, concat_ws(' ', n_name, CAST(s_suppkey % 5 AS VARCHAR)) AS city,
                     s_name AS address FROM supplier JOIN nr ON s_nationkey = n_nationkey),
     {_level('l1', 'region', 'country')}, {_level('l2', 'country', 'city')}, {_level('l3', 'city', 'address')},
     a AS (SELECT c_custkey, r_name AS region, {_at('l1', 42)} AS country
           FROM customer JOIN nr ON c_nationkey = n_nationkey LEFT JOIN l1 ON r_name = l1.p),
     b AS (SELECT a.*, {_at('l2', 43)} AS city FROM a LEFT JOIN l2 ON a.country = l2.p)
SELECT b.*, {_at('l3', 44)} AS address FROM b LEFT JOIN l3 ON b.city = l3.p
"""

ORACLE_SQL["prep_cards"] = f"""
WITH o AS (SELECT o_orderkey, CASE WHEN o_orderpriority LIKE '1%' THEN 'Credit Card' WHEN o_orderpriority LIKE '2%' THEN 'Debit Card'
                                   ELSE 'Cash' END AS payment_method FROM orders)
SELECT o.*, CASE payment_method WHEN 'Credit Card' THEN {PICK(prepare.CARD_TYPES['Credit Card'], 'o_orderkey')}
                                WHEN 'Debit Card' THEN {PICK(prepare.CARD_TYPES['Debit Card'], 'o_orderkey')} END AS card_type,
       CASE payment_method WHEN 'Credit Card' THEN {PICK(prepare.VERIFICATION_METHODS['Credit Card'], 'o_orderkey', 43)}
                           WHEN 'Debit Card' THEN {PICK(prepare.VERIFICATION_METHODS['Debit Card'], 'o_orderkey', 43)} END AS verification_method
FROM o
"""

ORACLE_SQL["prep_devices"] = f"""
WITH li AS (SELECT concat_ws('|', CAST(l_orderkey AS VARCHAR), CAST(l_linenumber AS VARCHAR)) AS transaction_id FROM lineitem)
SELECT transaction_id, {PICK(prepare.DEVICE_TYPES, 'transaction_id')} AS device_type,
       {PICK(prepare.BROWSERS, 'transaction_id', 43)} AS browser_used FROM li
"""

ORACLE_SQL["prep_names"] = f"""
WITH p AS (SELECT p_partkey, ['Books', 'Clothing', 'Electronics'][p_partkey % 3 + 1] AS product_category, p_brand, p_type FROM part)
SELECT p_partkey, product_category, lower(CASE product_category
    WHEN 'Books' THEN concat_ws(' ', 'The', {PICK(prepare.WORDS, 'p_partkey')}, {PICK(prepare.WORDS, 'p_partkey', 43)})
    WHEN 'Clothing' THEN concat_ws(' ', {PICK(prepare.COLOURS, 'p_partkey', 44)}, p_brand, {PICK(prepare.WORDS, 'p_partkey')})
    ELSE concat_ws(' ', p_type, p_brand, {PICK(prepare.WORDS, 'p_partkey')}) END) AS product_name
FROM p
"""

ORACLE_SQL["prep_emails"] = f"""
SELECT c_custkey, lower(c_mktsegment) || '.' || lower(c_name) || CAST(c_custkey AS VARCHAR) || '@'
       || {PICK(prepare.EMAIL_DOMAINS, 'c_custkey')} AS email FROM customer
"""

PERIOD_GRID = f"""o AS (SELECT CAST(CAST(o_orderdate AS DATE) AS TIMESTAMP) AS ts FROM orders),
     b AS (SELECT min(ts) AS lo, max(ts) AS hi FROM o),
     ends AS (SELECT i, CAST(last_day(CAST(lo AS DATE) + to_months(CAST(3 * i AS INTEGER))) AS TIMESTAMP) AS e, hi
              FROM b, range(1, 400) AS r(i)),
     marks AS (SELECT lo AS t FROM b UNION ALL SELECT hi FROM b UNION ALL
               SELECT e + to_days(CAST({MD5IDX('57', 'i')} - 28 AS INTEGER)) FROM ends WHERE e <= hi),
     grid AS (SELECT CAST(row_number() OVER (ORDER BY t) - 1 AS INTEGER) AS period_no, t AS period_start,
                     lead(t) OVER (ORDER BY t) AS period_end FROM marks)"""

ORACLE_SQL["prep_periods"] = f"""
WITH {PERIOD_GRID},
     per AS (SELECT o.ts, greatest((SELECT count(*) FROM marks WHERE t < o.ts) - 1, 0) AS period_no FROM (SELECT DISTINCT ts FROM o) o),
     n AS (SELECT period_no, count(*) AS n_orders FROM o JOIN per USING (ts) GROUP BY 1)
SELECT grid.*, coalesce(n_orders, 0) AS n_orders FROM grid LEFT JOIN n USING (period_no) WHERE period_end IS NOT NULL
"""

ORACLE_SQL["touched_months"] = f"""
WITH feed AS ({FEED}), {MERGED} SELECT DISTINCT month_id FROM merged WHERE update_dt = TIMESTAMP '2024-02-01 00:00:00'
"""

ORACLE_SQL["insert_absent"] = f"""
WITH known AS (SELECT DISTINCT CAST(o_custkey AS VARCHAR) AS customer_src_id FROM orders WHERE o_orderdate < {CUTOFF}),
     offered AS (SELECT CAST(c_custkey AS VARCHAR) AS customer_src_id, {NA('c_name')} AS customer_name FROM customer)
SELECT customer_src_id, CASE WHEN k.customer_src_id IS NULL THEN o.customer_name ELSE 'KNOWN' END AS customer_name,
       CASE WHEN k.customer_src_id IS NULL THEN 'insert' ELSE 'keep' END AS action
FROM offered o LEFT JOIN known k USING (customer_src_id)
"""

ORACLE_SQL["map_latest"] = f"""
WITH feed AS ({FEED}), {PRODUCT_MAP}
SELECT * EXCLUDE (rk) FROM (
  SELECT *, row_number() OVER (PARTITION BY product_id ORDER BY load_dt DESC, source_system, hash_value) AS rk FROM pmap) WHERE rk = 1
"""

ORACLE_SQL["run_log"] = f"""
SELECT TIMESTAMP '2024-02-01 00:00:00' AS execution_dt, procedure_name, 'BL_CL' AS procedure_schema,
       'LOAD PERFORMED SUCCESSFULLY' AS log_message, rows_processed, rows_inserted, rows_updated,
       'N/A' AS error_code, 'N/A' AS error_message
FROM ({ORACLE_SQL["audit_counts"]})
UNION ALL
SELECT TIMESTAMP '2024-02-01 00:00:00', 'SP_3NF_LOAD_CE_SALES', 'BL_CL', 'ERROR LOADING CE_SALES', -1, -1, -1, 'XX000',
       'FIRST LINE' || chr(10) || 'SECOND LINE'
"""


# ---- late SCD2 events: the event rule step by step ---------------------------------------------
# One row of ``fold`` per key and step: the open version (o_*), how many stored versions have been
# opened (p), and the version that this step closed for good (f_*).
ORACLE_SQL["scd2_late_merge"] = f"""
WITH RECURSIVE {versions('v', "coalesce(upper(trim(event_type)), 'N/A') <> 'PURCHASE'")},
  ids AS (SELECT k, row_number() OVER (ORDER BY k) AS employee_id FROM (SELECT DISTINCT employee_src_id AS k FROM v)),
  sv AS (SELECT employee_src_id AS k, event_type AS a, start_dt, end_dt, is_active,
                row_number() OVER (PARTITION BY employee_src_id ORDER BY start_dt) AS i FROM v),
  ev AS (SELECT DISTINCT CAST(user_id AS VARCHAR) AS k, ts AS t, 'PURCHASE' AS a FROM events WHERE {NA('event_type')} = 'PURCHASE'),
  steps AS (SELECT *, row_number() OVER (PARTITION BY k ORDER BY t, i IS NULL) AS n
            FROM (SELECT k, t, a, NULL AS i FROM ev
                  UNION ALL SELECT k, start_dt, a, i FROM sv WHERE k IN (SELECT k FROM ev))),
  todo AS (
    SELECT s.k, s.n, s.t, s.a, s.i, x.start_dt AS own_start, x.end_dt AS own_end, x.is_active AS own_active
    FROM steps s LEFT JOIN sv x ON s.k = x.k AND s.i = x.i),
  fold AS (
    SELECT k, CAST(0 AS BIGINT) AS n, CAST(0 AS BIGINT) AS p,
           CAST(NULL AS TIMESTAMP) AS o_start, CAST(NULL AS TIMESTAMP) AS o_end, CAST(NULL AS VARCHAR) AS o_a, CAST(NULL AS BOOLEAN) AS o_active,
           CAST(NULL AS TIMESTAMP) AS f_start, CAST(NULL AS TIMESTAMP) AS f_end, CAST(NULL AS VARCHAR) AS f_a, CAST(NULL AS BOOLEAN) AS f_active
    FROM (SELECT DISTINCT k FROM ev)
    UNION ALL
    SELECT k, n, p,
           CASE action WHEN 'none' THEN o_start WHEN 'replace' THEN o_start WHEN 'close' THEN NULL ELSE t END,
           CASE action WHEN 'none' THEN o_end WHEN 'replace' THEN o_end WHEN 'close' THEN NULL WHEN 'own' THEN own_end WHEN 'move' THEN x_end
                       WHEN 'insert' THEN coalesce(x_start - INTERVAL 1 MINUTE, {HIGH}) END,
           CASE action WHEN 'none' THEN o_a WHEN 'close' THEN NULL ELSE a END,
           CASE action WHEN 'none' THEN o_active WHEN 'replace' THEN o_active WHEN 'close' THEN NULL WHEN 'own' THEN own_active
                       WHEN 'move' THEN x_active WHEN 'insert' THEN x_start IS NULL END,
           CASE WHEN gives THEN o_start END, CASE WHEN gives THEN (CASE WHEN cuts THEN t - INTERVAL 1 MINUTE ELSE o_end END) END,
           CASE WHEN gives THEN o_a END, CASE WHEN gives THEN (CASE WHEN cuts THEN FALSE ELSE o_active END) END
    FROM (
      SELECT k, n, CASE action WHEN 'own' THEN i WHEN 'move' THEN p + 1 ELSE p END AS p, o_start, o_end, o_a, o_active, t, a, action,
             own_end, own_active, x_start, x_end, x_active,
             action IN ('own', 'move', 'insert', 'close') AND o_start IS NOT NULL AS gives,
             i IS NULL AND covered AS cuts
      FROM (
        SELECT *, CASE
            WHEN i IS NOT NULL THEN CASE WHEN i <= p THEN 'none' ELSE 'own' END
            WHEN o_start IS NOT NULL AND o_start = t THEN CASE WHEN o_a <> a AND md5(a) > md5(o_a) THEN 'replace' ELSE 'none' END
            WHEN covered AND o_a = a THEN 'none'
            WHEN x_a = a THEN 'move'
            WHEN x_start - INTERVAL 1 MINUTE < t THEN CASE WHEN covered THEN 'close' ELSE 'none' END
            ELSE 'insert' END AS action
        FROM (
          SELECT f.k, d.n, f.p, f.o_start, f.o_end, f.o_a, f.o_active, d.t, d.a, d.i, d.own_end, d.own_active,
                 x.start_dt AS x_start, x.end_dt AS x_end, x.a AS x_a, x.is_active AS x_active,
                 f.o_start IS NOT NULL AND f.o_end >= d.t AS covered
          FROM fold f JOIN todo d ON d.k = f.k AND d.n = f.n + 1 LEFT JOIN sv x ON x.k = f.k AND x.i = f.p + 1))))
SELECT ids.employee_id, r.k AS employee_src_id, r.a AS event_type, r.start_dt, r.end_dt, r.is_active FROM (
  SELECT k, f_a AS a, f_start AS start_dt, f_end AS end_dt, f_active AS is_active FROM fold WHERE f_start IS NOT NULL
  UNION ALL
  SELECT k, o_a, o_start, o_end, o_active FROM (SELECT *, row_number() OVER (PARTITION BY k ORDER BY n DESC) AS r FROM fold) WHERE r = 1 AND o_start IS NOT NULL
  UNION ALL
  SELECT employee_src_id, event_type, start_dt, end_dt, is_active FROM v WHERE employee_src_id NOT IN (SELECT k FROM ev)) r
LEFT JOIN ids ON ids.k = r.k
"""


# ---- the fact store ------------------------------------------------------------------------------

LATE = "(card_type = 'R' AND event_dt >= TIMESTAMP '1997-01-01' AND event_dt < TIMESTAMP '1997-04-01')"
FACT_COMPARE = ["quantity", "price", "cost", "discount", "total_amount"]


def bare_fact(name: str, feed: str) -> str:
    """Fact rows without dimension keys."""
    return f"""
  {name}_ch AS ({channel_sales(feed)}),
  {name} AS (SELECT sale_src_id, CAST(event_dt AS DATE) AS date_id, CAST(hour(event_dt) * 60 + minute(event_dt) AS SMALLINT) AS time_id,
                    quantity, price, CAST(quantity * price AS DECIMAL(10,2)) AS cost, discount, total_amount, 'BL_3NF' AS source_system,
                    CAST(year(event_dt) * 100 + month(event_dt) AS INTEGER) AS month_id FROM {name}_ch)"""


TWO_BATCH_FACT = f"""
  {bare_fact('fa', f"(SELECT * FROM feed WHERE NOT coalesce({LATE}, FALSE))").strip()},
  {bare_fact('fb', f"(SELECT * FROM feed WHERE {LATE})").strip()},
  f1 AS (SELECT row_number() OVER (ORDER BY sale_src_id) AS sale_surr_id, * FROM fa),
  chg AS (SELECT f1.sale_src_id FROM f1 JOIN fb ON f1.sale_src_id = fb.sale_src_id
          WHERE {' OR '.join(f'f1.{c} <> fb.{c}' for c in FACT_COMPARE)}),
  stored AS (
    SELECT f1.sale_surr_id, f1.sale_src_id, f1.date_id, f1.time_id,
           {', '.join(f'CASE WHEN chg.sale_src_id IS NULL THEN f1.{c} ELSE fb.{c} END AS {c}' for c in FACT_COMPARE)},
           f1.source_system, {B1} AS insert_dt, CASE WHEN chg.sale_src_id IS NULL THEN {B1} ELSE {B2} END AS update_dt, f1.month_id
    FROM f1 LEFT JOIN chg ON f1.sale_src_id = chg.sale_src_id LEFT JOIN fb ON chg.sale_src_id = fb.sale_src_id
    UNION ALL
    SELECT (SELECT coalesce(max(sale_surr_id), 0) FROM f1) + row_number() OVER (ORDER BY sale_src_id), sale_src_id, date_id, time_id,
           {', '.join(FACT_COMPARE)}, source_system, {B2}, {B2}, month_id
    FROM fb WHERE NOT EXISTS (SELECT 1 FROM f1 WHERE f1.sale_src_id = fb.sale_src_id))
"""

ORACLE_SQL["fact_store"] = f"WITH feed AS ({FEED}), {TWO_BATCH_FACT} SELECT * FROM stored"

MONTH_START = "CAST(strptime(CAST(month_id AS VARCHAR) || '01', '%Y%m%d') AS DATE)"
ORACLE_SQL["month_lifecycle"] = f"""
WITH feed AS ({FEED}), {TWO_BATCH_FACT},
     top AS (SELECT max(CAST(event_dt AS DATE)) AS d FROM feed),
     late AS (SELECT DISTINCT month_id FROM fb)
SELECT month_id, n_rows, CASE WHEN active THEN 'ACTIVE' ELSE 'ARCHIVED' END AS state,
       CASE WHEN NOT active AND month_id IN (SELECT month_id FROM late) AND month_id IN (SELECT month_id FROM fa) THEN {B2} END AS returned_at
FROM (SELECT month_id, count(*) AS n_rows, {MONTH_START} >= (SELECT d FROM top) - INTERVAL 3 MONTH AS active FROM stored GROUP BY month_id)
"""

ORACLE_SQL["stage_parts"] = f"""
WITH feed AS ({FEED}),
     seen AS (SELECT hash_value, transaction_id, event_dt,
                     CASE WHEN event_dt < TIMESTAMP '1997-01-01' THEN 1 WHEN event_dt < TIMESTAMP '1999-01-01' THEN 2 ELSE 3 END AS load_no
              FROM feed)
SELECT hash_value, transaction_id, event_dt, load_no FROM (
  SELECT *, row_number() OVER (PARTITION BY hash_value ORDER BY load_no, event_dt) AS rn FROM seen)
WHERE rn = 1
"""

# ---- the roster -----------------------------------------------------------------------------------

ORACLE_SQL["prep_roster"] = f"""
WITH {PERIOD_GRID},
     addr AS (SELECT nation, address, row_number() OVER (PARTITION BY nation ORDER BY address) - 1 AS no, count(*) OVER (PARTITION BY nation) AS n
              FROM (SELECT DISTINCT s_nationkey AS nation, s_name AS address FROM supplier)),
     sizes AS (SELECT DISTINCT nation, n FROM addr),
     drawn AS (SELECT s_suppkey AS employee_id, s_nationkey AS nation, period_no, period_start, period_end,
                      {MD5IDX('n', "s_suppkey || '|' || period_no")} AS k
               FROM supplier CROSS JOIN (SELECT * FROM grid WHERE period_end IS NOT NULL) JOIN sizes ON nation = s_nationkey)
SELECT d.employee_id, d.period_no, d.period_start, d.period_end, a.address, count(*) OVER (PARTITION BY d.employee_id) AS n_periods,
       count(*) OVER (PARTITION BY d.employee_id) - 1 AS n_shared_bounds, CAST(0 AS BIGINT) AS n_broken
FROM drawn d JOIN addr a ON a.nation = d.nation AND a.no = d.k
"""


# ---- whole loads -----------------------------------------------------------------------------------

_COLUMNS = {
    "transaction_id": "l_orderkey || '-' || l_linenumber",
    "customer_id": "CASE WHEN o_custkey % 50 <> 0 THEN 'c' || o_custkey END",
    "customer_first_name": "c_mktsegment", "customer_last_name": "c_name",
    "customer_email": "CASE WHEN o_custkey % 7 <> 0 THEN 'c' || o_custkey || '@example.org' END",
    "customer_age": "CAST(18 + o_custkey % 60 AS VARCHAR)",
    "customer_gender": "CASE WHEN o_custkey % 2 = 0 THEN 'Female' ELSE 'Male' END",
    "product_id": "'p' || l_partkey", "product_name": "p_name", "price": "CAST(CAST(l_extendedprice AS DECIMAL(10,2)) AS VARCHAR)",
    "product_manufacturer": "p_brand", "product_category": "p_type", "product_subcategory": "'size ' || p_size",
    "purchase_region": "r_name", "purchase_country": "n_name", "purchase_city": "'city ' || (s_suppkey % 5)", "purchase_address": "s_name",
    "employee_id": "'e' || l_suppkey", "employee_first_name": "'Emp'", "employee_last_name": "CAST(l_suppkey AS VARCHAR)",
    "employee_email": "CAST(NULL AS VARCHAR)",
    "quantity": "CAST(CAST(l_quantity AS INTEGER) AS VARCHAR)", "discount": "CAST(CAST(l_discount AS DECIMAL(3,2)) AS VARCHAR)",
    "total_amount": "CAST(CAST(CAST(l_extendedprice AS DECIMAL(10,2)) * (1 - CAST(l_discount AS DECIMAL(3,2))) AS DECIMAL(10,2)) AS VARCHAR)",
    "payment_method": "' ' || o_orderpriority", "card_type": "CASE WHEN l_returnflag <> 'N' THEN l_returnflag END",
    "verification_method": "l_linestatus", "device_type": "CASE WHEN p_size % 5 <> 0 THEN 'Phone' END",
    "browser_used": "CASE WHEN l_linenumber % 3 <> 0 THEN 'browser ' || l_linenumber END",
}


def _hashed(columns) -> str:
    return "concat_ws('|', " + ", ".join(c for c in columns if c != "timestamp") + ")"


LOADS = f"""
  raw AS (
    SELECT {', '.join(f'{e} AS {c}' for c, e in _COLUMNS.items())},
           l_shipdate + to_minutes(CAST(l_partkey % 1440 AS INTEGER)) AS ts, l_orderkey % 2 = 0 AS online, l_shipdate < {CUTOFF} AS first
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey JOIN customer ON o_custkey = c_custkey
    JOIN supplier ON s_suppkey = (l_suppkey * 3 + year(l_shipdate)) % (SELECT count(*) FROM supplier)
    JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey),
  marked AS (SELECT *, CASE WHEN online THEN {_hashed(ONLINE_COLUMNS)} ELSE {_hashed(OFFLINE_COLUMNS)} END AS fp FROM raw),
  s1 AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY online, fp ORDER BY ts) AS r FROM marked WHERE first) WHERE r = 1),
  s2 AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY online, fp ORDER BY ts) AS r FROM marked m
                        WHERE NOT EXISTS (SELECT 1 FROM s1 WHERE s1.online = m.online AND s1.fp = m.fp)) WHERE r = 1),
  src AS (SELECT *, 1 AS batch FROM s1 UNION ALL SELECT *, 2 FROM s2),
  moves AS (SELECT upper(trim(employee_id)) AS k, ts, purchase_address AS a, * FROM src WHERE NOT online),
  turns AS (SELECT *, lag(a) OVER (PARTITION BY k ORDER BY ts) AS pa FROM (SELECT DISTINCT k, ts, a, {', '.join(
      f"upper(trim({c})) AS {n}" for c, n in (("purchase_address", "address_name"), ("purchase_city", "city_name"),
                                              ("purchase_country", "country_name"), ("purchase_region", "region_name")))}, batch FROM moves)),
  emp AS (SELECT k, ts AS start_dt, address_name, city_name, country_name, region_name, batch,
                 coalesce(lead(ts) OVER (PARTITION BY k ORDER BY ts) - INTERVAL 1 MINUTE, {HIGH}) AS end_dt
          FROM turns WHERE pa IS NULL OR pa <> a),
  sales AS (
    SELECT batch, upper(trim(transaction_id)) AS transaction_id, ts, {', '.join(f'{e} AS {c}' for c, e in {
        "customer": f"CASE WHEN online THEN {NA('customer_id')} ELSE 'N/A' END", "product": NA("product_id"),
        "employee": f"CASE WHEN online THEN 'N/A' ELSE {NA('employee_id')} END",
        "payment_method_name": NA("payment_method"), "card_type_name": NA("card_type"), "verification_method": NA("verification_method"),
        "device_type": f"CASE WHEN online AND device_type IS NOT NULL AND browser_used IS NOT NULL THEN {NA('device_type')} ELSE 'N/A' END",
        "browser_used": f"CASE WHEN online AND device_type IS NOT NULL AND browser_used IS NOT NULL THEN {NA('browser_used')} ELSE 'N/A' END",
        "quantity": "CAST(quantity AS SMALLINT)", "price": "CAST(price AS DECIMAL(10,2))", "discount": "CAST(discount AS DECIMAL(3,2))",
        "total_amount": "CAST(total_amount AS DECIMAL(10,2))"}.items())}
    FROM (SELECT *, row_number() OVER (PARTITION BY batch, online, upper(trim(transaction_id)) ORDER BY ts DESC, md5(fp) DESC) AS r2 FROM src)
    WHERE r2 = 1)
"""
_VALUES = ["customer", "product", "employee", "payment_method_name", "card_type_name", "verification_method", "device_type", "browser_used",
           "quantity", "price", "discount", "total_amount"]

ORACLE_SQL["warehouse_run"] = f"""
WITH {LOADS},
  b1 AS (SELECT * FROM sales WHERE batch = 1), b2 AS (SELECT * FROM sales WHERE batch = 2),
  stored AS (
    SELECT b1.transaction_id, b1.ts, changed, {', '.join(f'CASE WHEN changed THEN b2.{c} ELSE b1.{c} END AS {c}' for c in _VALUES)},
           {B1} AS insert_dt, CASE WHEN changed THEN {B2} ELSE {B1} END AS update_dt
    FROM (SELECT b1.transaction_id, coalesce({' OR '.join(f'b1.{c} <> b2.{c}' for c in _VALUES)}, FALSE) AS changed
          FROM b1 LEFT JOIN b2 USING (transaction_id)) c
    JOIN b1 USING (transaction_id) LEFT JOIN b2 USING (transaction_id)
    UNION ALL
    SELECT transaction_id, ts, FALSE, {', '.join(_VALUES)}, {B2}, {B2} FROM b2
    WHERE NOT EXISTS (SELECT 1 FROM b1 WHERE b1.transaction_id = b2.transaction_id)),
  facts AS (SELECT *, CAST(ts AS DATE) AS date_id, CAST(year(ts) * 100 + month(ts) AS INTEGER) AS month_id FROM stored),
  goods AS (SELECT DISTINCT {NA('product_id')} AS product, {NA('product_subcategory')} AS product_subcategory_name,
                   {NA('product_category')} AS product_category_name FROM raw),
  buyers AS (SELECT DISTINCT {NA('customer_id')} AS customer, CAST(customer_age AS SMALLINT) AS age FROM raw WHERE customer_id IS NOT NULL)
SELECT f.transaction_id, f.date_id, CAST(hour(f.ts) * 60 + minute(f.ts) AS SMALLINT) AS time_id, f.customer, f.product,
       g.product_subcategory_name, g.product_category_name, CASE WHEN e.k IS NULL THEN 'N/A' ELSE f.employee END AS employee,
       {', '.join(f"coalesce(e.{c}, 'N/A') AS {c}" for c in ('address_name', 'city_name', 'country_name', 'region_name'))},
       f.payment_method_name, f.card_type_name,
       CASE WHEN f.card_type_name = 'N/A' THEN 'N/A' ELSE f.verification_method END AS verification_method,  -- of the unknown card type
       f.device_type, f.browser_used,
       CAST(coalesce(b.age, -1) AS SMALLINT) AS customer_age, coalesce(e.start_dt, {LOW}) AS start_dt, coalesce(e.end_dt, {HIGH}) AS end_dt,
       f.quantity, f.price, CAST(f.quantity * f.price AS DECIMAL(10,2)) AS cost, f.discount, f.total_amount, f.insert_dt, f.update_dt, f.month_id,
       CASE WHEN {MONTH_START} >= (SELECT max(date_id) FROM facts) - INTERVAL 3 MONTH THEN 'ACTIVE' ELSE 'ARCHIVED' END AS state
FROM facts f LEFT JOIN emp e ON f.employee = e.k AND f.ts BETWEEN e.start_dt AND e.end_dt
LEFT JOIN goods g ON g.product = f.product LEFT JOIN buyers b ON b.customer = f.customer
"""

_STEP_COUNTS = {  # step -> SQL of its rows in the first load (all of them are inserted)
    "SP_SA_ONLINE_LOAD_SRC_ONLINE_RETAIL_SALES": "SELECT count(*) FROM marked WHERE first AND online",
    "SP_SA_OFFLINE_LOAD_SRC_OFFLINE_RETAIL_SALES": "SELECT count(*) FROM marked WHERE first AND NOT online",
}


def _distinct(*columns: str, rows: str = "s1", where: str = "TRUE") -> str:
    return f"SELECT count(*) FROM (SELECT DISTINCT {', '.join(columns)} FROM {rows} WHERE {where})"


for _step, _columns, _where in (
        ("T_MAP_PRODUCT_CATEGORIES", ("product_category",), "TRUE"),
        ("T_MAP_PRODUCT_SUBCATEGORIES", ("product_subcategory", "product_category"), "TRUE"), ("T_MAP_PRODUCTS", ("product_id",), "TRUE"),
        ("T_MAP_PAYMENT_METHODS", ("payment_method",), "TRUE"),
        ("T_MAP_CARD_TYPES", ("card_type", "verification_method"), "card_type IS NOT NULL"),
        ("T_MAP_PAYMENT_DETAILS", ("payment_method", "card_type", "verification_method"), "TRUE")):
    _STEP_COUNTS[f"SP_CL_LOAD_{_step}"] = _distinct("online", *_columns, where=_where)
    _STEP_COUNTS[f"SP_3NF_LOAD_{_step.replace('T_MAP', 'CE')}"] = _distinct(*_columns, where=_where)
for _name, _columns, _where in (
        ("CUSTOMERS", ("customer_id",), "online AND customer_id IS NOT NULL"), ("REGIONS", ("purchase_region",), "NOT online"),
        ("COUNTRIES", ("purchase_country",), "NOT online"), ("CITIES", ("purchase_city", "purchase_country"), "NOT online"),
        ("ADDRESSES", ("purchase_address", "purchase_city", "purchase_country"), "NOT online"),
        ("DEVICES", ("concat_ws('|', device_type, browser_used)",), "online AND coalesce(device_type, browser_used) IS NOT NULL")):
    _STEP_COUNTS[f"SP_3NF_LOAD_CE_{_name}"] = _distinct(*_columns, where=_where)
for _dim, _entity in (("CUSTOMERS", "CUSTOMERS"), ("PRODUCTS", "PRODUCTS"), ("LOCATIONS", "ADDRESSES"), ("PAYMENT_DETAILS", "PAYMENT_DETAILS"), ("DEVICES", "DEVICES")):
    _STEP_COUNTS[f"SP_DM_LOAD_DIM_{_dim}"] = _STEP_COUNTS[f"SP_3NF_LOAD_CE_{_entity}"]
_VERSIONS1 = f"""SELECT count(*) FROM (SELECT a, lag(a) OVER (PARTITION BY k ORDER BY ts) AS pa FROM (SELECT DISTINCT k, ts, a FROM moves WHERE batch = 1)) WHERE pa IS NULL OR pa <> a"""
_STEP_COUNTS["SP_DM_LOAD_DIM_EMPLOYEES_SCD"] = _VERSIONS1
_STEP_COUNTS["SP_DM_LOAD_DIM_DATES"] = "SELECT date_diff('day', DATE '1995-01-01', DATE '2001-12-31') + 1"
_STEP_COUNTS["SP_DM_LOAD_DIM_TIMES"] = "SELECT 1440"
_STEP_COUNTS["SP_3NF_LOAD_CE_SALES"] = _STEP_COUNTS["SP_DM_LOAD_FCT_SALES"] = "SELECT count(*) FROM sales WHERE batch = 1"
_INSERTED = {
    "SP_SA_ONLINE_LOAD_SRC_ONLINE_RETAIL_SALES": "SELECT count(*) FROM s1 WHERE online",
    "SP_SA_OFFLINE_LOAD_SRC_OFFLINE_RETAIL_SALES": "SELECT count(*) FROM s1 WHERE NOT online",
    "SP_3NF_LOAD_CE_EMPLOYEES_SCD": _VERSIONS1,
}
_STEP_COUNTS["SP_3NF_LOAD_CE_EMPLOYEES_SCD"] = "SELECT count(*) FROM s1 WHERE NOT online"
_DEFAULTS = [f"SP_3NF_LOAD_CE_{x}_DEFAULT" for x in ("CUSTOMERS", "PRODUCT_CATEGORIES", "PRODUCT_SUBCATEGORIES", "PRODUCTS", "REGIONS", "COUNTRIES", "CITIES",
                                                    "ADDRESSES", "EMPLOYEES_SCD", "PAYMENT_METHODS", "CARD_TYPES", "PAYMENT_DETAILS", "DEVICES")]
_DEFAULTS += [f"SP_DM_LOAD_DIM_{x}_DEFAULT" for x in ("CUSTOMERS", "PRODUCTS", "LOCATIONS", "EMPLOYEES_SCD", "PAYMENT_DETAILS", "DEVICES")]
_OK = f"{B1} AS execution_dt, '{{}}' AS procedure_name, 'LOAD PERFORMED SUCCESSFULLY' AS log_message"
ORACLE_SQL["warehouse_resume"] = f"WITH {LOADS}\n" + "\nUNION ALL ".join(
    [f"SELECT {_OK.format(s)}, CAST(({n}) AS BIGINT) AS rows_processed, CAST(({_INSERTED.get(s, n)}) AS BIGINT) AS rows_inserted, "
     "CAST(0 AS BIGINT) AS rows_updated, 'N/A' AS error_code, 'N/A' AS error_message" for s, n in _STEP_COUNTS.items()]
    + [f"SELECT {_OK.format(s)}, 1, 1, 0, 'N/A', 'N/A'" for s in _DEFAULTS]
    + [f"SELECT {B1}, 'SP_3NF_LOAD_CE_SALES', 'ERROR LOADING CE_SALES', -1, -1, -1, 'XX000', 'LOST CONNECTION'"])


def _listed(values) -> str:
    return "[" + ", ".join("'" + v.replace("'", "''") + "'" for v in sorted(values)) + "]"


ORACLE_SQL["prep_files"] = f"""
WITH raw AS (
  SELECT o_orderkey, CAST(o_orderkey AS VARCHAR) AS transaction_id, strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS "timestamp",
         'C' || o_custkey AS customer_id, CAST(20 + o_orderkey % 50 AS VARCHAR) AS age, CASE WHEN o_orderkey % 3 = 0 THEN 'Female' ELSE 'Male' END AS gender,
         {_listed(prepare.REGION_COUNTRIES)}[n_regionkey % {len(prepare.REGION_COUNTRIES)} + 1] AS region, 'P' || (o_orderkey % 311) AS product_id,
         {_listed(prepare.CATEGORY_SUBCATEGORIES)}[o_orderkey % 13 % {len(prepare.CATEGORY_SUBCATEGORIES)} + 1] AS category,
         CAST(CAST(o_totalprice AS DECIMAL(12,2)) AS VARCHAR) AS price, CAST(o_orderkey % 9 + 1 AS VARCHAR) AS quantity, '0.1' AS discount,
         CASE WHEN o_orderpriority LIKE '1%' THEN 'Credit Card' ELSE 'Cash' END AS payment_method
  FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey),
  people AS (SELECT customer_id, arg_min(age, o_orderkey) AS age, arg_min(gender, o_orderkey) AS gender FROM raw GROUP BY 1),
  goods AS (SELECT product_id, arg_min(category, o_orderkey) AS category FROM raw GROUP BY 1),
  placed AS (SELECT *, row_number() OVER (ORDER BY md5('42|' || transaction_id), transaction_id) <= count(*) OVER () // 2 AS online FROM raw)
SELECT transaction_id, CASE WHEN online THEN 'ONLINE' ELSE 'OFFLINE' END AS channel,
       CASE WHEN online THEN '{",".join(ONLINE_COLUMNS)}' ELSE '{",".join(OFFLINE_COLUMNS)}' END AS header, "timestamp", product_id, g.category AS product_category,
       price, quantity, discount, price AS total_amount, payment_method, CASE WHEN online THEN customer_id END AS customer_id,
       CASE WHEN online THEN p.age END AS customer_age, CASE WHEN online THEN p.gender END AS customer_gender, CASE WHEN NOT online THEN region END AS purchase_region,
       payment_method = 'Credit Card' AS has_card, CAST(CASE WHEN online THEN 8 ELSE 10 END AS INTEGER) AS n_filled
FROM placed JOIN people p USING (customer_id) JOIN goods g USING (product_id)
"""
