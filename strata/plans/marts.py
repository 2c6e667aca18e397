"""Star-schema queries (Z1–Z5) over a fact table and its dimensions.

Dimensions with a size fixed by construction (calendar, minute of day) are broadcast
explicitly; every other join is left to the planner (AQE turns a join into a broadcast at
run time only when the measured side is below ``spark.sql.adaptive.autoBroadcastJoinThreshold``).
Aggregations are hash aggregates with a partial (map-side) step, so a hot group is
pre-aggregated in every task before the shuffle.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.functions.text import NA

MONEY = "decimal(18,2)"


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def sales_by_category_month(fact: DataFrame, products: DataFrame, dates: DataFrame, *,
                            fact_date, fact_product: str, product_key: str, category: str,
                            quantity, amount) -> DataFrame:
    """Quantity, amount and line count by year, month and product category."""
    prod = products.select(F.col(product_key).alias("_pk"),
                           F.coalesce(F.col(category), F.lit(NA)).alias("product_category"))
    f = (fact.select(_c(fact_date).alias("_d"), F.col(fact_product).alias("_fp"),
                     _c(quantity).alias("_q"), _c(amount).alias("_a"))
         .join(prod, F.col("_fp") == F.col("_pk"), "left")
         .withColumn("product_category", F.coalesce("product_category", F.lit(NA))))
    cal = F.broadcast(dates.select("date_id", "year_value", "month_value"))
    # left: a sale without a calendar day is counted under NULL year and month, not lost
    return (f.join(cal, F.col("_d") == F.col("date_id"), "left")
            .groupBy("year_value", "month_value", "product_category")
            .agg(F.sum("_q").cast(MONEY).alias("sum_quantity"),
                 F.sum("_a").cast(MONEY).alias("sum_amount"),
                 F.count(F.lit(1)).alias("n_lines")))


def rollup_totals(fact: DataFrame, levels: Sequence[str], amount, name: str = "sum_amount") -> DataFrame:
    """Z3: ``ROLLUP`` over a hierarchy (e.g. region > country > city); subtotal rows carry NULL in
    the rolled-up levels and ``grouping_level`` is the bit mask of the rolled-up levels."""
    return (fact.rollup(*levels)
            .agg(F.sum(_c(amount)).cast(MONEY).alias(name),
                 F.count(F.lit(1)).alias("n_lines"),
                 F.grouping_id().alias("grouping_level")))


def cube_totals(fact: DataFrame, dims: Sequence[str], amount, name: str = "sum_amount") -> DataFrame:
    """Z3: ``CUBE`` over independent dimensions (every combination of subtotals); ``grouping_level``
    is the bit mask of the rolled-up dimensions."""
    return (fact.cube(*dims)
            .agg(F.sum(_c(amount)).cast(MONEY).alias(name),
                 F.count(F.lit(1)).alias("n_lines"),
                 F.grouping_id().alias("grouping_level")))


def sales_by_time_of_day(fact: DataFrame, times: DataFrame, dates: DataFrame, *, ts, amount) -> DataFrame:
    """Totals by part of day, working hours and weekend."""
    f = fact.select(F.to_date(_c(ts)).alias("_d"),
                    (F.hour(_c(ts)) * 60 + F.minute(_c(ts))).cast("smallint").alias("_t"),
                    _c(amount).alias("_a"))
    tm = F.broadcast(times.select("time_id", "time_of_day", "working_hours_flag"))
    cal = F.broadcast(dates.select("date_id", "weekend_flag"))
    return (f.join(tm, F.col("_t") == F.col("time_id"), "left").join(cal, F.col("_d") == F.col("date_id"), "left")
            .groupBy("time_of_day", "working_hours_flag", "weekend_flag")
            .agg(F.count(F.lit(1)).alias("n_sales"), F.sum("_a").cast(MONEY).alias("sum_amount")))


def employee_performance(fact: DataFrame, employees: DataFrame, locations: DataFrame, dates: DataFrame, *,
                         group_cols: Sequence[str] = ("country_name", "year_value")) -> DataFrame:
    """Sales per location and year, each sale counted at the employee version valid when it
    happened (the fact already carries that version's surrogate and its location)."""
    emp = employees.select("employee_surr_id", F.col("location_id").alias("_emp_loc"))
    loc = locations.select("location_surr_id", "address_name", "city_name", "country_name")
    cal = F.broadcast(dates.select("date_id", "year_value", "month_value"))
    f = (fact.join(emp, "employee_surr_id", "left")
         .join(loc, "location_surr_id", "left")
         .join(cal, "date_id", "left"))
    return (f.groupBy(*group_cols)
            .agg(F.countDistinct("employee_surr_id").alias("n_employee_versions"),
                 F.count(F.lit(1)).alias("n_sales"),
                 F.sum("total_amount").cast(MONEY).alias("sum_amount")))


def assignments_at(versions: DataFrame, at_ts: str, *, start: str = "start_dt", end: str = "end_dt") -> DataFrame:
    """The SCD2 versions valid at an instant (closed interval, as the source compares)."""
    t = F.lit(at_ts).cast("timestamp_ntz")
    return versions.filter((F.col(start) <= t) & (t <= F.col(end)))
