"""Key integration: surrogate keys (K1), map-or-mint (K2), unknown member (K3), lookups.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strata.functions.text import fingerprint
from strata.operators.latest import first_per_key
from strata.session import stage

UNKNOWN_ID = -1
#: Business keys (as text) that a large part of all facts carry: half of them have no customer, the
#: other half no employee. They are looked up like any other key, but spread over SALTS tasks.
HOT_KEYS = ("N/A", "-1")
SALTS = 64


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def assign_keys(keys: DataFrame, order_cols: Sequence[str], id_col: str, offset: int = 0) -> DataFrame:
    """Give each row of ``keys`` (distinct natural keys) a dense id ``offset+1 .. offset+n`` in
    ``order_cols`` order — a distributed ``zipWithIndex``.

    The rows are range-partitioned, sorted and written to the shared folder once, so nothing is computed
    again or joined back; a row's id is the number of rows in the files before its own plus its row
    number there, and only one count per file passes through a single task. The ids follow the global key
    order (keys must be distinct), so they are the same on any re-run. Rows that share a key all the same
    get every id of that key, as a join on the key would give.
    """
    order = list(order_cols)
    alone = set(keys.columns) == set(order)
    ranged = keys.repartitionByRange(*order).sortWithinPartitions(*order)
    if not alone:  # equal keys lie in one partition, beside each other
        same = Window.partitionBy(*order)
        ranged = ranged.withColumn("_nth", F.row_number().over(same.orderBy(*order))).withColumn("_of", F.count(F.lit(1)).over(same))
    ranged = stage(ranged, "keys")
    number = F.regexp_extract(F.col("_metadata.file_name"), r"part-(\d+)", 1).cast("int")
    ranged = ranged.select(*ranged.columns, number.alias("_file"), F.col("_metadata.row_index").alias("_row"))
    counts = ranged.groupBy("_file").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy("_file").rowsBetween(Window.unboundedPreceding, -1)
    # One row per written file: bounded by the number of tasks that wrote them, safe to broadcast.
    bases = counts.select("_file", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_base"))
    row_id = (F.lit(int(offset)) + F.col("_base") + F.col("_row") + 1).cast("long")
    rows = ranged.join(F.broadcast(bases), "_file")
    if alone:
        return rows.select(*order, row_id.alias(id_col))
    first = row_id - F.col("_nth") + 1
    return rows.select(*keys.columns, F.explode(F.sequence(first, first + F.col("_of") - 1)).alias(id_col))


def max_id(df: DataFrame, id_col: str) -> int:
    """Current high-water mark of an id column (0 when empty); one scalar to the driver."""
    v = df.agg(F.max(id_col)).first()[0]
    return max(int(v or 0), 0)


def ensure_default(df: DataFrame, default_row: dict, key: str) -> DataFrame:
    """Insert the unknown member (id ``-1``) if absent (K3). The default is a single row, so
    the anti join is a broadcast of ``df``'s key check against one row."""
    spark = df.sparkSession
    row = spark.createDataFrame([tuple(default_row.get(f.name) for f in df.schema.fields)], df.schema)
    missing = row.join(df.select(key).filter(F.col(key) == default_row[key]), key, "left_anti")
    return df.unionByName(missing)


def lookup(df: DataFrame, dim: DataFrame, left_on, right_on: str, id_col: str, out_col: str,
           default: int | None = UNKNOWN_ID) -> DataFrame:
    """Left join to a dimension on its business key and fall back to ``-1`` (J1/J2 + K4).

    ``left_on`` may be an expression (e.g. an id cast to text). The dimension key must be
    unique; for non-unique keys use :func:`lookup_first`.
    """
    d = salted_rows(dim.select(F.col(right_on).alias("_lk"), F.col(id_col).alias("_lid")), "_lk", "_ds")
    out = df.withColumn("_jk", _c(left_on))
    out = out.withColumn("_js", salt_of(F.col("_jk"), df.columns))
    out = out.join(d, (F.col("_jk") == F.col("_lk")) & (F.col("_js") == F.col("_ds")), "left").drop("_jk", "_js", "_ds")
    filled = F.col("_lid") if default is None else F.coalesce(F.col("_lid"), F.lit(default))
    return out.withColumn(out_col, filled.cast("long")).drop("_lk", "_lid")


def salt_of(key: Column, columns: Sequence[str]) -> Column:
    """0, but for NULL and the hot keys a number below ``SALTS`` from the row's first columns, so that
    a key that half of all rows carry does not meet in one task."""
    hot = key.isNull() | key.cast("string").isin(*HOT_KEYS)
    return F.when(hot, F.pmod(F.xxhash64(*columns[:2]), F.lit(SALTS)).cast("int")).otherwise(F.lit(0))


def salted_rows(dim: DataFrame, key: str, salt: str) -> DataFrame:
    """The rows that :func:`salt_of` joins with: those of the hot keys, if the dimension has them, once for
    every salt."""
    hot = F.col(key).cast("string").isin(*HOT_KEYS)
    return dim.withColumn(salt, F.explode(F.when(hot, F.sequence(F.lit(0), F.lit(SALTS - 1))).otherwise(F.array(F.lit(0)))))


def lookup_first(df: DataFrame, dim: DataFrame, left_on, right_on: str, id_col: str, out_col: str,
                 order: Sequence[Column] | None = None, default: int | None = UNKNOWN_ID) -> DataFrame:
    """Lateral top-1 (J3): ``LEFT JOIN LATERAL (SELECT ... WHERE k = outer.k LIMIT 1)``.

    The dimension is first cut to one row per key (deterministically: lowest id unless an
    order is given), then left-joined — no fan-out, no correlated subquery.
    """
    order = list(order) if order else [F.col(id_col).asc()]
    one = first_per_key(dim.select(right_on, id_col, *[c for c in dim.columns if c not in (right_on, id_col)]),
                        right_on, order)
    return lookup(df, one, left_on, right_on, id_col, out_col, default=default)


@dataclass
class MintResult:
    rows: DataFrame        # rows to append to the map (new hashes only)
    table: DataFrame       # map after the append
    batch: DataFrame       # batch records with their resolved id


def map_or_mint(batch: DataFrame, existing: DataFrame, key: str, id_col: str, attrs: Sequence[str],
                load_dt, hash_col: str = "hash_value", lineage: Sequence[str] = ("source_system", "source_entity"),
                offset: int | None = None) -> MintResult:
    """Mapping-table load (K2): reuse the id of any row with the same business key, else mint
    one per new distinct key; append one row per new (attributes, lineage) fingerprint.

    ``batch`` holds the standardised records (key, attrs, lineage); ``existing`` the map
    (id, key, attrs, lineage, hash, load_dt). Ids never change; a key may own several rows.
    """
    # four joins read the batch: it is computed once
    hashed = stage(batch.withColumn(hash_col, fingerprint(key, *attrs, *lineage)), "map-batch")
    known = existing.groupBy(key).agg(F.min(id_col).alias(id_col))
    new_keys = hashed.select(key).distinct().join(known.select(key), key, "left_anti")
    start = max_id(existing, id_col) if offset is None else offset
    minted = assign_keys(new_keys, [key], id_col, offset=start)
    ids = known.unionByName(minted)
    resolved = hashed.join(ids, key, "left")
    rows = (resolved.join(existing.select(hash_col), hash_col, "left_anti")
            .dropDuplicates([hash_col])
            .withColumn("load_dt", _c(load_dt) if not isinstance(load_dt, str) else F.lit(load_dt).cast("timestamp_ntz")))
    cols = existing.columns
    rows = rows.select(*cols)
    return MintResult(rows=rows, table=existing.unionByName(rows), batch=resolved)


def probe(big: DataFrame, keys: DataFrame, key: str, exact: bool = True) -> DataFrame:
    """Rows of ``big`` whose ``key`` occurs in ``keys`` (semi join), for probing a large stored
    table with a batch. The planner, and AQE from the measured bytes, broadcast a small batch.
    Whoever compares the rows with the batch anyway needs no ``exact`` answer: a table with no more rows
    than the batch (both are written: their footers tell) is then returned whole, which moves less."""
    if not exact and big.count() <= keys.count():
        return big
    return big.join(keys.select(key).distinct(), key, "left_semi")
