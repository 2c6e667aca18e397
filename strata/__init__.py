"""strata — a layered retail sales warehouse built from Spark DataFrame operators.

Layers: raw CSV -> staging (fingerprinted, append-only) -> mapping (shared keys across
channels) -> normalised entities (SCD1 upserts, SCD2 history) -> star schema (dimensions,
month-partitioned fact with a rolling active window).

Every operator is a plain ``DataFrame -> DataFrame`` function; only ``strata.plans.warehouse``
touches storage.
"""

from strata.session import checkpoint_dir, cut_lineage, get_spark

__all__ = ["get_spark", "checkpoint_dir", "cut_lineage"]
