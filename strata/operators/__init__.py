"""DataFrame operators of the warehouse (each a ``DataFrame -> DataFrame`` function)."""

from strata.operators.calendar import dim_dates, dim_times
from strata.operators.keys import (UNKNOWN_ID, assign_keys, ensure_default, lookup, lookup_first, map_or_mint,
                                   max_id, probe)
from strata.operators.latest import first_per_key, latest_by
from strata.operators.pit import point_in_time_join
from strata.operators.scd2 import fold_key, scd2_merge, versions_from_events
from strata.operators.sequence import with_next
from strata.operators.staging import stage_append, stage_rows
from strata.operators.upsert import insert_absent, merge_fact, upsert

__all__ = [
    "UNKNOWN_ID", "assign_keys", "dim_dates", "dim_times", "ensure_default", "first_per_key", "fold_key",
    "insert_absent", "latest_by", "lookup", "lookup_first", "map_or_mint", "max_id", "merge_fact",
    "point_in_time_join", "probe", "scd2_merge", "stage_append", "stage_rows", "upsert", "versions_from_events", "with_next",
]
