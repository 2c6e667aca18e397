from strata.functions.dates import (HIGH_TS, LOW_DATE, LOW_TS, high_ts, iso_dow, low_ts, minus_minute,
                                   month_id, padded_upper_name, time_id)
from strata.functions.pick import hash_index, md5_index, pick
from strata.functions.text import NA, SEP, ckey, differs, fingerprint, na, same, std

__all__ = [
    "HIGH_TS", "LOW_DATE", "LOW_TS", "NA", "SEP", "ckey", "differs", "fingerprint", "hash_index",
    "high_ts", "iso_dow", "low_ts", "md5_index", "minus_minute", "month_id", "na",
    "padded_upper_name", "pick", "same", "std", "time_id",
]
