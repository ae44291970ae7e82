from ontime.functions.columns import (
    drop_nan,
    hash_bucket,
    key_hash,
    share_limit,
    hour_from_hhmm,
    is_missing,
    is_parquet,
    late_label,
    logistic,
    season,
    time_of_day,
    unsigned_zero,
    zone_path,
)

__all__ = [
    "drop_nan",
    "hash_bucket",
    "key_hash",
    "share_limit",
    "hour_from_hhmm",
    "is_missing",
    "is_parquet",
    "late_label",
    "logistic",
    "season",
    "time_of_day",
    "unsigned_zero",
    "zone_path",
]
