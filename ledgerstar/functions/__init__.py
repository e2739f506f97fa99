"""Column-expression helpers (all JVM-side built-ins)."""

from .buckets import bucket_pick, hex_bucket, merchant_category_of, region_of
from .masking import is_masked_id, mask_id
from .numeric import avg_half_up, money, pct, round_double, safe_div
from .timekeys import (date_key_of, day_name, is_weekend, iso_day_of_week, month_name,
                       step_to_timestamp, timestamp_to_step, week_of_month)
from .typecodes import normalise_type

__all__ = [
    "bucket_pick", "hex_bucket", "merchant_category_of", "region_of", "is_masked_id", "mask_id",
    "avg_half_up", "money", "pct", "round_double", "safe_div", "date_key_of", "day_name",
    "is_weekend", "iso_day_of_week", "month_name", "step_to_timestamp", "timestamp_to_step",
    "week_of_month", "normalise_type",
]
