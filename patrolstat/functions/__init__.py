"""Column-expression library (built-in Spark functions only, no UDFs)."""

from patrolstat.functions.categorize import hour_slot, is_theft, keyword_bucket, severity_weight
from patrolstat.functions.parsing import (
    day_of,
    fixed_slice,
    float_text,
    hour_of,
    minute_of,
    month_of,
    null_if_missing,
    percent_text,
    ratio_percent,
    safe_int,
    split_pick,
    strip_brackets,
    tail_from,
)

__all__ = [
    "day_of", "fixed_slice", "float_text", "hour_of", "hour_slot", "is_theft",
    "keyword_bucket", "minute_of", "month_of", "null_if_missing", "percent_text",
    "ratio_percent", "safe_int", "severity_weight", "split_pick", "strip_brackets",
    "tail_from",
]
