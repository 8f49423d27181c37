"""Column helpers; every one stays inside JVM code generation."""

from tidemart.functions.numbers import (
    exact_avg,
    exact_sum,
    gross_price,
    money_text,
    net_price,
    percent,
    ratio,
    round_to,
    safe_cast,
    typed_null,
)
from tidemart.functions.status import table_label, threshold_status
from tidemart.functions.times import epoch_seconds, hour_bucket, instant, micros

__all__ = [
    "epoch_seconds", "exact_avg", "exact_sum", "gross_price", "hour_bucket", "instant",
    "micros", "money_text", "net_price", "percent", "ratio", "round_to", "safe_cast",
    "table_label", "threshold_status", "typed_null",
]
