"""Column-returning helpers shared by the operators."""

from oddsline.functions.arrays import join_strings, outcome_name
from oddsline.functions.mathcols import change_from_previous, finite_or_kind, ieee_divide, pct_change
from oddsline.functions.timecols import (
    date_start_ms,
    day_bucket,
    epoch_ms,
    iso_to_ms,
    iso_to_ms_strict,
    lookback_start_ms,
    ms_to_iso,
    ms_to_timestamp,
)

__all__ = [
    "change_from_previous", "date_start_ms", "day_bucket", "epoch_ms", "finite_or_kind",
    "ieee_divide", "iso_to_ms", "iso_to_ms_strict", "join_strings", "lookback_start_ms",
    "ms_to_iso", "ms_to_timestamp", "outcome_name", "pct_change",
]
