"""Column functions; all of them are built-in Spark expressions (no Python UDF)."""

from lakeshelf.functions.casts import CAST_TYPES, number_of, tolerant_cast
from lakeshelf.functions.dates import (
    day_of_week,
    day_start,
    epoch_to_timestamp,
    hour_start,
    is_weekend,
    minute_start,
    season_name,
    season_number,
)
from lakeshelf.functions.keys import surrogate_key
from lakeshelf.functions.labels import at_least, below, first_match
from lakeshelf.functions.numbers import between_or_null, percent_of, round_half_even_int, round_to
from lakeshelf.functions.text import tidy_lower, tidy_upper

__all__ = [
    "CAST_TYPES", "at_least", "below", "between_or_null", "day_of_week", "day_start",
    "epoch_to_timestamp", "first_match", "hour_start", "is_weekend", "minute_start",
    "number_of", "percent_of", "round_half_even_int", "round_to", "season_name", "season_number", "surrogate_key",
    "tidy_lower", "tidy_upper", "tolerant_cast",
]
