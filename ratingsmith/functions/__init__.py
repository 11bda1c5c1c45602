"""Column-expression builders (JVM-side built-ins only)."""

from ratingsmith.functions.dates import epoch_to_date, day_number, year_of
from ratingsmith.functions.numeric import (
    decade_of, half_up, safe_divide, relative_change, fraction_floor,
)
from ratingsmith.functions.text import (
    split_list, title_year, strip_title_year, normalize_token,
)

__all__ = [
    "epoch_to_date", "day_number", "year_of", "decade_of", "half_up",
    "safe_divide", "relative_change", "fraction_floor", "split_list",
    "title_year", "strip_title_year", "normalize_token",
]
