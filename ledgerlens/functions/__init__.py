"""Column recipes (built-in expressions only, no Python UDFs)."""

from .dates import day_boundaries, literal_day_text, mm_yy, month_boundaries, month_index, us_week
from .numeric import decimal_text_pct, int_avg, int_part, pct_text, ratio
from .text import ci_eq, ci_in, ci_ne, concat_text, like, like_to_regex, nvl_text, prefix_before

__all__ = [
    "day_boundaries", "literal_day_text", "mm_yy", "month_boundaries", "month_index", "us_week",
    "decimal_text_pct", "int_avg", "int_part", "pct_text", "ratio",
    "ci_eq", "ci_in", "ci_ne", "concat_text", "like", "like_to_regex", "nvl_text", "prefix_before",
]
