from .text import pystrip, na_to_null, PANDAS_NA_TOKENS
from .dates import date_key, month_key, iso_weekday, week_ending_monday, month_index, time_of_day
from .ratios import safe_div, dax_div, round2, round_half_up

__all__ = [
    "pystrip", "na_to_null", "PANDAS_NA_TOKENS",
    "date_key", "month_key", "iso_weekday", "week_ending_monday", "month_index", "time_of_day",
    "safe_div", "dax_div", "round2", "round_half_up",
]
