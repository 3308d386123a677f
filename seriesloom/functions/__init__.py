"""Column expressions: calendar parts, scores, names, noise and the log target."""

from .calendar import CALENDAR_PARTS, calendar_parts, parse_date
from .naming import alpha_text, ewm_name, lag_name, replace_in_names, roll_name
from .scores import absolute_error, mean_absolute_error, smape
from .transforms import from_log, noise, to_log

__all__ = [
    "CALENDAR_PARTS",
    "absolute_error",
    "alpha_text",
    "calendar_parts",
    "ewm_name",
    "from_log",
    "lag_name",
    "mean_absolute_error",
    "noise",
    "parse_date",
    "replace_in_names",
    "roll_name",
    "smape",
    "to_log",
]
