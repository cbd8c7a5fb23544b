"""Column helpers built from Spark's own functions."""

from tallywork.functions.names import any_names, known_as
from tallywork.functions.numeric import average, half_up, ntile_of, percent, ratio
from tallywork.functions.text import normalise_email
from tallywork.functions.times import day_of, minutes, moment, month_of, months_apart, period_of

__all__ = [
    "any_names",
    "average",
    "day_of",
    "half_up",
    "known_as",
    "minutes",
    "moment",
    "month_of",
    "months_apart",
    "normalise_email",
    "ntile_of",
    "percent",
    "period_of",
    "ratio",
]
