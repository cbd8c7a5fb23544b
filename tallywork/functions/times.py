"""Calendar helpers. Dates are derived without a time zone where the input has none."""

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DataType

from tallywork.fixed_values import GRANULARITIES


def day_of(moment: Column) -> Column:
    return F.to_date(moment)


def month_of(moment: Column) -> Column:
    """First day of the month."""
    return F.trunc(F.to_date(moment), "month")


def period_of(moment: Column, granularity: str) -> Column:
    """First day of the day, week (Monday), month, quarter or year that holds ``moment``."""
    if granularity not in GRANULARITIES:
        raise ValueError(f"granularity must be one of {sorted(GRANULARITIES)}")
    day = F.to_date(moment)
    return day if granularity == "day" else F.trunc(day, granularity)


def months_apart(later: Column, earlier: Column) -> Column:
    """Whole months between two month starts."""
    years = F.year(later) - F.year(earlier)
    return (years * 12 + F.month(later) - F.month(earlier)).cast("int")


def minutes(micros: Column) -> Column:
    return micros.cast("double") / F.lit(6e7)


def moment(value, kind: DataType) -> Column:
    """A day, time or text as a literal of a column's own type.

    A plain datetime literal would be an instant, which Spark moves by the session zone when it is
    compared with a column without a zone.
    """
    text = value if isinstance(value, str) else value.isoformat()
    return F.lit(text).cast(kind)
