"""Operators on tables with other column names."""

from collections.abc import Callable, Mapping
from functools import wraps

from pyspark.sql import DataFrame


def known_as(df: DataFrame, columns: Mapping[str, str]) -> DataFrame:
    """Rename columns to the names that an operator uses: ``columns`` maps those to the own names.

    A column that has an operator's name already, but is not meant, is left out.
    """
    own = {name: mine for name, mine in columns.items() if mine in df.columns and mine != name}
    rest = df.drop(*(name for name in own if name not in own.values()))
    return rest.withColumnsRenamed({mine: name for name, mine in own.items()})


def any_names(operator: Callable) -> Callable:
    """Give an operator a parameter ``columns`` for tables whose columns have other names.

    ``columns={"user_id": "customer", "order_date": "placed_at"}`` says where the operator's columns
    are in the frames that it gets. The result has the operator's names.
    """

    @wraps(operator)
    def run(*frames, columns: Mapping[str, str] | None = None, **options):
        def renamed(value):
            return known_as(value, columns) if columns and isinstance(value, DataFrame) else value

        return operator(*map(renamed, frames), **{n: renamed(v) for n, v in options.items()})

    return run
