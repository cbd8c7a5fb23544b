"""DuckDB SQL for every registered query, written against the driver's parquet views."""

from oracles.queries import sql
from oracles.tables import PARAMETERS

__all__ = ["PARAMETERS", "sql"]
