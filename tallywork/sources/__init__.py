"""Where tables come from and results go to."""

from tallywork.sources.appends import CheckedTable
from tallywork.sources.layouts import KeyedTable
from tallywork.sources.months import read_months, write_by_month
from tallywork.sources.snapshots import Conflict, Snapshots, by_month
from tallywork.sources.tables import RULES, SCHEMAS, conform, read_tables
from tallywork.sources.trade import TradeTables

__all__ = [
    "CheckedTable",
    "Conflict",
    "KeyedTable",
    "RULES",
    "SCHEMAS",
    "Snapshots",
    "TradeTables",
    "by_month",
    "conform",
    "read_months",
    "read_tables",
    "write_by_month",
]
