"""How work is laid out over the cluster: shared tables, skewed joins, ordered slices."""

from tallywork.plans.frames import ALL, Frame, keyed_frames
from tallywork.plans.ordered import (
    OrderedRows,
    cut_by_order,
    first_of_key,
    following,
    global_ranks,
    join_null_safe,
    last_known,
    last_of_key,
    numbering,
    order_rows,
    previous,
    row_numbers,
)
from tallywork.plans.ranks import keyed_ranks
from tallywork.plans.selection import exact_percentiles, rows_by_rank
from tallywork.plans.skew import adapt_to_skew
from tallywork.plans.storage import durable, remove, scratch, shared_folder, stored

__all__ = [
    "ALL",
    "Frame",
    "OrderedRows",
    "adapt_to_skew",
    "cut_by_order",
    "durable",
    "exact_percentiles",
    "first_of_key",
    "following",
    "global_ranks",
    "join_null_safe",
    "keyed_frames",
    "keyed_ranks",
    "last_known",
    "last_of_key",
    "numbering",
    "order_rows",
    "previous",
    "remove",
    "row_numbers",
    "rows_by_rank",
    "scratch",
    "shared_folder",
    "stored",
]
