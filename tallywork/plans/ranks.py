"""Ranks and running totals with peers inside keys of any size.

Rows with equal values are peers: they share a rank, and the default frame of a running total takes
all of them in. The rows of a key are cut into slices in the order of value and unique column, so peers
may span slices. What a slice needs of the others is its place in the key and how many of its first
and last peers lie elsewhere; that is one row per slice.
"""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallywork.plans.ordered import SLICE, join_null_safe, order_rows

_BEFORE = (Window.unboundedPreceding, -1)
STATES = ("_rows", "_sum", "_dense", "_first_n", "_last_n", "_last_sum", "_total")


def keyed_ranks(
    df: DataFrame,
    key: str,
    value: str,
    unique: str,
    *,
    measure: str,
    slices: int | None = None,
) -> DataFrame:
    """Ranks of every row inside its key by ``value``, smallest first and NULLs before all.

    Adds ``row_number`` (ties by ``unique``), ``rank``, ``dense_rank``, ``total`` (rows of the key),
    ``peers_sum`` and ``peers_rows``: ``measure`` summed, and rows counted, over the default frame,
    that is all rows up to the last peer. ``slices``: see ``order_rows``. NULL keys are one key.
    """
    cut = order_rows(df, key, (value, unique), slices=slices)
    by_value = Window.partitionBy(key, SLICE).orderBy(value)
    whole = Window.partitionBy(key, SLICE)
    rows = cut.df.withColumns(
        {
            "_number": F.row_number().over(cut.window()),
            "_rank_here": F.rank().over(by_value),
            "_dense_here": F.dense_rank().over(by_value),
            "_sum_here": F.sum(measure).over(by_value),
            "_rows_here": F.count(F.lit(1)).over(by_value),
            "_size": F.count(F.lit(1)).over(whole),
        }
    )
    if cut.spans:
        # at most one row per slice of the keys that span slices
        rows = join_null_safe(rows, F.broadcast(_states(cut.spanning(), key, value, measure)), [key, SLICE], how="left")
    else:
        total = rows.schema["_sum_here"].dataType
        rows = rows.withColumns({n: F.lit(None).cast(total if "sum" in n else "bigint") for n in STATES})

    def carried(name: str) -> Column:
        return F.coalesce(F.col(name), F.lit(0))

    first_peers = F.col("_dense_here") == 1  # they may go on from the slice before
    last_peers = F.col("_rows_here") == F.col("_size")  # they may go on in the slice after
    before = F.when(first_peers, carried("_first_n")).otherwise(F.lit(0))
    after = F.when(last_peers, carried("_last_n")).otherwise(F.lit(0))
    parts = [F.col("_sum"), F.col("_sum_here"), F.when(last_peers, F.col("_last_sum"))]
    some = F.coalesce(*parts)
    total = sum((F.coalesce(p, F.lit(0)) for p in parts[1:]), F.coalesce(parts[0], F.lit(0)))
    made = {
        "row_number": carried("_rows") + F.col("_number"),
        "rank": carried("_rows") + F.col("_rank_here") - before,
        "dense_rank": carried("_dense") + F.col("_dense_here"),
        "total": F.coalesce("_total", "_size"),
        "peers_sum": F.when(some.isNotNull(), total).cast(rows.schema["_sum_here"].dataType),
        "peers_rows": carried("_rows") + F.col("_rows_here") + after,
    }
    return rows.select(*df.columns, *(c.alias(name) for name, c in made.items()))


def _states(rows: DataFrame, key: str, value: str, measure: str) -> DataFrame:
    """Per key and slice: rows, sum and values before it, its first peers before it, its last ones after it."""
    peers = rows.groupBy(key, SLICE, value).agg(F.count(F.lit(1)).alias("_n"), F.sum(measure).alias("_s"))
    same = Window.partitionBy(key, value).orderBy(SLICE)
    peers = peers.select(
        key,
        SLICE,
        F.struct(F.col(value)).alias("_value"),
        "_n",
        "_s",
        F.coalesce(F.sum("_n").over(same.rowsBetween(*_BEFORE)), F.lit(0)).alias("_n_before"),
        F.struct(
            F.sum("_n").over(same.orderBy(F.col(SLICE).desc()).rowsBetween(*_BEFORE)).alias("n"),
            F.sum("_s").over(same.orderBy(F.col(SLICE).desc()).rowsBetween(*_BEFORE)).alias("s"),
        ).alias("_after"),
    )
    ends = peers.groupBy(key, SLICE).agg(
        F.sum("_n").alias("_n"),
        F.sum("_s").alias("_s"),
        F.count(F.when(F.col("_n_before") == 0, F.lit(1))).alias("_new"),
        F.min_by("_n_before", "_value").alias("_first_n"),
        F.max_by("_after", "_value").alias("_last"),
    )
    in_order = Window.partitionBy(key).orderBy(SLICE)
    earlier = in_order.rowsBetween(*_BEFORE)
    # the first peers that go on from before are no new value
    goes_on = (F.col("_first_n") > 0).cast("int")
    return ends.select(
        key,
        SLICE,
        F.sum("_n").over(earlier).alias("_rows"),
        F.sum("_s").over(earlier).alias("_sum"),
        (F.coalesce(F.sum("_new").over(earlier), F.lit(0)) - goes_on).alias("_dense"),
        "_first_n",
        F.col("_last.n").alias("_last_n"),
        F.col("_last.s").alias("_last_sum"),
        F.sum("_n").over(Window.partitionBy(key)).alias("_total"),
    )
