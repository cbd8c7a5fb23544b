"""Order-dependent work without one task per group.

A window over a group runs in a single task. Where a group has no size bound, the rows are cut
into slices that are consecutive in the wanted order: work inside a slice is local, and a summary
of one row per slice (and key) carries the running state from slice to slice.
"""

from collections.abc import Callable, Sequence
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.window import WindowSpec
from pyspark.sql.types import ArrayType, StructType

from tallywork.plans.storage import durable, remove, stored

SLICE = "_slice"
POS = "_pos"
_SPANS = "_spans"
_SAMPLED = 20  # rows of the sample per slice
_BLOCK = 64  # borders are searched in two steps
_WIDTHS = {"string": 20, "decimal": 16}  # bytes of a value in size estimates; others about 8
_BEFORE = (Window.unboundedPreceding, -1)
_UP_TO_HERE = (Window.unboundedPreceding, Window.currentRow)
_WHOLE = (Window.unboundedPreceding, Window.unboundedFollowing)


def _range_partitioned(df: DataFrame, order: Sequence[Column], slices: int | None) -> DataFrame:
    return df.repartitionByRange(slices, *order) if slices else df.repartitionByRange(*order)


def cut_by_order(df: DataFrame, order: Sequence[Column], *, slices: int | None = None) -> DataFrame:
    """Range-partition by ``order`` and store the rows with their slice and position in it.

    ``order`` must be a total order (end it with a unique column): then equal sort values may
    span slices and no value is too frequent for one task. The result is written out because a
    recomputed range partitioning may sample other boundaries.
    """
    rows = _range_partitioned(df, order, slices).sortWithinPartitions(*order)
    # the lower 33 bits of this id count the rows of a partition from 0
    position = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    return durable(
        rows.withColumn(SLICE, F.spark_partition_id()).withColumn(POS, position), "slices"
    )


def _slice_offsets(cut: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Per slice and key: rows before it in the key, rows in it, its first position."""
    sizes = cut.groupBy(SLICE, *keys).agg(
        F.count(F.lit(1)).alias("_n"), F.min(POS).alias("_first")
    )
    earlier = Window.partitionBy(*keys).orderBy(SLICE).rowsBetween(*_BEFORE)
    return sizes.withColumn("_offset", F.coalesce(F.sum("_n").over(earlier), F.lit(0)))


def join_null_safe(
    left: DataFrame, right: DataFrame, columns: Sequence[str], *, how: str = "inner"
) -> DataFrame:
    """Join on columns where NULL equals NULL; keeps the left copy of the columns."""
    match = F.lit(True)
    for name in columns:
        right = right.withColumnRenamed(name, f"_right_{name}")
        match = match & F.col(name).eqNullSafe(F.col(f"_right_{name}"))
    return left.join(right, match, how).drop(*(f"_right_{name}" for name in columns))


def row_numbers(
    df: DataFrame, keys: Sequence[str], order: Sequence[Column], out: str
) -> DataFrame:
    """``row_number() over (partition by keys order by order)`` for groups of any size."""
    cut = cut_by_order(df, [*(F.col(k).asc_nulls_last() for k in keys), *order])
    offsets = _slice_offsets(cut, keys)
    number = F.col("_offset") + F.col(POS) - F.col("_first") + 1
    return join_null_safe(cut, offsets, [SLICE, *keys]).select(*df.columns, number.alias(out))


def global_ranks(
    df: DataFrame, value: str, unique: str, *, within: str, slices: int | None = None
) -> DataFrame:
    """Rank all rows by ``value`` (largest first) without gathering them.

    Adds ``row_number``, ``rank``, ``dense_rank``, ``row_number_within`` (per ``within``) and
    ``total``. Ties in row numbers are broken by ``unique``; ``value`` has no NULLs. All of it comes
    from one sort: the order inside ``within`` is the global order restricted to its rows.
    """
    cut = cut_by_order(df, [F.col(value).desc(), F.col(unique).asc()], slices=slices)

    tasks = slices or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    by_value = Window.partitionBy(SLICE).orderBy(F.col(value).desc_nulls_last())

    def ranked(rows: DataFrame) -> DataFrame:
        """Ranks inside each slice, one slice a task."""
        local = rows.repartitionById(tasks, F.col(SLICE)).withColumn("_rank", F.rank().over(by_value))
        return local.withColumn("_dense", F.dense_rank().over(by_value))

    # equal values next to each other in a slice form a run; only the value travels here
    per_slice = (
        ranked(cut.select(SLICE, value))
        .groupBy(SLICE)
        .agg(
            F.count(F.lit(1)).alias("_n"),
            F.max("_dense").alias("_values"),
            F.max(value).alias("_top"),
            F.min(value).alias("_bottom"),
            (F.max("_rank") - 1).alias("_last_run"),
        )
    )
    in_order = Window.orderBy(SLICE)  # one row per slice
    earlier = in_order.rowsBetween(*_BEFORE)
    continues = F.coalesce(F.col("_top") == F.lag("_bottom").over(in_order), F.lit(False))
    own_rank = F.when(
        ~F.col("_continues") | (F.col("_values") > 1), F.col("_offset") + F.col("_last_run") + 1
    )
    state = (
        per_slice.withColumn("_continues", continues)
        .withColumn("_offset", F.coalesce(F.sum("_n").over(earlier), F.lit(0)))
        .withColumn("_new_values", F.col("_values") - F.col("_continues").cast("int"))
        .withColumn("_dense_offset", F.coalesce(F.sum("_new_values").over(earlier), F.lit(0)))
        .withColumn("_carried_rank", F.last(own_rank, ignorenulls=True).over(earlier))
        .withColumn("_total", F.sum("_n").over(Window.partitionBy()))
        .select(SLICE, "_continues", "_offset", "_dense_offset", "_carried_rank", "_total")
    )
    # how many rows of a group lie in earlier slices; travels as one extra row in front of the
    # group's rows in the slice, which spares a join of all rows
    sizes = cut.groupBy(SLICE, within).agg(F.count(F.lit(1)).alias("_n"))
    group_before = Window.partitionBy(within).orderBy(SLICE).rowsBetween(*_BEFORE)
    heads = sizes.select(
        SLICE,
        within,
        F.lit(-1).cast("bigint").alias(POS),
        F.coalesce(F.sum("_n").over(group_before), F.lit(0)).alias("_group_offset"),
    )
    rows = cut.unionByName(heads, allowMissingColumns=True)

    in_group = Window.partitionBy(SLICE, within).orderBy(POS)
    local = (
        ranked(rows)  # the same task serves the windows of the group
        .withColumn("_in_group", F.row_number().over(in_group) - 1)
        .withColumn("_group_offset", F.first("_group_offset").over(in_group))
        .filter(F.col(POS) >= 0)
    )
    carried = F.col("_continues") & (F.col("_dense") == 1)
    # one row per slice, so at most the partition count
    return local.join(F.broadcast(state), SLICE).select(
        *df.columns,
        (F.col("_offset") + F.col(POS) + 1).alias("row_number"),
        F.when(carried, F.col("_carried_rank"))
        .otherwise(F.col("_offset") + F.col("_rank"))
        .alias("rank"),
        (F.col("_dense_offset") + F.col("_dense") - F.col("_continues").cast("int")).alias(
            "dense_rank"
        ),
        (F.col("_group_offset") + F.col("_in_group")).alias("row_number_within"),
        F.col("_total").alias("total"),
    )


@dataclass(frozen=True)
class Carried:
    """A column from a window over a key in order, put together from the key's slices.

    ``local`` is the value inside a slice, over the window of (key, slice). ``summary`` aggregates a
    slice; ``carry`` takes the summaries (``F.col`` of its argument) of the key's other slices, over a
    window in the order of slices. ``combine`` makes the value from both; what is carried is NULL where
    there are no other slices.
    """

    out: str
    local: Callable[[WindowSpec], Column]
    summary: Column
    carry: Callable[[str, WindowSpec], Column]
    combine: Callable[[Column, Column], Column]


def _boxed(value: str) -> Column:
    """Tells a NULL value from no row."""
    return F.struct(F.col(value).alias("v"))


def previous(value: str, out: str, order: Sequence[str]) -> Carried:
    """``lag(value)``."""
    return Carried(
        out,
        lambda w: F.lag(_boxed(value)).over(w),
        F.max_by(_boxed(value), F.struct(*order)),
        lambda name, w: F.lag(name).over(w),
        lambda here, other: F.coalesce(here, other)["v"],
    )


def following(value: str, out: str, order: Sequence[str]) -> Carried:
    """``lead(value)``; the state is carried backwards."""
    return Carried(
        out,
        lambda w: F.lead(_boxed(value)).over(w),
        F.min_by(_boxed(value), F.struct(*order)),
        lambda name, w: F.lead(name).over(w),
        lambda here, other: F.coalesce(here, other)["v"],
    )


def last_known(value: str, out: str, order: Sequence[str]) -> Carried:
    """The last value that is not NULL, up to and including the row."""
    known = F.when(F.col(value).isNotNull(), F.struct(*order))
    return Carried(
        out,
        lambda w: F.last(value, ignorenulls=True).over(w.rowsBetween(*_UP_TO_HERE)),
        F.max_by(value, known),
        lambda name, w: F.last(name, ignorenulls=True).over(w.rowsBetween(*_BEFORE)),
        F.coalesce,
    )


def first_of_key(value: str, out: str, order: Sequence[str]) -> Carried:
    """``first_value`` over the whole key."""
    return Carried(
        out,
        lambda w: F.first(_boxed(value)).over(w.rowsBetween(*_WHOLE)),
        F.min_by(_boxed(value), F.struct(*order)),
        lambda name, w: F.first(name).over(w.rowsBetween(*_WHOLE)),
        lambda here, other: F.coalesce(other, here)["v"],
    )


def last_of_key(value: str, out: str, order: Sequence[str]) -> Carried:
    """``last_value`` over the whole key, both ends unbounded."""
    return Carried(
        out,
        lambda w: F.last(_boxed(value)).over(w.rowsBetween(*_WHOLE)),
        F.max_by(_boxed(value), F.struct(*order)),
        lambda name, w: F.last(name).over(w.rowsBetween(*_WHOLE)),
        lambda here, other: F.coalesce(other, here)["v"],
    )


def running_sum(value: str, out: str) -> Carried:
    """Running total of ``value`` up to and including the row; NULLs add nothing."""
    return Carried(
        out,
        lambda w: F.sum(value).over(w.rowsBetween(*_UP_TO_HERE)),
        F.sum(value),
        lambda name, w: F.sum(name).over(w.rowsBetween(*_BEFORE)),
        lambda here, other: F.when(here.isNull(), other).otherwise(here + F.coalesce(other, F.lit(0))),
    )


def numbering(out: str) -> Carried:
    """1, 2, 3, ... in the key's order."""
    return Carried(
        out,
        lambda w: F.row_number().over(w).cast("bigint"),
        F.count(F.lit(1)),
        lambda name, w: F.sum(name).over(w.rowsBetween(*_BEFORE)),
        lambda here, other: here + F.coalesce(other, F.lit(0)),
    )


@dataclass(frozen=True)
class OrderedRows:
    """Rows grouped by ``key`` in ``order``, cut into slices of bounded size.

    One window per (key, slice) serves all rows. Keys that span slices carry state between them; that
    state has at most one row per slice and is broadcast.
    """

    df: DataFrame
    key: str
    order: tuple[str, ...]
    spans: bool

    def window(self) -> WindowSpec:
        return Window.partitionBy(self.key, SLICE).orderBy(*self.order)

    def spanning(self) -> DataFrame:
        """The rows of the keys that span slices."""
        return self.df.filter(_SPANS)

    def with_columns(self, *columns: Carried) -> "OrderedRows":
        """Add some columns; all their states come from one pass and travel together."""
        here = self.window()
        rows = self.df.withColumns({f"_local_{c.out}": c.local(here) for c in columns})
        if self.spans:
            slices = self.spanning().groupBy(self.key, SLICE)
            states = slices.agg(*(c.summary.alias(f"_state_{c.out}") for c in columns))
            in_order = Window.partitionBy(self.key).orderBy(SLICE)
            carried = [c.carry(f"_state_{c.out}", in_order).alias(f"_carried_{c.out}") for c in columns]
            states = states.select(self.key, SLICE, *carried)
            # a row per slice of the keys that span slices
            rows = join_null_safe(rows, F.broadcast(states), [self.key, SLICE], how="left")
        else:
            rows = rows.withColumns(
                {f"_carried_{c.out}": F.lit(None).cast(rows.schema[f"_local_{c.out}"].dataType) for c in columns}
            )
        made = {c.out: c.combine(F.col(f"_local_{c.out}"), F.col(f"_carried_{c.out}")) for c in columns}
        helpers = [f"_{kind}_{c.out}" for kind in ("local", "carried") for c in columns]
        return replace(self, df=rows.withColumns(made).drop(*helpers))

    def with_column(self, name: str, value: Column) -> "OrderedRows":
        return replace(self, df=self.df.withColumn(name, value))

    def with_previous(self, value: str, out: str) -> "OrderedRows":
        """``lag(value)`` in the key's order."""
        return self.with_columns(previous(value, out, self.order))

    def with_running_sum(self, value: str, out: str) -> "OrderedRows":
        """Running total of ``value`` up to and including the row."""
        return self.with_columns(running_sum(value, out))

    def with_row_number(self, out: str) -> "OrderedRows":
        """1, 2, 3, ... in the key's order."""
        return self.with_columns(numbering(out))

    def rows(self) -> DataFrame:
        return self.df.drop(SLICE, _SPANS)


def order_rows(
    df: DataFrame, key: str, order: Sequence[str], *, slices: int | None = None
) -> OrderedRows:
    """Prepare ``df`` for order-dependent work per ``key``; ``order`` must be total within a key.

    The rows are cut into about ``slices`` slices by (key, order), as many as there are shuffle
    partitions by default. A row's slice is the number of borders at or before it inside its key, an
    expression of the row alone, so a recomputed task gives the same slices.
    """
    slices = slices or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    borders = _borders(df, key, order, slices)
    if not borders:
        cut = df.withColumn(SLICE, F.lit(0)).withColumn(_SPANS, F.lit(False))
        return OrderedRows(cut, key, tuple(order), spans=False)
    place = StructType([df.schema[c] for c in order])
    schema = StructType([df.schema[key]]).add("_borders", ArrayType(ArrayType(place)))
    listed = df.sparkSession.createDataFrame(
        [(value, in_blocks(places)) for value, places in borders], schema
    )
    # at most one border per slice
    rows = join_null_safe(df, F.broadcast(listed), [key], how="left")
    cut = rows.withColumn(_SPANS, F.col("_borders").isNotNull()).withColumn(
        SLICE, borders_passed(F.col("_borders"), F.struct(*order))
    )
    return OrderedRows(cut.drop("_borders"), key, tuple(order), spans=True)


def in_blocks(places: list[tuple]) -> list[list[tuple]]:
    return [places[i : i + _BLOCK] for i in range(0, len(places), _BLOCK)]


def borders_passed(borders: Column, here: Column) -> Column:
    """How many of the sorted borders, in blocks, are at or before a place; 0 without borders."""
    block = F.size(F.filter(borders, lambda b: b[0] <= here))
    inside = F.size(F.filter(F.get(borders, block - 1), lambda b: b <= here))
    return F.coalesce(F.when(block > 0, (block - 1) * _BLOCK + inside).otherwise(0), F.lit(0))


def _borders(df: DataFrame, key: str, order: Sequence[str], slices: int) -> list[tuple]:
    """Where slices begin inside the keys that span them: (key, sorted borders).

    From a sample of some rows per slice. It is cut inside Spark, key by key; only the borders reach
    the driver, at most one per slice. The sample only steers the layout; results do not depend on it.
    """
    sample, m, folder = _sample(df.select(key, *order), _SAMPLED * slices)
    step = max(1, round(m / slices))
    places = F.array_sort(F.collect_list(F.struct(*order))).alias("places")
    starts = F.filter("places", lambda _, i: (i > 0) & (i % step == 0))
    cut = sample.groupBy(key).agg(places).filter(F.size("places") > step).select(key, starts.alias("starts"))
    found = [(value, [tuple(place) for place in borders]) for value, borders in cut.collect()]
    remove(df.sparkSession, folder)
    return found


def _sample(rows: DataFrame, wanted: int) -> tuple[DataFrame, int, str]:
    """About ``wanted`` rows, stored, their number, and their folder; as a rule in one pass over ``rows``.

    The share comes from Spark's estimate of the size. Only where that was far too high are the rows
    counted and sampled again.
    """
    share = min(1.0, wanted / max(_guessed_rows(rows), 1))
    sample, folder = stored(rows.sample(share, seed=1) if share < 1 else rows, "sample")
    m = sample.count()  # from the files' metadata
    if share < 1 and m < wanted / 4:
        remove(rows.sparkSession, folder)
        share = min(1.0, wanted / max(rows.count(), 1))
        sample, folder = stored(rows.sample(share, seed=1) if share < 1 else rows, "sample")
        m = sample.count()
    if m > 4 * wanted:
        sample = sample.sample(wanted / m, seed=1)
        m = wanted
    return sample, m, folder


def _guessed_rows(rows: DataFrame) -> int:
    """How many rows the optimizer's size estimate stands for, if they were stored plainly."""
    size = rows._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()
    width = 8 + sum(_WIDTHS.get(f.dataType.typeName(), 8) for f in rows.schema)
    return int(size) // width
