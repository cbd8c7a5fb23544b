"""Rows and values by their rank, without sorting or storing the rows.

The rows are counted between borders; only the part that holds a wanted rank is looked at again, with
finer borders, until it is small.
"""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tallywork.plans.ordered import SLICE, _borders, borders_passed, in_blocks, join_null_safe
from tallywork.plans.storage import durable

_ONE = "_one"
SORTED_ROWS = 1_000_000  # rows of a page's part that are sorted
BORDERS = 256  # in one round; they are literals of the plan
LISTED = 10_000  # values of one group that are listed
BINS = 1024


def rows_by_rank(
    df: DataFrame,
    order: Sequence[str],
    offset: int,
    size: int,
    *,
    slices: int | None = None,
    most: int = SORTED_ROWS,
) -> DataFrame:
    """Rows ``offset + 1`` to ``offset + size`` of ``df`` in ``order``, NULLs first.

    Rows are counted between borders from a sample; then only the slices with the page are read, cut
    again if they hold more than ``most`` rows beyond the page, and sorted. ``order`` covers all
    columns, so that rows with equal places are equal. The counts of the slices reach the driver.
    """
    slices = slices or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    slices = min(max(slices, 2), BORDERS)
    part, skipped = df, 0
    here = F.struct(*order)
    while True:
        sampled = _borders(part.withColumn(_ONE, F.lit(0)), _ONE, order, slices)
        borders = sampled[0][1] if sampled else []
        if not borders:
            break
        blocks = F.array(*(F.array(*(_place(df, order, b) for b in block)) for block in in_blocks(borders)))
        cut = part.withColumn(SLICE, borders_passed(blocks, here))
        counts = {r[SLICE]: r["count"] for r in cut.groupBy(SLICE).count().collect()}
        before, wanted = skipped, []
        for number in sorted(counts):
            after = before + counts[number]
            if after > offset and before < offset + size:
                wanted.append((number, before, counts[number]))
            before = after
        if not wanted:
            return df.limit(0)
        first, last = wanted[0][0], wanted[-1][0]
        low = borders[first - 1] if first else None
        high = borders[last] if last < len(borders) else None
        part = part.filter(_between(df, order, low, high))
        held_rows = sum(n for _, _, n in wanted)
        smaller = held_rows < sum(counts.values())
        skipped = wanted[0][1]
        if held_rows <= most + size or not smaller:
            break
    return part.orderBy(*(F.col(c).asc_nulls_first() for c in order)).offset(offset - skipped).limit(size)


def _place(df: DataFrame, order: Sequence[str], values: tuple) -> Column:
    fields = StructType([df.schema[c] for c in order])
    return F.struct(*(F.lit(v).cast(f.dataType).alias(f.name) for v, f in zip(values, fields, strict=True)))


def _between(df: DataFrame, order: Sequence[str], low: tuple | None, high: tuple | None) -> Column:
    """At or after ``low`` and before ``high``, with a range of the first column that the scan can use."""
    first, here = F.col(order[0]), F.struct(*order)
    condition = F.lit(True)
    if low is not None:
        condition &= here >= _place(df, order, low)
        if low[0] is not None:
            condition &= first >= F.lit(low[0])
    if high is not None:
        condition &= here < _place(df, order, high)
        if high[0] is None:
            condition &= first.isNull()
        elif low is None or low[0] is None:
            condition &= first.isNull() | (first <= F.lit(high[0]))
        else:
            condition &= first <= F.lit(high[0])
    return condition


def exact_percentiles(
    df: DataFrame,
    keys: Sequence[str],
    value: str,
    shares: dict[str, float],
    *,
    also: dict[str, Column] | None = None,
    bins: int = BINS,
    listed: int = LISTED,
) -> DataFrame:
    """Interpolated percentiles per key for groups of any size; one column per entry of ``shares``.

    Spark's exact ``percentile`` keeps every distinct value of a group in one buffer. Here each
    group's values, whole numbers or decimals, are counted in a histogram per wanted rank, whose
    range is then the bin that holds the rank, until a bin is one value or has at most ``listed``
    rows to list. Rows without a value do not count; a key that has no others gets NULLs. Equal
    values are never gathered.

    ``also`` are further aggregates of the groups, taken in the first pass. The rows are not stored,
    only states of a few rows per group: ``df`` is computed for the first pass, for every round of
    finer bins, which groups of up to ``listed`` values do without, and for the list.
    """
    known = F.col(value).isNotNull()
    groups = df.groupBy(*keys).agg(
        F.count(value).alias("_n"),
        F.min(value).alias("_lo"),
        F.max(value).alias("_hi"),
        *(column.alias(name) for name, column in (also or {}).items()),
    )
    if keys:
        groups = durable(groups, "groups")
    else:  # one row
        groups = df.sparkSession.createDataFrame(groups.collect(), groups.schema)
    wanted = F.array(*(F.struct(F.lit(n).alias("name"), F.lit(float(p)).alias("p")) for n, p in shares.items()))
    exact = F.col("_want.p") * (F.col("_n") - 1)
    asked = groups.filter("_n > 0").select(*keys, "_n", "_lo", "_hi", F.explode(wanted).alias("_want"))
    asked = asked.withColumn("_low", F.floor(exact)).withColumn("_part", exact - F.floor(exact))
    ranks = F.array(F.col("_low"), F.least(F.col("_low") + 1, F.col("_n") - 1))
    start = asked.select(
        *keys,
        F.explode(F.array_distinct(ranks)).alias("_rank"),
        "_lo",
        "_hi",
        F.lit(0).cast("bigint").alias("_skip"),
        F.col("_n").alias("_in"),
    )
    states = start.distinct()
    rows = df.filter(known).select(*keys, F.col(value).alias("_v"))
    open_ = (F.col("_in") > listed) & (F.col("_lo") < F.col("_hi"))
    while not states.filter(open_).isEmpty():
        finer = _narrowed(rows, states.filter(open_), keys, bins)
        states = durable(states.filter(~open_).unionByName(finer), "histograms")

    place = (F.col("_rank") - F.col("_skip")).cast("int")
    several = states.filter(F.col("_lo") < F.col("_hi"))
    inside = _meeting(rows, several, keys).groupBy(*keys, "_rank", "_skip").agg(
        F.array_sort(F.collect_list("_v")).alias("_values")  # at most ``listed``
    )
    found = states.filter(F.col("_lo") == F.col("_hi")).select(*keys, "_rank", F.col("_lo").alias("_value"))
    found = found.union(inside.select(*keys, "_rank", F.get("_values", place)))
    if not keys:  # one row, and a few ranks that are numbers by now
        n = groups.first()["_n"]
        values = {r["_rank"]: float(r["_value"]) for r in found.collect()}
        numbers = {name: _interpolated(values, p * (n - 1)) if n else None for name, p in shares.items()}
        return groups.select(*(also or {}), *(F.lit(x).cast("double").alias(name) for name, x in numbers.items()))
    ends = found.groupBy(*keys).agg(F.map_from_entries(F.collect_list(F.struct("_rank", "_value"))).alias("_at"))

    def one(p: float) -> Column:
        rank = F.lit(float(p)) * (F.col("_n") - 1)
        low = F.floor(rank)
        low_value = F.element_at("_at", low).cast("double")
        high_value = F.element_at("_at", F.least(low + 1, F.col("_n") - 1)).cast("double")
        return low_value + (high_value - low_value) * (rank - low)

    columns = [F.when(F.col("_n") > 0, one(p)).alias(name) for name, p in shares.items()]
    joined = join_null_safe(groups, ends, list(keys), how="left")
    return joined.select(*keys, *(also or {}), *columns)


def _interpolated(values: dict[int, float], rank: float) -> float:
    low = int(rank)
    return values[low] + (values.get(low + 1, values[low]) - values[low]) * (rank - low)


def _meeting(rows: DataFrame, states: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The rows inside the range of a state of their group, with that state."""
    if keys:
        return join_null_safe(rows, states, list(keys)).filter(F.col("_v").between(F.col("_lo"), F.col("_hi")))
    kind = rows.schema["_v"].dataType
    listed = [
        F.struct(
            F.lit(r["_rank"]).cast("bigint").alias("_rank"),
            F.lit(r["_lo"]).cast(kind).alias("_lo"),
            F.lit(r["_hi"]).cast(kind).alias("_hi"),
            F.lit(r["_skip"]).cast("bigint").alias("_skip"),
        )
        for r in states.collect()  # a few ranks of one group
    ]
    if not listed:
        return rows.limit(0).withColumns(
            {"_rank": F.lit(0).cast("bigint"), "_lo": F.col("_v"), "_hi": F.col("_v"), "_skip": F.lit(0).cast("bigint")}
        )
    inside = F.filter(F.array(*listed), lambda s: F.col("_v").between(s["_lo"], s["_hi"]))
    return rows.select("_v", F.inline(inside))


def _narrowed(rows: DataFrame, states: DataFrame, keys: Sequence[str], bins: int) -> DataFrame:
    """Each state's range becomes the smallest and largest value of the bin that holds the rank."""
    share = (F.col("_v") - F.col("_lo")).cast("double") / (F.col("_hi") - F.col("_lo")).cast("double")
    bin_ = F.least(F.floor(share * bins), F.lit(bins - 1))
    counted = (
        _meeting(rows, states, keys)
        .groupBy(*keys, "_rank", "_skip", bin_.alias("_bin"))
        .agg(F.count(F.lit(1)).alias("_in"), F.min("_v").alias("_lo"), F.max("_v").alias("_hi"))
    )
    up_to = Window.partitionBy(*keys, "_rank").orderBy("_bin")  # at most ``bins`` rows
    up_to = F.sum("_in").over(up_to.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    placed = counted.withColumn("_skip", F.col("_skip") + up_to - F.col("_in"))
    here = (F.col("_rank") >= F.col("_skip")) & (F.col("_rank") < F.col("_skip") + F.col("_in"))
    return placed.filter(here).select(*keys, "_rank", "_lo", "_hi", "_skip", "_in")
