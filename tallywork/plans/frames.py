"""Frames over the rows of a key, for keys and frames of any size.

The rows of a key are numbered and cut into blocks of equal length. A frame of n rows then starts at a
place that is known from the row's number. If it starts in the row's own block, it is a window there.
Otherwise it is what is left of the block it starts in, the whole blocks between, and the row's own
block up to the row. Running totals of the block from its end give the first part; they travel to the
block of the row as rows of a halo, which for a short frame are the last rows of each block. The
middle part is a state per block. Sum, count, maximum and minimum are put together from the three parts.
"""

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallywork.plans.ordered import join_null_safe, order_rows
from tallywork.plans.storage import durable

_NUMBER = "_number"
_BLOCK = "_block"
_HALO = "_halo"
_SHORT = 1000  # rows of a frame that a window evaluates row by row
_EARLIER = (Window.unboundedPreceding, -1)
_SO_FAR = (Window.unboundedPreceding, Window.currentRow)


def _sum_of_parts(a: Column, b: Column) -> Column:
    return F.when(a.isNull(), b).when(b.isNull(), a).otherwise(a + b)


# what a frame can hold: the aggregate, how parts are put together, and how states of blocks are
_KINDS = {
    "sum": (F.sum, _sum_of_parts, F.sum),
    "count": (F.count, _sum_of_parts, F.sum),
    "max": (F.max, F.greatest, F.max),
    "min": (F.min, F.least, F.min),
}
ALL = "all"


@dataclass(frozen=True)
class Frame:
    """A column ``out``: ``kind`` (sum, count, max, min) of ``value`` over some rows of the key.

    ``rows`` is the length of the frame that ends with the row, None for all rows up to it, or ``ALL``.
    """

    out: str
    kind: str
    value: str
    rows: int | str | None = None

    @property
    def moving(self) -> bool:
        return isinstance(self.rows, int)


def keyed_frames(
    df: DataFrame,
    key: str,
    order: Sequence[str],
    frames: Sequence[Frame],
    *,
    slices: int | None = None,
) -> DataFrame:
    """``df`` with a column per frame; ``order`` must be total within a key. NULL keys are one key.

    As in SQL a sum, maximum or minimum is NULL over a frame without values. The rows are cut into about
    ``slices`` blocks, as many as shuffle partitions by default; no task holds more than about two
    blocks per frame length, whatever the sizes of keys and frames.
    """
    slices = slices or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    numbered = order_rows(df, key, order, slices=slices).with_row_number(_NUMBER).rows()
    rows = durable(numbered, "numbered")
    size = max(1, -(-rows.count() // slices))  # the count comes from the files' metadata
    by_size: dict[int, list[Frame]] = {}
    for frame in frames:
        # a long frame within a block would be a slow window: then a block is as long as the frame
        long = frame.moving and _SHORT < frame.rows <= size
        by_size.setdefault(frame.rows - 1 if long else size, []).append(frame)
    for block_size, some in by_size.items():
        rows = _with_frames(rows, key, some, block_size)
    return rows.drop(_NUMBER)


def _with_frames(rows: DataFrame, key: str, frames: Sequence[Frame], size: int) -> DataFrame:
    """Add frames over blocks of ``size`` rows."""
    names = {part: f"_p{i}" for i, part in enumerate(dict.fromkeys((f.kind, f.value) for f in frames))}
    blocked = rows.withColumn(_BLOCK, F.floor((F.col(_NUMBER) - 1) / size))
    # keys of more than one block: each has one row with the number after the first block
    spanning = durable(blocked.filter(F.col(_NUMBER) == size + 1).select(key), "spanning")
    narrow = blocked.select(key, _BLOCK, _NUMBER, *dict.fromkeys(f.value for f in frames))
    narrow = join_null_safe(narrow, spanning, [key])

    lengths = sorted({f.rows for f in frames if f.moving})
    halos = [_left_of_blocks(narrow, key, frames, names, n, size) for n in lengths]
    own = blocked.withColumn(_HALO, F.lit(0))
    dealt = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), [own, *halos])

    # one shuffle by (key, block) serves all windows; the halo's rows stand at the row they are for
    block = Window.partitionBy(key, _BLOCK, _HALO).orderBy(_NUMBER)
    place = Window.partitionBy(key, _BLOCK, _NUMBER)
    dealt = dealt.withColumns(
        {name: F.max(name).over(place) for name in (_left(f, names) for f in frames if f.moving)}
    )

    def inside(frame: Frame) -> Column:
        if frame.rows == ALL:
            over = Window.partitionBy(key, _BLOCK, _HALO)
        elif frame.moving and frame.rows <= min(size, _SHORT):
            over = block.rowsBetween(1 - frame.rows, Window.currentRow)
        else:
            over = block.rowsBetween(*_SO_FAR)
        return _KINDS[frame.kind][0](frame.value).over(over)

    dealt = dealt.withColumns({f"_in_{f.out}": inside(f) for f in frames})
    own = dealt.filter(F.col(_HALO) == 0)
    stateful = [f for f in frames if not f.moving or f.rows - 1 > size]
    if stateful:
        states = _before_blocks(narrow, key, stateful, names, size)
        # at most two rows per slice: a key of m blocks has more than m - 1 blocks of rows
        own = join_null_safe(own, F.broadcast(states), [key, _BLOCK], how="left")
    made = {f.out: _put_together(f, names, size).cast(dealt.schema[f"_in_{f.out}"].dataType) for f in frames}
    kept = [c for c in rows.columns if c not in made]
    return own.withColumns(made).select(*kept, *made)


def _left(frame: Frame, names: dict) -> str:
    return f"_left{frame.rows}{names[frame.kind, frame.value]}"


def _left_of_blocks(narrow, key: str, frames: Sequence[Frame], names: dict, n: int, size: int) -> DataFrame:
    """What each row's block holds from the row on, at the row whose frame of ``n`` rows starts there.

    Only for rows in another block than the frame's last row.
    """
    from_the_end = Window.partitionBy(key, _BLOCK).orderBy(F.col(_NUMBER).desc()).rowsBetween(*_SO_FAR)
    parts = {_left(f, names): f for f in frames if f.rows == n}
    last = F.col(_NUMBER) + n - 1
    return (
        narrow.select(
            key,
            _BLOCK,
            last.alias("_last"),
            F.floor((last - 1) / size).alias("_last_block"),
            *(_KINDS[f.kind][0](f.value).over(from_the_end).alias(name) for name, f in parts.items()),
        )
        .filter(F.col("_last_block") != F.col(_BLOCK))
        .select(
            key,
            F.col("_last_block").alias(_BLOCK),
            F.col("_last").alias(_NUMBER),
            *parts,
            F.lit(n).alias(_HALO),
        )
    )


def _blocks_between(n: int, size: int) -> int:
    """The most whole blocks that a frame of ``n`` rows has between its first and its last block."""
    return max(-(-(n - 1) // size) - 1, 0)


def _before_blocks(narrow, key: str, frames: Sequence[Frame], names: dict, size: int) -> DataFrame:
    """Per block of the keys of several blocks: what the blocks before it hold, for some frames.

    ``_all_`` holds all blocks before, or the whole key. A moving frame that ends in the block has
    one of two numbers of whole blocks before it, ``_more_`` holds the larger number of them and
    ``_fewer_`` one block less.
    """
    blocks = narrow.groupBy(key, _BLOCK).agg(
        *(_KINDS[kind][0](value).alias(name) for (kind, value), name in names.items())
    )
    of_key = Window.partitionBy(key)
    columns = []
    for frame in frames:
        name = names[frame.kind, frame.value]
        add = _KINDS[frame.kind][2](name)
        bounds = {"_all_": _EARLIER}
        if frame.moving:
            most = _blocks_between(frame.rows, size)
            bounds |= {"_more_": (-most, -1), "_fewer_": (1 - most, -1)}
        for label, (first, last) in bounds.items():
            if frame.rows == ALL:
                value = add.over(of_key)
            elif first > last:
                value = F.lit(None).cast(blocks.schema[name].dataType)
            else:
                value = add.over(of_key.orderBy(_BLOCK).rowsBetween(first, last))
            columns.append(value.alias(f"{label}{frame.out}"))
    return blocks.select(key, _BLOCK, F.lit(True).alias("_spans"), *columns)


def _put_together(frame: Frame, names: dict, size: int) -> Column:
    """The value of a frame from what its first block has left, the blocks between and its last block."""
    together = _KINDS[frame.kind][1]
    here = F.col(f"_in_{frame.out}")
    if frame.rows == ALL:
        return F.when(F.col("_spans"), F.col(f"_all_{frame.out}")).otherwise(here)
    if not frame.moving:
        return together(F.col(f"_all_{frame.out}"), here)
    first = F.floor(F.greatest(F.col(_NUMBER) - frame.rows, F.lit(0)) / size)
    value = together(F.col(_left(frame, names)), here)
    if frame.rows - 1 > size:
        between = F.col(_BLOCK) - first - 1
        most = _blocks_between(frame.rows, size)
        middle = F.when(between == most, F.col(f"_more_{frame.out}")).otherwise(F.col(f"_fewer_{frame.out}"))
        cut_off = F.col(_NUMBER) < frame.rows  # by the key's first row
        value = together(F.when(cut_off, F.col(f"_all_{frame.out}")).otherwise(middle), value)
    return F.when(first == F.col(_BLOCK), here).otherwise(value)
