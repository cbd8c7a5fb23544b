"""The daily summary of a stream of orders."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.query import StreamingQuery

from tallywork.operators.rollups import daily_cells, merged_cells, summary_of_cells
from tallywork.sources import Snapshots

_SCHEMA = (
    "cell string, day date, bucket bigint, users binary, orders bigint, "
    "revenue decimal(38,6), profit decimal(38,6)"
)
_KEYS = ("cell", "day", "bucket")


class CellTable:
    """Daily cells under ``path`` that batches of orders are added to, each batch once.

    A batch is merged into the cells of its days, month by month. Its number is part of the commit, so a
    batch that comes again after a failure changes nothing. Several streams may add to one table, each
    under its own name.
    """

    def __init__(self, spark: SparkSession, path: str):
        self._table = Snapshots(
            spark, path, "cell", part=lambda cell: F.substring(cell, 1, 7), schema=_SCHEMA
        )

    def add(self, revenue: DataFrame, stream: str, batch: int) -> int:
        """Add a batch of order revenue; returns the number of cells it touched, 0 if it was in already."""
        cell = F.concat_ws("|", F.col("day").cast("string"), F.col("bucket").cast("string"))
        cells = daily_cells(revenue).select(cell.alias("cell"), "*")
        return self._table.upsert(cells, batch=(stream, batch), merge=_added)

    def cells(self) -> DataFrame:
        return self._table.read()

    def summary(self, granularity: str = "day") -> DataFrame:
        """The revenue summary of all that was added."""
        return summary_of_cells(self.cells(), granularity)


def _added(target: DataFrame, rows: DataFrame, key: str) -> DataFrame:
    """Cells of the table and of a batch put together."""
    part = [c for c in target.columns if c not in _SCHEMA_NAMES]
    return merged_cells(target.unionByName(rows), *_KEYS, *part)


_SCHEMA_NAMES = tuple(column.split()[0] for column in _SCHEMA.split(", "))


def stream_cells(revenue: DataFrame, table: CellTable, *, name: str, checkpoint: str) -> StreamingQuery:
    """Start adding a stream of order revenue to the cells, one commit per micro-batch.

    ``checkpoint`` is the stream's own folder in shared storage. Takes all that is there and ends.
    """

    def add(batch: DataFrame, number: int) -> None:
        table.add(batch, name, number)

    writer = revenue.writeStream.foreachBatch(add).option("checkpointLocation", checkpoint)
    return writer.trigger(availableNow=True).start()
