"""Tables laid out by calendar month, so that a time range reads only its months."""

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, StructField, StructType

from tallywork.functions import moment, month_of

MONTH = "event_month"


def write_by_month(
    df: DataFrame,
    path: str,
    *,
    time: str = "event_at",
    unique: str = "event_id",
    mode: str = "error",
) -> None:
    """Write ``df`` in one folder per month; ``mode="append"`` adds rows to the table.

    Rows are range-partitioned by time, so a month of any size is written by as many tasks as it
    needs, each task touches few months, and files hold narrow time ranges.
    """
    rows = df.withColumn(MONTH, month_of(F.col(time)))
    rows = rows.repartitionByRange(MONTH, time, unique).sortWithinPartitions(MONTH, time, unique)
    rows.write.partitionBy(MONTH).mode(mode).parquet(path)


def read_months(
    spark: SparkSession,
    path: str,
    lo: datetime,
    hi: datetime,
    *,
    schema,
    time: str = "event_at",
    columns: Sequence[str] = ("*",),
) -> DataFrame:
    """Rows with ``lo <= time < hi``; only the folders of those months are listed and read.

    ``schema`` is that of the frame that was written.
    """
    with_month = StructType([*schema, StructField(MONTH, DateType())])
    stored = spark.read.schema(with_month).parquet(path)
    kind = with_month[time].dataType
    months = F.col(MONTH).between(F.lit(lo.date().replace(day=1)), F.lit(hi.date()))
    inside = (F.col(time) >= moment(lo, kind)) & (F.col(time) < moment(hi, kind))
    return stored.filter(months & inside).select(*columns)
