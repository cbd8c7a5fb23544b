"""A table that takes in only rows which keep its rules; the others go to quarantine with their reasons."""

import uuid
from collections.abc import Mapping, Sequence
from dataclasses import asdict, dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, StringType, StructType

from tallywork.plans import remove, stored
from tallywork.sources.snapshots import ATTEMPTS, KEPT, Conflict, Records
from tallywork.sources.tables import Check, ForeignKey, Unique

BUCKET = "_bucket"
BUCKETS = 64
BROKEN = "broken"
_STATE = "_state"
_ROW = "_row"
_REASONS = ArrayType(StringType())


@dataclass(frozen=True)
class Load:
    """A version of the table: the folders of all loads in it."""

    version: int = 0
    folders: list[str] = field(default_factory=list)


class CheckedTable:
    """The table ``name`` under ``path``, with those of ``rules`` that are about it.

    Rows lie in buckets by a hash of the first unique column, so that incoming keys are probed in
    the buckets that they fall into. ``append`` judges every row, parts good from broken ones in one
    write and then adds a record that names the new folder, as ``Snapshots`` does; a load whose
    record another writer was faster with is judged again, since that writer may have brought the
    same keys.
    """

    def __init__(
        self,
        spark: SparkSession,
        path: str,
        name: str,
        rules: Sequence[Check | Unique | ForeignKey],
        *,
        schema: StructType | str,
        buckets: int = BUCKETS,
    ):
        self.spark, self.name, self._buckets = spark, name, buckets
        self._schema = StructType.fromDDL(schema) if isinstance(schema, str) else schema
        self._data, self._records = f"{path}/data", Records(spark, f"{path}/loads")
        mine = [r for r in rules if r.table == name]
        self._checks = [r for r in mine if isinstance(r, Check)]
        self._unique = [r for r in mine if isinstance(r, Unique)]
        self._foreign = [r for r in mine if isinstance(r, ForeignKey)]
        if not self._unique:
            raise ValueError("the rules name no unique column to lay the table out by")

    def _newest(self) -> Load:
        for number in reversed(self._records.numbers()):
            record = self._records.read(number)
            if record is not None:
                return Load(**record)
        return Load()

    def _folder(self, load: Load, state: str, schema: StructType) -> DataFrame:
        if not load.folders:
            return self.spark.createDataFrame([], schema)
        base = [f"{self._data}/{folder}/{_STATE}={state}" for folder in load.folders]
        places = [p for p in base if self._exists(p)]
        if not places:
            return self.spark.createDataFrame([], schema)
        # one reader per load, so that the bucket is a partition column of each
        return reduce(DataFrame.unionByName, (self.spark.read.schema(schema).parquet(p) for p in places))

    def _exists(self, path: str) -> bool:
        place = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return place.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(place)

    def _kept(self, load: Load) -> DataFrame:
        return self._folder(load, "good", StructType([*self._schema]).add(BUCKET, IntegerType()))

    def read(self) -> DataFrame:
        """The rows that were taken in."""
        return self._kept(self._newest()).select(*self._schema.names)

    def quarantine(self) -> DataFrame:
        """The rows that were not, with the names of the rules that they break in ``broken``."""
        schema = StructType([*self._schema]).add(BROKEN, _REASONS).add(BUCKET, IntegerType())
        return self._folder(self._newest(), "broken", schema).select(*self._schema.names, BROKEN)

    def append(self, rows: DataFrame, parents: Mapping[str, DataFrame]) -> tuple[int, int]:
        """Take in the good ones of ``rows``; returns the numbers of good and of broken rows.

        A check that is NULL holds, as in SQL; NULLs break no unique or foreign key. A foreign key
        looks its values up in ``parents``; one into the table itself finds the keys of the table
        and of the load. Of rows with the same unique value, the first one that breaks nothing else
        goes in, and only if the table does not hold the value; which of equally good rows is first
        is fixed when the load begins. Columns that the load lacks are NULL.
        """
        columns = [
            (F.col(f.name) if f.name in rows.columns else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in self._schema
        ]
        extra = set(rows.columns) - set(self._schema.names)
        if extra:
            raise ValueError(f"columns that the table lacks: {sorted(extra)}")
        bucket = F.pmod(F.xxhash64(self._unique[0].column), F.lit(self._buckets)).cast("int")
        numbered = rows.select(*columns).withColumn(_ROW, F.monotonically_increasing_id())
        load, incoming = stored(numbered.withColumn(BUCKET, bucket), "load")
        try:
            return self._append(load, parents)
        finally:
            remove(self.spark, incoming)

    def _append(self, load: DataFrame, parents: Mapping[str, DataFrame]) -> tuple[int, int]:
        for _ in range(ATTEMPTS):
            base, folder = self._newest(), uuid.uuid4().hex
            good, broken = self._write(self._judged(load, self._kept(base), parents), folder)
            new = Load(base.version + 1, [*base.folders, folder])
            if self._records.create(new.version, asdict(new)):
                for old in self._records.numbers()[:-KEPT]:
                    self._records.remove(old)
                return good, broken
            remove(self.spark, f"{self._data}/{folder}")
        raise Conflict(f"no load after {ATTEMPTS} attempts")

    def _judged(self, load: DataFrame, kept: DataFrame, parents: Mapping[str, DataFrame]) -> DataFrame:
        """``load`` with the names of the rules that each row breaks."""
        reasons = [
            F.when(~F.coalesce(F.expr(rule.condition), F.lit(True)), F.lit(rule.name)) for rule in self._checks
        ]
        rows = load
        for i, rule in enumerate(self._foreign):
            own = rule.parent == self.name
            keys = kept.select(rule.key).union(load.select(rule.key)) if own else parents[rule.parent].select(rule.key)
            missing = _values(load, rule.column).join(
                keys.withColumnRenamed(rule.key, "_value"), "_value", "left_anti"
            )
            rows, broken = _marked(rows, rule.column, missing, f"_foreign{i}")
            reasons.append(F.when(broken, F.lit(rule.name)))
        for i, rule in enumerate(self._unique):
            rows, broken = _marked(rows, rule.column, self._taken(load, kept, rule, first=i == 0), f"_taken{i}")
            reasons.append(F.when(broken, F.lit(rule.name)))
        names = F.filter(F.array(*reasons), lambda name: name.isNotNull())
        judged = rows.withColumn(BROKEN, names).select(*load.columns, BROKEN)

        # among the rows that break nothing so far, the first of each unique value
        fine = judged.filter(F.size(BROKEN) == 0)
        for i, rule in enumerate(self._unique):
            firsts = fine.filter(F.col(rule.column).isNotNull()).groupBy(F.col(rule.column).alias("_value"))
            firsts = firsts.agg(F.min(_ROW).alias(f"_first{i}"), F.count(F.lit(1)).alias("_n"))
            firsts = firsts.filter("_n > 1").drop("_n")
            judged = judged.join(firsts, judged[rule.column] == firsts["_value"], "left").drop("_value")
        later = [
            F.when((F.size(BROKEN) == 0) & (F.col(_ROW) > F.col(f"_first{i}")), F.lit(rule.name))
            for i, rule in enumerate(self._unique)
        ]
        again = F.filter(F.array(*later), lambda name: name.isNotNull())
        return judged.withColumn(BROKEN, F.concat(BROKEN, again)).select(*load.columns, BROKEN)

    def _taken(self, load: DataFrame, kept: DataFrame, rule: Unique, *, first: bool) -> DataFrame:
        """The values of a unique column in the load that the table holds."""
        if not first:
            return _values(load, rule.column).join(
                kept.select(F.col(rule.column).alias("_value")), "_value", "left_semi"
            )
        buckets = [r[0] for r in load.select(BUCKET).distinct().collect()]  # as many as buckets
        known = kept.filter(F.col(BUCKET).isin(buckets)).select(BUCKET, F.col(rule.column).alias("_value"))
        wanted = load.filter(F.col(rule.column).isNotNull()).select(BUCKET, F.col(rule.column).alias("_value"))
        return wanted.distinct().join(known, [BUCKET, "_value"], "left_semi").select("_value")

    def _write(self, judged: DataFrame, folder: str) -> tuple[int, int]:
        """Good and broken rows into folders of their own, in one write, ordered by bucket and key."""
        state = F.when(F.size(BROKEN) == 0, "good").otherwise("broken")
        key = self._unique[0].column
        rows = judged.drop(_ROW).withColumn(_STATE, state)
        rows = rows.repartitionByRange(_STATE, BUCKET, key, F.xxhash64(*self._schema.names))
        rows = rows.sortWithinPartitions(_STATE, BUCKET, key)
        path = f"{self._data}/{folder}"
        rows.write.partitionBy(_STATE, BUCKET).parquet(path)
        written = StructType([*self._schema]).add(BROKEN, _REASONS).add(_STATE, "string").add(BUCKET, IntegerType())
        counts = self.spark.read.schema(written).parquet(path).groupBy(_STATE).count().collect()
        found = {r[_STATE]: r["count"] for r in counts}
        return found.get("good", 0), found.get("broken", 0)

    def compact(self) -> int:
        """Write the table anew as one load with whole files; returns how many loads it was.

        Readers of the loads before go on; their files stay until ``forget``.
        """
        base, folder = self._newest(), uuid.uuid4().hex
        if len(base.folders) < 2:
            return len(base.folders)
        good = self._kept(base).withColumn(BROKEN, F.lit(None).cast(_REASONS))
        broken = self.quarantine().withColumn(BUCKET, F.lit(0))
        judged = good.unionByName(broken).withColumn(_ROW, F.lit(0))
        judged = judged.withColumn(BROKEN, F.coalesce(BROKEN, F.array().cast(_REASONS)))
        self._write(judged, folder)
        new = Load(base.version + 1, [folder])
        if not self._records.create(new.version, asdict(new)):
            remove(self.spark, f"{self._data}/{folder}")
            raise Conflict("a load came in meanwhile")
        return len(base.folders)

    def forget(self) -> None:
        """Delete the folders that the newest version does not name; nobody may be reading or loading."""
        needed = set(self._newest().folders)
        for number in self._records.numbers()[:-1]:
            record = self._records.read(number)
            for folder in set(record["folders"] if record else ()) - needed:
                remove(self.spark, f"{self._data}/{folder}")
            self._records.remove(number)


def _values(rows: DataFrame, column: str) -> DataFrame:
    """The distinct values of a column; NULL is none."""
    return rows.select(F.col(column).alias("_value")).filter("_value IS NOT NULL").distinct()


def _marked(rows: DataFrame, column: str, values: DataFrame, mark: str) -> tuple[DataFrame, Column]:
    """Join a mark to the rows that hold one of some distinct values."""
    marked = values.withColumn(mark, F.lit(True)).withColumnRenamed("_value", f"_value{mark}")
    joined = rows.join(marked, rows[column] == F.col(f"_value{mark}"), "left").drop(f"_value{mark}")
    return joined, F.col(mark)
