"""A keyed table in parts; an upsert rewrites the parts that it touches."""

import json
import os
import time
import uuid
from collections.abc import Callable
from dataclasses import asdict, dataclass, field
from urllib.parse import urlparse

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tallywork.plans import remove, stored

PART = "_part"
PARTS = 64
KEPT = 3
ATTEMPTS = 20
_PATIENCE = 30.0  # seconds that the record of another writer may take to be written


class Conflict(RuntimeError):
    """Other writers changed the same parts again and again."""


def hashed_part(key: Column) -> Column:
    """One of a fixed number of parts, by a hash of the key."""
    return F.pmod(F.xxhash64(key), F.lit(PARTS)).cast("string")


@dataclass(frozen=True)
class Commit:
    """A version of the table: the folder of every part, and the last batch of every stream in it."""

    version: int = 0
    affected: int = 0
    parts: dict[str, str] = field(default_factory=dict)
    batches: dict[str, int] = field(default_factory=dict)


class Snapshots:
    """Versions of a table under ``path``; the newest committed version is the table.

    ``part`` maps the key to the part that holds it, a short text: a hash by default, or a calendar
    month for a table whose upserts bring recent days. An upsert writes the merged rows of the parts
    that it touches to a folder of its own and only then adds a commit record that names the folder of
    every part, so a failed write stays invisible and readers never see a folder that is being written.

    Any number of writers may work at a time. A version belongs to the writer that creates its record;
    the creation fails if the record exists. A writer that comes second takes the next version if the
    others have touched other parts, and merges again if they have touched the same ones. This needs a
    file system that creates a file only if it is new (HDFS and local or mounted disks do; an object
    store must offer conditional writes).

    The last ``keep`` versions can be read; older records, and what only they need, are deleted.
    What a writer left behind that died before its commit is not looked for. ``schema`` declares the
    table's columns: then it can be read before the first upsert, and the first one may bring some
    columns only.
    """

    def __init__(
        self,
        spark: SparkSession,
        path: str,
        key: str = "period",
        *,
        part: Callable[[Column], Column] = hashed_part,
        keep: int = KEPT,
        schema: StructType | str | None = None,
    ):
        self.spark, self.key, self._part, self._keep = spark, key, part, keep
        self._schema = StructType.fromDDL(schema) if isinstance(schema, str) else schema
        self._data, self._records = f"{path}/data", Records(spark, f"{path}/commits")

    def _commits(self) -> dict[int, Commit]:
        """The versions that are kept."""
        versions = self._records.numbers()[-self._keep :]
        read = {v: self._records.read(v) for v in versions}
        return {v: Commit(**record) for v, record in read.items() if record is not None}

    def _newest(self) -> Commit:
        return max(self._commits().values(), key=lambda c: c.version, default=Commit())

    def version(self) -> int:
        """The newest committed version, 0 before the first."""
        return self._newest().version

    def read(self, version: int | None = None) -> DataFrame:
        """The current rows, or those of one of the versions that are kept."""
        commits = self._commits()
        if version is not None and version not in commits:
            raise KeyError(f"version {version} is not kept")
        if not commits:
            if self._schema is None:
                raise LookupError("the table has no version yet; declare its schema to read it empty")
            return self.spark.createDataFrame([], self._schema)
        return self._rows(commits[max(commits) if version is None else version].parts.values())

    def _rows(self, folders) -> DataFrame:
        folders = [f"{self._data}/{folder}" for folder in folders]
        if not folders:
            return self.spark.createDataFrame([], self._schema)
        reader = self.spark.read.schema(self._schema) if self._schema else self.spark.read
        return reader.parquet(*folders)

    def upsert(
        self,
        rows: DataFrame,
        *,
        batch: tuple[str, int] | None = None,
        merge: Callable[[DataFrame, DataFrame, str], DataFrame] | None = None,
    ) -> int:
        """Insert ``rows``, replacing every row with the same key, and return how many came in.

        ``rows`` may bring some of the columns only: the others stay as they are in known rows and are
        NULL in new ones. Columns that come in replace the old values, NULLs included. An empty input
        changes nothing and returns 0. Keys must be unique within the input. The names of the touched
        parts reach the driver.

        ``batch`` is the name of a stream and the number of its batch; a batch that the table holds
        already, or that comes before one that it holds, changes nothing and returns 0.

        ``merge`` makes the new rows of the touched parts from the old rows, the incoming rows and the
        name of the key, in place of the replacement; for a table with a declared schema.
        """
        merge = merge or replaced
        part = F.coalesce(self._part(F.col(self.key)).cast("string"), F.lit("none"))
        # computed once, read for the check and for every attempt to merge
        rows, incoming = stored(rows.withColumn(PART, part), "incoming")
        try:
            counts = rows.groupBy(PART, self.key).agg(F.count(F.lit(1)).alias("n"))
            seen = counts.groupBy(PART).agg(F.sum("n").alias("rows"), F.max("n").alias("most")).collect()
            if any(r["most"] > 1 for r in seen):
                raise ValueError(f"{self.key} is not unique in the input")
            affected, touched = sum(r["rows"] for r in seen), {r[PART] for r in seen}
            return self._commit(rows, part, affected, touched, batch, merge) if affected or batch else 0
        finally:
            remove(self.spark, incoming)

    def _commit(self, rows, part: Column, affected: int, touched: set[str], batch, merge) -> int:
        """Merge and commit; what others commit meanwhile is kept."""
        base, written = self._newest(), None
        for _ in range(ATTEMPTS):
            if batch and base.batches.get(batch[0], -1) >= batch[1]:
                return 0
            if written is None and affected:
                written = self._merged(base, rows, part, touched, merge)
            new = dict.fromkeys(touched, written) if affected else {}
            commit = Commit(
                base.version + 1,
                affected,
                base.parts | {p: f"{folder}/{PART}={p}" for p, folder in new.items()},
                base.batches | ({batch[0]: batch[1]} if batch else {}),
            )
            if self._records.create(commit.version, asdict(commit)):
                self._forget()
                return affected
            other = self._newest()
            if any(other.parts.get(p) != base.parts.get(p) for p in touched):
                remove(self.spark, f"{self._data}/{written}")  # merged with rows that are no longer the table's
                written = None
            base = other
        raise Conflict(f"no commit after {ATTEMPTS} attempts")

    def _merged(self, base: Commit, rows: DataFrame, part: Column, touched: set[str], merge) -> str:
        """Write the touched parts, merged with the rows of ``base``, to a new folder."""
        folder = uuid.uuid4().hex
        known = [f for p, f in base.parts.items() if p in touched]
        if known or self._schema:
            merged = merge(self._rows(known).withColumn(PART, part), rows, self.key)
        elif base.parts:
            merged = merge(self._rows(base.parts.values()).limit(0).withColumn(PART, part), rows, self.key)
        else:
            merged = rows
        merged.write.partitionBy(PART).parquet(f"{self._data}/{folder}")
        return folder

    def _forget(self) -> None:
        """Delete the records of versions that are no longer kept, and the folders only they name."""
        numbers = self._records.numbers()
        kept, old = numbers[-self._keep :], numbers[: -self._keep]
        needed = {f for v in kept for f in (self._records.read(v) or {"parts": {}})["parts"].values()}
        for version in old:
            record = self._records.read(version)
            for folder in set((record or {"parts": {}})["parts"].values()) - needed:
                remove(self.spark, f"{self._data}/{folder}")
            self._records.remove(version)


class Records:
    """Small numbered files in a folder, each created once by one writer."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")
        self._path = spark._jvm.org.apache.hadoop.fs.Path(self.folder)
        self._files = self._path.getFileSystem(spark._jsc.hadoopConfiguration())
        uri = urlparse(str(self._files.makeQualified(self._path).toString()))
        self._local = uri.path if uri.scheme == "file" else None

    def _place(self, number: int):
        return self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.folder}/{number:020d}.json")

    def numbers(self) -> list[int]:
        """The numbers of the records, in order."""
        if not self._files.exists(self._path):
            return []
        names = (status.getPath().getName() for status in self._files.listStatus(self._path))
        return sorted(int(name.removesuffix(".json")) for name in names if name.endswith(".json") and name[0] != ".")

    def read(self, number: int) -> dict | None:
        """A record, None if it was deleted. Waits for one that its writer has created, but not filled yet."""
        until = time.monotonic() + _PATIENCE
        while True:
            if not self._files.exists(self._place(number)):
                return None
            try:
                text = self._text(number)
            except Exception:
                if self._files.exists(self._place(number)):
                    raise
                return None
            if text.endswith("\n"):
                return json.loads(text)
            if time.monotonic() > until:
                raise RuntimeError(f"record {number} in {self.folder} is unfinished: its writer died; delete it")
            time.sleep(0.05)

    def _text(self, number: int) -> str:
        stream = self._files.open(self._place(number))
        try:
            return self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def create(self, number: int, record: dict) -> bool:
        """Write a record; False if there is one of that number or a later one."""
        if any(n >= number for n in self.numbers()):
            return False
        content = (json.dumps(record) + "\n").encode()
        if self._local:  # Hadoop's local file system looks first and writes then, which two writers can do
            os.makedirs(self._local, exist_ok=True)
            try:
                with open(f"{self._local}/{number:020d}.json", "xb") as file:
                    file.write(content)
            except FileExistsError:
                return False
            return True
        try:
            stream = self._files.create(self._place(number), False)
        except Exception:
            if self._files.exists(self._place(number)):
                return False
            raise
        stream.write(bytearray(content))
        stream.close()
        return True

    def remove(self, number: int) -> None:
        self._files.delete(self._place(number), False)


def replaced(target: DataFrame, rows: DataFrame, key: str) -> DataFrame:
    """Rows of ``target`` with the columns of ``rows`` put in by key, and the new rows added."""
    extra = set(rows.columns) - set(target.columns)
    if extra or key not in rows.columns:
        raise ValueError("the input needs the key and no other columns than the table's")
    new = rows.select(F.struct(*rows.columns).alias("_new"), F.col(key).alias("_key"))
    old = target.select(F.struct(*target.columns).alias("_old"), F.col(key).alias("_old_key"))
    joined = old.join(new, F.col("_old_key").eqNullSafe(F.col("_key")), "full_outer")
    came = F.col("_new").isNotNull()
    return joined.select(
        *(
            F.when(came, F.col(f"_new.{c}").cast(target.schema[c].dataType)).otherwise(F.col(f"_old.{c}")).alias(c)
            if c in rows.columns
            else F.col(f"_old.{c}").alias(c)
            for c in target.columns
        )
    )


def by_month(key: Column) -> Column:
    """The calendar month of a day, for tables whose upserts bring recent days."""
    return F.date_format(key, "yyyy-MM")
