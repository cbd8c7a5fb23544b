"""Exact top-k search by inner product, with histograms of all scores.

Every query is scored against every row, in blocks: a block of queries of bounded size goes to all
tasks, and each task scores its rows against it with one matrix product per batch. The scores are
not kept. A first pass counts them in a histogram per query; the bin that holds the k-th highest
score becomes the range of the next, finer histogram, and so on until the k-th score itself is known
or so few scores are at or above the bin that they can be listed. The last pass lists the scores from
that border up, each task its own k best at most, and ranks them with ties to the smaller id.

Histograms add up, so a task sends one short array per query whatever its number of rows. A block's
result is stored and its broadcast freed before the next block, so the state beside the tables is
that of one block.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallywork.llm.texts import map_in_arrow
from tallywork.plans.storage import new_folder

BINS = 512
BLOCK = 8192
_STEP_BYTES = 32_000_000  # of the scores that a task holds at a time
_EXACT = float(1 << 53)
_WIDEST = float(1 << 61)


def quantised(df: DataFrame, key: str, vector: str, scale: int) -> DataFrame:
    """``vec_id`` and ``v``: floor(scale * component) as bigints; vectors that take no part are left out.

    Left out: NULL keys, NULL vectors, and vectors that hold a NULL or non-finite component.
    """
    parts = F.transform(F.col(vector), lambda x: x.cast("double"))
    fine = F.forall(parts, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    whole = F.transform(parts, lambda x: F.floor(x * float(scale)))
    return df.filter(F.col(key).isNotNull() & F.col(vector).isNotNull() & fine).select(
        F.col(key).cast("bigint").alias("vec_id"), whole.alias("v")
    )


def _arrays(batch: pa.RecordBatch) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Ids and matrix of the vectors of each length in a batch of (vec_id, v)."""
    ids = batch.column(0).to_numpy(zero_copy_only=False)
    vectors = batch.column(1)
    lengths = vectors.value_lengths().to_numpy(zero_copy_only=False)
    flat = vectors.flatten().to_numpy(zero_copy_only=False)
    starts = np.cumsum(lengths) - lengths
    for length in np.unique(lengths):
        rows = np.flatnonzero(lengths == length)
        yield ids[rows], flat[starts[rows][:, None] + np.arange(length)].astype(np.int64)


def scores(queries: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Integer inner products, one line per query; in float64 where that is exact."""
    if not queries.size or not rows.size:
        return np.zeros((len(queries), len(rows)), dtype=np.int64)
    q, r = queries.astype(np.float64), rows.T.astype(np.float64)
    if np.abs(q).max() * np.abs(r).max() * queries.shape[1] < _EXACT:
        return (q @ r).astype(np.int64)
    return queries @ rows.T


class _Block:
    """Queries of one vector length, as they go to all tasks."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray):
        self.ids, self.vectors = ids, vectors

    def batches(self, batches: Iterator[pa.RecordBatch]):
        """(ids, scores, mask of the pairs that count) for pieces of the rows, bounded by their scores' size."""
        step = max(1, _STEP_BYTES // (8 * max(len(self.ids), 1)))
        for batch in batches:
            for ids, rows in _arrays(batch):
                if rows.shape[1] != self.vectors.shape[1]:
                    continue
                for at in range(0, len(ids), step):
                    piece = ids[at : at + step]
                    found = scores(self.vectors, rows[at : at + step])
                    yield piece, found, self.ids[:, None] != piece[None, :]


def _histograms(
    rows: DataFrame, sent: Broadcast[_Block], low: np.ndarray, width: np.ndarray, k: int
) -> tuple[np.ndarray, np.ndarray]:
    """Per query the highest bin with k or more scores at or above its lower edge, and their number.

    (0, 0) for queries with fewer scores. The last bin also counts the scores above the range.
    """

    def count(batches):
        block = sent.value
        total = np.zeros((len(block.ids), BINS), dtype=np.int64)
        for _, found, counts in block.batches(batches):
            bins = np.minimum((found - low[:, None]) // width[:, None], BINS - 1)
            place = (bins + np.arange(len(bins))[:, None] * BINS)[counts & (bins >= 0)]
            total += np.bincount(place, minlength=total.size).reshape(total.shape)
        q, bin_ = np.nonzero(total)
        columns = [pa.array(q), pa.array(bin_), pa.array(total[q, bin_])]
        yield pa.RecordBatch.from_arrays(columns, names=["q", "bin", "n"])

    parts = map_in_arrow(rows, count, "q bigint, bin bigint, n bigint")
    sums = parts.groupBy("q", "bin").agg(F.sum("n").alias("n"))
    above = F.sum("n").over(Window.partitionBy("q").orderBy(F.col("bin").desc()))
    holds = sums.withColumn("above", above).filter(F.col("above") >= k)
    got = holds.groupBy("q").agg(F.max(F.struct("bin", "above")).alias("top")).collect()
    found, n = np.zeros_like(low), np.zeros_like(low)
    for r in got:
        found[r["q"]], n[r["q"]] = r["top"]
    return found, n


def _borders(
    rows: DataFrame, sent: Broadcast[_Block], k: int, reach: np.ndarray, listed: int
) -> np.ndarray:
    """For each query a score at or below its k-th highest one, found by ever finer histograms.

    ``reach`` bounds the absolute scores. Ends for a query when its bin is one score wide, or when at
    most ``listed`` scores are at or above its bin's lower edge. Scores that may wrap are not narrowed
    down: their tasks send their own k best.
    """
    open_ = reach < _WIDEST
    safe = np.where(open_, reach, 0).astype(np.int64)
    low = np.where(open_, -safe, np.iinfo(np.int64).min)
    width = (2 * safe) // BINS + 1
    while open_.any():
        found, n = _histograms(rows, sent, low, width, k)
        low = np.where(open_, low + found * width, low)
        open_ &= (width > 1) & (n > max(listed, k))
        width = np.where(open_, width // BINS + 1, 1)
    return low


def top_k(
    df: DataFrame,
    *,
    k: int,
    every: int,
    key: str = "vec_id",
    vector: str = "embedding",
    scale: int = 1024,
    block: int = BLOCK,
    listed: int = 64,
) -> DataFrame:
    """The ``k`` highest scores of each query: ``query_id``, ``rank``, ``vec_id``, ``score``.

    Queries are the rows whose key is divisible by ``every``, candidates all rows but those with the
    query's own id; a candidate of another length than the query is no candidate. A query with fewer
    than ``k`` candidates gets them all. Rows with equal scores rank by id; repeated rows rank one
    by one as candidates, and repeated rows of a query are one query (the smallest vector). Vectors
    that are NULL or hold NULL or non-finite components take no part, nor do rows with a NULL id. An
    empty table gives an empty result; other columns are not read. Components beyond the range of a
    bigint are cut to it, and products wrap like bigints.

    ``block`` bounds the queries that are on the driver and in a broadcast at a time.
    """
    spark = df.sparkSession
    rows = quantised(df, key, vector, scale)
    queries = rows.filter(F.col("vec_id") % every == 0).groupBy("vec_id").agg(F.min("v").alias("v"))
    queries = queries.withColumn("d", F.size("v"))
    schema = "query_id bigint, rank int, vec_id bigint, score bigint"
    folder = None
    sizes = F.transform("v", lambda x: F.abs(x.cast("double")))
    largest = rows.agg(F.max(F.array_max(sizes))).first()[0] or 0.0
    after = None
    while True:  # blocks of queries in the order of length and id
        next_ = queries
        if after:
            same = (F.col("d") == after[0]) & (F.col("vec_id") > after[1])
            next_ = queries.filter((F.col("d") > after[0]) | same)
        got = next_.orderBy("d", "vec_id").limit(block).collect()
        if not got:
            break
        after = (got[-1]["d"], got[-1]["vec_id"])
        for d in sorted({r["d"] for r in got}):
            mine = [r for r in got if r["d"] == d]
            vectors = np.array([r["v"] for r in mine], dtype=np.int64).reshape(len(mine), d)
            part = _Block(np.array([r["vec_id"] for r in mine], dtype=np.int64), vectors)
            reach = np.abs(vectors.astype(np.float64)).sum(axis=1) * largest + 1
            sent = spark.sparkContext.broadcast(part)
            low = _borders(rows, sent, k, reach, listed)
            folder = folder or new_folder(spark, "top-k")
            _listed(rows, sent, low, k).write.mode("append").parquet(folder)
            sent.destroy()
    if folder is None:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(folder)


def _listed(rows: DataFrame, sent: Broadcast[_Block], low: np.ndarray, k: int) -> DataFrame:
    """The k best scores of each query: from each task its k best at or above the border, ranked."""

    def best(batches):
        block = sent.value
        kept = np.empty((0, 3), dtype=np.int64)  # place of the query, negative score, id
        for ids, found, counts in block.batches(batches):
            q, at = np.nonzero((found >= low[:, None]) & counts)
            kept = np.concatenate([kept, np.stack([q, -found[q, at], ids[at]], axis=1)])
            kept = kept[np.lexsort((kept[:, 2], kept[:, 1], kept[:, 0]))]
            first = np.searchsorted(kept[:, 0], kept[:, 0])
            kept = kept[np.arange(len(kept)) - first < k]
        columns = [pa.array(block.ids[kept[:, 0]]), pa.array(kept[:, 2]), pa.array(-kept[:, 1])]
        yield pa.RecordBatch.from_arrays(columns, names=["query_id", "vec_id", "score"])

    found = map_in_arrow(rows, best, "query_id bigint, vec_id bigint, score bigint")
    order = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
