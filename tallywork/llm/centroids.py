"""Clustering around centroids in integers, with a vantage-point tree over the centroids.

Each round builds a tree over the centroids and sends it to all tasks. An inner node holds one
centroid, the vantage point, and parts the others by their distance to it, the nearer half from the
farther one; a leaf holds a few centroids. A vector goes down the tree best-first: among its open
nodes it takes the one with the smallest lower bound on the distance, and it stops when that bound is
beyond its best distance so far. A node at the best distance itself is still visited, so ties are
found. Distances to centroids are exact integers; only the bounds are floating-point numbers, with a
margin that is wider than their error.

The vectors of a batch go down side by side, each with its own open nodes. A task adds up its own
vectors by cluster, so that what is shuffled and what reaches the driver does not grow with the table:
at most ``k`` centroids, which is the bound of the broadcast too.
"""

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallywork.llm.texts import map_in_arrow
from tallywork.plans import durable

_LEAF = 3
_STEP_BYTES = 8_000_000  # vectors of a step, in bytes of their differences to one centroid
_MARGIN = 1e-9


def largest_component(dims: int) -> int:
    """Components are cut to this size, so that squared distances fit into a bigint."""
    return int((2**62 / max(dims, 1)) ** 0.5) // 2


def whole_vectors(df: DataFrame, key: str, vector: str, *, dims: int, scale: int) -> DataFrame:
    """``vec_id`` and ``v``: floor(scale * component) as bigints, of the vectors that take part.

    Left out: NULL vectors, vectors of another length, and those with a NULL or non-finite component.
    """
    parts = F.transform(F.col(vector), lambda x: x.cast("double"))
    fine = F.forall(parts, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    most = float(largest_component(dims))
    cut = F.transform(
        parts, lambda x: F.floor(F.greatest(F.least(x * float(scale), F.lit(most)), F.lit(-most)))
    )
    kept = df.filter(F.col(vector).isNotNull() & (F.size(vector) == dims) & fine)
    return kept.select(F.col(key).cast("bigint").alias("vec_id"), cut.alias("v"))


def _squared(rows: np.ndarray, points: np.ndarray) -> np.ndarray:
    """Squared distances along the last axis, in integers."""
    gap = rows - points
    return np.einsum("...i,...i->...", gap, gap)


class VantageTree:
    """A vantage-point tree over the rows of an integer matrix."""

    def __init__(self, points: np.ndarray):
        self.points = points
        self.vantage, self.leaf, self.children, self.rings = [], [], [], []
        self._add(np.arange(len(points)))
        self.vantage = np.array(self.vantage)
        self.children = np.array(self.children)
        self.rings = np.array(self.rings, dtype=float)  # nearest and farthest, of both children
        members = np.full((len(self.leaf), _LEAF), -1)
        for node, some in enumerate(self.leaf):
            members[node, : len(some)] = some
        self.leaf = members

    def _add(self, members: np.ndarray) -> int:
        """Append the node of some points and what is below it; the depth is logarithmic."""
        node = len(self.vantage)
        small = len(members) <= _LEAF
        self.leaf.append(members if small else [])
        self.vantage.append(-1)
        self.children.append((-1, -1))
        self.rings.append(((0, 0), (0, 0)))
        if not small:
            # the point farthest from the first one lies at the rim, where rings are narrow
            at = int(_squared(self.points[members], self.points[members[0]]).argmax())
            vantage, others = members[at], np.delete(members, at)
            far = np.sqrt(_squared(self.points[others], self.points[vantage]).astype(float))
            order = np.argsort(far, kind="stable")
            halves = np.array_split(order, 2)
            self.vantage[node] = vantage
            self.rings[node] = tuple((far[half[0]], far[half[-1]]) for half in halves)
            self.children[node] = tuple(self._add(others[half]) for half in halves)
        return node

    def nearest(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Number and squared distance of each row's nearest point; ties go to the smaller number."""
        best = np.full(len(rows), np.iinfo(np.int64).max)
        number = np.full(len(rows), -1)
        active = np.arange(len(rows))
        bounds, nodes = np.zeros((len(rows), 1)), np.zeros((len(rows), 1), dtype=np.int64)
        while len(active):
            at = bounds.argmin(axis=1)
            lines = np.arange(len(active))
            lowest = bounds[lines, at]
            near = np.sqrt(best[active].astype(float))
            inside = np.isfinite(lowest) & (lowest * (1 - _MARGIN) <= near * (1 + _MARGIN) + _MARGIN)
            if not inside.all():
                active, bounds, nodes = active[inside], bounds[inside], nodes[inside]
                at, lowest = at[inside], lowest[inside]
                lines = np.arange(len(active))
            node = nodes[lines, at]
            bounds[lines, at] = np.inf
            vantage = self.vantage[node]
            ends = np.flatnonzero(vantage < 0)
            for place in range(_LEAF if len(ends) else 0):
                point = self.leaf[node[ends], place]
                some = ends[point >= 0]
                self._try(rows, active[some], self.leaf[node[some], place], best, number)
            inner = np.flatnonzero(vantage >= 0)
            if len(inner):
                far = self._try(rows, active[inner], vantage[inner], best, number)
                below = self._bounds(np.sqrt(far.astype(float)), node[inner], lowest[inner])
                # the first child takes the node's place, the second one a new column
                bounds[inner, at[inner]], nodes[inner, at[inner]] = below[:, 0], self.children[node[inner], 0]
                more = np.full((len(active), 1), np.inf), np.zeros((len(active), 1), dtype=np.int64)
                more[0][inner, 0], more[1][inner, 0] = below[:, 1], self.children[node[inner], 1]
                bounds, nodes = np.hstack([bounds, more[0]]), np.hstack([nodes, more[1]])
        return number, best

    def _try(self, rows, who, point, best, number) -> np.ndarray:
        """Exact distances of some rows to one point each; better points are noted."""
        far = _squared(rows[who], self.points[point])
        better = (far < best[who]) | ((far == best[who]) & (point < number[who]))
        best[who[better]], number[who[better]] = far[better], point[better]
        return far

    def _bounds(self, far: np.ndarray, node: np.ndarray, lowest: np.ndarray) -> np.ndarray:
        """Lower bounds on the distances to both children, from the distance to the vantage point."""
        rings = self.rings[node]
        gap = np.maximum(rings[:, :, 0] - far[:, None], far[:, None] - rings[:, :, 1])
        slack = _MARGIN * (far[:, None] + rings[:, :, 1])
        return np.maximum(gap - slack, lowest[:, None])


def _pieces(batches: Iterator[pa.RecordBatch], dims: int) -> Iterator[tuple[pa.Array, np.ndarray]]:
    """Ids and integer matrices of some rows at a time."""
    step = max(1, _STEP_BYTES // (8 * max(dims, 1)))
    for batch in batches:
        for start in range(0, batch.num_rows, step):
            part = batch.slice(start, step)
            flat = part.column(1).flatten().to_numpy(zero_copy_only=False)
            yield part.column(0), flat.reshape(part.num_rows, dims).astype(np.int64, copy=False)


def _floor_means(rows: DataFrame, centroids: np.ndarray) -> np.ndarray:
    """The next centroids: floors of the exact means of the vectors nearest to each."""
    k, dims = centroids.shape
    sent = rows.sparkSession.sparkContext.broadcast(VantageTree(centroids))

    def add(batches):
        tree = sent.value
        sums, n = np.zeros((k, dims), dtype=np.int64), np.zeros(k, dtype=np.int64)
        most = largest_component(dims)
        room = (2**63 - 1) // most  # so many vectors add up without wrapping
        held = 0

        def taken():
            some = np.flatnonzero(n)
            columns = [pa.array(some), pa.array(n[some]), pa.array(list(sums[some]), pa.list_(pa.int64()))]
            return pa.RecordBatch.from_arrays(columns, names=["cluster", "n", "sums"])

        for _, vectors in _pieces(batches, dims):
            if held + len(vectors) > room:
                yield taken()
                sums[:], n[:], held = 0, 0, 0
            numbers, _ = tree.nearest(vectors)
            np.add.at(sums, numbers, vectors)
            n += np.bincount(numbers, minlength=k)
            held += len(vectors)
        yield taken()

    parts = map_in_arrow(rows, add, "cluster bigint, n bigint, sums array<bigint>")
    exact = parts.select("cluster", "n", F.posexplode("sums").alias("place", "part"))
    totals = exact.groupBy("cluster", "place").agg(
        F.sum(F.col("part").cast("decimal(38,0)")).alias("total"), F.sum("n").alias("n")
    )
    means = centroids.copy()
    for cluster, place, total, n in totals.collect():  # k * dims numbers
        means[cluster, place] = int(total) // n
    sent.unpersist()
    return means


def _first_rows(rows: DataFrame, k: int, seed: int) -> np.ndarray:
    """The ``k`` vectors with the smallest hashed id; without an id last, then by components."""
    text = F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string"))
    first = rows.orderBy(F.sha2(text, 256).asc_nulls_last(), "v").limit(k).collect()
    return np.array([r["v"] for r in first], dtype=np.int64)


@dataclass(frozen=True)
class Clustering:
    """Centroids, and the columns ``vec_id``, ``cluster`` and ``distance`` of the vectors."""

    centroids: np.ndarray
    assigned: DataFrame

    def with_inertia(self) -> DataFrame:
        """Adds ``cluster_inertia`` and ``inertia``, the squared distances summed over each cluster and all.

        A sum that a bigint can't hold is NULL.
        """
        exact = F.sum(F.col("distance").cast("decimal(38,0)"))
        sums = self.assigned.groupBy("cluster").agg(exact.alias("_part"))
        parts = {r["cluster"]: int(r["_part"]) for r in sums.collect()}  # one row per cluster
        listed = {c: (n, sum(parts.values())) for c, n in parts.items()}

        def held(n: int) -> int | None:
            return n if n < 2**63 else None

        rows = [(c, held(n), held(total)) for c, (n, total) in listed.items()]
        schema = "cluster int, cluster_inertia bigint, inertia bigint"
        table = self.assigned.sparkSession.createDataFrame(rows, schema)
        return self.assigned.join(F.broadcast(table), "cluster").select(
            "vec_id", "cluster", "distance", "cluster_inertia", "inertia"
        )

    def centroid_digest(self) -> Column:
        """SHA-256 of the components of a row's centroid, as decimal integers with commas between."""
        digests = [
            hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in self.centroids.tolist()
        ]
        return F.get(F.array(*map(F.lit, digests)), F.col("cluster"))


def cluster(
    df: DataFrame,
    *,
    k: int,
    rounds: int,
    dims: int,
    key: str = "vec_id",
    vector: str = "embedding",
    scale: int = 64,
    seed: int = 1,
) -> Clustering:
    """Assign every vector to the nearest of ``k`` centroids after ``rounds`` rounds of means.

    Components become floor(scale * x); the first centroids are the vectors with the smallest SHA-256
    of "seed:id". In each round every centroid that has vectors moves to the floor of their mean.
    Nearest is by squared Euclidean distance, ties go to the smaller number.

    NULL vectors, other lengths than ``dims`` and NULL or non-finite components take no part;
    neither does a table without any other rows, which gives an empty result. With fewer than ``k``
    vectors each is a centroid. Repeated rows count one by one and can both be first centroids. Rows
    with a NULL id take part, as first centroids only after all others. Components beyond
    ``largest_component(dims)`` are cut to it. Other columns are not read, whatever their names. ``k
    * dims`` numbers are on the driver and in each broadcast; the table is read ``rounds`` + 2
    times.
    """
    rows = whole_vectors(df, key, vector, dims=dims, scale=scale)
    centroids = _first_rows(rows, k, seed)
    schema = "vec_id bigint, cluster int, distance bigint"
    if not len(centroids):
        return Clustering(centroids, df.sparkSession.createDataFrame([], schema))
    for _ in range(rounds):
        centroids = _floor_means(rows, centroids)
    sent = df.sparkSession.sparkContext.broadcast(VantageTree(centroids))

    def assign(batches):
        tree = sent.value
        for ids, vectors in _pieces(batches, dims):
            numbers, far = tree.nearest(vectors)
            columns = [ids, pa.array(numbers.astype(np.int32)), pa.array(far)]
            yield pa.RecordBatch.from_arrays(columns, names=["vec_id", "cluster", "distance"])

    return Clustering(centroids, durable(map_in_arrow(rows, assign, schema), "clusters"))
