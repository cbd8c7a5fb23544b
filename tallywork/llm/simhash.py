"""SimHash fingerprints of whole texts, and groups of documents with close fingerprints.

A fingerprint bit is set if it is set in more than half of the hashes of the text's word shingles.
Two fingerprints link if they differ in at most ``radius`` bits (3). Links are found with BK-trees:
each child of a node is keyed by its Hamming distance to the node, and a search follows only the
edges whose key lies within the radius of the distance at hand.

One tree over all fingerprints would be unbounded, and a broadcast of it too. The trees are shards:
fingerprints that share two of five blocks of bits form a shard. Three differing bits touch at most
three blocks, so two fingerprints that link share a shard, and no link is lost. A shard with too
many fingerprints for one task is split once more in the same way: over the bits that it does not
share, into four blocks of which one must be equal. Equal fingerprints are one node throughout, so
copies cost nothing, and what a shard returns is a spanning set of its links, never all pairs.
"""

from collections.abc import Iterator
from itertools import chain, combinations, pairwise, repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from xxhash import xxh64_intdigest

from tallywork.llm.components import smallest_reachable
from tallywork.llm.texts import arrow_rows, map_in_arrow
from tallywork.plans import durable

SEED = 42
SHINGLE = 3
RADIUS = 3
_BITS = 64
_FULL = (1 << _BITS) - 1
_BLOCKS = 5
_PIECES = RADIUS + 1
SHARD_SIZE = 20_000
_SPLITS = 2
_AT_ONCE = 2_000_000
# how often each bit is set, for each value of a byte
_BITS_OF_BYTE = ((np.arange(256)[:, None] >> np.arange(8)) & 1).astype(np.int64)
_BYTE_PLACES = (np.arange(8) * 256).astype(np.int64)


def shingle_hashes(text: bytes, shingle: int) -> np.ndarray:
    """Hashes of the word shingles of a whole text in UTF-8, in order; none without words."""
    words = text.lower().split()  # for bytes: A-Z only, and ASCII white space only
    if not words:
        return np.empty(0, dtype="<u8")
    shingles = map(b" ".join, zip(*(words[i:] for i in range(shingle)), strict=False))
    if len(words) < shingle:
        shingles = [b" ".join(words)]
    return np.fromiter(map(xxh64_intdigest, shingles, repeat(SEED)), dtype="<u8")


def fingerprint(text: bytes) -> int:
    """The 64-bit fingerprint of a whole text in UTF-8; 0 for a text without words."""
    return majority(shingle_hashes(text, SHINGLE))


def majority(hashes: np.ndarray) -> int:
    """The bits that are set in more than half of the hashes."""
    ones = np.zeros((8, 256), dtype=np.int64)
    for start in range(0, len(hashes), 65536):  # bounds the memory for a very long text
        by_byte = hashes[start : start + 65536].view(np.uint8).reshape(-1, 8)
        ones += np.bincount((by_byte + _BYTE_PLACES).ravel(), minlength=2048).reshape(8, 256)
    bits = (ones @ _BITS_OF_BYTE).ravel() * 2 > len(hashes)
    return int.from_bytes(np.packbits(bits, bitorder="little").tobytes(), "little")


def fingerprints(docs: DataFrame, *, keep: list[str], text: str = "text") -> DataFrame:
    """Columns ``keep`` and ``fp``, the fingerprint as a signed bigint; one pass, no shuffle."""

    def make(texts: list[bytes]) -> list[pa.Array]:
        found = np.array([fingerprint(t) for t in texts], dtype=np.uint64)
        return [pa.array(found.view(np.int64))]

    return arrow_rows(docs, keep, text, make, "fp bigint")


class BKTree:
    """A BK-tree over distinct fingerprints, with searches for many queries at once."""

    def __init__(self, points: np.ndarray):
        self.points = points
        values = points.tolist()
        children: list[dict[int, int]] = [{} for _ in values]
        for me in range(1, len(values)):
            value, node = values[me], 0
            while True:
                key = (value ^ values[node]).bit_count()
                following = children[node].setdefault(key, me)
                if following == me:
                    break
                node = following
        counts = np.array([len(c) for c in children])
        self.count = counts
        self.start = np.cumsum(counts) - counts
        self.key = np.array([k for c in children for k in c], dtype=np.int64)
        self.child = np.array([n for c in children for n in c.values()], dtype=np.int64)

    def within(self, queries: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
        """Pairs (place of the query, place of the point) that differ in at most ``radius`` bits."""
        query = np.arange(len(queries))
        node = np.zeros(len(queries), dtype=np.int64)
        found = []
        while len(query):
            distance = np.bitwise_count(queries[query] ^ self.points[node]).astype(np.int64)
            close = distance <= radius
            found.append((query[close], node[close]))
            counts = self.count[node]
            query, distance = np.repeat(query, counts), np.repeat(distance, counts)
            first = np.repeat(self.start[node] - (np.cumsum(counts) - counts), counts)
            edge = first + np.arange(len(first))
            follow = np.abs(self.key[edge] - distance) <= radius
            query, node = query[follow], self.child[edge[follow]]
        return tuple(np.concatenate(part) for part in zip(*found, strict=True))


def spanning_links(points: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """For distinct fingerprints: links from a point to the first point of its component.

    Searches go in blocks that bound the memory; links inside a known component are dropped at once.
    """
    tree = BKTree(points)
    root = np.arange(len(points))
    step = max(1, _AT_ONCE // len(points))
    for start in range(0, len(points), step):
        query, node = tree.within(points[start : start + step], radius)
        a, b = root[query + start], root[node]
        fresh = a != b
        for x, y in set(zip(a[fresh].tolist(), b[fresh].tolist(), strict=True)):
            while root[x] != x:
                x = root[x]
            while root[y] != y:
                y = root[y]
            root[max(x, y)] = min(x, y)
        while not np.array_equal(root, root[root]):
            root = root[root]
    linked = np.flatnonzero(root != np.arange(len(points)))
    return points[linked], points[root[linked]]


def _blocks(bits: list[int], n: int) -> list[int]:
    """Masks that cut the given bits into ``n`` runs of about one length."""
    return [sum(1 << bit for bit in part.tolist()) for part in np.array_split(bits, n)]


def _signed(mask: int) -> int:
    return mask - (1 << _BITS) if mask >> (_BITS - 1) else mask


def _first_masks() -> list[int]:
    blocks = _blocks(list(range(_BITS)), _BLOCKS)
    return [a | b for a, b in combinations(blocks, _BLOCKS - RADIUS)]


def _narrower(mask: int) -> list[int]:
    """The masks that split a shard: what it shares, and one of four blocks of the other bits."""
    others = [bit for bit in range(_BITS) if not mask >> bit & 1]
    return [mask | block for block in _blocks(others, _PIECES)]


def _longs(values: list[int]) -> Column:
    return F.array(*(F.lit(_signed(v)).cast("bigint") for v in values))


def _shards(points: DataFrame, shard_size: int) -> DataFrame:
    """(mask, value, fp): the shards of every fingerprint; large shards are split."""

    def keyed(df: DataFrame, masks: Column) -> DataFrame:
        rows = df.select("fp", F.explode(masks).alias("mask"))
        return rows.select("mask", F.col("fp").bitwiseAND(F.col("mask")).alias("value"), "fp")

    masks = _first_masks()
    rows = keyed(points, _longs(masks))
    for _ in range(_SPLITS):
        sizes = rows.groupBy("mask", "value").agg(F.count(F.lit(1)).alias("n"))
        large = durable(sizes.filter(F.col("n") > shard_size).drop("n"), "large-shards")
        if large.isEmpty():
            break
        split = F.create_map(
            *(x for m in masks for x in (F.lit(_signed(m)).cast("bigint"), _longs(_narrower(m))))
        )
        halves = rows.join(large.withColumn("large", F.lit(True)), ["mask", "value"], "left")
        kept = halves.filter(F.col("large").isNull()).select("mask", "value", "fp")
        again = halves.filter("large").select("fp", F.explode(split[F.col("mask")]).alias("mask"))
        again = again.select("mask", F.col("fp").bitwiseAND(F.col("mask")).alias("value"), "fp")
        rows = durable(kept.union(again), "shards")
        masks = [*masks, *(n for m in masks for n in _narrower(m))]
    return rows


def _link_shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Spanning links of shards that come sorted by (mask, value); holds one shard at a time."""
    rest = [np.empty(0, dtype=np.int64)] * 3
    for batch in chain(batches, [None]):  # None: no more rows, the last shard is complete
        if batch is not None:
            new = [batch.column(i).to_numpy() for i in range(3)]
            rest = [np.concatenate(both) for both in zip(rest, new, strict=True)]
        mask, value, fp = rest
        changes = np.flatnonzero((mask[1:] != mask[:-1]) | (value[1:] != value[:-1])) + 1
        borders = [0, *changes.tolist(), *([len(fp)] if batch is None else [])]
        found = [
            spanning_links(fp[start:end].view(np.uint64), RADIUS)
            for start, end in pairwise(borders)
            if end - start > 1
        ]
        rest = [column[borders[-1] :] for column in rest]
        if found:
            a, b = (np.concatenate(part).view(np.int64) for part in zip(*found, strict=True))
            yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], names=["a", "b"])


def links(points: DataFrame, *, shard_size: int = SHARD_SIZE) -> DataFrame:
    """Links (a, b) between distinct fingerprints ``fp`` that join all those within the radius.

    Spanning links per shard: two fingerprints are connected through the result exactly if a chain of
    links within the radius connects them.
    """
    shards = _shards(points, shard_size)
    dealt = shards.repartition("mask", "value").sortWithinPartitions("mask", "value", "fp")
    return map_in_arrow(dealt, _link_shards, "a bigint, b bigint")


def near_duplicates(
    docs: DataFrame, *, key: str = "doc_id", text: str = "text", shard_size: int = SHARD_SIZE
) -> DataFrame:
    """``key``, ``fp`` and ``component_id`` (smallest key reachable by links) of every row.

    Texts are read once; only ids and fingerprints are shuffled. Repeated rows stay. Rows with a NULL
    key take part in links; they can't name a component, and a component of such rows only has a
    NULL id. NULL, empty and blank texts have fingerprint 0 and link like any other. An empty table
    gives an empty result. Other columns are not read, whatever their names.
    """
    rows = durable(
        fingerprints(docs, keep=[key], text=text).select(F.col(key).alias("_key"), "fp"), "fps"
    )
    classes = durable(rows.groupBy("fp").agg(F.min("_key").alias("_least")), "classes")
    roots = smallest_reachable(links(classes.select("fp"), shard_size=shard_size))
    roots = roots.withColumnRenamed("node", "fp")
    rooted = classes.join(roots, "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    least = rooted.groupBy("root").agg(F.min("_least").alias("component_id"))
    found = rooted.join(least, "root").select("fp", "component_id")
    return rows.join(found, "fp").select(F.col("_key").alias(key), "fp", "component_id")
