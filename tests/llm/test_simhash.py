import random

import numpy as np
import xxhash
from llm import edge
from pyspark.sql import functions as F

from tallywork.llm import simhash
from tallywork.llm.components import smallest_reachable


def _brute_fingerprint(text):
    words = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    for c in "\t\n\x0b\x0c\r":
        words = words.replace(c, " ")
    words = [w for w in words.split(" ") if w]
    shingles = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or (
        [" ".join(words)] if words else []
    )
    hashes = [xxhash.xxh64(s.encode(), seed=42).intdigest() for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def _brute_components(points):
    """Smallest key reachable by links of at most 3 bits, for (key, fingerprint)."""
    root = list(range(len(points)))
    for _ in points:
        for i, (_, a) in enumerate(points):
            for j, (_, b) in enumerate(points):
                if (a ^ b).bit_count() <= 3:
                    root[i] = root[j] = min(root[i], root[j])
    return [
        min((k for (k, _), r in zip(points, root, strict=True) if r == mine and k is not None), default=None)
        for mine in root
    ]


def _close_points(rng, n):
    points = []
    while len(points) < n:
        point = rng.getrandbits(64) if rng.random() < 0.5 or not points else rng.choice(points)
        for _ in range(rng.randint(0, 4)):
            point ^= 1 << rng.randrange(64)
        points.append(point)
    return points


def _signed(x):
    return x - (1 << 64) if x >> 63 else x


def test_fingerprints_and_groups_of_edge_rows(spark):
    found = simhash.near_duplicates(edge.documents(spark)).collect()
    points = [(row[0], _brute_fingerprint(row[1])) for row in edge.ROWS]
    expected = _brute_components(points)
    assert edge.pairs(spark.createDataFrame(found), "doc_id", "fp", "component_id") == sorted(
        ((k, _signed(f), c) for (k, f), c in zip(points, expected, strict=True)), key=repr
    )


def test_spark_hash_is_the_shingle_hash(spark):
    row = spark.range(1).select(F.xxhash64(F.lit("ab çd e")).alias("h")).first()
    assert row.h % 2**64 == xxhash.xxh64("ab çd e".encode(), seed=42).intdigest()


def test_tree_finds_all_within_the_radius():
    rng = random.Random(4)
    points = np.array(sorted(set(_close_points(rng, 300))), dtype=np.uint64)
    query, node = simhash.BKTree(points).within(points, 3)
    found = set(zip(query.tolist(), node.tolist(), strict=True))
    expected = {
        (i, j)
        for i, a in enumerate(points.tolist())
        for j, b in enumerate(points.tolist())
        if (a ^ b).bit_count() <= 3
    }
    assert found == expected


def _components(spark, points, shard_size):
    df = spark.createDataFrame([(_signed(p),) for p in points], "fp bigint")
    rows = smallest_reachable(simhash.links(df, shard_size=shard_size)).collect()
    return {r.node: r.root for r in rows}


def test_components_against_brute_force_also_with_split_shards(spark, many_slices):
    rng = random.Random(5)
    points = sorted(set(_close_points(rng, 150)))
    expected = dict(
        zip(map(_signed, points), _brute_components([(_signed(p), p) for p in points]), strict=True)
    )
    for shard_size in (20_000, 3):
        found = _components(spark, points, shard_size)
        assert {p: found.get(p, p) for p in expected} == expected


def test_long_chains_and_stars(spark):
    chain = [(i, i + 1) for i in range(60)] + [(100, i) for i in range(101, 160)]
    chain += [(5, 5), (None, 3), (0, 1)]
    links = spark.createDataFrame(chain, "a bigint, b bigint")
    found = {r.node: r.root for r in smallest_reachable(links).collect()}
    assert found == {i: 0 for i in range(61)} | {i: 100 for i in range(100, 160)}
    assert smallest_reachable(links.filter("false")).collect() == []


def test_empty_table(spark):
    assert simhash.near_duplicates(edge.empty(spark)).collect() == []
