import hashlib
import math
import random

import numpy as np
import pytest

from tallywork.llm import centroids

SCHEMA = "vec_id bigint, embedding array<double>, cluster string, v string, distance string"


def _brute(rows, k, rounds, dims, scale=64, seed=1):
    kept = []
    for key, vector in rows:
        if vector is None or len(vector) != dims or any(x is None or not math.isfinite(x) for x in vector):
            continue
        most = centroids.largest_component(dims)
        kept.append((key, [max(-most, min(most, math.floor(x * scale))) for x in vector]))
    first = sorted(
        kept,
        key=lambda r: (r[0] is None, hashlib.sha256(f"{seed}:{r[0]}".encode()).hexdigest(), r[1]),
    )
    means = [v for _, v in first[:k]]

    def assigned():
        found = []
        for _, v in kept:
            far = [sum((a - b) ** 2 for a, b in zip(v, c, strict=True)) for c in means]
            found.append((far.index(min(far)), min(far)))
        return found

    for _ in range(rounds):
        found = assigned()
        for c in range(len(means)):
            mine = [v for (_, v), (n, _) in zip(kept, found, strict=True) if n == c]
            if mine:
                means[c] = [sum(column) // len(mine) for column in zip(*mine, strict=True)]
    found = assigned()
    sums = [sum(d for n, d in found if n == c) for c in range(len(means))]
    return [
        (
            key,
            n,
            d,
            sums[n],
            sum(sums),
            hashlib.sha256(",".join(map(str, means[n])).encode()).hexdigest(),
        )
        for (key, _), (n, d) in zip(kept, found, strict=True)
    ]


def _table(spark, rows):
    return spark.createDataFrame([(*r, "a", "b", "c") for r in rows], SCHEMA)


def _found(df, **parameters):
    found = centroids.cluster(df, **parameters)
    return [tuple(r) for r in found.with_inertia().withColumn("digest", found.centroid_digest()).collect()]


ODD = [
    (1, None),
    (2, []),
    (3, [1.0, 2.0]),
    (4, [1.0, None, 0.0]),
    (5, [1.0, float("nan"), 0.0]),
    (6, [1.0, float("-inf"), 0.0]),
    (None, [0.5, 0.5, 0.5]),
    (None, [-0.5, 0.25, 0.5]),
    (7, [1e300, -1e300, 1e18]),
    (8, [-1e300, 1e300, -1e18]),
]


def test_against_brute_force(spark, many_slices):
    rng = random.Random(11)
    rows = [(i, [rng.choice([-1, 0, 1]) / 64 + rng.random() / 32 for _ in range(3)]) for i in range(200)]
    rows += [rows[5], rows[5], *ODD]
    for k, rounds in ((1, 1), (4, 2), (16, 3), (500, 1)):
        expected = _brute(rows, k, rounds, 3)
        assert sorted(_found(_table(spark, rows), k=k, rounds=rounds, dims=3), key=repr) == sorted(
            expected, key=repr
        )


def test_tables_without_vectors(spark):
    assert _found(_table(spark, []), k=4, rounds=2, dims=3) == []
    assert _found(_table(spark, ODD[:6]), k=4, rounds=2, dims=3) == []


@pytest.mark.parametrize("spread", [1, 3, 1000, centroids.largest_component(5)])
def test_tree_finds_the_nearest_point_and_ties(spread):
    rng = np.random.default_rng(spread)
    for n in (1, 2, 3, 4, 7, 40, 300):
        points = rng.integers(-spread, spread + 1, (n, 5))
        rows = np.concatenate([rng.integers(-spread, spread + 1, (300, 5)), points])
        number, far = centroids.VantageTree(points).nearest(rows)
        all_ = ((rows[:, None, :] - points[None, :, :]) ** 2).sum(axis=2)
        assert np.array_equal(far, all_.min(axis=1))
        assert np.array_equal(number, all_.argmin(axis=1))


def test_tree_leaves_out_what_is_too_far(monkeypatch):
    rng = np.random.default_rng(2)
    points = rng.integers(-10_000, 10_000, (256, 2))
    rows = points[rng.integers(0, 256, 500)] + rng.integers(-5, 6, (500, 2))
    tried = []
    plain = centroids.VantageTree._try
    monkeypatch.setattr(
        centroids.VantageTree, "_try", lambda self, rows, who, *rest: (tried.append(len(who)), plain(self, rows, who, *rest))[1]
    )
    centroids.VantageTree(points).nearest(rows)
    assert sum(tried) < 500 * 256 / 5


def test_equal_points_do_not_deepen_the_tree():
    tree = centroids.VantageTree(np.zeros((5000, 4), dtype=np.int64))
    number, far = tree.nearest(np.ones((3, 4), dtype=np.int64))
    assert number.tolist() == [0, 0, 0] and far.tolist() == [4, 4, 4]
