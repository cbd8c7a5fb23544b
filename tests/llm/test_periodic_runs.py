import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from llm import edge

from tallywork.llm import periodic_runs
from tallywork.llm.periodic_runs import Run, collapse, find_runs, lyndon_array


def brute_runs(words, shortest=24, periods=3):
    """All runs, by a look at every period: maximal stretches of equal pairs, smallest period only."""
    n, found, seen = len(words), [], set()
    for q in range(1, n // periods + 1):
        at = 0
        while at + q < n:
            if words[at] != words[at + q]:
                at += 1
                continue
            end = at
            while end + q < n and words[end] == words[end + q]:
                end += 1
            length = end + q - at
            if length >= 2 * q and (at, length) not in seen:
                seen.add((at, length))
                if length >= max(shortest, periods * q):
                    found.append(Run(at, length, q))
            at = end
    return sorted(found, key=lambda r: (r.start, r.period))


def brute_collapse(words, runs):
    return [
        w
        for i, w in enumerate(words)
        if not any(r.start + r.period <= i < r.start + r.length for r in runs)
    ]


def _brute_lyndon(words):
    n = len(words)

    def lyndon(a, b):
        part = words[a:b]
        return all(part < part[i:] for i in range(1, len(part)))

    return [max(b - a for b in range(a + 1, n + 1) if lyndon(a, b)) for a in range(n)]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.integers(0, 2), min_size=1, max_size=22))
def test_lyndon_arrays_of_both_orders(words):
    assert lyndon_array(words, 3) == _brute_lyndon(words)
    turned = [2 - w for w in words]
    assert lyndon_array(turned, 3) == _brute_lyndon(turned)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(0, 1), min_size=1, max_size=60), st.sampled_from([(2, 2), (4, 2), (6, 3), (24, 3)]))
def test_runs_of_random_words(words, least):
    assert find_runs(words, *least) == brute_runs(words, *least)


def _periodic(rng, n, kinds):
    words = []
    while len(words) < n:
        if rng.random() < 0.5:
            root = [rng.randrange(kinds) for _ in range(rng.randint(1, 20))]
            words += (root * 9)[: rng.randint(len(root), 9 * len(root))]
        else:
            words += [rng.randrange(kinds) for _ in range(rng.randint(1, 30))]
    return words


def test_runs_of_periodic_words():
    rng = random.Random(7)
    some = 0
    for kinds in (1, 2, 3, 10, 1000) * 8:
        words = _periodic(rng, rng.randint(10, 600), kinds)
        runs = find_runs(words)
        assert runs == brute_runs(words)
        assert collapse(words, runs) == brute_collapse(words, runs)
        some += len(runs)
    assert some > 50


def test_nested_and_touching_runs():
    word = [1, 1, 1, 1, 2]
    for words in (word * 12, [1] * 40, [3] + [1] * 30 + [2] + [1] * 30, [1, 2] * 20 + [2, 1] * 20, word * 12 + [1] * 30):
        assert find_runs(words) == brute_runs(words)


def test_equal_hashes_lose_nothing(monkeypatch):
    monkeypatch.setattr(periodic_runs, "_SEED", np.uint64(0))
    words = _periodic(random.Random(8), 400, 50)
    assert find_runs(words) == brute_runs(words)


def test_extensions():
    rng = random.Random(9)
    words = np.array(_periodic(rng, 300, 2))
    places = [(rng.randrange(301), rng.randrange(301)) for _ in range(500)]
    a, b = map(np.array, zip(*places, strict=True))
    extensions = periodic_runs.Extensions(words)
    for x, y, right, left in zip(a, b, extensions.right(a, b), extensions.left(a, b), strict=True):
        u, v = words[x:], words[y:]
        equal = [p == q for p, q in zip(u, v, strict=False)]
        assert right == (equal + [False]).index(False)
        equal = [p == q for p, q in zip(words[:x][::-1], words[:y][::-1], strict=False)]
        assert left == (equal + [False]).index(False)


def test_odd_rows(spark):
    found = periodic_runs.detect_runs(edge.documents(spark), keep=["doc_id", "text"]).collect()
    assert len(found) == len(edge.ROWS)
    for r in found:
        words = (r.text or "").encode().split()
        assert r.n_words == len(words)
        if r.text == edge.LONG:
            assert [tuple(run) for run in r.runs] == [(0, len(words), 5)]
            assert r.collapsed == "lorem ipsum dolor sit amet"
        else:
            assert r.runs == []
    assert periodic_runs.detect_runs(edge.empty(spark), keep=["doc_id"]).collect() == []


def test_clashing_names_and_parameters(spark):
    with pytest.raises(ValueError, match="collapsed"):
        periodic_runs.detect_runs(edge.documents(spark).withColumnRenamed("ids", "collapsed"), keep=["collapsed"])
    with pytest.raises(ValueError, match="two periods"):
        find_runs([1, 1, 1], 3, 1)
