import re
from collections import defaultdict

from llm import edge

from tallywork.llm import mixing


def _targets(sizes, weights=(3, 1, 2), share=1.5, epochs=2):
    """Water-filling by small steps of redistribution."""
    names = sorted((n for n in sizes if n is not None), key=lambda n: n.encode())
    names += [None] if None in sizes else []
    weight = {n: weights[i % len(weights)] for i, n in enumerate(names)}
    target = dict.fromkeys(names, 0.0)
    left = share * sum(sizes.values())
    while left > 1e-9:
        room = [n for n in names if target[n] < epochs * sizes[n] - 1e-12]
        if not room:
            break
        given = {n: left * weight[n] / sum(weight[m] for m in room) for n in room}
        left = 0.0
        for n in room:
            target[n] += given[n]
            over = max(0.0, target[n] - epochs * sizes[n])
            target[n] -= over
            left += over
    return target


def _check(df, rows):
    sizes = defaultdict(int)
    for _, text, source in rows:
        sizes[source] += len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))
    target = _targets(sizes)
    plan = mixing.plan_mix(df)
    found = mixing.mix(df, plan, keep=["doc_id", "source"]).collect()
    assert len(found) == len(rows)
    taken, largest = defaultdict(int), defaultdict(int)
    for r in found:
        assert r.source_size == sizes[r.source]
        assert abs(r.target - target[r.source]) < 1e-6
        assert 0 <= r.taken <= 2 * r.size
        taken[r.source] += r.taken
        largest[r.source] = max(largest[r.source], r.size)
    return taken, target, largest, found


def test_words_come_near_the_targets_and_reruns_agree(spark):
    rows = []
    for i in range(600):
        source = None if i % 29 == 0 else "abcdefg"[min(i % 17, 6)]
        rows.append((i, "w " * (1 + (i * 7919) % 97), source))
    rows.append((600, "v " * 40_000, "B"))
    df = spark.createDataFrame(rows, "doc_id bigint, text string, source string")
    taken, target, largest, found = _check(df, rows)
    for source, wanted in target.items():
        assert abs(taken[source] - wanted) <= largest[source] / 2 + 1
    again = mixing.mix(df.repartition(5), mixing.plan_mix(df.repartition(3)), keep=["doc_id"])
    assert sorted((r.doc_id, r.taken) for r in again.collect()) == sorted(
        (r.doc_id, r.taken) for r in found
    )
    repeated = mixing.repeat_rows(df, mixing.plan_mix(df))
    assert repeated.columns == df.columns
    times = {r.doc_id: r.times for r in found}
    counts = {r["doc_id"]: r["count"] for r in repeated.groupBy("doc_id").count().collect()}
    assert counts == {k: n for k, n in times.items() if n}


def test_edges(spark):
    df = edge.documents(spark)
    taken, target, largest, _ = _check(df, [(r[0], r[1], r[3]) for r in edge.ROWS])
    for source, wanted in target.items():
        assert abs(taken[source] - wanted) <= largest[source] + 1
    empty = edge.empty(spark)
    assert mixing.mix(empty, mixing.plan_mix(empty), keep=["doc_id"]).collect() == []
    assert mixing.repeat_rows(empty, mixing.plan_mix(empty)).collect() == []
    blank = df.filter("doc_id in (2, 3, 4)")
    assert {r.taken for r in mixing.mix(blank, mixing.plan_mix(blank), keep=["doc_id"]).collect()} == {0}


def test_seeds_differ_and_no_fractions_when_all_is_capped(spark):
    rows = [(i, "w " * 10, "a") for i in range(100)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, source string")
    one, two = (
        {r.doc_id: r.taken for r in mixing.mix(df, mixing.plan_mix(df, seed=s), keep=["doc_id"], seed=s).collect()}
        for s in (1, 2)
    )
    assert one != two and sum(one.values()) == sum(two.values()) == 1500
    full = mixing.mix(df, mixing.plan_mix(df, share=9), keep=["doc_id"]).collect()
    assert {r.taken for r in full} == {20}


def test_texts_without_words_are_taken_no_more_often_than_others(spark):
    """A source at its cap takes all documents twice, those without words too."""
    rows = [(i, "w " * (i % 3), "a" if i % 10 else "b") for i in range(300)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, source string")
    found = mixing.mix(df, mixing.plan_mix(df), keep=["doc_id"]).collect()
    assert max(r.times for r in found) == mixing.EPOCHS
