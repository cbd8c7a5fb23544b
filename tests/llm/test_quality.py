import math
import re
import string
import zlib

import numpy as np
import pytest
from conftest import SF_DIR
from llm import edge

from tallywork.llm import quality, rules, stats


def _good(i):
    return f"The quick brown fox number {i} walks over the lazy dog, and sees the river. " * 3


def _bad(i):
    return f"BUY## NOW!!! $$${i}$$ | CLICK && HERE ### " * 4


def _tables(spark, n=400):
    docs = [(i, _good(i) if i % 2 else _bad(i), "junk") for i in range(n)]
    labels = [(i, i % 2, 0) for i in range(n)] + [(1, 0, 0), (None, 1, 0), (3, None, 0)]
    return (
        spark.createDataFrame(docs, "doc_id bigint, text string, score string"),
        spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int"),
    )


def test_held_out_documents_are_told_apart(spark):
    docs, labels = _tables(spark)
    model = quality.fit_quality(docs, labels, rows=150)
    found = quality.score_quality(docs, model, keep=["doc_id"]).collect()
    held = [r for r in found if zlib.crc32(str(r.doc_id).encode()) % 5 == 0]
    assert len(found) == 400 and len(held) > 40
    assert all((r.score >= quality.THRESHOLD) == (r.doc_id % 2 == 1) for r in held)
    assert all(0 <= r.score <= 1 for r in found)


def test_held_out_and_contradicting_labels_are_not_learnt(spark):
    docs, labels = _tables(spark)
    x, y = stats.labelled_sample(docs, labels, "quality", 1000)
    usable = [i for i in range(400) if zlib.crc32(str(i).encode()) % 5 and i not in (1,)]
    assert len(x) == len(y) == len(usable)
    few, _ = stats.labelled_sample(docs, labels, "quality", 37)
    assert len(few) == 37


def test_score_is_the_difference_of_log_densities():
    rng = np.random.default_rng(0)
    x = np.concatenate([rng.normal(0, 1, (200, 3)), rng.normal(1, 2, (100, 3))])
    y = np.repeat([0, 1], [200, 100])
    model = quality.fit(x, y, to_pooled=0, to_identity=0, temperature=1)
    z = (x - x.mean(axis=0)) / x.std(axis=0)
    log = []
    for k in (0, 1):
        mean, cov = z[y == k].mean(axis=0), np.cov(z[y == k], rowvar=False)
        d = z - mean
        inside = np.einsum("ij,jk,ik->i", d, np.linalg.inv(cov), d)
        log.append(np.log((y == k).mean()) - 0.5 * (inside + np.log(np.linalg.det(cov))))
    np.testing.assert_allclose(model.score(x), 1 / (1 + np.exp(log[0] - log[1])), atol=1e-9)


def _brute_statistics(text):
    """The statistics of a text, counted character by character."""
    text = text or ""
    words = [w for w in re.split("[ \t\n\x0b\x0c\r]+", text) if w]
    if not words:
        return [0.0] * len(stats.STATISTICS)
    size, n = len(text.encode()), len(words)
    ascii_ = [c for c in text if ord(c) < 128]
    kinds = {
        "upper": string.ascii_uppercase,
        "lower": string.ascii_lowercase,
        "digits": string.digits,
        "symbols": "#*$%&|<>",
        "marks": "!?",
        "stops": ".,;:",
        "white": " \t\n\x0b\x0c\r",
    }
    part = {k: sum(c in chars for c in ascii_) / size for k, chars in kinds.items()}
    # bytes that no kind counts, less the later bytes of characters twice
    later = sum(len(c.encode()) - 1 for c in text) / size
    lines = [x for x in text.split("\n") if any(c not in kinds["white"] for c in x)]
    windows = [tuple(words[i : i + 5]) for i in range(n - 4)]
    repeated = {i + k for i, w in enumerate(windows) if windows.count(w) > 1 for k in range(5)}
    n_lines = 1 + text.count("\n")
    roots = {
        "symbols": part["symbols"],
        "marks": part["marks"],
        "stops": part["stops"],
        "upper": part["upper"] / (part["upper"] + part["lower"] + 1e-9),
        "digits": part["digits"],
        "other": max(0.0, 1 - sum(part.values()) - 2 * later),
        "bars": text.count("|") / size,
        "dup_lines": sum(x in lines[:i] for i, x in enumerate(lines)) / n_lines,
        "repeat_words": len(repeated) / n,
        "same_as_last": sum(a == b for a, b in zip(words, words[1:], strict=False)) / n,
        "new_words": len(set(words)) / n,
        "short_words": sum(len(w.encode()) < 4 for w in words) / n,
        "capital_words": sum(
            any(c in kinds["upper"] for c in w) and not any(c in kinds["lower"] for c in w) for w in words
        )
        / n,
    }
    values = {k: math.sqrt(v) for k, v in roots.items()}
    values |= {
        "log_words": math.log(1 + n),
        "word_length": math.log(1 + sum(map(len, words)) / n),
        "line_words": math.log(1 + n / n_lines),
    }
    return [values[k] for k in stats.STATISTICS]


def test_scores_of_the_table_against_brute_force(spark):
    """Statistics, shrunk covariances and scores of whole documents, by plain formulas."""
    folder = SF_DIR.replace("sf0.01", "sf0.001")
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    texts = {r.doc_id: r.text for r in docs.collect() if len(r.text or "") < 20_000}
    values = {key: _brute_statistics(text) for key, text in texts.items()}
    got = dict(zip(texts, stats.matrix([t.encode() for t in texts.values()])[1], strict=True))
    for key in texts:
        np.testing.assert_allclose(got[key], values[key], atol=1e-7)  # roots of rounding errors

    model = quality.fit_quality(docs, labels)
    learnt = [r for r in labels.collect() if zlib.crc32(str(r.doc_id).encode()) % 5]
    every = {r.doc_id: r.text for r in docs.collect()}
    x = np.array([values.get(r.doc_id) or _brute_statistics(every[r.doc_id]) for r in learnt])
    y = np.array([r.quality for r in learnt])
    centre, scale = x.mean(axis=0), np.where(x.std(axis=0) > 1e-9, x.std(axis=0), 1)
    z = (x - centre) / scale
    own = [np.cov(z[y == k].T) for k in (0, 1)]
    pooled = np.mean(y == 0) * own[0] + np.mean(y == 1) * own[1]
    log = []
    tried = (np.array(list(values.values())) - centre) / scale
    for k in (0, 1):
        cov = 0.7 * own[k] + 0.3 * pooled
        cov = 0.95 * cov + 0.05 * np.trace(cov) / len(cov) * np.eye(len(cov))
        gap = tried - z[y == k].mean(axis=0)
        inside = np.einsum("ij,jk,ik->i", gap, np.linalg.inv(cov), gap)
        log.append(np.log(np.mean(y == k)) - 0.5 * (inside + np.linalg.slogdet(cov)[1]))
    expected = 1 / (1 + np.exp(np.clip((log[0] - log[1]) / 4, -40, 40)))
    found = {r.doc_id: r.score for r in quality.score_quality(docs, model, keep=["doc_id"]).collect()}
    np.testing.assert_allclose([found[k] for k in values], expected, atol=1e-6)


def test_names_that_clash(spark):
    docs, labels = _tables(spark)
    with pytest.raises(ValueError, match="score"):
        quality.score_quality(docs, quality.fit_quality(docs, labels), keep=["doc_id", "score"])


def test_edges(spark):
    _, labels = _tables(spark)
    docs = edge.documents(spark)
    model = quality.fit_quality(docs, labels)
    found = quality.score_quality(docs, model, keep=["doc_id"]).collect()
    assert len(found) == len(edge.ROWS)
    assert all(0 <= r.score <= 1 for r in found)
    assert len({r.score for r in found if r.doc_id == 6}) == 1
    blank = {r.score for r in found if r.doc_id in (2, 3, 4)}
    assert len(blank) == 1
    assert quality.score_quality(edge.empty(spark), model, keep=["doc_id"]).collect() == []


def test_without_labels_all_scores_are_a_half(spark):
    docs, labels = _tables(spark, 20)
    model = quality.fit_quality(docs, labels.filter("false"))
    assert {r.score for r in quality.score_quality(docs, model, keep=["doc_id"]).collect()} == {0.5}


def _brute_counts(text):
    text = text or ""
    white = " \t\n\x0b\x0c\r"
    words = "".join(" " if c in white else c for c in text).split(" ")
    words = [w for w in words if w]
    lines = [x for x in text.split("\n") if any(c not in white for c in x)]
    windows = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    repeated = {i + k for i, w in enumerate(windows) if windows.count(w) > 1 for k in range(5)}
    return (
        len(words),
        sum(map(len, words)),
        sum(c in "#*$%&|<>" for c in text),
        sum(x in lines[:i] for i, x in enumerate(lines)),
        len(repeated),
    )


def test_rule_counts_against_brute_force(spark):
    rows = [(i, t) for i, (t, *_) in enumerate((r[1],) for r in edge.ROWS) if t is not edge.LONG]
    rows += [
        (100, "a b c d e f a b c d e g a b c d e"),
        (101, "x y\nx y\n\n \nx y \nx y"),
        (102, "a a a a a a a a"),
        (103, "é# é\u0085é <b> $5 & 10% | *\n\n#"),
        (104, "1 2 3 4 5 6 7 8 9 10"),
    ]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    model = rules.fit(np.zeros((0, 1)), np.zeros(0), monotone={})
    found = {r.doc_id: r for r in rules.apply_rules(docs, model, keep=["doc_id"]).collect()}
    for key, text in rows:
        r = found[key]
        counts = (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words)
        assert counts == _brute_counts(text), text
        assert r.base_failed == (counts[0] < 10 or 100 * counts[4] > 20 * counts[0])
        assert r.kept == (not r.base_failed)  # no trees: the base rules alone


def test_trees_keep_held_out_documents_of_good_quality(spark):
    docs, labels = _tables(spark)
    model = rules.fit_rules(docs, labels)
    found = rules.apply_rules(docs, model, keep=["doc_id"]).collect()
    verdict = {r.doc_id: r for r in found}
    assert all(verdict[i].rule_score > 0.5 for i in range(1, 400, 2))
    assert all(verdict[i].rule_score < 0.3 for i in range(0, 400, 2))
    assert len(rules.apply_rules(edge.documents(spark), model, keep=["doc_id"]).collect()) == len(
        edge.ROWS
    )
    assert rules.apply_rules(edge.empty(spark), model, keep=["doc_id"]).collect() == []


def test_trees_learn_and_stay_monotone():
    rng = np.random.default_rng(1)
    x = rng.uniform(-1, 1, (4000, 3))
    noisy = x[:, 0] + 0.5 * np.sin(6 * x[:, 1]) + 0.4 * rng.normal(size=4000)
    y = (noisy > 0).astype(int)
    model = rules.fit(x, y, monotone={0: 1})
    assert ((model.score(x) > 0.5) == y).mean() > 0.8
    for _ in range(50):
        line = np.tile(rng.uniform(-1, 1, 3), (100, 1))
        line[:, 0] = np.linspace(-1, 1, 100)
        assert (np.diff(model.score(line)) >= -1e-12).all()
    falling = rules.fit(x, y, monotone={0: -1})
    line = np.zeros((100, 3))
    line[:, 0] = np.linspace(-1, 1, 100)
    assert (np.diff(falling.score(line)) <= 1e-12).all()


def test_flat_trees_equal_a_walk_from_node_to_node():
    rng = np.random.default_rng(2)
    x = rng.normal(size=(500, 4))
    y = (x[:, 0] * x[:, 1] > 0).astype(int)
    model = rules.fit(x, y, monotone={}, trees=7)

    def walk(row, node):
        while model.left[node] != node:
            side = model.left if row[model.feature[node]] <= model.threshold[node] else model.right
            node = side[node]
        return model.value[node]

    expected = [model.base + sum(walk(row, root) for root in model.roots) for row in x]
    np.testing.assert_allclose(model.raw(x), expected)
