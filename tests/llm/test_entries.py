"""The registered queries over whole tables, against SQL or brute force."""

import base64
import hashlib
import html
import re
import zlib
from collections import defaultdict

import __spark_entry__ as entry_module
import compare
import corpus_pipeline
import pytest
from conftest import SF_DIR
from llm.test_licences import _brute as brute_licences
from llm.test_mixing import _targets
from llm.test_periodic_runs import brute_collapse, brute_runs
from llm.test_quality import _brute_counts
from llm.test_simhash import _brute_components, _brute_fingerprint

from tallywork.llm import entries

SMALL = SF_DIR.replace("sf0.01", "sf0.001")
QUERIES = entry_module.queries()


@pytest.fixture(scope="module")
def duck():
    return compare.connect(SF_DIR)


@pytest.fixture(scope="module")
def docs(spark):
    return {r.doc_id: r.text for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()}


def test_all_are_registered():
    assert {re.match(r"op(\d+)_", n)[1] for n in entries.queries()} == {str(n) for n in range(1, 14)}
    assert "pipeline" in QUERIES and set(entries.oracle_sql()) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(entries.oracle_sql()))
def test_query_matches_sql(spark, duck, name):
    names, rows = compare.spark_rows(QUERIES[name](spark, SF_DIR))
    expected_names, expected = compare.duck_rows(duck, entries.oracle_sql()[name])
    assert names == expected_names
    assert rows and rows == expected


def test_licences(spark, docs):
    found = QUERIES["op3_licences"](spark, SF_DIR).collect()
    assert len(found) == len(docs)
    assert sum(r.n_base for r in found) > 0
    for r in found:
        n, places = brute_licences(docs[r.doc_id])
        starts = [i for i, _ in places]
        assert (r.n_words, r.n_base) == (n, len(places))
        assert (r.first_word, r.last_word) == (min(starts, default=None), max(starts, default=None))


def test_quality_of_held_out_documents(spark):
    found = {r.doc_id: r for r in QUERIES["op6_quality"](spark, SF_DIR).collect()}
    for key, r in found.items():
        assert r.held_out == (zlib.crc32(str(key).encode()) % 5 == 0)
        assert r.predicted == int(r.score >= 0.3)
    labels = spark.read.parquet(f"{SF_DIR}/labels.parquet").collect()
    held = [(r.quality, found[r.doc_id].predicted) for r in labels if found[r.doc_id].held_out]
    assert sum(a == b for a, b in held) / len(held) > 0.95


def test_fingerprints_and_groups(spark, docs):
    found = {r.doc_id: r for r in QUERIES["op7_simhash"](spark, SMALL).collect()}
    points = [(key, _brute_fingerprint(docs_text)) for key, docs_text in _small(spark).items()]
    assert len(found) == len(points)
    for (key, point), component in zip(points, _brute_components(points), strict=True):
        assert found[key].fingerprint == f"{point:016x}"
        assert found[key].component_id == component


def _small(spark):
    return {r.doc_id: r.text for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()}


def test_page_texts(spark):
    pages = {r.page_id: r.html for r in spark.read.parquet(f"{SF_DIR}/pages.parquet").collect()}
    found = QUERIES["op8_html"](spark, SF_DIR).collect()
    assert len(found) == len(pages)
    for r in found:
        article = re.search("<article>(.*)</article>", pages[r.page_id], re.DOTALL)[1]
        blocks = (
            " ".join(html.unescape(re.sub("<[^>]*>", "", part)).split())
            for part in re.split("</?(?:p|h1)>", article)
        )
        assert r.text == "\n\n".join(b for b in blocks if b)
        assert r.n_chars == len(r.text)


def test_derived_records(spark):
    """Both records of every page of the table, made again from the page alone."""
    pages = spark.read.parquet(f"{SF_DIR}/pages.parquet").collect()
    found = defaultdict(dict)
    for r in QUERIES["op9_warc"](spark, SF_DIR).collect():
        found[r.page_id][r.record_type] = r
    assert len(found) == len(pages)
    for page in pages:
        made = found[page.page_id]
        assert set(made) == {"metadata", "conversion"}
        body = page.html.encode()
        digest = "sha1:" + base64.b32encode(hashlib.sha1(body).digest()).decode()
        for r in made.values():
            assert r.content_length == len(r.block.encode())
            block = base64.b32encode(hashlib.sha1(r.block.encode()).digest()).decode()
            assert r.block_digest == f"sha1:{block}"
            assert (r.target_uri, r.date) == (page.url, entries.CRAWL_DATE)
            assert (r.refers_to_target_uri, r.refers_to_date) == (page.url, entries.CRAWL_DATE)
            assert r.source_payload_digest == digest
            assert r.source_headers == (
                f"content-length: {len(body)}\ncontent-type: text/html; charset=utf-8"
            )
        assert made["metadata"].refers_to == made["conversion"].refers_to
        assert made["metadata"].record_id != made["conversion"].record_id
        shown = re.sub("<(script|style|title)[^>]*>.*?</\\1>|<!--.*?-->", " ", page.html, flags=re.DOTALL)
        shown = re.sub("<[^>]*>", " ", shown)
        assert "".join(made["conversion"].block.split()) == "".join(html.unescape(shown).split())
        links = re.findall(r"<a\s[^>]*href=[\"']([^\"']*)", page.html)
        listed = [x[9:] for x in made["metadata"].block.split("\r\n") if x.startswith("outlink: ")]
        assert listed == [html.unescape(x) for x in links]


def test_rules_keep_clean_documents(spark, docs):
    found = {r.doc_id: r for r in QUERIES["op10_rules"](spark, SF_DIR).collect()}
    assert len(found) == len(docs)
    for key, text in docs.items():
        r = found[key]
        if len(text) < 3000:
            counts = (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words)
            assert counts == _brute_counts(text)
        assert not (r.kept and r.base_failed)
    labels = spark.read.parquet(f"{SF_DIR}/labels.parquet").collect()
    rest = [(x.quality, found[x.doc_id].kept) for x in labels if not found[x.doc_id].base_failed]
    assert sum(a == b for a, b in rest) / len(rest) > 0.98


def _sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def test_periodic_runs(spark):
    found = {r.doc_id: r for r in QUERIES["op11_periodic_runs"](spark, SMALL).collect()}
    texts = _small(spark)
    assert set(found) == set(texts)
    for key, text in texts.items():
        words = re.findall(r"[^\x20\x09-\x0D]+", text)
        h = zlib.crc32(str(key).encode())
        n, g = len(words), h // 10
        if n > 3000:
            continue
        if h % 10 == 0 and n:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
        runs = brute_runs(words)
        best = max(runs, key=lambda r: (r.length / r.period, -r.start, -r.period), default=None)
        r = found[key]
        assert r.n_runs == len(runs)
        assert r.runs_sha256 == _sha("".join(f"{x.start},{x.length},{x.period}\n" for x in runs))
        assert r.collapsed_sha256 == _sha(" ".join(brute_collapse(words, runs)))
        assert (r.start, r.length, r.period) == (
            (best.start, best.length, best.period) if best else (None, None, None)
        )
        assert r.exponent_milli == (1000 * best.length // best.period if best else None)
    assert any(r.n_runs for r in found.values())


def test_token_counts(spark, docs):
    import public_tokenizers
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    found = QUERIES["op12_token_counts"](spark, SF_DIR).collect()
    assert {r.doc_id for r in found} == set(docs) and len(found) == len(docs)
    for r in found:
        text = docs[r.doc_id]
        n = len(library.encode(text, add_special_tokens=False).ids)
        assert (r.n_bytes, r.n_tokens, r.over_limit) == (len(text.encode()), n, n > 512)
        fitting = library.encode(text[: r.fitting_chars], add_special_tokens=False).ids
        assert len(fitting) <= 512 and (n > 512 or r.fitting_chars == len(text))


def test_pipeline_stage_by_stage(spark, tmp_path):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    before = {r.doc_id: r for r in docs.collect()}
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SMALL}/labels.parquet").collect()}
    results = []
    for name, stage in corpus_pipeline.STAGES:
        path = str(tmp_path / name)
        stage(spark, docs, SMALL).write.parquet(path)
        docs = spark.read.parquet(path)
        results.append(docs.collect())
        if name != corpus_pipeline.STAGES[-1][0]:
            assert docs.columns == corpus_pipeline.COLUMNS
            assert all(r == before[r.doc_id] for r in results[-1])
    quality, rules, unique, mixed, encoded = results

    kept = {r.doc_id for r in quality}
    judged = [(labels[k], k in kept) for k in before if k in labels]
    assert sum(a == b for a, b in judged) / len(judged) > 0.95
    for r in quality:
        n, *_, repeated = _brute_counts(r.text) if len(r.text) < 20_000 else (10, 0)
        if n < 10 or 100 * repeated > 20 * n:
            assert r not in rules
    assert {r.doc_id for r in rules} <= kept and len(rules) > 0.8 * len(quality)

    points = [(r.doc_id, _brute_fingerprint(r.text)) for r in rules]
    assert sorted(r.doc_id for r in unique) == sorted(set(_brute_components(points)))

    size, taken, largest = defaultdict(int), defaultdict(int), defaultdict(int)
    for r in unique:
        n = len(re.findall(r"[^\x20\x09-\x0D]+", r.text))
        size[r.source] += n
        largest[r.source] = max(n, largest[r.source])
    for r in mixed:
        taken[r.source] += len(re.findall(r"[^\x20\x09-\x0D]+", r.text))
    for source, target in _targets(size).items():
        assert abs(taken[source] - target) <= largest[source] / 2 + 1

    assert sorted(r.doc_id for r in encoded) == sorted(r.doc_id for r in mixed)
    from llm.test_bpe import PATH
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(PATH)
    for r in encoded:
        ids = library.encode(before[r.doc_id].text, add_special_tokens=False).ids
        assert r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()


def test_pipeline_runs_as_one_query(spark):
    assert QUERIES["pipeline"](spark, SMALL).count() > 100
