import random
import re

from llm import edge

from tallywork.llm import licences

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def _brute(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = WORD.findall(low)
    places = [
        (i, label)
        for phrase, label in licences.PHRASES.items()
        for i in range(len(words) - len(phrase.split()) + 1)
        if words[i : i + len(phrase.split())] == phrase.split()
    ]
    return len(words), sorted(places)


def _texts():
    rng = random.Random(8)
    some = "gnu general public license apache cc by mit the of under x GNU, License. CC-BY".split()
    for _ in range(300):
        yield " ".join(rng.choice(some) for _ in range(40))
    for _ in range(100):
        yield "".join(chr(rng.randint(1, 0x2FF)) for _ in range(200)) + " MIT License cc\x85by Cc/By"


def test_phrases_against_brute_force(spark):
    rows = [*enumerate(_texts()), *((1000 + i, r[1]) for i, r in enumerate(edge.ROWS))]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    found = {r.doc_id: r for r in licences.scan_licences(docs, keep=["doc_id"]).collect()}
    assert len(found) == len(rows)
    for key, text in rows:
        n, places = _brute(text)
        r = found[key]
        starts = [i for i, _ in places]
        assert (r.n_words, r.n_base) == (n, len(places))
        assert sorted((p["first"], p["label"]) for p in r.places) == places
        assert (r.first_word, r.last_word) == (min(starts, default=None), max(starts, default=None))
        assert r.base_labels == ",".join(sorted({label for _, label in places}))
        assert {*r.base_labels.split(",")} <= {*r.labels.split(","), ""}
        assert 0 <= r.score <= 1 and (r.score == 1 or not places)


def test_matching_statistics_against_brute_force():
    texts = [licences.words_of(t.encode()) for t in ("a b c a b d", "b c a b c c", "x a b")]
    automaton = licences.SuffixAutomaton(texts)
    runs = {tuple(t[i:j]) for t in texts for i in range(len(t)) for j in range(i + 1, len(t) + 1)}
    rng = random.Random(9)
    for _ in range(200):
        words = [rng.choice([b"a", b"b", b"c", b"d", b"x", b"y"]) for _ in range(30)]
        state = length = 0
        for i, word in enumerate(words):
            state, length = automaton.step(state, length, word)
            longest = max(
                (k for k in range(1, i + 2) if tuple(words[i - k + 1 : i + 1]) in runs), default=0
            )
            assert length == longest
            if length:
                for number, end in automaton.states[state].ends:
                    assert texts[number][end - length + 1 : end + 1] == words[i - length + 1 : i + 1]


def test_changed_licence_text_is_one_span():
    scanner = licences.Scanner(licences.PHRASES, licences.LICENCE_TEXTS)
    body = licences.LICENCE_TEXTS["mit-text"].split()
    changed = [*body[:60], "foo", "bar", *body[64:]]
    places, spans = scanner.scan(licences.words_of(" ".join(["some", "start", *changed]).encode()))
    assert places == []
    assert [(s.label, s.first, s.last) for s in spans] == [("mit-text", 2, 1 + len(changed))]
    assert 0.9 < spans[0].coverage < 1
    _, few = scanner.scan(licences.words_of(" ".join(body[:20]).encode()))
    assert few == []


def test_empty_table(spark):
    assert licences.scan_licences(edge.empty(spark), keep=["doc_id"]).collect() == []
