"""License scans with a generalised suffix automaton of licence words.

The automaton holds every run of consecutive words of all licence texts. A document's words stream
through it, which yields the matching statistics: at every word the length of the longest run that
ends there and also stands in a licence text, and the place of that run there. Exact phrases are read
off the same statistics. Long matches are chained where they go on in the order of one licence text
with small gaps; a chain covers a span of the document and a share of the licence text.

The automaton has a few thousand states at most, fixed by the licence texts; it is built once per
worker process. Documents are scanned row by row, without a shuffle.
"""

from collections import defaultdict
from dataclasses import dataclass, field
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame

from tallywork.llm.texts import arrow_rows

# Phrases whose every place counts, with their labels.
PHRASES = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}

# Public licence texts and notices, lower case, with their labels.
LICENCE_TEXTS = {
    "mit-text": """
        permission is hereby granted free of charge to any person obtaining a copy of this software
        and associated documentation files the software to deal in the software without restriction
        including without limitation the rights to use copy modify merge publish distribute
        sublicense and or sell copies of the software and to permit persons to whom the software is
        furnished to do so subject to the following conditions the above copyright notice and this
        permission notice shall be included in all copies or substantial portions of the software
        the software is provided as is without warranty of any kind express or implied including
        but not limited to the warranties of merchantability fitness for a particular purpose and
        noninfringement in no event shall the authors or copyright holders be liable for any claim
        damages or other liability whether in an action of contract tort or otherwise arising from
        out of or in connection with the software or the use or other dealings in the software
    """,
    "apache-notice": """
        licensed under the apache license version 2 0 the license you may not use this file except
        in compliance with the license you may obtain a copy of the license at http www apache org
        licenses license 2 0 unless required by applicable law or agreed to in writing software
        distributed under the license is distributed on an as is basis without warranties or
        conditions of any kind either express or implied see the license for the specific language
        governing permissions and limitations under the license
    """,
    "gpl-notice": """
        this program is free software you can redistribute it and or modify it under the terms of
        the gnu general public license as published by the free software foundation either version
        3 of the license or at your option any later version this program is distributed in the
        hope that it will be useful but without any warranty without even the implied warranty of
        merchantability or fitness for a particular purpose see the gnu general public license for
        more details you should have received a copy of the gnu general public license along with
        this program if not see https www gnu org licenses
    """,
    "bsd-text": """
        redistribution and use in source and binary forms with or without modification are
        permitted provided that the following conditions are met redistributions of source code
        must retain the above copyright notice this list of conditions and the following disclaimer
        redistributions in binary form must reproduce the above copyright notice this list of
        conditions and the following disclaimer in the documentation and or other materials
        provided with the distribution neither the name of the copyright holder nor the names of
        its contributors may be used to endorse or promote products derived from this software
        without specific prior written permission
    """,
    "isc-text": """
        permission to use copy modify and or distribute this software for any purpose with or
        without fee is hereby granted provided that the above copyright notice and this permission
        notice appear in all copies
    """,
    "cc-by-notice": """
        this work is licensed under a creative commons attribution 4 0 international license
    """,
}

_SEPARATORS = bytes(
    c for c in range(0x80) if not (0x30 <= c <= 0x39 or 0x41 <= c <= 0x5A or 0x61 <= c <= 0x7A)
)
_PLAIN = bytes.maketrans(
    _SEPARATORS + bytes(range(0x41, 0x5B)), b" " * len(_SEPARATORS) + bytes(range(0x61, 0x7B))
)


def words_of(text: bytes) -> list[bytes]:
    """Lower-case words: runs of ASCII digits, ASCII letters and all characters beyond ASCII."""
    return text.translate(_PLAIN).split()


@dataclass
class _State:
    length: int
    link: int
    next: dict[bytes, int] = field(default_factory=dict)
    ends: list[tuple[int, int]] = field(default_factory=list)  # (text, place of the last word)


class SuffixAutomaton:
    """All runs of consecutive words of several texts, one state for runs that end at the same places."""

    def __init__(self, texts: list[list[bytes]]):
        self.states = [_State(0, -1)]
        own: list[tuple[int, int, int]] = []
        for number, words in enumerate(texts):
            last = 0
            for place, word in enumerate(words):
                last = self._extended(last, word)
                own.append((last, number, place))
        ends: dict[int, set[tuple[int, int]]] = defaultdict(set)
        for state, number, place in own:
            while state > 0 and (number, place) not in ends[state]:
                ends[state].add((number, place))
                state = self.states[state].link
        for state, places in ends.items():
            self.states[state].ends = sorted(places)

    def _extended(self, last: int, word: bytes) -> int:
        """The state after one more word of the text at hand, which has come to ``last``."""
        states = self.states
        if word in states[last].next:
            return self._split(last, word)
        new = len(states)
        states.append(_State(states[last].length + 1, 0))
        at = last
        while at >= 0 and word not in states[at].next:
            states[at].next[word] = new
            at = states[at].link
        if at >= 0:
            states[new].link = self._split(at, word)
        return new

    def _split(self, at: int, word: bytes) -> int:
        """The state of ``at``'s longest run with ``word``; cuts it off a state that has longer ones."""
        states = self.states
        old = states[at].next[word]
        if states[old].length == states[at].length + 1:
            return old
        new = len(states)
        states.append(_State(states[at].length + 1, states[old].link, dict(states[old].next)))
        states[old].link = new
        while at >= 0 and states[at].next.get(word) == old:
            states[at].next[word] = new
            at = states[at].link
        return new

    def step(self, state: int, length: int, word: bytes) -> tuple[int, int]:
        """State and length of the longest match that ends with ``word``."""
        states = self.states
        while state and word not in states[state].next:
            state = states[state].link
            length = states[state].length
        following = states[state].next.get(word)
        return (0, 0) if following is None else (following, length + 1)


@dataclass(frozen=True)
class Span:
    """A chain of long matches: words ``first`` to ``last`` of the document, share of the text covered."""

    label: str
    first: int
    last: int
    coverage: float


class Scanner:
    """Phrases and licence texts ready to scan documents."""

    def __init__(
        self,
        phrases: dict[str, str],
        texts: dict[str, str],
        *,
        least_match: int = 5,
        most_gap: int = 12,
        least_coverage: float = 0.3,
    ):
        self.least_match, self.most_gap, self.least_coverage = least_match, most_gap, least_coverage
        self.labels = list(texts)
        bodies = [words_of(body.encode()) for body in texts.values()]
        self.sizes = [len(body) for body in bodies]
        needles = [words_of(phrase.encode()) for phrase in phrases]
        self.automaton = SuffixAutomaton([*bodies, *needles])
        self.vocabulary = {word for words in [*bodies, *needles] for word in words}
        # a phrase ends at a state if it is a suffix of the state's runs; the match must be as long
        texts = [*bodies, *needles]
        self.phrases: dict[int, list[tuple[int, str]]] = defaultdict(list)
        for needle, label in zip(needles, phrases.values(), strict=True):
            for number, state in enumerate(self.automaton.states):
                if state.length >= len(needle):
                    text, place = state.ends[0]
                    if texts[text][place - len(needle) + 1 : place + 1] == needle:
                        self.phrases[number].append((len(needle), label))

    def scan(self, words: list[bytes]) -> tuple[list[tuple[int, str]], list[Span]]:
        """Places of phrases (first word, label) and the spans of licence texts."""
        places: list[tuple[int, str]] = []
        matches: list[tuple[int, int, int]] = []  # last word, length, state
        step, ends_here = self.automaton.step, self.phrases
        state = length = 0
        before = -2
        known = self.vocabulary
        for at in [i for i, word in enumerate(words) if word in known]:
            if at != before + 1:
                if length >= self.least_match:
                    matches.append((before, length, state))
                state = length = 0
            following, longer = step(state, length, words[at])
            if length >= self.least_match and longer <= length:
                matches.append((before, length, state))
            state, length, before = following, longer, at
            if state in ends_here:
                for size, label in ends_here[state]:
                    if length >= size:
                        places.append((at - size + 1, label))
        if length >= self.least_match:
            matches.append((before, length, state))
        return places, self._chains(matches)

    def _chains(self, matches: list[tuple[int, int, int]]) -> list[Span]:
        """Joins matches that go on in the order of one licence text; long enough chains only."""
        open_: dict[int, list[int]] = {}  # text: first and last word, end in the text, words covered
        spans: list[Span] = []

        def close(number: int) -> None:
            first, last, _, covered = open_.pop(number)
            share = min(1.0, covered / self.sizes[number])
            if share >= self.least_coverage:
                spans.append(Span(self.labels[number], first, last, share))

        for last, length, state in matches:
            first = last - length + 1
            by_text: dict[int, list[int]] = defaultdict(list)
            for number, end in self.automaton.states[state].ends:
                if number < len(self.sizes):
                    by_text[number].append(end)
            for number, ends in by_text.items():
                chain = open_.get(number)
                if chain:
                    # words already covered do not count again
                    new = min(length, last - chain[1])
                    later = [end for end in ends if end - new >= chain[2]]
                    if later and 0 < new and first - chain[1] <= self.most_gap:
                        open_[number] = [chain[0], last, later[0], chain[3] + new]
                        continue
                    close(number)
                open_[number] = [first, last, ends[0], length]
        for number in list(open_):
            close(number)
        return spans


@lru_cache(maxsize=4)
def _scanner(phrases: tuple, texts: tuple) -> Scanner:
    return Scanner(dict(phrases), dict(texts))


def scan_licences(
    docs: DataFrame,
    *,
    keep: list[str],
    text: str = "text",
    phrases: dict[str, str] = PHRASES,
    licence_texts: dict[str, str] = LICENCE_TEXTS,
) -> DataFrame:
    """Licence phrases and spans of every whole text, added to the columns ``keep``.

    ``n_words``; ``places``: every place of a phrase as (label, first word); ``spans``: chains as (label,
    first, last, coverage); ``n_base``, ``first_word``, ``last_word``: number, smallest and largest start of
    the places (NULL without one); ``base_labels`` and ``labels``: labels of the places, and of spans too,
    distinct, sorted and joined by commas; ``score``: 1 with a place, else the largest coverage.

    NULL and empty texts have no words and no labels. Rows are scanned one by one, repeated rows
    alike; an empty table gives an empty result. Other columns are not read, whatever their names.
    """
    given = tuple(phrases.items()), tuple(licence_texts.items())

    def make(texts: list[bytes]) -> list[pa.Array]:
        scanner = _scanner(*given)
        rows = []
        for body in texts:
            words = words_of(body)
            places, spans = scanner.scan(words)
            starts = [start for start, _ in places]
            base = {label for _, label in places}
            rows.append(
                {
                    "n_words": len(words),
                    "places": [{"label": label, "first": start} for start, label in places],
                    "spans": [vars(s) for s in spans],
                    "n_base": len(places),
                    "first_word": min(starts, default=None),
                    "last_word": max(starts, default=None),
                    "base_labels": ",".join(sorted(base)),
                    "labels": ",".join(sorted(base | {s.label for s in spans})),
                    "score": 1.0 if places else max((s.coverage for s in spans), default=0.0),
                }
            )
        place = pa.struct([("label", pa.string()), ("first", pa.int64())])
        span = pa.struct(
            [("label", pa.string()), ("first", pa.int64()), ("last", pa.int64()), ("coverage", pa.float64())]
        )
        types = {
            "n_words": pa.int64(),
            "places": pa.list_(place),
            "spans": pa.list_(span),
            "n_base": pa.int64(),
            "first_word": pa.int64(),
            "last_word": pa.int64(),
            "base_labels": pa.string(),
            "labels": pa.string(),
            "score": pa.float64(),
        }
        return [pa.array([row[name] for row in rows], kind) for name, kind in types.items()]

    added = (
        "n_words bigint, places array<struct<label:string,first:bigint>>, "
        "spans array<struct<label:string,first:bigint,last:bigint,coverage:double>>, "
        "n_base bigint, first_word bigint, last_word bigint, base_labels string, labels string, "
        "score double"
    )
    return arrow_rows(docs, keep, text, make, added)
