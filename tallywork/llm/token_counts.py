"""Exact token counts of every prefix of a text, for a byte-level BPE vocabulary.

A word's prefixes are counted by dynamic programming. For each place of the word the last token of
the encoding up to there is kept: of all tokens that end at the place, found by an Aho-Corasick
automaton, it is the one that is compatible with the last token of the prefix before it, that is, no
merge crosses the border between the two before both are complete. The count is one more than that
prefix's count. Words add up, so a text gets a table of counts with an entry per prefix, and questions
about truncation and budgets are lookups in the table; nothing is encoded again.

A prefix is counted as a text of its own. It differs from the start of the whole text's encoding where
it ends inside white space, a contraction or a special token; the table holds the prefix's own count.

The automaton is built once per worker process from the tokenizer's file; the path is a parameter and
the file must be at the same path on all executors.
"""

import json
import re
from functools import lru_cache
from itertools import accumulate, chain

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from tokenizers import pre_tokenizers

from tallywork.llm.bpe import _byte_alphabet
from tallywork.llm.texts import arrow_rows

_SHORT_WORD = 48  # characters; at most 192 bytes and as many tokens, so a count is one byte
_CACHED_WORDS = 200_000  # in each of two generations
_CACHED_PAIRS = 250_000
_AT_ONCE = 1_000_000  # characters of a long text that are split into words at a time

# fixed values: the word pattern that byte-level vocabularies of this kind are made with
_WORDS = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
_LONG_CONTRACTIONS = ("'re", "'ve", "'ll")

# a character of each kind and a partner that the word pattern joins to that kind only
_KINDS = (("a", r"\p{L}"), ("0", r"\p{N}"), ("!", r"[^\s\p{L}\p{N}]"))
_BLANK = "\t"


class PrefixCounter:
    """Counts of all prefixes for a tokenizer file of kind byte-level BPE."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            config = json.load(file)
        vocab = config["model"]["vocab"]
        merges = [m if isinstance(m, list) else m.split(" ") for m in config["model"]["merges"]]
        size = 1 + max(vocab.values())
        self.born = [-1] * size  # place of the merge that makes a token; -1 for single bytes
        self.parts: list[tuple[int, int] | None] = [None] * size
        self.merged: dict[tuple[int, int], int] = {}
        for rank, (left, right) in enumerate(merges):
            pair, made = (vocab[left], vocab[right]), vocab[left + right]
            self.merged[pair] = rank
            self.born[made], self.parts[made] = rank, pair
        self.compatible: dict[tuple[int, int], bool] = {}

        self.automaton = ahocorasick.Automaton()
        usable = set()  # tokens that merging in rank order can reach
        for text, n in sorted(vocab.items(), key=lambda item: self.born[item[1]]):
            pair = self.parts[n]
            if pair is None or (usable.issuperset(pair) and self._stay_apart(*pair, self.born[n])):
                usable.add(n)
                self.automaton.add_word(text, (len(text), n))
        self.automaton.make_automaton()

        self.alphabet = _byte_alphabet()
        self.special = {t["content"] for t in config["added_tokens"]}
        longest_first = sorted(self.special, key=len, reverse=True)
        self.special_pattern = re.compile("(" + "|".join(map(re.escape, longest_first)) + ")")
        self.words = regex.compile(_WORDS)
        self.blanks = regex.compile(r"\s\s+(?=\S)")
        self.border = regex.compile(r"(?<=\S)\s")
        self.library = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=True)
        self.stand_ins: dict[int, str] = {}
        self.checked: set[str] = set(map(chr, range(128)))
        self.cache: dict[str, bytes] = {}
        self.cached_before: dict[str, bytes] = {}

    def _stay_apart(self, left: int, right: int, end: float = float("inf")) -> bool:
        """Whether two tokens come to stand side by side before the moment ``end``.

        Takes both apart again, the younger one first. At no moment may the two symbols at the border
        have a merge that comes before the next merge of either side; of equal merges the left one
        comes first.
        """
        left_until = right_until = end
        while True:
            across = self.merged.get((left, right))
            if across is not None and across < min(left_until, end) and across <= right_until:
                return False
            if self.born[left] > self.born[right]:
                left_until, left = self.born[left], self.parts[left][1]
            elif self.born[right] >= 0:
                right_until, right = self.born[right], self.parts[right][0]
            else:
                return True

    def _byte_prefixes(self, symbols: str) -> list[int]:
        """Number of tokens of each prefix of a word, given in byte-level characters."""
        known = self.compatible
        if len(known) > _CACHED_PAIRS:
            known.clear()
        counts, last = [0] * (len(symbols) + 1), [0] * (len(symbols) + 1)
        for at, (length, token) in self.automaton.iter(symbols):
            end = at + 1
            if counts[end]:
                continue
            start = end - length
            if start:
                pair = last[start], token
                fits = known.get(pair)
                if fits is None:
                    fits = known[pair] = self._stay_apart(*pair)
                if not fits:
                    continue
            counts[end] = counts[start] + 1
            last[end] = token
        return counts

    def _count_word(self, word: str) -> list[int]:
        """Number of tokens of each prefix of a word."""
        raw = word.encode()
        counts = self._byte_prefixes("".join([self.alphabet[b] for b in raw]))
        if len(raw) == len(word):
            del counts[0]
        else:
            ends = accumulate(len(c.encode()) for c in word)
            counts = [counts[end] for end in ends]
        if word in _LONG_CONTRACTIONS:  # cut short, it is a mark and a letter
            counts[1] = counts[0] + 1
        return counts

    def _new_word(self, word: str) -> bytes:
        """The counts of a short word that is not in the cache's younger generation."""
        packed = self.cached_before.get(word) or bytes(self._count_word(word))
        if len(self.cache) >= _CACHED_WORDS:  # words in use move on from the older generation
            self.cached_before, self.cache = self.cache, {}
        self.cache[word] = packed
        return packed

    def _count_words(self, words: list[str]) -> np.ndarray:
        """The counts of some words one after the other, each from its own start."""
        get, new = self.cache.get, self._new_word
        if max(map(len, words)) <= _SHORT_WORD:
            packed = b"".join([get(w) or new(w) for w in words])
            return np.frombuffer(packed, np.uint8).astype(np.int32)
        lists = ((get(w) or new(w)) if len(w) <= _SHORT_WORD else self._count_word(w) for w in words)
        return np.fromiter(chain.from_iterable(lists), np.int32)

    def _splittable(self, text: str) -> str:
        """The text with stand-ins for characters that ``regex`` takes for another kind than the library.

        The two know different versions of Unicode. Each character that appears is looked up once.
        """
        if text.isascii():
            return text
        for c in set(text) - self.checked:
            self.checked.add(c)
            wanted = next(
                (k for k in _KINDS if len(self.library.pre_tokenize_str(k[0] + c)) == 1), (_BLANK, r"\s")
            )
            if not regex.match(wanted[1], c):
                self.stand_ins[ord(c)] = wanted[0]
        return text.translate(self.stand_ins) if self.stand_ins else text

    def _plain(self, text: str) -> np.ndarray:
        """Counts of the prefixes of 0, 1, 2, ... characters, with special tokens as plain text."""
        whole = self._splittable(text)
        found, total, start = [np.zeros(1, np.int32)], 0, 0
        while start < len(text):
            cut = self.border.search(whole, start + _AT_ONCE)
            end = cut.start() if cut else len(text)
            plain, part = whole[start:end], text[start:end]
            words = self.words.findall(plain)
            lengths = np.fromiter(map(len, words), np.int64, len(words))
            ends = np.cumsum(lengths)
            if plain != part:
                words = [part[e - n : e] for e, n in zip(ends.tolist(), lengths.tolist(), strict=True)]
            inner = self._count_words(words)
            sums = inner[ends - 1]
            before = (total + np.cumsum(sums) - sums).astype(np.int32)
            counts = inner + np.repeat(before, lengths)
            after = counts[-1]
            for run in self.blanks.finditer(plain):  # as the end of a text, white space is one word
                at, stop = run.span()
                left = counts[at - 1] if at else total
                counts[stop - 1] = left + self._count_words([part[at:stop]])[-1]
            found.append(counts)
            total, start = int(after), end
        return np.concatenate(found)

    def counts(self, text: str) -> np.ndarray:
        """Counts of the prefixes of 0, 1, 2, ... characters of a whole text."""
        parts = self.special_pattern.split(text) if self.special else [text]
        found, total = [], 0
        for at in range(0, len(parts), 2):
            section = parts[at]
            # a special token that is not complete is plain text, joined to what is before it
            special = parts[at + 1] if at + 1 < len(parts) else " "
            table = self._plain(section + special[:-1]) + np.int32(total)
            found.append(table)
            total = int(table[len(section)]) + 1
        return np.concatenate(found)


@lru_cache(maxsize=4)
def load(path: str) -> PrefixCounter:
    """The counter of a file, built once per process."""
    return PrefixCounter(path)


def prefix_counts(
    df: DataFrame,
    path: str,
    *,
    keep: list[str],
    text: str = "text",
    budgets: dict[str, int] | None = None,
) -> DataFrame:
    """Columns ``keep`` and ``counts``: entry i is the exact token count of the first i characters.

    The table starts with the empty prefix and ends with the whole text, so it has an entry more
    than the text has characters; a NULL or empty text has the one entry 0. Strings of special
    tokens count as those tokens. ``budgets`` names bigint columns to add: the characters of the
    longest prefix with at most so many tokens, as ``longest_prefix`` finds them in a stored table.

    One row per row of ``df``, repeated rows included, in one pass without a shuffle; an empty table
    gives an empty result. Other columns are not read. ``keep`` must not hold the name of an added
    column.
    """
    limits = budgets or {}
    clashing = {"counts", *limits} & set(keep)
    if clashing:
        raise ValueError(f"keep holds names of added columns: {sorted(clashing)}")

    def make(texts: list[bytes]) -> list[pa.Array]:
        counter = load(path)
        tables = [counter.counts(raw.decode("utf-8", "replace")) for raw in texts]
        ends = np.cumsum([0, *map(len, tables)])
        values = np.concatenate(tables) if tables else np.empty(0, np.int32)
        listed = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(values))
        fitting = [
            pa.array([int(np.flatnonzero(t <= budget)[-1]) for t in tables], pa.int64())
            for budget in limits.values()
        ]
        return [listed, *fitting]

    added = ", ".join(["counts array<int>", *(f"`{name}` bigint" for name in limits)])
    return arrow_rows(df, keep, text, make, added, largest=64)


def whole_count(counts: str = "counts") -> Column:
    """Tokens of the whole text."""
    return F.element_at(counts, -1)


def count_of_prefix(chars: Column | int, counts: str = "counts") -> Column:
    """Tokens of the text's first ``chars`` characters; of the whole text if it has fewer."""
    chars = F.lit(chars) if isinstance(chars, int) else chars
    return F.get(counts, F.least(chars.cast("int"), F.size(counts) - 1))


def longest_prefix(budget: int, counts: str = "counts") -> Column:
    """Characters of the longest prefix with at most ``budget`` tokens.

    A longer prefix can have fewer tokens than a shorter one; the longest of all counts.
    """
    fits = F.when(whole_count(counts) <= budget, F.size(counts) - 1)
    from_the_end = F.array_position(F.reverse(F.transform(counts, lambda n: n <= budget)), F.lit(True))
    return fits.otherwise(F.size(counts) - from_the_end).cast("bigint")
