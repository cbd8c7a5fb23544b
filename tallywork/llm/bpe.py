"""Byte-pair encoding of whole texts, and decoding.

Encoding walks over a word and takes the longest token that starts at each place, found for all
places at once by an Aho-Corasick automaton over the reversed vocabulary. A token is kept if the
pair with the token before it is compatible, that is if no merge would cross the border between
them before both are complete. Otherwise shorter tokens at the place are tried, and then the token
before is taken back. A border that has failed once is never tried again, so the work is linear in
the length of the word, and the result equals the merges in rank order.

Decoding copies slices of one buffer that holds all token texts, found through an offset table.

The automaton and the tables are built once per worker process from the tokenizer's file; the path
is a parameter and the file must be at the same path on all executors.
"""

import json
import re
import struct
import unicodedata
from functools import lru_cache

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallywork.llm.texts import arrow_rows

_END = "\x00"  # stands for the end-of-word mark; byte-level text never holds it
_LONGEST_CACHED = 48
_CACHED_WORDS = 400_000
_CACHED_PAIRS = 250_000


def _byte_alphabet() -> list[str]:
    """The character that stands for each byte in a byte-level vocabulary.

    Printable Latin-1 characters stand for themselves, the other bytes for characters from 256 on.
    """
    printable = {*range(33, 127), *range(161, 173), *range(174, 256)}
    others = iter(range(256, 512))
    return [chr(b) if b in printable else chr(next(others)) for b in range(256)]


class WordBPE:
    """Encoder and decoder for a tokenizer file of kind BPE with an end-of-word mark."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            config = json.load(file)
        model = config["model"]
        suffix = model["end_of_word_suffix"]
        inner = {self._inner(token, suffix): n for token, n in model["vocab"].items()}
        merges = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]

        size = 1 + max(*model["vocab"].values(), *(t["id"] for t in config["added_tokens"]))
        self.born = [-1] * size  # place of the merge that makes a token; -1 for single symbols
        self.parts = [None] * size
        self.pairs = {}
        for rank, (left, right) in enumerate(merges):
            made = inner[self._inner(left + right, suffix)]
            a, b = inner[self._inner(left, suffix)], inner[self._inner(right, suffix)]
            self.pairs[a, b] = made
            self.born[made], self.parts[made] = rank, (a, b)
        self.compatible = lru_cache(_CACHED_PAIRS)(self._compatible)

        # tokens that merging in rank order cannot reach never appear in an encoding
        usable = {}
        for text, n in sorted(inner.items(), key=lambda item: self.born[item[1]]):
            parts = self.parts[n]
            if parts is None or (
                parts[0] in usable and parts[1] in usable and self._meets(*parts, self.born[n])
            ):
                usable[n] = text
        self.length = {n: len(text) for n, text in usable.items()}
        by_text = {text: n for n, text in usable.items()}
        self.shorter = {n: self._longest_prefix(text, by_text) for n, text in usable.items()}
        self.automaton = ahocorasick.Automaton()
        for text, n in by_text.items():
            self.automaton.add_word(text[::-1], (len(text), n))
        self.automaton.make_automaton()

        self.alphabet = _byte_alphabet()
        self.special = {t["content"]: t["id"] for t in config["added_tokens"]}
        longest_first = sorted(self.special, key=len, reverse=True)
        self.special_pattern = (
            re.compile("(" + "|".join(map(re.escape, longest_first)) + ")") if self.special else None
        )
        splitter = config["pre_tokenizer"]["pretokenizers"][0]
        self.words = regex.compile(splitter["pattern"]["Regex"])
        self.cache: dict[str, bytes] = {}

        texts = {n: token for token, n in model["vocab"].items()}
        texts |= {n: token for token, n in self.special.items()}
        pieces = [texts.get(n, "").encode() + b" " for n in range(size)]
        self.offsets = np.concatenate([[0], np.cumsum([len(p) for p in pieces])])
        self.buffer = np.frombuffer(b"".join(pieces), dtype=np.uint8)

    @staticmethod
    def _inner(token: str, suffix: str) -> str:
        return token.removesuffix(suffix) + _END if token.endswith(suffix) else token

    @staticmethod
    def _longest_prefix(text: str, known: dict[str, int]) -> int | None:
        for end in range(len(text) - 1, 0, -1):
            if text[:end] in known:
                return known[text[:end]]
        return None

    def _meets(self, left: int, right: int, before: float) -> bool:
        """Whether ``left`` and ``right`` come to stand side by side as they are.

        Goes back in time from both complete tokens to single symbols. At each moment the two
        symbols at the border must not merge before either of them grows into the next one. Among
        merges of one rank the leftmost comes first. ``before`` is when the two may merge.
        """
        born, grows_left, grows_right = self.born, before, before
        while True:
            across = self.pairs.get((left, right))
            if across is not None:
                when = born[across]
                if when < grows_left and when < before and when <= grows_right:
                    return False
            if born[left] > born[right]:
                grows_left, left = born[left], self.parts[left][1]
            elif born[right] >= 0:
                grows_right, right = born[right], self.parts[right][0]
            else:
                return True

    def _compatible(self, left: int, right: int) -> bool:
        return self._meets(left, right, float("inf"))

    def encode_symbols(self, symbols: str) -> list[int]:
        """Token ids of one word, given in byte-level characters with the end mark."""
        n = len(symbols)
        longest = [(0, None)] * n
        for end, found in self.automaton.iter(symbols[::-1]):
            if found > longest[n - 1 - end]:
                longest[n - 1 - end] = found
        length, shorter, compatible = self.length, self.shorter, self.compatible
        failed = bytearray(n + 1)
        out: list[int] = []
        pos, last = 0, None
        token = longest[0][1]
        while pos < n:
            while token is not None:
                end = pos + length[token]
                if not failed[end] and (last is None or compatible(last, token)):
                    break
                token = shorter[token]
            if token is not None:
                out.append(token)
                pos, last = end, token
                token = longest[pos][1] if pos < n else None
            elif out:
                failed[pos] = 1
                token = out.pop()
                last = out[-1] if out else None
                pos -= length[token]
            else:
                raise ValueError("the vocabulary lacks a symbol of the word")
        return out

    def _encode_new(self, word: str) -> bytes:
        alphabet = self.alphabet
        ids = self.encode_symbols("".join([alphabet[b] for b in word.encode()]) + _END)
        packed = struct.pack(f"={len(ids)}i", *ids)
        if len(word) <= _LONGEST_CACHED:
            if len(self.cache) >= _CACHED_WORDS:
                self.cache.clear()
            self.cache[word] = packed
        return packed

    def encode(self, text: str) -> np.ndarray:
        """Token ids of a whole text; strings of special tokens become those tokens."""
        out: list[bytes] = []
        parts = self.special_pattern.split(text) if self.special_pattern else [text]
        get, new = self.cache.get, self._encode_new
        for place, part in enumerate(parts):
            if place % 2:
                out.append(np.int32(self.special[part]).tobytes())
                continue
            # lower case goes letter by letter: no other form for a sigma at a word's end
            plain = unicodedata.normalize("NFC", part).replace("Σ", "σ").lower()
            out += [get(word) or new(word) for word in self.words.findall(plain)]
        return np.frombuffer(b"".join(out), dtype=np.int32)

    def decode(self, ids: np.ndarray) -> bytes:
        """The tokens' texts joined by one space, as the file names no decoder."""
        if not len(ids):
            return b""
        starts = self.offsets[ids]
        lengths = self.offsets[ids + 1] - starts
        ends = np.cumsum(lengths)
        place = np.repeat(starts - (ends - lengths), lengths)
        place += np.arange(ends[-1])
        return self.buffer[place[:-1]].tobytes()


@lru_cache(maxsize=4)
def load(path: str) -> WordBPE:
    """The tokenizer of a file, built once per process."""
    return WordBPE(path)


def encode_decode(df: DataFrame, path: str, *, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Token ids of every whole text and what they decode to: ``key``, ``ids``, ``decoded``.

    One row per row of ``df``, repeated rows included; other columns are not read. A NULL or empty
    text has no ids and decodes to an empty text; a NULL key stays NULL. No shuffle.
    """

    def make(texts: list[bytes]) -> list[pa.Array]:
        bpe = load(path)
        flat, ends, decoded = [], [0], []
        for raw in texts:
            ids = bpe.encode(raw.decode("utf-8", "replace"))
            flat.append(ids)
            ends.append(ends[-1] + len(ids))
            decoded.append(bpe.decode(ids))
        values = pa.array(np.concatenate(flat) if flat else np.empty(0, np.int32))
        ids = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), values)
        return [ids, pa.array(decoded, pa.binary()).cast(pa.string())]

    return arrow_rows(df, [key], text, make, "ids array<int>, decoded string", largest=128)


def joined_ids(ids: str) -> Column:
    """Decimal ids joined by one space."""
    return F.array_join(F.col(ids).cast("array<string>"), " ")


def digests(encoded: DataFrame, *, key: str = "doc_id") -> DataFrame:
    """Per row of ``encode_decode``: number of tokens, and SHA-256 of the ids and of the decoded text."""
    return encoded.select(
        key,
        F.size("ids").cast("bigint").alias("n_tokens"),
        F.sha2(joined_ids("ids"), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )
