import random

import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from llm import edge
from tokenizers import Tokenizer

from tallywork.llm import token_counts

PATH = public_tokenizers.path("byte_bpe_50k.json")
LIBRARY = Tokenizer.from_file(PATH)


def _library(text):
    return len(LIBRARY.encode(text, add_special_tokens=False).ids)


def _brute(text):
    return [_library(text[:i]) for i in range(len(text) + 1)]


ODD = (
    "",
    " ",
    "a  b\n\n c\t\td   ",
    "I'll we've they're it's 'll've're 're",
    "x 'r 'll''re",
    "hi  <|endoftext|><|endoftext|> there <|endoftext|",
    "!<|endoftext|>  \n x",
    "Grüße, ΟΔΥΣΣΕΥΣ 你好 \U0001f600\U0001f600 naïve　space   z",
    "aaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaa",
    "=" * 130 + " " * 90 + "x" + "0123456789" * 8,
    "hello \U00010d4a\U0001ccf0 ⁒ Ᲊx \U0001c000",
)


@pytest.mark.parametrize("text", ODD)
def test_every_prefix(text):
    assert token_counts.load(PATH).counts(text).tolist() == _brute(text)


PIECES = st.sampled_from(
    ["'", "'r", "re", "ll", " ", "  ", "\n", "\t", "<|endoftext|>", "<|", "ab", "the", " The", "0", "!", "é", "한", " "]
)


@settings(max_examples=150, deadline=None)
@given(st.lists(PIECES | st.characters(exclude_categories=["Cs"]), max_size=14).map("".join))
def test_every_prefix_of_random_texts(text):
    assert token_counts.load(PATH).counts(text).tolist() == _brute(text)


def test_every_code_point_is_split_as_in_the_library():
    counter = token_counts.load(PATH)
    points = [chr(c) for c in range(0x20000) if not 0xD800 <= c < 0xE000]
    for start in range(0, len(points), 4096):
        some = points[start : start + 4096]
        text = "".join(f"a{c}a {c}0{c} !{c}" for c in some)
        assert counter.counts(text)[-1] == _library(text)


def test_long_texts_are_cut_between_words(monkeypatch):
    rng = random.Random(3)
    text = "".join(rng.choice(["word", " ", "  ", "\n", "'ll", "é", " the", "9"]) for _ in range(400))
    whole = token_counts.load(PATH).counts(text).tolist()
    monkeypatch.setattr(token_counts, "_AT_ONCE", 7)
    assert token_counts.load(PATH).counts(text).tolist() == whole == _brute(text)


def test_words_move_between_the_generations_of_the_cache(monkeypatch):
    monkeypatch.setattr(token_counts, "_CACHED_WORDS", 3)
    counter = token_counts.PrefixCounter(PATH)
    for text in ("a b c d e f a b", "f g a a h é a", "a b"):
        assert counter.counts(text).tolist() == _brute(text)


def test_tables_and_questions(spark):
    df = token_counts.prefix_counts(edge.documents(spark), PATH, keep=["doc_id", "text"], budgets={"fits": 3})
    rows = df.select(
        "text",
        "counts",
        "fits",
        token_counts.whole_count().alias("n"),
        token_counts.count_of_prefix(5).alias("five"),
        token_counts.longest_prefix(3).alias("three"),
    ).collect()
    assert sorted(map(repr, (r.text for r in rows))) == sorted(repr(r[1]) for r in edge.ROWS)
    for r in rows:
        text = r.text or ""
        short = [_library(text[:i]) for i in range(min(len(text), 60) + 1)]
        assert r.counts[: len(short)] == short and len(r.counts) == len(text) + 1
        assert r.n == _library(text)
        assert r.five == _library(text[:5])
        assert r.three == r.fits == max(i for i, n in enumerate(r.counts) if n <= 3)
    assert token_counts.prefix_counts(edge.empty(spark), PATH, keep=["doc_id"]).collect() == []


def test_a_name_that_clashes(spark):
    df = edge.documents(spark).withColumnRenamed("size", "counts")
    assert token_counts.prefix_counts(df, PATH, keep=["doc_id"]).columns == ["doc_id", "counts"]
    with pytest.raises(ValueError, match="counts"):
        token_counts.prefix_counts(df, PATH, keep=["counts"])
