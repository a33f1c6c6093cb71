"""Counts held against the library's ids, on whole texts."""

import random
import sys

import public_tokenizers
import pytest
from tokenizers import Tokenizer

from barline.llm import token_counts

PATH = public_tokenizers.path("byte_bpe_50k.json")
TEXTS = [
    None, "", " ", "  \n\n ", "one", " one  two\t\tthree \n", "it's we'll 'sorted' don't", "<|endoftext|>", "a <|endoftext|> b<|endoftext|>", "<|endoftext|", "z" * 5000 + " end",
    "foo  bar   baz", "a  b　c   d", "x\x1c y\x1f  z\x85 w", "Ünï cödé naïve straße", "日本語 テキスト 中文。", "🙂🙂 🏳️‍🌈 é", "١٢٣ 456 ⅷ", "᠎ ᠎a !᠎ !", "0123456789abcdef" * 40, "\r\n a\r\n\r\n  b \x00 c",
]


@pytest.fixture(scope="module")
def library():
    t = Tokenizer.from_file(PATH)
    return lambda x: len(t.encode(x or "", add_special_tokens=False).ids)


@pytest.mark.parametrize("chunk", [1 << 20, 7])
def test_counts_equal_the_library(library, monkeypatch, chunk):
    monkeypatch.setattr(token_counts, "CHUNK", chunk)
    monkeypatch.setattr(token_counts, "KEPT", 50)
    counter = token_counts.Counter(PATH)
    assert [counter.count(t) for t in TEXTS] == [library(t) for t in TEXTS]
    rng = random.Random(5)
    letters = "ab c\t\n'sdlE.,!9é  日🙂ß\x1d\x85<|>"
    for _ in range(3000):
        text = "".join(rng.choice(letters) for _ in range(rng.randrange(60)))
        assert counter.count(text) == library(text), text


def test_every_character_is_cut_as_the_library_does(library):
    counter = token_counts.Counter(PATH)
    chars = [chr(c) for c in [*range(0x3400), *range(0x3400, sys.maxunicode + 1, 61)] if not 0xD800 <= c < 0xE000]
    for lo in range(0, len(chars), 500):
        text = "".join(f"!{c} {c}! a{c}  {c}1 " for c in chars[lo : lo + 500])
        assert counter.count(text) == library(text), hex(ord(chars[lo]))


def test_merging_is_by_rank_and_place():
    # a a a -> (aa) a: leftmost first; (aa) a of a lower rank than a b is merged before it
    ranks = {(0, 0): 0, (2, 0): 1, (0, 1): 2}
    assert token_counts.merged([0, 0, 0, 1], ranks, [2, 3, 4]) == 2
    assert token_counts.merged([0, 1, 0, 1], ranks, [2, 3, 4]) == 2
    assert token_counts.merged([1, 1], ranks, [2, 3, 4]) == 2 and token_counts.merged([], ranks, []) == 0


def test_counted_rows(spark, library):
    rows = [(i, t, "clash", 7, True) for i, t in enumerate([*TEXTS, "word " * 512, "word " * 100_000, "again", "again"])] + [(None, "no id", None, None, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, n_bytes string, n_tokens int, over_limit boolean").repartition(3)
    got = sorted(token_counts.counted(df, PATH).collect(), key=lambda r: (r.doc_id is None, r.doc_id))
    assert [(r.doc_id, r.n_bytes, r.n_tokens, r.over_limit) for r in got] == [(i, len((t or "").encode()), library(t), library(t) > 512) for i, t, *_ in rows]
    assert token_counts.counted(df.where("false"), PATH).count() == 0


def test_other_vocabularies_are_refused():
    with pytest.raises(ValueError, match="byte-level"):
        token_counts.Counter(public_tokenizers.path("word_bpe_49k.json"))
