"""Encoding by pieces against the library on whole texts."""

import numpy as np
import public_tokenizers
import pyarrow.parquet as pq
import pytest
from tokenizers import Tokenizer

from barline.llm.tokens import Encoder

TEXTS = [
    None, "", " ", "\n\n", "a   b", "x\n \n y  ", "  lead", "trail \t ", " x", "z" * 5000 + " end", "Don't I'LL it's 1234 x", "é ́x ΣΑΣ. Ünï cödé", "the.and|so 'tis", "a \t b c", "\x1c y\x01z", "日本語 テスト 😀 a",
    "<|endoftext|> a<|startoftext|>", "a <|endoftext|> b", "<|ENDOFTEXT|> b", "<|endoftext", "a <| b", "ﬁ ½ ² ª", "İstanbul ŉ",
]


@pytest.mark.parametrize("name", ["word_bpe_49k.json", "byte_bpe_50k.json"])
def test_pieces_encode_like_whole_texts(name):
    path = public_tokenizers.path(name)
    plain, e = Tokenizer.from_file(path), Encoder(path)
    documents = pq.read_table("/root/testdata/sf0.01/documents.parquet", columns=["text"]).column(0).to_pylist()
    for texts in (TEXTS, TEXTS[::-1], documents):  # the second time from what is kept
        for x, got in zip(texts, e.encode_all(texts, 7), strict=True):
            assert got == np.array([*plain.encode(x or "", add_special_tokens=False).ids, 7], "<u4").tobytes(), x


def test_added_tokens_are_one_id():
    ids = lambda name: np.frombuffer(Encoder(public_tokenizers.path(name)).encode("a <|endoftext|> b"), "<u4").tolist()
    assert ids("word_bpe_49k.json") == [320, 49407, 321] and ids("byte_bpe_50k.json") == [64, 220, 50256, 275]


def test_what_is_kept_is_bounded(monkeypatch):
    from barline.llm import tokens

    path = public_tokenizers.path("byte_bpe_50k.json")
    plain, e = Tokenizer.from_file(path), Encoder(path)
    for k in ("KEPT_PIECES", "KEPT_IDS", "KEPT_PARTS", "CHUNK_BYTES"):
        monkeypatch.setattr(tokens, k, 40)
    for lo in range(0, 2000, 50):
        text = " ".join(f"word{i}" for i in range(lo, lo + 50))
        assert e.encode(text) == np.array(plain.encode(text).ids, "<u4").tobytes()
    assert len(e.size) < 200 and len(e.parts) < 400


def test_kept_ids_are_appended_in_place(monkeypatch):
    from barline.llm import tokens

    e = Encoder(public_tokenizers.path("byte_bpe_50k.json"))
    e.encode(" ".join(f"word{i}" for i in range(20_000)))
    e.encode("another piece, héé")
    held = e.flat
    e.encode("onemore")
    assert e.flat is held and e.n_ids <= len(held)  # new pieces do not copy what is kept
