"""Token counts by heap-and-linked-list byte-pair merging.

The library's own pre-tokenizer cuts a text into parts, as bytes. A part's bytes are its
first symbols, in a doubly linked list; a heap holds the rank and place of each adjacent
pair that the vocabulary merges. The pair of lowest rank, leftmost first, is popped and
merged until none is left. The count is the number of first symbols less that of merges:
no identifier is looked up or emitted, and nothing is shuffled.

A text is cut before white space that follows something else, where parts always end, and
each distinct piece is counted once per Python worker, in a cache of bounded size. Pieces
are found by their characters, so that counts are exact.

Defined results: a null text is an empty one, of no byte and no token; a special token's
string in a text is one token, as the library reads it by default; rows repeat as they
are; an empty table gives no row. Only doc_id and text are read.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterable, Iterator
from heapq import heapify, heappop, heappush

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barline.llm import common

LIMIT = 512
#: Pieces and parts whose counts a worker keeps at most, and characters of the longest kept.
KEPT = 1 << 18
KEPT_CHARS = 64
#: Characters of a text that are cut at once.
CHUNK = 1 << 20

_WHITE = "\\x20\\x09-\\x0d"
_ODD = "\\x1c-\\x1f\\x85\\xa0\\u1680\\u180e\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000"
_PIECE = re.compile(f"[{_WHITE}]*[^{_WHITE}]+|[{_WHITE}]+")
_CUT = re.compile(f"(?<=[^{_WHITE}{_ODD}])(?=[{_WHITE}])")
_HAS_ODD = re.compile(f"[{_ODD}]")

SCHEMA = "doc_id long, n_bytes long, n_tokens long, over_limit boolean"


def merged(symbols: list[int], ranks: dict[tuple[int, int], int], made: list[int]) -> int:
    """Symbols left when no pair of ``ranks`` is; ``made`` has the symbol that each rank's merge makes."""
    n = left = len(symbols)
    after, before = list(range(1, n + 1)), list(range(-1, n - 1))
    heap = [(ranks[p], i, p) for i, p in enumerate(zip(symbols, symbols[1:], strict=False)) if p in ranks]
    heapify(heap)
    while heap:
        rank, i, pair = heappop(heap)
        j = after[i]
        if j == n or (symbols[i], symbols[j]) != pair:  # one of them has been merged since
            continue
        symbols[i], symbols[j] = made[rank], -1
        k = after[i] = after[j]
        left -= 1
        if k < n:
            before[k] = i
            pair = symbols[i], symbols[k]
            if pair in ranks:
                heappush(heap, (ranks[pair], i, pair))
        h = before[i]
        if h >= 0:
            pair = symbols[h], symbols[i]
            if pair in ranks:
                heappush(heap, (ranks[pair], h, pair))
    return left


class _Counts(dict):
    """Counts by string; one that is missing is counted and, if short, kept."""

    def __init__(self, count):
        self.count = count

    def __missing__(self, key: str) -> int:
        n = self.count(key)
        if len(key) <= KEPT_CHARS:
            if len(self) >= KEPT:
                self.clear()
            self[key] = n
        return n


class Counter:
    """Tokens of texts under a byte-level BPE vocabulary in the ``tokenizers`` library's format."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        told = json.loads(Tokenizer.from_file(path).to_str())
        model, cut = told["model"], told["pre_tokenizer"]
        special = told["added_tokens"]
        plain = model["type"] == "BPE" and not any(model.get(k) for k in ("dropout", "unk_token", "continuing_subword_prefix", "end_of_word_suffix", "byte_fallback", "ignore_merges"))
        if not plain or told["normalizer"] or told["post_processor"] or cut["type"] != "ByteLevel" or cut["add_prefix_space"] or any(t[k] for t in special for k in ("lstrip", "rstrip", "single_word")):
            raise ValueError("counts are of plain byte-level BPE vocabularies")
        self.cut = Tokenizer.from_file(path).pre_tokenizer.pre_tokenize_str
        self.symbol = {t: i for t, i in model["vocab"].items() if len(t) == 1}
        pairs = [p if isinstance(p, list) else p.split(" ") for p in model["merges"]]
        vocab = model["vocab"]
        self.ranks = {(vocab[a], vocab[b]): r for r, (a, b) in enumerate(pairs)}
        self.made = [vocab[a + b] for a, b in pairs]
        self.special = re.compile("|".join(re.escape(t["content"]) for t in sorted(special, key=lambda t: -len(t["content"]))) or "(?!)")
        self.parts, self.pieces = _Counts(self._part), _Counts(self._piece)

    def _part(self, part: str) -> int:
        return merged([self.symbol[c] for c in part], self.ranks, self.made)

    def _piece(self, piece: str) -> int:
        return sum(self.parts[p] for p, _ in self.cut(piece))

    def _cuts(self, text: str) -> Iterator[Iterable[str]]:
        at = 0
        while at < len(text):
            end = _CUT.search(text, at + CHUNK) if len(text) - at > CHUNK else None
            some = text[at : end.start()] if end else text[at:]
            yield _CUT.split(some) if _HAS_ODD.search(some) else _PIECE.findall(some)
            at += len(some)

    def count(self, text: str | None) -> int:
        if not text:
            return 0
        known, n = self.pieces.__getitem__, 0
        for k, section in enumerate(self.special.split(text)):
            n += bool(k) + sum(sum(map(known, pieces)) for pieces in self._cuts(section))
        return n


_workers: dict[str, Counter] = {}


def counter(path: str) -> Counter:
    """One counter per Python worker and vocabulary file."""
    if path not in _workers:
        _workers[path] = Counter(path)
    return _workers[path]


def counted(docs: DataFrame, vocabulary_path: str, limit: int = LIMIT, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_bytes (UTF-8), n_tokens, over_limit (more than ``limit`` tokens) of each row."""
    common.prepare(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = counter(vocabulary_path).count
        for b in batches:
            n = [count(t) for t in b.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("n_bytes"), pa.array(n, pa.int64()), pa.array([x > limit for x in n], pa.bool_())], ["doc_id", "n_bytes", "n_tokens", "over_limit"])

    text = F.col(text_col)
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.octet_length(text), F.lit(0)).cast("long").alias("n_bytes"), text.alias("text"))
    return rows.mapInArrow(run, SCHEMA)


def query(spark, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return counted(common.table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))
