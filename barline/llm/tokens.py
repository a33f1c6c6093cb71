"""Whole-text encoding with the ``tokenizers`` library, one call per distinct piece.

Both vocabularies cut a text before they merge bytes, and never between two characters
that are not white space only because of what stands beyond the white space around them.
A text is therefore cut where white space follows something else; the ids of a piece do
not depend on its neighbours. Pieces that recur are encoded once per Python worker: a
table of fixed size finds them by a 64-bit hash of their bytes. Texts that hold an added
token's string or other white space than ASCII's are encoded whole, as the library does
by default. ``tests/llm/test_tokens.py`` holds the result against ``Tokenizer.from_file``
on whole texts.
"""

from __future__ import annotations

import os
import re
from itertools import chain

import numpy as np

from barline.llm import common
from barline.llm.words import span_hashes, spans

#: White space and separators that are not ASCII white space.
_ODD = re.compile("[\\x1c-\\x1f\\x85\\xa0\\u1680\\u180e\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000]")

#: Letters, digits and marks of which both vocabularies' classes are certain, and which normalising only lowers.
_LETTERS = "A-Za-z\\xc0-\\xd6\\xd8-\\xf6\\xf8-\\u012f\\u0131-\\u017e"
_PLAIN = re.compile(f" ?[!-~{_LETTERS}]+")
#: The vocabularies' patterns, for such pieces.
_LOWER_PARTS = re.compile(f"'s|'t|'re|'ve|'m|'ll|'d|[{_LETTERS}]+|[0-9]|[^ {_LETTERS}0-9]+")
_BYTE_PARTS = re.compile(f"'s|'t|'re|'ve|'m|'ll|'d| ?[{_LETTERS}]+| ?[0-9]+| ?[^ {_LETTERS}0-9]+")
KEPT_PARTS = 100_000
_ASCII_LETTER = np.zeros(256, bool)
_ASCII_LETTER[[*range(0x41, 0x5B), *range(0x61, 0x7B)]] = True
#: Stands in no text that is cut.
_BETWEEN = "\x1c"

#: Places of the table of known pieces, and pieces and ids kept at most.
SLOT_BITS = 20
KEPT_PIECES = 1 << 19
KEPT_IDS = 1 << 21
#: Bytes of text that are cut at once.
CHUNK_BYTES = 1 << 18

def _byte_letters() -> dict[int, str]:
    """How byte-level vocabularies write a byte: printable ones as themselves, the others from U+0100 on."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in shown]
    return {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(hidden)}


def _appended(x: np.ndarray, used: int, more: np.ndarray) -> np.ndarray:
    """``x`` with ``more`` after its first ``used`` places; longer than that by a half, so that few calls copy."""
    if used + len(more) > len(x):
        x = np.concatenate([x[:used], np.empty(max(used + len(more), len(x) * 3 // 2) - used, x.dtype)])
    x[used : used + len(more)] = more
    return x


class Encoder:
    """Texts to unsigned 32-bit ids."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.vocabulary = self.tokenizer.get_vocab_size(with_added_tokens=True)
        # New pieces are encoded many at a time, parted by an added token.
        added = {x.content: i for i, x in self.tokenizer.get_added_tokens_decoder().items()}
        self.mark, self.mark_id = next(iter(added.items()))
        self.added = re.compile("|".join(map(re.escape, added)), re.IGNORECASE)
        # A vocabulary that drops white space needs only what lies between.
        self.drops = not self.tokenizer.encode(" \n ", add_special_tokens=False).ids
        self.model, self.letters = self.tokenizer.model, _byte_letters()
        self.parts: dict[str, list[int]] = {}
        self._clear()

    def _clear(self) -> None:
        self.tags = np.zeros(1 << SLOT_BITS, np.uint64)
        self.codes = np.zeros(1 << SLOT_BITS, np.int32)
        self.n_pieces = self.n_ids = 0  # places used of these
        self.start = np.zeros(0, np.int32)  # of each piece's ids
        self.size = np.zeros(0, np.int32)
        self.flat = np.zeros(0, np.uint32)

    def encode(self, text: str | None) -> bytes:
        return self.encode_all([text])[0]

    def encode_all(self, texts: list[str | None], end: int | None = None) -> list[bytes]:
        """Little-endian ids of each text, and ``end`` after them."""
        tail = b"" if end is None else int(end).to_bytes(4, "little")
        out: list[bytes] = []
        part: list[bytes] = []
        held = 0

        def flush() -> None:
            nonlocal part, held
            out.extend(x + tail for x in self._cut(part))
            part, held = [], 0

        for t in texts:
            t = t or ""
            if not t.isascii() and _ODD.search(t) or t.isascii() and any(c in t for c in "\x1c\x1d\x1e\x1f") or "<|" in t and self.added.search(t):
                flush()
                out.append(np.array(self.tokenizer.encode(t, add_special_tokens=False).ids, "<u4").tobytes() + tail)
                continue
            raw = t.encode("utf-8", "surrogatepass")
            part.append(raw)
            held += len(raw)
            if held > CHUNK_BYTES:
                flush()
        flush()
        return out

    def _cut(self, texts: list[bytes]) -> list[bytes]:
        if not texts:
            return []
        raw, starts, ends, first = spans(texts)
        if not self.drops:  # white space before a word belongs to it; at the end of a text it is a piece
            at = np.cumsum([0, *(len(t) + 1 for t in texts)])
            starts = np.concatenate([[0], ends[:-1]])[: len(ends)]
            has = first[1:] > first[:-1]
            starts[first[:-1][has]] = at[:-1][has]
            last = at[:-1].copy()
            last[has] = ends[first[1:][has] - 1]
            more = np.flatnonzero(last < at[1:] - 1)
            starts, ends = np.insert(starts, first[1:][more], last[more]), np.insert(ends, first[1:][more], at[1:][more] - 1)
            first = first + np.concatenate([[0], np.cumsum(np.bincount(more, minlength=len(texts)))])
        code = self._known(raw, starts, ends)
        size = self.size[code]
        edge = np.concatenate([[0], np.cumsum(size)])
        ids = self.flat[np.repeat(self.start[code] - edge[:-1], size) + np.arange(edge[-1])].tobytes()
        at = (4 * edge[first]).tolist()
        return [ids[a:b] for a, b in zip(at[:-1], at[1:], strict=True)]

    def _known(self, raw: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """The number under which each piece's ids are kept; new pieces are encoded."""
        if self.n_pieces > KEPT_PIECES or self.n_ids > KEPT_IDS:
            self._clear()
        h = span_hashes(raw, starts, ends) | np.uint64(1)  # no hash is that of an empty place
        slot = (h >> np.uint64(64 - SLOT_BITS)).astype(np.int64)
        code = self.codes[slot]
        miss = np.flatnonzero(self.tags[slot] != h)
        if len(miss):
            new, at, back = np.unique(h[miss], return_index=True, return_inverse=True)
            flat, size = self._encoded(raw, starts[miss[at]], ends[miss[at]])
            codes = self.n_pieces + np.arange(len(new))
            self.start = _appended(self.start, self.n_pieces, self.n_ids + np.cumsum(size) - size)
            self.size, self.flat = _appended(self.size, self.n_pieces, size), _appended(self.flat, self.n_ids, flat)
            self.n_pieces, self.n_ids = self.n_pieces + len(new), self.n_ids + len(flat)
            code[miss] = codes[back]
            place = (new >> np.uint64(64 - SLOT_BITS)).astype(np.int64)
            self.tags[place], self.codes[place] = new, codes
            twice = self.tags[place] != new  # two new pieces of one place: the later stays
            self.codes[place[twice]] = codes[np.searchsorted(new, self.tags[place[twice]])]
        return code

    def _ids(self, part: str) -> list[int]:
        if not part.isascii():
            part = part.encode().decode("latin-1").translate(self.letters)
        elif part[0] == " ":
            part = self.letters[0x20] + part[1:]
        return [t.id for t in self.model.tokenize(part)]

    def _encoded(self, raw: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all pieces, and how many each has."""
        split, known = (_LOWER_PARTS if self.drops else _BYTE_PARTS).findall, self.parts
        # a word of ASCII letters, and white space of one blank before it, is one part
        other = np.concatenate([[0], np.cumsum(~_ASCII_LETTER[raw])])
        at = starts + (raw[starts] == 0x20)
        words = ((at < ends) & (other[at] == other[ends])).tolist()
        held = raw.tobytes()
        pieces = _BETWEEN.encode().join([held[a:b] for a, b in zip(starts.tolist(), ends.tolist(), strict=True)]).decode("utf-8", "surrogatepass").split(_BETWEEN)
        out: list[list[int] | None] = []
        for piece, word in zip(pieces, words, strict=True):
            if not word and not _PLAIN.fullmatch(piece):
                out.append(None)
                continue
            if self.drops:
                piece = piece.lower()
            if word:
                ids = known.get(piece)
                if ids is None:
                    ids = known[piece] = self._ids(piece)
            else:
                ids = []
                for part in split(piece):
                    got = known.get(part)
                    if got is None:
                        got = known[part] = self._ids(part)
                    ids += got
            out.append(ids)
        if len(known) > KEPT_PARTS:
            known.clear()
        other = [i for i, ids in enumerate(out) if ids is None]
        for lo in range(0, len(other), 20_000):
            some = other[lo : lo + 20_000]
            got = np.array(self.tokenizer.encode_batch_fast([self.mark.join(pieces[i] for i in some)], add_special_tokens=False)[0].ids, np.uint32)
            for i, ids in zip(some, np.split(got, np.flatnonzero(got == self.mark_id)), strict=True):
                out[i] = ids[ids != self.mark_id].tolist()
        size = np.fromiter(map(len, out), np.int64, len(out))
        return np.fromiter(chain.from_iterable(out), np.uint32, int(size.sum())), size


def encoder(path: str) -> Encoder:
    """One encoder per Python worker and vocabulary file, until a task that does not keep it."""
    name = kept_as(path)
    if name not in common.kept:
        common.kept[name] = Encoder(path)
    return common.kept[name]


def kept_as(path: str) -> str:
    return f"encoder {path}"
