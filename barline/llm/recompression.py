"""Symbols of words by recompression, for whole batches of texts at once.

A round pairs neighbours: a hash of a symbol's name and of the round's number puts it
left or right, and a left one followed by a right one becomes one symbol, named by a
hash of both names. Before the first round, runs of one word become one symbol. Names
depend on nothing but what they stand for, so all tasks name alike.

Each symbol carries its context: the words that decided that it exists. Two equal
stretches of words hold equal symbols wherever the context lies within them.
"""

from __future__ import annotations

import numpy as np

from barline.llm.words import mix


def symbols(h: np.ndarray, first: np.ndarray, rounds: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """name, number of words, context start and context end (exclusive), in order of place.

    ``h`` are the words' hashes, ``first`` the place of each text's first word, and the
    number of all words at the end. A symbol that owes itself to an end of its text has a
    context that reaches beyond.
    """
    n = len(h)
    if not n:
        return h, *(np.zeros(0, np.int64) for _ in range(3))
    head = np.zeros(n + 1, bool)
    head[first] = True
    cut = head[:-1] | np.concatenate([[True], h[1:] != h[:-1]])
    at = np.flatnonzero(cut)
    size = np.diff(at, append=n)
    name = np.where(size > 1, mix(h[at] + mix(size.astype(np.uint64))), h[at])
    head = head[at]  # whether a symbol opens its text
    tail = np.append(head[1:], True)
    lo, hi = at - 1, at + size + 1  # a run ends where another word stands, or its text does
    for k in range(rounds):
        right = (mix(name + np.uint64(0x632BE59BD9B4E019 * (k + 1) & (1 << 64) - 1)) >> np.uint64(63)).astype(bool)
        joins = ~right[:-1] & right[1:] & ~head[1:]
        opens, closes = np.append(joins, False), np.append(False, joins)
        # what stays alone has looked at one neighbour: the next if left, the one before if right
        alone = ~opens & ~closes
        new_lo, new_hi = lo.copy(), hi.copy()
        see = np.flatnonzero(alone & right & ~head)
        new_lo[see] = np.minimum(lo[see], lo[see - 1])
        new_hi[see] = np.maximum(hi[see], hi[see - 1])
        see = np.flatnonzero(alone & ~right & ~tail)
        new_hi[see] = np.maximum(hi[see], hi[see + 1])
        new_lo[see] = np.minimum(lo[see], lo[see + 1])
        o = np.flatnonzero(opens)
        new_lo[o] = np.minimum(lo[o], lo[o + 1])
        new_hi[o] = np.maximum(hi[o], hi[o + 1])
        name, size = name.copy(), size.copy()
        name[o] = mix(name[o] * np.uint64(0xD6E8FEB86659FD93) + mix(name[o + 1]))
        size[o] += size[o + 1]
        tail[o] = tail[o + 1]
        keep = ~closes
        name, size, lo, hi, head, tail = name[keep], size[keep], new_lo[keep], new_hi[keep], head[keep], tail[keep]
    return name, size, lo, hi
