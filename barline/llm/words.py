"""Words and runs of words as 64-bit hashes, for whole batches of texts at once."""

from __future__ import annotations

import numpy as np

_WHITE = np.zeros(256, bool)
_WHITE[[0x20, *range(0x09, 0x0E)]] = True
LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
_BASE = 0x9E3779B97F4A7C15 | 1
_powers = np.ones(1, np.uint64)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers whose every output bit depends on every input bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _power(n: int) -> np.ndarray:
    global _powers
    if len(_powers) < n:
        p = np.full(1 << int(n - 1).bit_length(), _BASE, np.uint64)
        p[0] = 1
        _powers = np.multiply.accumulate(p)
    return _powers[:n]


def spans(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Bytes of all texts, start and end of each word in them, and each text's first word (one more at the end)."""
    raw = np.frombuffer(b"\n".join(texts) + b"\n", np.uint8)
    white = _WHITE[raw]
    edge = np.flatnonzero(np.diff(white, prepend=True))
    starts, ends = edge[::2], edge[1::2]
    at = np.cumsum([0, *(len(t) + 1 for t in texts)])
    return raw, starts, ends, np.searchsorted(starts, at)


def span_hashes(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A hash of the bytes of each span; equal bytes have equal hashes, wherever they stand."""
    p = _power(len(raw) + 1)
    total = np.zeros(len(raw) + 1, np.uint64)
    np.cumsum((raw.astype(np.uint64) + np.uint64(1)) * p[:-1], out=total[1:])
    h = (total[ends] - total[starts]) * p[len(raw) - starts]
    # the factor p**len(raw) is taken out, so that equal bytes agree between batches
    inverse = np.uint64(pow(_BASE, -len(raw), 1 << 64))
    return mix(h * inverse ^ (ends - starts).astype(np.uint64))


def hashed(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """A hash for each word of all texts, and each text's first word (one more at the end)."""
    raw, starts, ends, first = spans(texts)
    return span_hashes(raw, starts, ends), first


def runs(h: np.ndarray, width: int) -> np.ndarray:
    """Hash of each run of ``width`` words; the last ``width - 1`` places have none."""
    n = len(h) - width + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = np.zeros(n, np.uint64)
    for k in range(width):
        out = mix(out + h[k : k + n]) * np.uint64(0xD6E8FEB86659FD93)
    return mix(out)


def rolling(h: np.ndarray, width: int) -> np.ndarray:
    """Like ``runs``, by prefix sums: a few passes, however wide."""
    n = len(h) - width + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    p = _power(len(h) + 1)
    total = np.zeros(len(h) + 1, np.uint64)
    np.cumsum(h * p[:-1], out=total[1:])
    at = np.arange(n)
    inverse = np.uint64(pow(_BASE, -len(h), 1 << 64))
    return mix((total[width:] - total[:n]) * p[len(h) - at] * inverse)
