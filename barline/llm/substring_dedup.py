"""Substring dedup: words covered by a run of WIDTH words that also starts earlier go.

Recompression names stretches of words (``recompression.py``): equal stretches hold
equal symbols wherever the symbols' context lies within them. A Spark round finds the
symbols that occur more than once. A run of WIDTH words that contains the context of a
symbol that occurs once cannot recur; all other runs are verified by 96-bit hashes of
their words, again across all texts, and the first of each (least id, then place) stays.
Runs without a symbol of their own are verified too, so no repeat is missed.

A run that recurs within one batch of rows is sent once; its later places are known at
once, so a passage that a third of all texts share is spread and counted once a batch.

Defined results: a null text has no words; null ids come before all others (the least
64-bit number counts as one); rows that
share id and text are one document twice and get the same result; an empty table gives
no row. Columns other than the two named ones are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barline.llm import common
from barline.llm.recompression import symbols
from barline.llm.words import hashed, mix, rolling

WIDTH = 20
ROUNDS = 3
#: Shorter symbols recur by chance and are not looked up.
LEAST_WORDS = 3
_NULL_ID = -(1 << 63)


def _texts(b: pa.RecordBatch) -> list[bytes]:
    return [(t or "").encode("utf-8", "surrogatepass") for t in b.column("text").to_pylist()]


def _looked_up(h: np.ndarray, first: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Name, context start and end of the symbols that can rule out a run."""
    name, size, lo, hi = symbols(h, first, ROUNDS)
    within = np.searchsorted(first, lo, "right") == np.searchsorted(first, hi - 1, "right")
    use = (size >= LEAST_WORDS) & (hi - lo <= width) & within
    return name[use], lo[use], hi[use]


def twice_at_most(names: np.ndarray) -> np.ndarray:
    """Each name once, and once more if it recurs."""
    names = np.sort(names)
    again = np.concatenate([[False], names[1:] == names[:-1]]) if len(names) else np.zeros(0, bool)
    return np.concatenate([names[~again], np.unique(names[again])])


def candidates(h: np.ndarray, first: np.ndarray, recurring: np.ndarray, width: int) -> np.ndarray:
    """Places where a run of ``width`` words within one text starts that no symbol rules out."""
    n = len(h) - width + 1
    if n <= 0:
        return np.zeros(0, np.int64)
    name, lo, hi = _looked_up(h, first, width)
    once = ~np.isin(name, recurring)
    change = np.bincount(np.maximum(hi[once] - width, 0), minlength=len(h) + 1) - np.bincount(lo[once] + 1, minlength=len(h) + 1)
    text = np.repeat(np.arange(len(first) - 1), np.diff(first))
    return np.flatnonzero((np.cumsum(change)[:n] == 0) & (text[:n] == text[width - 1 :]))


#: A run of words: two hashes of it, the document, its version and the place.
RUN = np.dtype([("a", "<u8"), ("c", "<u4"), ("d", "<i8"), ("w", "<i8"), ("start", "<u4")])


def repeats(x: np.ndarray) -> np.ndarray:
    """Whether an equal run stands before: in a lesser document, or earlier in the same."""
    order = np.lexsort((x["start"], x["w"], x["d"], x["c"], x["a"]))
    a, c = x["a"][order], x["c"][order]
    out = np.zeros(len(x), bool)
    out[order[1:]] = (a[1:] == a[:-1]) & (c[1:] == c[:-1])
    return out


def packed(x: np.ndarray) -> bytes:
    """Runs column by column, which compresses better than row by row."""
    return b"".join(x[f].tobytes() for f in RUN.names)


def unpacked(raw: bytes) -> np.ndarray:
    n = len(raw) // RUN.itemsize
    out, at = np.zeros(n, RUN), 0
    for f in RUN.names:
        out[f] = np.frombuffer(raw, RUN[f], n, at)
        at += n * RUN[f].itemsize
    return out


def dealt(x: np.ndarray, by: np.ndarray, buckets: int) -> list[tuple[int, bytes]]:
    """(bucket, packed runs): the runs dealt out by the number ``by``."""
    bucket = by % np.uint64(buckets)
    order = np.argsort(bucket, kind="stable")
    edge = np.searchsorted(bucket[order], np.arange(buckets + 1, dtype=np.uint64))
    return [(k, packed(x[order[edge[k] : edge[k + 1]]])) for k in np.flatnonzero(np.diff(edge)).tolist()]


def stretches(x: np.ndarray) -> list[tuple[int, int, bytes]]:
    """(document, version, packed (first place, number of places) of unbroken stretches) of runs."""
    if not len(x):
        return []
    x = x[np.lexsort((x["start"], x["w"], x["d"]))]
    other = np.concatenate([[True], (x["d"][1:] != x["d"][:-1]) | (x["w"][1:] != x["w"][:-1])])
    opens = np.flatnonzero(other | np.concatenate([[True], np.diff(x["start"].astype(np.int64)) > 1]))
    last = x["start"][np.append(opens[1:] - 1, len(x) - 1)]
    both = np.stack([x["start"][opens], last - x["start"][opens] + 1], axis=1).astype("<u4")
    edge = np.append(np.flatnonzero(other[opens]), len(opens)).tolist()
    return [(int(x["d"][opens[i]]), int(x["w"][opens[i]]), both[i:j].tobytes()) for i, j in zip(edge[:-1], edge[1:], strict=True)]


def deduplicated(docs: DataFrame, width: int = WIDTH, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_words, n_removed, kept (the kept words, joined by one space): one row per row of ``docs``."""
    common.prepare(docs.sparkSession)
    version = F.xxhash64(F.col(text_col))  # parts rows of one id
    docs = docs.select(F.coalesce(F.col(id_col).cast("long"), F.lit(_NULL_ID)).alias("d"), version.alias("w"), F.col(text_col).alias("text"))

    def names(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            h, first = hashed(_texts(b))
            name, lo, _ = _looked_up(h, first, width)
            cut = np.searchsorted(lo, first)
            out = [twice_at_most(name[x:y]).view(np.int64) for x, y in zip(cut[:-1].tolist(), cut[1:].tolist(), strict=True)]
            offsets = pa.array(np.cumsum([0, *map(len, out)]), pa.int32())
            yield pa.RecordBatch.from_arrays([b.column("d"), b.column("w"), pa.ListArray.from_arrays(offsets, pa.array(np.concatenate(out) if out else np.zeros(0, np.int64)))], ["d", "w", "names"])

    named = docs.mapInArrow(names, "d long, w long, names array<long>").select("d", "w", F.explode("names").alias("name"))
    often = named.groupBy("name").agg(F.count("*").alias("m")).where("m > 1").select("name")
    recurring = common.stored(named.join(often, "name").groupBy("d", "w").agg(F.collect_set("name").alias("names")))

    buckets = common.buckets(docs.sparkSession, docs.count())

    def places(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            h, first = hashed(_texts(b))
            known_names = b.column("names").flatten().to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64)
            at = candidates(h, first, known_names, width)
            if not len(at):
                continue
            text = np.searchsorted(first, at, "right") - 1
            d, w = b.column("d").to_numpy(), b.column("w").to_numpy()
            x = np.zeros(len(at), RUN)
            x["a"], x["c"] = rolling(h, width)[at], rolling(mix(h + np.uint64(1)), width)[at].astype(np.uint32)
            x["d"], x["w"], x["start"] = d[text], w[text], at - first[text]
            later = repeats(x)
            new = dealt(x[~later], x["a"][~later], buckets)
            old = x[later]
            old["a"] = old["c"] = 0  # hashes have done their work
            known = dealt(old, mix(old["d"].astype(np.uint64)), buckets)
            rows = [(k, v, False) for k, v in new] + [(k, v, True) for k, v in known]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), (pa.int32(), pa.binary(), pa.bool_()), strict=True)], ["bucket", "data", "known"])

    def verify(t: pa.Table) -> pa.Table:
        told = t.column("known")
        known, new = (np.concatenate([np.zeros(0, RUN), *(unpacked(s) for s in t.filter(k).column("data").to_pylist())]) for k in (told, pc.invert(told)))
        later = np.concatenate([known, new[repeats(new)]])
        later = later[np.lexsort((later["start"], later["w"], later["d"]))]
        later["a"] = later["c"] = 0  # hashes have done their work
        rows = dealt(later, mix(later["d"].astype(np.uint64)), buckets)
        return pa.table([pa.array([k for k, _ in rows], pa.int32()), pa.array([v for _, v in rows], pa.binary())], ["text_bucket", "data"])

    def gather(t: pa.Table) -> pa.Table:
        rows = stretches(np.concatenate([np.zeros(0, RUN), *map(unpacked, t.column("data").to_pylist())]))
        cols = zip(*rows, strict=True) if rows else ([], [], [])
        return pa.table([pa.array(c, k) for c, k in zip(cols, (pa.int64(), pa.int64(), pa.binary()), strict=True)], ["d", "w", "x"])

    found = docs.join(recurring, ["d", "w"], "left").select("d", "w", "text", "names").mapInArrow(places, "bucket int, data binary, known boolean")
    later = found.groupBy("bucket").applyInArrow(verify, "text_bucket int, data binary")
    marked = later.groupBy("text_bucket").applyInArrow(gather, "d long, w long, x binary")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            n_words, n_removed, kept = [], [], []
            marks = b.column("x")
            for t, m in zip(_texts(b), marks, strict=True):
                words = t.split()
                gone = 0
                if m.is_valid:
                    start, many = np.frombuffer(m.as_py(), "<u4").astype(np.int64).reshape(-1, 2).T
                    n = len(words) + 1
                    covered = np.cumsum(np.bincount(start, minlength=n) - np.bincount(start + many - 1 + width, minlength=n))[:-1] > 0
                    gone = int(covered.sum())
                    words_kept = [words[i] for i in np.flatnonzero(~covered).tolist()]
                else:
                    words_kept = words
                n_words.append(len(words))
                n_removed.append(gone)
                kept.append(b" ".join(words_kept))
            yield pa.RecordBatch.from_arrays([b.column("d"), pa.array(n_words, pa.int64()), pa.array(n_removed, pa.int64()), pa.array(kept, pa.binary()).cast(pa.string())], ["d", "n_words", "n_removed", "kept"])

    out = docs.join(marked, ["d", "w"], "left").select("d", "text", "x").mapInArrow(cut, "d long, n_words long, n_removed long, kept string")
    return out.select(F.nullif("d", F.lit(_NULL_ID)).alias("doc_id"), "n_words", "n_removed", "kept")


def query(spark, sf_dir: str) -> DataFrame:
    out = deduplicated(common.table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))
