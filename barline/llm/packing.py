"""Cost-balanced packing of documents into sequences of a fixed length.

A document's cost is ``LINEAR * n + QUADRATIC * n * n``: a part for each token and
the attention within the document. Documents longer than a sequence give whole
sequences first. What is left of each is placed in descending order of cost, each
on the sequence of lowest cost that still has room for it. Where no sequence has
room, a piece is cut to fill the roomiest one and its rest is placed in turn, so a
group of documents takes the fewest sequences possible and pads at most one
sequence's worth. A group is a run of rows of one input partition, bounded by
GROUP_PIECES and GROUP_TOKENS; nothing is shuffled.

Defined results: a null text is an empty text, of one id, the end id; an empty
table gives no row; equal rows are packed each on its own.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barline.llm import common
from barline.llm.tokens import encoder, kept_as

LENGTH = 1024
LINEAR = 1.0
QUADRATIC = 1.0 / 4096
GROUP_PIECES = 4096
GROUP_TOKENS = 1 << 22

SCHEMA = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, cost double"


def cost(n: np.ndarray | int) -> np.ndarray | float:
    return LINEAR * n + QUADRATIC * n * n


def place(lengths: list[int], capacity: int = LENGTH) -> list[tuple[int, int, int, int, int]]:
    """(item, start within the item, length, sequence, offset) of every piece.

    Items are shorter than ``capacity``. The number of sequences is the least that
    holds all; ties in cost go to the lower sequence.
    """
    count = -(-sum(lengths) // capacity)
    room, load = np.full(count, capacity, np.int64), np.zeros(count)
    out = []
    for item in sorted(range(len(lengths)), key=lambda i: (-lengths[i], i)):
        start, left = 0, lengths[item]
        while left:
            fits = room >= left
            s = int(np.where(fits, load, np.inf).argmin()) if fits.any() else int(room.argmax())
            n = min(left, int(room[s]))
            out.append((item, start, n, s, capacity - int(room[s])))
            room[s] -= n
            load[s] += cost(n)
            start, left = start + n, left - n
    return out


def packed(docs: DataFrame, vocabulary_path: str, end_id: int, length: int = LENGTH, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset, cost."""
    common.prepare(docs.sparkSession)

    def group(part: list[tuple[int | None, bytes]], base: int) -> tuple[pa.RecordBatch, int]:
        rows, rests, owner = [], [], []
        seq = base
        for k, (_, raw) in enumerate(part):
            n = len(raw) // 4
            for start in range(0, n - n % length, length):
                rows.append((k, start, length, seq, 0))
                seq += 1
            if n % length:
                rests.append(n % length)
                owner.append(k)
        for item, start, n, s, offset in place(rests, length):
            k = owner[item]
            rows.append((k, len(part[k][1]) // 4 - rests[item] + start, n, seq + s, offset))
        used = seq + -(-sum(rests) // length)
        crcs = [zlib.crc32(memoryview(part[k][1])[4 * a : 4 * (a + n)]) for k, a, n, _, _ in rows]
        cols = [[part[r[0]][0] for r in rows], [r[1] for r in rows], [r[2] for r in rows], crcs, [len(part[r[0]][1]) // 4 for r in rows], [r[3] for r in rows], [r[4] for r in rows]]
        arrays = [pa.array(c, pa.int64()) for c in cols] + [pa.array([float(cost(r[2])) for r in rows], pa.float64())]
        return pa.RecordBatch.from_arrays(arrays, ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "cost"]), used

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer, seq = encoder(vocabulary_path), TaskContext.get().partitionId() << 40
        part: list[tuple[int | None, bytes]] = []
        held = 0
        for b in batches:
            for key, raw in zip(b.column(0).to_pylist(), tokenizer.encode_all(b.column(1).to_pylist(), end_id), strict=True):
                part.append((key, raw))
                held += len(raw) // 4
                if len(part) >= GROUP_PIECES or held >= GROUP_TOKENS:
                    out, seq = group(part, seq)
                    part, held = [], 0
                    yield out
        if part:
            yield group(part, seq)[0]

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(common.released(run, kept_as(vocabulary_path)), SCHEMA)


def query(spark, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return packed(common.table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), end_id=0)
