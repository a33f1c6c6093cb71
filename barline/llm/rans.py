"""Token-ID output: static range asymmetric numeral system over interleaved lanes.

File format: a Parquet table of blocks. One frequency table, counted over all ids,
serves every block. A block holds the ids of whole documents in ascending doc_id
order. Token ``i`` belongs to lane ``i % lanes``; a step codes one token in each
lane at once. Every ``CHECK_STEPS`` steps a checkpoint records the states of all
lanes, the place in the word stream and a crc32 of the words up to the next
checkpoint, so that a segment can be decoded and verified alone. A crc32 of the
block's other columns guards them.

Defined results: a null text is an empty text; an empty table gives no block;
rows with equal doc_id all stay, next to each other; a null doc_id sorts first.
Columns other than the two named ones are not read.
"""

from __future__ import annotations

import json
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from barline.llm import common
from barline.llm.tokens import encoder

SCALE_BITS = 18
LOW = np.uint64(1 << 31)
LANES = 2048
CHECK_STEPS = 64
BLOCK_TOKENS = 1 << 18

BLOCK_SCHEMA = (
    "part int, seq int, start_in_part long, n_tokens long, lanes int, doc_ids array<long>, doc_tokens array<long>, "
    "word_at array<long>, states binary, crcs array<long>, words binary, head_crc long"
)


def frequency_table(counts: np.ndarray, bits: int = SCALE_BITS) -> np.ndarray:
    """Frequencies that sum to ``2**bits``; every id that occurs has at least one."""
    total = int(counts.sum())
    freq = np.zeros(len(counts), np.int64)
    if not total:
        return freq
    live = counts > 0
    spare = (1 << bits) - int(live.sum())
    if spare < 0:
        raise ValueError(f"{int(live.sum())} ids occur; a table of {1 << bits} places is too small")
    exact = counts * (spare / total)
    freq[live] = 1 + np.floor(exact[live]).astype(np.int64)
    left = (1 << bits) - int(freq.sum())
    order = np.lexsort((np.arange(len(counts)), -(exact - np.floor(exact)), ~live))
    freq[order[:left]] += 1
    return freq


class Coder:
    def __init__(self, freq: np.ndarray, bits: int = SCALE_BITS):
        self.bits = np.uint64(bits)
        self.freq = freq.astype(np.uint64)
        self.cum = (np.cumsum(freq) - freq).astype(np.uint64)
        self.limit = self.freq << np.uint64(63 - bits)
        self.mask = np.uint64((1 << bits) - 1)
        self.symbol = np.repeat(np.arange(len(freq), dtype=np.uint32), freq)

    def encode(self, ids: np.ndarray, lanes: int) -> tuple[list[int], bytes, list[int], bytes]:
        """word_at, states, crcs, words."""
        steps = -(-len(ids) // lanes)
        x = np.full(lanes, LOW, np.uint64)
        emitted: list[np.ndarray] = [None] * steps  # type: ignore[list-item]
        states = []
        shift = np.uint64(32)
        for t in range(steps - 1, -1, -1):
            s = ids[t * lanes : (t + 1) * lanes]
            y, f = x[: len(s)], self.freq[s]
            full = y >= self.limit[s]
            emitted[t] = y[full].astype("<u4")
            y = np.where(full, y >> shift, y)
            q = y // f
            x[: len(s)] = (q << self.bits) + (y - q * f) + self.cum[s]
            if t % CHECK_STEPS == 0:
                states.append(x.astype("<u8").tobytes())
        states.reverse()
        parts = [b"".join(w.tobytes() for w in emitted[t : t + CHECK_STEPS]) for t in range(0, steps, CHECK_STEPS)]
        at = np.cumsum([0, *(len(p) // 4 for p in parts)])[:-1].tolist()
        return at, b"".join(states), [zlib.crc32(p) for p in parts], b"".join(parts)

    def decode(self, n: int, lanes: int, word_at: list[int], states: bytes, crcs: list[int], words: bytes) -> np.ndarray:
        """All ids of a block; each segment is verified against its checksum first."""
        return np.concatenate([self.segment(k, n, lanes, word_at, states, crcs, words) for k in range(len(word_at))] or [np.zeros(0, np.uint32)])

    def segment(self, k: int, n: int, lanes: int, word_at: list[int], states: bytes, crcs: list[int], words: bytes) -> np.ndarray:
        """The ids between checkpoint ``k`` and the next one, from these two alone."""
        lo, hi = 4 * word_at[k], 4 * word_at[k + 1] if k + 1 < len(word_at) else len(words)
        if zlib.crc32(words[lo:hi]) != crcs[k]:
            raise ValueError(f"segment {k} is damaged")
        w = np.frombuffer(words, "<u4", (hi - lo) // 4, lo).astype(np.uint64)
        x = np.frombuffer(states, "<u8", lanes, 8 * lanes * k).copy()
        first, last = k * CHECK_STEPS * lanes, min(n, (k + 1) * CHECK_STEPS * lanes)
        out = np.empty(last - first, np.uint32)
        at, shift = 0, np.uint64(32)
        for lo in range(0, last - first, lanes):
            m = min(lanes, last - first - lo)
            y = x[:m]
            slot = y & self.mask
            s = self.symbol[slot]
            out[lo : lo + m] = s
            y = self.freq[s] * (y >> self.bits) + slot - self.cum[s]
            low = np.flatnonzero(y < LOW)
            y[low] = (y[low] << shift) | w[at : at + len(low)]
            at += len(low)
            x[:m] = y
        return out


def encoded(docs: DataFrame, path: str, end_id: int | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_tokens, ids): ids as packed little-endian numbers, with the end id."""
    width = "<u2" if encoder(path).vocabulary <= 1 << 16 else "<u4"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = encoder(path)
        for b in batches:
            raw = tokenizer.encode_all(b.column(1).to_pylist(), end_id)
            ids = [np.frombuffer(x, "<u4").astype(width).tobytes() for x in raw]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([len(x) // 4 for x in raw], pa.int64()), pa.array(ids, pa.binary())], ["doc_id", "n_tokens", "ids"])

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(run, "doc_id long, n_tokens long, ids binary")


def id_counts(ids: DataFrame, vocabulary: int) -> np.ndarray:
    """How often each id occurs, over all rows. The driver gets one number per id of the vocabulary."""
    width = "<u2" if vocabulary <= 1 << 16 else "<u4"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n = np.zeros(vocabulary, np.int64)
        for b in batches:
            n += np.bincount(np.frombuffer(b"".join(b.column(0).to_pylist()), width), minlength=vocabulary)
        seen = np.flatnonzero(n)
        yield pa.RecordBatch.from_arrays([pa.array(seen, pa.int64()), pa.array(n[seen], pa.int64())], ["id", "n"])

    rows = ids.select("ids").mapInArrow(run, "id long, n long").groupBy("id").agg(F.sum("n").alias("n")).collect()
    counts = np.zeros(vocabulary, np.int64)
    for r in rows:
        counts[r["id"]] = r["n"]
    return counts


def head_crc(n: int, lanes: int, doc_ids: list[int | None], doc_tokens: list[int], word_at: list[int], states: bytes, crcs: list[int]) -> int:
    return zlib.crc32(states, zlib.crc32(json.dumps([n, lanes, doc_ids, doc_tokens, word_at, crcs]).encode()))


def write_blocks(ids: DataFrame, freq: np.ndarray, vocabulary: int, path: str) -> None:
    """Blocks of ``ids``, which must be sorted within partitions that ascend."""
    width = "<u2" if vocabulary <= 1 << 16 else "<u4"
    schema = pa.schema([("part", pa.int32()), ("seq", pa.int32()), ("start_in_part", pa.int64()), ("n_tokens", pa.int64()), ("lanes", pa.int32()), ("doc_ids", pa.list_(pa.int64())), ("doc_tokens", pa.list_(pa.int64())), ("word_at", pa.list_(pa.int64())), ("states", pa.binary()), ("crcs", pa.list_(pa.int64())), ("words", pa.binary()), ("head_crc", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder, part, seq, start = Coder(freq), TaskContext.get().partitionId(), 0, 0
        keys: list[int | None] = []
        sizes: list[int] = []
        data: list[bytes] = []
        held = 0

        def block() -> pa.RecordBatch:
            nonlocal keys, sizes, data, held, seq, start
            tokens = np.frombuffer(b"".join(data), width)
            lanes = int(np.clip(len(tokens) // CHECK_STEPS, 1, LANES))
            at, states, crcs, words = coder.encode(tokens, lanes)
            row = [part, seq, start, len(tokens), lanes, keys, sizes, at, states, crcs, words, head_crc(len(tokens), lanes, keys, sizes, at, states, crcs)]
            seq, start = seq + 1, start + len(tokens)
            keys, sizes, data, held = [], [], [], 0
            return pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip(row, schema, strict=True)], schema=schema)

        for b in batches:
            for k, n, raw in zip(*(b.column(i).to_pylist() for i in range(3)), strict=True):
                keys.append(k)
                sizes.append(n)
                data.append(raw)
                held += n
                if held >= BLOCK_TOKENS:
                    yield block()
        if keys:
            yield block()

    ids.select("doc_id", "n_tokens", "ids").mapInArrow(run, BLOCK_SCHEMA).write.option("compression", "uncompressed").parquet(path)


def write_token_file(docs: DataFrame, vocabulary_path: str, path: str, end_id: int | None, id_col: str = "doc_id", text_col: str = "text") -> None:
    """Encodes every text; writes the blocks to ``path`` and their frequency table to ``path``-table."""
    common.prepare(docs.sparkSession)
    vocabulary = encoder(vocabulary_path).vocabulary
    ids = encoded(docs, vocabulary_path, end_id, id_col, text_col)
    staged = docs.sparkSession.read.schema(ids.schema)
    ids.write.option("compression", "zstd").parquet(f"{path}-ids")
    staged = staged.parquet(f"{path}-ids")
    freq = frequency_table(id_counts(staged, vocabulary))
    table = [(int(i), int(freq[i])) for i in np.flatnonzero(freq)]
    docs.sparkSession.createDataFrame(table, "id int, freq int").coalesce(1).write.parquet(f"{path}-table")
    ordered = staged.repartitionByRange(F.col("doc_id").asc_nulls_first()).sortWithinPartitions(F.col("doc_id").asc_nulls_first(), "n_tokens", "ids")
    write_blocks(ordered, freq, vocabulary, path)
    common.delete(docs.sparkSession, f"{path}-ids")


#: Rows of one number each up to which a side is broadcast.
BROADCAST_ROWS = 100_000


def with_part_starts(blocks: DataFrame) -> DataFrame:
    """Adds part_start, the ids before each writing task: one row a task is ordered, however much each wrote."""
    parts = blocks.groupBy("part").agg(F.sum("n_tokens").alias("n"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = common.stored(parts.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("part_start")))
    return blocks.join(F.broadcast(starts) if starts.count() <= BROADCAST_ROWS else starts, "part")


def read_token_file(spark: SparkSession, path: str) -> DataFrame:
    """Per document of a token file: doc_id, start, n_tokens, ids_crc32, from the decoded ids."""
    blocks = spark.read.schema(BLOCK_SCHEMA).parquet(path)
    rows = spark.read.schema("id int, freq int").parquet(f"{path}-table").collect()  # one an id of the vocabulary
    freq = np.zeros(max([0, *(r["id"] + 1 for r in rows)]), np.int64)
    for r in rows:
        freq[r["id"]] = r["freq"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = Coder(freq)
        for b in batches:
            for r in b.to_pylist():
                if head_crc(r["n_tokens"], r["lanes"], *(r[c] for c in ("doc_ids", "doc_tokens", "word_at", "states", "crcs"))) != r["head_crc"]:
                    raise ValueError(f"the head of a block of part {r['part']} is damaged")
                ids = coder.decode(r["n_tokens"], r["lanes"], r["word_at"], r["states"], r["crcs"], r["words"])
                raw = memoryview(ids.astype("<u4").tobytes())
                ends = np.cumsum(np.array(r["doc_tokens"], np.int64))
                starts = ends - r["doc_tokens"]
                crcs = [zlib.crc32(raw[4 * a : 4 * z]) for a, z in zip(starts.tolist(), ends.tolist(), strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(r["doc_ids"], pa.int64()), pa.array(starts + r["part_start"] + r["start_in_part"], pa.int64()), pa.array(r["doc_tokens"], pa.int64()), pa.array(crcs, pa.int64())],
                    ["doc_id", "start", "n_tokens", "ids_crc32"],
                )

    cols = ["part", "start_in_part", "n_tokens", "lanes", "doc_ids", "doc_tokens", "word_at", "states", "crcs", "words", "head_crc", "part_start"]
    return with_part_starts(blocks).select(*cols).mapInArrow(run, "doc_id long, start long, n_tokens long, ids_crc32 long")


def query(spark, sf_dir: str) -> DataFrame:
    import public_tokenizers

    vocabulary = public_tokenizers.path("word_bpe_49k.json")
    path = common.shared_dir(spark)
    write_token_file(common.table(spark, sf_dir, "documents"), vocabulary, path, end_id=1)
    return read_token_file(spark, path)
