"""Hard negatives by Four-Russians scoring: exact integer inner products from table lookups.

Components become integers, floor(256 * x). For each group of eight dimensions of an anchor
a table holds the sums of all 256 subsets of its eight components. A candidate is packed as
bit planes: one byte holds bit k of its eight components of a group, in two's complement,
so the table's entry at that byte is the group's part of plane k. Shifting and adding the
planes' sums, the sign's plane taken away, gives the full exact score.

Candidates are dealt into blocks of CANDIDATES rows and anchors into blocks of ANCHORS,
whatever their labels or ids, so that no label or id makes a block large. A task gets one
block of each and returns at most POSITIVES rows an anchor, then, for the positives found
over all blocks, at most NEGATIVES rows a positive; windows merge these. All anchors are
scored against all rows, twice, as positives' scores bound their negatives'.

Defined results: rows with a null vec_id, label or vector, or with a null or non-finite
component, take no part, nor do vectors whose components' absolute values add up to
2 ** 31 or more once scaled, as their scores may not fit a long; vectors are compared with
those of their own length; ties go to the smaller vec_id; rows that repeat the anchor's
vec_id are not its candidates, and other repeated rows are candidates each, as are repeated
anchors; zero vectors take part; an empty table gives no row. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from barline.llm import common

ANCHORS = 2048
CANDIDATES = 4096
POSITIVES = 5
NEGATIVES = 3
#: Anchors and candidates of one table of scores.
TILE = (256, 1024)
MOST_PARTITIONS = 20_000

_ROW = "block int, dim int, bits int, ids binary, labels binary, packed binary"
_NONE = np.iinfo(np.int64).min


def subset_sums(values: np.ndarray, dtype=np.int64) -> np.ndarray:
    """(group, byte, anchor): for each eight dimensions, sums of the components whose bits a byte has."""
    many, dim = values.shape
    groups = -(-dim // 8)
    padded = np.zeros((many, groups * 8), dtype)
    padded[:, :dim] = values
    parts = padded.reshape(many, groups, 8).transpose(1, 2, 0)
    out = np.zeros((groups, 256, many), dtype)
    for i in range(8):
        out[:, 1 << i : 2 << i] = out[:, : 1 << i] + parts[:, i : i + 1]
    return out


def bit_planes(values: np.ndarray) -> tuple[int, np.ndarray]:
    """Bits of a component, and (row, bit, group) bytes of the components in two's complement."""
    top = max(int(values.max()), -1 - int(values.min())) if values.size else 0
    bits = top.bit_length() + 1
    planes = (values[:, None, :] >> np.arange(bits)[None, :, None]) & 1
    return bits, np.packbits(planes.astype(np.uint8), axis=2, bitorder="little")


def scores(tables: np.ndarray, planes: np.ndarray) -> np.ndarray:
    """(anchor, row): exact inner products, plane by plane from the sign's down."""
    rows, bits, groups = planes.shape
    total = np.zeros((rows, tables.shape[2]), tables.dtype)
    part = np.empty_like(total)
    for k in range(bits - 1, -1, -1):
        total <<= 1
        for g in range(groups):
            np.take(tables[g], planes[:, k, g], axis=0, out=part, mode="clip")
            if k == bits - 1:
                total -= part
            else:
                total += part
    return np.ascontiguousarray(total.T)


class Best:
    """The ``k`` highest scores of each anchor so far; ties go to what came first."""

    def __init__(self, anchors: int, k: int):
        self.score, self.at = np.full((anchors, k), _NONE), np.zeros((anchors, k), np.int64)

    def add(self, lo: int, s: np.ndarray, ok: np.ndarray, start: int) -> None:
        """Scores ``s`` (anchor, row) of the anchors from ``lo`` on and the rows from ``start`` on, where ``ok``."""
        every, here, least = np.arange(len(s)), slice(lo, lo + len(s)), np.iinfo(s.dtype).min
        s = np.where(ok, s, least)
        score, at = [self.score[here]], [self.at[here]]
        for _ in range(self.score.shape[1]):
            i = s.argmax(axis=1)
            top = s[every, i].astype(np.int64)
            top[top == least] = _NONE
            if (top <= score[0][:, -1]).all():  # nothing beats what is kept
                break
            score.append(top[:, None])
            at.append(start + i[:, None])
            s[every, i] = least
        both, places = np.concatenate(score, axis=1), np.concatenate(at, axis=1)
        order = np.argsort(-(both + 1), axis=1, kind="stable")[:, : self.score.shape[1]]
        self.score[here], self.at[here] = np.take_along_axis(both, order, 1), np.take_along_axis(places, order, 1)


def _unpacked(row: dict) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Ids, labels and what is packed: an anchor block's components or a candidate block's bit planes."""
    ids, labels = np.frombuffer(row["ids"], np.int64), np.frombuffer(row["labels"], np.int64)
    if row["bits"]:
        return ids, labels, np.frombuffer(row["packed"], np.uint8).reshape(len(ids), row["bits"], -(-row["dim"] // 8))
    return ids, labels, np.frombuffer(row["packed"], np.int64).reshape(len(ids), row["dim"])


def _tiles(anchor: dict, candidate: dict) -> Iterator[tuple[slice, slice, np.ndarray]]:
    """Anchors, rows and their scores, tile by tile."""
    values, planes = _unpacked(anchor)[2], _unpacked(candidate)[2]
    most = int(np.abs(values).sum(axis=1).max(initial=0)) << candidate["bits"]
    dtype = np.int32 if most < 1 << 31 else np.int64
    for lo in range(0, len(values), TILE[0]):
        tables = subset_sums(values[lo : lo + TILE[0]], dtype)
        for start in range(0, len(planes), TILE[1]):
            yield slice(lo, lo + TILE[0]), slice(start, start + TILE[1]), scores(tables, planes[start : start + TILE[1]])


def packed(rows: DataFrame, blocks: int, planes: bool) -> DataFrame:
    """Blocks of ``rows`` (vec_id, label, ints) as one row each: bit planes of candidates, or components of anchors.

    Rows are dealt out in turn, whatever they hold; a block has one row for each length of vectors.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = list(batches)
        if not held:
            return
        t = pa.Table.from_batches(held)
        dims = pc.list_value_length(t.column("ints")).to_numpy()
        block = TaskContext.get().partitionId()
        for dim in np.unique(dims).tolist():
            some = t.filter(pa.array(dims == dim)).sort_by("vec_id")
            ids, labels = (some.column(c).to_numpy() for c in ("vec_id", "label"))
            values = some.column("ints").combine_chunks().flatten().to_numpy().reshape(len(ids), dim)
            bits, cells = bit_planes(values) if planes else (0, values)
            cols = [[block], [dim], [bits], [ids.tobytes()], [labels.tobytes()], [np.ascontiguousarray(cells).tobytes()]]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, (pa.int32(), pa.int32(), pa.int32(), pa.binary(), pa.binary(), pa.binary()), strict=True)], ["block", "dim", "bits", "ids", "labels", "packed"])

    return rows.select("vec_id", "label", "ints").repartition(blocks).mapInArrow(run, _ROW)


def _met(anchors: DataFrame, candidates: DataFrame, n: int, m: int, found, schema: str) -> DataFrame:
    """``found(anchor, candidate)`` for each block of ``n`` of anchors with each of ``m`` of candidates."""
    spark = anchors.sparkSession
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), min(n * m, MOST_PARTITIONS))
    names = [f.split()[0] for f in schema.split(", ")]
    kinds = [pa.int32() if f.endswith(" int") else pa.int64() for f in schema.split(", ")]

    def run(key: tuple, a: pa.Table, c: pa.Table) -> pa.Table:
        rows = []
        if a.num_rows and c.num_rows:
            anchor = a.to_pylist()[0]
            rows = [(key[0].as_py(), key[2].as_py(), *r) for r in found(anchor, c.to_pylist()[0])]
        return pa.table([pa.array(x, k) for x, k in zip(list(zip(*rows, strict=True)) or [()] * len(names), kinds, strict=True)], names)

    each = lambda k: F.explode(F.sequence(F.lit(0), F.lit(k - 1)))
    left = anchors.withColumnRenamed("block", "a").withColumn("c", each(m)).repartition(parts, "a", "c", "dim")
    right = candidates.withColumnRenamed("block", "c").withColumn("a", each(n)).repartition(parts, "a", "c", "dim")
    return left.groupBy("a", "c", "dim").cogroup(right.groupBy("a", "c", "dim")).applyInArrow(run, schema)


def _first_positives(k: int):
    def found(anchor: dict, candidate: dict) -> Iterator[tuple]:
        ids, labels, _ = _unpacked(anchor)
        others, other_labels, _ = _unpacked(candidate)
        best = Best(len(ids), k)
        for a, c, s in _tiles(anchor, candidate):
            ok = (labels[a, None] == other_labels[None, c]) & (ids[a, None] != others[None, c])
            best.add(a.start, s, ok, c.start)
        for i, r in zip(*np.nonzero(best.score != _NONE), strict=True):
            yield int(i), int(ids[i]), int(others[best.at[i, r]]), int(best.score[i, r])

    return found


def _first_negatives(k: int, low: int, high: int):
    """``anchor`` has its positives too: slot, order and score of each."""

    def found(anchor: dict, candidate: dict) -> Iterator[tuple]:
        ids, labels, _ = _unpacked(anchor)
        others, other_labels, _ = _unpacked(candidate)
        given = anchor["positives"]
        orders = max((p["n"] for p in given), default=0)
        least, most = np.ones((orders, len(ids)), np.int64), np.zeros((orders, len(ids)), np.int64)  # none fits
        for p in given:
            least[p["n"] - 1, p["slot"]], most[p["n"] - 1, p["slot"]] = -(-low * p["score"] // 100), high * p["score"] // 100
        best = [Best(len(ids), k) for _ in range(orders)]
        for a, c, s in _tiles(anchor, candidate):
            other = labels[a, None] != other_labels[None, c]
            for b, lo, hi in zip(best, least, most, strict=True):
                b.add(a.start, s, other & (s >= lo[a, None]) & (s <= hi[a, None]), c.start)
        for n, b in enumerate(best):
            for i, r in zip(*np.nonzero(b.score != _NONE), strict=True):
                yield int(i), n + 1, int(others[b.at[i, r]]), int(b.score[i, r])

    return found


def prepared(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label") -> DataFrame:
    """vec_id, label and integer components of the rows that take part."""
    v = F.col("v")
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(label_col).cast("long").alias("label"), F.col(vector_col).cast("array<double>").alias("v"))
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    fits = F.aggregate(v, F.lit(0.0), lambda t, x: t + F.abs(x * 256) + 1) < float(1 << 31)
    return rows.where("vec_id is not null and label is not null and v is not null").where(finite & fits).select("vec_id", "label", F.transform(v, lambda x: F.floor(x * 256).cast("long")).alias("ints"))


def mined(rows: DataFrame, is_anchor: Column, positives: int = POSITIVES, negatives: int = NEGATIVES, low: int = 50, high: int = 95, sizes: tuple[int, int] = (ANCHORS, CANDIDATES)) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score over ``prepared`` rows.

    Negatives have another label and from ``low`` to ``high`` per cent of the positive's score.
    """
    common.prepare(rows.sparkSession)
    rows = common.stored(rows)
    asked = rows.where(is_anchor)
    n, m = max(1, -(-asked.count() // sizes[0])), max(1, -(-rows.count() // sizes[1]))
    anchors, candidates = common.stored(packed(asked, n, planes=False)), common.stored(packed(rows, m, planes=True))

    met = _met(anchors, candidates, n, m, _first_positives(positives), "a int, dim int, slot int, anchor_id long, positive_id long, positive_score long")
    first = Window.partitionBy("a", "dim", "slot").orderBy(F.desc("positive_score"), "positive_id")
    firsts = common.stored(met.withColumn("n", F.row_number().over(first)).where(F.col("n") <= positives))

    told = firsts.groupBy("a", "dim").agg(F.collect_list(F.struct("slot", "n", F.col("positive_score").alias("score"))).alias("positives"))  # one block's
    full = anchors.withColumnRenamed("block", "a").join(told, ["a", "dim"]).withColumnRenamed("a", "block")
    met = _met(full, candidates, n, m, _first_negatives(negatives, low, high), "a int, dim int, slot int, n int, negative_id long, negative_score long")
    best = Window.partitionBy("a", "dim", "slot", "n").orderBy(F.desc("negative_score"), "negative_id")
    ranked = met.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= negatives)
    return ranked.join(firsts, ["a", "dim", "slot", "n"]).select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")


def query(spark, sf_dir: str) -> DataFrame:
    rows = prepared(common.table(spark, sf_dir, "embeddings"))
    rows = rows.withColumn("label", F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label")))
    return mined(rows, F.col("vec_id") % 50 == 0)


SQL = """
WITH r AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, list_transform(embedding::DOUBLE[], lambda x: floor(256 * x)) AS e
  FROM embeddings WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT a.vec_id AS anchor_id, b.vec_id AS id, a.label = b.label AS same, list_dot_product(a.e, b.e)::BIGINT AS score
  FROM r a JOIN r b ON a.vec_id % 50 = 0 AND a.vec_id <> b.vec_id AND len(a.e) = len(b.e)),
p AS (
  SELECT anchor_id, id AS positive_id, score AS positive_score FROM s WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= 5)
SELECT p.anchor_id, positive_id, row_number() OVER w AS rank, s.id AS negative_id, positive_score, s.score AS negative_score
FROM p JOIN s ON s.anchor_id = p.anchor_id AND NOT s.same AND 50 * positive_score <= 100 * s.score AND 100 * s.score <= 95 * positive_score
WINDOW w AS (PARTITION BY p.anchor_id, positive_id ORDER BY s.score DESC, s.id) QUALIFY row_number() OVER w <= 3
"""
