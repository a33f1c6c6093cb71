"""Embedding near-duplicates: int8 tile products with rigorous error bounds.

Every unit vector x is written as ``scale * code + rest`` with an int8 code; the norm
of the rest is the vector's error e. For two vectors the cosine lies within
``e_x + e_y + e_x * e_y`` of the product of what their codes stand for. Tiles multiply the
codes alone: sums of at most SEGMENT products of int8 numbers, which float32 holds exactly,
so BLAS gives the integer product without rounding. Most pairs are then decided. Vectors
with pairs whose bounds lie on both sides of the threshold are fetched, and these pairs
are computed again in double precision.

Equal vectors are one class, with its size. Classes are dealt at random into blocks of
BLOCK vectors; a task gets the codes of two blocks, so its memory does not depend on the
table. The work is all pairs, as the method says; a task returns each vector's count of
links, the edges of a spanning forest and the vectors that it needs, never the pairs.

Defined results: vectors that are null, empty, zero or hold nulls or non-finite parts, and
rows with a null vec_id, link with nothing and stay; vectors of another length than most compare only with
their like; an empty table gives no row; a repeated vec_id counts as another copy.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barline.llm import common
from barline.llm.components import components, forest

THRESHOLD = 0.9
BLOCK = 8192
TILE = 1024
#: So many products of numbers up to 127 sum up to less than 2 ** 24.
SEGMENT = 1024
#: What double precision can lose in a bound, or in the cosine of unit vectors, a component.
_ROUNDING = 2.0**-50

_CODED = "vec_id long, copies long, block int, dim int, code binary, scale double, error double"


def usable(vector: Column) -> Column:
    """Not null, no part null, NaN or infinite, and not all zero."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(vector.isNotNull() & finite & F.exists(vector, lambda x: x != 0), F.lit(False))


def quantised(x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Codes, scales and errors of unit vectors."""
    scale = np.abs(x).max(axis=1) / 127
    code = np.rint(x / scale[:, None]).astype(np.int8)
    return code, scale, np.linalg.norm(x - code * scale[:, None], axis=1) + 1e-15


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Products of int8 codes, exact."""
    out = np.zeros((len(a), len(b)))
    for lo in range(0, a.shape[1], SEGMENT):
        out += a[:, lo : lo + SEGMENT].astype(np.float32) @ b[:, lo : lo + SEGMENT].astype(np.float32).T
    return out


def decided(a: dict[str, np.ndarray], b: dict[str, np.ndarray], threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """For each pair whether its cosine reaches the threshold by its bounds, and whether they leave it open."""
    stands = products(a["code"], b["code"]) * a["scale"][:, None] * b["scale"][None]
    e, f = a["error"][:, None], b["error"][None]
    slack = e + f + e * f + _ROUNDING * (a["code"].shape[1] + 16)
    return stands - slack >= threshold, (stands - slack < threshold) & (stands + slack >= threshold)


def _tiles(t: pa.Table, vectors: bool) -> Iterator[tuple[np.ndarray, dict[str, np.ndarray]]]:
    dims = t.column("dim").to_numpy()
    for dim in np.unique(dims):
        part = t.filter(pa.array(dims == dim))
        for lo in range(0, part.num_rows, TILE):
            s = part.slice(lo, TILE)
            out = {"id": s.column("vec_id").to_numpy(), "copies": s.column("copies").to_numpy(), "scale": s.column("scale").to_numpy(), "error": s.column("error").to_numpy()}
            out["code"] = np.frombuffer(b"".join(s.column("code").to_pylist()), np.int8).reshape(-1, dim)
            if vectors:
                x = np.array(s.column("v").to_pylist(), float).reshape(-1, dim)
                x = x / np.abs(x).max(axis=1, keepdims=True)
                out["unit"] = x / np.linalg.norm(x, axis=1, keepdims=True)
            yield dim, out


def _links(a: dict[str, np.ndarray], b: dict[str, np.ndarray], again: bool, threshold: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Places (in a, in b) of linking pairs, and which pairs are left open; ``again``: those of the pairs left open before."""
    sure, unsure = decided(a, b, threshold)
    if not again:
        return *np.nonzero(sure), unsure
    i, j = np.nonzero(unsure)
    exact = np.concatenate([np.zeros(0), *(np.einsum("ij,ij->i", a["unit"][i[k : k + 65536]], b["unit"][j[k : k + 65536]]) for k in range(0, len(i), 65536))])
    return i[exact >= threshold], j[exact >= threshold], unsure


def pair_links(threshold: float, again: bool):
    """What a task does with two blocks, or with one: vec_id, n (links of one with another class's copies), to (forest edge), open (whether its vector is needed)."""

    def run(t: pa.Table) -> pa.Table:
        t = t.sort_by("vec_id")
        low, high = t.column("low")[0].as_py(), t.column("high")[0].as_py()
        mine, other = (t.filter(pa.array(x)) for x in ((t.column("block").to_numpy() == low), (t.column("block").to_numpy() != low)))
        same = high == low
        left = list(_tiles(mine, again))
        right = left if same else list(_tiles(other, again))
        none = np.zeros(0, np.int64)
        us, vs, ns, ms, opens = [none], [none], [none], [none], [none]
        for p, (dim, a) in enumerate(left):
            for q, (dim_b, b) in enumerate(right):
                if dim != dim_b or same and q < p:
                    continue
                i, j, unsure = _links(a, b, again, threshold)
                if same and p == q:
                    i, j = (x[i < j] for x in (i, j))
                    np.fill_diagonal(unsure, False)
                us.append(a["id"][i])
                vs.append(b["id"][j])
                ns.append(b["copies"][j])
                ms.append(a["copies"][i])
                opens += [a["id"][unsure.any(axis=1)], b["id"][unsure.any(axis=0)]]
        u, v, more = np.concatenate(us), np.concatenate(vs), np.unique(np.concatenate(opens))
        more = none if again else more
        ids, at = np.unique(np.concatenate([u, v, more]), return_inverse=True)
        n = np.bincount(at[: 2 * len(u)], np.concatenate([*ns, *ms]), len(ids)).astype(np.int64)
        to = ids.copy()
        if len(u):
            x, y = forest(u, v)
            to[np.searchsorted(ids, x)] = y
        cols = [pa.array(x, pa.int64()) for x in (np.full(len(ids), low), np.full(len(ids), high), ids, n, to)]
        return pa.table([*cols, pa.array(np.isin(ids, more))], ["low", "high", "vec_id", "n", "to", "open"])

    return run


_FOUND = "low long, high long, vec_id long, n long, to long, open boolean"


def linked(vectors: DataFrame, threshold: float = THRESHOLD, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """vec_id, n_links, component_id, kept: one row per row of ``vectors``."""
    common.prepare(vectors.sparkSession)
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).cast("array<double>").alias("v"))
    good = rows.where(usable(F.col("v")) & F.col("vec_id").isNotNull())
    key = F.sha2(F.concat_ws(",", F.col("v").cast("array<string>")), 256)
    classes = common.stored(good.groupBy(key.alias("key")).agg(F.min("vec_id").alias("vec_id"), F.count("*").alias("copies"), F.first("v").alias("v")))
    n_blocks = max(1, -(-classes.count() // BLOCK))

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for dim in sorted(set(np.diff(b.column("v").offsets.to_numpy()).tolist())) if b.num_rows else []:
                part = b.filter(pa.array(np.diff(b.column("v").offsets.to_numpy()) == dim))
                x = part.column("v").flatten().to_numpy().reshape(-1, dim)
                top = np.abs(x).max(axis=1, keepdims=True)  # parts may be so large or small that their squares are not numbers
                x = x / top
                c, scale, error = quantised(x / np.linalg.norm(x, axis=1, keepdims=True))
                yield pa.RecordBatch.from_arrays(
                    [part.column("vec_id"), part.column("copies"), part.column("block"), pa.array([dim] * len(x), pa.int32()), pa.array([r.tobytes() for r in c], pa.binary()), pa.array(scale), pa.array(error)],
                    ["vec_id", "copies", "block", "dim", "code", "scale", "error"],
                )

    block = F.pmod(F.xxhash64("vec_id"), F.lit(n_blocks)).cast("int").alias("block")
    coded = common.stored(classes.select("vec_id", "copies", block, "v").mapInArrow(code, _CODED))
    other = F.explode(F.sequence(F.lit(0), F.lit(n_blocks - 1))).alias("other")
    pairs = coded.select("*", other).withColumns({"low": F.least("block", "other"), "high": F.greatest("block", "other")}).drop("other")
    found = common.stored(pairs.groupBy("low", "high").applyInArrow(pair_links(threshold, again=False), _FOUND))
    needed = found.where("open").select("low", "high", "vec_id").join(coded, "vec_id").join(classes.select("vec_id", "v"), "vec_id")
    found = found.unionByName(common.stored(needed.groupBy("low", "high").applyInArrow(pair_links(threshold, again=True), _FOUND)))

    counts = found.groupBy("vec_id").agg(F.sum("n").alias("n"))
    comp = components(found.select(F.col("vec_id").alias("u"), F.col("to").alias("v")).where("u <> v")).withColumnRenamed("id", "vec_id")
    per_class = classes.select("key", "vec_id", "copies").join(counts, "vec_id", "left").join(comp, "vec_id", "left")
    per_class = per_class.select("key", (F.coalesce("n", F.lit(0)) + F.col("copies") - 1).alias("n_links"), F.coalesce("component", "vec_id").alias("component_id"))
    keyed = rows.select("vec_id", F.when(usable(F.col("v")) & F.col("vec_id").isNotNull(), key).alias("key"))
    out = keyed.join(per_class, "key", "left").select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), F.coalesce("component_id", "vec_id").alias("component_id"))
    return out.withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True)))


def query(spark, sf_dir: str) -> DataFrame:
    return linked(common.table(spark, sf_dir, "embeddings"))


SQL = """
WITH RECURSIVE v AS (
  SELECT vec_id, embedding::DOUBLE[] AS e FROM embeddings),
g AS (
  SELECT * FROM v WHERE e IS NOT NULL AND len([x for x in e if x IS NULL OR NOT isfinite(x)]) = 0 AND len([x for x in e if x <> 0]) > 0),
l AS (
  SELECT a.vec_id AS u, b.vec_id AS v FROM g a JOIN g b ON a.vec_id <> b.vec_id AND list_cosine_similarity(a.e, b.e) >= 0.9),
r AS (
  SELECT vec_id AS id, vec_id AS c FROM v
  UNION
  SELECT l.v, r.c FROM r JOIN l ON l.u = r.id AND r.c < l.v)
SELECT v.vec_id, (SELECT count(*) FROM l WHERE l.u = v.vec_id)::BIGINT AS n_links, m.c::BIGINT AS component_id, m.c = v.vec_id AS kept
FROM v JOIN (SELECT id, min(c) AS c FROM r GROUP BY id) m ON m.id = v.vec_id
"""


def planted(vectors: DataFrame) -> DataFrame:
    """``vectors`` and, for each, one of five further ones: twice as long, or moved a little, more and too far, or opposite.

    Moves are of the size that puts cosines of 64 components around the threshold, on both sides.
    """
    v, i, kind = F.col("embedding").cast("array<double>"), F.col("vec_id"), F.col("vec_id") % 5
    moved = lambda by: F.transform(v, lambda x, k: x + ((k.cast("long") * 7 + i) % 11 - 5) * F.lit(by))
    other = F.when(kind == 0, F.transform(v, lambda x: x * 2)).when(kind == 1, moved(0.01)).when(kind == 2, moved(0.018)).when(kind == 3, moved(0.03)).otherwise(F.transform(v, lambda x: -x))
    rows = vectors.select("vec_id", v.alias("embedding"), other.alias("other"))
    return rows.drop("other").unionByName(rows.select((i + 1_000_000_000).alias("vec_id"), F.col("other").alias("embedding")))


def planted_query(spark, sf_dir: str) -> DataFrame:
    return linked(planted(common.table(spark, sf_dir, "embeddings")))


_MOVED = "list_transform(embedding::DOUBLE[], lambda x, k: x + (((k - 1) * 7 + vec_id) % 11 - 5) * {0}::DOUBLE)"
PLANTED_SQL = SQL.replace(
    "SELECT vec_id, embedding::DOUBLE[] AS e FROM embeddings",
    f"""SELECT vec_id, embedding::DOUBLE[] AS e FROM embeddings
  UNION ALL SELECT vec_id + 1000000000, CASE vec_id % 5 WHEN 0 THEN list_transform(embedding::DOUBLE[], lambda x: x * 2) WHEN 1 THEN {_MOVED.format(0.01)}
    WHEN 2 THEN {_MOVED.format(0.018)} WHEN 3 THEN {_MOVED.format(0.03)} ELSE list_transform(embedding::DOUBLE[], lambda x: -x) END FROM embeddings""",
)
