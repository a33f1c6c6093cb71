"""Approximate nearest neighbours over balanced posting lists.

Centroids are fitted on a bounded sample (SAMPLE rows, least hash first) with k-means
that moves surplus members of large clusters on, and are searched by a best-first walk
over an in-memory neighbour graph. Every vector is posted to its nearest list and, if
it lies near a boundary, to each list that is at most BOUNDARY times as far. A query
visits the lists whose centroid is at most RATIO times as far as the nearest one.
Every vector is posted and every visited list is read whole. Long lists and lists with
many queries are split into parts of PART rows, so a task's memory is bounded and
thousands of copies of one vector are spread.

Nearness is the cosine of the original vectors in double precision. Defined results:
vectors that are null, empty, zero or hold nulls or non-finite parts, or whose length
is not the sample's commonest, take no part; ties go to the smaller id; a query with
fewer than k found although the table has more visits at least four times as many lists
in each further round, and all of them in the last; an empty table gives no row; rows that
repeat an id of the query are no candidates; rows with a null id take no part.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barline.llm import common
from barline.llm.embedding_dedup import usable

SAMPLE = 8192
ROWS_PER_LIST = 256
MOST_LISTS = 1024
GRAPH_DEGREE = 24
BOUNDARY = 1.03
RATIO = 1.3
PART = 4096


def unit(x: np.ndarray) -> np.ndarray:
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def fit_centroids(x: np.ndarray, k: int, rounds: int = 12) -> np.ndarray:
    """Balanced k-means of unit vectors: a cluster keeps its nearest 1.5 mean sizes, others go to their next choice."""
    rng = np.random.default_rng(7)
    c = x[rng.choice(len(x), k, replace=False)]
    most = int(np.ceil(1.5 * len(x) / k))
    for _ in range(rounds):
        near = x @ c.T
        owner = np.full(len(x), -1)
        free = np.arange(len(x))
        room = np.full(k, most)
        for _ in range(8):
            choice = near[free].argmax(axis=1)
            order = np.lexsort((-near[free, choice], choice))
            rank = np.arange(len(free)) - np.searchsorted(choice[order], choice[order])
            taken = order[rank < room[choice[order]]]
            owner[free[taken]] = choice[taken]
            room -= np.bincount(choice[taken], minlength=k)
            near[:, room <= 0] = -2
            free = np.flatnonzero(owner < 0)
            if not len(free):
                break
        held = owner >= 0
        sums = np.zeros_like(c)
        np.add.at(sums, owner[held], x[held])
        norm = np.linalg.norm(sums, axis=1)
        c = np.where(norm[:, None] > 1e-9, sums / np.maximum(norm, 1e-9)[:, None], c)
    return c


class CentroidGraph:
    """Neighbour graph of the centroids, walked from a fixed entry, best first."""

    def __init__(self, centroids: np.ndarray, degree: int = GRAPH_DEGREE):
        self.c = centroids
        k = len(centroids)
        near = centroids @ centroids.T
        order = np.argsort(-near, axis=1, kind="stable")[:, 1 : degree + 1]
        links = [set(r.tolist()) for r in order]
        for a, r in enumerate(order.tolist()):
            for b in r:
                links[b].add(a)
        for a in range(1, k):  # a path through all, so that every centroid can be reached
            links[a].add(a - 1)
            links[a - 1].add(a)
        self.links = [np.array(sorted(s), np.int64) for s in links]

    def within(self, q: np.ndarray, ratio: float, least: int = 0) -> np.ndarray:
        """Centroids met whose distance is at most ``ratio`` times the least, nearest first; the ``least`` nearest of all if these are more."""
        import heapq

        distance = np.full(len(self.c), np.inf)
        distance[0] = np.sqrt(max(0.0, 2 - 2 * float(self.c[0] @ q)))
        heap, best = [(distance[0], 0)], distance[0]
        while heap:
            d, a = heapq.heappop(heap)
            if d > max(best * ratio, best + 1e-9) * 1.05:  # the walk goes a little past the bound
                break
            new = self.links[a][np.isinf(distance[self.links[a]])]
            distance[new] = np.sqrt(np.maximum(0, 2 - 2 * (self.c[new] @ q)))
            for d, b in zip(distance[new].tolist(), new.tolist(), strict=True):
                heapq.heappush(heap, (d, b))
                best = min(best, d)
        hit = np.flatnonzero(distance <= best * ratio + 1e-12)
        if len(hit) < least:
            return np.argsort(-(self.c @ q), kind="stable")[:least]
        return hit[np.argsort(distance[hit], kind="stable")]


def _rows(b: pa.RecordBatch, name: str, dim: int) -> np.ndarray:
    return b.column(name).flatten().to_numpy().reshape(-1, dim) if b.num_rows else np.zeros((0, dim))


def nearest(vectors: DataFrame, is_query, k: int = 5, ratio: float = RATIO, boundary: float = BOUNDARY, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """query_id, rank, vec_id, score: the ``k`` nearest found of each row where ``is_query`` holds."""
    spark = vectors.sparkSession
    common.prepare(spark)
    schema = "query_id long, rank int, vec_id long, score double"
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).cast("array<double>").alias("v")).where(usable(F.col("v")) & F.col("vec_id").isNotNull())
    sample = [np.array(r["v"]) for r in rows.orderBy(F.xxhash64("vec_id"), "vec_id").limit(SAMPLE).collect()]
    if not sample:
        return spark.createDataFrame([], schema)
    sizes, counts = np.unique([len(x) for x in sample], return_counts=True)
    dim = int(sizes[counts.argmax()])
    rows = rows.where(F.size("v") == dim)
    sample = unit(np.stack([x for x in sample if len(x) == dim]))
    n = rows.count()
    graph = CentroidGraph(fit_centroids(sample, int(np.clip(n // ROWS_PER_LIST, 1, min(MOST_LISTS, len(sample))))))

    def post(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            near = np.sqrt(np.maximum(0, 2 - 2 * (unit(_rows(b, "v", dim)) @ graph.c.T))) if b.num_rows else np.zeros((0, len(graph.c)))
            at, to = np.nonzero(near <= near.min(axis=1, initial=np.inf, keepdims=True) * boundary + 1e-12)
            yield pa.RecordBatch.from_arrays([b.column("vec_id").take(pa.array(at)), pa.array(to, pa.int32()), b.column("v").take(pa.array(at))], ["vec_id", "list", "v"])

    postings = common.stored(rows.mapInArrow(post, "vec_id long, list int, v array<double>"))
    queries = rows.where(is_query(F.col("vec_id")))
    long_lists = {r["list"]: -(-r["n"] // PART) for r in postings.groupBy("list").agg(F.count("*").alias("n")).collect()}  # at most MOST_LISTS rows

    def search(ask: DataFrame, least: int) -> DataFrame:
        def visit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                hits = [graph.within(q, ratio, least) for q in unit(_rows(b, "v", dim))] if b.num_rows else []
                at = np.repeat(np.arange(len(hits)), [len(h) for h in hits])
                to = np.concatenate(hits) if hits else np.zeros(0, np.int64)
                yield pa.RecordBatch.from_arrays([b.column("vec_id").take(pa.array(at)), pa.array(to, pa.int32()), b.column("v").take(pa.array(at))], ["vec_id", "list", "v"])

        visits = common.stored(ask.mapInArrow(visit, "vec_id long, list int, v array<double>"))
        asked = {r["list"]: -(-r["n"] // PART) for r in visits.groupBy("list").agg(F.count("*").alias("n")).collect()}
        parts = spark.createDataFrame([(i, p, asked[i]) for i, p in long_lists.items() if i in asked] or [(-1, 1, 1)], "list int, parts int, asks int")
        salt = lambda many: F.pmod(F.xxhash64("vec_id"), F.col(many)).cast("int")
        all_of = lambda many: F.explode(F.sequence(F.lit(0), F.col(many) - 1))
        held = postings.join(F.broadcast(parts), "list").select("list", salt("parts").alias("part"), all_of("asks").alias("ask"), "vec_id", "v")
        asks = visits.join(F.broadcast(parts), "list").select("list", all_of("parts").alias("part"), salt("asks").alias("ask"), "vec_id", "v")

        def scan(a: pa.Table, h: pa.Table) -> pa.Table:
            out: list[list[np.ndarray]] = [[], [], []]
            if a.num_rows and h.num_rows:
                q, x = (t.column("v").combine_chunks().flatten().to_numpy().reshape(-1, dim) for t in (a, h))
                q_ids, ids = a.column("vec_id").to_numpy(), h.column("vec_id").to_numpy()
                x = x / np.abs(x).max(axis=1, keepdims=True)
                q = q / np.abs(q).max(axis=1, keepdims=True)
                x_norm, q_norm = np.sqrt((x * x).sum(axis=1)), np.sqrt((q * q).sum(axis=1))
                for lo in range(0, len(q), 256):
                    rough = (q[lo : lo + 256] @ x.T) / x_norm
                    rough[q_ids[lo : lo + 256, None] == ids[None, :]] = -np.inf
                    top = min(k, len(ids))
                    floor = np.partition(rough, len(ids) - top, axis=1)[:, len(ids) - top]
                    for i, f in enumerate(floor.tolist()):
                        j = np.flatnonzero((rough[i] >= f - 1e-9 * q_norm[lo + i]) & (rough[i] > -np.inf))
                        # one order of summation for every pair, so that copies tie
                        score = (x[j] * q[lo + i]).sum(axis=1) / (x_norm[j] * q_norm[lo + i])
                        best = np.lexsort((ids[j], -score))[:k]
                        for o, v in zip(out, (np.full(len(best), q_ids[lo + i]), ids[j[best]], score[best]), strict=True):
                            o.append(v)
            cols = [np.concatenate(o) if o else np.zeros(0) for o in out]
            return pa.table({"query_id": pa.array(cols[0], pa.int64()), "vec_id": pa.array(cols[1], pa.int64()), "score": pa.array(cols[2], pa.float64())})

        cell = ["list", "part", "ask"]
        found = asks.groupBy(*cell).cogroup(held.groupBy(*cell)).applyInArrow(scan, "query_id long, vec_id long, score double")
        best = F.slice(F.array_sort(F.collect_set(F.struct((-F.col("score")).alias("s"), "vec_id"))), 1, k)
        # a visited list part gives k rows at most and the number of lists is bounded
        return found.groupBy("query_id").agg(best.alias("b")).select("query_id", F.posexplode("b").alias("rank", "b")).select("query_id", (F.col("rank") + 1).cast("int").alias("rank"), F.col("b.vec_id").alias("vec_id"), (-F.col("b.s")).alias("score"))

    out, least = common.stored(search(queries, 1)), 1
    # a query's own row is no candidate, nor are rows that repeat its id
    ids = rows.groupBy("vec_id").agg(F.count("*").alias("n"))
    wanted = queries.select("vec_id").distinct().join(ids, "vec_id").select("vec_id", F.least(F.lit(k).cast("long"), F.lit(n) - F.col("n")).alias("wanted"))
    wanted = common.stored(wanted)
    while least < len(graph.c):
        have = out.groupBy(F.col("query_id").alias("vec_id")).agg(F.count("*").alias("have"))
        short = common.stored(wanted.join(have, "vec_id", "left").where(F.coalesce("have", F.lit(0)) < F.col("wanted")).select("vec_id"))
        if short.isEmpty():
            break
        least = min(4 * least, len(graph.c))
        again = search(queries.join(short, "vec_id"), least)
        out = common.stored(out.join(short.withColumnRenamed("vec_id", "query_id"), "query_id", "left_anti").unionByName(again))
    return out


def query(spark, sf_dir: str) -> DataFrame:
    return nearest(common.table(spark, sf_dir, "embeddings"), lambda vec_id: vec_id % 50 == 0)
