"""Table lookups against plain products, and mining against a plain version of itself."""

import math

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from barline.llm import hard_negatives as H

SCHEMA = "vec_id long, embedding array<double>, label int, a string, rank int, ints string"


@pytest.mark.parametrize("dim", [0, 1, 8, 13, 64])
@pytest.mark.parametrize("top", [1, 200, 1 << 22])
def test_scores_are_inner_products(dim, top):
    rng = np.random.default_rng(dim + top)
    a, b = rng.integers(-top, top, (5, dim)), rng.integers(-top - 1, top + 1, (9, dim))
    bits, planes = H.bit_planes(b)
    assert (H.scores(H.subset_sums(a), planes) == a @ b.T).all() and planes.shape == (9, bits, -(-dim // 8))


def plain(rows):
    ok = []
    for i, v, label in rows:
        if i is not None and v is not None and label is not None and all(x is not None and math.isfinite(x) for x in v) and sum(abs(x * 256) + 1 for x in v) < 1 << 31:
            ok.append((i, [math.floor(256 * x) for x in v], (label + 1) % 10 if i % 7 == 0 else label))
    out = []
    for i, v, label in ok:
        if i % 50:
            continue
        near = sorted((-sum(x * y for x, y in zip(v, w, strict=True)), j, other) for j, w, other in ok if j != i and len(w) == len(v))
        for ps, j, other in [x for x in near if x[2] == label][:5]:
            fit = [x for x in near if x[2] != label and 50 * -ps <= 100 * -x[0] <= 95 * -ps][:3]
            out += [(i, j, r + 1, k, -ps, -ns) for r, (ns, k, _) in enumerate(fit)]
    return sorted(out)


def mined(df, **sizes):
    rows = H.prepared(df).withColumn("label", F.expr("if(vec_id % 7 = 0, (label + 1) % 10, label)"))
    return sorted(tuple(r) for r in H.mined(rows, F.col("vec_id") % 50 == 0, **sizes).collect())


def test_mining_equals_the_plain_version(spark, monkeypatch):
    rng = np.random.default_rng(3)
    rows = []
    for i in range(-150, 650):
        near = rng.integers(0, 6)
        v = (np.eye(12)[near] * 0.5 + rng.normal(0, 0.12, 12)).round(2).tolist()
        rows.append((i, v, int(near if rng.random() < 0.5 else rng.integers(0, 10))))
    copies = [0.5] * 12
    rows += [(1000 + k, copies, k % 3) for k in range(60)] + [(1000, copies, 1), (1001, copies, 1), (0, copies, 2)]  # copies, repeated ids
    rows += [(2000, None, 1), (2050, [0.1] * 12, None), (None, copies, 1), (2100, [float("nan"), *copies[1:]], 1), (2150, [None, *copies[1:]], 1), (2200, [float("inf"), *copies[1:]], 1)]
    rows += [(2250, [0.0] * 12, 1), (2300, [], 1), (2301, [], 1), (2302, [], 2), (2350, [1.0, 2.0], 4), (2351, [1.0, 1.0], 4), (2353, [1.0, 0.5], 3), (2400, [3000.0] * 12, 5), (2403, [3e4] * 12, 5), (2402, [2e4] * 12, 6), (2450, [1e300] * 12, 5)]
    df = spark.createDataFrame([(*r, "x", 1, "y") for r in rows], SCHEMA).repartition(5)
    want = plain(rows)
    assert len({r[0] for r in want}) > 15 and any(r[0] == 2300 for r in want) and any(r[0] == 2350 for r in want) and any(r[4] > 1 << 31 for r in want)
    assert mined(df) == want
    monkeypatch.setattr(H, "TILE", (3, 50))
    assert mined(df, sizes=(7, 130)) == want
    assert mined(df.where("false")) == [] and mined(df.where("vec_id % 50 <> 0")) == []
    assert mined(df.withColumn("label", F.lit(3)).where("vec_id % 7 <> 0"), sizes=(7, 130)) == []  # one label: no negatives


def test_query_equals_sql(spark):
    sf = "/root/testdata/sf0.001"
    con = duckdb.connect()
    con.execute(f"create view embeddings as select * from '{sf}/embeddings.parquet'")
    want = sorted(con.execute(H.SQL).fetchall())
    assert want and sorted(tuple(r) for r in H.query(spark, sf).collect()) == want
