"""Links between vectors that the table does not hold by itself."""

import duckdb
from pyspark.sql import functions as F

from barline.llm import embedding_dedup as E


def test_planted_copies_link_as_sql_says(spark):
    sf = "/root/testdata/sf0.001"
    con = duckdb.connect()
    con.execute(f"create view embeddings as select * from '{sf}/embeddings.parquet'")
    want = sorted(con.execute(E.PLANTED_SQL).fetchall())
    got = E.planted_query(spark, sf)
    assert sorted(map(tuple, got.collect())) == want
    share = {r.k: r.share for r in got.where("vec_id >= 1000000000").groupBy((F.col("vec_id") % 5).alias("k")).agg(F.avg((F.col("n_links") > 0).cast("int")).alias("share")).collect()}
    assert share[0] == share[1] == 1 and 0 < share[2] < 1 and share[3] == share[4] == 0
