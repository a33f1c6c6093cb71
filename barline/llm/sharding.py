"""Sharding by a hierarchical weighted hash tree: region, then rack, then shard.

At each level every child draws ``-ln(u) / weight`` with ``u`` from the md5 of the
document's id and the child's name; the least draw wins. A child's draw depends on
its own name and weight alone: when a weight grows, documents move only into that
child, and when it shrinks, only out of it, so other subtrees keep theirs. ``grown``
adds a shard as a region of its own, which therefore takes documents only into itself,
however many shards there are; one added within a region may also move documents within
that region.

``slot`` numbers a shard's documents without gaps, in the order of the md5 of their
ids, counted in two levels (shard, md5 bucket).

Defined results: a null text has no bytes and the crc32 of an empty one; a null id
draws as the text ``null``; repeated rows land in one shard, in slots of their own;
an empty table gives no row. Columns other than the two named ones are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from barline.llm import common

#: Shards in a rack and racks in a region of ``even_tree``.
RACK_SHARDS = 5
REGION_RACKS = 4
OVERHEAD = 16

Tree = list[list[list[tuple[int, float]]]]
"""Regions of racks of (shard, weight)."""


def even_tree(shards: int) -> Tree:
    """Shards of weight 1, filled rack by rack and region by region."""
    racks = [[(s, 1.0) for s in range(lo, min(lo + RACK_SHARDS, shards))] for lo in range(0, shards, RACK_SHARDS)]
    return [racks[lo : lo + REGION_RACKS] for lo in range(0, len(racks), REGION_RACKS)]


def grown(tree: Tree, weight: float = 1.0) -> Tree:
    """The tree with one more shard, of the next number, as a region of its own."""
    last = max((s for region in tree for rack in region for s, _ in rack), default=-1)
    return [*tree, [[(last + 1, weight)]]]


def _draw(key: Column, *name: Column | str, weight: Column) -> Column:
    digest = F.md5(F.concat_ws("/", key, *(F.lit(n) if isinstance(n, str) else n.cast("string") for n in name)))
    u = (F.conv(F.substring(digest, 1, 13), 16, 10).cast("double") + 0.5) / float(1 << 52)
    return F.when(weight > 0, -F.log(u) / weight)


def _least(draws: list[Column]) -> Column:
    """Place of the least draw; null draws take no part, ties go to the first."""
    return F.least(*[F.when(d.isNotNull(), F.struct(d.alias("draw"), F.lit(i).alias("at"))) for i, d in enumerate(draws)], F.lit(None).cast("struct<draw:double,at:int>"))["at"]


def _table(values: list, *at: Column) -> Column:
    """A nested list literal looked up at zero-based places."""

    def literal(v) -> Column:
        return F.array(*map(literal, v)) if isinstance(v, list) else F.lit(v)

    out = literal(values)
    for a in at:
        out = F.element_at(out, a + 1)
    return out


def _padded(values: list, n: int, fill) -> list:
    return values + [fill] * (n - len(values))


def with_shard(df: DataFrame, tree: Tree, key: Column, out: str) -> DataFrame:
    """Adds column ``out``: the shard that the tree gives to ``key``, a non-null string."""
    n_racks, n_shards = max(map(len, tree)), max(len(rack) for region in tree for rack in region)
    weigh = [[sum(w for _, w in rack) for rack in region] for region in tree]
    racks = [_padded(r, n_racks, 0.0) for r in weigh]
    leaves = [[_padded([w for _, w in rack], n_shards, 0.0) for rack in _padded(region, n_racks, [])] for region in tree]
    names = [[_padded([s for s, _ in rack], n_shards, -1) for rack in _padded(region, n_racks, [])] for region in tree]
    region, rack, leaf = F.col("_region"), F.col("_rack"), F.col("_leaf")
    df = df.withColumn("_region", _least([_draw(key, "region", str(i), weight=F.lit(sum(w))) for i, w in enumerate(weigh)]))
    df = df.withColumn("_rack", _least([_draw(key, "rack", region, str(i), weight=_table(racks, region, F.lit(i))) for i in range(n_racks)]))
    df = df.withColumn("_leaf", _least([_draw(key, "shard", region, rack, str(i), weight=_table(leaves, region, rack, F.lit(i))) for i in range(n_shards)]))
    return df.withColumn(out, _table(names, region, rack, leaf)).drop("_region", "_rack", "_leaf")


def sharded(docs: DataFrame, tree: Tree, larger: Tree | None = None) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard (null without ``larger``)."""
    text = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    key = F.coalesce(F.col("doc_id").cast("string"), F.lit("null"))
    d = docs.select("doc_id", (F.octet_length(text) + OVERHEAD).cast("long").alias("size"), F.crc32(text).alias("text_crc32"), key.alias("_key"), F.md5(key).alias("_h"))
    d = with_shard(d, tree, F.col("_key"), "shard")
    d = with_shard(d, larger, F.col("_key"), "grown_shard") if larger else d.withColumn("grown_shard", F.lit(None).cast("int"))
    d = common.stored(d.withColumn("_bucket", F.substring("_h", 1, 2)).drop("_key"))
    before = Window.partitionBy("shard").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = d.groupBy("shard", "_bucket").agg(F.count("*").alias("n")).select("shard", "_bucket", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    within = Window.partitionBy("shard", "_bucket").orderBy("_h", "doc_id", "size", "text_crc32")
    d = d.join(starts, ["shard", "_bucket"]).withColumn("slot", (F.col("base") + F.row_number().over(within) - 1).cast("long"))
    return d.select("doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", "slot", "grown_shard")


def query(spark, sf_dir: str) -> DataFrame:
    return sharded(common.table(spark, sf_dir, "documents"), even_tree(40), grown(even_tree(40)))
