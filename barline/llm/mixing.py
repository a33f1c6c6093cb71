"""Mixing sources to target weights with a low-discrepancy source schedule.

Each source is a stream of its documents' words, in the order of the documents'
md5, cut into blocks of BLOCK_WORDS words (the last one shorter). A schedule slot
``i`` has the van der Corput point of ``i``; the point's place among the sources'
cumulative weights names the slot's source, so that every stretch of the schedule
holds the sources in proportion. The slots of a source are ranked, and rank ``r``
takes block ``r % blocks``, so that a source is read through before it repeats. A
source leaves the schedule when its words taken reach its target.

Hot sources: streams and ranks are summed in two levels, (source, md5 bucket) and
(source, run of slots), so no task holds a source.

Sources are few beside documents: what is known of each is one row, ordered in one task.

Defined results: a null text has no words; a null source is a source of its own,
last in order; documents without words are taken 0 times; repeated rows count each;
an empty table gives no row. Columns other than the named ones are not read.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from barline.llm import common

BLOCK_WORDS = 1024
WEIGHTS = (5, 2, 1)
MOST_REPEATS = 3
#: Sources up to which what is known of each is broadcast.
BROADCAST_ROWS = 100_000
_POINT_BITS = 40
_CELL_BITS = 12
_RUN = 1 << 14


def targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST_REPEATS) -> DataFrame:
    """k, source_size -> + target. Weights repeat over the sources by code point, null last.

    What a source may not take, being above ``most`` times its size, is shared by
    weight among the others, until none is above. One row per source.
    """
    every = Window.partitionBy()
    by_room = Window.orderBy("room", "k").rowsBetween(Window.unboundedPreceding, -1)
    zero = F.lit(0).cast("long")
    w = F.element_at(F.array(*map(F.lit, weights)), ((F.row_number().over(Window.orderBy("k")) - 1) % len(weights) + 1).cast("int"))
    s = sizes.withColumn("weight", w.cast("long")).withColumn("cap", most * F.col("source_size"))
    s = s.withColumn("room", F.col("cap").cast("double") / F.col("weight").cast("double"))
    s = s.withColumns({"cap_before": F.coalesce(F.sum("cap").over(by_room), zero), "weight_before": F.coalesce(F.sum("weight").over(by_room), zero), "words": F.sum("source_size").over(every), "weights": F.sum("weight").over(every)})
    s = s.withColumn("level", (F.col("words") - F.col("cap_before")).cast("double") / (F.col("weights") - F.col("weight_before")).cast("double"))
    s = s.withColumn("share", F.max(F.when(F.col("cap").cast("double") >= F.col("weight") * F.col("level"), F.col("level"))).over(every))
    return s.select("k", "source_size", F.least(F.col("cap").cast("double"), F.col("weight") * F.col("share")).alias("target"))


def schedule(sources: DataFrame) -> DataFrame:
    """k, slots -> slot, k, rank: each source's first ``slots`` slots, ranked from 0.

    The number of slots is a power of two and at least twice those needed, so the
    points are evenly spaced and each source gets its own.
    """
    spark = sources.sparkSession
    top = float(1 << _POINT_BITS)
    before = Window.orderBy("k").rowsBetween(Window.unboundedPreceding, -1)
    s = sources.where("slots > 0").withColumns({"all": F.sum("slots").over(Window.partitionBy()), "before": F.coalesce(F.sum("slots").over(before), F.lit(0))})
    s = s.select("k", "slots", F.floor(F.col("before") * (top / F.col("all"))).cast("long").alias("lo"), F.floor((F.col("before") + F.col("slots")) * (top / F.col("all"))).cast("long").alias("hi"))
    needed = sources.agg(F.sum("slots")).first()[0] or 0
    n = 1 << math.ceil(math.log2(2 * needed)) if needed else 0
    shift = _POINT_BITS - _CELL_BITS
    cells = s.withColumn("cell", F.explode(F.sequence(F.shiftright("lo", shift), F.shiftright(F.col("hi") - 1, shift))))
    point = F.conv(F.rpad(F.reverse(F.bin("id")), _POINT_BITS, "0"), 2, 10).cast("long")
    points = spark.range(n).select(F.col("id").alias("slot"), point.alias("point")).withColumn("cell", F.shiftright("point", shift))
    drawn = points.join(cells, "cell").where("point >= lo and point < hi").select("slot", "k", "slots", F.floor(F.col("slot") / _RUN).alias("run"))
    ahead = Window.partitionBy("k").orderBy("run").rowsBetween(Window.unboundedPreceding, -1)
    runs = drawn.groupBy("k", "run").agg(F.count("*").alias("n")).select("k", "run", F.coalesce(F.sum("n").over(ahead), F.lit(0)).alias("ranked"))
    within = Window.partitionBy("k", "run").orderBy("slot")
    ranked = drawn.join(runs, ["k", "run"]).withColumn("rank", F.col("ranked") + F.row_number().over(within) - 1)
    return ranked.where("rank < slots").select("slot", "k", "rank")


def mixed(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST_REPEATS, block_words: int = BLOCK_WORDS) -> tuple[DataFrame, DataFrame]:
    """(documents, schedule).

    documents: doc_id, size, source_size, target, taken. schedule: slot, source key
    ``k``, block, words: the mix in order, each slot taking the first ``words`` words
    of a block of its source.
    """
    taken, slots = _mixed(docs, weights, most, block_words)
    return taken.select("doc_id", "size", "source_size", "target", "taken"), slots


def mixed_documents(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST_REPEATS) -> DataFrame:
    """Whole documents, as often as the mix takes their words, to the nearest number; with all columns of ``docs``.

    A source's stream is in the order of ``h``, and its last round of blocks breaks off
    somewhere: up to there each document is taken once more than beyond. So the mix comes
    down to three values a source, and texts are not moved. Documents without words are
    not taken; rows that share an id are taken equally often.
    """
    with common.passing(docs.sparkSession):
        taken, _ = _mixed(docs, weights, most, BLOCK_WORDS)
        n = F.round(F.col("taken") / F.col("size")).cast("int")
        each = common.stored(taken.where("size > 0").groupBy("k", "h").agg(F.max(n).alias("n")))
        span = each.groupBy("k").agg(F.min("n").alias("low"), F.max("n").alias("high"))
        last = each.join(span, "k").where("n = high").groupBy("k").agg(F.max("h").alias("cut"))
        rule = common.lasting(span.join(last, "k"))
    k, h, times, one, low, high, cut = common.unused(docs, "k", "h", "times", "one", "low", "high", "cut")
    rule = rule.select(F.col("k").alias(k), F.col("low").alias(low), F.col("high").alias(high), F.col("cut").alias(cut))
    rule = F.broadcast(rule) if rule.count() <= BROADCAST_ROWS else rule
    own = common.columns(docs)
    rows = docs.where(F.coalesce(F.col("text").rlike(common.WORD), F.lit(False))).select(*own, _source_key().alias(k), _place().alias(h)).join(rule, k)
    rows = rows.withColumn(times, F.when(F.col(h) <= F.col(cut), F.col(high)).otherwise(F.col(low))).where(F.col(times) > 0)
    return rows.withColumn(one, F.explode(F.sequence(F.lit(1), F.col(times)))).select(*own)


def _source_key() -> Column:
    return F.coalesce(F.concat(F.lit("s"), F.col("source")), F.lit("t"))  # null last


def _place() -> Column:
    """What a source's documents are ordered by."""
    return F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit("null")))


def _mixed(docs: DataFrame, weights: tuple[int, ...], most: int, block_words: int) -> tuple[DataFrame, DataFrame]:
    b = F.lit(block_words).cast("long")
    d = common.stored(docs.select("doc_id", _source_key().alias("k"), common.word_count(F.col("text")).alias("size"), _place().alias("h")).withColumn("bucket", F.substring("h", 1, 3)))
    buckets = common.stored(d.groupBy("k", "bucket").agg(F.sum("size").alias("n")))
    src = targets(buckets.groupBy("k").agg(F.sum("n").alias("source_size")), weights, most)
    quota = F.floor(F.col("target") + 0.5).cast("long")
    size = F.greatest(F.col("source_size"), F.lit(1))
    blocks = F.ceil(F.col("source_size") / b).cast("long")
    full = F.floor(F.col("quota") / size).cast("long")
    src = src.withColumn("quota", quota).withColumn("blocks", blocks)
    src = common.stored(src.withColumn("slots", full * F.col("blocks") + F.ceil((F.col("quota") - full * F.col("source_size")) / b).cast("long")))

    before = Window.partitionBy("k").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = buckets.select("k", "bucket", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base")).join(src.select("k", "source_size", "target"), "k")
    within = Window.partitionBy("k", "bucket").orderBy("h", "doc_id", "size").rowsBetween(Window.unboundedPreceding, -1)
    placed = d.join(starts, ["k", "bucket"]).withColumn("at", F.col("base") + F.coalesce(F.sum("size").over(within), F.lit(0)))

    slots = schedule(src.select("k", "slots")).join(src.select("k", "source_size", "blocks", "quota"), "k")
    slots = slots.withColumn("block", F.col("rank") % F.col("blocks"))
    start = F.floor(F.col("rank") / F.col("blocks")) * F.col("source_size") + F.col("block") * b
    length = F.least(b, F.col("source_size") - F.col("block") * b)
    slots = slots.select("slot", "k", "block", length.alias("length"), F.least(length, F.col("quota") - start).cast("long").alias("words"))

    picks = slots.groupBy("k", "block").agg(F.sum((F.col("words") == F.col("length")).cast("long")).alias("whole"), F.coalesce(F.max(F.when(F.col("words") < F.col("length"), F.col("words"))), F.lit(0)).alias("part"))
    last = F.floor((F.col("at") + F.col("size") - 1) / b).cast("long")
    pieces = placed.where("size > 0").withColumn("block", F.explode(F.sequence(F.floor(F.col("at") / b).cast("long"), last)))
    lo = F.greatest(F.col("at") - F.col("block") * b, F.lit(0))
    hi = F.least(F.col("at") + F.col("size") - F.col("block") * b, b)
    got = F.coalesce(F.col("whole"), F.lit(0)) * (hi - lo) + F.greatest(F.least(hi, F.coalesce(F.col("part"), F.lit(0))) - lo, F.lit(0))
    cols = ["k", "h", "doc_id", "size", "source_size", "target"]
    taken = pieces.join(picks, ["k", "block"], "left").groupBy("at", *cols).agg(F.sum(got).alias("taken"))
    none = placed.where("size = 0").select(*cols, F.lit(0).cast("long").alias("taken"))
    return taken.select(*cols, "taken").unionByName(none), slots.select("slot", "k", "block", "words")


def query(spark, sf_dir: str) -> DataFrame:
    return mixed(common.table(spark, sf_dir, "documents"))[0]


SQL = """
WITH d AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0)::BIGINT AS size, md5(doc_id::VARCHAR) AS h FROM documents),
t AS (
  SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source),
w AS (
  SELECT *, CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END AS weight FROM t),
r AS (
  SELECT *, (3 * source_size)::DOUBLE / weight::DOUBLE AS room FROM w),
l AS (
  SELECT *, ((sum(source_size) OVER ())::BIGINT - coalesce(sum(3 * source_size) OVER before, 0)::BIGINT)::DOUBLE
         / ((sum(weight) OVER ())::BIGINT - coalesce(sum(weight) OVER before, 0)::BIGINT)::DOUBLE AS level
  FROM r WINDOW before AS (ORDER BY room, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
s AS (
  SELECT *, max(CASE WHEN (3 * source_size)::DOUBLE >= weight * level THEN level END) OVER () AS share FROM l),
g AS (
  SELECT source, source_size, least((3 * source_size)::DOUBLE, weight * share) AS target FROM s),
p AS (
  SELECT d.*, g.source_size, g.target, floor(g.target + 0.5)::BIGINT AS quota,
    coalesce(sum(size) OVER (PARTITION BY d.source ORDER BY h, doc_id, size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS pos
  FROM d JOIN g ON d.source IS NOT DISTINCT FROM g.source)
SELECT doc_id, size, source_size, target,
  CASE WHEN size = 0 THEN 0 ELSE (quota // source_size) * size + least(greatest(quota % source_size - pos, 0), size) END::BIGINT AS taken
FROM p
"""
