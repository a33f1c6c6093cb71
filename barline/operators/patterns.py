"""Candlestick patterns of one, two and three bars."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from barline.functions.columns import candle_shape, trend
from barline.operators.blocks import SPAN

UP, DOWN = "uptrend", "downtrend"
_LAGS = {"open_price": "o", "close_price": "c", "high_price": "h", "low_price": "l"}
_TWICE = list(_LAGS.items())[:2]


def lags(bars: DataFrame, by_day: bool = False, span: int = SPAN) -> DataFrame:
    """Adds o1, c1, h1, l1 of the bar before and o2, c2 of the one before that, within the symbol (and day).

    Windows are over blocks of ``span`` slots, so a symbol's history is many tasks. The last two
    bars of each block are handed on to the next block that has bars; only they, two rows a block,
    are ever sorted by symbol alone. ``bars`` is read twice: store what is dear to compute.
    """
    if by_day:
        w = Window.partitionBy("symbol", "landing_date").orderBy("group_id")
        cols = {f"{s}1": F.lag(c, 1).over(w) for c, s in _LAGS.items()}
        return bars.withColumns(cols | {f"{s}2": F.lag(c, 2).over(w) for c, s in _TWICE})
    keyed = bars.withColumn("_block", F.floor(F.col("group_id") / span))
    w = Window.partitionBy("symbol", "_block").orderBy("group_id")
    last_two = keyed.select("symbol", "_block", "group_id", F.struct(*_LAGS).alias("bar"), F.lead("group_id", 2).over(w).isNull().alias("last")).where("last")
    all_of = Window.partitionBy("symbol").orderBy("group_id")
    before = last_two.withColumns({"p1": F.lag("bar", 1).over(all_of), "p2": F.lag("bar", 2).over(all_of)})
    before = before.groupBy("symbol", "_block").agg(F.min_by(F.struct("p1", "p2"), "group_id").alias("_before")).withColumnsRenamed({"symbol": "_s", "_block": "_b"})

    here = keyed.withColumns({"_n": F.row_number().over(w)} | {f"{s}1": F.lag(c, 1).over(w) for c, s in _LAGS.items()} | {f"{s}2": F.lag(c, 2).over(w) for c, s in _TWICE})
    both = here.join(before, F.col("symbol").eqNullSafe(F.col("_s")) & (F.col("_block") == F.col("_b")), "left")
    first = {f"{s}1": F.when(F.col("_n") == 1, F.col(f"_before.p1.{c}")).otherwise(F.col(f"{s}1")) for c, s in _LAGS.items()}
    second = {f"{s}2": F.when(F.col("_n") == 1, F.col(f"_before.p2.{c}")).when(F.col("_n") == 2, F.col(f"_before.p1.{c}")).otherwise(F.col(f"{s}2")) for c, s in _TWICE}
    return both.withColumns(first | second).select(*bars.columns, *first, *second)


def pattern_one() -> Column:
    """Needs ``candle_shape`` and trend."""
    hit = (F.col("body") > 0) & (F.col("lower_shadow") >= 2 * F.col("body")) & (F.col("upper_shadow") <= 0.25 * F.col("body"))
    return F.when(hit & (F.col("trend") == UP), "hanging man").when(hit & (F.col("trend") == DOWN), "hammer")


def pattern_two() -> Column:
    """Needs ``lags`` and trend."""
    o, c, o1, c1, t = (F.col(x) for x in ("open_price", "close_price", "o1", "c1", "trend"))
    bullish = (c1 < o1) & (c > o) & (o < c1) & (c > o1) & (t == DOWN)
    bearish = (c1 > o1) & (c < o) & (o > c1) & (c < o1) & (t == UP)
    return F.when(bullish, "bullish engulfing").when(bearish, "bearish engulfing")


def pattern_three() -> Column:
    """Needs ``lags`` and trend. A doji that also meets the star rule is a star."""
    o, c, o1, c1, h1, l1, o2, c2, t = (F.col(x) for x in ("open_price", "close_price", "o1", "c1", "h1", "l1", "o2", "c2", "trend"))
    middle = (o2 + c2) / 2
    morning = (c2 < o2) & (o1 < c2) & (c1 < c2) & (c > o) & (c >= middle) & (t == DOWN)
    evening = (c2 > o2) & (o1 > c2) & (c1 > c2) & (c < o) & (c <= middle) & (t == UP)
    star = F.abs(o1 - c1) <= 0.5 * F.abs(o2 - c2)
    doji = F.abs(o1 - c1) <= 0.1 * (h1 - l1)
    return F.when(morning & star, "morning star").when(evening & star, "evening star").when(morning & doji, "morning doji star").when(evening & doji, "evening doji star")


def patterns(bars: DataFrame, by_day: bool = False) -> DataFrame:
    """Bars with ema7 and ema20 -> + trend, pattern_one, pattern_two, pattern_three and, by priority, pattern."""
    df = candle_shape(lags(bars, by_day)).withColumn("trend", trend(F.col("ema7"), F.col("ema20")))
    df = df.withColumns({"pattern_one": pattern_one(), "pattern_two": pattern_two(), "pattern_three": pattern_three()})
    df = df.withColumn("pattern", F.coalesce("pattern_three", "pattern_two", "pattern_one"))
    return df.select(*bars.columns, "trend", "pattern_one", "pattern_two", "pattern_three", "pattern")
