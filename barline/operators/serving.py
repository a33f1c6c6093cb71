"""Queries over finished tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def latest_klines(bars: DataFrame, n: int = 20) -> DataFrame:
    return bars.orderBy(F.desc("group_id"), "symbol").limit(n)


def pattern_only(rows: DataFrame) -> DataFrame:
    return rows.where(F.col("pattern").isNotNull())


def latest_patterns(rows: DataFrame, n: int = 20) -> DataFrame:
    return latest_klines(pattern_only(rows), n)


def pattern_history(rows: DataFrame) -> DataFrame:
    return pattern_only(rows).orderBy("group_id", "symbol")


def distinct_symbols(rows: DataFrame) -> DataFrame:
    return rows.select("symbol").distinct().orderBy("symbol")


def trade_preview(trades: DataFrame, n: int = 20) -> DataFrame:
    return trades.select("agg_trade_id", "symbol", "price", "quantity", "timestamp").orderBy("agg_trade_id").limit(n)


def chart_series(rows: DataFrame, symbol: str, start: str, end: str, time: str = "time") -> DataFrame:
    """A symbol's rows in a time range; ``marked`` is the close where a pattern fired. Bounds that are no times give no rows."""
    between = F.col(time).between(F.try_to_timestamp(F.lit(start)), F.try_to_timestamp(F.lit(end)))
    marked = F.when(F.col("pattern").isNotNull(), F.col("close_price"))
    return rows.where((F.col("symbol") == symbol) & between).withColumn("marked", marked).orderBy(time)
