"""Column functions of bars and indicators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def round_half_up(x: Column, places: int) -> Column:
    """``x * 10**places + 0.5`` cut towards zero, as the serving tables round; null stays null."""
    unit = float(10**places)
    return (x * unit + 0.5).cast("long") / unit


def _second(micros: Column) -> Column:
    return F.floor(micros / 1_000_000).cast("long")


def slot(micros: Column, width: int = 900) -> Column:
    """Number of the slot of ``width`` seconds that a time in microseconds falls in."""
    return F.floor(_second(micros) / width).cast("long")


def slot_date(group_id: Column, width: int = 900) -> Column:
    """A slot's start as text."""
    return F.from_unixtime(group_id * width, "yyyy-MM-dd HH:mm:ss")


def bar_keys(df: DataFrame, width: int = 900) -> DataFrame:
    """timestamp_second, timestamp_date, group_id and group_date from ``timestamp`` in microseconds."""
    second, group = _second(F.col("timestamp")), slot(F.col("timestamp"), width)
    return df.withColumns({"timestamp_date": F.from_unixtime(second, "yyyy-MM-dd"), "timestamp_second": second, "group_id": group, "group_date": slot_date(group, width)})


def lineage_columns(df: DataFrame, symbol: str | None = None, landing_date: str | None = None) -> DataFrame:
    """When a row was made, and for which symbol and day."""
    df = df.withColumns({"transform_date": F.current_date(), "transform_timestamp": F.current_timestamp()})
    df = df.withColumn("landing_date", F.to_date(F.lit(landing_date), "yyyy-MM-dd")) if landing_date else df
    return df.withColumn("symbol", F.lit(symbol)) if symbol else df


def candle_shape(df: DataFrame) -> DataFrame:
    o, c = F.col("open_price"), F.col("close_price")
    return df.withColumns({"body": F.abs(c - o), "lower_shadow": F.least(o, c) - F.col("low_price"), "upper_shadow": F.col("high_price") - F.greatest(o, c)})


def trend(fast: Column, slow: Column) -> Column:
    return F.when(fast > slow, "uptrend").when(fast < slow, "downtrend")


#: Types of the serving sink.
SINK_TYPES = dict.fromkeys(("open_price", "high_price", "low_price", "close_price", "ema7", "ema20", "ema12", "ema26"), "decimal(10,6)")
SINK_TYPES |= dict.fromkeys(("volume", "rsi_ag", "rsi_al", "macd", "signal", "histogram"), "decimal(18,8)") | {"rsi6": "decimal(5,2)"}


def sink_cast(df: DataFrame) -> DataFrame:
    """Casts to the sink's decimals; what does not fit becomes null."""
    return df.withColumns({c: F.col(c).try_cast(t) for c, t in SINK_TYPES.items() if c in df.columns})
