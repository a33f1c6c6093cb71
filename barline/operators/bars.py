"""OHLCV bars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barline.functions.columns import slot, slot_date


def klines_batch(trades: DataFrame, width: int = 900, price_places: int = 4, volume_places: int = 1, order_by: tuple[str, ...] = ("timestamp", "agg_trade_id")) -> DataFrame:
    """One bar per symbol, landing date and time slot.

    Open and close follow ``order_by`` and skip null prices, whatever order the rows come in.
    One shuffle, on the bar's key; aggregates combine before it, so it moves bars, not trades.
    The key has numbers, a date and the symbol alone; the slot's date is written out once a bar.
    Two columns of order make a sort aggregate, which is faster than a hash aggregate over both
    packed into one decimal; for feeds whose ids rise with time, ("agg_trade_id",) makes a hash
    aggregate.
    """
    at = F.struct(*order_by) if len(order_by) > 1 else F.col(order_by[0])
    priced = F.when(F.col("price").isNotNull(), at)
    keyed = trades.withColumn("group_id", slot(F.col("timestamp"), width))
    bars = keyed.groupBy("group_id", "landing_date", "symbol").agg(
        F.min("timestamp").alias("open_time"),
        F.round(F.min_by("price", priced), price_places).alias("open_price"),
        F.round(F.max("price"), price_places).alias("high_price"),
        F.round(F.min("price"), price_places).alias("low_price"),
        F.round(F.max_by("price", priced), price_places).alias("close_price"),
        F.round(F.sum("quantity"), volume_places).alias("volume"),
        F.max("timestamp").alias("close_time"),
    )
    return bars.select("group_id", slot_date(F.col("group_id"), width).alias("group_date"), *bars.columns[1:])


def prev_day_state(table: DataFrame, days: DataFrame, state: list[str]) -> DataFrame:
    """For each (symbol, landing_date) of ``days``: ``state`` of the last bar of the day before, or nulls."""
    last = table.groupBy("symbol", "landing_date").agg(F.max_by(F.struct(*state), "group_id").alias("s"))
    last = last.select("symbol", F.date_add("landing_date", 1).alias("landing_date"), *(F.col(f"s.{c}").alias(f"prev_{c}") for c in state))
    return days.select("symbol", "landing_date").distinct().join(last, ["symbol", "landing_date"], "left")
