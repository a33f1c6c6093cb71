"""Jobs over many symbols and days at once."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barline.operators.bars import klines_batch, prev_day_state
from barline.operators.patterns import patterns
from barline.operators.recurrence import indicators
from barline.plans import storage

BAR_COLUMNS = ["group_id", "group_date", "open_time", "open_price", "high_price", "low_price", "close_price", "volume", "close_time", "landing_date", "symbol"]


class Tables(dict):
    """Named tables that read what was stored for them; ``free`` deletes that once they are written elsewhere."""

    spark: SparkSession
    folder: str | None = None

    def free(self) -> None:
        if self.folder:
            storage.delete(self.spark, self.folder)


def _tables(full: DataFrame, by_day: bool, folder: str | None) -> Tables:
    """klines, macd, rsi6 and the three pattern tables from bars with their indicators."""
    marked = patterns(full, by_day)
    out = Tables(klines=full.select(*BAR_COLUMNS), macd=full.select(*BAR_COLUMNS, "ema12", "ema26", "macd", "signal", "histogram"), rsi6=full.select(*BAR_COLUMNS, "rsi6", "rsi_ag", "rsi_al"))
    for n in ("one", "two", "three"):
        out[f"pattern_{n}"] = marked.select(*BAR_COLUMNS, "ema7", "ema20", "trend", F.col(f"pattern_{n}").alias("pattern"))
    out.spark, out.folder = full.sparkSession, folder
    return out


def backfill(trades: DataFrame, first: str, last: str, width: int = 900, carry: str = "daily_rounded", **sizes: int) -> Tables:
    """klines, macd, rsi6 and the three pattern tables for every symbol and day between two dates.

    Days are carried by ``blocks.scan``: blocks of days run at once from guessed states, and
    only those run again whose guess was wrong. So a range needs no day-by-day jobs, a symbol's
    history is many tasks, and later days follow when an earlier one changes. Bars with their
    indicators are stored in the shared folder, and all tables read them; ``free`` deletes them.
    """
    days = F.col("landing_date").between(F.to_date(F.lit(first)), F.to_date(F.lit(last)))
    bars = klines_batch(trades.where(days), width).select(*BAR_COLUMNS)
    folder = storage.scratch(trades.sparkSession)
    return _tables(indicators(bars, carry, folder=folder, **sizes), carry == "daily_rounded", folder)


def run_day(trades: DataFrame, stored: dict[str, DataFrame], day: str, width: int = 900) -> Tables:
    """One day's tables for all symbols, carried on from the stored tables of the day before.

    Of ``stored`` (macd, rsi6 and pattern_one as this function or ``backfill`` gave them) only
    the partitions of that day are read, and their last bar of each symbol counts. A symbol
    without one starts cold, and so does an indicator whose stored value is null.
    """
    date = F.to_date(F.lit(day))
    bars = klines_batch(trades.where(F.col("landing_date") == date), width).select(*BAR_COLUMNS)
    days = bars.select("symbol", "landing_date").distinct()
    last = {t: stored[t].where(F.col("landing_date") == F.date_sub(date, 1)) for t in ("macd", "rsi6", "pattern_one")}
    previous = prev_day_state(last["macd"], days, ["ema12", "ema26", "signal"])
    for table, columns in (("rsi6", ["rsi_ag", "rsi_al", "close_price"]), ("pattern_one", ["ema7", "ema20"])):
        previous = previous.join(prev_day_state(last[table], days, columns), ["symbol", "landing_date"])
    folder = storage.scratch(trades.sparkSession)
    return _tables(storage.stored(indicators(bars, "daily_rounded", previous), f"{folder}/day"), True, folder)
