"""Streaming bars, indicators and sinks."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.streaming.query import StreamingQuery

from barline.operators.recurrence import OUTPUTS, STATE, advance, empty_state
from barline.sources.trades import decoded, json_trades

WATERMARK = "5 seconds"
WIDTH = "15 minutes"
BARS = ["open_price", "high_price", "low_price", "close_price", "volume"]


#: Gets a batch of a stream and its number.
Sink = Callable[[DataFrame, int], None]

PROVIDER = "spark.sql.streaming.stateStore.providerClass"
_ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


@contextmanager
def state_backend(spark: SparkSession) -> Iterator[None]:
    """Queries started within keep their state in RocksDB, which keyed state needs; the session's setting comes back."""
    before = spark.conf.get(PROVIDER, None)
    spark.conf.set(PROVIDER, _ROCKSDB)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(PROVIDER)
        else:
            spark.conf.set(PROVIDER, before)


def klines_stream(trades: DataFrame, width: str = WIDTH, watermark: str = WATERMARK) -> DataFrame:
    """Tumbling OHLCV bars per symbol of trades with event time ``ts``; rows of closed windows are dropped."""
    at = F.struct("ts_int", "agg_trade_id")
    priced = F.when(F.col("price").isNotNull(), at)
    bars = trades.withWatermark("ts", watermark).groupBy(F.window("ts", width).alias("w"), "symbol").agg(
        F.round(F.min_by("price", priced), 6).alias("open_price"),
        F.round(F.max("price"), 6).alias("high_price"),
        F.round(F.min("price"), 6).alias("low_price"),
        F.round(F.max_by("price", priced), 6).alias("close_price"),
        F.round(F.sum("quantity"), 8).alias("volume"),
    )
    return bars.select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), "symbol", F.to_date("w.start").alias("landing_date"), *BARS)


_BAR = T.StructType().add("window_start", "timestamp").add("window_end", "timestamp").add("symbol", "string").add("landing_date", "date")
for _c in BARS:
    _BAR.add(_c, "double")
_PREVIOUS = ["o1", "c1", "h1", "l1", "o2", "c2"]
_OUT = T.StructType([*_BAR.fields, *(T.StructField(c, T.DoubleType()) for c in (*OUTPUTS, *_PREVIOUS))])
_STATE = T.StructType([T.StructField(c, T.DoubleType()) for c in (*STATE, *_PREVIOUS)])


#: Bars that are turned into rows at once.
SLICE = 4096


class _Indicators(StatefulProcessor):
    """Per symbol: the recurrences' state and the last two bars.

    A batch's bars of a symbol are held as plain columns, some 60 bytes a bar, to put them in
    order; rows are made and handed on SLICE bars at a time.
    """

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.state = handle.getValueState("state", _STATE)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        parts = [(b["window_start"].to_numpy(), b["window_end"].to_numpy(), b[BARS].to_numpy(float)) for b in rows]
        start, end, values = (np.concatenate(p) for p in zip(*parts, strict=True))
        order = np.argsort(start, kind="stable")
        names = [*STATE, *_PREVIOUS]
        s = dict(zip(names, self.state.get(), strict=True)) if self.state.exists() else empty_state() | dict.fromkeys(_PREVIOUS)
        for lo in range(0, len(order), SLICE):
            at = order[lo : lo + SLICE]
            yield self._moved(s, key[0], start[at], end[at], values[at])
        self.state.update(tuple(s[k] for k in names))

    def _moved(self, s: dict, symbol: str, start: np.ndarray, end: np.ndarray, values: np.ndarray) -> pd.DataFrame:
        """The bars with all that is computed of them; moves ``s`` behind them."""
        out = pd.DataFrame({"window_start": start, "window_end": end, "symbol": symbol, "landing_date": pd.Series(start).dt.date})
        bars = dict(zip(BARS, values.T, strict=True))
        close = bars["close_price"]
        known = ~np.isnan(close)
        got = {c: np.full(len(close), np.nan) for c in OUTPUTS}
        for c, x in advance(s, close[known]).items():
            got[c][known] = x
        number = lambda x: np.nan if x is None else x
        for name, c in (("o", "open_price"), ("c", "close_price"), ("h", "high_price"), ("l", "low_price")):
            past = np.concatenate([[number(s.get(f"{name}2")), number(s[f"{name}1"])], bars[c]])
            got[f"{name}1"] = past[1:-1]
            s[f"{name}1"] = None if np.isnan(past[-1]) else float(past[-1])
            if name in "oc":
                got[f"{name}2"] = past[:-2]
                s[f"{name}2"] = None if np.isnan(past[-2]) else float(past[-2])
        return out.assign(**bars, **{c: got[c] for c in (*OUTPUTS, *_PREVIOUS)})

    def close(self) -> None:
        pass


def indicator_stream(bars: DataFrame) -> DataFrame:
    """Each closed bar once, with indicators, trend and pattern; state per symbol in the state store.

    A batch holds the bars that close in it. The source's own limit (maxFilesPerTrigger,
    maxOffsetsPerTrigger) bounds it, for a backlog that is read with availableNow too.
    """
    from barline.functions.columns import candle_shape, trend
    from barline.operators.patterns import pattern_one, pattern_three, pattern_two

    found = bars.groupBy("symbol").transformWithStateInPandas(_Indicators(), outputStructType=_OUT, outputMode="Append", timeMode="None")
    df = candle_shape(found).withColumn("trend", trend(F.col("ema7"), F.col("ema20")))
    df = df.withColumn("pattern", F.coalesce(pattern_three(), pattern_two(), pattern_one()))
    return df.select(*_BAR.names, *OUTPUTS, "trend", "pattern")


def crypto_stream(messages: DataFrame, checkpoint: str, bars: list[Sink], indicators: list[Sink], patterns: list[Sink], width: str = WIDTH, **trigger) -> StreamingQuery:
    """The whole job: messages to bars and indicators, fed to three kinds of sinks by one stateful query.

    Indicator rows hold all columns of the bars, so the bars' sinks get these; the
    patterns' sinks get the rows that have one.
    """
    rows = indicator_stream(klines_stream(json_trades(messages), width))
    of_bars = [lambda df, n, s=s: s(df.select(*_BAR.names), n) for s in bars]
    return multi_sink(rows, checkpoint, [*of_bars, *indicators, *(split_by_predicate(F.col("pattern").isNotNull(), s) for s in patterns)], **trigger)


def avg_by_symbol(rows: DataFrame) -> DataFrame:
    """Average price of each symbol; over a stream, of all rows so far (update or complete mode)."""
    return rows.groupBy("symbol").agg(F.round(F.avg("price"), 6).alias("avg_price"))


def keyed_json(rows: DataFrame, key: str = "symbol") -> DataFrame:
    """Key and JSON value, for any keyed sink."""
    return rows.select(F.col(key).alias("key"), F.to_json(F.struct(*rows.columns)).alias("value"))


def shard_json(rows: DataFrame, batch: int, path: str, most: int = 100, key: str = "symbol") -> None:
    """One batch of a stream as keyed JSON messages in files of ``most`` messages at most, the requests of a sharded sink.

    A batch that is run again replaces itself.
    """
    keyed_json(rows, key).write.mode("overwrite").option("maxRecordsPerFile", most).json(f"{path}/batch={batch}")


def serving_write(rows: DataFrame, batch: int, path: str, most: int = 5000, tries: int = 3) -> None:
    """One batch of a stream as files of ``most`` rows at most, seen by ``serving_read`` as a whole or not at all.

    Each try writes to a folder of its own and then adds a record of it, in one file; a try
    without a record is not read. A batch that is run again adds a second try with the same
    rows, of which the reader takes one. A write that fails is tried again, ``tries`` times in all.
    """
    made = rows.withColumn("created_at", F.current_date()).sortWithinPartitions("symbol", "window_start")
    for n in range(tries):
        attempt = uuid.uuid4().hex
        try:
            made.write.mode("error").option("maxRecordsPerFile", most).partitionBy("symbol", "landing_date").parquet(f"{path}/rows/batch={batch}/attempt={attempt}")
            commit = rows.sparkSession.range(1).select(F.lit(batch).cast("long").alias("batch"), F.lit(attempt).alias("attempt"))
            commit.coalesce(1).write.mode("append").json(f"{path}/commits")
            return
        except Exception:
            if n + 1 == tries:
                raise


def serving_read(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """The rows of committed batches, each batch once; folders of other tries are pruned."""
    commits = spark.read.schema("batch long, attempt string").json(f"{path}/commits").groupBy("batch").agg(F.min("attempt").alias("attempt"))
    fields = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    whole = T.StructType([*fields.fields, T.StructField("batch", T.LongType()), T.StructField("attempt", T.StringType())])
    rows = spark.read.schema(whole).option("basePath", f"{path}/rows").parquet(f"{path}/rows")
    return rows.join(commits, ["batch", "attempt"], "left_semi").select(*fields.names)


def split_by_predicate(predicate: Column, sink: Sink, otherwise: Sink | None = None) -> Sink:
    """A sink that hands rows for which ``predicate`` holds to ``sink``, and the others to ``otherwise``, if given."""

    def write(rows: DataFrame, batch: int) -> None:
        sink(rows.where(predicate), batch)
        if otherwise:
            otherwise(rows.where(~F.coalesce(predicate, F.lit(False))), batch)

    return write


def indicators_stream_reader(messages: DataFrame) -> DataFrame:
    """The emitted indicators, read back from their messages (value), streamed or not; malformed ones are skipped."""
    fields = T.StructType([*_BAR.fields, *(T.StructField(c, T.DoubleType()) for c in OUTPUTS), T.StructField("trend", T.StringType()), T.StructField("pattern", T.StringType())])
    return decoded(messages, fields).where("symbol is not null and window_start is not null")


def multi_sink(rows: DataFrame, checkpoint: str, sinks: list[Sink], **trigger) -> StreamingQuery:
    """One stateful query feeding several sinks; each batch is computed once.

    A sink gets a batch and its number; after a failure the batch comes again, to all sinks, so
    a sink has to replace or tell apart what it wrote of it before, as those here do.
    """

    def write(batch: DataFrame, n: int) -> None:
        batch = batch.persist()
        try:
            for sink in sinks:
                sink(batch, n)
        finally:
            batch.unpersist()

    writer = rows.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(**(trigger or {"processingTime": "2 seconds"}))
    with state_backend(rows.sparkSession):
        return writer.start()


def stream_to_table(rows: DataFrame, path: str, checkpoint: str, keys: list[str], **trigger) -> StreamingQuery:
    """Appends a stream to a partitioned Parquet folder, exactly once."""
    writer = rows.writeStream.partitionBy(*keys) if keys else rows.writeStream
    writer = writer.format("parquet").option("path", path).option("checkpointLocation", checkpoint).trigger(**(trigger or {"processingTime": "1 minute"}))
    with state_backend(rows.sparkSession):
        return writer.start()
