"""The registered queries of the market-data operators, and the SQL that checks them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barline.functions.columns import bar_keys, candle_shape, lineage_columns, round_half_up, sink_cast
from barline.operators import bars as B
from barline.operators import patterns as P
from barline.operators import serving as S
from barline.operators.recurrence import OUTPUTS, ema, indicators
from barline.plans import jobs, storage
from barline.sources import trades as T
from barline.streaming import streams

HOUR = 3600


def _in_utc(query: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    """Plans are made, and streams run, in UTC; the session's zone comes back."""

    def run(spark: SparkSession, sf: str) -> DataFrame:
        zone = spark.conf.get("spark.sql.session.timeZone")
        spark.conf.set("spark.sql.session.timeZone", "UTC")
        try:
            return query(spark, sf)
        finally:
            spark.conf.set("spark.sql.session.timeZone", zone)

    return run


def _trades(spark: SparkSession, sf: str) -> DataFrame:
    return T.trades_view(spark.read.parquet(f"{sf}/events.parquet"))


def _bars(spark: SparkSession, sf: str, width: int = HOUR) -> DataFrame:
    return B.klines_batch(_trades(spark, sf), width)


def _full(spark: SparkSession, sf: str) -> DataFrame:
    return indicators(_bars(spark, sf)).select("symbol", "group_id", "landing_date", "open_price", "high_price", "low_price", "close_price", *OUTPUTS)


def _marked(spark: SparkSession, sf: str) -> DataFrame:
    return P.patterns(_full(spark, sf))


def _daily(name: str):
    def query(spark: SparkSession, sf: str) -> DataFrame:
        return jobs.backfill(_trades(spark, sf), "1970-01-01", "9999-12-31")[name]

    return query


def _messages(spark: SparkSession, sf: str, stream: bool) -> DataFrame:
    path = f"{sf}/events.parque[t]"
    events = spark.read.parquet(f"{sf}/events.parquet")
    if stream:
        events = spark.readStream.schema(events.schema).parquet(path)
    return T.trades_to_messages(T.trades_view(events))


def _streamed(spark: SparkSession, rows: DataFrame) -> DataFrame:
    path = storage.scratch(spark)
    streams.stream_to_table(rows, f"{path}/out", f"{path}/checkpoint", [], availableNow=True).awaitTermination()
    return spark.read.schema(rows.schema).parquet(f"{path}/out")


def klines_stream(spark: SparkSession, sf: str) -> DataFrame:
    return _start_us(_streamed(spark, streams.klines_stream(T.json_trades(_messages(spark, sf, True)))))


def indicator_stream(spark: SparkSession, sf: str) -> DataFrame:
    return _start_us(_streamed(spark, streams.indicator_stream(streams.klines_stream(T.json_trades(_messages(spark, sf, True)), "60 minutes"))))


def _start_us(rows: DataFrame) -> DataFrame:
    """Window bounds as microseconds."""
    return rows.withColumns({c: F.unix_micros(c) for c in ("window_start", "window_end")})


def _priced(spark: SparkSession, sf: str) -> DataFrame:
    """A stream of price messages, times in ISO 8601."""
    events = spark.readStream.schema(spark.read.parquet(f"{sf}/events.parquet").schema).parquet(f"{sf}/events.parque[t]")
    rows = events.select(F.col("event_type").alias("symbol"), "value", F.col("ts").cast("timestamp").alias("ts"))
    return T.iso_messages(rows, {"ticker": "symbol", "price": "value", "event_time": "ts"})


def prices_stream(spark: SparkSession, sf: str) -> DataFrame:
    """Events as price messages, decoded by a stream."""
    return _streamed(spark, T.prices(_priced(spark, sf))).select("ticker", "price", F.unix_micros("event_time").alias("event_time"))


def prices_from(spark: SparkSession, sf: str) -> DataFrame:
    """Price messages from a time on."""
    rows = _streamed(spark, T.prices(_priced(spark, sf), "2024-01-10 12:00:00"))
    return rows.select("ticker", "price", F.unix_micros("event_time").alias("event_time"))


def _shard(position: str, start: str | None = None):
    def query(spark: SparkSession, sf: str) -> DataFrame:
        """Trades as messages of a sharded stream, decoded by a stream."""
        events = spark.readStream.schema(spark.read.parquet(f"{sf}/events.parquet").schema).parquet(f"{sf}/events.parque[t]")
        trades = T.trades_view(events).withColumn("ts", F.timestamp_micros("timestamp"))
        names = [f.split()[0] for f in T.SHARD_SCHEMA.split(", ")]
        sent = T.iso_messages(trades, {n: "ts" if n == "event_time" else n for n in names})
        rows = _streamed(spark, T.shard_trades(sent, position, start))
        return rows.select("agg_trade_id", "symbol", "price", "is_buyer_maker", F.unix_micros("ts").alias("ts_us"))

    return query


def late_drop(spark: SparkSession, sf: str) -> DataFrame:
    """Bars of a stream that is stopped and started again, and gets all trades a second time, with other prices, when their windows are closed."""
    path, sent = storage.scratch(spark), _messages(spark, sf, False)
    late = F.regexp_replace("value", r'"price":[0-9.]+', '"price":1000000')
    for messages in (sent, sent.select("key", late.alias("value"))):
        messages.write.mode("append").parquet(f"{path}/in")
        stream = spark.readStream.schema(sent.schema).parquet(f"{path}/in")
        streams.stream_to_table(streams.klines_stream(T.json_trades(stream)), f"{path}/out", f"{path}/checkpoint", [], availableNow=True).awaitTermination()
    return _start_us(spark.read.parquet(f"{path}/out"))


def catalog(spark: SparkSession, sf: str) -> DataFrame:
    """Bars kept as a table of a database of their own, counted, with what the catalog says of both."""
    name = f"shelf_{storage.scratch(spark).rsplit('-', 1)[1]}"
    before = storage.database_exists(spark, name) or storage.table_exists(spark, f"{name}.bars")
    storage.create_database(spark, name)
    storage.upsert_partitions(_bars(spark, sf), f"{name}.bars")
    found, listed = storage.database_exists(spark, name) and storage.table_exists(spark, f"{name}.bars"), storage.list_tables(spark, name) == ["bars"]
    rows = spark.table(f"{name}.bars").groupBy("symbol").agg(F.count("*").alias("n_bars"), F.countDistinct("landing_date").alias("n_days"))
    rows = storage.stored(rows, f"{storage.scratch(spark)}/counts")
    spark.sql(f"DROP DATABASE `{name}` CASCADE")
    return rows.withColumns({"before": F.lit(before), "found": F.lit(found), "listed": F.lit(listed)})


def multi_sink(spark: SparkSession, sf: str) -> DataFrame:
    """One stateful stream feeding bars, indicators and patterns to sinks of their own, read back and joined.

    Bars go to the serving sink, indicators to messages that are decoded again, patterns to a sharded sink.
    """
    path = storage.scratch(spark)
    bars = lambda rows, n: streams.serving_write(rows, n, f"{path}/bars")
    indicators = lambda rows, n: streams.keyed_json(rows).write.mode("overwrite").parquet(f"{path}/indicators/batch={n}")
    patterns = lambda rows, n: streams.shard_json(rows, n, f"{path}/patterns")
    streams.crypto_stream(_messages(spark, sf, True), f"{path}/checkpoint", [bars], [indicators], [patterns], "60 minutes", availableNow=True).awaitTermination()
    fields = "symbol string, landing_date date, window_start timestamp, close_price double, volume double, created_at date"
    served = streams.serving_read(spark, f"{path}/bars", fields).where("created_at is not null").drop("created_at")
    told = streams.indicators_stream_reader(spark.read.schema("key string, value string").parquet(f"{path}/indicators/batch=*"))
    marked = streams.indicators_stream_reader(spark.read.schema("key string, value string").json(f"{path}/patterns/batch=*")).select("symbol", "window_start", F.col("pattern").alias("sent_pattern"))
    rows = served.drop("landing_date").join(told.select("symbol", "window_start", "ema7", "rsi6", "pattern"), ["symbol", "window_start"]).join(marked, ["symbol", "window_start"], "left")
    return rows.withColumn("window_start", F.unix_micros("window_start"))


def avg_stream(spark: SparkSession, sf: str) -> DataFrame:
    """The average of each symbol as a stream has it at its end; each batch in update mode."""
    path = storage.scratch(spark)
    rows = streams.avg_by_symbol(T.json_trades(_messages(spark, sf, True)))
    write = lambda df, n: df.write.mode("overwrite").parquet(f"{path}/out/batch={n}")
    rows.writeStream.outputMode("update").foreachBatch(write).option("checkpointLocation", f"{path}/checkpoint").trigger(availableNow=True).start().awaitTermination()
    out = spark.read.schema("symbol string, avg_price double, batch long").option("basePath", f"{path}/out").parquet(f"{path}/out")
    return out.groupBy("symbol").agg(F.max_by("avg_price", "batch").alias("avg_price"))


def stream_to_table(spark: SparkSession, sf: str) -> DataFrame:
    """Price messages as a stream, appended to a folder partitioned by ticker, and read back."""
    events = spark.readStream.schema(spark.read.parquet(f"{sf}/events.parquet").schema).parquet(f"{sf}/events.parque[t]")
    rows = events.select(F.col("event_type").alias("ticker"), F.col("event_id").alias("reading_id"), F.col("value").cast("decimal(6,2)").alias("reading"))
    path = storage.scratch(spark)
    streams.stream_to_table(rows, f"{path}/out", f"{path}/checkpoint", ["ticker"], availableNow=True).awaitTermination()
    return spark.read.schema(rows.schema).option("basePath", f"{path}/out").parquet(f"{path}/out").select("ticker", "reading_id", F.col("reading").cast("double").alias("reading"))


def run_day(spark: SparkSession, sf: str) -> DataFrame:
    """A day's MACD from the tables of the days before, which are written and partitioned."""
    trades, stored, path = _trades(spark, sf), {}, storage.scratch(spark)
    tables = jobs.backfill(trades, "1970-01-01", "2024-01-04")
    for name in ("macd", "rsi6", "pattern_one"):
        tables[name].hint("rebalance", "symbol", "landing_date").write.partitionBy("symbol", "landing_date").parquet(f"{path}/{name}")
        stored[name] = spark.read.schema(tables[name].schema).parquet(f"{path}/{name}")
    tables.free()
    return jobs.run_day(trades, stored, "2024-01-05")["macd"].select("symbol", "group_id", "close_price", "macd", "signal", "histogram")


def lineage(spark: SparkSession, sf: str) -> DataFrame:
    """Trades stamped with a day and a symbol; that the stamps of now are there shows in ``stamped``."""
    rows = lineage_columns(_trades(spark, sf), "all", "2024-02-03")
    return rows.select("agg_trade_id", "symbol", "landing_date", (F.col("transform_date").isNotNull() & (F.to_date("transform_timestamp") == F.col("transform_date"))).alias("stamped"))


def partition_scan(spark: SparkSession, sf: str) -> DataFrame:
    """One partition of trades written by symbol and day."""
    path, rows = storage.scratch(spark), _trades(spark, sf)
    rows.hint("rebalance", "symbol", "landing_date").write.partitionBy("symbol", "landing_date").parquet(path)
    return storage.partition_scan(spark.read.schema(rows.schema).parquet(path), "view", "2024-01-03").select("agg_trade_id", "price", "timestamp")


def csv_trades_scan(spark: SparkSession, sf: str) -> DataFrame:
    """Trades written as files of the feed and scanned again."""
    path = storage.scratch(spark)
    _trades(spark, sf).drop("symbol", "landing_date").write.csv(path)
    return T.csv_trades_scan(spark, path)


def landing_scan(spark: SparkSession, sf: str) -> DataFrame:
    """Trades landed and read back."""
    path = storage.scratch(spark)
    T.landing_write(_trades(spark, sf), path)
    return T.landing_scan(spark, path).select("agg_trade_id", "symbol", "price", "timestamp")


def keyed_json(spark: SparkSession, sf: str) -> DataFrame:
    """Bars as keyed messages; their fields are read again."""
    rows = streams.keyed_json(_bars(spark, sf).select("symbol", "group_id", "close_price"))
    return rows.select("key", *(F.get_json_object("value", f"$.{c}").cast(t).alias(c) for c, t in (("group_id", "long"), ("close_price", "double"))))


def prev_day_state(spark: SparkSession, sf: str) -> DataFrame:
    full = _full(spark, sf)
    return B.prev_day_state(full, full, ["rsi_ag", "rsi_al", "close_price"])


def table_round_trip(spark: SparkSession, sf: str) -> DataFrame:
    """Bars written as a partitioned table, one partition written again with other values, and all of the table read back."""
    table = f"bars_{storage.scratch(spark).rsplit('-', 1)[1]}"
    rows = _bars(spark, sf)
    storage.upsert_partitions(rows, table)
    changed = rows.where("symbol = 'click' and landing_date = date'2024-01-02'").withColumn("volume", F.col("volume") + 1000)
    storage.upsert_partitions(changed, table)
    rows = storage.stored(spark.table(table).select("symbol", "landing_date", "group_id", "close_price", "volume"), f"{storage.scratch(spark)}/bars")
    spark.sql(f"DROP TABLE {table}")
    return rows


def session(spark: SparkSession, sf: str) -> DataFrame:
    """Averages in a session of the factory, with the settings that it made; they are put back."""
    names = ["spark.sql.session.timeZone", "spark.sql.adaptive.enabled", "spark.sql.sources.partitionOverwriteMode", streams.PROVIDER]
    before = {n: spark.conf.get(n, None) for n in names}
    try:
        made = storage.session()
        told = {n.rsplit(".", 1)[1]: F.lit(made.conf.get(n).rsplit(".", 1)[-1]) for n in names}
        return streams.avg_by_symbol(_trades(made, sf)).withColumns(told)
    finally:
        for n, v in before.items():
            spark.conf.unset(n) if v is None else spark.conf.set(n, v)


def run_day_history(spark: SparkSession, sf: str) -> DataFrame:
    """The same day out of a run over the whole history."""
    macd = jobs.backfill(_trades(spark, sf), "1970-01-01", "2024-01-05")["macd"]
    return macd.where("landing_date = date'2024-01-05'").select("symbol", "group_id", "close_price", "macd", "signal", "histogram")


def chart_series(spark: SparkSession, sf: str) -> DataFrame:
    rows = _marked(spark, sf).withColumn("time", F.timestamp_seconds(F.col("group_id") * HOUR))
    return S.chart_series(rows, "click", "2024-01-03", "2024-01-20").select("group_id", "rsi6", "macd", "marked")


def trades_to_messages(spark: SparkSession, sf: str) -> DataFrame:
    field = lambda name, kind: F.get_json_object("value", f"$.{name}").cast(kind).alias(name)
    return _messages(spark, sf, False).select("key", field("agg_trade_id", "long"), field("price", "double"))


QUERIES = {
    "klines_batch": lambda s, d: _bars(s, d, 900),
    "klines_by_id": lambda s, d: B.klines_batch(_trades(s, d), 900, order_by=("agg_trade_id",)),
    "klines_orders": lambda s, d: B.klines_batch(T.orders_view(s.read.parquet(f"{d}/orders.parquet")), 86400),
    "bar_keys": lambda s, d: bar_keys(_trades(s, d)).select("agg_trade_id", "timestamp_second", "timestamp_date", "group_id", "group_date"),
    "round_half_up": lambda s, d: _trades(s, d).select("agg_trade_id", round_half_up(F.col("price") - 50, 1).alias("rounded")),
    "candle_shape": lambda s, d: candle_shape(_bars(s, d)).select("symbol", "group_id", *(F.round(c, 6).alias(c) for c in ("body", "lower_shadow", "upper_shadow"))),
    "ema_pair": lambda s, d: _full(s, d).select("symbol", "group_id", "ema7", "ema20"),
    "macd": lambda s, d: _full(s, d).select("symbol", "group_id", "ema12", "ema26", "macd", "signal", "histogram"),
    "rsi": lambda s, d: _full(s, d).select("symbol", "group_id", "rsi6", "rsi_ag", "rsi_al"),
    "macd_daily": _daily("macd"),
    "rsi_daily": _daily("rsi6"),
    "pattern_one_daily": _daily("pattern_one"),
    "pattern_two_daily": _daily("pattern_two"),
    "pattern_three_daily": _daily("pattern_three"),
    "run_day": run_day,
    "run_day_history": run_day_history,
    "lag_prev": lambda s, d: P.lags(storage.stored(_bars(s, d), storage.scratch(s)), span=100).select("symbol", "group_id", "o1", "c1", "h1", "l1", "o2", "c2"),
    "pattern_one": lambda s, d: _marked(s, d).where("pattern_one is not null").select("symbol", "group_id", F.col("pattern_one").alias("pattern")),
    "pattern_two": lambda s, d: _marked(s, d).where("pattern_two is not null").select("symbol", "group_id", F.col("pattern_two").alias("pattern")),
    "pattern_three": lambda s, d: _marked(s, d).where("pattern_three is not null").select("symbol", "group_id", F.col("pattern_three").alias("pattern")),
    "trend": lambda s, d: _marked(s, d).select("symbol", "group_id", "trend"),
    "pattern_priority": lambda s, d: _marked(s, d).select("symbol", "group_id", "pattern_one", "pattern_two", "pattern_three", "pattern"),
    "pattern_only": lambda s, d: S.pattern_only(_marked(s, d)).select("symbol", "group_id", "pattern"),
    "indicator_set": lambda s, d: _marked(s, d).select("symbol", "group_id", *OUTPUTS, "trend", "pattern"),
    "pattern_history": lambda s, d: S.pattern_history(_marked(s, d)).select("symbol", "group_id", "trend", "pattern"),
    "latest_patterns": lambda s, d: S.latest_patterns(_marked(s, d)).select("symbol", "group_id", "trend", "pattern"),
    "latest_klines": lambda s, d: S.latest_klines(_bars(s, d)).select("symbol", "group_id", "close_price", "volume"),
    "chart_series": chart_series,
    "distinct_symbols": lambda s, d: S.distinct_symbols(_trades(s, d)),
    "trade_preview": lambda s, d: S.trade_preview(_trades(s, d)),
    "prev_day_state": prev_day_state,
    "sink_cast": lambda s, d: sink_cast(_full(s, d)).select("symbol", "group_id", *(F.col(c).cast("double").alias(c) for c in ("close_price", "rsi6", "macd", "ema26"))),
    "indicators_by_blocks": lambda s, d: indicators(_bars(s, d), span=128, halo=64).select("symbol", "group_id", *(F.round(c, 6).alias(c) for c in OUTPUTS)),
    "ema": lambda s, d: ema(_bars(s, d), 12).select("symbol", "group_id", "ema12"),
    "lineage_columns": lineage,
    "avg_by_symbol_stream": avg_stream,
    "stream_to_table": stream_to_table,
    "trades_to_messages": trades_to_messages,
    "json_trades": lambda s, d: T.json_trades(_messages(s, d, False)).select("agg_trade_id", "symbol", "price", "quantity", "ts_int", "is_buyer_maker"),
    "event_time": lambda s, d: T.json_trades(_messages(s, d, False)).select("agg_trade_id", F.unix_micros("ts").alias("ts_us")),
    "csv_trades_scan": csv_trades_scan,
    "landing_scan": landing_scan,
    "partition_scan": partition_scan,
    "keyed_json_sink": keyed_json,
    "prices_stream": prices_stream,
    "multi_sink": multi_sink,
    "avg_by_symbol": lambda s, d: streams.avg_by_symbol(_trades(s, d)),
    "upsert_partitions": table_round_trip,
    "prices_from": prices_from,
    "shard_stream_source": _shard("earliest"),
    "shard_stream_at_timestamp": _shard("at_timestamp", "2024-01-12 00:00:00"),
    "late_drop": late_drop,
    "session": session,
    "catalog": catalog,
    "klines_stream": klines_stream,
    "indicator_stream": indicator_stream,
}

QUERIES = {name: _in_utc(query) for name, query in QUERIES.items()}

_T = """t AS (SELECT event_id AS id, value AS price, json_extract_string(props, '$.k')::DOUBLE AS quantity, epoch_us(ts) AS us, event_type AS symbol, ts::DATE AS landing_date FROM events)"""


def _b(width: int, source: str = "t") -> str:
    """Bars as a CTE named b."""
    return f"""b AS (SELECT us // {width * 1000000} AS group_id, strftime(make_timestamp(us // {width * 1000000} * {width * 1000000}), '%Y-%m-%d %H:%M:%S') AS group_date, landing_date, symbol,
  min(us) AS open_time, round(arg_min(price, (us, id)), 4) AS open_price, round(max(price), 4) AS high_price, round(min(price), 4) AS low_price,
  round(arg_max(price, (us, id)), 4) AS close_price, round(sum(quantity), 1) AS volume, max(us) AS close_time FROM {source} GROUP BY ALL)"""


_AVG = {"ema7": 7, "ema20": 20, "ema12": 12, "ema26": 26}
_FIRST = ", ".join(f"NULL::DOUBLE AS {a}" for a in _AVG)
_NEXT = ", ".join(f"CASE WHEN r.n + 1 < {p} THEN NULL WHEN r.n + 1 = {p} THEN (r.total + c.close_price) / {p} ELSE (c.close_price - r.{a}) * (2.0::DOUBLE / {p + 1}) + r.{a} END AS {a}" for a, p in _AVG.items())
_I = f"""c AS (SELECT *, row_number() OVER (PARTITION BY symbol ORDER BY group_id) AS n FROM b),
e AS (SELECT symbol, n, close_price, 0.0::DOUBLE + close_price AS total, {_FIRST}, 0.0::DOUBLE AS gains, 0.0::DOUBLE AS losses, NULL::DOUBLE AS ag,
  NULL::DOUBLE AS al FROM c WHERE n = 1
  UNION ALL SELECT c.symbol, c.n, c.close_price, r.total + c.close_price, {_NEXT},
    r.gains + greatest(c.close_price - r.close_price, 0), r.losses + greatest(r.close_price - c.close_price, 0),
    CASE WHEN c.n < 7 THEN NULL WHEN c.n = 7 THEN (r.gains + greatest(c.close_price - r.close_price, 0)) / 6 ELSE (r.ag * 5 + greatest(c.close_price - r.close_price, 0)) / 6 END,
    CASE WHEN c.n < 7 THEN NULL WHEN c.n = 7 THEN (r.losses + greatest(r.close_price - c.close_price, 0)) / 6 ELSE (r.al * 5 + greatest(r.close_price - c.close_price, 0)) / 6 END
  FROM e r JOIN c ON c.symbol = r.symbol AND c.n = r.n + 1),
g AS (SELECT symbol, n, ema12 - ema26 AS macd, 0.0::DOUBLE + (ema12 - ema26) AS total, NULL::DOUBLE AS signal FROM e WHERE n = 26
  UNION ALL SELECT e.symbol, e.n, e.ema12 - e.ema26, r.total + (e.ema12 - e.ema26),
    CASE WHEN e.n < 34 THEN NULL WHEN e.n = 34 THEN (r.total + (e.ema12 - e.ema26)) / 9 ELSE ((e.ema12 - e.ema26) - r.signal) * (2.0::DOUBLE / 10) + r.signal END
  FROM g r JOIN e ON e.symbol = r.symbol AND e.n = r.n + 1),
f AS (SELECT c.*, e.ema7, e.ema20, e.ema12, e.ema26, g.macd, g.signal, g.macd - g.signal AS histogram,
    CASE WHEN e.al = 0 THEN 100 WHEN e.ag = 0 THEN 0 ELSE 100 - 100 / (1 + e.ag / e.al) END AS rsi6, e.ag AS rsi_ag, e.al AS rsi_al
  FROM c JOIN e USING (symbol, n) LEFT JOIN g USING (symbol, n))"""
_L = """l AS (SELECT *, lag(open_price) OVER w AS o1, lag(close_price) OVER w AS c1, lag(high_price) OVER w AS h1, lag(low_price) OVER w AS l1, lag(open_price, 2) OVER w AS o2, lag(close_price, 2) OVER w AS c2 FROM {0} WINDOW w AS (PARTITION BY symbol ORDER BY group_id))"""
_UP = "ema7 > ema20"
_DOWN = "ema7 < ema20"
_M = (
    _L.format("f")
    + f""",
m AS (SELECT *, CASE WHEN {_UP} THEN 'uptrend' WHEN {_DOWN} THEN 'downtrend' END AS trend,
  CASE WHEN abs(close_price - open_price) > 0 AND least(open_price, close_price) - low_price >= 2 * abs(close_price - open_price)
    AND high_price - greatest(open_price, close_price) <= 0.25::DOUBLE * abs(close_price - open_price)
    THEN CASE WHEN {_UP} THEN 'hanging man' WHEN {_DOWN} THEN 'hammer' END END AS pattern_one,
  CASE WHEN c1 < o1 AND close_price > open_price AND open_price < c1 AND close_price > o1 AND {_DOWN} THEN 'bullish engulfing'
    WHEN c1 > o1 AND close_price < open_price AND open_price > c1 AND close_price < o1 AND {_UP} THEN 'bearish engulfing' END AS pattern_two,
  c2 < o2 AND o1 < c2 AND c1 < c2 AND close_price > open_price AND close_price >= (o2 + c2) / 2 AND {_DOWN} AS low3,
  c2 > o2 AND o1 > c2 AND c1 > c2 AND close_price < open_price AND close_price <= (o2 + c2) / 2 AND {_UP} AS high3,
  abs(o1 - c1) <= 0.5::DOUBLE * abs(o2 - c2) AS star, abs(o1 - c1) <= 0.1::DOUBLE * (h1 - l1) AS doji FROM l),
p AS (SELECT *, CASE WHEN low3 AND star THEN 'morning star' WHEN high3 AND star THEN 'evening star' WHEN low3 AND doji THEN 'morning doji star'
  WHEN high3 AND doji THEN 'evening doji star' END AS pattern_three FROM m),
q AS (SELECT *, coalesce(pattern_three, pattern_two, pattern_one) AS pattern FROM p)"""
)


def _closed(width: int) -> str:
    """Bars as a stream makes them, of windows that the watermark has passed: times in milliseconds, prices to six places."""
    ms = "ms AS (SELECT id, price, quantity, us, us // 1000 * 1000 AS tm, symbol FROM t WHERE price IS NOT NULL AND quantity IS NOT NULL)"
    return f"""{ms}, b AS (SELECT * FROM (SELECT tm // {width * 1000000} AS group_id, make_timestamp(tm // {width * 1000000} * {width * 1000000})::DATE AS landing_date, symbol,
  round(arg_min(price, (us, id)), 6) AS open_price, round(max(price), 6) AS high_price, round(min(price), 6) AS low_price, round(arg_max(price, (us, id)), 6) AS close_price,
  round(sum(quantity), 8) AS volume FROM ms GROUP BY ALL) WHERE (group_id + 1) * {width * 1000000} <= (SELECT max(tm) - 5000000 FROM ms))"""


def _window(width: int) -> str:
    return f"group_id * {width * 1000000} AS window_start, (group_id + 1) * {width * 1000000} AS window_end, symbol, landing_date, open_price, high_price, low_price, close_price, volume"


def _half_up(x: str, places: int) -> str:
    return f"trunc({x} * {10**places} + 0.5::DOUBLE)::BIGINT / {10**places}"


def _moved(a: str, period: int, x: str) -> str:
    """Value, sum and count of an average after the number ``x``; without a number they stay."""
    v, s, k = f"{a}_v0", f"{a}_s0", f"{a}_k0"
    return f"""CASE WHEN {x} IS NULL THEN {v} WHEN {v} IS NOT NULL THEN ({x} - {v}) * (2.0::DOUBLE / {period + 1}) + {v} WHEN {k} + 1 = {period} THEN ({s} + {x}) / {period} END AS {a}_v,
  CASE WHEN {x} IS NULL OR {v} IS NOT NULL THEN {s} WHEN {k} + 1 = {period} THEN 0 ELSE {s} + {x} END AS {a}_s,
  CASE WHEN {x} IS NULL OR {v} IS NOT NULL THEN {k} WHEN {k} + 1 = {period} THEN 0 ELSE {k} + 1 END AS {a}_k"""


_KEPT = [*_AVG, "signal"]
_ROUND = {"ema7": 4, "ema20": 4, "ema12": 2, "ema26": 2, "signal": 2}
_COLS = ", ".join([*(f"{a}_{x}" for a in _KEPT for x in "vsk"), "ag", "al", "gains", "losses", "diffs"])
_CARRIED = ", ".join(
    [f"CASE WHEN c.landing_date = r.day THEN r.{a}_v WHEN c.landing_date = r.day + 1 THEN {_half_up(f'r.{a}_v', p)} END AS {a}_v0" for a, p in _ROUND.items()]
    + [f"CASE WHEN c.landing_date = r.day THEN r.{a}_{x} ELSE 0 END AS {a}_{x}0" for a in _ROUND for x in "sk"]
    + [f"CASE WHEN c.landing_date = r.day THEN r.{x} WHEN c.landing_date = r.day + 1 THEN {_half_up(f'r.{x}', 6)} END AS {x}0" for x in ("ag", "al")]
    + [f"CASE WHEN c.landing_date = r.day THEN r.{x} ELSE 0 END AS {x}0" for x in ("gains", "losses", "diffs")]
    + ["CASE WHEN c.landing_date IN (r.day, r.day + 1) THEN r.x END AS x0"]
)
_RSI = ", ".join(
    [f"CASE WHEN x0 IS NULL THEN {a}0 WHEN ag0 IS NOT NULL THEN ({a}0 * 5 + {g}) / 6 WHEN diffs0 + 1 = 6 THEN ({t}0 + {g}) / 6 END AS {a}" for a, t, g in (("ag", "gains", "greatest(x - x0, 0)"), ("al", "losses", "greatest(x0 - x, 0)"))]
    + [f"CASE WHEN x0 IS NULL OR ag0 IS NOT NULL THEN {t}0 WHEN diffs0 + 1 = 6 THEN 0 ELSE {t}0 + {g} END AS {t}" for t, g in (("gains", "greatest(x - x0, 0)"), ("losses", "greatest(x0 - x, 0)"), ("diffs", "1"))]
)
#: Indicators that start each day from the rounded outputs of the day before, as a CTE named f.
_DAY = f"""c AS (SELECT *, row_number() OVER (PARTITION BY symbol ORDER BY group_id) AS n FROM b),
d AS (SELECT DISTINCT symbol, 0::BIGINT AS n, NULL::DATE AS day, NULL::DOUBLE AS x, {", ".join(f"NULL::DOUBLE AS {a}_v, 0::DOUBLE AS {a}_s, 0::BIGINT AS {a}_k" for a in _KEPT)}, NULL::DOUBLE AS ag, NULL::DOUBLE AS al, 0::DOUBLE AS gains, 0::DOUBLE AS losses, 0::BIGINT AS diffs FROM c
  UNION ALL SELECT symbol, n, day, x, {_COLS} FROM (SELECT *, {_moved("signal", 9, "(ema12_v - ema26_v)")} FROM (SELECT *,
    {", ".join(_moved(a, p, "x") for a, p in _AVG.items())}, {_RSI} FROM (
    SELECT c.symbol, c.n, c.landing_date AS day, c.close_price AS x, {_CARRIED} FROM d r JOIN c ON c.symbol = r.symbol AND c.n = r.n + 1)))),
f AS (SELECT c.*, {", ".join(f"{_half_up(f'{a}_v', p)} AS {a}" for a, p in _ROUND.items())}, {_half_up("(ema12_v - ema26_v)", 2)} AS macd, {_half_up("(ema12_v - ema26_v - signal_v)", 2)} AS histogram,
  {_half_up("(CASE WHEN al = 0 THEN 100 WHEN ag = 0 THEN 0 ELSE 100 - 100 / (1 + ag / al) END)", 2)} AS rsi6, {_half_up("ag", 6)} AS rsi_ag,
    {_half_up("al", 6)} AS rsi_al FROM c JOIN d USING (symbol, n))"""
_DAILY = f"WITH RECURSIVE {_T}, {_b(900)}, {_DAY}"
_DAILY_ALL = f"{_DAILY}, {_M.replace('PARTITION BY symbol', 'PARTITION BY symbol, landing_date')}"
_BAR = ", ".join(jobs.BAR_COLUMNS)
_BARS = f"WITH {_T}, {_b(HOUR)}"
_FULL = f"WITH RECURSIVE {_T}, {_b(HOUR)}, {_I}"
_ALL = f"{_FULL}, {_M}"
_ORDERS = "t AS (SELECT o_orderkey AS id, o_totalprice AS price, 1.0::DOUBLE AS quantity, epoch_us(o_orderdate) AS us, o_orderpriority AS symbol, o_orderdate::DATE AS landing_date FROM orders)"

SQL = {
    "klines_batch": f"WITH {_T}, {_b(900)} SELECT * FROM b",
    "klines_by_id": f"WITH {_T}, {_b(900).replace('(us, id)', 'id')} SELECT * FROM b",
    "klines_orders": f"WITH {_ORDERS}, {_b(86400)} SELECT * FROM b",
    "bar_keys": f"""WITH {_T} SELECT id AS agg_trade_id, us // 1000000 AS timestamp_second, strftime(make_timestamp(us), '%Y-%m-%d') AS timestamp_date,
      us // 900000000 AS group_id, strftime(make_timestamp(us // 900000000 * 900000000), '%Y-%m-%d %H:%M:%S') AS group_date FROM t""",
    "round_half_up": f"WITH {_T} SELECT id AS agg_trade_id, trunc((price - 50) * 10 + 0.5::DOUBLE) / 10 AS rounded FROM t",
    "candle_shape": f"""{_BARS} SELECT symbol, group_id, round(abs(close_price - open_price), 6) AS body, round(least(open_price, close_price) - low_price, 6) AS lower_shadow,
      round(high_price - greatest(open_price, close_price), 6) AS upper_shadow FROM b""",
    "ema_pair": f"{_FULL} SELECT symbol, group_id, ema7, ema20 FROM f",
    "macd": f"{_FULL} SELECT symbol, group_id, ema12, ema26, macd, signal, histogram FROM f",
    "rsi": f"{_FULL} SELECT symbol, group_id, rsi6, rsi_ag, rsi_al FROM f",
    "lag_prev": f"{_BARS}, {_L.format('b')} SELECT symbol, group_id, o1, c1, h1, l1, o2, c2 FROM l",
    "pattern_one": f"{_ALL} SELECT symbol, group_id, pattern_one AS pattern FROM q WHERE pattern_one IS NOT NULL",
    "pattern_two": f"{_ALL} SELECT symbol, group_id, pattern_two AS pattern FROM q WHERE pattern_two IS NOT NULL",
    "pattern_three": f"{_ALL} SELECT symbol, group_id, pattern_three AS pattern FROM q WHERE pattern_three IS NOT NULL",
    "indicator_set": f"{_ALL} SELECT symbol, group_id, {', '.join(OUTPUTS)}, trend, pattern FROM q",
    "pattern_history": f"{_ALL} SELECT symbol, group_id, trend, pattern FROM q WHERE pattern IS NOT NULL ORDER BY group_id, symbol",
    "latest_patterns": f"{_ALL} SELECT symbol, group_id, trend, pattern FROM q WHERE pattern IS NOT NULL ORDER BY group_id DESC, symbol LIMIT 20",
    "latest_klines": f"{_BARS} SELECT symbol, group_id, close_price, volume FROM b ORDER BY group_id DESC, symbol LIMIT 20",
    "chart_series": f"""{_ALL} SELECT group_id, rsi6, macd, CASE WHEN pattern IS NOT NULL THEN close_price END AS marked FROM q WHERE symbol = 'click'
      AND make_timestamp(group_id * 3600000000) BETWEEN TIMESTAMP '2024-01-03' AND TIMESTAMP '2024-01-20' ORDER BY group_id""",
    "distinct_symbols": f"WITH {_T} SELECT DISTINCT symbol FROM t ORDER BY symbol",
    "trade_preview": f"WITH {_T} SELECT id AS agg_trade_id, symbol, price, quantity, us AS timestamp FROM t ORDER BY id LIMIT 20",
    "prev_day_state": f"""{_FULL}, s AS (SELECT symbol, landing_date, rsi_ag AS a, rsi_al AS l, close_price AS c FROM f QUALIFY row_number() OVER (PARTITION BY symbol,
      landing_date ORDER BY group_id DESC) = 1) SELECT d.symbol, d.landing_date, s.a AS prev_rsi_ag, s.l AS prev_rsi_al, s.c AS prev_close_price
      FROM (SELECT DISTINCT symbol, landing_date FROM f) d LEFT JOIN s ON s.symbol = d.symbol AND s.landing_date = d.landing_date - 1""",
    "trades_to_messages": f"WITH {_T} SELECT symbol AS key, id AS agg_trade_id, price FROM t WHERE price IS NOT NULL AND quantity IS NOT NULL",
    "json_trades": f"""WITH {_T} SELECT id AS agg_trade_id, symbol, price, quantity, us AS ts_int, symbol = 'purchase' AS is_buyer_maker FROM t WHERE price IS NOT NULL
      AND quantity IS NOT NULL""",
    "avg_by_symbol": f"WITH {_T} SELECT symbol, round(avg(price), 6) AS avg_price FROM t GROUP BY symbol",
    "upsert_partitions": f"""{_BARS} SELECT symbol, landing_date, group_id, close_price, volume + CASE WHEN symbol = 'click'
      AND landing_date = DATE '2024-01-02' THEN 1000 ELSE 0 END AS volume FROM b""",
    "macd_daily": f"{_DAILY} SELECT {_BAR}, ema12, ema26, macd, signal, histogram FROM f",
    "rsi_daily": f"{_DAILY} SELECT {_BAR}, rsi6, rsi_ag, rsi_al FROM f",
    **{f"pattern_{n}_daily": f"{_DAILY_ALL} SELECT {_BAR}, ema7, ema20, trend, pattern_{n} AS pattern FROM q" for n in ("one", "two", "three")},
    "run_day": f"{_DAILY} SELECT symbol, group_id, close_price, macd, signal, histogram FROM f WHERE landing_date = DATE '2024-01-05'",
    "run_day_history": f"{_DAILY} SELECT symbol, group_id, close_price, macd, signal, histogram FROM f WHERE landing_date = DATE '2024-01-05'",
    "trend": f"{_ALL} SELECT symbol, group_id, trend FROM q",
    "pattern_priority": f"{_ALL} SELECT symbol, group_id, pattern_one, pattern_two, pattern_three, pattern FROM q",
    "pattern_only": f"{_ALL} SELECT symbol, group_id, pattern FROM q WHERE pattern IS NOT NULL",
    "event_time": f"WITH {_T} SELECT id AS agg_trade_id, us // 1000 * 1000 AS ts_us FROM t WHERE price IS NOT NULL AND quantity IS NOT NULL",
    "csv_trades_scan": f"""WITH {_T} SELECT id AS agg_trade_id, price, quantity, id AS first_trade_id, id AS last_trade_id, us AS timestamp,
      symbol = 'purchase' AS is_buyer_maker, true AS is_best_match FROM t""",
    "landing_scan": f"WITH {_T} SELECT id AS agg_trade_id, symbol, price, us AS timestamp FROM t",
    "partition_scan": f"WITH {_T} SELECT id AS agg_trade_id, price, us AS timestamp FROM t WHERE symbol = 'view' AND landing_date = DATE '2024-01-03'",
    "keyed_json_sink": f"{_BARS} SELECT symbol AS key, group_id, close_price FROM b",
    "prices_stream": "SELECT event_type AS ticker, value AS price, epoch_us(ts) AS event_time FROM events",
    "multi_sink": f"""WITH RECURSIVE {_T}, {_closed(HOUR)}, {_I}, {_M} SELECT symbol, group_id * {HOUR * 1000000} AS window_start, close_price, volume, ema7, rsi6, pattern,
      pattern AS sent_pattern FROM q""",
    "sink_cast": f"""{_FULL} SELECT symbol, group_id, close_price::DECIMAL(10,6)::DOUBLE AS close_price, rsi6::DECIMAL(5,2)::DOUBLE AS rsi6,
      macd::DECIMAL(18,8)::DOUBLE AS macd, ema26::DECIMAL(10,6)::DOUBLE AS ema26 FROM f""",
    "indicators_by_blocks": f"{_FULL} SELECT symbol, group_id, {', '.join(f'round({c}, 6) AS {c}' for c in OUTPUTS)} FROM f",
    "ema": f"{_FULL} SELECT symbol, group_id, ema12 FROM f",
    "lineage_columns": f"WITH {_T} SELECT id AS agg_trade_id, 'all' AS symbol, DATE '2024-02-03' AS landing_date, true AS stamped FROM t",
    "avg_by_symbol_stream": f"WITH {_T} SELECT symbol, round(avg(price), 6) AS avg_price FROM t WHERE price IS NOT NULL AND quantity IS NOT NULL GROUP BY symbol",
    "stream_to_table": "SELECT event_type AS ticker, event_id AS reading_id, value::DECIMAL(6,2)::DOUBLE AS reading FROM events",
    "klines_stream": f"WITH {_T}, {_closed(900)} SELECT {_window(900)} FROM b",
    "indicator_stream": f"WITH RECURSIVE {_T}, {_closed(HOUR)}, {_I}, {_M} SELECT {_window(HOUR)}, {', '.join(OUTPUTS)}, trend, pattern FROM q",
    "prices_from": "SELECT event_type AS ticker, value AS price, epoch_us(ts) AS event_time FROM events WHERE ts >= TIMESTAMP '2024-01-10 12:00:00'",
    **{
        n: f"WITH {_T} SELECT id AS agg_trade_id, symbol, price, symbol = 'purchase' AS is_buyer_maker, us // 1000 * 1000 AS ts_us FROM t WHERE {w}"
        for n, w in (("shard_stream_source", "true"), ("shard_stream_at_timestamp", "us // 1000 >= epoch_ms(TIMESTAMP '2024-01-12')"))
    },
    "late_drop": f"WITH {_T}, {_closed(900)} SELECT {_window(900)} FROM b",
    "session": f"""WITH {_T} SELECT symbol, round(avg(price), 6) AS avg_price, 'UTC' AS "timeZone", 'true' AS enabled, 'dynamic' AS "partitionOverwriteMode",
      'RocksDBStateStoreProvider' AS "providerClass" FROM t GROUP BY symbol""",
    "catalog": f"{_BARS} SELECT symbol, count(*) AS n_bars, count(DISTINCT landing_date) AS n_days, false AS before, true AS found, true AS listed FROM b GROUP BY symbol",
}
