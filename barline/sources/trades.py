"""Trades from files, messages and the event table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Fixed by the feed.
TRADE_SCHEMA = "agg_trade_id long, price double, quantity double, first_trade_id long, last_trade_id long, timestamp long, is_buyer_maker boolean, is_best_match boolean"
MESSAGE_SCHEMA = "agg_trade_id long, price double, quantity double, first_trade_id long, last_trade_id long, ts_int long, is_buyer_maker boolean, is_best_match boolean, symbol string"


def csv_trades_scan(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(TRADE_SCHEMA).csv(path, header=False)


def landing_write(df: DataFrame, path: str) -> None:
    stamped = df.withColumns({"ingest_date": F.current_date(), "ingest_timestamp": F.current_timestamp()})
    stamped.write.mode("overwrite").parquet(path)


def landing_scan(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)
#: The same with the event's time in ISO 8601, as sharded streams carry it.
SHARD_SCHEMA = MESSAGE_SCHEMA.replace("ts_int long", "event_time timestamp")
ISO_8601 = "yyyy-MM-dd'T'HH:mm:ss[.SSSSSS][.SSS][XXX]"
POSITIONS = ("earliest", "at_timestamp")


def trades_view(events: DataFrame) -> DataFrame:
    """The event table as trades: one symbol per event type, its value as price."""
    ts = F.col("ts").cast("timestamp")
    return events.select(
        F.col("event_id").alias("agg_trade_id"), F.col("value").alias("price"), F.get_json_object("props", "$.k").cast("double").alias("quantity"),
        F.col("event_id").alias("first_trade_id"), F.col("event_id").alias("last_trade_id"), F.unix_micros(ts).alias("timestamp"),
        (F.col("event_type") == "purchase").alias("is_buyer_maker"), F.lit(True).alias("is_best_match"), F.col("event_type").alias("symbol"), F.to_date(ts).alias("landing_date"),
    )


def orders_view(orders: DataFrame) -> DataFrame:
    """Orders as trades of one symbol per priority; many share a time."""
    ts = F.col("o_orderdate").cast("timestamp")
    return orders.select(
        F.col("o_orderkey").alias("agg_trade_id"), F.col("o_totalprice").alias("price"), F.lit(1.0).alias("quantity"),
        F.unix_micros(ts).alias("timestamp"), F.col("o_orderpriority").alias("symbol"), F.to_date(ts).alias("landing_date"),
    )


def trades_to_messages(raw: DataFrame) -> DataFrame:
    """Text columns of a trade file (and ``symbol``) to key and JSON value; rows that do not parse are left out."""
    number = lambda c, t: F.col(c).try_cast(t)
    flag = lambda c: F.lower(F.trim(F.col(c).cast("string"))) == "true"
    longs = {c: number(c, "long") for c in ("agg_trade_id", "first_trade_id", "last_trade_id")}
    doubles = {c: number(c, "double") for c in ("price", "quantity")}
    flags = {c: flag(c) for c in ("is_buyer_maker", "is_best_match")}
    parsed = raw.withColumns(longs | doubles | flags | {"ts_int": number("timestamp", "long")})
    names = [f.split()[0] for f in MESSAGE_SCHEMA.split(", ")]
    whole = F.lit(True)
    for c in (*longs, *doubles, "ts_int"):
        whole = whole & F.col(c).isNotNull()
    return parsed.where(whole).select(F.col("symbol").alias("key"), F.to_json(F.struct(*names)).alias("value"))


def decoded(messages: DataFrame, schema: str | T.StructType, options: dict[str, str] | None = None) -> DataFrame:
    """The fields of the messages' JSON ``value``; a generator, so that filters on them do not parse it again."""
    return messages.select(F.inline(F.array(F.from_json(F.col("value").cast("string"), schema, options or {}))))


def json_trades(messages: DataFrame, strict: bool = False) -> DataFrame:
    """Messages, streamed or not, to trades with event time ``ts``; ``strict`` fails on malformed ones.

    Else a message that is no JSON, or has no time or symbol, is skipped, and another field that
    does not parse is null. A sharded stream, which has no option to ignore errors, is read ``strict``.
    """
    if strict:
        rows = decoded(messages, MESSAGE_SCHEMA, {"mode": "FAILFAST"})
    else:
        rows = decoded(messages, MESSAGE_SCHEMA).where("ts_int is not null and symbol is not null")
    return rows.withColumn("ts", event_time(F.col("ts_int")))


def event_time(micros):
    """Microseconds to a timestamp of whole milliseconds."""
    return F.timestamp_millis(F.floor(micros / 1000).cast("long"))


def iso_messages(trades: DataFrame, fields: dict[str, str]) -> DataFrame:
    """Rows as (key, value) messages: ``fields`` names the columns of a JSON value, times are written in ISO 8601."""
    names = [F.col(c).alias(n) for n, c in fields.items()]
    return trades.select(F.col("symbol").alias("key"), F.to_json(F.struct(*names), {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX", "timeZone": "UTC"}).alias("value"))


def shard_trades(messages: DataFrame, position: str = "earliest", start: str | None = None) -> DataFrame:
    """Trades of a sharded stream, from its oldest message on or, ``at_timestamp``, from an event time on.

    Such a stream has no option to ignore errors: a message that is no JSON, or whose time is not
    in ISO 8601, fails the query. Times without a zone are in UTC; event times ``ts`` are whole
    milliseconds. Messages without a symbol or time are left out.
    """
    if position not in POSITIONS:
        raise ValueError(f"a position is one of {', '.join(POSITIONS)}")
    if (position == "at_timestamp") != (start is not None):
        raise ValueError("a start is told for at_timestamp, and only for it")
    options = {"mode": "FAILFAST", "timestampFormat": ISO_8601, "timeZone": "UTC"}
    rows = decoded(messages, SHARD_SCHEMA, options).where("event_time is not null and symbol is not null").withColumn("ts", F.date_trunc("millisecond", "event_time")).drop("event_time")
    return rows.where(F.col("ts") >= F.lit(start).cast("timestamp")) if start else rows


def prices(messages: DataFrame, start: str | None = None) -> DataFrame:
    """ticker, price, event_time with a watermark of 5 seconds; from ``start`` on if given."""
    rows = decoded(messages, "ticker string, price double, event_time timestamp").where("event_time is not null")
    rows = rows.where(F.col("event_time") >= F.lit(start).cast("timestamp")) if start else rows
    return rows.withWatermark("event_time", "5 seconds")
