import duckdb
import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from barline import queries as Q
from barline.functions.columns import round_half_up, sink_cast
from barline.operators import patterns as P
from barline.operators.bars import klines_batch
from barline.operators import blocks
from barline.operators.recurrence import CARRIED, OUTPUTS, PLACES, advance, ema, empty_state, half_up, indicators, next_day, step
from barline.plans import jobs, storage
from barline.sources import trades as T
from barline.streaming import streams

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    c.execute("set timezone='UTC'")
    for t in ("events", "orders"):
        c.execute(f"create view {t} as select * from '{SF}/{t}.parquet'")
    return c


@pytest.mark.parametrize("name", sorted(Q.SQL))
def test_query_equals_sql(spark, con, name):
    a, b = Q.QUERIES[name](spark, SF).toPandas(), con.execute(Q.SQL[name]).fetchdf()
    assert sorted(a.columns) == sorted(b.columns)
    cols = sorted(a.columns)
    for df in (a, b):
        if "landing_date" in df:
            df["landing_date"] = pd.to_datetime(df["landing_date"]).dt.strftime("%Y-%m-%d")
    key = [c for c in ("symbol", "key", "ticker", "reading_id", "group_id", "window_start", "event_time", "agg_trade_id", "landing_date", "price") if c in cols]
    a, b = (df[cols].sort_values(key).reset_index(drop=True) for df in (a, b))
    pd.testing.assert_frame_equal(a, b, check_dtype=False, check_exact=True)


def bars(spark, rows):
    """(open, high, low, close) rows of one symbol and day."""
    data = [("s", i, *map(float, r)) for i, r in enumerate(rows)]
    return spark.createDataFrame(data, "symbol string, group_id long, open_price double, high_price double, low_price double, close_price double").withColumn("landing_date", F.to_date(F.lit("2024-01-01")))


CASES = [
    ("hammer", "downtrend", [(10, 11.25, 8, 11)]),
    ("hanging man", "uptrend", [(10, 11.25, 8, 11)]),
    (None, "downtrend", [(10, 11.26, 8, 11)]),
    (None, "downtrend", [(10, 10, 8, 10)]),
    ("bullish engulfing", "downtrend", [(10, 10.5, 8.8, 9), (8.5, 10.8, 8.4, 10.5)]),
    ("bearish engulfing", "uptrend", [(9, 10.2, 8.9, 10), (10.5, 10.6, 8.2, 8.5)]),
    ("morning star", "downtrend", [(12, 12.2, 9.8, 10), (9.5, 10, 8, 8.5), (9, 11.2, 8.9, 11)]),
    ("evening star", "uptrend", [(10, 12.2, 9.8, 12), (12.5, 14, 12, 13.5), (13, 13.1, 10.9, 11)]),
    ("morning doji star", "downtrend", [(11, 11.2, 9.8, 10), (9.5, 10, 2, 8.75), (9.5, 10.6, 9.4, 10.5)]),
    ("evening doji star", "uptrend", [(10, 11.2, 9.8, 11), (11.5, 18, 10, 12.25), (11.5, 11.6, 10.4, 10.5)]),
    ("morning star", "downtrend", [(11, 11.2, 9.8, 10), (9.5, 10, 2, 9.25), (9.5, 10.6, 9.4, 10.5)]),
]


@pytest.mark.parametrize(("label", "trend", "rows"), CASES)
def test_patterns(spark, label, trend, rows):
    fast = {"uptrend": 2.0, "downtrend": 1.0}[trend]
    df = bars(spark, rows).withColumns({"ema7": F.lit(fast), "ema20": F.lit(1.5)})
    assert P.patterns(df).orderBy("group_id").collect()[-1]["pattern"] == label
    assert P.patterns(df.withColumn("ema20", F.lit(None).cast("double"))).where("pattern is not null").count() == 0


def test_recurrences():
    s = empty_state()
    assert [step(s, float(x))["ema7"] for x in range(1, 9)] == [None] * 6 + [4.0, 5.0]
    s = empty_state()
    got = [step(s, float(x)) for x in (10, 11, 12, 11, 13, 12, 14, 14, 15)]
    assert [None if g["rsi6"] is None else (half_up(g["rsi6"], 2), half_up(g["rsi_ag"], 6), half_up(g["rsi_al"], 6)) for g in got[5:]] == [None, (75.0, 1.0, 0.333333), (75.0, 0.833333, 0.277778), (78.81, 0.861111, 0.231481)]
    s = empty_state()
    assert [step(s, 5.0)["rsi6"] for _ in range(8)] == [None] * 6 + [100.0, 100.0]
    s = empty_state()
    got = [step(s, float(x % 7)) for x in range(34)]
    assert [g["macd"] is None for g in got].index(False) == 25 and [g["signal"] is None for g in got].index(False) == 33


def test_rounding(spark):
    cases = [(1.005, 1.0), (0.125, 0.13), (-1.236, -1.23), (-0.125, -0.12), (-0.014, 0.0), (None, None)]
    got = spark.createDataFrame(cases, "x double, y double").select(round_half_up(F.col("x"), 2).alias("z"), "y").collect()
    assert all(r["z"] == r["y"] for r in got)
    assert all(half_up(x, 2) == y for x, y in cases)
    assert sink_cast(spark.createDataFrame([(12345.0,)], "open_price double")).first()[0] is None


def test_symbols_are_independent_of_partitioning(spark):
    trades = T.trades_view(spark.read.parquet(f"{SF}/events.parquet"))
    full = indicators(klines_batch(trades)).orderBy("symbol", "group_id").toPandas()
    one = indicators(klines_batch(trades.where("symbol = 'click'").repartition(7))).orderBy("symbol", "group_id").toPandas()
    pd.testing.assert_frame_equal(full[full.symbol == "click"].reset_index(drop=True), one)


def test_stream_equals_batch(spark):
    got = Q.indicator_stream(spark, SF).toPandas()
    batch = Q.QUERIES["indicator_set"](spark, SF).toPandas()
    got["group_id"] = got.window_start // 3_600_000_000
    both = got.merge(batch, on=["symbol", "group_id"])
    assert len(both) == len(got) and len(batch) - len(got) <= 5
    pd.testing.assert_series_equal(both.macd_x, both.macd_y, check_names=False)
    assert (both.pattern_x.fillna("") == both.pattern_y.fillna("")).all()


def test_messages(spark):
    rows = spark.createDataFrame([("1", "2.5", "1", "1", "1", "1000", " TRUE", "false", "A"), ("x", "2.5", "1", "1", "1", "1000", "true", "true", "A")], "agg_trade_id string, price string, quantity string, first_trade_id string, last_trade_id string, timestamp string, is_buyer_maker string, is_best_match string, symbol string")
    sent = T.trades_to_messages(rows)
    assert sent.count() == 1
    bad = spark.createDataFrame([("A", "{bad"), ("A", ""), ("A", '{"symbol":"A"}')], "key string, value string")
    got = T.json_trades(sent.unionByName(bad)).collect()
    assert len(got) == 1 and got[0]["is_buyer_maker"] and not got[0]["is_best_match"]
    odd = spark.createDataFrame([("A", '{"symbol":"A","ts_int":5,"price":"cheap","quantity":2.0}'), ("A", None)], "key string, value string")
    assert [(r.price, r.quantity) for r in T.json_trades(odd).collect()] == [(None, 2.0)]  # a field that does not parse is null
    plan = T.json_trades(sent)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_json") == 1
    assert streams.keyed_json(sent.select(F.col("key").alias("symbol"))).first()["key"] == "A"


def test_files_and_tables(spark, tmp_path):
    (tmp_path / "t.csv").write_text("1,2.0,3.0,1,1,1704067200000000,true,true\n")
    scan = T.csv_trades_scan(spark, str(tmp_path / "t.csv"))
    T.landing_write(scan, str(tmp_path / "landing"))
    assert T.landing_scan(spark, str(tmp_path / "landing")).first()["price"] == 2.0
    storage.create_database(spark, "market")
    assert storage.database_exists(spark, "market") and not storage.table_exists(spark, "market.none")
    assert Q.table_round_trip(spark, SF).count() > 0


@pytest.mark.parametrize("day", ["2024-01-02", "2024-01-03", "2024-01-06"])
def test_run_day_goes_on_from_stored_tables(spark, day):
    trades = T.trades_view(spark.read.parquet(f"{SF}/events.parquet"))
    before = pd.Timestamp(day) - pd.Timedelta(days=1)
    stored = jobs.backfill(trades, "1970-01-01", str(before.date()))
    got, want = jobs.run_day(trades, stored, day), jobs.backfill(trades, "1970-01-01", day)
    for name in want:
        a, b = (x.where(F.col("landing_date") == F.to_date(F.lit(day))) for x in (got[name], want[name]))
        assert a.count() == b.count() > 0 and a.exceptAll(b).count() == 0, name
    assert jobs.run_day(trades, {k: v.where("false") for k, v in stored.items()}, day)["macd"].where("ema26 is null").count() > 0
    stored.free()


def test_ema_goes_on_from_a_value(spark):
    df = bars(spark, [(1, 1, 1, x) for x in range(1, 9)])
    got = [r["ema3"] for r in ema(df, 3).orderBy("group_id").collect()]
    assert got[:4] == [None, None, 2.0, 3.0]
    went_on = ema(df, 3, spark.createDataFrame([("s", 5.0)], "symbol string, prev_ema double")).orderBy("group_id").collect()
    assert went_on[0]["ema3"] == 3.0 and "prev_ema" not in went_on[0].asDict()
    cold = ema(df, 3, spark.createDataFrame([("other", 5.0)], "symbol string, prev_ema double")).orderBy("group_id").collect()
    assert [r["ema3"] for r in cold] == got
    with pytest.raises(ValueError, match="period"):
        ema(df, 0)


def test_one_column_of_order_makes_a_hash_aggregate(spark):
    plan = lambda df: df._jdf.queryExecution().executedPlan().toString()
    trades = T.trades_view(spark.read.parquet(f"{SF}/events.parquet"))
    assert "SortAggregate" not in plan(klines_batch(trades, order_by=("agg_trade_id",)))
    assert klines_batch(trades, order_by=("agg_trade_id",)).exceptAll(klines_batch(trades)).count() == 0


@pytest.mark.parametrize("pieces", [1, 3, 17])
def test_columns_equal_steps(pieces):
    """Column by column and bar by bar: the same bits, wherever a history is cut."""
    rng = np.random.default_rng(pieces)
    close = np.concatenate([rng.normal(100, 20, 300).round(2), np.full(40, 7.5), rng.random(40) * 1e-9])
    a, b = empty_state(), empty_state()
    want = [step(a, float(x)) for x in close]
    got = [advance(b, x) for x in np.array_split(close, pieces)]
    for c in OUTPUTS:
        np.testing.assert_array_equal(np.concatenate([g[c] for g in got]), np.array([w[c] for w in want], float))
    assert a == b


def one_pass(rows: pd.DataFrame, carry: str) -> pd.DataFrame:
    """Every symbol's bars in order, one by one."""
    out = []
    for _, t in rows.groupby("symbol", dropna=False):
        s, day, last, close = empty_state(), None, None, None
        for d, c in zip(t.landing_date, t.close_price, strict=True):
            if carry == "daily_rounded" and d != day:
                s, day = next_day(last if day is not None and (d - day).days == 1 else None, close), d
            got = dict.fromkeys(OUTPUTS) if pd.isna(c) else step(s, float(c))
            if not pd.isna(c):
                got = {k: half_up(v, PLACES[k]) for k, v in got.items()} if carry == "daily_rounded" else got
                last, close = {k: got[k] for k in CARRIED}, float(c)
            out.append(got)
    return pd.concat([rows.reset_index(drop=True), pd.DataFrame(out, columns=OUTPUTS, dtype=float)], axis=1)


@pytest.fixture(scope="module")
def many_bars(spark):
    """Symbols with gaps of bars, days, prices and whole blocks, one of them with no more than a few bars, one null."""
    rng = np.random.default_rng(8)
    rows = []
    for symbol, every in (("a", 1), ("b", 3), ("gaps", 2), ("few", 200), (None, 5)):
        for slot in range(0, 1600, every):
            if symbol != "gaps" or not (300 < slot < 700 or 900 < slot < 960):
                rows.append((symbol, 20_000 * 24 + slot, None if slot % 17 == 0 else round(float(rng.normal(100, 9)), 2)))
    df = spark.createDataFrame(rows, "symbol string, group_id long, close_price double").withColumn("landing_date", F.date_from_unix_date(F.floor(F.col("group_id") / 24).cast("int")))
    return df, df.toPandas().sort_values(["symbol", "group_id"], na_position="last")


@pytest.mark.parametrize(("carry", "span", "halo"), [("exact", 4096, 768), ("exact", 64, 0), ("exact", 100, 64), ("exact", 500, 480), ("daily_rounded", 1, 0), ("daily_rounded", 3, 2)])
@pytest.mark.parametrize("rounds", [1, 3])
def test_blocks_equal_one_pass(spark, many_bars, tmp_path, monkeypatch, carry, span, halo, rounds):
    monkeypatch.setattr(blocks, "ROUNDS", rounds)  # the last round takes all that is left as one run
    df, rows = many_bars
    want = one_pass(rows, carry)
    got = indicators(df.repartition(3), carry, span=span, halo=halo, folder=f"file://{tmp_path}/t")
    got = got.toPandas().sort_values(["symbol", "group_id"], na_position="last").reset_index(drop=True)
    pd.testing.assert_frame_equal(got, want, check_dtype=False, check_exact=True)
    again = [p for p in (tmp_path / "t").iterdir() if p.name.startswith("again")]
    assert bool(again) == ((span, halo) != (4096, 768))
    if (span, halo) == (4096, 768):
        assert indicators(df.where("false"), carry).count() == 0


@pytest.mark.parametrize("span", [1, 7, 64, 4096])
def test_lags_reach_over_blocks(spark, many_bars, span):
    df, rows = many_bars
    df = df.withColumns({"open_price": F.col("close_price") + 1, "high_price": F.col("group_id") * 1.0, "low_price": -F.col("close_price")})
    got = P.lags(df, span=span)
    plan = got._jdf.queryExecution().executedPlan().toString()
    got = got.toPandas().sort_values(["symbol", "group_id"], na_position="last").reset_index(drop=True)
    by = rows.assign(open_price=rows.close_price + 1, high_price=rows.group_id * 1.0, low_price=-rows.close_price).groupby("symbol", dropna=False)
    for c, s in (("open_price", "o"), ("close_price", "c"), ("high_price", "h"), ("low_price", "l")):
        for k in (1, 2)[: 1 + (s in "oc")]:
            np.testing.assert_array_equal(got[f"{s}{k}"].to_numpy(float), by[c].shift(k).to_numpy(float))
    assert len(got) == len(rows) and "CartesianProduct" not in plan


def test_blocks_that_guess_right_do_not_run_again(spark, tmp_path):
    rows = spark.range(6000).select(F.lit("a").alias("symbol"), F.col("id").alias("group_id"), (F.rand(3) * 100).alias("close_price"), F.lit(None).cast("date").alias("landing_date"))
    got = indicators(rows, span=1000, halo=768, folder=f"file://{tmp_path}/t").orderBy("group_id").toPandas()
    assert not [p for p in (tmp_path / "t").iterdir() if p.name.startswith("again")]
    want = advance(empty_state(), got.close_price.to_numpy())
    assert all((np.nan_to_num(got[c], nan=-1) == np.nan_to_num(want[c], nan=-1)).all() for c in OUTPUTS)


def test_catalog(spark):
    storage.create_database(spark, "shelf")
    storage.upsert_partitions(bars(spark, [(1, 1, 1, 1)]), "shelf.bars")
    assert storage.list_tables(spark, "shelf") == ["bars"] and storage.table_exists(spark, "shelf.bars")
    made = storage.session(options={"spark.sql.shuffle.partitions": "4"})
    assert made.conf.get("spark.sql.session.timeZone") == "UTC" and "RocksDB" in made.conf.get(streams.PROVIDER)
    spark.conf.unset(streams.PROVIDER)  # it is the same session: what follows runs without
    scan = storage.partition_scan(spark.table("shelf.bars"), "s", "2024-01-01")
    plan = scan._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(symbol" in plan and scan.count() == 1


def trade(minute, second, n, price=1.0):
    ms = 1_704_067_200_000 + (minute * 60 + second) * 1000
    return '{"agg_trade_id":%d,"price":%s,"quantity":1.0,"first_trade_id":1,"last_trade_id":1,"ts_int":%d,"is_buyer_maker":true,"is_best_match":true,"symbol":"A"}' % (n, price, ms * 1000)


def test_late_rows_and_restart(spark, tmp_path):
    """A row of a closed window is dropped; a query that is started again goes on where it stopped."""
    source = tmp_path / "in"
    source.mkdir()
    batches = [[(0, 1), (14, 59), (14, 57)], [(15, 10)], [(14, 58)], [(31, 0)], [(46, 0)]]
    n = 0
    for k, rows in enumerate(batches):
        lines = []
        for minute, second in rows:
            n += 1
            lines.append(trade(minute, second, n, price=n))
        (source / f"{k}.txt").write_text("\n".join(lines) + "\n{bad\n")
        stream = spark.readStream.text(str(source)).withColumnRenamed("value", "value")
        out = streams.klines_stream(T.json_trades(stream))
        streams.stream_to_table(out, str(tmp_path / "out"), str(tmp_path / "at"), [], availableNow=True).awaitTermination()
    rows = spark.read.parquet(str(tmp_path / "out")).orderBy("window_start").collect()
    assert [(r["open_price"], r["close_price"], r["volume"]) for r in rows] == [(1.0, 2.0, 3.0), (4.0, 4.0, 1.0), (6.0, 6.0, 1.0)]


def test_sinks(spark, tmp_path):
    rows = spark.createDataFrame([("A", i, None if i % 2 else "hammer") for i in range(250)], "symbol string, n long, pattern string")
    got: dict[str, int] = {}
    take = lambda name: lambda df, n: got.update({name: df.count()})
    streams.split_by_predicate(F.col("pattern").isNotNull(), take("yes"), take("no"))(rows, 0)
    assert got == {"yes": 125, "no": 125}
    for _ in range(2):  # a batch that is run again replaces itself
        streams.shard_json(rows.coalesce(1), 7, str(tmp_path / "shard"))
    files = list((tmp_path / "shard/batch=7").glob("part-*"))
    assert len(files) == 3 and sum(len(f.read_text().splitlines()) for f in files) == 250



def bar_rows(spark, n=40):
    rows = spark.range(n).select(F.lit("A").alias("symbol"), F.to_date(F.lit("2024-01-01")).alias("landing_date"), F.timestamp_seconds(F.col("id") * 900).alias("window_start"), F.col("id").cast("double").alias("close_price"))
    return rows, "symbol string, landing_date date, window_start timestamp, close_price double, created_at date"


def test_readers_see_whole_batches(spark, tmp_path, monkeypatch):
    """A write that dies before its record is not read, and one that is run again is read once."""
    rows, fields = bar_rows(spark)
    path = f"file://{tmp_path}/sink"
    streams.serving_write(rows.where("close_price < 10"), 0, path, most=4)
    assert streams.serving_read(spark, path, fields).count() == 10
    monkeypatch.setattr(streams.F, "lit", lambda x: (_ for _ in ()).throw(OSError("away")))  # dies between rows and record
    with pytest.raises(OSError, match="away"):
        streams.serving_write(rows.where("close_price >= 10"), 1, path)
    monkeypatch.undo()
    assert len(list((tmp_path / "sink/rows/batch=1").iterdir())) == 3  # it was tried three times
    assert streams.serving_read(spark, path, fields).count() == 10
    for _ in range(2):
        streams.serving_write(rows.where("close_price >= 10"), 1, path)
    got = streams.serving_read(spark, path, fields)
    assert [r.close_price for r in got.orderBy("close_price").collect()] == [float(x) for x in range(40)] and got.where("created_at is null").isEmpty()


def test_session_settings_come_back(spark):
    for before in ("org.apache.spark.sql.execution.streaming.state.HDFSBackedStateStoreProvider", None):
        spark.conf.set(streams.PROVIDER, before) if before else spark.conf.unset(streams.PROVIDER)
        was = spark.conf.get(streams.PROVIDER, None)
        with streams.state_backend(spark):
            assert "RocksDB" in spark.conf.get(streams.PROVIDER)
        assert spark.conf.get(streams.PROVIDER, None) == was and "RocksDB" not in (was or "")


def test_job_goes_on_after_a_failure_between_two_sinks(spark, tmp_path):
    """The whole job, stopped where one sink had a batch and the next had not: no row is lost or doubled, and state goes on."""
    source = tmp_path / "in"
    source.mkdir()
    fields = "symbol string, landing_date date, window_start timestamp, close_price double, volume double, created_at date"

    def run(at, fail=False):
        def told(rows, n):
            if fail and not rows.isEmpty():
                raise OSError("away")
            streams.keyed_json(rows).write.mode("overwrite").parquet(f"{at}/told/batch={n}")

        bars = lambda rows, n: streams.serving_write(rows, n, f"{at}/bars")
        marked = lambda rows, n: streams.shard_json(rows, n, f"{at}/marked")
        messages = spark.readStream.option("maxFilesPerTrigger", 1).text(str(source))  # a backlog comes in batches of one file
        streams.crypto_stream(messages, f"{at}/checkpoint", [bars], [told], [marked], availableNow=True).awaitTermination()

    def seen(at):
        told = streams.indicators_stream_reader(spark.read.schema("key string, value string").parquet(f"{at}/told/batch=*")).orderBy("window_start").toPandas()
        return streams.serving_read(spark, f"{at}/bars", fields).orderBy("window_start").toPandas(), told

    broken, whole = f"file://{tmp_path}/broken", f"file://{tmp_path}/whole"
    (source / "0.txt").write_text("\n".join(trade(15 * k, 1, k, price=100 + k % 7) for k in range(30)))
    run(broken)
    (source / "1.txt").write_text("\n".join(trade(15 * k, 1, k, price=100 + k % 5) for k in range(30, 60)))
    with pytest.raises(Exception, match="away"):
        run(broken, fail=True)
    assert len(seen(broken)[0]) > len(seen(broken)[1])  # the first sink had the batch
    run(broken)
    (source / "2.txt").write_text("\n".join(trade(15 * k, 1, k, price=100 + k % 3) for k in range(60, 80)))
    run(broken)
    run(whole)
    for a, b in zip(seen(broken), seen(whole), strict=True):
        pd.testing.assert_frame_equal(a, b)
        assert len(a) == 78 and a.window_start.is_unique
    assert seen(whole)[1].signal.notna().sum() == 78 - 33


def test_hot_partitions_are_written_by_several_tasks(spark):
    rows = spark.range(200_000).select(F.rand(1).alias("x"), F.when(F.col("id") % 100 == 0, "cold").otherwise("hot").alias("symbol"), F.to_date(F.lit("2024-01-01")).alias("landing_date")).repartition(8)
    storage.create_database(spark, "rebalanced")
    size, least = ("spark.sql.adaptive.advisoryPartitionSizeInBytes", "spark.sql.adaptive.coalescePartitions.minPartitionSize")
    try:
        spark.conf.set(size, "200k")
        spark.conf.set(least, "1k")
        storage.upsert_partitions(rows, "rebalanced.t")
    finally:
        spark.conf.unset(size)
        spark.conf.unset(least)
    files = spark.table("rebalanced.t").select("symbol", F.input_file_name().alias("f")).distinct().groupBy("symbol").count().collect()
    assert {r.symbol: r["count"] for r in files}["hot"] > 2 and spark.table("rebalanced.t").count() == 200_000


def test_sharded_messages(spark):
    value = '{"agg_trade_id":1,"price":2.5,"symbol":"A","event_time":"%s"}'
    sent = lambda *times: spark.createDataFrame([("A", value % t) for t in times], "key string, value string")
    got = T.shard_trades(sent("2024-01-01T00:00:00Z", "2024-01-01T02:00:00.123456+02:00", "2024-01-01T00:00:01"))
    assert [r.us - 1_704_067_200_000_000 for r in got.select(F.unix_micros("ts").alias("us")).orderBy("us").collect()] == [0, 123_000, 1_000_000]
    assert T.shard_trades(sent("2024-01-01T00:00:00Z", "2024-01-01T00:00:01Z"), "at_timestamp", "2024-01-01 00:00:01").count() == 1
    assert T.shard_trades(spark.createDataFrame([("A", '{"price":1.0}')], "key string, value string")).count() == 0
    for bad in ("01/02/2024", "2024-01-01 00:00:00", "soon"):
        with pytest.raises(Exception, match="(?i)malformed"):
            T.shard_trades(sent(bad)).collect()
    for position, start in (("middle", None), ("at_timestamp", None), ("earliest", "2024-01-01")):
        with pytest.raises(ValueError, match="position|start"):
            T.shard_trades(sent("2024-01-01T00:00:00Z"), position, start)


def test_strict_messages_fail(spark):
    bad = spark.createDataFrame([("A", "{bad")], "key string, value string")
    with pytest.raises(Exception, match="(?i)malformed"):
        T.json_trades(bad, strict=True).collect()


def test_entry(spark):
    import __spark_entry__ as e

    assert e.entry(spark).count() > 0
    assert set(e.oracle_sql()) <= set(e.queries())
