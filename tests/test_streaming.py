"""Streams over files: batch parity, duplicates, late rows, restart, bad messages."""

import json

import pytest
from pyspark.sql import functions as F

from marketlake.streaming import trades

MINUTE = 60_000
START = 1_704_067_200_000


def message(symbol, number, ms, price, quantity="1"):
    return json.dumps({"stream": f"{symbol.lower()}@trade", "data": {
        "e": "trade", "E": ms, "s": symbol, "t": number, "p": str(price), "q": quantity, "T": ms, "m": False}})


def put(folder, name, messages):
    folder.mkdir(exist_ok=True)
    (folder / name).write_text("\n".join(messages) + "\n")


def feed():
    out = []
    for i in range(300):
        symbol = "BTCUSDT" if i % 3 else "ETHUSDT"
        out.append(message(symbol, i, START + i * 7_000, 100 + (i * 37) % 11, str(1 + i % 4)))
    return out


COLUMNS = ["symbol", "window_start", "open", "high", "low", "close", "volume", "trade_count"]


def candle_rows(df):
    return sorted(tuple(r[c] for c in COLUMNS) for r in df.collect())


def parsed(df):
    return trades.normalise(trades.parse_messages(df))


def run_candles(spark, src, out, state, lateness="2 minutes"):
    feed_ = parsed(trades.read_messages(spark, str(src), files_per_trigger=1))
    query = trades.land_candles(feed_, str(out), str(state), lateness=lateness, bounded=True)
    query.awaitTermination()
    return query


def test_stream_equals_batch_with_duplicates_and_restart(spark, tmp_path):
    src, out, state = tmp_path / "in", tmp_path / "out", tmp_path / "state"
    all_ = feed()
    put(src, "a.json", all_[:120])
    run_candles(spark, src, out, state)
    first = spark.read.parquet(str(out)).count()
    # the second run starts from the checkpoint; half of the first file is replayed
    put(src, "b.json", all_[105:])
    put(src, "c.json", [message("BTCUSDT", 10_000, START + 10_000 * MINUTE, 1)])
    run_candles(spark, src, out, state)
    batch = trades.candles(trades.distinct_trades(parsed(spark.createDataFrame([(m,) for m in all_], "value string"))))
    got = spark.read.parquet(str(out))
    assert 0 < first < got.count()
    assert candle_rows(got) == candle_rows(batch)


def test_rows_behind_the_watermark_are_dropped_and_counted(spark, tmp_path):
    src, out, state = tmp_path / "in", tmp_path / "out", tmp_path / "state"
    put(src, "a.json", [message("X", 1, START, 10), message("X", 2, START + 30 * MINUTE, 11)])
    run_candles(spark, src, out, state)
    put(src, "b.json", [message("X", 3, START + 1000, 99), message("X", 4, START + 90 * MINUTE, 12)])
    run_candles(spark, src, out, state)
    closed = {r["window_start"]: r["high"] for r in spark.read.parquet(str(out)).collect()}
    assert sorted(closed.values()) == [10.0, 11.0]
    # the window that the late trade belongs to was closed without it
    rows = parsed(spark.read.text(str(src)))
    late = trades.late_counts(rows, spark.read.parquet(str(out))).collect()
    assert [(r["symbol"], r["late"]) for r in late] == [("X", 1)]
    # the end of the feed: the window of the last trade is still open
    trades.finish_candles(rows, str(out), str(tmp_path / "rest"))
    assert [r["high"] for r in spark.read.parquet(str(tmp_path / "rest")).collect()] == [12.0]


def test_bronze_keeps_messages_as_received(spark, tmp_path):
    src, out, state = tmp_path / "in", tmp_path / "out", tmp_path / "state"
    put(src, "a.json", [*feed(), "{broken", "[1]", '{"stream": "x"}'])
    query = trades.land_bronze(trades.read_messages(spark, str(src)), str(out), str(state), bounded=True)
    query.awaitTermination()
    rows = spark.read.text(str(out))
    assert {r[0] for r in rows.select("symbol").distinct().collect()} == {"btcusdt", "ethusdt", "unknown"}
    got = sorted(json.loads(r["value"]).get("t", -1) for r in rows.collect())
    assert got == [-1, *range(300)]
    one = json.loads(rows.where("symbol = 'btcusdt'").first()["value"])
    assert set(one) == {"e", "E", "s", "t", "p", "q", "T", "m"} and isinstance(one["p"], str)
    trades.land_undecodable(trades.read_messages(spark, str(src)), str(tmp_path / "bad"), str(tmp_path / "bad_state"), bounded=True).awaitTermination()
    assert sorted(r[0] for r in spark.read.text(str(tmp_path / "bad")).collect()) == ["[1]", "{broken"]
    assert trades.landed(spark, str(out), str(tmp_path / "bad")) == {"received": 303, "written": 301, "undecodable": 2}


def test_totals_of_many_triggers(spark, tmp_path):
    src, out, bad = tmp_path / "in", tmp_path / "out", tmp_path / "bad"
    for i in range(105):
        put(src, f"{i:03}.json", [message("X", i, START + i, 1), *(["{broken"] if i % 10 == 0 else [])])
    feed_ = trades.read_messages(spark, str(src), files_per_trigger=1)
    for land, to in ((trades.land_bronze, out), (trades.land_undecodable, bad)):
        land(feed_, str(to), str(tmp_path / f"{to.name}_state"), bounded=True).awaitTermination()
    assert trades.landed(spark, str(out), str(bad)) == {"received": 116, "written": 105, "undecodable": 11}


def test_counters(spark):
    df = spark.createDataFrame([(m,) for m in [*feed(), "nope"]], "value string")
    out, seen = trades.counted(df)
    out.count()
    assert seen.get == {"received": 301, "undecodable": 1, "written": 300}


def test_numbers_that_are_none(spark):
    df = spark.createDataFrame([(message("X", 1, START, "abc"),), ('{"data": {"s": "X"}}',)], "value string")
    rows = parsed(df).collect()
    assert rows[0]["price"] is None and rows[1]["trade_time"] is None
    assert trades.candles(parsed(df)).count() == 0


def test_open_and_close_follow_time_then_id(spark):
    rows = [("X", 2, START, 5.0), ("X", 1, START, 4.0), ("X", 3, START + 10, 7.0), ("X", 9, START + 10, 8.0), ("X", None, START + 5, 1.0)]
    df = spark.createDataFrame(rows, "symbol string, trade_id bigint, ms bigint, price double").withColumns(
        {"trade_time": F.timestamp_millis("ms"), "quantity": F.lit(2.0)})
    c = trades.candles(df, quote_volume=True).first()
    assert (c["open"], c["high"], c["low"], c["close"], c["volume"], c["trade_count"]) == (4.0, 8.0, 1.0, 8.0, 10.0, 5)
    assert c["quote_volume"] == 50.0


@pytest.mark.parametrize("name", ["land_bronze", "land_candles"])
def test_jobs_run_until_stopped(spark, tmp_path, name):
    src = tmp_path / "in"
    put(src, "a.json", feed())
    stream = trades.read_messages(spark, str(src))
    job = getattr(trades, name)(stream if name == "land_bronze" else parsed(stream), str(tmp_path / "o"), str(tmp_path / "c"))
    job.processAllAvailable()
    assert job.isActive
    job.stop()
