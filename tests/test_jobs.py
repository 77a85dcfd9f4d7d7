"""Raw files to summary, end to end, full and incremental."""

import datetime as dt
import json
import shutil

import pytest
from pyspark.sql import functions as F

from marketlake.__main__ import parser, run
from marketlake.operators import similarity
from marketlake.plans import jobs, silver
from marketlake.sources import bronze, tables

GLOBAL = "active_coins bigint"
START = dt.date(2024, 1, 1)


def ms(day):
    return day * 86_400_000 + int(dt.datetime(2024, 1, 1, tzinfo=dt.timezone.utc).timestamp() * 1000)


def write(path, doc):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(json.dumps(doc))


def history(base, coin, start, days, fetched, factor=1.0):
    values = [[ms(d), factor * (100 + (d * 37 % 23))] for d in range(start, start + days)]
    write(base / f"market_chart/{coin}/{fetched}/response_1.json", {
        "prices": values, "market_caps": [[t, v * 10] for t, v in values], "total_volumes": [[t, v * 2] for t, v in values]})


@pytest.fixture
def raw(tmp_path):
    base = tmp_path / "raw"
    coins = ["alpha", "beta-coin", "gamma", "delta"]
    write(base / "markets/2024-04-01/response_1.json", [
        {"id": c, "symbol": c[:2], "name": c.title(), "current_price": 500.0 + i, "market_cap": 9.0, "market_cap_rank": i + 1,
         "total_volume": 7.0} for i, c in enumerate(coins[:3])])
    # an older page of the same conversion must not win
    write(base / "markets/2024-03-31/response_9.json", [
        {"id": "alpha", "symbol": "old", "name": "Old", "current_price": 1.0, "market_cap": 9.0, "market_cap_rank": 9,
         "total_volume": 7.0}])
    for i, c in enumerate(coins):
        history(base, c, 0, 60 if c != "gamma" else 20, "2024-03-01", 1.0 + i)
    return base


def convert(spark, raw, out, at):
    inner = spark.createDataFrame([], GLOBAL).schema
    silver.convert_all(spark, str(raw), str(out), inner, F.lit(at).cast("timestamp"))


def fact_rows(spark, path):
    return sorted(
        (r["coin_id"], r["date"], r["price_usd"], r["daily_return"], r["date_id"])
        for r in tables.read_table(spark, f"{path}/fact_daily_prices").collect())


def test_raw_to_summary(spark, raw, tmp_path):
    sil, gold_path, out = (str(tmp_path / n) for n in ("silver", "gold", "out"))
    convert(spark, raw, sil, "2024-03-01 06:00:00")
    jobs.build_gold(spark, sil, gold_path, "full")
    assert tables.read_table(spark, f"{gold_path}/dim_date").count() == 60
    counts = {r["table"]: r["rows"] for r in jobs.register_gold(spark, gold_path).collect()}
    assert {r["symbol"] for r in tables.read_table(spark, f"{gold_path}/dim_coins").collect()} == {"al", "be", "ga"}
    assert counts == {"dim_coins": 3, "dim_date": 60, "fact_daily_prices": 200}

    assert jobs.analyse(spark, gold_path, out, "2024-03-01") == 3  # gamma is too short
    got = {r["coin_id"]: r for r in spark.read.parquet(f"{out}/indicators").collect()}
    assert got["beta-coin"]["name"] == "Beta-Coin" and got["delta"]["name"] == "Delta" and got["delta"]["symbol"] == "del"
    # storing the run again changes nothing
    assert jobs.analyse(spark, gold_path, out, "2024-03-01") == 3
    assert spark.read.parquet(f"{out}/patterns").count() == 3

    jobs.recommend_top(spark, gold_path, out, "2024-03-01", at=F.lit("now"))
    records = {r["coin_id"]: r for r in spark.read.parquet(f"{out}/recommendations").collect()}
    assert set(records) == {"alpha", "beta-coin"}  # delta has no rank
    assert records["alpha"]["similar_patterns"] == 3

    # the same from the stored index, which takes a run twice without doubling it
    for _ in range(2):
        assert jobs.analyse(spark, gold_path, out, "2024-03-01", index=True) == 3
    jobs.recommend_top(spark, gold_path, out, "2024-03-01", at=F.lit("now"), index=True)
    assert {r["coin_id"]: r["similar_patterns"] for r in spark.read.parquet(f"{out}/recommendations").collect()} == {"alpha": 3, "beta-coin": 3}

    said = lambda prompt: F.concat(F.lit('{"action": "buy", "confidence": 90, "reasoning": "'), F.length(prompt).cast("string"), F.lit('"}'))
    jobs.recommend_top(spark, gold_path, out, "2024-03-01", n=1, answer=said, at=F.lit("now"))
    row = jobs.summarise(spark, out).first()
    assert row["market_sentiment"] == "BULLISH" and row["total_coins"] == 1
    assert row["top_buys"][0]["confidence"] == 90 and row["generated_at"] == "now"


def test_incremental_equals_full(spark, raw, tmp_path):
    sil, one, two = (str(tmp_path / n) for n in ("silver", "one", "two"))
    convert(spark, raw, sil, "2024-03-01 06:00:00")
    jobs.build_gold(spark, sil, one, "full")
    history(raw, "beta-coin", 55, 15, "2024-03-10", 3.0)
    # only the new response is converted anew, later than the last run
    convert(spark, raw, sil, "2024-03-10 06:00:00")
    jobs.build_gold(spark, sil, one, "incremental", since="2024-03-05")
    jobs.build_gold(spark, sil, two, "full")
    assert fact_rows(spark, one) == fact_rows(spark, two)
    assert tables.read_table(spark, f"{one}/dim_date").count() == 70


def test_incremental_by_files_equals_full_build(spark, raw, tmp_path):
    sil, one, two = (str(tmp_path / n) for n in ("silver", "one", "two"))
    convert(spark, raw, sil, "2024-03-01 06:00:00")
    # the first incremental build finds every file new
    jobs.build_gold(spark, sil, one, "incremental")
    jobs.build_gold(spark, sil, two, "full")
    assert fact_rows(spark, one) == fact_rows(spark, two)
    written_at = {p: p.stat().st_mtime_ns for p in (tmp_path / "one/fact_daily_prices").rglob("*.parquet")}
    jobs.build_gold(spark, sil, one, "incremental")
    assert written_at == {p: p.stat().st_mtime_ns for p in (tmp_path / "one/fact_daily_prices").rglob("*.parquet")}
    # one coin gets another file: only its folder is read and written
    extra = spark.read.parquet(f"{sil}/market_chart/coin_id=alpha").where("timestamp = (select max(timestamp) from parquet.`%s/market_chart/coin_id=alpha`)" % sil)
    extra.withColumn("timestamp", F.col("timestamp") + F.expr("interval 1 day")).write.mode("append").parquet(f"{sil}/market_chart/coin_id=alpha")
    unread = jobs.read_unread(spark, f"{sil}/market_chart", bronze.list_files(spark, f"{sil}/market_chart"), f"{one}/files_read")
    assert {f.split("coin_id=")[1].split("/")[0] for f in unread.inputFiles()} == {"alpha"}
    jobs.build_gold(spark, sil, one, "incremental")
    jobs.build_gold(spark, sil, two, "full")
    assert fact_rows(spark, one) == fact_rows(spark, two)
    after = {p: p.stat().st_mtime_ns for p in (tmp_path / "one/fact_daily_prices").rglob("*.parquet")}
    assert {str(p).split("coin_id=")[1].split("/")[0] for p in written_at.keys() ^ after.keys()} == {"alpha"}


def test_full_build_drops_what_is_gone(spark, raw, tmp_path):
    sil, out = str(tmp_path / "silver"), str(tmp_path / "gold")
    convert(spark, raw, sil, "2024-03-01 06:00:00")
    jobs.build_gold(spark, sil, out, "full")
    shutil.rmtree(f"{sil}/market_chart/coin_id=delta")
    jobs.build_gold(spark, sil, out, "full")
    assert {r[0] for r in fact_rows(spark, out)} == {"alpha", "beta-coin", "gamma"}


def test_records_that_cannot_be_stored(spark, tmp_path):
    fields = {c: 1.0 for c in [*similarity.FEATURES, *similarity.META, "macd_line", "macd_signal", "sma_20", "sma_50", "bb_upper",
                               "bb_middle", "bb_lower"]}
    rows = [{**fields, "coin_id": c, "symbol": "s", "name": "n", "date": "2024-01-01", "signal": "neutral", "confidence": 5,
             "return_streak": 1, "as_of": "r"} for c in ("a", None, "b")]
    schema = ", ".join(f"{k} {'string' if k in ('coin_id', 'symbol', 'name', 'date', 'signal', 'as_of') else 'int' if k in ('confidence', 'return_streak') else 'double'}"
                       for k in rows[0])
    spark.createDataFrame(rows, schema).write.partitionBy("as_of").parquet(str(tmp_path / "run"))
    counts = jobs.store_patterns(spark, str(tmp_path / "run"), str(tmp_path / "patterns"), "r", str(tmp_path / "failed"))
    assert counts == {"stored": 2, "failed": 1}
    assert [r["error"] for r in spark.read.parquet(str(tmp_path / "failed")).collect()] == ["no id"]


def test_snapshot_of_the_day(spark, raw, tmp_path):
    sil, out = str(tmp_path / "silver"), str(tmp_path / "gold")
    convert(spark, raw, sil, "2024-03-01 06:00:00")
    jobs.build_gold(spark, sil, out, "full", snapshot_date="2024-02-29", flat=True)
    rows = {(r[0], str(r[1])): r[2] for r in fact_rows(spark, out)}
    # day 59 is 2024-02-29: the snapshot wins where there is one
    assert rows[("alpha", "2024-02-29")] == 500.0 and rows[("delta", "2024-02-29")] == 4.0 * (100 + 59 * 37 % 23)
    only = tmp_path / "only"
    write(only / "raw/markets/2024-04-01/response_1.json", json.loads((raw / "markets/2024-04-01/response_1.json").read_text()))
    convert(spark, only / "raw", str(only / "silver"), "2024-04-01")
    jobs.build_gold(spark, str(only / "silver"), str(only / "gold"), "full", snapshot_date="2024-04-01")
    assert len(fact_rows(spark, str(only / "gold"))) == 3
    with pytest.raises(FileNotFoundError):
        jobs.build_gold(spark, str(only / "silver"), str(only / "gold"), "full")


def test_command_line(spark, raw, tmp_path, capsys):
    args = ["silver", "--raw", str(raw), "--silver", str(tmp_path / "s")]
    run(parser().parse_args(args))
    assert "markets" in capsys.readouterr().out
    run(parser().parse_args(["gold", "--silver", str(tmp_path / "s"), "--gold", str(tmp_path / "g"), "--mode", "full"]))
    assert tables.read_table(spark, str(tmp_path / "g/fact_daily_prices")).count() == 200
