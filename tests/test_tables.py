"""Readers, silver and gold builds, writers and catalog on real files."""

import datetime as dt
import json

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from marketlake import schemas
from marketlake.operators import keyed
from marketlake.plans import dashboards, gold, silver, summary
from marketlake.sources import bronze, tables, testbed

SF = "/root/testdata/sf0.001"
DAY_MS = 86_400_000


def put(path, doc):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(doc if isinstance(doc, str) else json.dumps(doc, indent=2))


@pytest.fixture
def raw(tmp_path):
    base = tmp_path / "raw"
    coin = dict(symbol="a", name="A", current_price=1.5, market_cap=2.0, total_volume=3.0)
    put(base / "markets/2024-01-01/response_1.json", [{"id": "x", "market_cap_rank": 2, **coin}, {"id": "y", "market_cap_rank": None, **coin}])
    put(base / "markets/2024-01-01/response_2.json", [{"id": "z", "market_cap_rank": 1, **coin}])
    put(base / "markets/2024-01-02/response_1.json", [{"id": "x", "market_cap_rank": 3, **coin}])
    chart = {"prices": [[0, 1.0], [DAY_MS, 2.0], [2 * DAY_MS, 3.0]], "market_caps": [[0, 10.0], [DAY_MS, 20.0], [2 * DAY_MS, 30.0]],
             "total_volumes": [[0, 5.0], [DAY_MS, 6.0]]}
    put(base / "market_chart/x/2024-01-01/response_1.json", chart)
    put(base / "market_chart/x/2024-01-02/response_1.json", {**chart, "prices": [[0, 9.0], [DAY_MS, 9.0], [3 * DAY_MS, 4.0]],
                                                            "total_volumes": [[0, 1.0], [0, 1.0], [0, 1.0]]})
    put(base / "market_chart/007/2024-01-01/response_1.json", chart)
    put(base / "market_chart/y/2024-01-01/response_1.json", {"prices": [[0, 1.0]]})
    put(base / "ohlc/x/2024-01-01/response_1.json", [[0, 1, 4, 0.5, 2], [DAY_MS, 2, 5, 1.5, 3]])
    put(base / "ohlc/x/2024-01-02/response_1.json", [[DAY_MS, 9, 9, 9, 9], [2 * DAY_MS, 3, 6, 2.5, 4]])
    put(base / "exchanges/2024-01-01/response_1.json", [{"id": "e", "name": "old", "trust": {"score": 1, "rank": 2}}])
    put(base / "exchanges/2024-01-01/response_2.json", [{"id": "e", "name": "new", "trust": {"score": 3, "rank": 4}}])
    put(base / "global_market/2024-01-01/response_1.json", {"data": {"active_coins": 5, "top_price": 1.5, "total_market_cap": {"usd": 1, "eur": 2}}})
    put(base / "global_market/2024-01-02/response_1.json", {"active_coins": 6, "total_market_cap": {"usd": 1}})
    return base


GLOBAL = "active_coins bigint, top_price double, total_market_cap struct<usd:double,eur:double>"


def test_silver_conversion_and_rerun(spark, raw, tmp_path):
    inner = spark.createDataFrame([], GLOBAL).schema
    out = tmp_path / "silver"
    at = F.lit("2024-01-03").cast("timestamp")
    for _ in range(2):  # running again gives the same tables
        assert len(silver.convert_all(spark, str(raw), str(out), inner, at)) == 5
        m = tables.read_table(spark, f"{out}/markets")
        assert m.count() == 4
        assert {(r["id"], r["snapshot_date"]) for r in m.collect()} == {
            ("x", "2024-01-01"), ("y", "2024-01-01"), ("z", "2024-01-01"), ("x", "2024-01-02")}
        c = tables.read_table(spark, f"{out}/market_chart")
        assert {r["coin_id"] for r in c.collect()} == {"x", "007"}  # ids stay text; y has no full rows
        x = {r["timestamp"].date(): r["price_usd"] for r in c.where("coin_id = 'x'").collect()}
        # shortest array wins, first copy of a timestamp wins
        assert x == {dt.date(1970, 1, 1): 1.0, dt.date(1970, 1, 2): 2.0, dt.date(1970, 1, 4): 4.0}
        o = {r["timestamp"].date().day: r["open"] for r in tables.read_table(spark, f"{out}/ohlc").collect()}
        assert o == {1: 1.0, 2: 2.0, 3: 3.0}
        e = tables.read_table(spark, f"{out}/exchanges").collect()
        assert [(r["name"], r["trust.score"]) for r in e] == [("new", 3)]
        g = tables.read_table(spark, f"{out}/global_market").drop("ingestion_time").collect()
        assert sorted(tuple(r) for r in g) == [(5, 1.5, "2024-01-01"), (6, None, "2024-01-02")]


def test_missing_feeds(spark, raw, tmp_path):
    inner = spark.createDataFrame([], GLOBAL).schema
    assert silver.convert_all(spark, str(tmp_path / "none"), str(tmp_path / "s"), inner) == []
    assert bronze.read_records(spark, str(tmp_path / "none"), schemas.MARKET).count() == 0
    assert bronze.read_arrays(spark, str(tmp_path / "none")).count() == 0
    for read in (lambda: bronze.read_objects(spark, str(tmp_path / "none"), schemas.MARKET_CHART, required=True),
                 lambda: tables.read_table(spark, str(tmp_path / "none"))):
        with pytest.raises(FileNotFoundError):
            read()


def test_first_seen_order_and_work_list(spark, raw):
    rows = bronze.read_records(spark, str(raw / "markets"), schemas.MARKET)
    first = keyed.first_seen(rows, "id", ["file_path", "pos"])
    assert [r["id"] for r in first.collect()] == ["x", "y", "z"]
    assert [r["id"] for r in keyed.first_seen(rows, "id", ["file_path", "pos"], 2).collect()] == ["x", "y"]
    done = spark.createDataFrame([("x",), (None,)], "id string")
    assert sorted(r["id"] for r in keyed.remaining(first, done, "id").collect()) == ["y", "z"]
    empty = done.limit(0)
    assert keyed.remaining(first, empty, "id").count() == 3
    assert sorted(r[0] for r in keyed.mark_done(empty, first, "id").collect()) == ["x", "y", "z"]


def test_dim_coins(spark):
    rows = [("a", "A", "s", "3", 1), ("a", "A2", "s", "n/a", 2), ("b", "B", "s", "1.0", 1), ("c", "C", "s", None, 1)]
    df = spark.createDataFrame(rows, "id string, name string, symbol string, market_cap_rank string, t int")
    got = gold.ranked(gold.dim_coins(df, ["t"])).collect()
    assert [(r["coin_id"], r["name"], r["market_cap_rank"]) for r in got] == [("b", "B", 1), ("a", "A2", None), ("c", "C", None)]


def test_incremental_refresh_equals_full(spark, tmp_path):
    raw = testbed.raw_prices(spark, SF)
    before = raw.where("date < '2001-10-01'")
    path = str(tmp_path / "fact")
    tables.write_table(gold.refresh(before, testbed.PRICE_ORDER), path, ["coin_id"])
    changed = raw.where("date >= '2001-10-01'").select("coin_id")
    tables.write_table(gold.refresh(raw, testbed.PRICE_ORDER, "incremental", changed), path, ["coin_id"])
    full = gold.refresh(raw, testbed.PRICE_ORDER)
    stored = tables.read_table(spark, path, schemas.FACT_DAILY_PRICES).select(*full.columns)
    assert stored.count() == full.count()
    assert stored.exceptAll(full).count() == 0
    assert full.groupBy("coin_id", "date").count().where("count > 1").count() == 0
    with pytest.raises(ValueError):
        gold.refresh(raw, testbed.PRICE_ORDER, "other")


def test_pivot_equals_self_join(spark):
    facts = testbed.facts(spark, SF)
    a = dashboards.multi_coin_series(facts, testbed.COINS, "daily_return")
    b = dashboards.multi_coin_self_join(facts, testbed.COINS, "daily_return")
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_catalog(spark, tmp_path):
    path = str(tmp_path / "fact")
    tables.create_database(spark)
    tables.create_table(spark, "fact_daily_prices", path)
    facts = testbed.facts(spark, SF)
    tables.write_table(facts, path, ["coin_id"])
    tables.discover_partitions(spark, "fact_daily_prices")
    got = spark.table("gold.fact_daily_prices")
    assert got.columns == [f.name for f in schemas.FACT_DAILY_PRICES.fields]
    assert got.count() == facts.count()
    flat = str(tmp_path / "flat")
    tables.write_flat(facts, flat)
    tables.create_table(spark, "fact_daily_prices", flat, flat=True)
    tables.discover_partitions(spark, "fact_daily_prices")
    assert spark.table("gold.fact_daily_prices").count() == facts.count()


def test_id_from_folder(spark, tmp_path):
    spark.createDataFrame([(1.0,)], "price double").write.parquet(str(tmp_path / "t" / "coin_id=007"))
    df = spark.read.option("recursiveFileLookup", "true").parquet(str(tmp_path / "t"))
    assert [tuple(r) for r in tables.with_id_from_path(df, "coin_id").collect()] == [(1.0, "007")]


def test_latest_run_and_ties(spark, tmp_path):
    df = spark.createDataFrame([("a", 1), ("b", 2)], "coin_id string, confidence int")
    path = str(tmp_path / "runs")
    tables.write_run(df, path, F.lit("2024-01-01"))
    tables.write_run(df.limit(1), path, F.lit("2024-01-02"))
    tables.write_run(df, path, F.lit("2024-01-02"))
    runs = spark.read.schema("coin_id string, confidence int, as_of string").json(path)
    assert runs.count() == 4 and tables.latest_run(spark, path, form="json").count() == 2
    rows = spark.createDataFrame([("x", 1, 5), ("x", 2, 5), ("x", 3, 4), ("y", 4, 1)], "k string, v int, t int")
    assert sorted(r["v"] for r in keyed.latest_with_ties(rows, "k", "t").collect()) == [1, 2, 4]


def recs(spark, actions):
    rows = [(f"c{i}", a, c, i) for i, (a, c) in enumerate(actions)]
    df = spark.createDataFrame(rows, "coin_id string, action string, confidence int, pos int")
    return df.withColumns({c: F.lit("x") for c in ("symbol", "risk_level", "reasoning", "name")} | {
        "generated_at": F.concat(F.lit("t"), "pos")})


@pytest.mark.parametrize("buy,sell,want", [(2, 1, "NEUTRAL"), (3, 1, "BULLISH"), (1, 3, "BEARISH"), (1, 2, "NEUTRAL"), (1, 0, "BULLISH"), (0, 0, "NEUTRAL")])
def test_summary(spark, buy, sell, want):
    df = recs(spark, [("HOLD", 40)] + [("BUY", 50 + i % 2) for i in range(buy)] + [("SELL", 55)] * sell)
    row = summary.market_summary(df).first()
    assert row["market_sentiment"] == want and row["total_coins"] == 1 + buy + sell
    assert row["generated_at"] == "t0" and row["signal_counts"]["sell"] == sell
    assert len(row["top_buys"]) == min(3, buy)
    values = {r["target"]: r["value"] for r in summary.metrics(summary.market_summary(df)).collect()}
    assert values["signal_counts.buy"] == str(buy)


def test_summary_ties_and_empty(spark):
    df = recs(spark, [("BUY", 50), ("BUY", 70), ("BUY", 50), ("BUY", None)])
    assert [r["coin_id"] for r in summary.top_actions(df, "BUY").collect()] == ["c1", "c0", "c2"]
    empty = df.limit(0)
    assert summary.market_summary(empty).count() == 0
    assert summary.top_actions(empty, "BUY").count() == 0
    assert summary.health(empty, df.select("coin_id")).first()["indicators_loaded"] == 4
    assert [r["text"] for r in summary.tag_keys(df).collect()] == ["coin_id", "signal"]


def test_histogram_edges(spark):
    df = spark.createDataFrame([(0.0,), (0.5,), (10.0,), (9.99,), (None,)], "x double")
    assert {r["bin"]: r["n"] for r in summary.histogram(df, "x", 20).collect()} == {1: 1, 2: 1, 20: 2}
    same = spark.createDataFrame([(3.0,), (3.0,)], "x double")
    assert [(r["bin"], r["n"]) for r in summary.histogram(same, "x").collect()] == [(1, 2)]
    with pytest.raises(ValueError):
        summary.sort_by(df, "x")


def test_sketches_merge_and_only_changed_partitions_are_written(spark, tmp_path):
    path, stored = str(tmp_path / "t"), str(tmp_path / "s")
    rows = spark.range(30_000).select((F.col("id") % 7).cast("string").alias("part"), (F.col("id") % 9000).cast("string").alias("coin_id"))
    tables.write_table(rows, path, ["part"])
    tables.write_sketches(tables.read_table(spark, path), stored, "part", ["coin_id"])

    def counts():
        return tables.merged_counts(spark.read.parquet(stored), ["coin_id"]).first()

    def files():
        return {str(f): f.stat().st_mtime_ns for f in (tmp_path / "s").rglob("*.parquet")}

    before = files()
    assert counts()["rows"] == 30_000 and abs(counts()["coin_id"] - 9000) < 450 and len(before) == 7
    more = rows.where("part = '3'").union(spark.range(5000).select(F.lit("3"), (F.col("id") + 100_000).cast("string")))
    tables.write_table(more, path, ["part"])
    changed = spark.createDataFrame([("3",)], "part string")
    tables.write_sketches(tables.read_table(spark, path), stored, "part", ["coin_id"], changed=changed)
    after = files()
    assert len(after) == 7 and len(before.keys() & after.keys()) == 6
    assert counts()["rows"] == 35_000 and abs(counts()["coin_id"] - 14_000) < 700


def test_bucketed_table_is_not_shuffled(spark, tmp_path):
    tables.create_database(spark)
    rows = spark.range(5000).select((F.col("id") % 300).cast("string").alias("coin_id"), F.col("id").alias("date"), F.rand(1).alias("price"))
    tables.write_bucketed(rows, "bucket_test", "coin_id", ["date"], 8, str(tmp_path / "b"))
    stored = spark.table("gold.bucket_test")
    before = stored.withColumn("before", F.lag("price").over(Window.partitionBy("coin_id").orderBy("date")))
    totals = before.groupBy("coin_id").agg(F.sum("before").alias("s"), F.count("*").alias("n"))
    plan = totals._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Bucketed: true" in plan
    assert totals.count() == 300 and totals.agg(F.sum("n")).first()[0] == 5000
    assert len(list((tmp_path / "b").glob("*.parquet"))) == 8
    spark.sql("DROP TABLE gold.bucket_test")
