"""What the plans must look like at scale."""

import re

import pytest
from pyspark.sql import functions as F

from marketlake.operators import blocks, indicators, recommend
from marketlake.plans import dashboards, gold, silver
from marketlake.registry import QUERIES
from marketlake.sources import tables, testbed

SF = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def shuffles(text):
    return text.count("Exchange hashpartitioning") + text.count("Exchange rangepartitioning") + text.count("SinglePartition")


@pytest.mark.parametrize("name", list(QUERIES))
def test_no_cross_join_and_no_global_window(spark, name):
    text = plan(QUERIES[name](spark, SF))
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text
    for line in text.splitlines():
        # every window has partition keys
        assert not (line.strip(" :+-*()0123456789").startswith("Window [") and line.rstrip().endswith("], [], [])"))


def test_dedup_is_a_partial_hash_aggregate(spark):
    text = plan(testbed.daily_prices(spark, SF))
    assert "partial_max_by" in text and "SortAggregate" not in text and shuffles(text) == 1


def test_first_copies_of_silver_feeds_are_not_sorted(spark, tmp_path):
    for coin in ("a", "b"):
        folder = tmp_path / f"market_chart/{coin}/2024-01-01"
        folder.mkdir(parents=True)
        (folder / "r.json").write_text('{"prices": [[1, 2.0]], "market_caps": [[1, 2.0]], "total_volumes": [[1, 2.0]]}')
        folder = tmp_path / f"ohlc/{coin}/2024-01-01"
        folder.mkdir(parents=True)
        (folder / "r.json").write_text("[[1, 2.0, 3.0, 1.0, 2.0]]")
    for build, name in ((silver.market_chart, "market_chart"), (silver.ohlc, "ohlc")):
        rows = build(spark, str(tmp_path / name))
        assert "SortAggregate" not in plan(rows) and rows.count() == 2


def test_fact_and_indicators_shuffle_twice(spark):
    facts = testbed.facts(spark, SF)
    assert shuffles(plan(facts)) == 2
    assert shuffles(plan(indicators.raw_indicators(facts))) == 2
    # whole series read key, order and price a second time, for the totals of the blocks
    assert shuffles(plan(indicators.indicator_series(testbed.daily_prices(spark, SF)))) <= 4


def test_candles_are_a_partial_hash_aggregate(spark):
    text = plan(QUERIES["agg_16_candles_1m"](spark, SF))
    assert "partial_min_by" in text and "SortAggregate" not in text and shuffles(text) == 1


@pytest.mark.parametrize("order", ["date", "stamp"])
@pytest.mark.parametrize("build", ["ema", "macd", "rsi", "indicator"])
def test_series_are_windowed_by_block(spark, monkeypatch, order, build):
    """No window over rows is partitioned by the key alone; those over blocks, one row a block, are."""
    monkeypatch.setattr(blocks, "written", lambda df, name: df)
    df = testbed.daily_prices(spark, SF).withColumn("stamp", F.col("date").cast("timestamp"))
    out = {"ema": lambda: indicators.ema_series(df, "coin_id", order, "price_usd", [12]), "macd": lambda: indicators.macd_series(df, "coin_id", order, "price_usd"),
           "rsi": lambda: indicators.rsi_series(df, "coin_id", order, "price_usd"), "indicator": lambda: indicators.indicator_series(df, order=order)}[build]()
    windows = [line.strip() for line in plan(out).splitlines() if "Window [" in line]
    spread = [re.search(r"\], \[([^\[\]]*)\], \[[^\[\]]*\]$", w).group(1) for w in windows]
    alone = [w for w, keys in zip(windows, spread) if "_bucket#" not in keys and "block#" not in keys]
    assert any("row_number" in w for w in windows) and any("price_usd" in w for w in windows)
    # what is left sees blocks only: their counts, ends and states
    for w in alone:
        assert not re.search(r"row_number|price_usd|volume_usd", w) and re.search(r"_rows#|_start#|_first#|_last#", w), w
    assert alone


def test_matches_are_the_broadcast_side(spark, tmp_path):
    """The collection is joined to the few matches without being shuffled."""
    ids = [f"c{i}_2024-01-01" for i in range(50)]
    meta = {"symbol": "s", "date": "2024-01-01", "signal": "neutral"}
    rows = [(i, i.split("_")[0]) for i in ids]
    numbers = {c: F.lit(1.0) for c in ("rsi_14", "macd_histogram", "daily_return", "volume_ratio", "price_usd", "macd_line",
                                       "macd_signal", "sma_20", "sma_50", "price_vs_sma20", "price_vs_sma50", "bb_position")}
    patterns = spark.createDataFrame(rows, "id string, coin_id string").withColumns(
        {**{k: F.lit(v) for k, v in meta.items()}, **numbers, "name": F.lit("n"), "confidence": F.lit(1), "return_streak": F.lit(1)})
    patterns.write.parquet(str(tmp_path / "p"))
    spark.createDataFrame([(ids[0], ids[1], 0.9, 1)], "query_id string, match_id string, similarity double, rank int").write.parquet(
        str(tmp_path / "m"))
    p, m = (spark.read.parquet(str(tmp_path / n)) for n in "pm")
    text = plan(recommend.with_patterns(p.limit(1), m, p))
    assert "BroadcastHashJoin" in text and "SortMergeJoin" not in text.split("HashAggregate")[-1]


def test_filters_reach_the_scan(spark, tmp_path):
    path = str(tmp_path / "fact")
    tables.write_table(testbed.facts(spark, SF), path, ["coin_id"])
    facts = tables.read_table(spark, path)
    text = plan(dashboards.daily_series(facts, "0", "price_usd"))
    assert "PartitionFilters: [isnotnull(coin_id" in text and "ReadSchema: struct<date:date,price_usd:double>" in text
    text = plan(dashboards.multi_coin_series(facts, testbed.COINS, "volume_usd"))
    assert text.count("FileScan") == 1 and "coin_id#" in text.split("PartitionFilters: ")[1].split("]")[0]
    assert shuffles(text) == 2


def test_top_k_is_cut_down_before_the_shuffle(spark):
    candles = QUERIES["agg_16_candles_1m"](spark, SF)
    assert plan(dashboards.multi_symbol_series(candles, testbed.SYMBOLS, "close")).count("WindowGroupLimit") == 2
    assert "TakeOrderedAndProject" in plan(dashboards.candle_series(candles, "CLICK", "close"))
    assert "TakeOrderedAndProject" in plan(gold.ranked(testbed.coins(spark, SF), 20))
