"""Dashboard queries (DSH-*) and candles."""

from pyspark.sql import functions as F

from marketlake.operators.keyed import top_per_group
from marketlake.plans import dashboards
from marketlake.registry.core import ORACLES, query, sql
from marketlake.registry.relational import _self_join_sql, as_of
from marketlake.session import shared_folder
from marketlake.sources import tables, testbed
from marketlake.streaming import fold, trades

ANCHOR, SECOND, THIRD = testbed.COINS[:3]
SYMBOLS = testbed.SYMBOLS
IN_SYMBOLS = ", ".join(f"'{s}'" for s in SYMBOLS)


def candles(spark, d):
    return trades.candles(testbed.trades(spark, d))


@query("dsh_01_coins_tracked", sql("SELECT count(*) AS coins_tracked FROM coins", "coins"))
def coins_tracked(spark, d):
    return dashboards.coins_tracked(testbed.coins(spark, d))


for _coin in (ANCHOR, SECOND, THIRD):
    @query(f"dsh_02_latest_price_{_coin}", sql(
        f"SELECT price_usd FROM fact WHERE coin_id = '{_coin}' ORDER BY \"date\" DESC LIMIT 1", "fact"))
    def latest_price(spark, d, coin=_coin):
        return dashboards.latest_price(testbed.facts(spark, d), coin)


@query("dsh_03_all_time_high", sql("SELECT max(price_usd) AS all_time_high FROM fact WHERE coin_id = '0'", "fact"))
def all_time_high(spark, d):
    return dashboards.all_time_high(testbed.facts(spark, d), ANCHOR)


@query("dsh_04_data_since", sql('SELECT CAST(min("date") AS VARCHAR) AS data_since FROM fact', "fact"))
def data_since(spark, d):
    return dashboards.data_since(testbed.facts(spark, d))


for _coin, _measure in ((ANCHOR, "price_usd"), (SECOND, "price_usd"), (ANCHOR, "market_cap_usd")):
    @query(f"dsh_05_daily_{_measure}_{_coin}", sql(
        f'SELECT CAST("date" AS TIMESTAMP) AS "time", {_measure} AS "value" FROM fact '
        f"WHERE coin_id = '{_coin}' ORDER BY 1", "fact"))
    def daily_series(spark, d, coin=_coin, measure=_measure):
        return dashboards.daily_series(testbed.facts(spark, d), coin, measure)


for _n, _measure in ((5, "price_usd"), (3, "price_usd"), (3, "volume_usd"), (3, "market_cap_usd")):
    @query(f"dsh_06_compare_{_measure}_{_n}", _self_join_sql(testbed.COINS[:_n], _measure))
    def compare(spark, d, n=_n, measure=_measure):
        return dashboards.multi_coin_series(testbed.facts(spark, d), testbed.COINS[:n], measure)


@query("dsh_06_compare_daily_return_3", sql("""
SELECT "time", round_even(a, 6) AS coin_0, round_even(b, 6) AS coin_1, round_even(c, 6) AS coin_2 FROM (
  SELECT CAST(f."date" AS TIMESTAMP) AS "time", f.daily_return AS a, f2.daily_return AS b, f3.daily_return AS c
  FROM fact f LEFT JOIN fact f2 ON f."date" = f2."date" AND f2.coin_id = '1'
  LEFT JOIN fact f3 ON f."date" = f3."date" AND f3.coin_id = '2' WHERE f.coin_id = '0')""", "fact"))
def compare_returns(spark, d):
    out = dashboards.multi_coin_series(testbed.facts(spark, d), testbed.COINS[:3], "daily_return")
    return out.select("time", *[F.bround(c, 6).alias(c) for c in out.columns if c != "time"])


for _sort in (True, False):
    @query("dsh_07_avg_volume" + ("_sorted" if _sort else ""), sql("""
SELECT c.name AS metric, round_even(avg(f.volume_usd), 4) AS avg_volume FROM fact f JOIN coins c ON f.coin_id = c.coin_id
WHERE c.coin_id IN ('0', '1', '2', '3', '4') GROUP BY c.name""" + (" ORDER BY 2 DESC" if _sort else ""), "fact", "coins"))
    def avg_volume(spark, d, sort=_sort):
        out = dashboards.avg_volume_by_coin(testbed.facts(spark, d), testbed.coins(spark, d), testbed.COINS, sort)
        return out.withColumn("avg_volume", F.bround("avg_volume", 4))


for _n in (None, 50):
    @query("dsh_08_coin_reference" + (f"_{_n}" if _n else ""), sql(
        "SELECT coin_id, name, symbol, market_cap_rank FROM coins ORDER BY market_cap_rank NULLS LAST, coin_id"
        + (f" LIMIT {_n}" if _n else ""), "coins"))
    def coin_reference(spark, d, n=_n):
        return dashboards.coin_reference(testbed.coins(spark, d), n)


@query("dsh_09_recent_prices", sql("""
SELECT f."date", c.name, f.price_usd, f.volume_usd, f.market_cap_usd, round_even(f.daily_return, 6) AS daily_return
FROM fact f JOIN coins c ON f.coin_id = c.coin_id
WHERE f.coin_id = '0' AND f."date" >= DATE '2001-11-04' - INTERVAL '30' DAY ORDER BY 1 DESC""", "fact", "coins"))
def recent_prices(spark, d):
    out = dashboards.recent_prices(testbed.facts(spark, d), testbed.coins(spark, d), ANCHOR, 30, as_of())
    return out.withColumn("daily_return", F.bround("daily_return", 6))


for _symbol in SYMBOLS[:3]:
    @query(f"dsh_10_latest_close_{_symbol.lower()}", sql(
        f"SELECT \"close\" AS price FROM candles WHERE symbol = '{_symbol}' ORDER BY window_end DESC LIMIT 1", "candles"))
    def latest_close(spark, d, symbol=_symbol):
        return dashboards.latest_close(candles(spark, d), symbol)


@query("dsh_11_latest_candles", sql("""
SELECT symbol, "close" AS last_price, volume AS last_volume, window_end AS last_updated FROM candles
WHERE (symbol, window_end) IN (SELECT symbol, max(window_end) FROM candles GROUP BY symbol) ORDER BY symbol""", "candles"))
def latest_candles(spark, d):
    return dashboards.latest_candle_all_symbols(candles(spark, d))


for _measure in ("close", "trade_count", "volume"):
    @query(f"dsh_12_candle_{_measure}", sql(
        f"SELECT window_end AS \"time\", \"{_measure}\" AS \"value\" FROM candles WHERE symbol = 'CLICK' "
        "ORDER BY window_end DESC LIMIT 200", "candles"))
    def candle_series(spark, d, measure=_measure):
        return dashboards.candle_series(candles(spark, d), SYMBOLS[0], measure)


@query("dsh_13_candles_ohlc", sql("""
SELECT window_end AS "time", "open", high, low, "close" FROM candles WHERE symbol = 'CLICK'
ORDER BY window_end DESC LIMIT 200""", "candles"))
def candles_ohlc(spark, d):
    return dashboards.candles_ohlc(candles(spark, d), SYMBOLS[0])


@query("dsh_14_candle_table", sql("""
SELECT window_start, window_end, "open", high, low, "close", volume, trade_count FROM candles WHERE symbol = 'CLICK'
ORDER BY window_end DESC LIMIT 50""", "candles"))
def candle_table(spark, d):
    return dashboards.candle_table(candles(spark, d), SYMBOLS[0])


_NEWEST = """
newest AS (
  SELECT window_end AS "time", symbol, "close", volume FROM candles
  QUALIFY row_number() OVER (PARTITION BY symbol ORDER BY window_end DESC) <= 200)"""

for _measure in ("close", "volume"):
    @query(f"dsh_15_symbols_{_measure}", sql(
        f'SELECT "time", symbol, "{_measure}" AS "value" FROM newest', "candles", extra=_NEWEST))
    def multi_symbol(spark, d, measure=_measure):
        return dashboards.multi_symbol_series(candles(spark, d), SYMBOLS, measure)


@query("dsh_16_stacked_volume", sql("""
SELECT "time", symbol, volume AS "value", sum(volume) OVER (PARTITION BY "time" ORDER BY symbol
  ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS stacked FROM newest""", "candles", extra=_NEWEST))
def stacked(spark, d):
    return dashboards.stacked_series(candles(spark, d), SYMBOLS, "volume")


# ---- the same panels over a stored table, newest folders first -------------------


def stored_candles(spark, d):
    """The candle table as jobs write it, by symbol and date."""
    path = shared_folder(spark, "candles")
    fold.write_candles(candles(spark, d), path)
    return path


@query("dsh_10_newest_close_click", ORACLES["dsh_10_latest_close_click"])
def newest_close(spark, d):
    return dashboards.latest_close(dashboards.newest_candles(spark, stored_candles(spark, d), SYMBOLS[:1], 1), SYMBOLS[0])


@query("dsh_12_newest_volume", ORACLES["dsh_12_candle_volume"])
def newest_series(spark, d):
    return dashboards.candle_series(dashboards.newest_candles(spark, stored_candles(spark, d), SYMBOLS[:1]), SYMBOLS[0], "volume")


@query("dsh_14_newest_table", ORACLES["dsh_14_candle_table"])
def newest_table(spark, d):
    return dashboards.candle_table(dashboards.newest_candles(spark, stored_candles(spark, d), SYMBOLS[:1], 50), SYMBOLS[0])


@query("dsh_16_newest_stacked", ORACLES["dsh_16_stacked_volume"])
def newest_stacked(spark, d):
    return dashboards.stacked_series(dashboards.newest_candles(spark, stored_candles(spark, d), SYMBOLS), SYMBOLS, "volume")


@query("top_03_newest_rows", sql("""
SELECT symbol, window_start, "close" FROM candles
QUALIFY row_number() OVER (PARTITION BY symbol ORDER BY window_start DESC) <= 500""", "candles"))
def newest_rows(spark, d):
    rows = tables.newest(spark, stored_candles(spark, d), trades.CANDLE_SCHEMA, "symbol", SYMBOLS, 500)
    return top_per_group(rows, ["symbol"], [F.desc("window_start")], 500).select("symbol", "window_start", "close")


@query("agg_16_candles_1m", sql("SELECT * FROM candles", "candles"))
def candles_1m(spark, d):
    return candles(spark, d)


@query("str_04_candles_6h", sql("""
SELECT symbol, w AS window_start, w + INTERVAL '6 hours' AS window_end, arg_min(price, (trade_time, trade_id)) AS "open",
  max(price) AS high, min(price) AS low, arg_max(price, (trade_time, trade_id)) AS "close", sum(quantity) AS volume,
  count(*) AS trade_count
FROM (SELECT *, time_bucket(INTERVAL '6 hours', trade_time, TIMESTAMP '2000-01-01') AS w FROM trades) GROUP BY symbol, w""",
    "trades"))
def candles_6h(spark, d):
    return trades.candles(testbed.trades(spark, d), "6 hours")


@query("str_01_normalised_trades", sql("""
SELECT symbol, trade_id, date_trunc('millisecond', trade_time) AS trade_time, price, quantity FROM trades""", "trades"))
def normalised(spark, d):
    return trades.normalise(trades.parse_messages(testbed.trade_messages(spark, d)))


@query("src_09_trade_messages", sql("""
SELECT lower(symbol) AS symbol, CAST(trade_time AS DATE) AS "date", trade_id AS t, CAST(price AS VARCHAR) AS p,
  CAST(quantity AS VARCHAR) AS q FROM trades""", "trades"))
def messages(spark, d):
    out = trades.bronze_trades(trades.parse_messages(testbed.trade_messages(spark, d)))
    return out.select("symbol", "date", F.get_json_object("value", "$.t").cast("bigint").alias("t"), *[
        F.get_json_object("value", f"$.{c}").alias(c) for c in ("p", "q")])


@query("str_07_distinct_trades", sql("SELECT symbol, trade_id, trade_time, price, quantity FROM trades", "trades"))
def distinct_trades(spark, d):
    # every trade of the second half is delivered twice
    once = testbed.trades(spark, d)
    return trades.distinct_trades(once.union(once.where("trade_time >= '2024-01-15'")))
