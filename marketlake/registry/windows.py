"""Window functions, indicators and signals (WIN-*)."""

from pyspark.sql import functions as F

from marketlake.functions.scalars import rsi_band
from marketlake.operators import indicators, series
from marketlake.operators.keyed import keep_last
from marketlake.registry.core import query, sql
from marketlake.session import shared_folder
from marketlake.sources import tables, testbed
from marketlake.streaming import trades

def w():
    return series.by_time("coin_id", "date")


def r6(c):
    return F.bround(c, 6)


@query("win_01_lag", sql("""
SELECT coin_id, "date", lag(price_usd) OVER (PARTITION BY coin_id ORDER BY "date") AS prev_price FROM daily""", "daily"))
def lag(spark, d):
    return testbed.daily_prices(spark, d).select(
        "coin_id", "date", series.previous("price_usd", w()).alias("prev_price"))


@query("win_02_daily_return", sql(
    'SELECT coin_id, "date", round_even(daily_return, 6) AS daily_return FROM fact', "fact"))
def daily_return(spark, d):
    return testbed.daily_prices(spark, d).select(
        "coin_id", "date", r6(series.simple_return("price_usd", w())).alias("daily_return"))


@query("win_03_latest_per_key", sql(
    'SELECT coin_id, "date", price_usd FROM daily QUALIFY row_number() OVER '
    '(PARTITION BY coin_id ORDER BY "date" DESC) = 1', "daily"))
def latest_per_key(spark, d):
    return keep_last(testbed.daily_prices(spark, d).select("coin_id", "date", "price_usd"), ["coin_id"], ["date"])


@query("win_04_sma", sql(
    'SELECT coin_id, "date", round_even(sma_20, 6) AS sma_20, round_even(sma_50, 6) AS sma_50 FROM series', "series"))
def sma(spark, d):
    return testbed.daily_prices(spark, d).select(
        "coin_id", "date", r6(series.sma("price_usd", 20, w())).alias("sma_20"),
        r6(series.sma("price_usd", 50, w())).alias("sma_50"))


@query("win_05_bollinger", sql(
    'SELECT coin_id, "date", round_even(sma_20 + 2 * sd, 4) AS bb_upper, round_even(sma_20, 4) AS bb_middle, '
    'round_even(sma_20 - 2 * sd, 4) AS bb_lower FROM series', "series"))
def bollinger(spark, d):
    upper, middle, lower = series.bollinger("price_usd", w())
    return testbed.daily_prices(spark, d).select(
        "coin_id", "date", F.bround(upper, 4).alias("bb_upper"), F.bround(middle, 4).alias("bb_middle"),
        F.bround(lower, 4).alias("bb_lower"))


@query("win_06_volume_ratio", sql(
    'SELECT coin_id, "date", round_even(vr, 6) AS volume_ratio FROM series', "series"))
def volume_ratio(spark, d):
    return testbed.daily_prices(spark, d).select(
        "coin_id", "date", r6(series.volume_ratio("volume_usd", w())).alias("volume_ratio"))


@query("win_07_ema", sql(
    'SELECT coin_id, "date", round_even(e12, 4) AS ema_12, round_even(e26, 4) AS ema_26 FROM series', "series"))
def ema(spark, d):
    out = indicators.ema_series(testbed.daily_prices(spark, d), "coin_id", "date", "price_usd", [12, 26])
    return out.select("coin_id", "date", *[F.bround(c, 4).alias(c) for c in ("ema_12", "ema_26")])


@query("win_08_macd", sql(
    'SELECT coin_id, "date", round_even(macd_line, 4) AS macd_line, round_even(macd_signal, 4) AS macd_signal, '
    'round_even(hist, 4) AS macd_histogram FROM series', "series"))
def macd(spark, d):
    out = indicators.macd_series(testbed.daily_prices(spark, d), "coin_id", "date", "price_usd")
    return out.select("coin_id", "date", *[
        F.bround(c, 4).alias(c) for c in ("macd_line", "macd_signal", "macd_histogram")])


@query("win_09_rsi", sql('SELECT coin_id, "date", round_even(rsi, 6) AS rsi_14 FROM series', "series"))
def rsi(spark, d):
    out = indicators.rsi_series(testbed.daily_prices(spark, d), "coin_id", "date", "price_usd")
    return out.select("coin_id", "date", r6("rsi").alias("rsi_14"))


@query("win_10_gain_loss", sql("""
SELECT coin_id, "date", round_even(greatest(coalesce(price_usd - p, 0), 0), 8) AS gain,
       round_even(greatest(coalesce(p - price_usd, 0), 0), 8) AS loss
FROM (SELECT *, lag(price_usd) OVER (PARTITION BY coin_id ORDER BY "date") AS p FROM daily)""", "daily"))
def gain_loss(spark, d):
    gain, loss = series.gain_loss("price_usd", w())
    return testbed.daily_prices(spark, d).select("coin_id", "date", F.bround(gain, 8).alias("gain"), F.bround(loss, 8).alias("loss"))


@query("win_11_return_streak", sql(
    "SELECT coin_id, return_streak FROM streaks WHERE coin_id IN (SELECT coin_id FROM points)", "streaks", "points"))
def return_streak(spark, d):
    return indicators.raw_indicators(testbed.facts(spark, d)).select("coin_id", "return_streak")


@query("win_12_price_vs_sma", sql(
    'SELECT coin_id, "date", round_even((price_usd / sma_20 - 1) * 100, 6) AS price_vs_sma20, '
    'round_even((price_usd / sma_50 - 1) * 100, 6) AS price_vs_sma50 FROM series', "series"))
def price_vs_sma(spark, d):
    averaged = testbed.daily_prices(spark, d).withColumns({
        "sma_20": series.sma("price_usd", 20, w()), "sma_50": series.sma("price_usd", 50, w())})
    return averaged.select(
        "coin_id", "date", r6(series.gap_percent("price_usd", "sma_20")).alias("price_vs_sma20"),
        r6(series.gap_percent("price_usd", "sma_50")).alias("price_vs_sma50"))


@query("win_13_band_position", sql("""
SELECT coin_id, "date", round_even(CASE WHEN sd > 0 THEN (price_usd - (sma_20 - 2 * sd)) / (4 * sd) ELSE 0.5 END, 6)
  AS bb_position FROM series""", "series"))
def band_position(spark, d):
    upper, _, lower = series.bollinger("price_usd", w())
    banded = testbed.daily_prices(spark, d).withColumns({"bb_upper": upper, "bb_lower": lower})
    return banded.select(
        "coin_id", "date", r6(series.band_position("price_usd", "bb_lower", "bb_upper")).alias("bb_position"))


@query("win_14_bullish_cross", sql("""
SELECT coin_id, "date", coalesce(hist > 0 AND lag(hist) OVER (PARTITION BY coin_id ORDER BY rn) <= 0, false) AS macd_cross
FROM series QUALIFY rn = n AND n >= 30""", "series"))
def bullish_cross(spark, d):
    return indicators.raw_indicators(testbed.facts(spark, d)).select("coin_id", "date", "macd_cross")


@query("win_15_signal", sql("""
SELECT coin_id, CAST(score AS INTEGER) AS score,
  CASE WHEN score > 15 THEN 'bullish' WHEN score < -15 THEN 'bearish' ELSE 'neutral' END AS signal,
  CAST(least(100, greatest(0, abs(score) + 30)) AS INTEGER) AS confidence FROM points""", "points"))
def signal(spark, d):
    return indicators.with_signal(indicators.raw_indicators(testbed.facts(spark, d))).select(
        "coin_id", "score", "signal", "confidence")


@query("win_16_snapshot", sql("SELECT * FROM snapshot", "snapshot"))
def snapshot(spark, d):
    return indicators.snapshots(testbed.facts(spark, d), testbed.coins(spark, d))


@query("win_17_indicator_series", sql("""
SELECT coin_id, "date", round_even(rsi, 4) AS rsi_14, round_even(macd_line, 4) AS macd_line,
  round_even(macd_signal, 4) AS macd_signal, round_even(hist, 4) AS macd_histogram,
  round_even(sma_20, 4) AS sma_20, round_even(sma_50, 4) AS sma_50, round_even(sma_20 + 2 * sd, 4) AS bb_upper,
  round_even(sma_20 - 2 * sd, 4) AS bb_lower, round_even(sma_20, 4) AS bb_middle, round_even(vr, 4) AS volume_ratio,
  round_even((price_usd / sma_20 - 1) * 100, 4) AS price_vs_sma20, round_even((price_usd / sma_50 - 1) * 100, 4) AS price_vs_sma50,
  round_even(CASE WHEN sd > 0 THEN (price_usd - (sma_20 - 2 * sd)) / (4 * sd) ELSE 0.5 END, 4) AS bb_position
FROM series""", "series"))
def indicator_series(spark, d):
    out = indicators.indicator_series(testbed.daily_prices(spark, d))
    names = ["rsi_14", "macd_line", "macd_signal", "macd_histogram", "sma_20", "sma_50", "bb_upper", "bb_lower",
             "bb_middle", "volume_ratio", "price_vs_sma20", "price_vs_sma50", "bb_position"]
    return out.select("coin_id", "date", *[F.bround(c, 4).alias(c) for c in names])


@query("win_17_candle_series", sql("""
SELECT coin_id AS symbol, "date" AS window_start, round_even(rsi, 4) AS rsi_14, round_even(macd_line, 6) AS macd_line,
  round_even(hist, 6) AS macd_histogram, round_even(sma_20, 4) AS sma_20, round_even(sma_50, 4) AS sma_50,
  round_even(vr, 4) AS volume_ratio FROM candle_series""", "candle_series"))
def candle_series(spark, d):
    """Few symbols hold all candles: numbered by day, cut into blocks."""
    path = shared_folder(spark, "candles")
    tables.write_table(trades.candles(testbed.trades(spark, d)), path)
    out = indicators.indicator_series(
        tables.read_table(spark, path), "symbol", "window_start", "close", "volume",
        bucket=F.to_date("window_start"), size=2048)
    return out.select(
        "symbol", "window_start", F.bround("rsi_14", 4).alias("rsi_14"), r6("macd_line").alias("macd_line"),
        r6("macd_histogram").alias("macd_histogram"),
        *[F.bround(c, 4).alias(c) for c in ("sma_20", "sma_50", "volume_ratio")])


@query("fil_06_min_history", sql(
    "SELECT coin_id, count(*) AS n FROM daily GROUP BY coin_id HAVING count(*) >= 30", "daily"))
def min_history(spark, d):
    return testbed.daily_prices(spark, d).groupBy("coin_id").agg(F.count("*").alias("n")).where(
        F.col("n") >= indicators.MIN_HISTORY)


@query("fil_08_rsi_band", sql("""
SELECT coin_id, rsi_14, CASE WHEN rsi_14 > 70 THEN 'overbought' WHEN rsi_14 < 30 THEN 'oversold' ELSE '' END AS band
FROM snapshot""", "snapshot"))
def band(spark, d):
    return indicators.snapshots(testbed.facts(spark, d)).select("coin_id", "rsi_14", rsi_band("rsi_14").alias("band"))
