"""Dashboard queries as parameterised functions (DSH-*).

``facts`` is the daily price fact, partitioned by ``coin_id`` on disk, so the
equality filters prune partitions; ``candles`` likewise by ``symbol``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from marketlake.operators.keyed import top_per_group
from marketlake.plans.gold import ranked
from marketlake.sources import tables
from marketlake.streaming.trades import CANDLE_SCHEMA


def coins_tracked(coins: DataFrame) -> DataFrame:
    """DSH-01."""
    return coins.agg(F.count(F.lit(1)).alias("coins_tracked"))


def latest_price(facts: DataFrame, coin: str) -> DataFrame:
    """DSH-02: an ordered take of one row."""
    return (
        facts.where(F.col("coin_id") == coin).orderBy(F.col("date").desc()).limit(1).select("price_usd")
    )


def all_time_high(facts: DataFrame, coin: str) -> DataFrame:
    """DSH-03."""
    return facts.where(F.col("coin_id") == coin).agg(F.max("price_usd").alias("all_time_high"))


def data_since(facts: DataFrame) -> DataFrame:
    """DSH-04."""
    return facts.agg(F.min("date").cast("string").alias("data_since"))


def daily_series(facts: DataFrame, coin: str, measure: str) -> DataFrame:
    """DSH-05: one coin's measure over time."""
    return (
        facts.where(F.col("coin_id") == coin)
        .select(F.col("date").cast("timestamp").alias("time"), F.col(measure).alias("value"))
        .orderBy("time")
    )


def multi_coin_series(facts: DataFrame, coins: Sequence[str], measure: str) -> DataFrame:
    """DSH-06: one column per coin on the dates of the first coin.

    The dashboards join the fact to itself once per coin. ``(coin_id, date)`` is
    unique, so one scan with a conditional aggregate per date gives the same
    rows with one small shuffle.
    """
    anchor = coins[0]

    def of(coin: str) -> Column:
        return F.max(F.when(F.col("coin_id") == coin, F.col(measure))).alias(f"coin_{coin}")

    return (
        facts.where(F.col("coin_id").isin(*coins))
        .groupBy("date")
        .agg(F.max((F.col("coin_id") == anchor).cast("int")).alias("_anchor"), *[of(c) for c in coins])
        .where("_anchor = 1")
        .select(F.col("date").cast("timestamp").alias("time"), *[f"coin_{c}" for c in coins])
        .orderBy("time")
    )


def multi_coin_self_join(facts: DataFrame, coins: Sequence[str], measure: str) -> DataFrame:
    """JN-03: the same result as literal left joins, kept for parity checks."""
    def branch(coin: str) -> DataFrame:
        return facts.where(F.col("coin_id") == coin).select("date", F.col(measure).alias(f"coin_{coin}"))

    out = branch(coins[0])
    for coin in coins[1:]:
        out = out.join(branch(coin), "date", "left")
    return out.select(F.col("date").cast("timestamp").alias("time"), *[f"coin_{c}" for c in coins]).orderBy("time")


def avg_volume_by_coin(
    facts: DataFrame, coins: DataFrame, only: Sequence[str], sort: bool = True
) -> DataFrame:
    """DSH-07: mean volume per coin name.

    Averaged per coin before the join, so the join sees one row per coin; equal
    names are merged afterwards from sums and counts.
    """
    per_coin = (
        facts.where(F.col("coin_id").isin(*only))
        .groupBy("coin_id")
        .agg(F.sum("volume_usd").alias("_sum"), F.count("volume_usd").alias("_n"))
    )
    out = (
        per_coin.join(coins.select("coin_id", F.col("name").alias("metric")), "coin_id")
        .groupBy("metric")
        .agg(F.try_divide(F.sum("_sum"), F.sum("_n")).alias("avg_volume"))
    )
    return out.orderBy(F.col("avg_volume").desc()) if sort else out


def coin_reference(coins: DataFrame, n: int | None = None) -> DataFrame:
    """DSH-08: the coin list by rank."""
    return ranked(coins.select("coin_id", "name", "symbol", "market_cap_rank"), n)


def recent_prices(
    facts: DataFrame, coins: DataFrame, coin: str, days: int = 30, as_of: Column | None = None
) -> DataFrame:
    """DSH-09: one coin's rows of the last ``days`` days before ``as_of``."""
    start = F.date_sub(as_of if as_of is not None else F.current_date(), days)
    return (
        facts.where((F.col("coin_id") == coin) & (F.col("date") >= start))
        .join(coins.where(F.col("coin_id") == coin).select("coin_id", "name"), "coin_id")
        .select("date", "name", "price_usd", "volume_usd", "market_cap_usd", "daily_return")
        .orderBy(F.col("date").desc())
    )


def newest_candles(spark: SparkSession, table: str, symbols: Sequence[str], n: int = 200) -> DataFrame:
    """Candles of the newest dates that hold the newest ``n`` of each symbol, for the panels below (DSH-10..16).

    ``table`` is laid out by symbol and date; older dates are not read.
    """
    return tables.newest(spark, table, CANDLE_SCHEMA, "symbol", symbols, n)


def latest_close(candles: DataFrame, symbol: str) -> DataFrame:
    """DSH-10."""
    return candle_series(candles, symbol, "close", 1).select(F.col("value").alias("price"))


def latest_candle_all_symbols(candles: DataFrame) -> DataFrame:
    """DSH-11: the newest candle of every symbol, from one scan; a symbol has one candle at a time."""
    newest = candles.groupBy("symbol").agg(
        F.max_by("close", "window_end").alias("last_price"), F.max_by("volume", "window_end").alias("last_volume"),
        F.max("window_end").alias("last_updated"))
    return newest.orderBy("symbol")


def _newest(candles: DataFrame, symbol: str, n: int) -> DataFrame:
    return candles.where(F.col("symbol") == symbol).orderBy(F.col("window_end").desc()).limit(n)


def candle_series(candles: DataFrame, symbol: str, measure: str, n: int = 200) -> DataFrame:
    """DSH-12: one measure of the newest ``n`` candles."""
    return _newest(candles, symbol, n).select(
        F.col("window_end").alias("time"), F.col(measure).alias("value")
    )


def candles_ohlc(candles: DataFrame, symbol: str, n: int = 200) -> DataFrame:
    """DSH-13."""
    return _newest(candles, symbol, n).select(
        F.col("window_end").alias("time"), "open", "high", "low", "close"
    )


def candle_table(candles: DataFrame, symbol: str, n: int = 50) -> DataFrame:
    """DSH-14."""
    return _newest(candles, symbol, n).select(
        "window_start", "window_end", "open", "high", "low", "close", "volume", "trade_count"
    )


def multi_symbol_series(candles: DataFrame, symbols: Sequence[str], measure: str, n: int = 200) -> DataFrame:
    """DSH-15: the newest ``n`` candles of several symbols in one pass."""
    chosen = candles.where(F.col("symbol").isin(*symbols)).select("symbol", "window_end", measure)
    newest = top_per_group(chosen, ["symbol"], [F.col("window_end").desc()], n)
    return newest.select(F.col("window_end").alias("time"), "symbol", F.col(measure).alias("value"))


def stacked_series(candles: DataFrame, symbols: Sequence[str], measure: str, n: int = 200) -> DataFrame:
    """DSH-16: running total across the symbols at each time, in the given order.

    A time holds at most one row per chosen symbol, so its window is small.
    """
    place = F.array_position(F.array(*[F.lit(s) for s in symbols]), F.col("symbol"))
    up_to = Window.partitionBy("time").orderBy("place").rowsBetween(Window.unboundedPreceding, 0)
    return (
        multi_symbol_series(candles, symbols, measure, n)
        .withColumn("place", place)
        .select("time", "symbol", "value", F.sum("value").over(up_to).alias("stacked"))
    )
