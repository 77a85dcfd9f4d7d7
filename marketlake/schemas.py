"""Declared schemas of the raw feeds and the gold tables."""

from __future__ import annotations

from pyspark.sql import types as T

S, I, L, D, B = T.StringType(), T.IntegerType(), T.LongType(), T.DoubleType(), T.BooleanType()
DATE, TS = T.DateType(), T.TimestampType()


def struct(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(n, t) for n, t in fields.items()])


PAIRS = T.ArrayType(T.ArrayType(D))

MARKET = struct(
    id=S, symbol=S, name=S, current_price=D, market_cap=D, market_cap_rank=S, total_volume=D
)
EXCHANGE = struct(id=S, name=S, trust=struct(score=L, rank=L))
MARKET_CHART = struct(prices=PAIRS, market_caps=PAIRS, total_volumes=PAIRS)
CANDLES = "array<array<double>>"

# Trade fields are e, E, s, t, p, q, T and m: a map keeps names that differ only
# in case apart, and p and q arrive as text anyway.
TRADE_MESSAGE = struct(stream=S, data=T.MapType(S, S))

DIM_COINS = struct(coin_id=S, name=S, symbol=S, market_cap_rank=I)
DIM_DATE = struct(
    date=DATE, date_id=I, year=I, month=I, day=I, day_of_week=S, is_weekend=B, month_name=S,
    quarter=I,
)
FACT_DAILY_PRICES = struct(
    date_id=I, date=DATE, price_usd=D, market_cap_usd=D, volume_usd=D, daily_return=D, coin_id=S
)
FACT_OHLCV_1M = struct(
    open=D, high=D, low=D, close=D, volume=D, trade_count=L, window_start=TS, window_end=TS,
    symbol=S, date=DATE, batch=I,
)
GOLD_TABLES = {
    "dim_coins": (DIM_COINS, []),
    "dim_date": (DIM_DATE, []),
    "fact_daily_prices": (FACT_DAILY_PRICES, ["coin_id"]),
    "fact_ohlcv_1m": (FACT_OHLCV_1M, ["symbol", "date", "batch"]),
}

# the 24 fields of a technical snapshot
SNAPSHOT_FIELDS = [
    "coin_id", "symbol", "name", "date", "price_usd", "market_cap_usd", "volume_usd",
    "daily_return", "rsi_14", "macd_line", "macd_signal", "macd_histogram", "sma_20", "sma_50",
    "price_vs_sma20", "price_vs_sma50", "bb_upper", "bb_middle", "bb_lower", "bb_position",
    "volume_ratio", "return_streak", "signal", "confidence",
]
# the 10 fields of a recommendation
RECOMMENDATION_FIELDS = [
    "coin_id", "symbol", "name", "action", "confidence", "reasoning", "risk_level", "timeframe",
    "similar_patterns", "generated_at",
]
