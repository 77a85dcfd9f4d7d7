"""Registry of runnable queries and the SQL that must give the same rows."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marketlake.session import prepare

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def portable(df: DataFrame) -> DataFrame:
    """Zoned timestamps as UTC wall-clock values, the type the SQL side has."""
    zoned = {
        f.name: F.col(f"`{f.name}`").cast("timestamp_ntz")
        for f in df.schema.fields
        if isinstance(f.dataType, T.TimestampType)
    }
    return df.withColumns(zoned) if zoned else df


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query; without ``sql`` only its rows are checked."""

    def add(fn: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")

        def run(spark: SparkSession, folder: str) -> DataFrame:
            return portable(fn(prepare(spark), folder))

        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return add


# ---- shared SQL building blocks -------------------------------------------

_PARTS = {
    "raw": """
raw AS (
  SELECT CAST(l_suppkey AS VARCHAR) AS coin_id, CAST(l_shipdate AS DATE) AS "date",
         l_extendedprice / l_quantity AS price_usd,
         l_extendedprice * (1 - l_discount) AS market_cap_usd,
         l_extendedprice AS volume_usd,
         (l_orderkey * 8 + l_linenumber) * 1048576 + l_partkey % 1048576 AS seq
  FROM lineitem)""",
    "daily": """
daily AS (
  SELECT coin_id, "date", price_usd, market_cap_usd, volume_usd FROM raw
  QUALIFY row_number() OVER (PARTITION BY coin_id, "date" ORDER BY seq DESC) = 1)""",
    "fact": """
fact AS (
  SELECT CAST(strftime("date", '%Y%m%d') AS INTEGER) AS date_id, "date", price_usd, market_cap_usd,
         volume_usd, coin_id,
         CASE WHEN p IS NOT NULL AND p <> 0 THEN (price_usd - p) / p END AS daily_return
  FROM (SELECT *, lag(price_usd) OVER (PARTITION BY coin_id ORDER BY "date") AS p FROM daily))""",
    "coins": """
coins AS (
  SELECT CAST(s_suppkey AS VARCHAR) AS coin_id, s_name AS name,
         'S' || CAST(s_nationkey AS VARCHAR) AS symbol,
         CASE WHEN s_acctbal >= 0
              THEN 1000000 - CAST(round(s_acctbal * 100) AS INTEGER) END AS market_cap_rank
  FROM supplier)""",
    "markets": """
markets AS (
  SELECT CAST(o_custkey AS VARCHAR) AS id, c_mktsegment AS symbol, c_name AS name,
         o_totalprice AS current_price, o_totalprice * 10 AS market_cap,
         CASE WHEN o_orderstatus = 'P' THEN 'n/a' ELSE CAST(o_orderkey AS VARCHAR) END AS market_cap_rank,
         c_acctbal AS total_volume, o_orderdate AS ingestion_time, o_orderkey
  FROM orders JOIN customer ON o_custkey = c_custkey)""",
    "latest_market": """
latest_market AS (
  SELECT * FROM markets
  QUALIFY row_number() OVER (PARTITION BY id ORDER BY ingestion_time DESC, o_orderkey DESC) = 1)""",
    "trades": """
trades AS (
  SELECT upper(event_type) AS symbol, event_id AS trade_id, ts AS trade_time, "value" AS price,
         CAST(json_extract_string(props, '$.k') AS DOUBLE) AS quantity
  FROM events)""",
    "candles": """
candles AS (
  SELECT symbol, time_bucket(INTERVAL '1 minute', trade_time) AS window_start,
         time_bucket(INTERVAL '1 minute', trade_time) + INTERVAL '1 minute' AS window_end,
         arg_min(price, (trade_time, trade_id)) AS "open", max(price) AS high, min(price) AS low,
         arg_max(price, (trade_time, trade_id)) AS "close", sum(quantity) AS volume,
         count(*) AS trade_count
  FROM trades GROUP BY ALL)""",
    "numbered": """
numbered AS (
  SELECT *, row_number() OVER (PARTITION BY coin_id ORDER BY "date") AS rn,
         count(*) OVER (PARTITION BY coin_id) AS n
  FROM fact)""",
    "walk": """
walk AS (
  SELECT coin_id, rn, price_usd, price_usd AS e12, price_usd AS e26,
         CAST(0 AS DOUBLE) AS sig, CAST(0 AS DOUBLE) AS g, CAST(0 AS DOUBLE) AS l
  FROM numbered WHERE rn = 1
  UNION ALL
  SELECT m.coin_id, m.rn, m.price_usd,
         m.price_usd * 2 / 13 + walk.e12 * 11 / 13,
         m.price_usd * 2 / 27 + walk.e26 * 25 / 27,
         0.2 * ((m.price_usd * 2 / 13 + walk.e12 * 11 / 13)
                - (m.price_usd * 2 / 27 + walk.e26 * 25 / 27)) + 0.8 * walk.sig,
         greatest(m.price_usd - walk.price_usd, 0) + walk.g * 13 / 14,
         greatest(walk.price_usd - m.price_usd, 0) + walk.l * 13 / 14
  FROM walk JOIN numbered m ON m.coin_id = walk.coin_id AND m.rn = walk.rn + 1)""",
    "series": """
series AS (
  SELECT f.*, w.e12 - w.e26 AS macd_line, w.sig AS macd_signal, w.e12 - w.e26 - w.sig AS hist,
         w.e12, w.e26,
         CASE WHEN f.rn >= 14 AND w.l > 0 THEN 100 - 100 / (1 + w.g / w.l) END AS rsi,
         CASE WHEN f.rn >= 20 THEN avg(f.price_usd) OVER r20 END AS sma_20,
         CASE WHEN f.rn >= 50 THEN avg(f.price_usd) OVER r50 END AS sma_50,
         CASE WHEN f.rn >= 20 THEN stddev_samp(f.price_usd) OVER r20 END AS sd,
         CASE WHEN f.rn >= 20 THEN f.volume_usd / nullif(avg(f.volume_usd) OVER r20, 0) END AS vr,
         CASE WHEN daily_return > 0 THEN 1 WHEN daily_return < 0 THEN -1 ELSE 0 END AS sgn
  FROM numbered f JOIN walk w ON f.coin_id = w.coin_id AND f.rn = w.rn
  WINDOW r20 AS (PARTITION BY f.coin_id ORDER BY f.rn ROWS BETWEEN 19 PRECEDING AND CURRENT ROW),
         r50 AS (PARTITION BY f.coin_id ORDER BY f.rn ROWS BETWEEN 49 PRECEDING AND CURRENT ROW))""",
    "streaks": """
streaks AS (
  SELECT coin_id, CAST(CASE WHEN any_value(final) = 0 THEN 0
    ELSE any_value(final) * (max(n) - coalesce(max(CASE WHEN sgn <> final THEN rn END), 0)) END AS INTEGER) AS return_streak
  FROM (SELECT coin_id, n, rn, sgn, last_value(sgn) OVER (PARTITION BY coin_id ORDER BY rn
          ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING) AS final FROM series)
  GROUP BY coin_id)""",
    "points": """
points AS (
  SELECT *, CASE WHEN coalesce(vr > 1.5, false) THEN CASE WHEN base > 0 THEN base + 10 ELSE base - 10 END ELSE base END AS score
  FROM (
    SELECT *,
      CASE WHEN rsi < 30 THEN 25 WHEN rsi < 40 THEN 10 WHEN rsi > 70 THEN -25 WHEN rsi > 60 THEN -10 ELSE 0 END
      + CASE WHEN hist > 0 THEN 15 WHEN hist < 0 THEN -15 ELSE 0 END
      + CASE WHEN hist > 0 AND before <= 0 THEN 10 ELSE 0 END
      + CASE WHEN price_usd > sma_20 THEN 10 ELSE -10 END
      + CASE WHEN price_usd > sma_50 THEN 10 ELSE -10 END
      + CASE WHEN pos < 0.2 THEN 15 WHEN pos > 0.8 THEN -15 ELSE 0 END AS base
    FROM (SELECT *, lag(hist) OVER (PARTITION BY coin_id ORDER BY rn) AS before,
            CASE WHEN sd > 0 THEN (price_usd - (sma_20 - 2 * sd)) / (4 * sd) ELSE 0.5 END AS pos FROM series)
    WHERE rn = n AND n >= 30))""",
    "snapshot": """
snapshot AS (
  SELECT p.coin_id, coalesce(c.symbol, substring(p.coin_id, 1, 3)) AS symbol,
    coalesce(c.name, p.coin_id) AS name, p."date", p.price_usd, p.market_cap_usd, p.volume_usd, p.daily_return,
    coalesce(round_even(rsi, 2), 50) AS rsi_14, round_even(macd_line, 6) AS macd_line,
    round_even(macd_signal, 6) AS macd_signal, round_even(hist, 6) AS macd_histogram,
    coalesce(round_even(sma_20, 2), price_usd) AS sma_20, coalesce(round_even(sma_50, 2), price_usd) AS sma_50,
    coalesce(round_even((price_usd / sma_20 - 1) * 100, 2), 0) AS price_vs_sma20,
    coalesce(round_even((price_usd / sma_50 - 1) * 100, 2), 0) AS price_vs_sma50,
    coalesce(round_even(sma_20 + 2 * sd, 2), price_usd) AS bb_upper,
    coalesce(round_even(sma_20, 2), price_usd) AS bb_middle,
    coalesce(round_even(sma_20 - 2 * sd, 2), price_usd) AS bb_lower,
    round_even(pos, 3) AS bb_position, coalesce(round_even(vr, 2), 1) AS volume_ratio,
    s.return_streak,
    CASE WHEN score > 15 THEN 'bullish' WHEN score < -15 THEN 'bearish' ELSE 'neutral' END AS signal,
    CAST(least(100, greatest(0, abs(score) + 30)) AS INTEGER) AS confidence
  FROM points p JOIN streaks s USING (coin_id) LEFT JOIN coins c USING (coin_id))""",
    "recs": """
recs AS (
  SELECT coin_id, upper(symbol) AS symbol, name,
    CASE WHEN rsi_14 < 30 THEN 'BUY' WHEN rsi_14 > 70 THEN 'SELL' ELSE 'HOLD' END AS action,
    CASE WHEN rsi_14 < 30 OR rsi_14 > 70 THEN 55 ELSE 40 END AS confidence,
    CASE WHEN rsi_14 < 30 THEN 'RSI at ' || format('{:.0f}', rsi_14) || ' indicates oversold conditions.'
         WHEN rsi_14 > 70 THEN 'RSI at ' || format('{:.0f}', rsi_14) || ' indicates overbought conditions.'
         ELSE 'LLM unavailable — using rule-based fallback.' END AS reasoning,
    'MEDIUM' AS risk_level, 'short-term' AS timeframe
  FROM snapshot)""",
}
# the same series blocks over minute candles instead of daily facts
_PARTS["candle_fact"] = """
candle_fact AS (
  SELECT symbol AS coin_id, window_start AS "date", "close" AS price_usd, volume AS volume_usd,
         CAST(NULL AS DOUBLE) AS daily_return
  FROM candles)"""
for _name, _source in (("numbered", "fact"), ("walk", "numbered"), ("series", "numbered")):
    _text = re.sub(rf"\b{_source}\b", f"candle_{_source}", _PARTS[_name])
    _PARTS[f"candle_{_name}"] = re.sub(r"(?<!candle_)\b(numbered|walk|series)\b", r"candle_\1", _text)

# what each block needs before it
_CHAINS = {
    "raw": [], "daily": ["raw"], "fact": ["raw", "daily"], "coins": [], "markets": [],
    "latest_market": ["markets"], "trades": [], "candles": ["trades"],
    "numbered": ["raw", "daily", "fact"],
}
_CHAINS["candle_series"] = ["trades", "candles", "candle_fact", "candle_numbered", "candle_walk"]
_CHAINS["walk"] = [*_CHAINS["numbered"], "numbered"]
_CHAINS["series"] = [*_CHAINS["walk"], "walk"]
_CHAINS["streaks"] = [*_CHAINS["series"], "series"]
_CHAINS["points"] = [*_CHAINS["series"], "series"]
_CHAINS["snapshot"] = [*_CHAINS["points"], "points", "streaks", "coins"]
_CHAINS["recs"] = [*_CHAINS["snapshot"], "snapshot"]


def sql(select: str, *parts: str, extra: str = "") -> str:
    """``select`` over the named blocks (and everything they need)."""
    names: list[str] = []
    for part in parts:
        names.extend(n for n in [*_CHAINS[part], part] if n not in names)
    blocks = [_PARTS[n].strip() for n in names]
    if extra:
        blocks.append(extra.strip())
    head = "WITH RECURSIVE " + ",\n".join(blocks) + "\n" if blocks else ""
    return head + select.strip()
