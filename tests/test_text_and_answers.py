"""Formatting against Python's own formatting; texts and answers against written-out results."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from marketlake.functions import scalars
from marketlake.operators import recommend


def numbers():
    rng = np.random.default_rng(1)
    ties = [x / 8 for x in range(-40, 41)] + [x / 200 for x in range(-300, 301)]
    ties += [36.35, 36.45, 0.305, 1.005, 2.675, 1.25, 0.5, 1.5, 2.5, -0.5, -0.004, 0.0, -0.0, 999.995, 0.99999]
    return ties + list(rng.normal(0, 1000, 300)) + list(rng.normal(0, 0.01, 300)) + [123456789.125, 1e12 + 0.5]


@pytest.mark.parametrize("places", [0, 1, 2, 4, 6])
def test_fixed_equals_python(spark, places):
    values = numbers()
    df = spark.createDataFrame(pd.DataFrame({"i": range(len(values)), "x": values})).select(
        "i", "x", scalars.fixed("x", places).alias("plain"), scalars.fixed("x", places, comma=True, plus=True).alias("full"))
    for r in df.collect():
        x = values[r["i"]]
        assert r["plain"] == f"{x:.{places}f}", x
        assert r["full"] == f"{x:+,.{places}f}", x


def test_percent_signed_and_plain(spark):
    values = [0.0123456, -0.5, 0.0, 1.23, 7.915, 1e-5, -2.5e-5, 12345678.5, 0.0001, 0.00099]
    df = spark.createDataFrame(pd.DataFrame({"i": range(len(values)), "x": values}))
    for r in df.select("i", scalars.percent("x").alias("p"), scalars.plain_number("x").alias("n")).collect():
        assert r["p"] == f"{values[r['i']]:+.2%}"
        assert r["n"] == repr(values[r["i"]])
    assert [r[0] for r in spark.range(-1, 2).select(scalars.signed_int("id")).collect()] == ["-1", "+0", "+1"]


def test_title_case(spark):
    names = ["usd-coin", "1inch", "two words", "BITCOIN", "a1b2", "o'neil", "x_y"]
    df = spark.createDataFrame(pd.DataFrame({"n": names}))
    assert [r[0] for r in df.select(scalars.title_case("n")).collect()] == [n.title() for n in names]


SNAPSHOT = dict(
    coin_id="usd-coin", symbol="usdc", name="USD Coin", date="2026-07-17", price_usd=1234567.891, market_cap_usd=1.0,
    volume_usd=2.0, daily_return=-0.01235, rsi_14=36.35, macd_line=-2.30845, macd_signal=1.0, macd_histogram=-3.308455,
    sma_20=1234.565, sma_50=0.994, price_vs_sma20=-3.45, price_vs_sma50=0.05, bb_upper=1.0, bb_middle=1.0, bb_lower=1.0,
    bb_position=0.305, volume_ratio=1.01, return_streak=-3, signal="bearish", confidence=65,
)


SNAPSHOT_TEXT = """\
USD Coin (USDC) on 2026-07-17:
  Price: $1,234,567.89 (daily return: -1.23%)
  RSI(14): 36.4
  MACD: -2.3085 (signal: 1.0000, histogram: -3.3085)
  SMA20: $1,234.57 (price is -3.5% vs SMA20)
  SMA50: $0.99 (price is +0.1% vs SMA50)
  Bollinger: position 0.30 (0=lower, 1=upper)
  Volume: 1.01x 20-day average
  Return streak: -3 days
  Signal: BEARISH (confidence: 65%)"""


def test_snapshot_and_patterns_text(spark):
    df = spark.createDataFrame(pd.DataFrame([SNAPSHOT]))
    assert df.select(recommend.snapshot_text()).first()[0] == SNAPSHOT_TEXT
    pattern = ("struct<rank:int,similarity:double,symbol:string,date:string,rsi_14:double,macd_histogram:double,"
               "signal:string,daily_return:double,volume_ratio:double>")
    one = spark.sql(f"""SELECT array(
      named_struct('rank',1,'similarity',0.985D,'symbol','btc','date','2026-01-01','rsi_14',50.0D,'macd_histogram',0.00001D,
        'signal','neutral','daily_return',0.0054D,'volume_ratio',1.0D),
      named_struct('rank',2,'similarity',0.5D,'symbol',null,'date',null,'rsi_14',null,'macd_histogram',null,
        'signal',null,'daily_return',null,'volume_ratio',null)) AS p, cast(array() AS array<{pattern}>) AS none""")
    text = one.select(recommend.patterns_text(F.col("p")), recommend.patterns_text(F.col("none"))).first()
    assert text[0] == (
        "Pattern 1 (similarity: 0.98):\n  btc on 2026-01-01 — RSI: 50.0, MACD hist: 1e-05, Signal: neutral, "
        "Daily return: +0.54%\n  Volume ratio: 1.00x\n"
        "Pattern 2 (similarity: 0.50):\n  ? on ? — RSI: ?, MACD hist: ?, Signal: ?, Daily return: +0.00%\n"
        "  Volume ratio: 1.00x")
    assert text[1] == "No similar historical patterns found."
    prompt = df.select(recommend.prompt_text(F.lit("STATE"), F.lit("PATTERNS"), F.col("symbol"))).first()[0]
    assert "STATE" in prompt and "PATTERNS" in prompt and prompt.endswith("recommendation for USDC.")


# (response, expected action, confidence, reasoning, risk level and time frame, or none if unusable)
ANSWERS = [
    ('```json\n{"action": "buy", "confidence": 80, "reasoning": "r", "risk_level": "low", "timeframe": "medium-term"}\n```', ('BUY', 80, 'r', 'LOW', 'medium-term')),
    ('text ```{"action": "SELL"}``` more', ('SELL', 50, 'Insufficient data for analysis.', 'MEDIUM', 'short-term')),
    ('{"confidence": 61.9}', ('HOLD', 61, 'Insufficient data for analysis.', 'MEDIUM', 'short-term')),
    ('{"confidence": -7.9}', ('HOLD', 0, 'Insufficient data for analysis.', 'MEDIUM', 'short-term')),
    ('{"confidence": "80"}', ('HOLD', 80, 'Insufficient data for analysis.', 'MEDIUM', 'short-term')),
    ('{"confidence": " +8_0 "}', ('HOLD', 80, 'Insufficient data for analysis.', 'MEDIUM', 'short-term')),
    ('{"confidence": "80%"}', None),
    ('{"confidence": "80.5"}', None),
    ('{"confidence": true}', ('HOLD', 1, 'Insufficient data for analysis.', 'MEDIUM', 'short-term')),
    ('{"confidence": null}', None),
    ('{"confidence": [1]}', None),
    ('{"confidence": 1e30}', ('HOLD', 100, 'Insufficient data for analysis.', 'MEDIUM', 'short-term')),
    ('{"action": null}', None),
    ('{"action": 5}', None),
    ('{"risk_level": null}', None),
    ('{"reasoning": null, "timeframe": null}', ('HOLD', 50, None, 'MEDIUM', None)),
    ('{"action": "x", "action2": 1}', ('X', 50, 'Insufficient data for analysis.', 'MEDIUM', 'short-term')),
    ('{}', ('HOLD', 50, 'Insufficient data for analysis.', 'MEDIUM', 'short-term')),
    ('[]', None),
    ('[1]', None),
    ('"text"', None),
    ('5', None),
    ('null', None),
    ('', None),
    ('   ', None),
    ('no json', None),
    ('{"a": 1} trailing', None),
    ("{'action': 'buy'}", None),
    ('{"action": "buy"', None),
    ('```json\n{"action": "buy"}', ('BUY', 50, 'Insufficient data for analysis.', 'MEDIUM', 'short-term')),
    ('```\n{"action": "hold"}\n```', ('HOLD', 50, 'Insufficient data for analysis.', 'MEDIUM', 'short-term')),
    ('\xa0{"action": "buy"}\n', ('BUY', 50, 'Insufficient data for analysis.', 'MEDIUM', 'short-term')),
    ('{"action": "buy",}', None),
    ('```json {"confidence": 5} ``` and ```json {"confidence": 6} ```', ('HOLD', 5, 'Insufficient data for analysis.', 'MEDIUM', 'short-term')),
    ('{"reasoning": "a ``` b"}', None),
]


def test_answers(spark):
    df = spark.createDataFrame(pd.DataFrame({"i": range(len(ANSWERS)), "response": [a for a, _ in ANSWERS]}))
    for r in recommend.parse_answers(df).collect():
        got = None if r["parsed"] is None else tuple(r["parsed"])
        response, expected = ANSWERS[r["i"]]
        assert got == expected, response


def test_rule_and_fallback(spark):
    rows = [("a", 29.99, "junk"), ("b", 30.0, "junk"), ("c", 70.0, None), ("d", 70.01, "[]"), ("e", 50.0, '{"action":"buy"}')]
    df = spark.createDataFrame(rows, "coin_id string, rsi_14 double, response string").withColumns(
        {"symbol": F.lit("x"), "name": F.lit("X")})
    got = {r["coin_id"]: r for r in recommend.decide(df, found=F.lit(5), at=F.lit("now")).collect()}
    assert [got[c]["action"] for c in "abcde"] == ["BUY", "HOLD", "HOLD", "SELL", "BUY"]
    assert [got[c]["confidence"] for c in "abcde"] == [55, 40, 40, 55, 50]
    assert got["a"]["reasoning"] == "RSI at 30 indicates oversold conditions."
    assert got["b"]["symbol"] == "X" and got["b"]["similar_patterns"] == 5 and got["b"]["generated_at"] == "now"
