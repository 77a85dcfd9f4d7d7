"""Indicators against pandas on walks, short, flat, monotone and long series."""

import datetime as dt

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from marketlake.operators import blocks, indicators, series
from marketlake.plans import gold

DAY = dt.date(2020, 1, 1)


def walk(n, seed):
    return np.round(100 * np.exp(np.cumsum(np.random.default_rng(seed).normal(0, 0.03, n))), 4)


SERIES = {
    "walk29": walk(29, 1), "walk30": walk(30, 2), "walk49": walk(49, 3), "walk50": walk(50, 4),
    "walk181": walk(181, 5), "walk3000": walk(3000, 6),
    "up": np.arange(1.0, 61.0), "down": np.arange(120.0, 60.0, -1.0), "flat": np.full(60, 64.0),
    "pause": np.concatenate([walk(50, 7), np.full(3, 99.5)]),
    "zero": np.concatenate([walk(40, 8), [0.0], walk(20, 9)]),
}


def frame(which=SERIES):
    rows = []
    for coin, prices in which.items():
        volumes = np.random.default_rng(len(prices)).integers(1, 1000, len(prices)).astype(float)
        for i, (p, v) in enumerate(zip(prices, volumes)):
            rows.append((coin, DAY + dt.timedelta(days=i), float(p), float(p) * 10, float(v)))
    return pd.DataFrame(rows, columns=["coin_id", "date", "price_usd", "market_cap_usd", "volume_usd"])


def expected(g):
    p = g["price_usd"]
    fast, slow = (p.ewm(span=s, adjust=False).mean() for s in (12, 26))
    line = fast - slow
    signal = line.ewm(span=9, adjust=False).mean()
    step = p.diff()
    up = step.clip(lower=0).fillna(0).ewm(alpha=1 / 14, min_periods=14).mean()
    down = (-step).clip(lower=0).fillna(0).ewm(alpha=1 / 14, min_periods=14).mean()
    mean, std = p.rolling(20).mean(), p.rolling(20).std()
    return pd.DataFrame({
        "coin_id": g["coin_id"], "date": g["date"], "ema_12": fast, "ema_26": slow, "macd_line": line,
        "macd_signal": signal, "macd_histogram": line - signal, "rsi_14": 100 - 100 / (1 + up / down.replace(0, np.nan)),
        "sma_20": mean, "sma_50": p.rolling(50).mean(), "bb_upper": mean + 2 * std, "bb_lower": mean - 2 * std,
        "volume_ratio": g["volume_usd"] / g["volume_usd"].rolling(20).mean(),
    })


def check(got, want, columns):
    both = want.merge(got, on=["coin_id", "date"], suffixes=("_w", ""))
    assert len(both) == len(want) == len(got)
    for c in columns:
        np.testing.assert_allclose(
            both[c].astype(float), both[f"{c}_w"].astype(float), rtol=1e-8, atol=1e-7, equal_nan=True, err_msg=c)


COLUMNS = ["macd_line", "macd_signal", "macd_histogram", "rsi_14", "sma_20", "sma_50", "bb_upper", "bb_lower",
           "volume_ratio"]


@pytest.fixture(scope="module")
def prices(spark):
    return frame(), spark.createDataFrame(frame())


@pytest.mark.parametrize("size", [None, 256])
def test_whole_series(prices, size):
    pdf, df = prices
    want = pd.concat(expected(g) for _, g in pdf.groupby("coin_id"))
    check(indicators.indicator_series(df, size=size).toPandas(), want, COLUMNS)


def test_one_long_hot_series(spark):
    """One key holds nearly all rows, is numbered by bucket and spread over blocks."""
    n = 20_000
    hot = frame({"hot": walk(n, 11), "small": walk(40, 12)})
    df = spark.createDataFrame(hot)
    want = pd.concat(expected(g) for _, g in hot.groupby("coin_id"))
    out = indicators.indicator_series(df, bucket=F.trunc("date", "year"), size=1024)
    check(out.toPandas(), want, COLUMNS)
    ema = indicators.ema_series(df, "coin_id", "date", "price_usd", [12, 26], F.trunc("date", "year"), 700)
    check(ema.toPandas(), want, ["ema_12", "ema_26"])
    rsi = indicators.rsi_series(df, "coin_id", "date", "price_usd", bucket=F.trunc("date", "year"), size=512)
    check(rsi.withColumnRenamed("rsi", "rsi_14").toPandas(), want, ["rsi_14"])


def test_a_block_never_holds_more_than_its_share(spark, monkeypatch):
    df = spark.createDataFrame(frame({"hot": walk(5000, 3)}))
    written = []
    monkeypatch.setattr(blocks, "written", lambda local, name, keep=blocks.written: written.append(local) or keep(local, name))
    scanned = blocks.scan(df, "coin_id", "date", "price_usd", {"s": 0.9}, bucket=F.trunc("date", "year"), size=100)
    assert scanned.orderBy("date").select("pos").toPandas()["pos"].tolist() == list(range(5000))
    assert written[0].groupBy("_bucket", "_block").count().agg(F.max("count")).first()[0] <= 100
    rows = blocks.cut(scanned, 300, 512)
    sizes = rows.groupBy("block").count().toPandas()["count"]
    assert sizes.max() <= 812 and len(sizes) >= 10
    assert rows.where("not ghost").count() == 5000


@pytest.mark.parametrize("order", ["date", "stamp", "number"])
def test_orders_of_any_type_without_a_bucket(spark, order):
    """Dates are cut by the calendar, other orders by sampled ranges; sparse blocks and many keys too."""
    parts = {"hot": walk(3000, 5), **{f"k{i}": walk(3 + i * 7, i) for i in range(12)}}
    pdf = frame(parts)
    # years apart: most blocks hold a few rows
    pdf["date"] = pdf.groupby("coin_id").cumcount().map(lambda i: dt.date(1950, 1, 1) + dt.timedelta(days=i * (11 if i % 2 else 7)))
    pdf = pdf.sort_values(["coin_id", "date"]).drop_duplicates(["coin_id", "date"])
    pdf["stamp"] = pd.to_datetime(pdf["date"]) + pd.Timedelta("5h")
    pdf["number"] = pd.to_datetime(pdf["date"]).astype("int64") // 10**9
    df = spark.createDataFrame(pdf).repartition(3)
    for size in (None, 64):
        out = indicators.ema_series(df, "coin_id", order, "price_usd", [12], size=size).join(
            indicators.rsi_series(df, "coin_id", order, "price_usd", size=size).select("coin_id", "date", "rsi"), ["coin_id", "date"]).toPandas()
        out = out.sort_values(["coin_id", "date"]).reset_index(drop=True)
        want = pdf.sort_values(["coin_id", "date"]).reset_index(drop=True)
        ema = want.groupby("coin_id")["price_usd"].transform(lambda x: x.ewm(span=12, adjust=False).mean())
        np.testing.assert_allclose(out["ema_12"], ema, rtol=1e-9)
        step = want.groupby("coin_id")["price_usd"].diff().fillna(0.0)
        up, down = (sign.groupby(want["coin_id"]).transform(lambda x: x.ewm(alpha=1 / 14, adjust=False).mean()) for sign in (step.clip(lower=0), (-step).clip(lower=0)))
        # both averages start at 0, so their quotient is that of the sums
        rsi = (100 - 100 / (1 + up / down.where(down > 0))).where(want.groupby("coin_id").cumcount() >= 13)
        np.testing.assert_allclose(out["rsi"].astype(float), rsi, rtol=1e-7)


@pytest.mark.parametrize("spans,size", [([1], 256), ([2, 3], 256), ([200], 256), ([1, 12, 500], 1024), ([5000], None)])
def test_ema_spans(prices, spans, size):
    pdf, df = prices
    out = indicators.ema_series(df, "coin_id", "date", "price_usd", spans, size=size).toPandas()
    for s in spans:
        want = pdf.assign(**{f"ema_{s}": pdf.groupby("coin_id")["price_usd"].transform(
            lambda x, s=s: x.ewm(span=s, adjust=False).mean())})
        check(out, want[["coin_id", "date", f"ema_{s}"]], [f"ema_{s}"])


def streak(returns):
    last = returns.iloc[-1]
    if pd.isna(last):
        return 0
    n, sign = 0, 1 if last > 0 else -1
    for r in returns[::-1]:
        if pd.isna(r) or r * sign <= 0:
            break
        n += sign
    return n


def points(x):
    """The scoring table, written out from its description."""
    score = 0
    if x["rsi"] < 30: score += 25
    elif x["rsi"] < 40: score += 10
    elif x["rsi"] > 70: score -= 25
    elif x["rsi"] > 60: score -= 10
    score += 15 if x["hist"] > 0 else -15 if x["hist"] < 0 else 0
    score += 10 if x["hist"] > 0 and x["before"] <= 0 else 0
    score += 10 if x["vs20"] > 0 else -10
    score += 10 if x["vs50"] > 0 else -10
    score += 15 if x["pos"] < 0.2 else -15 if x["pos"] > 0.8 else 0
    if x["vol"] > 1.5:
        score += 10 if score > 0 else -10
    return score


def test_latest_snapshot(prices):
    pdf, df = prices
    facts = gold.fact_daily_prices(df)
    got = indicators.snapshots(facts).toPandas().set_index("coin_id")
    assert "walk29" not in got.index and len(got) == len(SERIES) - 1
    raw = indicators.with_signal(indicators.raw_indicators(facts)).toPandas().set_index("coin_id")
    for coin, g in pdf.groupby("coin_id"):
        if len(g) < 30:
            continue
        g = g.reset_index(drop=True)
        e = expected(g)
        end, p = e.iloc[-1], g["price_usd"].iloc[-1]
        returns = g["price_usd"].diff() / g["price_usd"].shift().replace(0, np.nan)
        row, unrounded = got.loc[coin], raw.loc[coin]
        assert row["return_streak"] == streak(returns), coin
        width = end["bb_upper"] - end["bb_lower"]
        pos = (p - end["bb_lower"]) / width if width > 1e-9 else 0.5
        for name, value, default, places in (
            ("rsi_14", end["rsi_14"], 50.0, 2), ("macd_line", end["macd_line"], 0, 6),
            ("macd_signal", end["macd_signal"], 0, 6), ("macd_histogram", end["macd_histogram"], 0, 6),
            ("sma_20", end["sma_20"], p, 2), ("sma_50", end["sma_50"], p, 2), ("bb_upper", end["bb_upper"], p, 2),
            ("volume_ratio", end["volume_ratio"], 1.0, 2), ("bb_position", pos, 0.5, 3),
        ):
            want = default if pd.isna(value) else value
            assert row[name] == pytest.approx(want, abs=1.01 * 10**-places), (coin, name)
        assert unrounded["score"] == points({
            "rsi": end["rsi_14"], "hist": unrounded["macd_histogram"],
            "before": e["macd_histogram"].iloc[-2] if coin != "flat" else 0.0,
            "vs20": p / end["sma_20"] - 1, "vs50": p / end["sma_50"] - 1, "pos": pos, "vol": end["volume_ratio"],
        }), coin
    # no loss at all: no RSI, shown as 50, and no RSI points in the score
    assert got.loc["up", "rsi_14"] == 50.0 and pd.isna(raw.loc["up", "rsi_14"])
    assert got.loc["down", "rsi_14"] == 0.0
    # a flat series stays exactly flat
    assert raw.loc["flat", "macd_line"] == 0 and raw.loc["flat", "macd_histogram"] == 0
    assert got.loc["flat", "bb_position"] == 0.5 and got.loc["flat", "return_streak"] == 0
    assert raw.loc["flat", "score"] == -20


def test_score_edges(spark):
    rows = [(30.0, 0.0), (29.99, 1.0), (40.0, -1.0), (39.99, 0.0), (60.0, 0.0), (60.01, 0.0), (70.0, 0.0), (70.01, 0.0)]
    base = dict(before=1.0, vs20=1.0, vs50=-1.0, pos=0.2, vol=1.5)
    more = [dict(rsi=r, hist=h, **base) for r, h in rows]
    more += [dict(rsi=50.0, hist=0.0, before=0.0, vs20=a, vs50=b, pos=c, vol=v)
             for a in (1.0, 0.0) for b in (1.0, -1.0) for c in (0.19, 0.2, 0.8, 0.81) for v in (1.5, 1.51)]
    more += [dict(rsi=20.0, hist=1.0, before=0.0, vs20=1.0, vs50=1.0, pos=0.1, vol=2.0)]
    df = spark.createDataFrame(pd.DataFrame(more))
    c = F.col
    total = indicators.score(
        c("rsi"), c("hist"), (c("hist") > 0) & (c("before") <= 0), c("vs20"), c("vs50"), c("pos"), c("vol"))
    got = [r[0] for r in df.select(total).collect()]
    assert got == [points(m) for m in more]


def test_missing_inputs_take_no_branch(spark):
    null = F.lit(None).cast("double")
    df = spark.range(1).select(indicators.score(null, null, F.lit(None).cast("boolean"), null, null, null, null).alias("s"))
    assert df.first()["s"] == -20


def test_returns_and_nan(spark):
    df = spark.createDataFrame(
        [("a", 1, 10.0), ("a", 2, 0.0), ("a", 3, 5.0), ("a", 4, 10.0)], "coin_id string, date int, price_usd double")
    got = [r[0] for r in df.select(series.simple_return("price_usd", series.by_time("coin_id", "date"))).collect()]
    assert got == [None, -1.0, None, 1.0]
    prices = frame({"a": walk(40, 1)})
    prices.loc[5, "price_usd"] = np.nan
    kept = indicators.daily_series(spark.createDataFrame(prices))
    assert kept.count() == 39


def test_keep_last_by_ingestion_time(spark):
    t = pd.Timestamp("2024-01-01")
    pdf = pd.DataFrame({
        "coin_id": ["a"] * 3, "date": [DAY] * 3, "price_usd": [1.0, 3.0, 2.0],
        "ingestion_time": [t, t + pd.Timedelta(hours=2), t + pd.Timedelta(hours=1)],
    })
    row = indicators.daily_series(spark.createDataFrame(pdf)).collect()
    assert [r["price_usd"] for r in row] == [3.0]


def test_rsi_after_a_long_flat_stretch(spark):
    """Both decayed sums shrink alike over more than two blocks; their ratio must not change."""
    rng = np.random.default_rng(4)
    price = np.concatenate([100 + np.cumsum(rng.normal(0, 1, 700)), np.zeros(1500)])
    price[700:] = price[699]
    rows = pd.DataFrame({"coin_id": "a", "date": pd.date_range("2000-01-01", periods=len(price)).date, "price_usd": price,
                         "volume_usd": 1.0, "market_cap_usd": 1.0, "daily_return": 0.0})
    df = spark.createDataFrame(rows)
    last = indicators.raw_indicators(df).first()["rsi_14"]
    for out, name in ((indicators.rsi_series(df, "coin_id", "date", "price_usd", size=512), "rsi"),
                      (indicators.rsi_series(df, "coin_id", "date", "price_usd", bucket=F.trunc("date", "year"), size=64), "rsi"),
                      (indicators.indicator_series(df, size=512), "rsi_14")):
        got = {r["date"]: r[name] for r in out.collect()}
        flat = [got[d] for d in rows["date"][700:]]
        assert flat == pytest.approx([last] * len(flat)) and 0 < last < 100


def test_one_row_per_coin_and_date(spark):
    rows = [("a", dt.date(2024, 1, 1) + dt.timedelta(days=i), 100.0 + i % 7) for i in range(40)]
    doubled = rows + [(c, d, p - 50) for c, d, p in rows[::3]]
    one, two = (spark.createDataFrame(r, "coin_id string, date date, price_usd double").withColumns(
        {"volume_usd": F.lit(1.0), "market_cap_usd": F.lit(1.0), "daily_return": F.lit(0.01)}) for r in (rows, doubled))
    assert indicators.snapshots(one).collect() == indicators.snapshots(two).collect()
