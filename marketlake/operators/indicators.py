"""Technical indicators per series: the latest snapshot and whole series."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marketlake.functions.scalars import missing_as_null, title_case
from marketlake.operators import blocks, series
from marketlake.schemas import SNAPSHOT_FIELDS

# fixed values: indicator periods
RSI_PERIOD = 14
MACD_FAST, MACD_SLOW, MACD_SIGNAL = 12, 26, 9
SMA_SHORT, SMA_LONG = 20, 50
BAND_PERIOD, BAND_WIDTH = 20, 2.0
VOLUME_PERIOD = 20
MIN_HISTORY = 30


def _ema_weight(span: int, power: Column, first: Column) -> Column:
    """Weight of a value in an EMA seeded with the first row.

    ``power`` is (1 - 2/(span+1)) to the number of rows the value lies back.
    """
    return F.when(first, power).otherwise(power * (2.0 / (span + 1)))


def _ema_of_ema_weight(inner: int, outer: int, pk: Column, qk: Column, first: Column) -> Column:
    """Weight of a value in the EMA (span ``outer``) of an EMA (span ``inner``).

    ``pk`` and ``qk`` are the powers of the inner and the outer EMA; the spans differ.
    """
    a, b = 2.0 / (inner + 1), 2.0 / (outer + 1)
    p, q = 1.0 - a, 1.0 - b
    seeded = qk + (qk - pk) * (b * p / (q - p))
    later = (qk * q - pk * p) * (a * b / (q - p))
    return F.when(first, seeded).otherwise(later)


def daily_series(prices: DataFrame) -> DataFrame:
    """One row per (coin, date), missing prices removed (NaN counts as missing).

    Of several rows of a date the last ingested stays, of equals the one with the
    highest price. Tables without ``ingestion_time`` are hashed by coin once, for
    this and all that follows.
    """
    clean = prices.withColumn("price_usd", missing_as_null("price_usd")).where("price_usd IS NOT NULL")
    order = [c for c in ("ingestion_time", "price_usd") if c in prices.columns]
    w = Window.partitionBy("coin_id").orderBy("date", *order)
    following = F.lead("date").over(w)
    return clean.withColumn("_next", following).where(F.col("_next").isNull() | (F.col("_next") != F.col("date"))).drop("_next")


def raw_indicators(facts: DataFrame) -> DataFrame:
    """Unrounded latest indicators, one row per coin; missing values are null.

    Recursive averages are written as weighted sums over the row's distance from
    the end, so everything is one partial + final aggregate per coin. Prices
    enter as the distance from the coin's first price: EMA weights add up to
    one, so this changes nothing but keeps a flat series exactly flat.
    """
    w = series.by_time("coin_id", "date")
    whole = Window.partitionBy("coin_id")
    gain, loss = series.gain_loss("price_usd", w)
    rows = facts.select(
        "coin_id", "date", "price_usd", "market_cap_usd", "volume_usd", "daily_return",
        (F.row_number().over(w) - 1).alias("j"),
        (F.count(F.lit(1)).over(whole) - 1).alias("last"),
        F.first("price_usd").over(w).alias("base"),
        gain.alias("gain"),
        loss.alias("loss"),
    ).where(F.col("last") + 1 >= MIN_HISTORY)

    back = F.col("last") - F.col("j")
    spans = {"_fast": MACD_FAST, "_slow": MACD_SLOW, "_outer": MACD_SIGNAL}
    keep = {name: 1.0 - 2.0 / (span + 1) for name, span in spans.items()}
    # the powers are computed once per row, the weights below only scale them
    rows = rows.withColumns({
        "back": back, "y": F.col("price_usd") - F.col("base"),
        **{name: F.pow(F.lit(k), back) for name, k in keep.items()},
        "_wilder": F.pow(F.lit(1.0 - 1.0 / RSI_PERIOD), back),
    })
    back, first, y = F.col("back"), F.col("j") == 0, F.col("y")

    def power(name: str, earlier: int) -> Column:
        return F.col(name) * (keep[name] ** -earlier)

    def line_weight(earlier: int = 0) -> Column:
        """Weight in the MACD line ``earlier`` rows before the end."""
        return _ema_weight(MACD_FAST, power("_fast", earlier), first) - _ema_weight(
            MACD_SLOW, power("_slow", earlier), first)

    def signal_weight(earlier: int = 0) -> Column:
        outer = power("_outer", earlier)
        return _ema_of_ema_weight(
            MACD_FAST, MACD_SIGNAL, power("_fast", earlier), outer, first
        ) - _ema_of_ema_weight(MACD_SLOW, MACD_SIGNAL, power("_slow", earlier), outer, first)

    def recent(value: str, n: int, agg) -> Column:
        inside = F.when(back < n, F.col(value))
        return F.when(F.count(inside) == n, agg(inside))

    def at_end(value: str) -> Column:
        return F.max(F.when(back == 0, F.col(value)))

    earlier = back >= 1
    r = missing_as_null("daily_return")
    sign = F.when(r > 0, 1).when(r < 0, -1).otherwise(0)
    totals = rows.groupBy("coin_id").agg(
        (F.max("last") + 1).alias("n"),
        F.max("date").alias("date"),
        *[at_end(c).alias(c) for c in ("price_usd", "market_cap_usd", "volume_usd", "daily_return")],
        F.sum(y * line_weight()).alias("macd_line"),
        F.sum(y * signal_weight()).alias("macd_signal"),
        F.sum(F.when(earlier, y * line_weight(1))).alias("_line_before"),
        F.sum(F.when(earlier, y * signal_weight(1))).alias("_signal_before"),
        F.sum(F.col("gain") * F.col("_wilder")).alias("_gain"),
        F.sum(F.col("loss") * F.col("_wilder")).alias("_loss"),
        recent("price_usd", SMA_SHORT, F.avg).alias("sma_20"),
        recent("price_usd", SMA_LONG, F.avg).alias("sma_50"),
        recent("price_usd", BAND_PERIOD, F.avg).alias("bb_middle"),
        recent("price_usd", BAND_PERIOD, F.stddev_samp).alias("_std"),
        recent("volume_usd", VOLUME_PERIOD, F.avg).alias("_volume_mean"),
        F.max(F.when(back == 0, sign)).alias("_sign"),
        *[F.max(F.when(sign == s, F.col("j"))).alias(f"_seen{i}") for i, s in enumerate((-1, 0, 1))],
    )

    rs = F.try_divide(F.col("_gain"), F.nullif(F.col("_loss"), F.lit(0.0)))
    # the streak ends at the last row whose sign differs from the final one
    def other(*seen: str) -> Column:
        return F.coalesce(F.greatest(*[F.coalesce(F.col(s), F.lit(-1)) for s in seen]), F.lit(-1))

    run = F.col("n") - 1
    streak = (
        F.when(F.col("_sign") == 1, run - other("_seen0", "_seen1"))
        .when(F.col("_sign") == -1, -(run - other("_seen1", "_seen2")))
        .otherwise(0)
    )
    return (
        totals.withColumns({
            "macd_histogram": F.col("macd_line") - F.col("macd_signal"),
            "_hist_before": F.col("_line_before") - F.col("_signal_before"),
            "rsi_14": 100 - 100 / (1 + rs),
            "bb_upper": F.col("bb_middle") + BAND_WIDTH * F.col("_std"),
            "bb_lower": F.col("bb_middle") - BAND_WIDTH * F.col("_std"),
            "volume_ratio": F.try_divide(F.col("volume_usd"), F.nullif("_volume_mean", F.lit(0.0))),
            "price_vs_sma20": series.gap_percent("price_usd", "sma_20"),
            "price_vs_sma50": series.gap_percent("price_usd", "sma_50"),
            "return_streak": streak.cast("int"),
        })
        .withColumn("bb_position", series.band_position("price_usd", "bb_lower", "bb_upper"))
        .withColumn("macd_cross", (F.col("macd_histogram") > 0) & (F.col("_hist_before") <= 0))
        .drop("_gain", "_loss", "_std", "_volume_mean", "_line_before", "_signal_before",
              "_sign", "_seen0", "_seen1", "_seen2", "_hist_before")
    )


def score(
    rsi: Column, histogram: Column, cross: Column, vs_short: Column, vs_long: Column,
    band: Column, volume: Column,
) -> Column:
    """Composite score (WIN-15). A missing input takes no branch, or the else branch if there is one."""
    def points(*cases: tuple[Column, int], otherwise: int = 0) -> Column:
        out = F
        for when, value in cases:
            out = out.when(when, value)
        return out.otherwise(otherwise)

    # fixed values: bounds and points of the score
    base = (
        points((rsi < 30, 25), (rsi < 40, 10), (rsi > 70, -25), (rsi > 60, -10))
        + points((histogram > 0, 15), (histogram < 0, -15))
        + points((cross, 10))
        + points((vs_short > 0, 10), otherwise=-10)
        + points((vs_long > 0, 10), otherwise=-10)
        + points((band < 0.2, 15), (band > 0.8, -15))
    )
    return base + points((volume > 1.5, F.when(base > 0, 10).otherwise(-10)))


def with_signal(df: DataFrame) -> DataFrame:
    """Add score, signal and confidence to unrounded indicators."""
    total = score(*[F.col(c) for c in (
        "rsi_14", "macd_histogram", "macd_cross", "price_vs_sma20", "price_vs_sma50",
        "bb_position", "volume_ratio",
    )])
    return (
        df.withColumn("score", total)
        .withColumn("confidence", F.least(F.lit(100), F.greatest(F.lit(0), F.abs("score") + 30)))
        .withColumn(
            "signal",
            F.when(F.col("score") > 15, "bullish").when(F.col("score") < -15, "bearish").otherwise("neutral"),
        )
    )


def snapshots(facts: DataFrame, coins: DataFrame | None = None) -> DataFrame:
    """Latest technical snapshot per coin with defaults and rounding (WIN-16).

    Coins with fewer than 30 rows yield nothing (FIL-06). The coin table is a
    left join without a broadcast hint: it grows with the data, so Spark decides
    by its size.
    """
    latest = with_signal(raw_indicators(daily_series(facts)))
    price = F.col("price_usd")

    def rounded(name: str, places: int, default) -> Column:
        default = default if isinstance(default, Column) else F.lit(default)
        return F.coalesce(F.bround(F.col(name), places), default).alias(name)

    if coins is not None:
        meta = coins.select("coin_id", F.col("symbol").alias("_symbol"), F.col("name").alias("_name"))
        latest = latest.join(meta, "coin_id", "left")
    else:
        latest = latest.withColumns({"_symbol": F.lit(None).cast("string"), "_name": F.lit(None).cast("string")})
    return latest.select(
        "coin_id",
        F.coalesce("_symbol", F.substring("coin_id", 1, 3)).alias("symbol"),
        F.coalesce("_name", title_case("coin_id")).alias("name"),
        "date", "price_usd", "market_cap_usd", "volume_usd", "daily_return",
        rounded("rsi_14", 2, 50.0),
        rounded("macd_line", 6, 0.0),
        rounded("macd_signal", 6, 0.0),
        rounded("macd_histogram", 6, 0.0),
        rounded("sma_20", 2, price),
        rounded("sma_50", 2, price),
        rounded("price_vs_sma20", 2, 0.0),
        rounded("price_vs_sma50", 2, 0.0),
        rounded("bb_upper", 2, price),
        rounded("bb_middle", 2, price),
        rounded("bb_lower", 2, price),
        rounded("bb_position", 3, 0.5),
        rounded("volume_ratio", 2, 1.0),
        "return_streak", "signal", "confidence",
    ).select(*SNAPSHOT_FIELDS)


def ema_series(
    df: DataFrame, key: str, order: str, value: str, spans: list[int], bucket: Column | None = None,
    size: int | None = None,
) -> DataFrame:
    """EMA of a whole series, one column ``ema_<span>`` per span (WIN-07)."""
    keeps = {f"ema_{s}": blocks.ema_keep(s) for s in spans}
    rows = blocks.scan(df, key, order, value, keeps, bucket=bucket, size=size)
    return rows.withColumns({name: F.col("base") + F.col(name) * (1.0 - keep) for name, keep in keeps.items()}).drop("pos", "base")


def _macd_keeps(fast: int, slow: int, signal: int) -> dict[str, float]:
    """The three decayed sums that all MACD columns are made of."""
    if signal in (fast, slow):
        raise ValueError("the span of the signal must differ from the others")
    return {"_fast": blocks.ema_keep(fast), "_slow": blocks.ema_keep(slow), "_outer": blocks.ema_keep(signal)}


def _macd_columns(fast: int, slow: int, signal: int) -> dict[str, Column]:
    """MACD line and signal from the decayed sums.

    The EMA (factor q) of an EMA (factor p) is a mixture of the two decayed sums:
    the powers q**i * p**(age - i) add up to (q**(age+1) - p**(age+1)) / (q - p).
    """
    keeps = _macd_keeps(fast, slow, signal)
    q = keeps["_outer"]

    def nested(name: str) -> Column:
        p = keeps[name]
        return (F.col("_outer") * q - F.col(name) * p) * ((1.0 - p) * (1.0 - q) / (q - p))

    line = F.col("_fast") * (1.0 - keeps["_fast"]) - F.col("_slow") * (1.0 - keeps["_slow"])
    return {"macd_line": line, "macd_signal": nested("_fast") - nested("_slow")}


def _with_macd(rows: DataFrame, fast: int, slow: int, signal: int) -> DataFrame:
    return (rows.withColumns(_macd_columns(fast, slow, signal)).withColumn("macd_histogram", F.col("macd_line") - F.col("macd_signal"))
            .drop("_fast", "_slow", "_outer"))


def macd_series(
    df: DataFrame, key: str, order: str, value: str, fast: int = MACD_FAST, slow: int = MACD_SLOW,
    signal: int = MACD_SIGNAL, bucket: Column | None = None, size: int | None = None,
) -> DataFrame:
    """MACD line, signal line and histogram for every row (WIN-08)."""
    rows = blocks.scan(df, key, order, value, _macd_keeps(fast, slow, signal), bucket=bucket, size=size)
    return _with_macd(rows, fast, slow, signal).drop("pos", "base")


def _rsi(period: int) -> Column:
    rs = F.try_divide(F.col("_gain"), F.nullif(F.col("_loss"), F.lit(0.0)))
    return F.when(F.col("pos") >= period - 1, 100 - 100 / (1 + rs))


def rsi_series(
    df: DataFrame, key: str, order: str, value: str, period: int = RSI_PERIOD,
    bucket: Column | None = None, size: int | None = None,
) -> DataFrame:
    """RSI for every row, null before ``period`` rows or without any loss (WIN-09)."""
    rows = blocks.scan(df, key, order, value, steps={("_gain", "_loss"): blocks.wilder_keep(period)}, bucket=bucket, size=size)
    return rows.withColumn("rsi", _rsi(period)).drop("_gain", "_loss", "pos", "base")


def indicator_series(
    df: DataFrame, key: str = "coin_id", order: str = "date", price: str = "price_usd",
    volume: str = "volume_usd", bucket: Column | None = None, size: int | None = None,
) -> DataFrame:
    """Every indicator for every row of every series (WIN-17).

    Works on series of any length: no window holds more than a block.
    """
    spans = MACD_FAST, MACD_SLOW, MACD_SIGNAL
    rows = blocks.scan(df, key, order, price, _macd_keeps(*spans), {("_gain", "_loss"): blocks.wilder_keep(RSI_PERIOD)}, bucket, size)
    recursive = _with_macd(rows.withColumn("rsi_14", _rsi(RSI_PERIOD)), *spans).drop("_gain", "_loss", "base")
    framed = blocks.cut(recursive, max(SMA_LONG, VOLUME_PERIOD, BAND_PERIOD) - 1, size or blocks.BLOCK)
    w = blocks.in_block(key)
    upper, middle, lower = series.bollinger(price, w, BAND_PERIOD, BAND_WIDTH)
    rolled = framed.withColumns({
        "sma_20": series.sma(price, SMA_SHORT, w),
        "sma_50": series.sma(price, SMA_LONG, w),
        "bb_upper": upper, "bb_middle": middle, "bb_lower": lower,
        "volume_ratio": series.volume_ratio(volume, w, VOLUME_PERIOD),
    })
    return blocks.own_rows(rolled).drop("pos").withColumns({
        "price_vs_sma20": series.gap_percent(price, "sma_20"),
        "price_vs_sma50": series.gap_percent(price, "sma_50"),
        "bb_position": series.band_position(price, "bb_lower", "bb_upper"),
    })
