"""Summary marts over the recommendations and indicators of one run (SUM-*)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketlake.functions.scalars import defaulted
from marketlake.operators.keyed import top_per_group
from marketlake.session import written

# columns the explorer may sort by
SORTABLE = ["coin_id", "rsi_14", "confidence", "price_usd", "volume_ratio"]
TOP_COLUMNS = ["coin_id", "symbol", "action", "confidence", "risk_level", "reasoning"]


def sentiment(buy: Column, sell: Column) -> Column:
    return F.when(buy > sell * 2, "BULLISH").when(sell > buy * 2, "BEARISH").otherwise("NEUTRAL")


def signal_counts(recs: DataFrame) -> DataFrame:
    """One row: sentiment, counts per action and total (SUM-01, AGG-05).

    ``pos`` is the place of a record in the run; the run's time is that of its
    first record. An empty run gives no row.
    """
    def n(action: str) -> Column:
        return F.count_if(F.col("action") == action).alias(action.lower())

    one = recs.agg(
        n("BUY"), n("SELL"), n("HOLD"), F.count(F.lit(1)).alias("total_coins"),
        F.min_by("generated_at", "pos").alias("generated_at"),
    ).where("total_coins > 0")
    return one.select(
        sentiment(F.col("buy"), F.col("sell")).alias("market_sentiment"),
        "buy", "sell", "hold", "total_coins", "generated_at",
    )


def top_actions(recs: DataFrame, action: str, n: int = 3) -> DataFrame:
    """The most confident records of one action, input order on ties (TOP-06, SUM-04)."""
    top = top_per_group(
        recs.where(F.col("action") == action), ["action"],
        [defaulted("confidence", 0).desc(), F.col("pos")], n,
    )
    return top.select(*TOP_COLUMNS, "rank").orderBy("rank")


def market_summary(recs: DataFrame) -> DataFrame:
    """The whole summary in one row, counts nested and top lists as arrays (SUM-01).

    ``recs`` may be a long computation: it is run once, and its few columns written.
    """
    recs = written(recs.select("generated_at", "pos", *[c for c in TOP_COLUMNS if c != "pos"]), "records")
    top = top_per_group(
        recs.where(F.col("action").isin("BUY", "SELL")), ["action"],
        [defaulted("confidence", 0).desc(), F.col("pos")], 3,
    )
    # at most six rows
    record = F.struct("rank", *TOP_COLUMNS)
    lists = top.agg(*[
        F.array_sort(F.collect_list(F.when(F.col("action") == a, record))).alias(name)
        for a, name in (("BUY", "top_buys"), ("SELL", "top_sells"))
    ])
    packed = lists.select(F.struct("top_buys", "top_sells").alias("tops")).scalar()
    return (
        signal_counts(recs)
        .withColumn("_tops", packed)
        .select(
            "market_sentiment",
            F.struct("buy", "sell", "hold").alias("signal_counts"),
            F.col("_tops.top_buys").alias("top_buys"),
            F.col("_tops.top_sells").alias("top_sells"),
            "total_coins", "generated_at",
        )
    )


def metric(summary: DataFrame, path: str) -> DataFrame:
    """A value by dotted path such as ``signal_counts.buy`` (FLT-10)."""
    return summary.select(F.lit(path).alias("target"), F.col(path).cast("string").alias("value"))


METRICS = ["market_sentiment", "total_coins", "signal_counts.buy", "signal_counts.sell", "signal_counts.hold"]


def metrics(summary: DataFrame) -> DataFrame:
    """Scalar metrics as (target, value) rows (SUM-05)."""
    pairs = F.array(*[
        F.struct(F.lit(m).alias("target"), F.col(m).cast("string").alias("value")) for m in METRICS
    ])
    return summary.select(F.inline(pairs))


def recommendations_table(recs: DataFrame) -> DataFrame:
    """SUM-02."""
    text = ["coin_id", "symbol", "name", "action", "risk_level", "reasoning", "generated_at"]
    return recs.select(
        *[defaulted(c, "").alias(c) for c in text[:4]],
        defaulted("confidence", 0).alias("confidence"),
        *[defaulted(c, "").alias(c) for c in text[4:]],
    )


def indicators_table(snapshots: DataFrame) -> DataFrame:
    """SUM-03."""
    # fixed values: what a missing field is shown as
    defaults = {
        "coin_id": "", "symbol": "", "name": "", "price_usd": 0.0, "rsi_14": 50.0, "macd_line": 0.0,
        "macd_signal": 0.0, "macd_histogram": 0.0, "sma_20": 0.0, "sma_50": 0.0, "bb_position": 0.5,
        "volume_ratio": 1.0, "signal": "neutral", "confidence": 50,
    }
    return snapshots.select(*[defaulted(c, v).alias(c) for c, v in defaults.items()])


def tag_keys(snapshots: DataFrame) -> DataFrame:
    """The tag names with the column type (SUM-06)."""
    spark = snapshots.sparkSession
    return spark.createDataFrame([(c, "string") for c in ("coin_id", "signal")], "text string, type string")


def tag_values(snapshots: DataFrame, recs: DataFrame) -> DataFrame:
    """Distinct coin ids of both tables, then distinct signals (SUM-06, SET-03)."""
    ids = snapshots.select("coin_id").union(recs.select("coin_id"))
    tagged = ids.select(F.lit("coin_id").alias("kind"), F.col("coin_id").alias("text")).union(
        snapshots.select(F.lit("signal"), "signal")
    )
    return tagged.distinct().orderBy("kind", "text")


def health(recs: DataFrame, snapshots: DataFrame) -> DataFrame:
    """Rows loaded per table, in one row (SUM-07)."""
    loaded = snapshots.agg(F.count(F.lit(1)).alias("n")).scalar()
    return recs.agg(F.count(F.lit(1)).alias("recommendations_loaded")).select(
        F.lit("ok").alias("status"), "recommendations_loaded", loaded.alias("indicators_loaded")
    )


def sort_by(df: DataFrame, column: str, allowed: Sequence[str] = SORTABLE) -> DataFrame:
    """User-chosen sort column from an allow-list (TOP-08)."""
    if column not in allowed:
        raise ValueError(f"cannot sort by {column!r}")
    return df.orderBy(F.col(column).asc_nulls_last())


def explore(snapshots: DataFrame, signals: Sequence[str], column: str = "coin_id") -> DataFrame:
    """Indicator explorer: chosen signals, sorted, rounded for display (SUM-08)."""
    numbers = ["price_usd", "rsi_14", "macd_histogram", "sma_20", "sma_50", "bb_position", "volume_ratio"]
    rows = sort_by(snapshots.where(F.col("signal").isin(*signals)), column)
    return rows.select(
        "coin_id", "symbol", "name", *[F.bround(c, 4).alias(c) for c in numbers], "signal", "confidence"
    )


def histogram(df: DataFrame, column: str, bins: int = 20) -> DataFrame:
    """Equal bins over [min, max], the maximum in the last bin, nulls dropped (AGG-07).

    The column is computed once and written. The bounds are a one-row scalar
    subquery over it; the counting is an ordinary partial + final aggregate over
    the bin number. Empty bins give no row.
    """
    value = F.col(column)
    kept = written(df.select(value.alias(column)).where(value.isNotNull()), "values")
    bounds = kept.agg(F.struct(F.min(value).alias("lo"), F.max(value).alias("hi")).alias("b")).scalar()
    width = (F.col("b.hi") - F.col("b.lo")) / bins
    place = F.when(
        F.col("b.hi") > F.col("b.lo"), F.floor((value - F.col("b.lo")) / F.nullif(width, F.lit(0.0)))
    ).otherwise(0)
    return (
        kept.select(value.alias(column), bounds.alias("b"))
        .select("b.lo", "b.hi", F.least(F.lit(bins), place + 1).cast("int").alias("bin"))
        .groupBy("bin", "lo", "hi")
        .agg(F.count(F.lit(1)).alias("n"))
        .select("bin", (F.col("lo") + (F.col("bin") - 1) * (F.col("hi") - F.col("lo")) / bins).alias("bin_start"), "n")
    )


def run_check(snapshots: DataFrame) -> DataFrame:
    """Row count and one sample coin (SUM-09)."""
    first = F.min_by(F.struct("coin_id", "signal", "rsi_14"), "coin_id")
    return snapshots.agg(F.count(F.lit(1)).alias("rows"), first.alias("_s")).select("rows", "_s.*")
