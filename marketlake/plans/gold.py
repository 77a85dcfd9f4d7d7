"""Star schema builds (GLD-01..05)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketlake.functions.scalars import to_int
from marketlake.operators import series
from marketlake.operators.keyed import keep_last, upsert

PRICE_COLUMNS = ["coin_id", "date", "price_usd", "market_cap_usd", "volume_usd"]
FACT_COLUMNS = [
    "date_id", "date", "price_usd", "market_cap_usd", "volume_usd", "daily_return", "coin_id",
]


def dim_coins(markets: DataFrame, order: list[str]) -> DataFrame:
    """Latest market row per coin, coerced rank (GLD-01). Not sorted: see ``ranked``."""
    latest = keep_last(markets.select("id", "name", "symbol", "market_cap_rank", *order), ["id"], order)
    return latest.select(
        F.col("id").alias("coin_id"), "name", "symbol", to_int("market_cap_rank").alias("market_cap_rank")
    )


def ranked(coins: DataFrame, n: int | None = None) -> DataFrame:
    """Coins by rank, unranked ones last (TOP-01, TOP-04)."""
    out = coins.orderBy(F.col("market_cap_rank").asc_nulls_last(), "coin_id")
    return out.limit(n) if n is not None else out


def date_id(date: Column | str) -> Column:
    return F.date_format(date, "yyyyMMdd").cast("int")


def dim_date(prices: DataFrame, date: str = "date") -> DataFrame:
    """One row per date that occurs, no gap fill (GLD-02)."""
    d = F.col("date")
    return prices.select(F.to_date(date).alias("date")).where(d.isNotNull()).distinct().select(
        "date",
        date_id(d).alias("date_id"),
        F.year(d).alias("year"),
        F.month(d).alias("month"),
        F.dayofmonth(d).alias("day"),
        F.date_format(d, "EEEE").alias("day_of_week"),
        F.dayofweek(d).isin(1, 7).alias("is_weekend"),
        F.date_format(d, "MMMM").alias("month_name"),
        F.quarter(d).alias("quarter"),
    )


def daily_prices(chart: DataFrame, order: list[str]) -> DataFrame:
    """One price row per (coin, date): the last by ``order``.

    The grouped aggregate has a map-side partial, so a coin with a third of all
    raw rows reaches the shuffle as at most one row per date and task.
    """
    return keep_last(chart.select(*PRICE_COLUMNS, *order), ["coin_id", "date"], order).select(*PRICE_COLUMNS)


def fact_daily_prices(daily: DataFrame, dates: DataFrame | None = None) -> DataFrame:
    """Daily price facts with the date key and the daily return (GLD-03).

    ``daily`` has one row per (coin, date), so the per-coin window is bounded by
    the calendar. ``dates`` is broadcast: it has one row per calendar date that
    occurs, a few MB for any real history. Without it the key is computed.
    """
    if dates is None:
        keyed = daily.withColumn("date_id", date_id("date"))
    else:
        keyed = daily.join(F.broadcast(dates.select("date", "date_id")), "date", "left")
    w = series.by_time("coin_id", "date")
    return keyed.withColumn("daily_return", series.simple_return("price_usd", w)).select(*FACT_COLUMNS)


def merge_snapshot(daily: DataFrame, snapshot: DataFrame) -> DataFrame:
    """History plus a day's market snapshot, the snapshot winning (SET-02, GLD-04)."""
    return upsert(daily.select(*PRICE_COLUMNS), snapshot.select(*PRICE_COLUMNS), ["coin_id", "date"])


def snapshot_prices(markets: DataFrame, as_of: Column) -> DataFrame:
    """The market feed as price rows of one date."""
    return markets.select(
        F.col("id").alias("coin_id"),
        as_of.alias("date"),
        F.col("current_price").alias("price_usd"),
        F.col("market_cap").alias("market_cap_usd"),
        F.col("total_volume").alias("volume_usd"),
    )


def refresh(
    chart: DataFrame, order: list[str], mode: str = "full", changed: DataFrame | None = None,
) -> DataFrame:
    """Fact rows to write (GLD-05).

    ``full`` gives all coins. ``incremental`` gives all rows of the coins in
    ``changed``, to be written with dynamic partition overwrite on ``coin_id``;
    the other partitions stay untouched, so the table equals a full rebuild.
    """
    return fact_daily_prices(daily_prices(rows_to_build(chart, mode, changed), order))


def rows_to_build(chart: DataFrame, mode: str = "full", changed: DataFrame | None = None) -> DataFrame:
    """The history rows that a build of this mode reads (GLD-05)."""
    if mode == "full":
        return chart
    if mode != "incremental":
        raise ValueError(f"unknown mode {mode!r}")
    if changed is None:
        raise ValueError("incremental needs the changed coins")
    return chart.join(changed.select("coin_id").distinct(), "coin_id", "left_semi")
