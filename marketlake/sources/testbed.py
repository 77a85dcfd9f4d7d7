"""The engine's inputs bound to the supplied test tables (see FIXTURES.md)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marketlake.plans import gold

# ingestion order of the raw price rows; unique within (coin, date)
PRICE_ORDER = ["seq"]
# the five coins and five symbols the dashboards follow, the first is the anchor
COINS = ["0", "1", "2", "3", "4"]
SYMBOLS = ["CLICK", "ERROR", "PURCHASE", "SIGNUP", "VIEW"]
AS_OF = "2001-11-04"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def raw_prices(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "lineitem").select(
        F.col("l_suppkey").cast("string").alias("coin_id"),
        F.col("l_shipdate").cast("date").alias("date"),
        (F.col("l_extendedprice") / F.col("l_quantity")).alias("price_usd"),
        (F.col("l_extendedprice") * (1 - F.col("l_discount"))).alias("market_cap_usd"),
        F.col("l_extendedprice").alias("volume_usd"),
        # order, line (1 to 7), part
        ((F.col("l_orderkey") * 8 + F.col("l_linenumber")) * 1048576 + F.col("l_partkey") % 1048576).alias("seq"),
    )


def daily_prices(spark: SparkSession, folder: str) -> DataFrame:
    return gold.daily_prices(raw_prices(spark, folder), PRICE_ORDER)


def facts(spark: SparkSession, folder: str) -> DataFrame:
    return gold.fact_daily_prices(daily_prices(spark, folder))


def coins(spark: SparkSession, folder: str) -> DataFrame:
    """Coin dimension; the rank falls with the balance, negative balances are unranked."""
    cents = F.round(F.col("s_acctbal") * 100).cast("int")
    return table(spark, folder, "supplier").select(
        F.col("s_suppkey").cast("string").alias("coin_id"),
        F.col("s_name").alias("name"),
        F.concat(F.lit("S"), F.col("s_nationkey").cast("string")).alias("symbol"),
        F.when(F.col("s_acctbal") >= 0, F.lit(1_000_000) - cents).alias("market_cap_rank"),
    )


def markets(spark: SparkSession, folder: str) -> DataFrame:
    """Market snapshots: one row per order, several per customer."""
    orders, customer = table(spark, folder, "orders"), table(spark, folder, "customer")
    return orders.join(customer, orders.o_custkey == customer.c_custkey).select(
        F.col("o_custkey").cast("string").alias("id"),
        F.col("c_mktsegment").alias("symbol"),
        F.col("c_name").alias("name"),
        F.col("o_totalprice").alias("current_price"),
        (F.col("o_totalprice") * 10).alias("market_cap"),
        F.when(F.col("o_orderstatus") == "P", "n/a").otherwise(F.col("o_orderkey").cast("string")).alias(
            "market_cap_rank"
        ),
        F.col("c_acctbal").alias("total_volume"),
        F.col("o_orderdate").cast("timestamp").alias("ingestion_time"),
        F.col("o_orderkey"),
    )


MARKET_ORDER = ["ingestion_time", "o_orderkey"]


def trades(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "events").select(
        F.upper("event_type").alias("symbol"),
        F.col("event_id").alias("trade_id"),
        F.col("ts").cast("timestamp").alias("trade_time"),
        F.col("value").alias("price"),
        F.get_json_object("props", "$.k").cast("double").alias("quantity"),
    )


def trade_messages(spark: SparkSession, folder: str) -> DataFrame:
    """The trades as the JSON text a feed would deliver, numbers as text where it does so."""
    t = trades(spark, folder)
    ms = F.unix_millis("trade_time")
    data = F.struct(
        F.lit("trade").alias("e"), ms.alias("E"), F.col("symbol").alias("s"), F.col("trade_id").alias("t"),
        F.col("price").cast("string").alias("p"), F.col("quantity").cast("string").alias("q"),
        ms.alias("T"), (F.col("trade_id") % 2 == 0).alias("m"),
    )
    stream = F.concat(F.lower("symbol"), F.lit("@trade"))
    return t.select(F.to_json(F.struct(stream.alias("stream"), data.alias("data"))).alias("value"))


def vectors(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "embeddings").select(
        F.col("vec_id").cast("string").alias("id"),
        F.col("embedding").cast("array<double>").alias("embedding"),
        F.col("label").cast("string").alias("coin_id"),
    )


# ---- responses as the feeds deliver them ----------------------------------
# Bodies are grouped by a range of unique order keys or by coin and calendar
# day, so a body is bounded whatever the data size.

PAGE_KEYS = 20_000


def market_pages(spark: SparkSession, folder: str) -> DataFrame:
    """Market pages: one JSON array per month and order-key range."""
    m = markets(spark, folder).withColumn("date", F.trunc("ingestion_time", "month"))
    record = F.struct("id", "symbol", "name", "current_price", "market_cap", "market_cap_rank", "total_volume")
    page = F.floor(F.col("o_orderkey") / PAGE_KEYS)
    grouped = m.groupBy("date", page.alias("page")).agg(
        F.array_sort(F.collect_list(F.struct("o_orderkey", record.alias("r")))).alias("rows")
    )
    body = F.to_json(F.transform("rows", lambda x: x["r"]))
    return grouped.select("date", "page", body.alias("value"))


def chart_bodies(spark: SparkSession, folder: str) -> DataFrame:
    """One price-history object per coin; volumes of coin 0 and 1 lack the last entry."""
    ms = F.unix_millis(F.col("date").cast("timestamp")).cast("double")
    grouped = daily_prices(spark, folder).groupBy("coin_id").agg(
        F.array_sort(F.collect_list(F.struct(ms.alias("t"), "price_usd", "market_cap_usd", "volume_usd"))).alias("p")
    )
    def pairs(name):
        return F.transform("p", lambda x: F.array(x["t"], x[name]))
    volumes = pairs("volume_usd")
    short = F.when(
        F.col("coin_id").isin("0", "1"), F.slice(volumes, F.lit(1), F.size("p") - 1)
    ).otherwise(volumes)
    body = F.to_json(F.struct(
        pairs("price_usd").alias("prices"), pairs("market_cap_usd").alias("market_caps"),
        short.alias("total_volumes"),
    ))
    return grouped.select("coin_id", F.lit("2001-12-01").alias("fetched"), body.alias("value"))


def candle_bodies(spark: SparkSession, folder: str) -> DataFrame:
    """One bare array of [ms, open, high, low, close] per coin."""
    ms = F.unix_millis(F.col("date").cast("timestamp")).cast("double")
    p = F.col("price_usd")
    candle = F.array(ms, p, p + 1, p - 1, p + 0.5)
    grouped = daily_prices(spark, folder).groupBy("coin_id").agg(
        F.array_sort(F.collect_list(candle)).alias("c")
    )
    return grouped.select("coin_id", F.lit("2001-12-01").alias("fetched"), F.to_json("c").alias("value"))


def exchange_pages(spark: SparkSession, folder: str) -> DataFrame:
    """Exchange pages with a nested object: suppliers, per range of keys."""
    s = table(spark, folder, "supplier")
    record = F.struct(
        F.col("s_suppkey").cast("string").alias("id"), F.col("s_name").alias("name"),
        F.struct(
            F.col("s_nationkey").cast("bigint").alias("score"), (F.col("s_suppkey") % 7).alias("rank")
        ).alias("trust"),
    )
    grouped = s.groupBy(F.floor(F.col("s_suppkey") / 250).alias("page")).agg(
        F.array_sort(F.collect_list(F.struct("s_suppkey", record.alias("r")))).alias("rows")
    )
    return grouped.select(
        F.lit("2001-12-01").alias("date"), "page", F.to_json(F.transform("rows", lambda x: x["r"])).alias("value"))


def global_bodies(spark: SparkSession, folder: str) -> DataFrame:
    """One wrapped object per order month with nested currency objects."""
    o = table(spark, folder, "orders")
    grouped = o.groupBy(F.trunc("o_orderdate", "month").alias("date")).agg(
        F.count("*").alias("active"), F.max("o_totalprice").alias("top"), F.min("o_totalprice").alias("low"))
    body = F.to_json(F.struct(F.struct(
        F.col("active").alias("active_coins"), F.col("top").alias("top_price"),
        F.struct(F.col("top").alias("usd"), F.col("low").alias("eur")).alias("total_market_cap"),
    ).alias("data")))
    return grouped.select("date", body.alias("value"))


GLOBAL_SCHEMA = "active_coins bigint, top_price double, total_market_cap struct<usd:double,eur:double>"
