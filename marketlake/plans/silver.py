"""Bronze responses to silver tables, one builder per feed (GLD-06)."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marketlake import schemas
from marketlake.functions import flatten
from marketlake.operators.keyed import keep_first, keep_last
from marketlake.session import written
from marketlake.sources import bronze, tables


def _clock(ingestion_time: Column | None) -> Column:
    return ingestion_time if ingestion_time is not None else F.current_timestamp()


def markets(spark: SparkSession, path: str, ingestion_time: Column | None = None, schema: T.StructType = schemas.MARKET) -> DataFrame:
    """All pages of every date, nested fields dotted; partition ``snapshot_date``.

    ``file_path`` and ``pos`` stay: only they tell which of two rows of a coin,
    converted by the same run, was fetched later.
    """
    rows = bronze.read_records(spark, path, schema).withColumn("snapshot_date", bronze.fetch_date())
    return flatten.flatten_records(rows, _clock(ingestion_time))


def global_market(spark: SparkSession, path: str, inner: T.StructType, ingestion_time: Column | None = None) -> DataFrame:
    """One row of plain fields per response; partition ``snapshot_date`` is the fetch date.

    A response without the ``data`` wrapper is taken as the object itself.
    """
    both = T.StructType([T.StructField("data", inner), *inner.fields])
    rows = bronze.read_objects(spark, path, both)
    wrapped = F.col("data").isNotNull()
    fields = [
        F.when(wrapped, F.col("data")[f.name]).otherwise(F.col(f"`{f.name}`")).alias(f.name) for f in inner.fields
    ]
    flat = flatten.flatten_wrapped(rows.select(*fields, "file_path"), _clock(ingestion_time))
    return flat.withColumn("snapshot_date", bronze.fetch_date()).drop("file_path")


def _numbered(spark: SparkSession, path: str, rows: DataFrame) -> DataFrame:
    """Add ``file_no``, the place of a response among those of its id by path.

    The places come from a listing alone: no content is read for them. Only files
    behind the first of their id are looked up, in a table whose size is known:
    where they are few, the content of the responses is not shuffled.
    """
    order = Window.partitionBy(bronze.dataset_folder()).orderBy("file_path")
    listed = bronze.list_files(spark, path).withColumn("file_no", F.row_number().over(order).cast("bigint"))
    later = written(listed.where("file_no > 1"), "later")
    return rows.join(later, "file_path", "left").withColumn("file_no", F.coalesce("file_no", F.lit(1).cast("bigint")))


def _first_copy(flat: DataFrame, keys: list[str]) -> DataFrame:
    """The first row of each key by file and place: one number, so a hash aggregate without a sort."""
    at = F.col("file_no") * F.lit(1 << 32) + F.col("pos")
    return keep_first(flat.withColumn("_at", at).drop("file_no", "pos"), keys, ["_at"]).drop("_at")


def market_chart(spark: SparkSession, path: str, ingestion_time: Column | None = None) -> DataFrame:
    """Price history per coin, first copy of a (coin, timestamp) kept; partition ``coin_id``."""
    rows = bronze.read_objects(spark, path, schemas.MARKET_CHART).withColumn("coin_id", bronze.dataset_folder())
    flat = flatten.flatten_chart(_numbered(spark, path, rows), ["coin_id", "file_no"], _clock(ingestion_time))
    return _first_copy(flat, ["coin_id", "timestamp"])


def ohlc(spark: SparkSession, path: str, ingestion_time: Column | None = None) -> DataFrame:
    """Candles per coin, first copy kept; partition ``coin_id``."""
    rows = bronze.read_arrays(spark, path).withColumn("coin_id", bronze.dataset_folder())
    flat = flatten.flatten_candles(_numbered(spark, path, rows), "items", ["coin_id", "file_no"], _clock(ingestion_time))
    return _first_copy(flat, ["coin_id", "timestamp"])


def exchanges(spark: SparkSession, path: str, ingestion_time: Column | None = None, schema: T.StructType = schemas.EXCHANGE) -> DataFrame:
    """Latest copy of an exchange per fetch date; partition ``snapshot_date``."""
    rows = bronze.read_records(spark, path, schema).withColumn("snapshot_date", bronze.fetch_date())
    flat = flatten.flatten_records(rows, _clock(ingestion_time))
    return keep_last(flat, ["id", "snapshot_date"], ["file_path", "pos"]).drop("file_path", "pos")


@dataclass(frozen=True)
class Feed:
    name: str
    partition: str


FEEDS = [
    Feed("markets", "snapshot_date"),
    Feed("global_market", "snapshot_date"),
    Feed("market_chart", "coin_id"),
    Feed("ohlc", "coin_id"),
    Feed("exchanges", "snapshot_date"),
]


def convert_all(
    spark: SparkSession, raw: str, out: str, global_schema: T.StructType, ingestion_time: Column | None = None,
    groups: int | None = None,
) -> list[str]:
    """Convert every feed that has raw data; re-running gives the same tables.

    Returns the names of the feeds written. A feed without raw data is skipped.
    Feeds by coin have a folder a coin, or with ``groups`` that many folders of
    coins, for many thousands of coins.
    """
    build = {
        "markets": lambda p: markets(spark, p, ingestion_time),
        "global_market": lambda p: global_market(spark, p, global_schema, ingestion_time),
        "market_chart": lambda p: market_chart(spark, p, ingestion_time),
        "ohlc": lambda p: ohlc(spark, p, ingestion_time),
        "exchanges": lambda p: exchanges(spark, p, ingestion_time),
    }
    written = []
    for feed in FEEDS:
        path = f"{raw}/{feed.name}"
        if bronze.path_exists(spark, path):
            rows, folder = build[feed.name](path), f"{out}/{feed.name}"
            if groups and feed.partition == "coin_id":
                tables.write_grouped(rows, folder, feed.partition, groups)
            else:
                tables.write_silver(rows, folder, feed.partition)
            written.append(feed.name)
    return written
