"""Candles as a fold over micro-batches, with all state in tables (STR-04..07).

Every micro-batch takes the open candles and the recent trade ids that the batch
before it left, adds its own trades and writes, under its batch id:

* ``table``: candles whose window the watermark has passed, below symbol, date and batch;
* ``late``: trades of windows that were closed before they came;
* ``state``/open, ``state``/seen: candles still open, ids of their trades;
* ``state``/ledger, last: one row of counts, the greatest trade time and the trades in open candles.

A batch that is run again after a failure overwrites what it wrote, so each
trade counts once. Totals are sums over the ledger; the end of a feed is written
from the open candles alone. No landed trade or message is read again for either.

The state holds what is within the lateness of the newest trade, however long the
feed is. A symbol with a third of the trades is a partial aggregate in every task
of a batch, as in ``trades.candles``.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from marketlake.session import remove_folder, shared_folder
from marketlake.sources import tables
from marketlake.sources.bronze import child_folders, delete_folder, path_exists
from marketlake.streaming import trades

OPEN = ("symbol string, window_start timestamp, window_end timestamp, first_at decimal(38,0), open double, high double, low double, "
        "last_at decimal(38,0), close double, volume double, trade_count bigint, closed boolean")
SEEN = "symbol string, trade_id bigint, window_end timestamp"
LEDGER = "received bigint, undecodable bigint, written bigint, late bigint, repeated bigint, candles bigint, newest bigint, left bigint"
COUNTS = ["received", "undecodable", "written", "late", "repeated", "candles"]


def _write(df: DataFrame, path: str, number: int) -> None:
    df.write.mode("overwrite").parquet(f"{path}/batch={number}")


def _read(spark: SparkSession, path: str, number: int, schema: str) -> DataFrame:
    folder = f"{path}/batch={number}"
    if number < 0 or not path_exists(spark, folder):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(folder)


def _instant(micros: int) -> Column:
    return F.timestamp_micros(F.lit(micros))


def _merged(parts: DataFrame) -> DataFrame:
    """Partial candles of equal windows as one."""
    return parts.groupBy("symbol", "window_start", "window_end").agg(
        F.min("first_at").alias("first_at"), F.min_by("open", "first_at").alias("open"), F.max("high").alias("high"), F.min("low").alias("low"),
        F.max("last_at").alias("last_at"), F.max_by("close", "last_at").alias("close"), F.sum("volume").alias("volume"),
        F.sum("trade_count").cast("bigint").alias("trade_count"))


def _fold(batch: DataFrame, number: int, table: str, late: str, state: str, width: str, lateness: str) -> None:
    spark = batch.sparkSession
    before = _read(spark, f"{state}/ledger", number - 1, LEDGER).head()
    newest = before["newest"] if before else None
    delay = int(pd.Timedelta(lateness).total_seconds() * 1_000_000)
    parsed = trades.parse_messages(batch)
    judged = parsed.select("valid", *trades.trade_columns()).withColumn("w", F.window(F.coalesce("trade_time", F.timestamp_micros(F.lit(0))), width)).select(
        "*", F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end")).drop("w")
    known = F.lit(None).cast("timestamp") if newest is None else _instant(newest - delay)
    usable = F.col("valid") & F.col("trade_time").isNotNull() & F.col("price").isNotNull()
    judged = judged.withColumns({"usable": usable, "behind": usable & F.coalesce(F.col("window_end") <= known, F.lit(False))}).persist()
    try:
        counts = judged.agg(*trades.counters(), F.count_if("behind").alias("late"), F.count_if(usable & ~F.col("behind")).alias("in_time"),
                            F.max(F.when(F.col("usable"), F.unix_micros("trade_time"))).alias("newest")).head()
        newest = max((x for x in (newest, counts["newest"]) if x is not None), default=None)
        closing = F.lit(False) if newest is None else F.col("window_end") <= _instant(newest - delay)
        rows = judged.where("usable").drop("valid", "usable")

        seen = _read(spark, f"{state}/seen", number - 1, SEEN)
        ids = seen.select(F.col("symbol").alias("_symbol"), F.col("trade_id").alias("_id"))
        fresh = trades.distinct_trades(rows.where("not behind")).join(
            ids, (F.col("symbol") == F.col("_symbol")) & F.col("trade_id").eqNullSafe(F.col("_id")), "left_anti")
        at = trades.trade_order()
        own = fresh.groupBy("symbol", "window_start", "window_end").agg(
            F.min(at).alias("first_at"), F.min_by("price", at).alias("open"), F.max("price").alias("high"), F.min("price").alias("low"),
            F.max(at).alias("last_at"), F.max_by("price", at).alias("close"), F.sum("quantity").alias("volume"), F.count(F.lit(1)).alias("trade_count"))
        left = _read(spark, f"{state}/open", number - 1, OPEN).where("not closed").drop("closed")
        _write(_merged(left.unionByName(own)).withColumn("closed", closing), f"{state}/open", number)
        if counts["late"] or number == 0:
            _write(rows.where("behind").drop("behind"), late, number)
        _write(seen.unionByName(fresh.select("symbol", "trade_id", "window_end")).where(~closing), f"{state}/seen", number)

        held = _read(spark, f"{state}/open", number, OPEN)
        write_candles(held.where("closed").select(*trades.CANDLE_COLUMNS), table, number)
        made = held.agg(F.coalesce(F.sum("trade_count"), F.lit(0)).alias("trades"), F.count_if("closed").alias("candles"),
                        F.coalesce(F.sum(F.when(~F.col("closed"), F.col("trade_count"))), F.lit(0)).alias("left")).head()
        taken = before["left"] if before else 0
        ledger = [(counts["received"], counts["undecodable"], counts["written"], counts["late"], counts["in_time"] - (made["trades"] - taken),
                   made["candles"], newest, made["left"])]
        # the last write of a batch: what it holds counts from now on
        _write(spark.createDataFrame(ledger, LEDGER).coalesce(1), f"{state}/ledger", number)
    finally:
        judged.unpersist()
    for name in ("open", "seen"):
        delete_folder(spark, f"{state}/{name}/batch={number - 2}")


def fold_candles(
    messages: DataFrame, table: str, late: str, checkpoint: str, width: str = "1 minute", lateness: str = trades.LATENESS,
    bounded: bool = False,
) -> StreamingQuery:
    """Run the fold over a stream of messages; its state lives below ``checkpoint``.

    A window closes once a trade is seen that is ``lateness`` younger than its
    end; copies of a trade are dropped while its window is open.
    """
    def step(batch: DataFrame, number: int) -> None:
        _fold(batch, number, table, late, f"{checkpoint}/state", width, lateness)

    writer = messages.writeStream.foreachBatch(step).option("checkpointLocation", f"{checkpoint}/offsets")
    if bounded:
        return writer.trigger(availableNow=True).start()
    return writer.trigger(processingTime=f"{trades.FLUSH_SECONDS} seconds").start()


def totals(spark: SparkSession, checkpoint: str) -> dict[str, int]:
    """Messages received, undecodable and written, late and repeated trades, candles written: sums of the ledger (STR-05)."""
    path = f"{checkpoint}/state/ledger"
    if not path_exists(spark, path):
        return dict.fromkeys(COUNTS, 0)
    return spark.read.schema(LEDGER).parquet(path).agg(*[F.sum(c).alias(c) for c in COUNTS]).head().asDict()


def open_candles(spark: SparkSession, checkpoint: str) -> DataFrame:
    """The candles that the feed has left open, from the state of its last batch."""
    path = f"{checkpoint}/state/ledger"
    batches = [int(f.removeprefix("batch=")) for f in child_folders(spark, path) if f.startswith("batch=")] if path_exists(spark, path) else []
    last = max(batches, default=-1)
    return _read(spark, f"{checkpoint}/state/open", last, OPEN).where("not closed").select(*trades.CANDLE_COLUMNS)


def flush_candles(spark: SparkSession, checkpoint: str, rest: str) -> None:
    """Write the open candles at the end of a feed to a table of their own (STR-06); a resumed feed closes them itself, delete ``rest`` then."""
    write_candles(open_candles(spark, checkpoint), rest, 0)


def write_candles(candles: DataFrame, table: str, number: int = 0) -> None:
    """Candles below symbol, date and batch: the newest are found by listing, and a batch replaces only itself."""
    laid = candles.withColumns({"date": F.to_date("window_start"), "batch": F.lit(number)})
    tables.write_table(laid, table, ["symbol", "date", "batch"])


def compact_candles(spark: SparkSession, table: str, before: str | None = None) -> int:
    """Fold the batches of each (symbol, date) into one folder; returns how many folders went.

    Only dates before ``before`` if given. Candles are unique by symbol and start,
    so a run that broke off is mended by the next.
    """
    many = {}
    for symbol in child_folders(spark, table):
        for date in child_folders(spark, f"{table}/{symbol}"):
            parts = sorted((f for f in child_folders(spark, f"{table}/{symbol}/{date}") if f.startswith("batch=")), key=lambda f: int(f[6:]))
            if len(parts) > 1 and (before is None or date.removeprefix("date=") < before):
                many[f"{table}/{symbol}/{date}"] = parts
    if not many:
        return 0
    rows = spark.read.schema(f"{trades.CANDLE_SCHEMA}, date date, batch int").option("basePath", table).parquet(*many)
    last = rows.groupBy("symbol", "date").agg(F.max("batch").alias("batch"))
    stage = shared_folder(spark, "compacted")
    tables.write_table(rows.drop("batch").dropDuplicates(["symbol", "window_start"]).join(last, ["symbol", "date"]), stage)
    tables.write_table(spark.read.parquet(stage), table, ["symbol", "date", "batch"])
    for folder, parts in many.items():
        for old in parts[:-1]:
            delete_folder(spark, f"{folder}/{old}")
    remove_folder(spark, stage)
    return sum(len(parts) - 1 for parts in many.values())
