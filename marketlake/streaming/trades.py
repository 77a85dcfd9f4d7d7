"""Trade feed: parsing, bronze landing and one-minute candles (STR-*, SRC-09).

Every transformation takes a batch or a streaming DataFrame. Jobs read with
``readStream`` and are restartable: offsets and state live in the checkpoint
folder the caller names.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from marketlake import schemas
from marketlake.functions.scalars import epoch_ms
from marketlake.operators.keyed import keep_first
from marketlake.sources.bronze import path_exists

# fixed values: flush every 10 s or 500 messages
FLUSH_SECONDS = 10
FLUSH_ROWS = 500
LATENESS = "2 minutes"
CANDLE_SCHEMA = ("open double, high double, low double, close double, volume double, trade_count bigint, window_start timestamp, "
                 "window_end timestamp, symbol string")
CANDLE_COLUMNS = ["open", "high", "low", "close", "volume", "trade_count", "window_start", "window_end", "symbol"]


def read_messages(spark: SparkSession, folder: str, files_per_trigger: int | None = None) -> DataFrame:
    """Stream of raw message text, one message per line (any text source has this shape)."""
    reader = spark.readStream.format("text").option("recursiveFileLookup", "true")
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.load(folder)


def parse_messages(messages: DataFrame, value: str = "value") -> DataFrame:
    """Unwrap the envelope; ``valid`` is false for text that is not JSON.

    A message without ``data`` is kept as an empty trade.
    """
    parsed = F.from_json(F.col(value), schemas.TRADE_MESSAGE, {"allowSingleQuotes": "false"})
    return messages.select(
        F.col(value).alias("message"),
        # null for text that is no JSON object
        F.json_object_keys(value).isNotNull().alias("valid"),
        F.coalesce(parsed["data"], F.create_map().cast("map<string,string>")).alias("data"),
    )


def _field(name: str) -> Column:
    return F.try_element_at(F.col("data"), F.lit(name))


def bronze_trades(parsed: DataFrame) -> DataFrame:
    """Trade objects untouched, as text, with the folder columns (STR-03)."""
    return parsed.where("valid").select(
        F.coalesce(F.get_json_object("message", "$.data"), F.lit("{}")).alias("value"),
        F.coalesce(F.lower(_field("s")), F.lit("unknown")).alias("symbol"),
        F.to_date(epoch_ms(_field("T").try_cast("bigint"))).alias("date"),
    )


def quarantine(parsed: DataFrame) -> DataFrame:
    """Messages that could not be decoded."""
    return parsed.where(~F.col("valid")).select("message")


def normalise(parsed: DataFrame) -> DataFrame:
    """Typed trades: upper-case symbol, event time, numbers from text (STR-01)."""
    return parsed.where("valid").select(*trade_columns())


def trade_columns() -> list[Column]:
    return [
        F.upper(F.coalesce(_field("s"), F.lit("unknown"))).alias("symbol"),
        _field("t").try_cast("bigint").alias("trade_id"),
        epoch_ms(_field("T").try_cast("bigint")).alias("trade_time"),
        _field("p").try_cast("double").alias("price"),
        _field("q").try_cast("double").alias("quantity"),
    ]


def distinct_trades(trades: DataFrame, lateness: str = LATENESS) -> DataFrame:
    """One row per (symbol, trade id) (STR-07); in a stream within the watermark."""
    keys = ["symbol", "trade_id"]
    if trades.isStreaming:
        return trades.withWatermark("trade_time", lateness).dropDuplicatesWithinWatermark(keys)
    # of differing copies the earliest, as in a stream read in time order; trades without a time stay
    return keep_first(trades.withColumn("_at", F.coalesce(F.unix_micros("trade_time"), F.lit(0))), keys, ["_at"]).select(*trades.columns)


def trade_order() -> Column:
    """(time, id) of a trade as one number."""
    micros = F.unix_micros("trade_time").cast("decimal(17,0)")
    number = F.coalesce("trade_id", F.lit(0)).cast("decimal(19,0)")
    return (micros * F.lit(Decimal(10**19)) + number).cast("decimal(38,0)")


def candles(trades: DataFrame, width: str = "1 minute", quote_volume: bool = False) -> DataFrame:
    """Tumbling OHLCV per symbol (STR-04, AGG-16).

    Open and close are the first and last trade by (time, id), which are packed
    into one number: fixed-width buffers make this a hash aggregate, where a
    struct would force every task to sort its trades. The map-side partial
    reduces a symbol with a third of the trades to one row per task and window
    before the shuffle.
    """
    at = trade_order()
    sums = [F.sum("quantity").alias("volume")]
    if quote_volume:
        sums.append(F.sum(F.col("price") * F.col("quantity")).alias("quote_volume"))
    grouped = (
        trades.where("trade_time IS NOT NULL AND price IS NOT NULL")
        .groupBy("symbol", F.window("trade_time", width).alias("w"))
        .agg(
            F.min_by("price", at).alias("open"),
            F.max("price").alias("high"),
            F.min("price").alias("low"),
            F.max_by("price", at).alias("close"),
            *sums,
            F.count(F.lit(1)).alias("trade_count"),
        )
    )
    names = ["open", "high", "low", "close", "volume", *(["quote_volume"] if quote_volume else []), "trade_count"]
    return grouped.select(
        *names, F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), "symbol"
    )


def late_counts(trades: DataFrame, stored: DataFrame, width: str = "1 minute") -> DataFrame:
    """Trades of finished candles that came too late to be in them: symbol, window_start, late.

    ``trades`` is a batch of all trades landed (they are in bronze whatever became
    of them), ``stored`` the candle table.
    """
    all_ = candles(distinct_trades(trades), width).select("symbol", "window_start", F.col("trade_count").alias("_all"))
    return (
        all_.join(stored.select("symbol", "window_start", "trade_count"), ["symbol", "window_start"])
        .where("_all > trade_count")
        .select("symbol", "window_start", (F.col("_all") - F.col("trade_count")).alias("late"))
    )


def _write(
    df: DataFrame, path: str, checkpoint: str, partitions: list[str], form: str, bounded: bool, rows_per_file: int = 0,
) -> StreamingQuery:
    writer = (
        df.writeStream.format(form)
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .option("maxRecordsPerFile", rows_per_file)
        .outputMode("append")
    )
    if partitions:
        writer = writer.partitionBy(*partitions)
    if bounded:
        writer = writer.trigger(availableNow=True)
    else:
        writer = writer.trigger(processingTime=f"{FLUSH_SECONDS} seconds")
    return writer.start()


def land_bronze(
    messages: DataFrame, path: str, checkpoint: str, bounded: bool = False, rows_per_file: int = FLUSH_ROWS,
) -> StreamingQuery:
    """Write raw trades per symbol and date every 10 s, at most ``rows_per_file`` rows per file (STR-02, STR-03).

    ``bounded`` drains what is there and stops (STR-06); otherwise the caller
    ends the run with ``awaitTermination(seconds)`` and ``stop()``. The default
    file size suits a small feed; give millions of rows (0: no limit) for a large one.
    """
    return _write(
        bronze_trades(parse_messages(messages)), path, checkpoint, ["symbol", "date"], "text", bounded, rows_per_file)


def land_undecodable(messages: DataFrame, path: str, checkpoint: str, bounded: bool = False) -> StreamingQuery:
    """Write the messages that ``land_bronze`` cannot decode to a folder of their own (SRC-09)."""
    return _write(quarantine(parse_messages(messages)), path, checkpoint, [], "text", bounded)


def land_candles(
    trades: DataFrame, path: str, checkpoint: str, width: str = "1 minute", lateness: str = LATENESS,
    bounded: bool = False,
) -> StreamingQuery:
    """Append finished candles to a table folder partitioned by symbol (STR-04).

    A window is written once the watermark has passed it: a bounded run keeps the
    windows of the last ``lateness`` in its state for the next run over the same
    checkpoint. ``finish_candles`` writes them at the end of a feed; trades behind
    the watermark are in bronze and counted by ``late_counts``.
    """
    out = candles(distinct_trades(trades, lateness), width)
    return _write(out, path, checkpoint, ["symbol"], "parquet", bounded)


def counters() -> list[Column]:
    """Received, undecodable and written messages of a parsed feed."""
    return [
        F.count(F.lit(1)).alias("received"),
        F.count_if(~F.col("valid")).alias("undecodable"),
        F.count_if(F.col("valid")).alias("written"),
    ]


def counted(messages: DataFrame, name: str = "trades") -> tuple[DataFrame, Observation | None]:
    """Parse and attach the counters (STR-05).

    In a stream they appear in each progress report under ``name``; in a batch
    the returned observation holds them.
    """
    parsed = parse_messages(messages)
    if messages.isStreaming:
        return parsed.observe(name, *counters()), None
    seen = Observation(name)
    return parsed.observe(seen, *counters()), seen


def landed(spark: SparkSession, bronze: str, undecodable: str) -> dict[str, int]:
    """Messages received, written and undecodable, counted in the folders themselves (STR-05, STR-06).

    Exact for any number of triggers, runs and restarts: a file counts once the
    sink has committed it.
    """
    def rows(path: str) -> int:
        if not path_exists(spark, path):
            return 0
        # the sink's log, which batch reads follow, names the committed files
        return spark.read.schema("value string").text(path).count()

    written, bad = rows(bronze), rows(undecodable)
    return {"received": written + bad, "written": written, "undecodable": bad}


def finish_candles(trades: DataFrame, path: str, rest: str, width: str = "1 minute") -> None:
    """Write the candles whose windows no watermark has closed (the final flush of STR-06).

    ``trades`` is a batch of all trades landed, ``path`` the stream's table. The
    candles go to a table of their own, ``rest``: readers of a stream's folder see
    what the stream has committed only. A resumed stream writes these windows to
    ``path`` after all; delete ``rest`` then.
    """
    spark = trades.sparkSession
    out = candles(distinct_trades(trades), width)
    if path_exists(spark, path):
        known = spark.read.schema("symbol string, window_start timestamp").parquet(path)
        out = out.join(known, ["symbol", "window_start"], "left_anti")
    out.select(*CANDLE_COLUMNS).write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy("symbol").parquet(rest)
