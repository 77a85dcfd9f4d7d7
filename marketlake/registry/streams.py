"""Streaming jobs run over files until the input is drained (STR-*)."""

from pyspark.sql import functions as F

from marketlake.registry.core import query, sql
from marketlake.session import shared_folder
from marketlake.sources import testbed
from marketlake.streaming import fold, trades

CANDLES = "open double, high double, low double, close double, volume double, trade_count bigint, " \
          "window_start timestamp, window_end timestamp, symbol string"


def messages(spark, d, extra=None):
    """A stream of the message files in the shared folder."""
    path = shared_folder(spark, "messages")
    text = testbed.trade_messages(spark, d)
    (text if extra is None else text.union(extra)).write.text(path)
    return trades.read_messages(spark, path)


def drain(job):
    job.awaitTermination()


BAD = ["{broken", "[1]", "nope"]


def land_all(spark, d):
    """Both folders of a drained run with some undecodable messages, and what they hold."""
    bronze, bad = shared_folder(spark, "bronze"), shared_folder(spark, "undecodable")
    feed = messages(spark, d, spark.createDataFrame([(m,) for m in BAD], "value string"))
    drain(trades.land_bronze(feed, bronze, shared_folder(spark, "offsets"), bounded=True))
    drain(trades.land_undecodable(feed, bad, shared_folder(spark, "offsets"), bounded=True))
    return bronze, bad, trades.landed(spark, bronze, bad)


@query("str_03_bronze_by_symbol", sql("""
SELECT lower(symbol) AS symbol, CAST(trade_time AS DATE) AS "date", trade_id FROM trades""", "trades"))
def bronze_by_symbol(spark, d):
    out = shared_folder(spark, "bronze")
    drain(trades.land_bronze(messages(spark, d), out, shared_folder(spark, "offsets"), bounded=True))
    rows = spark.read.schema("value string, symbol string, date string").text(out)
    return rows.select("symbol", F.col("date").cast("date").alias("date"), F.get_json_object("value", "$.t").cast("bigint").alias("trade_id"))


@query("str_04_stream_candles", sql("""
SELECT c.symbol, c.window_start, c.window_end, c."open", c.high, c.low, c."close", c.volume, c.trade_count FROM candles c""", "candles"))
def stream_candles(spark, d):
    # the windows the watermark has closed, then those left open at the end of the feed, from the state
    table, _, checkpoint = folded(spark, messages(spark, d))
    rest = shared_folder(spark, "open")
    fold.flush_candles(spark, checkpoint, rest)
    both = spark.read.schema(trades.CANDLE_SCHEMA).parquet(table).unionByName(spark.read.schema(trades.CANDLE_SCHEMA).parquet(rest))
    return both.select(*trades.CANDLE_COLUMNS)


def folded(spark, *feeds):
    """The folders of a candle job that is run once for each of the feeds, one after another."""
    table, late, checkpoint = (shared_folder(spark, name) for name in ("candles", "late", "fold"))
    for feed in feeds:
        drain(fold.fold_candles(feed, table, late, checkpoint, bounded=True))
    return table, late, checkpoint


def two_runs(spark, d):
    """The whole feed with some undecodable messages; then, after a restart, the first day once more under new ids."""
    path = shared_folder(spark, "messages")
    text = testbed.trade_messages(spark, d)
    text.union(spark.createDataFrame([(m,) for m in BAD], "value string")).write.text(f"{path}/first")
    feed = trades.read_messages(spark, path)
    table, late, checkpoint = folded(spark, feed)
    number = F.get_json_object("value", "$.data.t")
    day = F.timestamp_millis(F.get_json_object("value", "$.data.T").cast("bigint")) < "2024-01-02"
    again = text.where(day).select(F.replace("value", F.concat(F.lit('"t":'), number), F.concat(F.lit('"t":9'), number)).alias("value"))
    again.write.text(f"{path}/second")
    drain(fold.fold_candles(trades.read_messages(spark, path), table, late, checkpoint, bounded=True))
    return late, checkpoint


@query("str_05_ledger", sql("""
SELECT count(*) + 3 + count(*) FILTER (trade_time < '2024-01-02') AS received, CAST(3 AS BIGINT) AS undecodable,
  count(*) + count(*) FILTER (trade_time < '2024-01-02') AS written, count(*) FILTER (trade_time < '2024-01-02') AS late,
  CAST(0 AS BIGINT) AS repeated FROM trades""", "trades"))
def ledger(spark, d):
    _, checkpoint = two_runs(spark, d)
    sums = fold.totals(spark, checkpoint)
    names = ["received", "undecodable", "written", "late", "repeated"]
    return spark.createDataFrame([tuple(sums[n] for n in names)], ", ".join(f"{n} bigint" for n in names))


@query("str_07_late_trades", sql("""
SELECT symbol, count(*) AS late, sum(quantity) AS quantity FROM trades WHERE trade_time < '2024-01-02' GROUP BY symbol""", "trades"))
def late_trades(spark, d):
    late, _ = two_runs(spark, d)
    return spark.read.parquet(late).groupBy("symbol").agg(F.count("*").alias("late"), F.sum("quantity").alias("quantity"))


@query("str_05_counters", sql("SELECT count(*) + 3 AS received, count(*) AS written, CAST(3 AS BIGINT) AS undecodable FROM trades", "trades"))
def counters(spark, d):
    totals = land_all(spark, d)[2]
    return spark.createDataFrame([tuple(totals.values())], ", ".join(f"{k} bigint" for k in totals))


@query("str_06_bounded_run", sql("""
SELECT 'undecodable' AS folder, message, CAST(1 AS BIGINT) AS n FROM (VALUES ('{broken'), ('[1]'), ('nope')) v(message)
UNION ALL SELECT 'bronze', lower(symbol), count(*) FROM trades GROUP BY symbol""", "trades"))
def bounded_run(spark, d):
    bronze, bad, _ = land_all(spark, d)
    rows = spark.read.schema("value string, symbol string, date string").text(bronze)
    return (
        spark.read.schema("value string").text(bad).groupBy(F.col("value").alias("message")).agg(F.count("*").alias("n"))
        .select(F.lit("undecodable").alias("folder"), "message", "n")
        .unionByName(rows.groupBy(F.col("symbol").alias("message")).agg(F.count("*").alias("n")).select(
            F.lit("bronze").alias("folder"), "message", "n"))
    )


@query("str_02_flush_files", sql("""
SELECT lower(symbol) AS symbol, count(*) AS n, true AS bounded FROM trades GROUP BY symbol""", "trades"))
def flush_files(spark, d):
    out = shared_folder(spark, "flushed")
    drain(trades.land_bronze(messages(spark, d), out, shared_folder(spark, "offsets"), bounded=True))
    rows = spark.read.schema("value string, symbol string, date string").text(out)
    per_file = rows.groupBy("symbol", F.col("_metadata.file_path").alias("file")).agg(F.count("*").alias("n"))
    return per_file.groupBy("symbol").agg(
        F.sum("n").alias("n"), (F.max("n") <= trades.FLUSH_ROWS).alias("bounded"))
