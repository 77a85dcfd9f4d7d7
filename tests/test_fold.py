"""The candle fold: batch parity, copies, late trades, restart and repeated batches, totals, flush, compaction, newest folders."""

import pytest
from pyspark.sql import functions as F
from test_streaming import MINUTE, START, candle_rows, feed, message, parsed, put

from marketlake.plans import dashboards
from marketlake.sources import tables
from marketlake.sources.bronze import child_folders
from marketlake.streaming import fold, trades


@pytest.fixture
def job(spark, tmp_path):
    class Job:
        src, table, late, checkpoint = (str(tmp_path / n) for n in ("in", "table", "late", "cp"))

        def run(self, lateness="2 minutes"):
            stream = trades.read_messages(spark, self.src, files_per_trigger=1)
            fold.fold_candles(stream, self.table, self.late, self.checkpoint, lateness=lateness, bounded=True).awaitTermination()

        def put(self, name, messages):
            put(tmp_path / "in", name, messages)

        def closed(self):
            return spark.read.schema(trades.CANDLE_SCHEMA).parquet(self.table)

    return Job()


def test_equals_batch_with_copies_and_restart(spark, job):
    all_ = feed()
    job.put("a.json", all_[:120])
    job.run()
    first = job.closed().count()
    # the second run starts from the state; a part of the first file is replayed
    job.put("b.json", [*all_[60:], "{broken", '{"stream": "x"}'])
    job.run()
    batch = trades.candles(trades.distinct_trades(parsed(spark.createDataFrame([(m,) for m in all_], "value string"))))
    rest = f"{job.checkpoint}-rest"
    fold.flush_candles(spark, job.checkpoint, rest)
    got = job.closed().select(*trades.CANDLE_COLUMNS).union(spark.read.schema(trades.CANDLE_SCHEMA).parquet(rest).select(*trades.CANDLE_COLUMNS))
    assert 0 < first < job.closed().count() < got.count()
    # copies of trades whose window is closed are late, the others are dropped
    late = spark.read.parquet(job.late).count()
    sums = fold.totals(spark, job.checkpoint)
    assert candle_rows(got) == candle_rows(batch)
    assert sums == {"received": 362, "undecodable": 1, "written": 361, "late": late, "repeated": 60 - late, "candles": job.closed().count()}
    assert 0 < late < 60


def test_late_trades_land_in_a_folder(spark, job):
    job.put("a.json", [message("X", 1, START, 10), message("X", 2, START + 30 * MINUTE, 11)])
    job.run()
    job.put("b.json", [message("X", 3, START + 1000, 99), message("X", 4, START + 90 * MINUTE, 12)])
    job.run()
    assert sorted(r["high"] for r in job.closed().collect()) == [10.0, 11.0]
    assert [(r["trade_id"], r["price"]) for r in spark.read.parquet(job.late).collect()] == [(3, 99.0)]
    assert [r["high"] for r in fold.open_candles(spark, job.checkpoint).collect()] == [12.0]


def test_a_repeated_batch_changes_nothing(spark, job):
    job.put("a.json", feed()[:200])
    job.put("b.json", feed()[200:])
    job.run()
    before = candle_rows(job.closed()), fold.totals(spark, job.checkpoint), candle_rows(fold.open_candles(spark, job.checkpoint))
    batch = spark.read.text(f"{job.src}/b.json")
    fold._fold(batch, 1, job.table, job.late, f"{job.checkpoint}/state", "1 minute", "2 minutes")
    assert before == (candle_rows(job.closed()), fold.totals(spark, job.checkpoint), candle_rows(fold.open_candles(spark, job.checkpoint)))


def test_flush_and_totals_read_no_trade(spark, job, tmp_path):
    job.put("a.json", feed())
    job.run()
    files = fold.open_candles(spark, job.checkpoint).inputFiles()
    assert files and all("/state/open/batch=0/" in f for f in files)
    # only the state of the last two batches is kept
    for i in range(3):
        job.put(f"b{i}.json", [message("X", 1000 + i, START + (100 + i) * MINUTE, 1)])
        job.run()
    assert sorted(child_folders(spark, f"{job.checkpoint}/state/open")) == ["batch=2", "batch=3"]
    assert fold.totals(spark, job.checkpoint)["received"] == 303


def test_totals_of_many_triggers(spark, job):
    for i in range(12):
        job.put(f"{i:03}.json", [message("X", i, START + i, 1), *(["{broken"] if i % 10 == 0 else [])])
    job.run()
    job.put("more.json", [message("X", 99, START, 1)])
    job.run()
    sums = fold.totals(spark, job.checkpoint)
    assert (sums["received"], sums["written"], sums["undecodable"]) == (15, 13, 2)
    assert len(child_folders(spark, f"{job.checkpoint}/state/ledger")) == 13


def test_compaction_keeps_every_candle(spark, job):
    for i in range(3):
        job.put(f"{i}.json", feed()[i * 100:(i + 1) * 100])
    job.run()
    before = candle_rows(job.closed())
    folders = [f for s in child_folders(spark, job.table) for f in child_folders(spark, f"{job.table}/{s}/date=2024-01-01")]
    assert len(folders) > 2
    assert fold.compact_candles(spark, job.table, before="2024-01-01") == 0
    assert fold.compact_candles(spark, job.table) == len(folders) - 2 and candle_rows(job.closed()) == before
    assert fold.compact_candles(spark, job.table) == 0


def test_only_the_newest_dates_are_read(spark, tmp_path):
    path = str(tmp_path / "c")
    rows = spark.range(30 * 24).select(
        F.lit(1.0).alias("open"), F.lit(1.0).alias("high"), F.lit(1.0).alias("low"), F.col("id").cast("double").alias("close"),
        F.lit(1.0).alias("volume"), F.lit(1).cast("bigint").alias("trade_count"),
        F.timestamp_seconds(1_704_067_200 + F.col("id") * 3600).alias("window_start"),
        F.timestamp_seconds(1_704_067_200 + F.col("id") * 3600 + 60).alias("window_end"), F.lit("A B/C").alias("symbol"))
    fold.write_candles(rows.union(rows.withColumn("symbol", F.lit("Z")).where("close < 30")), path)
    newest = dashboards.newest_candles(spark, path, ["A B/C"], 30)
    files = newest.select("_metadata.file_path").distinct().collect()
    assert {f[0].split("date=")[1][:10] for f in files} == {"2024-01-30", "2024-01-29", "2024-01-28"}
    assert [r["value"] for r in dashboards.candle_series(newest, "A B/C", "close", 30).collect()] == [float(x) for x in range(719, 689, -1)]
    # a symbol with fewer rows gives all it has, an unknown one none
    both = dashboards.newest_candles(spark, path, ["A B/C", "Z", "none"], 40)
    assert both.where("symbol = 'Z'").count() == 30 and both.where("symbol = 'none'").count() == 0
    assert tables.newest_folders(spark, path, "symbol", ["none"], 5) == []
    assert len(newest.inputFiles()) == 3
