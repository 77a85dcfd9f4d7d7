"""Filters, joins, aggregates, top-k, set operations and gold builds."""

from pyspark.sql import functions as F

from marketlake.functions import scalars
from marketlake.operators import indicators, keyed
from marketlake.plans import dashboards, gold, jobs, summary
from marketlake.registry.core import query, sql
from marketlake.session import shared_folder, written
from marketlake.sources import bronze, tables, testbed

AS_OF = testbed.AS_OF


def as_of():
    return F.lit(AS_OF).cast("date")


# ---- filters ----------------------------------------------------------------


@query("fil_01_partition_key", sql(
    "SELECT coin_id, \"date\", price_usd FROM fact WHERE coin_id = '0'", "fact"))
def partition_key(spark, d):
    return testbed.facts(spark, d).where("coin_id = '0'").select("coin_id", "date", "price_usd")


@query("fil_02_in_list", sql(
    "SELECT coin_id, \"date\", price_usd FROM daily WHERE coin_id IN ('0', '1', '2', '3', '4')", "daily"))
def in_list(spark, d):
    daily = testbed.daily_prices(spark, d)
    return daily.where(F.col("coin_id").isin(*testbed.COINS)).select("coin_id", "date", "price_usd")


@query("fil_03_not_null", sql("SELECT coin_id, market_cap_rank FROM coins WHERE market_cap_rank IS NOT NULL", "coins"))
def not_null(spark, d):
    return testbed.coins(spark, d).where(F.col("market_cap_rank").isNotNull()).select("coin_id", "market_cap_rank")


@query("fil_04_recent_dates", sql(
    f"SELECT coin_id, \"date\", price_usd FROM daily WHERE \"date\" >= DATE '{AS_OF}' - INTERVAL '30' DAY", "daily"))
def recent_dates(spark, d):
    raw = testbed.raw_prices(spark, d).where(F.col("date") >= F.date_sub(as_of(), 30))
    return gold.daily_prices(raw, testbed.PRICE_ORDER).select("coin_id", "date", "price_usd")


@query("fil_05_other_coins", sql("""
SELECT coin_id, "date", price_usd FROM daily WHERE coin_id <> '0'""", "daily"))
def other_coins(spark, d):
    return testbed.daily_prices(spark, d).where("coin_id <> '0'").select("coin_id", "date", "price_usd")


@query("fil_07_point_lookup", sql(
    "SELECT coin_id, name, symbol, market_cap_rank FROM coins WHERE coin_id = '3'", "coins"))
def point_lookup(spark, d):
    return testbed.coins(spark, d).where("coin_id = '3'").select("coin_id", "name", "symbol", "market_cap_rank")


# ---- joins ------------------------------------------------------------------


@query("jn_01_fact_dates", sql("""
SELECT f.coin_id, f."date", d.date_id, f.price_usd
FROM daily f LEFT JOIN (SELECT DISTINCT "date", CAST(strftime("date", '%Y%m%d') AS INTEGER) AS date_id FROM raw) d
  ON f."date" = d."date\"""", "daily"))
def fact_dates(spark, d):
    dates = gold.dim_date(testbed.raw_prices(spark, d))
    return gold.fact_daily_prices(testbed.daily_prices(spark, d), dates).select(
        "coin_id", "date", "date_id", "price_usd")


@query("jn_02_fact_coins", sql("""
SELECT f.coin_id, c.name, f."date", f.price_usd FROM daily f JOIN coins c ON f.coin_id = c.coin_id
WHERE c.market_cap_rank IS NOT NULL""", "daily", "coins"))
def fact_coins(spark, d):
    coins = testbed.coins(spark, d).where("market_cap_rank IS NOT NULL").select("coin_id", "name")
    return testbed.daily_prices(spark, d).join(coins, "coin_id").select("coin_id", "name", "date", "price_usd")


def _self_join_sql(coins, measure):
    first, *others = coins
    cols = ", ".join(f"f{c}.{measure} AS coin_{c}" for c in coins)
    joins = " ".join(
        f"LEFT JOIN fact f{c} ON f{first}.\"date\" = f{c}.\"date\" AND f{c}.coin_id = '{c}'" for c in others)
    return sql(
        f"SELECT CAST(f{first}.\"date\" AS TIMESTAMP) AS \"time\", {cols} FROM fact f{first} {joins} "
        f"WHERE f{first}.coin_id = '{first}'", "fact")


@query("jn_03_self_join", _self_join_sql(testbed.COINS, "price_usd"))
def self_join(spark, d):
    return dashboards.multi_coin_series(testbed.facts(spark, d), testbed.COINS, "price_usd")


@query("jn_04_latest_tuples", sql("""
SELECT id, name, current_price, ingestion_time FROM markets
WHERE (id, ingestion_time) IN (SELECT id, max(ingestion_time) FROM markets GROUP BY id)""", "markets"))
def latest_tuples(spark, d):
    return keyed.latest_with_ties(testbed.markets(spark, d), "id", "ingestion_time").select(
        "id", "name", "current_price", "ingestion_time")


@query("jn_05_metadata_defaults", sql("""
SELECT p.coin_id, coalesce(c.symbol, substring(p.coin_id, 1, 3)) AS symbol, coalesce(c.name, p.coin_id) AS name
FROM (SELECT DISTINCT coin_id FROM raw) p
LEFT JOIN (SELECT * FROM coins WHERE market_cap_rank IS NOT NULL) c USING (coin_id)""", "raw", "coins"))
def metadata_defaults(spark, d):
    coins = testbed.coins(spark, d).where("market_cap_rank IS NOT NULL")
    ids = testbed.raw_prices(spark, d).select("coin_id").distinct()
    return ids.join(coins, "coin_id", "left").select(
        "coin_id", F.coalesce("symbol", F.substring("coin_id", 1, 3)).alias("symbol"),
        F.coalesce("name", scalars.title_case("coin_id")).alias("name"))


@query("jn_06_not_completed", sql("""
SELECT coin_id, market_cap_rank FROM coins
WHERE coin_id NOT IN (SELECT CAST(l_suppkey AS VARCHAR) FROM lineitem WHERE l_shipdate >= TIMESTAMP '2001-11-01')""", "coins"))
def not_completed(spark, d):
    done = testbed.raw_prices(spark, d).where("date >= '2001-11-01'").select("coin_id").distinct()
    return keyed.remaining(testbed.coins(spark, d).select("coin_id", "market_cap_rank"), done, "coin_id")


@query("jn_08_top_coin_facts", sql("""
SELECT coin_id, "date", price_usd FROM fact WHERE coin_id IN
  (SELECT coin_id FROM coins WHERE market_cap_rank IS NOT NULL ORDER BY market_cap_rank LIMIT 20)""", "fact", "coins"))
def top_coin_facts(spark, d):
    # the id list is bounded by its limit, hence the broadcast
    top = F.broadcast(_top_coins(spark, d, 20).select("coin_id"))
    raw = tables.scan_ids(testbed.raw_prices(spark, d), top, "coin_id")
    return gold.fact_daily_prices(gold.daily_prices(raw, testbed.PRICE_ORDER)).select("coin_id", "date", "price_usd")


def _top_coins(spark, d, n):
    return gold.ranked(testbed.coins(spark, d).where("market_cap_rank IS NOT NULL"), n)


# ---- aggregates -------------------------------------------------------------


@query("agg_01_count", sql("SELECT count(*) AS n FROM raw", "raw"))
def count(spark, d):
    return testbed.raw_prices(spark, d).agg(F.count("*").alias("n"))


@query("agg_02_max", sql("SELECT coin_id, max(price_usd) AS top FROM raw GROUP BY coin_id", "raw"))
def maximum(spark, d):
    return testbed.raw_prices(spark, d).groupBy("coin_id").agg(F.max("price_usd").alias("top"))


@query("agg_03_min_date_text", sql('SELECT CAST(min("date") AS VARCHAR) AS since FROM raw', "raw"))
def min_date(spark, d):
    return testbed.raw_prices(spark, d).agg(F.min("date").cast("string").alias("since"))


@query("agg_04_avg_by_name", sql("""
SELECT c.name, round_even(avg(f.volume_usd), 4) AS avg_volume FROM fact f JOIN coins c USING (coin_id) GROUP BY c.name""",
    "fact", "coins"))
def avg_by_name(spark, d):
    per_coin = testbed.facts(spark, d).groupBy("coin_id").agg(
        F.sum("volume_usd").alias("s"), F.count("volume_usd").alias("n"))
    named = per_coin.join(testbed.coins(spark, d), "coin_id").groupBy("name")
    return named.agg(F.bround(F.try_divide(F.sum("s"), F.sum("n")), 4).alias("avg_volume"))


@query("agg_06_value_counts", sql("SELECT symbol, count(*) AS n FROM trades GROUP BY symbol ORDER BY n DESC", "trades"))
def value_counts(spark, d):
    counts = testbed.trades(spark, d).groupBy("symbol").agg(F.count("*").alias("n"))
    return counts.orderBy(F.col("n").desc(), "symbol")


@query("agg_07_rsi_histogram", sql("""
SELECT bin, lo + (bin - 1) * span / 20 AS bin_start, count(*) AS n FROM (
  SELECT lo, span, CAST(least(20, 1 + CAST(floor((rsi_14 - lo) / (span / 20)) AS INTEGER)) AS INTEGER) AS bin
  FROM snapshot, (SELECT min(rsi_14) AS lo, max(rsi_14) - min(rsi_14) AS span FROM snapshot))
GROUP BY bin, lo, span""", "snapshot"))
def rsi_histogram(spark, d):
    return summary.histogram(indicators.snapshots(testbed.facts(spark, d)), "rsi_14", 20)


@query("agg_08_distinct_dates", sql('SELECT DISTINCT "date" FROM raw', "raw"))
def distinct_dates(spark, d):
    return testbed.raw_prices(spark, d).select("date").distinct()


@query("agg_09_distinct_coins", sql("SELECT count(DISTINCT coin_id) AS coins FROM raw", "raw"))
def distinct_coins(spark, d):
    return testbed.raw_prices(spark, d).agg(F.count_distinct("coin_id").alias("coins"))


@query("agg_10_keep_first", sql("""
SELECT coin_id, "date", price_usd, seq FROM raw
QUALIFY row_number() OVER (PARTITION BY coin_id, "date" ORDER BY seq) = 1""", "raw"))
def keep_first(spark, d):
    rows = testbed.raw_prices(spark, d).select("coin_id", "date", "price_usd", "seq")
    return keyed.keep_first(rows, ["coin_id", "date"], testbed.PRICE_ORDER)


@query("agg_11_keep_last", sql('SELECT coin_id, "date", price_usd, market_cap_usd, volume_usd FROM daily', "daily"))
def keep_last(spark, d):
    return testbed.daily_prices(spark, d)


@query("agg_12_latest_snapshot", sql("SELECT id, name, symbol, current_price, ingestion_time FROM latest_market", "latest_market"))
def latest_snapshot(spark, d):
    rows = testbed.markets(spark, d).select("id", "name", "symbol", "current_price", *testbed.MARKET_ORDER)
    return keyed.keep_last(rows, ["id"], testbed.MARKET_ORDER).drop("o_orderkey")


@query("agg_13_first_seen", sql("""
SELECT id, min(o_orderkey) AS o_orderkey FROM markets GROUP BY id ORDER BY 2 LIMIT 100""", "markets"))
def first_seen(spark, d):
    return keyed.first_seen(testbed.markets(spark, d).select("id", "o_orderkey"), "id", ["o_orderkey"], 100)


@query("agg_14_counters", sql("SELECT count(*) AS rows, count(DISTINCT coin_id) AS coins FROM fact", "fact"))
def counters(spark, d):
    return testbed.facts(spark, d).agg(F.count("*").alias("rows"), F.count_distinct("coin_id").alias("coins"))


@query("agg_15_last_non_null", sql("""
SELECT coin_id, round_even(arg_max(daily_return, "date"), 6) AS daily_return FROM fact
WHERE daily_return IS NOT NULL GROUP BY coin_id""", "fact"))
def last_non_null(spark, d):
    out = keyed.latest_value(testbed.facts(spark, d), "daily_return", "date", ["coin_id"])
    return out.withColumn("daily_return", F.bround("daily_return", 6))


# ---- sorts and limits -------------------------------------------------------


@query("top_01_rank_nulls_last", sql("SELECT * FROM coins ORDER BY market_cap_rank NULLS LAST, coin_id", "coins"))
def rank_nulls_last(spark, d):
    return gold.ranked(testbed.coins(spark, d))


@query("top_02_latest_row", sql(
    "SELECT \"date\", price_usd FROM fact WHERE coin_id = '1' ORDER BY \"date\" DESC LIMIT 1", "fact"))
def latest_row(spark, d):
    rows = testbed.facts(spark, d).where("coin_id = '1'").select("date", "price_usd")
    return rows.orderBy(F.col("date").desc()).limit(1)


@query("top_03_latest_rows", sql(
    "SELECT \"date\", price_usd FROM fact WHERE coin_id = '1' ORDER BY \"date\" DESC LIMIT 50", "fact"))
def latest_rows(spark, d):
    rows = testbed.facts(spark, d).where("coin_id = '1'").select("date", "price_usd")
    return rows.orderBy(F.col("date").desc()).limit(50)


@query("top_04_first_by_rank", sql(
    "SELECT * FROM coins ORDER BY market_cap_rank NULLS LAST, coin_id LIMIT 50", "coins"))
def first_by_rank(spark, d):
    return gold.ranked(testbed.coins(spark, d), 50)


@query("top_05_top_coins", sql("""
SELECT coin_id, name, symbol FROM coins WHERE market_cap_rank IS NOT NULL ORDER BY market_cap_rank LIMIT 20""", "coins"))
def top_coins(spark, d):
    return _top_coins(spark, d, 20).select("coin_id", "name", "symbol")


@query("top_06_top_per_action", sql("""
SELECT symbol, id, current_price, rank FROM (
  SELECT *, CAST(row_number() OVER (PARTITION BY symbol ORDER BY current_price DESC, o_orderkey) AS INTEGER) AS rank
  FROM markets) WHERE rank <= 3""", "markets"))
def top_per_action(spark, d):
    top = keyed.top_per_group(
        testbed.markets(spark, d), ["symbol"], [F.col("current_price").desc(), F.col("o_orderkey")], 3)
    return top.select("symbol", "id", "current_price", "rank")


@query("top_08_sort_column", sql("""
SELECT id, name, current_price FROM latest_market ORDER BY current_price""", "latest_market"))
def sort_column(spark, d):
    rows = keyed.keep_last(testbed.markets(spark, d), ["id"], testbed.MARKET_ORDER)
    return summary.sort_by(rows, "current_price", ["id", "current_price"]).select("id", "name", "current_price")


@query("top_09_page", sql("""
SELECT id, market_cap, o_orderkey FROM markets ORDER BY market_cap DESC, o_orderkey LIMIT 250 OFFSET 250""", "markets"))
def ranked_page(spark, d):
    rows = testbed.markets(spark, d).select("id", "market_cap", "o_orderkey")
    return keyed.page(rows, [F.col("market_cap").desc(), F.col("o_orderkey")], number=2, size=250)


@query("top_09_page_after", sql("""
SELECT id, o_orderkey, o_orderkey AS place FROM markets ORDER BY o_orderkey LIMIT 250 OFFSET 250""", "markets"))
def page_after(spark, d):
    """The second page, from the key of the first one's last row."""
    rows = testbed.markets(spark, d).select("id", "o_orderkey", F.col("o_orderkey").alias("place"))
    last = keyed.page(rows, [F.col("place")], number=1, size=250).agg(F.max("place")).head()[0]
    return keyed.page_after(rows, ["place"], [last], 250)


# ---- set operations ---------------------------------------------------------


@query("set_01_concat", sql("""
SELECT id AS entity, current_price AS amount, o_orderkey FROM markets
UNION ALL SELECT coin_id, market_cap_rank, NULL FROM coins""", "markets", "coins"))
def concat(spark, d):
    left = testbed.markets(spark, d).select(
        F.col("id").alias("entity"), F.col("current_price").alias("amount"), "o_orderkey")
    right = testbed.coins(spark, d).select(
        F.col("coin_id").alias("entity"), F.col("market_cap_rank").cast("double").alias("amount"))
    return left.unionByName(right, allowMissingColumns=True)


_MERGED = """
merged AS (
  SELECT coin_id, "date", price_usd, market_cap_usd, volume_usd FROM (
    SELECT *, 0 AS turn FROM daily
    UNION ALL
    SELECT id, DATE '2001-11-04', current_price, market_cap, total_volume, 1 FROM latest_market)
  QUALIFY row_number() OVER (PARTITION BY coin_id, "date" ORDER BY turn DESC) = 1)"""


def _merged(spark, d):
    latest = keyed.keep_last(testbed.markets(spark, d), ["id"], testbed.MARKET_ORDER)
    return gold.merge_snapshot(testbed.daily_prices(spark, d), gold.snapshot_prices(latest, as_of()))


@query("set_02_history_and_snapshot", sql("SELECT * FROM merged", "daily", "latest_market", extra=_MERGED))
def history_and_snapshot(spark, d):
    return _merged(spark, d)


@query("set_03_tag_values", sql("""
SELECT 'coin_id' AS kind, coin_id AS text FROM coins UNION SELECT 'coin_id', id FROM markets
UNION SELECT 'signal', symbol FROM markets""", "coins", "markets"))
def tag_values(spark, d):
    markets = testbed.markets(spark, d)
    return summary.tag_values(
        markets.select(F.col("id").alias("coin_id"), F.col("symbol").alias("signal")), testbed.coins(spark, d))


@query("set_04_difference", sql("""
SELECT id FROM (SELECT DISTINCT id FROM markets)
EXCEPT SELECT CAST(l_suppkey AS VARCHAR) FROM lineitem""", "markets"))
def difference(spark, d):
    ids = testbed.markets(spark, d).select("id").distinct()
    done = testbed.raw_prices(spark, d).select(F.col("coin_id").alias("id")).distinct()
    return keyed.remaining(ids, done, "id")


@query("set_05_mark_done", sql("""
SELECT coin_id FROM coins UNION SELECT id FROM markets""", "coins", "markets"))
def mark_done(spark, d):
    return keyed.mark_done(
        testbed.coins(spark, d), testbed.markets(spark, d).select(F.col("id").alias("coin_id")), "coin_id")


@query("set_05_reset", sql("""
SELECT coin_id FROM coins EXCEPT SELECT CAST(l_suppkey AS VARCHAR) FROM lineitem WHERE l_shipdate >= TIMESTAMP '2001-11-03'""", "coins"))
def reset_done(spark, d):
    again = testbed.raw_prices(spark, d).where("date >= '2001-11-03'").select("coin_id")
    return keyed.reset_done(testbed.coins(spark, d), again, "coin_id")


# ---- gold -------------------------------------------------------------------


@query("gld_01_dim_coins", sql("""
SELECT id AS coin_id, name, symbol, TRY_CAST(market_cap_rank AS INTEGER) AS market_cap_rank FROM latest_market""",
    "latest_market"))
def dim_coins(spark, d):
    return gold.dim_coins(testbed.markets(spark, d), testbed.MARKET_ORDER)


@query("gld_02_dim_date", sql("""
SELECT "date", CAST(strftime("date", '%Y%m%d') AS INTEGER) AS date_id, CAST(year("date") AS INTEGER) AS "year",
  CAST(month("date") AS INTEGER) AS "month", CAST(day("date") AS INTEGER) AS "day", dayname("date") AS day_of_week,
  dayofweek("date") IN (0, 6) AS is_weekend, monthname("date") AS month_name, CAST(quarter("date") AS INTEGER) AS "quarter"
FROM (SELECT DISTINCT "date" FROM raw)""", "raw"))
def dim_date(spark, d):
    return gold.dim_date(testbed.raw_prices(spark, d))


@query("gld_03_fact_daily_prices", sql("""
SELECT date_id, "date", price_usd, market_cap_usd, volume_usd, round_even(daily_return, 6) AS daily_return, coin_id
FROM fact""", "fact"))
def fact_daily_prices(spark, d):
    raw = testbed.raw_prices(spark, d)
    fact = gold.fact_daily_prices(gold.daily_prices(raw, testbed.PRICE_ORDER), gold.dim_date(raw))
    return fact.withColumn("daily_return", F.bround("daily_return", 6))


@query("gld_04_fact_with_snapshot", sql("""
SELECT CAST(strftime("date", '%Y%m%d') AS INTEGER) AS date_id, "date", price_usd, market_cap_usd, volume_usd, coin_id,
  round_even(CASE WHEN p <> 0 THEN (price_usd - p) / p END, 6) AS daily_return
FROM (SELECT *, lag(price_usd) OVER (PARTITION BY coin_id ORDER BY "date") AS p FROM merged)""",
    "daily", "latest_market", extra=_MERGED))
def fact_with_snapshot(spark, d):
    return gold.fact_daily_prices(_merged(spark, d)).withColumn("daily_return", F.bround("daily_return", 6))


@query("gld_05_incremental", sql("""
SELECT coin_id, "date", price_usd, round_even(daily_return, 6) AS daily_return FROM fact
WHERE coin_id IN (SELECT coin_id FROM raw WHERE "date" >= DATE '2001-11-01')""", "fact"))
def incremental(spark, d):
    raw = testbed.raw_prices(spark, d)
    changed = raw.where("date >= '2001-11-01'").select("coin_id")
    out = gold.refresh(raw, testbed.PRICE_ORDER, "incremental", changed)
    return out.select("coin_id", "date", "price_usd", F.bround("daily_return", 6).alias("daily_return"))


@query("gld_05_by_files", sql(
    'SELECT coin_id, "date", price_usd, round_even(daily_return, 6) AS daily_return FROM fact', "fact"))
def incremental_by_files(spark, d):
    """A build, more files of every third coin, and a second build that reads those coins alone."""
    history, out = shared_folder(spark, "history"), shared_folder(spark, "fact")
    raw = testbed.raw_prices(spark, d)
    later = (F.col("seq") % 10 == 0) & (F.col("coin_id").cast("int") % 3 == 0)
    tables.write_grouped(raw.where(~later), history, "coin_id")
    known = written(bronze.list_files(spark, history), "files")
    tables.write_grouped(gold.fact_daily_prices(gold.daily_prices(tables.read_table(spark, history), testbed.PRICE_ORDER)), out, "coin_id")
    tables.append_grouped(raw.where(later), history, "coin_id")
    manifest = shared_folder(spark, "manifest")
    tables.write_table(known, manifest)
    unread = jobs.read_unread(spark, history, bronze.list_files(spark, history), manifest, grouped="coin_id")
    tables.write_grouped(gold.fact_daily_prices(gold.daily_prices(unread, testbed.PRICE_ORDER)), out, "coin_id")
    return tables.read_table(spark, out).select("coin_id", "date", "price_usd", F.bround("daily_return", 6).alias("daily_return"))


@query("gld_07_work_list", sql("""
SELECT id, o_orderkey FROM (SELECT id, min(o_orderkey) AS o_orderkey FROM markets GROUP BY id ORDER BY 2 LIMIT 100)
WHERE id NOT IN (SELECT CAST(l_suppkey AS VARCHAR) FROM lineitem)""", "markets"))
def work_list(spark, d):
    first = keyed.first_seen(testbed.markets(spark, d).select("id", "o_orderkey"), "id", ["o_orderkey"], 100)
    done = testbed.raw_prices(spark, d).select(F.col("coin_id").alias("id")).distinct()
    return keyed.remaining(first, done, "id")
