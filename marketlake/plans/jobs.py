"""Whole jobs over stored tables: silver, gold, analysis, recommendations, summary.

Each job reads tables, builds one lineage and writes tables; the only actions
are the writes (and the bounded look-ups of the similarity search). Where a
later step needs a result more than once it reads the table just written, so a
lost executor costs one stage, not the whole chain.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from marketlake.operators import indicators, recommend, similarity, vector_index
from marketlake.operators.keyed import keep_last
from marketlake.plans import gold, summary
from marketlake.schemas import GOLD_TABLES
from marketlake.session import remove_folder, shared_folder, written
from marketlake.sources import tables
from marketlake.sources.bronze import list_files, path_exists

# all rows of a conversion share its clock; the path holds the fetch date
MARKET_ORDER = ["ingestion_time", "file_path", "pos"]
TOP_COINS = 20
NEIGHBOURS = 5


def build_gold(
    spark: SparkSession, silver: str, out: str, mode: str = "full", since: str | None = None,
    snapshot_date: str | None = None, flat: bool = False,
) -> None:
    """Star schema from the silver feeds (GLD-01..05).

    ``incremental`` rebuilds the small dimensions and rewrites only the fact
    partitions of coins ingested after ``since``, or without it of coins with
    files that no build has read yet: the files read are kept in ``out``/files_read,
    and nothing is opened of a coin that has no new file. With ``snapshot_date`` the
    latest market rows are added as prices of that date and win over history;
    they are also all there is if no history has been loaded yet.
    """
    markets = tables.read_table(spark, f"{silver}/markets")
    coins = gold.dim_coins(markets, MARKET_ORDER)
    tables.write_table(coins, f"{out}/dim_coins")

    history = f"{silver}/market_chart"
    has_history = path_exists(spark, history)
    if not has_history and snapshot_date is None:
        raise FileNotFoundError(f"no price history at {history}")
    frames = []
    if has_history:
        # listed before anything is read: a file that comes meanwhile is new to the next build
        listed = written(list_files(spark, history), "listed")
        by_files = mode == "incremental" and since is None
        if by_files and snapshot_date is None:
            chart = read_unread(spark, history, listed, f"{out}/files_read")
            if chart is None:
                return
            chart, build, changed = chart.withColumn("date", F.to_date("timestamp")), "full", None
        else:
            chart, build, changed = tables.read_table(spark, history).withColumn("date", F.to_date("timestamp")), mode, None
            if mode == "incremental":
                # the day's prices need the price before: coins of the market feed are built whole
                late = chart.select("coin_id") if by_files else chart.where(F.col("ingestion_time") > F.lit(since).cast("timestamp")).select("coin_id")
                changed = late.distinct() if snapshot_date is None else late.union(coins.select("coin_id")).distinct()
        frames.append(gold.daily_prices(gold.rows_to_build(chart, build, changed), ["timestamp"]))
    if snapshot_date is not None:
        wanted = ["id", "current_price", "market_cap", "total_volume", *MARKET_ORDER]
        latest = keep_last(markets.select(*wanted), ["id"], MARKET_ORDER)
        today = gold.snapshot_prices(latest, F.lit(snapshot_date).cast("date"))
        frames = [gold.merge_snapshot(frames[0], today) if frames else today]

    # the merged prices feed both the date dimension and the fact
    staged = [shared_folder(spark, "daily")]
    tables.write_table(frames[0], staged[0])
    daily = tables.read_table(spark, staged[0])
    dates = gold.dim_date(daily)
    if mode == "incremental" and path_exists(spark, f"{out}/dim_date"):
        known = tables.read_table(spark, f"{out}/dim_date")
        dates = known.union(dates.select(*known.columns)).distinct()
        staged.append(shared_folder(spark, "dates"))
        tables.write_table(dates, staged[1])
        dates = tables.read_table(spark, staged[1])
    tables.write_table(dates.orderBy("date"), f"{out}/dim_date")
    fact = gold.fact_daily_prices(daily, dates)
    if flat:
        tables.write_flat(fact, f"{out}/fact_daily_prices")
    else:
        # a full build drops the coins that are gone; an incremental one leaves other coins alone
        tables.write_table(fact, f"{out}/fact_daily_prices", ["coin_id"], replace=mode == "full")
    if has_history:
        tables.write_table(listed, f"{out}/files_read")
    for folder in staged:
        remove_folder(spark, folder)


def read_unread(spark: SparkSession, path: str, listed: DataFrame, manifest: str, grouped: str | None = None) -> DataFrame | None:
    """The partition folders of the table at ``path`` that hold files not in ``manifest``, or None if there are none (GLD-05).

    Folders are found from the two lists alone; the driver holds the changed ones.
    Of a table that lies by groups of the key ``grouped``, only the rows of keys
    that are in new files; their names come from that column of the new files.
    """
    known = tables.read_table(spark, manifest, listed.schema, required=False)
    folder = F.regexp_replace("file_path", "/[^/]*$", "").alias("folder")
    new = listed.join(known, "file_path", "left_anti")
    if grouped is None:
        changed = [r["folder"] for r in new.select(folder).distinct().collect()]
        return spark.read.option("basePath", path).parquet(*changed) if changed else None
    files = [r["file_path"] for r in new.collect()]  # some a group
    if not files:
        return None
    changed = sorted({f.rpartition("/")[0] for f in files})
    rows = spark.read.option("basePath", path).parquet(*changed)
    found = spark.read.schema(rows.schema).option("basePath", path).parquet(*files)
    keys = written(found.select(F.col(grouped).alias("_key")).distinct(), "keys")
    return rows.join(tables.small(keys), F.col(grouped).eqNullSafe(F.col("_key")), "left_semi")


def register_gold(spark: SparkSession, out: str, database: str = "gold", flat: bool = False) -> DataFrame:
    """Catalog tables over the gold folder; row counts per table (SNK-07..09)."""
    tables.create_database(spark, database)
    counts = []
    for name in GOLD_TABLES:
        if path_exists(spark, f"{out}/{name}"):
            tables.create_table(spark, name, f"{out}/{name}", database, flat and name == "fact_daily_prices")
            tables.discover_partitions(spark, name, database)
            counts.append(
                spark.table(f"{database}.{name}").agg(F.lit(name).alias("table"), F.count(F.lit(1)).alias("rows")))
    result = counts[0]
    for one in counts[1:]:
        result = result.union(one)
    return result


def analyse(spark: SparkSession, gold_path: str, out: str, as_of: str, index: bool = False) -> int:
    """Snapshots of all coins, saved as a dated run and added to the pattern collection.

    Returns the number of patterns stored (PAT-06); what could not be stored is in
    ``out``/patterns_failed with its reason. With ``index`` the vector index in
    ``out``/patterns_index gets the run too; a new one takes the whole collection.
    """
    facts = tables.read_table(spark, f"{gold_path}/fact_daily_prices")
    coins = tables.read_table(spark, f"{gold_path}/dim_coins")
    tables.write_run(indicators.snapshots(facts, coins), f"{out}/indicators", F.lit(as_of), "parquet")
    stored = store_patterns(spark, f"{out}/indicators", f"{out}/patterns", as_of, f"{out}/patterns_failed")["stored"]
    if index and stored:
        dates = _run_of(spark, f"{out}/indicators", as_of).agg(F.min("date").cast("string")).first()[0]
        vector_index.refresh_index(spark, f"{out}/patterns", f"{out}/patterns_index", since=dates)
    return stored


def _run_of(spark: SparkSession, path: str, as_of: str) -> DataFrame:
    return spark.read.parquet(path).where(F.col("as_of") == as_of).drop("as_of")


def store_patterns(spark: SparkSession, snapshots_path: str, path: str, as_of: str, failed: str) -> dict[str, int]:
    """Upsert a run into the collection, rewriting only the dates it touches (PAT-02).

    Records that cannot be stored go to ``failed`` as this run's rows (id, coin_id,
    date, error). Returns how many were stored and failed (PAT-06).
    """
    judged = shared_folder(spark, "judged")
    tables.write_table(similarity.split_storable(similarity.pattern_vectors(_run_of(spark, snapshots_path, as_of))), judged)
    checked = spark.read.parquet(judged)
    bad = checked.where("error IS NOT NULL").select("id", "coin_id", F.col("date").cast("string").alias("date"), "error")
    tables.write_run(bad, failed, F.lit(as_of), "parquet")
    good = checked.where("error IS NULL").drop("error").withColumn("date", F.col("date").cast("string"))
    fresh = good.withColumn("document", recommend.snapshot_text()).select(
        "id", "embedding", "document", *similarity.META)
    staged = shared_folder(spark, "patterns")
    if path_exists(spark, path):
        known = spark.read.parquet(path)
        touched = known.join(F.broadcast(fresh.select("date").distinct()), "date", "left_semi")
        fresh = similarity.merge(touched, fresh)
    # the table being replaced is also read, hence the stage in between
    tables.write_table(fresh, staged, ["date"])
    tables.write_table(spark.read.parquet(staged), path, ["date"])
    counts = checked.agg(F.count_if(F.col("error").isNull()), F.count_if(F.col("error").isNotNull())).head()
    for folder in (judged, staged):
        remove_folder(spark, folder)
    return {"stored": counts[0], "failed": counts[1]}


def stored_matches(spark: SparkSession, matches: DataFrame) -> DataFrame:
    """Matches as a table: its known size lets Spark choose how to join the collection to it."""
    path = shared_folder(spark, "matches")
    tables.write_table(matches, path)
    return tables.read_table(spark, path)


def recommend_top(
    spark: SparkSession, gold_path: str, out: str, as_of: str, n: int = TOP_COINS, answer=None, at: Column | None = None,
    neighbours: int = NEIGHBOURS, index: bool = False,
) -> None:
    """Recommendations for the best-ranked coins, saved as a dated run (REC-04).

    Similar patterns come from an exact search, or with ``index`` from the stored index.
    """
    coins = tables.read_table(spark, f"{gold_path}/dim_coins")
    # the size of either side is known to Spark: the list is bounded by its limit
    top = gold.ranked(coins.where("market_cap_rank IS NOT NULL"), n).select("coin_id")
    run = _run_of(spark, f"{out}/indicators", as_of).join(top, "coin_id", "left_semi")
    patterns = spark.read.parquet(f"{out}/patterns")
    ids = run.withColumn("id", similarity.pattern_id())
    asked = patterns.select("id", "embedding").join(ids, "id")
    if index:
        found = vector_index.search_index(asked, f"{out}/patterns_index", neighbours)
    else:
        found = similarity.similar_patterns(asked, patterns, neighbours, ship=True)
    matches = stored_matches(spark, found)
    records = recommend.recommend(asked, matches, patterns, answer, at)
    tables.write_run(records, f"{out}/recommendations", F.lit(as_of), "parquet")


def summarise(spark: SparkSession, out: str) -> DataFrame:
    """Summary of the newest run (SUM-01); records are in order of their coin id."""
    records = tables.latest_run(spark, f"{out}/recommendations")
    return summary.market_summary(records.withColumn("pos", F.col("coin_id")))
