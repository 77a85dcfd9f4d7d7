"""Packed responses and grouped tables: the rows of the folder layouts, without a folder or file a coin."""

import json

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marketlake.plans import jobs, silver
from marketlake.sources import bronze, tables

INNER = T.StructType([T.StructField("active_coins", T.LongType())])


def responses(spark):
    """Charts of 40 coins, of some a second one of the same time and a later one, and bodies that are no charts."""
    out = []
    for n in range(40):
        coin = None if n == 4 else "a/b" if n == 5 else f"c{n}"
        chart = {k: [[86_400_000 * t, n + t + 0.5] for t in range(3)] for k in ("prices", "market_caps", "total_volumes")}
        out.append((coin, "2024-01-01", json.dumps(chart)))
        if n % 4 == 0:
            out.append((coin, "2024-01-02", json.dumps({k: [[172_800_000, 99.0], [259_200_000, 7.0]] for k in chart})))
    out += [("x1", "2024-01-01", "not json"), ("x2", "2024-01-01", "[1, 2]"), ("x3", "2024-01-01", "{}")]
    return spark.createDataFrame(out, "coin_id string, fetched string, value string")


def rows(df):
    return sorted(map(str, df.collect()))


def test_packed_responses_read_as_files_do(spark, tmp_path):
    bodies, tree, packed = responses(spark), str(tmp_path / "tree"), str(tmp_path / "packed")
    bronze.write_responses(bodies, f"{tree}/market_chart", ["coin_id", "fetched"])
    bronze.write_packed(bodies.where("fetched = '2024-01-01'"), f"{packed}/market_chart", ["coin_id", "fetched"])
    bronze.write_packed(bodies.where("fetched > '2024-01-01'"), f"{packed}/market_chart", ["coin_id", "fetched"])
    assert bronze.list_files(spark, f"{packed}/market_chart").distinct().count() == bodies.count()
    at = F.lit("2024-02-01 00:00:00").cast("timestamp")
    got, want = (silver.market_chart(spark, f"{p}/market_chart", at).where("coin_id <> 'a%2Fb'") for p in (packed, tree))
    want = want.where("coin_id <> 'a%252Fb'")  # of files the listing escapes a second time
    assert want.count() == 39 * 3 + 10 and rows(got.select(*want.columns)) == rows(want)
    # responses of both kinds in one feed
    bronze.write_responses(bodies.where("coin_id = 'c1'").withColumn("coin_id", F.lit("new")), f"{packed}/market_chart", ["coin_id", "fetched"])
    assert silver.market_chart(spark, f"{packed}/market_chart", at).where("coin_id = 'new'").count() == 3


def test_silver_of_many_coins_has_few_folders(spark, tmp_path):
    raw, one, many = (str(tmp_path / n) for n in ("raw", "one", "many"))
    bodies = responses(spark).where("coin_id is null or coin_id <> 'a/b'")
    bronze.write_packed(bodies, f"{raw}/market_chart", ["coin_id", "fetched"])
    at = F.lit("2024-02-01 00:00:00").cast("timestamp")
    for out, groups in ((one, None), (many, 4)):
        for _ in range(2):  # a second run gives the same table
            assert silver.convert_all(spark, raw, out, INNER, at, groups=groups) == ["market_chart"]
    was, now = tables.read_table(spark, f"{one}/market_chart"), tables.read_table(spark, f"{many}/market_chart")
    assert rows(now.select(*was.columns)) == rows(was)
    folders = bronze.child_folders(spark, f"{many}/market_chart")
    assert 1 < len(folders) <= 4 and all(f.startswith("coin_id_of_4=") for f in folders)


def test_grouped_tables_replace_the_values_present(spark, tmp_path):
    path = str(tmp_path / "t")
    old = spark.createDataFrame([(f"c{n % 20}" if n % 20 else None, n) for n in range(100)], "k string, v int")
    tables.write_grouped(old, path, "k", 3)
    fresh = spark.createDataFrame([("c1", -1), (None, -2), ("new", -3)], "k string, v int")
    tables.write_grouped(fresh, path, "k", 3)
    want = sorted([(f"c{n % 20}", n) for n in range(100) if n % 20 > 1] + [("c1", -1), ("", -2), ("new", -3)])
    assert sorted((r["k"] or "", r["v"]) for r in tables.read_table(spark, path).collect()) == want
    tables.write_grouped(fresh.where("v > 0"), path, "k", 3)
    assert tables.read_table(spark, path).count() == len(want)
    with pytest.raises(ValueError, match="k_of_3"):
        tables.write_grouped(fresh, path, "k", 4)


def test_unread_rows_of_a_grouped_table_are_those_of_the_changed_keys(spark, tmp_path):
    path, manifest = str(tmp_path / "t"), str(tmp_path / "m")
    old = spark.createDataFrame([(f"c{n % 30}" if n % 30 else None, n) for n in range(300)], "coin_id string, v int")
    tables.write_grouped(old, path, "coin_id", 8)
    tables.write_table(bronze.list_files(spark, path), manifest)
    assert jobs.read_unread(spark, path, bronze.list_files(spark, path), manifest, grouped="coin_id") is None
    more = old.where("coin_id = 'c7' or coin_id is null").withColumn("v", F.col("v") + 1000)
    tables.append_grouped(more, path, "coin_id", 8)
    unread = jobs.read_unread(spark, path, bronze.list_files(spark, path), manifest, grouped="coin_id")
    want = [(c, n + k) for n in range(300) if n % 30 in (0, 7) for c in ["" if n % 30 == 0 else "c7"] for k in (0, 1000)]
    assert sorted((r["coin_id"] or "", r["v"]) for r in unread.collect()) == sorted(want)
    assert len({f.rpartition("/")[0] for f in unread.inputFiles() if "/t/coin_id_of_8=" in f}) <= 2
    assert len(bronze.child_folders(spark, path)) <= 8


def test_build_by_files_makes_no_folder_a_coin(spark, tmp_path, monkeypatch):
    from marketlake.registry import relational

    raw = [(n % 40, n % 7, float(1 + n % 9), n) for n in range(2000)]
    spark.createDataFrame(raw, "coin int, day int, price double, seq long").selectExpr(
        "cast(coin as string) coin_id", "date_add(date'2024-01-01', day) date", "price price_usd", "price market_cap_usd", "price volume_usd", "seq").write.parquet(
        str(tmp_path / "raw"))
    monkeypatch.setattr(relational.testbed, "raw_prices", lambda s, d: s.read.parquet(str(tmp_path / "raw")))
    monkeypatch.setattr(relational, "shared_folder", lambda s, name: str(tmp_path / name))
    monkeypatch.setattr(tables, "GROUPS", 4)
    monkeypatch.setattr(tables.write_grouped, "__defaults__", (4,))
    monkeypatch.setattr(tables.append_grouped, "__defaults__", (4,))
    got = {(r["coin_id"], str(r["date"])): r["price_usd"] for r in relational.incremental_by_files(spark, "").collect()}
    want = {}
    for coin, day, price, _ in sorted(raw, key=lambda r: r[3]):
        want[str(coin), f"2024-01-0{1 + day}"] = price
    assert got == want
    assert all(len(bronze.child_folders(spark, str(tmp_path / n))) <= 4 for n in ("history", "fact"))
