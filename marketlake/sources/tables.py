"""Parquet tables: readers, writers and catalog (SRC-04..08, SNK-02..10)."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marketlake.functions.scalars import strip_prefix
from marketlake.schemas import GOLD_TABLES
from marketlake.session import written
from marketlake.sources.bronze import NO_VALUE, child_folders, path_exists

# bits of a sketch's registers: 2 ** 12 bytes or fewer a column and partition
SKETCH_BITS = 12
# folders of a grouped table, and key values that are broadcast at most: some tens of MB
GROUPS = 256
FEW_KEYS = 1 << 20

# ---- readers --------------------------------------------------------------


def read_table(spark: SparkSession, path: str, schema: T.StructType | None = None, required: bool = True) -> DataFrame:
    """A Parquet folder with its partition folders (SRC-04).

    Without ``required`` a missing folder gives an empty frame of ``schema``.
    """
    if not path_exists(spark, path):
        if required or schema is None:
            raise FileNotFoundError(f"no table at {path}")
        return spark.createDataFrame([], schema)
    reader = spark.read.schema(schema) if schema is not None else spark.read
    return reader.parquet(path)


def with_id_from_path(df: DataFrame, column: str) -> DataFrame:
    """Fill a missing id column from the file's folder name, prefix stripped (FLT-14)."""
    folder = F.element_at(F.split(F.col("_metadata.file_path"), "/"), -2)
    return df.withColumn(column, strip_prefix(folder, f"{column}="))


def latest_run(spark: SparkSession, path: str, schema: T.StructType | str | None = None, run: str = "as_of", form: str = "parquet") -> DataFrame:
    """Rows of the newest run of a table partitioned by ``run`` (SRC-06).

    The newest run comes from a listing of the run folders; no file of another
    run is opened. Equal to reading all and keeping the greatest ``run``.
    """
    folders = [f for f in child_folders(spark, path) if f.startswith(f"{run}=") and not f.endswith("__HIVE_DEFAULT_PARTITION__")]
    if not folders:
        raise FileNotFoundError(f"no run at {path}")
    newest = max(folders, key=lambda f: unquote(f))
    reader = spark.read.format(form).option("basePath", path)
    return (reader.schema(schema) if schema is not None else reader).load(f"{path}/{newest}")


def newest_folders(spark: SparkSession, path: str, key: str, values: Sequence[str], n: int, part: str = "date") -> list[str]:
    """The newest ``part`` folders of each ``key`` value that hold at least ``n`` rows together (TOP-03).

    Folders are walked from the newest back, twice as many each time; rows are
    counted without reading a column, from the files' footers.
    """
    left, escaped = {}, spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.escapePathName
    for value in values:
        top = f"{path}/{key}={escaped(value)}"
        if path_exists(spark, top):
            left[top] = sorted((f for f in child_folders(spark, top) if f.startswith(f"{part}=")), reverse=True)
    chosen, held, step = {top: [] for top in left}, dict.fromkeys(left, 0), 1
    while True:
        more = {top: folders[:step] for top, folders in left.items() if folders and held[top] < n}
        if not more:
            return [f"{top}/{f}" for top, folders in chosen.items() for f in folders]
        counts = [spark.read.option("basePath", path).parquet(*[f"{top}/{f}" for f in folders]).agg(F.lit(top).alias("top"), F.count(F.lit(1)).alias("n"))
                  for top, folders in more.items()]
        for row in reduce(DataFrame.union, counts).collect():
            held[row["top"]] += row["n"]
        for top, folders in more.items():
            chosen[top] += folders
            left[top] = left[top][step:]
        step *= 2


def newest(spark: SparkSession, path: str, schema: str, key: str, values: Sequence[str], n: int, part: str = "date") -> DataFrame:
    """Rows of the newest folders of each ``key`` value: its newest ``n`` rows are among them, and no older folder is read."""
    folders = newest_folders(spark, path, key, values, n, part)
    if not folders:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).option("basePath", path).parquet(*folders)


def scan(df: DataFrame, columns: Sequence[str], order: Sequence[str] = ()) -> DataFrame:
    """Column list and optional order (SRC-07)."""
    out = df.select(*columns)
    return out.orderBy(*order) if order else out


def scan_ids(df: DataFrame, ids: DataFrame, key: str) -> DataFrame:
    """Rows whose key is in ``ids``: a semi join instead of a spliced IN list (SRC-08, JN-08)."""
    return df.join(ids.select(key), key, "left_semi")


# ---- writers --------------------------------------------------------------


def write_silver(df: DataFrame, path: str, partition: str) -> None:
    """Snappy Parquet per partition value, replacing only the values present (SNK-02, SNK-04)."""
    write_table(df, path, [partition])


def write_table(df: DataFrame, path: str, partitions: Sequence[str] = (), replace: bool = False) -> None:
    """Overwrite a gold table (SNK-03): the partitions present, or with ``replace`` the whole table.

    Partitioned tables are laid out with REBALANCE: rows of a partition value
    meet in few files, and a value that holds far more than its share is split
    into several files instead of being written by one task.
    """
    out = df.hint("rebalance", *[F.col(p) for p in partitions]) if partitions else df
    writer = out.write.mode("overwrite").option("compression", "snappy")
    if partitions:
        writer = writer.partitionBy(*partitions).option("partitionOverwriteMode", "static" if replace else "dynamic")
    writer.parquet(path)


def _grouped(df: DataFrame, key: str, groups: int) -> DataFrame:
    value = F.nullif(F.nullif(F.col(key), F.lit("")), F.lit(NO_VALUE))
    return df.withColumn(key, value).withColumn(group_column(key, groups), F.pmod(F.xxhash64(key), F.lit(groups)).cast("int"))


def small(keys: DataFrame) -> DataFrame:
    """Stored key values, broadcast up to a bounded number of them."""
    return F.broadcast(keys) if keys.count() <= FEW_KEYS else keys


def group_column(key: str, groups: int) -> str:
    """The partition column of a grouped table; the number of groups is fixed for its lifetime."""
    return f"{key}_of_{groups}"


def _write_groups(laid: DataFrame, path: str, key: str, group: str, mode: str) -> None:
    spread = laid.hint("rebalance", F.col(group)).sortWithinPartitions(group, key)
    spread.write.mode(mode).option("compression", "snappy").option("partitionOverwriteMode", "dynamic").partitionBy(group).parquet(path)


def write_grouped(df: DataFrame, path: str, key: str, groups: int = GROUPS) -> None:
    """Snappy Parquet in ``groups`` folders of hashed key values, replacing only the values present (SNK-02..04).

    The layout for many thousands of text values: a folder a value costs a file, a
    rename and a listing each. Rows are sorted by key in their file. Values are null
    where the folder of a value would be that of no value. Other values of a group
    that is written again are carried over.
    """
    group, spark = group_column(key, groups), df.sparkSession
    if not path_exists(spark, path):
        return _write_groups(_grouped(df, key, groups), path, key, group, "overwrite")
    if wrong := [f for f in child_folders(spark, path) if not f.startswith(f"{group}=")]:
        raise ValueError(f"{path} has folder {wrong[0]}, not {group}")
    fresh = written(_grouped(df, key, groups), "fresh")
    keys = written(fresh.select(group, F.col(key).alias("_key")).distinct(), "keys")
    touched = [r[0] for r in keys.select(group).distinct().collect()]  # at most ``groups``
    if not touched:
        return None
    known = spark.read.schema(fresh.schema).parquet(path).where(F.col(group).isin(touched))
    stays = known.join(small(keys.drop(group)), F.col(key).eqNullSafe(F.col("_key")), "left_anti")
    _write_groups(fresh.unionByName(stays), path, key, group, "overwrite")


def append_grouped(df: DataFrame, path: str, key: str, groups: int = GROUPS) -> None:
    """More files of a grouped table."""
    _write_groups(_grouped(df, key, groups), path, key, group_column(key, groups), "append")


def write_flat(df: DataFrame, path: str) -> None:
    """Unpartitioned fact with a plain date column, previous files removed (SNK-05, SNK-06)."""
    df.withColumn("date", F.col("date").cast("date")).write.mode("overwrite").option(
        "compression", "snappy"
    ).parquet(path)


def write_run(df: DataFrame, path: str, as_of: Column, form: str = "json") -> None:
    """Indicators or recommendations of one run, dated (SNK-10)."""
    dated = df.withColumn("as_of", as_of)
    dated.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("as_of").format(
        form
    ).save(path)


def check_table(df: DataFrame, key: str = "coin_id") -> DataFrame:
    """Row and key counts after a write (SNK-09)."""
    return df.agg(F.count(F.lit(1)).alias("rows"), F.count_distinct(key).alias("keys"))


def write_sketches(df: DataFrame, path: str, partition: str, columns: Sequence[str], changed: DataFrame | None = None) -> None:
    """Row counts and mergeable distinct-count sketches of each partition value, beside the table (AGG-09, SNK-09).

    With ``changed`` (partition values) only those partitions of ``df`` are read
    and only their sketches are written; the others stay. Sketches of partitions
    that are gone stay too, so write all of them after a full build.
    """
    if changed is not None:
        df = df.join(changed.select(partition).distinct(), partition, "left_semi")
    rows = df.groupBy(partition).agg(F.count(F.lit(1)).alias("rows"), *[
        F.hll_sketch_agg(F.col(c).cast("string"), F.lit(SKETCH_BITS)).alias(c) for c in columns])
    write_table(rows.withColumn("value", F.col(partition).cast("string")).drop(partition), path, ["value"], replace=changed is None)


def merged_counts(sketches: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row: rows, and about how many distinct values each column has, from the sketches alone.

    The standard error is about 1.04 / sqrt(2 ** SKETCH_BITS), 1.6 percent.
    """
    return sketches.agg(F.sum("rows").alias("rows"), *[F.hll_sketch_estimate(F.hll_union_agg(c)).alias(c) for c in columns])


def write_bucketed(df: DataFrame, name: str, key: str, order: Sequence[str], buckets: int, path: str, database: str = "gold") -> None:
    """A catalog table in ``buckets`` files' worth of hashed keys, each sorted by key and order (SNK-03, SNK-07).

    Windows and aggregates by key read it without a shuffle, and a million keys
    make no million folders. Rows are put to their bucket first, so that each
    bucket is one file; a key with very many rows makes its bucket long.
    """
    spread = df.repartition(buckets, key)
    (spread.write.mode("overwrite").option("path", path).option("compression", "snappy")
     .bucketBy(buckets, key).sortBy(key, *order).saveAsTable(f"{database}.{name}"))


# ---- catalog --------------------------------------------------------------


def create_database(spark: SparkSession, database: str = "gold") -> None:
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")


def create_table(spark: SparkSession, name: str, location: str, database: str = "gold", flat: bool = False) -> None:
    """External table over a gold folder (SNK-07)."""
    schema, partitions = GOLD_TABLES[name]
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    spread = f"PARTITIONED BY ({', '.join(partitions)})" if partitions and not flat else ""
    spark.sql(f"DROP TABLE IF EXISTS {database}.{name}")
    spark.sql(
        f"CREATE TABLE {database}.{name} ({columns}) USING PARQUET {spread} LOCATION '{location}'"
    )


def discover_partitions(spark: SparkSession, name: str, database: str = "gold") -> None:
    """Register partition folders written since (SNK-08); nothing to do for flat tables."""
    table = f"{database}.{name}"
    if any(c.isPartition for c in spark.catalog.listColumns(table)):
        spark.catalog.recoverPartitions(table)
    spark.catalog.refreshTable(table)
