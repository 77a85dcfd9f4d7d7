"""Raw JSON responses (SRC-01..03, SRC-05, SNK-01).

A response is a file of its own in the folders of its feed, or, where a feed has
very many, a row of the table ``PACKED`` in the feed's folder, under the path it
would have as a file. The readers take both.
"""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marketlake import schemas
from marketlake.functions.scalars import last_path_part

# hidden from Spark's listings of files, like all names that begin so
PACKED = "_packed"
# what Spark's writers put into folder names for values that are missing, and for characters that paths do not hold
NO_VALUE = "__HIVE_DEFAULT_PARTITION__"
_ESCAPED = "%\"#'*/:=?\\{[]^"


def path_exists(spark: SparkSession, path: str) -> bool:
    """True if ``path`` exists on whatever file system it names."""
    jvm = spark._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()).exists(target)


def child_folders(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders directly below ``path``: one listing, nothing is read."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    listed = target.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(target)
    return [f.getPath().getName() for f in listed if f.isDirectory()]


def delete_folder(spark: SparkSession, path: str) -> None:
    """Delete a folder, if it is there."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def list_files(spark: SparkSession, path: str) -> DataFrame:
    """``file_path`` of every file below a folder, packed ones included; empty without the folder. No file is opened."""
    if not path_exists(spark, path):
        return spark.createDataFrame([], "file_path string")
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    files = files.select(F.col("_metadata.file_path").alias("file_path"))
    packed = _packed(spark, path)
    return files if packed is None else files.union(packed.select("file_path"))


def _packed(spark: SparkSession, path: str) -> DataFrame | None:
    """(value, file_path) of the packed responses of a feed, if it has any."""
    folder = f"{path}/{PACKED}"
    return spark.read.schema("value string, file_path string").parquet(folder) if path_exists(spark, folder) else None


def _texts(spark: SparkSession, path: str) -> DataFrame:
    """(value, file_path) of every response of a feed."""
    text = _with_origin(spark.read.option("recursiveFileLookup", "true").text(path, wholetext=True)).select("value", "file_path")
    packed = _packed(spark, path)
    return text if packed is None else text.union(packed)


def _with_origin(df: DataFrame) -> DataFrame:
    return df.select("*", F.col("_metadata.file_path").alias("file_path"))


def read_records(spark: SparkSession, path: str, schema: T.StructType, required: bool = False) -> DataFrame:
    """Files that each hold an array of objects, one row per object (SRC-01).

    Adds ``file_path`` and ``pos``, the place within the file, so that the
    order of the feed survives. A response file is one page of a feed; Spark
    packs many of them into a task. A missing folder gives an empty frame, or
    an error if ``required`` (SRC-05).
    """
    full = T.StructType([*schema.fields, T.StructField("file_path", T.StringType()), T.StructField("pos", T.IntegerType())])
    if not path_exists(spark, path):
        return _missing(spark, path, full, required)
    rows = _texts(spark, path).select(
        "file_path", F.posexplode(F.from_json("value", T.ArrayType(schema))).alias("pos", "_r")
    )
    return rows.select(*[F.col(f"_r.`{f.name}`").alias(f.name) for f in schema.fields], "file_path", "pos")


def read_objects(spark: SparkSession, path: str, schema: T.StructType, required: bool = False) -> DataFrame:
    """Files that each hold one object (SRC-02); adds ``file_path``."""
    full = T.StructType([*schema.fields, T.StructField("file_path", T.StringType())])
    if not path_exists(spark, path):
        return _missing(spark, path, full, required)
    reader = spark.read.schema(schema).option("multiLine", "true").option("recursiveFileLookup", "true")
    files, packed = _with_origin(reader.json(path)), _packed(spark, path)
    if packed is None:
        return files
    # as the reader has it: a response that is no object gives a row of nulls, an array one row an object
    rows = packed.select("file_path", F.explode_outer(F.from_json("value", T.ArrayType(schema))).alias("_r"))
    return files.union(rows.select(*[F.col(f"_r.`{f.name}`").alias(f.name) for f in schema.fields], "file_path"))


def read_arrays(
    spark: SparkSession, path: str, element: str = schemas.CANDLES, required: bool = False
) -> DataFrame:
    """Files that each hold a bare array of arrays, as column ``items`` (SRC-03).

    The JSON source cannot make rows of bare arrays, so the file text is parsed.
    """
    if not path_exists(spark, path):
        empty = spark.createDataFrame([], f"items {element}, file_path string")
        return _missing(spark, path, empty.schema, required)
    return _texts(spark, path).select(F.from_json("value", element).alias("items"), "file_path")


def _missing(spark: SparkSession, path: str, schema: T.StructType, required: bool) -> DataFrame:
    if required:
        raise FileNotFoundError(f"no raw data at {path}")
    return spark.createDataFrame([], schema)


def folder_value(levels_above_file: int) -> Column:
    """Name of a folder above the file; of a ``column=value`` folder only the value."""
    return F.regexp_replace(last_path_part("file_path", levels_above_file), "^[^=]*=", "")


def dataset_folder(levels_above_file: int = 2) -> Column:
    """The id a response belongs to: ``{dataset}/{id}/{date}/file``."""
    return folder_value(levels_above_file)


def fetch_date(levels_above_file: int = 1) -> Column:
    """Date folder of a response; null if the folder is no date."""
    return folder_value(levels_above_file).try_cast("date")


def write_bronze(df: DataFrame, path: str, partitions: list[str], mode: str = "append") -> None:
    """Write rows untouched as JSON per source, dataset and date (SNK-01).

    Part file names are unique, so two flushes within a second never collide.
    """
    df.write.mode(mode).partitionBy(*partitions).json(path)


def write_responses(df: DataFrame, path: str, partitions: list[str], body: str = "value") -> None:
    """Write response bodies, one file per partition folder, body text unchanged."""
    df.select(*partitions, body).repartition(*partitions).write.mode("append").partitionBy(*partitions).text(path)


def write_packed(df: DataFrame, path: str, partitions: list[str], body: str = "value") -> None:
    """Response bodies as rows of one table, each under the path that ``write_responses`` would give it.

    For feeds of very many responses: no file, folder or task a response.
    """
    def folder(name: str) -> Column:
        value = F.coalesce(F.nullif(F.col(name).cast("string"), F.lit("")), F.lit(NO_VALUE))
        value = reduce(lambda v, c: F.replace(v, F.lit(c), F.lit(f"%{ord(c):02X}")), _ESCAPED, value)
        return F.concat(F.lit(f"/{name}="), value)

    name = F.concat(F.lit(f"/part-{uuid.uuid4().hex}-"), F.monotonically_increasing_id().cast("string"))
    packed = df.select(F.col(body).alias("value"), F.concat(F.lit(path), *[folder(c) for c in partitions], name).alias("file_path"))
    packed.write.mode("append").option("compression", "zstd").parquet(f"{path}/{PACKED}")
