"""Vector bin packing of documents into shards.

Equal texts form a group, which stays whole. Small groups meet in hashed units; a
group above one quantum of any load is a unit of its own. Only a group that
alone exceeds a shard's capacity (one may hold a third of all rows) is cut into
pieces of a quantum. The number of units is bounded by a parameter, so their
loads fit on the driver, where the greedy rule places the heaviest unit first,
always into the shard whose residual capacity has the highest dot product with
the unit's load vector (bytes, words, rows, each as a share of its total).

Documents themselves are never gathered: loads are partial sums, a row finds
its shard by two bounded look-ups, and slots come from counts per (shard,
part) plus a row number within a part.

Defined results: a null text has no bytes and no words and groups with empty
texts; null ids sort first; equal rows get different slots in arbitrary order;
an empty table gives an empty result. Other columns are not touched.
"""

from __future__ import annotations

import math
from functools import reduce

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from marketlake.llm.common import documents, staged, word_count

SHARDS = 24
UNITS = 8192          # hashed units of small groups
QUANTA = 2048         # a group above 1/QUANTA of a total is a unit of its own
PART_ROWS = 4_000     # rows numbered in one task, on average
ROW_BYTES = 8         # added to each text's bytes

_UNIT = T.StructType([
    T.StructField("group", T.LongType()), T.StructField("pieces", T.IntegerType())])


def text_key(text: Column) -> Column:
    return F.xxhash64(F.coalesce(text, F.lit("")))


def text_size(text: Column) -> Column:
    return (F.coalesce(F.octet_length(text), F.lit(0)) + ROW_BYTES).cast("long")


def place(loads: np.ndarray, n_shards: int) -> np.ndarray:
    """Shard of each unit; ``loads`` has one row a unit, columns are shares of a total."""
    order = np.lexsort((np.arange(len(loads)), -loads.sum(axis=1), -loads.max(axis=1, initial=0.0)))
    residual = np.full((n_shards, loads.shape[1]), 1.0 / n_shards)
    shard = np.zeros(len(loads), dtype=np.int64)
    for unit in order:
        best = int(np.argmax(residual @ loads[unit]))
        shard[unit] = best
        residual[best] -= loads[unit]
    return shard


def pack(rows: DataFrame, loads: DataFrame, n_shards: int = SHARDS, part_rows: int = PART_ROWS) -> DataFrame:
    """Add ``shard`` and ``slot`` to ``rows``.

    Both frames hold one row a document with ``id`` and ``group``; ``loads`` has
    ``bytes`` and ``words`` too and should be narrow and stored, as it is read
    several times.
    """
    spark = rows.sparkSession
    names = ("bytes", "words", "rows")
    total = loads.agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in names[:2]], F.count(F.lit(1)).alias("rows")).head()
    quantum = [max(1, math.ceil(total[c] / QUANTA)) for c in names]
    pieces = F.greatest(*[F.ceil(F.col(c) / q) for c, q in zip(names, quantum)])
    # a group is whole unless no shard could hold it
    over = reduce(Column.__or__, [F.col(c) * n_shards > total[c] for c in names])
    # at most 3 x QUANTA groups can exceed a quantum of any of three loads
    large = (loads.groupBy("group").agg(*[F.sum(c).alias(c) for c in names[:2]], F.count(F.lit(1)).alias("rows"))
             .withColumn("pieces", pieces).where("rows > 1 and pieces > 1")
             .select("group", F.when(over, F.col("pieces")).otherwise(1).cast("int").alias("pieces")).collect())
    large_groups = F.broadcast(spark.createDataFrame(large, _UNIT))

    def unit(df):
        piece = F.pmod(F.xxhash64("id", F.lit("piece")), F.col("pieces"))
        return df.join(large_groups, "group", "left").withColumns({
            "unit": F.when(F.col("pieces").isNull(), F.pmod("group", F.lit(UNITS))).otherwise(F.col("group")),
            "piece": F.when(F.col("pieces").isNull(), F.lit(-1)).otherwise(piece).cast("int")}).drop("pieces")

    units = (unit(loads).groupBy("unit", "piece")
             .agg(*[F.sum(c).alias(c) for c in names[:2]], F.count(F.lit(1)).alias("rows")).orderBy("unit", "piece").collect())
    shares = np.array([[u[c] / max(1, total[c]) for c in names] for u in units]).reshape(len(units), 3)
    placed = [(u["unit"], u["piece"], int(s)) for u, s in zip(units, place(shares, n_shards))]
    shards = F.broadcast(spark.createDataFrame(placed, "unit long, piece int, shard int"))

    # about part_rows rows in each part of a shard, however many rows there are
    parts = max(1, math.ceil(total["rows"] / n_shards / part_rows))
    part = F.pmod(F.xxhash64("id", "group"), F.lit(parts)).cast("int")

    def sharded(df):
        return unit(df).join(shards, ["unit", "piece"]).drop("unit", "piece").withColumn("part", part)

    before = F.coalesce(F.sum("n").over(Window.partitionBy("shard").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    first = sharded(loads).groupBy("shard", "part").agg(F.count(F.lit(1)).alias("n")).select("shard", "part", before.alias("first"))
    number = F.row_number().over(Window.partitionBy("shard", "part").orderBy("id", "group")) - 1
    return (sharded(rows).withColumn("number", number).join(first, ["shard", "part"])
            .withColumn("slot", (F.col("first") + F.col("number")).cast("long")).drop("part", "number", "first"))


def shard_documents(docs: DataFrame, n_shards: int = SHARDS) -> DataFrame:
    """All columns of ``docs`` plus ``shard`` and ``slot`` (replacing columns of those names)."""
    text, ids = F.col("text"), F.col("doc_id")
    loads = staged(docs.select(ids.alias("id"), text_key(text).alias("group"), text_size(text).alias("bytes"),
                               word_count(text).alias("words")), "loads")
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns if c.lower() not in ("shard", "slot")]).alias("row"),
                       ids.alias("id"), text_key(text).alias("group"))
    return pack(rows, loads, n_shards).select("row.*", "shard", "slot")


def op5_sharding(spark, folder):
    """Contract 5 under the law ``bytes``."""
    text = F.col("text")
    rows = staged(documents(spark, folder).select(
        F.col("doc_id").cast("long").alias("id"), text_key(text).alias("group"), text_size(text).alias("bytes"),
        word_count(text).alias("words"), F.coalesce(F.crc32(text), F.lit(0)).cast("long").alias("crc")), "loads")
    return pack(rows, rows).select(
        F.col("id").alias("doc_id"), F.col("bytes").alias("size"), F.col("crc").alias("text_crc32"),
        F.lit("bytes").alias("law"), F.col("shard"), F.col("slot"), F.lit(None).cast("int").alias("grown_shard"),
        F.col("words").alias("n_words"))
