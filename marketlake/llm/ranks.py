"""Positions in an order, without one task for a whole key."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from marketlake.llm.common import staged


def numbered(rows: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """``rows`` plus ``pos`` (from 0) within ``keys`` in the order of ``order``, and ``n``, the number of rows of the key.

    The rows are cut into ranges of (keys, order), so a key with a third of all
    rows is spread over a third of the ranges. A row's position is its number
    within its range plus the rows of its key in earlier ranges. Rows that tie
    get arbitrary positions among themselves, and may lie in several ranges.
    ``rows`` should be stored: it is sampled and read. Keys must not be null.
    """
    ranges = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    salted = rows.withColumn("tie", F.xxhash64(F.monotonically_increasing_id()))
    cut = staged(salted.repartitionByRange(ranges, *keys, *order, "tie").withColumn("part", F.spark_partition_id()), "ranges")

    by_part = Window.partitionBy(*keys).orderBy("part")
    before = F.sum("here").over(by_part.rowsBetween(Window.unboundedPreceding, -1))
    counts = (cut.groupBy(*keys, "part").agg(F.count(F.lit(1)).alias("here"))
              .withColumn("before", F.coalesce(before, F.lit(0)).cast("long"))
              .withColumn("n", F.sum("here").over(Window.partitionBy(*keys)).cast("long")).drop("here"))
    number = F.row_number().over(Window.partitionBy("part", *keys).orderBy(*order, "tie")) - 1
    return (cut.withColumn("number", number).join(counts, [*keys, "part"])
            .withColumn("pos", (F.col("before") + F.col("number")).cast("long")).drop("tie", "part", "number", "before"))
