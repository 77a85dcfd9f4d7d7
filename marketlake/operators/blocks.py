"""Long series cut into blocks, recursive averages as a scan of affine maps, and blocks with rows in front for rolling frames.

A recursive average turns the state in front of a run of rows into the state
behind it by a map ``state -> a * state + b``. Such maps compose, so a series
needs no pass in order by one task:

1. rows are cut into blocks of consecutive rows of a key. A series by date is
   cut by the calendar (dates are unique within a key, so a bucket of ``DAYS``
   days holds at most that many rows); other orders are cut by sampled ranges of
   (key, order), or by a bucket that the caller names;
2. each block is scanned on its own, from a state of zero, by running sums of one
   window; the result is written;
3. each block's map, one row, is composed with those in front of it, which gives
   the state that comes in, the block's place within its key, and the value in
   front of it;
4. the written rows take up the state of their block: an ordinary join.

``a`` is a power of the factor and the number of rows, so a state in front of
enough rows is zero in a double and the maps that matter are few.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marketlake.session import written

# rows of a block at most, and days of a bucket of dates
BLOCK = 2048
DAYS = 2048
# factor**-rows must stay well inside the double range within a block
LARGEST_SCALE = 1e200
# powers of a factor below exp(-745) are zero in a double
ZERO = 745.0


def ema_keep(span: int) -> float:
    """Factor of an EMA: weight 2/(span+1) on the new value (WIN-07)."""
    return 1.0 - 2.0 / (span + 1)


def wilder_keep(period: int) -> float:
    """Factor of Wilder's average; its normaliser cancels in a ratio."""
    return 1.0 - 1.0 / period


def size_for(keeps: list[float], size: int | None = None) -> int:
    """Rows of a block: few enough that no scale factor leaves the double range."""
    fastest = min((k for k in keeps if k > 0), default=0.5)
    return max(1, min(BLOCK if size is None else size, int(math.log(LARGEST_SCALE) / -math.log(fastest))))


def _in_buckets(df: DataFrame, key: str, order: str, bucket: Column | None) -> tuple[DataFrame, bool]:
    """``df`` with ``_bucket``, which rises with ``order`` within a key; whether it is known to hold at most ``DAYS`` rows of a key."""
    if bucket is not None:
        return df.withColumn("_bucket", bucket), False
    if isinstance(df.schema[order].dataType, T.DateType):
        return df.withColumn("_bucket", F.floor(F.unix_date(order) / DAYS)), True
    ranges = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return df.repartitionByRange(ranges, key, order).withColumn("_bucket", F.spark_partition_id()), False


def scan(
    df: DataFrame, key: str, order: str, value: str, smooth: dict[str, float] | None = None,
    steps: dict[tuple[str, str], float] | None = None, bucket: Column | None = None, size: int | None = None,
) -> DataFrame:
    """Decayed sums along every series, with ``pos``, the 0-based place of a row within its key, and ``base``.

    ``order`` is unique within a key and not null, nor is ``value``. A column of
    ``smooth`` (name: factor) is the sum of factor**age * (value - base) over the
    rows up to this one, with ``base`` the first value of the key: an EMA seeded
    with the first value is base + (1 - factor) * sum. The two columns of an entry
    of ``steps`` are the like sums of the rises and of the falls between
    neighbouring rows. Blocks hold at most ``size`` rows. Without a date as order
    and without ``bucket`` the input is read twice, the first time for a sample.
    """
    smooth, steps = smooth or {}, steps or {}
    sums = {**smooth, **{name: keep for names, keep in steps.items() for name in names}}
    size = size_for(list(sums.values()), size)
    columns = df.columns
    rows, bounded = _in_buckets(df, key, order, bucket)
    by_bucket = Window.partitionBy(key, "_bucket").orderBy(order)
    x = F.col(value)
    rows = rows.withColumn("_n", F.row_number().over(by_bucket) - 1)
    if steps:
        rows = rows.withColumn("_step", x - F.lag(x).over(by_bucket))
    if bounded and size >= DAYS:
        rows, block = rows.withColumn("_block", F.lit(0)), by_bucket
    else:
        rows = rows.withColumn("_block", F.floor(F.col("_n") / size).cast("int"))
        block = Window.partitionBy(key, "_bucket", "_block").orderBy(order)
    up_to = block.rowsBetween(Window.unboundedPreceding, 0)
    # from here on _n counts within the block
    rows = rows.withColumns({"_n": F.col("_n") - F.col("_block") * size, "_first": F.first(x).over(up_to)})
    step = F.coalesce("_step", F.lit(0.0)) if steps else None
    terms = {**{name: x - F.col("_first") for name in smooth},
             **{rise: F.greatest(step, F.lit(0.0)) for rise, _ in steps}, **{fall: F.greatest(-step, F.lit(0.0)) for _, fall in steps}}

    def own(name: str, keep: float) -> Column:
        if keep <= 0:
            return terms[name]
        return F.pow(F.lit(keep), "_n") * F.sum(terms[name] * F.pow(F.lit(1.0 / keep), "_n")).over(up_to)

    local = written(rows.withColumns({name: own(name, keep) for name, keep in sums.items()}).drop("_step"), "blocks")
    states = _states(local, key, value, smooth, steps, sums)
    n = F.col("_n")
    out = local.join(states, [key, "_bucket", "_block"])

    def whole(name: str, keep: float) -> Column:
        if keep <= 0:
            return F.col(name) + _from_start(name, keep, n, smooth, steps)
        return F.col(name) + _from_start(name, keep, n, smooth, steps) + F.pow(F.lit(keep), n + 1) * F.col(f"_{name}_in")

    return out.select(*[F.col(f"`{c}`") for c in columns], (F.col("_start") + n).alias("pos"), F.col("_base").alias("base"),
                      *[whole(name, keep).alias(name) for name, keep in sums.items()])


def _from_start(name: str, keep: float, n: Column, smooth: dict, steps: dict) -> Column:
    """What a block's own scan lacks at its row ``n``: values count from the key's base, and the first row has a step too."""
    if name in smooth:
        return (F.col("_first") - F.col("_base")) * (1.0 - F.pow(F.lit(keep), n + 1)) / (1.0 - keep)
    rises = any(name == rise for rise, _ in steps)
    entry = F.greatest(F.col("_entry") if rises else -F.col("_entry"), F.lit(0.0))
    return entry * (F.pow(F.lit(keep), n) if keep > 0 else F.when(n == 0, 1.0).otherwise(0.0))


def _states(local: DataFrame, key: str, value: str, smooth: dict, steps: dict, sums: dict) -> DataFrame:
    """One row a block: its place, the key's base, the step into it, and the state that the blocks in front of it leave.

    The windows run over blocks, not over rows.
    """
    n = F.col("_n")
    blocks = local.groupBy(key, "_bucket", "_block").agg(
        F.count(F.lit(1)).alias("_rows"), F.first("_first").alias("_first"), F.max_by(value, "_n").alias("_last"),
        *[F.max_by(name, "_n").alias(name) for name in sums])
    order = Window.partitionBy(key).orderBy("_bucket", "_block")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    # the first step of a bucket is not seen within it; that of a later block of the bucket is
    entry = F.when(F.col("_block") == 0, F.coalesce(F.col("_first") - F.lag("_last").over(order), F.lit(0.0))).otherwise(0.0)
    placed = blocks.withColumns({
        "_start": F.coalesce(F.sum("_rows").over(before), F.lit(0)), "_base": F.first("_first").over(order), "_entry": entry, "_n": F.col("_rows") - 1})
    behind = placed.withColumns({name: F.col(name) + _from_start(name, keep, n, smooth, steps) for name, keep in sums.items()})
    moving = {name: keep for name, keep in sums.items() if keep > 0}
    if not moving:
        return behind.select(key, "_bucket", "_block", "_start", "_base", *(["_entry"] if steps else []))
    # blocks whose end lies so far back that every power is zero do not count
    reach = math.ceil(ZERO / min(-math.log(k) for k in moving.values())) + 2 * BLOCK
    near = Window.partitionBy(key).orderBy("_start").rangeBetween(-reach, -1)
    earlier = F.collect_list(F.struct((F.col("_start") + F.col("_rows")).alias("end"), *moving)).over(near)
    listed = behind.withColumn("_maps", earlier)

    def state(name: str, keep: float) -> Column:
        return F.aggregate("_maps", F.lit(0.0), lambda total, m: total + m[name] * F.pow(F.lit(keep), F.col("_start") - m["end"]))

    return listed.select(key, "_bucket", "_block", "_start", "_base", *(["_entry"] if steps else []),
                         *[state(name, keep).alias(f"_{name}_in") for name, keep in moving.items()])


# ---- blocks for rolling frames -------------------------------------------------


def cut(df: DataFrame, halo: int, size: int = BLOCK) -> DataFrame:
    """Add ``block`` and ``ghost``; needs ``pos``.

    A rolling frame of a block's first rows reaches back into the block before:
    copies of its last ``halo`` rows come along as ghosts.
    """
    own = F.floor(F.col("pos") / size)
    homes = F.transform(F.sequence(F.lit(0), F.lit(-(-halo // size))), lambda i: own + i)
    # a row belongs to its own block and is a ghost where the block starts within reach
    near = F.filter(homes, lambda b: b * size - F.col("pos") <= halo)
    return df.withColumn("block", F.explode(near)).withColumn("ghost", F.col("block") != own)


def in_block(key: str) -> WindowSpec:
    return Window.partitionBy(key, "block").orderBy("pos")


def own_rows(df: DataFrame) -> DataFrame:
    """Drop the ghosts and the helper columns."""
    return df.where(~F.col("ghost")).drop("ghost", "block")
