"""Nested responses to flat rows (FLT-01..05)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marketlake.functions.scalars import epoch_ms


def _leaves(schema: T.StructType, path: tuple[str, ...] = ()) -> list[tuple[str, ...]]:
    out: list[tuple[str, ...]] = []
    for field in schema.fields:
        here = (*path, field.name)
        if isinstance(field.dataType, T.StructType):
            out.extend(_leaves(field.dataType, here))
        else:
            out.append(here)
    return out


def flatten_struct(df: DataFrame) -> DataFrame:
    """Nested objects become dotted columns (``a.b``); arrays stay as they are."""
    cols = []
    for path in _leaves(df.schema):
        cols.append(F.col(".".join(f"`{p}`" for p in path)).alias(".".join(path)))
    return df.select(*cols)


def flatten_records(df: DataFrame, ingestion_time: Column) -> DataFrame:
    """Rows of objects to flat columns plus ``ingestion_time`` (FLT-01, FLT-05)."""
    return flatten_struct(df).withColumn("ingestion_time", ingestion_time)


def flatten_wrapped(df: DataFrame, ingestion_time: Column) -> DataFrame:
    """Unwrap ``data`` if present and keep only non-object fields (FLT-02)."""
    inner = df.select("data.*") if "data" in df.columns else df
    keep = [
        f.name for f in inner.schema.fields
        if not isinstance(f.dataType, (T.StructType, T.MapType))
    ]
    return inner.select(*[F.col(f"`{c}`") for c in keep]).withColumn("ingestion_time", ingestion_time)


def flatten_chart(df: DataFrame, keep: list[str], ingestion_time: Column) -> DataFrame:
    """Zip three [ms, value] arrays by position, cut to the shortest (FLT-03).

    A missing array counts as empty, so the response gives no rows. The time
    comes from ``prices`` only. ``pos`` is the place within the response.
    """
    def pairs(name: str) -> Column:
        return F.coalesce(F.col(name), F.array().cast("array<array<double>>"))

    names = ["prices", "market_caps", "total_volumes"]
    shortest = F.least(*[F.size(pairs(n)) for n in names])
    zipped = F.arrays_zip(*[F.slice(pairs(n), F.lit(1), shortest).alias(n) for n in names])
    rows = df.select(*keep, F.posexplode(zipped).alias("pos", "_z"))
    return rows.select(
        *keep,
        "pos",
        epoch_ms(F.col("_z.prices")[0]).alias("timestamp"),
        F.col("_z.prices")[1].alias("price_usd"),
        F.col("_z.market_caps")[1].alias("market_cap_usd"),
        F.col("_z.total_volumes")[1].alias("volume_usd"),
        ingestion_time.alias("ingestion_time"),
    )


def flatten_candles(df: DataFrame, candles: str, keep: list[str], ingestion_time: Column) -> DataFrame:
    """[ms, open, high, low, close] arrays to rows (FLT-04)."""
    rows = df.select(*keep, F.posexplode(candles).alias("pos", "_c"))
    named = [F.col("_c")[i + 1].alias(n) for i, n in enumerate(["open", "high", "low", "close"])]
    return rows.select(
        *keep, "pos", epoch_ms(F.col("_c")[0]).alias("timestamp"), *named,
        ingestion_time.alias("ingestion_time"),
    )
