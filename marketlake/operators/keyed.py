"""Keyed row selection: dedup, latest, top-k, pages, set operations.

Every operator here is either a grouped aggregate with a map-side partial (so
a hot key shrinks to one row per task before the shuffle) or a bounded top-k
that Spark prunes per task first.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _keep(df: DataFrame, keys: Sequence[str], order: Sequence[str], best, best_by) -> DataFrame:
    # quoted: flattened feeds have dots in their column names
    rest = [c for c in df.columns if c not in keys]
    if len(order) == 1:
        # One buffer per column: with fixed-width columns this is a hash
        # aggregate without any sort. Every column sees the rows in the same
        # order, so equal orders still give the columns of one and the same row.
        at = F.col(f"`{order[0]}`")
        return df.groupBy(*keys).agg(*[
            (best(at) if c == order[0] else best_by(F.col(f"`{c}`"), at)).alias(c) for c in rest
        ])
    # one comparable row, the order columns first
    others = [c for c in rest if c not in order]
    row = F.struct(*[F.col(f"`{c}`") for c in (*order, *others)])
    picked = df.groupBy(*keys).agg(best(row).alias("_row"))
    return picked.select(*keys, *[F.col("_row")[c].alias(c) for c in rest])


def keep_last(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """One row per key: the one with the greatest ``order`` (AGG-11, AGG-12).

    ``order`` columns must not be null.
    """
    return _keep(df, keys, order, F.max, F.max_by)


def keep_first(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """One row per key: the one with the smallest ``order`` (AGG-10)."""
    return _keep(df, keys, order, F.min, F.min_by)


def first_seen(df: DataFrame, key: str, order: Sequence[str], n: int | None = None) -> DataFrame:
    """Distinct keys in order of first appearance, optionally the first ``n`` (AGG-13)."""
    seen = (
        df.where(F.col(key).isNotNull() & (F.col(key) != ""))
        .groupBy(key)
        .agg(F.min(F.struct(*order)).alias("_at"))
    )
    out = seen.orderBy("_at", key)
    if n is not None:
        out = out.limit(n)
    return out.select(key, *[F.col("_at")[c].alias(c) for c in order])


def latest_with_ties(df: DataFrame, key: str, order: str) -> DataFrame:
    """Rows whose ``order`` equals the greatest of their key, ties kept (JN-04).

    A hash aggregate finds the greatest; no task sorts its rows. The frame is
    read twice, the first time for two columns.
    """
    newest = df.groupBy(key).agg(F.max(order).alias(order))
    return df.join(newest, [key, order], "left_semi")


def top_per_group(df: DataFrame, keys: Sequence[str], order: Sequence[Column], k: int) -> DataFrame:
    """The first ``k`` rows of each group; ``rank`` is 1..k.

    The filter on ``row_number`` becomes a per-task group limit, so at most
    ``k`` rows per group and task reach the shuffle however hot a group is.
    """
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("rank", rank).where(F.col("rank") <= k)


def latest_value(df: DataFrame, value: str, order: str, keys: Sequence[str] = ()) -> DataFrame:
    """Last non-null value of a series (AGG-15)."""
    pick = F.max_by(F.col(value), F.col(order)).alias(value)
    return df.where(F.col(value).isNotNull()).groupBy(*keys).agg(pick)


def page(df: DataFrame, order: Sequence[Column], number: int, size: int) -> DataFrame:
    """Page ``number`` (from 1) of a ranked list (TOP-09).

    An ordered take without a global window. It holds all rows up to the end of
    the page, so it is meant for leading pages; walk a long list by its key.
    """
    return df.orderBy(*order).offset((number - 1) * size).limit(size)


def page_after(df: DataFrame, order: Sequence[str], last: Sequence, size: int) -> DataFrame:
    """The page that follows the row whose ``order`` columns are ``last`` (TOP-09).

    The order is ascending, unique and without nulls. Each task keeps ``size`` rows
    however deep the page is.
    """
    beyond = F.struct(*[F.col(c) for c in order]) > F.struct(*[F.lit(v).alias(c) for c, v in zip(order, last)])
    return df.where(beyond).orderBy(*order).limit(size)


def remaining(todo: DataFrame, done: DataFrame, key: str) -> DataFrame:
    """Rows whose key is not in the completed manifest (JN-06, SET-04)."""
    return todo.join(done.select(key).where(F.col(key).isNotNull()), key, "left_anti")


def mark_done(done: DataFrame, more: DataFrame, key: str) -> DataFrame:
    """The manifest after adding keys (SET-05)."""
    return done.select(key).union(more.select(key)).distinct()


def reset_done(done: DataFrame, keys: DataFrame | None = None, key: str = "id") -> DataFrame:
    """The manifest after taking keys back: all of them, or those in ``keys`` (SET-05)."""
    if keys is None:
        return done.select(key).limit(0)
    return done.select(key).join(keys.select(key).distinct(), key, "left_anti")


def upsert(base: DataFrame, changes: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Union with the changes winning on equal keys (SET-02, PAT-02)."""
    tagged = base.withColumn("_turn", F.lit(0)).unionByName(
        changes.withColumn("_turn", F.lit(1)), allowMissingColumns=True
    )
    return keep_last(tagged, keys, ["_turn"]).drop("_turn")
