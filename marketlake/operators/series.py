"""Window expressions over one keyed, ordered series.

These take a window, so the caller decides the partitioning:

* a *daily* series is partitioned by its key alone. ``(key, date)`` is unique
  after the gold dedup, so one partition holds at most one row per calendar
  day (36,525 per century), however many raw rows the key had;
* a series without such a bound is first cut into blocks
  (``marketlake.operators.blocks``) and partitioned by (key, block).

Missing values must be null, never NaN: Spark orders NaN above all numbers.
"""

from __future__ import annotations

from pyspark.sql import Column, Window, WindowSpec
from pyspark.sql import functions as F

from marketlake.functions.scalars import col


def by_time(key: str, order: str) -> WindowSpec:
    return Window.partitionBy(key).orderBy(order)


def previous(value: Column | str, w: WindowSpec) -> Column:
    return F.lag(col(value), 1).over(w)


def simple_return(price: Column | str, w: WindowSpec) -> Column:
    """(p - prev) / prev, null if there is no previous price or it is 0 (WIN-02)."""
    prev = previous(price, w)
    return F.when(prev.isNotNull() & (prev != 0), (col(price) - prev) / prev)


def rolling(agg: Column, value: Column | str, n: int, w: WindowSpec) -> Column:
    """``agg`` over the last ``n`` rows, null until the frame holds ``n`` values."""
    frame = w.rowsBetween(-(n - 1), 0)
    return F.when(F.count(col(value)).over(frame) == n, agg.over(frame))


def sma(value: Column | str, n: int, w: WindowSpec) -> Column:
    """Simple moving average (WIN-04)."""
    return rolling(F.avg(col(value)), value, n, w)


def rolling_std(value: Column | str, n: int, w: WindowSpec) -> Column:
    return rolling(F.stddev_samp(col(value)), value, n, w)


def bollinger(value: Column | str, w: WindowSpec, n: int = 20, width: float = 2.0):
    """Upper, middle and lower band: mean +- ``width`` sample deviations (WIN-05)."""
    middle = sma(value, n, w)
    band = rolling_std(value, n, w) * F.lit(float(width))
    return middle + band, middle, middle - band


def volume_ratio(volume: Column | str, w: WindowSpec, n: int = 20) -> Column:
    """Volume against its ``n``-row mean; a zero mean gives null (WIN-06)."""
    return F.try_divide(col(volume), F.nullif(sma(volume, n, w), F.lit(0.0)))


def gain_loss(value: Column | str, w: WindowSpec) -> tuple[Column, Column]:
    """Positive and negative part of the first difference, 0 on the first row (WIN-10)."""
    step = F.coalesce(col(value) - previous(value, w), F.lit(0.0))
    return F.greatest(step, F.lit(0.0)), F.greatest(-step, F.lit(0.0))


def gap_percent(price: Column | str, average: Column | str) -> Column:
    """Percent above or below an average (WIN-12); null for a missing or zero average."""
    return (F.try_divide(col(price), F.nullif(col(average), F.lit(0.0))) - 1) * 100


def band_position(price: Column | str, lower: Column | str, upper: Column | str) -> Column:
    """0 at the lower band, 1 at the upper, 0.5 for a band without width (WIN-13)."""
    width = col(upper) - col(lower)
    return F.when(width > 0, F.try_divide(col(price) - col(lower), width)).otherwise(0.5)
