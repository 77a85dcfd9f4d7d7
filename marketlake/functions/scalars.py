"""Scalar expressions: time, casts, case mapping and text formatting."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F


def col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def epoch_ms(ms: Column | str) -> Column:
    """Epoch milliseconds to a UTC timestamp (FLT-06)."""
    return F.timestamp_millis(col(ms).cast("bigint"))


def to_int(value: Column | str) -> Column:
    """Coercing integer cast: text that is not a number becomes null (FLT-08)."""
    return col(value).try_cast("double").try_cast("int")


def missing_as_null(value: Column | str) -> Column:
    """NaN and null are both 'missing'; Spark orders NaN above every number."""
    return F.nanvl(col(value).cast("double"), F.lit(None).cast("double"))


def defaulted(value: Column | str, default) -> Column:
    """Field access with a default (FLT-09)."""
    return F.coalesce(col(value), F.lit(default))


def title_case(value: Column | str) -> Column:
    """Upper-case the first letter of every run of letters, lower-case the rest (FLT-12)."""
    parts = F.split(F.lower(col(value)), r"(?<=[^\p{L}])")
    return F.array_join(F.transform(parts, F.initcap), "")


def strip_prefix(value: Column | str, prefix: str) -> Column:
    """Drop a leading ``prefix`` such as ``coin_id=`` (FLT-14)."""
    c = col(value)
    return F.when(c.startswith(prefix), F.substring(c, F.lit(len(prefix) + 1), F.length(c))).otherwise(c)


def last_path_part(path: Column | str, above: int = 0) -> Column:
    """File name of a path, or with ``above`` the name of a folder above it."""
    return F.element_at(F.split(col(path), "/"), -1 - above)


# a fraction is split as high * 2^43 + low over 2^73, both halves exact doubles
_HIGH, _LOW = 2**30, 2**43


def fixed(value: Column | str, places: int, comma: bool = False, plus: bool = False) -> Column:
    """Fixed-point text of a double, correctly rounded from its exact binary value (FLT-15).

    ``format_string`` and ``bround`` start from the shortest decimal text of a
    double, so 36.45 (binary 36.4500000000000028) would print as 36.4. Here the
    fraction is taken as a whole number over 2^73 (enough bits to see on which
    side of a tie it lies, up to 6 places) and rounded half-even in decimals.
    """
    if not 0 <= places <= 6:
        raise ValueError("0 to 6 places")
    x = col(value).cast("double")
    size = F.abs(x)
    step = F.lit(Decimal(_HIGH * _LOW))

    def scale(s: Column) -> Column:
        shifted = (s["size"] - s["whole"]) * F.lit(float(_HIGH))
        low = F.floor((shifted - F.floor(shifted)) * F.lit(float(_LOW)))
        bits = F.floor(shifted).cast("decimal(10,0)") * F.lit(_LOW).cast("decimal(14,0)") + low.cast("decimal(14,0)")
        scaled = bits * F.lit(10**places).cast("decimal(8,0)")
        return F.struct(s["whole"].alias("whole"), scaled.alias("scaled"))

    def divide(s: Column) -> Column:
        rest = s["scaled"] % step
        units = ((s["scaled"] - rest) / step).cast("bigint")
        return F.struct(s["whole"].alias("whole"), units.alias("units"), (rest * F.lit(2).cast("decimal(1,0)")).alias("twice"))

    def round_even(s: Column) -> Column:
        odd = (s["units"] % 2 == 1) if places else (s["whole"] % 2 == 1)
        up = (s["twice"] > step) | ((s["twice"] == step) & odd)
        return F.struct(s["whole"].alias("whole"), (s["units"] + F.when(up, 1).otherwise(0)).alias("digits"))

    def write(s: Column) -> Column:
        full = s["digits"] >= 10**places
        text = F.format_string("%,d" if comma else "%d", s["whole"] + F.when(full, 1).otherwise(0))
        if not places:
            return text
        return F.concat(text, F.lit("."), F.lpad((s["digits"] % 10**places).cast("string"), places, "0"))

    out = F.struct(size.alias("size"), F.floor(size).alias("whole"))
    for stage in (scale, divide, round_even, write):
        out = _bind(out, stage)
    # a negative number that rounds to zero keeps its minus sign
    negative = (x < 0) | (x.cast("string") == "-0.0")
    return F.when(x.isNotNull(), F.concat(F.when(negative, "-").otherwise("+" if plus else ""), out))


def _bind(value: Column, body) -> Column:
    """``body(value)`` with the value computed once, however often the body uses it."""
    return F.transform(F.array(value), body)[0]


def plain_number(value: Column | str) -> Column:
    """Shortest text of a double: plain digits from 0.0001 up, else like 1.2e-05."""
    x = col(value).cast("double")
    digits = F.regexp_replace(x.cast("decimal(38,10)").cast("string"), "0+$", "")
    plain = F.when(digits.endswith("."), F.concat(digits, F.lit("0"))).otherwise(digits)
    parts = F.split(x.cast("string"), "E-")
    small = F.concat(
        F.regexp_replace(parts[0], r"\.0$", ""), F.lit("e-"), F.lpad(F.try_element_at(parts, F.lit(2)), 2, "0")
    )
    return F.when((F.abs(x) < 1e-4) & (x != 0), small).otherwise(plain)


def signed_int(value: Column | str) -> Column:
    return F.format_string("%+d", col(value).cast("bigint"))


def percent(value: Column | str, places: int = 2) -> Column:
    """Signed percentage of a fraction."""
    return F.concat(fixed(col(value) * 100, places, plus=True), F.lit("%"))


def rsi_band(value: Column | str) -> Column:
    """Overbought / oversold label (FIL-08)."""
    c = col(value)
    return F.when(c > 70, "overbought").when(c < 30, "oversold").otherwise("")
