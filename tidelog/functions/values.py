"""Scalar conversions: literals to values, canonical texts, human figures, row ids."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

DAY_US = 86_400_000_000
MONTH_DAYS = 365.25 / 12


def hex_bytes(text: Column) -> Column:
    """Bytes of an even number of hex digits, null where they are not."""
    clean = F.trim(text)
    return F.when(clean.rlike("^([0-9A-Fa-f]{2})*$"), F.unhex(clean))


def local_time(text: Column, mask: str = "yyyy-MM-dd HH:mm:ss") -> Column:
    return F.try_to_timestamp(text, F.lit(mask)).cast("timestamp_ntz")


def nanos(text: Column) -> Column:
    """Fraction of a timestamp text in nanoseconds; Spark's timestamps keep microseconds."""
    return F.rpad(F.regexp_extract(text, r"\.(\d{1,9})", 1), 9, "0").cast("string").try_cast("long")


def zoned_instant(text: Column) -> Column:
    """Instant of ``... +hh:mm``; UTC where there is no offset."""
    clean = F.when(text.rlike(r"[+-]\d\d:\d\d$"), F.regexp_replace(text, r" ([+-]\d\d:\d\d)$", "$1")).otherwise(F.concat(text, F.lit("+00:00")))
    return F.try_to_timestamp(clean)


def months(text: Column) -> Column:
    """Months of ``+YY-MM``, the sign over both parts."""
    part = lambda k: F.regexp_extract(text, r"^([+-]?)(\d+)-(\d+)$", k)
    size = part(2).cast("long") * 12 + part(3).cast("long")
    return F.when(text.rlike(r"^[+-]?\d+-\d+$"), F.when(part(1) == "-", -size).otherwise(size))


def interval_micros(text: Column) -> Column:
    """Microseconds of ``+DD HH:MM:SS.f``, the sign over all parts."""
    shape = r"^([+-]?)(\d+) (\d+):(\d+):(\d+)(?:\.(\d{1,6})\d*)?$"
    part = lambda k: F.regexp_extract(text, shape, k)
    seconds = ((part(2).cast("long") * 24 + part(3).cast("long")) * 60 + part(4).cast("long")) * 60 + part(5).cast("long")
    size = seconds * 1_000_000 + F.rpad(part(6), 6, "0").cast("long")
    return F.when(text.rlike(shape), F.when(part(1) == "-", -size).otherwise(size))


def months_to_micros(count: Column) -> Column:
    """A month is a twelfth of 365.25 days; halves round up."""
    return F.floor(count * MONTH_DAYS * DAY_US + 0.5).cast("long")


def epoch(ts: Column, unit: str) -> Column:
    """Epoch of an instant in ms, us or ns, downward for times before 1970."""
    us = F.unix_micros(ts)
    return {"ms": F.floor(us / 1000).cast("long"), "us": us, "ns": us * 1000}[unit]


def canonical_number(text: Column) -> Column:
    """Plain digits without needless zeros; zero is ``0``."""
    cut = F.when(text.contains("."), F.regexp_replace(text, r"\.?0+$", "")).otherwise(text)
    cut = F.regexp_replace(cut, r"^(-?)0+(?=\d)", "$1")
    return F.when(cut.isin("", "-", "-0", "0"), "0").otherwise(cut)


def local_text(ts: Column) -> Column:
    """Local time text: seconds only where needed, the fraction in groups of three digits."""
    us = F.date_format(ts, "SSSSSS").cast("int")
    base = F.date_format(ts, "yyyy-MM-dd'T'HH:mm")
    return (
        F.when((us == 0) & (F.second(ts) == 0), base)
        .when(us == 0, F.concat(base, F.date_format(ts, ":ss")))
        .when(us % 1000 == 0, F.concat(base, F.date_format(ts, ":ss.SSS")))
        .otherwise(F.concat(base, F.date_format(ts, ":ss.SSSSSS")))
    )


def human_bytes(b: Column) -> Column:
    gib = 1 << 30
    whole = lambda d: F.floor(b / d).cast("long").cast("string")
    return (
        F.when(b < 1 << 20, F.concat(whole(1 << 10), F.lit(" KiB")))
        .when(b < gib, F.concat(whole(1 << 20), F.lit(" MiB")))
        .when(b % gib == 0, F.concat(whole(gib), F.lit(" GiB")))
        .otherwise(F.concat(F.format_string("%.1f", b / gib), F.lit(" GiB")))
    )


def human_minutes(m: Column) -> Column:
    h, rest = F.floor(m / 60).cast("long").cast("string"), (m % 60).cast("string")
    return F.when(m < 60, F.concat(rest, F.lit(" min"))).when(m % 60 == 0, F.concat(h, F.lit(" h"))).otherwise(F.concat(h, F.lit(" h "), rest, F.lit(" min")))


def rowid_part(rowid: Column) -> Column:
    """The real part of a row id that carries a synthetic ``#R``, ``#L`` or ``#X`` mark."""
    return F.when(rowid.rlike("#[RLX]"), F.nullif(F.substring_index(rowid, "#", 1), F.lit(""))).otherwise(rowid)


def decimal_struct(text: pd.Series) -> pd.DataFrame:
    """Scale and big-endian two's-complement unscaled value of decimal texts."""
    from decimal import Decimal, InvalidOperation

    out = []
    for x in text:
        try:
            sign, digits, exponent = Decimal(x).as_tuple()
            scale = max(0, -exponent)
            unscaled = int("".join(map(str, digits))) * 10 ** max(0, exponent) * (-1 if sign else 1)
            out.append((scale, unscaled.to_bytes((unscaled.bit_length() if unscaled >= 0 else (unscaled + 1).bit_length()) // 8 + 1, "big", signed=True)))
        except (InvalidOperation, TypeError, ValueError):
            out.append((None, None))
    return pd.DataFrame(out, columns=["scale", "value"])


variable_decimal = F.pandas_udf(decimal_struct, T.StructType([T.StructField("scale", T.IntegerType()), T.StructField("value", T.BinaryType())]))
