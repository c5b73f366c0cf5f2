"""Conversions of single values as Column expressions: from text output or from native types."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from parquill.settings import MacLayout, Rounding

DAY_MS = 86_400_000


def as_text(c: Column, src: T.DataType) -> Column:
    return c if isinstance(src, T.StringType) else c.cast("string")


def truncated(text: Column, scale: int, precision: int = 38) -> Column:
    """Decimal text cut after `scale` digits, so that no cast can round it.

    Exponents are written out first, with as many digits as the target's whole part leaves room for.
    """
    plain = F.when(text.rlike("[eE]"), text.try_cast(f"decimal(38,{38 - (precision - scale)})").cast("string")).otherwise(text)
    cut = F.regexp_replace(plain, r"^(\s*[-+]?[0-9]*)\.([0-9]{%d})[0-9]+\s*$" % scale, "$1.$2")
    return F.regexp_replace(cut, r"\.$", "")


def to_decimal(c: Column, src: T.DataType, precision: int, scale: int, rounding: Rounding) -> Column:
    """NULL for NaN, infinities and what does not fit."""
    text = as_text(c, src)
    if rounding is Rounding.TRUNCATE:
        text = truncated(text, scale, precision)
    return text.try_cast(f"decimal({precision},{scale})")


def to_float(c: Column, src: T.DataType, kind: str) -> Column:
    """Through the decimal digits, as text has them; NaN and infinities stay."""
    return c.cast(kind) if isinstance(src, T.FloatType | T.DoubleType) else as_text(c, src).cast(kind)


def money(c: Column, src: T.DataType) -> Column:
    """Amounts as numbers or as text with a decimal point: $1,234.56, -$0.01, ($5.00).

    NULL for any other text, as 1.234,56 or 1 234,56: what a comma or space means there is not known.
    """
    if not isinstance(src, T.StringType):
        return c.cast("string").try_cast("decimal(18,2)")
    digits = F.regexp_replace(c, "[^0-9.]", "")
    sign = F.when(c.rlike(r"^\s*(-|\()|-\s*$"), F.lit("-")).otherwise(F.lit(""))
    understood = c.rlike(r"^\s*[-(]?\s*[^0-9.,\s()-]{0,4}\s*-?(?:[0-9]{1,3}(?:,[0-9]{3})+|[0-9]+)(?:\.[0-9]{1,2})?\s*[^0-9.,\s()-]{0,4}[-)]?\s*$")
    return F.when(understood, F.concat(sign, digits).try_cast("decimal(18,2)"))


def char_code(c: Column) -> Column:
    """The byte of a "char" as 0 to 255; bytes above 127 come as octal escapes."""
    octal = F.conv(F.substr(c, F.lit(2)), 8, 10)
    code = F.when(c.rlike(r"^\\[0-7]{3}$"), octal.cast("int")).otherwise(F.ascii(c))
    return code.bitwiseAND(F.lit(255)).cast("smallint")


def bytea(c: Column, src: T.DataType) -> Column:
    if isinstance(src, T.BinaryType):
        return c
    return F.when(c.startswith("\\x"), F.unhex(F.substr(c, F.lit(3)))).otherwise(c.cast("binary"))


def uuid_text(c: Column, src: T.DataType) -> Column:
    if isinstance(src, T.BinaryType):
        return F.regexp_replace(F.lower(F.hex(c)), "^(.{8})(.{4})(.{4})(.{4})(.{12})$", "$1-$2-$3-$4-$5")
    return F.lower(c)


def mac_hex(c: Column) -> Column:
    return F.lower(F.regexp_replace(c, "[^0-9A-Fa-f]", ""))


def mac_text(c: Column) -> Column:
    return F.regexp_replace(mac_hex(c), "^(..)(..)(..)(..)(..)(..)$", "$1:$2:$3:$4:$5:$6")


def mac_bytes(c: Column) -> Column:
    return F.unhex(mac_hex(c))


def mac_int64(c: Column, layout: MacLayout) -> Column:
    """The address in the upper six bytes of eight, negative from 80:.. on; or, with layout low, as a number."""
    value = F.conv(mac_hex(c), 16, 10).cast("bigint")
    return F.shiftleft(value, 16) if layout is MacLayout.HIGH else value


def inet(c: Column, keep_netmask: bool = False) -> Column:
    return c if keep_netmask else F.regexp_replace(c, "/.*$", "")


def bits(c: Column, src: T.DataType) -> Column:
    return F.regexp_replace(as_text(c, src), "^[Bb]'|'$", "")


def time_of_day(c: Column, src: T.DataType, micros: bool) -> Column:
    if isinstance(src, T.LongType):
        return c if micros else F.expr("null").cast("time")
    text = as_text(c, src)
    if not micros:
        return text.try_cast("time")
    part = lambda i: F.regexp_extract(text, r"^\s*([0-9]+):([0-9]+)(?::([0-9]+)(?:\.([0-9]+))?)?", i)
    number = lambda i: F.coalesce(part(i).try_cast("bigint"), F.lit(0).cast("bigint"))
    fraction = F.rpad(F.substring(part(4), 1, 6), 6, "0").cast("bigint")
    return F.when(text.rlike("^[^:]+:[0-9]"), (number(1) * 3600 + number(2) * 60 + number(3)) * 1_000_000 + fraction)


def _units(text: Column, names: str) -> Column:
    found = F.regexp_extract(text, rf"(?i)([-+]?[0-9]+(?:\.[0-9]+)?)\s*(?:{names})\b", 1)
    return F.coalesce(F.regexp_replace(found, r"^\+", "").try_cast("decimal(28,6)"), F.lit(0).cast("decimal(28,6)"))


def interval_parts(c: Column, src: T.DataType) -> tuple[Column, Column, Column]:
    """Months, days and microseconds of an interval in text form or as a struct of these three."""
    if isinstance(src, T.StructType):
        names = src.fieldNames()
        return tuple(c.getField(n).cast(k) for n, k in zip(names, ("bigint", "bigint", "bigint"), strict=True))
    months = _units(c, "years?|yrs?") * 12 + _units(c, "months?|mons?")
    days = _units(c, "weeks?") * 7 + _units(c, "days?")
    micros = _units(c, "hours?|hrs?") * 3_600_000_000 + _units(c, "minutes?|mins?") * 60_000_000 + _units(c, "seconds?|secs?") * 1_000_000
    micros = micros + _units(c, "milliseconds?|msecs?") * 1000 + _units(c, "microseconds?|usecs?")
    clock = r"([-+]?)([0-9]+):([0-9]+)(?::([0-9]+)(?:\.([0-9]{1,6}))?)?"
    part = lambda i: F.coalesce(F.regexp_extract(c, clock, i).try_cast("bigint"), F.lit(0).cast("bigint"))
    fraction = F.coalesce(F.rpad(F.regexp_extract(c, clock, 5), 6, "0").try_cast("bigint"), F.lit(0).cast("bigint"))
    sign = F.when(F.regexp_extract(c, clock, 1) == "-", F.lit(-1)).otherwise(F.lit(1)).cast("bigint")
    micros = micros.cast("bigint") + sign * ((part(2) * 3600 + part(3) * 60 + part(4)) * 1_000_000 + fraction)
    null = F.when(c.isNotNull(), F.lit(1)).cast("bigint")
    return months.cast("bigint") * null, days.cast("bigint") * null, micros * null


def _truncated_div(a: Column, by: int) -> Column:
    """Whole division towards zero."""
    return F.call_function("div", a.cast("bigint"), F.lit(by).cast("bigint"))


def interval_triple(months: Column, days: Column, micros: Column) -> tuple[Column, Column, Column]:
    """Months, days and milliseconds of the 12-byte form: whole days of the time move to the days."""
    ms = _truncated_div(micros, 1000)
    carry = _truncated_div(ms, DAY_MS)
    return months.cast("bigint"), days.cast("bigint") + carry, ms - carry * DAY_MS


def little_endian(c: Column) -> Column:
    digits = F.lpad(F.hex(c.cast("bigint").bitwiseAND(F.lit(4294967295))), 8, "0")
    return F.regexp_replace(digits, "^(..)(..)(..)(..)$", "$4$3$2$1")


def interval_bytes(months: Column, days: Column, micros: Column) -> Column:
    return F.unhex(F.concat(*[little_endian(x) for x in interval_triple(months, days, micros)]))


def enum_number(c: Column, labels: tuple[str, ...], path: str) -> Column:
    """1-based place of a label; an unknown one is an error."""
    place = F.array_position(F.array(*[F.lit(x) for x in labels]), c)
    wrong = F.raise_error(F.concat(F.lit(f"column {path}: unknown enum label "), c))
    return F.when(c.isNotNull() & (place == 0), wrong.cast("int")).otherwise(F.nullif(place, F.lit(0)).cast("int"))
