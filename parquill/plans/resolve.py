"""From source types to Spark expressions: one projection, built when the query is planned."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from parquill.errors import UnsupportedTypeError
from parquill.functions import scalars as S
from parquill.functions import vectors as V
from parquill.functions.nested_text import is_nested, parser, shape
from parquill.settings import Array, EnumAs, Float16, Interval, Json, Macaddr, Numeric, Settings, TimeAs
from parquill.types import ArrayOf, Composite, Domain, Enumeration, PgType, RangeOf, Simple, parse_type, show

#: Key of field metadata that names the Parquet annotation meant, where Spark's writer has none.
LOGICAL = "parquet.logical"

Convert = Callable[[Column], Column]


@dataclass(frozen=True)
class Resolved:
    """How one column (or part of one) is converted, and the annotations meant for it."""

    convert: Convert
    hints: Mapping[str, str] = field(default_factory=dict)  # by path inside the column; "" is itself


def _hinted(convert: Convert, hint: str | None = None) -> Resolved:
    return Resolved(convert, {"": hint} if hint else {})


def _simple(name: str, s: Settings, src: T.DataType, path: str) -> Resolved:
    match name:
        case "bool":
            return _hinted(lambda c: c.cast("boolean"))
        case "int2" | "int4" | "int8":
            kind = {"int2": "smallint", "int4": "int", "int8": "bigint"}[name]
            return _hinted(lambda c: c.cast(kind))
        case "oid":
            return _hinted(lambda c: c.cast("bigint"), "UINT_32")
        case "float4" | "float8":
            kind = "float" if name == "float4" else "double"
            return _hinted(lambda c: c.cast(kind))
        case "numeric":
            if s.numeric is Numeric.DECIMAL:
                return _hinted(lambda c: S.to_decimal(c, src, s.decimal_precision, s.decimal_scale, s.rounding))
            if s.numeric is Numeric.STRING:
                return _hinted(lambda c: S.as_text(c, src))
            kind = "double" if s.numeric is Numeric.DOUBLE else "float"
            return _hinted(lambda c: S.to_float(c, src, kind))
        case "money":
            return _hinted(lambda c: S.money(c, src))
        case "char":
            return _hinted(S.char_code, "UINT_8")
        case "bytea":
            return _hinted(lambda c: S.bytea(c, src))
        case "name" | "text" | "xml" | "bpchar" | "varchar" | "citext":
            return _hinted(lambda c: S.as_text(c, src))
        case "json" | "jsonb":
            return _hinted(lambda c: S.as_text(c, src), "JSON" if s.json is Json.MARKED else None)
        case "timestamptz":
            return _hinted(lambda c: c.try_cast("timestamp"))
        case "timestamp":
            return _hinted(lambda c: c.try_cast("timestamp_ntz"))
        case "date":
            return _hinted(lambda c: c.try_cast("date"))
        case "time":
            return _hinted(lambda c: S.time_of_day(c, src, s.time is TimeAs.MICROS))
        case "uuid":
            return _hinted(lambda c: S.uuid_text(c, src), "UUID")
        case "macaddr":
            if s.macaddr is Macaddr.TEXT:
                return _hinted(S.mac_text)
            if s.macaddr is Macaddr.BYTES:
                return _hinted(S.mac_bytes, "FIXED_6")
            return _hinted(lambda c: S.mac_int64(c, s.mac_layout))
        case "inet":
            return _hinted(lambda c: S.inet(c, s.keep_netmask))
        case "bit" | "varbit":
            return _hinted(lambda c: S.bits(c, src))
        case "interval":
            if s.interval is Interval.INTERVAL:
                return _hinted(lambda c: S.interval_bytes(*S.interval_parts(c, src)), "INTERVAL")

            def parts(c: Column) -> Column:
                months, days, micros = S.interval_parts(c, src)
                return F.when(c.isNotNull(), F.struct(months.cast("int").alias("months"), days.cast("int").alias("days"), micros.alias("microseconds")))

            return _hinted(parts)
        case "vector":
            return _hinted(lambda c: V.dense(c, src))
        case "halfvec":
            as_bytes = s.float16 is Float16.FLOAT16
            return Resolved(lambda c: V.half(c, src, as_bytes), {"/element": "FLOAT16"} if as_bytes else {})
        case "sparsevec":
            return Resolved(lambda c: V.sparse(c, src), {"/key": "UINT_32"})
    raise UnsupportedTypeError(path, name)


def _depth(t: T.DataType) -> int:
    return 1 + _depth(t.elementType) if isinstance(t, T.ArrayType) else 0


def _value_depth(t: PgType) -> int:
    """Array levels that one value of a type has by itself in native form."""
    if isinstance(t, Domain):
        return _value_depth(t.base)
    return 1 if isinstance(t, Simple) and t.name in ("vector", "halfvec", "sparsevec") else 0


def _flat(c: Column, src: T.ArrayType, element: PgType) -> tuple[Column, Column, T.DataType]:
    """A native array row-major, its dimensions, and the type of its elements."""
    levels = max(1, _depth(src) - _value_depth(element))
    sizes, at, inner = [], c, src
    for d in range(levels):
        sizes.append(F.size(at))
        inner = inner.elementType
        if d + 1 < levels:
            at = F.get(at, F.lit(0))
    data = c
    for _ in range(levels - 1):
        data = F.flatten(data)
    dims = F.when(F.size(data) > 0, F.array(*sizes)).otherwise(F.array().cast("array<int>"))
    return data, dims, inner


def _array(t: ArrayOf, s: Settings, src: T.DataType, path: str) -> Resolved:
    if isinstance(src, T.StructType):
        inner = src["data"].dataType.elementType
        whole = lambda c: (c["data"], c["dims"], c["lower_bound"])
    elif isinstance(src, T.ArrayType):
        inner = _flat(F.lit(None), src, t.element)[2]

        def whole(c):
            data, dims, _ = _flat(c, src, t.element)
            return data, dims, F.transform(dims, lambda _: F.lit(1))
    else:
        raise UnsupportedTypeError(path, f"{show(t)} from {src.simpleString()}")
    element = resolve(t.element, s, inner, f"{path}/element")

    def convert(c: Column) -> Column:
        data, dims, low = whole(c)
        data = F.transform(data, element.convert)
        if s.array is Array.PLAIN:
            return F.when(c.isNotNull(), data)
        parts = [data.alias("data"), F.transform(dims, lambda x: F.coalesce(x, F.lit(0))).alias("dims")]
        if s.array is Array.DIMS_LB:
            parts.append(F.transform(low, lambda x: F.coalesce(x, F.lit(1))).alias("lower_bound"))
        return F.when(c.isNotNull(), F.struct(*parts))

    at = "/element" if s.array is Array.PLAIN else "/data/element"
    hints = {at + k: v for k, v in element.hints.items()}
    if s.array is not Array.PLAIN:
        hints["/dims/element"] = "UINT_32"
    return Resolved(convert, hints)


def _range(t: RangeOf, s: Settings, src: T.DataType, path: str) -> Resolved:
    if not isinstance(src, T.StructType):
        raise UnsupportedTypeError(path, f"{show(t)} from {src.simpleString()}")
    low, high = (resolve(t.subtype, s, src[n].dataType, f"{path}/{n}") for n in ("lower", "upper"))

    def convert(c: Column) -> Column:
        some = ~F.coalesce(c["is_empty"], F.lit(False))
        flag = lambda n, bound: (some & F.coalesce(c[n], F.lit(False)) & c[bound].isNotNull()).alias(n)
        return F.when(
            c.isNotNull(),
            F.struct(
                F.when(some, low.convert(c["lower"])).alias("lower"), F.when(some, high.convert(c["upper"])).alias("upper"),
                flag("lower_inclusive", "lower"), flag("upper_inclusive", "upper"), (~some).alias("is_empty"),
            ),
        )

    return Resolved(convert, {f"/{n}{k}": v for n, r in (("lower", low), ("upper", high)) for k, v in r.hints.items()})


def _composite(t: Composite, s: Settings, src: T.DataType, path: str) -> Resolved:
    if not isinstance(src, T.StructType):
        raise UnsupportedTypeError(path, f"{show(t)} from {src.simpleString()}")
    parts = [(n, resolve(f, s, src[n].dataType, f"{path}/{n}")) for n, f in t.fields]
    hints = {f"/{n}{k}": v for n, r in parts for k, v in r.hints.items()}
    return Resolved(lambda c: F.when(c.isNotNull(), F.struct(*[r.convert(c[n]).alias(n) for n, r in parts])), hints)


def resolve(t: PgType, s: Settings, src: T.DataType, path: str) -> Resolved:
    """The conversion of a value of type t that comes as Spark type src (text output, parsed or native)."""
    if isinstance(t, Domain):
        return resolve(t.base, s, src, path)
    if is_nested(t) and isinstance(src, T.StringType):
        inner, read = resolve(t, s, shape(t), path), parser(t)
        return Resolved(lambda c: inner.convert(read(c)), inner.hints)
    match t:
        case Simple(name):
            return _simple(name, s, src, path)
        case Enumeration(labels):
            if s.enum is EnumAs.INT:
                return _hinted(lambda c: S.enum_number(S.as_text(c, src), labels, path))
            return _hinted(lambda c: S.as_text(c, src), "ENUM" if s.enum is EnumAs.TEXT else None)
        case ArrayOf():
            return _array(t, s, src, path)
        case RangeOf():
            return _range(t, s, src, path)
        case Composite():
            return _composite(t, s, src, path)
    raise UnsupportedTypeError(path, show(t))


#: The source type that a native Spark column stands for, where none is given.
NATIVE = {
    "boolean": "bool", "tinyint": "int2", "smallint": "int2", "int": "int4", "bigint": "int8", "float": "float4", "double": "float8",
    "string": "text", "binary": "bytea", "date": "date", "timestamp": "timestamptz", "timestamp_ntz": "timestamp", "time(6)": "time",
}


def native_type(src: T.DataType, path: str) -> PgType | None:
    """None: keep the column as it is."""
    if isinstance(src, T.DecimalType):
        return None
    if isinstance(src, T.ArrayType):
        inner = native_type(src.elementType, path)
        return ArrayOf(inner) if inner is not None and not isinstance(inner, ArrayOf) else None
    if isinstance(src, T.StructType):
        parts = [(f.name, native_type(f.dataType, path)) for f in src.fields]
        return Composite(tuple(parts)) if all(p for _, p in parts) else None
    name = NATIVE.get(src.simpleString())
    return Simple(name) if name else None


def _nullable(c: Column) -> Column:
    """The same values as an optional column; a condition that the optimiser cannot decide keeps it so."""
    return F.when(F.monotonically_increasing_id() >= 0, c)


def columns(df: DataFrame, types: Mapping[str, PgType | str] | None = None, settings: Settings | None = None) -> list[Column]:
    """All columns of a query result in their export form, in order, all of them optional.

    types: source types by column name; columns without one keep what their Spark type stands for.
    """
    types, settings, out = types or {}, settings or Settings(), []
    for f in df.schema.fields:
        t = types.get(f.name)
        t = parse_type(t) if isinstance(t, str) else t if t is not None else native_type(f.dataType, f.name)
        c = F.col("`" + f.name.replace("`", "``") + "`")
        found = resolve(t, settings, f.dataType, f.name) if t is not None else Resolved(lambda c: c)
        made = _nullable(found.convert(c)) if not f.nullable else found.convert(c)
        meta = {LOGICAL: found.hints[""]} if "" in found.hints else {}
        nested = {k: v for k, v in found.hints.items() if k}
        out.append(made.alias(f.name, metadata=meta | ({LOGICAL + ".nested": nested} if nested else {})))
    return out


def project(df: DataFrame, types: Mapping[str, PgType | str] | None = None, settings: Settings | None = None) -> DataFrame:
    """A query result with its columns() in place of its own."""
    return df.select(*columns(df, types, settings))
