"""Schemas as text and as rows."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import types as T

from parquill.plans.resolve import LOGICAL


def type_name(t: T.DataType, hint: str | None = None) -> str:
    """A leaf's type as the Parquet file means it."""
    match t:
        case T.DecimalType():
            return f"Decimal({t.precision}, {t.scale})"
        case T.TimestampType():
            return "Timestamp(us, utc=true)"
        case T.TimestampNTZType():
            return "Timestamp(us, utc=false)"
        case T.StringType():
            return {"JSON": "Json", "ENUM": "Enum", "UUID": "Uuid"}.get(hint or "", "String")
        case T.ShortType():
            return "UInt8" if hint == "UINT_8" else "Int16"
        case T.BinaryType():
            return {"INTERVAL": "Interval", "FLOAT16": "Float16", "FIXED_6": "Fixed(6)"}.get(hint or "", "Binary")
        case T.LongType():
            return "UInt32" if hint == "UINT_32" else "Int64"
    names = {"boolean": "Boolean", "tinyint": "Int8", "int": "Int32", "float": "Float", "double": "Double", "date": "Date"}
    simple = t.simpleString()
    return "Time(us, utc=false)" if simple.startswith("time(") else names.get(simple, simple)


def walk(schema: T.StructType) -> Iterator[tuple[int, str, str, bool]]:
    """(depth, path, type, optional) of all nodes, parents first."""

    def node(path: str, name: str, t: T.DataType, optional: bool, depth: int, hints: dict, at: str):
        here = f"{path}/{name}" if path else name
        if isinstance(t, T.StructType):
            yield depth, here, "Struct", optional
            for f in t.fields:
                yield from node(here, f.name, f.dataType, f.nullable, depth + 1, hints, f"{at}/{f.name}")
        elif isinstance(t, T.ArrayType):
            yield depth, here, "List", optional
            yield from node(here, "element", t.elementType, t.containsNull, depth + 1, hints, f"{at}/element")
        elif isinstance(t, T.MapType):
            yield depth, here, "Map", optional
            yield from node(here, "key", t.keyType, False, depth + 1, hints, f"{at}/key")
            yield from node(here, "value", t.valueType, t.valueContainsNull, depth + 1, hints, f"{at}/value")
        else:
            yield depth, here, type_name(t, hints.get(at)), optional

    for f in schema.fields:
        hints = dict(f.metadata.get(LOGICAL + ".nested", {}))
        if LOGICAL in f.metadata:
            hints[""] = f.metadata[LOGICAL]
        yield from node("", f.name, f.dataType, f.nullable, 0, hints, "")


def format_schema(schema: T.StructType, indent: str = "") -> str:
    """A tree, one node a line: name, type, whether it is required."""
    return "\n".join(f"{indent}{'  ' * d}{p.rsplit('/', 1)[-1]}: {t}{'' if o else ' (required)'}" for d, p, t, o in walk(schema))


def leaf_count(schema: T.DataType) -> int:
    if isinstance(schema, T.StructType):
        return sum(leaf_count(f.dataType) for f in schema.fields)
    if isinstance(schema, T.ArrayType):
        return leaf_count(schema.elementType)
    return leaf_count(schema.keyType) + leaf_count(schema.valueType) if isinstance(schema, T.MapType) else 1
