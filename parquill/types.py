"""Descriptions of source types."""

from __future__ import annotations

import re
from dataclasses import dataclass

from parquill.errors import ParquillError


@dataclass(frozen=True)
class PgType:
    pass


@dataclass(frozen=True)
class Simple(PgType):
    name: str


@dataclass(frozen=True)
class Enumeration(PgType):
    labels: tuple[str, ...]
    name: str = "enum"


@dataclass(frozen=True)
class ArrayOf(PgType):
    element: PgType


@dataclass(frozen=True)
class Domain(PgType):
    base: PgType
    name: str = "domain"


@dataclass(frozen=True)
class RangeOf(PgType):
    subtype: PgType


@dataclass(frozen=True)
class Composite(PgType):
    fields: tuple[tuple[str, PgType], ...]
    name: str = "record"


#: SQL spellings of catalogue names.
SPELLINGS = {
    "boolean": "bool", "smallint": "int2", "integer": "int4", "int": "int4", "bigint": "int8", "serial": "int4", "bigserial": "int8",
    "real": "float4", "double precision": "float8", "decimal": "numeric", "character varying": "varchar", "character": "bpchar", "char": "bpchar",
    '"char"': "char", "timestamp without time zone": "timestamp", "timestamp with time zone": "timestamptz", "time without time zone": "time",
    "bit varying": "varbit",
}
#: Subtypes of the built-in ranges.
RANGES = {"int4range": "int4", "int8range": "int8", "numrange": "numeric", "tsrange": "timestamp", "tstzrange": "timestamptz", "daterange": "date"}


def parse_type(text: str) -> PgType:
    """`numeric(10,2)[]`, `int4range`, `double precision` ... as a type; modifiers are dropped."""
    text = " ".join(text.split())
    if text.endswith("[]"):
        return ArrayOf(parse_type(text[:-2]))
    name = re.sub(r"\s*\([^)]*\)", "", text)
    name = name if name.startswith('"') else name.lower()
    name = SPELLINGS.get(name, name)
    if not name:
        raise ParquillError("empty type name")
    return RangeOf(Simple(RANGES[name])) if name in RANGES else Simple(name)


def composite(name: str, **fields: str | PgType) -> Composite:
    return Composite(tuple((k, v if isinstance(v, PgType) else parse_type(v)) for k, v in fields.items()), name)


def show(t: PgType) -> str:
    match t:
        case Simple(name) | Enumeration(_, name) | Domain(_, name) | Composite(_, name):
            return name
        case ArrayOf(e):
            return show(e) + "[]"
        case RangeOf(s):
            return f"range of {show(s)}"
    return "unknown"
