"""Labels of rows, raw sizes, warnings about arrays."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from parquill.types import ArrayOf, Domain, PgType, parse_type


def quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def row_label(df: DataFrame) -> Column:
    """name=value of the first text or whole-number column that is not null."""
    usable = [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType | T.IntegerType | T.LongType)]
    return F.coalesce(*[F.concat(F.lit(f"{n}="), F.col(f"`{n}`").cast("string")) for n in usable], F.lit("unknown row"))


def failing_rows(df: DataFrame, column: str, converted: Column) -> DataFrame:
    """Labels and texts of rows whose value a conversion lost (not null before, null after)."""
    c = F.col(f"`{column}`")
    return df.where(c.isNotNull() & converted.isNull()).select(row_label(df).alias("row"), F.lit(column).alias("column"), c.cast("string").alias("value"))


def raw_size(c: Column, t: T.DataType) -> Column:
    """Bytes of a value as written plain, with two bytes for the levels of each leaf."""
    match t:
        case T.StringType() | T.BinaryType():
            own = F.coalesce(F.octet_length(c).cast("long") + 4, F.lit(0).cast("long"))
        case T.StructType():
            return sum((raw_size(c[f.name], f.dataType) for f in t.fields), F.lit(0).cast("long"))
        case T.ArrayType():
            add = lambda acc, x: acc + raw_size(x, t.elementType)
            return F.coalesce(F.aggregate(c, F.lit(0).cast("long"), add), F.lit(2).cast("long"))
        case T.MapType():
            return raw_size(F.map_keys(c), T.ArrayType(t.keyType)) + raw_size(F.map_values(c), T.ArrayType(t.valueType))
        case _:
            wide = {"boolean": 1, "tinyint": 4, "smallint": 4, "int": 4, "float": 4, "date": 4}.get(t.simpleString(), 8)
            wide = 4 if isinstance(t, T.DecimalType) and t.precision <= 9 else 16 if isinstance(t, T.DecimalType) and t.precision > 18 else wide
            own = F.when(c.isNotNull(), F.lit(wide)).otherwise(F.lit(0)).cast("long")
    return own + 2


def observed(df: DataFrame) -> tuple[DataFrame, Observation]:
    """df with rows and raw bytes counted while something else reads it."""
    seen = Observation()
    size = sum((raw_size(F.col(f"`{f.name}`"), f.dataType) for f in df.schema.fields), F.lit(0).cast("long"))
    return df.observe(seen, F.count(F.lit(1)).alias("rows"), F.sum(size).alias("bytes")), seen


def _dimensions(f: T.StructField, t: PgType | str | None, c: Column) -> Column | None:
    """Whether an array has more than one dimension, as a native array of arrays or as text."""
    if isinstance(f.dataType, T.ArrayType) and isinstance(f.dataType.elementType, T.ArrayType):
        return F.size(c) > 0
    t = parse_type(t) if isinstance(t, str) else t
    while isinstance(t, Domain):
        t = t.base
    return c.rlike(r"^\s*(\[[^=]*=)?\{\s*\{") if isinstance(t, ArrayOf) and isinstance(f.dataType, T.StringType) else None


class Told:
    """What an export says about its rows, gathered while something else reads them."""

    def __init__(self, df: DataFrame, made: list[Column], types: Mapping[str, PgType | str]):
        """made: the export form of each column of df."""
        self._seen, counts, names = Observation(), [], df.schema.names
        self._lost, self._flat = {}, {}
        kept = lambda k: F.col(f"source {k}")
        for k, f in enumerate(df.schema.fields):
            if f.name in types:
                lost = kept(k).isNotNull() & F.col(quoted(f.name)).isNull()
                counts += [F.count_if(lost).alias(f"lost {k}"), F.min(F.when(lost, F.col("source row"))).alias(f"row {k}")]
                self._lost[k] = f.name
            many = _dimensions(f, types.get(f.name), kept(k))
            if many is not None:
                counts.append(F.count_if(many).alias(f"flat {k}"))
                self._flat[k] = f.name
        self.rows = df.select(*made)
        if counts:
            needed = [F.col(quoted(names[k])).alias(f"source {k}") for k in sorted({*self._lost, *self._flat})]
            wide = df.select(*made, *needed, row_label(df).alias("source row"))
            self.rows = wide.observe(self._seen, *counts).select(*[F.col(quoted(n)) for n in names])

    def lost(self) -> dict[str, int]:
        """Per column the values that became NULL; after the rows were read."""
        return {n: c for k, n in self._lost.items() if (c := self._seen.get[f"lost {k}"])}

    def warnings(self, flattened: bool) -> list[str]:
        out = [f"column {n}: {c} values became NULL, one of them in row {self._seen.get[f'row {k}']}" for k, n in self._lost.items() if (c := self._seen.get[f"lost {k}"])]
        if flattened:
            out += [f"column {n}: {c} arrays of several dimensions are flattened; see the array option" for k, n in self._flat.items() if (c := self._seen.get[f"flat {k}"])]
        return out
