"""Dense, half-precision and sparse vectors."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _required(c: Column) -> Column:
    """Elements that cannot be null."""
    return F.transform(c, lambda x: F.coalesce(x, F.lit(0.0).cast("float")))


def floats(c: Column, src: T.DataType) -> Column:
    """From `[1,2,3]` or from an array of numbers."""
    return c.cast("array<float>") if isinstance(src, T.ArrayType) else F.from_json(c, "array<float>")


def dense(c: Column, src: T.DataType) -> Column:
    return _required(floats(c, src))


@F.pandas_udf(T.ArrayType(T.FloatType()))
def _halves(vectors: pd.Series) -> pd.Series:
    return vectors.map(lambda v: None if v is None else np.asarray(v, np.float32).astype(np.float16).astype(np.float32))


@F.pandas_udf(T.ArrayType(T.BinaryType()))
def _half_bytes(vectors: pd.Series) -> pd.Series:
    return vectors.map(lambda v: None if v is None else [x.tobytes() for x in np.asarray(v, np.float32).astype("<f2")])


def half(c: Column, src: T.DataType, as_bytes: bool) -> Column:
    """Values rounded to half precision, as floats or as two little-endian bytes each."""
    return _half_bytes(floats(c, src)) if as_bytes else _required(_halves(floats(c, src)))


def sparse(c: Column, src: T.DataType) -> Column:
    """A map from 1-based places to values: of `{1:-1,5:5.25}/5`, of a map, or of a dense array."""
    if isinstance(src, T.MapType):
        found = c.cast("map<int,float>")
    elif isinstance(src, T.ArrayType):
        pairs = F.transform(c.cast("array<float>"), lambda x, i: F.struct((i + 1).alias("key"), x.alias("value")))
        found = F.map_from_entries(F.filter(pairs, lambda p: p["value"] != 0))
    else:
        inner = F.regexp_extract(c, r"^\s*\{(.*)\}", 1)
        pairs = F.filter(F.split(inner, ","), lambda p: F.trim(p) != "")
        entry = lambda p: F.struct(F.trim(F.split_part(p, F.lit(":"), F.lit(1))).cast("int").alias("key"), F.trim(F.split_part(p, F.lit(":"), F.lit(2))).cast("float").alias("value"))
        found = F.map_from_entries(F.transform(pairs, entry))
    return F.transform_values(found, lambda k, v: F.coalesce(v, F.lit(0.0).cast("float")))
