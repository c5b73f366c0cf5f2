"""Export: a query or table, converted and written."""

from __future__ import annotations

import sys
from collections.abc import Mapping
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession

from parquill.errors import SettingsError
from parquill.operators.annotated import write_annotated
from parquill.operators.diagnostics import Told
from parquill.operators.sink import WriterStats, write_parquet
from parquill.plans.resolve import columns
from parquill.plans.schema_tree import format_schema
from parquill.settings import Array, Settings
from parquill.types import PgType


def configure(spark: SparkSession) -> SparkSession:
    """What exact exports rely on."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    spark.conf.set("spark.sql.parquet.outputTimestampType", "TIMESTAMP_MICROS")
    spark.conf.set("spark.sql.timeType.enabled", "true")
    return spark


def source(spark: SparkSession, query: str | None = None, table: str | None = None) -> DataFrame:
    """Spark SQL over registered tables, or one table: exactly one of both."""
    if (query is None) == (table is None):
        raise SettingsError("give either a query or a table")
    return spark.sql(query) if query is not None else spark.table(table)


def export(
    spark: SparkSession, path: str, *, query: str | None = None, table: str | None = None, df: DataFrame | None = None, types: Mapping[str, PgType | str] | None = None,
    settings: Settings | None = None, sink: str = "native", quiet: bool = True, **writing,
) -> WriterStats | None:
    """Writes the result of a query, a table or a DataFrame as Parquet.

    sink: `native` (Spark's writer) or `annotated` (a folder of files with annotations that Spark
    lacks; no statistics). Values that a conversion of a given type loses are counted on the way;
    unless quiet, they and flattened arrays are told on stderr.
    """
    configure(spark)
    settings = settings or Settings()
    rows = df if df is not None else source(spark, query, table)
    told = Told(rows, columns(rows, types, settings), types or {})
    out = told.rows
    if not quiet:
        print(format_schema(out.schema), file=sys.stderr)
    if sink == "annotated":
        write_annotated(out, path, **{k: v for k, v in writing.items() if k in ("compression", "level", "row_group_rows")})
        stats = None
    else:
        stats = write_parquet(out, path, quiet=quiet, **writing)
        stats = replace(stats, lost=told.lost())
    if not quiet:
        for warning in told.warnings(settings.array is Array.PLAIN):
            print(f"warning: {warning}", file=sys.stderr)
    return stats
