"""Parquet output: Spark's writer, one file or a folder, and what the footers say."""

from __future__ import annotations

import sys
import time
import uuid
from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

from parquill.errors import SettingsError
from parquill.operators.diagnostics import observed
from parquill.sources.footers import totals

#: Names of codecs in Spark, and those that take a level.
CODECS = {"none": "uncompressed", "snappy": "snappy", "gzip": "gzip", "lz4": "lz4_raw", "zstd": "zstd"}
LEVELS = {"zstd": "parquet.compression.codec.zstd.level", "gzip": "zlib.compress.level"}
#: Names of gzip levels 0 to 9 in Hadoop.
GZIP_LEVELS = ("NO_COMPRESSION", "BEST_SPEED", "TWO", "THREE", "FOUR", "FIVE", "SIX", "SEVEN", "EIGHT", "BEST_COMPRESSION")
ANNOTATED_ONLY = ("brotli",)
DEFAULT_LEVEL = 3
ROW_GROUP_BYTES = 500 * 1024 * 1024
ROW_GROUP_ROWS = 1024 * 1024


@dataclass(frozen=True)
class WriterStats:
    rows: int
    bytes: int
    bytes_out: int
    groups: int
    seconds: float = 0.0
    lost: Mapping[str, int] = field(default_factory=dict)  # values that became NULL, by column

    def summary(self) -> str:
        mib, s = 1024 * 1024, max(self.seconds, 1e-9)
        return f"{self.rows} rows, {self.bytes / mib:.1f} MiB raw, {self.bytes_out / mib:.1f} MiB parquet, {self.groups} row groups, {self.rows / s:.0f} rows/s, {self.bytes / mib / s:.1f} MiB/s"


def compression_options(codec: str = "zstd", level: int | None = None) -> dict[str, str]:
    """Options of Spark's writer. A level is refused for codecs without levels."""
    codec = codec.lower()
    if codec not in CODECS:
        more = "; sink='annotated' writes it" if codec in ANNOTATED_ONLY else ""
        raise SettingsError(f"compression {codec!r} is not available here{more}; choose {', '.join(CODECS)}")
    if level is not None and codec not in LEVELS:
        raise SettingsError(f"compression {codec!r} takes no level")
    options = {"compression": CODECS[codec]}
    if codec in LEVELS:
        level = DEFAULT_LEVEL if level is None else level
        if codec == "gzip" and not 0 <= level <= 9:
            raise SettingsError("gzip levels are 0 to 9")
        options[LEVELS[codec]] = GZIP_LEVELS[level] if codec == "gzip" else str(level)
    return options


def page_options(codec: str, level: int | None) -> dict[str, str]:
    """Larger pages for strong codecs, which gain from them."""
    strong = codec == "gzip" or codec == "zstd" and (DEFAULT_LEVEL if level is None else level) >= 3
    return {"parquet.page.row.count.limit": "131072", "parquet.page.size": str(4 << 20)} if strong else {}


def _path(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def _one_file(spark: SparkSession, folder: str, target: str) -> None:
    """The only part file of a folder becomes the target, which it replaces."""
    at, fs = _path(spark, folder)
    part = [s.getPath() for s in fs.listStatus(at) if s.getPath().getName().startswith("part-")][0]
    to, _ = _path(spark, target)
    if fs.exists(to):
        fs.delete(to, True)
    if not fs.rename(part, to):
        raise OSError(f"{part} could not be moved to {target}")
    fs.delete(at, True)


def _sorted(df: DataFrame) -> bool:
    """Whether rows come in an order that the query asked for."""
    node = df._jdf.queryExecution().optimizedPlan()
    while node.nodeName() in ("Project", "CollectMetrics", "Filter", "SubqueryAlias", "GlobalLimit", "LocalLimit"):
        node = node.children().head()
    return node.nodeName() == "Sort" and bool(getattr(node, "global")())


def write_parquet(
    df: DataFrame, path: str, *, compression: str = "zstd", level: int | None = None, row_group_bytes: int = ROW_GROUP_BYTES,
    row_group_rows: int = ROW_GROUP_ROWS, single_file: bool = True, quiet: bool = True,
) -> WriterStats:
    """Writes df as one Parquet file (or a folder of them, for scale), replacing what was there.

    With one file, sorted input keeps its order; other input is computed in parallel, and only the
    write is one task. The target appears whole or not at all.
    """
    spark, began = df.sparkSession, time.monotonic()
    options = compression_options(compression, level) | page_options(compression, level)
    options |= {"parquet.block.size": str(row_group_bytes), "parquet.block.row.count.limit": str(row_group_rows)}
    counted, seen = observed(df)
    spark.conf.set("spark.sql.parquet.outputTimestampType", "TIMESTAMP_MICROS")
    if single_file:
        folder = f"{path}.{uuid.uuid4().hex}.writing"
        (counted.coalesce(1) if _sorted(df) else counted.repartition(1)).write.options(**options).mode("overwrite").parquet(folder)
        _one_file(spark, folder, path)
    else:
        counted.write.options(**options).mode("overwrite").parquet(path)
    found, files = seen.get, totals(spark, path)
    stats = WriterStats(found["rows"] or 0, found["bytes"] or 0, files["file_bytes"] or 0, files["groups"] or 0, time.monotonic() - began)
    if not quiet:
        print(stats.summary(), file=sys.stderr)
    return stats
