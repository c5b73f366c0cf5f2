"""Parquet footers: of a few files through Hadoop's own reader, of many in Spark's tasks."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

GROUPS = T.StructType([T.StructField(n, t) for n, t in (("file", T.StringType()), ("file_bytes", T.LongType()), ("created_by", T.StringType()), ("group", T.IntegerType()), ("rows", T.LongType()), ("raw_bytes", T.LongType()))])
CHUNKS = T.StructType([T.StructField(n, t) for n, t in (("file", T.StringType()), ("group", T.IntegerType()), ("column", T.StringType()), ("type", T.StringType()), ("codec", T.StringType()), ("values", T.LongType()), ("nulls", T.LongType()), ("raw_bytes", T.LongType()), ("bytes", T.LongType()), ("min", T.StringType()), ("max", T.StringType()))])


def _files(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(conf)
    status = fs.getFileStatus(p)
    found = fs.listStatus(p) if status.isDirectory() else [status]
    for s in found:
        if s.isFile() and not s.getPath().getName().startswith(("_", ".")):
            reader = jvm.org.apache.parquet.hadoop.ParquetFileReader.open(jvm.org.apache.parquet.hadoop.util.HadoopInputFile.fromPath(s.getPath(), conf))
            try:
                yield s.getPath().toString(), s.getLen(), reader.getFooter()
            finally:
                reader.close()


def footers(spark: SparkSession, path: str) -> list[dict]:
    """A row for each row group; group -1 for a file without any."""
    out = []
    for name, size, footer in _files(spark, path):
        by = footer.getFileMetaData().getCreatedBy()
        blocks = list(footer.getBlocks())
        for i, b in enumerate(blocks):
            out.append({"file": name, "file_bytes": size, "created_by": by, "group": i, "rows": b.getRowCount(), "raw_bytes": b.getTotalByteSize()})
        if not blocks:
            out.append({"file": name, "file_bytes": size, "created_by": by, "group": -1, "rows": 0, "raw_bytes": 0})
    return out


#: Stores that pyarrow opens by the same names as Hadoop.
DIRECT = ("file", "hdfs")
#: Files whose footers the driver reads itself.
FEW = 64


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    import pyarrow.parquet as pq
    from pyarrow import fs

    for batch in batches:
        rows = []
        for path, size in zip(batch.column("path").to_pylist(), batch.column("length").to_pylist(), strict=True):
            store, at = fs.FileSystem.from_uri(path.replace("file:/", "file:///", 1) if path.startswith("file:/") and not path.startswith("file://") else path)
            with store.open_input_file(at) as f:
                meta = pq.ParquetFile(f).metadata
                groups = [meta.row_group(i) for i in range(meta.num_row_groups)]
            rows.append({"files": 1, "file_bytes": size, "groups": len(groups), "rows": meta.num_rows, "raw_bytes": sum(g.total_byte_size for g in groups)})
        yield pa.RecordBatch.from_pylist(rows, schema=pa.schema([(n, pa.int64()) for n in TOTALS]))


#: What totals() counts.
TOTALS = ("files", "file_bytes", "groups", "rows", "raw_bytes")


def totals(spark: SparkSession, path: str, few: int = FEW) -> dict[str, int]:
    """Files, their bytes, row groups, rows and raw bytes. The footers of many files are read in tasks."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if fs.getContentSummary(p).getFileCount() <= few or fs.getUri().getScheme() not in DIRECT:
        found = footers(spark, path)
        sizes = {g["file"]: g["file_bytes"] for g in found}
        return {"files": len(sizes), "file_bytes": sum(sizes.values()), "groups": sum(g["group"] >= 0 for g in found), "rows": sum(g["rows"] for g in found), "raw_bytes": sum(g["raw_bytes"] for g in found)}
    files = spark.read.format("binaryFile").load(path).select("path", "length")
    return files.mapInArrow(_read, ", ".join(f"{n} long" for n in TOTALS)).agg(*[F.sum(n).alias(n) for n in TOTALS]).first().asDict()


def inspect(spark: SparkSession, path: str) -> DataFrame:
    """A row for each column chunk: type, codec, counts, sizes and bounds."""
    rows = []
    for name, _, footer in _files(spark, path):
        for i, b in enumerate(footer.getBlocks()):
            for c in b.getColumns():
                stats = c.getStatistics()
                known = stats is not None and stats.hasNonNullValue()
                nulls = stats.getNumNulls() if stats is not None and stats.isNumNullsSet() else None
                rows.append((name, i, "/".join(c.getPath().toArray()), c.getPrimitiveType().toString(), str(c.getCodec()), c.getValueCount(), nulls, c.getTotalUncompressedSize(), c.getTotalSize(), stats.minAsString() if known else None, stats.maxAsString() if known else None))
    return spark.createDataFrame(rows, CHUNKS)


def file_schema(spark: SparkSession, path: str) -> str:
    """The Parquet schema of the first file."""
    for _, _, footer in _files(spark, path):
        return footer.getFileMetaData().getSchema().toString()
    raise FileNotFoundError(path)


def peek(spark: SparkSession, path: str, rows: int = 300) -> DataFrame:
    """The first rows of a file."""
    return spark.read.parquet(path).limit(rows)
