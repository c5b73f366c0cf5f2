"""Parquet with annotations that Spark's writer lacks: files written by pyarrow in Spark's tasks.

UUID, JSON, FLOAT16, unsigned and fixed-size types follow the hints in the column metadata. Not
reachable: INTERVAL (12 fixed bytes without the annotation) and ENUM (a string).
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage

from parquill import VERSION
from parquill.plans.resolve import LOGICAL

#: A row group ends at so many rows or bytes, which a worker holds at a time.
GROUP_ROWS, GROUP_BYTES = 1024 * 1024, 128 << 20
#: The Arrow type of each hint.
TARGETS = {"UUID": pa.uuid, "JSON": pa.json_, "UINT_8": pa.uint8, "UINT_32": pa.uint32, "FIXED_6": lambda: pa.binary(6), "INTERVAL": lambda: pa.binary(12), "FLOAT16": pa.float16}


def _fixed(t: pa.DataType, data: bytes, a: pa.Array) -> pa.Array:
    """Values of one width from their bytes, null where a is."""
    valid = pc.is_valid(a).buffers()[1] if a.null_count else None
    return pa.Array.from_buffers(t, len(a), [valid, pa.py_buffer(data)])


def annotated_array(a: pa.Array, hint: str) -> pa.Array:
    """The same values under the hinted type."""
    if hint == "UUID":
        digits = pc.fill_null(pc.replace_substring(a.cast(pa.string()), "-", ""), "0" * 32)
        raw = _fixed(pa.binary(16), bytes.fromhex("".join(digits.to_pylist())), a)
        return pa.ExtensionArray.from_storage(pa.uuid(), raw)
    if hint == "JSON":
        return pa.ExtensionArray.from_storage(pa.json_(), a.cast(pa.string()))
    if hint == "FLOAT16":
        return _fixed(pa.float16(), b"".join(pc.fill_null(a, b"\0\0").to_pylist()), a)
    return a.cast(TARGETS[hint]()) if hint in TARGETS else a


def _nested(a: pa.Array, hints: dict[str, str], at: str) -> pa.Array:
    if at in hints:
        return annotated_array(a, hints[at])
    if not any(k.startswith(at + "/") for k in hints):
        return a
    t = a.type
    if pa.types.is_struct(t):
        parts = [_nested(a.field(i), hints, f"{at}/{t.field(i).name}") for i in range(t.num_fields)]
        fields = [pa.field(t.field(i).name, p.type) for i, p in enumerate(parts)]
        return pa.StructArray.from_arrays(parts, fields=fields, mask=a.is_null())
    if pa.types.is_map(t):
        if a.offset:
            a = a.take(pa.array(range(len(a)), pa.int64()))
        keys, items = _nested(a.keys, hints, f"{at}/key"), _nested(a.items, hints, f"{at}/value")
        return pa.MapArray.from_arrays(a.offsets, keys, items, mask=a.is_null() if a.null_count else None)
    if pa.types.is_list(t):
        if a.offset:  # a mask goes with offsets that begin at the first one only
            a = a.take(pa.array(range(len(a)), pa.int64()))
        return pa.ListArray.from_arrays(a.offsets, _nested(a.values, hints, f"{at}/element"), mask=a.is_null() if a.null_count else None)
    return a


def annotated_table(table: pa.Table, hints: dict[str, dict[str, str]]) -> pa.Table:
    columns = {}
    for name in table.column_names:
        column = table.column(name).combine_chunks()
        column = column.chunk(0) if isinstance(column, pa.ChunkedArray) and column.num_chunks else column
        columns[name] = _nested(column, hints[name], "") if hints.get(name) and isinstance(column, pa.Array) else table.column(name)
    return pa.table(columns).replace_schema_metadata({"parquill.version": VERSION})


class Wrote(WriterCommitMessage):
    def __init__(self, name: str):
        self.name = name


class AnnotatedWriter(DataSourceArrowWriter):
    """Each task writes a hidden file; the driver shows all of them at once when every task is done."""

    def __init__(self, options: dict[str, str], hints: dict[str, dict[str, str]], overwrite: bool = False):
        self.path, self.hints, self.overwrite = options["path"], hints, overwrite
        self.group_rows = int(options.get("row_group_rows", GROUP_ROWS))
        self.codec, self.level = options.get("compression", "zstd"), options.get("level")

    def _store(self):
        from pyarrow import fs

        store, at = fs.FileSystem.from_uri(self.path) if "://" in self.path or self.path.startswith("file:") else (fs.LocalFileSystem(), self.path)
        store.create_dir(at, recursive=True)
        return store, at

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Wrote:
        import pyarrow.parquet as pq

        store, at = self._store()
        name, writer = f"{uuid.uuid4().hex}.parquet", None
        try:
            with store.open_output_stream(f"{at}/.{name}") as out:
                for group in self._groups(iterator):
                    table = annotated_table(group, self.hints)
                    writer = writer or pq.ParquetWriter(out, table.schema, compression=self.codec, compression_level=int(self.level) if self.level else None)
                    writer.write_table(table, row_group_size=self.group_rows)
                if writer:
                    writer.close()
        except BaseException:
            store.delete_file(f"{at}/.{name}")
            raise
        if not writer:
            store.delete_file(f"{at}/.{name}")
        return Wrote(name if writer else "")

    def _groups(self, iterator: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
        """Batches put together into tables of a row group each."""
        some, rows, size = [], 0, 0
        for batch in iterator:
            while batch.num_rows:
                part = batch.slice(0, self.group_rows - rows)
                batch = batch.slice(part.num_rows)
                some.append(part)
                rows, size = rows + part.num_rows, size + part.nbytes
                if rows >= self.group_rows or size >= GROUP_BYTES:
                    yield pa.Table.from_batches(some)
                    some, rows, size = [], 0, 0
        if some:
            yield pa.Table.from_batches(some)

    def commit(self, messages: list) -> None:
        from pyarrow import fs

        store, at = self._store()
        if self.overwrite:
            for old in store.get_file_info(fs.FileSelector(at)):
                if old.is_file and not old.base_name.startswith("."):
                    store.delete_file(old.path)
        for m in messages:
            if m and m.name:
                store.move(f"{at}/.{m.name}", f"{at}/part-{m.name}")

    def abort(self, messages: list) -> None:
        store, at = self._store()
        for m in messages:
            if m and m.name:
                store.delete_file(f"{at}/.{m.name}")


class AnnotatedParquet(DataSource):
    @classmethod
    def name(cls) -> str:
        return "annotated_parquet"

    def writer(self, schema, overwrite):
        import json

        return AnnotatedWriter(dict(self.options), json.loads(self.options.get("hints", "{}")), overwrite)


def write_annotated(df: DataFrame, path: str, *, compression: str = "zstd", level: int | None = None, row_group_rows: int = GROUP_ROWS) -> None:
    """Writes a folder of annotated files, in place of the files that are there."""
    import json

    hints = {}
    for f in df.schema.fields:
        own = dict(f.metadata.get(LOGICAL + ".nested", {}))
        if LOGICAL in f.metadata:
            own[""] = f.metadata[LOGICAL]
        if own:
            hints[f.name] = own
    df.sparkSession.dataSource.register(AnnotatedParquet)
    options = {"path": path, "compression": compression, "hints": json.dumps(hints), "row_group_rows": str(row_group_rows)} | ({"level": str(level)} if level is not None else {})
    df.write.format("annotated_parquet").options(**options).mode("overwrite").save()
