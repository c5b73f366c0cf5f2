"""Sinks, footers, schemas, connections, command line, streams."""

import json
import os

import pyarrow as pa
import pyarrow.parquet as pq
import pytest

from parquill import cli
from parquill.errors import ConnectionProblem, SettingsError
from parquill.operators.diagnostics import failing_rows
from parquill.operators.export import configure, export
from parquill.operators.sink import compression_options
from parquill.plans.schema_tree import format_schema, leaf_count
from parquill.settings import Settings
from parquill.sources import postgres
from parquill.sources.footers import file_schema, footers, inspect, totals
from parquill.streaming.batches import export_stream
from parquill.types import ArrayOf, Composite, Enumeration, RangeOf, Simple
from tests.conftest import SF


def test_one_file(spark, tmp_path):
    df = spark.range(3000).selectExpr("id", "cast(id as string) as name", "1 as fixed").orderBy("id")
    target = str(tmp_path / "out.parquet")
    for codec, name in (("zstd", "ZSTD"), ("gzip", "GZIP"), ("snappy", "SNAPPY"), ("none", "UNCOMPRESSED"), ("lz4", "LZ4")):
        stats = export(spark, target, df=df, compression=codec, row_group_rows=1000)
        assert (stats.rows, stats.groups) == (3000, 3) and stats.bytes > 3000 * 8 and stats.bytes_out == os.path.getsize(target)
        meta = pq.ParquetFile(target).metadata
        assert meta.num_row_groups == 3 and name in meta.row_group(0).column(0).compression
    table = pq.read_table(target)
    assert table["id"].to_pylist() == list(range(3000)) and all(f.nullable for f in table.schema)
    assert len(footers(spark, target)) == 3 and inspect(spark, target).count() == 9 and "optional int64 id" in file_schema(spark, target)
    assert [p.name for p in tmp_path.iterdir() if not p.name.startswith(".")] == ["out.parquet"]


def test_empty_result(spark, tmp_path):
    stats = export(spark, str(tmp_path / "e.parquet"), df=spark.range(0))
    assert (stats.rows, stats.groups) == (0, 0) and pq.read_table(tmp_path / "e.parquet").num_rows == 0


def test_codec_options():
    assert compression_options("zstd", 9)["parquet.compression.codec.zstd.level"] == "9"
    for codec, level in (("snappy", 3), ("none", 1), ("lzo", None), ("brotli", None), ("gzip", 12)):
        with pytest.raises(SettingsError):
            compression_options(codec, level)


TYPED = {"o": "oid", "u": "uuid", "j": "json", "h": "halfvec(2)", "m": "macaddr", "c": '"char"', "p": Composite((("u", Simple("uuid")), ("l", ArrayOf(Simple("oid")))), "p"), "e": Enumeration(("a",))}


def _typed(spark):
    row = ("7", "0000000a-000b-000c-000d-e00000000001", "{}", "[1,2]", "08:00:2b:01:02:03", "x", '(0000000a-000b-000c-000d-e00000000001,"{1,2}")', "a")
    return spark.createDataFrame([row, (None,) * 8], ", ".join(f"{n} string" for n in TYPED))


def test_annotated(spark, tmp_path):
    export(spark, str(tmp_path / "a"), df=_typed(spark).coalesce(1), types=TYPED, settings=Settings(json="text-marked-as-json", float16="float16", macaddr="byte-array"), sink="annotated", compression="brotli")
    schema = pq.read_schema(next((tmp_path / "a").glob("part-*")))
    assert schema.field("o").type == pa.uint32() and schema.field("u").type == pa.uuid() and schema.field("c").type == pa.uint8() and schema.field("m").type == pa.binary(6)
    assert schema.field("h").type.value_type == pa.float16() and schema.field("p").type.field("u").type == pa.uuid() and schema.field("p").type.field("l").type.value_type == pa.uint32()
    table = pq.read_table(next((tmp_path / "a").glob("part-*")))
    assert table["o"].to_pylist() == [7, None] and str(table["u"].to_pylist()[0]) == "0000000a-000b-000c-000d-e00000000001" and table["p"].to_pylist()[1] is None


def test_schema_text(spark):
    from parquill.plans.resolve import project

    schema = project(_typed(spark), TYPED, Settings(json="text-marked-as-json")).schema
    text = format_schema(schema)
    assert "o: UInt32" in text and "j: Json" in text and "e: Enum" in text and "  u: Uuid" in text and leaf_count(schema) == 9


def test_failing_rows(spark):
    df = spark.createDataFrame([("a", "1"), ("b", "x"), ("c", None)], "id string, v string")
    found = failing_rows(df, "v", df.v.try_cast("int")).collect()
    assert [tuple(r) for r in found] == [("id=b", "v", "x")]


def test_stream(spark, tmp_path):
    configure(spark)
    source = f"{SF}/events.parquet"
    stream = spark.readStream.schema(spark.read.parquet(source).schema).parquet(os.path.dirname(source) + "/events.parquet*")
    q = export_stream(stream, str(tmp_path / "out"), str(tmp_path / "check"), types={"props": "jsonb"})
    q.awaitTermination(120)
    assert spark.read.parquet(str(tmp_path / "out")).count() == spark.read.parquet(source).count()


def test_connections():
    c = postgres.connection(url="postgresql://me:p%40ss@db.example.org:6000/shop?sslmode=require", env={})
    assert (c.host, c.port, c.user, c.password, c.dbname, c.sslmode) == ("db.example.org", 6000, "me", "p@ss", "shop", "require") and "p@ss" not in repr(c)
    assert postgres.connection(env={"POSTGRES_URL": "postgres://a/x", "DATABASE_URL": "postgres://b/y"}).host == "a"
    assert postgres.connection(env={"DATABASE_URL": "postgres://b/y", "PGUSER": "u", "PGPASSWORD": "w"}).password == "w"
    own = postgres.connection(host="h", dbname="d", password="p", ssl_root_cert="r.pem", env={})
    assert own.user == "d" and own.sslmode == "require" and own.options()["sslrootcert"] == "r.pem" and own.options()["sslmode"] == "verify-full"
    assert c.options()["sslfactory"].endswith("DefaultJavaSSLFactory") and "sslfactory" not in own.options()
    for wrong in ({"url": "postgres://a/x", "host": "h"}, {}, {"host": "h", "dbname": "d", "password": "", "ssl_client_cert": "c"}):
        with pytest.raises(SettingsError):
            postgres.connection(env={}, **wrong)
    for wrong in ("mysql://a/x", "postgres://"):
        with pytest.raises(ConnectionProblem):
            postgres.from_url(wrong, {})
    assert "driver is not" in str(postgres.explained(Exception("ClassNotFoundException: org.postgresql.Driver"), own))


def test_pushdown_sql():
    assert postgres.quoted_table('shop."My Table"') == '"shop"."My Table"' and postgres.quoted_table("a") == '"a"'
    with pytest.raises(SettingsError):
        postgres.quoted_table("a..b")
    types = {"id": Simple("int4"), "r": RangeOf(Simple("int4"))}
    assert postgres.pushed_query("select 1", types) == 'SELECT q."id", q."r"::text AS "r" FROM (select 1) q'
    rows = {
        1: {"name": "_mood", "kind": "b", "category": "A", "element": 2}, 2: {"name": "mood", "kind": "e", "category": "E", "element": 0, "labels": "ok\x01bad"},
        3: {"name": "pair", "kind": "c", "category": "C", "element": 0, "fields": "m\x021\x01n\x024"}, 4: {"name": "int4", "kind": "b", "category": "N", "element": 0},
    }
    assert postgres.type_tree(3, rows) == Composite((("m", ArrayOf(Enumeration(("ok", "bad"), "mood"))), ("n", Simple("int4"))), "pair")


def test_command_line(spark, tmp_path, capsys, monkeypatch):
    for name in ("POSTGRES_URL", "DATABASE_URL", "PGHOST"):
        monkeypatch.delenv(name, raising=False)
    target = str(tmp_path / "cli.parquet")
    assert cli.main(["export", "-q", "select r_regionkey, upper(r_name) as name from region", "-o", target, "--input", f"region={SF}/region.parquet", "--quiet"]) == 0
    assert pq.read_table(target).num_rows == 5 and capsys.readouterr().err == ""
    assert cli.main(["export", "-t", "x", "-o", target]) == 2
    assert cli.main(["export", "-t", "x", "-o", target, "-c", "postgres://a/b", "-H", "h"]) == 2
    assert cli.main(["export", "-t", "x", "-o", target, "--input", "x=y", "--numeric-handling", "no"]) == 2
    with pytest.raises(SystemExit) as e:
        cli.main(["export", "-q", "a", "-t", "b", "-o", target])
    assert e.value.code == 2
    with pytest.raises(SystemExit):
        cli.main(["export", "-h"])
    assert len(capsys.readouterr().out.splitlines()) < 40
    assert cli.main(["inspect", target]) == 0 and "name" in capsys.readouterr().out


def test_catalogue_keys():
    from parquill.plans import catalogue

    assert set(catalogue.oracle_sql()) <= set(catalogue.queries()) and len(catalogue.queries()) > 60
    assert json.dumps(sorted(catalogue.queries()))


def test_sliced_lists_keep_nulls():
    import pyarrow as pa

    from parquill.operators.annotated import annotated_table

    rows = [[9], None, [2], None, [3]]
    sliced = pa.table({"a": pa.array(rows, pa.list_(pa.int64())).slice(1)})
    found = annotated_table(sliced, {"a": {"/element": "UINT_32"}}).column("a")
    assert found.to_pylist() == rows[1:] and found.type == pa.list_(pa.uint32())


def test_annotated_replaces_and_groups(spark, tmp_path):
    types = {"u": "uuid", "h": "halfvec(2)", "s": "sparsevec(9)"}
    rows = [(f"0000000a-000b-000c-000d-{k:012x}" if k % 3 else None, "[1,2.5]" if k % 4 else None, "{1:-1,5:5.25}/9" if k % 5 else None) for k in range(250)]
    df = spark.createDataFrame(rows, "u string, h string, s string").coalesce(1)
    for _ in range(2):
        export(spark, str(tmp_path / "a"), df=df, types=types, settings=Settings(float16="float16"), sink="annotated", row_group_rows=100)
    (path,) = [p for p in (tmp_path / "a").iterdir() if p.name.endswith(".parquet") and not p.name.startswith(".")]
    file = pq.ParquetFile(path)
    assert file.metadata.num_row_groups == 3 and b"parquill.version" in file.schema_arrow.metadata
    table = file.read()
    assert table.schema.field("s").type.key_type == pa.uint32()
    assert [x and str(x) for x in table["u"].to_pylist()] == [r[0] for r in rows]
    assert [x and [float(v) for v in x] for x in table["h"].to_pylist()] == [r[1] and [1.0, 2.5] for r in rows]
    assert [x and dict(x) for x in table["s"].to_pylist()] == [r[2] and {1: -1.0, 5: 5.25} for r in rows]


def test_lost_values_are_told(spark, tmp_path, capsys):
    df = spark.createDataFrame([("a", "1.5", "{1,2}"), ("b", "NaN", "{{1,2},{3,4}}"), ("c", None, None)], "id string, v string, t string")
    stats = export(spark, str(tmp_path / "x.parquet"), df=df, types={"v": "numeric(9,2)", "t": "int4[]"}, settings=Settings(numeric="decimal"), quiet=False)
    said = capsys.readouterr().err
    assert stats.lost == {"v": 1} and "column v: 1 values became NULL, one of them in row id=b" in said and "column t: 1 arrays" in said
    assert export(spark, str(tmp_path / "x.parquet"), df=df.where("id = 'a'"), types={"t": "int4[]"}).lost == {}


def test_footers_in_tasks(spark, tmp_path):
    path = str(tmp_path / "many")
    spark.range(1000).repartition(9).write.parquet(path)
    assert totals(spark, path, few=0) == totals(spark, path) and totals(spark, path)["rows"] == 1000


def test_unsorted_rows_in_parallel(spark, tmp_path):
    from parquill.operators.sink import _sorted

    df = spark.range(100).selectExpr("id", "id * 2 as twice")
    assert not _sorted(df) and _sorted(df.orderBy("id")) and _sorted(df.orderBy("id").select("twice")) and not _sorted(df.sortWithinPartitions("id"))
    assert export(spark, str(tmp_path / "u.parquet"), df=df).rows == 100 and pq.read_table(tmp_path / "u.parquet")["id"].to_pylist() != []
