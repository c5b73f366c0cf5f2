"""Queries that show each operator on the driver's tables, with the same query for DuckDB."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from parquill.operators.diagnostics import row_label
from parquill.operators.export import configure, export
from parquill.plans.resolve import project
from parquill.plans.schema_tree import leaf_count, walk
from parquill.settings import Settings
from parquill.sources.footers import footers, inspect
from parquill.types import ArrayOf, Composite, Domain, Enumeration, RangeOf, Simple

#: The event types in their order as an enumeration.
EVENTS = ("view", "click", "signup", "purchase", "error")
WEEK = Enumeration(EVENTS, "event_type")

FLAGSHIP = """
SELECT n.n_name AS nation, count(*) AS items, CAST(sum(CAST(l.l_extendedprice AS decimal(18,2))) AS decimal(38,2)) AS revenue
FROM nation n JOIN customer c ON c.c_nationkey = n.n_nationkey JOIN orders o ON o.o_custkey = c.c_custkey JOIN lineitem l ON l.l_orderkey = o.o_orderkey
GROUP BY n.n_name"""

_queries: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
_oracle: dict[str, str] = {}


def _table(spark: SparkSession, d: str, name: str) -> DataFrame:
    return configure(spark).read.parquet(f"{d}/{name}.parquet")


def _views(spark: SparkSession, d: str, *names: str) -> None:
    for n in names:
        _table(spark, d, n).createOrReplaceTempView(n)


def _query(sql: str | None = None, name: str | None = None):
    """Registers a function as a query of its name, with its DuckDB form."""

    def add(f):
        key = name or f.__name__
        _queries[key] = f
        if sql is not None:
            _oracle[key] = sql
        return f

    return add


def _same_sql(name: str, sql: str, *tables: str) -> None:
    def run(spark: SparkSession, d: str) -> DataFrame:
        _views(spark, d, *tables)
        return project(spark.sql(sql))

    _query(sql, name)(run)


def _mapped(name: str, table: str, columns: dict[str, str], types: dict, sql: str, after: list[str] | None = None, **settings) -> None:
    """Columns of a table, converted as the given source types; `after` picks scalars of the result."""

    def run(spark: SparkSession, d: str) -> DataFrame:
        rows = _table(spark, d, table).select(*[F.expr(e).alias(n) for n, e in columns.items()])
        out = project(rows, types, Settings(**settings))
        return out.selectExpr(*after) if after else out

    _query(sql, name)(run)


# scans and pass-through

_same_sql("scan_table", "SELECT * FROM region", "region")
_same_sql("scan_query", "SELECT l_orderkey, l_linenumber, l_orderkey * 2 AS double_key, upper(l_returnflag) AS flag FROM lineitem", "lineitem")
_same_sql("passthrough_join_agg", FLAGSHIP, "nation", "customer", "orders", "lineitem")
_same_sql(
    "passthrough_window_topk",
    "SELECT * FROM (SELECT o_custkey, o_orderkey, CAST(row_number() OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC, o_orderkey) AS int) AS place FROM orders) ranked WHERE place <= 3",
    "orders",
)
_same_sql(
    "passthrough_rollup_setops",
    "SELECT l_returnflag AS flag, l_linestatus AS status, count(*) AS items FROM lineitem GROUP BY ROLLUP (l_returnflag, l_linestatus) UNION ALL SELECT o_orderstatus AS flag, NULL AS status, count(*) AS items FROM orders GROUP BY o_orderstatus",
    "lineitem", "orders",
)

# numbers

_mapped("type_bool", "events", {"event_id": "event_id", "b": "case when event_type = 'purchase' then 't' else 'f' end"}, {"b": "bool"}, "SELECT event_id, event_type = 'purchase' AS b FROM events")
_mapped(
    "type_ints", "lineitem", {"small": "cast(l_linenumber as string)", "plain": "cast(l_linenumber as string)", "big": "cast(l_orderkey as string)", "oid": "cast(l_partkey as string)"},
    {"small": "smallint", "plain": "integer", "big": "bigint", "oid": "oid"},
    "SELECT CAST(l_linenumber AS smallint) AS small, CAST(l_linenumber AS int) AS plain, CAST(l_orderkey AS bigint) AS big, CAST(l_partkey AS bigint) AS oid FROM lineitem",
)
_mapped("type_floats", "events", {"event_id": "event_id", "f": "cast(value as string)", "d": "cast(value as string)"}, {"f": "real", "d": "double precision"}, "SELECT event_id, CAST(CAST(value AS varchar) AS float) AS f, CAST(value AS double) AS d FROM events")
_mapped("numeric_decimal_i32", "events", {"event_id": "event_id", "x": "cast(value as string)"}, {"x": "numeric(10,4)"}, "SELECT event_id, TRY_CAST(CAST(trunc(CAST(CAST(value AS varchar) AS decimal(18,9)) * 100) AS decimal(18,0)) / 100 AS decimal(9,2)) AS x FROM events", numeric="decimal", decimal_precision=9, decimal_scale=2)
_mapped("numeric_decimal_i64", "lineitem", {"l_orderkey": "l_orderkey", "l_linenumber": "l_linenumber", "x": "cast(l_extendedprice as string)"}, {"x": "numeric"}, "SELECT l_orderkey, l_linenumber, CAST(CAST(l_extendedprice AS varchar) AS decimal(18,9)) AS x FROM lineitem", numeric="decimal", decimal_precision=18, decimal_scale=9)
_mapped("numeric_decimal_bytes", "lineitem", {"l_orderkey": "l_orderkey", "l_linenumber": "l_linenumber", "x": "cast(l_extendedprice as string)"}, {"x": "numeric"}, "SELECT l_orderkey, l_linenumber, CAST(CAST(l_extendedprice AS varchar) AS decimal(38,18)) AS x FROM lineitem", numeric="decimal")
_mapped("numeric_decimal_overflow", "lineitem", {"l_orderkey": "l_orderkey", "l_linenumber": "l_linenumber", "x": "cast(cast(cast(l_extendedprice as string) as decimal(20,2)) * 1000 as string)"}, {"x": "numeric"}, "SELECT l_orderkey, l_linenumber, TRY_CAST(CAST(CAST(l_extendedprice AS varchar) AS decimal(20,2)) * 1000 AS decimal(9,4)) AS x FROM lineitem", numeric="decimal", decimal_precision=9, decimal_scale=4)
for _name, _kind, _sql in (("double", "double", "double"), ("float32", "float32", "float"), ("string", "string", "varchar")):
    _mapped(
        f"numeric_{_name}", "orders", {"o_orderkey": "o_orderkey", "x": "cast(cast(cast(o_totalprice as string) as decimal(20,2)) as string)"}, {"x": "numeric(20,2)"},
        f"SELECT o_orderkey, CAST(CAST(CAST(CAST(o_totalprice AS varchar) AS decimal(20,2)) AS varchar) AS {_sql}) AS x FROM orders", numeric=_kind,
    )


@_query("""SELECT event_id, CASE WHEN event_type = 'error' THEN NULL ELSE CAST(CAST(value AS varchar) AS decimal(18,4)) END AS as_decimal,
 CASE WHEN event_type = 'error' THEN true ELSE false END AS is_nan, CASE WHEN event_type = 'error' THEN 'NaN' ELSE CAST(CAST(CAST(value AS varchar) AS decimal(18,4)) AS varchar) END AS as_string FROM events""")
def numeric_nan(spark: SparkSession, d: str) -> DataFrame:
    text = "case when event_type = 'error' then 'NaN' else cast(cast(cast(value as string) as decimal(18,4)) as string) end"
    rows = _table(spark, d, "events").selectExpr("event_id", *[f"{text} as {n}" for n in ("as_decimal", "as_double", "as_string")])
    one = project(rows, {"as_decimal": "numeric"}, Settings(numeric="decimal", decimal_precision=18, decimal_scale=4))
    two = project(one, {"as_double": "numeric"}, Settings())
    return project(two, {"as_string": "numeric"}, Settings(numeric="string")).selectExpr("event_id", "as_decimal", "isnan(as_double) as is_nan", "as_string")


_mapped("type_money", "orders", {"o_orderkey": "o_orderkey", "m": "concat('$', cast(cast(o_totalprice as string) as decimal(18,2)))"}, {"m": "money"}, "SELECT o_orderkey, CAST(CAST(o_totalprice AS varchar) AS decimal(18,2)) AS m FROM orders")
_mapped("type_char", "events", {"event_id": "event_id", "c": "event_type"}, {"c": '"char"'}, "SELECT event_id, CAST(ascii(event_type) AS smallint) AS c FROM events")

# text, bytes, time

_mapped("type_bytea", "events", {"event_id": "event_id", "b": "concat('\\\\x', lower(hex(event_type)))"}, {"b": "bytea"}, "SELECT event_id, encode(event_type) AS b FROM events")
_mapped(
    "type_text_bpchar", "customer", {"c_custkey": "c_custkey", "t": "c_name", "v": "c_name", "n": "c_mktsegment", "x": "concat('<a>', c_mktsegment, '</a>')", "b": "rpad(c_mktsegment, 12, ' ')"},
    {"t": "text", "v": "varchar(30)", "n": "name", "x": "xml", "b": "char(12)"},
    "SELECT c_custkey, c_name AS t, c_name AS v, c_mktsegment AS n, '<a>' || c_mktsegment || '</a>' AS x, rpad(c_mktsegment, 12, ' ') AS b FROM customer",
)
_mapped("type_json", "events", {"event_id": "event_id", "j": "props", "jb": "props"}, {"j": "json", "jb": "jsonb"}, "SELECT event_id, props AS j, props AS jb, props->>'$.k' AS k FROM events", after=["event_id", "j", "jb", "get_json_object(jb, '$.k') as k"], json="text-marked-as-json")
_mapped("type_timestamps", "events", {"event_id": "event_id", "tz": "cast(ts as string)", "ntz": "cast(ts as string)"}, {"tz": "timestamptz", "ntz": "timestamp"}, "SELECT event_id, epoch_us(ts) AS micros, ts AS ntz FROM events", after=["event_id", "unix_micros(tz) as micros", "ntz"])
_mapped("type_date_time", "events", {"event_id": "event_id", "day": "cast(cast(ts as date) as string)", "time": "date_format(ts, 'HH:mm:ss.SSSSSS')"}, {"day": "date", "time": "time"}, "SELECT event_id, CAST(ts AS date) AS day, epoch_us(ts) % 86400000000 AS micros FROM events", after=["event_id", "day", "time as micros"], time="micros")
_UUID = "regexp_replace({}(md5(cast(event_id as {})) ), '^(.{{8}})(.{{4}})(.{{4}})(.{{4}})(.{{12}})$', '{}')"
_mapped("type_uuid", "events", {"event_id": "event_id", "u": _UUID.format("upper", "string", "$1-$2-$3-$4-$5")}, {"u": "uuid"}, "SELECT event_id, " + _UUID.format("", "varchar", "\\1-\\2-\\3-\\4-\\5") + " AS u FROM events")
_MAC = {"event_id": "event_id", "m": "regexp_replace(upper(lpad(hex(user_id * 7919 + event_id * 1000003), 12, '0')), '^(..)(..)(..)(..)(..)(..)$', '$1:$2:$3:$4:$5:$6')"}
_HEX = "lower(lpad(hex(user_id * 7919 + event_id * 1000003), 12, '0'))"
_mapped("type_mac_text", "events", _MAC, {"m": "macaddr"}, "SELECT event_id, " + " || ':' || ".join(f"substr({_HEX}, {i}, 2)" for i in (1, 3, 5, 7, 9, 11)) + " AS m FROM events")
_mapped("type_mac_bytes", "events", _MAC, {"m": "macaddr"}, f"SELECT event_id, unhex({_HEX}) AS m FROM events", macaddr="byte-array")
_mapped("type_mac_int64", "events", _MAC, {"m": "macaddr"}, "SELECT event_id, (user_id * 7919 + event_id * 1000003) * 65536 AS m FROM events", macaddr="int64")
_INET = "concat('10.', cast(user_id % 256 as {0}), '.', cast(event_id % 256 as {0}), '.1{1}')"
_mapped("type_inet", "events", {"event_id": "event_id", "i": _INET.format("string", "/24")}, {"i": "inet"}, "SELECT event_id, " + _INET.format("varchar", "") + " AS i FROM events")
_mapped("type_bits", "events", {"event_id": "event_id", "b": "lpad(bin(user_id), 32, '0')", "v": "bin(event_id)"}, {"b": "bit(32)", "v": "bit varying"}, "SELECT event_id, lpad(bin(user_id), 32, '0') AS b, bin(event_id) AS v FROM events")

# intervals

_INTERVAL = {"event_id": "event_id", "months": "cast(event_id % 29 - 14 as int)", "days": "cast(user_id % 41 - 20 as int)", "us": "(event_id * 7777777 + user_id) % 400000000000 - 200000000000"}


def _intervals(spark: SparkSession, d: str, **settings) -> DataFrame:
    rows = _table(spark, d, "events").selectExpr(*[f"{e} as {n}" for n, e in _INTERVAL.items()])
    rows = rows.select("event_id", F.struct("months", "days", F.col("us").alias("microseconds")).alias("i"))
    return project(rows, {"i": "interval"}, Settings(**settings))


@_query("""SELECT event_id, m AS months, d + ms // 86400000 AS days, ms % 86400000 AS millis FROM (SELECT event_id, event_id % 29 - 14 AS m, user_id % 41 - 20 AS d,
 ((event_id * 7777777 + user_id) % 400000000000 - 200000000000) // 1000 AS ms FROM events) x""")
def interval_parquet(spark: SparkSession, d: str) -> DataFrame:
    le = "cast(conv(hex(reverse(substr(i, {0}, 4))), 16, 10) as bigint)"
    signed = [f"if({le.format(p)} >= 2147483648, {le.format(p)} - 4294967296, {le.format(p)}) as {n}" for p, n in ((1, "months"), (5, "days"), (9, "millis"))]
    swap = "unhex(regexp_replace(hex(i), '(..)(..)(..)(..)', '$4$3$2$1'))"
    rows = _intervals(spark, d).selectExpr("event_id", f"{swap} as i")
    return rows.selectExpr("event_id", *[s.replace("reverse(", "(") for s in signed])


@_query("SELECT event_id, CAST(event_id % 29 - 14 AS int) AS months, CAST(user_id % 41 - 20 AS int) AS days, (event_id * 7777777 + user_id) % 400000000000 - 200000000000 AS microseconds FROM events")
def interval_struct(spark: SparkSession, d: str) -> DataFrame:
    return _intervals(spark, d, interval="struct").selectExpr("event_id", "i.months", "i.days", "i.microseconds")


@_query("""SELECT event_id, CAST((event_id % 7) * 12 + event_id % 5 AS int) AS months, CAST(user_id % 30 AS int) AS days, (event_id % 50) * 3600000000 + (user_id % 60) * 60000000 + 5250000 AS microseconds FROM events""")
def interval_text(spark: SparkSession, d: str) -> DataFrame:
    text = "concat(event_id % 7, ' years ', event_id % 5, ' mons ', user_id % 30, ' days ', lpad(event_id % 50, 2, '0'), ':', lpad(user_id % 60, 2, '0'), ':05.25')"
    rows = _table(spark, d, "events").selectExpr("event_id", f"{text} as i")
    return project(rows, {"i": "interval"}, Settings(interval="struct")).selectExpr("event_id", "i.months", "i.days", "i.microseconds")


# enumerations and domains

for _name, _mode, _sql in (("text", "text", "event_type"), ("plain", "plain-text", "event_type"), ("int", "int", f"CAST(list_position({list(EVENTS)}, event_type) AS int)")):
    _mapped(f"enum_{_name}", "events", {"event_id": "event_id", "e": "event_type"}, {"e": WEEK}, f"SELECT event_id, {_sql} AS e FROM events", enum=_mode)
_mapped("type_domain", "orders", {"o_orderkey": "o_orderkey", "price": "cast(o_totalprice as string)"}, {"price": Domain(Simple("numeric"), "price")}, "SELECT o_orderkey, CAST(CAST(o_totalprice AS varchar) AS decimal(10,2)) AS price FROM orders", numeric="decimal", decimal_precision=10, decimal_scale=2)

# arrays

_LINES = "SELECT l_orderkey, array_agg(l_linenumber ORDER BY l_linenumber) AS a FROM lineitem GROUP BY l_orderkey"


@_query(f"SELECT l_orderkey, CAST(i - 1 AS int) AS at, a[i] AS item FROM (SELECT l_orderkey, a, unnest(generate_series(1, len(a))) AS i FROM ({_LINES}) x) y")
def array_plain(spark: SparkSession, d: str) -> DataFrame:
    rows = _table(spark, d, "lineitem").groupBy("l_orderkey").agg(F.array_sort(F.collect_list("l_linenumber")).alias("a"))
    return project(rows, {"a": "int4[]"}).select("l_orderkey", F.posexplode("a").alias("at", "item"))


@_query(f"SELECT l_orderkey, array_to_string(a, ',') AS data, CAST(len(a) AS varchar) AS dims, '1' AS lower FROM ({_LINES}) x")
def array_text(spark: SparkSession, d: str) -> DataFrame:
    rows = _table(spark, d, "lineitem").groupBy("l_orderkey").agg(F.array_sort(F.collect_list("l_linenumber")).alias("a"))
    rows = rows.selectExpr("l_orderkey", "concat('{', array_join(cast(a as array<string>), ','), '}') as a")
    out = project(rows, {"a": "int4[]"}, Settings(array="dims+lb"))
    join = "array_join(cast(a.{} as array<string>), ',') as {}"
    return out.selectExpr("l_orderkey", join.format("data", "data"), join.format("dims", "dims"), join.format("lower_bound", "lower"))


def _matrix(spark: SparkSession, d: str, mode: str) -> DataFrame:
    rows = _table(spark, d, "embeddings").selectExpr("vec_id", "transform(sequence(0, 7), i -> slice(embedding, i * 8 + 1, 8)) as m")
    return project(rows, {"m": "float4[]"}, Settings(array=mode))


_MATRIX = "(SELECT vec_id, flatten(list_transform(range(0, 8), lambda i: embedding[i*8+1:i*8+8])) AS f FROM embeddings) x"


_CELLS = f"SELECT vec_id, CAST(i - 1 AS int) AS place, CAST(f[i] AS float) AS value, '8,8' AS dims{{}} FROM (SELECT vec_id, f, unnest(generate_series(1, len(f))) AS i FROM {_MATRIX}) y"


@_query(_CELLS.format(""))
def array_dims(spark: SparkSession, d: str) -> DataFrame:
    return _matrix(spark, d, "dims").selectExpr("vec_id", "posexplode(m.data) as (place, value)", "array_join(cast(m.dims as array<string>), ',') as dims")


@_query(_CELLS.format(", '1,1' AS lower"))
def array_dims_lb(spark: SparkSession, d: str) -> DataFrame:
    join = "array_join(cast(m.{} as array<string>), ',') as {}"
    return _matrix(spark, d, "dims+lb").selectExpr("vec_id", "posexplode(m.data) as (place, value)", join.format("dims", "dims"), join.format("lower_bound", "lower"))


_mapped(
    "array_nulls", "events", {"event_id": "event_id", "a": "case event_id % 4 when 0 then null when 1 then '{}' when 2 then '{NULL}' else concat('{', event_type, ',NULL,\"NULL\"}') end"}, {"a": "text[]"},
    "SELECT event_id, event_id % 4 = 0 AS missing, CASE event_id % 4 WHEN 0 THEN NULL WHEN 1 THEN 0 WHEN 2 THEN 1 ELSE 3 END::int AS items, CASE event_id % 4 WHEN 2 THEN 1 WHEN 3 THEN 1 WHEN 1 THEN 0 END::int AS nulls, CASE WHEN event_id % 4 = 3 THEN event_type END AS first FROM events",
    after=["event_id", "a is null as missing", "if(a is null, null, size(a)) as items", "if(a is null, null, size(filter(a, x -> x is null))) as nulls", "try_element_at(a, 1) as first"],
)

# ranges and composites

_RANGE = ["lower", "upper", "lower_inclusive", "upper_inclusive", "is_empty"]


def _ranges(name: str, t: RangeOf, text: str, sql: str, table: str, key: str, **settings) -> None:
    fields = [f"r.{f} as {f}" for f in _RANGE]
    _mapped(name, table, {key: key, "r": text}, {"r": t}, sql, after=[key, *fields], **settings)


_ranges(
    "range_numeric", RangeOf(Simple("numeric")), "concat('[', cast(cast(o_totalprice as string) as decimal(18,2)), ',', cast(cast(o_totalprice as string) as decimal(18,2)) + 10, ')')",
    "SELECT o_orderkey, CAST(CAST(o_totalprice AS varchar) AS decimal(18,2)) AS lower, CAST(CAST(CAST(o_totalprice AS varchar) AS decimal(18,2)) + 10 AS decimal(18,2)) AS upper, true AS lower_inclusive, false AS upper_inclusive, false AS is_empty FROM orders",
    "orders", "o_orderkey", numeric="decimal", decimal_precision=18, decimal_scale=2,
)
_ranges(
    "range_ts", RangeOf(Simple("timestamp")), "concat('(\"', cast(ts as string), '\",\"', cast(ts + interval 1 day as string), '\"]')",
    "SELECT event_id, ts AS lower, ts + INTERVAL 1 DAY AS upper, false AS lower_inclusive, true AS upper_inclusive, false AS is_empty FROM events", "events", "event_id",
)
_ranges(
    "range_empty", RangeOf(Simple("int4")), "case event_id % 4 when 0 then 'empty' when 1 then '(,)' when 2 then concat('(,', event_id, ')') else concat('[', event_id, ',)') end",
    "SELECT event_id, CASE WHEN event_id % 4 = 3 THEN event_id END::int AS lower, CASE WHEN event_id % 4 = 2 THEN event_id END::int AS upper, event_id % 4 = 3 AS lower_inclusive, false AS upper_inclusive, event_id % 4 = 0 AS is_empty FROM events", "events", "event_id",
)

REGION = Composite((("key", Simple("int4")), ("name", Simple("text"))), "region")


@_query("SELECT n_nationkey, n_name AS name, r_regionkey AS region_key, r_name AS region_name FROM nation JOIN region ON r_regionkey = n_regionkey")
def composite_nested(spark: SparkSession, d: str) -> DataFrame:
    text = "concat('(\"', n_name, '\",\"(', r_regionkey, ',\"\"', r_name, '\"\")\")')"
    rows = _table(spark, d, "nation").join(_table(spark, d, "region"), F.expr("r_regionkey = n_regionkey")).selectExpr("n_nationkey", f"{text} as c")
    out = project(rows, {"c": Composite((("name", Simple("text")), ("region", REGION)), "nation")})
    return out.selectExpr("n_nationkey", "c.name", "c.region.key as region_key", "c.region.name as region_name")


_mapped(
    "composite_null", "events", {"event_id": "event_id", "c": "case event_id % 3 when 0 then null when 1 then '(,)' else concat('(', event_id, ',', event_type, ')') end"}, {"c": REGION},
    "SELECT event_id, event_id % 3 = 0 AS missing, CASE WHEN event_id % 3 = 2 THEN event_id END::int AS key, CASE WHEN event_id % 3 = 2 THEN event_type END AS name FROM events",
    after=["event_id", "c is null as missing", "c.key", "c.name"],
)

# vectors

_TEXT_VECTOR = "concat('[', array_join(transform(embedding, x -> cast(x as string)), ','), ']')"
_ITEMS = "(SELECT vec_id, CAST(i - 1 AS int) AS place, CAST(embedding[i] AS double) AS x FROM (SELECT vec_id, embedding, unnest(generate_series(1, len(embedding))) AS i FROM embeddings) y) z"
_mapped("vector_dense", "embeddings", {"vec_id": "vec_id", "v": _TEXT_VECTOR}, {"v": "vector(64)"}, f"SELECT vec_id, place, CAST(x AS float) AS value FROM {_ITEMS}", after=["vec_id", "posexplode(v) as (place, value)"])
_mapped("sparsevec_map", "embeddings", {"vec_id": "vec_id", "v": "transform(embedding, x -> if(abs(x) > 0.25, x, cast(0 as float)))"}, {"v": "sparsevec(64)"}, "SELECT vec_id, CAST(i AS int) AS key, CAST(embedding[i] AS float) AS value FROM (SELECT vec_id, embedding, unnest(generate_series(1, len(embedding))) AS i FROM embeddings) x WHERE abs(embedding[i]) > 0.25", after=["vec_id", "explode(v) as (key, value)"])


#: Half precision by arithmetic: multiples of the place value of the tenth binary digit, ties to even.
_HALF = f"SELECT vec_id, place, CAST(CASE WHEN x = 0 THEN 0 ELSE round_even(x / p, 0) * p END AS float) AS value FROM (SELECT *, pow(2, CASE WHEN x = 0 THEN 0 ELSE greatest(floor(log2(abs(x))), -14) - 10 END) AS p FROM {_ITEMS}) w"


@_query(_HALF)
def halfvec_float32(spark: SparkSession, d: str) -> DataFrame:
    rows = _table(spark, d, "embeddings").selectExpr("vec_id", f"{_TEXT_VECTOR} as v")
    return project(rows, {"v": "halfvec(64)"}).selectExpr("vec_id", "posexplode(v) as (place, value)")


@_query(_HALF)
def halfvec_float16(spark: SparkSession, d: str) -> DataFrame:
    """The two bytes of every value, read as a sign, five bits of exponent and ten of fraction."""
    rows = _table(spark, d, "embeddings").selectExpr("vec_id", f"{_TEXT_VECTOR} as v")
    found = project(rows, {"v": "halfvec(64)"}, Settings(float16="float16")).selectExpr("vec_id", "posexplode(v) as (place, b)")
    bits = found.selectExpr("vec_id", "place", "cast(conv(concat(substr(hex(b), 3, 2), substr(hex(b), 1, 2)), 16, 10) as int) as n")
    parts = bits.selectExpr("vec_id", "place", "if(n >= 32768, -1, 1) as s", "(n div 1024) % 32 as e", "n % 1024 as m")
    return parts.selectExpr("vec_id", "place", "cast(s * if(e = 0, m * pow(2, -24), (1024 + m) * pow(2, e - 25)) as float) as value")


# schemas and diagnostics

_TREE = [
    ("id", 0, "Int32", True), ("amount", 0, "Decimal(18, 2)", True), ("at", 0, "Timestamp(us, utc=true)", True), ("tags", 0, "List", True), ("tags/element", 1, "String", True),
    ("place", 0, "Struct", True), ("place/key", 1, "Int32", True), ("place/name", 1, "String", True),
]


def _typed(spark: SparkSession) -> DataFrame:
    rows = configure(spark).sql("SELECT '1' AS id, '$2.50' AS amount, '2000-01-01 00:00:00+00' AS at, '{a,b}' AS tags, '(1,x)' AS place")
    return project(rows, {"id": "int4", "amount": "money", "at": "timestamptz", "tags": ArrayOf(Simple("text")), "place": REGION})


@_query("SELECT * FROM (VALUES " + ", ".join(f"('{p}', {d}, '{t}', {str(o).lower()})" for p, d, t, o in _TREE) + ") x(path, depth, type, optional)")
def schema_tree(spark: SparkSession, d: str) -> DataFrame:
    nodes = [(p, depth, t, o) for depth, p, t, o in walk(_typed(spark).schema)]
    return spark.createDataFrame(nodes, "path string, depth int, type string, optional boolean")


@_query("SELECT CAST(6 AS int) AS leaves")
def leaf_counts(spark: SparkSession, d: str) -> DataFrame:
    return spark.createDataFrame([(leaf_count(_typed(spark).schema),)], "leaves int")


@_query("SELECT c_custkey, CASE WHEN c_custkey % 2 = 0 THEN 'name=' || c_name ELSE 'c_custkey=' || c_custkey END AS label FROM customer")
def row_identify(spark: SparkSession, d: str) -> DataFrame:
    rows = _table(spark, d, "customer").selectExpr("if(c_custkey % 2 = 0, c_name, null) as name", "c_custkey")
    return rows.select("c_custkey", row_label(rows).alias("label"))


# sinks


def _target(spark: SparkSession, name: str) -> str:
    """A place that all executors reach: beside the warehouse."""
    return f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/parquill/{name}-{uuid.uuid4().hex}.parquet"


def _roundtrip(codec: str) -> None:
    @_query("SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority FROM orders", f"sink_roundtrip_{codec}")
    def run(spark: SparkSession, d: str) -> DataFrame:
        path = _target(spark, f"orders-{codec}")
        export(spark, path, df=_table(spark, d, "orders"), compression=codec, single_file=False)
        return spark.read.parquet(path)


for _codec in ("zstd", "gzip", "snappy", "lz4", "none"):
    _roundtrip(_codec)


def _orders_file(spark: SparkSession, d: str, **writing):
    path = _target(spark, "orders")
    return path, export(spark, path, df=_table(spark, d, "orders"), single_file=False, **writing)


@_query("SELECT CAST(sum(1) AS bigint) AS rows FROM orders")
def sink_row_groups(spark: SparkSession, d: str) -> DataFrame:
    path, _ = _orders_file(spark, d, row_group_rows=1000)
    groups = footers(spark, path)
    assert all(g["rows"] <= 1000 for g in groups)
    return spark.createDataFrame([(sum(g["rows"] for g in groups),)], "rows long")


@_query("SELECT count(*) AS rows FROM orders")
def export_stats(spark: SparkSession, d: str) -> DataFrame:
    _, stats = _orders_file(spark, d)
    return spark.createDataFrame([(stats.rows,)], "rows long")


@_query()
def inspect_file(spark: SparkSession, d: str) -> DataFrame:
    path, _ = _orders_file(spark, d)
    return inspect(spark, path).drop("file")


def flagship(spark: SparkSession, d: str) -> DataFrame:
    """Revenue by nation: SQL, typed projection, zstd Parquet, read back."""
    _views(spark, d, "nation", "customer", "orders", "lineitem")
    path = _target(spark, "flagship")
    export(spark, path, query=FLAGSHIP, types={"revenue": "numeric"}, settings=Settings(numeric="decimal", decimal_precision=38, decimal_scale=2), single_file=False)
    return spark.read.parquet(path)


_query(FLAGSHIP, "export_flagship")(flagship)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(_queries)


def oracle_sql() -> dict[str, str]:
    return dict(_oracle)
