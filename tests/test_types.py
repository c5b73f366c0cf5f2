"""Conversions against known values, from text output."""

import datetime
import math
import struct
from decimal import Decimal

import pytest

from parquill.errors import ParquillError, SettingsError, UnsupportedTypeError
from parquill.functions.nested_text import parse_array, parse_range, parse_record
from parquill.operators.export import configure
from parquill.plans.resolve import project
from parquill.settings import Settings
from parquill.types import ArrayOf, Composite, Domain, Enumeration, RangeOf, Simple, composite, parse_type

WEEK = Enumeration(("monday", "tuesday", "wednesday", "thursday", "friday", "saturday", "sunday"), "weekday")
CHAIN = composite("chain_id", pdbid="char(4)", model="int", chain="char(1)")


@pytest.fixture
def convert(spark):
    configure(spark)

    def run(values, t, **settings):
        df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, c string")
        out = project(df, {"c": t}, Settings(**settings))
        return [r["c"] for r in out.orderBy("i").collect()]

    return run


def test_numbers(convert):
    assert convert(["1", None, "-2"], "smallint") == [1, None, -2]
    assert convert(["4294967295"], "oid") == [4294967295]
    assert convert(["t", "f", None], "bool") == [True, False, None]
    assert convert(["1.1"], "real") == [1.100000023841858]
    d = convert(["NaN", "Infinity", "-Infinity", "-0"], "double precision")
    assert math.isnan(d[0]) and d[1:3] == [math.inf, -math.inf] and math.copysign(1, d[3]) == -1
    assert convert(["1.234,56 €", "kr 1 234,56", "12,34", "1,234.50 €", "£12"], "money") == [None, None, None, Decimal("1234.50"), Decimal("12.00")]
    assert convert(["1e25", "-1.239E1", "12.999"], "numeric", numeric="decimal", decimal_precision=38, decimal_scale=2) == [Decimal("1e25"), Decimal("-12.39"), Decimal("12.99")]
    assert convert(["$1,234.56", "-$0.01", "($5.00)", None], "money") == [Decimal("1234.56"), Decimal("-0.01"), Decimal("-5.00"), None]
    assert convert(["x", "", "\\377", None], '"char"') == [120, 0, 255, None]


def test_numeric(convert):
    assert convert(["1000.00010", "NaN"], "numeric(10,5)", numeric="decimal") == [Decimal("1000.000100000000000000"), None]
    assert convert(["1000.0001", "1"], "numeric", numeric="decimal", decimal_precision=9, decimal_scale=4) == [Decimal("1000.0001"), Decimal("1.0000")]
    assert convert(["1.239", "-1.239", "0." + "9" * 40], "numeric", numeric="decimal", decimal_precision=9, decimal_scale=2) == [Decimal("1.23"), Decimal("-1.23"), Decimal("0.99")]
    assert convert(["1.239"], "numeric", numeric="decimal", decimal_precision=9, decimal_scale=2, rounding="half_up") == [Decimal("1.24")]
    assert convert(["123456.7891"], "numeric", numeric="decimal", decimal_precision=9, decimal_scale=4) == [None]
    assert convert(["1000.0001"], "numeric", numeric="float") == [1000.0001]
    assert convert(["1000.0001"], "numeric", numeric="float32") == [1000.0001220703125]
    assert convert(["1000.00010", "NaN"], "numeric", numeric="string") == ["1000.00010", "NaN"]
    assert math.isnan(convert(["NaN"], "numeric")[0])
    with pytest.raises(SettingsError):
        Settings(numeric="decimal", decimal_precision=76, decimal_scale=50)


def test_text_and_bytes(convert):
    assert convert(["char      ", None], "char(10)") == ["char      ", None]
    assert [bytes(x) for x in convert(["foo", "\\x0001"], "bytea")] == [b"foo", b"\0\1"]
    assert convert(["0000000A-000B-000C-000D-E00000000001"], "uuid") == ["0000000a-000b-000c-000d-e00000000001"]
    assert convert(["08:00:2B:01:02:03"], "macaddr") == ["08:00:2b:01:02:03"]
    assert bytes(convert(["08:00:2b:01:02:03"], "macaddr", macaddr="byte-array")[0]) == bytes.fromhex("08002b010203")
    assert convert(["08:00:2b:01:02:03", "ff:00:2b:01:02:03"], "macaddr", macaddr="int64") == [576508035632136192, -72010310709215232]
    assert convert(["08:00:2b:01:02:03"], "macaddr", macaddr="int64", mac_layout="low") == [0x08002B010203]
    assert convert(["10.0.0.1/24", "::1"], "inet") == ["10.0.0.1", "::1"]
    assert convert(["101000", "B'101'"], "bit(6)") == ["101000", "101"]


def test_times(convert):
    assert convert(["2000-01-01", "infinity", None], "date") == [datetime.date(2000, 1, 1), None, None]
    assert convert(["2000-01-01 12:34:56.000001"], "timestamp") == [datetime.datetime(2000, 1, 1, 12, 34, 56, 1)]
    assert convert(["12:34:56", "00:00:00.25"], "time", time="micros") == [45296000000, 250000]
    text = ["1 year 2 months 1 days 40 hours 5 mins 6 secs 1 microsecond", "-40:00:00", None, "1 year 2 mons 1 day 40:05:06.000001"]
    assert [r and tuple(r) for r in convert(text, "interval", interval="struct")] == [(14, 1, 144306000001), (0, 0, -144000000000), None, (14, 1, 144306000001)]
    assert [x and struct.unpack("<iii", bytes(x)) for x in convert(text, "interval")] == [(14, 2, 57906000), (0, -1, -57600000), None, (14, 2, 57906000)]


def test_enums_domains(convert):
    assert convert(["monday", None, "sunday"], WEEK, enum="int") == [1, None, 7]
    assert convert(["monday", None], WEEK) == convert(["monday", None], WEEK, enum="plain-text") == ["monday", None]
    assert convert(["{monday,NULL}"], ArrayOf(WEEK), enum="int") == [[1, None]]
    assert convert(["1.55"], Domain(Simple("numeric")), numeric="decimal", decimal_precision=10, decimal_scale=1) == [Decimal("1.5")]
    with pytest.raises(Exception, match="unknown enum label"):
        convert(["someday"], WEEK, enum="int")


def test_arrays(convert):
    values = ["{{1,2},{NULL,3},{4,5}}", None, "{}", "{{{{1}}}}", "[-2:0]={1,2,3}"]
    assert convert(values, "int[]") == [[1, 2, None, 3, 4, 5], None, [], [1], [1, 2, 3]]
    dims = convert(values, "int[]", array="dims")
    assert [r and r["dims"] for r in dims] == [[3, 2], None, [], [1, 1, 1, 1], [3]]
    low = convert(values, "int[]", array="dims+lb")
    assert [r and r["lower_bound"] for r in low] == [[1, 1], None, [], [1, 1, 1, 1], [-2]]
    assert convert(["[-1:0][4:5]={{a,b},{c,d}}"], "text[]", array="dims+lb")[0]["lower_bound"] == [-1, 4]
    assert convert(["{1.5,NaN,NULL}"], "numeric(10,2)[]", numeric="decimal", decimal_precision=10, decimal_scale=2) == [[Decimal("1.50"), None, None]]


def test_ranges(convert):
    found = [r and tuple(r) for r in convert(["[1,2)", None, "(,3)", "empty", "(,)", "[2,)"], "int4range")]
    assert found == [(1, 2, True, False, False), None, (None, 3, False, False, False), (None, None, False, False, True), (None, None, False, False, False), (2, None, True, False, False)]
    assert [tuple(r) for r in convert(['{"[1,2)",empty}'], "int4range[]")[0]] == [(1, 2, True, False, False), (None, None, False, False, True)]
    assert [tuple(r) for r in convert(["[monday,tuesday]"], RangeOf(WEEK))] == [("monday", "tuesday", True, True, False)]


def test_composites(convert):
    assert [r and tuple(r) for r in convert(["(1ehz,1,A)", "(,,)", None, '("a,b",,"")'], CHAIN)] == [("1ehz", 1, "A"), (None, None, None), None, ("a,b", None, "")]
    assert [r and tuple(r) for r in convert(['{NULL,"(1ehz,1,A)","(,,A)"}'], ArrayOf(CHAIN))[0]] == [None, ("1ehz", 1, "A"), (None, None, "A")]
    deep = Composite((("list", ArrayOf(Composite((("v", Simple("vector")), ("n", ArrayOf(Simple("text"))))))),), "deep")
    inner = r'("{""(\\""[1,2]\\"",\\""{a,NULL}\\"")"",NULL}")'
    row = convert([inner, "()", None], deep)
    assert row[0]["list"][0]["v"] == [1.0, 2.0] and row[0]["list"][0]["n"] == ["a", None] and row[0]["list"][1] is None
    assert row[1]["list"] is None and row[2] is None


def test_vectors(convert):
    assert convert(["[1.0001,2,3,4,100000]"], "vector(5)") == [[1.000100016593933, 2.0, 3.0, 4.0, 100000.0]]
    assert convert(["[6.0e-8,1.001]"], "halfvec(2)") == [[5.960464477539063e-08, 1.0009765625]]
    halves = convert(["[1.0001,0,1.001,-4,10000,10001,-10000]"], "halfvec(7)", float16="float16")[0]
    assert [struct.unpack("<e", bytes(x))[0] for x in halves] == [1.0, 0.0, 1.0009765625, -4.0, 10000.0, 10000.0, -10000.0]
    assert convert(["{1:-1,5:5.25}/5", "{}/5", None], "sparsevec(5)") == [{1: -1.0, 5: 5.25}, {}, None]
    assert convert(['{"[1,2]",NULL}', "{}"], "vector(2)[]") == [[[1.0, 2.0], None], []]


def test_unsupported(convert):
    with pytest.raises(UnsupportedTypeError, match="column c"):
        convert(["(1,2)"], "point")
    with pytest.raises(UnsupportedTypeError, match="c/element"):
        convert(["{}"], "tsvector[]")


def test_parsers():
    assert parse_array('{NULL,"NULL","a\\"b","c\\\\d", e }') == ([None, "NULL", 'a"b', "c\\d", "e"], [5], [1])
    assert parse_record('(1,"a""b",,"")') == ["1", 'a"b', None, ""]
    assert parse_range('["2000-01-01 00:00:00",)') == ("2000-01-01 00:00:00", None, True, False, False)
    for bad in ("1,2", "{1,2"):
        with pytest.raises(ParquillError):
            parse_array(bad)
    assert parse_type("double precision[]") == ArrayOf(Simple("float8")) and parse_type("numrange") == RangeOf(Simple("numeric"))
