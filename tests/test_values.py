"""JSON values: seven kinds, strict accessors, whole-map conversion (VAL1-VAL5)."""

from pyspark.sql import functions as F

from eventloom.functions.json_values import (
    as_bool, as_double, as_int, as_string, is_null_value, parse_object, value_tag,
)


def test_seven_kinds(spark):
    df = spark.createDataFrame(
        [('{"s":"x","i":42,"d":3.5,"b":true,"a":[1,"two"],"o":{"k":"v"},"n":null,"f":3.0,"e":1e3,"big":12345678901234567890}',)],
        "j string",
    )
    m = parse_object(F.col("j"))
    row = df.select(*[value_tag(F.element_at(m, k)).alias(k) for k in ["s", "i", "d", "b", "a", "o", "n", "f", "e", "big"]]).first()
    assert row.asDict() == {
        "s": "string", "i": "int", "d": "double", "b": "bool", "a": "array", "o": "object", "n": "null",
        "f": "int", "e": "int", "big": "double",
    }


def test_strict_accessors(spark):
    df = spark.createDataFrame([('{"s":"42","i":7,"b":true,"d":2.5}',)], "j string")
    m = parse_object(F.col("j"))
    v = lambda k: F.element_at(m, k)
    r = df.select(
        as_int(v("s")).alias("s_int"), as_string(v("s")).alias("s_str"), as_double(v("i")).alias("i_dbl"),
        as_int(v("b")).alias("b_int"), as_bool(v("b")).alias("b_bool"), as_int(v("d")).alias("d_int"),
        as_double(v("d")).alias("d_dbl"), is_null_value(v("s")).alias("s_null"),
    ).first()
    assert r.s_int is None and r.s_str == "42"   # "42" is not an int
    assert r.i_dbl == 7.0                         # int widens to double
    assert r.b_int is None and r.b_bool is True   # true is not a number
    assert r.d_int is None and r.d_dbl == 2.5
    assert r.s_null is False


def test_whole_map_or_nothing(spark):
    df = spark.createDataFrame([('{"a":1,"b":',), ("[1,2]",), ('{"a":{"b":[1,{"c":null}]}}',), (None,)], "j string")
    got = [r.ok for r in df.select(parse_object(F.col("j")).isNotNull().alias("ok")).collect()]
    assert got == [False, False, True, False]


def test_edge_values(spark):
    """Emoji, empty string, zero, negative and large numbers keep their kinds."""
    df = spark.createDataFrame(
        [('{"emoji":"🎉","empty":"","zero":0,"neg":-42,"big":999999999999,"neg_d":-0.5,"nested":{"a":[1,{"b":null}]}}',)],
        "j string",
    )
    m = parse_object(F.col("j"))
    keys = ["emoji", "empty", "zero", "neg", "big", "neg_d", "nested"]
    tags = df.select(*[value_tag(F.element_at(m, k)).alias(k) for k in keys]).first().asDict()
    assert tags == {"emoji": "string", "empty": "string", "zero": "int", "neg": "int", "big": "int", "neg_d": "double", "nested": "object"}
    r = df.select(
        as_string(F.element_at(m, "emoji")).alias("e"), as_int(F.element_at(m, "big")).alias("b"),
        as_int(F.element_at(m, "neg")).alias("n"), F.to_json(F.element_at(m, "nested")).alias("nested"),
    ).first()
    assert (r.e, r.b, r.n) == ("🎉", 999999999999, -42)
    assert r.nested == '{"a":[1,{"b":null}]}'
