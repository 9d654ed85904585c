"""JSON property values as VARIANT (VAL1-VAL5).

A property map is ``MAP<STRING, VARIANT>``; a whole payload is one VARIANT.
The seven value kinds of the reference are derived from ``schema_of_variant``:
``null string int double bool array object``. A number is ``int`` when it is
integral and fits 64 bits, else ``double`` (Spark reads ``3.0`` as DECIMAL(1,0)
and ``1e3`` as DOUBLE, so the tag is decided on the value, not the text).
The strict accessors never coerce: ``"42"`` is not an int, ``true`` is not a
number; only int widens to double.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---- fixed values: value kinds ---------------------------------------------
TAGS = ["null", "string", "int", "double", "bool", "array", "object"]
# ----------------------------------------------------------------------------

#: Kind by the schema's leading word; numbers start as int.
_KINDS = {
    "STRING": "string", "BOOLEAN": "bool", "VOID": "null", "ARRAY": "array", "OBJECT": "object",
    **dict.fromkeys(("TINYINT", "SMALLINT", "INT", "BIGINT", "FLOAT", "DOUBLE", "DECIMAL"), "int"),
}


def parse_object(text: Column) -> Column:
    """VAL1: JSON text to MAP<STRING,VARIANT>; NULL if malformed or not an object."""
    return F.try_variant_get(F.try_parse_json(text), "$", "map<string,variant>")


def is_object_text(text: Column) -> Column:
    return parse_object(text).isNotNull()


def value_tag(v: Column) -> Column:
    """VAL2: kind of a VARIANT value (NULL for a missing value)."""
    # The leading word of the schema, looked up: the schema text, which holds a
    # nested value's whole type, is built once for most kinds.
    word = F.regexp_extract(F.schema_of_variant(v), "^[A-Z]+", 0)
    kind = F.try_element_at(F.create_map(*[F.lit(x) for kv in _KINDS.items() for x in kv]), word)
    as_long = F.try_variant_get(v, "$", "bigint")
    as_double = F.try_variant_get(v, "$", "double")
    integral = as_long.isNotNull() & (as_long.cast("double") == as_double)
    fraction = as_double.isNotNull() & ~F.coalesce(integral, F.lit(False))
    return F.when(v.isNotNull(), F.when((kind == "int") & fraction, F.lit("double")).otherwise(kind))


def _tag(v: Column, tag: Column | None) -> Column:
    return value_tag(v) if tag is None else tag


def as_string(v: Column, tag: Column | None = None) -> Column:
    return F.when(_tag(v, tag) == "string", F.try_variant_get(v, "$", "string"))


def as_int(v: Column, tag: Column | None = None) -> Column:
    return F.when(_tag(v, tag) == "int", F.try_variant_get(v, "$", "bigint"))


def as_double(v: Column, tag: Column | None = None) -> Column:
    return F.when(_tag(v, tag).isin("int", "double"), F.try_variant_get(v, "$", "double"))


def as_bool(v: Column, tag: Column | None = None) -> Column:
    return F.when(_tag(v, tag) == "bool", F.try_variant_get(v, "$", "boolean"))


def as_array(v: Column, tag: Column | None = None) -> Column:
    return F.when(_tag(v, tag) == "array", F.try_variant_get(v, "$", "array<variant>"))


def as_object(v: Column, tag: Column | None = None) -> Column:
    return F.when(_tag(v, tag) == "object", F.try_variant_get(v, "$", "map<string,variant>"))


def is_null_value(v: Column, tag: Column | None = None) -> Column:
    return F.coalesce(_tag(v, tag) == "null", F.lit(False))


def str_variant(c: Column) -> Column:
    """A string column as a VARIANT string value."""
    return c.cast("variant")


def empty_props() -> Column:
    return F.create_map().cast("map<string,variant>")
