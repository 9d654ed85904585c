"""Property payload jobs over whole call tables (VAL1-VAL5).

Each job parses ``payload_json`` once to VARIANT (``try_parse_json``) and uses
built-in VARIANT functions; nothing runs in Python per row.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventloom.functions.json_values import (
    as_array, as_bool, as_double, as_int, as_string, is_null_value, parse_object, value_tag,
)


def props_convert(calls: DataFrame) -> DataFrame:
    """VAL1: payloads that convert (whole map) or not, per call kind and name.

    A bad payload gives NULL properties; the row is kept and counted here.
    """
    c = calls.filter(F.col("payload_json").isNotNull())
    ok = parse_object(F.col("payload_json")).isNotNull()
    return c.groupBy("call", "name").agg(
        F.count(F.lit(1)).alias("n"),
        F.count(F.when(ok, 1)).alias("n_ok"),
        F.count(F.when(~ok, 1)).alias("n_bad"),
    )


def props_quarantine(calls: DataFrame) -> DataFrame:
    """VAL1 side output: calls whose payload is not a JSON object."""
    return calls.filter(F.col("payload_json").isNotNull() & parse_object(F.col("payload_json")).isNull())


def _entries(calls: DataFrame) -> DataFrame:
    m = parse_object(F.col("payload_json"))
    return calls.filter(F.col("payload_json").isNotNull()).select(
        "device_id", "seq", "call", F.explode(m).alias("key", "v")
    )


def props_profile(calls: DataFrame) -> DataFrame:
    """VAL2: number of values per call kind, top-level key and value kind."""
    e = _entries(calls)
    return e.groupBy("call", "key", value_tag(F.col("v")).alias("tag")).agg(F.count(F.lit(1)).alias("n"))


def props_columns(calls: DataFrame, spec: dict[str, tuple[str, str]]) -> DataFrame:
    """VAL3: typed columns from chosen paths with strict accessors.

    ``spec`` maps an output column to ``(path, kind)`` with kind one of
    ``string int double bool array_size is_null``. The payload is parsed once;
    each path is extracted once and tagged once (staged projections).
    """
    v = F.try_parse_json(F.col("payload_json"))
    base = calls.filter(F.col("payload_json").isNotNull()).select("device_id", "seq", v.alias("__v"))
    base = base.select("device_id", "seq", F.when(F.schema_of_variant("__v").startswith("OBJECT"), F.col("__v")).alias("__v"))
    paths = sorted({p for p, _ in spec.values()})
    xs = base.select("device_id", "seq", *[F.try_variant_get("__v", p, "variant").alias(f"__x{i}") for i, p in enumerate(paths)])
    tagged = xs.select("*", *[value_tag(F.col(f"__x{i}")).alias(f"__t{i}") for i in range(len(paths))])
    cols = []
    for name, (path, kind) in spec.items():
        i = paths.index(path)
        x, t = F.col(f"__x{i}"), F.col(f"__t{i}")
        if kind == "string":
            c = as_string(x, t)
        elif kind == "int":
            c = as_int(x, t)
        elif kind == "double":
            c = as_double(x, t)
        elif kind == "bool":
            c = as_bool(x, t)
        elif kind == "array_size":
            arr = as_array(x, t)
            c = F.when(arr.isNotNull(), F.size(arr).cast("bigint"))
        elif kind == "is_null":
            c = is_null_value(x, t)
        else:
            raise ValueError(kind)
        cols.append(c.alias(name))
    return tagged.select("device_id", "seq", *cols)


def props_explode(calls: DataFrame) -> DataFrame:
    """VAL5: long table, one row per call, top-level key and array element.

    Arrays give one row per element (``pos`` from 0); other values (and empty
    arrays) give one row with ``pos`` NULL.
    """
    e = _entries(calls)
    e = e.select("device_id", "seq", "key", "v", value_tag(F.col("v")).alias("__t"))
    arr = as_array(F.col("v"), F.col("__t"))
    e = e.select("device_id", "seq", "key", "v", F.when(F.size(arr) > 0, arr).alias("__arr"))
    x = e.select("device_id", "seq", "key", "v", F.posexplode_outer("__arr").alias("pos", "el"))
    x = x.select("device_id", "seq", "key", "pos", F.when(F.col("pos").isNotNull(), F.col("el")).otherwise(F.col("v")).alias("val"))
    x = x.select("*", value_tag(F.col("val")).alias("tag"))
    val, tag = F.col("val"), F.col("tag")
    return x.select(
        "device_id", "seq", "key", F.col("pos").cast("bigint").alias("pos"), "tag",
        as_string(val, tag).alias("str_val"), as_double(val, tag).alias("num_val"), as_bool(val, tag).alias("bool_val"),
    )
