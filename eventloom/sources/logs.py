"""SRC1: read call and attempt logs written by collectors (parquet or JSON).

Schemas are fixed (no inference). JSON is read PERMISSIVE with a corrupt-record
column, so malformed lines go to a quarantine frame instead of failing the job.
Write the quarantine (or read it with its columns); Spark refuses a query that
reads only the corrupt-record column, such as a bare ``count()``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from eventloom.schemas import ATTEMPTS_SCHEMA, CALLS_SCHEMA

_CORRUPT = "_corrupt_record"


def _read(spark: SparkSession, path: str, schema: T.StructType, fmt: str) -> tuple[DataFrame, DataFrame]:
    if fmt == "parquet":
        df = spark.read.schema(schema).parquet(path)
        return df, df.limit(0)
    if fmt != "json":
        raise ValueError(fmt)
    with_corrupt = T.StructType(schema.fields + [T.StructField(_CORRUPT, T.StringType())])
    raw = spark.read.schema(with_corrupt).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", _CORRUPT).json(path)
    ok = raw.filter(F.col(_CORRUPT).isNull()).drop(_CORRUPT)
    # Keep every column: Spark refuses a plan that reads only the corrupt column.
    bad = raw.filter(F.col(_CORRUPT).isNotNull())
    return ok, bad


def read_calls(spark: SparkSession, path: str, fmt: str = "parquet") -> tuple[DataFrame, DataFrame]:
    """Calls log and its quarantine (malformed JSON lines)."""
    return _read(spark, path, CALLS_SCHEMA, fmt)


def read_attempts(spark: SparkSession, path: str, fmt: str = "parquet") -> tuple[DataFrame, DataFrame]:
    """Delivery-attempts log and its quarantine."""
    return _read(spark, path, ATTEMPTS_SCHEMA, fmt)


def calls_stream(spark: SparkSession, path: str, fmt: str = "parquet", max_files_per_trigger: int = 1) -> DataFrame:
    """SRC1/STR3: the calls log as a stream with bounded intake per micro-batch."""
    return spark.readStream.schema(CALLS_SCHEMA).option("maxFilesPerTrigger", max_files_per_trigger).format(fmt).load(path)
