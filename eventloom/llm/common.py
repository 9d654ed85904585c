"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from eventloom.session import ensure_checkpoint_dir

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = "abcdefghijklmnopqrstuvwxyz"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def table_path(spark: SparkSession, name: str) -> str:
    """A new path in the shared checkpoint folder, removed when the
    application ends."""
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/llm-{name}-{uuid.uuid4().hex}"
    jvm = spark.sparkContext._jvm
    hadoop_path = jvm.org.apache.hadoop.fs.Path(path)
    hadoop_path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(hadoop_path)
    return path


def keep(df: DataFrame, name: str, **options: object) -> DataFrame:
    """Write ``df`` as a table in the shared folder and read it back: cuts the
    lineage, so that a lost executor costs a re-read and not a re-run. ``options``
    are those of the writer."""
    path = table_path(df.sparkSession, name)
    df.write.options(**options).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def free_shuffles(df: DataFrame) -> None:
    """Let Spark drop the shuffle files of finished jobs now: it does so when
    the driver collects its garbage, which may come late on a large heap. It
    changes no result; it lowers the disk in use, which the check counts too."""
    df.sparkSession.sparkContext._jvm.System.gc()


#: Rows and bytes (of the rows as JSON text) up to which a table is sent to all
#: executors; larger ones are joined by a shuffle, with the same result.
BROADCAST_ROWS = 400_000
BROADCAST_BYTES = 64 << 20


def sized(table: DataFrame, rows: int = BROADCAST_ROWS, size: int = BROADCAST_BYTES) -> DataFrame:
    """``table``, marked for broadcast if it has at most ``rows`` rows and
    ``size`` bytes; give a kept table, for it is counted. Bytes are summed only
    where a column has no fixed width."""
    if table.limit(rows + 1).count() > rows:
        return table
    if all(isinstance(f.dataType, (T.NumericType, T.BooleanType, T.DatetimeType)) for f in table.schema):
        return F.broadcast(table)
    total = table.agg(F.sum(F.octet_length(F.to_json(F.struct("*"))).cast("bigint"))).first()[0]
    return F.broadcast(table) if (total or 0) <= size else table


def small_batches(df: DataFrame, rows: int = 1000) -> DataFrame:
    """``df``, with Python tasks of its session given at most ``rows`` rows at
    once: texts may be long, and a worker holds a batch several times."""
    conf, name = df.sparkSession.conf, "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(conf.get(name)) <= rows:
        conf.set(name, str(rows))
    return df


def lower_ascii(col: Column) -> Column:
    return F.translate(col, UPPER, LOWER)


def text_hash() -> Column:
    """Hash of ``text``; with the doc_id it is the key of a row, so that rows
    that share a doc_id (or have none) stay apart."""
    return F.xxhash64(F.coalesce(F.col("text").cast("string"), F.lit(""))).alias("text_hash")


def fold(col: Column, modulus: int) -> Column:
    """crc32 of an id's text modulo ``modulus``; a null id counts as ''."""
    return F.crc32(F.coalesce(col.cast("string"), F.lit("")).cast("binary")) % modulus
