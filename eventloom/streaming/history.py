"""STR4 across runs: messages that an earlier run has taken are not taken again.

A message id carries its own time (MID3) and a repeat carries the same id, so a
repeat can only stand in the part of the history for that day. The history is a
table partitioned by the day inside the id; a run joins it after a semi join on
the days of its own ids, which Spark turns into a filter on partitions, so old
parts are neither read nor shuffled.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from eventloom.functions.ids import message_id_millis
from eventloom.streaming.dedup import dedup_messages

#: Days after 1970-01-01 that have a part of their own (to the year 2099); ids
#: with earlier times, or none, share part ``NO_DAY``, later ones the last part.
#: This bounds the number of days.
LAST_DAY = 47_481
NO_DAY = -1
_MILLIS_A_DAY = 86_400_000


def id_day(message_id: Column) -> Column:
    """The part of the history that an id belongs to."""
    day = F.coalesce(F.floor(message_id_millis(message_id) / _MILLIS_A_DAY), F.lit(NO_DAY))
    return F.greatest(F.least(day, F.lit(LAST_DAY)), F.lit(NO_DAY)).cast("int")


def add_to_history(messages: DataFrame, path: str, run: int, id_col: str = "message_id") -> None:
    """Store the ids that run ``run`` took. The run's folder is overwritten, so
    a run that is done again stores each id once. NULL ids are not stored."""
    rows = messages.where(F.col(id_col).isNotNull()).select(F.col(id_col).alias("message_id"), id_day(F.col(id_col)).alias("id_day"))
    rows.repartition("id_day", F.pmod(F.xxhash64("message_id"), F.lit(16))).write.mode("overwrite").partitionBy("id_day").parquet(f"{path}/run={run}")


def read_history(spark: SparkSession, path: str, before_run: int | None = None) -> DataFrame:
    """Ids of the runs before ``before_run`` (all without it); ``path`` holds at
    least one run."""
    rows = spark.read.schema("message_id string, id_day int, run int").parquet(path)
    return rows if before_run is None else rows.where(F.col("run") < before_run)


def new_messages(received: DataFrame, history: DataFrame, id_col: str = "message_id", time_col: str = "sent_ts") -> DataFrame:
    """Earliest copy per id of ``received`` whose id is not in ``history``, with
    the copies received in this run. Rows without an id are one message (as in
    :func:`dedup_messages`) that no history holds."""
    first = dedup_messages(received, id_col, time_col).withColumn("__day", id_day(F.col(id_col)))
    # At most LAST_DAY + 2 rows, so their broadcast is bounded. The filter keeps
    # every row; a compared column lets Spark prune partitions by the days.
    days = received.select(id_day(F.col(id_col)).alias("id_day")).where(F.col("id_day") >= NO_DAY).distinct()
    stored = history.join(F.broadcast(days), "id_day", "left_semi").select(F.col("id_day").alias("__stored_day"), F.col("message_id").alias("__stored"))
    same = (F.col("__day") == F.col("__stored_day")) & (F.col(id_col) == F.col("__stored"))
    return first.join(stored, same, "left_anti").drop("__day")
