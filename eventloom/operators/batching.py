"""Buffering and batching rules over event tables (BUF1-BUF9, TIM2, SNK1).

The reference keeps one FIFO per client: bounded at 2000 (drop oldest),
drained in chunks of at most 100, flushed every 10 s or once 20 events wait,
failed batches go back to the front. Here each rule is a table operator keyed
by a queue key (``device_id`` by default) and ordered by ``seq``:

* top-k rules (keep newest/first N, requeue merge) use ``row_number() <= N``,
  which Spark plans, for N up to ``spark.sql.optimizer.windowGroupLimitThreshold``,
  as a WindowGroupLimit before and after the shuffle; in a session that splits
  keys they are positions of the split scan, cut inside each chunk first, for
  any N;
* positions (batch numbers, count windows, drop-front) use the skew-safe
  running count of :mod:`eventloom.plans.scan`;
* batch bodies collect at most ``max_batch`` events per group.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from eventloom.functions.times import iso_seconds
from eventloom.plans.scan import DEFAULT_WIDTH, SEQ_WIDTH, running, split_session

# ---- fixed values: queue and flush settings -----------------------------------
QUEUE_CAPACITY = 2000
MAX_BATCH = 100
AUTO_FLUSH_AT = 20
FLUSH_INTERVAL = "10 seconds"
PROXY_BUFFER = 20
BATCH_HALVING = [100, 50, 25, 12, 6, 3, 1]
# --------------------------------------------------------------------------------


def _keys(key: str | Sequence[str]) -> list[str]:
    return [key] if isinstance(key, str) else list(key)


def _first_rows(df: DataFrame, n: int, keys: list[str], order: Column, position: str | None = None) -> DataFrame:
    """The first ``n`` rows of each key in ``order`` (a bigint); with
    ``position`` their places, from 1, stay as that column."""
    name = position or "__rn"
    if split_session(df.sparkSession):
        d = df.withColumn("__order", order)
        # At most n rows of a key and cell can be among its first n.
        cell = Window.partitionBy(*keys, F.floor(F.col("__order") / SEQ_WIDTH)).orderBy("__order")
        d = d.withColumn("__in_cell", F.row_number().over(cell)).filter(F.col("__in_cell") <= n).drop("__in_cell")
        out = running(d, keys, "__order", total={name: F.lit(1)}).drop("__order")
    else:
        out = df.withColumn(name, F.row_number().over(Window.partitionBy(*keys).orderBy(order)).cast("bigint"))
    out = out.filter(F.col(name) <= n)
    return out if position else out.drop(name)


def keep_newest(df: DataFrame, n: int = QUEUE_CAPACITY, key: str | Sequence[str] = "device_id", order: str = "seq") -> DataFrame:
    """BUF1: bounded buffer, drop oldest: the newest ``n`` rows per key."""
    return _first_rows(df, n, _keys(key), -F.col(order).cast("bigint"))


def keep_first(df: DataFrame, n: int = QUEUE_CAPACITY, key: str | Sequence[str] = "device_id", order: str = "seq") -> DataFrame:
    """BUF2 / BUF5 ``drain``: drop newest, i.e. the first ``n`` rows per key."""
    return _first_rows(df, n, _keys(key), F.col(order).cast("bigint"))


def drop_front(df: DataFrame, n: int, key: str | Sequence[str] = "device_id", order: str = "seq", width: int | None = DEFAULT_WIDTH) -> DataFrame:
    """BUF5 ``dropFront``: all but the first ``n`` rows per key."""
    return running(df, _keys(key), order, total={"__rn": F.lit(1)}, width=width).filter(F.col("__rn") > n).drop("__rn")


def prebind_replay(calls: DataFrame, n: int = PROXY_BUFFER, width: int | None = DEFAULT_WIDTH) -> DataFrame:
    """BUF3: calls made before a device's first ``initialize``; the last ``n``
    are replayed in order (``replay_pos`` from 1). Devices without an
    ``initialize`` row replay nothing. One read: of the rows up to the first
    ``initialize`` the newest ``n + 1`` are kept, and its row is among them if
    there is one."""
    is_init = F.coalesce(F.col("call") == "initialize", F.lit(False))
    c = running(calls, "device_id", "seq", total={"__inits": is_init.cast("bigint")}, width=width)
    upto = c.filter((F.col("__inits") == 0) | ((F.col("__inits") == 1) & is_init)).drop("__inits")
    device = Window.partitionBy("device_id")  # at most n + 1 rows
    kept = keep_newest(upto, n + 1).withColumn("__bound", F.max(is_init).over(device)).filter(F.col("__bound") & ~is_init).drop("__bound")
    return kept.withColumn("replay_pos", F.row_number().over(device.orderBy("seq")).cast("bigint"))


def requeue_merge(failed: DataFrame, new: DataFrame, capacity: int = QUEUE_CAPACITY, key: str | Sequence[str] = "device_id") -> DataFrame:
    """BUF6: failed events go ahead of new ones; over capacity the newest new
    events are lost. Adds ``is_new`` and ``queue_pos`` (from 1)."""
    u = failed.withColumn("is_new", F.lit(False)).unionByName(new.withColumn("is_new", F.lit(True)))
    place = F.col("seq").cast("bigint") + F.when(F.col("is_new"), F.lit(1 << 61)).otherwise(F.lit(0))
    return _first_rows(u, capacity, _keys(key), place, "queue_pos")


def flush_window(ts: Column, interval: str = FLUSH_INTERVAL) -> Column:
    return F.window(ts, interval)["start"]


def batch_assign(
    events: DataFrame,
    key: str | Sequence[str] = "device_id",
    interval: str = FLUSH_INTERVAL,
    max_batch: int = MAX_BATCH,
    width: int | None = DEFAULT_WIDTH,
    extra_keys: Sequence[str] = (),
) -> DataFrame:
    """BUF4: FIFO chunks of at most ``max_batch`` per key and flush window.

    Adds ``flush_start`` (window start), ``batch_no`` and ``batch_pos`` (from 0)
    and a ``batch_id`` text. The key is a parameter: per device like the
    reference, or e.g. ``write_key`` for a shared job (the flush window keeps a
    hot write key spread over many groups). ``extra_keys`` adds boundaries,
    e.g. ``flush_epoch`` so no batch spans an explicit ``flush`` call.
    """
    keys = _keys(key) + list(extra_keys)
    e = events.withColumn("flush_start", flush_window(F.col("ts"), interval))
    e = running(e, [*keys, "flush_start"], "seq", total={"__rn": F.lit(1)}, width=width)
    e = e.withColumn("batch_no", F.floor((F.col("__rn") - 1) / max_batch).cast("bigint")).withColumn(
        "batch_pos", ((F.col("__rn") - 1) % max_batch).cast("bigint")
    )
    bid = F.concat_ws(":", *[F.col(k).cast("string") for k in keys], F.unix_seconds("flush_start").cast("string"), F.col("batch_no").cast("string"))
    return e.withColumn("batch_id", bid).drop("__rn")


def batch_keys(key: str | Sequence[str], extra_keys: Sequence[str] = ()) -> list[str]:
    """The columns that name a batch of :func:`batch_assign`. Its rows are already
    dealt by the first of them, so grouping by these needs no other shuffle
    (as grouping by the text ``batch_id`` alone does)."""
    return [*_keys(key), *extra_keys, "flush_start", "batch_no"]


def sent_at(batched: DataFrame, by: Sequence[str] = ("batch_id",)) -> DataFrame:
    """TIM2: one ``sentAt`` per batch, the time of its newest event (a live sink
    would use the drain time). Adds ``sent_at`` to every row. ``by``: ``batch_id``
    or :func:`batch_keys`."""
    w = Window.partitionBy(*by)  # a batch holds at most MAX_BATCH rows
    return batched.withColumn("sent_at", iso_seconds(F.max("ts").over(w)))


def batch_summary(batched: DataFrame, by: Sequence[str] = ("batch_id",)) -> DataFrame:
    """TIM2 report: events and ``sentAt`` per batch."""
    return batched.groupBy(*dict.fromkeys([*by, "batch_id"])).agg(F.count(F.lit(1)).alias("n_events"), iso_seconds(F.max("ts")).alias("sent_at")).select("batch_id", "n_events", "sent_at")


def batch_bodies(batched: DataFrame, env: Column, by: Sequence[str] = ("batch_id",)) -> DataFrame:
    """SNK1: ``{"batch":[...]}`` per batch, events in FIFO order, each stamped
    with the batch's ``sentAt`` (TIM2) as its last field. Each event is serialized once per
    row; the batch (at most ``max_batch`` events, so the collected list is bounded)
    joins the texts in ``batch_pos`` order and stamps them, so that its time needs no
    other sort of the rows. ``by``: ``batch_id`` or :func:`batch_keys`."""
    names = list(dict.fromkeys([*by, "batch_id"]))
    event_json = F.to_json(env.withField("sentAt", F.lit(None).cast("string")), {"ignoreNullFields": "true"})
    unended = F.left(event_json, F.length(event_json) - 1)
    rows = batched.select(*names, "ts", F.struct(F.col("batch_pos").alias("pos"), unended.alias("j")).alias("item"))
    g = rows.groupBy(*names).agg(F.sort_array(F.collect_list("item")).alias("items"), iso_seconds(F.max("ts")).alias("sent_at"))
    stamp = F.coalesce(F.concat(F.lit('"sentAt":"'), F.col("sent_at"), F.lit('"}')), F.lit("}"))
    between = lambda j: F.when((j == "{") | F.col("sent_at").isNull(), "").otherwise(",")
    stamped = F.transform("items", lambda x: F.concat(x["j"], between(x["j"]), stamp))
    body = F.concat(F.lit('{"batch":['), F.array_join(stamped, ","), F.lit("]}"))
    return g.select("batch_id", F.size("items").cast("bigint").alias("n_events"), body.alias("body"))


def write_bodies(bodies: DataFrame, path: str) -> None:
    """SNK1 sink: one JSON body per line."""
    bodies.select("body").write.mode("overwrite").text(path)


def flush_windows(events: DataFrame, interval: str = FLUSH_INTERVAL, max_batch: int = MAX_BATCH, key: str = "device_id") -> DataFrame:
    """BUF8: events per key and tumbling flush window, and requests needed."""
    g = events.groupBy(key, F.window("ts", interval).alias("w")).agg(F.count(F.lit(1)).alias("n"))
    return g.select(
        key, F.unix_seconds(F.col("w.start")).alias("window_start_s"), "n",
        F.ceil(F.col("n") / max_batch).cast("bigint").alias("n_batches"),
    )


def count_windows(events: DataFrame, threshold: int = AUTO_FLUSH_AT, key: str = "device_id", width: int | None = DEFAULT_WIDTH) -> DataFrame:
    """BUF9: flush as soon as ``threshold`` events wait: consecutive groups of
    ``threshold`` per key with first/last seq and size."""
    e = running(events, key, "seq", total={"__rn": F.lit(1)}, width=width)
    e = e.withColumn("group_no", F.floor((F.col("__rn") - 1) / threshold).cast("bigint"))
    return e.groupBy(key, "group_no").agg(
        F.min("seq").alias("first_seq"), F.max("seq").alias("last_seq"), F.count(F.lit(1)).alias("size")
    )


def stamped_bytes(env: Column, ts: Column) -> Column:
    """Bytes of an event's JSON as it is sent, with its ``sentAt`` (whose text
    has the same length for every time)."""
    return F.octet_length(F.to_json(env.withField("sentAt", iso_seconds(ts)), {"ignoreNullFields": "true"})).cast("bigint")


def size_batches(
    sized: DataFrame,
    max_bytes: int,
    key: str | Sequence[str] = "device_id",
    interval: str = FLUSH_INTERVAL,
    sizes: Sequence[int] = BATCH_HALVING,
    width: int | None = DEFAULT_WIDTH,
) -> tuple[DataFrame, DataFrame]:
    """BUF7: batches whose body ``{"batch":[e1,...]}`` fits ``max_bytes``.

    ``sized`` has the key, ``seq``, ``ts`` and ``bytes`` (:func:`stamped_bytes`).
    Events that do not fit alone go to quarantine. The rest is batched as by
    BUF4, and a batch is cut into pieces of the largest candidate size (halving
    from its 100) at which each piece fits. A batch is bounded, so its byte
    counts are one short array. Returns (rows with ``flush_start, batch_no,
    batch_size, piece``; quarantined rows)."""
    alone = F.lit(12) + F.col("bytes")
    quarantine = sized.where(alone > max_bytes)
    b = batch_assign(sized.where(alone <= max_bytes), key=key, interval=interval, max_batch=sizes[0], width=width)
    keys = [*_keys(key), "flush_start", "batch_no"]
    g = b.groupBy(*keys).agg(F.sort_array(F.collect_list(F.struct("batch_pos", "seq", "bytes"))).alias("rows"))

    def fits(size: int) -> Column:
        pieces = F.sequence(F.lit(0), F.floor((F.size("rows") - 1) / size).cast("int"))
        piece = lambda i: F.slice(F.col("rows.bytes"), i * size + 1, F.lit(size))
        total = lambda i: F.aggregate(piece(i), F.lit(0).cast("bigint"), lambda x, y: x + y)
        return F.forall(pieces, lambda i: F.lit(11) + total(i) + F.size(piece(i)) <= max_bytes)

    size = F.coalesce(*[F.when(fits(s), F.lit(s)) for s in sizes], F.lit(1))
    out = g.withColumn("batch_size", size).select(*keys, "batch_size", F.explode("rows").alias("r"))
    return out.select(
        *keys, "batch_size", F.col("r.seq").alias("seq"), F.col("r.bytes").alias("bytes"),
        F.floor(F.col("r.batch_pos") / F.col("batch_size")).cast("bigint").alias("piece"),
    ), quarantine
