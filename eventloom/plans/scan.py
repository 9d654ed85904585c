"""Running (prefix) values per key, whole or split along the order.

Most operators of the engine are "state as of this row" questions: the user id
set by the last ``identify``, the number of ``reset`` rows so far, the number of
413 answers before this attempt. ``running`` answers them with one window per
key, or with the key split along its order; both give the same rows.

The split is an explicit choice, never taken by looking at the data: by the
``width`` argument, or for a whole session by ``spark.eventloom.scan.split``
(``cluster_conf`` sets it). It bounds what one task holds, so that a device or
write key with a third of all rows runs in parallel, and costs a second read of
the input. Chunks are cells of a fixed grid on the first order column
(``SEQ_WIDTH`` numbers or ``TIME_WIDTH_US`` microseconds), so one outlier in the
order only makes one more chunk:

1. a window per ``(key, chunk)`` gives the in-chunk running value;
2. a per-chunk summary (partial aggregation, so only one row per chunk is
   shuffled) gives each chunk's total, and a window over the summaries gives the
   carry-in from all earlier chunks of the key;
3. a join on ``(key, chunk)`` combines them.

Two kinds of running value are supported, both associative:

* ``last``: the last non-NULL value of an expression (wrap a value in a struct
  when an explicit NULL must overwrite: ``struct(x AS v)`` is non-NULL even if
  ``x`` is NULL);
* ``total``: the running sum (NULL counts as 0).

Both include the current row. NULL keys form one group; rows with a NULL order
value come first and are one chunk.

``clamped`` is a third kind, for state that has bounds: the value after functions
``x -> min(max(x + add, low), high)``, which compose to functions of that shape.
The composition runs over sorted Arrow batches as a segmented doubling scan, so a
key streams through its task; chunks carry their composed function like a total.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

#: ``None`` follows the session's setting, ``0`` never splits, a number is the
#: chunk width in units of the first order column.
DEFAULT_WIDTH = None
SPLIT_CONF = "spark.eventloom.scan.split"
#: Grid of a split session: a chunk holds at most this many sequence numbers,
SEQ_WIDTH = 1_000_000
#: or rows of this much time.
TIME_WIDTH_US = 6 * 3600 * 1_000_000

_CK = "__chunk"


def _names(cols: str | Sequence[str]) -> list[str]:
    return [cols] if isinstance(cols, str) else list(cols)


def split_session(spark: SparkSession) -> bool:
    return spark.conf.get(SPLIT_CONF, "false").lower() == "true"


def running(
    df: DataFrame,
    by: str | Sequence[str],
    order: str | Sequence[str],
    *,
    last: Mapping[str, Column] | None = None,
    total: Mapping[str, Column] | None = None,
    width: int | None = DEFAULT_WIDTH,
) -> DataFrame:
    """Add running columns over the rows of each ``by`` group in ``order``
    (see the module's docstring for ``last``, ``total`` and ``width``). Lazy:
    building it starts no job."""
    by = _names(by)
    order = _names(order)
    last = dict(last or {})
    total = dict(total or {})
    if not last and not total:
        return df
    if width is None:
        width = _grid(df, order[0]) if split_session(df.sparkSession) else 0

    def values(partition: list[str], prefix: str = "") -> dict[str, Column]:
        w = Window.partitionBy(*partition).orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
        cols = {prefix + n: F.last(e, ignorenulls=True).over(w) for n, e in last.items()}
        return cols | {prefix + n: F.sum(F.coalesce(e, F.lit(0))).over(w) for n, e in total.items()}

    if not width:
        return df.withColumns(values(by))

    # Level 1: in-chunk running values. A NULL order value sorts first.
    cell = F.coalesce(F.floor(_numeric(df, order[0]) / F.lit(width)), F.lit(-(2**63)))
    d = df.withColumn(_CK, cell.cast("bigint"))
    local = d.withColumns(values([*by, _CK], "__l_"))

    # Level 2: one summary row per chunk, then carry-in from earlier chunks.
    position = F.struct(*[F.col(c) for c in order])
    aggs = [F.max_by(e, F.when(e.isNotNull(), position)).alias(n) for n, e in last.items()]
    aggs += [F.sum(F.coalesce(e, F.lit(0))).alias(n) for n, e in total.items()]
    keys = [f"__k{i}" for i in range(len(by))]
    summary = d.groupBy(*[F.col(b).alias(k) for b, k in zip(by, keys, strict=True)], F.col(_CK).alias("__c")).agg(*aggs)
    wc = Window.partitionBy(*keys).orderBy("__c").rowsBetween(Window.unboundedPreceding, -1)
    carry = summary.select(
        *keys, "__c",
        *[F.last(n, ignorenulls=True).over(wc).alias(f"__c_{n}") for n in last],
        *[F.sum(n).over(wc).alias(f"__c_{n}") for n in total],
    )
    same = reduce(lambda a, b: a & b, [F.col(b).eqNullSafe(F.col(k)) for b, k in zip(by, keys, strict=True)], F.col(_CK) == F.col("__c"))
    joined = local.join(carry, same, "left")
    final = {n: F.coalesce(F.col(f"__l_{n}"), F.col(f"__c_{n}")) for n in last}
    final |= {n: F.col(f"__l_{n}") + F.coalesce(F.col(f"__c_{n}"), F.lit(0)) for n in total}
    return joined.select(*[c for c in df.columns if c not in final], *[e.alias(n) for n, e in final.items()])


_STEP = ("__add", "__low", "__high")


def _after(step: np.ndarray, earlier: np.ndarray) -> np.ndarray:
    """Functions (rows ``add, low, high``) of first ``earlier``, then ``step``."""
    add, low, high = step
    return np.stack([earlier[0] + add, np.clip(earlier[1] + add, low, high), np.clip(earlier[2] + add, low, high)])


def _composed(step: np.ndarray, first: np.ndarray, carry: np.ndarray | None) -> np.ndarray:
    """At each row the functions of its segment so far, composed; ``first`` marks
    segment starts and ``carry`` is what came before the first row."""
    out, begun, reach = step.copy(), first.copy(), 1
    while reach < out.shape[1]:
        joined = np.where(begun[reach:], out[:, reach:], _after(out[:, reach:], out[:, :-reach]))
        out, begun = np.concatenate([out[:, :reach], joined], axis=1), np.concatenate([begun[:reach], begun[reach:] | begun[:-reach]])
        reach *= 2
    return out if carry is None else np.where(begun, out, _after(out, carry[:, None]))


def _prefixes(df: DataFrame, by: list[str], order: list[str]) -> DataFrame:
    """``df`` with its functions replaced by their composition along each key."""
    rows = df.withColumn("__first", F.row_number().over(Window.partitionBy(*by).orderBy(*order)) == 1)
    schema = StructType([f if f.name not in _STEP else StructField(f.name, LongType()) for f in df.schema.fields])
    names = df.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        carry = None
        for batch in batches:
            if not batch.num_rows:
                continue
            step = np.stack([batch.column(c).to_numpy(zero_copy_only=False) for c in _STEP])
            out = _composed(step, batch.column("__first").to_numpy(zero_copy_only=False), carry)
            carry = out[:, -1]
            new = dict(zip(_STEP, map(pa.array, out), strict=True))
            yield pa.RecordBatch.from_arrays([new[c] if c in new else batch.column(c) for c in names], names)

    return rows.mapInArrow(run, schema)


def clamped(
    df: DataFrame,
    by: str | Sequence[str],
    order: str | Sequence[str],
    name: str,
    *,
    add: Column,
    low: Column,
    high: Column,
    start: int = 0,
    width: int | None = DEFAULT_WIDTH,
) -> DataFrame:
    """Add ``name``: the value after the functions ``min(max(x + add, low),
    high)`` of all rows of the key up to this one, in ``order`` (which must be
    unique in a key), from ``start``. The functions are bigints without NULL, of
    size below 2^61, ``low <= high``. Keys and chunks as for :func:`running`;
    columns must be of types that Arrow knows."""
    by, order = _names(by), _names(order)
    d = df.withColumns(dict(zip(_STEP, (c.cast("bigint") for c in (add, low, high)), strict=True)))
    value = lambda x: F.least(F.greatest(x + F.col("__add"), F.col("__low")), F.col("__high"))
    if width is None:
        width = _grid(df, order[0]) if split_session(df.sparkSession) else 0
    if not width:
        return _prefixes(d, by, order).withColumn(name, value(F.lit(start))).drop(*_STEP)

    cell = F.coalesce(F.floor(_numeric(df, order[0]) / F.lit(width)), F.lit(-(2**63))).cast("bigint")
    local = _prefixes(d.withColumn(_CK, cell), [*by, _CK], order)
    keys = [f"__k{i}" for i in range(len(by))]
    last = local.groupBy(*[F.col(b).alias(k) for b, k in zip(by, keys, strict=True)], F.col(_CK).alias("__c")).agg(
        F.max_by(F.struct(*_STEP), F.struct(*order)).alias("s"))
    ends = _prefixes(last.select(*keys, "__c", *[F.col(f"s.{c}").alias(c) for c in _STEP]), keys, ["__c"]).withColumn("__x", value(F.lit(start)))
    carry = ends.select(*keys, "__c", F.lag("__x", 1, start).over(Window.partitionBy(*keys).orderBy("__c")).alias("__x"))
    same = reduce(lambda a, b: a & b, [F.col(b).eqNullSafe(F.col(k)) for b, k in zip(by, keys, strict=True)], F.col(_CK) == F.col("__c"))
    return local.join(carry, same, "left").withColumn(name, value(F.col("__x"))).select(*df.columns, name)


def _grid(df: DataFrame, col: str) -> int:
    kind = df.schema[col].dataType.typeName()
    if kind.startswith("timestamp"):
        return TIME_WIDTH_US
    return 1 if kind == "date" else SEQ_WIDTH


def _numeric(df: DataFrame, col: str) -> Column:
    kind = df.schema[col].dataType.typeName()
    if kind in ("timestamp", "timestamp_ntz"):
        return F.unix_micros(F.col(col).cast("timestamp"))
    if kind == "date":
        return F.unix_date(F.col(col)).cast("bigint")
    return F.col(col).cast("bigint")
