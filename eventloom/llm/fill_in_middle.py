"""Fill-in-the-middle texts by displacement scatter.

A text is cut into units, two of them drawn from a hash of its id, and the three
spans between them change places. The texts of a batch are one run of bytes: the
cuts say by how much each span moves, a difference array holds those moves at
the spans' first bytes, and its cumulative sum is the shift of every byte, so
one numpy scatter builds all outputs of the batch. The way back finds the marks
in the outputs, makes the same kind of shifts, and gathers.

Bytes are handled in tiles of ``TILE``, so a task holds a batch's texts, their
outputs and a few arrays of a tile's length, however long a text is.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType, StringType, LongType

from eventloom.llm.common import small_batches

PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
PLAIN_FROM = 90
SPM_BELOW = 20
TILE = 1 << 20

Marks = Callable[[int, int], np.ndarray]

_LETTER = np.zeros(256, bool)
_LETTER[[*range(65, 91), *range(97, 123)]] = True


def _bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of string ``texts`` in one run, and the place of each text
    (with the end of the last)."""
    _, offsets, data = texts.buffers()
    width = np.int64 if pa.types.is_large_string(texts.type) else np.int32
    at = np.frombuffer(offsets, width, len(texts) + 1, texts.offset * np.dtype(width).itemsize).astype(np.int64)
    run = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return run[at[0] : at[-1]], at - at[0]


def _texts(run: np.ndarray, at: np.ndarray) -> pa.Array:
    return pa.LargeStringArray.from_buffers(len(at) - 1, pa.py_buffer(at.astype(np.int64)), pa.py_buffer(run)).cast(pa.string())


def _tiles(size: int) -> Iterator[tuple[int, int]]:
    for a in range(0, size, TILE):
        yield a, min(a + TILE, size)


def _before(marks: Marks, size: int, places: np.ndarray) -> np.ndarray:
    """How many marks lie before each of the ``places``."""
    out, seen = np.zeros(len(places), np.int64), 0
    for a, b in _tiles(size):
        here = marks(a, b)
        inside = (places > a) & (places <= b)
        out[inside] = seen + np.searchsorted(here, places[inside])
        seen += len(here)
    return out


def _select(marks: Marks, size: int, ranks: np.ndarray) -> np.ndarray:
    """Place of the mark with each of the ``ranks`` (from 0), ``size`` past the last."""
    out, seen = np.full(len(ranks), size, np.int64), 0
    for a, b in _tiles(size):
        here = marks(a, b)
        inside = (ranks >= seen) & (ranks < seen + len(here))
        out[inside] = here[ranks[inside] - seen]
        seen += len(here)
    return out


def _shifted(starts: np.ndarray, targets: np.ndarray, size: int) -> Iterator[tuple[int, int, np.ndarray]]:
    """For each tile ``[a, b)`` of a run whose spans begin at ``starts``
    (ascending, empty spans allowed) and go to ``targets``: where its bytes go."""
    moves = np.diff(targets - starts, prepend=0)
    carry = 0
    for a, b in _tiles(size):
        low, high = np.searchsorted(starts, [a, b])
        change = np.zeros(b - a, np.int64)
        np.add.at(change, starts[low:high] - a, moves[low:high])
        change[0] += carry
        shift = np.cumsum(change)
        carry = shift[-1]
        yield a, b, shift + np.arange(a, b)


def _unit_marks(run: np.ndarray, at: np.ndarray) -> Marks:
    """First bytes of the units ``[A-Za-z]+|[^A-Za-z]`` over code points."""

    def marks(a: int, b: int) -> np.ndarray:
        piece = run[a:b]
        letter = _LETTER[piece]
        joined = letter & np.concatenate([[a > 0 and _LETTER[run[a - 1]]], letter[:-1]])
        first = ((piece & 0xC0) != 0x80) & ~joined
        firsts = at[np.searchsorted(at, a) : np.searchsorted(at, b)]
        first[firsts - a] = True
        return a + np.flatnonzero(first)

    return marks


def _char_marks(run: np.ndarray) -> Marks:
    return lambda a, b: a + np.flatnonzero((run[a:b] & 0xC0) != 0x80)


def _sentinel_marks(run: np.ndarray) -> Marks:
    def marks(a: int, b: int) -> np.ndarray:
        here = a + np.flatnonzero(run[a : min(b, len(run) - 2)] == ord("<"))
        return here[np.isin(run[here + 1], [ord(s[1]) for s in (PREFIX, SUFFIX, MIDDLE)]) & (run[here + 2] == ord(">"))]

    return marks


def _order(spm: np.ndarray) -> np.ndarray:
    """Places of prefix, middle and suffix in the output, of psm or spm."""
    return np.where(spm[:, None], [1, 2, 0], [0, 2, 1])


def _transform(run: np.ndarray, at: np.ndarray, h: np.ndarray, plain: np.ndarray, spm: np.ndarray):
    """Units, code points of prefix and middle, and the outputs' bytes and places."""
    size, rows = len(run), len(at) - 1
    units = _unit_marks(run, at)
    rank = _before(units, size, at)
    n = np.diff(rank)
    drawn = np.sort(h % (n + 1)[:, None], axis=1)
    drawn[plain] = n[plain, None]  # the whole text is the prefix
    cuts = _select(units, size, (rank[:-1, None] + drawn).ravel()).reshape(rows, 2)
    cuts = np.minimum(cuts, at[1:, None])
    starts = np.column_stack([at[:-1], cuts])
    lengths = np.diff(np.column_stack([starts, at[1:]]), axis=1)
    chars = np.diff(_before(_char_marks(run), size, starts.ravel()).reshape(rows, 3), axis=1)

    mark = np.where(plain, 0, len(PREFIX))
    out_at = np.concatenate([[0], np.cumsum(lengths.sum(axis=1) + 3 * mark)])
    order = _order(spm)
    by_place = np.take_along_axis(lengths, np.argsort(order, axis=1), axis=1) + mark[:, None]
    place_at = out_at[:-1, None] + np.cumsum(by_place, axis=1) - by_place
    begins = np.take_along_axis(place_at, order, axis=1)  # of the marks of prefix, middle and suffix

    out = np.empty(out_at[-1], np.uint8)
    for a, b, to in _shifted(starts.ravel(), (begins + mark[:, None]).ravel(), size):
        out[to] = run[a:b]
    for column, sentinel in enumerate((PREFIX, MIDDLE, SUFFIX)):
        out[begins[~plain, column, None] + np.arange(3)] = np.frombuffer(sentinel.encode(), np.uint8)
    return n, chars, out, out_at


def _inverse(run: np.ndarray, at: np.ndarray, plain: np.ndarray, spm: np.ndarray):
    """The texts' bytes and places from the bytes and places of outputs."""
    size, rows = len(run), len(at) - 1
    sentinels = _sentinel_marks(run)
    rank = _before(sentinels, size, at)[:-1]
    marks = _select(sentinels, size, (rank[:, None] + np.arange(3)).ravel()).reshape(rows, 3)
    marks[plain] = at[1:][plain, None]
    marks[plain, 0] = at[:-1][plain]
    mark = np.where(plain, 0, len(PREFIX))
    begins = marks + mark[:, None]  # in output order
    lengths = np.diff(np.column_stack([marks, at[1:]]), axis=1) - mark[:, None]
    order = _order(spm)
    begins, lengths = np.take_along_axis(begins, order, axis=1), np.take_along_axis(lengths, order, axis=1)
    ends = np.cumsum(lengths.ravel())
    text_at = np.concatenate([[0], ends[2::3]])
    out = np.empty(text_at[-1], np.uint8)
    for a, b, source in _shifted(ends - lengths.ravel(), begins.ravel(), len(out)):
        out[a:b] = run[source]
    return out, text_at


def fill_in_middle(docs: DataFrame) -> DataFrame:
    """``doc_id, n, form, prefix_chars, middle_chars, output`` of every row of
    ``docs(doc_id, text, ...)``.

    ``n`` counts the units ``[A-Za-z]+|[^A-Za-z]``; h1 to h4 are 32-bit numbers
    of the sha256 of ``1:`` and the doc_id. The cuts lie after ``h1 % (n + 1)``
    and ``h2 % (n + 1)`` units. ``form`` is ``plain`` (the text itself; null
    spans) for an empty text, one that holds a mark, or ``h3 % 100 >= 90``;
    else ``spm`` for ``h4 % 100 < 20``; else ``psm``.

    A null text is empty; a null doc_id is hashed as ''. Repeated rows give
    repeated results, other columns are not read, an empty table gives no rows,
    and a text may be as long as a row can be."""
    digest = F.sha2(F.concat(F.lit("1:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), 256)
    h = [F.conv(F.substring(digest, 8 * i + 1, 8), 16, 10).cast("bigint") for i in range(4)]
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    held = text.contains(PREFIX) | text.contains(SUFFIX) | text.contains(MIDDLE)
    plain = (text == "") | held | (h[2] % 100 >= PLAIN_FROM)
    form = F.when(plain, "plain").when(h[3] % 100 < SPM_BELOW, "spm").otherwise("psm")
    rows = docs.select("doc_id", text.alias("text"), h[0].alias("h1"), h[1].alias("h2"), form.alias("form"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            form = batch.column(4).to_numpy(zero_copy_only=False)
            h = np.column_stack([batch.column(i).to_numpy(zero_copy_only=False) for i in (2, 3)]).astype(np.int64)
            n, chars, out, at = _transform(*_bytes(batch.column(1)), h, form == "plain", form == "spm")
            spans = [pa.array(chars[:, i], mask=form == "plain") for i in (0, 1)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(n), batch.column(4), *spans, _texts(out, at)],
                ["doc_id", "n", "form", "prefix_chars", "middle_chars", "output"])

    schema = StructType([
        StructField("doc_id", docs.schema["doc_id"].dataType), StructField("n", LongType()), StructField("form", StringType()),
        StructField("prefix_chars", LongType()), StructField("middle_chars", LongType()), StructField("output", StringType())])
    return small_batches(rows).mapInArrow(run, schema)


def restore(outputs: DataFrame) -> DataFrame:
    """The columns of ``outputs(form, output, ...)`` and ``restored``: the exact
    text, rebuilt from the output and its form alone. Outputs are those of
    :func:`fill_in_middle`; an empty table gives no rows."""
    fields = [*outputs.schema.fields, StructField("restored", StringType())]
    names = [f.name for f in fields]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            form = batch.column("form").to_numpy(zero_copy_only=False)
            out, at = _inverse(*_bytes(batch.column("output")), form == "plain", form == "spm")
            yield pa.RecordBatch.from_arrays([*batch.columns, _texts(out, at)], names)

    return small_batches(outputs).mapInArrow(run, StructType(fields))


def digests(docs: DataFrame) -> DataFrame:
    """``doc_id, n, form, prefix_chars, middle_chars`` with the sha256 of each
    output and of the text restored from it."""
    sha = lambda name: F.sha2(F.col(name), 256)
    return restore(fill_in_middle(docs)).select(
        "doc_id", "n", "form", "prefix_chars", "middle_chars", sha("output").alias("output_sha256"), sha("restored").alias("restored_sha256"))


FILL_IN_MIDDLE_SQL = """
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS t, sha256('1:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS s FROM documents),
u AS (
  SELECT *, regexp_extract_all(t, '[A-Za-z]+|[^A-Za-z]') AS w, ('0x' || s[1:8])::BIGINT AS h1, ('0x' || s[9:16])::BIGINT AS h2,
    ('0x' || s[17:24])::BIGINT AS h3, ('0x' || s[25:32])::BIGINT AS h4 FROM d),
c AS (
  SELECT *, len(w) AS n, least(h1 % (len(w) + 1), h2 % (len(w) + 1)) AS lo, greatest(h1 % (len(w) + 1), h2 % (len(w) + 1)) AS hi,
    CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR h3 % 100 >= 90 THEN 'plain'
         WHEN h4 % 100 < 20 THEN 'spm' ELSE 'psm' END AS form FROM u),
p AS (SELECT *, array_to_string(w[1:lo], '') AS p, array_to_string(w[lo + 1:hi], '') AS m, array_to_string(w[hi + 1:n], '') AS x FROM c)
SELECT doc_id, CAST(n AS BIGINT) AS n, form,
  CASE WHEN form <> 'plain' THEN CAST(length(p) AS BIGINT) END AS prefix_chars,
  CASE WHEN form <> 'plain' THEN CAST(length(m) AS BIGINT) END AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || p || '<S>' || x || '<M>' || m
    ELSE '<S>' || x || '<P>' || p || '<M>' || m END) AS output_sha256,
  sha256(t) AS restored_sha256 FROM p
"""
