"""Language model scores from class-based n-grams.

Words are put into classes by the exchange algorithm on the bigrams of the
training texts: each unit moves to the class that raises the likelihood of the
class bigrams most. Units are the most frequent words and, for all other words,
groups tied by their last letters, so that every word has a class. The model is
``P(w | v) = a * P(class w | class v) * P(w | class w) + (1 - a) * P(w)`` with
additive smoothing throughout.

Counts are taken in Spark over all training tokens. The driver sees the units
(at most ``frequent`` words), their classes, the class bigram matrix and the
counts of the ``SHARED_COUNTS`` most frequent words, whose sizes are parameters.
Other words of a text meet their counts by chunk: a chunk of some MB of texts
asks for each of them once.

Tasks split and look up words as Arrow columns. The unit bigrams of a task are sums
in one table, sent as packed blocks of ``BLOCK`` units, and each round of the exchange
reads the summed blocks: their number and size go by the units, not by the input.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventloom.llm.common import fold, free_shuffles, keep, small_batches

FREQUENT = 4000
TIED = 500
CLASSES = 48
#: Words whose counts go to every task; the others are asked for by chunk.
SHARED_COUNTS = 100_000
ROUNDS = 6
MIX = 0.7
CHUNK_BYTES = 6_000_000
END_UNIT = 0


#: Units whose bigrams are one row, and tokens summed before a task's words are sent.
BLOCK = 32
COUNTED = 2_000_000
_BLOCKS = "side int, block long, cells binary, c binary"


def words_of(texts: pa.Array) -> tuple[np.ndarray, pa.Array]:
    """Number of words of each text, and the words of all: between ASCII white
    space, A-Z lowered, as UTF-8."""
    lists = pc.ascii_split_whitespace(pc.ascii_trim_whitespace(pc.ascii_lower(texts)))
    n, words = pc.list_value_length(lists).to_numpy(zero_copy_only=False).astype(np.int64), lists.flatten().cast(pa.binary())
    some = pc.not_equal(words, b"")  # a text without words is split into one empty word
    if not pc.all(some).as_py():
        ends = np.append(0, np.cumsum(some.to_numpy(zero_copy_only=False)))
        n, words = np.diff(ends[np.append(0, np.cumsum(n))]), words.filter(some)
    return n, words


def _places(words: pa.Array, among: pa.Array) -> np.ndarray:
    """Place of each word ``among`` others, or -1."""
    return pc.index_in(words, value_set=among).fill_null(-1).to_numpy(zero_copy_only=False)


def units_of(words: pa.Array, frequent: pa.Array, tied: int) -> np.ndarray:
    """Unit of each word: its own for a frequent word, else that of its ending."""
    units = _places(words, frequent).astype(np.int64) + 1
    rare = np.flatnonzero(units == 0)
    if len(rare):
        ends = pc.binary_slice(words.take(pa.array(rare)), -3).dictionary_encode()
        unit = np.array([len(frequent) + 1 + zlib.crc32(e) % tied for e in ends.dictionary.to_pylist()], np.int64)
        units[rare] = unit[ends.indices.to_numpy()]
    return units


def _word_counts(texts: DataFrame) -> DataFrame:
    """``word, c`` over all texts, summed within tasks first."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: list[pa.Array] = []

        def summed() -> pa.RecordBatch:
            found = pa.chunked_array(waiting, pa.binary()).value_counts()
            return pa.RecordBatch.from_arrays([found.field("values"), found.field("counts")], ["word", "c"])

        for batch in batches:
            waiting.append(words_of(batch.column(0))[1])
            if sum(map(len, waiting)) >= COUNTED:
                yield summed()
                waiting = []
        yield summed()

    return texts.select("text").mapInArrow(run, "word binary, c long").groupBy("word").agg(F.sum("c").alias("c"))


def _pack(numbers: np.ndarray) -> bytes:
    return pa.compress(numbers.tobytes(), codec="zstd", asbytes=True)


def _unpack(packed: bytes, kind: type) -> np.ndarray:
    size = int(np.dtype(kind).itemsize)
    with pa.input_stream(pa.BufferReader(packed), compression="zstd") as stream:
        data = stream.read()
    return np.frombuffer(data, kind, len(data) // size)


def _blocks(batches: Iterator[pa.RecordBatch], n_units: int) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """``side, block, cells, c`` of rows of packed blocks. A cell is ``(unit - block * BLOCK) * n_units + other``."""
    for batch in batches:
        for side, block, cells, c in zip(*(batch.column(i) for i in range(4)), strict=True):
            yield side.as_py(), block.as_py(), np.cumsum(_unpack(cells.as_buffer(), np.int32), dtype=np.int64), _unpack(c.as_buffer(), np.int64)


def _block_row(side: int, block: int, cells: np.ndarray, c: np.ndarray) -> pa.RecordBatch:
    packed = [_pack(np.diff(cells, prepend=0).astype(np.int32)), _pack(c.astype(np.int64))]
    return pa.RecordBatch.from_arrays([pa.array([side], pa.int32()), pa.array([block], pa.int64()), *(pa.array([x], pa.binary()) for x in packed)],
                                      ["side", "block", "cells", "c"])


def _unit_bigrams(texts: DataFrame, frequent: pa.Array, tied: int, n_units: int) -> DataFrame:
    """``side, block, cells, c``: how often the units of a block are followed by
    (side 0) and follow (side 1) each unit, packed; the end stands before the
    first word and after the last. A task's sums are one table, and so are
    the sums of the blocks of a task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, held = np.zeros(n_units * n_units, np.int32), 0

        def summed() -> Iterator[pa.RecordBatch]:
            for side, square in enumerate((table.reshape(n_units, n_units), table.reshape(n_units, n_units).T)):
                for block in range(-(-n_units // BLOCK)):
                    part = square[block * BLOCK : (block + 1) * BLOCK].ravel()
                    cells = part.nonzero()[0]
                    if len(cells):
                        yield _block_row(side, block, cells, part[cells])

        for batch in batches:
            n, words = words_of(batch.column(0))
            if held + len(words) + len(n) >= 2**31:
                yield from summed()
                table[:], held = 0, 0
            held += len(words) + len(n)
            units = np.full(len(words) + len(n) + 1, END_UNIT, np.int64)  # the end of a text stands before the next
            units[1 + np.arange(len(words)) + np.repeat(np.arange(len(n)), n)] = units_of(words, frequent, tied)
            np.add.at(table, units[:-1] * n_units + units[1:], np.int32(1))
        yield from summed()

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables: dict[tuple[int, int], np.ndarray] = {}
        for side, block, cells, c in _blocks(batches, n_units):
            table = tables.setdefault((side, block), np.zeros(BLOCK * n_units, np.int64))
            table[cells] += c  # a row's cells differ
        for (side, block), table in tables.items():
            cells = table.nonzero()[0]
            yield _block_row(side, block, cells, table[cells])

    width = max(12, int(texts.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    return texts.select("text").mapInArrow(run, _BLOCKS).repartition(width, "side", "block").mapInArrow(sums, _BLOCKS)


def _h(x: np.ndarray) -> np.ndarray:
    return x * np.log(np.maximum(x, 1e-300))


def best_moves(right: np.ndarray, left: np.ndarray, own: np.ndarray, at: np.ndarray, g: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each unit the best class other than 0 and the gain in log
    likelihood over staying. ``right[u, c]``, ``left[u, c]``: tokens of class c
    after and before the unit; ``own[u]``: unit after itself; ``at[u]``: its
    class; ``g``: class bigrams."""
    best, gain = at.copy(), np.zeros(len(at))
    for i, a in enumerate(at.tolist()):
        s, r, l = own[i], right[i].copy(), left[i].copy()
        rest = g.copy()
        rest[a] -= r
        rest[:, a] -= l
        rest[a, a] += s
        r[a] -= s
        l[a] -= s
        row, col = rest.sum(axis=1) + l, rest.sum(axis=0) + r  # the unit is in some class anyway
        diagonal = np.diag(rest)
        f = (_h(rest + r) - _h(rest)).sum(axis=1) + (_h(rest + l[:, None]) - _h(rest)).sum(axis=0)
        f += _h(diagonal + r + l + s) - _h(diagonal) - (_h(diagonal + r) - _h(diagonal)) - (_h(diagonal + l) - _h(diagonal))
        total_r, total_l = r.sum() + s, l.sum() + s
        f -= _h(row + total_r) - _h(row) + _h(col + total_l) - _h(col)
        f[0] = -np.inf  # the end's class is its own
        best[i] = int(f.argmax())
        gain[i] = f[best[i]] - f[a]
    return best, gain


def exchange_classes(bigrams: DataFrame, n_units: int, classes: int, rounds: int) -> tuple[np.ndarray, np.ndarray]:
    """Class of each unit and the class bigram matrix. A round sums the classes
    around each unit and moves the half of the units whose turn it is; a round
    that lowers the likelihood is undone and moves fewer the next time."""
    at = np.zeros(n_units, np.int64)
    at[1:] = 1 + np.arange(n_units - 1) % (classes - 1)

    def around(assigned: np.ndarray):
        """Tokens of each class after (before) the units of a block, and of the unit itself."""

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for side, block, cells, c in _blocks(batches, n_units):
                unit, other = cells // n_units, cells % n_units
                own = unit + block * BLOCK == other
                found = np.bincount(unit * (classes + 1) + assigned[other], c, BLOCK * (classes + 1)).reshape(BLOCK, classes + 1)
                found[unit[own], classes] = c[own]
                yield pa.RecordBatch.from_pydict({"side": pa.array([side], pa.int32()), "block": [block], "counts": [found.ravel()]})

        return run

    def counts_of(row: dict) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Units of a row of ``around``, the tokens of each class and those of the unit itself."""
        found = np.array(row["counts"], float).reshape(BLOCK, classes + 1)
        units = np.arange(row["block"] * BLOCK, min(n_units, (row["block"] + 1) * BLOCK))
        return units, found[: len(units), :classes], found[: len(units), classes]

    def moves(assigned: np.ndarray, g: np.ndarray, turn: int, share: int):
        def run(found: pa.Table) -> pa.Table:
            rows = {row["side"]: counts_of(row) for row in found.to_pylist()}
            none = np.zeros((BLOCK, classes))
            units = next(iter(rows.values()))[0]
            right, left = (rows[side][1] if side in rows else none[: len(units)] for side in (0, 1))
            own = rows[0][2] if 0 in rows else np.zeros(len(units))
            some = (units != END_UNIT) & ((units * 2654435761 >> 7) % share == turn % share) & ((right > 0).any(axis=1) | (left > 0).any(axis=1))
            best, gain = best_moves(right[some], left[some], own[some], assigned[units[some]], g)
            return pa.table({"unit": units[some], "to": best, "gain": gain})

        return run

    def matrix(cells: DataFrame, assigned: np.ndarray) -> np.ndarray:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            g = np.zeros((classes, classes))
            for batch in batches:
                for row in batch.to_pylist():
                    units, found, _ = counts_of(row)
                    np.add.at(g, assigned[units], found)
            yield pa.RecordBatch.from_pydict({"a": np.arange(classes).repeat(classes), "b": np.tile(np.arange(classes), classes), "c": g.ravel()})

        rows = cells.where("side = 0").mapInArrow(run, "a long, b long, c double").groupBy("a", "b").agg(F.sum("c").alias("c")).toPandas()
        g = np.zeros((classes, classes))
        g[rows["a"].to_numpy(int), rows["b"].to_numpy(int)] = rows["c"].to_numpy()
        return g

    def state(assigned: np.ndarray) -> tuple[DataFrame, np.ndarray, float]:
        cells = keep(bigrams.mapInArrow(around(assigned), "side int, block long, counts array<double>"), "cells")
        g = matrix(cells, assigned)
        return cells, g, float(_h(g).sum() - _h(g.sum(axis=0)).sum() - _h(g.sum(axis=1)).sum())

    cells, g, value = state(at)
    share = 2
    for turn in range(rounds):
        found = cells.groupBy("block").applyInArrow(moves(at, g, turn, share), "unit long, to long, gain double").where("gain > 0").toPandas()
        if found.empty:
            continue
        new = at.copy()
        new[found["unit"].to_numpy(int)] = found["to"].to_numpy()
        cells2, g2, value2 = state(new)
        if value2 > value:
            at, cells, g, value = new, cells2, g2, value2
        else:
            share *= 2
    return at, g


def score_texts(docs: DataFrame, frequent: int = FREQUENT, tied: int = TIED, classes: int = CLASSES, rounds: int = ROUNDS) -> DataFrame:
    """``doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score``
    for each row of ``docs(doc_id, text, ...)``; learned from the rows whose
    crc32 of the doc_id's text modulo 5 is not 1.

    ``score`` is the log10 probability of the text's words and its end under the
    class model, ``base_score`` under smoothed unigrams. A null or empty text is
    its end alone. Repeated rows count as often as they occur and each get their
    row; a null doc_id counts as the text ''. Without training rows every token
    is unknown. An empty table gives no rows."""
    rows = small_batches(docs).select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    held_out = fold(F.col("doc_id"), 5) == 1
    train = rows.where(~held_out)
    counts = keep(_word_counts(train), "counts")
    n_docs = train.count()
    total, distinct = counts.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count("*")).first()
    n, v = total + n_docs, distinct + (n_docs > 0)
    top = [(bytes(r.word), r.c) for r in _most_frequent(counts, max(frequent, SHARED_COUNTS)).collect()]
    known = pa.array([w for w, _ in top[:frequent]], pa.binary())
    shared = docs.sparkSession.sparkContext.broadcast((pa.array([w for w, _ in top], pa.binary()), np.array([c for _, c in top], np.int64)))
    n_units = len(known) + 1 + tied
    bigrams = keep(_unit_bigrams(train, known, tied, n_units), "bigrams")
    free_shuffles(docs)
    at, g = exchange_classes(bigrams, n_units, classes, rounds)
    free_shuffles(docs)

    def by_class(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens, types = np.zeros(classes), np.zeros(classes, np.int64)
        for batch in batches:
            cls = at[units_of(batch.column(0), known, tied)]
            tokens += np.bincount(cls, batch.column(1).to_numpy(), classes)
            types += np.bincount(cls, minlength=classes)
        yield pa.RecordBatch.from_pydict({"class": np.arange(classes), "tokens": tokens.astype(np.int64), "types": types})

    sums = counts.select("word", "c").mapInArrow(by_class, "class long, tokens long, types long").groupBy("class").agg(
        F.sum("tokens").alias("tokens"), F.sum("types").alias("types")).toPandas()
    tokens, types = np.zeros(classes), np.zeros(classes)
    tokens[sums["class"].to_numpy(int)], types[sums["class"].to_numpy(int)] = sums["tokens"], sums["types"]
    tokens[0], types[0] = n_docs, 1
    follow = (g + 0.1) / (g.sum(axis=1, keepdims=True) + 0.1 * classes)
    rest = 0.5 * (types + 1)

    size = rows.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    chunks = max(1, -(-size // CHUNK_BYTES))
    width = min(chunks, max(12, int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))))
    dealt = rows.withColumn("chunk", F.pmod(F.xxhash64("doc_id", "text"), F.lit(chunks))).repartition(width, "chunk")

    def asked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        top_words, waiting = shared.value[0], []
        for batch in batches:
            n, words = words_of(batch.column(1))
            rare = np.flatnonzero(_places(words, top_words) < 0)
            chunk = np.repeat(batch.column(2).to_numpy(), n)[rare]
            waiting.append(pa.table({"chunk": pa.array(chunk, pa.int64()), "word": words.take(pa.array(rare))}))
            if sum(map(len, waiting)) >= COUNTED:
                yield from _distinct(waiting)
                waiting = []
        if waiting:
            yield from _distinct(waiting)

    # A chunk lies in one task, so its requests hardly repeat; that does no harm.
    answers = dealt.mapInArrow(asked, "chunk long, word binary").join(counts, "word")

    def score(texts: pa.Table, found: pa.Table) -> pa.Table:
        (top_words, top_counts), flat = shared.value, texts.column("text").combine_chunks()
        lengths, words = words_of(flat if isinstance(flat, pa.Array) else pa.concat_arrays(flat.chunks))
        coded = words.dictionary_encode()
        distinct = coded.dictionary
        place = _places(distinct, top_words)
        c = np.zeros(len(distinct) + 1)  # number 0 is the end
        c[0] = n_docs
        c[1:][place >= 0] = top_counts[place[place >= 0]]
        rare = np.flatnonzero(place < 0)
        if len(rare) and len(found):
            at_answer = _places(distinct.take(pa.array(rare)), found.column("word"))
            c[1 + rare[at_answer >= 0]] = found.column("c").to_numpy()[at_answer[at_answer >= 0]]
        cls = np.append(0, at[units_of(distinct, known, tied)])
        base = (c + 0.5) / (n + 0.5 * (v + 1))
        emit = (c + 0.5) / (tokens[cls] + rest[cls])
        ids = np.zeros(len(words) + len(lengths), np.int64)
        ids[np.arange(len(words)) + np.repeat(np.arange(len(lengths)), lengths)] = coded.indices.to_numpy() + 1
        k = cls[ids]
        p = MIX * follow[np.append(0, k[:-1]), k] * emit[ids] + (1 - MIX) * base[ids]
        log_base, log_p, is_known = np.log10(base)[ids], np.log10(p), c[ids] > 0
        ends = np.cumsum(lengths + 1)
        spans = [slice(a, b) for a, b in zip((ends - lengths - 1).tolist(), ends.tolist(), strict=True)]
        return pa.table({
            "doc_id": texts.column("doc_id"), "n_tokens": lengths + 1, "n_known": pa.array([int(is_known[x].sum()) for x in spans], pa.int64()),
            "base_score": pa.array([float(log_base[x].sum()) for x in spans], pa.float64()),
            "score": pa.array([float(log_p[x].sum()) for x in spans], pa.float64())})

    scored = dealt.groupBy("chunk").cogroup(answers.groupBy("chunk")).applyInArrow(
        score, "doc_id long, n_tokens long, n_known long, base_score double, score double")
    return scored.select("doc_id", held_out.alias("held_out"), "n_tokens", "n_known", F.lit(n).cast("long").alias("train_tokens"),
                         "base_score", "score")


def _most_frequent(counts: DataFrame, n: int) -> DataFrame:
    """The ``n`` largest counts, ties by word. A histogram of the counts' sizes
    comes first, so that tasks send about ``n`` rows together, not each."""
    size = F.floor(F.log2(F.col("c")) * 8)
    least, seen = 0, 0
    for r in sorted(counts.groupBy(size.alias("size")).agg(F.count("*").alias("words")).collect(), reverse=True):
        least, seen = r["size"], seen + r["words"]
        if seen >= n:
            break
    return counts.where(size >= least).orderBy(F.desc("c"), "word").limit(n)


def _distinct(tables: list[pa.Table]) -> Iterator[pa.RecordBatch]:
    return iter(pa.concat_tables(tables).group_by(["chunk", "word"], use_threads=False).aggregate([]).combine_chunks().to_batches())
