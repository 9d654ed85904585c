"""Token ids in files of static rANS blocks.

One frequency table, counted over the whole corpus and scaled to ``2**SCALE``,
is shared by all blocks. A block holds whole documents; its ids are dealt over
``LANES`` interleaved coders, which advance together (one step codes ``LANES``
ids), and it decodes without any other block. Every ``CHECK_STEPS`` steps a
checkpoint keeps the coders' states and the place in the words, so a block can
also be decoded from there. Readers decode all stretches between a block's checkpoints
at once, one step of every stretch at a time. A checksum covers ids and words.

Files are Parquet with one row per block, in ascending doc_id order over the
files and within each; the table of frequencies lies beside them.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventloom.llm.common import keep, small_batches, table_path
from eventloom.llm.tokens import END, encoder

SCALE = 20
LOW = 1 << 31  # states lie in [LOW, 2**63)
LANES = 2048
CHECK_STEPS = 128
BLOCK_TOKENS = 1 << 19
FILE_TOKENS = 1 << 24

BLOCK = ("block_start long, n_tokens long, doc_ids array<long>, doc_tokens array<long>, states binary, words binary, "
         "check_states binary, check_words array<long>, checksum long")
_BLOCK_NAMES = [x.split()[0] for x in BLOCK.split(", ")]
_BLOCK_TYPES = [pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.binary(), pa.binary(), pa.binary(),
                pa.list_(pa.int64()), pa.int64()]


def scaled_frequencies(counts: np.ndarray) -> np.ndarray:
    """Counts scaled to sum to ``2**SCALE``; every id that occurs keeps at
    least 1."""
    total = counts.sum()
    if not total:
        return np.zeros(len(counts), np.uint64)
    freq = np.where(counts > 0, np.maximum(1, counts.astype(float) * (1 << SCALE) / total), 0).astype(np.int64)
    over = int(freq.sum()) - (1 << SCALE)
    order = np.argsort(-freq, kind="stable")
    while over:
        for i in order:  # the largest give or take
            take = min(over, int(freq[i]) - 1) if over > 0 else over
            take = max(-(1 << SCALE), min(take, max(1, int(freq[i]) // 2))) if over > 0 else take
            freq[i] -= take
            over -= take
            if not over:
                break
    return freq.astype(np.uint64)


class Coder:
    """Encoder and decoder of blocks for one frequency table."""

    def __init__(self, freq: np.ndarray):
        self.freq = freq.astype(np.uint64)
        self.cum = np.concatenate([[0], np.cumsum(self.freq)]).astype(np.uint64)
        self._slots: np.ndarray | None = None

    def encode(self, ids: np.ndarray) -> tuple[bytes, bytes, bytes, list[int]]:
        """``(states, words, check states, check words)``; the k-th checkpoint
        is the decoder's before step ``k * CHECK_STEPS``, k from 1."""
        steps = -(-len(ids) // LANES)
        x = np.full(LANES, LOW, np.uint64)
        words: list[np.ndarray] = []
        checks: list[tuple[np.ndarray, int]] = []
        written = 0
        shift, scale = np.uint64(32), np.uint64(SCALE)
        top = np.uint64((LOW >> SCALE) << 32)
        for t in range(steps - 1, -1, -1):
            part = ids[t * LANES : (t + 1) * LANES]
            n = len(part)
            f, c, lane = self.freq[part], self.cum[part], x[:n]
            full = lane >= top * f
            if full.any():
                out = lane[full]
                words.append((out & np.uint64(0xFFFFFFFF)).astype("<u4"))
                written += len(out)
                lane = np.where(full, lane >> shift, lane)
            q = lane // f
            x[:n] = (q << scale) + (lane - q * f) + c
            if t and t % CHECK_STEPS == 0:
                checks.append((x.copy(), written))
        checks.reverse()
        return (x.astype("<u8").tobytes(), b"".join(w.tobytes() for w in reversed(words)),
                b"".join(s.astype("<u8").tobytes() for s, _ in checks), [written - w for _, w in checks])

    def _slot_ids(self) -> np.ndarray:
        if self._slots is None:
            self._slots = np.repeat(np.arange(len(self.freq), dtype=np.uint32), self.freq.astype(np.int64))
        return self._slots

    def decode_stretches(self, n: int, states: bytes, words: bytes, check_states: bytes, check_words: list[int]) -> np.ndarray:
        """All ``n`` ids of a block, its stretches side by side: stretch k starts
        from checkpoint k (the first from the block's states) and reads the words
        from that checkpoint's place on."""
        slots, steps = self._slot_ids(), -(-n // LANES)
        stretches = len(check_words) + 1
        x = np.concatenate([np.frombuffer(states, "<u8"), np.frombuffer(check_states, "<u8")]).astype(np.uint64)
        w = np.frombuffer(words, "<u4").astype(np.uint64)
        at = np.array([0, *check_words], np.int64)
        whole, edges = LANES * (stretches - 1), LANES * np.arange(stretches + 1)
        rest = n - whole * CHECK_STEPS  # ids of the last stretch
        out = np.empty(n, np.uint32)
        full = out[: whole * CHECK_STEPS].reshape(stretches - 1, CHECK_STEPS, LANES)
        tail = out[whole * CHECK_STEPS :]
        mask, scale, shift, low = np.uint64((1 << SCALE) - 1), np.uint64(SCALE), np.uint64(32), np.uint64(LOW)
        for t in range(min(steps, CHECK_STEPS)):
            more = max(0, min(LANES, rest - t * LANES))  # lanes of the last stretch that go on
            lane = x[: whole + more]
            slot = lane & mask
            ids = slots[slot]
            lane = self.freq[ids] * (lane >> scale) + slot - self.cum[ids]
            need = (lane < low).nonzero()[0]
            if len(need):
                starts = np.searchsorted(need, edges)
                taken = np.diff(starts)
                lane[need] = (lane[need] << shift) | w[np.arange(len(need)) + np.repeat(at - starts[:-1], taken)]
                at += taken
            x[: whole + more] = lane
            full[:, t] = ids[:whole].reshape(-1, LANES)
            tail[t * LANES : t * LANES + more] = ids[whole:]
        return out

    def decode(self, n: int, states: bytes, words: bytes, first: int = 0, last: int | None = None) -> np.ndarray:
        """Ids of the steps ``first`` to ``last`` of a block of ``n`` ids; for
        ``first`` over 0, ``states`` and ``words`` are those of its checkpoint."""
        slots = self._slot_ids()
        x = np.frombuffer(states, "<u8").astype(np.uint64)
        w, at = np.frombuffer(words, "<u4").astype(np.uint64), 0
        steps = -(-n // LANES)
        last = steps if last is None else min(last, steps)
        out = np.empty(max(0, min(n, last * LANES) - first * LANES), np.uint32)
        mask, scale, shift, low = np.uint64((1 << SCALE) - 1), np.uint64(SCALE), np.uint64(32), np.uint64(LOW)
        for t in range(first, last):
            lanes = min(LANES, n - t * LANES)
            lane = x[:lanes]
            slot = lane & mask
            ids = slots[slot]
            lane = self.freq[ids] * (lane >> scale) + slot - self.cum[ids]
            need = (lane < low).nonzero()[0]
            if len(need):
                lane[need] = (lane[need] << shift) | w[at : at + len(need)]
                at += len(need)
            x[:lanes] = lane
            out[(t - first) * LANES : (t - first) * LANES + lanes] = ids
        return out


def _tokenized(docs: DataFrame, tokenizer: str) -> DataFrame:
    """``doc_id, at, n, ids, part``, in doc_id order over the partitions; ``at``:
    ids before the document in its partition."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, before = encoder(tokenizer), 0
        for big in batches:
            for batch in (big.slice(at, 128) for at in range(0, big.num_rows, 128)):
                raw = [r + END for r in enc.encode([x or "" for x in batch.column(1).to_pylist()])]
                n = np.array([len(r) // 4 for r in raw], np.int64)
                ends = before + np.cumsum(n)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), pa.array(ends - n), pa.array(n), pa.array([_narrow(r) for r in raw], pa.binary())],
                    ["doc_id", "at", "n", "ids"])
                before = int(ends[-1]) if len(ends) else before

    rows = small_batches(docs).select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    width = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ordered = rows.repartitionByRange(width, F.col("doc_id").asc_nulls_first()).sortWithinPartitions(
        F.col("doc_id").asc_nulls_first(), "text")
    return ordered.mapInArrow(run, "doc_id long, at long, n long, ids binary").withColumn("part", F.spark_partition_id())


def _narrow(raw: bytes) -> bytes:
    """Ids below 65,536 with two bytes each, marked by a leading 2, else 4."""
    ids = np.frombuffer(raw, "<u4")
    return b"\x02" + ids.astype("<u2").tobytes() if ids.max(initial=0) < 65536 else b"\x04" + raw


def _ids(packed: bytes) -> np.ndarray:
    return np.frombuffer(packed, "<u2" if packed[0] == 2 else "<u4", offset=1).astype(np.uint32)


def _counts(tokens: DataFrame) -> np.ndarray:
    """Occurrences of each id over the corpus; as long as the largest id."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(0, np.int64)
        for batch in batches:
            if batch.num_rows:
                c = np.bincount(np.concatenate([_ids(x) for x in batch.column(0).to_pylist()]), minlength=len(total))
                c[: len(total)] += total
                total = c
        seen = total.nonzero()[0]
        yield pa.RecordBatch.from_arrays([pa.array(seen), pa.array(total[seen])], ["id", "c"])

    rows = tokens.select("ids").mapInArrow(run, "id long, c long").groupBy("id").agg(F.sum("c").alias("c")).toPandas()
    out = np.zeros(int(rows["id"].max()) + 1 if len(rows) else 1, np.int64)
    out[rows["id"].to_numpy(np.int64)] = rows["c"].to_numpy(np.int64)
    return out


def write_tokens(docs: DataFrame, path: str, tokenizer: str = "byte_bpe_50k.json") -> None:
    """Tokenize every row of ``docs(doc_id, text, ...)`` (null text: empty),
    append id 0 and write blocks to ``path/blocks`` and the frequencies to
    ``path/frequencies``. Rows go by doc_id, nulls first, equal ones by text;
    repeated rows are written as often as they occur. An empty table makes
    files without blocks. The frequency table has a row per id of the
    vocabulary that occurs, which bounds what the driver sees."""
    spark = docs.sparkSession
    tokens = keep(_tokenized(docs, tokenizer), "tokens")
    freq = scaled_frequencies(_counts(tokens))
    spark.createDataFrame(pd.DataFrame({"id": np.arange(len(freq)), "freq": freq.astype(np.int64)})).coalesce(1).write.parquet(f"{path}/frequencies")
    sizes = tokens.groupBy("part").agg(F.sum("n").alias("n")).orderBy("part").toPandas()  # a row per partition
    starts = dict(zip(sizes["part"].tolist(), (sizes["n"].cumsum() - sizes["n"]).tolist(), strict=True))

    total = int(sizes["n"].sum())

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = Coder(freq)
        names: list = []
        ids: list[np.ndarray] = []
        start = end = 0

        def block() -> pa.RecordBatch:
            all_ids = np.concatenate(ids)
            states, words, check_states, check_words = coder.encode(all_ids)
            row = (start, len(all_ids), names, [len(x) for x in ids], states, words, check_states, check_words,
                   zlib.crc32(words, zlib.crc32(all_ids.astype("<u4").tobytes())))
            return pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(row, _BLOCK_TYPES, strict=True)], _BLOCK_NAMES)

        for batch in batches:
            for doc_id, part, at, packed in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                place = starts[part] + at
                if ids and (place != end or end - start >= BLOCK_TOKENS):
                    yield block()
                    names, ids = [], []
                if not ids:
                    start = end = place
                names.append(doc_id)
                ids.append(_ids(packed))
                end += len(ids[-1])
        if ids:
            yield block()

    files = max(1, -(-total // FILE_TOKENS))
    (tokens.select("doc_id", "part", "at", "ids").mapInArrow(blocks, BLOCK)
     .repartitionById(files, F.floor(F.col("block_start") / FILE_TOKENS).cast("int")).sortWithinPartitions("block_start")
     .write.parquet(f"{path}/blocks"))


def read_tokens(spark, path: str) -> DataFrame:
    """``doc_id, start, n_tokens, ids`` (array of int) of each document of the
    files; a block whose checksum differs raises ValueError."""
    return _decoded(spark, path, lambda ids: ids.astype(np.int32), "array<int>", "ids")


def token_index(spark, path: str) -> DataFrame:
    """``doc_id, start, n_tokens, ids_crc32`` of each document of the files."""
    return _decoded(spark, path, lambda ids: zlib.crc32(ids.astype("<u4").tobytes()), "long", "ids_crc32")


def _decoded(spark, path: str, of, kind: str, name: str) -> DataFrame:
    table = spark.read.parquet(f"{path}/frequencies").toPandas().sort_values("id")
    freq = table["freq"].to_numpy(np.uint64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = Coder(freq)
        for batch in batches:
            for b in batch.to_pylist():
                ids = coder.decode_stretches(b["n_tokens"], b["states"], b["words"], b["check_states"], b["check_words"])
                if zlib.crc32(b["words"], zlib.crc32(ids.astype("<u4").tobytes())) != b["checksum"]:
                    raise ValueError(f"block at {b['block_start']}: checksum differs")
                ends = np.cumsum(b["doc_tokens"])
                parts = np.split(ids, ends[:-1])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(b["doc_ids"], pa.int64()), pa.array(b["block_start"] + ends - b["doc_tokens"], pa.int64()),
                     pa.array(b["doc_tokens"], pa.int64()), pa.array([of(p) for p in parts], pa.list_(pa.int32()) if kind != "long" else pa.int64())],
                    ["doc_id", "start", "n_tokens", name])

    return spark.read.schema(BLOCK).parquet(f"{path}/blocks").select(
        "block_start", "n_tokens", "doc_ids", "doc_tokens", "states", "words", "check_states", "check_words", "checksum").mapInArrow(
        run, f"doc_id long, start long, n_tokens long, {name} {kind}")


def round_trip(docs: DataFrame, tokenizer: str = "byte_bpe_50k.json") -> DataFrame:
    """Write ``docs`` to files in the shared folder and index what they hold."""
    path = table_path(docs.sparkSession, "token-files")
    write_tokens(docs, path, tokenizer)
    return token_index(docs.sparkSession, path)
