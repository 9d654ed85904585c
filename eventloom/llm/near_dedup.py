"""MinHash near-duplicate detection with tensored banding.

Two small collections of ``half_tables`` half keys (``half_rows`` minhashes
each) are computed per text. A table key is a pair (one half key of each
collection), so ``2 * half_tables * half_rows`` minhashes serve
``half_tables ** 2`` tables. A pair of similarity s meets in some table with
probability ``(1 - (1 - s**r)**m) ** 2`` (r rows, m half tables): above
0.999999 at s = 0.85 for the defaults. Links are confirmed on the full sets.

Equal shingle sets are one class and travel once. Only half keys that two or
more classes share are combined, so a text without a similar partner sends
nothing beyond its half keys. A large bucket is never expanded into pairs:

1. each class is confirmed against the pivots of its buckets (the smallest and
   the most frequent one) and the links give first components;
2. buckets that still hold several components are settled exactly. Two sets
   with similarity of at least t share one of their ``floor((1 - t) * n) + 1``
   rarest shingles, whatever the order, so the members of those buckets meet by
   these prefix shingles: some rounds against one pivot per shingle, then all
   pairs of different components that still share one early enough in the
   order for the needed overlap, and whose parity bitmaps do not already prove
   too many differing shingles.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventloom.llm.common import keep, small_batches, text_hash
from eventloom.llm.components import relabel

SHINGLE_WORDS = 5
HALF_ROWS = 4
HALF_TABLES = 20
BITMAP_WORDS = 8
_WORD_CACHE = 150_000


class _WordHash(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) >= _WORD_CACHE:
            self.clear()
        h = self[word] = xxhash.xxh3_64_intdigest(word)
        return h


_word_hash = _WordHash()


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingle_set(text: str | None, k: int = SHINGLE_WORDS) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the ``k``-word shingles of a text
    (A-Z lowered, words between ASCII white space); a text of fewer words has
    its whole sequence as the only shingle, a text without words none."""
    words = text.encode("utf-8", "surrogatepass").lower().split() if text else []
    if not words:
        return np.empty(0, np.uint64)
    h = np.fromiter(map(_word_hash.__getitem__, words), np.uint64, len(words))
    width = min(k, len(h))
    out = np.full(len(h) - width + 1, np.uint64(width))
    for i in range(width):
        out = _mix(out * np.uint64(0x9E3779B97F4A7C15) + h[i : len(h) - width + 1 + i])
    return np.unique(out)


def parity_bitmap(values: np.ndarray) -> np.ndarray:
    """Each shingle flips one bit: two bitmaps differ in at most as many bits
    as the sets differ in shingles."""
    odd = np.bincount((values >> np.uint64(40)).astype(np.int64) % (64 * BITMAP_WORDS), minlength=64 * BITMAP_WORDS) % 2
    return np.packbits(odd.astype(np.uint8), bitorder="little").view("<i8")


def _coefficients(n: int) -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(20240601)
    a = rng.integers(0, 2**63, n, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    return a, rng.integers(0, 2**63, n, dtype=np.uint64)


def half_keys(values: np.ndarray, rows: int, tables: int) -> np.ndarray:
    """``2 * tables`` half keys: the first ``tables`` are of collection A."""
    a, b = _coefficients(2 * tables * rows)
    low = np.full(len(a), np.uint64(2**64 - 1))
    for at in range(0, len(values), 2048):
        part = values[at : at + 2048]
        np.minimum(low, (a[:, None] * part[None, :] + b[:, None]).min(axis=1), out=low)
    out = np.arange(2 * tables, dtype=np.uint64)
    for r in range(rows):
        out = _mix(out * np.uint64(0x9E3779B97F4A7C15) + low.reshape(2 * tables, rows)[:, r])
    return out.view(np.int64)


def _signatures(batches: Iterator[pa.RecordBatch], k: int, rows: int, tables: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids, his, los, ns, keys = [], [], [], [], []
        for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            s = shingle_set(text, k)
            digest = xxhash.xxh3_128_digest(s.tobytes())
            ids.append(doc_id)
            his.append(int.from_bytes(digest[:8], "little", signed=True))
            los.append(int.from_bytes(digest[8:], "little", signed=True))
            ns.append(len(s))
            keys.append(half_keys(s, rows, tables).tolist() if len(s) else None)
        yield pa.RecordBatch.from_arrays(
            [pa.array(ids, pa.int64()), pa.array(his, pa.int64()), pa.array(los, pa.int64()),
             pa.array(ns, pa.int64()), pa.array(keys, pa.list_(pa.int64())), *batch.columns[2:]],
            ["doc_id", "hi", "lo", "n_shingles", "half_keys", *batch.schema.names[2:]])


def _rows(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))


def _sets(docs: DataFrame, classes: DataFrame, nodes: DataFrame) -> DataFrame:
    """``(node, shingles, bits)`` of the given nodes, recomputed from the text of
    each class's first document (sets of all texts would be larger than the
    texts themselves)."""
    wanted = classes.join(nodes, "node").select("node", "hi", "lo", F.col("doc_id").alias("id"))
    texts = _rows(docs).join(wanted.select("id").distinct(), F.col("doc_id").eqNullSafe(F.col("id"))).select("text")

    def recompute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = [shingle_set(x) for x in batch.column(0).to_pylist()]
            digests = [xxhash.xxh3_128_digest(x.tobytes()) for x in sets]
            yield pa.RecordBatch.from_arrays(
                [pa.array([int.from_bytes(d[:8], "little", signed=True) for d in digests], pa.int64()),
                 pa.array([int.from_bytes(d[8:], "little", signed=True) for d in digests], pa.int64()),
                 pa.array([x.view(np.int64) for x in sets], pa.list_(pa.int64())),
                 pa.array([parity_bitmap(x) for x in sets], pa.list_(pa.int64()))],
                ["hi", "lo", "shingles", "bits"])

    found = texts.mapInArrow(recompute, "hi long, lo long, shingles array<long>, bits array<long>")
    return (found.join(wanted.select("node", "hi", "lo"), ["hi", "lo"])
            .groupBy("node").agg(F.first("shingles").alias("shingles"), F.first("bits").alias("bits")))


def _confirm(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs ``(a, b)`` with ``100 * intersection >= percent * union``."""

    def check(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            good = []
            for x, y in zip(f["x"], f["y"], strict=True):
                common = len(np.intersect1d(x, y, assume_unique=True))
                good.append(100 * common >= percent * (len(x) + len(y) - common))
            yield f.loc[good, ["a", "b"]]

    side = lambda end, name: sets.select(F.col("node").alias(end), F.col("shingles").alias(name))
    return (pairs.join(side("a", "x"), "a").join(side("b", "y"), "b").select("a", "b", "x", "y")
            .mapInPandas(check, "a long, b long"))


def _prefixes(sets: DataFrame, percent: int) -> DataFrame:
    """``(node, n, at, shingle, before, bits)``: of the rarest shingles of each
    set, among the given sets, those that some other set has too; ``at``: place in
    that order; ``before``: those of them at earlier places."""
    one = sets.select("node", F.size("shingles").alias("n"), F.explode("shingles").alias("shingle"))
    freq = one.groupBy("shingle").agg(F.count("*").alias("freq"))
    ordered = (one.join(freq, "shingle").groupBy("node", "n")
               .agg(F.sort_array(F.collect_list(F.struct("freq", "shingle"))).alias("s")))
    width = F.floor(F.col("n") * (100 - percent) / 100).cast("int") + 1
    earlier = F.transform(F.filter(F.slice("p", F.lit(1), F.col("at")), lambda x: x["freq"] > 1), lambda x: x["shingle"])
    return (ordered.select("node", "n", F.slice("s", F.lit(1), width).alias("p"))
            .select("node", "n", "p", F.posexplode("p").alias("at", "s")).where("s.freq > 1")
            .select("node", "n", "at", F.col("s.shingle").alias("shingle"), earlier.alias("before"))
            .join(sets.select("node", "bits"), "node"))


def near_duplicates(
    docs: DataFrame, percent: int = 85, half_rows: int = HALF_ROWS, half_tables: int = HALF_TABLES,
    pivot_rounds: int = 2, hashed: bool = False,
) -> DataFrame:
    """One row per row of ``docs(doc_id, text, ...)``: ``doc_id, n_shingles,
    class_id, component_id, kept``.

    Documents are linked when ``100 * |intersection| >= percent * |union|`` of
    their shingle sets; ``component_id`` is the smallest doc_id reachable and
    ``kept`` says that the row's doc_id is it. ``class_id`` numbers the distinct
    shingle sets. A null or empty text has no shingles and is linked with
    nothing (class_id null). Repeated rows and equal texts are one class and so
    linked. Rows with a null doc_id take part; where a whole component has none,
    component_id is null and the row is kept. Other columns of ``docs`` are
    not used. An empty table gives no rows. ``hashed`` adds the row's
    ``text_hash`` and ``comp``, a number of its component (null without
    shingles) that components without ids have too.
    """
    rows = _rows(docs).select("doc_id", "text", text_hash()) if hashed else _rows(docs)
    sig = keep(small_batches(rows).mapInArrow(
        lambda batches: _signatures(batches, SHINGLE_WORDS, half_rows, half_tables),
        "doc_id long, hi long, lo long, n_shingles long, half_keys array<long>" + ", text_hash long" * hashed), "signatures")
    classes = keep(sig.where("n_shingles > 0").groupBy("hi", "lo")
                   .agg(F.first("half_keys").alias("half_keys"), F.min("doc_id").alias("doc_id"))
                   .withColumn("node", F.monotonically_increasing_id()), "classes")

    half = classes.select("node", F.posexplode("half_keys").alias("at", "key"))
    shared = half.join(half.groupBy("at", "key").agg(F.count("*").alias("c")).where("c > 1").select("at", "key"),
                       ["at", "key"], "left_semi")
    both = (shared.groupBy("node").agg(
        F.collect_list(F.when(F.col("at") < half_tables, F.col("key"))).alias("a"),
        F.collect_list(F.when(F.col("at") >= half_tables, F.col("key"))).alias("b")))
    tables = keep(both.select("node", "b", F.explode("a").alias("a"))
                  .select("node", F.explode(F.transform("b", lambda b: F.xxhash64("a", b))).alias("key")), "tables")

    pivots = tables.groupBy("key").agg(F.min("node").alias("pivot"), F.max("node").alias("last")).where("pivot < last")
    met = (tables.join(pivots.select("key", "pivot"), "key").where("node <> pivot")
           .groupBy("node", "pivot").agg(F.count("*").alias("c")))
    first = met.groupBy("node").agg(F.array_distinct(F.array(F.min("pivot"), F.max_by("pivot", "c"))).alias("p"))
    pairs = keep(first.select(F.col("node").alias("a"), F.explode("p").alias("b")), "pairs")
    nodes = keep(tables.join(pivots.select("key"), "key", "left_semi").select("node").distinct(), "nodes")
    sets = keep(_sets(docs, classes, nodes), "sets")
    labels = relabel(nodes.select("node", F.col("node").alias("comp")), _confirm(pairs, sets, percent))

    open_keys = (tables.join(labels, "node").groupBy("key")
                 .agg(F.min("comp").alias("low"), F.max("comp").alias("high")).where("low < high").select("key"))
    unsettled = tables.join(open_keys, "key", "left_semi").select("node").distinct()
    prefixes = keep(_prefixes(sets.join(unsettled, "node", "left_semi"), percent), "prefixes")
    tested = pairs
    # Sizes, and what can still be common if this shingle is the first common one.
    alike = (100 * F.least("n", "m") >= percent * F.greatest("n", "m")) & (
        (100 + percent) * F.least(F.col("n") - F.col("at"), F.col("m") - F.col("at2")) >= percent * (F.col("n") + F.col("m"))) & (
        (100 + percent) * sum(F.bit_count(F.col("bits")[i].bitwiseXOR(F.col("bits2")[i])) for i in range(BITMAP_WORDS))
        <= (100 - percent) * (F.col("n") + F.col("m")))
    for turn in range(pivot_rounds + 1):
        now = prefixes.join(labels, "node")
        mixed = now.groupBy("shingle").agg(
            F.min("comp").alias("low"), F.max("comp").alias("high"),
            F.min_by(F.struct("node", "n", "at", "comp", "bits"), F.xxhash64("node", F.lit(turn))).alias("pivot")).where("low < high")
        if turn < pivot_rounds:
            found = (now.join(mixed.select("shingle", "pivot"), "shingle").where("comp <> pivot.comp")
                     .withColumn("m", F.col("pivot.n")).withColumn("at2", F.col("pivot.at"))
                     .withColumn("bits2", F.col("pivot.bits")).where(alike)
                     .select(F.least("node", "pivot.node").alias("a"), F.greatest("node", "pivot.node").alias("b")))
        else:
            # The largest component of a shingle stays on one side only.
            sizes = (now.join(mixed.select("shingle"), "shingle", "left_semi").groupBy("shingle", "comp")
                     .agg(F.count("*").alias("c")).groupBy("shingle").agg(F.max_by("comp", "c").alias("most")))
            here = now.join(sizes, "shingle")
            minor = here.where("comp <> most").select("shingle", "node", "comp", "n", "at", "bits", "before")
            other = here.select("shingle", F.col("node").alias("other"), F.col("comp").alias("comp2"),
                                F.col("n").alias("m"), F.col("at").alias("at2"), F.col("bits").alias("bits2"), F.col("before").alias("before2"))
            # A pair is made at its first common shingle only.
            found = (minor.join(other, "shingle").where("comp <> comp2").where(alike).where(~F.arrays_overlap("before", "before2"))
                     .select(F.least("node", "other").alias("a"), F.greatest("node", "other").alias("b")))
        fresh = keep(found.distinct().join(tested, ["a", "b"], "left_anti"), "pairs")
        labels = relabel(labels, _confirm(fresh, sets, percent))
        tested = tested.unionByName(fresh)

    numbered = (classes.select("hi", "lo", "node", F.col("doc_id").alias("first_id"))
                .join(labels, "node", "left").withColumn("comp", F.coalesce("comp", "node")))
    lowest = numbered.groupBy("comp").agg(F.min("first_id").alias("component_id"))
    by_set = numbered.join(lowest, "comp").select("hi", "lo", F.col("node").alias("class_id"), "component_id", *(["comp"] if hashed else []))
    return (sig.drop("half_keys").join(by_set, ["hi", "lo"], "left")
            .withColumn("component_id", F.when(F.col("n_shingles") > 0, F.col("component_id")).otherwise(F.col("doc_id")))
            .select("doc_id", "n_shingles", "class_id", "component_id",
                    F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"), *(["text_hash", "comp"] if hashed else [])))
