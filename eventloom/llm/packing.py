"""Best-fit packing by a grouping genetic algorithm on islands.

Pieces are dealt by hash into blocks of a bounded number of pieces. Each block
lives on several islands, each a population of packings. A child takes whole
well-filled sequences of one parent, loses the other parent's sequences that
hold a piece twice, and the displaced pieces are placed best fit, longest
first. Between epochs every island sends its elite to the next one. A block
stops when it has as few sequences as its tokens need. Sequences that stay
unfilled are pooled over the blocks and packed again until one block is left
or pooling no longer shrinks them.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventloom.llm.common import keep, small_batches
from eventloom.llm.tokens import END, encoder

CAPACITY = 2048
BLOCK_PIECES = 4096
ISLANDS = 2
EPOCHS = 2
POPULATION = 4
GENERATIONS = 3
ELITE = 2
#: A sequence with at least this share of its capacity is not pooled again.
FULL = 0.995

_PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


def cut_pieces(docs: DataFrame, tokenizer: str = "byte_bpe_50k.json", capacity: int = CAPACITY) -> DataFrame:
    """Pieces of every document: its ids and id 0, cut only if longer than
    ``capacity``, then into full pieces after a first one with the rest."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(tokenizer)
        for big in batches:
            for batch in (big.slice(at, 128) for at in range(0, big.num_rows, 128)):
                out: list[list] = [[], [], [], [], []]
                ids = enc.encode([x or "" for x in batch.column(1).to_pylist()])
                for doc_id, raw in zip(batch.column(0).to_pylist(), ids, strict=True):
                    raw += END
                    n, at, piece = len(raw) // 4, 0, 0
                    while at < n:
                        end = min(n, at + ((n - at) % capacity or capacity))
                        for c, x in zip(out, (doc_id, piece, at, end - at, zlib.crc32(raw[4 * at : 4 * end])), strict=True):
                            c.append(x)
                        at, piece = end, piece + 1
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(out, (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()), strict=True)],
                    ["doc_id", "piece", "start", "length", "ids_crc32"])

    return small_batches(docs).select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(run, _PIECES)


class _Packing:
    """Sequences as lists of piece numbers with the room left in each."""

    def __init__(self, sizes: list[int], capacity: int):
        self.sizes, self.bins, self.room = sizes, [], []
        self._with_room: list[list[int]] = [[] for _ in range(capacity + 1)]
        self._mask, self.capacity = 0, capacity

    def _offer(self, b: int, room: int) -> None:
        if room:
            self._with_room[room].append(b)
            self._mask |= 1 << room

    def add_bin(self, items: list[int]) -> None:
        self.bins.append(items)
        self.room.append(self.capacity - sum(self.sizes[i] for i in items))
        self._offer(len(self.bins) - 1, self.room[-1])

    def best_fit(self, items: list[int]) -> None:
        sizes, bins, with_room = self.sizes, self.bins, self._with_room
        for i in items:
            size = sizes[i]
            fits = self._mask >> size
            if fits:
                room = size + (fits & -fits).bit_length() - 1
                stack = with_room[room]
                b = stack.pop()
                if not stack:
                    self._mask ^= 1 << room
                bins[b].append(i)
                room -= size
                self.room[b] = room
                if room:
                    with_room[room].append(b)
                    self._mask |= 1 << room
            else:
                self.add_bin([i])

    def cost(self) -> tuple[int, float]:
        return len(self.bins), -sum((self.capacity - r) ** 2 for r in self.room)

    def assignment(self) -> np.ndarray:
        out = np.empty(len(self.sizes), np.int32)
        for b, items in enumerate(self.bins):
            out[items] = b
        return out


def _from_assignment(sizes: list[int], capacity: int, assignment: np.ndarray) -> _Packing:
    groups: dict[int, list[int]] = {}
    for i, b in enumerate(assignment.tolist()):
        groups.setdefault(b, []).append(i)
    p = _Packing(sizes, capacity)
    for items in groups.values():
        p.add_bin(items)
    return p


def _child(mother: _Packing, father: _Packing, rng: np.random.Generator) -> _Packing:
    sizes = mother.sizes
    order = np.argsort(mother.room, kind="stable")
    well = order[: max(1, len(order) // 2)]
    injected = well[rng.random(len(well)) < 0.6].tolist()
    child, taken = _Packing(sizes, mother.capacity), set()
    for b in injected:
        child.add_bin(list(mother.bins[b]))
        taken.update(mother.bins[b])
    displaced = []
    drop = set(np.argsort(father.room)[-max(1, len(father.bins) // 50):].tolist())  # mutation: the emptiest are opened
    for b, items in enumerate(father.bins):
        if b in drop or not taken.isdisjoint(items):
            displaced += [i for i in items if i not in taken]
        else:
            child.add_bin(list(items))
    displaced.sort(key=sizes.__getitem__, reverse=True)
    child.best_fit(displaced)
    return child


def evolve(sizes: list[int], capacity: int, seeds: list[np.ndarray], seed: int,
           population: int = POPULATION, generations: int = GENERATIONS) -> list[_Packing]:
    """Packings of one island, best first; ``seeds`` are given assignments."""
    rng = np.random.default_rng(seed)
    least = -(-sum(sizes) // capacity)
    pool = [_from_assignment(sizes, capacity, a) for a in seeds]
    longest = sorted(range(len(sizes)), key=sizes.__getitem__, reverse=True)
    while len(pool) < population and not any(len(p.bins) <= least for p in pool):
        order = longest
        if pool:  # the descending order, disturbed
            noise = np.array([sizes[i] for i in range(len(sizes))]) * rng.uniform(0.8, 1.2, len(sizes))
            order = np.argsort(-noise).tolist()
        p = _Packing(sizes, capacity)
        p.best_fit(order)
        pool.append(p)
    pool.sort(key=_Packing.cost)
    for _ in range(generations):
        if len(pool) < 2 or len(pool[0].bins) <= least:
            break
        children = [_child(pool[a], pool[b], rng) for a, b in rng.permuted(np.tile(np.arange(len(pool)), (population // 2 + 1, 1)), axis=1)[:, :2].tolist()]
        pool = sorted([*pool, *children], key=_Packing.cost)[:population]
    return pool


_ELITES = "block long, island int, n_bins long, cost double, assignment binary"


def _island(capacity: int, elite: int):
    def run(items: pd.DataFrame, elites: pd.DataFrame) -> pd.DataFrame:
        if items.empty:
            return pd.DataFrame({c.split()[0]: [] for c in _ELITES.split(", ")})
        items = items.sort_values("pid")
        block, island = int(items["block"].iloc[0]), int(items["island"].iloc[0])
        seeds = [np.frombuffer(a, np.int32) for a in elites.sort_values(["n_bins", "cost", "assignment"])["assignment"]]
        if "was" in items and not seeds:
            seeds = [pd.factorize(items["was"])[0].astype(np.int32)] if items["was"].notna().all() else []
        best = evolve(items["length"].tolist(), capacity, seeds, hash((block, island, len(seeds))) & 0xFFFFFFFF)[:elite]
        return pd.DataFrame({"block": block, "island": island, "n_bins": [len(p.bins) for p in best],
                             "cost": [p.cost()[1] for p in best], "assignment": [p.assignment().tobytes() for p in best]})

    return run


def _places(items: pd.DataFrame, best: pd.DataFrame) -> pd.DataFrame:
    items = items.sort_values("pid")
    bins = pd.Series(np.frombuffer(best["assignment"].iloc[0], np.int32), index=items.index).astype("int64")
    offset = items["length"].groupby(bins).cumsum() - items["length"]
    return pd.DataFrame({"pid": items["pid"], "block": items["block"], "length": items["length"], "bin": bins, "offset": offset,
                         "fill": items["length"].groupby(bins).transform("sum")})


def _pack_level(pool: DataFrame, n_blocks: int, level: int, capacity: int, islands: int, epochs: int) -> DataFrame:
    items = keep(pool.withColumn("block", F.pmod(F.xxhash64("pid", F.lit(level)), F.lit(n_blocks))), "items")
    spread = items.withColumn("island", F.explode(F.array(*map(F.lit, range(islands)))))
    elites = items.sparkSession.createDataFrame([], _ELITES)
    for _ in range(epochs):
        arrived = elites.withColumn("island", ((F.col("island") + 1) % islands).cast("int")).unionByName(elites)
        elites = keep(spread.groupBy("block", "island").cogroup(arrived.groupBy("block", "island"))
                      .applyInPandas(_island(capacity, ELITE), _ELITES), "elites")
    best = elites.groupBy("block").agg(F.min_by("assignment", F.struct("n_bins", "cost", "assignment")).alias("assignment"))
    placed = items.groupBy("block").cogroup(best.groupBy("block")).applyInPandas(
        _places, "pid long, block long, length long, bin long, offset long, fill long")
    sequence = ((F.lit(level).cast("long") * (1 << 30) + F.col("block")) * (1 << 16) + F.col("bin")) * 4
    return keep(placed.withColumn("sequence_id", sequence), "placed")


def pack(docs: DataFrame, tokenizer: str = "byte_bpe_50k.json", capacity: int = CAPACITY, block_pieces: int = BLOCK_PIECES,
         islands: int = ISLANDS, epochs: int = EPOCHS) -> DataFrame:
    """``doc_id, piece, start, length, ids_crc32, sequence_id, offset`` for each
    piece of each row of ``docs(doc_id, text, ...)``.

    A null or empty text is the end id alone. Repeated rows are packed as often
    as they occur, a null doc_id stays null; other columns are not used. An
    empty table gives no rows. ``block_pieces`` may be at most 32,768."""
    pieces = keep(keep(cut_pieces(docs, tokenizer, capacity), "pieces").withColumn("pid", F.monotonically_increasing_id()), "numbered")
    full = pieces.where(F.col("length") == capacity).select("pid", (F.col("pid") * 4 + 3).alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    pool = pieces.where(F.col("length") < capacity).select("pid", "length", F.lit(None).cast("long").alias("was"))
    done, left, level = full, pool.count(), 0
    while left:
        n_blocks = max(1, -(-left // block_pieces))
        placed = _pack_level(pool, n_blocks, level, capacity, islands, epochs)
        open_bins = placed.where(F.col("fill") < FULL * capacity)
        again = open_bins.count() if n_blocks > 1 else 0
        if again > 0.7 * left or level == 15:
            again = 0
        settled = placed.where(F.col("fill") >= FULL * capacity) if again else placed
        done = done.unionByName(settled.select("pid", "sequence_id", "offset"))
        pool = open_bins.select("pid", "length", F.col("sequence_id").alias("was"))
        left, level = again, level + 1
    return pieces.join(done, "pid").drop("pid")
