"""Phrase collocations by an FM-index per shard.

Tasks turn their texts into shards of about ``SHARD_WORDS`` words over local
word numbers (0 ends a piece) and store for each shard the Burrows-Wheeler
transforms of its words and of its words reversed. Rows are sorted by their
first ``LONGEST`` words, which is all that phrases of that length need. A phrase
is an interval of rows in both; the words before (after) its occurrences are
that range of the forward (backward) transform, so the phrases longer by one
word come with their counts, and a rank in the transform gives their intervals:
to the left from words to pairs and threes, to the right, and to the left again.

A frequent phrase has frequent parts only. So the counts of words and then of
pairs of words are summed over all shards by a hash, a Bloom filter of bounded
size says which may be frequent, and the last pass sends the phrases of 2 to
``LONGEST`` words, all of whose words and pairs pass, as texts to the sum that
decides. Hashes and filters can only let too much through, so counts are exact
and nothing is lost. The index is read where it lies; only counts are shuffled.

Both sums are dealt to parts by the hash, whose number goes by the words, so that a
part is of bounded size. A task adds up its shards' counts and sends those of a part
sorted and packed, which takes a fraction of the bytes of a row each.

What a Python worker holds does not grow with the input: a shard's phrases are
enumerated from some of its words at a time, held as word numbers and spelled for
some parts at a time; a part's phrases are sifted by sums in bounded slots before
any is kept as a text; and shards reach a worker a few bytes at a time.
"""

from __future__ import annotations

import itertools
from array import array
from collections import defaultdict
from collections.abc import Iterator
from contextlib import contextmanager
from functools import cached_property

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from eventloom.llm.common import free_shuffles, keep, sized, small_batches

LEAST = 100
LONGEST = 5
BEST = 2000
SHARD_WORDS = 1 << 19
#: Bytes of a text that are split into words at once.
SLICE = 1 << 20
#: Bits of a filter for each frequent word or pair, and at most (64 MB).
PHRASE_BITS = 16
FILTER_BITS = 1 << 29
NO_LANG = "und"
#: Words of the input for each part of the sums, and counts of pairs and of phrases
#: that a task adds up before it sends them.
PART_WORDS = 1 << 20
PAIRS_HELD = 1 << 21
PHRASES_HELD = 1 << 20
HELD_BYTES = 64 << 20
#: Rows of a shard that are extended at once, counts that are packed at once, slots
#: of a part's sums at most, and bytes of shards sent to Python at once.
ROWS_AT_ONCE = 1 << 16
PACKED_AT_ONCE = 1 << 15
SLOTS = 1 << 22
BATCH_BYTES = 4 << 20

_BREAK = b"\xff"  # in no UTF-8 text
_TO_BREAK = bytes.maketrans(b".,;:!?\n\x0b\x0c\r", _BREAK * 10)
_INDEX = "n long, langs array<string>, words array<string>, counts array<int>, forward binary, backward binary"
_INDEX_BATCH = pa.schema([
    ("n", pa.int64()), ("langs", pa.list_(pa.string())), ("words", pa.list_(pa.string())), ("counts", pa.list_(pa.int32())),
    ("forward", pa.binary()), ("backward", pa.binary())])
#: Pages and row groups of a shard or two: read and written whole, in buffers beside
#: the heap, they would else have all shards of a file (100 rows are not looked at).
_INDEX_FILE = {"parquet.page.size.row.check.min": 1, "parquet.block.size": 4 << 20}
_SALTS = 64


def _pack(numbers: np.ndarray) -> bytes:
    return pa.compress(numbers.astype("<i4").tobytes(), codec="zstd", asbytes=True)


def _unpack(packed: bytes, n: int) -> np.ndarray:
    return np.frombuffer(pa.decompress(packed, 4 * n, codec="zstd", asbytes=True), "<i4")


def _transform(words: np.ndarray) -> np.ndarray:
    """The word before each suffix of the ring ``words``, suffixes sorted by
    their first ``LONGEST`` words."""
    next_ = [np.roll(words, -i).astype(np.int64) for i in range(LONGEST)]
    keys = [(a << 32) | b for a, b in zip(next_[::2], next_[1::2])] + next_[LONGEST - LONGEST % 2 :]
    return np.roll(words, 1)[np.lexsort(keys[::-1])]


class _Shard:
    """Words collected for the next shard."""

    def __init__(self) -> None:
        number = itertools.count(1).__next__
        self.ids = array("i", [0])
        self.vocabularies: defaultdict[str, defaultdict[bytes, int]] = defaultdict(lambda: defaultdict(number, {_BREAK: 0}))

    def add(self, lang: str, text: bytes) -> None:
        self.ids.extend(map(self.vocabularies[lang].__getitem__, text.replace(_BREAK, b" \xff ").split()))
        self.ids.append(0)

    def index(self) -> pa.RecordBatch:
        ids = np.array(self.ids, np.int32)
        ids = ids[(ids != 0) | (np.roll(ids, -1) != 0)]  # of breaks in a row, one
        named = sorted((i, lang, word) for lang, vocabulary in self.vocabularies.items() for word, i in vocabulary.items() if i)
        row = {"n": [len(ids)], "langs": [[x[1] for x in named]], "words": [[x[2].decode() for x in named]],
               "counts": [np.bincount(ids, minlength=len(named) + 1)[1:].tolist()],
               "forward": [_pack(_transform(ids))], "backward": [_pack(_transform(ids[::-1]))]}
        return pa.RecordBatch.from_pydict(row, _INDEX_BATCH)


def _slices(text: bytes) -> Iterator[bytes]:
    """``text`` in parts of about ``SLICE`` bytes that end at a break."""
    a = 0
    while a < len(text):
        b = text.rfind(_BREAK, a, a + SLICE) if a + SLICE < len(text) else len(text)
        if b < 0:
            b = text.find(_BREAK, a + SLICE)
        b = len(text) if b < 0 else b + 1
        yield text[a:b]
        a = b


def _indexes(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[pa.RecordBatch]:
    shard = _Shard()
    for batch in batches:
        for lang, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            for part in _slices(text.encode().lower().translate(_TO_BREAK)):
                shard.add(lang, part)
                if len(shard.ids) >= size:
                    yield shard.index()
                    shard = _Shard()
    if len(shard.ids) > 1:
        yield shard.index()


class _Side:
    """One transform: ``first[w]`` is the first row that starts with word ``w``."""

    def __init__(self, before: np.ndarray, counts: np.ndarray):
        self.before, self.n = before, len(before)
        self.first = np.concatenate([[0], np.cumsum(counts)])

    @cached_property
    def ranks(self) -> np.ndarray:
        places = np.argsort(self.before, kind="stable")
        return self.before[places].astype(np.int64) * self.n + places

    def rows(self, word: np.ndarray, row: np.ndarray) -> np.ndarray:
        """First rows of the phrases longer by ``word`` than those at ``row``."""
        return np.searchsorted(self.ranks, word * self.n + row)


def _extend(side: _Side, words: int, start: np.ndarray, size: np.ndarray):
    """The phrases one word longer, to the front of ``side``, than those whose
    rows are ``size`` from ``start``: ``(parent, word, size, smaller)``, the last
    being the rows of the parent's phrases with smaller words."""
    parent = np.repeat(np.arange(len(start)), size)
    rows = np.arange(len(parent)) + np.repeat(start - (np.cumsum(size) - size), size)
    keys, found = np.unique(parent * words + side.before[rows], return_counts=True)
    parent, word = keys // words, keys % words
    smaller = np.cumsum(found) - found
    if len(parent):
        smaller -= smaller[np.searchsorted(parent, np.arange(len(start)))][parent]
    return parent, word, found, smaller


def _word_hash(lang: str, word: str) -> int:
    return xxhash.xxh3_64_intdigest(word, xxhash.xxh32_intdigest(lang))


def _keys(hashes: np.ndarray, bits: int) -> np.ndarray:
    """A number of ``bits`` for each phrase, from the hashes of its words."""
    mixed = np.zeros(len(hashes), np.uint64)
    for column in hashes.T:
        mixed = (mixed ^ (mixed >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15) + column
    return ((mixed ^ (mixed >> np.uint64(29))) * np.uint64(0xC2B2AE3D27D4EB4F)) >> np.uint64(64 - bits)


_PROBES = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93], np.uint64)


def _places(keys: np.ndarray, bits: int, probe: np.uint64) -> np.ndarray:
    """Places of keys in a Bloom filter of ``bits`` (a power of two) by one probe."""
    mixed = (keys ^ (keys >> np.uint64(29))) * _PROBES[0]
    return ((mixed ^ (mixed >> np.uint64(32))) * probe) >> np.uint64(65 - bits.bit_length())


def _may_hold(words: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Numbers of the keys that the filter may hold."""
    left = np.arange(len(keys))
    for probe in _PROBES:
        at = _places(keys[left], 64 * len(words), probe)
        left = left[((words[at >> np.uint64(6)] >> (at & np.uint64(63))) & np.uint64(1)).astype(bool)]
    return left


def _filter(keys: DataFrame) -> np.ndarray:
    """Bloom filter of the column ``key``, as 64-bit words; of at most ``FILTER_BITS``."""
    wanted = max(1, keys.count()) * PHRASE_BITS
    bits = min(FILTER_BITS, max(1 << 16, 1 << (wanted - 1).bit_length()))

    def marks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = batch.column(0).to_numpy().astype(np.uint64)
            at = np.unique(np.concatenate([_places(keys, bits, probe) for probe in _PROBES]))
            word, first = np.unique(at >> np.uint64(6), return_index=True)
            marks = np.bitwise_or.reduceat(np.uint64(1) << (at & np.uint64(63)), first) if len(first) else at
            yield pa.RecordBatch.from_pydict({"word": word.astype(np.int64), "marks": marks.view(np.int64)})

    rows = keys.select("key").mapInArrow(marks, "word long, marks long").groupBy("word").agg(F.bit_or("marks").alias("marks")).toPandas()
    out = np.zeros(bits // 64, np.uint64)
    out[rows["word"].to_numpy(np.int64)] = rows["marks"].to_numpy(np.int64).view(np.uint64)
    return out


def _enumerate(row: dict, filters: dict[int, Broadcast], bits: int, longest: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """``(phrases, counts, hashes)`` of a shard for each length from 2 to
    ``longest``, of phrases whose words and pairs pass ``filters``; those found
    from some of the words, then those from the next."""
    counts = np.append(row["n"] - row["counts"].sum(), row["counts"])
    hashes = np.fromiter(itertools.chain([0], map(_word_hash, _strings(row["langs"]), _strings(row["words"]))), np.uint64, len(counts))
    forward = _Side(_unpack(row["forward"], row["n"]), counts)
    backward = _Side(_unpack(row["backward"], row["n"]), counts) if longest > 3 else forward
    words = np.arange(1, len(counts))
    if 1 in filters:
        words = words[_may_hold(filters[1].value, _keys(hashes[words[:, None]], bits))]
    known = np.zeros(len(counts), bool)
    known[words] = True
    before = np.cumsum(counts[words]) - counts[words]
    for some in np.split(words, np.flatnonzero(np.diff(before // ROWS_AT_ONCE)) + 1):
        phrase, size = some[:, None], counts[some]
        start = other = forward.first[some]
        for length in range(2, longest + 1):
            left = length != 4
            near, far = (forward, start) if left else (backward, other)
            parent, word, found, smaller = _extend(near, len(counts), far, size)
            good = np.flatnonzero(known[word])
            if 2 in filters:
                ends = phrase[parent[good], 0 if left else -1]
                pair = np.column_stack([word[good], ends] if left else [ends, word[good]])
                good = good[_may_hold(filters[2].value, _keys(hashes[pair], bits))]
            parent, word, size = parent[good], word[good], found[good]
            phrase = np.column_stack([word, phrase[parent]] if left else [phrase[parent], word])
            yield phrase, size, hashes
            if length < longest:
                mine, opposite = near.rows(word, far[parent]), (other if left else start)[parent] + smaller[good]
                start, other = (mine, opposite) if left else (opposite, mine)


def _strings(column: pa.Array) -> Iterator[str]:
    for a in range(0, len(column), 1000):
        yield from column.slice(a, 1000).to_pylist()


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    """Rows one by one, lists as Arrow arrays: a shard as Python objects is large."""
    for batch in batches:
        for i in range(batch.num_rows):
            row = {name: batch[name][i] for name in batch.schema.names}
            yield {name: x.values if isinstance(x, pa.ListScalar) else x.as_py() for name, x in row.items()} | {"counts": row["counts"].values.to_numpy().astype(np.int64)}


def _pack_longs(numbers: np.ndarray) -> bytes:
    """Small numbers packed well: their lowest bytes, then the next, and so on."""
    return pa.compress(numbers.astype("<i8").view(np.uint8).reshape(-1, 8).T.tobytes(), codec="zstd", asbytes=True)


def _unpack_longs(packed: bytes, n: int) -> np.ndarray:
    planes = np.frombuffer(pa.decompress(packed, 8 * n, codec="zstd", asbytes=True), np.uint8)
    return np.ascontiguousarray(planes.reshape(8, n).T).view("<i8").ravel()


def _added(keys: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys, sorted, and the sums of their counts."""
    order = np.argsort(keys)
    keys = keys[order]
    first = np.flatnonzero(np.append(True, keys[1:] != keys[:-1])) if len(keys) else np.zeros(0, int)
    return keys[first], np.add.reduceat(n[order], first) if len(first) else n


_PAIRS = "part long, size long, keys binary, counts binary"
_PAIRS_BATCH = pa.schema([("part", pa.int64()), ("size", pa.int64()), ("keys", pa.binary()), ("counts", pa.binary())])
_PHRASES = "part long, lang string, size long, phrases binary, counts binary"
_PHRASES_BATCH = pa.schema([("part", pa.int64()), ("lang", pa.string()), ("size", pa.int64()), ("phrases", pa.binary()), ("counts", pa.binary())])


def _hashed_pairs(batches: Iterator[pa.RecordBatch], filters: dict[int, Broadcast], bits: int, part_bits: int) -> Iterator[pa.RecordBatch]:
    """Counts of pairs of words in shards, by key."""
    held: list[tuple[np.ndarray, np.ndarray]] = []

    def added() -> Iterator[pa.RecordBatch]:
        for a, b in _spans(sum(len(keys) for keys, _ in held), part_bits):
            within = [slice(*np.searchsorted(keys, [a << (bits - part_bits), b << (bits - part_bits)])) for keys, _ in held]
            keys, n = _added(*(np.concatenate([x[w] for x, w in zip(xs, within, strict=True)]) for xs in zip(*held, strict=True)))
            part = keys >> (bits - part_bits)
            starts = np.flatnonzero(np.append(True, part[1:] != part[:-1])) if len(part) else np.zeros(0, int)
            spans = [*zip(starts.tolist(), [*starts[1:].tolist(), len(keys)], strict=False)]
            yield pa.RecordBatch.from_pydict({
                "part": part[starts], "size": [b - a for a, b in spans], "keys": [_pack_longs(np.diff(keys[a:b], prepend=part[a] << (bits - part_bits))) for a, b in spans],
                "counts": [_pack_longs(n[a:b]) for a, b in spans]}, _PAIRS_BATCH)

    for row in _rows(batches):
        for phrase, size, hashes in _enumerate(row, filters, bits, 2):
            held.append(_added(_keys(hashes[phrase], bits).astype(np.int64), size.astype(np.int64)))
            if sum(len(keys) for keys, _ in held) >= PAIRS_HELD:
                yield from added()
                held.clear()
    if held:
        yield from added()


def _spans(n: int, part_bits: int) -> Iterator[tuple[int, int]]:
    """Spans of the parts that have about ``PACKED_AT_ONCE`` of ``n`` counts each."""
    step = max(1, (PACKED_AT_ONCE << part_bits) // max(1, n))
    for a in range(0, 1 << part_bits, step):
        yield a, min(a + step, 1 << part_bits)


def _frequent_pairs(found: pa.Table, least: int, bits: int, part_bits: int) -> pa.Table:
    """Keys of a part that occur ``least`` times."""
    rows = found.to_pylist()
    keys = [(r["part"] << (bits - part_bits)) + np.cumsum(_unpack_longs(r["keys"], r["size"])) for r in rows]
    keys, n = _added(np.concatenate(keys), np.concatenate([_unpack_longs(r["counts"], r["size"]) for r in rows]))
    return pa.table({"key": pa.array(keys[n >= least], pa.int64())})


def _spelled(batches: Iterator[pa.RecordBatch], filters: dict[int, Broadcast], bits: int, part_bits: int) -> Iterator[pa.RecordBatch]:
    """Counts of the phrases that pass all filters in shards, as texts."""
    held: list[tuple[pa.Array, pa.Array, np.ndarray, np.ndarray, np.ndarray]] = []

    def texts(a: int, b: int) -> Iterator[pa.Table]:
        """The phrases held of parts ``a`` to ``b``."""
        for words, langs, part, phrase, n in held:
            within = slice(*np.searchsorted(part, [a, b]))
            phrase = phrase[:, within]
            yield pa.table({"part": part[within], "lang": langs.take(pa.array(phrase[0])), "phrase": pc.binary_join_element_wise(*(words.take(pa.array(c)) for c in phrase), " "), "n": n[within]})

    def added() -> Iterator[pa.RecordBatch]:
        for a, b in _spans(sum(len(x[2]) for x in held), part_bits):
            one = pa.concat_tables(texts(a, b)).group_by(["part", "lang", "phrase"], use_threads=False).aggregate([("n", "sum")])
            one = one.sort_by([("part", "ascending"), ("lang", "ascending"), ("phrase", "ascending")]).combine_chunks()
            part, n = one["part"].to_numpy().astype(np.int64), one["n_sum"].to_numpy()
            lang = one["lang"].combine_chunks().dictionary_encode()
            code = lang.indices.to_numpy()
            starts = np.flatnonzero(np.append(True, (part[1:] != part[:-1]) | (code[1:] != code[:-1]))) if len(part) else np.zeros(0, int)
            ends = np.append(starts, len(part))
            joined = pc.binary_join(pa.ListArray.from_arrays(pa.array(ends, pa.int32()), one["phrase"].combine_chunks().cast(pa.binary())), b"\n")
            yield pa.RecordBatch.from_pydict({
                "part": part[starts], "lang": lang.dictionary.take(pa.array(code[starts])), "size": np.diff(ends),
                "phrases": [pa.compress(x.as_buffer(), codec="zstd", asbytes=True) for x in joined],
                "counts": [_pack_longs(n[a:b]) for a, b in zip(starts.tolist(), ends[1:].tolist(), strict=True)]}, _PHRASES_BATCH)

    for row in _rows(batches):
        words, langs = (pa.concat_arrays([pa.nulls(1, pa.string()), row[name].cast(pa.string())]) for name in ("words", "langs"))
        for phrase, size, hashes in _enumerate(row, filters, bits, LONGEST):
            part = (_keys(hashes[phrase], bits) >> np.uint64(bits - part_bits)).astype(np.int32)
            order = np.argsort(part, kind="stable")
            held.append((words, langs, part[order], phrase[order].T.astype(np.int32, order="C"), size[order].astype(np.int32)))
            shards = {id(x[0]): x[0].nbytes + x[1].nbytes for x in held}
            if sum(len(x[2]) for x in held) >= PHRASES_HELD or sum(shards.values()) + sum(y.nbytes for x in held for y in x[2:]) >= HELD_BYTES:
                yield from added()
                held.clear()
    if held:
        yield from added()


def _texts(row: dict) -> list[bytes]:
    with pa.input_stream(pa.py_buffer(row["phrases"]), compression="zstd") as stream:
        return stream.read().split(b"\n")


def _frequent_phrases(found: pa.Table, least: int) -> pa.Table:
    """Phrases of a part that occur ``least`` times. Sums by a hash, in as many
    slots as phrases or ``SLOTS``, say which may; only those are kept as texts."""
    wanted = int(pc.sum(found["size"]).as_py())
    slots = min(SLOTS, 1 << max(10, wanted.bit_length()))
    sums, places = np.zeros(slots, np.int64), []
    for row in _rows_of(found):
        seed = xxhash.xxh32_intdigest(row["lang"])
        hashes = np.fromiter((xxhash.xxh3_64_intdigest(text, seed) for text in _texts(row)), np.uint64, row["size"])
        places.append((hashes & np.uint64(slots - 1)).astype(np.int32))
        np.add.at(sums, places[-1], _unpack_longs(row["counts"], row["size"]))
    held = [pa.table({"lang": pa.array([], pa.string()), "phrase": pa.array([], pa.large_binary()), "n": pa.array([], pa.int64())})]
    for row, at in zip(_rows_of(found), places, strict=True):
        good = np.flatnonzero(sums[at] >= least)
        if len(good):
            texts = _texts(row)
            held.append(pa.table({"lang": pa.repeat(pa.scalar(row["lang"], pa.string()), len(good)), "phrase": pa.array([texts[i] for i in good.tolist()], pa.large_binary()),
                                  "n": _unpack_longs(row["counts"], row["size"])[good]}))
    out = pa.concat_tables(held).group_by(["lang", "phrase"], use_threads=False).aggregate([("n", "sum")])
    out = out.filter(pc.greater_equal(out["n_sum"], least))
    return pa.table({"lang": out["lang"], "phrase": out["phrase"].cast(pa.large_string()).cast(pa.string()), "a": out["n_sum"]})


def _rows_of(found: pa.Table) -> Iterator[dict]:
    for batch in found.to_batches(max_chunksize=64):
        yield from batch.to_pylist()


@contextmanager
def _bytes_at_once(spark: SparkSession) -> Iterator[None]:
    """Python tasks started within get ``BATCH_BYTES`` at once, or little more."""
    conf, name = spark.conf, "spark.sql.execution.arrow.maxBytesPerBatch"
    before = conf.get(name)
    if not 0 < spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(before) <= BATCH_BYTES:
        conf.set(name, str(BATCH_BYTES))
    try:
        yield
    finally:
        conf.set(name, before)


def phrase_counts(docs: DataFrame, least: int = LEAST, shard_words: int = SHARD_WORDS) -> tuple[DataFrame, DataFrame]:
    """``(phrases, totals)``: ``phrases(lang, phrase, a)`` of 1 to ``LONGEST``
    words that occur ``least`` times in texts of one language, and ``totals(lang,
    n)`` of all words."""
    with _bytes_at_once(docs.sparkSession):
        return _phrase_counts(docs, least, shard_words)


def _phrase_counts(docs: DataFrame, least: int, shard_words: int) -> tuple[DataFrame, DataFrame]:
    context = docs.sparkSession.sparkContext
    rows = docs.select(F.coalesce(F.col("lang").cast("string"), F.lit(NO_LANG)).alias("lang"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    index = keep(small_batches(rows).mapInArrow(lambda batches: _indexes(batches, shard_words), _INDEX), "index", **_INDEX_FILE)

    named = index.select(F.explode(F.arrays_zip("langs", "words", "counts")).alias("w")).select("w.langs", "w.words", "w.counts")
    words = keep(named.groupBy(F.col("langs").alias("lang"), F.col("words").alias("phrase")).agg(F.sum("counts").alias("a")), "words")
    totals = keep(words.groupBy("lang").agg(F.sum("a").alias("n")), "totals")
    free_shuffles(totals)

    # 256 keys a word: chance agreement stays rare at any size.
    size = int(totals.agg(F.sum("n")).head()[0] or 0)
    bits, part_bits = min(63, max(32, 8 + size.bit_length())), max(4, (size // PART_WORDS).bit_length())

    def word_keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hashes = np.array([*map(_word_hash, *(c.to_pylist() for c in batch.columns))], np.uint64)
            yield pa.RecordBatch.from_pydict({"key": _keys(hashes[:, None], bits).astype(np.int64)})

    filters: dict[int, Broadcast] = {}
    frequent = keep(words.where(F.col("a") >= least).select("lang", "phrase").mapInArrow(word_keys, "key long"), "frequent")
    filters[1] = context.broadcast(_filter(frequent))
    counts = index.drop("backward").mapInArrow(lambda batches, f=dict(filters): _hashed_pairs(batches, f, bits, part_bits), _PAIRS)
    frequent = keep(counts.groupBy("part").applyInArrow(lambda found: _frequent_pairs(found, least, bits, part_bits), "key long"), "frequent")
    filters[2] = context.broadcast(_filter(frequent))
    free_shuffles(frequent)
    longer = (index.mapInArrow(lambda batches: _spelled(batches, filters, bits, part_bits), _PHRASES)
              .groupBy("part").applyInArrow(lambda found: _frequent_phrases(found, least), "lang string, phrase string, a long"))
    phrases = keep(words.where(F.col("a") >= least).unionByName(longer), "phrases")
    free_shuffles(phrases)
    return phrases, totals


def collocations(docs: DataFrame, least: int = LEAST, best: int = BEST, shard_words: int = SHARD_WORDS) -> DataFrame:
    """``lang, rank, phrase, a, l, r, n, score``: the ``best`` phrases of each
    language of ``docs(text, lang, ...)``.

    Texts, with A-Z in lower case, are pieces between ``.,;:!?`` and line ends,
    and pieces words between blanks and tabs. A candidate has 2 to ``LONGEST``
    words and occurs ``a >= least`` times within pieces, overlaps included. Its
    score is that of its lowest cut into two parts (the first of equals), ``floor(1000 a n /
    (l r))``, with ``l`` and ``r`` the counts of the parts and ``n`` of all words
    of the language, in exact decimals. A candidate that occurs as often in a
    longer candidate is dropped. Ranks go by score and a, falling, and phrase.

    A null lang is ``und``, a null or empty text has no words, rows are counted
    as often as they are repeated, other columns are not read, and an empty
    table gives no rows. Texts may be as long as a row can be; a single piece
    is held whole in one shard."""
    counted, totals = phrase_counts(docs, least, shard_words)
    phrases = counted.select("lang", "phrase", "a", F.split("phrase", " ").alias("w")).where(F.size("w") > 1)
    part = lambda name, n: counted.select("lang", F.col("phrase").alias(name), F.col("a").alias(n))
    cuts = phrases.select("*", F.explode(F.sequence(F.lit(1), F.size("w") - 1)).alias("k")).select(
        "lang", "phrase", "a", "k", F.expr("array_join(slice(w, 1, k), ' ')").alias("head"),
        F.expr("array_join(slice(w, k + 1, size(w)), ' ')").alias("tail"))
    cuts = cuts.join(part("head", "l"), ["lang", "head"]).join(part("tail", "r"), ["lang", "tail"]).join(sized(totals), "lang")
    exact = lambda name: F.col(name).cast("decimal(20,0)")
    cuts = cuts.withColumn("above", exact("a") * F.lit(1000).cast("decimal(4,0)") * exact("n")).withColumn("below", exact("l") * exact("r"))
    lowest = F.min(F.struct(F.expr("above div below").alias("score"), "k", "l", "r"))
    scored = cuts.groupBy("lang", "phrase", "a", "n").agg(lowest.alias("cut"))

    less = [F.expr("array_join(slice(w, 1, size(w) - 1), ' ')"), F.expr("array_join(slice(w, 2, size(w) - 1), ' ')")]
    within = phrases.where(F.size("w") > 2).select("lang", "a", F.explode(F.array(*less)).alias("phrase")).distinct()
    kept = scored.join(within, ["lang", "phrase", "a"], "left_anti")
    rows = kept.select("lang", "phrase", "a", F.col("cut.l").alias("l"), F.col("cut.r").alias("r"), "n", F.col("cut.score").alias("score"))
    # A language's best are among the best of its parts, so no task ranks all its candidates.
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    parts = Window.partitionBy("lang", F.pmod(F.xxhash64("phrase"), F.lit(_SALTS))).orderBy(*order)
    few = rows.withColumn("rank", F.row_number().over(parts)).where(F.col("rank") <= best)
    ranked = few.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long"))
    return ranked.where(F.col("rank") <= best).select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


COLLOCATIONS_SQL = """
WITH p AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\\x0A-\\x0D]')) AS p FROM documents),
w AS (SELECT lang, regexp_extract_all(p, '[^\\x20\\x09]+') AS w FROM p),
t AS (SELECT lang, CAST(sum(len(w)) AS BIGINT) AS n FROM w GROUP BY lang),
g AS (
  SELECT lang, k, unnest(list_transform(range(1, len(w) - k + 2), lambda i: w[i:i + k - 1])) AS g
  FROM w, (VALUES (1), (2), (3), (4), (5)) s(k) WHERE len(w) >= k),
f AS (SELECT lang, k, g, count(*) AS f FROM g GROUP BY lang, k, g HAVING count(*) >= 100),
c AS (SELECT lang, k, g, f AS a FROM f WHERE k > 1),
cut AS (SELECT *, unnest(range(1, k)) AS h FROM c),
s AS (
  SELECT c.lang, c.k, c.g, c.a, c.h, l.f AS l, r.f AS r, t.n,
    CAST((CAST(1000 AS HUGEINT) * c.a * t.n) // (CAST(l.f AS HUGEINT) * r.f) AS BIGINT) AS score
  FROM cut c JOIN f l ON l.lang = c.lang AND l.g = c.g[1:c.h] JOIN f r ON r.lang = c.lang AND r.g = c.g[c.h + 1:c.k]
  JOIN t ON t.lang = c.lang),
b AS (SELECT * FROM s QUALIFY row_number() OVER (PARTITION BY lang, g ORDER BY score, h) = 1),
d AS (
  SELECT DISTINCT x.lang, x.g FROM c x JOIN c y ON x.lang = y.lang AND y.k > x.k AND 100 * y.a >= 100 * x.a
  AND contains(' ' || array_to_string(y.g, ' ') || ' ', ' ' || array_to_string(x.g, ' ') || ' ')),
k AS (SELECT lang, array_to_string(g, ' ') AS phrase, a, l, r, n, score FROM b ANTI JOIN d ON b.lang = d.lang AND b.g = d.g)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score FROM k
QUALIFY row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) <= 2000
"""
