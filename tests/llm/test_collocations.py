"""Collocations against plain counting, and the transforms against the words."""

import re
import tracemalloc
from collections import Counter

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import pytest

from eventloom.llm import collocations as C


def plain_counts(rows, least, best):
    n, f = Counter(), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        text = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", text):
            words = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(words)
            f.update((lang, *words[i : i + k]) for k in range(1, 6) for i in range(len(words) - k + 1))
    c = {p: a for p, a in f.items() if len(p) > 2 and a >= least}
    hidden = set()
    for p, a in c.items():
        for k in range(3, len(p)):
            hidden |= {(p[0], *p[i : i + k - 1]) for i in range(1, len(p) - k + 2) if a >= c[(p[0], *p[i : i + k - 1])]}
    out = {}
    for p, a in c.items():
        if p not in hidden:
            score, _, left, right = min((1000 * a * n[p[0]] // (f[p[:k]] * f[(p[0], *p[k:])]), k, f[p[:k]], f[(p[0], *p[k:])]) for k in range(2, len(p)))
            out.setdefault(p[0], []).append((-score, -a, " ".join(p[1:]).encode(), left, right))
    return sorted((lang, r + 1, x[2].decode(), -x[1], x[3], x[4], n[lang], -x[0]) for lang, xs in out.items() for r, x in enumerate(sorted(xs)[:best]))


def texts(seed, n):
    rng = np.random.default_rng(seed)
    words = ["a", "B", "cé", "d'x", "e", "漢", "\x00", "f\xa0g", "new", "york"]
    ends = [" ", "  ", "\t", ". ", ",", "\n", "!?", " "]
    return [("en" if i % 3 else [None, "fr", ""][i // 3 % 3],
             "".join(words[min(int(w), 9)] + ends[int(e)] for w, e in zip(rng.exponential(2.5, 30), rng.integers(0, 8, 30)))
             + "new york new york city hall " * (i % 2)) for i in range(n)]


@pytest.mark.parametrize("shard_words", [1, 50, 1 << 20])
def test_equals_plain_counting(spark, shard_words):
    rows = texts(3, 240) + [("en", None), (None, None), ("en", ""), ("fr", " \t "), ("de", "one two")] + [("en", "york " * 3000)]
    df = spark.createDataFrame([(*r, 1, "x", 2) for r in rows], "lang string, text string, a int, phrase string, id int").repartition(3)
    got = C.collocations(df, least=20, best=40, shard_words=shard_words)
    want = plain_counts(rows, 20, 40)
    assert len(want) > 50 and any(len(w[2].split(" ")) == 5 for w in want)
    assert sorted(map(tuple, got.collect())) == want


def test_messy_and_empty(spark, messy):
    docs = messy.withColumn("lang", messy.source)
    got = C.collocations(docs, least=2)
    assert sorted(map(tuple, got.collect())) == plain_counts([(r.lang, r.text) for r in docs.collect()], 2, C.BEST)
    assert C.collocations(docs.where("false")).count() == 0
    assert C.collocations(docs).where("a < 100").count() == 0


def test_long_texts_are_cut_at_breaks(monkeypatch):
    monkeypatch.setattr(C, "SLICE", 7)
    for text in (b"", b"\xff", b"abc", b"a b\xffc d e f g h i j\xffk\xff", b"\xff" * 20, b"x" * 30 + b"\xff" + b"y" * 30):
        parts = list(C._slices(text))
        assert b"".join(parts) == text and all(p.endswith(b"\xff") for p in parts[:-1])


def test_filter_has_no_false_negatives(spark, monkeypatch):
    keys = np.random.default_rng(4).integers(0, 1 << 40, 3000)
    rows = spark.createDataFrame([(int(k),) for k in keys], "key long")
    held, keys = C._filter(rows), keys.astype(np.uint64)
    assert C._may_hold(held, keys).tolist() == list(range(3000))
    assert len(C._may_hold(held, np.setdiff1d(np.arange(20000, dtype=np.uint64) << np.uint64(20), keys))) < 400
    assert not len(C._may_hold(C._filter(rows.where("false")), keys))
    monkeypatch.setattr(C, "FILTER_BITS", 1 << 10)
    small = C._filter(rows)
    assert len(small) == 16 and len(C._may_hold(small, keys)) == 3000


def test_full_filters_change_nothing(spark, monkeypatch):
    docs = spark.createDataFrame(texts(8, 90), "lang string, text string")
    want = sorted(map(tuple, C.collocations(docs, least=10).collect()))
    monkeypatch.setattr(C, "_filter", lambda keys: np.full(16, 2**64 - 1, np.uint64))
    assert sorted(map(tuple, C.collocations(docs, least=10).collect())) == want != []


def test_extensions_are_counts_and_intervals():
    rng = np.random.default_rng(1)
    ids = np.concatenate([[0], rng.integers(0, 6, 400), [0]]).astype(np.int32)
    counts = np.bincount(ids, minlength=6)
    forward, backward = (C._Side(C._transform(x), counts) for x in (ids, ids[::-1]))
    found = Counter(tuple(ids[i : i + k]) for k in (1, 2, 3, 4) for i in range(len(ids) - k + 1))
    phrase = np.arange(1, 6)[:, None]
    start, size, other = forward.first[1:6], counts[1:6], backward.first[1:6]
    for length in (2, 3, 4):
        left = length % 2 == 0
        near, far = (forward, start) if left else (backward, other)
        parent, word, size, smaller = C._extend(near, 6, far, size)
        mine, opposite = near.rows(word, far[parent]), (other if left else start)[parent] + smaller
        start, other = (mine, opposite) if left else (opposite, mine)
        phrase = np.column_stack([word, phrase[parent]] if left else [phrase[parent], word])
        good = word > 0
        phrase, start, size, other = phrase[good], start[good], size[good], other[good]
        assert {tuple(p): s for p, s in zip(phrase, size)} == {p: n for p, n in found.items() if len(p) == length and 0 not in p}


def test_sums_are_packed_by_part(spark, monkeypatch):
    """A shard's counts of pairs and phrases are a row a part; before, one a pair or phrase."""
    docs = spark.createDataFrame(texts(5, 120), "lang string, text string").repartition(2)
    want = sorted(map(tuple, C.collocations(docs, least=10).collect()))
    sent, apply = [], type(docs.groupBy("lang")).applyInArrow

    def counting(grouped, *args):
        sent.append(grouped.count().select("count", "part").toPandas())
        return apply(grouped, *args)

    monkeypatch.setattr(type(docs.groupBy("lang")), "applyInArrow", counting)
    assert sorted(map(tuple, C.collocations(docs, least=10).collect())) == want != []
    pairs, phrases = sent
    assert pairs["part"].max() < 16 and pairs["count"].max() <= 2 and phrases["part"].max() < 16 and phrases["count"].max() <= 2 * 4
    for name in ("PAIRS_HELD", "PHRASES_HELD", "PART_WORDS"):
        monkeypatch.setattr(C, name, 30)
    assert sorted(map(tuple, C.collocations(docs, least=10).collect())) == want
    assert sent[-1]["count"].sum() > phrases["count"].sum()


def test_packed_longs():
    for numbers in ([], [0], [5, 0, -3, 1 << 62, -(1 << 62)], range(70000)):
        numbers = np.array(numbers, np.int64)
        assert C._unpack_longs(C._pack_longs(numbers), len(numbers)).tolist() == numbers.tolist()


POOLS = []  # Arrow's memory must not outlive its pool


def held_most(f):
    """Result of ``f()`` and the most MB it held at once: Python's and numpy's, and Arrow's."""
    before, pool = pa.default_memory_pool(), pa.proxy_memory_pool(pa.default_memory_pool())
    POOLS.append(pool)
    pa.set_memory_pool(pool)
    tracemalloc.start()
    try:
        out = f()
        return out, (tracemalloc.get_traced_memory()[1] + pool.max_memory()) / 1e6
    finally:
        tracemalloc.stop()
        pa.set_memory_pool(before)


def one_shard(n, seed):
    words = [f"long-word-{w}" for w in np.random.default_rng(seed).zipf(1.3, n) % 5000]
    docs = pa.RecordBatch.from_pydict({"lang": ["en"], "text": [" ".join(words)]}, pa.schema([("lang", pa.string()), ("text", pa.string())]))
    return words, list(C._indexes(iter([docs]), 1 << 30))


def test_a_shard_is_spelled_in_little_memory():
    """All phrases of a shard pass the filters, as those of large inputs do: they were held as texts, all at once."""
    words, index = one_shard(150_000, 6)
    sent, most = held_most(lambda: [b for b in C._spelled(iter(index), {}, 40, 4)])
    got = Counter()
    for b in sent:
        for row in b.to_pylist():
            texts = pa.input_stream(pa.py_buffer(row["phrases"]), compression="zstd").read().decode().split("\n")
            got.update(dict(zip(texts, C._unpack_longs(row["counts"], row["size"]).tolist(), strict=True)))
    want = Counter(" ".join(words[i : i + k]) for k in (2, 3, 4, 5) for i in range(len(words) - k + 1))
    assert got == want
    assert most < 40, most


def test_a_part_of_many_phrases_is_summed_in_little_memory(monkeypatch):
    """A part's phrases, nearly all rare, were held as texts, all at once."""
    words, index = one_shard(150_000, 7)
    sent = pa.Table.from_batches(C._spelled(iter(index), {}, 40, 4))
    found, most = held_most(lambda: C._frequent_phrases(sent, 100))
    want = Counter(" ".join(words[i : i + k]) for k in (2, 3, 4, 5) for i in range(len(words) - k + 1))
    want = {p: n for p, n in want.items() if n >= 100}
    as_counts = lambda t: dict(zip(t["phrase"].to_pylist(), t["a"].to_pylist(), strict=True))
    assert as_counts(found) == want and len(want) > 100 and set(found["lang"].to_pylist()) == {"en"}
    assert most < 20, most
    monkeypatch.setattr(C, "SLOTS", 1)
    assert as_counts(C._frequent_phrases(sent, 100)) == want
    assert not C._frequent_phrases(sent, 1 << 40).num_rows


def test_shards_reach_a_worker_few_at_once(spark, monkeypatch):
    """All shards of a file were sent to Python in one batch."""
    docs = spark.createDataFrame([("en", " ".join(f"w{i}" for i in range(j, j + 60_000))) for j in range(8)], "lang string, text string").coalesce(1)
    spelled, before = C._spelled, spark.conf.get("spark.sql.execution.arrow.maxBytesPerBatch")

    def watched(batches, *args):
        yield from spelled((b if b.num_rows < 4 else pytest.fail("many shards at once") for b in batches), *args)

    monkeypatch.setattr(C, "_spelled", watched)
    monkeypatch.setattr(C, "BATCH_BYTES", 1 << 20, raising=False)
    assert C.phrase_counts(docs, 8, 60_000)[0].count() == 5 * (60_000 - 7) - 10
    assert spark.conf.get("spark.sql.execution.arrow.maxBytesPerBatch") == before


def test_index_is_read_few_shards_at_once(spark, monkeypatch):
    """A file of the index was one row group, read whole in buffers beside the heap."""
    docs = spark.createDataFrame([("en", " ".join(f"w{i}" for i in range(j, j + 60_000))) for j in range(8)], "lang string, text string").coalesce(1)
    keep, groups = C.keep, []

    def watched(df, name, **options):
        out = keep(df, name, **options)
        files = [pq.ParquetFile(x.removeprefix("file://")).metadata for x in out.inputFiles()]
        groups.extend(f.row_group(i).num_rows for f in files for i in range(f.num_row_groups))
        raise InterruptedError

    monkeypatch.setattr(C, "keep", watched)
    with pytest.raises(InterruptedError):
        C.phrase_counts(docs, 8, 60_000)
    assert sum(groups) == 8 and max(groups) <= 4
