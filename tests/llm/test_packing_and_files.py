"""Packing and token files against direct encoding."""

import zlib
from collections import Counter

import numpy as np
import pytest
from tokenizers import Tokenizer

from eventloom.llm import packing, rans
from eventloom.llm.common import table_path
from eventloom.llm.tokens import tokenizer_file

NAME = "byte_bpe_50k.json"


@pytest.fixture(scope="module")
def ids_of(messy):
    library = Tokenizer.from_file(tokenizer_file(NAME))
    return [(r.doc_id, [*library.encode(r.text or "", add_special_tokens=False).ids, 0]) for r in messy.collect()]


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


def test_pieces_and_places(messy, ids_of):
    rows = packing.pack(messy, block_pieces=4).collect()
    want = Counter()
    for doc_id, ids in ids_of:
        first = len(ids) % 2048 or 2048 if len(ids) > 2048 else len(ids)
        cuts = [0, *range(first, len(ids) + 1, 2048)]
        want.update((doc_id, i, a, b - a, crc(ids[a:b])) for i, (a, b) in enumerate(zip(cuts, cuts[1:])))
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows) == want
    by = {}
    for r in rows:
        by.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for places in by.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= 2048


def test_evolution_beats_or_equals_best_fit_and_keeps_every_piece():
    rng = np.random.default_rng(1)
    # Triplets that fill a sequence exactly: best fit decreasing leaves waste.
    sizes = []
    for _ in range(40):
        a, b = int(rng.integers(520, 900)), int(rng.integers(520, 640))
        sizes += [a, b, 2048 - a - b]
    first = packing._Packing(sizes, 2048)
    first.best_fit(sorted(range(len(sizes)), key=sizes.__getitem__, reverse=True))
    best = packing.evolve(sizes, 2048, [], seed=1, population=8, generations=30)[0]
    assert 40 <= len(best.bins) <= len(first.bins)
    assert sorted(i for b in best.bins for i in b) == list(range(len(sizes)))
    assert all(sum(sizes[i] for i in b) <= 2048 for b in best.bins)
    child = packing._child(first, best, rng)
    assert sorted(i for b in child.bins for i in b) == list(range(len(sizes)))


def test_files_round_trip(spark, messy, ids_of):
    path = table_path(spark, "test-files")
    rans.write_tokens(messy, path)
    order = sorted(((r.doc_id, r.text or ""), ids) for r, (_, ids) in zip(messy.collect(), ids_of, strict=True) if r.doc_id is not None)
    nulls = [ids for d, ids in ids_of if d is None]
    start, want = sum(map(len, nulls)), Counter()
    for (doc_id, _), ids in order:
        want[(doc_id, len(ids), crc(ids))] += 1
    got = rans.token_index(spark, path).collect()
    assert Counter((r.doc_id, r.n_tokens, r.ids_crc32) for r in got if r.doc_id is not None) == want
    at = 0
    for r in sorted(got, key=lambda r: r.start):
        assert r.start == at
        at += r.n_tokens
    assert [r.doc_id for r in sorted(got, key=lambda r: r.start) if r.start >= start] == [d for (d, _), _ in order]
    back = {(r.doc_id, tuple(r.ids)) for r in rans.read_tokens(spark, path).collect()}
    assert back == {(d, tuple(ids)) for d, ids in ids_of}


def test_damaged_block_is_noticed(spark, messy):
    path = table_path(spark, "test-files")
    rans.write_tokens(messy.limit(3), path)
    blocks = spark.read.parquet(f"{path}/blocks").toPandas()
    states = bytearray(blocks.loc[0, "states"])
    states[2] ^= 0x0F
    blocks.at[0, "states"] = bytes(states)
    spark.createDataFrame(blocks, rans.BLOCK).write.mode("overwrite").parquet(f"{path}-bad/blocks")
    spark.read.parquet(f"{path}/frequencies").write.parquet(f"{path}-bad/frequencies")
    with pytest.raises(Exception, match="checksum differs"):
        rans.token_index(spark, f"{path}-bad").collect()


def test_empty_tables(spark, empty_docs):
    assert packing.pack(empty_docs).count() == 0
    assert rans.round_trip(empty_docs).count() == 0
