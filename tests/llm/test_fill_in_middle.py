"""Fill-in-the-middle against a plain rewrite of its rules."""

import hashlib
import re

import numpy as np
import pyarrow as pa
import pytest

from eventloom.llm import fill_in_middle as M


def plain_rule(doc_id, text):
    text = text or ""
    digest = hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(digest[8 * i : 8 * i + 8], 16) for i in range(4)]
    units = re.findall(r"[A-Za-z]+|[^A-Za-z]", text)
    n = len(units)
    if not text or any(s in text for s in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 90:
        return n, "plain", None, None, text
    low, high = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    p, m, s = ("".join(x) for x in (units[:low], units[low:high], units[high:]))
    spm = h[3] % 100 < 20
    out = f"<S>{s}<P>{p}<M>{m}" if spm else f"<P>{p}<S>{s}<M>{m}"
    return n, "spm" if spm else "psm", len(p), len(m), out


ODD = ["", None, "a", "<", "<P", "x<P>y", "<S><M>", "S>", "<S", ">", "abc def\nghi", "é漢字\U0001f600z", "--" * 40, "Word" * 50, "a<b>c<", "\x00\r\n"]


def test_rows_equal_the_plain_rule(spark, messy, empty_docs):
    docs = spark.createDataFrame([(i, ODD[i % len(ODD)], "k") for i in range(1000)], "doc_id long, text string, form string")
    for df in (docs, messy):
        got = [tuple(r) for r in M.restore(M.fill_in_middle(df)).collect()]
        want = [(r.doc_id, *plain_rule(r.doc_id, r.text), r.text or "") for r in df.collect()]
        order = lambda r: (r[0] is None, r[0] or 0, r[5])
        assert sorted(got, key=order) == sorted(want, key=order)
    assert {r[2] for r in got} >= {"plain", "psm"}
    assert M.digests(empty_docs).count() == 0


@pytest.mark.parametrize("tile", [1, 2, 3, 7, 64])
def test_tiles_do_not_show(tile, monkeypatch):
    rng = np.random.default_rng(tile)
    texts = ["".join(rng.choice(list("aB<PSM> \né漢"), rng.integers(0, 30))) for _ in range(60)]
    run, at = M._bytes(pa.array(texts))
    h = rng.integers(0, 2**32, (60, 2))
    plain = np.array([not t or any(s in t for s in ("<P>", "<S>", "<M>")) for t in texts])
    spm = ~plain & (rng.random(60) < 0.5)
    whole = M._transform(run, at, h, plain, spm)
    monkeypatch.setattr(M, "TILE", tile)
    for a, b in zip(whole, M._transform(run, at, h, plain, spm)):
        assert np.array_equal(a, b)
    back, places = M._inverse(whole[2], whole[3], plain, spm)
    assert M._texts(back, places).to_pylist() == texts


def test_sliced_arrays():
    run, at = M._bytes(pa.array(["ab", "", "cde", "f"]).slice(1, 2))
    assert bytes(run) == b"cde" and at.tolist() == [0, 0, 3]
