"""Learned operators: held-out accuracy, exact base scores, edge cases."""

import math
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from eventloom.llm import class_lm, quality, toxicity
from eventloom.llm.common import read_table

BIG = "/root/testdata/sf0.01"


def crc(doc_id):
    return zlib.crc32(str(doc_id).encode()) if doc_id is not None else 0


# ---- quality ------------------------------------------------------------------


def test_quality_on_held_out_rows(spark):
    scored = quality.score_quality(read_table(spark, BIG, "documents"), read_table(spark, BIG, "labels")).toPandas()
    assert (scored["held_out"] == scored["doc_id"].map(lambda d: crc(d) % 3 == 1)).all()
    labels = read_table(spark, BIG, "labels").toPandas()
    m = scored[scored["held_out"]].merge(labels, on="doc_id")
    assert len(m) > 50 and (m["predicted"] == m["quality"]).mean() >= 0.97
    assert scored["score"].between(0, 1).all() and ((scored["score"] >= 0.5) == (scored["predicted"] == 1)).all()


def test_compiled_rules_equal_numpy(spark):
    rng = np.random.default_rng(0)
    x = rng.random((400, len(quality.STATS)))
    y = ((x[:, 1] > 0.6) & (x[:, 4] <= 0.7)).astype(float)
    intercept, rules = quality.learn_rules(x, y)
    assert rules and any(len(r) > 1 for r, _ in rules)
    want = 1 / (1 + np.exp(-(intercept + sum(w * quality._covers(r, x) for r, w in rules))))
    df = spark.createDataFrame([tuple(map(float, r)) for r in x], list(quality.STATS))
    got = [r[0] for r in df.select(quality.compiled(intercept, rules)).collect()]
    assert np.allclose(got, want) and ((want >= 0.5) == (y == 1)).mean() > 0.97


def test_quality_edge_cases(spark, messy, empty_docs):
    labels = spark.createDataFrame([(1, 1, "a"), (1, 0, "a"), (2, None, None), (None, 1, "b"), (5, 0, "c"), (7, 1, "d")], "doc_id long, quality int, text string")
    rows = quality.score_quality(messy, labels).collect()
    assert len(rows) == messy.count() and all(0 <= r.score <= 1 for r in rows)
    assert quality.score_quality(messy, labels.where("false")).first().score == 0.5
    assert quality.score_quality(empty_docs, labels).count() == 0
    assert quality.statistics(None) == quality.statistics(" \n") == [0.0] * len(quality.STATS)


# ---- toxicity -----------------------------------------------------------------


def levenshtein(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


@pytest.mark.parametrize("edits", [1, 2])
def test_automaton_equals_edit_distance(edits):
    rng = np.random.default_rng(4)
    make = lambda: "".join(rng.choice(list("abcé"), rng.integers(1, 9)))
    words = sorted({make() for _ in range(40)})
    trie = toxicity.Trie(words, edits, fuzzy_letters=4)
    for _ in range(1500):
        w = make()
        near = [(levenshtein(w, t), i) for i, t in enumerate(words) if w == t or len(t) >= 4]
        near = [x for x in near if x[0] <= edits]
        if len(w) < 4 - edits:
            near = [x for x in near if x[0] == 0]
        got = trie.search(w)
        assert (got is None and not near) or got == min(near)[::-1], (w, got, near)


def test_context_tells_quotation_from_abuse():
    known = toxicity._Known(toxicity.Trie(["moron"]))
    weight = lambda t: toxicity.find_hits(t, known)[3]
    assert weight("you moron") == [1.0] and weight('he said "you moron" to them') == [0.25] and weight("she called moron") == [0.25]
    assert weight("moron and morron")[0] > 1
    assert toxicity.find_hits("you mor0n mooron", known)[1:3] == ([0], [1])
    assert toxicity.find_hits(None, known) == (0, [], [], [])


@pytest.mark.parametrize("n", [2_000, 40_000])
def test_a_rare_term_is_learned_at_any_size(spark, n):
    text = "CASE WHEN id % 2 = 1 THEN concat('vile ', IF(id < 60, 'scoundrel ', ''), 'w', id % 97) ELSE concat('fine w', id % 97, IF(id < 8, ' chance', '')) END"
    train = spark.range(2 * n).selectExpr("xxhash64(id) AS at", "id AS doc_id", f"{text} AS text", "CAST(id % 2 AS int) AS y")
    assert toxicity.learn_lexicon(train, 0.5) == ["vile", "scoundrel"]


def test_toxicity_on_held_out_rows(spark):
    big = "/root/testdata/sf0.1"
    labels = read_table(spark, big, "labels")
    scored = toxicity.score_toxicity(read_table(spark, big, "documents"), labels).toPandas()
    assert (scored["held_out"] == scored["doc_id"].map(lambda d: crc(d) % 5 == 0)).all()
    m = scored[scored["held_out"]].merge(labels.toPandas(), on="doc_id")
    assert m.loc[m["toxic"] == 1, "predicted"].mean() >= 0.9 and m.loc[m["toxic"] == 0, "predicted"].mean() <= 0.005


def test_toxicity_edge_cases(spark, messy, empty_docs):
    labels = spark.createDataFrame([(1, 0, 1), (2, None, 1), (None, 1, 1)], "doc_id long, toxic int, y int")
    rows = toxicity.score_toxicity(messy, labels).collect()
    assert len(rows) == messy.count() and len({r.score for r in rows}) == 1 and rows[0].predicted == 0
    assert toxicity.score_toxicity(empty_docs, labels).count() == 0


# ---- language model -----------------------------------------------------------


def check_base(rows, texts):
    tokens = {i: [*(t or "").encode().lower().split(), None] for i, (_, t) in enumerate(texts)}
    c = Counter(w for i, (d, _) in enumerate(texts) if crc(d) % 5 != 1 for w in tokens[i])
    n, v = sum(c.values()), len(c)
    want = sorted(((d is None, d or 0), crc(d) % 5 == 1, len(tokens[i]), sum(c[w] > 0 for w in tokens[i]), n,
                   round(sum(math.log10((c[w] + 0.5) / (n + 0.5 * (v + 1))) for w in tokens[i]), 6)) for i, (d, _) in enumerate(texts))
    got = sorted(((r.doc_id is None, r.doc_id or 0), r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in rows)
    assert got == want


def test_lm_scores(spark):
    docs = read_table(spark, BIG, "documents")
    rows = class_lm.score_texts(docs, frequent=1000, tied=100, classes=16, rounds=4).collect()
    check_base(rows, [(r.doc_id, r.text) for r in docs.collect()])
    held = [r for r in rows if r.held_out]
    assert sum(r.score for r in held) > sum(r.base_score for r in held)


def test_lm_units_are_not_cut():
    assert class_lm.score_texts.__defaults__[:2] == (class_lm.FREQUENT, class_lm.TIED)
    assert class_lm.FREQUENT >= 4000 and class_lm.TIED >= 500


def test_lm_edge_cases(spark, messy, empty_docs):
    rows = class_lm.score_texts(messy, frequent=10, tied=5, classes=4, rounds=2).collect()
    check_base(rows, [(r.doc_id, r.text) for r in messy.collect()])
    assert all(math.isfinite(r.score) and r.score < 0 for r in rows)
    assert class_lm.score_texts(empty_docs).count() == 0


def test_best_moves_equal_recomputed_likelihood():
    rng = np.random.default_rng(8)
    units, classes = 12, 4
    n = rng.integers(0, 6, (units, units)).astype(float)
    at = np.array([0, *(1 + rng.integers(0, classes - 1, units - 1))])

    def value(a):
        g = np.zeros((classes, classes))
        np.add.at(g, (a[:, None].repeat(units, 1), a[None, :].repeat(units, 0)), n)
        return g, class_lm._h(g).sum() - class_lm._h(g.sum(axis=0)).sum() - class_lm._h(g.sum(axis=1)).sum()

    g, now = value(at)
    right, left = (np.stack([m[:, at == c].sum(axis=1) for c in range(classes)], axis=1) for m in (n, n.T))
    best, gain = class_lm.best_moves(right[1:], left[1:], np.diag(n)[1:], at[1:], g)
    for u in range(1, units):
        values = []
        for c in range(1, classes):
            moved = at.copy()
            moved[u] = c
            values.append(value(moved)[1])
        assert math.isclose(max(values) - now, gain[u - 1], abs_tol=1e-8)
        assert math.isclose(values[best[u - 1] - 1], max(values), abs_tol=1e-8)


def test_lm_words_and_units_equal_those_of_plain_python():
    texts = ["  Ab  cD\x1c\x1fe  f\x85g\t\n\x0b\x0c\rÄB ", "", " \n", "x", "\x00 İ漢字 ab", "a  b A"]
    plain = [t.encode().lower().split() for t in texts]
    n, words = class_lm.words_of(pa.array(texts))
    assert n.tolist() == [len(w) for w in plain] and words.to_pylist() == [w for ws in plain for w in ws]
    own = {b"a": 1, b"x": 2}
    units = class_lm.units_of(words, pa.array(list(own), pa.binary()), 7)
    assert units.tolist() == [own.get(w, 3 + zlib.crc32(w[-3:]) % 7) for w in words.to_pylist()]
    n, words = class_lm.words_of(pa.array([], pa.string()))
    assert len(n) == len(words) == len(class_lm.units_of(words, pa.array([b"a"], pa.binary()), 7)) == 0


def test_lm_bigrams_are_rows_by_units_not_by_texts(spark):
    texts = [f"a b c{i % 300} b a c{i % 7}" for i in range(900)] + ["", " "]
    frequent, n_units = pa.array([b"a", b"b"], pa.binary()), 3 + 200
    docs = spark.createDataFrame([(t,) for t in texts], "text string").repartition(4)
    rows = class_lm._unit_bigrams(docs, frequent, 200, n_units).toArrow()
    assert len(rows) <= 2 * -(-n_units // class_lm.BLOCK)  # one row a pair of units before
    want = Counter()
    for t in texts:
        n, words = class_lm.words_of(pa.array([t]))
        units = [0, *class_lm.units_of(words, frequent, 200).tolist(), 0]
        want.update(zip(units, units[1:], strict=False))
    for side in (0, 1):
        got = {}
        for s, block, cells, c in class_lm._blocks(rows.to_batches(), n_units):
            if s == side:
                unit, other = (cells // n_units + block * class_lm.BLOCK).tolist(), (cells % n_units).tolist()
                got |= dict(zip(zip(*((other, unit) if side else (unit, other)), strict=True), c.tolist(), strict=True))
        assert got == want
