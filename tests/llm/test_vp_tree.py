"""Vantage-point trees against brute force."""

import math

import numpy as np
import pytest

from eventloom.llm import vp_tree as V
from eventloom.llm.queries import op13_vp_tree
from eventloom.llm.common import read_table


def brute(rows, asked, k):
    vectors = {(i, tuple(v)) for i, v in rows
               if i is not None and v and all(x is not None and math.isfinite(x) for x in v) and any(v)}
    out = []
    for q, a in sorted(x for x in vectors if x[0] in asked):
        scores = sorted((-float((np.array(a) * np.array(b)).sum()), i) for i, b in vectors if i != q and len(a) == len(b))[:k]
        out += [(q, r + 1, i, -s) for r, (s, i) in enumerate(scores)]
    return out


def test_messy_vectors(spark):
    rng = np.random.default_rng(5)
    rows = [(i, [float(np.float32(x)) for x in rng.normal(size=6) * (1 + i % 5)]) for i in range(400)]
    rows += [(1000 + i, rows[7][1]) for i in range(300)]  # one vector many times: ties
    rows += [rows[3], (7, rows[8][1]), (2000, None), (2020, [1.0, None, 1.0, 1.0, 1.0, 1.0]), (2040, [float("nan")] * 6), (2060, [float("inf")] * 6),
             (2080, [0.0] * 6), (None, [1.0] * 6), (2100, [1.0, 2.0]), (2101, [3.0, 1.0]), (2120, []), (2121, []), (2140, [5.0])]
    df = spark.createDataFrame([(i, v, 1, 2.0, "s") for i, v in rows], "vec_id long, embedding array<float>, rank int, score double, shard string")
    asked = {i for i, _ in rows if i is not None and i % 20 == 0}
    got = V.search(V.trees(df, shard_rows=150), df.where("vec_id % 20 = 0"), k=9, factor=1.0)
    want = brute(rows, asked, 9)
    assert sorted(r[:3] for r in map(tuple, got.collect())) == sorted(r[:3] for r in want)
    assert np.allclose([r[3] for r in sorted(map(tuple, got.collect()))], [r[3] for r in sorted(want)], rtol=1e-12)
    assert V.nearest(df.where("false"), df.where("false")).count() == 0
    assert V.nearest(df, df.where("false")).count() == 0


def _search(x, q, own, k, factor):
    order, nodes, longest = V.build_tree(x, leaf_rows=16)
    assert sorted(order) == list(range(len(x)))
    found = V._Nearest(q, own, x[order], np.arange(len(x))[order], longest, k)
    V.search_tree(nodes, found, factor)
    return found


@pytest.mark.parametrize("scale", [1.0, 1e6, 1e-6])
@pytest.mark.parametrize("dim", [1, 2, 16])
def test_factor_one_is_exact_and_larger_factors_score_less(dim, scale):
    rng = np.random.default_rng(dim)
    centres = rng.normal(size=(30, dim)) * 4
    x = (centres[rng.integers(0, 30, 2000)] + 0.1 * rng.normal(size=(2000, dim))) * scale
    x[100:160] = x[100]
    own = np.arange(0, 2000, 20)
    want = x[own] @ x.T
    want[np.arange(len(own)), own] = -np.inf
    exact = _search(x, x[own], own, 10, 1.0)
    assert np.allclose(exact.scores, -np.sort(-want, axis=1)[:, :10], rtol=1e-9)
    loose = _search(x, x[own], own, 10, 3.0)
    assert loose.scored <= exact.scored
    if dim <= 2:
        assert exact.scored < 0.7 * want.size  # the triangle inequality prunes


def test_equal_distances_split():
    x = np.ones((5000, 3))
    found = _search(x, x[:2], np.array([0, 1]), 5, 1.0)
    assert found.found.tolist() == [[1, 2, 3, 4, 5], [0, 2, 3, 4, 5]]


def test_recall_of_the_registered_query(spark):
    sf = "/root/testdata/sf0.01"
    rows = [(r.vec_id, r.embedding) for r in read_table(spark, sf, "embeddings").collect()]
    want = {(q, i) for q, _, i, _ in brute(rows, {i for i, _ in rows if i % 20 == 0}, 20)}
    got = {(r.query_id, r.vec_id) for r in op13_vp_tree(spark, sf).collect()}
    assert len(got) == len(want) and len(got & want) >= 0.95 * len(want)
