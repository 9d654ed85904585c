"""Approximate nearest neighbours by inner product with vantage-point trees.

Rows are dealt over shards of a bounded size and each shard becomes one tree. A
node picks one of its rows as vantage point, orders its rows by their distance
from it and splits them in two halves; each half keeps the smallest and largest
of its distances. The trees are a written table, in tree order, so a node is a
range of rows and a leaf's rows lie together.

The largest inner product is the smallest distance once every row of a shard
gets one more component ``sqrt(M^2 - |x|^2)`` (M: the shard's largest norm) and
queries get 0 there. By the triangle inequality a half whose distances lie in
``[low, high]`` holds nothing nearer to a query than ``max(low - d, d - high)``,
d being the query's distance from the vantage point. A half is skipped if
``factor`` times that bound exceeds the query's k-th distance so far: factor 1
gives exact search, larger factors skip more and may miss some.

Trees meet groups of queries by key, so a task holds one tree and one group, and
each sends on at most k rows a query.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from eventloom.llm.common import keep

SHARD_ROWS = 16_384
QUERY_GROUP = 4096
LEAF_ROWS = 64
SAMPLE = 8
FACTOR = 4.0
#: Relative slack that rounding of distances may need.
SLACK = 1e-9

_TREES = "dim int, shard long, n long, longest double, vec_ids binary, cells binary, nodes binary"
_FOUND = pa.schema([("query", pa.int64()), ("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.float64())])
_NODE = np.dtype([("a", "<i4"), ("b", "<i4"), ("vantage", "<i4"), ("inner", "<i4"), ("outer", "<i4"),
                  ("low0", "<f8"), ("high0", "<f8"), ("low1", "<f8"), ("high1", "<f8")])


def _vectors(rows: DataFrame) -> DataFrame:
    """Distinct ``(vec_id, dim, v)`` of the rows that take part."""
    v = F.col("embedding").cast("array<double>")
    usable = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists(v, lambda x: x != 0)
    usable &= F.aggregate(v, F.lit(0.0), lambda total, x: total + x * x) < float("inf")
    return (rows.where(F.col("vec_id").isNotNull() & F.coalesce(usable, F.lit(False)))
            .select(F.col("vec_id").cast("long").alias("vec_id"), F.size(v).alias("dim"), F.transform(v, lambda x: x + F.lit(0.0)).alias("v"))
            .distinct())


def _matrix(table: pa.Table, name: str, dim: int) -> np.ndarray:
    return table[name].combine_chunks().flatten().to_numpy(zero_copy_only=False).astype(float).reshape(table.num_rows, dim)


def _lifted(cells: np.ndarray, longest: float) -> np.ndarray:
    """Rows with the component that makes inner products distances."""
    return np.column_stack([cells, np.sqrt(np.maximum(longest**2 - (cells * cells).sum(axis=1), 0))])


def build_tree(cells: np.ndarray, leaf_rows: int = LEAF_ROWS) -> tuple[np.ndarray, np.ndarray, float]:
    """``(order, nodes, longest)``: the rows in tree order, the nodes, of which
    the first is the root, and the largest norm. Halves are cut by place in the
    order of distance, so rows at equal distances split as well."""
    longest = float(np.sqrt((cells * cells).sum(axis=1).max()))
    points = _lifted(cells, longest)
    order = np.arange(len(points))
    nodes: list[tuple] = [()]
    work = [(0, 0, len(points))]
    while work:
        here, a, b = work.pop()
        if b - a <= leaf_rows:
            nodes[here] = (a, b, -1, -1, -1, 0.0, 0.0, 0.0, 0.0)
            continue
        rows = order[a:b]
        # Of a few rows, the one whose distances to the others spread most.
        tried = rows[np.linspace(0, b - a - 1, SAMPLE).astype(int)]
        others = points[rows[np.linspace(0, b - a - 1, 8 * SAMPLE).astype(int)]]
        spread = [np.linalg.norm(others - points[t], axis=1).std() for t in tried]
        vantage = tried[int(np.argmax(spread))]
        rest = rows[rows != vantage]
        d = np.linalg.norm(points[rest] - points[vantage], axis=1)
        half = len(rest) // 2
        by = np.argpartition(d, half)
        order[a] = vantage
        order[a + 1 : b] = rest[by]
        inner, outer = d[by[:half]], d[by[half:]]
        middle = a + 1 + half
        nodes[here] = (a, b, a, len(nodes), len(nodes) + 1, inner.min(), inner.max(), outer.min(), outer.max())
        work += [(len(nodes), a + 1, middle), (len(nodes) + 1, middle, b)]
        nodes += [(), ()]
    return order, np.array(nodes, _NODE), longest


class _Nearest:
    """The k best rows of every query so far, best first, and how many scores
    were computed."""

    def __init__(self, queries: np.ndarray, own: np.ndarray, cells: np.ndarray, ids: np.ndarray, longest: float, k: int):
        self.queries, self.own, self.cells, self.ids, self.k = queries, own, cells, ids, k
        self.squares = (queries * queries).sum(axis=1) + longest**2
        self.error = SLACK * self.squares
        self.scores = np.full((len(queries), k), -np.inf)
        self.found = np.full((len(queries), k), np.iinfo(np.int64).max)
        self.scored = 0

    def reach(self, q: np.ndarray) -> np.ndarray:
        """Distance of the k-th best, infinite before there are k."""
        return np.sqrt(np.maximum(self.squares[q] - 2 * self.scores[q, -1] + self.error[q], 0))

    def distance(self, q: np.ndarray, row: int) -> np.ndarray:
        return np.sqrt(np.maximum(self.squares[q] - 2 * (self.queries[q] @ self.cells[row]), 0))

    def offer(self, q: np.ndarray, a: int, b: int) -> None:
        """Score rows ``a`` to ``b`` for the queries ``q``. A matrix product
        finds the pairs that may enter; their scores are summed alike for every
        pair, so equal vectors tie."""
        self.scored += len(q) * (b - a)
        rough = self.queries[q] @ self.cells[a:b].T
        may = (rough >= (self.scores[q, -1] - self.error[q])[:, None]) & (self.ids[a:b][None, :] != self.own[q][:, None])
        hit = np.flatnonzero(may.any(axis=1))
        if not len(hit):
            return
        left, right = np.nonzero(may[hit])
        exact = np.full((len(hit), b - a), -np.inf)
        exact[left, right] = (self.queries[q[hit[left]]] * self.cells[a + right]).sum(axis=1)
        scores = np.hstack([self.scores[q[hit]], exact])
        names = np.hstack([self.found[q[hit]], np.where(may[hit], self.ids[a:b][None, :], np.iinfo(np.int64).max)])
        best = np.lexsort((names, -scores), axis=1)[:, : self.k]
        self.scores[q[hit]] = np.take_along_axis(scores, best, axis=1)
        self.found[q[hit]] = np.take_along_axis(names, best, axis=1)


def search_tree(nodes: np.ndarray, nearest: _Nearest, factor: float) -> None:
    """Walk the tree with all queries at once, so that a node is entered twice
    at most: each query first goes down to the leaf nearest to it, which gives
    it k rows to beat, and then into every half that the bound allows."""
    everyone = np.arange(len(nearest.queries))
    home = np.full(len(everyone), -1)

    def bounds(q: np.ndarray, node: np.void) -> tuple[np.ndarray, np.ndarray]:
        d = nearest.distance(q, node["vantage"])
        return (np.maximum(np.maximum(node["low0"] - d, d - node["high0"]), 0), np.maximum(np.maximum(node["low1"] - d, d - node["high1"]), 0))

    work = [(0, everyone)]
    while work:
        at, q = work.pop()
        node = nodes[at]
        if not len(q):
            continue
        if node["vantage"] < 0:
            home[q] = at
            nearest.offer(q, node["a"], node["b"])
            continue
        to_inner, to_outer = bounds(q, node)
        work += [(node["outer"], q[to_inner > to_outer]), (node["inner"], q[to_inner <= to_outer])]

    todo = [(0, everyone, np.zeros(len(everyone)))]
    while todo:
        at, q, bound = todo.pop()
        q = q[(factor * bound <= nearest.reach(q)) & (home[q] != at)]
        node = nodes[at]
        if not len(q):
            continue
        if node["vantage"] < 0:
            nearest.offer(q, node["a"], node["b"])
            continue
        nearest.offer(q, node["a"], node["a"] + 1)
        to_inner, to_outer = bounds(q, node)
        todo += [(node["outer"], q, to_outer), (node["inner"], q, to_inner)]


def trees(rows: DataFrame, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """The index of ``rows(vec_id, embedding, ...)`` as a kept table: one row
    for each shard of about ``shard_rows`` vectors of one length."""
    vectors = keep(_vectors(rows), "vectors")
    shards = max(1, -(-vectors.count() // shard_rows))
    dealt = vectors.withColumn("shard", F.pmod(F.xxhash64("vec_id", "v"), F.lit(shards)).cast("long"))

    def build(table: pa.Table) -> pa.Table:
        dim = table["dim"][0].as_py()
        cells = _matrix(table, "v", dim)
        order, nodes, longest = build_tree(cells)
        ids = table["vec_id"].to_numpy()[order].astype("<i8")
        return pa.table({"dim": pa.array([dim], pa.int32()), "shard": table["shard"][:1], "n": pa.array([len(ids)]), "longest": [longest],
                         "vec_ids": [ids.tobytes()], "cells": [cells[order].tobytes()], "nodes": [nodes.tobytes()]})

    return keep(dealt.groupBy("dim", "shard").applyInArrow(build, _TREES), "trees")


def search(index: DataFrame, queries: DataFrame, k: int = 20, factor: float = FACTOR) -> DataFrame:
    """:func:`nearest` over the trees of ``index``."""
    shards = 1 + (index.agg(F.max("shard")).head()[0] or 0)
    asked = keep(_vectors(queries).withColumn("query", F.monotonically_increasing_id()), "queries")
    groups = max(1, -(-asked.count() // QUERY_GROUP))
    each = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n - 1).cast("long")))
    left = index.withColumn("group", each(groups))
    right = asked.withColumn("group", F.pmod(F.xxhash64("query"), F.lit(groups))).withColumn("shard", each(shards))

    def run(tree: pa.Table, group: pa.Table) -> pa.Table:
        out: list[pa.Table] = []
        if tree.num_rows and group.num_rows:
            dim = tree["dim"][0].as_py()
            names, own = group["query"].to_numpy(), group["vec_id"].to_numpy()
            asked = _matrix(group, "v", dim)
            row = tree.slice(0, 1).to_pylist()[0]
            cells = np.frombuffer(row["cells"]).reshape(row["n"], dim)
            found = _Nearest(asked, own, cells, np.frombuffer(row["vec_ids"], "<i8"), row["longest"], k)
            search_tree(np.frombuffer(row["nodes"], _NODE), found, factor)
            q, place = np.nonzero(found.scores > -np.inf)
            out.append(pa.table({"query": names[q], "query_id": own[q], "vec_id": found.found[q, place], "score": found.scores[q, place]}))
        return pa.concat_tables([_FOUND.empty_table(), *out])

    found = left.groupBy("dim", "shard", "group").cogroup(right.groupBy("dim", "shard", "group")).applyInArrow(
        run, "query long, query_id long, vec_id long, score double")
    order = Window.partitionBy("query_id", "query").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def nearest(rows: DataFrame, queries: DataFrame, k: int = 20, factor: float = FACTOR) -> DataFrame:
    """``query_id, rank, vec_id, score``: for each row of ``queries(vec_id,
    embedding, ...)`` the ``k`` rows of the same length with the largest inner
    product found (in double precision), ties to the smaller vec_id; with
    ``factor`` 1 the search is exact.

    Rows whose vec_id is null, or whose vector is null, empty, zero or holds a
    null or non-finite component, take no part. Repeated rows count once; rows
    that share the query's vec_id are no candidates; a vec_id with several
    vectors is a candidate, and a query, with each. A vector whose squared norm
    is beyond doubles takes no part. Other columns are not read; empty tables
    give no rows."""
    return search(trees(rows), queries, k, factor)
