"""Quality classifier: a sparse rule ensemble.

Statistics of every whole text are computed once. A bounded sample of labelled
training rows (statistics and labels only) goes to the driver, where shallow
boosted trees are grown; every tree path becomes a conjunctive rule over the
statistics, lasso logistic regression keeps few of them, and the kept rules are
compiled into one Spark column expression that scores the whole table.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventloom.llm.common import fold, keep, small_batches, text_hash

STATS = (
    "log_chars", "symbols", "upper", "digits", "pipes", "ends", "commas", "word_chars", "distinct", "repeats", "short",
    "long", "top_word", "line_words", "line_distinct", "marked",
)
#: Labelled rows that the driver learns from, the smallest hashes of doc_id.
SAMPLE_ROWS = 20_000

_SYMBOLS = np.zeros(256, bool)
_SYMBOLS[[c for c in range(33, 127) if not chr(c).isalnum() and chr(c) not in ".,'\"-()?:;"]] = True


def statistics(text: str | None) -> list[float]:
    """Shares and means of a text; an empty one has zeros."""
    raw = (text or "").encode("utf-8", "surrogatepass")
    words = raw.split()
    if not words:
        return [0.0] * len(STATS)
    n, nw = len(raw), len(words)
    count = np.bincount(np.frombuffer(raw, np.uint8), minlength=256)
    freq: dict[bytes, int] = {}
    for w in words:
        freq[w] = freq.get(w, 0) + 1
    lengths = np.fromiter(map(len, words), np.int64, nw)
    lines = raw.split(b"\n")
    return [
        float(np.log10(n)), count[_SYMBOLS].sum() / n, count[65:91].sum() / n, count[48:58].sum() / n, count[124] / nw,
        (count[46] + count[33] + count[63]) / nw, count[44] / nw, float(lengths.mean()), len(freq) / nw,
        sum(map(bytes.__eq__, words, words[1:])) / nw, float((lengths <= 3).mean()), float((lengths >= 12).mean()),
        max(freq.values()) / nw, nw / len(lines), len(set(lines)) / len(lines),
        sum(not w[-1:].isalnum() and w[-1] < 128 for w in words) / nw,
    ]


def text_statistics(docs: DataFrame, hashed: bool = False) -> DataFrame:
    """``doc_id`` and the statistics, one row per row of ``docs``; ``hashed``
    adds ``text_hash``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = np.array([statistics(x) for x in batch.column(1).to_pylist()], float).reshape(-1, len(STATS))
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(c) for c in rows.T), *batch.columns[2:]], ["doc_id", *STATS, *extra])

    extra = ["text_hash"] if hashed else []
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), *([text_hash()] if hashed else [])).mapInArrow(
        run, ", ".join(["doc_id long", *(f"{s} double" for s in STATS), *(f"{x} long" for x in extra)]))


Rule = tuple[tuple[int, bool, float], ...]  # (statistic, True: above or False: at most, threshold)


def _covers(rule: Rule, x: np.ndarray) -> np.ndarray:
    return np.logical_and.reduce([(x[:, j] > t) == above for j, above, t in rule])


def _tree(x: np.ndarray, bins: np.ndarray, cuts: list[np.ndarray], grad: np.ndarray, depth: int) -> list[tuple[Rule, np.ndarray]]:
    """Regression tree on ``grad``: all its paths with their rows."""
    out, todo = [], [((), np.arange(len(x)))]
    for _ in range(depth):
        nxt = []
        for rule, rows in todo:
            if len(rows) < 20:
                continue
            g, best = grad[rows], (1e-9, None)
            for j, cut in enumerate(cuts):
                n = np.bincount(bins[rows, j], minlength=len(cut) + 1)[:-1].cumsum()
                s = np.bincount(bins[rows, j], g, minlength=len(cut) + 1)[:-1].cumsum()
                ok = (n >= 5) & (len(rows) - n >= 5)
                if ok.any():
                    gain = np.where(ok, s**2 / np.maximum(n, 1) + (g.sum() - s) ** 2 / np.maximum(len(rows) - n, 1), -1) - g.sum() ** 2 / len(rows)
                    if gain.max() > best[0]:
                        best = (gain.max(), (j, int(gain.argmax())))
            if best[1]:
                j, k = best[1]
                right = bins[rows, j] > k
                for above in (False, True):
                    nxt.append(((*rule, (j, above, float(cuts[j][k]))), rows[right == above]))
        out += nxt
        todo = nxt
    return out


def learn_rules(x: np.ndarray, y: np.ndarray, trees: int = 24, depth: int = 3, penalty: float = 2e-3) -> tuple[float, list[tuple[Rule, float]]]:
    """``(intercept, [(rule, weight)])`` by boosted trees and lasso logistic
    regression; without both classes only an intercept."""
    if not len(y) or y.min() == y.max():
        p = (y.sum() + 1) / (len(y) + 2) if len(y) else 0.5
        return float(np.log(p / (1 - p))), []
    cuts = [np.unique(np.quantile(c, np.linspace(0.02, 0.98, 33))) for c in x.T]
    bins = np.stack([np.searchsorted(c, v, side="left") for c, v in zip(cuts, x.T, strict=True)], axis=1)
    f, rules = np.full(len(y), np.log(y.mean() / (1 - y.mean()))), {}
    rng = np.random.default_rng(7)
    for _ in range(trees):
        grad = y - 1 / (1 + np.exp(-f))
        some = np.sort(rng.choice(len(y), max(1, int(len(y) * 0.7)), replace=False))
        paths = _tree(x[some], bins[some], cuts, grad[some], depth)
        leaves = [r for r, _ in paths if len(r) == max(len(p) for p, _ in paths)]
        for rule, _ in paths:
            rules.setdefault(tuple(sorted(rule)), None)
        for rule in leaves:
            rows = _covers(rule, x)
            p = 1 / (1 + np.exp(-f[rows]))
            if rows.any():
                f[rows] += 0.3 * np.clip((y[rows] - p).sum() / max((p * (1 - p)).sum(), 1e-3), -4, 4)
    names = list(rules)
    a = np.stack([_covers(r, x) for r in names], axis=1).astype(float)
    keep_cols = (a.std(axis=0) > 0).nonzero()[0]
    a, names = a[:, keep_cols], [names[i] for i in keep_cols]
    a1 = np.column_stack([np.ones(len(a)), a])
    w = z = np.zeros(a1.shape[1])
    step, t = 4 * len(a) / np.linalg.norm(a1, 2) ** 2, 1.0
    for _ in range(300):
        g = a1.T @ (1 / (1 + np.exp(-a1 @ z)) - y) / len(y)
        new = z - step * g
        new[1:] = np.sign(new[1:]) * np.maximum(np.abs(new[1:]) - step * penalty, 0)
        t2 = (1 + np.sqrt(1 + 4 * t * t)) / 2
        z, w, t = new + (t - 1) / t2 * (new - w), new, t2
    return float(w[0]), [(r, float(v)) for r, v in zip(names, w[1:], strict=True) if abs(v) > 1e-6]


def compiled(intercept: float, rules: list[tuple[Rule, float]]) -> Column:
    """The score as one column expression over the statistics."""
    total = F.lit(intercept)
    for rule, weight in rules:
        holds = F.lit(True)
        for j, above, t in rule:
            holds = holds & ((F.col(STATS[j]) > t) if above else (F.col(STATS[j]) <= t))
        total = total + F.when(holds, F.lit(weight)).otherwise(F.lit(0.0))
    return 1 / (1 + F.exp(-total))


def score_quality(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS, hashed: bool = False) -> DataFrame:
    """``doc_id, held_out, score, predicted`` for each row of ``docs(doc_id,
    text, ...)``, learned from ``labels(doc_id, quality, ...)`` outside the
    held-out third (crc32 of the doc_id's text modulo 3 is 1).

    Null and empty texts are scored like any other, on zero statistics. Labels
    that are null are ignored, several of one document averaged; repeated rows
    each get their row. Without labels of both classes all texts get the share
    of label 1 seen (0.5 for none). Empty tables give no rows. ``hashed`` adds
    the row's ``text_hash``."""
    stats = keep(text_statistics(small_batches(docs), hashed), "statistics")
    truth = (labels.where("doc_id IS NOT NULL AND quality IS NOT NULL").where(fold(F.col("doc_id"), 3) != 1)
             .groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg((F.avg("quality") >= 0.5).cast("double").alias("y")))
    marked = keep(stats.join(truth, "doc_id").withColumn("at", F.xxhash64("doc_id")), "labelled")
    # Only hashes that can be among the smallest are sorted and sent.
    share = 2 * sample_rows / max(1, marked.count())
    some = marked if share >= 1 else marked.where(F.col("at") < F.lit(int(-(2**63) + share * 2**64)))
    sample = some.orderBy("at", "doc_id", *STATS).limit(sample_rows).select(*STATS, "y").toPandas()
    intercept, rules = learn_rules(sample[list(STATS)].to_numpy(float), sample["y"].to_numpy(float))
    return (stats.withColumn("score", compiled(intercept, rules))
            .select("doc_id", (fold(F.col("doc_id"), 3) == 1).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"),
                    *(["text_hash"] if hashed else [])))
