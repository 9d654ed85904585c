"""Near duplicates against brute force over all pairs."""

import numpy as np
import pytest

from eventloom.llm.components import connected_components
from eventloom.llm.near_dedup import near_duplicates, shingle_set


def brute(rows, percent):
    """Per row: (shingles, component_id) by comparing all pairs of words."""
    sets = []
    for _, text in rows:
        words = (text or "").encode().lower().split()
        sets.append({tuple(words[i : i + 5]) for i in range(len(words) - 4)} if len(words) >= 5 else ({tuple(words)} if words else set()))
    comp = list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            a, b = sets[i], sets[j]
            if a and b and 100 * len(a & b) >= percent * len(a | b) and comp[i] != comp[j]:
                old, new = comp[i], comp[j]
                comp = [new if c == old else c for c in comp]
    low = {}
    for (doc_id, _), c in zip(rows, comp):
        if doc_id is not None:
            low[c] = min(low.get(c, doc_id), doc_id)
    return [(d, len(s), low.get(c) if s else d) for (d, _), s, c in zip(rows, sets, comp)]


def rows_of(df):
    key = lambda r: tuple((x is None, x) for x in r)
    return sorted([(r.doc_id, r.n_shingles, r.component_id) for r in df.collect()], key=key)


@pytest.mark.parametrize("percent", [85, 80])
def test_messy_rows_match_brute_force(messy, percent):
    want = brute([(r.doc_id, r.text) for r in messy.collect()], percent)
    got = near_duplicates(messy, percent)
    assert rows_of(got) == sorted(want, key=lambda r: tuple((x is None, x) for x in r))
    assert all(r.kept == (r.doc_id == r.component_id) for r in got.collect())


def test_chains_and_a_large_group_with_edges_near_the_threshold(spark):
    rng = np.random.default_rng(3)
    base = [f"w{i}" for i in range(120)]
    rows = []
    for i in range(150):  # one group whose members are about as similar as the threshold
        words = list(base)
        for at in rng.choice(120, rng.integers(0, 4), replace=False):
            words[at] = f"x{rng.integers(1000)}"
        rows.append((i, " ".join(words)))
    rows += [(1000 + i, " ".join(f"c{j}" for j in range(i, i + 200))) for i in range(0, 60, 3)]  # a chain
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert rows_of(near_duplicates(docs)) == sorted(brute(rows, 85))


def test_empty_table(empty_docs):
    assert near_duplicates(empty_docs).count() == 0


def test_components_of_paths_and_stars(spark):
    links = [(i, i + 1) for i in range(1, 30)] + [(100, 100 + i) for i in range(1, 20)] + [(7, 7)]
    got = {r.node: r.comp for r in connected_components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {**{i: 1 for i in range(1, 31)}, **{100 + i: 100 for i in range(20)}}
    assert connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_shingle_sets_are_case_blind_for_ascii_only():
    assert (shingle_set("ONE  two") == shingle_set("one\ttwo")).all()
    assert (shingle_set("É a b") != shingle_set("é a b")).any()
