"""Index matches against brute force; the SQL of the query is the oracle for
whole tables."""

import hashlib
import re

from eventloom.llm.decontaminate import contamination, find_windows

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def brute(docs, items):
    out = []
    for doc_id, text in docs:
        w, hit, names = words(text), set(), set()
        for item_id, passage in items:
            p = words(passage)
            n = min(10, len(p))
            for s in range(len(p) - n + 1 if p else 0):
                for at in range(len(w) - n + 1):
                    if w[at : at + n] == p[s : s + n]:
                        hit |= set(range(at, at + n))
                        names.add(item_id)
        names = sorted(str(x) for x in names if x is not None)
        out.append((doc_id, len(w), len(hit), len(names), hashlib.sha256(",".join(names).encode()).hexdigest(), bool(hit)))
    return out


def ordered(rows):
    return sorted(map(tuple, rows), key=lambda r: tuple((x is None, x) for x in r))


def test_messy_rows_match_brute_force(spark, messy):
    texts = [r.text for r in messy.collect()]
    items = [(1, " ".join(texts[0].split()[5:30])), (1, " ".join(texts[0].split()[5:30])), (2, "one two"), (10, texts[0].upper()),
             (3, None), (4, ""), (5, "never seen words in any of the texts at all here"), (None, texts[0]), (6, "pi"), (7, "é漢字 " * 12), (12, texts[9])]  # texts[9] has no doc_id
    bench = spark.createDataFrame([(*i, 1, "w") for i in items], "item_id long, text string, at int, word string")
    got = contamination(messy, bench).collect()
    assert ordered(got) == ordered(brute([(r.doc_id, r.text) for r in messy.collect()], items))


def test_common_words_and_overlapping_windows(spark):
    docs = [(i, " ".join(["the of and"] * 20) + f" own{i}") for i in range(5)] + [(9, "a b " * 8)]
    items = [(1, "the of and " * 5), (2, "b a " * 7)]
    got = contamination(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")).collect()
    assert ordered(got) == ordered(brute(docs, items))


def test_empty_tables(spark, messy, empty_docs):
    bench = spark.createDataFrame([(1, "a b c")], "item_id long, text string")
    assert contamination(empty_docs, bench).count() == 0
    assert not [r for r in contamination(messy, bench.where("false")).collect() if r.contaminated]


def test_proximity_takes_words_out_of_place(spark):
    docs = spark.createDataFrame([(1, "x red green extra blue y"), (2, "red green blue"), (3, "red q q q q green blue")], "doc_id long, text string")
    bench = spark.createDataFrame([(1, "red green blue")], "item_id long, text string")
    found = lambda slop: sorted(r.key.id for r in find_windows(docs, bench, slop=slop).select("key").distinct().collect())
    assert found(0) == [2]
    assert found(1) == [1, 2]
