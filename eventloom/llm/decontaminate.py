"""Benchmark decontamination with a positional inverted index, in DataFrame
functions only.

Corpus postings ``(document, position, term)`` are met with the benchmark's
terms: a posting at position p of a term that an item has at position i speaks
for the diagonal ``p - i``. For each window of an item only its rarest terms
(by corpus count) are looked up; a window is a candidate where all of them meet
on one diagonal (lists intersected after adjusting by the offset), and it is
then confirmed on the document's words. A window with a term that the corpus
lacks cannot match and is not looked up. Postings are made from the texts as
they are read and filtered to the looked-up terms before any shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventloom.llm.common import keep, lower_ascii, sized

#: Word separators of the contract: ASCII outside 0-9 and letters.
NOT_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
WINDOW = 10
RAREST = 3


def words_of(text: Column) -> Column:
    return F.array_remove(F.split(lower_ascii(F.coalesce(text.cast("string"), F.lit(""))), NOT_WORD), "")


def _documents(docs: DataFrame) -> DataFrame:
    """A row's key is its doc_id with a hash of its text, so rows that share a
    doc_id (or have none) stay apart and equal rows share their result."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    return docs.select(F.col("doc_id"), F.struct(F.col("doc_id").alias("id"), F.xxhash64(text).alias("hash")).alias("key"),
                       text.alias("text"))


def _windows(benchmark: DataFrame, window: int) -> DataFrame:
    """``(item, item_id, words, starts, length)``, one row per distinct item with words."""
    items = benchmark.select("item_id", words_of(F.col("text")).alias("words")).where(F.size("words") > 0).distinct()
    length = F.least(F.size("words"), F.lit(window))
    return items.withColumn("item", F.monotonically_increasing_id()).withColumn("length", length).withColumn(
        "starts", F.sequence(F.lit(0), F.size("words") - length))


def find_windows(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, slop: int = 0) -> DataFrame:
    """``(key, item_id, at, start, length)``: occurrences in ``docs(doc_id,
    text, ...)`` of windows of ``window`` consecutive words of ``benchmark(item_id,
    text, ...)``; an item with fewer words is one window. ``at`` is the place in
    the document, ``start`` that in the item, ``key`` the document's key.

    ``slop`` 0 finds exact phrases. With a larger one, proximity matches: the
    window's rarest word stands at its place and each other word at most
    ``slop`` words from its own. Null texts and empty tables give no rows;
    repeated rows give their occurrences once.
    """
    items = keep(_windows(benchmark, window), "items")
    terms = items.select(F.explode(F.array_distinct("words")).alias("word")).distinct()
    corpus = _documents(docs)
    counts = (corpus.select(F.explode(words_of(F.col("text"))).alias("word"))
              .join(sized(keep(terms, "terms")), "word").groupBy("word").agg(F.count("*").alias("freq")))
    counts = keep(counts, "counts")

    each = (items.select("item", "length", "words", F.explode("starts").alias("start"))
            .select("item", "start", F.posexplode(F.slice("words", F.col("start") + 1, F.col("length"))).alias("i", "word"))
            .join(sized(counts), "word", "left"))
    picked = (each.groupBy("item", "start")
              .agg(F.sort_array(F.collect_list(F.struct("freq", (F.col("start") + F.col("i")).alias("place"), "word"))).alias("s"))
              .where(F.col("s")[0]["freq"].isNotNull()).withColumn("s", F.slice("s", 1, RAREST)))
    picked = keep(picked.select("item", "start", F.col("s.place").alias("places"), F.col("s.word").alias("rare")), "picked")
    lookups = keep(picked.select("item", F.explode(F.arrays_zip("places", "rare")).alias("x"))
                   .select("item", F.col("x.places").alias("place"), F.col("x.rare").alias("word")).distinct(), "lookups")

    postings = corpus.select("key", F.posexplode(words_of(F.col("text"))).alias("at", "word"))
    met = postings.join(sized(lookups), "word").select("key", "item", "place", (F.col("at") - F.col("place")).alias("diagonal"))
    if slop:
        met = met.withColumn("off", F.explode(F.sequence(F.lit(-slop), F.lit(slop)))).select(
            "key", "item", "place", (F.col("diagonal") + F.col("off")).alias("diagonal"), "off")
    else:
        met = met.withColumn("off", F.lit(0))
    diagonals = (met.groupBy("key", "item", "diagonal")
                 .agg(F.collect_set("place").alias("near"), F.collect_set(F.when(F.col("off") == 0, F.col("place"))).alias("exact")))
    by_item = picked.groupBy("item").agg(F.min(F.size("places")).alias("least"), F.collect_list(F.struct("start", "places")).alias("windows"))
    candidates = (diagonals.join(sized(keep(by_item, "windows")), "item")
                  .where((F.size("near") >= F.col("least")) & (F.size("exact") > 0))
                  .withColumn("windows", F.filter("windows", lambda w: F.array_contains("exact", w["places"][0])
                              & (F.size(F.array_intersect(w["places"], "near")) == F.size(w["places"]))))
                  .where(F.size("windows") > 0)
                  .select("key", "item", "diagonal", F.col("windows").alias("windows")))
    candidates = keep(candidates, "candidates")
    per_doc = (candidates.join(sized(items.select("item", "item_id", "words", "length")), "item")
               .select("key", F.struct("item_id", "words", "length", "diagonal", "windows").alias("c")))
    ids = sized(keep(candidates.select("key").distinct(), "keys"))
    texts = corpus.join(ids, "key", "left_semi").select("key", "text").dropDuplicates(["key"])
    seen = (texts.withColumn("found", words_of(F.col("text"))).drop("text")
            .join(per_doc.groupBy("key").agg(F.collect_list("c").alias("c")), "key")
            .select("key", "found", F.explode("c").alias("c")))
    at = lambda w: F.col("c.diagonal") + w["start"]
    if slop:
        fits = lambda w: F.forall(F.sequence(F.lit(0), F.col("c.length") - 1), lambda i: F.array_contains(
            F.slice("found", F.greatest(at(w) + i - slop, F.lit(0)) + 1, F.lit(2 * slop + 1) + F.least(at(w) + i - slop, F.lit(0))),
            F.get(F.col("c.words"), w["start"] + i)))
    else:
        fits = lambda w: (at(w) >= 0) & (F.slice("found", F.greatest(at(w), F.lit(0)) + 1, F.col("c.length"))
                                         == F.slice(F.col("c.words"), w["start"] + 1, F.col("c.length")))
    return (seen.select("key", "c.item_id", F.col("c.length").alias("length"), F.col("c.diagonal").alias("diagonal"),
                        F.explode(F.filter(F.col("c.windows"), fits)).alias("w"))
            .select("key", "item_id", (F.col("diagonal") + F.col("w.start")).alias("at"), F.col("w.start").alias("start"), "length"))


def contamination(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, hashed: bool = False) -> DataFrame:
    """One row per row of ``docs``: ``doc_id, n_words, n_hit, n_items,
    items_sha256, contaminated``. A null or empty text has no words. Items
    without an id make hits but are not counted or named. Rows that share a
    doc_id each have their own result; an empty benchmark hits nothing.
    ``hashed`` adds the row's ``text_hash``."""
    found = keep(find_windows(docs, benchmark, window), "found")
    per_doc = found.groupBy("key").agg(
        F.size(F.array_distinct(F.flatten(F.collect_list(F.sequence("at", F.col("at") + F.col("length") - 1))))).alias("n_hit"),
        F.array_join(F.sort_array(F.collect_set(F.col("item_id").cast("string"))), ",").alias("items"),
        F.size(F.collect_set("item_id")).alias("n_items"))
    corpus = _documents(docs).select("doc_id", "key", F.size(words_of(F.col("text"))).cast("long").alias("n_words"))
    zero = lambda name: F.coalesce(F.col(name).cast("long"), F.lit(0)).alias(name)
    return (corpus.join(per_doc, corpus["key"].eqNullSafe(per_doc["key"]), "left")
            .select("doc_id", "n_words", zero("n_hit"), zero("n_items"),
                    F.sha2(F.coalesce("items", F.lit("")), 256).alias("items_sha256"),
                    (F.coalesce("n_hit", F.lit(0)) > 0).alias("contaminated"), *([corpus["key.hash"].alias("text_hash")] if hashed else [])))


CONTAMINATION_SQL = r"""
WITH d AS (
  SELECT row_number() OVER () AS rid, doc_id, regexp_extract_all(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (
  SELECT DISTINCT item_id, regexp_extract_all(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
win AS (
  SELECT DISTINCT item_id, least(len(w), 10) AS l, array_to_string(w[s + 1 : s + least(len(w), 10)], ' ') AS g
  FROM (SELECT item_id, w, unnest(range(0, greatest(len(w) - 10, 0) + 1)) AS s FROM b WHERE len(w) > 0)),
gram AS (
  SELECT rid, p, l, array_to_string(w[p + 1 : p + l], ' ') AS g
  FROM (SELECT rid, w, l, unnest(range(0, greatest(len(w) - l + 1, 0))) AS p FROM d, (SELECT DISTINCT l FROM win))),
hit AS (SELECT rid, p, l, item_id FROM gram JOIN win USING (l, g)),
pos AS (SELECT rid, count(DISTINCT q) AS n_hit FROM (SELECT rid, unnest(range(p, p + l)) AS q FROM hit) GROUP BY rid),
item AS (SELECT rid, count(*) AS n_items, string_agg(i, ',' ORDER BY i) AS items
  FROM (SELECT DISTINCT rid, CAST(item_id AS VARCHAR) AS i FROM hit) GROUP BY rid)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
  CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN pos USING (rid) LEFT JOIN item USING (rid)
"""
