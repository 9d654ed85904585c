"""The pipeline stage by stage against what each stage's operator decides, and
the registered queries against their SQL."""

import duckdb
import pytest

import corpus_pipeline as P
from eventloom.llm import queries as Q
from eventloom.llm.decontaminate import contamination
from eventloom.llm.near_dedup import near_duplicates
from eventloom.llm.quality import score_quality
from eventloom.llm.secrets import redacted, scan

SF = "/root/testdata/sf0.001"


def rows(df):
    return sorted((r.doc_id, r.text) for r in df.collect())


def test_stages_take_effect_in_order(spark):
    assert [n for n, _ in P.STAGES] == ["quality", "near_dedup", "decontamination", "secrets", "packing"]
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns = docs.columns
    labels, bench = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("labels", "benchmark"))
    texts = dict(rows(docs))

    good = {r.doc_id for r in score_quality(docs, labels).where("predicted = 1").collect()}
    kept = P.quality(spark, docs, SF)
    assert kept.columns == columns and dict(rows(kept)) == {d: texts[d] for d in good} and len(good) < len(texts)

    once = {r.doc_id for r in near_duplicates(kept, P.NEAR_PERCENT).where("kept").collect()}
    kept2 = P.near_dedup(spark, kept, SF)
    assert kept2.columns == columns and {d for d, _ in rows(kept2)} == once and len(once) < len(good)

    dirty = {r.doc_id for r in contamination(kept2, bench).where("contaminated").collect()}
    kept3 = P.decontaminate(spark, kept2, SF)
    assert kept3.columns == columns and {d for d, _ in rows(kept3)} == once - dirty

    clean = P.secrets(spark, kept3, SF)
    assert clean.columns == columns
    assert rows(clean) == sorted((d, redacted(t)) for d, t in rows(kept3))
    assert not any(scan(t)[0] for _, t in rows(clean)) and all(r.n_chars == len(r.text) for r in clean.collect())

    packed = P.packing(spark, clean, SF)
    assert {r.doc_id for r in packed.select("doc_id").distinct().collect()} == {d for d, _ in rows(clean)}


def test_empty_and_messy_documents_pass_all_stages(spark, messy):
    docs = messy.selectExpr("doc_id", "text", "CAST(NULL AS STRING) AS lang", "source", "n_chars")
    for start in (docs.where("false"), docs):
        now = start
        for _, stage in P.STAGES:
            now = stage(spark, now, SF)
        assert now.count() >= 0


def test_rows_without_or_with_shared_ids_go_by_their_own_text(spark, messy, tmp_path):
    item = " ".join(f"bench{i}" for i in range(12))
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    clean = [(None, "a clean text of its own without an id"), (None, "another clean one that also has no id here"), (5, "shares its id with a dropped row of another text")]
    docs = spark.createDataFrame([*clean, (None, f"x {item} y"), (5, f"z {item}")], "doc_id long, text string")
    by = lambda r: (r[0] is None, r[0] or 0, r[1] is not None, r[1] or "")
    assert sorted(map(tuple, P.decontaminate(spark, docs, str(tmp_path)).collect()), key=by) == sorted(clean, key=by)
    copies = spark.createDataFrame([*clean, (3, clean[0][1]), (2, clean[2][1])], "doc_id long, text string")
    assert sorted(map(tuple, P.near_dedup(spark, copies, "").collect()), key=by) == sorted([(3, clean[0][1]), clean[1], (2, clean[2][1])], key=by)
    rows = {(r.doc_id, r.text) for r in messy.select("doc_id", "text").collect()}
    got = [(r.doc_id, r.text) for r in P.near_dedup(spark, messy, "").collect()]
    near = {r for r in rows if r[0] in (2, 3, 8)}
    assert sorted(got, key=by) == sorted(rows - near, key=by)


@pytest.mark.parametrize("name", sorted(Q.ORACLE))
def test_queries_equal_their_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "benchmark", "embeddings"):
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    want = con.sql(Q.ORACLE[name]).df()
    got = Q.QUERIES[name](spark, SF).toPandas()
    columns = sorted(want.columns)
    assert columns == sorted(got.columns)
    assert sorted(map(tuple, got[columns].astype(str).values)) == sorted(map(tuple, want[columns].astype(str).values))
