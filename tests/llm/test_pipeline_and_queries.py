import duckdb
import pandas as pd
import pytest

import __spark_entry__ as entry
import corpus_pipeline
from adtally.llm import jaccard, mixing, passages, queries

SF = "/root/testdata/sf0.001"


def test_all_queries():
    assert sorted(int(n[2:].split("_")[0]) for n in queries.QUERIES) == list(range(1, 14))
    assert {*queries.QUERIES, "pipeline"} <= set(entry.queries()) and set(queries.ORACLE) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", sorted(queries.ORACLE))
def test_query_against_sql(spark, name):
    got = queries.QUERIES[name](spark, SF).toPandas()
    con = duckdb.connect()
    for table in ("documents", "benchmark", "conversations", "embeddings", "pages"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF}/{table}.parquet'")
    expected = con.sql(queries.ORACLE[name]).df()
    columns = sorted(expected.columns)
    assert sorted(got.columns) == columns
    # A column of nulls alone has no type of its own in pandas.
    tidy = lambda d: d[columns].astype(object).where(d[columns].notna(), "null").astype(str).sort_values(columns).reset_index(drop=True)
    pd.testing.assert_frame_equal(tidy(got), tidy(expected))


def test_pipeline_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns = docs.columns
    before = {r.doc_id: r for r in docs.collect()}
    toxic = {r[0] for r in spark.read.parquet(f"{SF}/labels.parquet").filter("toxic = 1").select("doc_id").collect()}
    kept = corpus_pipeline.toxicity(spark, docs, SF)
    ids = {r.doc_id for r in kept.select("doc_id").collect()}
    gone = set(before) - ids
    assert kept.columns == columns and gone and len(gone & toxic) >= 0.9 * len(gone)

    linked = {r.doc_id: r.component_id for r in corpus_pipeline.jaccard.linked_documents(docs).collect()}
    assert {r.doc_id for r in corpus_pipeline.near_duplicates(spark, docs, SF).select("doc_id").collect()} == {i for i, c in linked.items() if i == c}

    bad = {r.doc_id for r in queries.QUERIES["op2_decontamination"](spark, SF).filter("contaminated").collect()}
    clean = corpus_pipeline.decontamination(spark, docs, SF)
    assert {r.doc_id for r in clean.select("doc_id").collect()} == set(before) - bad and clean.columns == columns

    taken = {r.doc_id: r.taken for r in mixing.mix(docs).collect()}
    rows = corpus_pipeline.mixed(spark, docs, SF)
    words = {}
    for r in rows.collect():
        words[r.doc_id] = words.get(r.doc_id, 0) + len(r.text.split())
    assert rows.columns == columns and words == {i: n for i, n in taken.items() if n}

    assert corpus_pipeline.sharded(spark, docs, SF).columns == [*columns, "shard"]


def test_pipeline_runs_and_stages_take_odd_rows(spark):
    got = corpus_pipeline.run(spark, SF)
    assert got.columns[-1] == "shard" and got.count() > 100
    docs = spark.createDataFrame([(None, None, None, None, None), (1, "", "en", "a", 0), (1, "", "en", "a", 0), (2, "some words of a text", "en", None, 20)],
                                 "doc_id long, text string, lang string, source string, n_chars long")
    for frame in (docs, docs.limit(0)):
        for _, stage in corpus_pipeline.STAGES:
            stage(spark, frame, SF).collect()
    assert corpus_pipeline.decontamination(spark, docs, SF).count() == 4 and corpus_pipeline.near_duplicates(spark, docs, SF).count() == 4


def test_verdicts_are_on_rows(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    kind = "doc_id long, text string, lang string, source string, n_chars long"
    texts = {r.doc_id: r.text for r in docs.collect()}
    clean = "a few plain words about the weather in the hills this morning and no more than that"
    for stage in (corpus_pipeline.toxicity, corpus_pipeline.decontamination):
        left = {r.doc_id for r in stage(spark, docs, SF).select("doc_id").collect()}
        bad = min(set(texts) - left)
        odd = docs.unionAll(spark.createDataFrame([(None, texts[bad], "en", "a", 1), (bad, clean, "en", "a", 2), (None, clean, "en", "a", 3)], kind))
        got = stage(spark, odd, SF).collect()
        assert {r.doc_id for r in got if r.doc_id is not None and r.text != clean} == left
        assert sorted((r.doc_id is None, r.n_chars) for r in got if r.text == clean) == [(False, 2), (True, 3)]
        assert not any(r.text == texts[bad] for r in got)


def test_one_row_of_each_component_stays(spark):
    long = " ".join(f"w{i}" for i in range(60))
    near, other = long.replace("w59", "x"), " ".join(f"v{i}" for i in range(60))
    rows = [(7, long), (7, long), (7, near), (None, near), (9, near), (7, other), (None, other), (None, "null only one " + other.upper()),
            (None, " ".join(f"u{i}" for i in range(60))), (None, " ".join(f"u{i}" for i in range(59))), (None, ""), (None, None), (3, " \n")]
    docs = spark.createDataFrame([(k, t, "en", "a", i) for i, (k, t) in enumerate(rows)], "doc_id long, text string, lang string, source string, n_chars long")
    got = [(r.doc_id, r.text) for r in corpus_pipeline.near_duplicates(spark, docs.repartition(3), SF).collect()]
    of = lambda word: [(k, len(t.split())) for k, t in got if t and word in t.split()]
    assert [k for k, _ in of("w0")] == [7] and of("v0") == [(7, 60)] and len(of("u0")) == 1
    assert len(got) == 6


def test_links_by_texts_without_a_key(spark):
    a = [f"w{i}" for i in range(80)]
    b = [*a[:-3], "x1", "x2", "x3"]
    kind = "doc_id long, text string"
    rows = [(1, " ".join(a)), (None, " ".join(b))]
    got = jaccard.linked_documents(spark.createDataFrame(rows, kind)).collect()
    assert {r.component_id for r in got} == {1}
    got = passages.repeated_passages(spark.createDataFrame(rows, kind)).collect()
    assert {r.class_id for r in got} == {1} and all(r.n_links == 1 for r in got)
