"""The registered queries against their SQL, and the pipeline against a brute-force version of each stage."""

import hashlib

import duckdb
import pytest

import corpus_pipeline
from registrar.llm import quality
from registrar.llm.queries import QUERIES, SQL

TABLES = ["documents", "pages", "benchmark", "labels", "embeddings"]


@pytest.fixture(scope="module")
def duck(sf_dir):
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{table}.parquet'")
    return connection


def test_one_query_for_each_operator():
    assert sorted(int(q[2:].split("_")[0]) for q in QUERIES) == list(range(1, 14)) and set(SQL) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_sql(spark, sf_dir, duck, name):
    df = QUERIES[name](spark, sf_dir)
    cursor = duck.execute(SQL[name])
    names = [c[0] for c in cursor.description]
    assert sorted(df.columns) == sorted(names)
    columns = sorted(names)
    got = sorted(repr([r[c] for c in columns]) for r in df.collect())
    expected = sorted(repr([r[names.index(c)] for c in columns]) for r in cursor.fetchall())
    assert got == expected and got


def test_pipeline_stages(spark, sf_dir):
    from test_llm_operators import earlier_bytes, hits, jaccard_truth, reference_ids

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    (_, first), (_, second), (_, third), (_, fourth), (_, last) = corpus_pipeline.STAGES
    reread = lambda df: spark.createDataFrame(df.collect(), df.schema)
    texts = lambda df: sorted((r.doc_id, r.text) for r in df.collect())

    good = reread(first(spark, docs, sf_dir))
    scores = quality.score(docs, quality.learn(docs, labels)).filter("predicted = 1")
    assert good.columns == docs.columns and texts(good) == texts(scores)

    one = reread(second(spark, good, sf_dir))
    truth = jaccard_truth(texts(good))
    assert one.columns == docs.columns
    assert sorted(r.doc_id for r in one.collect()) == sorted({c for c, _ in truth.values()})

    cut = reread(third(spark, one, sf_dir))
    truth = earlier_bytes([(i, t.encode()) for i, t in texts(one)])
    left = dict(texts(cut))
    assert cut.columns == docs.columns and all(r.n_chars == len(r.text) for r in cut.collect())
    for i, text in texts(one):
        n_bytes, removed, spans, digest = truth[i]
        if not removed:
            assert left[i] == text
        elif removed == n_bytes:
            assert i not in left
        elif i in left and hashlib.sha256(left[i].encode()).hexdigest() != digest:
            assert n_bytes - removed - 6 * spans <= len(left[i].encode()) < n_bytes - removed

    clean = reread(fourth(spark, cut, sf_dir))
    items = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").select("item_id", "text").collect()]
    kept = {r.doc_id for r in clean.collect()}
    assert clean.columns == docs.columns and all((i in kept) == (not hits(t, items)[4]) for i, t in texts(cut))

    rows = last(spark, clean, sf_dir).collect()
    _, ids = reference_ids([dict(texts(clean))[r.doc_id] for r in rows])
    assert [r["ids"] for r in rows] == ids and len(rows) == len(kept)


def test_pipeline_run(spark, sf_dir):
    rows = corpus_pipeline.run(spark, sf_dir).collect()
    assert rows and all(r.n_tokens == len(r["ids"]) for r in rows)
