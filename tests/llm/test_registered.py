"""The registered corpus queries and the pipeline on the smallest tables."""

from pathlib import Path

import duckdb
import pytest

from kinetrail.llm import queries

DATA = Path("/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not DATA.exists(), reason="no test tables")


@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_sql_agrees(spark, name):
    con = duckdb.connect()
    for t in ("documents", "conversations", "labels", "benchmark", "pages"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{DATA}/{t}.parquet')")
    cursor = con.execute(queries.ORACLE_SQL[name])
    names = [d[0] for d in cursor.description]
    got = queries.QUERIES[name](spark, str(DATA)).select(*names).collect()
    assert sorted(map(repr, map(tuple, got))) == sorted(map(repr, cursor.fetchall()))


def test_ten_operators_are_registered():
    assert sorted(int(x[2:].split("_")[0]) for x in queries.QUERIES) == list(range(1, 11))


def test_pipeline(spark):
    import corpus_pipeline

    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    every = {r.doc_id for r in docs.collect()}
    sizes, rows = [len(every)], docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, rows, str(DATA))
        assert sorted(out.columns) == sorted(docs.columns), name
        rows = spark.createDataFrame(out.collect(), out.schema)
        sizes.append(rows.count())
    assert sizes == sorted(sizes, reverse=True) and sizes[-1] > len(every) // 2
    last = corpus_pipeline.run(spark, str(DATA)).collect()
    assert {r.doc_id for r in last} == {r.doc_id for r in rows.collect()}
    import hashlib

    texts = {r.doc_id: r.text for r in rows.collect()}
    assert all(r.decoded_sha256 == hashlib.sha256(texts[r.doc_id].encode()).hexdigest() for r in last)
