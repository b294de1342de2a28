"""The registered queries on the smallest driver tables, and the pipeline against its stages."""

import hashlib
import os

import pytest

duckdb = pytest.importorskip("duckdb")

import __spark_entry__ as entry_points
import corpus_pipeline
from evrange.llm import queries

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables not present")


@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_sql(spark, name):
    duck = duckdb.connect()
    for file in os.listdir(SF):
        duck.execute(f"CREATE VIEW {file.removesuffix('.parquet')} AS SELECT * FROM '{SF}/{file}'")
    df = queries.QUERIES[name](spark, SF)
    columns = sorted(df.columns)
    want = duck.execute(f"SELECT {', '.join(columns)} FROM ({queries.SQL[name]})").fetchall()
    assert sorted(map(repr, want)) == sorted(repr(tuple(r[c] for c in columns)) for r in df.collect()) and want


def test_every_operator_is_registered():
    names = entry_points.queries()
    assert all(any(n.startswith(f"op{k}_") for n in names) for k in range(1, 11)) and "pipeline" in names


def test_pipeline_is_its_stages(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    names = docs.columns
    counts = [docs.count()]
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, SF).write.parquet(str(tmp_path / str(k)))
        docs = spark.read.parquet(str(tmp_path / str(k)))
        counts.append(docs.count())
        if k < len(corpus_pipeline.STAGES) - 1:
            assert docs.columns == names
    assert counts == sorted(counts, reverse=True) and 0 < counts[-1] < counts[0]
    run = corpus_pipeline.run(spark, SF).collect()
    digest = lambda rows: sorted((r.doc_id, r.text, hashlib.sha256(bytes(r.ids)).hexdigest()) for r in rows)
    assert digest(run) == digest(docs.collect())
    assert all(bytes(r.decoded) == r.text.encode() and r.n_chars == len(r.text) for r in run)
