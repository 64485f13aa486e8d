"""The registered queries against their SQL, and the pipeline."""
import duckdb
import pytest

import corpus_pipeline
from ledgerline.llm import base

SF = "/root/testdata/sf0.001"
base.load_all()


@pytest.mark.parametrize("name", sorted(base.ORACLES))
def test_query_equals_its_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "embeddings", "conversations", "pages", "labels"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    df = base.QUERIES[name](spark, SF)
    got = sorted(map(repr, (tuple(r[c] for c in sorted(df.columns)) for r in df.collect())))
    rel = con.execute(base.ORACLES[name])
    names = [d[0] for d in rel.description]
    order = [names.index(c) for c in sorted(names)]
    assert sorted(df.columns) == sorted(names)
    assert got == sorted(repr(tuple(r[i] for i in order)) for r in rel.fetchall())


def test_operators_and_stages():
    assert sorted(int(n[2:].split("_")[0]) for n in base.QUERIES) == list(range(1, 14))
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality", "near_dedup", "pii", "mixing", "packing"]


def test_pipeline(spark):
    docs = base.table(spark, SF, "documents")
    out = corpus_pipeline.run(spark, SF)
    assert {"doc_id", "piece", "sequence_id", "offset", "length"} <= set(out.columns)
    good = {r.doc_id for r in corpus_pipeline.good_quality(spark, docs, SF).collect()}
    assert {r.doc_id for r in out.select("doc_id").distinct().collect()} <= good
    bad = base.table(spark, SF, "labels").where("quality = 0")
    assert not good & {r.doc_id for r in bad.collect()}
