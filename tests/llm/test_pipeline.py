from functools import partial

import duckdb
import pytest

import corpus_pipeline
from tallystar.llm import mixing, packing
from tallystar.llm.queries import ORACLES, QUERIES


def rows(values):
    return sorted(tuple(str(x) for x in r) for r in values)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_queries_agree_with_sql(spark, folder, name):
    con = duckdb.connect()
    for t in ("documents", "embeddings", "pages", "labels"):
        con.execute(f"create view {t} as select * from '{folder}/{t}.parquet'")
    df = QUERIES[name](spark, folder)
    want = con.sql(ORACLES[name])
    assert sorted(df.columns) == sorted(want.columns)
    columns = sorted(df.columns)
    assert rows(df.select(columns).collect()) == rows(con.sql(f"select {', '.join(columns)} from ({ORACLES[name]})").fetchall())


def test_stages_feed_each_other(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    seen = {r.doc_id for r in docs.select("doc_id").collect()}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, folder)
        assert out.columns == docs.columns and [f.dataType for f in out.schema] == [f.dataType for f in docs.schema], name
        ids = {r.doc_id for r in out.select("doc_id").collect()}
        assert ids <= seen and len(ids) > 0.5 * len(seen)
        docs, seen = spark.createDataFrame(out.collect(), docs.schema), ids
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, folder).collect()
    assert {r.doc_id for r in packed} == seen


def test_run(spark, folder):
    assert corpus_pipeline.run(spark, folder).select("doc_id").distinct().count() > 50


def test_packing_keeps_the_written_order(spark):
    ids = [5, 3, 9, 1, 7, 8, 0, 2]
    docs = spark.createDataFrame([(i, "same words") for i in ids], "doc_id long, text string").coalesce(1)
    for given in (docs, docs.repartitionByRange(3, "doc_id").sortWithinPartitions("doc_id")):
        wanted = [r.doc_id for r in given.collect()]
        got = sorted(packing.stage(spark, given, "").collect(), key=lambda r: (r.sequence_id, r.offset))
        rank = {r.doc_id: (r.offset, r.sequence_id) for r in got}
        assert sorted(wanted, key=rank.get) == wanted


def test_weights_of_the_mix_reach_the_sequences(spark, folder, monkeypatch):
    sources = [r.source or "" for r in spark.read.parquet(f"{folder}/documents.parquet").select("source").distinct().collect()]
    mix, found = mixing.mix_sources, []
    for heavy in sources[:2]:
        monkeypatch.setattr(mixing, "mix_sources", partial(mix, weights={s: 100 if s == heavy else 1 for s in sources}, block_bytes=2000))
        found.append({tuple(r) for r in corpus_pipeline.run(spark, folder).collect()})
    assert {x[:5] for x in found[0]} == {x[:5] for x in found[1]} and found[0] != found[1]
