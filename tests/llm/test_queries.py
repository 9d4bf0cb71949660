"""The registered queries of the package against their SQL, and the pipeline against its operators."""

import zlib

import pytest
from helpers import edge_docs, no_docs

import __spark_entry__ as entry
import corpus_pipeline
from riskloom.llm import decontaminate, exact_dedup, queries, simhash_dedup, toxicity


def test_all_are_registered():
    names = list(entry.queries())
    assert {int(n[2:].split("_")[0]) for n in names if n.startswith("op")} == set(range(1, 14))
    assert "pipeline" in names and set(queries.ORACLE) <= set(queries.QUERIES)
    assert not any("limit" in sql.lower() for sql in queries.ORACLE.values())


@pytest.mark.parametrize("name", sorted(queries.ORACLE))
def test_query_equals_sql(spark, small, duck, name):
    df = queries.QUERIES[name](spark, small)
    columns = sorted(df.columns)
    relation = duck.sql(queries.ORACLE[name])
    assert sorted(relation.columns) == columns
    place = [relation.columns.index(c) for c in columns]
    want = sorted(str(tuple(row[i] for i in place)) for row in relation.fetchall())
    assert sorted(str(tuple(r)) for r in df.select(*columns).collect()) == want


def test_pipeline_stages_filter_whole_documents(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet").cache()
    before, gone = docs, []
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = stage(spark, before, small).cache()
        assert after.columns == docs.columns
        ids, left = ({r.doc_id for r in df.select("doc_id").collect()} for df in (before, after))
        assert left <= ids and after.exceptAll(before).isEmpty()
        gone.append((name, ids - left))
        if name == "toxicity":
            model = toxicity.fit(before, spark.read.parquet(f"{small}/labels.parquet"))
            want = {r.doc_id for r in toxicity.scores(before, model).collect() if r.score >= 0.3}
        elif name == "exact_dedup":
            want = {r.doc_id for r in exact_dedup.decisions(before).where("NOT kept").collect()}
        elif name == "simhash_dedup":
            want = {r.doc_id for r in simhash_dedup.near_classes(before).where("doc_id <> component_id").collect()}
        else:
            want = {r.doc_id for r in decontaminate.matches(before, spark.read.parquet(f"{small}/benchmark.parquet")).collect()}
        assert ids - left == want
        before = after
    packed = corpus_pipeline.STAGES[-1][1](spark, before, small)
    assert {r.doc_id for r in packed.select("doc_id").distinct().collect()} == {r.doc_id for r in before.select("doc_id").collect()}
    whole = corpus_pipeline.run(spark, small)
    key = lambda r: (r.doc_id, r.start, r.length, r.ids_crc32)
    assert sorted(map(key, whole.collect())) == sorted(map(key, packed.collect()))
    assert sum(len(ids) for _, ids in gone) > 0


def test_pipeline_edges(spark, small):
    for docs in (edge_docs(spark), no_docs(spark)):
        for _, stage in corpus_pipeline.STAGES:
            docs = stage(spark, docs, small).cache()
        assert docs.columns[:2] == ["doc_id", "start"]


def test_held_out_rule(spark):
    ids = [0, 1, 17, 12345, -4]
    got = {r.doc_id: r.h for r in spark.createDataFrame([(i,) for i in ids] + [(None,)], "doc_id long").select("doc_id", toxicity.held_out().alias("h")).collect()}
    assert got == {**{i: zlib.crc32(str(i).encode()) % 4 == 2 for i in ids}, None: False}
