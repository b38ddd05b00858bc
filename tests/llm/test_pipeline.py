from __future__ import annotations

from collections import Counter

import __spark_entry__
import corpus_pipeline
import pytest
from ledgerstrata.llm import queries
from ledgerstrata.llm.common import components, gapless

from . import edge


def folder(tmp_path, spark, docs, labels):
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    labels.write.parquet(f"{tmp_path}/labels.parquet")
    return str(tmp_path)


def test_stages_take_effect(spark, tmp_path):
    source = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{source}/documents.parquet")
    current, columns = docs, docs.columns
    seen = []
    for name, stage in corpus_pipeline.STAGES:
        current = stage(spark, current, source)
        if name != "packing":
            assert current.columns == columns
        current.write.parquet(f"{tmp_path}/{name}")
        current = spark.read.parquet(f"{tmp_path}/{name}")
        seen.append((name, current.count()))
    assert [n for n, _ in seen] == ["quality", "line_dedup", "near_dedup", "mixing", "packing"]
    counts = dict(seen)
    assert counts["quality"] < docs.count() and counts["line_dedup"] == counts["quality"] > counts["near_dedup"]
    once = Counter(map(tuple, corpus_pipeline.run(spark, source).drop("sequence_id", "offset").collect()))
    assert once == Counter(map(tuple, current.drop("sequence_id", "offset").collect()))


@pytest.mark.parametrize("rows", ["edge", "empty"])
def test_edges(spark, tmp_path, rows):
    docs = edge.docs(spark) if rows == "edge" else edge.empty(spark)
    labels = spark.createDataFrame([(0, 1, 0), (None, None, None)], "doc_id long, quality int, toxic int")
    found = corpus_pipeline.run(spark, folder(tmp_path, spark, docs, labels)).collect()
    assert bool(found) == (rows == "edge")


def test_every_operator_is_registered():
    names = __spark_entry__.queries()
    for n in range(1, 11):
        assert sum(q.startswith(f"op{n}_") for q in queries.QUERIES) == 1
    assert set(queries.QUERIES) | {"pipeline"} <= set(names)
    assert set(__spark_entry__.oracle_sql()) <= set(names)


def test_components_of_a_chain_and_a_star(spark):
    edges = [(i, i + 1) for i in range(100, 160)] + [(7, i) for i in range(300, 400)] + [(5, 5), (None, 3), (9, 8), (9, 8)]
    got = {r["node"]: r["component"] for r in components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert got == {i: 100 for i in range(100, 161)} | {i: 7 for i in (7, *range(300, 400))} | {9: 8, 8: 8}


def test_gapless(spark):
    df = spark.range(500).selectExpr("id % 3 as g", "id % 7 as o")
    ranks = {}
    for r in gapless(df, ["g"], ["o"], "n", 4).collect():
        ranks.setdefault(r["g"], []).append(r["n"])
    assert all(sorted(x) == list(range(len(x))) for x in ranks.values())
