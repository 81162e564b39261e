"""The registered queries against their SQL, and the pipeline stage by stage."""

import os
import sys
from collections import Counter

import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))), "tools"))
from oracle import compare, connect

import corpus_pipeline as p
from quillmesh.llm import queries
from quillmesh.llm.jaccard_join import Similarity

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", queries.QUERIES)
def test_query(spark, name):
    said = compare(spark, connect(SF), name, SF)
    assert said.startswith("equal" if name in queries.ORACLE_SQL else "rows only"), said


def test_stages(spark, tmp_path):
    from test_operators import brute_components

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    frames = [docs]
    for k, (_, stage) in enumerate(p.STAGES):
        stage(spark, frames[-1], SF).write.parquet(f"{tmp_path}/{k}")
        frames.append(spark.read.parquet(f"{tmp_path}/{k}"))
    rows = [f.collect() for f in frames]
    assert all(f.columns == docs.columns for f in frames[:-1])
    kept = {r[0] for r in connect(SF).sql(f"WITH {queries.quality_sql()} SELECT doc_id FROM verdict WHERE kept").fetchall()}
    assert {r["doc_id"] for r in rows[1]} == kept
    by_text = {}
    for r in rows[1]:
        by_text[r["text"]] = max(by_text.get(r["text"], -1), r["doc_id"])
    assert {r["doc_id"] for r in rows[2]} == set(by_text.values())
    classes = brute_components([(r["doc_id"], r["text"]) for r in rows[2]], Similarity())
    assert {r["doc_id"] for r in rows[3]} == {c for _, c in classes.values()}
    copies = Counter(r["doc_id"] for r in rows[4])
    assert max(copies.values()) <= 2 and set(copies) <= {r["doc_id"] for r in rows[3]}
    assert Counter(r["doc_id"] for r in rows[5]) == copies
    assert Counter(r["doc_id"] for r in p.run(spark, SF).collect()) == copies
