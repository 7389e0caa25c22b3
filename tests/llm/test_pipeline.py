"""The pipeline stage by stage, and the registered queries, on the smallest tables."""

import os
import sys

import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))), "tools"))

import corpus_pipeline  # noqa: E402
from salaria.llm.catalog import ORACLE_SQL, QUERIES  # noqa: E402
from salaria.llm.mixing import mix_taken  # noqa: E402
from test_exact_dedup import norm  # noqa: E402
from test_jaccard_join import brute  # noqa: E402

SF_DIR = "/root/testdata/sf0.001"


def test_stages(spark):
    docs = corpus_pipeline.documents(spark, SF_DIR)
    columns, results = docs.columns, []
    for name, stage in corpus_pipeline.STAGES:
        docs = corpus_pipeline.table(stage(spark, docs, SF_DIR), f"test-{name}")
        results.append(docs)
    toxicity, exact, near, mixed, pieces = results
    assert all(r.columns == columns for r in results[:4])
    whole = {r.doc_id: r.text for r in corpus_pipeline.documents(spark, SF_DIR).collect()}
    clean = {r.doc_id: r.text for r in toxicity.collect()}
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{SF_DIR}/labels.parquet").collect()}
    assert all(whole[i] == t for i, t in clean.items())
    assert sum(labels.get(i) == 0 for i in clean) >= 0.97 * sum(t == 0 for t in labels.values())
    first = {}
    for i in sorted(clean):
        first.setdefault(norm(clean[i]), i)
    assert {r.doc_id for r in exact.collect()} == set(first.values())
    kept = {r.doc_id: r.text for r in exact.collect()}
    assert {r.doc_id for r in near.collect()} == {i for i, _, c in brute([(i, t, None, None) for i, t in kept.items()]) if i == c}
    words = {}
    for r in mixed.collect():
        assert set(r.text.split()) <= set(kept[r.doc_id].split()) and r.n_chars == len(r.text)
        words[r.doc_id] = words.get(r.doc_id, 0) + len(r.text.split())
    assert words == {r.doc_id: r.taken for r in mix_taken(near).collect() if r.taken}
    out = pieces.collect()
    assert len(out) == mixed.count() and all(r.round_trip and r.n_pieces == len(r.ids) for r in out)


def test_run_is_repeatable(spark):
    one, two = (sorted((r.doc_id, r.n_pieces, r.ids_crc32) for r in corpus_pipeline.run(spark, SF_DIR).collect()) for _ in range(2))
    assert one == two and len(one) > 100


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query_matches_oracle(spark, name):
    import duckdb

    con = duckdb.connect()
    for t in ("documents", "embeddings", "benchmark"):
        con.execute(f"create view {t} as select * from read_parquet('{SF_DIR}/{t}.parquet')")
    want = con.sql(ORACLE_SQL[name])
    got = QUERIES[name](spark, SF_DIR)
    assert sorted(got.columns) == sorted(want.columns)
    assert sorted(tuple(r[c] for c in want.columns) for r in got.collect()) == sorted(want.fetchall())


def test_every_operator_is_registered():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))
    import __spark_entry__ as contract

    assert set(QUERIES) | {"pipeline"} <= set(contract.queries()) and set(ORACLE_SQL) <= set(contract.oracle_sql())
