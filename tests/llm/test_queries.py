import duckdb
import pytest

import corpus_pipeline
from parcelkit.llm.queries import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_matches_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "pages", "labels", "embeddings", "conversations"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    df = QUERIES[name](spark, SF)
    cur = con.execute(ORACLES[name])
    names = [d[0] for d in cur.description]
    assert set(names) <= set(df.columns)
    assert sorted(map(str, map(tuple, df.select(names).collect()))) == sorted(map(str, cur.fetchall()))


def test_pipeline_stages_keep_columns_and_only_shrink(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, n, ids = docs.columns, docs.count(), {r.doc_id for r in docs.select("doc_id").collect()}
    assert [name for name, _ in corpus_pipeline.STAGES] == ["quality", "toxicity", "exact_dedup", "simhash", "packing"]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = corpus_pipeline.written(stage(spark, docs, SF), name)
        now = {r.doc_id for r in docs.select("doc_id").collect()}
        assert docs.columns == columns and docs.count() <= n and now <= ids
        n, ids = docs.count(), now
    out = corpus_pipeline.STAGES[-1][1](spark, docs, SF)
    assert {r.doc_id for r in out.collect()} == ids


def test_pipeline_stages_against_brute_force(spark):
    import numpy as np
    from tokenizers import Tokenizer

    from tests.llm.test_exact_dedup import lower
    from tests.llm.test_simhash import brute_fingerprint, brute_labels
    stages = dict(corpus_pipeline.STAGES)
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = {r.doc_id: r.text for r in docs.collect()}
    best = {}
    for i, t in rows.items():
        best[lower(t)] = max(best.get(lower(t), -1), i)
    kept = corpus_pipeline.written(stages["exact_dedup"](spark, docs, SF), "t")
    ids = sorted(r.doc_id for r in kept.collect())
    assert ids == sorted(best.values())
    label = brute_labels(np.array([brute_fingerprint(rows[i]) for i in ids], np.uint64), 4)
    assert sorted(r.doc_id for r in stages["simhash"](spark, kept, SF).collect()) == sorted({ids[c] for c in label})
    t = Tokenizer.from_file(corpus_pipeline.public_tokenizers.path("word_bpe_49k.json"))
    size = {i: len(t.encode(x, add_special_tokens=False).ids) + 1 for i, x in rows.items()}
    out = stages["packing"](spark, docs, SF).toPandas()
    assert out.groupby("doc_id")["length"].sum().to_dict() == size and out.groupby("sequence_id")["length"].sum().max() <= 4096


def test_every_operator_has_a_query():
    assert sorted(k.split("_")[0] for k in QUERIES) == sorted([*(f"op{n}" for n in range(1, 14)), "pipeline"])
