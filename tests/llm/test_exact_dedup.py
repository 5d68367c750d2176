import hashlib
from collections import defaultdict

from parcelkit.llm.exact_dedup import block_names, exact_dedup, keep_first_copies


def lower(t):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or "")


def test_matches_brute_force_on_odd_rows(spark, odd_docs):
    rows = [(r.doc_id, r.text) for r in odd_docs.collect()]
    groups = defaultdict(list)
    for i, t in rows:
        groups[lower(t)].append(i)
    got = exact_dedup(odd_docs, block_chars=64, salts=3).collect()
    want = sorted((str(i), str(max((x for x in groups[lower(t)] if x is not None), default=None)), len(groups[lower(t)]),
                   hashlib.sha256(lower(t).encode()).hexdigest()) for i, t in rows)
    assert sorted((str(r.doc_id), str(r.keep_id), r.group_size, r.text_sha256) for r in got) == want
    assert sum(r.kept for r in got) == len(groups)
    assert all(r.doc_id == r.keep_id for r in got if r.kept)


def test_names_tell_texts_apart_at_any_depth(spark):
    base = "".join(chr(97 + i % 26) for i in range(1000))
    texts = [base, base[:-1], base[:500] + "#" + base[501:], base + base, base * 3, base[::-1], base]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    for size in (1, 7, 100, 5000):
        names = {r.id: (r.n_blocks, r.name) for r in block_names(df, block_chars=size, salts=2).collect()}
        assert names[0] == names[6] and len(set(names.values())) == len(set(texts))


def test_a_hot_group_of_copies_and_keeping_rows(spark, odd_docs, no_docs):
    df = spark.range(600).selectExpr("id doc_id", "if(id % 3 = 0, 'hot text', concat('t', id)) text")
    got = {r.doc_id: r for r in exact_dedup(df, salts=4).collect()}
    assert got[0].group_size == 200 and got[0].keep_id == 597 and sum(r.kept for r in got.values()) == 401
    kept = keep_first_copies(odd_docs)
    assert kept.columns == odd_docs.columns
    texts = [lower(r.text) for r in kept.collect()]
    assert len(texts) == len(set(texts)) == len({lower(r.text) for r in odd_docs.collect()})
    assert exact_dedup(no_docs).count() == 0 and keep_first_copies(no_docs).count() == 0
