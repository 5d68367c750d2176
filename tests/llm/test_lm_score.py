import math
import random
import zlib
from collections import Counter

import numpy as np
import pytest

from parcelkit.llm import lm_score
from parcelkit.llm.lm_score import CONTEXT_BUCKETS, score_documents
from parcelkit.llm.queries import op8_lm_scoring
from tests.llm.conftest import prose


def tokens(text):
    return [*(text or "").encode().lower().split(), "END"]


def crc(i):
    return zlib.crc32(b"" if i is None else str(i).encode())


def model(rows, order, rounds):
    """The same model, n-grams counted in dictionaries."""
    def grams(t):
        seq = ["BOS"] * (order - 1) + t
        return [(tuple(seq[k:k + n]), n) for n in range(1, order + 1) for k in range(order - n, len(seq) - n + 1) if True] , seq
    def counts(docs):
        c = Counter()
        for t in docs:
            seq = ["BOS"] * (order - 1) + t
            for n in range(1, order + 1):
                c.update(tuple(seq[k:k + n]) for k in range(len(seq) - n + 1))
        return c
    train = [tokens(t) for i, t in rows if crc(i) % 5 != 1]
    dev = [tokens(t) for i, t in rows if crc(i) % 5 != 1 and crc(i) // 5 % 10 == 0]
    fit = [tokens(t) for i, t in rows if crc(i) % 5 != 1 and crc(i) // 5 % 10 != 0]
    def estimates(docs, c):
        n = sum(v for k, v in c.items() if len(k) == 1 and k != ("BOS",))
        v = sum(1 for k in c if len(k) == 1 and k != ("BOS",))
        out = []
        for t in docs:
            seq = ["BOS"] * (order - 1) + t
            for p in range(order - 1, len(seq)):
                f = [1 / (v + 1), c[(seq[p],)] / max(n, 1)]
                context = n
                for k in range(2, order + 1):
                    context = c[tuple(seq[p - k + 1:p])]
                    f.append(c[tuple(seq[p - k + 1:p + 1])] / max(context, 1))
                out.append((min(context.bit_length(), CONTEXT_BUCKETS - 1), f))
        return out, n, v
    seen, _, _ = estimates(dev, counts(fit))
    w = np.full((CONTEXT_BUCKETS, order + 1), 1 / (order + 1))
    for _ in range(rounds):
        s = np.zeros_like(w)
        for b, f in seen:
            share = w[b] * np.float32(f)
            s[b] += share / max(share.sum(), 1e-300)
        w = np.where(s.sum(1, keepdims=True) > 0, s / np.maximum(s.sum(1, keepdims=True), 1e-300), 1 / (order + 1))
    w = 0.999 * w + 0.001 / (order + 1)
    c = counts(train)
    result = {}
    for i, t in rows:
        est, n, v = estimates([tokens(t)], c)
        score = sum(math.log10(float(w[b] @ np.array(f))) for b, f in est)
        base = sum(math.log10((c[(x,)] + .5) / (n + .5 * (v + 1))) for x in tokens(t))
        result[i] = (crc(i) % 5 == 1, len(tokens(t)), sum(c[(x,)] > 0 for x in tokens(t)), n, round(base, 6), round(score, 4))
    return result


@pytest.mark.parametrize("order", [1, 2, 3])
def test_matches_a_dictionary_model(spark, order):
    rng = random.Random(order)
    rows = [(i, prose(rng, rng.randint(1, 60))) for i in range(300)] + [(300, None), (301, ""), (302, "NEW " * 50)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(5)
    got = score_documents(df, order=order, rounds=4, chunk_tokens=700, owner_keys=500).collect()
    want = model(rows, order, 4)
    assert len(got) == len(rows)
    for r in got:
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) == want[r.doc_id][:5]
        assert abs(r.score - want[r.doc_id][5]) < 1e-3 * max(1, abs(r.score))


def test_odd_rows(spark, odd_docs, no_docs):
    got = score_documents(odd_docs).collect()
    assert sorted(str(r.doc_id) for r in got) == sorted(str(r.doc_id) for r in odd_docs.collect())
    assert all(math.isfinite(r.score) and r.score <= 0 for r in got)
    assert {r.n_tokens for r in got if r.doc_id in (3, 4, 7)} == {1}
    assert score_documents(no_docs).count() == 0


def test_without_training_documents(spark):
    ids = [i for i in range(100) if crc(i) % 5 == 1][:5]
    got = score_documents(spark.createDataFrame([(i, "a b") for i in ids], "doc_id bigint, text string")).collect()
    assert all(r.train_tokens == 0 and r.n_known == 0 and math.isfinite(r.score) for r in got)


def test_planes_round_trip():
    for a in (np.arange(5, dtype=np.uint64) * 12345678901, np.zeros(0, np.uint32), np.array([3], np.int64)):
        assert lm_score._unpack(lm_score._pack(a), a.dtype).tolist() == a.tolist()


def test_registered_query_uses_trigrams(spark, tmpdir_path):
    rng = random.Random(8)
    rows = [(i, prose(rng, rng.randint(1, 60))) for i in range(200)]
    spark.createDataFrame(rows, "doc_id bigint, text string").write.parquet(f"{tmpdir_path}/documents.parquet")
    want = model(rows, 3, 12)
    got = op8_lm_scoring(spark, tmpdir_path).collect()
    assert len(got) == len(rows)
    assert all(abs(r.score - want[r.doc_id][5]) < 1e-3 * max(1, abs(r.score)) for r in got)
