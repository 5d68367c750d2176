import random
import re

import numpy as np
import pytest
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st

from parcelkit.llm.components import components
from parcelkit.llm.simhash import (_budgets, _dealt, _edges, _rotate, _Linked, fingerprint, hamming_links, one_per_group,
                                   simhash_groups, trie_links)


def brute_fingerprint(text, k=4):
    words = re.findall(r"[^\x20\x09-\x0D]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
    shingles = [" ".join(words[i:i + k]) for i in range(max(1, len(words) - k + 1))] if words else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_labels(x, k):
    linked = _Linked(len(x))
    for a in range(len(x)):
        near = np.flatnonzero(np.bitwise_count(x[a] ^ x) <= k)
        linked.join(np.full(len(near), a), near)
    return linked.label.tolist()


@settings(max_examples=60, deadline=None)
@given(st.text(alphabet="aAbB \t\n\u2028é", max_size=60))
def test_fingerprint(text):
    assert fingerprint(text) == brute_fingerprint(text)


@pytest.mark.parametrize("k", [1, 2, 3, 4, 5, 7])
def test_tries_of_all_rotations_find_every_link(k):
    rng = np.random.default_rng(k)
    base = rng.integers(0, 2**63, 150, dtype=np.uint64) * np.uint64(2)
    sets = [base]
    for _ in range(4):
        mask = np.zeros(len(base), np.uint64)
        for _ in range(rng.integers(1, k + 2)):
            mask ^= np.uint64(1) << rng.integers(0, 64, len(base)).astype(np.uint64)
        sets.append(base ^ mask)
    dense = np.full(300, base[0])
    for _ in range(3):
        dense ^= np.uint64(1) << rng.integers(0, 64, 300).astype(np.uint64)
    x = np.unique(np.concatenate([*sets, dense]))
    linked = _Linked(len(x))
    for turn in range(k):
        y = _rotate(x, _edges(k)[turn])
        order = np.argsort(y)
        linked.join(order, order[trie_links(y[order], k, _budgets(k, turn), chunk=500)])
    assert linked.label.tolist() == brute_labels(x, k)


def test_links_over_buckets_and_salted_parts(spark):
    rng = np.random.default_rng(2)
    base = rng.integers(0, 2**63, 200, dtype=np.uint64)
    x = np.unique(np.concatenate([base, base ^ np.uint64(1 << 60), base ^ np.uint64(0b1011), base ^ np.uint64((1 << 50) | 1)]))
    df = spark.createDataFrame([(int(v),) for v in x.view(np.int64)], "fp bigint")
    want = brute_labels(x, 4)
    for size, limit in ((1 << 20, 1 << 20), (16, 1 << 20), (64, 10)):
        links = hamming_links(df, 4, bucket_size=size, bucket_limit=limit).collect()
        at = {int(v): i for i, v in enumerate(x.view(np.int64))}
        linked = _Linked(len(x))
        linked.join(np.array([at[r.src] for r in links]), np.array([at[r.dst] for r in links]))
        assert linked.label.tolist() == want


def test_components_of_chains_stars_and_cycles(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 160)] + [(200, 201), (201, 202), (202, 200),
             (300, 300), (None, 5), (7, 6), (6, 7)]
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "src bigint, dst bigint")).collect()}
    want = {**{i: 0 for i in range(1, 41)}, **{i: 100 for i in range(101, 160)}, 201: 200, 202: 200}
    assert got == want
    assert components(spark.createDataFrame([], "src bigint, dst bigint")).count() == 0


def test_groups_on_odd_rows(spark, odd_docs, no_docs):
    rows = [(r.doc_id, r.text) for r in odd_docs.collect()]
    got = simhash_groups(odd_docs).collect()
    assert sorted(str(r.doc_id) for r in got) == sorted(str(i) for i, _ in rows)
    fps = [brute_fingerprint(t) for _, t in rows]
    x = np.array(fps, np.uint64)
    label = brute_labels(x, 4)
    least = {}
    for (i, _), c in zip(rows, label):
        if i is not None:
            least[c] = min(least.get(c, i), i)
    want = sorted((str(i), f, str(least.get(c))) for (i, _), f, c in zip(rows, fps, label))
    assert sorted((str(r.doc_id), r.fp & (1 << 64) - 1, str(r.component_id)) for r in got) == want
    kept = one_per_group(odd_docs)
    assert kept.columns == odd_docs.columns
    ids = [r.doc_id for r in kept.collect()]
    assert sorted(i for i in ids if i is not None) == sorted(set(least.values())) and len(ids) == len(set(label))
    assert simhash_groups(no_docs).count() == 0


def test_a_small_bucket_beside_a_hot_one_is_dealt_out(spark):
    rng = random.Random(6)
    values = sorted({rng.getrandbits(48) for _ in range(3000)} | {(1 << b) | 5 for b in range(48, 63)})
    df = spark.createDataFrame([(v,) for v in values], "fp bigint")
    sizes = _dealt(df, len(values), 4, 64, 1000).groupBy("r", "p", "a", "b").count().collect()
    assert len({r.p for r in sizes if r.r == 0}) > 5
    assert max(r["count"] for r in sizes) <= 1000


def test_one_row_of_every_component_stays(spark):
    rng = random.Random(9)
    words = [f"w{i}" for i in range(400)]
    texts = [" ".join(rng.sample(words, 80)) for _ in range(5)]
    near = texts[4] + " w1"
    assert bin(fingerprint(texts[4]) ^ fingerprint(near)).count("1") <= 4
    rows = [(1, texts[0]), (1, texts[1]), (2, texts[2]),            # one id, texts that are not alike: both stay
            (None, texts[3]), (None, texts[3]), (None, texts[3]),   # equal texts without an id: one stays
            (3, texts[4]), (2, near), (2, near),                    # the near copy of the smaller id stays, once
            (1, texts[2])]                                          # a copy under an id that names another component
    docs = spark.createDataFrame([(*r, "x", 1) for r in rows], "doc_id bigint, text string, h1 string, copies int").repartition(3)
    kept = one_per_group(docs)
    assert kept.columns == docs.columns
    assert sorted(((r.doc_id, r.text) for r in kept.collect()), key=str) == sorted(
        [(1, texts[0]), (1, texts[1]), (1, texts[2]), (None, texts[3]), (2, near)], key=str)
