import base64
import hashlib

import numpy as np
import public_tokenizers as P
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st

from parcelkit.llm import byte_bpe
from parcelkit.llm.byte_bpe import Ranks, decode_documents, encode_documents, round_trip_digests, scan_states

PATH = P.path("byte_bpe_50k.tiktoken")


@pytest.fixture(scope="module")
def ranks():
    return Ranks.read(PATH)


@pytest.fixture(scope="module")
def library(ranks):
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks.ranks, special_tokens={})


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text(alphabet=st.one_of(st.sampled_from("abrevldstm'RE  \n\t19.,-\xa0\x1c\x85\u0663é中🎉\u3000\u0308"), st.characters(
    exclude_categories=["Cs"])), max_size=50), max_size=5))
def test_ids_equal_the_library_and_decode_back(texts):
    r = Ranks.read(PATH) if not hasattr(test_ids_equal_the_library_and_decode_back, "r") else None
    if r:
        test_ids_equal_the_library_and_decode_back.r = r
        test_ids_equal_the_library_and_decode_back.e = tiktoken.Encoding(
            "own", pat_str=P.PATTERN, mergeable_ranks=r.ranks, special_tokens={})
    r, e = test_ids_equal_the_library_and_decode_back.r, test_ids_equal_the_library_and_decode_back.e
    for text, (ids, offsets) in zip(texts, r.encode(texts)):
        assert ids.tolist() == e.encode_ordinary(text)
        assert r.decode(ids) == text.encode()
        assert all(text.encode()[o:].startswith(r.tokens[i]) for i, o in zip(ids, offsets))


def test_long_pieces_and_slab_edges(ranks, library, monkeypatch):
    texts = ["ab" * 3000, " " * 5000, "'" * 700, "x's'll've'r'v'l it's 're", "word " * 4000]
    want = [library.encode_ordinary(t) for t in texts]
    assert [i.tolist() for i, _ in ranks.encode(texts)] == want
    for slab in (100, 129, 1000):
        monkeypatch.setattr(byte_bpe, "_SLAB", slab)
        assert [i.tolist() for i, _ in ranks.encode(texts)] == want


def test_scan_equals_running_the_automaton():
    rng = np.random.default_rng(0)
    for n in (0, 1, 63, 64, 65, 1000, 4097):
        symbols = rng.integers(0, 12, n).astype(np.uint8)
        state, want = 0, []
        for s in symbols:
            state = byte_bpe._T[s, state]
            want.append(state)
        assert scan_states(symbols).tolist() == want


def test_documents(spark, odd_docs, no_docs, library):
    rows = sorted(((r.doc_id, r.text or "") for r in odd_docs.collect()), key=str)
    encoded = encode_documents(odd_docs, PATH)
    assert sorted(((r.doc_id, r.ids) for r in encoded.collect()), key=str) == sorted(
        ((i, library.encode_ordinary(t)) for i, t in rows), key=str)
    assert sorted(((r.doc_id, bytes(r.decoded).decode()) for r in decode_documents(encoded, PATH).collect()), key=str) == rows
    got = {(r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in round_trip_digests(odd_docs, PATH).collect()}
    assert got == {(len(i), hashlib.sha256(np.array(i, "<u4").tobytes()).hexdigest(), hashlib.sha256(t.encode()).hexdigest())
                   for t in (t for _, t in rows) for i in [library.encode_ordinary(t)]}
    assert round_trip_digests(no_docs, PATH).count() == 0
    assert len(Ranks.read(PATH).ranks) == sum(1 for x in open(PATH) if base64.b64decode(x.split()[0]))
