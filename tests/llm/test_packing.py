import random
import zlib
from collections import defaultdict

import numpy as np
import pyarrow as pa
import public_tokenizers as P
from tokenizers import Tokenizer

from parcelkit.llm.packing import WordIds, pack, sum_of_squares, token_pieces

PATH = P.path("word_bpe_49k.json")


def library():
    return Tokenizer.from_file(PATH)


def ids_of(texts):
    ids, sizes = WordIds(PATH).encode(pa.array(texts, pa.string()), [7, 8])
    out = [x.tolist() for x in np.split(ids, np.cumsum(sizes)[:-1])]
    assert all(x[-2:] == [7, 8] for x in out)
    return [x[:-2] for x in out]


TEXTS = ["Hello, World. it's don't  x", "ÄÖ İ ΣΑΣ fin.", "a\tb\x0bc d\u00a0e", "", "  ", "1.5, (x)... ..", "No\nline\r\nend. A.B.,",
         "a.b,c .d é.É,ß. e\u0301. x\u0301,y ŉ ǰ Ǆ K Å ﬁ", "'s.'T x's.y", "汉字. かな, ½.", "\u0300a \u0301", "A\u030a Å E\u0323\u0307"]
SPECIAL = ["a <|endoftext|> b", "<|startoftext|>", "x<|endoftext|><|endoftext|>Y. Z", "<|ENDOFTEXT|> a", "<|endof text|>", "<|endoftext|"]


def test_ids_equal_the_library():
    texts = TEXTS + SPECIAL
    assert ids_of(texts + [None]) == [library().encode(t, add_special_tokens=False).ids for t in texts] + [[]]
    assert ids_of(["a <|endoftext|> b"]) == [[320, 49407, 321]]
    assert ids_of(TEXTS[:1]) == [library().encode(TEXTS[0], add_special_tokens=False).ids]


def test_random_texts_equal_the_library():
    rng = random.Random(4)
    parts = ["word", "Über", "straße", "É", "e\u0301", ".", ",", " ", "  ", "\n", "\t", "'s", "'LL", "9", "İ", "Σ", "σς", "-", "<|endoftext|>", "<|", "|>",
             "漢", "\u00a0", "🎉", "(", "ñ", "Ø", "ǆ", "ſ", "K", "\u200d", "\u0345"]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randint(0, 14))) for _ in range(6000)]
    assert ids_of(texts) == [e.ids for e in library().encode_batch(texts, add_special_tokens=False)]


def brute(lengths, capacity):
    """The rule, with all sums of squares worked out."""
    gaps, where = [], []
    for s in lengths:
        count = defaultdict(int)
        for g in gaps:
            count[g] += g > 0
        def total(old, new):
            c = dict(count)
            if old is not None:
                c[old] -= 1
            if new > 0:
                c[new] = c.get(new, 0) + 1
            return sum(v * v for v in c.values())
        options = [(total(g, g - s), g) for g in sorted({g for g in gaps if g >= s and g > 0})] + [(total(None, capacity - s), capacity + 1)]
        _, g = min(options)
        if g > capacity:
            gaps.append(capacity - s)
            where.append(g)
        else:
            gaps[gaps.index(g)] -= s
            where.append(g)
    return sorted(gaps)


def test_rule_matches_brute_force():
    rng = np.random.default_rng(1)
    for capacity in (7, 20, 50):
        lengths = rng.integers(1, capacity + 1, 120)
        bins = sum_of_squares(lengths, capacity)
        fill = np.bincount(bins, weights=lengths).astype(int)
        assert (fill <= capacity).all() and sorted(capacity - fill) == brute(lengths.tolist(), capacity)


def test_pieces_and_sequences(spark, odd_docs, no_docs):
    t = library()
    pieces = token_pieces(odd_docs, PATH, capacity=64, with_ids=True)
    want = []
    for r in odd_docs.collect():
        ids = [*t.encode(r.text or "", add_special_tokens=False).ids, 1]
        want += [(r.doc_id, k, s, len(ids[s:s + 64]), zlib.crc32(np.array(ids[s:s + 64], "<u4").tobytes()))
                 for k, s in enumerate(range(0, len(ids), 64))]
    got = pack(pieces, capacity=64).collect()
    assert sorted(((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got), key=str) == sorted(want, key=str)
    assert all(zlib.crc32(np.array(r.ids, "<u4").tobytes()) == r.ids_crc32 for r in got)
    places = defaultdict(list)
    for r in got:
        places[r.sequence_id].append((r.offset, r.length))
    for members in places.values():
        end = 0
        for offset, length in sorted(members):
            assert offset == end
            end += length
        assert end <= 64
    total = sum(w[3] for w in want)
    assert len(places) <= 1.02 * total / 64 + 2
    assert pack(token_pieces(no_docs, PATH)).count() == 0


def test_many_shards_waste_little(spark, monkeypatch):
    from parcelkit.llm import packing
    monkeypatch.setattr(packing, "SHARD", 300)
    df = spark.range(4000).selectExpr("id", "1 + pmod(xxhash64(id), 400) as length", "'x' as offset")
    got = pack(df, capacity=1000).toPandas()
    fill = got.groupby("sequence_id")["length"].sum()
    assert fill.max() <= 1000 and len(got) == 4000
    assert len(fill) <= 1.03 * fill.sum() / 1000
