"""Language-model scoring by deleted interpolation.

Maximum-likelihood estimates of orders 0 (uniform) to n are mixed; the weights depend on how often the context
was seen (buckets of powers of two) and are learned by expectation-maximisation on a held-out tenth of the
training documents, with counts of the other nine tenths.

The corpus is gathered in four steps, each a Spark job over a written table:

1. every input task turns its documents into chunks: token numbers of a chunk-local vocabulary;
2. a chunk asks the owners of its distinct n-grams (ranges of a 64-bit key) for their counts, sending its own
   training counts along. An n-gram is sent once per chunk, however frequent. Orders follow one another, so the
   disk holds the requests of one order at a time;
3. an owner adds up the counts and answers each chunk in the order it asked: counts only;
4. a chunk meets its answers and scores its documents. The weights come from the same step over the chunks of
   held-out documents, reduced to sums per bucket in every round.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parcelkit.llm.common import id_crc_mod, on_workers, ragged, written

CONTEXT_BUCKETS = 24
_BOS, _END = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)      # keys of no word
_MIX = np.uint64(0xFF51AFD7ED558CCD)


def _settled(df: DataFrame, name: str) -> DataFrame:
    """``written``, and the shuffle files of the writing are dropped at its end: they are as large as the table."""
    conf, key = df.sparkSession.conf, "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = conf.get(key)
    conf.set(key, "true")
    try:
        return written(df, name)
    finally:
        conf.set(key, before)


def _pack(a: np.ndarray) -> bytes:
    """Integers as compressed byte planes."""
    return zstandard.compress(np.ascontiguousarray(a.view(np.uint8).reshape(len(a), a.itemsize).T).tobytes(), 1)


def _unpack(b: bytes, kind) -> np.ndarray:
    raw = np.frombuffer(zstandard.decompress(b, max_output_size=1 << 31), np.uint8)
    return np.ascontiguousarray(raw.reshape(np.dtype(kind).itemsize, -1).T).view(kind).ravel()


class _Chunk:
    """Documents of one role: ids, token counts, and tokens as numbers of a local vocabulary."""

    def __init__(self):
        self.index: dict[bytes, int] = {}
        self.ids, self.held, self.sizes, self.tokens = [], [], [], []
        self.total = 0

    def add(self, doc_id, held: bool, words: list[bytes]) -> None:
        index = self.index
        for w in [w for w in set(words) if w not in index]:
            index[w] = len(index)
        self.ids.append(doc_id)
        self.held.append(held)
        self.sizes.append(len(words))
        self.tokens.append(np.fromiter(map(index.__getitem__, words), np.uint32, len(words)))
        self.total += len(words) + 1

    def row(self, dev: bool) -> tuple:
        vocabulary = np.array([xxhash.xxh64_intdigest(w) for w in self.index], np.uint64)
        return (uuid.uuid4().int & ((1 << 62) - 1), dev, self.ids, self.held, self.sizes,
                _pack(np.concatenate([*self.tokens, np.zeros(0, np.uint32)])), _pack(vocabulary))


def _chunks(docs: DataFrame, id_col: str, text_col: str, train_mod: int, held_residue: int, chunk_tokens: int):
    kind = docs.schema[id_col].dataType

    def run(batches: Iterator[pa.RecordBatch]):
        open_ = {False: _Chunk(), True: _Chunk()}

        def out(dev):
            names = ["chunk", "dev", "ids", "held", "sizes", "tokens", "vocabulary"]
            row = open_[dev].row(dev)
            open_[dev] = _Chunk()
            return pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(row, types)], names)

        types = [pa.int64(), pa.bool_(), None, pa.list_(pa.bool_()), pa.list_(pa.int32()), pa.binary(), pa.binary()]
        for batch in batches:
            types[2] = pa.list_(batch.column(0).type)
            for doc_id, text, held, dev in zip(*(c.to_pylist() for c in batch.columns)):
                open_[dev].add(doc_id, held, (text or "").encode().lower().split())
                if open_[dev].total >= chunk_tokens:
                    yield out(dev)
        for dev, chunk in open_.items():
            if chunk.ids:
                yield out(dev)

    crc = F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")))
    held = id_crc_mod(id_col, train_mod) == held_residue
    dev = ~held & (F.floor(crc / train_mod) % 10 == 0)
    narrow = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"), held.alias("held"),
                         dev.alias("dev"))
    kind = kind.simpleString()
    schema = (f"chunk bigint, dev boolean, ids array<{kind}>, held array<boolean>, sizes array<int>, tokens binary, "
              "vocabulary binary")
    return on_workers(narrow).mapInArrow(run, schema)


def _gram_keys(row, order: int):
    """Keys of the n-grams that end at each place of the padded texts, per order; places of real tokens;
    document of each place."""
    words = _unpack(row["vocabulary"], np.uint64) if len(row["vocabulary"]) else np.zeros(0, np.uint64)
    tokens = words[_unpack(row["tokens"], np.uint32)]
    sizes = np.asarray(row["sizes"], np.int64)
    pad = order - 1
    wide = sizes + pad + 1                                      # begin marks, words, one end
    first = np.cumsum(wide) - wide
    doc = np.repeat(np.arange(len(sizes)), wide)
    place = np.arange(int(wide.sum())) - first[doc]
    seq = np.empty(len(doc), np.uint64)
    begin, end = place < pad, place == wide[doc] - 1
    seq[begin], seq[end] = _BOS, _END
    seq[~begin & ~end] = tokens
    keys = [seq]
    for n in range(2, order + 1):
        longer = keys[-1].copy()                                # places before n - 1 are never used
        before = keys[-1][:-1]
        x = (before ^ (before >> np.uint64(31))) * _MIX
        x ^= x >> np.uint64(29)
        longer[1:] = (x + seq[1:]) * np.uint64(0x94D049BB133111EB) ^ np.uint64(n)
        longer[place < n - 1] = 0
        keys.append(longer)
    return keys, ~begin, doc, place


def _distinct(row, order: int):
    """For each order: sorted distinct keys, and where each place's key is among them."""
    keys, real, doc, place = _gram_keys(row, order)
    return [np.unique(k, return_inverse=True) for k in keys], real, doc, place


def _requests(chunks: DataFrame, gram: int, order: int, owners: int) -> DataFrame:
    def run(batches):
        edges = np.array([(i << 64) // owners for i in range(1, owners)], np.uint64)
        for batch in batches:
            for row in batch.to_pylist():
                grams, _, doc, place = _gram_keys(row, order)
                keys, at = np.unique(grams[gram - 1], return_inverse=True)
                train = ~np.asarray(row["held"], bool)[doc]
                counts = np.bincount(at[train & (place >= gram - 1)], minlength=len(keys)).astype(np.uint32)
                cuts = [0, *np.searchsorted(keys, edges).tolist(), len(keys)]
                out = []
                for k, (a, b) in enumerate(zip(cuts, cuts[1:])):
                    if b > a:
                        out.append((gram, k, row["chunk"], row["dev"],
                                    _pack(np.diff(keys[a:b], prepend=np.uint64(0))), _pack(counts[a:b])))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(zip(*out), [pa.int32(), pa.int32(), pa.int64(), pa.bool_(),
                                                                pa.binary(), pa.binary()])],
                    ["gram", "owner", "chunk", "dev", "keys", "counts"])

    return on_workers(chunks).mapInArrow(run, "gram int, owner int, chunk bigint, dev boolean, keys binary, counts binary")


def _answers(requests: DataFrame) -> DataFrame:
    """Counts over all training chunks (``total``) and without the dev chunks (``fit``), in the order asked."""
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        keys = [np.cumsum(_unpack(b, np.uint64), dtype=np.uint64) for b in pdf["keys"]]
        own = [_unpack(b, np.uint32).astype(np.int64) for b in pdf["counts"]]
        distinct, at = np.unique(np.concatenate(keys), return_inverse=True)
        dev = np.repeat(pdf["dev"].to_numpy(bool), [len(k) for k in keys])
        counts = np.concatenate(own)
        total = np.bincount(at, weights=counts, minlength=len(distinct)).astype(np.int64)
        fit = total - np.bincount(at[dev], weights=counts[dev], minlength=len(distinct)).astype(np.int64)
        gram, owner = int(pdf["gram"].iloc[0]), int(pdf["owner"].iloc[0])
        rows, lo = [], 0
        for chunk, is_dev, k in zip(pdf["chunk"], pdf["dev"], keys):
            place = at[lo:lo + len(k)]
            lo += len(k)
            rows.append((gram, owner, chunk, _pack(total[place]), _pack(fit[place]) if is_dev else None, 0, 0, 0, 0))
        if gram == 1:                                           # sizes of the training text and vocabulary
            word = distinct != _BOS
            rows.append((0, owner, -1, None, None, total[word].sum(), (total[word] > 0).sum(), fit[word].sum(),
                         (fit[word] > 0).sum()))
        return pd.DataFrame(rows, columns=["gram", "owner", "chunk", "total", "fit", "n", "v", "n_fit", "v_fit"])

    return requests.groupBy("gram", "owner").applyInPandas(
        run, "gram int, owner int, chunk bigint, total binary, fit binary, n bigint, v bigint, n_fit bigint, v_fit bigint")


def _estimates(row, answers: pd.DataFrame, column: str, order: int, n: int, v: int):
    """Estimates of orders 0 .. n for each real token, its context bucket, unigram count and document."""
    grams, real, doc, _ = _distinct(row, order)
    answers = answers.sort_values(["gram", "owner"])
    counts = []
    for k, (keys, at) in enumerate(grams, 1):
        got = [_unpack(b, np.int64) for b in answers.loc[answers["gram"] == k, column]]
        counts.append(np.concatenate([*got, np.zeros(0, np.int64)])[at])
    here = np.flatnonzero(real)
    f = np.empty((order + 1, len(here)))
    f[0] = 1.0 / (v + 1)
    f[1] = counts[0][here] / max(n, 1)
    context = np.full(len(here), n)
    for k in range(2, order + 1):
        context = counts[k - 2][here - 1]
        f[k] = counts[k - 1][here] / np.maximum(context, 1)
    bucket = np.minimum(np.frexp(context.astype(np.float64))[1], CONTEXT_BUCKETS - 1)
    return f, bucket, counts[0][here], doc[here]


def _learned(dev: DataFrame, order: int, rounds: int) -> np.ndarray:
    """Weights per context bucket: expectation-maximisation over the written estimates of the dev tokens."""
    weights = np.full((CONTEXT_BUCKETS, order + 1), 1.0 / (order + 1))
    names = [f"w{k}" for k in range(order + 1)]
    for _ in range(rounds):
        now = weights

        def run(batches, now=now):
            sums = np.zeros((CONTEXT_BUCKETS, order + 1))
            for batch in batches:
                for row in batch.to_pylist():
                    bucket = np.frombuffer(row["bucket"], np.uint8)
                    f = np.frombuffer(row["f"], np.float32).reshape(order + 1, -1)
                    share = now[bucket].T * f
                    share /= np.maximum(share.sum(0), 1e-300)
                    for k in range(order + 1):
                        sums[:, k] += np.bincount(bucket, weights=share[k], minlength=CONTEXT_BUCKETS)
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(CONTEXT_BUCKETS, dtype=np.int32)),
                                              *(pa.array(c) for c in sums.T)], ["bucket", *names])

        schema = "bucket int, " + ", ".join(f"{x} double" for x in names)
        got = dev.mapInArrow(run, schema).groupBy("bucket").agg(*[F.sum(x).alias(x) for x in names]).collect()
        weights = np.full_like(now, 1.0 / (order + 1))
        for r in got:                                           # CONTEXT_BUCKETS rows
            s = np.array([r[x] for x in names])
            if s.sum() > 0:
                weights[r["bucket"]] = s / s.sum()
    return 0.999 * weights + 0.001 / (order + 1)                # no estimate is ruled out for unseen cases


def score_documents(docs: DataFrame, order: int = 3, train_mod: int = 5, held_residue: int = 1, rounds: int = 12,
                    chunk_tokens: int = 1_500_000, owner_keys: int = 1_500_000, id_col: str = "doc_id",
                    text_col: str = "text") -> DataFrame:
    """Score every document with a model of the training documents (crc32 of the id, modulo ``train_mod``, is
    not ``held_residue``).

    Returns ``doc_id``, ``held_out``, ``n_tokens`` (words and one end), ``n_known`` (tokens seen in training),
    ``train_tokens``, ``base_score`` (add-half unigram, log10) and ``score`` (log10 of the interpolated model's
    probability). Words are lower-cased (A-Z) and split at space and \\x09-\\x0D.

    A null text is empty: it has the end token only. A null id counts as the empty text for the split. Repeated
    rows are documents of their own. Without training documents all counts are zero and the uniform estimate
    decides; an empty table gives no rows. Other columns are ignored.
    """
    kind = docs.schema[id_col].dataType.simpleString()
    chunks = written(_chunks(docs, id_col, text_col, train_mod, held_residue, chunk_tokens), "chunks")
    tokens = chunks.select(F.sum(F.aggregate("sizes", F.lit(0).cast("long"), lambda a, x: a + x + 1))).first()[0]
    schema = (f"doc_id {kind}, held_out boolean, n_tokens bigint, n_known bigint, train_tokens bigint, "
              "base_score double, score double")
    if not tokens:
        return docs.sparkSession.createDataFrame([], schema)
    owners = max(1, -(-tokens // owner_keys))
    answers = reduce(DataFrame.unionByName, [
        _settled(_answers(_requests(chunks, gram, order, owners)), "answers") for gram in range(1, order + 1)])
    n, v, n_fit, v_fit = answers.where("gram = 0").agg(*[F.sum(c) for c in ("n", "v", "n_fit", "v_fit")]).first()
    per_chunk = answers.where("gram > 0").select("gram", "owner", "chunk", "total", "fit")

    def dev_estimates(_, chunk: pd.DataFrame, got: pd.DataFrame) -> pd.DataFrame:
        f, bucket, _, _ = _estimates(chunk.iloc[0], got, "fit", order, n_fit, v_fit)
        return pd.DataFrame({"bucket": [bucket.astype(np.uint8).tobytes()], "f": [f.astype(np.float32).tobytes()]})

    held_back = chunks.where("dev")
    dev = _settled(held_back.groupBy("chunk").cogroup(per_chunk.where("fit is not null").groupBy("chunk")).applyInPandas(
        dev_estimates, "bucket binary, f binary"), "estimates")
    weights = _learned(on_workers(dev), order, rounds)

    def score(_, chunk: pd.DataFrame, got: pd.DataFrame) -> pd.DataFrame:
        row = chunk.iloc[0]
        f, bucket, c, doc = _estimates(row, got, "total", order, n, v)
        size = len(row["sizes"])
        p = np.log10((weights[bucket].T * f).sum(0))
        base = np.log10((c + 0.5) / (n + 0.5 * (v + 1)))
        add = lambda x: np.bincount(doc, weights=x, minlength=size)
        return pd.DataFrame({"doc_id": row["ids"], "held_out": row["held"],
                             "n_tokens": np.asarray(row["sizes"], np.int64) + 1, "n_known": add(c > 0).astype(np.int64),
                             "train_tokens": n, "base_score": add(base), "score": add(p)})

    return chunks.groupBy("chunk").cogroup(per_chunk.drop("fit").groupBy("chunk")).applyInPandas(score, schema)
