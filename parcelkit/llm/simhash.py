"""SimHash near-duplicates: 64-bit fingerprints linked by a self-join over binary tries.

A trie is walked against itself: a pair of nodes at the same depth carries the number of differing bits so far,
its four child pairs carry that number plus the new bit's difference, and a pair is dropped as soon as its error
budget is exceeded.

*Budget.* With at most k differing bits, some rotation of the k blocks of 64/k bits has at most i errors in its
first i blocks, for every i (cycle lemma). So k tries are walked, one per rotation, with a budget of i errors
while the i-th block is read. Shallow node pairs, where a trie join is expensive, are held to one error.

*Distribution.* A bucket holds the fingerprints that share the first bits of a rotation, and those of
neighbouring buckets within the budget; a bucket is one task's trie. A bucket over ``bucket_limit`` is dealt to
salted pairs of parts, each pair in its own task, so no task grows with a hot bucket.

*Dense groups.* Only links that join two components are kept, so a task returns at most one link per
fingerprint. A first walk with a budget of one joins dense groups; node pairs that lie wholly in one component
are not walked again, and a pair of nodes whose varying bits fit the budget is linked without a walk.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parcelkit.llm.common import on_workers, written
from parcelkit.llm.components import components

BITS = 64
_CHUNK = 1 << 16


def fingerprint(text: str | None, width: int = 4, seed: int = 42) -> int:
    """SimHash of the lower-cased (A-Z) words' shingles; 0 without a word."""
    words = (text or "").encode().lower().split()       # bytes.split: space and \x09-\x0D
    if not words:
        return 0
    joined = b" ".join(words)
    sizes = np.fromiter(map(len, words), np.int64, len(words)) + 1
    start = np.cumsum(sizes) - sizes
    last = np.arange(min(width, len(words)) - 1, len(words))
    ends = (start + sizes - 1)[last].tolist()
    digest = xxhash.xxh64_intdigest
    hashes = np.array([digest(joined[a:b], seed) for a, b in zip(start.tolist(), ends)], np.uint64)
    ones = np.zeros(BITS, np.int64)
    for lo in range(0, len(hashes), _CHUNK):
        part = hashes[lo:lo + _CHUNK]
        ones += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame, width: int = 4, seed: int = 42, id_col: str = "doc_id",
                 text_col: str = "text", marks: bool = False) -> DataFrame:
    """``doc_id``, ``fp`` (the 64 bits as a signed long) of every row; with ``marks`` also ``h1``, ``h2``, two hashes
    that stand for the text."""
    own = ["doc_id", "h1", "h2"] if marks else ["doc_id"]

    def run(batches):
        for batch in batches:
            fps = np.array([fingerprint(x.as_py(), width, seed) for x in batch.column("text")], np.uint64)
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in own), pa.array(fps.view(np.int64))], [*own, "fp"])

    narrow = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    narrow = narrow.withColumns(_text_marks("text")) if marks else narrow
    kind = narrow.schema["doc_id"].dataType.simpleString()
    return on_workers(narrow).mapInArrow(run, f"doc_id {kind}, {'h1 bigint, h2 bigint, ' if marks else ''}fp bigint")


def _text_marks(text_col: str) -> dict:
    text = F.coalesce(F.col(text_col), F.lit(""))
    return {"h1": F.xxhash64(text), "h2": F.xxhash64(F.lit(1), text)}


def _rotate(x: np.ndarray, by: int) -> np.ndarray:
    return (x << np.uint64(by)) | (x >> np.uint64(BITS - by)) if by else x


def _edges(k: int, turn: int = 0) -> list[int]:
    """Where the k blocks begin and end in the rotation that starts at block ``turn``."""
    edges = [-(-BITS * i // k) for i in range(k + 1)]
    widths = [b - a for a, b in zip(edges, edges[1:])]
    return np.cumsum([0, *widths[turn:], *widths[:turn]]).tolist()


def _budgets(k: int, turn: int = 0) -> list[int]:
    """Errors allowed among the first d bits, d = 0 .. 64: i while block i is read."""
    edges = _edges(k, turn)
    return [0] + [next(i for i in range(1, k + 1) if d <= edges[i]) for d in range(1, BITS + 1)]


class _Linked:
    """Component labels of a sorted array's positions (smallest position of a component)."""

    def __init__(self, n: int):
        self.label = np.arange(n)

    def join(self, a: np.ndarray, b: np.ndarray) -> None:
        label = self.label
        while True:
            a_, b_ = label[a], label[b]
            open_ = a_ != b_
            if not open_.any():
                return
            a, b = a[open_], b[open_]
            np.minimum.at(label, np.maximum(a_, b_)[open_], np.minimum(a_, b_)[open_])
            while True:
                up = label[label]
                if (up == label).all():
                    break
                label[:] = up


def trie_links(x: np.ndarray, k: int, budgets: list[int], chunk: int = 1 << 19) -> np.ndarray:
    """Walk the trie of sorted distinct fingerprints against itself.

    Returns the component label of each position: positions linked by pairs with at most ``k`` differing bits
    that the budgets reach share a label.
    """
    n = len(x)
    linked = _Linked(n)
    for limit in sorted({min(1, k), k}):
        allowed = [min(b, limit) for b in budgets]
        _walk(x, limit, allowed, linked, chunk)
    return linked.label


def _levels(x: np.ndarray):
    """Per depth: node ranges (lo, hi), children (-1: none) and the bits that vary inside a node."""
    lo, hi = np.zeros(1, np.int64), np.array([len(x)], np.int64)
    out = []
    for depth in range(BITS + 1):
        vary = np.bitwise_or.reduceat(x ^ np.repeat(x[lo], hi - lo), lo)
        if depth == BITS:
            out.append((lo, hi, None, None, vary))
            break
        bit = np.uint64(BITS - 1 - depth)
        ones = (x >> bit) & np.uint64(1)
        count = np.add.reduceat(ones.astype(np.int64), lo)
        mid = hi - count
        has0, has1 = mid > lo, mid < hi
        numbers = np.cumsum(has0.astype(np.int64) + has1) - (has0.astype(np.int64) + has1)
        zero, one = np.where(has0, numbers, -1), np.where(has1, numbers + has0, -1)
        out.append((lo, hi, zero, one, vary))
        if (hi - lo == 1).all():
            break
        new_lo = np.stack([np.where(has0, lo, -1), np.where(has1, mid, -1)], 1).ravel()
        new_hi = np.stack([mid, hi], 1).ravel()
        keep = new_lo >= 0
        lo, hi = new_lo[keep], new_hi[keep]
    return out


def _walk(x, limit, allowed, linked: _Linked, chunk: int) -> None:
    levels = _levels(x)
    one_comp = []
    for lo, hi, *_ in levels:                           # components of the walks before
        least = np.minimum.reduceat(linked.label, lo)
        one_comp.append(np.where(least == np.maximum.reduceat(linked.label, lo), least, -1))
    zero = np.zeros(1, np.int64)
    stack = [(0, zero, zero, zero)]
    while stack:
        depth, i, j, err = stack.pop()
        if len(i) > chunk:
            half = len(i) // 2
            stack += [(depth, i[half:], j[half:], err[half:]), (depth, i[:half], j[:half], err[:half])]
            continue
        lo, hi, zero, one, vary = levels[depth]
        comp = one_comp[depth]
        go = (comp[i] < 0) | (comp[i] != comp[j])       # not yet one component
        go &= (i != j) | (hi[i] - lo[i] > 1)
        i, j, err = i[go], j[go], err[go]
        if not len(i):
            continue
        # all members of both nodes lie within the limit: link them without a walk; lone pairs end here, too
        spread = np.bitwise_count(vary[i] | vary[j] | (x[lo[i]] ^ x[lo[j]])) <= limit
        lone = (hi[i] - lo[i] == 1) & (hi[j] - lo[j] == 1)
        if spread.any():
            a, b = i[spread], j[spread]
            linked.join(lo[a], lo[b])
            wide = np.unique(np.concatenate([a, b]))
            wide = wide[hi[wide] - lo[wide] > 1]
            if len(wide):
                size = hi[wide] - lo[wide]
                base = np.repeat(lo[wide], size)
                linked.join(base + np.arange(len(base)) - np.repeat(np.cumsum(size) - size, size), base)
        go = ~(spread | lone)
        i, j, err = i[go], j[go], err[go]
        if not len(i) or zero is None:
            continue
        zi, oi, zj, oj = zero[i], one[i], zero[j], one[j]
        apart = i != j
        more = err + 1 <= allowed[depth + 1]
        parts = [(zi, zj, err, True), (oi, oj, err, True), (zi, oj, err + 1, more), (oi, zj, err + 1, more & apart)]
        new = []
        for a, b, e, ok in parts:
            ok = ok & (a >= 0) & (b >= 0)
            new.append((a[ok], b[ok], e[ok]))
        i, j, err = (np.concatenate(c) for c in zip(*new))
        if len(i):
            stack.append((depth + 1, i, j, err))


def _bucket_links(pdf: pd.DataFrame, k: int, turn: int) -> pd.DataFrame:
    by = _edges(k)[turn]
    fps = np.unique(pdf["fp"].to_numpy(np.int64)).view(np.uint64)
    x = np.sort(_rotate(fps, by))
    label = trie_links(x, k, _budgets(k, turn))
    other = np.flatnonzero(label != np.arange(len(x)))
    back = _rotate(x, (BITS - by) % BITS).view(np.int64)
    return pd.DataFrame({"src": back[other], "dst": back[label[other]]})


def hamming_links(fps: DataFrame, k: int = 4, bucket_size: int = 4096, bucket_limit: int = 1 << 16) -> DataFrame:
    """``src``, ``dst``: links that connect the distinct values ``fp`` as all pairs with at most ``k`` differing
    bits would (a spanning set for each bucket, not every pair)."""
    fps = fps.select("fp").where("fp is not null").distinct()
    fps = written(fps, "distinct")
    n = fps.count()
    if k <= 0 or n < 2:
        return fps.select(F.col("fp").alias("src"), F.col("fp").alias("dst")).where("false")
    dealt = _dealt(fps, n, k, bucket_size, bucket_limit)
    schema = "src bigint, dst bigint"

    def run(key, pdf):
        return _bucket_links(pdf, k, int(key[0]))

    return on_workers(dealt).groupBy("r", "p", "a", "b").applyInPandas(run, schema)


def _dealt(fps: DataFrame, n: int, k: int, bucket_size: int, bucket_limit: int) -> DataFrame:
    """``fp`` in each group (``r``, ``p``, ``a``, ``b``) that it is compared in: a pair of parts of a bucket. The parts
    follow from all that a bucket receives, its neighbours' members too, so that no pair exceeds ``bucket_limit``."""
    edges = _edges(k)
    first = min(16, BITS // k)
    prefix = min(first, max(0, (n // bucket_size).bit_length()))
    turned = F.array(*[F.struct(F.lit(r).alias("r"), _turned(F.col("fp"), edges[r]).alias("x")) for r in range(k)])
    rows = fps.select("fp", F.explode(turned).alias("t")).select("fp", "t.r", "t.x")
    own = F.shiftrightunsigned("x", BITS - prefix) if prefix else F.lit(0).cast("long")
    rows = rows.withColumn("p", own)
    near = F.array(F.col("p"), *[F.col("p").bitwiseXOR(F.lit(1 << b)) for b in range(prefix)])
    # at most k * 2**prefix buckets, 2**16 each: a bounded table
    sizes = rows.groupBy("r", "p").count()
    sizes = sizes.select("r", F.col("p").alias("home"), F.explode(near).alias("p"), "count").where("p >= home")
    received = sizes.groupBy("r", "p").agg(F.sum("count").alias("count"), F.max(F.col("p") == F.col("home")).alias("own"))
    # a pair holds two parts; a sixteenth is left for parts that differ in size
    several = F.ceil(F.col("count") * F.lit(2.125) / F.lit(bucket_limit)).cast("int")
    parts = received.where("own").select(
        "r", "p", F.when(F.col("count") <= bucket_limit, 1).otherwise(several).alias("parts"))
    sent = rows.select("r", "fp", F.col("p").alias("home"), F.explode(near).alias("p")).where("p >= home")
    sent = sent.join(F.broadcast(parts), ["r", "p"])            # a neighbour without members is no bucket
    part = F.pmod(F.xxhash64("fp"), F.col("parts")).cast("int")
    others = F.when(F.col("parts") == 1, F.array(F.lit(0))).otherwise(
        F.filter(F.sequence(F.lit(0), F.col("parts") - 1), lambda q: q != part))
    return sent.select("r", "p", "fp", part.alias("a"), F.explode(others).alias("b")).select(
        "r", "p", F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"), "fp")


def _turned(c, by: int):
    return c if not by else F.shiftleft(c, by).bitwiseOR(F.shiftrightunsigned(c, BITS - by))


def simhash_groups(docs: DataFrame, width: int = 4, max_bits: int = 4, seed: int = 42, id_col: str = "doc_id",
                   text_col: str = "text") -> DataFrame:
    """Near-duplicate components of ``docs``: ``doc_id``, ``fp``, ``component_id`` (smallest doc_id reachable).

    Documents are linked when their fingerprints differ in at most ``max_bits`` bits. A null or empty text has
    fingerprint zero and is linked like any other. Null doc_ids take part but never name a component that has
    another id; repeated rows give one row each. An empty table gives no rows; other columns are ignored.
    """
    marks = written(fingerprints(docs, width, seed, id_col, text_col), "fingerprints")
    roots = components(written(hamming_links(marks, max_bits), "links"))
    distinct = marks.groupBy("fp").agg(F.min("doc_id").alias("least"))
    linked = written(distinct.join(roots, distinct.fp == roots.node, "left").select(
        "fp", F.coalesce("root", "fp").alias("root"), "least"), "classes")
    names = written(linked.groupBy("root").agg(F.min("least").alias("component_id")), "names")
    classes = written(linked.join(names, "root").select("fp", "component_id"), "components")
    return marks.join(classes, "fp").select("doc_id", "fp", "component_id")


def one_per_group(docs: DataFrame, width: int = 4, max_bits: int = 4, seed: int = 42, id_col: str = "doc_id",
                  text_col: str = "text") -> DataFrame:
    """``docs`` with exactly one row of each near-duplicate component, all columns as they were.

    It is a row of the smallest id (a null id loses against any other), whose row is found again by id and text: other
    components' rows of the same id are rows of their own. Of rows that repeat both, one stays. A null text equals the
    empty one.
    """
    rows = written(fingerprints(docs, width, seed, id_col, text_col, marks=True), "fingerprints")
    roots = components(written(hamming_links(rows, max_bits), "links"))
    row = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "h1", "h2")
    least = rows.groupBy("fp").agg(F.min(row).alias("row"))
    kept = least.join(roots, least.fp == roots.node, "left").groupBy(F.coalesce("root", "fp").alias("root")).agg(
        F.min("row").alias("row")).select("row.doc_id", "row.h1", "row.h2")
    copies = rows.groupBy("doc_id", "h1", "h2").agg(F.count(F.lit(1)).alias("copies")).where("copies > 1")
    same = (kept.h1 == copies.h1) & (kept.h2 == copies.h2) & kept.doc_id.eqNullSafe(copies.doc_id)
    kept = written(kept.join(copies, same, "left").select(
        kept.doc_id.alias("__id"), kept.h1.alias("__k1"), kept.h2.alias("__k2"), "copies"), "kept")
    marked = docs.withColumns({f"__{k}": c for k, c in _text_marks(text_col).items()})
    found = marked.join(kept.withColumnRenamed("copies", "__copies"), (F.col("__h1") == F.col("__k1")) & (
        F.col("__h2") == F.col("__k2")) & F.col(id_col).eqNullSafe(F.col("__id")))
    once = found.where("__copies is null").select(docs.columns)
    return once.unionByName(found.where("__copies > 1").dropDuplicates(["__id", "__k1", "__k2"]).select(docs.columns))
