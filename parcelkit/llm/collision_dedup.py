"""Embedding near-duplicates by collision-counting projections.

Every unit vector is projected on ``PROJECTIONS`` random directions. In each projection's sorted order a query's window
reaches ``width`` to both sides of its own value; a vector in it collides with the query. Pairs that collide often
enough are verified by their cosine in double precision.

*Calibration.* Two vectors at the threshold cosine lie sqrt(2 - 2 cos) apart, and their projections differ by a normal
variable of that deviation: each projection is a collision with the same known probability, their number is binomial,
and the count that a pair must reach is the largest that misses a pair at the threshold with probability at most
``miss``. Closer pairs collide more often, so the bound holds for all links. The window's width is the one that costs
least on unrelated vectors (at right angles): collisions counted, and verifications of pairs that reach the count.

*Distribution.* Equal vectors of a label are one class. Classes are range-partitioned by label and their place on a
first, unit direction and numbered; ``PART`` numbers make a part, so a label of any size lies in many parts. Two parts
of a label meet in one task if they are no farther apart on the first direction than a link can reach (an exact
bound). A task holds two parts: it returns the number of links of each class and a spanning set of its links, never
the pairs of a dense group.
"""

from __future__ import annotations

import math
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parcelkit.llm.common import on_workers, written
from parcelkit.llm.components import components

PROJECTIONS = 32
VERIFY = 200            # cost of a verification, in counted collisions
PART = 2048             # classes of a part
MISS = 1e-6             # chance that a pair at the threshold is not found


def _normal(z: float) -> float:
    """Chance that a normal variable of deviation 1 lies within ``z`` of its mean."""
    return math.erf(z / math.sqrt(2))


def _binomial_below(count: int, n: int, p: float) -> float:
    """Chance of fewer than ``count`` hits."""
    return sum(math.comb(n, k) * p ** k * (1 - p) ** (n - k) for k in range(count))


@lru_cache(100)
def calibrate(threshold: float, projections: int = PROJECTIONS, miss: float = MISS) -> tuple[float, int]:
    """The window's half-width and the least count of collisions of a pair that is verified."""
    near = math.sqrt(max(2 - 2 * threshold, 1e-24))
    best = None
    for step in range(10, 61):
        width = near * step / 20                # 0.5 to 3 deviations of a pair at the threshold
        hit, far = _normal(width / near), _normal(width / math.sqrt(2))
        count = next(c for c in range(projections, -1, -1) if _binomial_below(c, projections, hit) <= miss)
        cost = projections * far + VERIFY * (1 - _binomial_below(count, projections, far))
        if count > 0 and (best is None or cost < best[0]):
            best = cost, width, count
    return (best[1], best[2]) if best else (math.inf, 0)


@lru_cache(20)
def directions(dims: int, projections: int = PROJECTIONS, seed: int = 42) -> np.ndarray:
    """A unit direction for the order of the parts, and the random directions of the windows, as columns."""
    rng = np.random.default_rng([seed, dims])
    first = rng.standard_normal((dims, 1))
    return np.hstack([first / np.linalg.norm(first), rng.standard_normal((dims, projections))])


def _clean(vectors: DataFrame, id_col: str, vec_col: str, label_col: str) -> DataFrame:
    """Rows with ``label``, ``c`` (doubles; null if the vector takes no part) and 16 bytes that name label and vector."""
    def finite(c: Column) -> Column:
        return c.isNotNull() & ~F.isnan(c) & (F.abs(c) != float("inf"))
    rows = vectors.select(F.col(id_col).alias("vec_id"), F.col(label_col).alias("label"),
                          F.transform(F.col(vec_col).cast("array<double>"), lambda c: c + F.lit(0.0)).alias("c"))  # no -0
    fit = F.col("label").isNotNull() & F.forall("c", finite) & F.exists("c", lambda c: c != 0)
    rows = rows.withColumn("c", F.when(fit, F.col("c")))
    return rows.select("vec_id", "label", "c", F.when(F.col("c").isNotNull(), F.xxhash64(F.lit(1), "label", "c")).alias("h1"),
                       F.when(F.col("c").isNotNull(), F.xxhash64(F.lit(2), "label", "c")).alias("h2"))


def _classes(rows: DataFrame) -> DataFrame:
    """A row per distinct vector of a label: ``label``, ``dims``, ``u`` (unit vector, bytes), ``place``, ``copies``, ``least``."""
    same = rows.where("c is not null").groupBy("label", "c", "h1", "h2").agg(
        F.count(F.lit(1)).alias("copies"), F.min("vec_id").alias("least"))

    def run(batches):
        for batch in batches:
            units, places, dims = [], [], []
            for c in batch.column("c"):
                v = c.values.to_numpy(zero_copy_only=False)
                v = v / np.abs(v).max()                     # squares neither overflow nor vanish
                v = v / np.linalg.norm(v)
                units.append(v.tobytes())
                places.append(float(v @ directions(len(v))[:, 0]))
                dims.append(len(v))
            keep = ["label", "h1", "h2", "copies", "least"]
            yield pa.RecordBatch.from_arrays([*(batch.column(k) for k in keep), pa.array(units, pa.binary()),
                                              pa.array(places, pa.float64()), pa.array(dims, pa.int32())], [*keep, "u", "place", "dims"])

    kinds = {f.name: f.dataType.simpleString() for f in same.schema.fields}
    schema = ", ".join(f"{c} {kinds[c]}" for c in ("label", "h1", "h2", "copies", "least"))
    units = on_workers(same).mapInArrow(run, f"{schema}, u binary, place double, dims int")
    keys = ["label", "dims", "place"]
    order = units.repartitionByRange(*keys, "h1").sortWithinPartitions(*keys, "h1", "h2")
    return written(order.withColumn("pos", F.monotonically_increasing_id()), "vector-classes")


def _meetings(classes: DataFrame, reach: float) -> DataFrame:
    """``label``, ``dims``, ``a``, ``b``: parts of a label (a = b: within one) that a link may join."""
    parts = classes.groupBy("label", "dims", "part").agg(F.min("place").alias("low"), F.max("place").alias("high"))
    other = parts.select("label", "dims", F.col("part").alias("b"), F.col("low").alias("low_b"))
    # the parts of a label follow each other on the first direction: later ones begin where earlier ones end
    return parts.join(other, ["label", "dims"]).where((F.col("b") >= F.col("part")) & (F.col("low_b") <= F.col("high") + reach)).select(
        "label", "dims", F.col("part").alias("a"), "b")


def _spanning(label: np.ndarray, i: np.ndarray, j: np.ndarray) -> None:
    """Join the components of ``label`` (smallest position of each) along the links (i, j)."""
    while True:
        a, b = label[i], label[j]
        open_ = a != b
        if not open_.any():
            return
        i, j = i[open_], j[open_]
        np.minimum.at(label, np.maximum(a, b)[open_], np.minimum(a, b)[open_])
        while True:
            up = label[label]
            if (up == label).all():
                break
            label[:] = up


def links_between(u: np.ndarray, v: np.ndarray | None, threshold: float, width: float, least: int, tile: int = 256):
    """Yields (query positions in ``u``, positions in ``v``) of verified links; ``v`` None: links within ``u``, each once.

    For each projection: sort ``v``, find every query's window by binary search, count its members.
    """
    own = v is None
    v = u if own else v
    d = directions(u.shape[1])[:, 1:]
    pu, pv = u @ d, v @ d
    orders = np.argsort(pv, axis=0, kind="stable")
    windows = []
    for k in range(d.shape[1]):
        line = pv[orders[:, k], k]
        windows.append((np.searchsorted(line, pu[:, k] - width, "left"), np.searchsorted(line, pu[:, k] + width, "right")))
    for lo in range(0, len(u), tile):
        hi = min(lo + tile, len(u))
        counts = np.zeros((hi - lo, len(v)), np.uint8)
        for k, (first, last) in enumerate(windows):
            order = orders[:, k]
            for row, a, b in zip(counts, first[lo:hi].tolist(), last[lo:hi].tolist()):
                row[order[a:b]] += 1
        i, j = np.nonzero(counts >= least)
        if own:
            later = j > i + lo
            i, j = i[later], j[later]
        if len(i) > counts.size // 20:                      # a dense tile is verified as a whole
            near = (u[lo:hi] @ v.T)[i, j] >= threshold
        else:
            near = np.concatenate([np.einsum("ij,ij->i", u[lo + i[s:s + 65536]], v[j[s:s + 65536]]) >= threshold
                                   for s in range(0, len(i), 65536)]) if len(i) else np.zeros(0, bool)
        yield i[near] + lo, j[near]


def _meet(pdf: pd.DataFrame, dims: int, threshold: float, width: float, least: int) -> pd.DataFrame:
    """Links of one meeting: a row (pos, null, links) for each class that has some, and spanning links (pos, other, 0)."""
    pdf = pdf.sort_values("pos", kind="stable")
    pos, copies = pdf["pos"].to_numpy(np.int64), pdf["copies"].to_numpy(np.int64)
    unit = np.frombuffer(b"".join(pdf["u"]), float).reshape(len(pdf), dims)
    first = pdf["side"].to_numpy() == 0
    split = int(first.sum())                                # part a's numbers are the smaller ones
    within = split == len(pdf)
    links, label = np.zeros(len(pdf), np.int64), np.arange(len(pdf))
    for i, j in links_between(unit[:split], None if within else unit[split:], threshold, width, least):
        j = j if within else j + split
        np.add.at(links, i, copies[j])
        np.add.at(links, j, copies[i])
        _spanning(label, i, j)
    some, tied = np.flatnonzero(links), np.flatnonzero(label != np.arange(len(pdf)))
    return pd.DataFrame({"pos": np.concatenate([pos[some], pos[tied]]),
                         "other": pd.array([None] * len(some) + pos[label[tied]].tolist(), "Int64"),
                         "links": np.concatenate([links[some], np.zeros(len(tied), np.int64)])})


def near_duplicates(vectors: DataFrame, threshold: float = 0.93, id_col: str = "vec_id", vec_col: str = "embedding",
                    label_col: str = "label") -> DataFrame:
    """``vec_id``, ``n_links``, ``component_id``, ``kept`` of every row.

    Rows link when their labels are equal and their cosine is at least ``threshold``. Rows with a null label, or a
    vector that is null, empty, zero or holds a null or non-finite entry, link with nothing; nor do vectors of
    different lengths. Repeated rows link with each other; rows of one id are rows of their own. A null id takes part
    but names no component that has another id (``kept`` compares null with null as equal). An empty table gives no
    rows; other columns are ignored.
    """
    rows = _clean(vectors, id_col, vec_col, label_col)
    classes = _classes(rows).withColumn("part", F.shiftright("pos", PART.bit_length() - 1))
    width, least = calibrate(threshold)
    reach = math.sqrt(max(2 - 2 * threshold, 0.0)) + 1e-9
    sent = classes.select("label", "dims", "part", "pos", "copies", "u")
    meetings = written(_meetings(classes, reach), "meetings")
    both = meetings.select("label", "dims", "a", "b", F.explode(F.when(F.col("a") == F.col("b"), F.array(F.lit(0))).otherwise(
        F.array(F.lit(0), F.lit(1)))).alias("side"))
    both = both.withColumn("part", F.when(F.col("side") == 0, F.col("a")).otherwise(F.col("b")))
    # tasks by number of meetings, not by bytes
    tasks = max(1, min(meetings.count(), 100_000))
    dealt = sent.join(both, ["label", "dims", "part"]).select("label", "dims", "a", "b", "side", "pos", "copies", "u")
    dealt = dealt.repartition(tasks, "label", "dims", "a", "b")

    def run(key, pdf):
        return _meet(pdf, int(key[1]), threshold, width, least)

    found = written(on_workers(dealt).groupBy("label", "dims", "a", "b").applyInPandas(run, "pos bigint, other bigint, links bigint"),
                    "links")
    roots = components(found.where("other is not null").select(F.col("pos").alias("src"), F.col("other").alias("dst")))
    totals = found.where("links > 0").groupBy("pos").agg(F.sum("links").alias("links"))
    named = classes.select("pos", "h1", "h2", "copies", "least").join(totals, "pos", "left").join(
        roots.select(F.col("node").alias("pos"), "root"), "pos", "left")
    named = written(named.select("h1", "h2", "least", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
                                 F.coalesce("root", "pos").alias("root")), "linked-classes")
    names = named.groupBy("root").agg(F.min("least").alias("component_id"))
    named = written(named.join(names, "root").select("h1", "h2", "n_links", "component_id"), "named-classes")
    alone = rows.where("c is null").select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    linked = rows.where("c is not null").select("vec_id", "h1", "h2").join(named, ["h1", "h2"]).select(
        "vec_id", "n_links", "component_id")
    return linked.unionByName(alone).withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))
