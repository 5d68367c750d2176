"""Document quality by co-training: a classifier of the text and one of the page's metadata teach each other.

Both are logistic regressions fitted on a bounded sample of labelled rows (``max_train``). In every round each
view labels the unlabelled sample rows (``max_pool``) that it is surest of, and these go to the other view's
training rows. At the end each view is calibrated on labelled rows that no fit has seen (Platt scaling), and
the calibrated log odds are combined. Features and scores of all rows are computed by Spark tasks.
"""

from __future__ import annotations

import re
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from parcelkit.llm.common import id_crc_mod, on_workers
from parcelkit.llm.token_table import TokenTable
from parcelkit.llm.toxicity import labelled_sample

_WIDTH = 10
_RUN = re.compile(r"[^\w\s]{2,}")
CONTENT = 24
META = 1 + 8 + 64 + 3      # constant, lang hashed to 8, source hashed to 64, length


def _describe(token: str) -> list[float]:
    letters = sum(c.isalpha() for c in token)
    upper = sum(c.isupper() for c in token)
    marks = sum(not c.isalnum() for c in token)
    return [len(token), letters, upper, marks, sum(c.isdigit() for c in token), float(letters > 1 and upper == letters),
            float(letters == 0), float(bool(_RUN.search(token))), float(token[-1] in ".?!"), float(token[0].isupper())]


def content_features(text: str, table: TokenTable) -> np.ndarray:
    """What the text itself shows: repetition, marks, capitals, word and sentence lengths."""
    out = np.zeros(CONTENT)
    out[0] = 1.0
    words = text.split()
    n = len(words)
    if not n:
        out[1] = 1.0
        return out
    at, matrix = table.rows(words)
    m = matrix[at]
    total = m.sum(0)
    counts = np.bincount(np.unique(at, return_inverse=True)[1])
    lines = [x for x in text.split("\n") if x.strip()]
    same = (at[1:] == at[:-1]).mean() if n > 1 else 0.0
    pairs = at[:-1] * (len(matrix) + 1) + at[1:]
    pair_rep = 1 - len(np.unique(pairs)) / len(pairs) if n > 1 else 0.0
    chars = max(float(total[0]), 1.0)
    letters = max(float(total[1]), 1.0)
    sentences = max(float(total[8]), 1.0)
    out[2:] = (len(counts) / n, counts.max() / n, same, pair_rep, np.log1p(n) / 10, total[0] / n / 10, total[2] / letters,
               total[3] / chars, total[4] / chars, total[5] / n, total[6] / n, total[7] / n, total[8] / n,
               total[9] / n, min(n / sentences, 100) / 100, 1 - len(set(lines)) / max(len(lines), 1),
               np.log1p(len(lines)) / 10, float(n < 5), float(same > 0.2), float(total[7] / n > 0.1),
               float(total[5] / n > 0.5), float(total[6] / n > 0.2))
    return out


def meta_features(lang: str | None, source: str | None, n_chars: int | None) -> np.ndarray:
    """What the page's record shows: language, source and declared length."""
    out = np.zeros(META)
    out[0] = 1.0
    out[1 + zlib.crc32((lang or "").encode()) % 8] = 1.0
    out[9 + zlib.crc32((source or "").encode()) % 64] = 1.0
    size = np.log1p(max(n_chars or 0, 0)) / 10
    out[73:] = size, size * size, float(n_chars is None)
    return out


def features(docs: DataFrame, keep: list[str]) -> DataFrame:
    """``keep``, ``content`` and ``meta`` (arrays of double) of rows with text, lang, source and n_chars."""
    def run(batches):
        table = TokenTable(_describe, _WIDTH)
        k = len(keep)
        for batch in batches:
            for lo in range(0, batch.num_rows, 1024):
                part = batch.slice(lo, 1024)
                text, lang, source, size = (c.to_pylist() for c in part.columns[k:k + 4])
                views = (np.array([content_features(x or "", table) for x in text]),
                         np.array([meta_features(*x) for x in zip(lang, source, size)]))
                lists = [pa.ListArray.from_arrays(np.arange(len(v) + 1, dtype=np.int32) * v.shape[1], pa.array(v.ravel()))
                         for v in views]
                yield pa.RecordBatch.from_arrays([*part.columns[:k], *lists], [*keep, "content", "meta"])

    narrow = docs.select(*keep, F.col("text").cast("string").alias("__text"), F.col("lang").cast("string").alias("__lang"),
                         F.col("source").cast("string").alias("__source"), F.col("n_chars").cast("bigint").alias("__size"))
    numbers = T.ArrayType(T.DoubleType())
    schema = T.StructType([*(narrow.schema[c] for c in keep), T.StructField("content", numbers),
                           T.StructField("meta", numbers)])
    return on_workers(narrow).mapInArrow(run, schema)


def logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1.0, steps: int = 25) -> np.ndarray:
    """Weights of a ridge logistic regression, by Newton steps."""
    w = np.zeros(x.shape[1])
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        h = (x * np.maximum(p * (1 - p), 1e-6)[:, None]).T @ x + ridge * np.eye(len(w))
        step = np.linalg.solve(h, x.T @ (y - p) - ridge * w)
        w += step
        if np.abs(step).max() < 1e-6:
            break
    return w


def co_train(views: list[np.ndarray], y: np.ndarray, pools: list[np.ndarray], rounds: int, share: float,
             sure: float) -> list[np.ndarray]:
    """Weights of both views. ``share`` of the pool may be taken per round and view, of rows at least ``sure``."""
    known = [(views[k], y) for k in (0, 1)]
    taken = [np.zeros(len(pools[0]), bool) for _ in (0, 1)]     # pool rows that view k has received
    weights = [logistic(*known[k]) for k in (0, 1)]
    for _ in range(rounds):
        for k in (0, 1):
            p = 1 / (1 + np.exp(-np.clip(pools[k] @ weights[k], -30, 30)))
            free = np.flatnonzero(~taken[1 - k])
            picked = []
            for label, belief in ((1, p), (0, 1 - p)):
                # as many of each label as the labelled rows have, so pseudo-labels don't shift the balance
                most = int(len(p) * share * ((y == label).mean() if len(y) else 0.5))
                best = free[np.argsort(-belief[free], kind="stable")][:most]
                picked.append(best[belief[best] >= sure])
            got = np.concatenate(picked)
            if not len(got):
                continue
            taken[1 - k][got] = True
            given = np.concatenate([np.ones(len(picked[0])), np.zeros(len(picked[1]))])
            x_, y_ = known[1 - k]
            known[1 - k] = np.vstack([x_, pools[1 - k][got]]), np.concatenate([y_, given])
        weights = [logistic(*known[k]) for k in (0, 1)]
    return weights


class QualityModel:
    """Weights, calibration and shares of both views; a constant share where nothing could be learned."""

    def __init__(self, share: float, weights=(), scale=(), mix=()):
        self.share, self.weights, self.scale, self.mix = share, weights, scale, mix

    def apply(self, docs: DataFrame, keep: list[str]) -> DataFrame:
        """Columns ``keep`` with ``content_score``, ``meta_score`` and ``score`` of every row."""
        if not len(self.weights):
            return docs.select(*keep, *[F.lit(self.share).alias(c) for c in ("content_score", "meta_score", "score")])

        def logit(column: str, w: np.ndarray, a: np.ndarray):
            products = F.zip_with(column, F.array(*[F.lit(float(x)) for x in w]), lambda p, q: p * q)
            dot = F.aggregate(products, F.lit(0.0), lambda s, x: s + x)
            return F.lit(float(a[0])) + F.lit(float(a[1])) * F.greatest(F.lit(-30.0), F.least(F.lit(30.0), dot))

        def chance(z):
            return 1 / (1 + F.exp(-z))

        rows = features(docs, keep).select(*keep, logit("content", self.weights[0], self.scale[0]).alias("__c"),
                                           logit("meta", self.weights[1], self.scale[1]).alias("__m"))
        a, b, c = (F.lit(float(x)) for x in self.mix)
        return rows.select(*keep, chance(F.col("__c")).alias("content_score"), chance(F.col("__m")).alias("meta_score"),
                           chance(a + b * F.col("__c") + c * F.col("__m")).alias("score"))


def fit_quality(docs: DataFrame, labels: DataFrame, max_train: int = 20_000, max_pool: int = 10_000, rounds: int = 3,
                sure: float = 0.9, id_col: str = "doc_id") -> QualityModel:
    """Co-train on at most ``max_train`` labelled rows (crc32(id) modulo 5 not 0) and ``max_pool`` unlabelled ones."""
    docs = docs.select(F.col(id_col).alias("doc_id"), "text", "lang", "source", "n_chars")
    labels = labels.withColumnRenamed(id_col, "doc_id")
    sample = labelled_sample(docs, labels, "quality", max_train)
    known = features(sample, ["label", "part"]).toPandas()          # at most max_train rows of numbers
    y = known["label"].to_numpy(float) if len(known) else np.zeros(0)
    if min((y == 0).sum(), (y == 1).sum()) < 10:
        return QualityModel(float((y.sum() + 1) / (len(y) + 2)))
    n = docs.count()
    pick = F.pmod(F.xxhash64("doc_id", F.lit(29)), F.lit(1 << 20)) < int((1 << 20) * min(1.0, 0.9 * max_pool / n))
    blank = labels.where(F.col("quality").isNotNull()).select(F.col("doc_id").alias("__id")).distinct()
    pool = docs.where(pick).join(blank, F.col("doc_id") == F.col("__id"), "left_anti")
    pool = features(pool, ["doc_id"]).drop("doc_id").limit(max_pool).toPandas()     # at most max_pool rows of numbers
    fit, test = (known["part"] < 80).to_numpy(), (known["part"] >= 80).to_numpy()
    widths = (("content", CONTENT), ("meta", META))
    views = [np.array(known[c].tolist(), float).reshape(len(known), w) for c, w in widths]
    pools = [np.array(pool[c].tolist(), float).reshape(len(pool), w) for c, w in widths]
    weights = co_train([v[fit] for v in views], y[fit], pools, rounds, 0.1, sure)
    logits = [np.clip(v[test] @ w, -30, 30) for v, w in zip(views, weights)]
    # Platt scaling of each view, then one more fit for the shares of both
    scale = [logistic(np.column_stack([np.ones(len(z)), z]), y[test], 1e-2) for z in logits]
    calibrated = [a[0] + a[1] * z for a, z in zip(scale, logits)]
    mix = logistic(np.column_stack([np.ones(len(y[test])), *calibrated]), y[test], 1e-2)
    return QualityModel(float(y.mean()), weights, scale, mix)


def quality_scores(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", **fit) -> DataFrame:
    """``doc_id``, ``held_out``, ``content_score``, ``meta_score``, ``score`` (chance of quality 1), ``predicted``.

    Labels of ids with crc32(id) modulo 5 equal to 0 (``held_out``) are never used. Null text, lang and source
    count as empty, a null n_chars as unknown; null ids and repeated rows are scored like any other. With fewer
    than ten labels of a kind every score is the smoothed share of label 1. An empty table gives no rows; other
    columns are ignored.
    """
    model = fit_quality(docs, labels, id_col=id_col, **fit)
    rows = model.apply(docs.select(F.col(id_col).alias("doc_id"), "text", "lang", "source", "n_chars"), ["doc_id"])
    return rows.select("doc_id", (id_crc_mod("doc_id", 5) == 0).alias("held_out"), "content_score", "meta_score", "score",
                       (F.col("score") >= 0.5).cast("int").alias("predicted"))


def quality_filter(docs: DataFrame, labels: DataFrame, least: float = 0.5, **fit) -> DataFrame:
    """Rows of ``docs``, all columns as they were, with a quality score of at least ``least``."""
    model = fit_quality(docs, labels, **fit)
    return model.apply(docs.withColumn("__row", F.struct("*")), ["__row"]).where(F.col("score") >= least).select("__row.*")
