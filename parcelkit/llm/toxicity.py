"""Toxicity scores: gradient-boosted trees over dense features, with isotonic calibration.

Labelled training rows are a bounded sample (``max_train`` rows, chosen by a hash of the id). It is split by
the same hash: one part for the lexicon (words and word stems whose document frequency speaks for the label),
one for the trees, one for the calibration. Features and scores are computed for whole texts of all rows, by
Spark tasks; trees and calibration are Spark ML models.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import IsotonicRegression
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from parcelkit.llm.common import id_crc_mod, on_workers, written
from parcelkit.llm.token_table import TokenTable

# fixed word list: forms of address in the languages of the corpus
SECOND_PERSON = frozenset("you your yours yourself u ur thou thee du dich dir dein deine ihr euch euer "
                          "tu te toi ton vous votre vos tú ti usted ustedes vosotros vuestro".split())
# fixed values: signs used in place of letters
_LOOKALIKE = str.maketrans("013457@$!|", "oieastasil")
_EDGE = re.compile(r"^\W+|\W+$")
_INNER = re.compile(r"[\W_]+")
STEMS = (4, 5, 6)
FEATURES = ("log_words", "lexicon_density", "lexicon_hits", "lexicon_weight", "lexicon_best", "stem_density",
            "stem_hits", "stem_weight", "stem_best", "distinct_hits", "hidden_density", "hidden_hits",
            "second_person_density", "proximity", "capitals", "shouted", "exclamations", "questions", "marks",
            "obfuscated", "stretched", "mean_length")
# per token: word weight, stem weight, hidden weight, second person, letters, capitals, all capitals, !, ?, other
# marks, obfuscated, stretched, length
_WIDTH = 13


def _core(token: str) -> str:
    return _EDGE.sub("", token).lower()


def _candidates(token: str) -> list[str]:
    """The word of a token and its stems (marked with a star)."""
    core = _core(token)
    return [core, *(core[:k] + "*" for k in STEMS if len(core) > k)] if core else []


def _describer(lexicon: dict[str, float]):
    def describe(token: str) -> list[float]:
        core = _core(token)
        word = lexicon.get(core, 0.0)
        stem = max((lexicon.get(core[:k] + "*", 0.0) for k in STEMS if len(core) >= k), default=0.0)
        inner = bool(_INNER.search(core)) or not core.isalpha()
        hidden = 0.0
        if core and inner and any(c.isalpha() for c in core):
            plain = _INNER.sub("", core.translate(_LOOKALIKE))
            hidden = lexicon.get(plain, 0.0)
        letters = sum(c.isalpha() for c in token)
        upper = sum(c.isupper() for c in token)
        marks = sum(not c.isalnum() for c in token)
        return [word, stem, hidden, float(core in SECOND_PERSON), letters, upper, float(letters > 2 and upper == letters),
                token.count("!"), token.count("?"), marks, float(inner and letters > 0),
                float(bool(re.search(r"(\w)\1\1", token))), len(token)]
    return describe


def _features(text: str, table: TokenTable) -> np.ndarray:
    words = text.split()
    n = len(words)
    out = np.zeros(len(FEATURES), np.float64)
    if not n:
        return out
    at, matrix = table.rows(words)
    m = matrix[at]
    word, stem, hidden, second = m[:, 0], m[:, 1], m[:, 2], m[:, 3]
    letters = max(float(m[:, 4].sum()), 1.0)
    hits, stems, hid = np.flatnonzero(word > 0), np.flatnonzero(stem > 0), np.flatnonzero(hidden > 0)
    any_hit = np.union1d(np.union1d(hits, stems), hid)
    you = np.flatnonzero(second > 0)
    near = 0.0
    if len(you) and len(any_hit):
        k = np.searchsorted(you, any_hit)
        left = np.where(k > 0, any_hit - you[np.maximum(k - 1, 0)], n)
        right = np.where(k < len(you), you[np.minimum(k, len(you) - 1)] - any_hit, n)
        near = 1.0 / (1.0 + float(np.minimum(left, np.abs(right)).min()))
    out[:] = (np.log1p(n), len(hits) / n, len(hits), word.sum(), word.max(), len(stems) / n, len(stems), stem.sum(),
              stem.max(), len(np.unique(at[any_hit])), len(hid) / n, len(hid), len(you) / n, near,
              m[:, 5].sum() / letters, m[:, 6].mean(), m[:, 7].mean(), m[:, 8].mean(), m[:, 9].mean(), m[:, 10].mean(),
              m[:, 11].mean(), m[:, 12].mean())
    return out


def dense_features(docs: DataFrame, lexicon: dict[str, float], keep: list[str], text_col: str = "text") -> DataFrame:
    """Columns ``keep`` and ``features`` (array of double) of every row; a null text is empty: all zeros."""
    def run(batches):
        table = TokenTable(_describer(lexicon), _WIDTH)
        for batch in batches:
            for lo in range(0, batch.num_rows, 1024):
                part = batch.slice(lo, 1024)
                rows = np.array([_features(x or "", table) for x in part.column(len(keep)).to_pylist()])
                edges = np.arange(len(rows) + 1, dtype=np.int32) * len(FEATURES)
                yield pa.RecordBatch.from_arrays(
                    [*part.columns[:len(keep)], pa.ListArray.from_arrays(edges, pa.array(rows.ravel()))],
                    [*keep, "features"])

    narrow = docs.select(*keep, F.col(text_col).alias("__text"))
    schema = T.StructType([*(narrow.schema[c] for c in keep), T.StructField("features", T.ArrayType(T.DoubleType()))])
    return on_workers(narrow).mapInArrow(run, schema)


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, max_train: int, id_col: str = "doc_id") -> DataFrame:
    """``id``, ``text`` ..., ``label`` (0.0 or 1.0), ``part`` (0 to 99) of at most ``max_train`` labelled rows whose
    crc32(id) modulo 5 is not 0. Labels are cut to the sample before they meet the documents, so the side that is
    broadcast has at most ``max_train`` rows of three numbers. An id labelled more than once takes its largest label."""
    rows = (labels.where(F.col(label).isin(0, 1) & F.col(id_col).isNotNull()).where(id_crc_mod(id_col, 5) != 0)
            .groupBy(F.col(id_col).alias("__id")).agg(F.max(label).cast("double").alias("label")))
    order = F.xxhash64(F.col("__id"), F.lit(17))
    n = rows.count()
    if n > 2 * max_train:       # thin out first: the exact cut then sorts few rows
        rows = rows.where(F.pmod(F.xxhash64(F.col("__id"), F.lit(3)), F.lit(1 << 20)) < int((1 << 20) * 1.5 * max_train / n))
    rows = rows.orderBy(order, "__id").limit(max_train).withColumn("part", F.pmod(order, F.lit(100)).cast("int"))
    rows = written(rows, "label-sample")
    return docs.join(F.broadcast(rows), F.col(id_col) == F.col("__id"))


def learn_lexicon(sample: DataFrame, text_col: str = "text", min_docs: int = 5, candidates: int = 20_000,
                  max_words: int = 3_000, min_log_odds: float = 1.5) -> dict[str, float]:
    """Words and stems with the log odds of their document frequency among rows labelled 1, from ``label`` and text.

    At most ``candidates`` entries (those in most rows of label 1) are counted and ``max_words`` kept."""
    narrow = on_workers(sample.select("label", F.coalesce(F.col(text_col), F.lit("")).alias("text")))

    def counts(df: DataFrame, wanted: frozenset | None) -> DataFrame:
        def run(batches):
            for batch in batches:
                seen: dict[str, list[int]] = {}
                for label, text in zip(*(c.to_pylist() for c in batch.columns)):
                    for x in {x for w in set(text.split()) for x in _candidates(w)}:
                        if wanted is None or x in wanted:
                            seen.setdefault(x, [0, 0])[int(label)] += 1
                yield pa.RecordBatch.from_arrays(
                    [pa.array(list(seen)), pa.array([v[0] for v in seen.values()], pa.int64()),
                     pa.array([v[1] for v in seen.values()], pa.int64())], ["entry", "clean", "toxic"])

        return df.mapInArrow(run, "entry string, clean bigint, toxic bigint").groupBy("entry").agg(
            F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic"))

    sizes = {r["label"]: r["count"] for r in narrow.groupBy("label").count().collect()}
    first = counts(narrow.where("label = 1"), None).where(F.col("toxic") >= min_docs)
    wanted = frozenset(r["entry"] for r in first.orderBy(F.desc("toxic"), "entry").limit(candidates).collect())
    out = []
    for r in counts(narrow, wanted).collect():
        p = (r["toxic"] + 0.5) / (sizes.get(1.0, 0) + 1)
        q = (r["clean"] + 0.5) / (sizes.get(0.0, 0) + 1)
        odds = float(np.log(p / (1 - p)) - np.log(q / (1 - q))) if p < 1 and q < 1 else 0.0
        if odds >= min_log_odds:
            out.append((odds * np.sqrt(r["toxic"]), r["entry"], odds))
    return {entry: odds for _, entry, odds in sorted(out, reverse=True)[:max_words]}


class ToxicityModel:
    """Lexicon, trees and calibration; a constant share where nothing could be learned."""

    def __init__(self, share: float, lexicon=None, trees=None, calibration=None):
        self.share, self.lexicon, self.trees, self.calibration = share, lexicon, trees, calibration

    def apply(self, docs: DataFrame, keep: list[str], text_col: str = "text") -> DataFrame:
        """Columns ``keep`` and ``score`` of every row."""
        if self.trees is None:
            return docs.select(*keep, F.lit(self.share).alias("score"))
        rows = dense_features(docs, self.lexicon, keep, text_col).withColumn("features", array_to_vector("features"))
        rows = self.trees.transform(rows).withColumn("raw", vector_to_array("probability")[1])
        # the trees' own order is kept inside a step of the calibration
        score = 0.99 * F.col("fitted") + 0.01 * F.col("raw")
        return self.calibration.transform(rows).select(
            *keep, F.least(F.lit(1.0), F.greatest(F.lit(0.0), score)).alias("score"))


def fit_toxicity(docs: DataFrame, labels: DataFrame, max_train: int = 24_000, trees: int = 20, depth: int = 4,
                 id_col: str = "doc_id", text_col: str = "text", seed: int = 7) -> ToxicityModel:
    """Learn from at most ``max_train`` labelled rows whose crc32(id) modulo 5 is not 0."""
    docs = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    sample = labelled_sample(docs, labels.withColumnRenamed(id_col, "doc_id"), "toxic", max_train)
    sample = written(sample.select("text", "label", "part"), "toxic-sample")
    by = {r["label"]: r["count"] for r in sample.groupBy("label").count().collect()}
    if min(by.get(0.0, 0), by.get(1.0, 0)) < 10:
        return ToxicityModel((by.get(1.0, 0) + 1) / (sum(by.values()) + 2))
    lexicon = learn_lexicon(sample.where("part < 45"))
    known = written(dense_features(sample.where("part >= 45"), lexicon, ["label", "part"]), "toxic-features").withColumn(
        "features", array_to_vector("features"))
    boosted = GBTClassifier(labelCol="label", featuresCol="features", maxIter=trees, maxDepth=depth, maxBins=64,
                            stepSize=0.2, seed=seed).fit(known.where("part < 85"))
    rest = boosted.transform(known.where("part >= 85")).select("label", vector_to_array("probability")[1].alias("raw"))
    calibration = IsotonicRegression(labelCol="label", featuresCol="raw", predictionCol="fitted").fit(rest)
    return ToxicityModel(0.0, lexicon, boosted, calibration)


def toxicity_scores(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    **fit) -> DataFrame:
    """``doc_id``, ``held_out``, ``score`` (0 to 1), ``predicted`` for every row of ``docs``.

    Only labels of ids with crc32(id) modulo 5 other than 0 are used. A null text counts as empty and is scored;
    a null id is scored, too (its crc is that of the empty text). Repeated rows are scored alike. With fewer than
    ten labels of a kind every score is the smoothed share of label 1. Other columns of ``docs`` are never inputs;
    an empty table gives no rows.
    """
    model = fit_toxicity(docs, labels, id_col=id_col, text_col=text_col, **fit)
    rows = model.apply(docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")), ["doc_id"])
    return rows.select("doc_id", (id_crc_mod("doc_id", 5) == 0).alias("held_out"), "score",
                       (F.col("score") >= 0.5).cast("int").alias("predicted"))


def toxicity_filter(docs: DataFrame, labels: DataFrame, most: float = 0.5, **fit) -> DataFrame:
    """Rows of ``docs``, all columns as they were, with a toxicity score under ``most``."""
    model = fit_toxicity(docs, labels, **fit)
    return model.apply(docs.withColumn("__row", F.struct("*")), ["__row"]).where(F.col("score") < most).select("__row.*")
