import random
import zlib

import numpy as np
import pytest

from parcelkit.llm import quality, toxicity
from parcelkit.llm.toxicity import labelled_sample, learn_lexicon
from tests.llm.conftest import prose

BAD = ["grimwit", "sludgeon", "dolthead"]


@pytest.fixture(scope="module")
def corpus(spark):
    """900 documents; a fifth toxic (words of BAD, some with another ending), a fifth junk (repeats or marks)."""
    rng = random.Random(4)
    rows, labels = [], []
    for i in range(900):
        text, toxic, good = prose(rng, rng.randint(20, 80)), 0, 1
        if i % 5 == 0:
            words = text.split()
            for _ in range(4):
                words.insert(rng.randrange(len(words)), rng.choice(BAD) + rng.choice(["", "", "ly", "ness"]))
            text, toxic = "You " + " ".join(words), 1
        elif i % 5 == 1:
            text, good = (" ".join(w + "$$$" for w in text.split()) if i % 2 else " ".join([text.split()[0]] * 60)), 0
        rows.append((i, text, "en", f"s{i % 7}", len(text)))
        if i % 10 != 9:
            labels.append((i, good, toxic))
    return (spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint"),
            spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int"))


def accuracy(scored, labels, column):
    truth = {r.doc_id: r[column] for r in labels.collect()}
    held = [(r.predicted, truth[r.doc_id]) for r in scored.collect() if r.held_out and r.doc_id in truth]
    assert len(held) > 100
    return np.mean([p == t for p, t in held])


def test_toxicity_held_out(spark, corpus):
    docs, labels = corpus
    scored = toxicity.toxicity_scores(docs, labels, trees=5, depth=3).cache()
    assert scored.count() == 900 and scored.where("score < 0 or score > 1 or score is null").count() == 0
    assert {r.doc_id for r in scored.where("held_out").collect()} == {i for i in range(900) if zlib.crc32(str(i).encode()) % 5 == 0}
    assert accuracy(scored, labels, "toxic") > 0.95
    kept = toxicity.toxicity_filter(docs, labels, trees=5, depth=3)
    assert kept.columns == docs.columns and 650 < kept.count() < 780


def test_labels_of_held_out_rows_change_nothing(spark, corpus):
    docs, labels = corpus
    flipped = labels.selectExpr("doc_id", "quality", "if(crc32(cast(doc_id as string)) % 5 = 0, 1 - toxic, toxic) toxic")
    a = toxicity.toxicity_scores(docs, labels, trees=3, depth=2).toPandas().sort_values("doc_id")
    b = toxicity.toxicity_scores(docs, flipped, trees=3, depth=2).toPandas().sort_values("doc_id")
    assert np.allclose(a["score"], b["score"])


def test_quality_held_out(spark, corpus):
    docs, labels = corpus
    scored = quality.quality_scores(docs, labels).cache()
    assert scored.count() == 900 and accuracy(scored, labels, "quality") > 0.95
    kept = quality.quality_filter(docs, labels)
    assert kept.columns == docs.columns and 680 < kept.count() < 760


def test_lexicon_holds_words_and_stems(spark, corpus):
    docs, labels = corpus
    lexicon = learn_lexicon(labelled_sample(docs, labels, "toxic", 10_000))
    assert set(BAD) <= set(lexicon) and {"grimwi*", "sludge*"} <= set(lexicon) and "alder" not in lexicon


def test_sample_is_bounded_and_uses_training_ids(spark, corpus):
    docs, labels = corpus
    rows = labelled_sample(docs, labels.unionByName(labels), "toxic", 100).collect()
    assert len(rows) == 100 and all(zlib.crc32(str(r.doc_id).encode()) % 5 for r in rows)


def test_pseudo_labels_pass_between_views():
    rng = np.random.default_rng(0)
    y = rng.integers(0, 2, 60).astype(float)
    views = [np.column_stack([np.ones(60), y * 4 - 2 + rng.normal(size=60)]), np.column_stack([np.ones(60), rng.normal(size=60)])]
    hidden = rng.integers(0, 2, 2000)
    pools = [np.column_stack([np.ones(2000), hidden * 4 - 2 + rng.normal(size=2000)]), np.column_stack([np.ones(2000), hidden * 2 - 1 + rng.normal(size=2000)])]
    alone = quality.co_train(views, y, pools, 0, 0.2, 0.9)
    taught = quality.co_train(views, y, pools, 3, 0.2, 0.9)
    right = [((pools[1] @ w[1] > 0) == hidden).mean() for w in (alone, taught)]
    assert right[1] > 0.8 and right[1] > right[0]


def test_odd_rows_and_no_labels(spark, corpus, odd_docs, no_docs):
    _, labels = corpus
    docs, labelled = corpus
    for score, keep in ((toxicity.toxicity_scores, toxicity.toxicity_filter), (quality.quality_scores, quality.quality_filter)):
        got = score(odd_docs, labels.where("false")).collect()
        assert len(got) == 14 and len({r.score for r in got}) == 1
        assert score(no_docs, labels).count() == 0
        assert keep(odd_docs, labels.where("false")).columns == odd_docs.columns
    both = docs.unionByName(odd_docs.select(docs.columns))
    for score in (toxicity.toxicity_scores, quality.quality_scores):
        got = score(both, labelled).collect()
        assert len(got) == 914 and all(0 <= r.score <= 1 for r in got)
