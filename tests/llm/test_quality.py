import random

import numpy as np

from obslake.llm import quality
from tests.llm.conftest import sentence


def labelled(spark, size=400):
    rng = random.Random(8)
    rows, labels = [], []
    for i in range(size):
        good = i % 3 > 0
        text = sentence(rng, "en", rng.randint(20, 80))
        if not good:
            text = " ".join(w + "%%%" for w in text.upper().split())
        rows.append((i, text, "en", f"{'good' if good and rng.random() < 0.8 else 'bad'}{i % 2}", len(text)))
        if i < size // 2:
            labels.append((i, int(good), 0))
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    return docs, spark.createDataFrame(labels, "doc_id long, quality int, toxic int")


def test_unlabelled_documents_are_told_apart(spark):
    docs, labels = labelled(spark)
    rows = quality.scored(docs, labels).toPandas()
    truth = rows.doc_id % 3 > 0
    assert len(rows) == 400 and (rows.keep == truth)[rows.doc_id >= 200].mean() > 0.98
    assert rows[["text_score", "meta_score", "score"]].stack().between(0, 1).all()
    kept = quality.good_documents(docs, labels)
    assert kept.columns == docs.columns
    assert {r["doc_id"] for r in kept.select("doc_id").collect()} == set(rows.doc_id[rows.keep])


def test_pseudo_labels_teach_the_other_view():
    rng = np.random.default_rng(0)
    truth = rng.integers(0, 2, 1500)
    a = truth[:, None] * 2.0 + rng.normal(0, 0.5, (1500, 3))
    b = truth[:, None] * 2.0 + rng.normal(0, 0.5, (1500, 40))
    labels = np.where(np.arange(1500) < 60, truth, -1)
    aside = np.arange(1500) % 3 == 0
    alone = quality.co_train([a, b], labels, aside, rounds=0)
    taught = quality.co_train([a, b], labels, aside, rounds=3)
    right = [((m.views[1].logit(b) > 0) == truth)[60:].mean() for m in (alone, taught)]
    assert right[1] >= right[0] and right[1] > 0.97
    assert ((taught.scores([a, b])[2] > 0.5) == truth)[60:].mean() > 0.98


def test_odd_rows_and_tables(spark, corpus, nothing):
    _, labels = labelled(spark)
    messy = labels.unionByName(spark.createDataFrame([(0, 1, 0), (0, 0, 0), (None, 1, 0), (5, None, 0), (9999, 1, 1)], labels.schema))
    rows = quality.scored(corpus, messy).toPandas()
    assert len(rows) == corpus.count() and rows.score.notna().all()
    assert (rows.groupby("doc_id").score.nunique() == 1).all()
    plain = quality.scored(corpus, labels.where("false")).toPandas()
    assert (plain.score == 0.5).all() and plain.keep.all()
    assert quality.scored(nothing, labels).count() == 0
    assert quality.good_documents(corpus, labels.where("quality = 1")).count() == corpus.count()
