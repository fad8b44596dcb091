import hashlib
import math
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from obslake.llm import resample

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def features(text):
    lowered = (text or "").translate({c: c + 32 for c in range(ord("A"), ord("Z") + 1)})
    words = WORD.findall(lowered)
    return len(words), [zlib.crc32(f.encode()) % 10_000 for f in [*words, *map(" ".join, zip(words, words[1:]))]]


def brute(docs, target):
    s, t = (Counter(b for text in texts for b in features(text)[1]) for texts in ([d[1] for d in docs], target))
    corpus, wanted = s.total(), t.total()
    gain = [math.floor(1000 * math.log((t[b] + 1) * (corpus + 10_000) / ((s[b] + 1) * (wanted + 10_000)))) for b in range(10_000)]
    rows = []
    for doc_id, text in docs:
        words, found = features(text)
        weight = sum(gain[b] for b in found) // len(found) if found else 0
        score = None
        if doc_id is not None:
            h = int(hashlib.sha256(f"7:{doc_id}".encode()).hexdigest()[:8], 16)
            score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        rows.append((doc_id, len(found), weight, score, words))
    order = sorted((r for r in rows if r[4] >= 20 and r[3] is not None), key=lambda r: (-r[3], r[0]))
    drawn = Counter((r[0], n + 1) for n, r in enumerate(order[: 25 * len(order) // 100]))
    return sorted((r[:4] for r in rows), key=str), drawn


def test_resampled_equals_brute_force(spark, corpus):
    target = ["The river, and\n\nthe stone water", None, "", "light\nMORNING light é٣ x", "winter " * 50]
    found = resample.resampled(corpus, spark.createDataFrame([(t, 1) for t in target], "text string, doc_id int")).collect()
    rows, drawn = brute([(r["doc_id"], r["text"]) for r in corpus.collect()], target)
    assert sorted((tuple(r)[:4] for r in found), key=str) == rows
    assert Counter((r["doc_id"], r["rank"]) for r in found if r["rank"]) == drawn
    assert found[0].asDict().keys() == {"doc_id", "n_features", "weight", "score", "rank"}


@pytest.mark.parametrize("texts", [["", None, "A b\nC\n\nd", "x" * 100 + " " + "y" * 300, "é", "ab", "cd\n", "\nzZ9"], [], ["a"]])
def test_words_of_a_sliced_column(texts):
    column = pa.array(["before", *texts, "after"], pa.string()).slice(1, len(texts))
    words = resample.Words(column)
    row, bucket = words.features()
    want = [sorted(features(t)[1]) for t in texts]
    assert [sorted(bucket[row == r].tolist()) for r in range(len(texts))] == want
    lines = [f for t in texts for line in (t or "").split("\n") for f in features(line)[1]]
    assert Counter(lines) + Counter(words.crossing().tolist()) == Counter(f for part in want for f in part)


def test_repeated_lines_count_once_and_are_multiplied(spark):
    docs = spark.createDataFrame([("same line here\nother",)] * 300 + [("other\nsame line here",)] * 200, "text string")
    found = {r["bucket"]: r["found"] for r in resample.feature_counts(docs).collect()}
    bucket = {f: zlib.crc32(f.encode()) % 10_000 for f in ("same line", "here other", "other same", "line")}
    assert {f: found[b] for f, b in bucket.items()} == {"same line": 500, "here other": 300, "other same": 200, "line": 500}
    plan = docs.where("text != ''").selectExpr("explode(split(text, '\n')) AS line").groupBy("line").count()._jdf.queryExecution().toString()
    assert "partial_count" in plan  # lines are combined before they travel


def test_empty_tables(spark, corpus, nothing):
    assert resample.resampled(nothing, corpus).count() == 0
    found = resample.resampled(corpus, nothing)
    assert found.count() == corpus.count()
    assert np.all(resample.gains(nothing, nothing) == 0)


def test_drawn_documents_keep_their_columns(spark, corpus):
    some = resample.drawn(corpus, corpus)
    assert some.columns == corpus.columns and 0 < some.count() < corpus.count()
