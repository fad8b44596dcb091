import random
import tracemalloc

import numpy as np

from obslake.llm import language
from tests.llm.conftest import sentence


def brute_phrases(reference: str, text: str) -> int:
    """Greedy longest matches; a letter that does not occur is a phrase."""
    phrases, start = 0, 0
    while start < len(text):
        end = start + 1
        while end <= len(text) and text[start:end] in reference:
            end += 1
        start = max(start + 1, end - 1)
        phrases += 1
    return phrases


def test_phrases_equal_brute_force():
    rng = random.Random(2)
    samples = {lang: [sentence(rng, lang, 60) for _ in range(3)] for lang in ("en", "fr")}
    model = language.Model.of(samples)

    def plain(text):
        return "".join(c.lower() if c.isalpha() else " " for c in text)

    def squeezed(text):
        words = " ".join(plain(text).split())
        return words + " " * (bool(text) and not text[-1].isalpha() and bool(words))

    references = {lang: " ".join(squeezed(text).strip() + " " * text.endswith((".", ",")) for text in texts) + " " for lang, texts in samples.items()}
    references = {lang: " ".join(reference.split()) + " " for lang, reference in references.items()}
    texts = [sentence(rng, rng.choice(["en", "fr"]), rng.randint(1, 40)) for _ in range(50)] + ["zzz qqq", "a", ""]
    bits, _ = model.phrases(texts)
    for row, text in enumerate(texts):
        for column, lang in enumerate(model.languages):
            mine = bits[row, column] / model.weights[column]
            assert abs(mine - brute_phrases(references[lang], squeezed(text))) <= 1, (text, lang)


def test_lanes_add_at_most_a_phrase_each():
    rng = random.Random(3)
    model = language.Model.of({"en": [sentence(rng, "en", 50)], "fr": [sentence(rng, "fr", 50)]})
    long = sentence(rng, "fr", 3000)
    whole, sizes = model.phrases([long])
    parts, _ = model.phrases([long[i : i + 500] for i in range(0, len(long), 500)])
    assert np.abs(whole[0] - parts.sum(axis=0)).max() <= model.weights.max() * (len(long) // 500 + 2)
    assert model.predict([long])[0] == ["fr"]


def test_predictions_of_all_rows(corpus):
    rows = language.identified(corpus).toPandas()
    assert len(rows) == corpus.count()
    truth = {r["doc_id"]: r["lang"] for r in corpus.select("doc_id", "lang").collect()}
    ordinary = rows[rows.doc_id < 120]
    assert (ordinary.lang_pred == ordinary.doc_id.map(truth)).mean() > 0.97
    odd = rows[rows.doc_id.isin([132, 133, 134, 135])]
    assert (odd.lang_pred == "und").all() and (odd.score == 0).all()
    assert rows.score.between(0, 1).all()
    assert not rows[rows.doc_id.isna()].held_out.any()


def test_held_out_rows_teach_nothing(corpus, spark):
    rows = corpus.select("doc_id", "text", "lang").withColumn("lang", language.F.when(language.held_out(), "zz").otherwise(language.F.col("lang")))
    assert rows.where("lang = 'zz'").count() > 10
    assert language.identified(rows).where("lang_pred = 'zz'").count() == 0


def test_filter_keeps_columns_and_drops_letterless(corpus):
    kept = language.known_language(corpus)
    assert kept.columns == corpus.columns
    ids = {row["doc_id"] for row in kept.select("doc_id").collect()}
    assert set(range(132)) <= ids and not ids & {132, 133, 134, 135}


def test_empty_and_unlabelled(nothing, corpus):
    assert language.identified(nothing).count() == 0
    rows = language.identified(corpus.withColumn("lang", language.F.lit(None).cast("string")))
    assert {row["lang_pred"] for row in rows.collect()} == {"und"}


def test_phrases_hold_few_bytes_a_character():
    rng = random.Random(5)
    model = language.Model.of({lang: [sentence(rng, lang, 60)] for lang in ("en", "fr")})
    texts = ["", " ", *(sentence(rng, "en", 400) for _ in range(400)), "12", sentence(rng, "fr", 30_000)]
    tracemalloc.start()
    try:
        _, sizes = model.phrases(texts)
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert peak < 16 * sum(map(len, texts))
    assert sizes[[0, 1, -2]].tolist() == [0, 0, 0] and (np.delete(sizes, [0, 1, -2]) > 0).all()
    assert sizes.tolist() == [len(language._symbols_of(model.symbols, text)) for text in texts]
