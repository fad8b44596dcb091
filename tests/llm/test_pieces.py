import math
import random
from collections import Counter

import numpy as np
import pytest

from obslake.llm import pieces


@pytest.fixture(scope="module")
def encoder():
    return pieces.Encoder(pieces.model_path())


def segmentations(encoder, word: str):
    """All segmentations of a word (a space in front) with their weights."""
    word = word.replace(" ", pieces.MARK)
    vocabulary = encoder.vocabulary
    if not word:
        return {(): 1.0}
    out = {}
    for size in range(1, len(word) + 1):
        if (piece := vocabulary.pieces.get(word[:size])) is not None:
            for rest, weight in segmentations(encoder, word[size:]).items():
                out[(piece, *rest)] = weight * math.exp(vocabulary.weight[piece])
    return out


def test_draws_follow_the_lattice(encoder):
    word = "houses"
    weights = segmentations(encoder, " " + word)
    total = sum(weights.values())
    size = 20_000
    drawn = Counter(tuple(x.tolist()) for x in encoder.encode([word] * size, np.arange(size, dtype=np.uint64) * np.uint64(77)))
    assert set(drawn) <= set(weights) and len(weights) > 20
    for segmentation, weight in weights.items():
        share = weight / total
        assert abs(drawn[segmentation] / size - share) < 5 * math.sqrt(share / size) + 1e-3


def test_round_trip(encoder):
    rng = random.Random(3)
    signs = [" ", "  ", "\n", "a", "The", "é", "b.", "12_3", "\t", "中", " ", "🙂", "\r", "▁", "x▁y", "\x00", "̀", "ﬁ", "٣"]
    texts = ["".join(rng.choices(signs, k=rng.randint(0, 14))) for _ in range(3000)] + ["", " ", "word " * 20_000, "a" * 5000]
    ids = encoder.encode(texts, np.arange(len(texts), dtype=np.uint64))
    assert [encoder.decode(x) for x in ids] == texts


def test_words_are_cached_and_cleared_alike(encoder, monkeypatch):
    rng = random.Random(4)
    texts = [" ".join(f"w{rng.randint(0, 300)}" for _ in range(50)) for _ in range(40)]
    seeds = np.arange(40, dtype=np.uint64)
    first = encoder.encode(texts, seeds)
    monkeypatch.setattr(pieces, "WORDS", 10)
    again = [encoder.encode([t], seeds[i : i + 1])[0] for i, t in enumerate(texts)]
    assert all((a == b).all() for a, b in zip(first, again, strict=True))


def test_draws_do_not_depend_on_what_a_worker_saw_before():
    """All draws of a word by fresh caches, in other company, and after many other words."""
    rng = random.Random(6)
    words = ["international", "a", "straße", "中文字", "x" * 40]
    seeds = np.arange(4000, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    others = [" ".join("".join(rng.choices("abcdeéinrst", k=rng.randint(2, 12))) for _ in range(60_000))]
    old = pieces.Encoder(pieces.model_path())
    old.encode(others, seeds[:1])
    for word in words:
        fresh = pieces.Encoder(pieces.model_path()).encode([word] * 4000, seeds)
        company = pieces.Encoder(pieces.model_path()).encode(["b " + word if n % 2 else word for n in range(4000)], seeds)
        used = old.encode([word] * 4000, seeds)
        assert all(np.array_equal(a, b) for a, b in zip(fresh, used, strict=True))
        assert all(np.array_equal(a, b) for a, b in zip(fresh[::2], company[::2], strict=True))


def test_rows_are_reproducible_and_lossless(corpus, nothing):
    rows = pieces.encoded(corpus)
    one, two = (sorted((str(r["doc_id"]), r["n_pieces"], tuple(r["ids"]), r["lossless"]) for r in df.collect()) for df in (rows, pieces.encoded(corpus.repartition(3))))
    assert one == two and all(r[3] for r in one) and len(one) == corpus.count()
    assert any(a[2] != b[2] for a, b in zip(one, sorted((str(r["doc_id"]), r["n_pieces"], tuple(r["ids"])) for r in pieces.encoded(corpus, salt=1).collect()), strict=True))
    back = sorted((str(r["doc_id"]), r["text"]) for r in pieces.decoded(rows).collect())
    assert back == sorted((str(r["doc_id"]), r["text"] or "") for r in corpus.select("doc_id", "text").collect())
    assert pieces.encoded(nothing).count() == 0
