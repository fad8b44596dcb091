import random
from collections import Counter, defaultdict

import numpy as np
import pytest

from obslake.llm import neardup
from obslake.llm.common import marked
from obslake.llm.graph import bucket_links


def shingles(text: str) -> Counter:
    words = (text or "").lower().split()
    return Counter(tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))) if words else Counter()


def brute_classes(rows: list) -> set:
    """Components of all pairs with Jaccard similarity of 5-word shingles of 0.8 or more."""
    counts = [shingles(text) for _, text in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, a in enumerate(counts):
        for j, b in enumerate(counts[:i]):
            both, either = sum((a & b).values()), sum((a | b).values())
            if (both / either if either else 1.0) >= 0.8 and bool(a) == bool(b):
                root[find(i)] = find(j)
    groups = defaultdict(list)
    for i, (doc_id, _) in enumerate(rows):
        groups[find(i)].append(str(doc_id))
    return {tuple(sorted(g)) for g in groups.values()}


def test_similarity_is_an_alignment():
    rng = random.Random(4)
    for _ in range(200):
        a = np.array(rng.sample(range(1000), 60), np.uint64)
        b = np.array([x for x in a if rng.random() > 0.08] + rng.sample(range(1000, 1100), rng.randint(0, 5)), np.uint64)
        if rng.random() < 0.3:
            i = rng.randint(0, len(b) - 6)
            b[i : i + 5] = b[i : i + 5][::-1].copy()
        table = np.zeros((len(a) + 1, len(b) + 1), int)
        for i in range(len(a)):
            for j in range(len(b)):
                table[i + 1, j + 1] = table[i, j] + 1 if a[i] == b[j] else max(table[i, j + 1], table[i + 1, j])
        common = table[-1, -1]
        exact = common / (len(a) + len(b) - common)
        mine = neardup.similarity(a, b, 0.6)
        assert mine == exact if exact >= 0.6 else mine < 0.62


def test_labels_tell_occurrences_apart():
    words = np.array([1, 2, 3, 4, 5, 1, 2, 3, 4, 5, 1, 2, 3, 4, 5], np.uint64)
    found = neardup.labelled_shingles(words)
    assert len(found) == 11 and len(set(found.tolist())) == 11
    assert len(neardup.labelled_shingles(words[:2])) == 1 and len(neardup.labelled_shingles(words[:0])) == 0


def test_blocks_do_not_change_bands(monkeypatch):
    values = neardup.mix(np.arange(5000, dtype=np.uint64))
    whole = neardup.bands(values)
    monkeypatch.setattr(neardup, "BLOCK", 700)
    assert (neardup.bands(values) == whole).all()


def test_order_matters_to_a_sketch():
    values = neardup.mix(np.arange(40, dtype=np.uint64))
    assert not set(neardup.bands(values).tolist()) & set(neardup.bands(values[::-1]).tolist())


def test_classes_equal_brute_force(corpus):
    rows = neardup.near_classes(corpus).toPandas()
    assert len(rows) == corpus.count()
    expected = brute_classes([(r["doc_id"], r["text"]) for r in corpus.select("doc_id", "text").collect()])
    rows["name"] = rows.doc_id.map(lambda i: "None" if i != i else str(int(i)))
    rows["of"] = rows.class_id.map(lambda i: "None" if i != i else str(int(i)))
    found = {tuple(sorted(group)) for group in rows.groupby("of")["name"].apply(list)}
    assert found == expected
    sizes = rows.groupby("of").size()
    assert (rows.class_size == rows.of.map(sizes)).all()


@pytest.mark.parametrize("seed", [1, 2])
def test_planted_copies(spark, seed):
    rng = random.Random(seed)
    rows = []
    for group in range(30):
        words = [f"w{rng.randint(0, 4000)}" for _ in range(rng.randint(30, 300))]
        rows.append((len(rows), " ".join(words)))
        for _ in range(rng.randint(0, 6)):
            copy = list(words)
            for _ in range(rng.randint(0, max(1, len(words) // 60))):
                copy[rng.randrange(len(copy))] = f"z{rng.randint(0, 99)}"
            rows.append((len(rows), " ".join(copy)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = neardup.near_classes(docs).toPandas().groupby("class_id").doc_id.apply(lambda ids: tuple(sorted(map(str, ids))))
    assert set(found) == brute_classes(rows)


def test_one_of_each_class_is_kept(corpus, nothing):
    kept = neardup.deduplicated(corpus)
    assert kept.columns == corpus.columns
    rows = kept.select("doc_id").toPandas()
    classes = neardup.near_classes(corpus).toPandas()
    assert len(rows) == classes.class_id.nunique(dropna=False)
    assert set(rows.doc_id.dropna()) == set(classes.class_id.dropna())
    assert neardup.near_classes(nothing).count() == 0 and neardup.deduplicated(nothing).count() == 0


def test_parities_never_exceed_the_difference():
    rng = np.random.default_rng(3)
    for _ in range(100):
        a = rng.integers(0, 2**63, rng.integers(0, 300)).astype(np.uint64)
        b = np.concatenate([a[rng.random(len(a)) > 0.2], rng.integers(0, 2**63, rng.integers(0, 40)).astype(np.uint64)])
        bits = np.unpackbits((neardup.parities(a) ^ neardup.parities(b)).view(np.uint8)).sum()
        assert bits <= len(set(a.tolist()) ^ set(b.tolist()))


def test_long_parities_tell_long_texts_apart():
    rng = np.random.default_rng(4)
    base = rng.integers(0, 2**63, 900).astype(np.uint64)
    for like, linked in ((0.7, False), (0.95, True)):
        x, y = (np.concatenate([base[: int(900 * like)], rng.integers(0, 2**63, 900 - int(900 * like)).astype(np.uint64)]) for _ in "xy")
        unlike = len(set(x.tolist()) ^ set(y.tolist()))
        most = (len(x) + len(y)) * 0.2 / 1.8
        bits = np.unpackbits((neardup.parities(x, 64) ^ neardup.parities(y, 64)).view(np.uint8)).sum()
        assert (bits <= most) == (unlike <= most) == linked and bits <= unlike
    wide = neardup.parities(base, 16)
    assert (wide[:8] ^ wide[8:] == neardup.parities(base, 8)).all()


@pytest.fixture
def measured_rows(monkeypatch):
    """Rows that each call of the measure gets."""
    found, measure = [], neardup._measured

    def counted(pairs, words, least):
        found.append(pairs.count())
        return measure(pairs, words, least)

    monkeypatch.setattr(neardup, "_measured", counted)
    return found


def test_unlinked_copies_of_a_long_text_are_not_all_compared(spark, measured_rows):
    """Texts that lie 0.72 to 0.78 apart from each other share many buckets, and none is linked to another."""
    rng = random.Random(8)
    base = [f"w{i}" for i in range(1200)]
    rows = []
    for number in range(60):
        words = list(base)
        for at in rng.sample(range(0, 1200, 8), 25):
            words[at] = f"z{number}x{at}"
        rows.append((number, " ".join(words)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = neardup.near_classes(docs).toPandas().groupby("class_id").doc_id.apply(lambda ids: tuple(sorted(map(str, ids))))
    assert set(found) == brute_classes(rows)
    assert sum(measured_rows[2:]) <= 60


def test_a_text_whose_parts_changed_places_is_linked(spark):
    """The pivot is farther than it looks from a text with parts in another order; that must not part two linked ones."""
    words = iter(neardup.mix(np.arange(1, 400, dtype=np.uint64)).tolist())
    a, c, b, new = ([next(words) for _ in range(size)] for size in (60, 4, 60, 30))
    p = a + c + b
    x = b + c + a
    texts = {1: p, 2: p[:60] + new, 3: x, 4: x[:-24]}
    values = {key: np.array(value, np.uint64) for key, value in texts.items()}
    assert neardup.similarity(values[3], values[4], 0.6) >= 0.8
    radius = 0.2 + 1e-9

    def distance(pairs):
        rows = [(r["a"], r["b"], 1 - neardup.similarity(values[r["a"]], values[r["b"]], 1 - 2 * radius)) for r in pairs.collect()]
        return spark.createDataFrame(rows, "a long, b long, d double")

    members = spark.createDataFrame([(0, key) for key in texts], "key long, id long")
    links = {(r["a"], r["b"]) for r in bucket_links(members, distance, radius).collect()}
    assert (3, 4) in links


def test_marked_rows_miss_no_id(spark):
    rows = spark.range(5000).selectExpr("xxhash64(id) AS __id", "id AS n")
    found = marked(rows, rows.where("n % 7 = 0").selectExpr("__id AS id"), "known")
    assert found.where("n % 7 = 0 AND NOT known").count() == 0
    assert found.where("n % 7 <> 0 AND known").count() < 10 and found.count() == 5000
    assert marked(rows, rows.where("false").selectExpr("__id AS id"), "known").where("known").count() == 0
