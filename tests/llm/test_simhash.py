import hashlib
from collections import defaultdict

import numpy as np

from obslake.llm import simhash
from obslake.llm.graph import bucket_links, components


def test_columns_follow_the_next_document(corpus):
    rows = simhash.fingerprinted(corpus.where("doc_id IS NOT NULL").dropDuplicates(["doc_id"])).toPandas().sort_values("doc_id")
    texts = {r["doc_id"]: r["text"] or "" for r in corpus.where("doc_id IS NOT NULL").collect()}
    order = sorted(texts)
    following = dict(zip(order, [*order[1:], order[0]], strict=True))
    assert rows.doc_id.tolist() == order
    for row in rows.itertuples():
        text, after = texts[row.doc_id], texts[following[row.doc_id]]
        quarter = len(text) // 4
        changed = text[: len(text) - quarter] + after[:quarter]
        assert row.n_chars == len(text) and row.edited_sha256 == hashlib.sha256(changed.encode()).hexdigest()
        one, two, three = (simhash.fingerprints([t]) for t in (text, changed, after))
        assert row.fingerprint == one.tobytes().hex() and row.edited_fingerprint == two.tobytes().hex()
        assert row.near_edited == simhash.likeness(one, two)[0] and row.near_next == simhash.likeness(one, three)[0]


def test_repeated_rows_empty_table_and_single_row(corpus, nothing):
    rows = simhash.fingerprinted(corpus).toPandas()
    assert len(rows) == corpus.count()
    assert (rows.groupby("doc_id").fingerprint.nunique() == 1).all()
    assert simhash.fingerprinted(nothing).count() == 0
    one = simhash.with_next(corpus.where("doc_id = 7")).first()
    assert one["near_next"] == 1.0


def test_votes_equal_brute_force():
    text = "One two  three two three one two three four"
    words = text.lower().split()
    votes = np.zeros(128)
    hashes = simhash.word_hashes(words)
    for i in range(len(words) - 2):
        term = simhash.mix(hashes[i : i + 1])
        for step in (1, 2):
            term = simhash.mix(term ^ (hashes[i + step : i + step + 1] + np.uint64(step)))
        bits = np.concatenate([np.unpackbits(simhash.mix(term + np.uint64(lane)).view(np.uint8)) for lane in (1, 2)])
        votes += (2.0 * bits - 1) * sum(map(len, words[i : i + 3]))
    assert (simhash.fingerprints([text])[0] == np.packbits(votes > 0)).all()


def test_block_tables_find_all_within_the_radius(spark):
    rng = np.random.default_rng(0)
    centres = rng.integers(0, 256, (12, 16), np.uint8)
    prints = {centre.tobytes().hex() for centre in centres}
    for centre in centres:
        for flips in (1, 2, 3, 4, 5):
            bits = np.unpackbits(centre)
            bits[rng.choice(128, flips, replace=False)] ^= 1
            prints.add(np.packbits(bits).tobytes().hex())
    prints = sorted(prints)
    values = [int(p, 16) for p in prints]
    classes = {r["fingerprint"]: r["fingerprint_class"] for r in simhash.near_classes(spark.createDataFrame([(p,) for p in prints], "fingerprint string")).collect()}
    root = list(range(len(prints)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(prints)):
        for j in range(i):
            if bin(values[i] ^ values[j]).count("1") <= 3:
                root[find(i)] = find(j)
    groups = defaultdict(set)
    for i, p in enumerate(prints):
        groups[find(i)].add(p)
    assert {frozenset(g) for g in groups.values()} == {frozenset(p for p in prints if classes[p] == c) for c in set(classes.values())}


def test_bucket_links_connect_like_all_pairs(spark):
    rng = np.random.default_rng(1)
    places = rng.uniform(0, 30, 150)
    members = spark.createDataFrame([(int(k), i) for i in range(150) for k in rng.choice(6, 2, replace=False)], "key long, id long")
    values = spark.createDataFrame([(i, float(x)) for i, x in enumerate(places)], "id long, x double")

    def distance(pairs):
        a, b = values.toDF("a", "x"), values.toDF("b", "y")
        return pairs.join(a, "a").join(b, "b").selectExpr("a", "b", "abs(x - y) AS d")

    found = {r["node"]: r["class"] for r in components(bucket_links(members, distance, 0.4)).collect()}
    buckets = defaultdict(set)
    for r in members.collect():
        buckets[r["key"]].add(r["id"])
    pairs = [(i, j) for ids in buckets.values() for i in ids for j in ids if i < j and abs(places[i] - places[j]) <= 0.4]
    expected = {r["node"]: r["class"] for r in components(spark.createDataFrame(pairs, "a long, b long")).collect()}
    assert found == expected
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0
