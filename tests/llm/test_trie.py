import hashlib
import random
import zlib
from collections import defaultdict

import pytest

from obslake.llm import trie

SCHEMA = "conv_id long, turn long, role string, text string, key string, depth long"


def brute(rows, block=1, shared=9):
    turns = defaultdict(list)
    for conv_id, turn, role, text, *_ in rows:
        if conv_id is not None:
            role, text = role or "", text or ""
            digest = hashlib.sha256(f"{len(role)}:{role}{text}".encode()).digest()
            turns[conv_id].append(((turn is not None, turn or 0), digest, (role, text)))
    own = {c: [t[2] for t in sorted(found)] for c, found in turns.items()}
    built = {}
    for c, said in own.items():
        base = c - (abs(c) % block) * (1 if c >= 0 else -1)
        h = zlib.crc32(str(c).encode()) % shared
        built[c] = tuple(said if base == c else own.get(base, [])[:h] + said[h:])
    members = defaultdict(list)
    for c, said in built.items():
        for d in range(len(said) + 1):
            members[said[:d]].append(c)
    rows = []
    for node, found in members.items():
        below = [n for n in members if n[: len(node)] == node]
        inner = {n[:-1] for n in members if n}
        ends = sorted(c for c in found if len(built[c]) == len(node))
        rows.append((
            min(found), len(node), min(members[node[:-1]]) if node else None, len(found),
            sum(1 for n in below if len(n) == len(node) + 1), sum(1 for n in below if n not in inner),
            sum((len(members[n]) - 1) * len(n[-1][1].encode()) for n in below if n),
            hashlib.sha256(",".join(map(str, ends)).encode()).hexdigest(),
        ))
    return sorted(rows, key=lambda r: r[:2])


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(4)
    said = [("user", "hé 🙂"), ("assistant", "yes"), ("user", None), (None, "no"), ("", "x" * 50), ("user", "")]
    found = []
    for c in [*range(40), *range(-7, 0), 1000, 1001, 5002]:
        found += [(c, t, *rng.choice(said[: 2 + t % 3])) for t in range(rng.randint(1, 12))]
    found += [(c, t, *said[t]) for c in range(100, 130) for t in range(3)]  # copies
    found += [(130, t, "user", "long " * 10_000) for t in range(60)]
    found += [(131, None, "user", "b"), (131, None, "user", "a"), (131, 0, "user", "c"), (131, 0, "user", "c"), (131, -1, "user", "d")]
    found += [(None, 0, "user", "lost"), (3, None, "user", "first")]
    found += found[:5]
    return [(*row, "clash", 7) for row in found]


@pytest.mark.parametrize("block", [1, 5])
def test_nodes_equal_brute_force(spark, rows, block, monkeypatch):
    monkeypatch.setattr(trie, "ENDS", 7)
    found = trie.prefix_trie(spark.createDataFrame(rows, SCHEMA).repartition(5), block).collect()
    names = ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")
    assert sorted((tuple(r[n] for n in names) for r in found), key=lambda r: r[:2]) == brute(rows, block)


def test_shared_nodes_are_joined_by_broadcast_or_shuffle_alike(spark, rows, monkeypatch):
    found = []
    for hot in (1, 1_000_000):
        monkeypatch.setattr(trie, "HOT", hot)
        found.append(sorted(map(tuple, trie.prefix_trie(spark.createDataFrame(rows, SCHEMA)).collect()), key=str))
    assert found[0] == found[1] == sorted(brute(rows), key=str)


def test_conversations_without_turns_end_at_the_root(spark):
    rows = [(c, 0, "user", "gone", "", 0) for c in range(10_001, 10_100) if zlib.crc32(str(c).encode()) % 9 and c % 5]
    found = trie.prefix_trie(spark.createDataFrame(rows, SCHEMA), 5).collect()
    assert [tuple(r) for r in found] == brute(rows, 5) and found[0]["n_convs"] == len(rows)
    assert trie.prefix_trie(spark.createDataFrame([], SCHEMA)).count() == 0
