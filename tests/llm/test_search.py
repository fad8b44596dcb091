import random

import numpy as np
import pytest

from obslake.llm import search

SCHEMA = "vec_id long, embedding array<float>, label int"


def brute(rows: list, k: int, every: int) -> list:
    kept: dict[int, list] = {}
    for vec_id, vector, _ in rows:
        if vec_id is None or vector is None or any(x is None or not np.isfinite(x) for x in vector):
            continue
        whole = [int(np.floor(256 * float(np.float32(x)))) for x in vector]
        kept[vec_id] = min(kept.get(vec_id, whole), whole)
    out = []
    for query, a in kept.items():
        if query % every:
            continue
        scores = sorted((-sum(x * y for x, y in zip(a, b, strict=False)), other) for other, b in kept.items() if other != query)
        out += [(query, rank, other, -score) for rank, (score, other) in enumerate(scores[:k], 1)]
    return sorted(out)


def found(df) -> list:
    return sorted(tuple(r) for r in df.collect())


@pytest.mark.parametrize("seed", range(3))
def test_results_equal_brute_force(spark, seed, monkeypatch):
    monkeypatch.setattr(search, "BLOCK", 16)
    monkeypatch.setattr(search, "GROUP", 4)
    rng = np.random.default_rng(seed)
    rows = [(i, [float(x) for x in rng.normal(0, 0.3, 6)], 0) for i in range(300)]
    hot = [float(x) for x in rng.normal(0, 0.3, 6)]
    rows += [(i, hot, 1) for i in range(300, 450)]  # a third of all vectors are equal
    rows += [(500, None, 0), (550, [1.0, None], 0), (551, [float("nan")] * 6, 0), (552, [float("inf")] * 6, 0)]
    rows += [(None, hot, 0), (600, [0.5], 0), (650, [], 0), rows[50], (700, [3e38, -3e38], 0)]
    table = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 AS score", "2 AS rank").repartition(4)
    rows = [r if r[0] != 700 else (700, [(2**31 - 1) / 256, -(2**31 - 1) / 256], 0) for r in rows]
    expected = brute([r for r in rows if r[0] != 700], 5, 50)
    got = found(search.nearest(table.where("vec_id IS NULL OR vec_id <> 700"), pivots=5))
    assert got == expected
    assert search.nearest(table).where("query_id = 700").count() == 5


def test_few_candidates_and_empty_table(spark):
    table = spark.createDataFrame([(0, [1.0], 0), (1, [2.0], 0), (50, [1.0], 0)], SCHEMA)
    assert found(search.nearest(table)) == [(0, 1, 1, 131072), (0, 2, 50, 65536), (50, 1, 1, 131072), (50, 2, 0, 65536)]
    assert search.nearest(table.where("false")).count() == 0


def test_bounds_skip_far_annuli():
    """Two far clusters: a query never visits the other one once its own gives k better scores."""
    rng = random.Random(0)
    near = [[100 + rng.randint(-3, 3), rng.randint(-3, 3)] for _ in range(50)]
    far = [[-100 + rng.randint(-3, 3), rng.randint(-3, 3)] for _ in range(50)]
    space = search.Space(2, float(max(x * x + y * y for x, y in near + far)), [near[0], far[0]])
    blocks = []
    for pivot, rows in enumerate((near, far)):
        x = space.padded(rows)
        distance = space.to_pivots(x, query=False)[:, pivot]
        blocks.append((pivot, distance.min(), distance.max(), np.arange(50) + 100 * pivot, x))
    group = search.Search(space, np.array([-1]), space.padded([near[1]]), 5)
    visited = []
    visit = group.visit
    group.visit = lambda rows, ids, vectors: (visited.append(int(ids[0])), visit(rows, ids, vectors))
    group.expand(blocks)
    assert visited == [0]
