import math
import random

import numpy as np
import pyarrow as pa
import pytest

from plateful.llm import topk
from tests.llm.cases import clashing

SCHEMA = "vec_id long, embedding array<float>, label int"


def plain(rows, k=10, every=100):
    usable = [(i, [math.floor(1024 * float(np.float32(x))) for x in v]) for i, v, *_ in rows
              if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    queries = {}
    for i, v in usable:
        if i % every == 0:
            queries[i] = min(v, queries.get(i, v))
    found = []
    for q, a in queries.items():
        scored = sorted((-sum(x * y for x, y in zip(a, b)), i) for i, b in usable if i != q)[:k]
        found += [(q, n + 1, i, -s) for n, (s, i) in enumerate(scored)]
    return sorted(found)


def found(spark, rows, **how):
    return sorted(map(tuple, topk.neighbours(spark.createDataFrame(rows, SCHEMA).repartition(3), **how).collect()))


@pytest.fixture
def small_pages(monkeypatch):
    for name, value in (("PIVOTS", 5), ("PAGE", 40), ("LEAF", 8), ("FANOUT", 3), ("QUERY_BLOCK", 3)):
        monkeypatch.setattr(topk, name, value)


def vectors(n, size=6, seed=1, spread=1.0):
    draw = random.Random(seed)
    centres = [[draw.gauss(0, spread) for _ in range(size)] for _ in range(8)]
    return [(i, [c + draw.gauss(0, 0.1) for c in centres[i % 8]], 0) for i in range(n)]


def test_matches_brute_force(spark, small_pages):
    rows = vectors(900)
    assert found(spark, rows) == plain(rows)


def test_far_clusters_and_a_page_as_one_row(spark, small_pages):
    """Queries need the pages near them; a page's tree, ids and vectors are one row that searches alike."""
    rows = vectors(900, spread=50.0)
    assert found(spark, rows) == plain(rows)
    v = np.array([[math.floor(1024 * float(np.float32(x))) for x in r[1]] for r in rows[:100]], dtype=np.int64)
    space = topk.Space(int((v * v).sum(axis=1).max()))
    page = pa.table([pa.array(range(100), pa.int64()), pa.array(v.tolist(), pa.list_(pa.int64()))], names=["vec_id", "v"])
    made = topk._built_page(space, (pa.scalar(3, pa.int32()), pa.scalar(4, pa.int32())), page)
    assert made.num_rows == 1 and made.column("pivot")[0].as_py() == 3
    queries = pa.table([pa.array([0]), pa.array([v[0].tolist()]), pa.array([None], pa.int64())], names=["query_id", "q", "known"])
    best = topk._search_page(space, 5, None, made, queries).to_pydict()
    scores = sorted(((int(v[i] @ v[0]), -i) for i in range(1, 100)), reverse=True)[:5]
    assert sorted(zip(best["score"], best["vec_id"]), key=lambda b: (-b[0], b[1])) == [(s, -i) for s, i in scores]


def test_many_equal_vectors(spark, small_pages):
    rows = [(i, [0.5, -0.25, 0.125] if i % 3 == 0 else v[:3], 0) for i, v, _ in vectors(600, 3)]
    assert found(spark, rows) == plain(rows)


def test_rows_of_one_id_spread_over_pages(spark, small_pages):
    dealt = spark.range(2000).selectExpr("7L AS vec_id", "0 AS pivot", "id AS row").withColumn("page", topk.page_of({0: 10}))
    assert max(r["count"] for r in dealt.groupBy("page").count().collect()) < 300
    rows = vectors(300) + [(7, v, 0) for _, v, _ in vectors(300, seed=2)]
    assert found(spark, rows) == plain(rows)


def test_components_whose_squares_pass_bigint(spark):
    """The lengths pass 2 ** 63, the scores of the queries do not."""
    rows = [(i, v, 0) for i, v, _ in vectors(250, 3)] + [(301, [4e6, 0.0, 1.0], 0), (302, [-4e6, 4e6, 0.0], 0), (303, [4e6] * 3, 0)]
    assert found(spark, rows) == plain(rows)


def test_ties_zeros_and_different_lengths(spark):
    rows = [(0, [0.0, 0.0], 0), (100, [1.0, 1.0, 1.0], 0), (200, [], 0), (300, [-3.0], 0)]
    rows += [(i, [0.5, 0.5] if i % 2 else [0.25, 0.75], 0) for i in range(1, 40)]
    assert found(spark, rows) == plain(rows)


def test_unusable_and_repeated_rows(spark):
    rows = vectors(120, 4) + [(400, None, 0), (500, [1.0, None, 2.0, 0.0], 0), (600, [1.0, float("nan"), 0.0, 0.0], 0),
                              (700, [float("inf"), 0.0, 0.0, 0.0], 0), (None, [9.0, 9.0, 9.0, 9.0], 0)]
    rows += [(7, [5.0, 5.0, 5.0, 5.0], 0)] * 3 + [(100, [0.5, 0.0, 0.0, 0.1], 1)] * 2
    assert found(spark, rows) == plain(rows)


def test_few_candidates_and_empty_table(spark):
    assert found(spark, [(100, [1.0], 0)]) == []
    assert found(spark, [(100, [1.0], 0), (1, [2.0], 0)]) == [(100, 1, 1, 2 * 1024 * 1024)]
    assert found(spark, []) == []
    assert found(spark, [(1, [2.0], 0)]) == []


def test_extra_columns(spark):
    rows = vectors(150, 3)
    df = clashing(spark.createDataFrame(rows, SCHEMA), "v", "score", "page", "pivot", "query_id")
    assert sorted(map(tuple, topk.neighbours(df).collect())) == plain(rows)


def test_large_whole_numbers_are_exact():
    draw = np.random.default_rng(3)
    v = draw.integers(-2 ** 28, 2 ** 28, (50, 4))
    space = topk.Space(int((v.astype(object) ** 2).sum(axis=1).max()))
    assert space.scores(v, v[0]).tolist() == [sum(int(x) * int(y) for x, y in zip(r, v[0])) for r in v]


def test_tree_skips_most_entries(monkeypatch):
    draw = np.random.default_rng(4)
    v = (draw.normal(0, 30_000, (40, 8))[draw.integers(0, 40, 8000)] + draw.normal(0, 100, (8000, 8))).astype(np.int64)
    space = topk.Space(int((v ** 2).sum(axis=1).max()))
    tree, looked = topk.bulk_load(space.lift(v)), []
    plain_scores = topk.Space.scores
    monkeypatch.setattr(topk.Space, "scores", lambda self, rows, q: looked.append(len(rows)) or plain_scores(self, rows, q))
    best = topk.search(tree, space, np.arange(8000), v, 17, v[17], 10, None)
    order = sorted((-int(s), i) for i, s in enumerate(v @ v[17]) if i != 17)[:10]
    assert best == [(-s, i) for s, i in order] and sum(looked) < 2000
