import numpy as np
import pytest

from tests.llm import brute
from tramline.llm import vector_dedup as vd
from tramline.llm.common import components, forest


def groups(vectors, cosine):
    ids = list(range(len(vectors)))
    x = np.array([v for _, v in vectors], float)
    x /= np.linalg.norm(x, axis=1)[:, None]
    c = x @ x.T
    return sorted((min(vectors[i][0] for i in g), len(g)) for g in brute.groups(ids, lambda a, b: c[a, b] >= cosine))


@pytest.mark.parametrize("dim, block, spread", [(16, 4, 1.0), (10, 3, 0.6), (5, 8, 1.0)])
def test_equals_brute_force(spark, dim, block, spread):
    rng = np.random.default_rng(dim)
    base = rng.normal(size=(120, dim)) * spread ** np.arange(dim)
    near = base[:60] + rng.normal(size=(60, dim)) * np.linalg.norm(base[:60], axis=1)[:, None] * rng.choice([0.01, 0.05, 0.1, 0.3], (60, 1))
    vectors = [(i, v.astype(np.float32).tolist()) for i, v in enumerate(np.concatenate([base, near, base[:20]]))]
    df = spark.createDataFrame(vectors, "vec_id long, embedding array<float>")
    got = sorted(map(tuple, vd.vector_dedup(df, 0.95, block, chunk=40).collect()))
    assert got == groups(vectors, 0.95)


def test_edges(spark, clash, rows):
    vectors = [(1, [1.0, 0.0]), (1, [1.0, 0.0]), (2, [2.0, 0.01]), (3, [0.0, 0.0]), (4, None), (5, [1.0]), (6, [1.0, None]), (7, [float("nan"), 1.0]), (None, [0.0, 1.0]), (8, [])]
    df = spark.createDataFrame(vectors, "vec_id long, embedding array<float>")
    got = rows(vd.vector_dedup(df))
    assert got == sorted([(1, 3), (3, 1), (4, 1), (5, 1), (6, 1), (7, 1), (None, 1), (8, 1)], key=repr)
    assert rows(vd.vector_dedup(clash(df))) == got
    assert vd.vector_dedup(df.filter("false")).count() == 0


def test_components(spark):
    rng = np.random.default_rng(4)
    edges = [(i, i + 1) for i in range(100, 160)] + [(int(a), int(b)) for a, b in rng.integers(0, 90, (40, 2))]
    want = {}
    for g in brute.groups(sorted({x for e in edges for x in e}), lambda a, b, s={frozenset(e) for e in edges}: frozenset((a, b)) in s):
        want |= {n: min(g) for n in g if n != min(g)}
    assert {r[0]: r[1] for r in components(spark.createDataFrame(edges, "a long, b long")).collect()} == want
    a, b = (np.array(x) for x in zip(*edges))
    assert dict(zip(*(x.tolist() for x in forest(a, b)))) == want
