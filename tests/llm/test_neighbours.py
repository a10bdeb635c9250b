import numpy as np
import pytest
from pyspark.sql import functions as F

from daybook.llm import neighbours
from daybook.llm.common import prepare


def brute(rows, is_query, k):
    usable = {i: np.array(v, float) for i, v in rows
              if i is not None and v and None not in v and np.isfinite(v).all() and any(v)}
    out = {}
    for q in filter(is_query, usable):
        near = sorted((float(np.sqrt(((usable[q] - v) ** 2).sum())), i) for i, v in usable.items()
                      if i != q and len(v) == len(usable[q]))[:k]
        out[q] = near
    return out


def run(spark, rows, every=3, k=4, extra=False):
    prepare(spark)
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    if extra:
        df = df.selectExpr("*", "1 as id", "'x' as v", "2 as q", "3 as score")
    got = {}
    for r in sorted(neighbours.search(df, F.col("vec_id") % every == 0, k).collect(), key=lambda r: (r.query_id, r.rank)):
        got.setdefault(r.query_id, []).append((r.score, r.vec_id))
        assert r.rank == len(got[r.query_id])
    return got


def same(got, want):
    assert set(got) == {q for q, near in want.items() if near}
    for q, near in got.items():
        assert [i for _, i in near] == [i for _, i in want[q]]
        assert np.allclose([d for d, _ in near], [d for d, _ in want[q]], rtol=1e-12)


@pytest.mark.parametrize("n,dim,scale", [(300, 16, 1.0), (500, 3, 1e6), (40, 2000, 1e-3)])
def test_against_brute_force(spark, n, dim, scale):
    rng = np.random.default_rng(n)
    rows = [(i, (rng.normal(size=dim) * scale * 10.0 ** rng.integers(-2, 2)).tolist()) for i in range(n)]
    same(run(spark, rows), brute(rows, lambda i: i % 3 == 0, 4))


def test_ties_copies_and_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(i, [1.0, 2.0]) for i in range(30)] + [(i, [float(i % 5), 1.0]) for i in range(30, 60)]
    rows += [(60, None), (63, []), (66, [0.0, 0.0]), (69, [1.0, None]), (72, [nan, 1.0]), (75, [inf, 1.0]),
             (78, [1.0, 2.0, 3.0]), (81, [2.0, 2.0, 3.0]), (84, [5.0]), (None, [1.0, 2.0])]
    same(run(spark, rows, extra=True), brute(rows, lambda i: i % 3 == 0, 4))


def test_fewer_candidates_than_k_and_empty(spark):
    rows = [(0, [1.0]), (1, [2.0]), (3, [4.0])]
    same(run(spark, rows, k=10), brute(rows, lambda i: i % 3 == 0, 10))
    assert run(spark, []) == {}
    assert run(spark, [(1, [1.0])]) == {}


def test_many_query_blocks(spark, monkeypatch):
    monkeypatch.setattr(neighbours, "QUERY_BLOCK", 20)
    rng = np.random.default_rng(2)
    rows = [(i, rng.normal(size=8).tolist()) for i in range(200)]
    same(run(spark, rows, every=2), brute(rows, lambda i: i % 2 == 0, 4))


@pytest.mark.parametrize("scale", [1.0, 1e160, 1e-160])
def test_bounds_hold(scale):
    rng = np.random.default_rng(3)
    q, x = (neighbours.Codes(rng.normal(size=(50, 70)) * scale * 10.0 ** rng.integers(-5, 5, (50, 1))) for _ in range(2))
    low, high = neighbours.distance_bounds(q, x)
    exact = np.sqrt((((q.exact[:, None, :] - x.exact[None, :, :]) / scale) ** 2).sum(axis=2)) * scale
    assert (low <= exact).all() and (exact <= high).all()
    assert q.code.dtype == np.int8


@pytest.mark.parametrize("scale", [2.0 ** 520, 2.0 ** -520])
def test_vectors_whose_squares_no_double_holds(spark, scale):
    """A power of two moves every distance by itself, bit for bit, and no neighbour."""
    rng = np.random.default_rng(5)
    plain = [(i, rng.normal(size=6).tolist()) for i in range(62)]
    want = brute(plain, lambda i: i % 3 == 0, 4)
    got = run(spark, [(i, [c * scale for c in v]) for i, v in plain])
    same({q: [(d / scale, i) for d, i in near] for q, near in got.items()}, want)


def test_lengths_far_apart_in_one_tile(spark):
    rng = np.random.default_rng(6)
    rows = [(i, (rng.normal(size=5) * 10.0 ** (-140 if i % 2 else 140)).tolist()) for i in range(60)]
    same(run(spark, rows), brute(rows, lambda i: i % 3 == 0, 4))


def test_many_widths_blocks_and_groups(spark, monkeypatch):
    monkeypatch.setattr(neighbours, "QUERY_BLOCK", 7)
    monkeypatch.setattr(neighbours, "ROW_GROUP", 40)
    rng = np.random.default_rng(7)
    rows = [(i, rng.normal(size=2 + i % 5).tolist()) for i in range(300)]
    same(run(spark, rows, every=4), brute(rows, lambda i: i % 4 == 0, 4))


def test_single_precision_column(spark):
    rng = np.random.default_rng(8)
    rows = [(i, rng.normal(size=12).astype(np.float32).tolist()) for i in range(90)] + [(90, [1e30] * 12), (91, None)]
    prepare(spark)
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    got = {}
    for r in sorted(neighbours.search(df, F.col("vec_id") % 3 == 0, 4).collect(), key=lambda r: (r.query_id, r.rank)):
        got.setdefault(r.query_id, []).append((r.score, r.vec_id))
    same(got, brute([(i, None if v is None else [float(np.float32(c)) for c in v]) for i, v in rows], lambda i: i % 3 == 0, 4))


def test_registered_query(spark):
    from daybook.llm.registered import QUERIES
    sf = "/root/testdata/sf0.01"
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{sf}/embeddings.parquet").collect()]
    got = {}
    for r in sorted(QUERIES["op6_neighbours"](spark, sf).collect(), key=lambda r: (r.query_id, r.rank)):
        got.setdefault(r.query_id, []).append((r.score, r.vec_id))
    same(got, brute(rows, lambda i: i % 100 == 0, 10))


def test_query_id_with_usable_and_unusable_rows(spark):
    from pyspark.sql import functions as F

    from daybook.llm import neighbours

    rows = [(100, [0.0, 0.0]), (100, [1.0, 2.0]), (100, [None, -5.0]), (100, [float("nan"), 1.0]), (100, None), (100, [])]
    rows += [(i, [float(i), 2.0]) for i in range(1, 20)]
    got = neighbours.search(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), F.col("vec_id") % 100 == 0, k=20).collect()
    assert sorted((r.rank, r.vec_id, r.score) for r in got) == [(i, i, float(i - 1)) for i in range(1, 20)]
