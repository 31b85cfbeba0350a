import numpy as np
import pytest
from wardflow.llm.permutation_index import EXTRA, PIVOTS, PLACES, RERANK, Orders, Segment, nearest_neighbours, recall

SCHEMA = "vec_id long, embedding array<double>, label int"


def exact(rows, every, k=10):
    good = [(i, np.array(v)) for i, v, _ in rows if i is not None and v and None not in v and np.isfinite(np.array(v, float)).all() and any(v)]
    out = []
    for q, v in good:
        if q % every:
            continue
        far = sorted((float(np.sqrt(((v - x) ** 2).sum())), i) for i, x in good if i != q)[:k]
        out += [(q, r + 1, i, d) for r, (d, i) in enumerate(far)]
    return sorted(out)


def test_small_tables_are_exact(spark):
    rng = np.random.default_rng(3)
    rows = [(i, rng.normal(size=8).tolist(), 1) for i in range(120)]
    rows += [(200 + i, rows[7][1], 1) for i in range(6)]
    rows += [(300, None, 1), (400, [0.0] * 8, 1), (500, [float("nan")] * 8, 1), (600, [None] + [1.0] * 7, 1)]
    rows += [(None, [1.0] * 8, 1), (700, [float("inf")] * 8, 1), (800, [], 1)]
    df = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "'x' as VEC_ID")
    plain = spark.createDataFrame(rows, SCHEMA)
    got = nearest_neighbours(df, plain.filter("vec_id % 100 = 0")).collect()
    want = exact(rows, 100)
    assert [tuple(r)[:3] for r in sorted(got)] == [w[:3] for w in want]
    assert np.allclose([r["score"] for r in sorted(got)], [w[3] for w in want], rtol=1e-15)


def test_few_and_none(spark):
    rows = [(0, [1.0, 2.0], 1), (1, [1.0, 3.0], 1), (2, [4.0, 3.0], 1), (100, [9.0], 1)]
    df = spark.createDataFrame(rows, SCHEMA)
    got = sorted(map(tuple, nearest_neighbours(df, df.filter("vec_id % 100 = 0")).collect()))
    assert [g[:3] for g in got] == [(0, 1, 1), (0, 2, 2)]
    none = df.limit(0)
    assert nearest_neighbours(none, none).count() == 0
    assert nearest_neighbours(df, none).count() == 0


def test_recall_over_segments(spark):
    rng = np.random.default_rng(5)
    vectors = rng.normal(size=(3000, 32))
    rows = [(i, v.tolist(), 0) for i, v in enumerate(vectors)]
    df = spark.createDataFrame(rows, SCHEMA)
    found = nearest_neighbours(df, df.filter("vec_id % 100 = 0"), segment=700)
    far = []
    for q in range(0, 3000, 100):
        d = np.sqrt(((vectors - vectors[q]) ** 2).sum(1))
        d[q] = np.inf
        far += [(q, int(i)) for i in np.argsort(d)[:10]]
    assert recall(found, spark.createDataFrame(far, "query_id long, vec_id long")) >= 0.9


def test_copies_do_not_crowd_others_out(spark):
    """A vector with thousands of copies takes one place of the rerank, and its copies rank by id."""
    rng = np.random.default_rng(9)
    vectors = rng.normal(size=(1000, 16))
    rows = [(i, v.tolist(), 0) for i, v in enumerate(vectors)]
    # The hot vector is nearer to query 100 than most, so its copies precede others by footrule.
    near = np.argsort(((vectors - vectors[100]) ** 2).sum(1))
    hot = vectors[near[5]].tolist()
    rows += [(10_000 + 7 * i + 1, hot, 0) for i in range(2000)]
    df = spark.createDataFrame(rows, SCHEMA).repartition(4)
    queries = df.filter("vec_id in (100, 10001)")
    got = sorted(tuple(r) for r in nearest_neighbours(df, queries, segment=1500).collect())
    want = [w for q in (100, 10001) for w in exact([(i, v, x) for i, v, x in rows], q) if w[0] == q]
    assert [g[:3] for g in got] == [w[:3] for w in want]


def test_components_near_the_ends_of_the_range(spark):
    for scale in (1e200, 1e-200):
        rows = [(i, [scale * (i + 1), scale * i * i], 0) for i in range(30)]
        df = spark.createDataFrame(rows, SCHEMA)
        got = sorted(map(tuple, nearest_neighbours(df, df.filter("vec_id = 3"), k=3).collect()))
        far = sorted((((i - 3) ** 2 + (i * i - 9) ** 2) ** 0.5, i) for i in range(30) if i != 3)[:3]
        assert [g[2] for g in got] == [i for _, i in far]
        assert np.allclose([g[3] / scale for g in got], [d for d, _ in far], rtol=1e-12)


@pytest.mark.parametrize(("unit", "share"), [(True, 0.1), (False, 0.15)])
def test_work_of_a_query(unit, share):
    """Postings and reranked components against those of brute force, at 50,000 vectors.

    Pivots of small norm are near to everything, so vectors of unequal norms have longer files.
    """
    rng = np.random.default_rng(2)
    vectors = rng.normal(size=(50_000, 64))
    if unit:
        vectors /= np.linalg.norm(vectors, axis=1, keepdims=True)
    orders = Orders(vectors[:PIVOTS], PLACES)
    index = Segment(np.arange(len(vectors)), vectors, orders)
    visits = np.diff(index.ends)[orders.of(vectors[-20:])].sum(1).mean()
    reranked = RERANK * len(vectors) + EXTRA * len(vectors) ** 0.5
    assert visits + reranked * 64 < share * vectors.size


def test_repeated_ids_and_rows(spark):
    """Rows of the query's id never answer it, however many; repeated candidates all count."""
    rows = [(1, [1.0, 0.0], 0)] * 40 + [(2, [1.0, 0.0], 0)] * 3 + [(3, [2.0, 0.5], 0)]
    df = spark.createDataFrame(rows, SCHEMA)
    got = sorted(map(tuple, nearest_neighbours(df, df.filter("vec_id = 1"), k=4).collect()))
    assert [g[1:3] for g in got] == [(1, 2), (2, 2), (3, 2), (4, 3)]
