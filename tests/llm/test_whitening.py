import math

import numpy as np
from tables import empty

from rivulet.llm.queries import queries
from rivulet.llm.whitening import whiten


def brute(rows, components=4):
    ok = [(i, v) for i, v in rows if v and all(c is not None and math.isfinite(c) for c in v)]
    dim = max({len(v) for _, v in ok}, key=lambda d: (sum(len(v) == d for _, v in ok), d))
    ok = [(i, tuple(math.floor(256 * c) for c in v)) for i, v in ok if len(v) == dim]
    fit = sorted({x for _, x in ok})
    n, s = len(fit), [sum(c) for c in zip(*fit)]
    f = np.array([[c - t / n for c, t in zip(x, s)] for x in fit])
    value, vector = np.linalg.eigh(f.T @ f / n)
    value, vector = value[::-1], vector[:, ::-1]
    out = []
    for i, x in ok:
        c = np.array([c - t / n for c, t in zip(x, s)])
        for j in range(min(components, dim)):
            if value[j] > value[0] * 1e-12:
                out.append((i, j + 1, n, sum((n * c - t) ** 2 for c, t in zip(x, s)), float(c @ vector[:, j] / math.sqrt(value[j])),
                            value[j] / value.sum()))
    return out


def same(got, want):
    assert len(got) == len(want)
    signs = {}
    by = lambda r: (str(r[0]), r[1], r[3], abs(r[4]))
    for g, w in zip(sorted(got, key=by), sorted(want, key=by)):
        assert g[:4] == w[:4]
        assert abs(abs(g[4]) - abs(w[4])) < 1e-8 and abs(g[5] - w[5]) < 1e-9
        if abs(w[4]) > 1e-6:  # either sign, the same for all rows
            assert signs.setdefault(g[1], g[4] * w[4] > 0) == (g[4] * w[4] > 0)


def test_whitening_with_awkward_vectors(spark, monkeypatch):
    from rivulet.llm import whitening

    monkeypatch.setattr(whitening, "BLOCK_ENTRIES", 5 * 16)  # many blocks
    rng = np.random.default_rng(3)
    rows = [(i, (rng.normal(size=5) * [5, 3, 2, 1, 0.5]).tolist()) for i in range(300)]
    rows += [(400 + i, rows[7][1]) for i in range(150)]  # a third are copies of one vector
    rows += [(7, rows[8][1]), (7, rows[8][1]), (None, rows[9][1]), (None, [0.0] * 5), (600, [-0.0] * 5),
             (601, None), (602, []), (603, [1.0, None, 2.0, 3.0, 4.0]), (604, [1.0, float("nan"), 2.0, 3.0, 4.0]),
             (605, [1.0, float("inf"), 2.0, 3.0, 4.0]), (606, [1.0, 2.0]), (607, [1e30, 0.0, 0.0, 0.0, 0.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").selectExpr(
        "*", "'c' AS x", "1 AS n", "2 AS index", "3 AS deviation", "4 AS vector")
    got = whiten(df).collect()
    same([tuple(r)[:6] for r in got], brute(rows[:-1]))
    error = {r.identity_error for r in got}
    assert len(error) == 1 and 0 <= error.pop() < 1e-9
    assert whiten(empty(spark, df)).collect() == []
    assert whiten(df.where("vec_id BETWEEN 400 AND 420")).collect() == []  # equal vectors have no variance
    few = df.where("vec_id IN (1, 2, 3, 400, 401)")
    got = whiten(few).collect()
    assert {r.component for r in got} == {1, 2, 3} and len(got) == 15
    same([tuple(r)[:6] for r in got], [r for r in brute([r for r in rows if r[0] in (1, 2, 3, 400, 401)]) if r[1] <= 3])


def test_deviations_beyond_a_long_are_null(spark):
    df = spark.range(40_000).selectExpr("id AS vec_id", "array(IF(id = 7, 2e12D, CAST(id AS DOUBLE))) AS embedding")
    got = {r.vec_id: r.deviation for r in whiten(df).where("vec_id IN (7, 8)").collect()}
    assert got == {7: None, 8: None}
    few = spark.createDataFrame([(0, [0.0]), (1, [1e9]), (2, [2.0])], "vec_id long, embedding array<double>")
    got = {r.vec_id: r.deviation for r in whiten(few).collect()}
    x = [0, 256 * 10 ** 9, 512]
    assert got == {i: v if (v := (3 * x[i] - sum(x)) ** 2) < 2 ** 63 else None for i in range(3)}


def test_the_query_equals_numpy(spark):
    d = "/root/testdata/sf0.01"
    rows = [(r.vec_id, [float(c) for c in r.embedding]) for r in
            spark.read.parquet(f"{d}/embeddings.parquet").select("vec_id", "embedding").collect()]
    got = queries()["op13_block_whitening"](spark, d).collect()
    same([tuple(r)[:6] for r in got], brute(rows))
    assert max(r.identity_error for r in got) < 1e-4
