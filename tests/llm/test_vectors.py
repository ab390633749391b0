import math

import numpy as np
from pyspark.sql import functions as F

from quiver.llm.lattice import cells, e8, near_duplicates
from quiver.llm.topk import Part, top_k

SHAPE = "vec_id long, embedding array<double>, label int, cell string, part string"


def vectors():
    rng = np.random.default_rng(11)
    base = rng.standard_normal((120, 16))
    rows = [(i, base[i].tolist()) for i in range(120)]
    rows += [(200 + i, (base[3] + 0.08 * rng.standard_normal(16)).tolist()) for i in range(25)]  # one group of near copies
    rows += [(300 + i, base[5].tolist()) for i in range(4)] + [(7, base[5].tolist())]  # exact copies, a repeated id
    rows += [(400, None), (401, [0.0] * 16), (402, [float("nan")] + [1.0] * 15), (403, [float("inf")] * 16), (404, [None] + [1.0] * 15), (405, []), (406, [1.0, 2.0])]
    rows += [(None, base[9].tolist()), (407, (1e200 * base[9]).tolist())]
    return rows


def frame(spark, rows):
    return spark.createDataFrame([(i, v, 0, "c", "p") for i, v in rows], SHAPE).repartition(3)


def usable(v, zero):
    return v is not None and all(x is not None and np.isfinite(x) for x in v) and (zero or any(v))


def test_e8_points_are_lattice_points_and_nearest_of_their_copy():
    x = np.random.default_rng(0).standard_normal((400, 8)) * 2
    for code in e8(x):
        p = code.view(np.int8).reshape(-1, 8) / 2
        assert ((p * 2).astype(int) % 2 == (p[:, :1] * 2).astype(int) % 2).all() and (p.sum(axis=1) % 2 == 0).all()
    near = e8(x)[0].view(np.int8).reshape(-1, 8) / 2
    assert ((x - near) ** 2).sum(axis=1).max() <= 1.0 + 1e-9  # the covering radius


def test_recall_of_the_index_at_the_threshold():
    rng = np.random.default_rng(2)
    a = rng.standard_normal((2000, 64))
    a /= np.linalg.norm(a, axis=1, keepdims=True)
    n = rng.standard_normal((2000, 64))
    n -= (n * a).sum(axis=1, keepdims=True) * a
    n /= np.linalg.norm(n, axis=1, keepdims=True)
    c = rng.uniform(0.9, 0.92, (2000, 1))
    x, y = cells(a), cells(c * a + np.sqrt(1 - c * c) * n)
    met = ((y[:, :, :1] == x) | (x[:, :, :1] == y)).any(axis=(1, 2))
    assert met.mean() >= 0.95


def test_near_duplicates_against_brute_force(spark):
    rows = vectors()
    ok = [i for i, (k, v) in enumerate(rows) if k is not None and usable(v, False)]

    def cos(x, y):
        x, y = np.array(x) / np.abs(x).max(), np.array(y) / np.abs(y).max()
        return x @ y / np.sqrt((x @ x) * (y @ y))

    link = {i: [j for j in ok if j != i and len(rows[i][1]) == len(rows[j][1]) and cos(rows[i][1], rows[j][1]) >= 0.9] for i in ok}
    label = {i: rows[i][0] for i in ok}
    for _ in rows:
        for i in ok:
            label[i] = min([label[i], *(label[j] for j in link[i])])
    want = sorted(((k, len(link.get(i, [])), label.get(i, k), None if k is None else label.get(i, k) == k) for i, (k, _) in enumerate(rows)), key=str)
    for cap in (4096, 3):
        got = near_duplicates(frame(spark, rows), cap=cap).collect()
        assert sorted(map(tuple, got), key=str) == want
    assert near_duplicates(frame(spark, [])).count() == 0


LEAST, MOST = -(2**63), 2**63 - 1


def quantised(v):
    return [min(max(math.floor(256.0 * x) if abs(x) < 1e18 else int(256.0 * x), LEAST), MOST) for x in v]


def test_top_k_against_brute_force(spark):
    rng = np.random.default_rng(6)
    # scores beyond 2 ** 53 and beyond a long
    rows = vectors() + [(500 + i, (1e6 * rng.standard_normal(16)).tolist()) for i in range(12)] + [(520 + i, (3e6 + rng.random(16)).tolist()) for i in range(12)]
    rows += [(540, [1e15] * 16), (541, [-1e15] * 16), (545, [400001.0] * 16), (546, [400001.0 + i / 256 for i in range(16)])]
    ok = [(k, quantised(v)) for k, v in rows if k is not None and usable(v, True)]
    df = frame(spark, rows)
    for k, part in ((5, 8192), (3, 20)):
        want = []
        for q in sorted({i for i, _ in ok if i % 5 == 0}):
            mine = min(v for i, v in ok if i == q)
            score = sorted((-min(max(sum(a * b for a, b in zip(mine, v)), LEAST), MOST), i) for i, v in ok if i != q)
            want += [(q, r + 1, i, -s) for r, (s, i) in enumerate(score[:k])]
        got = top_k(df, F.col("vec_id") % 5 == 0, k, part_rows=part)
        assert "NestedLoop" not in got._jdf.queryExecution().toString() and "Cartesian" not in got._jdf.queryExecution().toString()
        assert sorted((r.query_id, r["rank"], r.vec_id, r.score) for r in got.collect()) == want
    assert top_k(frame(spark, []), F.col("vec_id") % 5 == 0).count() == 0
    assert top_k(frame(spark, rows[:1]), F.col("vec_id") % 5 == 0).count() == 0


def test_blocks_are_pruned():
    rng = np.random.default_rng(4)
    blocks = [(list(range(b * 10, b * 10 + 10)), [(rng.integers(-5, 5, 8) + 100 * b).astype(np.int64).tobytes() for _ in range(10)]) for b in range(20)]
    part = Part(blocks)
    best = part.best(-1, np.ones(8, np.int64), 5, None)
    assert part.scored < 5 and {i // 10 for _, i in best} == {19}
