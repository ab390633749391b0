import hashlib

import numpy as np
import pytest

from quiver.operators.canopy import canopy, canopy_sizes
from quiver.operators.kmeans import _check_cycle, assign, kmeans
from quiver.operators.seeding import seats, seeds
from conftest import vec_df


def seats_reference(sizes, k):
    """Rule D9 in plain Python."""
    n_total, c = sum(sizes.values()), len(sizes)
    kk = min(n_total, max(k, c))
    if n_total == c:
        return {cid: 1 for cid in sizes}
    base = {cid: 1 + ((kk - c) * (n - 1)) // (n_total - c) for cid, n in sizes.items()}
    rem = {cid: ((kk - c) * (n - 1)) % (n_total - c) for cid, n in sizes.items()}
    left = kk - sum(base.values())
    order = sorted(sizes, key=lambda cid: (-rem[cid], cid))
    return {cid: base[cid] + (1 if i < left else 0) for i, cid in enumerate(order)}


@pytest.mark.parametrize("case", range(6))
def test_seats_rule(spark, case):
    rng = np.random.default_rng(case)
    sizes = {f"c{i:02d}": int(n) for i, n in enumerate(rng.integers(1, 40, rng.integers(1, 12)))}
    k = int(rng.integers(1, 30))
    df = spark.createDataFrame(list(sizes.items()), "canopy_id string, n long")
    got = {r["canopy_id"]: r["seats"] for r in seats(df, k).collect()}
    assert got == seats_reference(sizes, k)
    kk = min(sum(sizes.values()), max(k, len(sizes)))
    assert sum(got.values()) == kk
    assert all(1 <= got[c] <= sizes[c] for c in sizes)


def test_k_greater_than_vectors(spark):
    df = spark.createDataFrame([("a", 2), ("b", 1)], "canopy_id string, n long")
    assert {r["canopy_id"]: r["seats"] for r in seats(df, 10).collect()} == {"a": 2, "b": 1}


def test_seeds_follow_md5_order(spark):
    rows = [(f"s{i}", [float(i)]) for i in range(6)]
    v = vec_df(spark, rows)
    m = v.selectExpr("symbol", "'c' as canopy_id", "v")
    st = spark.createDataFrame([("c", 6, 2)], "canopy_id string, n long, seats long")
    got = [r["symbol"] for r in seeds(m, st, "42").orderBy("center_id").collect()]
    expect = sorted((s for s, _ in rows), key=lambda s: (hashlib.md5(f"42:{s}".encode()).hexdigest(), s))[:2]
    assert got == expect


def test_tie_goes_to_lowest_center_id(spark):
    m = vec_df(spark, [("x", [0.5])]).selectExpr("symbol", "'c' as canopy_id", "v")
    centres = spark.createDataFrame([(2, "c", [0.0]), (1, "c", [1.0])], "center_id long, canopy_id string, v array<double>")
    assert assign(m, centres, 1, 2).first()["center_id"] == 1


def test_empty_centre_keeps_vector_and_canopy_restriction(spark):
    m = vec_df(spark, [("a", [0.0]), ("b", [0.2]), ("z", [5.0])]).selectExpr(
        "symbol", "case when symbol = 'z' then 'z' else 'a' end as canopy_id", "v")
    centres = spark.createDataFrame(
        [(1, "a", [0.1]), (2, "a", [9.0]), (3, "z", [0.0])], "center_id long, canopy_id string, v array<double>")
    res = kmeans(m, centres, 1, max_iter=5)
    tab = kmeans(m, centres, 1, max_iter=5, model_bytes=0)
    assert sorted(tab.centers.collect()) == sorted(res.centers.collect())
    got = {r["center_id"]: r["v"] for r in res.centers.collect()}
    assert got[2] == [9.0]  # lost all members
    assert got[1] == [pytest.approx(0.1)]
    assert got[3] == [5.0]  # z only sees its own canopy's centre
    a = {r["symbol"]: r["center_id"] for r in res.assignments.collect()}
    assert a == {"a": 1, "b": 1, "z": 3}


def kmeans_reference(mem, init, rounds):
    """Plain canopy-restricted k-means: mean-L1 assign (rounded 12), mean update."""
    cent = {cid: (can, np.array(v)) for cid, can, v in init}
    assign_ = {}
    for _ in range(rounds):
        assign_ = {}
        for sym, can, v in mem:
            x = np.array(v)
            cands = [(float(np.floor(np.cumsum(np.abs(cv - x))[-1] / len(x) * 1e12 + 0.5) / 1e12), cid)
                     for cid, (cc, cv) in cent.items() if cc == can]
            assign_[sym] = min(cands)[1]
        for cid in cent:
            pts = [np.array(v) for sym, _, v in mem if assign_[sym] == cid]
            if pts:
                cent[cid] = (cent[cid][0], np.mean(pts, axis=0))
    return assign_


def test_matches_reference_kmeans(spark):
    rng = np.random.default_rng(5)
    rows = [(f"p{i:03d}", rng.random(5).tolist()) for i in range(80)]
    v = vec_df(spark, rows)
    m = canopy(v, 0.3)
    st = seats(canopy_sizes(m), 7)
    init = seeds(m, st)
    res = kmeans(m, init, 5, max_iter=4, stop_on_convergence=False)
    mem = [(r["symbol"], r["canopy_id"], r["v"]) for r in m.collect()]
    ini = [(r["center_id"], r["canopy_id"], r["v"]) for r in init.collect()]
    expect = kmeans_reference(mem, ini, 4)
    assert {r["symbol"]: r["center_id"] for r in res.assignments.collect()} == expect


def test_salted_join_matches_broadcast(spark):
    rng = np.random.default_rng(9)
    rows = [(f"q{i:03d}", rng.random(3).tolist()) for i in range(60)]
    m = canopy(vec_df(spark, rows), 0.35)
    init = seeds(m, seats(canopy_sizes(m), 6))
    a = kmeans(m, init, 3, max_iter=3, stop_on_convergence=False)
    b = kmeans(m, init, 3, max_iter=3, stop_on_convergence=False, broadcast_bytes=0, salts=4, model_bytes=0)
    c = kmeans(m, init, 3, max_iter=3, stop_on_convergence=False, model_bytes=0)
    e = kmeans(m, init, 3, max_iter=3, stop_on_convergence=False, engine="jvm")
    f = kmeans(m, init, 3, max_iter=3, stop_on_convergence=False, model_bytes=0, engine="jvm",
               broadcast_bytes=0, salts=4)
    g = kmeans(m, init, 3, max_iter=3, stop_on_convergence=False, model_bytes=0, rows_per_group=5)
    key = ["symbol", "center_id"]
    for other in (f, g):
        assert sorted(a.assignments.select(*key).collect()) == sorted(other.assignments.select(*key).collect())
        assert a.changed == other.changed
    assert sorted(a.assignments.select(*key).collect()) == sorted(e.assignments.select(*key).collect())
    assert a.changed == e.changed
    assert sorted(a.assignments.select(*key).collect()) == sorted(b.assignments.select(*key).collect())
    assert sorted(a.assignments.select(*key).collect()) == sorted(c.assignments.select(*key).collect())
    assert a.changed == b.changed == c.changed
    ca = {r["center_id"]: r["v"] for r in a.centers.collect()}
    cb = {r["center_id"]: r["v"] for r in b.centers.collect()}
    assert ca.keys() == cb.keys()
    assert all(abs(x - y) < 1e-12 for k in ca for x, y in zip(ca[k], cb[k]))


def test_independent_of_shuffle_partitions(spark):
    rng = np.random.default_rng(13)
    rows = [(f"r{i:03d}", rng.random(4).tolist()) for i in range(70)]
    out = []
    for parts in ("3", "8"):
        spark.conf.set("spark.sql.shuffle.partitions", parts)
        m = canopy(vec_df(spark, rows).repartition(int(parts)), 0.3)
        init = seeds(m, seats(canopy_sizes(m), 5))
        res = kmeans(m, init, 4, max_iter=10)
        out.append(sorted((r["symbol"], r["center_id"]) for r in res.assignments.collect()))
    spark.conf.set("spark.sql.shuffle.partitions", "8")
    assert out[0] == out[1]


def test_empty_input_runs(spark):
    from quiver.config import RunConfig
    from quiver.plans.pipeline import cluster_vectors

    empty = spark.createDataFrame([], "symbol string, v array<double>")
    members, seat_table, initial, res = cluster_vectors(empty, RunConfig(clusters=3))
    assert members.count() == 0 and initial.count() == 0
    assert res.assignments.count() == 0


def test_long_vectors_use_exploded_mean(spark):
    import quiver.operators.kmeans as K

    rng = np.random.default_rng(21)
    rows = [(f"w{i:03d}", rng.random(90).tolist()) for i in range(50)]
    m = canopy(vec_df(spark, rows), 0.5)
    init = seeds(m, seats(canopy_sizes(m), 5))
    wide = kmeans(m, init, 90, max_iter=3, stop_on_convergence=False, engine="jvm")
    old = K.WIDE_DIM
    K.WIDE_DIM = 1000
    try:
        narrow = kmeans(m, init, 90, max_iter=3, stop_on_convergence=False, engine="jvm")
    finally:
        K.WIDE_DIM = old
    assert wide.changed == narrow.changed
    a = {r["center_id"]: r["v"] for r in wide.centers.collect()}
    b = {r["center_id"]: r["v"] for r in narrow.centers.collect()}
    assert a.keys() == b.keys()
    assert all(abs(x - y) < 1e-12 for k in a for x, y in zip(a[k], b[k]))
    assert sorted(wide.assignments.select("symbol", "center_id").collect()) == \
        sorted(narrow.assignments.select("symbol", "center_id").collect())
    fast = kmeans(m, init, 90, max_iter=3, stop_on_convergence=False)
    assert sorted(fast.assignments.select("symbol", "center_id").collect()) == \
        sorted(wide.assignments.select("symbol", "center_id").collect())


def test_seeds_in_parts_equal_seeds_at_once(spark):
    v = vec_df(spark, [(f"s{i:03d}", [float(i)]) for i in range(120)])
    m = v.selectExpr("symbol", "if(symbol < 's100', 'hot', 'cold') as canopy_id", "v")
    st = spark.createDataFrame([("hot", 100, 7), ("cold", 20, 2)], "canopy_id string, n long, seats long")
    assert sorted(seeds(m, st, "42", rows_per_group=9).collect()) == sorted(seeds(m, st, "42").collect())


@pytest.mark.parametrize("options", [{}, {"model_bytes": 0}, {"model_bytes": 0, "engine": "jvm"}])
def test_members_without_a_distance_take_the_lowest_centre(spark, options):
    nan = float("nan")
    m = vec_df(spark, [("a", [nan, 0.0]), ("b", [0.2, 0.0]), ("c", [0.9, 1.0])]).selectExpr("symbol", "'k' as canopy_id", "v")
    centres = spark.createDataFrame([(1, "k", [1.0, 1.0]), (2, "k", [0.0, 0.0])], "center_id long, canopy_id string, v array<double>")
    res = kmeans(m, centres, 2, max_iter=1, stop_on_convergence=False, **options)
    got = {r["symbol"]: (r["center_id"], r["dist"]) for r in res.assignments.collect()}
    assert {s: c for s, (c, _) in got.items()} == {"a": 1, "b": 2, "c": 1}
    assert np.isnan(got["a"][1])


def test_rounds_go_on_until_nothing_changes(spark):
    """Centres that start at one end of a line need more rounds than the former cap of 50."""
    x = (np.arange(200) / 200) ** 2
    want, prev, rounds = x[:8].copy(), None, 0
    while True:
        rounds += 1
        near = np.abs(x[:, None] - want[None]).argmin(1)
        if prev is not None and (near == prev).all():
            break
        prev, want = near, np.array([x[near == j].mean() for j in range(8)])
    assert rounds > 50
    m = vec_df(spark, [(f"s{i:03d}", [float(v)]) for i, v in enumerate(x)]).selectExpr("symbol", "'c' as canopy_id", "v").coalesce(1)
    centres = spark.createDataFrame([(j, "c", [float(x[j])]) for j in range(8)], "center_id long, canopy_id string, v array<double>")
    res = kmeans(m, centres, 1)
    assert res.converged and res.rounds > 50
    assert np.allclose([r["v"][0] for r in res.centers.orderBy("center_id").collect()], want)
    for options in ({}, {"model_bytes": 0}):
        with pytest.raises(RuntimeError, match="after 3 rounds"):
            kmeans(m, centres, 1, max_iter=3, **options)


def test_centres_that_come_back_raise():
    seen = {"a": 0}
    for i, state in enumerate("abc", 1):  # a resting state is no cycle
        _check_cycle(seen, state, i)
    with pytest.raises(RuntimeError, match="those after round 2"):
        _check_cycle(seen, "b", 4)
