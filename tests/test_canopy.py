import hashlib
import math

import numpy as np
import pytest

from quiver.operators.canopy import canopy, canopy_bucketed, canopy_sizes, canopy_tree, tree_levels
from conftest import greedy_reference, vec_df


def members(df):
    return {r["symbol"]: r["canopy_id"] for r in df.collect()}


def test_one_dimensional_example(spark):
    v = vec_df(spark, [("a", [0.0]), ("b", [0.3]), ("c", [0.6]), ("d", [0.9])])
    assert members(canopy(v, 0.5)) == {"a": "a", "b": "a", "c": "c", "d": "c"}


def test_distance_exactly_t1_does_not_join(spark):
    v = vec_df(spark, [("a", [0.0]), ("b", [0.5])])
    assert members(canopy(v, 0.5)) == {"a": "a", "b": "b"}


def test_nan_vector_is_its_own_canopy(spark):
    v = vec_df(spark, [("a", [0.0, 0.0]), ("b", [float("nan"), 0.0]), ("c", [0.1, 0.0])])
    assert members(canopy(v, 0.5)) == {"a": "a", "b": "b", "c": "a"}


def test_all_one_and_all_singletons(spark):
    v = vec_df(spark, [(f"s{i}", [i * 0.01]) for i in range(10)])
    assert set(members(canopy(v, 1.0)).values()) == {"s0"}
    assert members(canopy(v, 0.001)) == {f"s{i}": f"s{i}" for i in range(10)}


@pytest.mark.parametrize("batch", [1, 2, 7, 4096])
def test_matches_sequential_greedy_for_any_batch(spark, batch):
    rng = np.random.default_rng(7)
    rows = [(f"x{i:03d}", rng.random(6).tolist()) for i in range(120)]
    got = members(canopy(vec_df(spark, rows), 0.25, batch=batch))
    assert got == greedy_reference(rows, 0.25)


def test_unequal_lengths_rejected(spark):
    v = vec_df(spark, [("a", [0.0]), ("b", [0.0, 1.0])])
    with pytest.raises(ValueError):
        canopy(v, 0.5)


def test_bucketed_properties(spark):
    rng = np.random.default_rng(11)
    rows = [(f"y{i:03d}", rng.random(4).tolist()) for i in range(150)]
    v = vec_df(spark, rows)
    t1 = 0.2
    got = members(canopy_bucketed(v, t1, buckets=4))
    assert set(got) == {r[0] for r in rows}
    centres = sorted(set(got.values()))
    vec = dict(rows)
    for c in centres:
        assert got[c] == c
    for i, a in enumerate(centres):  # surviving centres are at least T1 apart
        for b in centres[i + 1:]:
            assert np.abs(np.array(vec[a]) - np.array(vec[b])).mean() >= t1 - 1e-12
    for s, c in got.items():  # members within 2*T1 of their canopy centre
        assert np.abs(np.array(vec[s]) - np.array(vec[c])).mean() < 2 * t1
    # one bucket is the exact sequential pass
    assert members(canopy_bucketed(v, t1, buckets=1)) == greedy_reference(rows, t1)


def test_sizes(spark):
    v = vec_df(spark, [("a", [0.0]), ("b", [0.3]), ("c", [0.6]), ("d", [0.9]), ("e", [0.95])])
    got = {r["canopy_id"]: r["n"] for r in canopy_sizes(canopy(v, 0.5)).collect()}
    assert got == {"a": 2, "c": 3}
    assert not math.isnan(sum(got.values()))


def test_duplicate_symbols_rejected(spark):
    v = vec_df(spark, [("a", [0.0]), ("a", [1.0])])
    with pytest.raises(ValueError):
        canopy(v, 0.5)


def test_distance_to_centre_broadcast_and_salted(spark):
    from quiver.operators.canopy import distance_to_centre

    v = vec_df(spark, [("a", [0.0]), ("b", [0.3]), ("c", [0.6]), ("d", [0.9])])
    m = canopy(v, 0.5)
    expect = {"a": 0.0, "b": 0.3, "c": 0.0, "d": 0.3}
    for kw in ({}, {"broadcast_bytes": 0, "salts": 3}):
        got = {r["symbol"]: round(r["dist"], 12) for r in distance_to_centre(m, 1, **kw).collect()}
        assert got == expect


@pytest.mark.parametrize("batch_bytes", [64 << 20, 500])
def test_rounds_with_many_nan_vectors(spark, batch_bytes):
    rng = np.random.default_rng(3)
    rows = [(f"n{i:03d}", [float("nan")] * 3 if i % 4 == 0 else rng.random(3).tolist()) for i in range(200)]
    got = members(canopy(vec_df(spark, rows), 0.2, batch=8, max_batch=16, batch_bytes=batch_bytes))
    assert got == greedy_reference(rows, 0.2)


def test_bucketed_nan_vectors_stay_alone(spark):
    rows = [(f"n{i}", [float("nan")] if i % 2 else [0.1]) for i in range(8)]
    assert members(canopy_bucketed(vec_df(spark, rows), 0.5, buckets=2)) == {
        f"n{i}": f"n{i}" if i % 2 else "n0" for i in range(8)}


def tree_reference(rows, t1, levels, bucket):
    """Sequential pass per bucket, then per bucket of the next level over the centres left."""
    left, of = list(rows), {s: s for s, _ in rows}
    for n in levels:
        step = {}
        for b in range(n):
            step.update(greedy_reference([r for r in left if bucket(r[0], n) == b], t1))
        of = {s: step[c] for s, c in of.items()}
        left = [r for r in left if step[r[0]] == r[0]]
    return of


@pytest.mark.parametrize("max_centres", [1, 3, 1000])
@pytest.mark.parametrize("broadcast_bytes", [0, 64 << 20])
def test_tree_of_buckets_for_any_bound_of_centres(spark, max_centres, broadcast_bytes):
    rng = np.random.default_rng(5)
    rows = [(f"t{i:03d}", rng.random(4).tolist()) for i in range(160)]
    digest = lambda s, n: int(hashlib.md5(s.encode()).hexdigest()[:8], 16) % n
    for levels in ((8, 2, 1), (6, 4), (1,)):
        got = members(canopy_tree(vec_df(spark, rows), 0.2, levels, max_centres=max_centres, broadcast_bytes=broadcast_bytes))
        assert got == tree_reference(rows, 0.2, levels, digest)


def test_tree_of_nothing_and_of_nan(spark):
    nan = float("nan")
    assert members(canopy_tree(vec_df(spark, []), 0.5, (4, 1))) == {}
    assert members(canopy_tree(vec_df(spark, [("a", [nan]), ("b", [nan])]), 0.5, (4, 2, 1))) == {"a": "a", "b": "b"}
    assert members(canopy_tree(vec_df(spark, [("a", [0.1]), ("b", [nan]), ("c", [0.2])]), 0.5)) == {"a": "a", "b": "b", "c": "a"}


def test_levels_of_a_tree():
    assert tree_levels(0) == tree_levels(1_000_000) == (1,)
    assert tree_levels(40_000_000) == (40, 3, 1)
    assert tree_levels(300, rows_per_bucket=10, fan=2) == (30, 15, 8, 4, 2, 1)
