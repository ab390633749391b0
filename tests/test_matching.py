import tracemalloc

import numpy as np
import pyarrow as pa
import pytest

from quiver.functions.distance import CentreIndex, mean_l1_matrix

from quiver.operators.matching import _block_pass, match_centres
from conftest import vec_df


def brute(rows, cents, t1):
    out = {}
    for s, v in rows:
        x = np.asarray(v)
        ds = [(float(np.floor(np.cumsum(np.abs(np.asarray(cv) - x))[-1] / len(x) * 1e12 + 0.5) / 1e12), c,
               np.cumsum(np.abs(np.asarray(cv) - x))[-1] / len(x)) for c, cv in sorted(cents)]
        near = min((d, c) for d, c, _ in ds)
        within = [c for _, c, raw in ds if raw < t1]
        out[s] = (near[1], round(near[0], 9), within[0] if within else None, len(within))
    return out


def test_match_centres_one_and_many_blocks(spark):
    rng = np.random.default_rng(17)
    rows = [(f"v{i:03d}", rng.random(4).round(1).tolist()) for i in range(80)]  # rounding makes ties
    cents = [(f"c{i:02d}", rng.random(4).round(1).tolist()) for i in range(12)]
    v = vec_df(spark, rows)
    c = vec_df(spark, cents).withColumnRenamed("symbol", "centre")
    expect = brute(rows, cents, 0.3)
    for block in (32 << 20, 1):  # one block / one centre per block (combined by aggregation)
        got = {r["symbol"]: (r["nearest"], round(r["nearest_dist"], 9), r["first"], r["n_within"])
               for r in match_centres(v, c, 0.3, block_bytes=block).collect()}
        assert got == expect


def test_nan_vector_keeps_the_first_centre_in_every_block_layout(spark):
    v = vec_df(spark, [("a", [float("nan"), 1.0]), ("b", [0.9, 0.9])])
    c = vec_df(spark, [("c2", [1.0, 1.0]), ("c1", [5.0, 5.0]), ("c3", [float("nan"), 0.9])]).withColumnRenamed("symbol", "centre")
    for block in (32 << 20, 1):
        got = {r["symbol"]: (r["nearest"], r["n_within"]) for r in match_centres(v, c, 0.5, block_bytes=block).collect()}
        assert got == {"a": ("c1", 0), "b": ("c2", 1)}


@pytest.mark.parametrize("dim", [1, 4, 6, 20, 33])
@pytest.mark.parametrize("spread", [1.0, 0.05, 1e6])
def test_index_keeps_every_distance_that_matters(dim, spread):
    rng = np.random.default_rng(dim)
    seats = rng.random((30, dim)) * spread
    cents = np.vstack([seats, seats[:5], np.full((1, dim), np.nan)])  # repeats tie
    rows = np.vstack([seats[rng.integers(0, 30, 200)] + rng.normal(0, 0.01 * spread, (200, dim)), cents[:3], np.full((1, dim), np.nan)])
    exact, t1 = mean_l1_matrix(rows, cents), 0.05 * spread
    for pivots in (0, 4):
        for known in (None, np.full(len(rows), np.inf)):
            got, n = CentreIndex(cents, pivots).distances(rows, t1, known)
            assert ((got < t1) == (exact < t1)).all()
            kept = np.isfinite(got)
            assert (got[kept] == exact[kept]).all() and (n <= len(cents) + 4).all()
            if known is not None:
                assert (np.nanmin(got[:-1], axis=1) == np.nanmin(exact[:-1], axis=1)).all()
                assert (np.where(np.isnan(got[:-1]), np.inf, got[:-1]).argmin(axis=1) == np.where(np.isnan(exact[:-1]), np.inf, exact[:-1]).argmin(axis=1)).all()


def test_index_computes_under_half_of_the_distances_where_it_pays(spark):
    rng = np.random.default_rng(3)
    seats = rng.random((60, 16))
    rows = [(f"v{i:04d}", (seats[i % 60] + rng.normal(0, 0.02, 16)).tolist()) for i in range(600)]
    cents = [(f"c{i:02d}", s.tolist()) for i, s in enumerate(seats)]
    v, c = vec_df(spark, rows), vec_df(spark, cents).withColumnRenamed("symbol", "centre")
    expect = brute(rows, cents, 0.1)
    both = match_centres(v, c, 0.1).collect()
    assert {r["symbol"]: (r["nearest"], round(r["nearest_dist"], 9), r["first"], r["n_within"]) for r in both} == expect
    assert sum(r["n_computed"] for r in both) < 0.25 * len(rows) * len(cents)
    within = match_centres(v, c, 0.1, nearest=False).collect()
    assert {r["symbol"]: (r["first"], r["n_within"]) for r in within} == {k: e[2:] for k, e in expect.items()}
    assert {r["nearest"] for r in within} == {None}


def test_a_large_batch_is_matched_in_little_memory():
    rng = np.random.default_rng(5)
    cents, rows = rng.random((900, 20)).round(2), rng.random((10_000, 20)).round(2)
    batch = pa.RecordBatch.from_pydict({"symbol": [f"v{i:05d}" for i in range(len(rows))], "v": list(rows)})
    run = _block_pass([f"c{i:03d}" for i in range(len(cents))], cents, 0.2, True)
    tracemalloc.start()
    out = next(run(iter([batch])))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 48 << 20  # bytes; tiles of all rows at once took over three times that
    some = rng.choice(len(rows), 40, replace=False).tolist()
    expect = brute([(f"v{i:05d}", rows[i].tolist()) for i in some], [(f"c{j:03d}", c.tolist()) for j, c in enumerate(cents)], 0.2)
    got = out.take(some).to_pylist()
    assert {r["symbol"]: (r["nearest"], round(r["nearest_dist"], 9), r["first"], r["n_within"]) for r in got} == expect
