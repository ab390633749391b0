"""Property tests: canopy equals the sequential definition; seat rule invariants."""

import numpy as np
from hypothesis import HealthCheck, given, settings, strategies as st

from quiver.operators.canopy import canopy
from conftest import greedy_reference, vec_df
from test_kmeans import seats_reference

SETTINGS = settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])


@SETTINGS
@given(seed=st.integers(0, 10_000), n=st.integers(1, 60), d=st.integers(1, 5),
       t1=st.floats(0.02, 0.6), batch=st.integers(1, 16))
def test_canopy_is_sequential_greedy(spark, seed, n, d, t1, batch):
    rng = np.random.default_rng(seed)
    rows = [(f"s{rng.integers(0, 10**6):07d}_{i}", rng.random(d).round(2).tolist()) for i in range(n)]
    got = {r["symbol"]: r["canopy_id"] for r in canopy(vec_df(spark, rows), t1, batch=batch).collect()}
    assert got == greedy_reference(rows, t1)


@settings(max_examples=2000, deadline=None)
@given(sizes=st.lists(st.integers(1, 500), min_size=1, max_size=40), k=st.integers(1, 200))
def test_seat_rule_invariants(sizes, k):
    table = {f"c{i:03d}": n for i, n in enumerate(sizes)}
    seats = seats_reference(table, k)
    kk = min(sum(sizes), max(k, len(sizes)))
    assert sum(seats.values()) == kk
    assert all(1 <= seats[c] <= table[c] for c in table)
