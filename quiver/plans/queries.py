"""Registered queries: one Spark plan per operator group, each with its DuckDB oracle.

Every query reads whole test tables (events, customer, lineitem, embeddings)
at the given scale directory.  Doubles are rounded to 6 places, dates are
rendered as ``yyyy-MM-dd`` strings and counts are bigint, identically on both
sides.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from quiver.config import FEATURES, RunConfig
from quiver.operators import canopy as canopy_ops
from quiver.operators import features as feat
from quiver.operators.kmeans import assign, kmeans
from quiver.operators.load import failed_symbols, load_report
from quiver.operators.matching import match_centres
from quiver.operators.persist import reliable
from quiver.operators.results import cluster_sizes, number_clusters, series, series_min
from quiver.operators.seeding import seats, seeds
from quiver.plans import oracle as O
from quiver.plans.pipeline import cluster_vectors, run
from quiver.session import scratch_path
from quiver.sinks import (append_price_rows, cluster_text_lines, write_assignments, write_canopies, write_cluster_text, write_price_csv,
                          write_symbol_directory, write_vector_text)
from quiver.sources import (customer_symbols, embedding_vectors, events_bars, lineitem_bars, load_table,
                            read_assignments, read_canopies, read_cluster_text, read_price_csv, read_symbol_directory,
                            read_vector_text)
from quiver.sources.files import number_directory

# Fixed query parameters (the reference's defaults where it has them).
DAYS = 5
T1 = 0.4
T1_FINE = 0.2
K = 12
SEED = "42"
SHORT_DAYS = 28
AMOUNT = 100
EMB_T1 = 0.14
EMB_K = 8
BUCKETS = 4
LEVELS = (16, 4, 1)
LEVEL_CENTRES = 3
K_LARGE = 40
RECENT_DAYS = 7
DIM = DAYS * len(FEATURES)
SUBSET = ("open", "close")


def _r(c, n: int = 6):
    return F.round(c, n)


def _bars(spark: SparkSession, sf: str) -> DataFrame:
    return events_bars(load_table(spark, sf, "events"))


def _vectors(spark: SparkSession, sf: str, days: int = DAYS, degenerate: str = "nan") -> DataFrame:
    return feat.build_vectors(_bars(spark, sf), days, FEATURES, degenerate)


def _window(spark: SparkSession, sf: str) -> DataFrame:
    """Latest-D raw bars of full-history symbols, written once (shared by vectors and series)."""
    return reliable(feat.full_history(_bars(spark, sf), DAYS))


def _members(spark: SparkSession, sf: str, window: DataFrame | None = None) -> DataFrame:
    if window is None:
        return canopy_ops.canopy(_vectors(spark, sf), T1)
    return canopy_ops.canopy(feat.assemble(feat.normalize(window)), T1)


def _seeded(spark: SparkSession, sf: str, k: int = K, window: DataFrame | None = None):
    members = _members(spark, sf, window)
    seat_table = reliable(seats(canopy_ops.canopy_sizes(members), k))
    initial = reliable(seeds(members, seat_table, SEED))
    return members, seat_table, initial


def _long(df: DataFrame, key: list[str], vcol: str = "v") -> DataFrame:
    return df.select(*key, F.posexplode(vcol).alias("pos", "x")).select(
        *key, F.col("pos").cast("int").alias("pos"), _r(F.col("x")).alias("x"))


def _bars_out(b: DataFrame) -> DataFrame:
    return b.select("symbol", F.date_format("d", "yyyy-MM-dd").alias("d"),
                    *[_r(F.col(f)).alias(f) for f in FEATURES])


# ---------------------------------------------------------------- features

def q_bars(spark, sf):
    return _bars_out(_bars(spark, sf))


def q_lineitem_bars(spark, sf):
    return _bars_out(lineitem_bars(load_table(spark, sf, "lineitem")))


def q_first_n_symbols(spark, sf):
    return feat.first_n_symbols(customer_symbols(load_table(spark, sf, "customer")), AMOUNT)


def q_latest_days(spark, sf):
    lat = feat.latest_days(_bars(spark, sf), DAYS)
    return lat.select("symbol", F.date_format("d", "yyyy-MM-dd").alias("d"),
                      F.col("day_index").cast("int").alias("day_index"), *[_r(F.col(f)).alias(f) for f in FEATURES])


def q_latest_days_recent(spark, sf):
    """latest_days computed recent-first: events from the last RECENT_DAYS days, history only where needed."""
    events = load_table(spark, sf, "events")
    last = events.agg(F.max(F.to_date("ts"))).first()[0]
    since = last - dt.timedelta(days=RECENT_DAYS - 1)
    listed = events.where(F.col("value").isNotNull() & F.col("ts").isNotNull() & F.col("user_id").isNotNull()).select(
        F.col("user_id").cast("string").alias("symbol"))
    lat = feat.latest_days_recent_first(lambda d: events_bars(events, d), DAYS, since, universe=listed)
    return lat.select("symbol", F.date_format("d", "yyyy-MM-dd").alias("d"),
                      F.col("day_index").cast("int").alias("day_index"), *[_r(F.col(f)).alias(f) for f in FEATURES])


def q_short_history(spark, sf):
    return feat.short_history(_bars(spark, sf), SHORT_DAYS)


def q_feature_minmax(spark, sf):
    full = feat.full_history(_bars(spark, sf), DAYS)
    mm = feat.feature_minmax(full)
    return mm.select("symbol", *[_r(F.col(c)).alias(c) for c in mm.columns if c != "symbol"])


def _normalized_long(spark, sf, days, degenerate):
    full = feat.full_history(_bars(spark, sf), days)
    lng = feat.to_long(feat.normalize(full, degenerate=degenerate))
    return lng.select("symbol", "pos", _r(F.col("x")).alias("x"))


def q_normalized_long(spark, sf):
    return _normalized_long(spark, sf, DAYS, "nan")


def q_normalized_constant(spark, sf):
    return _normalized_long(spark, sf, 1, "zero")


def q_vectors_long(spark, sf):
    return _long(_vectors(spark, sf), ["symbol"])


def q_vectors_subset(spark, sf):
    """Vectors of a feature subset."""
    return _long(feat.build_vectors(_bars(spark, sf), DAYS, SUBSET), ["symbol"])


def q_vector_text(spark, sf):
    path = scratch_path(spark, "vectors-text")
    write_vector_text(_vectors(spark, sf), path)
    return _long(read_vector_text(spark, path), ["symbol"])


def q_price_csv(spark, sf):
    path = scratch_path(spark, "prices")
    write_price_csv(_bars(spark, sf), path)
    return _bars_out(read_price_csv(spark, path))


def q_price_csv_corrupt(spark, sf):
    """Price files where every symbol that closed its last day lower has an unreadable row: those symbols fail whole."""
    path = scratch_path(spark, "prices")
    bars = reliable(_bars(spark, sf))
    write_price_csv(bars, path)
    falling = feat.latest_days(bars, 1).where(F.col("close") < F.col("open"))
    bad = falling.select("symbol", F.date_format("d", "yyyy-MM-dd").alias("date"), F.lit("?").alias("open"), "high", "low", "close")
    append_price_rows(bad, path)
    return _bars_out(read_price_csv(spark, path))


def q_symbol_directory(spark, sf):
    path = scratch_path(spark, "symbols")
    write_symbol_directory(customer_symbols(load_table(spark, sf, "customer")), path)
    return number_directory(read_symbol_directory(spark, path))


def q_load_report(spark, sf):
    requested = customer_symbols(load_table(spark, sf, "customer"))
    return load_report(requested, _bars(spark, sf))


def q_failed_symbols(spark, sf):
    requested = customer_symbols(load_table(spark, sf, "customer"))
    return failed_symbols(requested, _bars(spark, sf))


def q_vector_equality(spark, sf):
    return feat.equal_vector_groups(reliable(_vectors(spark, sf)), DIM)


# ---------------------------------------------------------------- canopy

def q_canopy_members(spark, sf):
    return _members(spark, sf).select("symbol", "canopy_id")


def q_canopy_members_rounds(spark, sf):
    """Canopies in many rounds of a small batch: what decides vectors beyond the first batch."""
    return canopy_ops.canopy(_vectors(spark, sf), T1, batch=16, max_batch=32).select("symbol", "canopy_id")


def q_canopy_files(spark, sf):
    path = scratch_path(spark, "canopies")
    members = _members(spark, sf)
    write_canopies(members, path)
    members.select("symbol").write.mode("overwrite").parquet(f"{path}/Other")  # not a canopy: skipped
    return read_canopies(spark, path).select("symbol", "canopy_id")


def q_canopy_members_bucketed(spark, sf):
    return canopy_ops.canopy_bucketed(_vectors(spark, sf), T1, buckets=BUCKETS).select("symbol", "canopy_id")


def q_canopy_members_tree(spark, sf):
    """Local passes merged over three levels; a task holds at most LEVEL_CENTRES centres."""
    tree = canopy_ops.canopy_tree(_vectors(spark, sf), T1, LEVELS, max_centres=LEVEL_CENTRES)
    return tree.select("symbol", "canopy_id")


def q_canopy_sizes(spark, sf):
    return canopy_ops.number_canopies(canopy_ops.canopy_sizes(_members(spark, sf)))


def q_pair_distance(spark, sf):
    d = canopy_ops.distance_to_centre(_members(spark, sf), DIM)
    return d.select("symbol", "canopy_id", _r(F.col("dist"), 9).alias("dist"))


def _centre_match(spark, sf, t1, nearest=True, canopy_t1=T1):
    m = canopy_ops.canopy(_vectors(spark, sf), canopy_t1)
    centres = m.where(F.col("symbol") == F.col("canopy_id")).select(F.col("symbol").alias("centre"), "v")
    return match_centres(m.select("symbol", "v"), centres, t1, nearest=nearest)


def q_centre_index(spark, sf):
    """Nearest, first and number of the centres of small canopies: many centres, most of them left out by their bounds."""
    r = _centre_match(spark, sf, T1_FINE, canopy_t1=T1_FINE)
    return r.select("symbol", "nearest", _r(F.col("nearest_dist"), 9).alias("nearest_dist"), F.col("first").alias("matched"), "n_within")


def q_nearest_neighbor(spark, sf):
    """Nearest canopy centre of every vector (not necessarily its own canopy's)."""
    r = _centre_match(spark, sf, T1)
    return r.select("symbol", "nearest", _r(F.col("nearest_dist"), 9).alias("nearest_dist"))


def q_nearest_neighbor_constant(spark, sf):
    """Nearest centre of vectors without any distance (one-day window, constant features): the first one."""
    m = canopy_ops.canopy(_vectors(spark, sf, 1), T1)
    centres = m.where(F.col("symbol") == F.col("canopy_id")).select(F.col("symbol").alias("centre"), "v")
    r = match_centres(m.select("symbol", "v"), centres, T1)
    return r.select("symbol", "nearest", _r(F.col("nearest_dist"), 9).alias("nearest_dist"))


def q_fixed_center_match(spark, sf):
    """First canopy centre (creation order) within T1/2 of every vector, else null."""
    return _centre_match(spark, sf, T1 / 2, nearest=False).select("symbol", F.col("first").alias("matched"))


def q_pairs_within_t1(spark, sf):
    """Number of canopy centres within T1 of every vector."""
    return _centre_match(spark, sf, T1, nearest=False).select("symbol", "n_within")


# ---------------------------------------------------------------- k-means

def q_canopy_seats(spark, sf):
    _, seat_table, _ = _seeded(spark, sf)
    return seat_table.select("canopy_id", "n", "seats")


def q_seeds(spark, sf):
    _, _, initial = _seeded(spark, sf)
    return initial.select(F.col("center_id").cast("long").alias("center_id"), "canopy_id", "symbol")


def q_assign_step(spark, sf):
    members, _, initial = _seeded(spark, sf)
    n = initial.count()
    a = assign(members, initial, DIM, n)
    return a.select("symbol", "canopy_id", "center_id", _r(F.col("dist"), 9).alias("dist"))


def q_update_step(spark, sf):
    members, _, initial = _seeded(spark, sf)
    res = kmeans(members, initial, DIM, max_iter=1, stop_on_convergence=False, checkpoint_members=False)
    return _long(res.centers, ["center_id"])


def q_convergence_count(spark, sf):
    """Changed assignments per round, as the loop counted them into the per-round centre tables (SNK4)."""
    members, _, initial = _seeded(spark, sf)
    path = scratch_path(spark, "centres-by-round")
    kmeans(members, initial, DIM, max_iter=3, stop_on_convergence=False, checkpoint_members=False, centers_path=path)
    return spark.read.parquet(path).groupBy(F.col("iter").cast("int").alias("round")).agg(
        F.sum("changed").cast("long").alias("changed"))


def q_kmeans_3_iter(spark, sf):
    members, _, initial = _seeded(spark, sf)
    res = kmeans(members, initial, DIM, max_iter=3, stop_on_convergence=False, checkpoint_members=False)
    return res.assignments.select("symbol", "center_id")


def q_kmeans_tables(spark, sf):
    """Three rounds with the centres held in written tables and small member groups."""
    members, _, initial = _seeded(spark, sf)
    res = kmeans(members, initial, DIM, max_iter=3, stop_on_convergence=False, checkpoint_members=False,
                 model_bytes=0, rows_per_group=20)
    return res.assignments.select("symbol", "center_id")


def q_kmeans_jvm(spark, sf):
    """Three rounds by the JVM expression, centres in tables and joined by salt."""
    members, _, initial = _seeded(spark, sf)
    res = kmeans(members, initial, DIM, max_iter=3, stop_on_convergence=False, checkpoint_members=False,
                 model_bytes=0, broadcast_bytes=0, salts=4, engine="jvm")
    return res.assignments.select("symbol", "center_id")


def _clusters(spark, sf, k: int = K, window: DataFrame | None = None):
    members, _, initial = _seeded(spark, sf, k, window)
    res = kmeans(members, initial, DIM, checkpoint_members=False)
    return reliable(number_clusters(res.assignments, res.n_centers))


def q_clusters(spark, sf):
    return _clusters(spark, sf)


def q_clusters_k40(spark, sf):
    """Many more centres than canopies: real k-means iterations inside canopies."""
    return _clusters(spark, sf, K_LARGE)


def q_clusters_constant(spark, sf):
    """Clusters of vectors without any distance: every one its own canopy and cluster."""
    res = run(_bars(spark, sf), RunConfig(days=1, clusters=K, t1=T1))
    return res.clusters


def q_assignments_roundtrip(spark, sf):
    """The assignment table written and read back (SNK6, SRC7)."""
    members, _, initial = _seeded(spark, sf)
    res = kmeans(members, initial, DIM, checkpoint_members=False)
    path = scratch_path(spark, "assignments")
    write_assignments(res.assignments, path)
    a = read_assignments(spark, path)
    return a.select("symbol", "canopy_id", "center_id", _r(F.col("dist"), 9).alias("dist"))


def q_lineitem_clusters(spark, sf):
    """The full run on the second bar source (supplier x ship date, long histories)."""
    res = run(lineitem_bars(load_table(spark, sf, "lineitem")), RunConfig(days=DAYS, clusters=K, t1=T1))
    return res.clusters


def q_cluster_lines(spark, sf):
    return cluster_text_lines(_clusters(spark, sf))


def q_cluster_text(spark, sf):
    path = scratch_path(spark, "clusters-text")
    write_cluster_text(_clusters(spark, sf), path)
    return read_cluster_text(spark, path)


def q_cluster_sizes(spark, sf):
    return cluster_sizes(_clusters(spark, sf))


def _series(spark, sf):
    window = _window(spark, sf)
    return series(_clusters(spark, sf, window=window), window)


def q_series(spark, sf):
    s = _series(spark, sf)
    return s.select("cluster_no", "symbol", "day_index", _r(F.col("value")).alias("value"))


def q_series_subset(spark, sf):
    """Per-day mean of a feature subset, clustered on that subset."""
    res = run(_bars(spark, sf), RunConfig(days=DAYS, clusters=K, t1=T1, features=SUBSET))
    return res.series.select("cluster_no", "symbol", "day_index", _r(F.col("value")).alias("value"))


def q_series_min(spark, sf):
    m = series_min(_series(spark, sf))
    return m.select("symbol", _r(F.col("min_value")).alias("min_value"))


def q_pipeline(spark, sf):
    """The whole run through the pipeline API (first AMOUNT requested symbols)."""
    requested = customer_symbols(load_table(spark, sf, "customer"))
    res = run(_bars(spark, sf), RunConfig(amount=AMOUNT, days=DAYS, clusters=5, t1=T1), requested)
    return res.clusters


# ---------------------------------------------------------------- embeddings

def _emb(spark, sf):
    return embedding_vectors(load_table(spark, sf, "embeddings"))


def q_embedding_canopy(spark, sf):
    return canopy_ops.canopy(_emb(spark, sf), EMB_T1).select("symbol", "canopy_id")


def q_embedding_canopy_rounds(spark, sf):
    """Canopies of the embeddings in rounds of a batch far below their number."""
    return canopy_ops.canopy(_emb(spark, sf), EMB_T1, batch=64, max_batch=128).select("symbol", "canopy_id")


def q_embedding_clusters(spark, sf):
    vec = _emb(spark, sf)
    cfg = RunConfig(clusters=EMB_K, t1=EMB_T1)
    _, _, _, res = cluster_vectors(vec, cfg)
    return number_clusters(res.assignments, res.n_centers)


# ---------------------------------------------------------------- oracle SQL

P = O.pipeline_prefix


def _sql_round6(cols):
    return ", ".join(f"round({c}, 6) AS {c}" for c in cols)


def _oracle() -> dict[str, str]:
    feats6 = _sql_round6(FEATURES)
    base = P(DAYS)
    canopy = O.canopy_ctes(T1)
    seeded = ",\n".join([base, canopy, O.seats_ctes(K), O.seeds_ctes(SEED)])
    clusters_sql = ",\n".join([seeded, O.converged_ctes(DIM)])
    q: dict[str, str] = {}
    q["bars"] = f"WITH {O.bars_cte()}\nSELECT symbol, CAST(d AS VARCHAR) AS d, {feats6} FROM bars"
    q["lineitem_bars"] = f"WITH {O.bars_cte('lineitem')}\nSELECT symbol, CAST(d AS VARCHAR) AS d, {feats6} FROM bars"
    q["first_n_symbols"] = (f"SELECT CAST(c_custkey AS VARCHAR) AS symbol, CAST(c_custkey AS BIGINT) AS pos "
                            f"FROM customer WHERE c_custkey < {AMOUNT}")
    q["latest_days"] = (f"WITH {O.bars_cte()},\n{O.latest_ctes(DAYS)}\n"
                        f"SELECT symbol, CAST(d AS VARCHAR) AS d, CAST(day_index AS INTEGER) AS day_index, {feats6} FROM lat")
    q["latest_days_recent"] = q["latest_days"]
    q["short_history"] = (f"WITH {O.bars_cte()},\n{O.latest_ctes(SHORT_DAYS)}\n"
                          f"SELECT symbol, CAST(count(*) AS BIGINT) AS n_days FROM lat GROUP BY symbol "
                          f"HAVING count(*) < {SHORT_DAYS}")
    mm = ", ".join(f"round(min({f}), 6) AS {f}_min, round(max({f}), 6) AS {f}_max" for f in FEATURES)
    q["feature_minmax"] = f"WITH {O.bars_cte()},\n{O.latest_ctes(DAYS)}\nSELECT symbol, {mm} FROM fh GROUP BY symbol"
    q["normalized_long"] = f"WITH {base}\nSELECT symbol, pos, round(x, 6) AS x FROM vl"
    q["normalized_constant"] = f"WITH {P(1, 'zero')}\nSELECT symbol, pos, round(x, 6) AS x FROM vl"
    q["vectors_long"] = (f"WITH {base}\nSELECT symbol, CAST(p - 1 AS INTEGER) AS pos, round(v[p], 6) AS x "
                         f"FROM vec, generate_series(1, {DIM}) g(p)")
    q["vector_text"] = q["vectors_long"]
    q["vectors_subset"] = (f"WITH {P(DAYS, feats=SUBSET)}\nSELECT symbol, CAST(p - 1 AS INTEGER) AS pos, round(v[p], 6) AS x "
                           f"FROM vec, generate_series(1, {DAYS * len(SUBSET)}) g(p)")
    q["price_csv"] = q["bars"]
    q["price_csv_corrupt"] = (f"WITH {O.bars_cte()},\n{O.latest_ctes(1)}\nSELECT symbol, CAST(d AS VARCHAR) AS d, {feats6} FROM bars "
                              "WHERE symbol NOT IN (SELECT symbol FROM lat WHERE close < open)")
    q["symbol_directory"] = ("SELECT CAST(c_custkey AS VARCHAR) AS symbol, "
                             "CAST(row_number() OVER (ORDER BY c_custkey) - 1 AS BIGINT) AS pos FROM customer")
    q["load_report"] = (f"WITH {O.bars_cte()},\nreq AS (SELECT DISTINCT CAST(c_custkey AS VARCHAR) AS symbol FROM customer),\n"
                        "got AS (SELECT DISTINCT symbol FROM bars)\n"
                        "SELECT CAST((SELECT count(*) FROM req) AS BIGINT) AS requested, "
                        "CAST((SELECT count(*) FROM req WHERE symbol IN (SELECT symbol FROM got)) AS BIGINT) AS loaded, "
                        "CAST((SELECT count(*) FROM req WHERE symbol NOT IN (SELECT symbol FROM got)) AS BIGINT) AS failed")
    q["failed_symbols"] = (f"WITH {O.bars_cte()}\nSELECT DISTINCT CAST(c_custkey AS VARCHAR) AS symbol FROM customer "
                           "WHERE CAST(c_custkey AS VARCHAR) NOT IN (SELECT symbol FROM bars)")
    q["vector_equality"] = (f"WITH {base}\nSELECT a.symbol, g.twin_of, g.n_same FROM vec a JOIN "
                            "(SELECT v, min(symbol) AS twin_of, CAST(count(*) AS BIGINT) AS n_same FROM vec GROUP BY v) g "
                            "ON a.v = g.v")
    q["canopy_members"] = O.with_recursive(base, canopy) + "SELECT symbol, canopy AS canopy_id FROM mem"
    q["canopy_members_rounds"] = q["canopy_members"]
    q["canopy_files"] = q["canopy_members"]
    q["canopy_members_bucketed"] = O.with_recursive(base, O.canopy_bucketed_ctes(T1, BUCKETS)) + \
        "SELECT symbol, canopy AS canopy_id FROM mem"
    q["canopy_members_tree"] = O.with_recursive(base, O.canopy_tree_ctes(T1, LEVELS)) + "SELECT symbol, canopy AS canopy_id FROM mem"
    q["canopy_sizes"] = O.with_recursive(base, canopy) + \
        ("SELECT canopy AS canopy_id, CAST(count(*) AS BIGINT) AS n, "
         "CAST(row_number() OVER (ORDER BY canopy) AS BIGINT) AS canopy_no FROM mem GROUP BY canopy")
    q["pair_distance"] = O.with_recursive(base, canopy) + (
        f"SELECT m.symbol, m.canopy AS canopy_id, round({O.dist('c.v', 'm.v')}, 9) AS dist "
        "FROM mem m JOIN mem c ON c.symbol = m.canopy")
    cen = ("fixed AS (SELECT symbol AS centre, v AS cv FROM mem WHERE symbol = canopy),\n"
           f"mc AS (SELECT m.symbol, {O.dist('c.cv', 'm.v')} AS dd, c.centre FROM mem m CROSS JOIN fixed c)")
    q["nearest_neighbor"] = O.with_recursive(base, canopy, cen) + (
        f"SELECT symbol, arg_min(centre, ({O.snap('dd')}, centre)) AS nearest, "
        f"round(min({O.snap('dd')}), 9) AS nearest_dist FROM mc GROUP BY symbol")
    fine = O.canopy_ctes(T1_FINE)
    q["centre_index"] = O.with_recursive(base, fine, cen) + (
        f"SELECT symbol, arg_min(centre, ({O.snap('dd')}, centre)) AS nearest, round(min({O.snap('dd')}), 9) AS nearest_dist, "
        f"min(centre) FILTER (WHERE dd < {T1_FINE!r}) AS matched, "
        f"CAST(count(*) FILTER (WHERE dd < {T1_FINE!r}) AS BIGINT) AS n_within FROM mc GROUP BY symbol")
    one_day = P(1)
    q["nearest_neighbor_constant"] = O.with_recursive(one_day, canopy, cen) + (
        f"SELECT symbol, arg_min(centre, ({O.snap('dd')}, centre)) AS nearest, "
        f"round(min({O.snap('dd')}), 9) AS nearest_dist FROM mc GROUP BY symbol")
    q["fixed_center_match"] = O.with_recursive(base, canopy, cen) + (
        f"SELECT symbol, min(centre) FILTER (WHERE dd < {T1 / 2!r}) AS matched FROM mc GROUP BY symbol")
    q["pairs_within_t1"] = O.with_recursive(base, canopy, cen) + (
        f"SELECT symbol, CAST(count(*) FILTER (WHERE dd < {T1!r}) AS BIGINT) AS n_within FROM mc GROUP BY symbol")
    q["canopy_seats"] = O.with_recursive(base, canopy, O.seats_ctes(K)) + \
        "SELECT canopy AS canopy_id, CAST(n AS BIGINT) AS n, CAST(k AS BIGINT) AS seats FROM seats"
    q["seeds"] = O.with_recursive(seeded) + \
        "SELECT CAST(cid AS BIGINT) AS center_id, canopy AS canopy_id, symbol FROM c0"
    q["assign_step"] = O.with_recursive(seeded, O.kmeans_ctes(1, DIM)) + \
        "SELECT symbol, canopy AS canopy_id, CAST(cid AS BIGINT) AS center_id, round(dd, 9) AS dist FROM a1"
    q["update_step"] = O.with_recursive(seeded, O.kmeans_ctes(1, DIM)) + \
        f"SELECT CAST(cid AS BIGINT) AS center_id, CAST(p - 1 AS INTEGER) AS pos, round(v[p], 6) AS x " \
        f"FROM c1, generate_series(1, {DIM}) g(p)"
    q["convergence_count"] = O.with_recursive(seeded, O.kmeans_ctes(3, DIM)) + (
        "SELECT 1 AS round, CAST(count(*) AS BIGINT) AS changed FROM a1 UNION ALL "
        "SELECT 2, CAST(count(*) FILTER (WHERE a1.cid <> a2.cid) AS BIGINT) FROM a1 JOIN a2 USING (symbol) UNION ALL "
        "SELECT 3, CAST(count(*) FILTER (WHERE a2.cid <> a3.cid) AS BIGINT) FROM a2 JOIN a3 USING (symbol)")
    q["kmeans_3_iter"] = O.with_recursive(seeded, O.kmeans_ctes(3, DIM)) + \
        "SELECT symbol, CAST(cid AS BIGINT) AS center_id FROM a3"
    q["kmeans_tables"] = q["kmeans_jvm"] = q["kmeans_3_iter"]
    q["clusters"] = O.with_recursive(clusters_sql) + "SELECT cluster_no, symbol FROM cl"
    q["cluster_text"] = q["clusters"]
    q["lineitem_clusters"] = O.with_recursive(O.clusters_ctes(P(DAYS, source="lineitem"), T1, K, DIM)) + "SELECT cluster_no, symbol FROM cl"
    q["clusters_k40"] = O.with_recursive(O.clusters_ctes(base, T1, K_LARGE, DIM)) + \
        "SELECT cluster_no, symbol FROM cl"
    q["clusters_constant"] = O.with_recursive(O.clusters_ctes(one_day, T1, K, len(FEATURES))) + \
        "SELECT cluster_no, symbol FROM cl"
    q["assignments_roundtrip"] = O.with_recursive(clusters_sql) + \
        "SELECT symbol, canopy AS canopy_id, CAST(cid AS BIGINT) AS center_id, round(dd, 9) AS dist FROM af"
    q["cluster_sizes"] = O.with_recursive(clusters_sql) + \
        "SELECT cluster_no, CAST(count(*) AS BIGINT) AS n_symbols FROM cl GROUP BY cluster_no"
    q["cluster_lines"] = O.with_recursive(clusters_sql) + (
        "SELECT cluster_no, CAST(0 AS BIGINT) AS chunk, "
        "CAST(cluster_no AS VARCHAR) || ' ' || string_agg(symbol, ' ' ORDER BY symbol) AS line "
        "FROM cl GROUP BY cluster_no")
    series_sql = ("ser AS (SELECT cl.cluster_no, f.symbol, CAST(f.day_index AS INTEGER) AS day_index, "
                  "(f.open + f.high + f.low + f.close) / CAST(4.0 AS DOUBLE) AS value FROM cl JOIN fh f USING (symbol))")
    q["series"] = O.with_recursive(clusters_sql, series_sql) + \
        "SELECT cluster_no, symbol, day_index, round(value, 6) AS value FROM ser"
    subset_mean = " + ".join(f"f.{c}" for c in SUBSET)
    q["series_subset"] = O.with_recursive(O.clusters_ctes(P(DAYS, feats=SUBSET), T1, K, DAYS * len(SUBSET))) + (
        f"SELECT cl.cluster_no, f.symbol, CAST(f.day_index AS INTEGER) AS day_index, "
        f"round(({subset_mean}) / CAST({len(SUBSET)} AS DOUBLE), 6) AS value FROM cl JOIN fh f USING (symbol)")
    q["series_min"] = O.with_recursive(clusters_sql, series_sql) + \
        "SELECT symbol, round(min(value), 6) AS min_value FROM ser GROUP BY symbol"
    q["stock_pipeline"] = O.with_recursive(O.clusters_ctes(P(DAYS, amount=AMOUNT), T1, 5, DIM)) + \
        "SELECT cluster_no, symbol FROM cl"
    emb = "emb AS (SELECT CAST(vec_id AS VARCHAR) AS symbol, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS v FROM embeddings)"
    q["embedding_clusters"] = O.with_recursive(O.clusters_ctes(emb, EMB_T1, EMB_K, 64, vec="emb")) + \
        "SELECT cluster_no, symbol FROM cl"
    q["embedding_canopy"] = O.with_recursive(emb, O.canopy_ctes(EMB_T1, "emb")) + \
        "SELECT symbol, canopy AS canopy_id FROM mem"
    q["embedding_canopy_rounds"] = q["embedding_canopy"]
    return q


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "bars": q_bars,
    "lineitem_bars": q_lineitem_bars,
    "first_n_symbols": q_first_n_symbols,
    "latest_days": q_latest_days,
    "latest_days_recent": q_latest_days_recent,
    "short_history": q_short_history,
    "feature_minmax": q_feature_minmax,
    "normalized_long": q_normalized_long,
    "normalized_constant": q_normalized_constant,
    "vectors_long": q_vectors_long,
    "vectors_subset": q_vectors_subset,
    "vector_text": q_vector_text,
    "price_csv": q_price_csv,
    "price_csv_corrupt": q_price_csv_corrupt,
    "symbol_directory": q_symbol_directory,
    "load_report": q_load_report,
    "failed_symbols": q_failed_symbols,
    "vector_equality": q_vector_equality,
    "canopy_members": q_canopy_members,
    "canopy_members_rounds": q_canopy_members_rounds,
    "canopy_files": q_canopy_files,
    "canopy_members_bucketed": q_canopy_members_bucketed,
    "canopy_members_tree": q_canopy_members_tree,
    "canopy_sizes": q_canopy_sizes,
    "pair_distance": q_pair_distance,
    "nearest_neighbor": q_nearest_neighbor,
    "centre_index": q_centre_index,
    "nearest_neighbor_constant": q_nearest_neighbor_constant,
    "fixed_center_match": q_fixed_center_match,
    "pairs_within_t1": q_pairs_within_t1,
    "canopy_seats": q_canopy_seats,
    "seeds": q_seeds,
    "assign_step": q_assign_step,
    "update_step": q_update_step,
    "convergence_count": q_convergence_count,
    "kmeans_3_iter": q_kmeans_3_iter,
    "clusters": q_clusters,
    "clusters_k40": q_clusters_k40,
    "clusters_constant": q_clusters_constant,
    "assignments_roundtrip": q_assignments_roundtrip,
    "lineitem_clusters": q_lineitem_clusters,
    "cluster_lines": q_cluster_lines,
    "cluster_text": q_cluster_text,
    "cluster_sizes": q_cluster_sizes,
    "series": q_series,
    "series_subset": q_series_subset,
    "series_min": q_series_min,
    "stock_pipeline": q_pipeline,
    "embedding_canopy": q_embedding_canopy,
    "embedding_canopy_rounds": q_embedding_canopy_rounds,
    "embedding_clusters": q_embedding_clusters,
    "kmeans_tables": q_kmeans_tables,
    "kmeans_jvm": q_kmeans_jvm,
}

ORACLE: dict[str, str] = _oracle()
