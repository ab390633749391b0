"""The full run: bars -> vectors -> canopies -> seats/seeds -> k-means -> clusters -> series."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, functions as F

from quiver.config import RunConfig
from quiver.operators import canopy as canopy_ops
from quiver.operators import features as feat
from quiver.operators.kmeans import KMeansResult, kmeans
from quiver.operators.persist import reliable
from quiver.operators.results import number_clusters, series
from quiver.operators.seeding import seats, seeds


# Fixed value: requested-symbol lists up to this many rows are broadcast.
BROADCAST_SYMBOLS = 2_000_000


@dataclass
class RunResult:
    vectors: DataFrame
    members: DataFrame
    seats: DataFrame
    seeds: DataFrame
    kmeans: KMeansResult
    clusters: DataFrame
    series: DataFrame


def select_symbols(bars: DataFrame, symbols: DataFrame | None, amount: int | None) -> DataFrame:
    """Bars of the first ``amount`` requested symbols (all bars when no list is given)."""
    if symbols is None:
        return bars
    wanted = feat.first_n_symbols(symbols, amount).select("symbol").distinct()
    if wanted.count() <= BROADCAST_SYMBOLS:
        # bounded list: broadcast, so the (large) bar source is never shuffled for it
        wanted = F.broadcast(wanted)
    return bars.join(wanted, "symbol", "left_semi")


def cluster_vectors(vectors: DataFrame, cfg: RunConfig, centers_path: str | None = None
                    ) -> tuple[DataFrame, DataFrame, DataFrame, KMeansResult]:
    """vectors -> (members, seats, seeds, k-means result)."""
    vectors = reliable(vectors.select("symbol", "v"))
    dim = canopy_ops.check_vectors(vectors)
    if cfg.buckets > 0:
        members = canopy_ops.canopy_bucketed(vectors, cfg.t1, cfg.buckets, cfg.canopy_batch, check=False)
    else:
        members = canopy_ops.canopy(vectors, cfg.t1, cfg.canopy_batch, check=False, materialized=True)
    seat_table = reliable(seats(canopy_ops.canopy_sizes(members), cfg.clusters))
    initial = reliable(seeds(members, seat_table, cfg.seed))
    result = kmeans(members, initial.select("center_id", "canopy_id", "v"), dim, cfg.max_iter,
                    checkpoint_members=False, centers_path=centers_path)
    return members, seat_table, initial, result


def stage_window(bars: DataFrame, cfg: RunConfig, symbols: DataFrame | None = None,
                 bars_since=None, since=None) -> DataFrame:
    """The latest-D raw bars of every kept symbol, written once.

    Both the vectors and the result series derive from this N x D table, so
    the (large) bar source is scanned a single time per run.  With
    ``bars_since`` (date -> bars from that day on) and ``since``, the window is
    built recent-first: history is read only for symbols short of D recent
    bars (exact, see :func:`features.latest_days_recent_first`).
    """
    if bars_since is not None and since is not None:
        wanted = feat.first_n_symbols(symbols, cfg.amount).select("symbol") if symbols is not None else None
        lat = feat.latest_days_recent_first(bars_since, cfg.days, since, wanted, cfg.features)
        full = feat.with_history_count(lat)
        if cfg.short_history == "raise" and full.where(F.col("n_days") < cfg.days).limit(1).count():
            raise ValueError(f"symbols with fewer than {cfg.days} days")
        return reliable(full.where(F.col("n_days") == F.lit(int(cfg.days))).drop("n_days"))
    chosen = select_symbols(bars, symbols, cfg.amount)
    return reliable(feat.full_history(chosen, cfg.days, cfg.features, cfg.short_history))


def run(bars: DataFrame, cfg: RunConfig, symbols: DataFrame | None = None,
        centers_path: str | None = None, bars_since=None, since=None) -> RunResult:
    """The whole run; ``centers_path`` keeps each round's centre table (``iter=<i>``).

    ``bars_since``/``since`` switch the window to the recent-first build.
    """
    window = stage_window(bars, cfg, symbols, bars_since, since)
    vectors = feat.assemble(feat.normalize(window, cfg.features, degenerate=cfg.degenerate), cfg.features)
    members, seat_table, initial, result = cluster_vectors(vectors, cfg, centers_path)
    clusters = number_clusters(result.assignments, result.n_centers)
    return RunResult(vectors, members, seat_table, initial, result, clusters,
                     series(clusters, window, cfg.features))


def write_run(res: RunResult, out_dir: str) -> None:
    """Write every output of a run under ``out_dir`` (each folder overwritten)."""
    from quiver.sinks import write_assignments, write_canopies, write_cluster_text, write_vector_text

    out = out_dir.rstrip("/")
    write_vector_text(res.vectors, f"{out}/vectors")
    write_canopies(res.members, f"{out}/canopies")
    res.kmeans.centers.write.mode("overwrite").parquet(f"{out}/centers")
    write_assignments(res.kmeans.assignments, f"{out}/assignments")
    write_cluster_text(res.clusters, f"{out}/clusters")
    res.series.write.mode("overwrite").parquet(f"{out}/series")
