"""Run options for the clustering pipeline."""

from __future__ import annotations

from dataclasses import dataclass, field

# Fixed values that results depend on (feature names and their order).
FEATURES: tuple[str, ...] = ("open", "high", "low", "close")


@dataclass(frozen=True)
class RunConfig:
    """Options of one clustering run.

    amount        first N symbols of the directory (file order); None = all
    days          latest D trading days kept per symbol
    clusters      k requested clusters (K = min(N, max(k, #canopies)))
    features      chosen subset of open/high/low/close, kept in that order
    t1            canopy threshold on the mean-L1 scale, strict ``<``
    seed          text mixed into the md5 ordering that picks seeds
    max_iter      k-means rounds after which a run that has not converged raises; None = no cap
    degenerate    constant feature in the window: 'nan', 'zero' or 'drop'
    short_history symbol with fewer than D days: 'drop' or 'raise'
    canopy_batch  vectors decided per canopy round in one task (bounded)
    buckets       >0 switches canopy to the bucketed local-pass + merge form
    """

    amount: int | None = None
    days: int = 5
    clusters: int = 5
    features: tuple[str, ...] = field(default=FEATURES)
    t1: float = 0.4
    seed: str = "42"
    max_iter: int | None = None
    degenerate: str = "nan"
    short_history: str = "drop"
    canopy_batch: int = 2048
    buckets: int = 0

    def __post_init__(self) -> None:
        bad = [f for f in self.features if f not in FEATURES]
        if bad or not self.features:
            raise ValueError(f"features must be a non-empty subset of {FEATURES}, got {self.features}")
        ordered = tuple(f for f in FEATURES if f in self.features)
        object.__setattr__(self, "features", ordered)
        if self.days < 1:
            raise ValueError("days must be >= 1")
        if self.clusters < 1:
            raise ValueError("clusters must be >= 1")
        if self.degenerate not in ("nan", "zero", "drop"):
            raise ValueError("degenerate must be 'nan', 'zero' or 'drop'")
        if self.short_history not in ("drop", "raise"):
            raise ValueError("short_history must be 'drop' or 'raise'")

    @property
    def dim(self) -> int:
        return self.days * len(self.features)
