"""quiver: canopy-restricted k-means clustering of short price series on Spark.

Pipeline: symbols -> daily bars -> latest days per symbol -> min-max scaled
feature vectors -> canopies (mean-L1, threshold T1) -> k-means inside each
canopy -> cluster listing and per-day series.  Every step is a DataFrame job.
"""

from quiver.config import RunConfig  # noqa: F401

__all__ = ["RunConfig"]
