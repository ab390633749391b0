"""Session helpers: local session for tests/bench, the shared checkpoint folder, and
shipping the package to Python workers."""

from __future__ import annotations

import os
import shutil
import tempfile
import uuid

from pyspark.sql import SparkSession

_LOCAL_CKPT: dict[str, str] = {}
_SHIPPED: set[str] = set()
_SCRATCH: list[str] = []


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "quiver") -> SparkSession:
    """Local session used by tests, bench and tools."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", os.environ.get("QUIVER_DRIVER_MEMORY", "8g"))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    checkpoint_dir(spark)
    ship_package(spark)
    return spark


def _context(spark: SparkSession):
    try:
        return spark.sparkContext
    except Exception:  # noqa: BLE001  (Spark Connect sessions have no SparkContext)
        return None


def _is_local(spark: SparkSession, sc) -> bool:
    if sc is not None:
        return sc.master.startswith("local")
    master = spark.conf.get("spark.master", "") or ""
    return master.startswith("local")


def checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared folder for written intermediate tables.

    On a cluster ``spark.checkpoint.dir`` must name a folder shared by all
    nodes; it is read from the session.  Only a local-mode session without the
    setting (tests) gets a fresh temporary folder.
    """
    sc = _context(spark)
    if sc is not None and sc.getCheckpointDir():
        return sc.getCheckpointDir()
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured and sc is not None:
        configured = sc.getConf().get("spark.checkpoint.dir", None)
    if not configured:
        if not _is_local(spark, sc):
            raise RuntimeError("spark.checkpoint.dir is not set; point it at a folder shared by the cluster")
        key = "local"
        if key not in _LOCAL_CKPT:
            _LOCAL_CKPT[key] = tempfile.mkdtemp(prefix="quiver-ckpt-", dir="/tmp")
        configured = _LOCAL_CKPT[key]
    if sc is not None:
        sc.setCheckpointDir(configured)
        return sc.getCheckpointDir()
    return configured


def ship_package(spark: SparkSession) -> None:
    """Make ``quiver`` importable in Python workers (what ``--py-files`` does).

    The archive is staged in a driver-local folder and served by the driver
    through ``addPyFile``; no data goes there.  Skipped when the job was
    submitted with the package already in ``--py-files``.
    """
    sc = _context(spark)
    key = sc.applicationId if sc is not None else f"connect-{id(spark)}"
    if key in _SHIPPED:
        return
    if sc is not None and "quiver" in (sc.getConf().get("spark.submit.pyFiles", "") or ""):
        _SHIPPED.add(key)
        return
    pkg_dir = os.path.dirname(os.path.abspath(__file__))
    out_dir = tempfile.mkdtemp(prefix="quiver-pyfiles-")
    archive = shutil.make_archive(os.path.join(out_dir, "quiver"), "zip",
                                  root_dir=os.path.dirname(pkg_dir), base_dir="quiver")
    if sc is not None:
        sc.addPyFile(archive)
    else:
        spark.addArtifacts(archive, pyfile=True)
    _SHIPPED.add(key)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder under the shared checkpoint folder for a written intermediate table."""
    ship_package(spark)
    base = checkpoint_dir(spark).rstrip("/")
    path = f"{base}/quiver-{name}-{uuid.uuid4().hex[:12]}"
    _SCRATCH.append(path)
    return path


def scratch_mark() -> int:
    """Position in the scratch registry; pass it to :func:`release_scratch`."""
    return len(_SCRATCH)


def release_scratch(spark: SparkSession, mark: int = 0) -> int:
    """Delete the intermediate tables written since ``mark``; returns how many were removed.

    Call only when no DataFrame that reads them is used again (e.g. after the
    run's outputs are written).  Uses the Hadoop FileSystem of each path, so it
    works for any shared folder Spark can write.
    """
    sc = _context(spark)
    if sc is None:
        return 0
    jvm = sc._jvm
    conf = sc._jsc.hadoopConfiguration()
    removed = 0
    while len(_SCRATCH) > mark:
        p = jvm.org.apache.hadoop.fs.Path(_SCRATCH.pop())
        fs = p.getFileSystem(conf)
        if fs.exists(p):
            fs.delete(p, True)
            removed += 1
    return removed
