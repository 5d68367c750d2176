"""Spark session helpers.

Everything in the library is lazy DataFrame code; this module only builds a
session with settings that suit it (AQE on, shuffle partitions sized for the
machine, UI off) and resolves the shared checkpoint folder.
"""

from __future__ import annotations

import os
from contextlib import contextmanager

from pyspark.sql import SparkSession

#: Spark then removes a write's shuffle files when it ends, instead of when the driver's garbage collector finds them.
FREE_SHUFFLES = {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true"}


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                app_name: str = "parcelkit") -> SparkSession:
    """Return (or create) a session configured for the appraisal workloads.

    On a cluster ``getOrCreate`` returns the session the launcher built and
    only the SQL settings below are applied; ``master`` is used for local runs.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    parts = shuffle_partitions or int(os.environ.get("PARCELKIT_SHUFFLE_PARTITIONS", "8"))
    builder = (
        builder
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", str(parts))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        .config("spark.driver.memory", os.environ.get("PARCELKIT_DRIVER_MEMORY", "8g"))
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


@contextmanager
def settings(spark: SparkSession, values: dict[str, str]):
    """Run a block with some SQL settings of the session, then put the former ones back."""
    before = {k: spark.conf.get(k, None) for k in values}
    try:
        for k, v in values.items():
            spark.conf.set(k, v)
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Make sure reliable checkpoints have a folder.

    Uses ``spark.checkpoint.dir`` when the session names one (a cluster must:
    it is the shared folder). Only a ``local`` master without one gets a fresh
    folder under the system temp dir, as in tests.
    """
    current = spark.conf.get("spark.checkpoint.dir", None)
    if current:
        return checkpoint_dir(spark)
    existing = _FALLBACK.get(spark.sparkContext.applicationId) or spark.sparkContext.getCheckpointDir()
    if existing:
        return existing
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a shared folder (e.g. on the cluster file system)")
    import tempfile
    return checkpoint_dir(spark, tempfile.mkdtemp(prefix="parcelkit-ckpt-"))


#: Folders installed where ``spark.checkpoint.dir`` was unset, by application.
_FALLBACK: dict[str, str] = {}


def checkpoint_dir(spark: SparkSession, fallback: str | None = None) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    A cluster names this folder (it must be on shared storage); it is read
    from the session. Only when it is unset (tests, local runs) is
    ``fallback`` installed, and ``fallback`` must then be given.
    """
    current = spark.conf.get("spark.checkpoint.dir", None)
    if current:
        if not spark.sparkContext.getCheckpointDir():
            spark.sparkContext.setCheckpointDir(current)
        return current
    if not fallback:
        raise RuntimeError("spark.checkpoint.dir is not set; pass a shared folder as fallback")
    # the setting itself cannot be changed while a session runs; the context keeps the folder
    spark.sparkContext.setCheckpointDir(fallback)
    _FALLBACK[spark.sparkContext.applicationId] = fallback
    return fallback


_SHIPPED: set = set()


def ship_package(spark: SparkSession) -> None:
    """Make ``parcelkit`` importable in Python workers (once per application).

    Operators that run Python in tasks (``mapInPandas``) pickle functions by
    reference to this package. On a cluster, install the package or pass it
    with ``--py-files``; otherwise this zips the package's sources and adds
    them with ``addPyFile`` (code distribution only, no data).
    """
    sc = spark.sparkContext
    if sc.applicationId in _SHIPPED:
        return
    import tempfile
    import zipfile
    pkg = os.path.dirname(os.path.abspath(__file__))
    target = os.path.join(tempfile.mkdtemp(prefix="parcelkit-py-"), "parcelkit.zip")
    with zipfile.ZipFile(target, "w") as z:
        for root, _dirs, files in os.walk(pkg):
            for f in files:
                if f.endswith(".py"):
                    full = os.path.join(root, f)
                    z.write(full, os.path.relpath(full, os.path.dirname(pkg)))
    sc.addPyFile(target)
    _SHIPPED.add(sc.applicationId)


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether ``path`` (its last name may be a pattern) exists on its (possibly distributed) file system."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    found = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).globStatus(p)
    return found is not None and len(found) > 0


def qualified(spark: SparkSession, path: str) -> str:
    """``path`` with the scheme of its file system, so that Python tasks open the same folder as Spark does."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).makeQualified(p).toString()
