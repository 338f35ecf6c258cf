"""Session bootstrap and the shared scratch folder.

Intermediate tables (landed inputs, the written star) live under the folder
the cluster names in ``spark.checkpoint.dir``. Only when that is unset and
the master is local (tests, laptops) do we create one ourselves.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession


# Scratch folders made for local sessions, by application.
_LOCAL_ROOTS: dict[str, str] = {}


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                app_name: str = "tallystar") -> SparkSession:
    builder = (
        SparkSession.builder.appName(app_name)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
    )
    if master:
        builder = builder.master(master)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    return builder.getOrCreate()


def scratch_root(spark: SparkSession) -> str:
    """The shared folder for written intermediates.

    Read from the session (``spark.checkpoint.dir`` or the context's
    checkpoint dir). If unset on a local master, make one; on a cluster an
    unset value is an error, because a machine-local folder is not visible to
    executors.
    """
    sc = spark.sparkContext
    root = sc.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    if not sc.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a shared folder (e.g. on the object store)")
    # kept here: the caller's checkpoint dir stays as it is
    if sc.applicationId not in _LOCAL_ROOTS:
        _LOCAL_ROOTS[sc.applicationId] = tempfile.mkdtemp(prefix="tallystar-")
    return _LOCAL_ROOTS[sc.applicationId]


def fresh_path(spark: SparkSession, name: str) -> str:
    """A new, unused path under the scratch root."""
    return f"{scratch_root(spark)}/{name}-{uuid.uuid4().hex[:12]}"
