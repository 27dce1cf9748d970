"""Session construction and cluster-safe scratch locations."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Settings every playlake plan relies on: UTC dates (DAT-2), AQE for runtime
# re-planning (coalescing, skew splits, broadcast conversion by measured size).
_DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    # Capturing the Python call site of every Column operation (DataFrame
    # debugging) makes plan construction about 3x slower; errors still carry
    # the JVM-side query context without it.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(
    master: str | None = None,
    app_name: str = "playlake",
    shuffle_partitions: int | None = None,
    conf: dict[str, str] | None = None,
) -> SparkSession:
    """Return a session configured for playlake plans.

    On a cluster, ``master`` stays ``None`` and the launcher decides. Local
    runs (tests, bench) pass ``local[N]``.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    settings = dict(_DEFAULTS)
    if shuffle_partitions:
        settings["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    settings.update(conf or {})
    for key, value in settings.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder, setting a local one only if unset.

    A cluster names its shared, fault-tolerant folder in
    ``spark.checkpoint.dir``; that setting always wins. Only when it is absent
    (tests, local runs) do we fall back to a fresh scratch folder.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    try:
        sc = spark.sparkContext
    except Exception:  # noqa: BLE001 - remote client: the server side owns checkpointing
        return (configured or "").rstrip("/")
    if not configured:
        configured = sc.getCheckpointDir()
    if not configured:
        if not sc.master.startswith("local"):
            raise RuntimeError(
                "spark.checkpoint.dir is not set: name a shared, fault-tolerant folder "
                "(a machine-local temporary folder does not survive executor loss)"
            )
        configured = tempfile.mkdtemp(prefix="playlake-ckpt-")
        spark.conf.set("spark.checkpoint.dir", configured)
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(configured)
    return configured.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A path for an intermediate table under the shared checkpoint folder."""
    base = ensure_checkpoint_dir(spark)
    if "://" not in base and not os.path.isabs(base):
        base = os.path.abspath(base)
    return f"{base}/{name}"
