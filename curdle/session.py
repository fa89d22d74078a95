"""SparkSession construction and the few session-level settings the pipeline relies on."""

from __future__ import annotations

import os
import tempfile

from pyspark.errors import PySparkException
from pyspark.sql import SparkSession

# Settings every run needs for the results to be right and comparable.
REQUIRED_CONF = {
    # Dates and timestamps are interpreted in UTC everywhere.
    "spark.sql.session.timeZone": "UTC",
    # ANSI casts raise on bad text, like the reference's server does.
    "spark.sql.ansi.enabled": "true",
}

# Settings for throughput; a cluster deployment may override any of them.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.localShuffleReader.enabled": "true",
    # Broadcasts are only chosen from measured (runtime) sizes below this bound.
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "64MB",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    # Building a plan from Python costs one JVM round trip per Column call;
    # call-site capture for error messages adds several more to each.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
    # A query's shuffle files go when it ends, not when the driver next collects garbage: what is
    # read again is staged, so no later query has a use for them.
    "spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true",
}


def build_session(
    master: str | None = None,
    app_name: str = "curdle",
    shuffle_partitions: int | None = None,
    extra_conf: dict[str, str] | None = None,
) -> SparkSession:
    """Create (or reuse) a session with the pipeline's settings applied."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra_conf or {})
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    apply_required_conf(spark)
    return spark


def apply_required_conf(spark: SparkSession) -> None:
    for key, value in REQUIRED_CONF.items():
        spark.conf.set(key, value)


_LOCAL_FALLBACK: dict[str, str] = {}


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder named by ``spark.checkpoint.dir``.

    A cluster names a shared (distributed) folder there and it is used as is.
    Only a local master (one JVM) may go without: it gets a private scratch folder,
    created once per application and registered as the context's checkpoint
    directory. On a cluster executors do not share local folders, so a missing
    setting is an error there.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured
    try:
        sc = spark.sparkContext
        current = sc.getCheckpointDir()
        if current:
            return current
        app, master = sc.applicationId, sc.master
    except PySparkException:  # remote sessions have no SparkContext
        sc, app, master = None, "remote", "remote"
    if master.split("[")[0] != "local":
        raise RuntimeError(f"set spark.checkpoint.dir to a folder that all executors share (master is {master})")
    if app not in _LOCAL_FALLBACK:
        _LOCAL_FALLBACK[app] = tempfile.mkdtemp(prefix="curdle-ckpt-")
        if sc is not None:
            sc.setCheckpointDir(_LOCAL_FALLBACK[app])
    return _LOCAL_FALLBACK[app]


def scratch_path(spark: SparkSession, name: str) -> str:
    """A path for an intermediate table under the shared checkpoint folder."""
    return os.path.join(checkpoint_dir(spark), name)


def apply_runtime_tuning(spark: SparkSession) -> None:
    """Best-effort throughput settings on a session this package did not build."""
    for key in ("spark.python.sql.dataFrameDebugging.enabled", "spark.sql.classic.shuffleDependency.fileCleanup.enabled"):
        try:
            spark.conf.set(key, DEFAULT_CONF[key])
        except Exception:  # noqa: BLE001 — static in some deployments; only a speed setting
            pass
