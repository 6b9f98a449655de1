"""Session construction and shared scratch space.

Every job in the package takes a ``SparkSession`` from the caller; this
module only builds one for scripts, tests and the bench, and resolves the
shared folder that intermediate tables, models and stream checkpoints go to.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings the package relies on.  ANSI mode stays on (Spark 4 default):
# number parsing goes through try_cast, divisions through try_divide.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def build_session(
    master: str | None = None,
    app_name: str = "raresift",
    shuffle_partitions: int | None = None,
    driver_memory: str | None = None,
    extra_conf: dict[str, str] | None = None,
) -> SparkSession:
    """Create (or reuse) a session with the package defaults.

    ``master`` is left to the launcher when ``None`` (spark-submit on a
    cluster); scripts and tests pass ``local[N]``.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in DEFAULT_CONF.items():
        builder = builder.config(key, value)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    if driver_memory:
        builder = builder.config("spark.driver.memory", driver_memory)
    for key, value in (extra_conf or {}).items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def _is_local(spark: SparkSession) -> bool:
    try:
        master = spark.sparkContext.master
    except Exception:  # Spark Connect: no context on the client side
        master = spark.conf.get("spark.master", "") or ""
    return master.startswith("local")


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    On a cluster the folder must be configured (a shared file system or
    object store); a machine-local folder would lose data with the executor
    that wrote it.  Only a local-mode session without the setting gets a
    private temporary folder.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not _is_local(spark):
            raise RuntimeError(
                "spark.checkpoint.dir is not set; point it at a shared folder "
                "(HDFS, object store) before running raresift jobs on a cluster"
            )
        base = tempfile.mkdtemp(prefix="raresift-ckpt-")
        spark.conf.set("spark.checkpoint.dir", base)
    try:
        if spark.sparkContext.getCheckpointDir() is None:
            spark.sparkContext.setCheckpointDir(base)
    except Exception:  # Spark Connect: the server owns the context
        pass
    return base.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique folder under the shared checkpoint folder."""
    base = ensure_checkpoint_dir(spark)
    return f"{base}/raresift/{name}-{uuid.uuid4().hex[:12]}"
