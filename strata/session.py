"""Session contract (L2).

* the session time zone is UTC, so run timestamps and report times are unambiguous;
* AQE is on, so shuffle partition counts coalesce at run time and skewed partitions are split;
* an existing session is reused and never stopped here (the caller owns it);
* scratch tables live under the cluster's shared ``spark.checkpoint.dir``; a fresh local folder is chosen only when
  that is unset and the master is local, elsewhere an unset folder is an error.
"""

from __future__ import annotations

import os
import re
import tempfile
import uuid
import zipfile

from pyspark.sql import SparkSession

DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # size shuffle partitions by bytes (advisory size), not by default parallelism: small aggregates use few
    # tasks, large shuffles still split into ~advisory-size partitions
    "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.ui.enabled": "false",
    # remove reliable-checkpoint files from the shared folder once the checkpointed data is unreferenced
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


# Starting points for a large cluster (overridable through ``conf``): many initial shuffle partitions that AQE
# coalesces to ~256 MB, and 512 MB scan splits. A narrow layer writes one file per split, so a 512 MB CSV split
# becomes a ~100-200 MB Parquet file (100 TB of CSV -> ~200k tasks and files instead of ~800k at 128 MB).
CLUSTER_CONF = {
    "spark.sql.shuffle.partitions": "4000",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256m",
    "spark.sql.files.maxPartitionBytes": "512m",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "5",
}

# Delta Lake session settings (effective only when the Delta package is on the classpath).
DELTA_CONF = {
    "spark.sql.extensions": "io.delta.sql.DeltaSparkSessionExtension",
    "spark.sql.catalog.spark_catalog": "org.apache.spark.sql.delta.catalog.DeltaCatalog",
}


def get_session(app_name: str = "strata", master: str | None = None, conf: dict | None = None,
                profile: str = "local", delta: bool = False) -> SparkSession:
    """Return the active session (or build one) with the session contract applied.

    ``profile="cluster"`` adds :data:`CLUSTER_CONF`; ``delta=True`` adds the Delta extension and catalog.
    """
    extra = {**(CLUSTER_CONF if profile == "cluster" else {}), **(DELTA_CONF if delta else {})}
    conf = {**extra, **(conf or {})}
    active = SparkSession.getActiveSession()
    if active is not None:
        apply_session_contract(active, conf)
        return active
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**DEFAULT_CONF, **conf}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    apply_session_contract(spark, conf)
    return spark


def apply_session_contract(spark: SparkSession, conf: dict | None = None) -> None:
    """Pin the runtime SQL settings the layers rely on (UTC, AQE) on an existing session."""
    for key, value in {**DEFAULT_CONF, **(conf or {})}.items():
        if key.startswith("spark.sql.") and spark.conf.isModifiable(key):
            spark.conf.set(key, value)


def checkpoint_root(spark: SparkSession) -> str:
    """The shared checkpoint folder of the cluster; a local one only when none is configured and the master is local.

    Under Spark Connect (no SparkContext on the client) the folder must come from ``spark.checkpoint.dir``.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    try:
        sc = spark.sparkContext
    except Exception:  # Spark Connect: the server owns the context and its checkpoint folder
        if not configured:
            raise RuntimeError("set spark.checkpoint.dir to a shared folder for reliable checkpoints")
        return configured
    current = sc.getCheckpointDir()
    if current:
        return current
    if not configured:
        if not re.match(r"local(\[|$)", sc.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        configured = tempfile.mkdtemp(prefix="strata-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def scratch_dir(spark: SparkSession, name: str = "run") -> str:
    """A fresh, unique folder under the shared checkpoint root for intermediate written tables."""
    root = checkpoint_root(spark).rstrip("/")
    return f"{root}/strata-{name}-{uuid.uuid4().hex[:12]}"


_SHIPPED: set[str] = set()


def ship_code(spark: SparkSession) -> None:
    """Send this package to the Python workers of the session once, as ``--py-files`` would."""
    if spark.sparkContext.applicationId in _SHIPPED:
        return
    root = os.path.dirname(os.path.abspath(__file__))
    folder = tempfile.mkdtemp(prefix="strata-code-")  # of the driver alone; Spark serves the archive to the executors
    archive = os.path.join(folder, "strata.zip")
    with zipfile.ZipFile(archive, "w", zipfile.ZIP_DEFLATED) as out:
        for folder, _, names in os.walk(root):
            for name in sorted(names):
                if name.endswith(".py"):
                    path = os.path.join(folder, name)
                    out.write(path, os.path.join(os.path.basename(root), os.path.relpath(path, root)))
    spark.sparkContext.addPyFile(archive)
    _SHIPPED.add(spark.sparkContext.applicationId)
