"""Session settings and the shared scratch location.

Everything the engine persists between stages (lineage cuts, export trials) goes under the folder
the cluster names in ``spark.checkpoint.dir``.  A private folder is created only for a local
master without that setting (tests, benches); on a cluster the setting is required.
"""

from __future__ import annotations

import os
import re
import tempfile
import uuid
import zipfile

from pyspark.sql import SparkSession

# Settings every daybook job relies on; they are SQL confs, so they can also be applied to an
# existing session with ``apply_conf``.
SQL_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.optimizer.runtime.bloomFilter.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # Fixed value: Arrow batch size of the reference's Python models.
    "spark.sql.execution.arrow.maxRecordsPerBatch": "100000",
    # Parquet TIMESTAMP(NANOS) (written by pandas-backed exporters) is otherwise rejected.
    "spark.sql.legacy.parquet.nanosAsLong": "true",
}


def build_session(master: str | None = None, shuffle_partitions: int | None = None, app: str = "daybook",
                  driver_memory: str | None = None, extra: dict | None = None) -> SparkSession:
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    conf = dict(SQL_CONF)
    conf["spark.ui.enabled"] = "false"
    # Checkpoints of the day-replacement frames are removed once nothing references them.
    conf["spark.cleaner.referenceTracking.cleanCheckpoints"] = "true"
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    if driver_memory:
        conf["spark.driver.memory"] = driver_memory
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    apply_conf(spark)
    return spark


# Results depend on these: a session that refuses them must not run.
REQUIRED_CONF = ("spark.sql.session.timeZone", "spark.sql.legacy.parquet.nanosAsLong")


def apply_conf(spark: SparkSession) -> None:
    for k, v in SQL_CONF.items():
        try:
            spark.conf.set(k, v)
        except Exception as e:  # a tuning setting that this deployment fixes: keep its value
            if k in REQUIRED_CONF and spark.conf.get(k, None) != v:
                raise RuntimeError(f"the session must have {k}={v}") from e
    ship_package(spark)


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Make ``daybook`` importable in the Python workers (the Arrow functions are pickled by
    reference to their module), as ``--py-files`` would: zip the package once per application
    and hand it to ``SparkContext.addPyFile``, which distributes it to every executor."""
    sc = spark.sparkContext
    app = sc.applicationId
    if app in _SHIPPED:
        return
    pkg_dir = os.path.dirname(os.path.abspath(__file__))
    out_dir = tempfile.mkdtemp(prefix="daybook-pyfiles-")
    archive = os.path.join(out_dir, "daybook.zip")
    with zipfile.ZipFile(archive, "w", zipfile.ZIP_DEFLATED) as zf:
        for folder, _, files in os.walk(pkg_dir):
            for f in files:
                if f.endswith(".py"):
                    full = os.path.join(folder, f)
                    zf.write(full, os.path.join("daybook", os.path.relpath(full, pkg_dir)))
    sc.addPyFile(archive)
    _SHIPPED.add(app)


def checkpoint_root(spark: SparkSession) -> str:
    """The shared checkpoint folder.  A private one is made only for a local master that has none; on
    a cluster its executors could not see it, so there the setting is required."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = sc.getConf().get("spark.checkpoint.dir", None)
    if not configured:
        if not re.match(r"local(\[[^,]*\])?$", sc.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        configured = tempfile.mkdtemp(prefix="daybook-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique sub-folder of the shared checkpoint folder for a written intermediate."""
    root = checkpoint_root(spark).rstrip("/")
    return f"{root}/daybook-{name}-{uuid.uuid4().hex[:12]}"
