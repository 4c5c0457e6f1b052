"""Session helpers: a tuned local/test session and the shared checkpoint folder."""

from __future__ import annotations

import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

# Settings a job relies on. On a cluster these come from spark-defaults; the
# builder below applies them only for local runs and tests.
JOB_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.python.filterPushdown.enabled": "true",
}

# Planner settings of the catalogue queries. The document projections alias
# many CASE expressions; constraint propagation then enumerates alias
# combinations and planning takes minutes. Filters are still pushed to the
# scans without it (PushDownPredicates does that).
PLAN_CONF = {
    "spark.sql.constraintPropagation.enabled": "false",
}


def planned(spark: SparkSession) -> SparkSession:
    """A sibling session (same application, same settings) with ``PLAN_CONF``; the caller's own session stays as it is."""
    own = getattr(spark, "_casebook_planned", None)
    if own is None:
        own = spark._casebook_planned = spark.newSession()
    for k, v in {**spark.conf.getAll, **PLAN_CONF}.items():
        if own.conf.get(k, None) != v and own.conf.isModifiable(k):
            own.conf.set(k, v)
    return own


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "casebook") -> SparkSession:
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", "8g")
    )
    for k, v in {**JOB_CONF, **PLAN_CONF}.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    On a cluster the setting must name a shared file system path. Only a local master, whose
    executors are this very process, gets a scratch folder where it is unset.
    """
    d = spark.conf.get("spark.checkpoint.dir", None) or getattr(spark, "_casebook_checkpoint_dir", None)
    if not d:
        master = spark.sparkContext.master
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        d = spark._casebook_checkpoint_dir = tempfile.mkdtemp(prefix="casebook-ckpt-")
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(d)
    return d


def ship_package(spark: SparkSession) -> None:
    """Send this package to the Python workers of the session's cluster, once per application.

    Tasks that run Python import it; on a cluster it need not be installed on the executors.
    """
    sc = spark.sparkContext
    if getattr(sc, "_casebook_shipped", False):
        return
    root = Path(__file__).resolve().parent
    archive = Path(tempfile.mkdtemp(prefix="casebook-ship-")) / "casebook.zip"
    with zipfile.ZipFile(archive, "w", zipfile.ZIP_DEFLATED) as z:
        for p in sorted(root.rglob("*.py")):
            z.write(p, p.relative_to(root.parent))
    sc.addPyFile(str(archive))
    sc._casebook_shipped = True


def scratch_path(spark: SparkSession, name: str) -> str:
    """A sub-path of the shared checkpoint folder for written intermediate tables."""
    return f"{checkpoint_dir(spark).rstrip('/')}/{name}"
