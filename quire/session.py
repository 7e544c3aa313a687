"""Session helpers shared by tests, bench and the entry module."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings that matter at scale.  AQE re-plans joins from runtime sizes (so a
# side is broadcast only when its measured size is under the threshold),
# coalesces small shuffle partitions and splits skewed ones.
SCALE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # split a partition held by a hot key even when that adds a shuffle
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.autoBroadcastJoinThreshold": str(32 * 1024 * 1024),
    "spark.sql.files.maxPartitionBytes": str(128 * 1024 * 1024),
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.parquet.filterPushdown": "true",
}


def build_session(master: str | None = None, app: str = "quire",
                  shuffle_partitions: int | None = None) -> SparkSession:
    """Local/test session.  On a cluster the launcher supplies master and
    resources; only the SQL settings above are added."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    builder = builder.config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false")
    for k, v in SCALE_CONF.items():
        builder = builder.config(k, v)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the checkpoint folder, setting a local one only when the
    session has none and runs in local mode (tests).  On a cluster the
    launcher names a shared folder in ``spark.checkpoint.dir`` and that one
    is used as is; without it the job stops rather than write to a
    machine-local folder."""
    try:
        sc = spark.sparkContext
    except Exception:          # Spark Connect: the server's configuration applies
        conf_dir = spark.conf.get("spark.checkpoint.dir", None)
        if not conf_dir:
            raise RuntimeError("spark.checkpoint.dir is not set on the Spark Connect server")
        return conf_dir
    current = sc.getCheckpointDir()
    if current:
        return current
    conf_dir = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get(
        "spark.checkpoint.dir", None)
    if not conf_dir:
        if not (sc.master or "").startswith("local"):
            raise RuntimeError("spark.checkpoint.dir is not set: name a folder on shared storage "
                               "(a machine-local folder is lost with its executor)")
        conf_dir = tempfile.mkdtemp(prefix="quire-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
    sc.setCheckpointDir(conf_dir)
    return sc.getCheckpointDir() or conf_dir


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A fresh folder for file round trips (exports, layouts), placed next to
    the checkpoint folder so that on a cluster it is on shared storage."""
    base = ensure_checkpoint_dir(spark)
    # checkpoint dirs get a random sub-folder per context; keep files beside it
    root = base.rstrip("/")
    return f"{root}/files/{name}-{uuid.uuid4().hex[:12]}"
