"""Session helpers: one place for the configs tests / bench use, and for the shared scratch folder."""

from __future__ import annotations

import os
import re
import tempfile
import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession

# Configs a caller-built session should carry.  A cluster session supplies its own
# values; nothing in the library mutates static confs of a session it was handed.
LOCAL_CONFS = {
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.python.sql.dataFrameDebugging.enabled": "false",   # per-call call-site capture: debugging aid only
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "strata") -> SparkSession:
    """Session for tests and the local bench (single JVM)."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", "16g")
    )
    if not os.environ.get("STRATA_WAREHOUSE_KEEP"):
        # local runs keep managed tables out of the working directory
        builder = builder.config("spark.sql.warehouse.dir", tempfile.mkdtemp(prefix="strata-wh-"))
    for k, v in LOCAL_CONFS.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    Only a single-JVM session (master ``local`` or ``local[...]``, as in tests), whose tasks share the driver's disk, gets a fresh
    local folder when the setting is absent.  Any other session must name one: a machine-local folder would scatter part files over
    the executors' own disks.  Works without a SparkContext handle too (e.g. a Spark Connect session).
    """
    d = spark.conf.get("spark.checkpoint.dir", None)
    sc = None
    try:
        sc = spark.sparkContext
    except Exception:  # noqa: BLE001 - no JVM context handle (Spark Connect)
        pass
    if not d and sc is not None:
        d = sc.getConf().get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not d:
        if sc is None or not re.fullmatch(r"local(\[.*\])?", sc.master):
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        d = tempfile.mkdtemp(prefix="strata-ckpt-")
        spark.conf.set("spark.checkpoint.dir", d)
    if sc is not None and sc.getCheckpointDir() is None:
        sc.setCheckpointDir(d)
    return d


def scratch_path(spark: SparkSession, *parts: str) -> str:
    """A fresh, unique path under the shared checkpoint folder (never a machine-local temp dir)."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return "/".join([base, "strata", *parts, uuid.uuid4().hex])


def cut_lineage(df):
    """Reliable checkpoint (written to the shared checkpoint folder), never localCheckpoint."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def observed(observation) -> dict:
    """The metrics of a finished run; none where the optimizer proved the observed rows empty and left them out of the plan."""
    try:
        return observation.get
    except Py4JJavaError:
        return {}

