"""Session construction and the shared scratch location.

Intermediate tables and checkpoints go under the folder the cluster names in
``spark.checkpoint.dir``. Only a session whose master is this one machine and
that has none (tests) gets one made; on a cluster a missing folder is an error,
since executors would write to their own disks.
"""

from __future__ import annotations

import os
import re
import tempfile
import uuid

from pyspark.sql import SparkSession

# Defaults for any deployment; a value set by the submitter always wins.
_DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Fact tables are never broadcast implicitly: dimensions are broadcast
    # by the optimiser's size in bytes (operators.broadcast) or by AQE from
    # measured bytes; entity joins are shuffled, as hash joins when Spark's
    # estimate says the build side fits per partition (or AQE measures it so),
    # else sort-merge.
    "spark.sql.autoBroadcastJoinThreshold": "1m",
    "spark.sql.join.preferSortMergeJoin": "false",
    "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold": "64m",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # partition values such as '01' or '007' must stay strings (H20)
    "spark.sql.sources.partitionColumnTypeInference.enabled": "false",
}

# No web UI server and no console progress bars.
_UI_OFF = {
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}

# Sizing for a single machine only (never applied to a cluster master).
_LOCAL_ONLY = {
    "spark.sql.shuffle.partitions": "8",
}


def get_session(master: str | None = None, app: str = "areatab", **conf: str) -> SparkSession:
    """Return the active session, or build one.

    ``conf`` given here always applies. Library defaults (all runtime SQL
    settings) are set after start-up, and only for keys the submitter
    (``spark-submit --conf``, ``spark-defaults.conf``) left unset; the
    single-machine sizing only when the master is local.
    """
    active = SparkSession.getActiveSession()
    if active is not None:
        return active
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for k, v in {**_UI_OFF, **conf}.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    submitted = spark.sparkContext.getConf()
    defaults = dict(_DEFAULTS)
    if spark.sparkContext.master.startswith("local"):
        defaults.update(_LOCAL_ONLY)
    for k, v in defaults.items():
        if k not in conf and not submitted.contains(k):
            spark.conf.set(k, v)
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder; create a local one only if unset."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if not configured:
        if not re.fullmatch(r"local(\[[^\]]*\])?", sc.master):
            raise RuntimeError(f"set spark.checkpoint.dir to a folder that all executors share (master {sc.master})")
        configured = tempfile.mkdtemp(prefix="areatab-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique path under the shared checkpoint folder."""
    base = ensure_checkpoint_dir(spark)
    return os.path.join(base, "areatab", f"{name}-{uuid.uuid4().hex[:12]}")
