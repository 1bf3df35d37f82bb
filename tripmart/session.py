"""Session construction and the shared work folder.

Everything that must survive an executor loss (checkpoints, intermediate
tables, streaming checkpoints, sink targets of the gate queries) lives under
the folder the cluster names in ``spark.checkpoint.dir``.  We only choose a
folder ourselves when the session has none (local runs and tests).
"""

from __future__ import annotations

import os
import re
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings a job of this package expects; runtime SQL confs only, so they can be
# applied to a session someone else built.
SQL_DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
}


def build_session(master: str = "local[*]", shuffle_partitions: int | None = None,
                  app_name: str = "tripmart", extra: dict | None = None) -> SparkSession:
    """A session with the settings this package expects.  The number of shuffle
    partitions is left to the cluster, or to ``apply_scale_conf``, unless given."""
    builder = (
        SparkSession.builder.master(master)
        .appName(app_name)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    if shuffle_partitions is not None:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in SQL_DEFAULTS.items():
        builder = builder.config(k, v)
    for k, v in (extra or {}).items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    work_root(spark)
    return spark


def work_root(spark: SparkSession) -> str:
    """The shared folder for durable intermediate data.

    Reads ``spark.checkpoint.dir`` from the session (or the context's current
    checkpoint dir).  Where none is configured, a session in one machine's
    process (``local[...]``) gets a fresh local one; on a cluster that is an
    error, as no executor would see the driver's folder.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        configured = spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    current = spark.sparkContext.getCheckpointDir()
    if configured:
        if not current:
            spark.sparkContext.setCheckpointDir(configured)
        return configured.rstrip("/")
    if current:
        # getCheckpointDir() appends a per-application uuid folder; its parent
        # is the folder somebody chose.
        return os.path.dirname(current.rstrip("/"))
    if not is_one_machine(spark):
        raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    local = tempfile.mkdtemp(prefix="tripmart-ckpt-")
    spark.conf.set("spark.checkpoint.dir", local)
    spark.sparkContext.setCheckpointDir(local)
    return local


def is_one_machine(spark: SparkSession) -> bool:
    """Whether driver and executors are one process (local-cluster ones are not)."""
    return re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master) is not None


def scratch_dir(spark: SparkSession, label: str) -> str:
    """A new, never reused folder under the shared work root."""
    return f"{work_root(spark)}/tripmart-{label}-{uuid.uuid4().hex[:12]}"


def scratch_database(spark: SparkSession, label: str) -> str:
    """A new database whose managed tables live under the shared work root."""
    name = f"tm_{label}_{uuid.uuid4().hex[:12]}"
    spark.sql(f"CREATE DATABASE {name} LOCATION '{scratch_dir(spark, label)}'")
    return name


# Settings for large inputs.  Input splits and post-shuffle partitions of
# ~256 MB keep a task's working set well inside executor memory; AQE then
# coalesces small partitions and splits skewed ones (a join partition over
# 5x the median and 512 MB is split, its other side replicated).
SCALE_DEFAULTS = {
    "spark.sql.files.maxPartitionBytes": str(256 * 1024 * 1024),
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(256 * 1024 * 1024),
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "5",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(512 * 1024 * 1024),
    "spark.sql.autoBroadcastJoinThreshold": str(64 * 1024 * 1024),
}

#: More reducers than this cost the driver more (a block status for each of
#: map tasks x reducers) than smaller partitions gain: beyond 256 MB x this
#: (8 TB shuffled at once) partitions grow and spill to disk instead.
MOST_SHUFFLE_PARTITIONS = 32_768


def shuffle_partitions_for(input_bytes: int, target_bytes: int = 256 * 1024 * 1024,
                           minimum: int = 200, most: int = MOST_SHUFFLE_PARTITIONS) -> int:
    """Initial shuffle partition count so that each post-shuffle partition
    holds about ``target_bytes``, within bounds (AQE coalesces downward at run time)."""
    return min(most, max(minimum, -(-int(input_bytes) // target_bytes)))


def apply_scale_conf(spark: SparkSession, input_bytes: int) -> dict[str, str]:
    """Apply the large-input settings that neither the cluster's configuration
    nor the session sets (explicit settings win: a value other than Spark's
    default is one).  Returns what was applied."""
    applied = {}
    cluster = spark.sparkContext.getConf()
    defaults = spark.newSession().conf
    wanted = dict(SQL_DEFAULTS, **SCALE_DEFAULTS)
    wanted["spark.sql.shuffle.partitions"] = str(shuffle_partitions_for(input_bytes))
    for k, v in wanted.items():
        # A value that an earlier call set may be set anew.
        if not cluster.contains(k) and spark.conf.get(k, None) in (defaults.get(k, None), spark.conf.get(f"tripmart.scale.{k}", None)):
            spark.conf.set(k, v)
            spark.conf.set(f"tripmart.scale.{k}", v)
            applied[k] = v
    return applied
