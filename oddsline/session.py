"""Session settings every job relies on.

* ``spark.sql.session.timeZone=UTC`` -- epoch-ms arithmetic and ISO parsing
  must not depend on the host zone.
* ANSI mode stays on (Spark 4 default): bad casts raise instead of silently
  turning into nulls; the operators use ``try_*`` where null is wanted.
* AQE on, with skew-join splitting and partition coalescing.
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"

BASE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.parquet.filterPushdown": "true",
}


def build_session(master: str = "local[8]", shuffle_partitions: int = 8, app: str = "oddsline",
                  extra: dict[str, str] | None = None) -> SparkSession:
    """Session for tests, bench and local runs (the UI stays off)."""
    b = SparkSession.builder.master(master).appName(app)
    conf = dict(BASE_CONF)
    conf.update({
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        # No data locality to wait for (one host here, object stores on a
        # cluster): schedule tasks at once instead of waiting up to 3 s.
        "spark.locality.wait": "0",
        "spark.sql.shuffle.partitions": str(shuffle_partitions),
        "spark.driver.memory": "16g",
    })
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    apply_conf(spark)
    return spark


def apply_conf(spark: SparkSession) -> None:
    """Pin the runtime settings on an existing session (the driver's, say)."""
    for k, v in BASE_CONF.items():
        try:
            spark.conf.set(k, v)
        except Exception:  # some confs are static on a running session
            pass


def share_modules(spark: SparkSession) -> None:
    """Let the Python workers import this package from the driver's checkout.

    Workers take over the context's environment; a cluster whose machines
    have no copy at this place ships the package with ``--py-files``.
    """
    # Whole documents pass to Python: a thousand rows a batch, not ten thousand.
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "1000")
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    environment = spark.sparkContext.environment
    paths = [p for p in environment.get("PYTHONPATH", "").split(os.pathsep) if p]
    if root not in paths:
        environment["PYTHONPATH"] = os.pathsep.join([*paths, root])


def scale_conf(spark: SparkSession, input_bytes: int, target_partition_bytes: int = 256 << 20,
               max_partitions: int = 200_000) -> dict[str, str]:
    """Size shuffles and scans for an input of ``input_bytes`` and apply it.

    Shuffle partitions start at input / target (bounded), so the largest
    exchange of a job (raw rows before partial aggregation) still fits a task;
    AQE then coalesces the smaller exchanges (post-aggregation) towards the
    advisory size and splits skewed join partitions. Scan splits use the same
    target. Returns the settings applied.
    """
    n = max(200, min(max_partitions, -(-int(input_bytes) // target_partition_bytes)))
    conf = {
        "spark.sql.shuffle.partitions": str(n),
        "spark.sql.files.maxPartitionBytes": str(target_partition_bytes),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target_partition_bytes // 2),
        "spark.sql.adaptive.coalescePartitions.minPartitionSize": str(16 << 20),
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "4",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(target_partition_bytes),
    }
    for k, v in conf.items():
        spark.conf.set(k, v)
    return conf


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder the cluster names in ``spark.checkpoint.dir``.

    Only when the session has none and runs in local mode (tests, local
    runs) is a scratch folder created and registered; on a cluster the
    configured shared path is required.
    """
    sc = spark.sparkContext
    configured = spark.conf.get(CHECKPOINT_CONF, None) or sc.getConf().get(CHECKPOINT_CONF, None)
    if configured:
        if sc.getCheckpointDir() is None:
            sc.setCheckpointDir(configured)
        return configured
    current = sc.getCheckpointDir()
    if current:
        return current
    if not sc.master.startswith("local"):
        # Executors on other machines cannot share a folder of this one.
        raise ValueError("set spark.checkpoint.dir to a folder shared by the cluster "
                         "(checkpoints and streaming state are written there)")
    local = tempfile.mkdtemp(prefix="oddsline-ckpt-")
    sc.setCheckpointDir(local)
    spark.conf.set(CHECKPOINT_CONF, local)
    return local


def reliable_checkpoint(df, sort_cols: list | None = None):
    """Checkpoint ``df`` (sorted by ``sort_cols`` when given) to the shared
    checkpoint folder, computing its input once.

    A range sort first runs a sampling pass over its whole input, and
    writing a checkpoint runs the plan again; both would re-read the
    upstream scan. The input is therefore persisted (memory, spilling to
    disk) for the sampling and sorting passes, the sorted result is
    persisted for the checkpoint write, and both caches are dropped once
    the checkpoint exists.
    """
    from pyspark import StorageLevel

    checkpoint_dir(df.sparkSession)
    src = df.persist(StorageLevel.MEMORY_AND_DISK) if sort_cols else df
    out = (src.orderBy(*sort_cols) if sort_cols else src).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        return out.checkpoint(eager=True)
    finally:
        out.unpersist()
        if sort_cols:
            src.unpersist()

