"""Session and lineage helpers.

``get_spark`` is for tests, the bench and local runs only; library functions
never create sessions, they take the caller's DataFrames.

``materialize`` cuts lineage with a *reliable* checkpoint into the folder the
cluster names in ``spark.checkpoint.dir``.  Only when that is unset *and* the
master is local (tests) do we pick a scratch folder ourselves; on a cluster
an unset checkpoint dir is an error rather than a silent machine-local path.
"""

from __future__ import annotations

import os
import tempfile

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession


def get_spark(cpus: str | int = "*", app: str = "quarry", **conf) -> SparkSession:
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        # Fused stages above HotSpot's 8000-byte JIT limit would run
        # interpreted; let Spark fall back to per-operator code instead.
        .config("spark.sql.codegen.hugeMethodLimit", "8000")
        # remove checkpoint files once their frames are unreachable
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
    )
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def _context(spark: SparkSession):
    """The SparkContext, or None on a Spark Connect session."""
    try:
        return spark.sparkContext
    except Exception:  # noqa: BLE001 - Connect sessions have no context
        return None


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder; set a scratch one only for local masters."""
    sc = _context(spark)
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if sc is None:
        if not configured:
            raise RuntimeError("spark.checkpoint.dir is not set on this session")
        return configured
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = configured or sc.getConf().get("spark.checkpoint.dir", None)
    if configured:
        sc.setCheckpointDir(configured)
        return sc.getCheckpointDir()
    if not sc.master.startswith("local"):
        raise RuntimeError(
            "spark.checkpoint.dir is not set; iterative operators need a shared "
            "checkpoint folder on a cluster"
        )
    scratch = tempfile.mkdtemp(prefix="quarry-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
    sc.setCheckpointDir(scratch)
    return sc.getCheckpointDir()


def materialize(df: DataFrame, how: str = "checkpoint", balance: bool = True, cache: bool = True) -> DataFrame:
    """Materialise ``df`` once for repeated reads by an iterative operator.

    ``checkpoint`` (default) writes to the reliable checkpoint folder: the
    frame survives executor loss without recomputing upstream shuffles and
    its plan is a leaf, so loops never stack plans.  With ``cache`` the
    checkpointed frame is also kept in executor memory/disk, so iterations
    read memory instead of the shared store; a lost block is rebuilt from
    the checkpoint files, not from the original lineage.  ``persist`` skips
    the checkpoint (lost blocks are recomputed from lineage).

    With ``balance``, a result that landed in fewer partitions than half the
    cluster's parallelism (one large file, a coalesced shuffle) is spread
    round-robin and stored again, so every later pass uses all executors.
    The count is read from the stored result, so nothing runs twice.
    """
    sc = _context(df.sparkSession)
    if sc is None:  # Connect: the server owns partitioning and the folder
        return df.checkpoint(eager=True) if how == "checkpoint" else df.persist(StorageLevel.MEMORY_AND_DISK)
    target = sc.defaultParallelism
    if how == "persist":
        out = df.persist(StorageLevel.MEMORY_AND_DISK)
        out.count()
        if balance and out.rdd.getNumPartitions() < max(1, target // 2):
            spread = out.repartition(target).persist(StorageLevel.MEMORY_AND_DISK)
            spread.count()
            out.unpersist()
            out = spread
        return out
    checkpoint_dir(df.sparkSession)
    out = df.checkpoint(eager=True)
    if balance and out.rdd.getNumPartitions() < max(1, target // 2):
        out = out.repartition(target).checkpoint(eager=True)
    if cache:
        out = out.persist(StorageLevel.MEMORY_AND_DISK)
    return out


def release(df: DataFrame) -> None:
    """Drop the executor-side copy of a materialised frame (the checkpoint
    files stay valid, so later reads still work)."""
    df.unpersist(blocking=False)
