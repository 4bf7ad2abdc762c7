"""Session helpers: a local session for tests and the shared scratch folder.

The shared folder is whatever ``spark.checkpoint.dir`` names; a private one
under the local temp directory is created only for a local master without
that setting (tests).
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

_CHECKPOINT_KEY = "spark.checkpoint.dir"
_SCRATCH: list[str] = []


def local_session(app: str = "tidemark", cores: int | str = "*", shuffle_partitions: int = 8) -> SparkSession:
    """A local session configured like the tests expect (UI off, AQE on)."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.driver.memory", "8g")
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    checkpoint_dir(spark)
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder for checkpoints and written intermediate tables.

    Taken from the session (``spark.checkpoint.dir`` or an earlier
    ``setCheckpointDir``).  Where neither is set, a local session gets a fresh
    private folder; on a cluster that would be another disk on every machine,
    so there it is an error.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current.rstrip("/")
    configured = sc.getConf().get(_CHECKPOINT_KEY, None)
    if configured:
        sc.setCheckpointDir(configured)
    elif sc.master.startswith("local[") or sc.master == "local":
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="tidemark-ckpt-"))
    else:
        raise ValueError(f"set {_CHECKPOINT_KEY} to a folder that the driver and all executors share")
    return sc.getCheckpointDir().rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique sub-path of the shared folder for one job's outputs."""
    path = f"{checkpoint_dir(spark)}/{name}-{uuid.uuid4().hex[:12]}"
    _SCRATCH.append(path)
    return path


def release_scratch(spark: SparkSession) -> int:
    """Remove what this process has written to its scratch paths; frames that read them can't be used after.

    Returns how many paths were removed.  Call it when the results are stored elsewhere.
    """
    paths, _SCRATCH[:] = _SCRATCH[:], []
    return sum(remove_path(spark, p) for p in paths)


def remove_path(spark: SparkSession, path: str) -> bool:
    """Remove a file or folder, wherever the session's file systems reach; is anything gone?"""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return bool(target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True))
