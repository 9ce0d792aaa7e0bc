"""Session settings and the shared work folder."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

SESSION_DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
}

def build_session(app_name: str = "tidemark", conf: dict[str, str] | None = None) -> SparkSession:
    """A session pinned to UTC with adaptive execution left on.

    Stream state is kept in RocksDB, beside the heap, as window state grows
    with the number of entities. Shuffle partitions are not set here: on a
    cluster they follow the input size, and adaptive execution merges small ones.
    """
    builder = SparkSession.builder.appName(app_name)
    for key, value in {**SESSION_DEFAULTS, **(conf or {})}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach: ``spark.checkpoint.dir``.

    Only a local-mode session without that setting gets a folder beside its
    warehouse; on a cluster a missing setting is an error, because a
    machine-local folder would be lost with its executor.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    sc = spark.sparkContext
    if not sc.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    return f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/scratch-{sc.applicationId}"


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Let iterative jobs cut their lineage in the shared folder."""
    folder = shared_dir(spark)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(folder)


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path below the shared folder; nothing is created yet."""
    return f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex[:12]}"


def delete_path(spark: SparkSession, path: str) -> None:
    """Remove a scratch folder through the file system it lies in."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    target = jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(conf).delete(target, True)


def path_exists(spark: SparkSession, path: str) -> bool:
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    target = jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(conf).exists(target)


def scratch_database(spark: SparkSession, label: str) -> str:
    """Create a database whose managed tables live below the shared folder."""
    name = f"{label}_{uuid.uuid4().hex[:12]}"
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {name} LOCATION '{shared_dir(spark)}/{name}.db'")
    return name


def require_utc(spark: SparkSession) -> None:
    zone = spark.conf.get("spark.sql.session.timeZone")
    if zone not in ("UTC", "Etc/UTC", "GMT", "Z", "+00:00"):
        raise ValueError(
            f"session zone is {zone}; zone-less timestamps are read as UTC here, "
            "so set spark.sql.session.timeZone=UTC"
        )


def estimated_bytes(df: DataFrame) -> int | None:
    """Optimizer size estimate of a plan, or None when there is none."""
    plan = getattr(df, "_jdf", None)  # absent on clients without a local JVM
    if plan is None:
        return None
    return int(str(plan.queryExecution().optimizedPlan().stats().sizeInBytes()))
