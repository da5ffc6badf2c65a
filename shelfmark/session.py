"""Session settings and the shared folder for intermediate tables."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_KEY = "spark.checkpoint.dir"

# Each task of a partitioned write makes a file per folder; more tasks than this
# would make more files than a driver can list in good time.
PARTITIONED_WRITERS = 20_000

_local_folders: dict[str, str] = {}


def build_session(app_name: str = "shelfmark", master: str | None = None, **conf: str) -> SparkSession:
    """A session with adaptive execution on and UTC timestamps; `conf` keys use `__` for dots."""
    builder = (
        SparkSession.builder.appName(app_name)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
    )
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can read, as named by the cluster in `spark.checkpoint.dir`.

    A folder of our own is made only in local mode, where driver and executors
    are one process; on a cluster a missing setting is an error.
    """
    configured = spark.conf.get(CHECKPOINT_KEY, None)
    if configured:
        return configured.rstrip("/")
    context = spark.sparkContext
    if not context.master.startswith("local") or context.master.startswith("local-cluster"):
        raise ValueError(f"{CHECKPOINT_KEY} must name a folder shared by all executors")
    if context.applicationId not in _local_folders:
        _local_folders[context.applicationId] = tempfile.mkdtemp(prefix="shelfmark-")
    return _local_folders[context.applicationId]


def scratch_path(spark: SparkSession, label: str) -> str:
    """A path under the shared folder that no other call has handed out."""
    return f"{shared_folder(spark)}/{label}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, label: str, partition_by: tuple[str, ...] = (), **options: str) -> DataFrame:
    """Write `df` once to the shared folder and read it back.

    Later jobs scan the table instead of recomputing the plan, a lost executor
    costs nothing, and `partition_by` columns prune whole directories. `options`
    are those of the writer.
    """
    spark = df.sparkSession
    path = scratch_path(spark, label)
    if partition_by:
        df.coalesce(PARTITIONED_WRITERS).write.options(**options).partitionBy(*partition_by).parquet(path)
    else:
        df.write.options(**options).parquet(path)
    return spark.read.schema(df.schema).parquet(path)
