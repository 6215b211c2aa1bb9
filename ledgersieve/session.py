"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings the jobs rely on, whatever the cluster size. AQE sizes the reduce side at run time (it merges
# small partitions and splits skewed ones), so only the starting number of shuffle partitions is ours.
JOB_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
}

TASK_BYTES = 128 * 1024 * 1024
TRACKED_TASKS = 30_000


def size_settings(input_bytes: int) -> dict[str, str]:
    """Settings that follow the input size: how much one scan task and one reduce task handle.

    Tasks take about 128 MB until there are 30,000 of them; then they grow instead, as the driver keeps one entry
    per map task and reduce partition. 100 TB gives 3.3 GB tasks: their sorts spill, but the job stays plannable.
    The advisory size stays at 128 MB, so AQE splits skewed partitions and written files alike at every size.
    """
    task_bytes = max(TASK_BYTES, -(-input_bytes // TRACKED_TASKS))
    return {
        "spark.sql.files.maxPartitionBytes": str(task_bytes),
        "spark.sql.shuffle.partitions": str(max(8, -(-input_bytes // task_bytes))),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(TASK_BYTES),
    }


def build_session(
    app_name: str = "ledgersieve",
    master: str | None = None,
    shuffle_partitions: int | None = None,
    **extra: str,
) -> SparkSession:
    """Get a session. On a cluster leave ``master`` unset, so that spark-submit decides."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for key, value in {**JOB_SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def scratch_dir(spark: SparkSession, label: str) -> str:
    """A new folder name under the shared folder the cluster names in ``spark.checkpoint.dir``.

    Only a local session, where driver and executors share one disk, may do without that setting.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that every executor can reach")
        shared = tempfile.gettempdir()
    return f"{shared.rstrip('/')}/ledgersieve/{label}-{uuid.uuid4().hex}"
