"""Session set-up: UTC, adaptive execution and a checkpoint directory."""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession

# What the results rely on (UTC, and errors rather than wrapped numbers) and what lets Spark re-plan
# at run time.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Staged intermediates are deleted once nothing refers to them.
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}

# Input per shuffle partition when sizing a large job. Aggregation on the map side leaves a fraction
# of it to shuffle, and adaptive execution merges partitions that turn out small.
INPUT_PER_SHUFFLE_PARTITION = 4 * 1024**3


def settings_for(input_bytes: int) -> dict[str, str]:
    """Split and shuffle sizes for a job that reads about ``input_bytes``.

    At 100 TB this gives some 200,000 scan tasks and 25,000 shuffle partitions; small jobs keep
    Spark's usual 200.
    """
    partitions = max(200, input_bytes // INPUT_PER_SHUFFLE_PARTITION)
    return {
        "spark.sql.files.maxPartitionBytes": "512m",
        "spark.sql.shuffle.partitions": str(partitions),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    }


def build_session(app_name: str, master: str | None = None, **settings: str) -> SparkSession:
    """A session with :data:`SETTINGS`; on a cluster leave ``master`` to spark-submit."""
    builder = SparkSession.builder.appName(app_name)
    if master is not None:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **settings}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder for intermediate results that the session uses.

    It is the context's own, below the folder in ``spark.checkpoint.dir`` unless the caller set another.
    Only a local session may go without the setting: it gets a temporary folder. On a cluster that
    folder would be private to one machine, so the setting is required there.
    """
    context = spark.sparkContext
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if context.getCheckpointDir() is None:
        if configured is None:
            if not context.master.startswith("local"):
                raise ValueError("set spark.checkpoint.dir to a folder all executors share")
            configured = tempfile.mkdtemp(prefix="checkpoint-")
        context.setCheckpointDir(configured)
    return context.getCheckpointDir()
