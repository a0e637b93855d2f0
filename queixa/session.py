"""Session settings the package relies on."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # Stored files come out at a size that is cheap to list and to read.
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128MB",
    # Hot join keys (a third of the fact under one key) are split at run time.
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Once a join's sides are shuffled and small per partition, hash instead of sorting.
    "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold": "64MB",
    # Uneven output partitions of a rebalanced write are split too.
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
}


def build_session(app: str = "queixa", **extra: str) -> SparkSession:
    """A session with the settings above; master, memory and partitions come from spark-submit or `extra`."""
    builder = SparkSession.builder.appName(app)
    for key, value in {**SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def measured_size(table: DataFrame) -> int:
    """Bytes of a stored table as the planner sees them: file sizes, less the columns not read."""
    return int(str(table._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def stored_size(table: DataFrame) -> int:
    """Bytes of everything stored that a table is computed from."""
    leaves = table._jdf.queryExecution().optimizedPlan().collectLeaves()
    return sum(int(str(leaves.apply(i).stats().sizeInBytes())) for i in range(leaves.length()))


# A task's share of a shuffle. The session may set MOST_SHUFFLE_TASKS where the bookkeeping of
# more tasks costs more than larger shares do; by default there is no such bound.
SHUFFLE_SHARE, MOST_SHUFFLE_TASKS = 512 * 1024**2, "spark.queixa.mostShuffleTasks"


def size_shuffles(*tables: DataFrame) -> int:
    """Start shuffles with partitions that fit the stored input; adaptive execution joins
    the ones that turn out small, but it cannot cut 200 partitions of a hundred terabytes."""
    conf = tables[0].sparkSession.conf
    wanted = sum(map(stored_size, tables)) // SHUFFLE_SHARE
    most = conf.get(MOST_SHUFFLE_TASKS, None)
    start = max(int(conf.get("spark.sql.shuffle.partitions")), min(wanted, int(most)) if most else wanted)
    conf.set("spark.sql.adaptive.coalescePartitions.initialPartitionNum", str(start))
    return start


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach: the one the cluster names in
    `spark.checkpoint.dir`. A local session that names none gets one of its own."""
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not folder:
        if not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="queixa-"))
        folder = context.getCheckpointDir()
    return folder


def write_and_read_back(df: DataFrame, name: str) -> DataFrame:
    """Cut the lineage with a Parquet table in the shared folder.

    Unlike cached blocks the table outlives lost executors, keeps column pruning,
    and its size on disk is known to the planner when it chooses a join.
    """
    spark = df.sparkSession
    path = os.path.join(shared_folder(spark), f"{name}-{uuid.uuid4().hex}")
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
