"""Session settings the library relies on."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Runtime settings only, so they can also be applied to a session someone else made.
RUNTIME_CONF = {
    # Instants are compared across sources; one zone for all of them.
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # Joins here keep one side unique per key, so splitting the other side is always exact.
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # A hot key can also make the reduce side of an explicit repartition uneven.
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to `spark` and return it."""
    for name, value in RUNTIME_CONF.items():
        spark.conf.set(name, value)
    return spark


def build_session(app: str = "carelattice", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings above; `conf` takes dotted names through `**{...}`."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    start_conf = {"spark.cleaner.referenceTracking.cleanCheckpoints": "true"}
    for name, value in {**RUNTIME_CONF, **start_conf, **conf}.items():
        builder = builder.config(name, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession, name: str) -> str:
    """A folder all executors can reach: below what the cluster names in `spark.checkpoint.dir`."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        raise ValueError("set spark.checkpoint.dir to a folder shared by the cluster")
    return f"{root.rstrip('/')}/{name}"


def importable(spark: SparkSession) -> None:
    """Let Python workers of a local session import this package. On a cluster it is installed on the executors."""
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    spark.sparkContext.environment.setdefault("PYTHONPATH", root)


def shared_scratch(spark: SparkSession, name: str) -> str:
    """A new path below the checkpoint folder of the session."""
    return f"{checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def checkpoint_dir(spark: SparkSession) -> str:
    """The checkpoint folder of the session: what `spark.checkpoint.dir` names, which a cluster must set. Only a
    local session without one gets a folder of its own."""
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        root = spark.conf.get("spark.checkpoint.dir", None)
        if root is None and context.master.startswith("local"):
            root = tempfile.mkdtemp(prefix="checkpoint-")
        if root is None:
            raise ValueError("set spark.checkpoint.dir to a folder shared by the cluster")
        context.setCheckpointDir(root)
    return context.getCheckpointDir()


def cut_lineage(df: DataFrame) -> DataFrame:
    """`df` written to the checkpoint folder and read back, for loops that run many jobs over it.

    Tasks of such loops then carry a short plan instead of everything that led to `df`, and a lost
    executor costs a read, not a recomputation.
    """
    checkpoint_dir(df.sparkSession)
    return df.checkpoint()


def kept(df: DataFrame) -> DataFrame:
    """`df` written below the checkpoint folder as Parquet and read back: a fraction of what a checkpoint takes, which is
    neither compressed nor by column, but rows come back in other partitions."""
    path = shared_scratch(df.sparkSession, "kept")
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
