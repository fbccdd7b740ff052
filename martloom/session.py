"""Session settings and the shared checkpoint folder."""

from __future__ import annotations

import tempfile
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# Runtime settings every plan here relies on: AQE re-plans after each shuffle,
# splits skewed join partitions even if that costs one more exchange, and
# merges small partitions.
RUNTIME = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.session.timeZone": "UTC",
}


def build_session(app: str = "martloom", master: str | None = None, **conf: str) -> SparkSession:
    """Session with the settings above; on a cluster leave `master` to spark-submit."""
    builder = SparkSession.builder.appName(app).config("spark.ui.enabled", "false")
    if master:
        builder = builder.master(master)
    for key, value in {**RUNTIME, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def tune(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to a session made elsewhere."""
    for key, value in RUNTIME.items():
        spark.conf.set(key, value)
    return spark


def shuffle_partitions(spark: SparkSession) -> int:
    """What a shuffle starts with in this session."""
    configured = spark.conf.get("spark.sql.shuffle.partitions")
    return int(spark.conf.get("spark.sql.adaptive.coalescePartitions.initialPartitionNum", None) or configured)


@contextmanager
def shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """Writes and checkpoints begun inside remove their shuffle files when they end, instead of
    keeping them until the driver collects garbage.  Shuffles below a persisted frame stay."""
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key, None)
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        spark.conf.unset(key) if before is None else spark.conf.set(key, before)


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Checkpoint folder of the session; a private one only for local masters."""
    sc = spark.sparkContext
    if current := sc.getCheckpointDir():
        return current
    shared = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir")
    if shared is None:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
        shared = tempfile.mkdtemp(prefix="martloom-checkpoint-")
    sc.setCheckpointDir(shared)
    return shared


def checkpointed(df: DataFrame) -> DataFrame:
    """Cut the lineage through reliable storage, so a lost executor loses nothing."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint()
