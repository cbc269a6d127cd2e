"""Session construction and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Confs every daybook job wants. Shuffle partition count and memory are left
# to the caller: they depend on cluster size and data volume.
DEFAULT_CONFS = {
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Broadcast only what a finished shuffle stage has measured: the static
    # (file-size based) estimate is off, AQE's runtime threshold is on, and
    # anything above it stays a sort-merge join.
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "32MB",
}


def build_session(
    master: str | None = None,
    app: str = "daybook",
    shuffle_partitions: int | None = None,
    extra: dict[str, str] | None = None,
) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    confs = dict(DEFAULT_CONFS)
    if shuffle_partitions:
        confs["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    confs.update(extra or {})
    for key, value in confs.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def _checkpoint_root(spark: SparkSession) -> str | None:
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root
    try:
        return spark.sparkContext.getCheckpointDir()
    except Exception:  # Spark Connect has no SparkContext
        return None


def shared_dir(spark: SparkSession, name: str) -> str:
    """A fresh, never-reused folder under the cluster's shared checkpoint dir.

    Staging tables, scratch warehouses and lineage cuts live here, so every
    executor (and a restarted one) can read them. Only a local-mode session
    without ``spark.checkpoint.dir`` gets a private temp folder, as in tests.
    """
    root = _checkpoint_root(spark)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
        root = tempfile.mkdtemp(prefix="daybook-")
        spark.sparkContext.setCheckpointDir(root)
    return f"{root.rstrip('/')}/daybook/{name}-{uuid.uuid4().hex[:12]}"


def cut_lineage(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once to the shared folder and read back, for work that reads it several times."""
    path = shared_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
