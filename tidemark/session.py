"""Session settings for local runs and the shared folder for intermediate tables."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"
# The same for a local session that is running already, where that setting is fixed.
LOCAL_CONF = "tidemark.local.root"


def local_session(app: str = "tidemark", cores: int | str = "*", **conf: str) -> SparkSession:
    """A session for tests and benchmarks; on a cluster the caller brings their own."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    if CHECKPOINT_CONF not in conf:
        # One machine: any folder of it is shared by all tasks.
        builder = builder.config(CHECKPOINT_CONF, tempfile.mkdtemp(prefix="tidemark-"))
    for name, value in conf.items():
        builder = builder.config(name, value)
    return builder.getOrCreate()


def shared_root(spark: SparkSession) -> str:
    """The folder all executors can reach, as the cluster names it.

    A local session that names none gets a folder of its machine, set once for the session.
    """
    root = spark.conf.get(CHECKPOINT_CONF, None) or spark.conf.get(LOCAL_CONF, None)
    if root:
        return root.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError(f"set {CHECKPOINT_CONF} to a folder every executor can reach")
    spark.conf.set(LOCAL_CONF, tempfile.mkdtemp(prefix="tidemark-"))
    return spark.conf.get(LOCAL_CONF)


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path under the shared folder."""
    return f"{shared_root(spark)}/{label}-{uuid.uuid4().hex}"


def cut_lineage(df: DataFrame, label: str = "cut") -> DataFrame:
    """``df`` written as a table in the shared folder and read back.

    What follows reads the columns it needs from there; a lost executor costs a
    read, and the plan starts afresh.
    """
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
