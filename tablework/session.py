"""Session helpers: local sessions for tests and bench, shared scratch folders, fresh databases."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: int | str = "*", app: str = "tablework", shuffle_partitions: int = 8) -> SparkSession:
    """A session for tests and the bench. On a cluster the caller brings its own."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "12g")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.adaptive.enabled", "true")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_root(spark: SparkSession) -> str:
    """The folder every executor can reach: ``spark.checkpoint.dir`` as the cluster names it.

    Only a local session without the setting gets a temporary folder.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if root:
        return root.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    root = tempfile.mkdtemp(prefix="tablework-")
    spark.sparkContext.setCheckpointDir(root)
    return root


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Iterative fits cut their lineage here; the cluster's own setting always wins."""
    root = shared_root(spark)
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(root)
    return root


def scratch_dir(spark: SparkSession, label: str) -> str:
    """A new, not yet existing folder below the shared root; each call gives another one."""
    return f"{shared_root(spark)}/tablework/{label}-{uuid.uuid4().hex[:12]}"


def fresh_database(spark: SparkSession, label: str) -> str:
    """Create an empty database whose tables live below the shared root."""
    name = f"tw_{label}_{uuid.uuid4().hex[:8]}"
    spark.sql(f"CREATE DATABASE {name} LOCATION '{scratch_dir(spark, name)}'")
    return name


def staged(df: DataFrame, label: str, spread: bool = False) -> DataFrame:
    """Write an intermediate result to the shared folder and return it as a scan.

    Later steps start from the files: nothing upstream is computed twice, a lost executor costs no
    replay, and the optimizer knows the true size. ``spread=True`` deals the rows evenly over the
    shuffle partitions first, for iterative fits whose input came from few files.
    """
    spark = df.sparkSession
    path = scratch_dir(spark, label)
    if spread:
        df = df.repartition(int(spark.conf.get("spark.sql.shuffle.partitions")))
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
