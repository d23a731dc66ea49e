"""Spark sessions with the settings that results depend on."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, memory: str = "8g", name: str = "quern") -> SparkSession:
    """A local session in UTC with adaptive execution, for tests and benchmarks."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(name)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The Parquet table ``name`` in ``sf_dir``."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def spread(df: DataFrame, key: str) -> DataFrame:
    """``df`` laid out by key over all cores, for work that costs far more than moving its rows: a small file is one task's otherwise."""
    spark = df.sparkSession
    n = max(4 * spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
    return df.repartition(n, key)


def _ensure_folder(spark: SparkSession) -> None:
    """A checkpoint folder of our own only in a local session that names none."""
    if not spark.conf.get("spark.checkpoint.dir", None) and spark.sparkContext.getCheckpointDir() is None:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="quern-checkpoint-"))


def checkpointed(df: DataFrame) -> DataFrame:
    """``df`` written to the folder in spark.checkpoint.dir, its lineage cut; a folder of our own only where none is set."""
    spark = df.sparkSession
    _ensure_folder(spark)
    return df.checkpoint(eager=True)


def shared_folder(spark: SparkSession, name: str) -> str:
    """A new folder below the one in spark.checkpoint.dir, which driver and executors share; a local one only where none is set."""
    _ensure_folder(spark)
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    return f"{base.rstrip('/')}/quern-{name}-{uuid.uuid4().hex}"
