"""Session helpers: a local session for tests and the shared scratch folder."""

from __future__ import annotations

import os
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: str | int = "*", shuffle_partitions: int = 8, warehouse: str | None = None) -> SparkSession:
    """A session for tests and benchmarks; a cluster job passes in its own."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("terrasift")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", "12g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
    )
    if warehouse:
        builder = builder.config("spark.sql.warehouse.dir", warehouse)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


# Applications whose workers already have the code.
_shipped: set[str] = set()


def ship_code(spark: SparkSession) -> None:
    """Let Python workers import the packages of this repository, wherever they run."""
    app = spark.sparkContext.applicationId
    if app in _shipped:
        return
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    build = tempfile.mkdtemp(prefix="terrasift-code-")
    for package in ("terrasift", "workload"):
        if os.path.isdir(os.path.join(root, package)):
            spark.sparkContext.addPyFile(shutil.make_archive(os.path.join(build, package), "zip", root, package))
    _shipped.add(app)


def scratch_dir(spark: SparkSession) -> str:
    """A fresh folder every executor can reach.

    The cluster names the shared root in ``spark.checkpoint.dir``. Only a local
    session, where every task runs on this machine, may fall back to a
    temporary folder.
    """
    sc = spark.sparkContext
    root = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not root and sc.master.startswith("local"):
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="terrasift-"))
        root = sc.getCheckpointDir()
    if not root:
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    return f"{root.rstrip('/')}/terrasift-{uuid.uuid4().hex}"


def staged(df: DataFrame) -> DataFrame:
    """Write a frame once to the shared scratch folder and read it from there.

    Unlike cached blocks it takes no executor's disk and outlives its executors.
    """
    if not df.columns:
        return df
    names = [f"c{i}" for i in range(len(df.columns))]
    plain = df.toDF(*names)
    path = scratch_dir(df.sparkSession)
    plain.write.parquet(path)
    return df.sparkSession.read.schema(plain.schema).parquet(path).toDF(*df.columns)
