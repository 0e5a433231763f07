"""Session settings the library relies on, and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def build_session(app: str = "kerbflow", master: str | None = None, shuffle_partitions: int | None = None,
                  **conf: str) -> SparkSession:
    """A session with UTC time and adaptive execution; a cluster's own settings win where none is given."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    builder = (
        builder.config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        # The JVM does not compile methods of more than 8000 bytes; past that, Spark's smaller methods are faster.
        .config("spark.sql.codegen.hugeMethodLimit", "8000")
    )
    for name, value in conf.items():
        builder = builder.config(name.replace("__", "."), value)
    return builder.getOrCreate()


def prepare(spark: SparkSession) -> SparkSession:
    """Set the runtime options that results depend on; everything else stays as the cluster has it."""
    if spark.conf.get("spark.sql.session.timeZone") != "UTC":
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A fresh folder in the shared checkpoint area of the cluster.

    Where `spark.checkpoint.dir` is unset, a session that runs in one process (tests, a laptop) gets a temporary folder;
    on a cluster that would be another disk on every machine, so there it is an error.
    """
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not base:
        if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        base = tempfile.mkdtemp(prefix="kerbflow-")
        spark.sparkContext.setCheckpointDir(base)
    return f"{base.rstrip('/')}/kerbflow/{name}-{uuid.uuid4().hex[:12]}"


def store(df: DataFrame, name: str, compression: str | None = None) -> DataFrame:
    """Write a derived table to the shared folder and read it back.

    It cuts the lineage, survives lost executors, and gives Spark the true size, by which it decides on broadcasts.
    """
    path = scratch_dir(df.sparkSession, name)
    df.write.parquet(path, compression=compression)
    stored = df.sparkSession.read.schema(df.schema).parquet(path)
    stored.stored_at = path
    return stored


def discard(*stored: DataFrame) -> None:
    """Remove tables of `store` that no later step reads."""
    for df in stored:
        context = df.sparkSession.sparkContext
        path = context._jvm.org.apache.hadoop.fs.Path(df.stored_at)
        path.getFileSystem(context._jsc.hadoopConfiguration()).delete(path, True)
