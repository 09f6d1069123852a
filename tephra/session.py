"""Session settings the library relies on."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def get_session(app: str = "tephra", master: str | None = None, **conf: str) -> SparkSession:
    """A UTC session with adaptive execution; `master` is left to the cluster unless given.

    Nothing here caps parallelism: shuffle partitions start high and adaptive execution merges the
    small ones, so one setting serves a laptop and a large cluster.
    """
    builder = (SparkSession.builder.appName(app)
               .config("spark.sql.session.timeZone", "UTC")
               .config("spark.sql.adaptive.enabled", "true")
               .config("spark.sql.adaptive.skewJoin.enabled", "true")
               .config("spark.sql.adaptive.coalescePartitions.enabled", "true"))
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def local_session(app: str = "tephra-local", cpus: int | None = None, **conf: str) -> SparkSession:
    """A local session for tests and the benchmark."""
    n = cpus or int(os.environ.get("BENCH_CPUS", "8"))
    settings = {"spark.sql.shuffle.partitions": str(n), "spark.ui.enabled": "false",
                "spark.ui.showConsoleProgress": "false",
                "spark.driver.memory": os.environ.get("BENCH_DRIVER_MEMORY", "12g"), **conf}
    spark = get_session(app, f"local[{n}]", **settings)
    spark.sparkContext.setLogLevel("ERROR")
    return spark


_own_dir: str | None = None
_claimed: set[str] = set()


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share, as the session names it.

    Only a session whose driver and executors are one process may do without; anywhere else a missing setting is
    an error, since each machine would write to a disk of its own.
    """
    global _own_dir
    path = spark.conf.get("spark.checkpoint.dir", None)
    if path:
        return path
    master = spark.sparkContext.master
    if not master.startswith("local") or master.startswith("local-cluster"):
        raise RuntimeError(f"spark.checkpoint.dir must name a folder that all executors of {master} share")
    if _own_dir is None:
        _own_dir = tempfile.mkdtemp(prefix="spark-")
    return _own_dir


def run_dir(spark: SparkSession) -> str:
    """This application's folder below the shared one; Hadoop's file system deletes it when the driver's JVM ends."""
    path = f"{shared_dir(spark).rstrip('/')}/tephra-{spark.sparkContext.applicationId}"
    if path not in _claimed:
        hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        files = hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        files.mkdirs(hadoop)
        files.deleteOnExit(hadoop)
        _claimed.add(path)
    return path


def materialize(df: DataFrame) -> DataFrame:
    """Write an intermediate table to the application's shared folder and read it back.

    Cuts the plan: what reads the result several times computes it once, survives the loss of any executor,
    and joins it with its true size known. Nothing refers to the table after the application.
    """
    path = f"{run_dir(df.sparkSession)}/{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def drop_materialized(df: DataFrame) -> None:
    """Delete the files of a table that materialize() returned, once nothing will read it again."""
    spark = df.sparkSession
    for name in {f.rpartition("/")[0] for f in df.inputFiles()}:
        if name.rpartition("/")[0].endswith(f"tephra-{spark.sparkContext.applicationId}"):
            hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(name)
            hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(hadoop, True)
