"""Session settings that the operators rely on."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def session(master: str | None = None, shuffle_partitions: int | None = None, **conf: str) -> SparkSession:
    """A session in UTC with ANSI mode and adaptive execution; partitions left unset follow the cluster's default."""
    builder = SparkSession.builder.appName("tidewright")
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.ansi.enabled": "true",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.sources.partitionOverwriteMode": "dynamic",
    }
    if shuffle_partitions:
        settings["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    return builder.config(map=settings | conf).getOrCreate()


def scratch_folder(spark: SparkSession) -> str:
    """The shared folder for intermediate tables: spark.checkpoint.dir, or one of this machine where that is unset and driver
    and executors are one process; a cluster must set it."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        master = spark.sparkContext.master
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        base = tempfile.mkdtemp(prefix="tidewright-")
    return base.rstrip("/")


def stored(df: DataFrame, name: str) -> DataFrame:
    """df written to the shared folder and read back, so that what follows does not compute it again and a lost executor
    costs no more than its tasks."""
    path = f"{scratch_folder(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def released(*tables: DataFrame) -> None:
    """Delete tables that `stored` gave and that nothing to come reads: each is the folder of its files."""
    for df in tables:
        spark = df.sparkSession
        for folder in {f.rpartition("/")[0] for f in df.inputFiles()}:
            at = spark._jvm.org.apache.hadoop.fs.Path(spark._jvm.java.net.URI(folder))
            at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)
