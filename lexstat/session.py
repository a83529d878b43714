"""Session defaults, table loading and lineage cuts shared by all operators."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def get_spark(app: str = "lexstat", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the engine's defaults; a cluster's own settings win where it sets them."""
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    defaults = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
    }
    for k, v in {**defaults, **conf}.items():
        b = b.config(k, v)
    return b.getOrCreate()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share: the session's spark.checkpoint.dir.

    Only a local session, whose tasks all run on this machine, may leave it unset and gets a temporary folder.
    """
    d = spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        master = spark.sparkContext.master
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        d = "file://" + os.path.join(tempfile.gettempdir(), "lexstat-checkpoints")
    return d.rstrip("/")


#: Folders of staged tables that are still there.
_STAGED: list[str] = []


def exists(spark: SparkSession, path: str) -> bool:
    """Whether a path is there, on whatever file system it names."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).exists(at)


def staged(df: DataFrame) -> DataFrame:
    """df written as a Parquet table in the shared folder and read back: columnar and prunable.

    Executors can be lost without losing it. It is deleted by drop_staged, else when the driver's JVM ends.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/staged-{uuid.uuid4().hex}"
    _STAGED.append(path)
    df.write.parquet(path)
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).deleteOnExit(at)
    return spark.read.schema(df.schema).parquet(path)


def drop_staged(spark: SparkSession) -> int:
    """Deletes all tables that were staged so far, once what was made of them is written; how many there were.

    For long sessions: DataFrames that still read them can't be computed any more.
    """
    conf, n = spark._jsparkSession.sessionState().newHadoopConf(), len(_STAGED)
    while _STAGED:
        at = spark._jvm.org.apache.hadoop.fs.Path(_STAGED.pop())
        at.getFileSystem(conf).delete(at, True)
    return n


def spread(df: DataFrame, *keys: str) -> DataFrame:
    """df with at least as many partitions as the cluster has cores, for work that is heavy per row.

    A text file or row group is one partition whatever its rows cost; where there are fewer of them than cores, the rows
    are hashed out by the keys. Otherwise df comes back as it is. The rows are the same either way; only the exchange
    before them depends on how the table is stored.
    """
    want = df.sparkSession.sparkContext.defaultParallelism
    return df if df._jdf.rdd().getNumPartitions() >= want else df.repartition(want, *keys)
