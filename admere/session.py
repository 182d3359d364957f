"""Session settings and the shared folder used to cut lineage."""

from __future__ import annotations

import tempfile
import uuid
import weakref

from pyspark.sql import DataFrame, SparkSession

#: Settings that change results, so every entry point applies them.
RESULT_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
}

#: Settings that change speed only; a cluster may override them.
SPEED_SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
}


#: Stream state beyond the heap; on one machine the start-up costs more than it saves.
CLUSTER_SETTINGS = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}


def one_machine(spark: SparkSession) -> bool:
    """Whether driver and executors are one process; ``local-cluster`` is not."""
    master = spark.sparkContext.master
    return master == "local" or master.startswith("local[")


def prepare(spark: SparkSession) -> SparkSession:
    """Apply the settings results depend on to a session made elsewhere."""
    local = one_machine(spark)
    for key, value in {**RESULT_SETTINGS, **SPEED_SETTINGS, **({} if local else CLUSTER_SETTINGS)}.items():
        spark.conf.set(key, value)
    return spark


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, **conf: str) -> SparkSession:
    """A local session for tests and the benchmark."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("admere")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", "8g")
    )
    for key, value in {**RESULT_SETTINGS, **SPEED_SETTINGS, **conf}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors can reach, from ``spark.checkpoint.dir``.

    Only a local master may fall back to a folder of this machine: on a cluster
    such a folder would be lost with its executor.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    context = spark.sparkContext
    current = context.getCheckpointDir()
    if current:
        return current.rstrip("/")
    if not one_machine(spark):
        raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
    folder = tempfile.mkdtemp(prefix="admere-")
    spark.conf.set("spark.checkpoint.dir", folder)
    return folder


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder."""
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def use_checkpoints(spark: SparkSession) -> None:
    """Point the context's checkpoints at the shared folder."""
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(shared_folder(spark))


def remove_folder(spark: SparkSession, path: str) -> None:
    """Delete a folder of any file system Hadoop knows."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


_PATHS: weakref.WeakKeyDictionary[DataFrame, str] = weakref.WeakKeyDictionary()


def stable(df: DataFrame) -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    Every later use sees the same rows, also after executors are lost, and reads
    only the columns it needs.
    """
    path = scratch_path(df.sparkSession, "stable")
    df.write.parquet(path)
    kept = df.sparkSession.read.schema(df.schema).parquet(path)
    _PATHS[kept] = path
    return kept


def release(df: DataFrame) -> None:
    """Delete what :func:`stable` wrote, once nothing reads it any more."""
    path = _PATHS.pop(df, None)
    if path:
        remove_folder(df.sparkSession, path)
