"""Session settings and the shared folder used for checkpoints and round trips."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_KEY = "spark.checkpoint.dir"
_own_folders: dict[str, str] = {}
#: Stored tables by application.
_paths: dict[str, list[str]] = {}


def local_session(cpus: int | str = "*", app: str = "tallywright", **conf: str) -> SparkSession:
    """A single-JVM session for tests and benchmarks; on a cluster use spark-submit's own."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "12g")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
    )
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors can see, as named by ``spark.checkpoint.dir``.

    Only a local session without the setting gets a temporary folder; a cluster session without
    it is refused, because a machine-local folder is lost together with its executor.
    """
    configured = spark.conf.get(CHECKPOINT_KEY, None)
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError(f"set {CHECKPOINT_KEY} to a folder shared by all executors")
    application = spark.sparkContext.applicationId
    if application not in _own_folders:
        _own_folders[application] = tempfile.mkdtemp(prefix="tallywright-")
    return _own_folders[application]


def shared_path(spark: SparkSession, name: str) -> str:
    """A fresh path below :func:`shared_dir`."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def ensure_checkpointing(spark: SparkSession) -> None:
    """Give iterative ``pyspark.ml`` estimators a place to cut their lineage."""
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(shared_dir(spark))


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write a table to the shared folder and read it back.

    Cuts the lineage of a result that several jobs start from; unlike cached blocks, the files
    outlive the executors that wrote them. They are deleted when the driver ends, or before by
    :func:`stored` and :func:`discard_stored`.
    """
    return _store(df, name)[0]


@contextmanager
def stored(df: DataFrame, name: str) -> Iterator[DataFrame]:
    """A :func:`materialize` d table that is deleted at the end of the block."""
    table, path = _store(df, name)
    try:
        yield table
    finally:
        _delete(df.sparkSession, path)


def discard_stored(spark: SparkSession) -> int:
    """Delete all tables stored so far by this session; returns their number.

    For the end of a job, when no table that reads them will be used again.
    """
    paths = _paths.pop(spark.sparkContext.applicationId, [])
    for path in paths:
        _delete(spark, path)
    return len(paths)


def _store(df: DataFrame, name: str) -> tuple[DataFrame, str]:
    spark = df.sparkSession
    path = shared_path(spark, name)
    _paths.setdefault(spark.sparkContext.applicationId, []).append(path)
    _file_system(spark, path).deleteOnExit(spark._jvm.org.apache.hadoop.fs.Path(path))
    df.write.mode("errorifexists").parquet(path, compression="zstd")
    return spark.read.schema(df.schema).parquet(path), path


def _file_system(spark: SparkSession, path: str):  # a Hadoop FileSystem of the JVM
    return spark._jvm.org.apache.hadoop.fs.Path(path).getFileSystem(spark._jsc.hadoopConfiguration())


def _delete(spark: SparkSession, path: str) -> None:
    _file_system(spark, path).delete(spark._jvm.org.apache.hadoop.fs.Path(path), True)
