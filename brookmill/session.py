"""Session settings and the shared folder for data that must outlive an executor."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def local_session(cpus: int | str = "*", app: str = "brookmill") -> SparkSession:
    """A session for one machine: tests and the bench. On a cluster, use the cluster's own."""
    return (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "12g")
        .getOrCreate()
    )


def shared_folder(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``, as the cluster's owner set it: all executors reach it.

    Where the setting is absent, a session in one process gets a folder of its own; any other fails,
    because a machine-local folder is not readable from other executors.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if base:
        return base.rstrip("/")
    context = spark.sparkContext
    if not context.getCheckpointDir():
        if not one_machine(context.master):
            raise ValueError("set spark.checkpoint.dir to a folder all executors can reach")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="brookmill-"))
    return context.getCheckpointDir().rstrip("/")


def one_machine(master: str) -> bool:
    """Do the driver and all tasks run in one process? ``local-cluster`` starts executors of their own."""
    return master == "local" or master.startswith("local[")


_scopes: list[list[str]] = []


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Remove, at the end, what ``shared_path`` handed out inside: results must have been used by then.

    Outside any such block the files stay until the shared folder is cleaned.
    """
    _scopes.append([])
    try:
        yield
    finally:
        jvm = spark.sparkContext._jvm
        for name in _scopes.pop():
            path = jvm.org.apache.hadoop.fs.Path(name)
            path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def shared_path(spark: SparkSession, name: str) -> str:
    """A new, unused path below the shared folder."""
    path = f"{shared_folder(spark)}/brookmill/{name}-{uuid.uuid4().hex}"
    for scope in _scopes[-1:]:
        scope.append(path)
    return path


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    Cuts the lineage, survives lost executors, and gives the optimizer the real size.
    """
    path = shared_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
