"""Session settings and the shared scratch folder."""

from __future__ import annotations

import shutil
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession


def build_session(app_name: str = "tidemark", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the operators are written for.

    Partition counts are left to adaptive execution; pass ``conf`` to override.
    """
    builder = (
        SparkSession.builder.appName(app_name)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """Root for checkpoints and intermediate tables: the one the cluster names.

    ``spark.checkpoint.dir`` (or an already set checkpoint folder) wins. Only a
    local session without either gets a temporary folder of its own; a cluster
    without one is an error, because a driver-local path is lost to executors.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    root = root or spark.sparkContext.getCheckpointDir()
    if root:
        return root.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
    root = tempfile.mkdtemp(prefix="tidemark-")
    spark.sparkContext.setCheckpointDir(root)
    return root


#: Folders named in this context and not yet removed; ``scratch`` gives a part of a job a list of its own.
_folders: ContextVar[list[str]] = ContextVar("folders", default=[])  # noqa: B039


def run_folder(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder, one per call."""
    path = f"{shared_folder(spark)}/tidemark/{name}-{uuid.uuid4().hex}"
    _folders.get().append(path)
    return path


def discard(spark: SparkSession, path: str) -> bool:
    """Remove one folder that ``run_folder`` named, through the file system it is on."""
    if path in _folders.get():
        _folders.get().remove(path)
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


def discard_folders(spark: SparkSession) -> int:
    """Remove every folder that ``run_folder`` named in this context so far; their number is returned.

    For when the results that read them are done.
    """
    return sum(discard(spark, path) for path in list(_folders.get()))


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Folders named inside are removed at the end; those of other running jobs are left alone.

    A result that outlives the block is written to a folder named before it.
    """
    mark = _folders.set([])
    try:
        yield
    finally:
        discard_folders(spark)
        _folders.reset(mark)


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once below the shared folder and read it back.

    Used where several jobs need the same intermediate result: the lineage is cut
    and the table outlives any executor.
    """
    spark = df.sparkSession
    path = run_folder(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


_shipped: set[str] = set()


def ship_code(spark: SparkSession) -> None:
    """Send this package to the Python workers, once per application.

    Needed before a job whose tasks call functions of the package, unless it is
    installed on every node.
    """
    app = spark.sparkContext.applicationId
    if app in _shipped:
        return
    package = Path(__file__).resolve().parent
    target = Path(tempfile.mkdtemp(prefix="tidemark-code-")) / "tidemark"
    spark.sparkContext.addPyFile(shutil.make_archive(str(target), "zip", package.parent, package.name))
    _shipped.add(app)
