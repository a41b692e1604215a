"""Session helpers: table access and the shared checkpoint folder."""

from __future__ import annotations

import shutil
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession


_shipped: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Gives this package to the Python workers of the application, wherever they run; once for each application.

    Spark serves the archive from the driver, as with ``--py-files``; no data go through it.
    """
    context = spark.sparkContext
    if context.applicationId not in _shipped:
        package = Path(__file__).resolve().parent
        archive = shutil.make_archive(str(Path(tempfile.mkdtemp(prefix="locusloom-")) / package.name), "zip", package.parent, package.name)
        context.addPyFile(archive)
        _shipped.add(context.applicationId)


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """The Parquet table ``name`` of a data folder."""
    ship_package(spark)
    return spark.read.parquet(f"{folder}/{name}.parquet")


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder for checkpoints, as the session names it.

    ``spark.checkpoint.dir`` decides. Only a local session that names none (tests) gets a temporary
    folder; on a cluster a missing setting is an error, since a machine-local folder would not survive
    the loss of an executor.
    """
    context = spark.sparkContext
    current = context._jsc.sc().getCheckpointDir()
    if current.isDefined():
        return current.get()
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not context.master.startswith("local") or context.master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        folder = tempfile.mkdtemp(prefix="locusloom-checkpoint-")
    context.setCheckpointDir(folder)
    return folder


_scopes: list[list[str]] = []


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """A scope at whose end the tables that :func:`saved` wrote in it are removed.

    Results that read them must be written or collected inside. Outside of any scope tables stay until the folder is
    cleared, as checkpoints do.
    """
    held: list[str] = []
    _scopes.append(held)
    try:
        yield
    finally:
        _scopes.remove(held)
        for path in held:
            place = spark._jvm.org.apache.hadoop.fs.Path(path)
            place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


def saved(df: DataFrame, name: str) -> DataFrame:
    """``df`` written as a table in the shared checkpoint folder, and read again.

    Like a checkpoint it cuts the lineage and outlives lost executors; unlike one it brings its true size, by which
    the next join chooses its strategy. :func:`scratch` removes such tables.
    """
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark)}/locusloom/{uuid.uuid4().hex}-{name}"
    if _scopes:
        _scopes[-1].append(path)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def local_session(cores: str = "8", partitions: int = 8, memory: str = "12g") -> SparkSession:
    """A session for tests and the bench on one machine."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("locusloom")
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .getOrCreate()
    )
