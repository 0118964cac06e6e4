"""Session helpers: building one, shipping the package, cutting lineage through the shared folder."""

from __future__ import annotations

import atexit
import contextlib
import os
import shutil
import tempfile
import uuid
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession

# Tests and the bench read tables of one row group on all cores; a cluster never sets this.
SPREAD = "lexloom.spread"
# Spark removes the shuffle files of a query at its end, not when the driver happens to collect its garbage.
SHORT_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

_own_folders: dict[str, str] = {}
_shipped: set[str] = set()


def build_session(app: str = "lexloom", cores: str | int = "*", **conf: str) -> SparkSession:
    """A local session for tests and the bench; on a cluster the caller brings its own."""
    settings = {
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.sql.shuffle.partitions": "8",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.driver.memory": "12g",
        SPREAD: "true",
        **conf,
    }
    builder = SparkSession.builder.master(f"local[{cores}]").appName(app)
    for key, value in settings.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def spread(df: DataFrame, *keys: str) -> DataFrame:
    """A scan as it is; only in sessions of :func:`build_session` its rows are dealt out to all cores.

    The small test tables are one row group, which one task would read. A session without that setting
    never shuffles texts here.
    """
    if df.sparkSession.conf.get(SPREAD, "false") != "true":
        return df
    return df.repartition(df.sparkSession.sparkContext.defaultParallelism, *keys)


def ship_package(spark: SparkSession) -> None:
    """Send the package to the executors, once for each application, so that workers can import it from anywhere."""
    app = spark.sparkContext.applicationId
    if app in _shipped:
        return
    _shipped.add(app)
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    folder = tempfile.mkdtemp(prefix="lexloom-package-")
    atexit.register(shutil.rmtree, folder, True)
    spark.sparkContext.addPyFile(shutil.make_archive(os.path.join(folder, "lexloom"), "zip", root, "lexloom"))


def shared_folder(spark: SparkSession) -> str:
    """The folder that every executor can reach, as named by ``spark.checkpoint.dir``.

    Where it is unset a local session gets a folder of its own, removed when Python ends; on a cluster that is an error.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that every executor can reach")
    app = spark.sparkContext.applicationId
    if app not in _own_folders:
        _own_folders[app] = tempfile.mkdtemp(prefix="lexloom-")
        atexit.register(shutil.rmtree, _own_folders[app], True)
    return _own_folders[app]


def _tables_of(spark: SparkSession) -> str:
    return f"{shared_folder(spark)}/lexloom-{spark.sparkContext.applicationId}"


def new_path(spark: SparkSession) -> str:
    """An unused path in the shared folder; what is written there stays until :func:`clean_up`."""
    return f"{_tables_of(spark)}/{uuid.uuid4().hex}"


@contextlib.contextmanager
def short_shuffles(spark: SparkSession) -> Iterator[None]:
    """Queries that are run within leave no shuffle files behind; for those whose result nothing is recomputed from."""
    before = spark.conf.get(SHORT_SHUFFLES, None)
    spark.conf.set(SHORT_SHUFFLES, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(SHORT_SHUFFLES)
        else:
            spark.conf.set(SHORT_SHUFFLES, before)


def write_table(df: DataFrame, path: str, *parts: str) -> None:
    """Write ``df`` to ``path``, in folders by ``parts``; the shuffles that led to it go at once."""
    ship_package(df.sparkSession)
    with short_shuffles(df.sparkSession):
        (df.write.partitionBy(*parts) if parts else df.write).parquet(path)


def remove_table(spark: SparkSession, path: str) -> None:
    """Remove what was written to ``path``; no frame that is still to be run may read it."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def cut_lineage(df: DataFrame, path: str | None = None) -> DataFrame:
    """Write ``df`` to a table in the shared folder and continue from it.

    Later stages then survive lost executors without recomputing what came before, and Spark
    knows the table's true size when it decides on broadcasts. The tables stay until
    :func:`clean_up`, as frames that read them may still be run, or until the caller that gave
    their ``path`` removes them.
    """
    spark = df.sparkSession
    path = path or new_path(spark)
    write_table(df, path)
    return spark.read.schema(df.schema).parquet(path)


def clean_up(spark: SparkSession) -> None:
    """Remove the tables that this application has cut its lineage with; frames on them can't be run any more."""
    remove_table(spark, _tables_of(spark))
