"""Session settings and the shared scratch area."""

from __future__ import annotations

import atexit
import logging
import os
import shutil
import tempfile
import uuid
import zipfile
from functools import cache
from pathlib import Path

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession

logger = logging.getLogger(__name__)

# Runtime settings the plans are written for. All are ordinary Spark options; a session built elsewhere works too,
# because no result depends on them except through the time zone of zoned timestamps.
RUNTIME_OPTIONS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    # A rebalanced task writes few directories; keeping their files open spares sorting its rows by directory. A task
    # that meets more directories falls back to the sort.
    "spark.sql.maxConcurrentOutputFileWriters": "4",
}


def open_session(app_name: str, master: str | None = None, **options: str) -> SparkSession:
    """Session with the settings above; memory and executors belong to spark-submit."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**RUNTIME_OPTIONS, **options}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def scratch_root(spark: SparkSession) -> str:
    """Folder of this application's intermediate tables; one per application.

    It lies below ``spark.checkpoint.dir``, the folder all executors share. A machine-local folder is taken only in
    local mode with that setting absent. Tables in it go when the application ends normally; after a crash the caller
    can remove the folder as a whole.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.conf.get("spark.master", "").startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        base = _local_base()
    return f"{base.rstrip('/')}/fareloom-{spark.conf.get('spark.app.id')}"


@cache
def _local_base() -> str:
    base = tempfile.mkdtemp(prefix="fareloom-")
    atexit.register(shutil.rmtree, base, ignore_errors=True)
    return base


def scratch_path(spark: SparkSession, label: str) -> str:
    """New, unused path for an intermediate table below ``scratch_root``."""
    return f"{scratch_root(spark)}/{label}-{uuid.uuid4().hex[:12]}"


def discard_at_exit(spark: SparkSession, path: str) -> None:
    """Let Hadoop remove an existing scratch path when the application ends.

    Only a session with its own JVM can ask for that; elsewhere the path stays until ``scratch_root`` is removed.
    """
    jvm = getattr(spark, "_jvm", None)
    if jvm is None:
        logger.warning("%s stays: this session has no JVM to remove it at exit", path)
        return
    target = jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(target)


_shipped: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Give the Python workers of this application the package, once, where it is a folder on the driver.

    Functions that run in tasks call helpers of the package; with this they find them wherever a session was started
    from. A package that came with ``--py-files`` is there already.
    """
    context, folder = spark.sparkContext, Path(__file__).resolve().parent
    if context.applicationId in _shipped or not folder.is_dir():
        return
    _shipped.add(context.applicationId)
    archive = Path(os.path.realpath(tempfile.mkdtemp(prefix="fareloom-code-"))) / "fareloom.zip"
    atexit.register(shutil.rmtree, archive.parent, ignore_errors=True)
    with zipfile.ZipFile(archive, "w") as target:
        for source in sorted(folder.rglob("*.py")):
            target.write(source, source.relative_to(folder.parent))
    context.addPyFile(str(archive))


def has_files(spark: SparkSession, path: str) -> bool:
    """Whether anything is stored at ``path``."""
    jvm = getattr(spark, "_jvm", None)
    if jvm is not None:
        target = jvm.org.apache.hadoop.fs.Path(path)
        system = target.getFileSystem(spark._jsc.hadoopConfiguration())
        return bool(system.exists(target)) and (not system.isDirectory(target) or len(system.listStatus(target)) > 0)
    try:
        return not spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path).select("path").isEmpty()
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return False
        raise


def materialise(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once to shared scratch and read it back.

    Used where a small derived table is needed by several jobs: it is computed once, survives the loss of executors,
    and Catalyst sees its true size on disk.
    """
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.write.parquet(path)
    discard_at_exit(spark, path)
    return spark.read.schema(df.schema).parquet(path)
