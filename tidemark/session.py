"""Sessions for local runs, and the shared folder for intermediate tables."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import SparkSession

_local_folders: dict[str, str] = {}


# With this many files open per task, rows of few partition values need no sort before a write.
OPEN_FILES = 8
_OPEN_FILES_SETTING = "spark.sql.maxConcurrentOutputFileWriters"


def prepare(spark: SparkSession) -> None:
    """Settings the loads profit from, where the session leaves them at their default.

    They stay set: Spark reads them both when it plans a write and when it runs it.  A cluster without a
    shared folder is refused here, not on the first day that is large enough to need one.
    """
    if _named_folder(spark) is None and not spark.sparkContext.master.startswith("local"):
        raise RuntimeError(_NO_FOLDER)
    if int(spark.conf.get(_OPEN_FILES_SETTING)) <= 0:
        spark.conf.set(_OPEN_FILES_SETTING, OPEN_FILES)


_NO_FOLDER = "set spark.checkpoint.dir to a folder every executor can reach"


def _named_folder(spark: SparkSession) -> str | None:
    return spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")


def local_session(cores: int | str = "*", memory: str = "8g") -> SparkSession:
    """A session for tests and benches; on a cluster the caller brings its own."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("tidemark")
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        .getOrCreate()
    )


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors can reach, as named by ``spark.checkpoint.dir``.

    Only a local master may leave it unset; it then gets a temporary folder that
    is removed when Python exits.
    """
    if named := _named_folder(spark):
        return named.rstrip("/")
    context = spark.sparkContext
    if not context.master.startswith("local"):
        raise RuntimeError(_NO_FOLDER)
    if context.applicationId not in _local_folders:
        folder = tempfile.mkdtemp(prefix="tidemark-")
        atexit.register(shutil.rmtree, folder, ignore_errors=True)
        _local_folders[context.applicationId] = folder
    return _local_folders[context.applicationId]


def work_folder(spark: SparkSession, purpose: str) -> str:
    """A fresh folder name below the shared folder."""
    return f"{shared_folder(spark)}/{purpose}-{uuid.uuid4().hex[:12]}"


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Let ``DataFrame.checkpoint`` work where the session names no folder."""
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(f"{shared_folder(spark)}/checkpoints")
