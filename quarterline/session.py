"""Session helpers: local sessions for tests and the shared checkpoint folder."""

from __future__ import annotations

import atexit
import hashlib
import os
import shutil
import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

#: Folders made since each `scratch` that is open began.
_SCRATCH: list[list[str]] = []


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, memory: str = "8g") -> SparkSession:
    """A single-machine session for tests and the bench; clusters bring their own."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("quarterline")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", memory)
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_folder(spark: SparkSession) -> str:
    """The folder named in spark.checkpoint.dir; a temporary one only for local masters."""
    context = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if named is None:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
        named = tempfile.mkdtemp(prefix="quarterline-")
        atexit.register(shutil.rmtree, named, ignore_errors=True)
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(named)
    return named


def fresh_folder(spark: SparkSession, purpose: str) -> str:
    """A path under the shared folder that nothing has written to yet; the innermost `scratch` removes it at its end."""
    path = os.path.join(shared_folder(spark), f"{purpose}-{uuid.uuid4().hex}")
    if _SCRATCH:
        _SCRATCH[-1].append(path)
    return path


@contextmanager
def scratch(spark: SparkSession):
    """Stored stages made inside are removed at the end, so results that read them must have been written or collected by then."""
    made: list[str] = []
    _SCRATCH.append(made)
    try:
        yield
    finally:
        _SCRATCH.remove(made)
        for path in made:
            remove(spark, path)


def _place(spark: SparkSession, path: str):
    """The path and its file system, local, distributed or an object store."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()), place


def exists(spark: SparkSession, path: str) -> bool:
    system, place = _place(spark, path)
    return system.exists(place)


def remove(spark: SparkSession, path: str) -> None:
    system, place = _place(spark, path)
    system.delete(place, True)


def rename(spark: SparkSession, path: str, new: str) -> None:
    system, place = _place(spark, path)
    if not system.rename(place, spark._jvm.org.apache.hadoop.fs.Path(new)):
        raise OSError(f"{path} can't be renamed to {new}")


def kept_folder(spark: SparkSession, purpose: str, sources: list[str], *settings: object) -> str:
    """A path under the shared folder that stays the same while the source files and settings do, also in later sessions."""
    told = [repr(settings)]
    for source in sources:
        system, place = _place(spark, source)
        files = system.listFiles(place, True)
        while files.hasNext():
            status = files.next()
            told.append(f"{status.getPath()} {status.getLen()} {status.getModificationTime()}")
    return os.path.join(shared_folder(spark), f"{purpose}-{hashlib.md5(chr(10).join(sorted(told)).encode()).hexdigest()}")


def subfolders(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders right under a path, none where there is no such path."""
    system, place = _place(spark, path)
    return sorted(s.getPath().getName() for s in system.listStatus(place) if s.isDirectory()) if system.exists(place) else []


def materialise(df: DataFrame) -> DataFrame:
    """Cut lineage with a reliable checkpoint, so a lost executor costs no recomputation upstream."""
    shared_folder(df.sparkSession)
    return df.checkpoint(eager=True)
