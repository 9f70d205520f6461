"""Session settings and the shared scratch folder."""

from __future__ import annotations

import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import SparkSession


# Names under which a session's zone is UTC.
UTC_NAMES = ("UTC", "Etc/UTC", "Z", "GMT", "Etc/GMT", "+00:00", "UTC+00:00", "Universal", "Etc/Universal", "Zulu")


# The intermediate tables of each application.
_SCRATCH: dict[str, list[str]] = {}


def require_utc(spark: SparkSession) -> SparkSession:
    """Raise unless the session's zone is UTC: timestamps without a zone are UTC throughout.

    The setting is the caller's; nothing here changes a session.
    """
    zone = spark.conf.get("spark.sql.session.timeZone")
    if zone not in UTC_NAMES:
        raise ValueError(f"spark.sql.session.timeZone must be UTC, not {zone}")
    return spark


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path for an intermediate table, visible to every executor.

    The folder is the one that ``spark.checkpoint.dir`` names; where that is unset, a folder in the
    warehouse of a local session. A cluster must name one that all its machines share, or it raises.
    Tables stay until ``forget_scratch``: what reads them is lazy.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.conf.get("spark.master", "local").startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that the whole cluster shares")
        base = spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_scratch"
    path = f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"
    _SCRATCH.setdefault(spark.sparkContext.applicationId, []).append(path)
    return path


def forget_scratch(spark: SparkSession) -> int:
    """Delete the intermediate tables of this application so far; returns how many there were.

    For when nothing that was made from them will be read again.
    """
    conf, gone = spark._jsc.hadoopConfiguration(), 0
    for path in _SCRATCH.pop(spark.sparkContext.applicationId, []):
        at = spark._jvm.org.apache.hadoop.fs.Path(path)
        gone += at.getFileSystem(conf).delete(at, True)
    return gone


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a file or folder exists on the file system that serves ``path``."""
    try:
        spark.read.text(path).schema
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return False
        raise
    return True


def committed(spark: SparkSession, path: str) -> bool:
    """Whether a writer has finished this folder, or a partition of it."""
    path = path.rstrip("/")
    return path_exists(spark, f"{path}/_SUCCESS") or path_exists(spark, f"{path}/*=*/_SUCCESS")


def readable(spark: SparkSession, path: str) -> bool:
    """Whether an input is there: a file or folder that no writer has left half-written."""
    if not path_exists(spark, path):
        return False
    return committed(spark, path) or not path_exists(spark, f"{path.rstrip('/')}/_temporary")


def publish(spark: SparkSession, staged: str, path: str) -> None:
    """Put a finished folder in the place of ``path``; what was there stays until then, and on failure."""
    if not committed(spark, staged):
        raise ValueError(f"{staged} isn't finished")
    hadoop = spark._jvm.org.apache.hadoop.fs.Path
    source, target, old = hadoop(staged), hadoop(path), hadoop(f"{path.rstrip('/')}-{uuid.uuid4().hex}")
    files = target.getFileSystem(spark._jsc.hadoopConfiguration())
    files.mkdirs(target.getParent())
    replaces = files.exists(target)
    if replaces and not files.rename(target, old):
        raise OSError(f"{path} can't be moved")
    if not files.rename(source, target):
        if replaces:
            files.rename(old, target)
        raise OSError(f"{staged} can't be moved to {path}")
    if replaces:
        files.delete(old, True)
