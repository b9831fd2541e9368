"""Versioned folders with a commit log: replacing a published table safely
(SURVEY S12, S13, M7).

``path/v=<n>/`` holds version n, ``path/_commits/<n>`` says that it is
complete.  A writer fills a new folder first and commits it last, so readers,
who follow the highest commit, see the old version until the new one is
whole; a writer that dies leaves the published one as it was.  A commit file
appears by one rename, and never twice: of two writers of one version the
second fails.  The last ``keep`` versions stay, for readers that are still
at work on them."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import SparkSession

COMMITS = "_commits"


def _file(spark: SparkSession, path: str):
    """Hadoop path and its file system."""
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return at, at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def names(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder, none if it is absent."""
    at, fs = _file(spark, path)
    return sorted(s.getPath().getName() for s in fs.listStatus(at)) if fs.exists(at) else []


def is_folder(spark: SparkSession, path: str) -> bool:
    at, fs = _file(spark, path)
    return fs.getFileStatus(at).isDirectory()


def remove(spark: SparkSession, path: str) -> None:
    at, fs = _file(spark, path)
    fs.delete(at, True)


def put_text(spark: SparkSession, path: str, text: str) -> bool:
    """Create a small file by one rename; False if there is one already."""
    at, fs = _file(spark, path)
    if fs.exists(at):
        return False
    temporary, _ = _file(spark, f"{at.getParent()}/.{uuid.uuid4().hex}")
    out = fs.create(temporary, False)
    out.write(bytearray(text.encode()))
    out.close()
    if fs.rename(temporary, at):
        return True
    fs.delete(temporary, False)
    return False


def get_text(spark: SparkSession, path: str) -> str | None:
    """Content of a small file, None if it is absent."""
    at, fs = _file(spark, path)
    if not fs.exists(at):
        return None
    source = fs.open(at)
    try:
        return bytes(spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toByteArray(source)).decode()
    finally:
        source.close()


def committed(spark: SparkSession, path: str) -> list[int]:
    """All committed versions, oldest first."""
    return sorted(int(n) for n in names(spark, f"{path}/{COMMITS}") if n.isdigit())


def current_path(spark: SparkSession, path: str) -> str:
    """Folder of the newest version; ``path`` itself if it has no versions."""
    done = committed(spark, path)
    return f"{path}/v={done[-1]}" if done else path


def commit_version(spark: SparkSession, path: str, write: Callable[[str], None],
                   version: int | None = None, keep: int = 2) -> int:
    """Let ``write(folder)`` fill a new version and publish it.  ``version``:
    a number of the caller's (a stream's batch id); one that is committed
    already stays as it is, so a replayed batch changes nothing."""
    done = committed(spark, path)
    if version is None:
        begun = [int(n[2:]) for n in names(spark, path) if n.startswith("v=")]
        version = max([-1, *done, *begun]) + 1
    elif version in done:
        return version
    else:
        remove(spark, f"{path}/v={version}")  # of a writer that died
    write(f"{path}/v={version}")
    if not put_text(spark, f"{path}/{COMMITS}/{version}", ""):
        raise RuntimeError(f"version {version} of {path} was committed by another writer")
    for old in sorted({*done, version})[:-keep] if keep else []:
        remove(spark, f"{path}/{COMMITS}/{old}")
        remove(spark, f"{path}/v={old}")
    return version
