"""Numbered result folders `<name>=<id>` on any file system the cluster reaches.

A folder counts once its job has left the success marker, so readers never see half a
result. Listing touches folder names only; their number is the number of versions or
batches kept.
"""

from __future__ import annotations

import re
from datetime import UTC, datetime

from pyspark.sql import SparkSession


def _file_system(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())


def finished_since(spark: SparkSession, path: str, name: str) -> dict[int, datetime]:
    """Finished folders under `path`, by ascending id, with the time (UTC) each was finished."""
    p, fs = _file_system(spark, path)
    if not fs.exists(p):
        return {}
    found = {}
    for status in fs.listStatus(p):
        m = re.fullmatch(rf"{name}=(\d+)", status.getPath().getName())
        marker = spark._jvm.org.apache.hadoop.fs.Path(status.getPath(), "_SUCCESS")
        if m and fs.exists(marker):
            at = fs.getFileStatus(marker).getModificationTime() / 1000
            found[int(m.group(1))] = datetime.fromtimestamp(at, UTC).replace(tzinfo=None)
    return dict(sorted(found.items()))


def finished_folders(spark: SparkSession, path: str, name: str) -> list[int]:
    """Ids of the finished folders under `path`, ascending."""
    return list(finished_since(spark, path, name))


def delete_folder(spark: SparkSession, path: str) -> None:
    p, fs = _file_system(spark, path)
    fs.delete(p, True)
