"""Files through Arrow's file systems, the same way from the driver and from tasks."""

from __future__ import annotations

import os
from collections.abc import Iterator
from fnmatch import fnmatch

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def located(path: str) -> tuple[fs.FileSystem, str]:
    """The file system of a path or URI, and the path in it."""
    if path.startswith("file:"):
        path = "/" + path[len("file:") :].lstrip("/")
    if "://" in path:
        return fs.FileSystem.from_uri(path)
    return fs.LocalFileSystem(), path


def listed(path: str) -> list[tuple[str, int]]:
    """(path, bytes) of a file, of the files in a folder or of those that a pattern names, by name; none where nothing is.

    Names that begin with a dot or underscore are left out, as Spark's readers do.
    """
    system, place = located(path)
    info = system.get_file_info(place)
    if info.type == fs.FileType.File:
        return [(place, info.size)]
    folder, name = (place, "*") if info.type == fs.FileType.Directory else place.rsplit("/", 1)
    if "*" in folder or system.get_file_info(folder).type != fs.FileType.Directory:
        return []
    found = [f for f in system.get_file_info(fs.FileSelector(folder)) if f.type == fs.FileType.File]
    return sorted((f.path, f.size) for f in found if fnmatch(f.base_name, name) and f.base_name[0] not in "._")


def write_placed(df: DataFrame, path: str) -> None:
    """One file from rows (at, value): each task writes its values at their places, so the order of tasks is all the same.

    Places follow each other without gaps. The file takes its name when all is written; a task run again writes the
    same bytes. It needs a file system on which files can be written at any place, such as a shared mount.
    """
    system, place = located(path)
    if not isinstance(system, fs.LocalFileSystem):
        raise ValueError("files can be written in parts only on a mounted file system")
    size = F.octet_length("value")
    total = df.agg(F.coalesce(F.max(F.col("at") + size), F.lit(0)).alias("n")).first()["n"]
    os.makedirs(os.path.dirname(place), exist_ok=True)
    part = f"{place}.part"
    with open(part, "wb") as out:
        out.truncate(total)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with open(part, "r+b") as out:
            for batch in batches:
                for at, value in zip(batch.column("at").to_pylist(), batch.column("value").to_pylist()):
                    out.seek(at)
                    out.write(value)
                yield pa.RecordBatch.from_arrays([pa.array([batch.num_rows], pa.int64())], ["n"])

    df.select(F.col("at").cast("long").alias("at"), F.col("value").cast("binary").alias("value")).mapInArrow(write, "n long").agg(F.sum("n")).collect()
    os.replace(part, place)
