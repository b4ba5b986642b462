"""Folders, on whatever file system Spark reaches them."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession


#: For a session that was started without ``spark.checkpoint.dir``, which cannot be set later.
STAGING_SETTING = "spark.layerline.staging.dir"


def staging_folder(spark: SparkSession, label: str) -> str:
    """A new folder under ``spark.checkpoint.dir``, which all executors share.

    Where that is not set, under ``spark.layerline.staging.dir``. No folder is made
    up: executors of a cluster cannot read one of the driver's machine.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get(STAGING_SETTING, None)
    if not shared:
        raise RuntimeError(f"set spark.checkpoint.dir, or {STAGING_SETTING}, to a folder that all executors share")
    folder = f"{shared.rstrip('/')}/layerline-{label}-{uuid.uuid4().hex}"
    # Staged copies are as large as their tables, so they go when the application ends.
    files, path = _hadoop(spark, folder)
    files.mkdirs(path)
    files.deleteOnExit(path)
    return folder


def remove_folder(spark: SparkSession, folder: str) -> None:
    files, path = _hadoop(spark, folder)
    files.delete(path, True)


def full_location(spark: SparkSession, folder: str) -> str:
    """The folder with its file system and without detours, so that two spellings of it compare equal."""
    files, path = _hadoop(spark, folder)
    place = files.makeQualified(path).toUri().normalize()
    return f"{place.getScheme()}://{place.getAuthority() or ''}{place.getPath().rstrip('/')}"


def folder_exists(spark: SparkSession, folder: str) -> bool:
    files, path = _hadoop(spark, folder)
    return files.exists(path)


def make_folder(spark: SparkSession, folder: str) -> None:
    files, path = _hadoop(spark, folder)
    files.mkdirs(path)


def move(spark: SparkSession, source: str, target: str) -> None:
    """Rename a file or folder to a name that is not taken, in a folder that is made where it is absent."""
    files, path = _hadoop(spark, source)
    there = _hadoop(spark, target)[1]
    files.mkdirs(there.getParent())
    # Renaming a folder to one that exists would put it inside.
    if files.exists(there) or not files.rename(path, there):
        raise OSError(f"{source} cannot be moved to {target}")


def folder_entries(spark: SparkSession, folder: str) -> list[str]:
    """Names in the folder itself, in order; none where it is absent."""
    files, path = _hadoop(spark, folder)
    return sorted(one.getPath().getName() for one in files.listStatus(path)) if files.exists(path) else []


def data_files(spark: SparkSession, folder: str) -> list[str]:
    """Files below the folder that hold rows, as paths relative to it."""
    files, path = _hadoop(spark, folder)
    root, found, listed = files.makeQualified(path).toUri(), [], files.listFiles(path, True)
    while listed.hasNext():
        one = listed.next().getPath()
        if not one.getName().startswith(("_", ".")):
            found.append(root.relativize(one.toUri()).getPath())
    return sorted(found)


def leave_mark(spark: SparkSession, file: str) -> None:
    """An empty file, whose name says it all."""
    files, path = _hadoop(spark, file)
    files.create(path, True).close()


def _hadoop(spark: SparkSession, folder: str):
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    return path.getFileSystem(spark._jsc.hadoopConfiguration()), path
