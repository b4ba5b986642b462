"""Overwriting a location by swapping directories, so that a failed write leaves the old rows.

Spark's overwrite deletes first and then writes. Here the rows are written next to the
location, under a hidden name, and two renames put them in its place:

    1. .location.new    ->  .location.ready   once all rows are written
    2. location         ->  .location.old
    3. .location.ready  ->  location
    4. .location.old is deleted

A run that ends before 2 leaves the old rows, after 3 the new ones. Between the two
there is no location for the moment that a rename takes; a run that ends right there
is made good by ``recover``, at the next write and before each read through the library.
On object stores a rename copies, so there this is neither quick nor atomic.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

from layerline.sources.folders import folder_exists, move, remove_folder


def _beside(location: str) -> tuple[str, str, str]:
    parent, _, name = location.rstrip("/").rpartition("/")
    # Names that begin with a dot are hidden from readers of the parent, also those with a '='.
    return f"{parent}/.{name}.new", f"{parent}/.{name}.ready", f"{parent}/.{name}.old"


def recover(spark: SparkSession, location: str) -> None:
    """Finish a swap that was cut short between its two renames."""
    _, ready, old = _beside(location)
    if not folder_exists(spark, location):
        for folder in (ready, old):
            if folder_exists(spark, folder):
                return move(spark, folder, location)


@contextmanager
def swapped(spark: SparkSession, location: str) -> Iterator[str]:
    """A folder to write to, which takes the location's place when the block ends without an error."""
    new, ready, old = _beside(location)
    recover(spark, location)
    # Left by an earlier run: rows that did not get into place before it ended, and rows that were replaced.
    for folder in (new, ready, old):
        remove_folder(spark, folder)
    yield new
    move(spark, new, ready)
    if folder_exists(spark, location):
        move(spark, location, old)
    move(spark, ready, location)
    remove_folder(spark, old)
