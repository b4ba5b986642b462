"""Keeping what a stream of files remembers bounded.

Spark's log of files taken only ever grows, and each run reads all of it into the
driver. Files that are no longer where they arrived need not be remembered, so
after a run the files it took are moved to an archive, and once the log has enough
names the next run begins with an empty one, in a checkpoint of its own: the next
generation. A file is known by its place, so one that arrives under a name used in
an earlier generation is new, and no date is too old.

A generation ends only after a run that committed all it took, with every file of its log
moved away; a run that fails is taken up again in the same generation.
"""

from __future__ import annotations

from typing import NamedTuple
from urllib.parse import unquote, urlsplit

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from layerline.sources.folders import folder_entries, make_folder, move, remove_folder

_PREFIX = "generation-"


class Generation(NamedTuple):
    number: int
    checkpoint: str


def open_generation(spark: SparkSession, checkpoint: str) -> Generation:
    """The latest one. What is left of those before it is removed."""
    numbers = [
        int(name.removeprefix(_PREFIX)) for name in folder_entries(spark, checkpoint) if name.startswith(_PREFIX)
    ]
    latest = max(numbers, default=0)
    for number in numbers:
        if number < latest:
            remove_folder(spark, _folder(checkpoint, number))
    return Generation(latest, _folder(checkpoint, latest))


def archive_taken(spark: SparkSession, checkpoint: str, generation: Generation, archive: str, log_files: int) -> int:
    """Move the files in the log to the archive; return how many there were to move.

    For a generation whose stream has ended well. Files keep their path below the archive, in a folder
    of the generation.
    """
    taken = taken_files(spark, generation.checkpoint)
    if taken is None:
        return 0
    folders = [row.folder for row in taken.select(F.regexp_replace("file", "/[^/]*$", "").alias("folder")).distinct().collect()]
    here = spark.read.format("binaryFile").load([*map(_plain, folders)]) if folders else None
    moved = 0
    if here is not None:
        # Listed, not opened; what is left here of the log is what this run took, and what an earlier one did not move.
        # Where there is no host, a listing leaves out the slashes that the log has.
        file = F.regexp_replace("_metadata.file_path", "^([^:/]+):/([^/])", "$1:///$2").alias("file")
        left = here.select(file).join(taken, "file", "left_semi")
        for (file,) in left.collect():
            below = urlsplit(file).path
            move(spark, _plain(file), f"{archive}/{_PREFIX}{generation.number:06d}{_plain(below)}")
            moved += 1
    if taken.count() >= log_files:
        make_folder(spark, _folder(checkpoint, generation.number + 1))
        remove_folder(spark, generation.checkpoint)
    return moved


def taken_files(spark: SparkSession, checkpoint: str) -> DataFrame | None:
    """``file``: each one in the log of the stream's sources, as Spark spells it; None where it has no log yet."""
    sources = folder_entries(spark, f"{checkpoint}/sources")
    if not sources:
        return None
    lines = spark.read.text([f"{checkpoint}/sources/{name}" for name in sources])
    file = F.get_json_object("value", "$.path").alias("file")
    return lines.where(F.col("value").startswith("{")).select(file).where("file IS NOT NULL").distinct()


def _folder(checkpoint: str, number: int) -> str:
    return f"{checkpoint}/{_PREFIX}{number:06d}"


def _plain(uri: str) -> str:
    """A path as Spark takes it, from the spelling with escapes."""
    return unquote(uri)
