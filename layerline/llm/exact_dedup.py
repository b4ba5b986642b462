"""Exact duplicates by block naming.

A text's bytes are cut into blocks of a fixed size. Distinct blocks are sorted
and numbered, so that a number names one content. Adjacent names form pairs,
distinct pairs are sorted and numbered in turn, and so on until every document
has one name. Two texts are equal if and only if they end on the same level with
the same name: names stand for contents, not for hashes of them.

Blocks are sorted within hash partitions, not over the whole table: a name is the
partition and the place in it. Only distinct blocks are shuffled as bytes, once.
To find the names of its blocks again a document sends their hashes; where two
different blocks share a hash, those are looked up by content.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from layerline.llm.work import Work

#: The right half of the last pair where the number of names is odd. Names are never negative but from -2 down.
NO_NAME = -1


def _numbered(distinct: DataFrame, *by: str) -> DataFrame:
    return distinct.sortWithinPartitions(*by).withColumn("name", F.monotonically_increasing_id())


def _block_names(
    work: Work, docs: DataFrame, text: Column, id_col: str, block_bytes: int, block_hash: Callable
) -> DataFrame:
    """A row per block of each document: row, pos, n (blocks), name; at pos 0 also id and sha256 of the text."""
    last = F.greatest(F.lit(0), F.ceil(F.length(text) / block_bytes).cast("int") - 1)
    blocks = F.transform(
        F.sequence(F.lit(0), last), lambda i: F.substring(text, i * block_bytes + 1, F.lit(block_bytes))
    )
    distinct = docs.select(F.explode(blocks).alias("block")).select(block_hash(F.col("block")).alias("hash"), "block")
    distinct = distinct.select("hash", "block").distinct()
    names = work.keep(_numbered(distinct, "hash", "block").select("hash", "name"), "block-names")
    by_hash = work.keep(names.groupBy("hash").agg(F.min("name").alias("name"), F.count("*").alias("blocks")), "hashes")
    work.drop(names)

    shared = by_hash.where(F.col("blocks") > 1).select("hash")
    by_content = None
    if not shared.isEmpty():
        distinct = distinct.join(shared, "hash", "left_semi")
        numbered = _numbered(distinct, "hash", "block").withColumn("other", -F.col("name") - 2).drop("name")
        by_content = work.keep(numbered, "blocks-of-shared-hashes")

    # Column values are read once, in one evaluation: the row numbers never have to be found again.
    rows = docs.select(
        F.monotonically_increasing_id().alias("row"),
        F.col(id_col).alias("id"),
        F.sha2(text, 256).alias("sha256"),
        (last + 1).alias("n"),
        F.transform(
            blocks,
            lambda b: F.struct(block_hash(b).alias("hash"), *([b.alias("block")] if by_content is not None else [])),
        ).alias("blocks"),
    )
    rows = rows.select("row", "id", "sha256", "n", F.posexplode("blocks").alias("pos", "of")).select(
        "row", "n", "pos", "of.*", *[F.when(F.col("pos") == 0, F.col(c)).alias(c) for c in ("id", "sha256")]
    )
    name = F.col("name")
    named = rows.join(by_hash.where(F.col("blocks") == 1).drop("blocks") if by_content is not None else by_hash, "hash", "left")
    if by_content is not None:
        named = named.join(by_content, ["hash", "block"], "left")
        name = F.coalesce("name", "other")
    return work.keep(named.select("row", "pos", "n", name.alias("name"), "id", "sha256"), "names-0")


def name_documents(
    docs: DataFrame,
    *,
    doc_id: str = "doc_id",
    text: str = "text",
    block_bytes: int = 4096,
    block_hash: Callable[[Column], Column] = F.xxhash64,
) -> DataFrame:
    """A row per document: row, id, sha256, level, name; equal texts, and no others, share level and name."""
    work = Work(docs.sparkSession, "exact-dedup")
    content = F.coalesce(F.col(text).cast("string").cast("binary"), F.lit(b""))
    names = _block_names(work, docs, content, doc_id, block_bytes, block_hash)
    most = names.agg(F.max("n")).first()[0] or 1
    ended = []
    for level in range(math.ceil(math.log2(most)) + 1):
        ended.append(names.where("n = 1").select("row", "id", "sha256", F.lit(level).alias("level"), "name"))
        if 2**level >= most:
            break
        left = F.max(F.when(F.col("pos") % 2 == 0, F.col("name")))
        right = F.coalesce(F.max(F.when(F.col("pos") % 2 == 1, F.col("name"))), F.lit(NO_NAME))
        pairs = (
            names.where("n > 1")
            .groupBy("row", F.floor(F.col("pos") / 2).alias("half"))
            .agg(
                left.alias("left"),
                right.alias("right"),
                F.ceil(F.max("n") / 2).cast("int").alias("n"),
                F.max("id").alias("id"),
                F.max("sha256").alias("sha256"),
            )
        )
        distinct = pairs.select("left", "right").distinct()
        numbers = work.keep(_numbered(distinct, "left", "right"), f"pair-names-{level + 1}")
        named = pairs.join(numbers, ["left", "right"])
        names = named.select("row", F.col("half").alias("pos"), "n", "name", "id", "sha256")
        names = work.keep(names, f"names-{level + 1}")
    all_ended = ended[0]
    for more in ended[1:]:
        all_ended = all_ended.unionByName(more)
    return work.keep(all_ended, "documents")


def exact_duplicates(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", **more) -> DataFrame:
    """A row per document: doc_id, keep_id, group_size, kept, text_sha256, level, name.

    Of equal texts the row with the largest id stays, of rows that repeat this
    id one. A null text equals an empty one. A null id is below all others:
    such a row stays only where all ids of its group are null, and then one does.
    Other columns of ``docs`` are not read; no documents give no rows.
    """
    named = name_documents(docs, doc_id=doc_id, text=text, **more)
    last = F.max(F.struct("id", "row"))
    groups = named.groupBy("level", "name").agg(last.alias("last"), F.count("*").alias("group_size"))
    groups = Work(docs.sparkSession, "exact-groups").keep(groups, "groups")
    return named.join(groups, ["level", "name"]).select(
        F.col("id").alias("doc_id"),
        F.col("last.id").alias("keep_id"),
        "group_size",
        (F.col("row") == F.col("last.row")).alias("kept"),
        F.col("sha256").alias("text_sha256"),
        "level",
        "name",
    )
