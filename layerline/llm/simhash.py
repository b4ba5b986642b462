"""Near duplicates by SimHash, found with BK-trees.

Links are pairs of fingerprints that differ in at most ``radius`` of 64 bits.
The bits are cut into ``radius`` + 2 blocks: a linked pair agrees on at least two
of them, so comparing fingerprints that agree on some two blocks finds every
link. Those that agree form a bucket. Each bucket is a shard with a BK-tree of its
own, sent only to the tasks that can hold its neighbours; a tree over all
fingerprints would grow with the data and fit nowhere. A bucket beyond
``shard_rows`` is dealt into several shards, and each pair of its shards is
compared in a task of its own, so no task holds more than two shards.

A shard reports a link from each fingerprint to the smallest one it reaches
within the shard, not all pairs. Components are then joined by repeated star
steps, each written to the shared folder.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import chain, combinations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from layerline.llm.work import Work

BITS = 64
#: Shingles hashed and counted at a time, which bounds memory on very long texts.
SLICE = 65_536


def fingerprint_of(text: str | None, words: int = 3) -> int:
    """Signed, as Spark's long. Lower-cases A to Z; a text of fewer words is one shingle, none gives zero."""
    parts = (text or "").encode().lower().split()
    if not parts:
        return 0
    count = max(1, len(parts) - words + 1)
    ones = np.zeros(BITS, dtype=np.int64)
    for start in range(0, count, SLICE):
        end = min(count, start + SLICE)
        hashes = [xxhash.xxh64_intdigest(b" ".join(parts[i : i + words]), 42) for i in range(start, end)]
        octets = np.array(hashes, dtype="<u8").view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(octets, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(ones * 2 > count, bitorder="little").view("<i8")[0])


def with_fingerprint(docs: DataFrame, text: str, words: int, name: str) -> DataFrame:
    @F.pandas_udf("long")
    def fingerprints(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield pd.Series([fingerprint_of(t, words) for t in texts], dtype="int64")

    return docs.withColumn(name, fingerprints(F.col(text).cast("string")))


class BKTree:
    """Children hang on an edge that bears their distance to the parent."""

    def __init__(self):
        self.values: list[int] = []
        self.edges: list[dict[int, int]] = []

    def add(self, value: int) -> None:
        node, at = len(self.values), 0
        self.values.append(value)
        self.edges.append({})
        while at != node:
            at = self.edges[at].setdefault((self.values[at] ^ value).bit_count(), node)

    def within(self, value: int, radius: int) -> list[int]:
        """Places of the values at most ``radius`` bits away."""
        found, open_nodes = [], [0] if self.values else []
        while open_nodes:
            node = open_nodes.pop()
            distance = (self.values[node] ^ value).bit_count()
            if distance <= radius:
                found.append(node)
            # By the triangle inequality nothing within the radius hangs on another edge.
            edges = self.edges[node]
            if edges:
                low, high = distance - radius, distance + radius
                open_nodes += [child for edge, child in edges.items() if low <= edge <= high]
        return found


def _shard_links(members: np.ndarray, second: np.ndarray, radius: int) -> list[tuple[int, int]]:
    """(fingerprint, smallest reached in the shard). ``second`` marks the shard that probes, if there are two."""
    values = [v & (2**BITS - 1) for v in members.tolist()]
    root = list(range(len(values)))

    def top(i: int) -> int:
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    two = bool(second.any()) and not bool(second.all())
    tree, places = BKTree(), []
    for i in np.argsort(second, kind="stable").tolist():
        if not (two and not second[i]):
            for node in tree.within(values[i], radius):
                a, b = top(i), top(places[node])
                if a != b:
                    small, large = (a, b) if members[a] < members[b] else (b, a)
                    root[large] = small
        if not (two and second[i]):
            tree.add(values[i])
            places.append(i)
    return [(int(members[i]), int(members[top(i)])) for i in range(len(values)) if top(i) != i]


def _linked(batches: Iterator[pd.DataFrame], radius: int) -> Iterator[pd.DataFrame]:
    """Shards follow one another; one that a batch cuts through waits for the rest."""
    columns = ["blocks", "key", "one", "other"]
    rest = None
    for batch in chain(batches, [None]):
        rows = batch if rest is None else rest if batch is None else pd.concat([rest, batch], ignore_index=True)
        if rows is None or not len(rows):
            continue
        keys = rows[columns].to_numpy()
        starts = np.flatnonzero(np.r_[True, (keys[1:] != keys[:-1]).any(axis=1)])
        ends = np.r_[starts[1:], len(rows)]
        whole = len(starts) if batch is None else len(starts) - 1
        prints, second = rows["print"].to_numpy(), rows["second"].to_numpy()
        links = []
        for start, end in zip(starts[:whole].tolist(), ends[:whole].tolist()):
            links += _shard_links(prints[start:end], second[start:end], radius)
        rest = rows.iloc[starts[-1] :] if batch is not None else None
        yield pd.DataFrame(links, columns=["u", "v"], dtype="int64")


def fingerprint_links(work: Work, prints: DataFrame, radius: int, shard_rows: int) -> DataFrame:
    """``prints``: distinct ``print``. Links u, v whose components are those of all pairs within the radius."""
    blocks = radius + 2
    edges = [BITS * i // blocks for i in range(blocks + 1)]
    masks = []
    for a, b in combinations(range(blocks), 2):
        bits = sum(1 << i for x in (a, b) for i in range(edges[x], edges[x + 1]))
        masks.append(bits - 2**BITS if bits >= 2 ** (BITS - 1) else bits)
    kinds = F.array(*[F.struct(F.lit(i).alias("blocks"), F.lit(mask).alias("mask")) for i, mask in enumerate(masks)])
    rows = prints.select("print", F.explode(kinds).alias("kind")).select(
        "kind.blocks", F.col("print").bitwiseAND(F.col("kind.mask")).alias("key"), "print"
    )
    sizes = rows.groupBy("blocks", "key").agg(F.count("*").alias("rows")).where("rows > 1")
    sizes = work.keep(sizes.withColumn("shards", F.ceil(F.col("rows") / shard_rows).cast("int")).drop("rows"), "buckets")
    own = F.pmod(F.xxhash64("print", "blocks"), F.col("shards")).cast("int")
    dealt = (
        rows.join(sizes, ["blocks", "key"])
        .withColumn("own", own)
        .withColumn("with", F.explode(F.sequence(F.lit(0), F.col("shards") - 1)))
        .select(
            "blocks",
            "key",
            F.least("own", "with").alias("one"),
            F.greatest("own", "with").alias("other"),
            (F.col("own") > F.col("with")).alias("second"),
            "print",
        )
    )
    shards = dealt.repartition("blocks", "key", "one", "other").sortWithinPartitions("blocks", "key", "one", "other")
    found = shards.mapInPandas(lambda batches: _linked(batches, radius), "u long, v long")
    return work.keep(found.distinct(), "links")


def components(work: Work, links: DataFrame) -> DataFrame:
    """``links``: u, v. A row per linked node that is not its component's smallest: node, root.

    Large and small star steps by turns, until a round changes nothing.
    """

    def smallest(pairs: DataFrame, of: str, name: str) -> DataFrame:
        return work.keep(pairs.groupBy(of).agg(F.min("v").alias("least")), name)

    links = links.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).where("u <> v")
    links = work.keep(links.distinct(), "edges")
    state = None
    while True:
        both = links.select("u", "v").unionAll(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = smallest(both, "u", "low").select("u", F.least("u", "least").alias("least"))
        large = both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("least").alias("v")).distinct()
        large = work.keep(large, "large-star")
        low = smallest(large, "u", "low")
        small = large.join(low, "u").select(F.col("v").alias("u"), F.col("least").alias("v"))
        small = small.unionAll(low.select("u", F.col("least").alias("v"))).where("u <> v").distinct()
        small = work.keep(small, "small-star")
        work.drop(large, links)
        links = small
        row = links.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if tuple(row) == state:
            return links.select(F.col("u").alias("node"), F.col("v").alias("root"))
        state = tuple(row)


def print_components(prints: DataFrame, *, radius: int = 2, shard_rows: int = 2048) -> DataFrame:
    """``prints``: id, print. A row per distinct fingerprint: print, root, component_id (the component's smallest id)."""
    work = Work(prints.sparkSession, "simhash")
    first = work.keep(prints.groupBy("print").agg(F.min("id").alias("first")), "prints")
    linked = components(work, fingerprint_links(work, first.select("print"), radius, shard_rows))
    rooted = first.join(linked, first["print"] == linked["node"], "left").select(
        "print", "first", F.coalesce("root", "print").alias("root")
    )
    least = work.keep(rooted.groupBy("root").agg(F.min("first").alias("component_id")), "roots")
    return work.keep(rooted.join(least, "root").select("print", "root", "component_id"), "components")


def as_hex(fingerprint: Column) -> Column:
    return F.lower(F.lpad(F.hex(fingerprint), 16, "0"))


def near_duplicates(
    docs: DataFrame,
    *,
    doc_id: str = "doc_id",
    text: str = "text",
    words: int = 3,
    radius: int = 2,
    shard_rows: int = 2048,
) -> DataFrame:
    """A row per document: doc_id, fingerprint (16 hex digits), component_id.

    Fingerprints are linked at ``radius`` or fewer differing bits. Null and empty
    texts, and those of white space, have the fingerprint zero, linked like any
    other. component_id is the smallest id reachable; null ids count for nothing
    there, so a component of null ids only has a null one. Repeated rows each
    come back. Other columns of ``docs`` are not read; no documents give no rows.
    """
    work = Work(docs.sparkSession, "simhash-documents")
    rows = docs.select(F.col(doc_id).alias("id"), F.col(text).alias("text"))
    prints = work.keep(with_fingerprint(rows, "text", words, "print").select("id", "print"), "fingerprints")
    found = print_components(prints, radius=radius, shard_rows=shard_rows)
    return prints.join(found, "print").select(
        F.col("id").alias("doc_id"), as_hex(F.col("print")).alias("fingerprint"), "component_id"
    )


def without_near_duplicates(
    docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", words: int = 3, radius: int = 2
) -> DataFrame:
    """The documents, of each component one: that of the smallest id, null above all others.

    Of rows that repeat this id one stays. Columns and texts are as they were.
    """
    work = Work(docs.sparkSession, "simhash-keep")
    # Rows that repeat id and text share a key; documents are read again instead of kept aside.
    name = F.coalesce(F.col(doc_id).cast("string"), F.lit("no id"))
    key = F.sha2(F.concat(name, F.lit("\n"), F.coalesce(F.col(text), F.lit(""))).cast("binary"), 256)
    rows = docs.select(key.alias("key"), F.col(doc_id).alias("id"), F.col(text).alias("text"))
    rows = work.keep(with_fingerprint(rows, "text", words, "print").drop("text"), "fingerprints")
    found = print_components(rows.select("id", "print"), radius=radius)
    first = F.min(F.struct(F.col("id").isNull().alias("none"), "id", "key"))
    stays = rows.join(found, "print").groupBy("root").agg(first.alias("first"))
    stays = work.keep(stays.select(F.col("first.key").alias("__key")), "stays")
    # Merged at every size: the rows that stay grow with the documents.
    kept = docs.withColumn("__key", key).join(stays.hint("merge"), "__key", "left_semi")
    return kept.dropDuplicates(["__key"]).select(*[F.col(f"`{column}`") for column in docs.columns])
