"""Vector code compression: product quantisation by dual-tree Lloyd rounds.

Vectors of integers are cut into equal parts, and each part position has a codebook.
A round assigns every part to the nearest entry of its codebook and replaces each
entry by the mean of its parts, rounded down.

A task takes its vectors batch by batch and builds, for each part position, a tree
over the batch's parts (runs of their Morton order, so that a node is a slice whose
box and sum are known) and one over the entries. Pairs of nodes are refined from the
two roots on; a pair is dropped where the least distance of its boxes exceeds the
largest distance of some other pair of the same node of parts. Where one entry is left,
the node goes to it as a whole, with its cached sum. Leaves where several are left
compare their parts with these, in integers. All bounds are integers too, so the
outcome is that of comparing everything.

Only sums leave a task: one per part position, entry and component, added up over
its batches. They are what the driver gets, as many as the codebooks have numbers.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from layerline.llm.work import Work

#: Parts or entries below a node of the lowest level, and nodes below each of the others.
LEAF, FAN = 16, 4
#: Scaled components from here on are beyond exact sums of squares in 64 bits, and count as not finite.
LARGEST = 2**26


def morton_order(points: np.ndarray) -> np.ndarray:
    """Places in the order of the interleaved leading bits of the components (of the first 31 where there are more)."""
    points = points[:, :31] - points[:, :31].min(axis=0)
    bits = min(16, 62 // points.shape[1])
    down = max(0, int(points.max()).bit_length() - bits)
    code = np.zeros(len(points), np.int64)
    for bit in range(bits - 1, -1, -1):
        for i in range(points.shape[1]):
            code = code << 1 | (points[:, i] >> down + bit & 1)
    return np.argsort(code, kind="stable")


class Tree:
    """Boxes over runs of ordered points: level 0 has runs of ``leaf`` points, each other one runs of FAN nodes."""

    def __init__(self, points: np.ndarray, leaf: int):
        self.points, self.leaf = points, leaf
        starts = np.arange(0, len(points), leaf)
        self.low = [np.minimum.reduceat(points, starts, axis=0)]
        self.high = [np.maximum.reduceat(points, starts, axis=0)]
        while len(self.low[-1]) > 1:
            starts = np.arange(0, len(self.low[-1]), FAN)
            self.low.append(np.minimum.reduceat(self.low[-1], starts, axis=0))
            self.high.append(np.maximum.reduceat(self.high[-1], starts, axis=0))

    def span(self, level: int, nodes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """First and last place (exclusive) of the nodes' points."""
        width = self.leaf * FAN**level
        return nodes * width, np.minimum((nodes + 1) * width, len(self.points))

    def children(self, level: int, nodes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The nodes of the level below, and for each the place of its parent in ``nodes``."""
        first = nodes * FAN
        counts = np.minimum(first + FAN, len(self.low[level - 1])) - first
        parent = np.repeat(np.arange(len(nodes)), counts)
        within = np.arange(len(parent)) - np.repeat(np.cumsum(counts) - counts, counts)
        return first[parent] + within, parent


def assign(points: np.ndarray, book: np.ndarray, sums: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The nearest entry of each point, the lower one of several. Adds the points to ``sums`` and ``counts`` by entry."""
    # Equal entries would never be told apart by distance; the first of them stands for all.
    _, first = np.unique(book, axis=0, return_index=True)
    first = np.sort(first)
    numbers = first[morton_order(book[first])]
    order = morton_order(points)
    parts, entries = Tree(points[order], LEAF), Tree(book[numbers], 1)
    total = np.concatenate([np.zeros((1, points.shape[1]), np.int64), np.cumsum(parts.points, axis=0)])
    codes = np.empty(len(points), np.int64)

    level, depth = len(parts.low) - 1, len(entries.low) - 1
    node = other = np.zeros(1, np.int64)
    while True:
        # Pairs of a node follow one another, so what bounds a node is a reduction over its run.
        low, high = parts.low[level][node], parts.high[level][node]
        their_low, their_high = entries.low[depth][other], entries.high[depth][other]
        least = np.maximum(np.maximum(their_low - high, low - their_high), 0)
        most = np.maximum(their_high - low, high - their_low)
        least, most = (least * least).sum(axis=1), (most * most).sum(axis=1)
        runs = np.flatnonzero(np.r_[True, node[1:] != node[:-1]])
        lengths = np.diff(np.r_[runs, len(node)])
        near = least <= np.repeat(np.minimum.reduceat(most, runs), lengths)
        node, other = node[near], other[near]
        if depth == 0:
            alone = np.r_[True, node[1:] != node[:-1]] & np.r_[node[1:] != node[:-1], True]
            starts, ends = parts.span(level, node[alone])
            found = numbers[other[alone]]
            np.add.at(sums, found, total[ends] - total[starts])
            np.add.at(counts, found, ends - starts)
            codes[_places(starts, ends)] = np.repeat(found, ends - starts)
            node, other = node[~alone], other[~alone]
            if level == 0 or not len(node):
                break
        if depth > 0:
            # The codebook is the smaller tree: refined first, its entries settle large nodes.
            other, parent = entries.children(depth, other)
            node, depth = node[parent], depth - 1
        else:
            node, parent = parts.children(level, node)
            other, level = other[parent], level - 1
            # All pairs of a node are to follow one another.
            together = np.argsort(node, kind="stable")
            node, other = node[together], other[together]
    if len(node):
        starts, ends = parts.span(0, node)
        runs = np.flatnonzero(np.r_[True, node[1:] != node[:-1]])
        lengths = np.diff(np.r_[runs, len(node)])
        places = np.minimum(starts[:, None] + np.arange(LEAF), len(points) - 1)
        gaps = parts.points[places] - entries.points[other][:, None, :]
        distance = (gaps * gaps).sum(axis=2)
        nearest = np.repeat(np.minimum.reduceat(distance, runs, axis=0), lengths, axis=0)
        found = np.where(distance == nearest, numbers[other][:, None], len(book))
        found = np.minimum.reduceat(found, runs, axis=0)
        there = starts[runs][:, None] + np.arange(LEAF) < ends[runs][:, None]
        places, found = places[runs][there], found[there]
        codes[places] = found
        np.add.at(sums, found, parts.points[places])
        np.add.at(counts, found, 1)
    back = np.empty(len(points), np.int64)
    back[order] = codes
    return back


def _places(starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    lengths = ends - starts
    return np.arange(lengths.sum()) + np.repeat(starts - (np.cumsum(lengths) - lengths), lengths)


def _vectors(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy().reshape(len(column), -1)


def book_numbers(books: np.ndarray) -> str:
    """All entries' components by part, entry and place, as decimals parted by commas."""
    return ",".join(str(x) for x in books.ravel().tolist())


def whole_vectors(vectors: DataFrame, vector: str, scale: int) -> DataFrame:
    """The rows whose vector is there, with finite components only, and as ``ints`` the floors of its scaled components."""
    scaled = F.transform(F.col(vector), lambda x: x.cast("double") * F.lit(float(scale)))
    fits = F.forall(scaled, lambda x: F.coalesce(F.abs(x) < LARGEST, F.lit(False)) & ~F.isnan(x))
    found = vectors.where(F.col(vector).isNotNull() & fits)
    return found.select("*", F.transform(scaled, lambda x: F.floor(x).cast("int")).alias("ints")).drop(vector)


def compress_vectors(
    vectors: DataFrame,
    *,
    vec_id: str = "vec_id",
    vector: str = "embedding",
    label: str = "label",
    parts: int = 16,
    entries: int = 64,
    rounds: int = 2,
    scale: int = 256,
) -> DataFrame:
    """A row per encoded vector: vec_id, code, error, label_error, codebooks_sha256.

    Rows whose vector is null or holds null or non-finite components are dropped,
    as are components of 2**26 and more after scaling. The codebooks start with the
    vectors of the smallest ids (null ids last, ties by the vectors); with fewer
    vectors than ``entries`` they have as many. All vectors have the length of the first
    of these, in equal parts; rows of another length cannot be encoded and are dropped,
    and where that length is not a multiple of ``parts`` it is refused. Repeated rows
    and ids each come back. No vectors give no rows. Other columns are not read.
    """
    if entries > 256:
        raise ValueError("an index is written as two hex digits, so a codebook has at most 256 entries")
    work = Work(vectors.sparkSession, "vector-codes")
    rows = vectors.select(F.col(vec_id).alias("id"), F.col(label).alias("label"), F.col(vector).alias("vector"))
    rows = work.keep(whole_vectors(rows, "vector", scale).where(F.size("ints") > 0), "ints")
    start = rows.orderBy(F.asc_nulls_last("id"), "ints").limit(entries).select("ints").collect()
    length = len(start[0].ints) if start else parts
    if length % parts:
        raise ValueError(f"vectors of {length} components cannot be cut into {parts} equal parts")
    books = np.array([row.ints for row in start if len(row.ints) == length], np.int64)
    books = books.reshape(-1, parts, length // parts).transpose(1, 0, 2)
    rows = rows.where(F.size("ints") == length)

    for _ in range(rounds if start else 0):
        books = _next_books(rows, books)
    coded = work.keep(_encoded(rows, books), "codes")
    # Sums of a label are made in each task first; they meet their rows by the label, nulls too.
    sums = coded.groupBy(F.col("label").alias("of")).agg(F.sum("error").alias("label_error"))
    digest = hashlib.sha256(book_numbers(books).encode()).hexdigest()
    return coded.join(sums, coded["label"].eqNullSafe(sums["of"])).select(
        F.col("id").alias("vec_id"), "code", "error", "label_error", F.lit(digest).alias("codebooks_sha256")
    )


def _next_books(rows: DataFrame, books: np.ndarray) -> np.ndarray:
    parts, entries, width = books.shape
    schema = pa.schema([("place", pa.int32()), ("n", pa.int64()), ("total", pa.int64())])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums, counts = np.zeros(books.shape, np.int64), np.zeros(books.shape[:2], np.int64)
        for batch in batches:
            if batch.num_rows:
                points = _vectors(batch.column(0)).astype(np.int64).reshape(-1, parts, width)
                for i in range(parts):
                    assign(np.ascontiguousarray(points[:, i]), books[i], sums[i], counts[i])
        used = np.flatnonzero(np.repeat(counts.ravel(), width))
        columns = [used, np.repeat(counts.ravel(), width)[used], sums.ravel()[used]]
        yield pa.record_batch([pa.array(x, t) for x, t in zip(columns, schema.types)], schema=schema)

    found = rows.select("ints").mapInArrow(add, "place int, n long, total long")
    found = found.groupBy("place").agg(F.sum("n").alias("n"), F.sum("total").alias("total"))
    new = books.copy().ravel()
    # One row per number of the codebooks at most.
    for place, n, total in found.collect():
        new[place] = total // n
    return new.reshape(books.shape)


def _encoded(rows: DataFrame, books: np.ndarray) -> DataFrame:
    parts, _, width = books.shape
    types = [rows.schema[name].dataType for name in ("id", "label")]
    schema = pa.schema(
        [("id", to_arrow_type(types[0])), ("label", to_arrow_type(types[1])), ("code", pa.string()), ("error", pa.int64())]
    )

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            points = _vectors(batch.column(2)).astype(np.int64).reshape(-1, parts, width)
            codes = np.empty(points.shape[:2], np.uint8)
            error = np.zeros(len(points), np.int64)
            for i in range(parts):
                own = np.ascontiguousarray(points[:, i])
                found = assign(own, books[i], np.zeros_like(books[i]), np.zeros(len(books[i]), np.int64))
                gap = own - books[i][found]
                error += (gap * gap).sum(axis=1)
                codes[:, i] = found
            written = codes.tobytes().hex()
            step = 2 * parts
            texts = [written[at : at + step] for at in range(0, len(written), step)]
            yield pa.record_batch(
                [batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array(error, pa.int64())], schema=schema
            )

    spelled = ", ".join(f"{name} {kind.simpleString()}" for name, kind in zip(("id", "label"), types))
    return rows.select("id", "label", "ints").mapInArrow(encode, f"{spelled}, code string, error long")
