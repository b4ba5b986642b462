"""Near duplicates among embeddings: an epsilon grid order join.

Unit vectors with a cosine of at least the threshold are at most epsilon apart. The
vectors are sorted by the cells of an epsilon grid on their leading principal
directions, which puts cells in lexicographic order, and the sequence is cut into
blocks. Blocks are joined as a sequence of intervals, each the union of up to FAN
shorter ones: a pair of intervals is refined into the pairs of its parts unless it is
settled as a whole. Boxes in the principal directions and balls in all of them say
that two intervals are provably distant, which drops the pair, or provably within
epsilon, which counts and links them without looking at a vector. So a third of all
vectors in one spot costs little more than the same number apart. What is left
at the level of blocks is compared in tasks of one block and a few others, again
by shorter intervals, with products in single precision and in double precision
wherever these come near the threshold.

A task gives a number of links per vector and, for each vector that is linked, one link
to the smallest it reaches among the two blocks, never all pairs.

Principal directions are fitted on a bounded sample. They decide how much is
skipped, not what is found: any directions give the same links.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from math import ceil, sqrt

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from layerline.llm.simhash import components
from layerline.llm.work import Work

#: Intervals that form one of the next level.
FAN = 16
#: Vectors of the shortest intervals, those that a task compares as a whole.
SHORT = 256
#: Bounds are trusted to be this much off, which is far more than rounding makes them.
SURE = 1e-7


def with_units(vectors: DataFrame, length: int) -> DataFrame:
    """``row``, ``id``, ``vector`` (doubles) to row, id, ``unit``: its octets, with zeros up to ``length``.

    NULL where the vector is null, zero or not finite throughout.
    """
    id_type = vectors.schema["id"].dataType
    schema = pa.schema([("row", pa.int64()), ("id", to_arrow_type(id_type)), ("unit", pa.binary())])

    def scaled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(2)
            spans = lists.value_lengths().fill_null(0).to_numpy()
            x = np.zeros((len(lists), length))
            within = np.arange(spans.sum()) - np.repeat(np.cumsum(spans) - spans, spans)
            # Null components become NaN here.
            x[np.repeat(np.arange(len(lists)), spans), within] = lists.flatten().to_numpy(zero_copy_only=False)
            peak = np.abs(x).max(axis=1, initial=0)
            good = np.isfinite(peak) & (peak > 0)
            x = x[good] / peak[good, None]
            x /= np.sqrt((x * x).sum(axis=1))[:, None]
            units = np.full(len(lists), None)
            units[good] = [one.tobytes() for one in x]
            yield pa.record_batch([batch.column(0), batch.column(1), pa.array(units, pa.binary())], schema=schema)

    return vectors.mapInArrow(scaled, f"row long, id {id_type.simpleString()}, unit binary")


def principal_directions(units: DataFrame, lead: int, sample_bytes: int) -> np.ndarray:
    """As columns, those in which a sample of at most ``sample_bytes`` varies most; the sample is the smallest hashes."""
    first = units.select("unit").first()
    if first is None:
        return np.zeros((1, 1))
    rows = max(1, min(4096, sample_bytes // len(first.unit)))
    sample = units.select("unit").orderBy(F.xxhash64("unit"), "unit").limit(rows).collect()
    points = np.stack([np.frombuffer(row.unit) for row in sample])
    _, _, directions = np.linalg.svd(points - points.mean(axis=0), full_matrices=False)
    return np.ascontiguousarray(directions[:lead].T)


class Intervals:
    """Balls in all and boxes in the leading directions, one per interval."""

    def __init__(self, centre: np.ndarray, radius: np.ndarray, low: np.ndarray, high: np.ndarray):
        self.centre, self.radius, self.low, self.high = centre, radius, low, high

    @classmethod
    def over(cls, vectors: np.ndarray, directions: np.ndarray, length: int) -> Intervals:
        starts = np.arange(0, len(vectors), length)
        counts = np.diff(np.r_[starts, len(vectors)])
        centre = np.add.reduceat(vectors, starts, axis=0) / counts[:, None]
        away = np.sqrt(((vectors - np.repeat(centre, counts, axis=0)) ** 2).sum(axis=1))
        leading = vectors @ directions
        return cls(
            centre,
            np.maximum.reduceat(away, starts),
            np.minimum.reduceat(leading, starts, axis=0),
            np.maximum.reduceat(leading, starts, axis=0),
        )

    def joined(self) -> Intervals:
        """The interval of all of them."""
        centre = self.centre.mean(axis=0)
        away = np.sqrt(((self.centre - centre) ** 2).sum(axis=1)) + self.radius
        return Intervals(centre[None], away.max()[None], self.low.min(axis=0)[None], self.high.max(axis=0)[None])

    def to_bytes(self, i: int = 0) -> bytes:
        return np.concatenate([self.radius[[i]], self.low[i], self.high[i], self.centre[i]]).tobytes()

    @classmethod
    def from_bytes(cls, many: list[bytes], lead: int) -> Intervals:
        x = np.frombuffer(b"".join(many)).reshape(len(many), -1)
        return cls(x[:, 1 + 2 * lead :], x[:, 0], x[:, 1 : 1 + lead], x[:, 1 + lead : 1 + 2 * lead])

    def settled(self, other: Intervals, epsilon: float) -> tuple[np.ndarray, np.ndarray]:
        """Which pairs are provably distant, and which provably within epsilon. The two are compared by broadcasting."""
        between = np.sqrt(((self.centre - other.centre) ** 2).sum(axis=-1))
        reach = self.radius + other.radius
        gap = np.maximum(np.maximum(other.low - self.high, self.low - other.high), 0)
        distant = (between - reach > epsilon + SURE) | (np.sqrt((gap**2).sum(axis=-1)) > epsilon + SURE)
        return distant, between + reach < epsilon - SURE

    def as_rows(self) -> Intervals:
        return Intervals(self.centre[:, None], self.radius[:, None], self.low[:, None], self.high[:, None])


def unite(root: np.ndarray, one: np.ndarray, other: np.ndarray) -> None:
    """Joins the sets that hold ``one[i]`` and ``other[i]``; each member of ``root`` leads to its set's smallest."""
    while True:
        a, b = root[one], root[other]
        apart = a != b
        if not apart.any():
            return
        one, other, a, b = one[apart], other[apart], a[apart], b[apart]
        np.minimum.at(root, np.maximum(a, b), np.minimum(a, b))
        while (root[root] != root).any():
            root[:] = root[root]


class Block:
    """Vectors of one block, in short intervals."""

    def __init__(self, rows: np.ndarray, vectors: np.ndarray, directions: np.ndarray):
        self.rows, self.vectors, self.single = rows, vectors, vectors.astype(np.float32)
        self.intervals = Intervals.over(self.vectors, directions, SHORT)
        self.starts = range(0, len(rows), SHORT)


def block_links(a: Block, b: Block, threshold: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Links of each vector of ``a``, of ``b`` (within one block, all in the first, itself included), and the sets
    they form, over the vectors of ``a`` and then those of ``b``."""
    same, epsilon = a is b, sqrt(max(0.0, 2 - 2 * threshold))
    counts, theirs = np.zeros(len(a.rows), np.int64), np.zeros(len(b.rows), np.int64)
    shift = 0 if same else len(a.rows)
    root = np.arange(len(a.rows) if same else len(a.rows) + len(b.rows))
    doubt = a.vectors.shape[1] * 1.2e-7 + 1e-6
    distant, within = a.intervals.as_rows().settled(b.intervals, epsilon)
    for p, q in np.argwhere(~distant):
        if same and q < p:
            continue
        i, j = a.starts[p], b.starts[q]
        width, height = min(SHORT, len(a.rows) - i), min(SHORT, len(b.rows) - j)
        if within[p, q]:
            counts[i : i + width] += height
            if not (same and p == q):
                theirs[j : j + height] += width
            members = np.r_[np.arange(i, i + width), np.arange(j + shift, j + shift + height)]
            unite(root, members, np.full_like(members, i))
            continue
        products = a.single[i : i + width] @ b.single[j : j + height].T
        x, y = np.nonzero(products >= threshold - doubt)
        unsure = np.flatnonzero(products[x, y] < threshold + doubt)
        linked = np.ones(len(x), bool)
        linked[unsure] = (a.vectors[i + x[unsure]] * b.vectors[j + y[unsure]]).sum(axis=1) >= threshold
        x, y = x[linked], y[linked]
        if len(x):
            counts[i : i + width] += np.bincount(x, minlength=width)
            if not (same and p == q):
                theirs[j : j + height] += np.bincount(y, minlength=height)
            unite(root, i + x, j + y + shift)
    return counts, theirs, root


def _numpy(column: pa.Array) -> np.ndarray:
    return column.to_numpy(zero_copy_only=False)


def _matrix(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist())).reshape(len(column), -1)


def _blocks(work: Work, units: DataFrame, directions: np.ndarray, epsilon: float, block_rows: int) -> DataFrame:
    """The vectors in grid order (row, part, block, place, vector) and, where row is NULL, their blocks' extent, size and smallest row."""
    schema = pa.schema(
        [("row", pa.int64()), ("part", pa.int32()), ("block", pa.int64()), ("place", pa.int32()), ("vector", pa.binary())]
        + [("n", pa.int64()), ("least", pa.int64())]
    )
    grid = pa.schema([("row", pa.int64()), ("vector", pa.binary()), ("cells", pa.list_(pa.int32()))])

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                cells = np.floor(_matrix(batch.column(1)) @ directions / epsilon).astype(np.int32)
                yield pa.record_batch([*batch.columns, pa.array(list(cells), grid.types[2])], schema=grid)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, block, held = TaskContext.get().partitionId(), 0, []

        def closed(rows: pa.Table) -> Iterator[pa.RecordBatch]:
            count = rows.num_rows
            vectors = rows.column("vector").combine_chunks()
            ids = rows.column("row").combine_chunks()
            extent = Intervals.over(_matrix(vectors), directions, count).to_bytes()
            least = int(_numpy(ids).min())
            columns = [
                pa.concat_arrays([ids, pa.nulls(1, pa.int64())]),
                pa.array([part] * (count + 1), pa.int32()),
                pa.array([block] * (count + 1), pa.int64()),
                pa.array(range(count + 1), pa.int32()),
                pa.concat_arrays([vectors, pa.array([extent], pa.binary())]),
                pa.array([None] * count + [count], pa.int64()),
                pa.array([None] * count + [least], pa.int64()),
            ]
            yield pa.record_batch(columns, schema=schema)

        for batch in batches:
            held.append(batch)
            while sum(one.num_rows for one in held) >= block_rows:
                rows = pa.Table.from_batches(held)
                yield from closed(rows.slice(0, block_rows))
                block, held = block + 1, rows.slice(block_rows).to_batches()
        if rows := sum(one.num_rows for one in held):
            yield from closed(pa.Table.from_batches(held))

    placed = units.select("row", "unit").mapInArrow(place, "row long, vector binary, cells array<int>")
    placed = placed.withColumn("spot", F.xxhash64("vector"))
    # The row's number deals out many copies of one vector; they stay next to one another.
    dealt = placed.repartitionByRange(max(1, ceil(units.count() / (4 * block_rows))), "cells", "spot", "row")
    ordered = dealt.sortWithinPartitions("cells", "spot", "row").select("row", "vector")
    columns = "row long, part int, block long, place int, vector binary, n long, least long"
    return work.keep(ordered.mapInArrow(cut, columns), "blocks")


def _levels(work: Work, blocks: DataFrame, lead: int) -> list[DataFrame]:
    """Intervals by level, from the blocks up to the one of all: pos, n, least, extent."""

    def joined(rows: pd.DataFrame) -> pd.DataFrame:
        whole = Intervals.from_bytes(rows["extent"].tolist(), lead).joined()
        up = {"pos": rows["pos"].iloc[0] // FAN, "n": rows["n"].sum(), "least": rows["least"].min()}
        return pd.DataFrame([{**up, "extent": whole.to_bytes()}])

    levels = [blocks]
    top = blocks.agg(F.max("pos")).first()[0] or 0
    while top:
        above = levels[-1].groupBy((F.col("pos") / FAN).cast("long").alias("up"))
        levels.append(work.keep(above.applyInPandas(joined, "pos long, n long, least long, extent binary"), "intervals"))
        top //= FAN
    return levels


def _refined(pairs: DataFrame, below: DataFrame, lead: int, epsilon: float) -> DataFrame:
    """Pairs of the level below that are not provably distant; ``within`` those that are provably linked throughout."""
    schema = pa.schema(
        [(name, pa.int64()) for name in ("a", "b", "na", "nb", "la", "lb")] + [("within", pa.bool_())]
    )

    def judged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                a, b = (Intervals.from_bytes(batch.column(name).to_pylist(), lead) for name in ("xa", "xb"))
                distant, within = a.settled(b, epsilon)
                columns = [batch.column(name) for name in schema.names[:6]] + [pa.array(within)]
                yield pa.record_batch(columns, schema=schema).filter(pa.array(~distant))

    def side(name: str) -> DataFrame:
        names = {"pos": name, "n": f"n{name}", "least": f"l{name}", "extent": f"x{name}"}
        parts = [F.col(one).alias(other) for one, other in names.items()]
        return below.select((F.col("pos") / FAN).cast("long").alias(f"up_{name}"), *parts)

    up = pairs.select(F.col("a").alias("up_a"), F.col("b").alias("up_b"))
    both = up.join(side("a"), "up_a").join(side("b"), "up_b").where("a <= b").drop("up_a", "up_b")
    return both.mapInArrow(judged, "a long, b long, na long, nb long, la long, lb long, within boolean")


def _compared(pairs: DataFrame, vectors: DataFrame, directions: np.ndarray, threshold: float, partners: int) -> DataFrame:
    """Pairs of blocks, each with up to ``partners`` others in a task: rows u, n (links counted) and u, v (a link)."""
    schema = pa.schema([("u", pa.int64()), ("v", pa.int64()), ("n", pa.int64())])
    group = pairs.select("a", F.floor(F.col("b") / partners).alias("group"), "b")
    held = group.groupBy("a", "group").agg(F.max(F.col("a") == F.col("b")).alias("itself"))
    columns = ("a", "group", "other", "pos", "place", "itself", "row", "vector")
    first = held.join(vectors, F.col("a") == F.col("pos")).withColumn("other", F.lit(0)).select(*columns)
    rest = group.where("a <> b").join(vectors, F.col("b") == F.col("pos"))
    rest = rest.withColumns({"other": F.lit(1), "itself": F.lit(False)}).select(*columns)

    def results(a: Block, b: Block) -> Iterator[pa.RecordBatch]:
        counts, theirs, root = block_links(a, b, threshold)
        rows = a.rows if a is b else np.r_[a.rows, b.rows]
        found = counts + theirs if a is b else np.r_[counts, theirs]
        some, moved = np.flatnonzero(found), np.flatnonzero(root != np.arange(len(root)))
        nothing = np.zeros(len(moved), np.int64)
        yield pa.record_batch(
            [
                pa.array(np.r_[rows[some], rows[moved]]),
                pa.concat_arrays([pa.nulls(len(some), pa.int64()), pa.array(rows[root[moved]])]),
                pa.array(np.r_[found[some], nothing]),
            ],
            schema=schema,
        )

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # Runs of (a, group, pos) follow one another, the one of a itself before its partners.
        open_key, rows, parts, itself, own = None, [], [], False, None

        def ended() -> Iterator[pa.RecordBatch]:
            nonlocal own
            block = Block(np.concatenate(rows), np.concatenate(parts), directions)
            if open_key[2] == 0:
                own = block
                if itself:
                    yield from results(own, own)
            else:
                yield from results(own, block)

        for batch in batches:
            if not batch.num_rows:
                continue
            keys = np.stack([_numpy(batch.column(name)) for name in ("a", "group", "other", "pos")], axis=1)
            starts = np.flatnonzero(np.r_[True, (keys[1:] != keys[:-1]).any(axis=1)])
            for start, end in zip(starts.tolist(), [*starts[1:].tolist(), batch.num_rows]):
                key = tuple(keys[start].tolist())
                if key != open_key:
                    if rows:
                        yield from ended()
                    open_key, rows, parts, itself = key, [], [], batch.column("itself")[start].as_py()
                rows.append(_numpy(batch.column("row"))[start:end])
                parts.append(_matrix(batch.column("vector").slice(start, end - start)))
        if rows:
            yield from ended()

    dealt = first.unionAll(rest).repartition("a", "group").sortWithinPartitions("a", "group", "other", "pos", "place")
    return dealt.mapInArrow(compare, "u long, v long, n long")


def embedding_links(
    vectors: DataFrame,
    *,
    vec_id: str = "vec_id",
    vector: str = "embedding",
    threshold: float = 0.9,
    lead: int = 8,
    block_rows: int = 4096,
    partners: int = 8,
    sample_bytes: int = 16 * 1024 * 1024,
) -> DataFrame:
    """A row per vector: vec_id, n_links, component_id, kept.

    Linked are vectors, rows of their own, whose cosine is at least ``threshold`` (above -1).
    n_links is how many others a vector is linked with directly, component_id the smallest
    id reachable, itself included, and ``kept`` says that it is its own. Vectors that
    are null, empty, zero, or hold null or non-finite components link with nothing.
    Shorter vectors are compared as if zeros followed. Null ids count for nothing in a
    component, so one of null ids only has a null component_id, and its rows are kept.
    Repeated rows each come back and link with one another. No vectors give no rows.
    Other columns are not read.
    """
    if not -1 < threshold < 1:
        raise ValueError(f"a threshold lies between -1 and 1, not at {threshold}")
    epsilon = sqrt(2 - 2 * threshold)
    work = Work(vectors.sparkSession, "vector-links")
    given = vectors.select(
        F.monotonically_increasing_id().alias("row"),
        F.col(vec_id).alias("id"),
        F.col(vector).cast("array<double>").alias("vector"),
    )
    length = max(0, given.agg(F.max(F.size("vector"))).first()[0] or 0)
    given = work.keep(with_units(given, length), "units")
    units = given.where("unit IS NOT NULL")
    directions = principal_directions(units, lead, sample_bytes)
    lead = directions.shape[1]

    cut = _blocks(work, units, directions, epsilon, block_rows)
    most = cut.agg(F.max("block")).first()[0] or 0
    stride = 1
    while stride <= most:
        stride *= FAN
    cut = cut.withColumn("pos", F.col("part").cast("long") * stride + F.col("block"))
    ordered = cut.where("row IS NOT NULL").select("row", "pos", "place", "vector")
    blocks = cut.where("row IS NULL").select("pos", "n", "least", F.col("vector").alias("extent"))
    levels = _levels(work, blocks, lead)

    # Down from the pair of the whole sequence with itself.
    pairs, settled = vectors.sparkSession.createDataFrame([(0, 0)], "a long, b long"), []
    for depth in range(len(levels) - 1, -1, -1):
        pairs = work.keep(_refined(pairs, levels[depth], lead, epsilon), "pairs")
        settled.append(pairs.where("within").withColumn("level", F.lit(depth)))
        pairs = pairs.where("NOT within").select("a", "b")
    found = work.keep(_compared(pairs, ordered, directions, threshold, partners), "links")

    counts = [found.where("v IS NULL").select(F.col("u").alias("row"), "n")]
    links = [found.where("v IS NOT NULL").select("u", "v")]
    whole = work.keep(reduce(DataFrame.unionAll, settled), "settled")
    for (depth,) in whole.select("level").distinct().orderBy("level").collect():
        here = whole.where(F.col("level") == depth)
        sides = here.select(F.col("a").alias("at"), F.col("nb").alias("n"), F.col("lb").alias("v"))
        sides = sides.unionAll(here.where("a <> b").select("b", "na", "la"))
        sides = sides.groupBy("at").agg(F.sum("n").alias("n"), F.min("v").alias("v"))
        # All of an interval is linked to the smallest of one partner, and partners to one another.
        members = ordered.select("row", F.floor(F.col("pos") / FAN**depth).alias("at")).join(sides, "at")
        counts.append(members.select("row", "n"))
        links += [members.select(F.col("row").alias("u"), "v"), here.select(F.col("la").alias("u"), F.col("lb").alias("v"))]

    # Each vector was met with itself once.
    totals = reduce(DataFrame.unionAll, counts).groupBy("row").agg((F.sum("n") - 1).alias("n_links"))
    rooted = components(work, reduce(DataFrame.unionAll, links)).select(F.col("node").alias("row"), "root")
    rows = given.select("row", "id").join(totals, "row", "left").join(rooted, "row", "left")
    rows = rows.select("id", F.coalesce("n_links", F.lit(0)).alias("n_links"), F.coalesce("root", "row").alias("root"))
    rows = work.keep(rows, "rooted")
    linked = rows.where("n_links > 0")
    least = linked.groupBy("root").agg(F.min("id").alias("component_id"))
    linked = linked.join(least, "root").select("id", "n_links", "component_id")
    alone = rows.where("n_links = 0").select("id", "n_links", F.col("id").alias("component_id"))
    return linked.unionAll(alone).select(
        F.col("id").alias("vec_id"), "n_links", "component_id", F.col("id").eqNullSafe(F.col("component_id")).alias("kept")
    )
