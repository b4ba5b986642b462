"""Against rounds that compare every part with every entry."""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pytest

from layerline.llm.vector_codes import assign, compress_vectors, morton_order
from tests.llm.helpers import plain

SCHEMA = "vec_id LONG, embedding ARRAY<FLOAT>, label INT"


def nearest(points, book):
    return ((points[:, None] - book[None]) ** 2).sum(axis=2).argmin(axis=1)


@pytest.mark.parametrize("seed", range(60))
def test_whole_nodes_and_leaves_go_where_each_part_would(seed):
    r = np.random.default_rng(seed)
    n, width, entries, spread = int(r.integers(1, 900)), int(r.integers(1, 40)), int(r.integers(1, 65)), int(r.choice([1, 4, 60, 10**6]))
    points = r.integers(-spread, spread + 1, (n, width))
    points[r.random(n) < 0.3] = points[0]
    book = points[r.integers(0, n, entries)] + r.integers(0, 2, (entries, width)) * int(r.integers(0, 2))
    sums, counts = np.zeros_like(book), np.zeros(entries, np.int64)
    codes, wanted = assign(points, book, sums, counts), nearest(points, book)
    assert (codes == wanted).all()
    assert (counts == np.bincount(wanted, minlength=entries)).all()
    assert all((sums[i] == points[wanted == i].sum(axis=0)).all() for i in range(entries))


def test_a_node_in_one_spot_is_not_opened(monkeypatch):
    """As for a third of all vectors being copies of one."""
    from layerline.llm import vector_codes

    made, before = [], vector_codes._places
    monkeypatch.setattr(vector_codes, "_places", lambda starts, ends: made.append(len(starts)) or before(starts, ends))
    points = np.full((65_536, 4), 7)
    assign(points, np.array([[7, 7, 7, 7], [90, 0, 0, 0], [0, 90, 0, 0]]), np.zeros((3, 4), np.int64), np.zeros(3, np.int64))
    assert sum(made) == 1


def test_morton_order_is_an_order():
    points = np.random.default_rng(1).integers(-50, 50, (300, 5))
    assert sorted(morton_order(points).tolist()) == list(range(300))


def compressed(rows, parts, entries, rounds=2, scale=256):
    """Rows as the operator gives them."""
    whole = [row for row in rows if row[1] is not None and all(x is not None and math.isfinite(x) for x in row[1]) and row[1]]
    whole = [(row[0], row[2], [math.floor(scale * float(np.float32(x))) for x in row[1]]) for row in whole]
    whole.sort(key=lambda row: (row[0] is None, row[0] or 0, row[2]))
    if not whole:
        return []
    points = np.array([row[2] for row in whole]).reshape(len(whole), parts, -1)
    books = points[:entries].copy()
    for _ in range(rounds):
        for part in range(parts):
            codes = nearest(points[:, part], books[:, part])
            for entry in {*codes.tolist()}:
                own = points[codes == entry, part]
                books[entry, part] = own.sum(axis=0) // len(own)
    codes = np.stack([nearest(points[:, part], books[:, part]) for part in range(parts)], axis=1)
    errors = [int(sum(((points[i, part] - books[codes[i, part], part]) ** 2).sum() for part in range(parts))) for i in range(len(whole))]
    by_label = {}
    for row, error in zip(whole, errors):
        by_label[row[1]] = by_label.get(row[1], 0) + error
    digest = hashlib.sha256(",".join(str(x) for x in books.transpose(1, 0, 2).ravel().tolist()).encode()).hexdigest()
    return plain((row[0], bytes(c.tolist()).hex(), e, by_label[row[1]], digest) for row, c, e in zip(whole, codes, errors))


def drawn(seed, n=400, length=12):
    r = np.random.default_rng(seed)
    spots = r.normal(size=(20, length))
    rows = [(i, (spots[r.integers(20)] + r.normal(size=length) * 0.2).tolist(), [None, 1, 1, 1, 2][r.integers(5)]) for i in range(n)]
    return rows + [(n + i, rows[3][1], 1) for i in range(200)]


@pytest.mark.parametrize(("parts", "entries"), [(4, 64), (3, 7), (12, 256), (1, 1000)])
def test_codes_and_codebooks(spark, parts, entries):
    rows = drawn(parts)
    vectors = spark.createDataFrame(rows, SCHEMA).repartition(7)
    if entries > 256:
        with pytest.raises(ValueError, match="256"):
            compress_vectors(vectors, parts=parts, entries=entries)
        return
    found = compress_vectors(vectors, parts=parts, entries=entries)
    assert plain(found.collect()) == compressed(rows, parts, entries)


def test_edges(spark):
    nan, infinite = float("nan"), float("inf")
    rows = [
        (1, [0.1, -0.1, 0.5, 0.004], 1),
        (1, [0.1, -0.1, 0.5, 0.004], 1),
        (2, None, 1),
        (3, [], 1),
        (4, [0.1, None, 0.0, 0.0], 1),
        (5, [nan, 0.0, 0.0, 0.0], None),
        (6, [infinite, 0.0, 0.0, -infinite], None),
        (7, [0.0, 0.0, 0.0, 0.0], None),
        (None, [-0.5, -0.004, 0.0, 1.0], None),
        (None, [-0.5, -0.004, 0.0, 1.0], 3),
        (8, [-100.0, 250.5, 0.0, 1.0], 3),
    ]
    vectors = spark.createDataFrame(rows, SCHEMA)
    for name in ("id", "ints", "error", "code", "of", "CODEBOOKS_SHA256"):
        vectors = vectors.withColumn(name, vectors["label"] + 1)
    assert plain(compress_vectors(vectors, parts=2, entries=4).collect()) == compressed(rows, 2, 4)
    # Vectors of another length than the first have no code.
    ragged = spark.createDataFrame([*rows, (9, [0.5] * 6, 1)], SCHEMA)
    assert plain(compress_vectors(ragged, parts=2, entries=4).collect()) == compressed(rows, 2, 4)
    with pytest.raises(ValueError, match="equal parts"):
        compress_vectors(vectors, parts=3, entries=4)


def test_no_vectors(spark):
    assert compress_vectors(spark.createDataFrame([], SCHEMA)).collect() == []
    assert compress_vectors(spark.createDataFrame([(1, None, 2)], SCHEMA)).collect() == []
