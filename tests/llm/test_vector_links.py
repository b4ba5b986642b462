"""Against all pairs."""

from __future__ import annotations

import numpy as np
import pytest

from layerline.llm import vector_links
from layerline.llm.vector_links import Block, Intervals, block_links, embedding_links, unite
from tests.llm.helpers import plain

SCHEMA = "vec_id LONG, embedding ARRAY<DOUBLE>, label INT"


def linked(rows, threshold=0.9):
    """Rows as the operator gives them."""
    length = max([0, *(len(row[1]) for row in rows if row[1])])
    good = [i for i, row in enumerate(rows) if row[1] and None not in row[1] and np.isfinite(row[1]).all() and np.any(row[1])]
    x = np.array([[*rows[i][1], *[0.0] * (length - len(rows[i][1]))] for i in good]).reshape(len(good), length)
    x /= np.abs(x).max(axis=1, initial=1e-300)[:, None]
    same = np.zeros((len(rows), len(rows)), bool)
    if good:
        same[np.ix_(good, good)] = (x @ x.T) / np.sqrt((x**2).sum(axis=1)[:, None] * (x**2).sum(axis=1)) >= threshold
    np.fill_diagonal(same, True)
    first = np.arange(len(rows))
    while True:
        new = np.array([first[one].min() for one in same])
        if (new == first).all():
            break
        first = new
    ids = {}
    for row, of in zip(rows, first.tolist()):
        ids.setdefault(of, set()).add(row[0])
    least = {of: min(own - {None}, default=None) for of, own in ids.items()}
    counts = same.sum(axis=1) - 1
    return plain((row[0], int(n), least[of], row[0] == least[of]) for row, n, of in zip(rows, counts, first.tolist()))


def drawn(seed, length=16, lone=200):
    """Vectors apart, one tight and one loose group, copies, and a chain whose ends are not linked directly."""
    r = np.random.default_rng(seed)
    groups = [r.normal(size=(1, length)) + r.normal(size=(150, length)) * spread for spread in (0.03, 0.27)]
    turn = np.arange(60) * 0.2
    chain = np.zeros((60, length))
    chain[:, 0], chain[:, 1] = np.cos(turn), np.sin(turn)
    x = np.concatenate([r.normal(size=(lone, length)), *groups, np.repeat(r.normal(size=(1, length)), 90, axis=0), chain])
    x *= r.uniform(0.01, 100, (len(x), 1))
    ids = r.permutation(len(x)).tolist()
    return [(i, one.tolist(), 1) for i, one in zip(ids, x)]


@pytest.mark.parametrize(("seed", "block_rows", "partners"), [(1, 4096, 8), (2, 64, 2), (3, 17, 1)])
def test_every_link_counts(spark, monkeypatch, seed, block_rows, partners):
    rows = drawn(seed)
    vectors = spark.createDataFrame(rows, SCHEMA).repartition(5)
    found = embedding_links(vectors, block_rows=block_rows, partners=partners)
    assert plain(found.collect()) == linked(rows)


def test_intervals_settle_what_they_can(spark, monkeypatch):
    """Two tight groups apart: between them nothing is compared, and within them blocks are linked as a whole."""
    r = np.random.default_rng(5)
    ends = np.zeros((2, 8))
    ends[0, 0], ends[1, 0] = 1, -1
    x = np.concatenate([end + r.normal(size=(400, 8)) * 0.01 for end in ends])
    rows = [(i, one.tolist(), 1) for i, one in enumerate(x)]
    compared = []
    before = vector_links._compared
    monkeypatch.setattr(vector_links, "_compared", lambda pairs, *more: compared.append(pairs.count()) or before(pairs, *more))
    found = embedding_links(spark.createDataFrame(rows, SCHEMA), block_rows=50)
    assert plain(found.collect()) == linked(rows)
    # At most pairs with the one block that may hold both groups' vectors.
    assert compared[0] <= 20


@pytest.mark.parametrize("seed", range(8))
def test_two_blocks(monkeypatch, seed):
    monkeypatch.setattr(vector_links, "SHORT", 8)
    r = np.random.default_rng(seed)
    x = np.concatenate([r.normal(size=(50, 5)), r.normal(size=(1, 5)) + r.normal(size=(70, 5)) * r.uniform(0.01, 0.4)])
    x /= np.linalg.norm(x, axis=1)[:, None]
    x = x[np.argsort(x[:, 0])]
    rows, lead = np.arange(len(x)), np.eye(5)[:, :3]
    same = x @ x.T >= 0.9
    a, b = Block(rows[:57], x[:57], lead), Block(rows[57:], x[57:], lead)
    counts, theirs, root = block_links(a, b, 0.9)
    assert (counts == same[:57, 57:].sum(axis=1)).all() and (theirs == same[57:, :57].sum(axis=1)).all()
    between = same.copy()
    between[:57, :57] = between[57:, 57:] = False
    wanted = rows.copy()
    unite(wanted, *np.nonzero(between))
    assert (root == wanted).all()
    counts, more, root = block_links(a, a, 0.9)
    assert (counts + more == same[:57, :57].sum(axis=1)).all()


def test_bounds_hold():
    r = np.random.default_rng(3)
    for _ in range(50):
        x, y = (r.normal(size=4) + r.normal(size=(30, 4)) * r.uniform(0, 1) for _ in range(2))
        lead = np.linalg.qr(r.normal(size=(4, 4)))[0][:, :2]
        one, other = (Intervals.from_bytes([Intervals.over(v, lead, 30).to_bytes()], 2) for v in (x, y))
        apart = np.sqrt(((x[:, None] - y[None]) ** 2).sum(axis=2))
        for epsilon in (0.2, 1.0, 3.0):
            distant, within = one.settled(other, epsilon)
            assert not distant[0] or apart.min() > epsilon
            assert not within[0] or apart.max() < epsilon


def test_edges(spark):
    nan, infinite = float("nan"), float("inf")
    rows = [
        (1, [1.0, 0.0, 0.0], 1),
        (2, [2.0, 0.1, 0.0], 1),
        (2, [2.0, 0.1, 0.0], 1),
        (None, [3.0, 0.0, 0.0], None),
        (None, [0.0, 1.0, 0.0], None),
        (None, [0.0, 2.0, 0.0], None),
        (3, None, 1),
        (4, [], 1),
        (5, [0.0, 0.0, -0.0], 1),
        (6, [1.0, None, 0.0], 1),
        (7, [1.0, nan, 0.0], 1),
        (8, [infinite, 0.0, 0.0], 1),
        (8, [infinite, 0.0, 0.0], 1),
        (9, [1e300, 1e299, 0.0], 1),
        (10, [1e-310, 0.0, 0.0], 1),
        (11, [0.0, 0.0, 5.0], 1),
        (12, [0.0, 0.0, 5.0, 0.0], 1),
    ]
    vectors = spark.createDataFrame(rows, SCHEMA)
    for name in ("row", "id", "unit", "n_links", "root", "pos", "KEPT"):
        vectors = vectors.withColumn(name, vectors["label"] + 1)
    found = embedding_links(vectors)
    assert found.columns == ["vec_id", "n_links", "component_id", "kept"]
    assert plain(found.collect()) == linked(rows)


def test_no_vectors(spark):
    assert embedding_links(spark.createDataFrame([], SCHEMA)).collect() == []
    rows = [(1, None, 1), (2, [0.0], 1)]
    assert plain(embedding_links(spark.createDataFrame(rows, SCHEMA)).collect()) == linked(rows)
    assert plain(embedding_links(spark.createDataFrame([(1, [0.5], 1)], SCHEMA)).collect()) == [(1, 0, 1, True)]
