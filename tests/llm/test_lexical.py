"""Against scores of all documents, one by one."""

from __future__ import annotations

import random
import re
from collections import Counter
from math import floor, log

import numpy as np
import pytest

from layerline.llm import lexical
from layerline.llm.lexical import Shard, ranked_documents, term_counts
from tests.llm.helpers import EDGES, documents, plain, with_clashes

ITEMS = "item_id LONG, text STRING"


def terms_of(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def ranked(rows, items, top=50):
    """(item_id, rank, doc_id, score) by the formula; rows that tie on the id too are alike."""
    counts = [(row[0], Counter(terms_of(row[1]))) for row in rows]
    some = [c for _, c in counts if c]
    n, length = len(some), sum(c.total() for c in some)
    frequency = Counter(term for c in some for term in c)
    weight = {term: floor(1000 * log((2 * n + 2) / (2 * df + 1))) for term, df in frequency.items()}
    out = []
    for item, text in items:
        scores = []
        for doc, c in counts:
            m = 50 + 50 * c.total() * n // length if length else 0
            score = sum(weight[t] * (10**9 * c[t] // (1000 * c[t] + 20 * m)) for t in {*terms_of(text)} if t in c)
            if score > 0:
                scores.append((-score, doc is None, doc or 0, doc))
        out += [(item, i + 1, doc, -score) for i, (score, _, _, doc) in enumerate(sorted(scores, key=lambda s: s[:3])[:top])]
    return plain(out)


def drawn(seed, documents=300, words=60):
    draw = random.Random(seed)
    text = lambda n: " ".join(f"w{int(draw.paretovariate(0.6)) % words}" for _ in range(n))
    rows = [(i, text(draw.choice([0, 1, 3, 10, 80])), "en", "a", 1) for i in range(documents)]
    rows += [(1000 + i, rows[i % 7][1], "en", "a", 1) for i in range(100)]
    return rows, [(i, text(draw.choice([1, 4, 20]))) for i in range(25)]


@pytest.mark.parametrize("seed", range(3))
def test_the_best_are_found_whatever_the_shards(spark, seed):
    rows, items = drawn(seed)
    docs, asked = documents(spark, rows), spark.createDataFrame(items, ITEMS)
    for top, shard in ((50, 16_384), (5, 16_384), (5, 32)):
        found = ranked_documents(docs, asked, top=top, shard_documents=shard)
        assert plain(found.collect()) == ranked(rows, items, top)


def test_lists_are_read_only_as_far_as_needed():
    """Much lies in one rare term; what the frequent one adds cannot change the order, only the scores of a few."""
    documents = 50_000
    rare, frequent = np.arange(0, documents, 5_000), np.arange(documents)
    impacts = np.r_[10_000 + np.arange(len(rare)), np.full(documents, 3)]
    shard = Shard(documents, np.r_[np.zeros(len(rare)), np.ones(documents)].astype(int), np.r_[rare, frequent], impacts)
    places, scores = shard.best([0, 1, 2], 3)
    assert sorted(zip(scores.tolist(), places.tolist())) == [(10_010, 35_000), (10_011, 40_000), (10_012, 45_000)]


@pytest.mark.parametrize("seed", range(20))
def test_a_shard_gives_all_that_tie(monkeypatch, seed):
    monkeypatch.setattr(lexical, "FIRST_READ", 2)
    r = np.random.default_rng(seed)
    documents, terms = 200, 8
    grid = r.integers(0, 4, (documents, terms)) * r.integers(0, 2, (documents, terms))
    place, term = np.nonzero(grid)
    shard = Shard(documents, term, place, grid[place, term])
    for top in (1, 5, 50, 500):
        asked = r.choice(terms, 5, replace=False).tolist()
        total = grid[:, asked].sum(axis=1)
        least = max(1, np.sort(total)[::-1][min(top, documents) - 1])
        places, scores = shard.best(asked, top)
        assert places.tolist() == np.flatnonzero(total >= least).tolist() and (scores == total[places]).all()


def test_items_beyond_the_bound_are_searched_in_groups(spark):
    rows, items = drawn(5)
    found = ranked_documents(documents(spark, rows), spark.createDataFrame(items, ITEMS), query_bytes=200)
    assert plain(found.collect()) == ranked(rows, items)


def test_terms_of_a_long_text_are_not_cut(monkeypatch):
    monkeypatch.setattr(lexical, "SLICE", 7)
    text = "Éa ñu-ß 漢字😀 İABC_def 0x1F " * 40 + "z" * 50
    assert term_counts(text.encode()) == Counter(term.encode() for term in terms_of(text))


def test_edges(spark):
    items = [(1, "same text, TWICE"), (1, "same text, twice"), (None, "no id word5"), (2, None), (3, "漢字 😀"), (4, " ,;")]
    docs, asked = with_clashes(documents(spark)), spark.createDataFrame(items, ITEMS).selectExpr("*", "1 AS item", "2 AS rank")
    found = ranked_documents(docs, asked)
    assert found.columns == ["item_id", "rank", "doc_id", "score"]
    assert plain(found.collect()) == ranked(EDGES, items)


def test_nothing_to_search(spark):
    none = spark.createDataFrame([], ITEMS)
    assert ranked_documents(documents(spark), none).collect() == []
    assert ranked_documents(documents(spark, []), spark.createDataFrame([(1, "a")], ITEMS)).collect() == []
    assert ranked_documents(documents(spark, [(1, None, "en", "a", 1)]), spark.createDataFrame([(1, "a")], ITEMS)).collect() == []
