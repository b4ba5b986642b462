from __future__ import annotations

import random
from itertools import combinations

import numpy as np
import pytest
from pyspark.sql import functions as F

import layerline.llm.decontaminate as module
from layerline.llm.decontaminate import benchmark_overlaps, without_benchmark
from tests.llm.helpers import EDGES, documents, overlaps, plain, with_clashes

ITEMS = "item_id LONG, text STRING"


@pytest.fixture(scope="module")
def case():
    """Documents of random words; some hold items whole or cut, with words replaced, in other case and punctuation."""
    draw = random.Random(3)
    vocabulary = ["".join(draw.choice("abcdeé") for _ in range(draw.randint(2, 6))) for _ in range(400)]

    def text(words):
        return [draw.choice(vocabulary) for _ in range(words)]

    items = [(i, text(draw.choice([14, 20, 40]))) for i in range(9)] + [(30, text(6)), (31, text(3)), (32, text(9))]
    rows = []
    for doc in range(36):
        words = text(draw.randint(5, 60))
        if doc % 3:
            passage = list(draw.choice(items)[1])
            if doc % 3 == 2:
                start = draw.randint(0, len(passage) // 2)
                passage = passage[start:]
                for _ in range(len(passage) // 10):
                    passage[draw.randrange(len(passage))] = "zzz"
            at = draw.randint(0, len(words))
            words[at:at] = [one.upper() + draw.choice(["", ",", "!"]) for one in passage]
        rows.append((doc, draw.choice([" ", "\n", " - "]).join(words), "en", "a", 1))
    return rows, [(i, " ".join(words)) for i, words in items]


@pytest.mark.parametrize("least_item", [1, 8])
def test_as_every_stretch_tried(spark, case, least_item):
    rows, items = case
    docs, benchmark = documents(spark, rows), spark.createDataFrame(items, ITEMS)
    found = benchmark_overlaps(docs, benchmark, least_item_words=least_item).collect()
    got = {(row.doc_id, row.item_id) for row in found}
    wanted = {(doc[0], item) for doc in rows for item, text in items if overlaps(doc[1], text, least_item=least_item)}
    assert got == wanted
    kept = without_benchmark(docs, benchmark, least_item_words=least_item).collect()
    assert {row.doc_id for row in kept} == {doc[0] for doc in rows} - {doc for doc, _ in got}
    items = [one for one in items if len(one[1].split()) >= least_item]
    whole = {(doc[0], item) for doc in rows for item, text in items if f" {text} " in " " + " ".join(module.WORDS.findall(doc[1].lower())) + " "}
    assert whole <= got and len(whole) > 8
    for row in found:
        assert row.matches >= 0.8 * row.words and abs(row.similarity - row.matches / row.words) < 1e-12


def test_words_replaced_here_and_there(spark):
    draw = random.Random(5)
    item = [f"w{i}" for i in range(60)]
    rows = []
    for doc in range(40):
        words = list(item)
        for i in range(draw.randint(0, 4), 60, 9):
            words[i] = "other"
        rows.append((doc, " ".join(["x"] * 30 + words + ["y"] * 30), "en", "a", 1))
    found = benchmark_overlaps(documents(spark, rows), spark.createDataFrame([(1, " ".join(item))], ITEMS)).collect()
    assert sorted(row.doc_id for row in found) == list(range(40))
    assert all(row.doc_place - row.item_place == 30 and row.words >= 50 for row in found)


def test_masks_miss_no_two_changes_in_twelve_words():
    for changed in combinations(range(12), 2):
        assert any(
            all(mask[i] == "0" or at + i not in changed for i in range(len(mask)))
            for mask in module.MASKS
            for at in range(12 - len(mask) + 1)
        )


def alike(size):
    """Every way in which a stretch of so many words can just count: the places that agree."""
    return [set(range(size)) - set(gone) for gone in combinations(range(size), size // 5)]


def fits(mask, places, size):
    return any(all(c == "0" or at + i in places for i, c in enumerate(mask)) for at in range(size - len(mask) + 1))


@pytest.mark.parametrize("words", range(1, 24))
def test_masks_miss_no_stretch_that_counts(words):
    least = min(12, -(-words * 4 // 5))
    masks = module.masks_by_length([words], module.MASKS, 12, 0.8, 1)[words]
    shared = module.masks_by_length([*range(8, 14), words], module.MASKS, 12, 0.8, 8)
    assert len({mask for own in shared.values() for mask in own}) <= 8
    if words >= 8:
        masks = shared[words]
    for size in range(least, words + 1):
        assert all(any(fits(mask, places, size) for mask in masks) for places in alike(size))


def test_masks_of_other_similarities():
    for similarity, words in [(0.5, 20), (0.6, 9), (0.9, 11), (1.0, 7)]:
        least = module._least(words, 12, similarity)
        masks = module.short_masks(range(least, words + 1), similarity)
        for size in range(least, min(words, 12) + 1):
            for gone in combinations(range(size), int(round(size * (1 - similarity), 9))):
                assert any(fits(mask, set(range(size)) - set(gone), size) for mask in masks)


def test_short_items_and_three_changes(spark):
    """Changed words of short items and of long ones, wherever one stretch only just counts."""
    cases = [(10, (0, 3)), (10, (4, 7)), (11, (2, 5)), (9, (0, 4)), (8, (0, 3)), (6, (4, 5)), (5, (2,)), (12, (0, 3, 6, 11))]
    cases += [(15, (3, 7, 11)), (15, (4, 5, 8)), (16, (5, 6, 9)), (17, (6, 7, 10)), (20, (2, 7, 8, 11))]
    items, rows = [], []
    for i, (size, changed) in enumerate(cases):
        words = [f"c{i}w{k}" for k in range(size)]
        items.append((i, " ".join(words)))
        rows.append((i, " ".join(["x"] * 9 + ["new" if k in changed else one for k, one in enumerate(words)] + ["y"] * 9), "en", "a", 1))
        assert overlaps(rows[-1][1], items[-1][1], least_item=1)
    docs, benchmark = documents(spark, rows), spark.createDataFrame(items, ITEMS)
    found = benchmark_overlaps(docs, benchmark, least_item_words=1).collect()
    assert sorted((row.doc_id, row.item_id) for row in found) == [(i, i) for i in range(len(cases))]


def test_without_the_filter_the_join_decides(spark, case, monkeypatch):
    """A filter that lets everything through, as one does that is too small for its benchmark."""
    rows, items = case
    docs, benchmark = documents(spark, rows), spark.createDataFrame(items, ITEMS)
    before = plain(benchmark_overlaps(docs, benchmark).collect())
    monkeypatch.setattr(module, "LEAST_BITS", 64)
    monkeypatch.setattr(module, "FILTER_BITS", 64)
    assert plain(benchmark_overlaps(docs, benchmark).collect()) == before


def test_regions_of_a_long_text(spark, monkeypatch):
    """Hits all along a text, and some far from them."""
    monkeypatch.setattr(module, "CONTEXT", 40)
    items = [(i, " ".join(f"i{i}w{k}" for k in range(30))) for i in range(20)]
    apart = " ".join(f"x{k}" for k in range(500))
    rows = [(7, " ".join([*(text for _, text in items), apart, items[3][1]]), "en", "a", 1)]
    found = benchmark_overlaps(documents(spark, rows), spark.createDataFrame(items, ITEMS)).collect()
    assert sorted((row.item_id, row.doc_place, row.words) for row in found) == [(i, 30 * i, 30) for i in range(20)]


def test_a_long_item_copied_whole_is_one_stretch(spark):
    item = " ".join(f"w{k}" for k in range(6_000))
    rows = [(1, f"some words before {item} and some after", "en", "a", 1)]
    (found,) = benchmark_overlaps(documents(spark, rows), spark.createDataFrame([(1, item)], ITEMS)).collect()
    assert (found.doc_place, found.item_place, found.words, found.matches) == (3, 0, 6_000, 6_000)


def test_items_of_a_few_words_are_lines(spark):
    items = [(1, "things"), (2, "Answer: yes"), (3, "a b c d e f g"), (4, "a b c d e f g h")]
    texts = ["all things", "x\n Things!\ny", "answer YES", "the answer, yes", "a b c d e f g", "a b c d e f g h", "z a b c d e f g h z", ""]
    rows = [(i, text, "en", "a", 1) for i, text in enumerate(texts)]
    docs, benchmark = documents(spark, rows), spark.createDataFrame(items, ITEMS)
    found = benchmark_overlaps(docs, benchmark).collect()
    wanted = {(i, item) for i, text in enumerate(texts) for item, one in items if overlaps(text, one)}
    assert {(row.doc_id, row.item_id) for row in found} == wanted == {(1, 1), (2, 2), (4, 3), (4, 4), (5, 4), (6, 4)}
    assert sorted(row.doc_id for row in without_benchmark(docs, benchmark).collect()) == [0, 3, 7]


def test_a_shared_instruction_is_not_tried_with_every_item(spark, monkeypatch):
    """50 documents and 60 items that share 14 words: each document is compared once."""
    shared = " ".join(f"s{k}" for k in range(14))
    items = [(i, f"{shared} " + " ".join(f"i{i}w{k}" for k in range(20))) for i in range(60)]
    rows = [(i, f"d{i} begins {shared} d{i} ends", "en", "a", 1) for i in range(50)]
    rows += [(50, " ".join(["z", *shared.split()[:9], "z", "z"]), "en", "a", 1), (51, items[59][1].split(" ", 12)[-1], "en", "a", 1)]
    made, before = [], module._Search.overlays

    def overlays(self, hits, seeds):
        found = self.work.keep(before(self, hits, seeds), "counted")
        made.append(found.count())
        return found

    monkeypatch.setattr(module._Search, "overlays", overlays)
    docs, benchmark = documents(spark, rows), spark.createDataFrame(items, ITEMS)
    kept = without_benchmark(docs, benchmark).collect()
    assert [row.doc_id for row in kept] == [50]
    # One item for each of the fifty; then others, for the document that holds none.
    assert made[0] <= 60 and sum(made) <= 60 + 60
    assert benchmark_overlaps(docs, benchmark).count() == 50 * 60 + 1


def test_the_filter_is_gathered_in_blocks(spark):
    hashes = spark.range(0, 30_000).select(F.xxhash64("id").alias("seed"))
    bloom = module._filter(hashes)
    own = np.array([row.seed for row in hashes.collect()], np.int64).view(np.uint64)
    assert len(bloom.passing(own)) == 30_000
    others = np.random.default_rng(1).integers(0, 2**63, 100_000).astype(np.uint64)
    assert len(bloom.passing(others)) < 100
    plain_bits = module.Bloom.empty(len(bloom.octets) * 8)
    for i in range(module.PROBES):
        at = plain_bits.probe(own, i)
        np.bitwise_or.at(plain_bits.octets, at >> np.uint64(3), (1 << (at & np.uint64(7)).astype(np.int64)).astype(np.uint8))
    assert (plain_bits.octets == bloom.octets).all()


def test_edges(spark):
    items = spark.createDataFrame([(1, "same text twice"), (2, None), (3, ""), (None, "no id here"), (1, "same text twice")], ITEMS)
    docs = with_clashes(documents(spark))
    found = benchmark_overlaps(docs, items)
    assert {(row.doc_id, row.item_id) for row in found.collect()} == {(1, 1), (2, 1), (None, 1), (None, None)}
    kept = without_benchmark(docs, items)
    assert kept.columns == docs.columns
    for name in ("__id", "__hash", "__ID_"):
        docs = docs.withColumn(name, docs["doc_id"])
    assert without_benchmark(docs, items).columns == docs.columns
    wanted = [row for row in EDGES if row[1] not in ("Same text, twice.", "No id here")]
    assert plain(kept.select("doc_id", "text").collect()) == plain(row[:2] for row in wanted)
    nothing = spark.createDataFrame([], ITEMS)
    assert benchmark_overlaps(docs, nothing).collect() == []
    assert without_benchmark(docs, nothing).count() == len(EDGES)
    assert benchmark_overlaps(documents(spark, []), items).collect() == []
