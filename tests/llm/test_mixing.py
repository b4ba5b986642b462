from __future__ import annotations

import random

import pytest

from layerline.llm.mixing import mix, mixed_documents
from tests.llm.helpers import EDGES, documents, plain, targets, with_clashes, word_total


def drawn(seed, sources):
    draw = random.Random(seed)
    rows = []
    for i in range(400):
        source = draw.choice(sources) if draw.random() < 0.7 else sources[0]
        text = None if draw.random() < 0.03 else " ".join(["w"] * draw.choice([0, 1, 5, 40, 300]))
        rows.append((i, text, "en", source, 1))
    return rows


def check(found, rows):
    sizes, taken = {}, {}
    for row in rows:
        sizes[row[3]] = sizes.get(row[3], 0) + word_total(row[1])
    goal = targets(sizes)
    by_source = {row[0]: row[3] for row in rows}
    for row in found:
        source = by_source[row.doc_id]
        assert row.source_size == sizes[source] and abs(row.target - goal[source]) < 1e-6
        assert 0 <= row.taken <= 2 * row.size
        taken[source] = taken.get(source, 0) + row.taken
    assert plain((r.doc_id, r.size) for r in found) == plain((r[0], word_total(r[1])) for r in rows)
    # To the word: the budget is the target rounded down.
    assert taken == {source: int(goal[source] + 1e-9) for source in sizes}


@pytest.mark.parametrize("sources", [["a", "b", "c", None], ["z"], [None], ["é", "Z", "a", "😀", "ﬀ", "", None]])
def test_budgets_are_met_to_the_word(spark, sources):
    rows = drawn(len(sources), sources)
    check(mix(documents(spark, rows)).collect(), rows)


def test_reruns_agree_however_rows_are_dealt(spark):
    docs = documents(spark, drawn(9, ["a", "b", None]))
    assert plain(mix(docs).collect()) == plain(mix(docs.repartition(7, "n_chars", "text")).collect())
    one, other = (plain(mix(docs, seed=seed).select("doc_id", "taken").collect()) for seed in (20, 21))
    assert one != other


def test_only_the_document_at_the_cut_is_taken_in_part(spark):
    rows = drawn(4, ["a", "b", "c"])
    found = mix(documents(spark, rows)).where("size > 0 AND taken % size <> 0").groupBy("source").count().collect()
    assert all(row["count"] == 1 for row in found)


def test_documents_are_repeated_and_cut(spark):
    rows = [(i, f"a{i}  b{i}\nc{i} d{i}", "en", source, 1) for i, source in enumerate("aabbbbbcc")]
    mixed = mix(documents(spark, rows))
    goal = {row.doc_id: row.taken for row in mixed.collect()}
    out = mixed_documents(mixed)
    assert out.columns == documents(spark, rows).columns
    found = {}
    for row in out.collect():
        found.setdefault(row.doc_id, []).append(row.text)
    assert {i: sum(map(word_total, texts)) for i, texts in found.items()} == {i: n for i, n in goal.items() if n}
    for i, texts in found.items():
        assert all(text == rows[i][1] or rows[i][1].split()[: word_total(text)] == text.split() for text in texts)


def test_edges(spark):
    """Null and repeated ids share a key, and what is left at the cut."""
    docs = with_clashes(documents(spark))
    found = mix(docs)
    assert sorted(found.columns, key=str.lower) == sorted({*docs.columns, "source_size"}, key=str.lower)
    rows = found.collect()
    assert len(rows) == len(EDGES)
    assert all(0 <= row.taken <= 2 * row.size for row in rows)
    sizes = {}
    for row in EDGES:
        sizes[row[3]] = sizes.get(row[3], 0) + word_total(row[1])
    goal = targets(sizes)
    for source in goal:
        got = sum(row.taken for row in rows if row.source == source)
        assert goal[source] - 5 <= got <= goal[source]
    assert mixed_documents(mix(documents(spark))).count() > 0


def test_no_words_and_no_documents(spark):
    assert mix(documents(spark, [])).collect() == []
    rows = [(1, None, "en", "a", 1), (2, "", "en", None, 1)]
    assert plain(mix(documents(spark, rows)).select("size", "source_size", "target", "taken").collect()) == [(0, 0, 0.0, 0)] * 2
