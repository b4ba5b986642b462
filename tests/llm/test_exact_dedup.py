from __future__ import annotations

import hashlib

import pytest
from pyspark.sql import functions as F

from layerline.llm.exact_dedup import exact_duplicates
from tests.llm.helpers import EDGES, documents, plain, with_clashes


def wanted(rows):
    groups = {}
    for row in rows:
        groups.setdefault(row[1] or "", []).append(row[0])
    last = {text: max((i for i in ids if i is not None), default=None) for text, ids in groups.items()}
    digest = {text: hashlib.sha256(text.encode()).hexdigest() for text in groups}
    return [(row[0], last[row[1] or ""], len(groups[row[1] or ""]), digest[row[1] or ""]) for row in rows]


def check(found, rows):
    found = found.collect()
    assert plain((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in found) == plain(wanted(rows))
    # One of each group stays, and it bears the group's id.
    kept = [r for r in found if r.kept]
    assert sorted(r.text_sha256 for r in kept) == sorted({r.text_sha256 for r in found})
    assert all(r.doc_id == r.keep_id for r in kept)
    # A name stands for a text.
    assert len({(r.level, r.name, r.text_sha256) for r in found}) == len({(r.level, r.name) for r in found})


@pytest.mark.parametrize("block_bytes", [4096, 64])
def test_equal_texts_and_no_others(spark, block_bytes):
    check(exact_duplicates(documents(spark), block_bytes=block_bytes), EDGES)


def test_blocks_that_share_a_hash_are_told_apart_by_content(spark):
    texts = ["abcd" * 5, "abcd" * 5, "abcd" * 4 + "abce", "", "ab", "abcdx", "xabcd", "ab", "abcd" * 6]
    rows = [(i, text, "en", "a", 1) for i, text in enumerate(texts)]
    for kinds in (1, 3):
        check(exact_duplicates(documents(spark, rows), block_bytes=4, block_hash=lambda b: F.pmod(F.xxhash64(b), F.lit(kinds))), rows)


def test_texts_that_differ_by_position_only(spark):
    texts = ["aabb", "bbaa", "abab", "aab", "baa", "aabbaabb", "aabbaab", "a", "aa", "aaa", "aaaa", "aaaaa"]
    rows = [(i, text, "en", "a", 1) for i, text in enumerate(texts)]
    check(exact_duplicates(documents(spark, rows), block_bytes=1), rows)


def test_no_documents_and_clashing_columns(spark):
    assert exact_duplicates(documents(spark, [])).collect() == []
    check(exact_duplicates(with_clashes(documents(spark))), EDGES)
