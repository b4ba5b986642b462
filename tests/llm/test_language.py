from __future__ import annotations

import subprocess
import sys
import zlib
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

import layerline.llm.language as module
from layerline.llm.language import Profiles, identify_languages
from tests.conftest import TESTDATA
from tests.llm.helpers import EDGES, documents, profile, with_clashes


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{TESTDATA}/documents.parquet")


def is_held_out(doc_id):
    return doc_id is not None and zlib.crc32(str(doc_id).encode()) % 3 == 1


def test_profiles_as_bundled_one_by_one():
    texts = ["The cat sat.", "a", "", "ÉA ñu--ß 漢字", "x  y\n\nz", "1234", "aa aa aa", "İx"]
    found, letters = Profiles(256, 3, 4).of(texts)
    for text, vector, has in zip(texts, found, letters):
        assert has == any(c.isalpha() for c in text)
        if has:
            assert (vector == profile(text, 256)).all(), text


def test_predictions_as_of_plain_cosines(spark, docs):
    found = {row.doc_id: row for row in identify_languages(docs).collect()}
    rows = docs.select("doc_id", "text", "lang").collect()
    vectors = {row.doc_id: profile(row.text).astype(float) for row in rows}
    sums = {}
    for row in rows:
        if not is_held_out(row.doc_id):
            sums[row.lang] = sums.get(row.lang, 0) + vectors[row.doc_id]
    for row in rows:
        v = vectors[row.doc_id]
        cosine = {lang: v @ p / np.linalg.norm(v) / np.linalg.norm(p) for lang, p in sums.items()}
        best = max(sorted(cosine), key=cosine.get)
        got = found[row.doc_id]
        assert got.held_out == is_held_out(row.doc_id)
        assert abs(got.score - max(0.0, cosine[best])) < 1e-4
        assert got.lang_pred == best or abs(cosine[best] - cosine[got.lang_pred]) < 1e-4


def test_held_out_accuracy(docs):
    found = identify_languages(docs).join(docs.select("doc_id", "lang"), "doc_id").where("held_out").collect()
    assert sum(row.lang == row.lang_pred for row in found) / len(found) > 0.97


def test_only_the_text_counts(docs):
    """Held-out documents without their language and source, under other ids of the fold, are judged alike."""
    out = [row for row in docs.collect() if is_held_out(row.doc_id)]
    ids = [i for i in range(10**6, 10**6 + 2000) if is_held_out(i)][: len(out)]
    spark = docs.sparkSession
    bare = spark.createDataFrame([(i, row.text, None, None, None) for i, row in zip(ids, out)], docs.schema)
    other = docs.unionByName(bare)
    found = {row.doc_id: (row.lang_pred, row.score) for row in identify_languages(other).collect()}
    assert all(found[i] == found[row.doc_id] for i, row in zip(ids, out))


def test_the_sample_is_bounded_and_learns_from_whole_texts(docs):
    few = identify_languages(docs, per_language=3).join(docs.select("doc_id", "lang"), "doc_id").collect()
    assert sum(row.lang == row.lang_pred for row in few) / len(few) > 0.8


def test_edges(spark):
    found = identify_languages(with_clashes(documents(spark))).collect()
    assert len(found) == len(EDGES)
    by_id = {row.doc_id: row for row in found}
    assert [(by_id[i].lang_pred, by_id[i].score) for i in (3, 4, 5)] == [("und", 0.0)] * 3
    assert not by_id[None].held_out
    assert all(0 <= row.score <= 1 for row in found)
    assert identify_languages(documents(spark, [])).collect() == []


def test_nothing_to_learn_from(spark):
    unlabelled = documents(spark).withColumn("lang", F.lit(None).cast("string"))
    assert {(row.lang_pred, row.score) for row in identify_languages(unlabelled).collect()} == {("und", 0.0)}


@pytest.mark.parametrize("piece", [1, 2, 7, 64])
def test_texts_in_pieces(monkeypatch, piece):
    """Characters, kinds and texts in pieces of any size give the same sums."""
    texts = ["ab, cd", None, "", "a", "  é漢字  漢字 ", "x1y2 z", "the end " * 9, "!!", "ab ab ab"]
    whole = Profiles(1024, 3, 4).measured(texts)
    monkeypatch.setattr(module, "SLICE_CHARACTERS", piece)
    monkeypatch.setattr(module, "KINDS", 3)
    cut = Profiles(1024, 3, 4).measured(texts)
    for one, other in zip(whole, cut):
        assert (one == other).all()
    for text, vector in zip(texts, whole[0]):
        assert (vector == profile(text or "")).all()


MEASURED = """
import resource, sys
import numpy as np
sys.path.insert(0, sys.argv[1])
from layerline.llm.language import Profiles
r = np.random.default_rng(1)
spread = lambda n: "".join(map(chr, 0x4E00 + (r.pareto(0.7, n) * 20).astype(int) % 20_000))
texts = [spread(1_500) for _ in range(256)] if sys.argv[2] == "pages" else ["".join(map(chr, r.integers(0x4E00, 0x9000, 1_050_000)))]
before = resource.getrusage(resource.RUSAGE_SELF).ru_maxrss
vectors, _, different = Profiles(1024, 3, 4).measured(texts)
print((resource.getrusage(resource.RUSAGE_SELF).ru_maxrss - before) / 1024, different.max())
"""


@pytest.mark.parametrize(("kind", "least"), [("pages", 1_000), ("text", 1_000_000)])
def test_memory_of_texts_of_many_ngrams(kind, least):
    repo = Path(__file__).resolve().parents[2]
    done = subprocess.run([sys.executable, "-c", MEASURED, repo, kind], capture_output=True, text=True, timeout=600, check=True)
    megabytes, different = map(float, done.stdout.split())
    assert megabytes < 500 and different >= least
