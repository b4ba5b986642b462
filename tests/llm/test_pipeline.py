"""The pipeline against a plain version of it, and each stage on documents with everything wrong in them."""

from __future__ import annotations

import hashlib
import zlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from tests.conftest import TESTDATA
from tests.llm.helpers import EDGES, components, documents, fingerprint, overlaps, plain, profile, targets, with_clashes, word_total
from tests.llm.test_language import is_held_out


def in_a_language(rows):
    vectors = {row.doc_id: profile(row.text).astype(float) for row in rows}
    sums = {}
    for row in rows:
        if not is_held_out(row.doc_id):
            sums[row.lang] = sums.get(row.lang, 0) + vectors[row.doc_id]
    kept = []
    for row in rows:
        v = vectors[row.doc_id]
        best = max(v @ p / np.linalg.norm(v) / np.linalg.norm(p) for p in sums.values())
        if any(c.isalpha() for c in row.text) and best >= corpus_pipeline.LEAST_SCORE:
            kept.append(row)
    return kept


def one_of_each(rows):
    rows = sorted(rows, key=lambda row: row.doc_id)
    first = components([fingerprint(row.text) for row in rows])
    return [row for i, row in enumerate(rows) if first[i] == i]


def mixed(rows):
    by_source, out = {}, []
    for row in rows:
        by_source.setdefault(row.source, []).append(row)
    sizes = {source: sum(word_total(row.text) for row in own) for source, own in by_source.items()}
    for source, goal in targets(sizes).items():
        left = int(goal + 1e-9)
        order = sorted(by_source[source], key=lambda row: int(hashlib.md5(f"{row.doc_id}:20".encode()).hexdigest()[:15], 16))
        for row in order * 2:
            words = row.text.split(" ") if left >= word_total(row.text) else row.text.split()[:left]
            if left > 0 and word_total(row.text):
                out.append((row.doc_id, " ".join(words)))
            left -= min(left, word_total(row.text))
    return out


def test_as_of_plain_python(spark):
    rows = spark.read.parquet(f"{TESTDATA}/documents.parquet").collect()
    items = [row.text for row in spark.read.parquet(f"{TESTDATA}/benchmark.parquet").collect()]
    kept = [row for row in one_of_each(in_a_language(rows)) if not any(overlaps(row.text, item) for item in items)]
    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    wanted = []
    for doc_id, text in mixed(kept):
        ids = np.array([*tokenizer.encode(text, add_special_tokens=False).ids, 2], "<u4")
        wanted.append((doc_id, len(ids), zlib.crc32(ids.tobytes())))
    found = corpus_pipeline.run(spark, TESTDATA).collect()
    assert plain((row.doc_id, row.n_tokens, row.ids_crc32) for row in found) == plain(wanted)
    assert len(rows) > len(kept) > 0


@pytest.mark.parametrize("rows", [EDGES, []])
@pytest.mark.parametrize("stage", [name for name, _ in corpus_pipeline.STAGES])
def test_stages_on_edges(spark, stage, rows):
    docs = with_clashes(documents(spark, rows))
    found = dict(corpus_pipeline.STAGES)[stage](spark, docs, TESTDATA)
    if stage != corpus_pipeline.STAGES[-1][0]:
        assert found.columns == docs.columns
    out = found.collect()
    ids = [row[0] for row in rows]
    assert all(row.doc_id in ids for row in out)
    assert bool(out) == bool(rows)


def test_the_language_stage_keeps_short_texts(spark):
    """Pieces of one to three words of documents nothing was learned from: all with a letter stay, numbers go."""
    docs = spark.read.parquet(f"{TESTDATA}/documents.parquet")
    ids = (i for i in range(10**6, 10**7) if is_held_out(i))
    pieces = []
    for row in docs.collect():
        words = row.text.split()
        if is_held_out(row.doc_id):
            pieces += [" ".join(words[at : at + 1 + at % 3]) for at in range(0, min(len(words), 30), 3)]
            pieces += [f"{word} " * 60 for word in words[:2]]
    pieces += ["12 34", " - "]
    rows = [(i, text) for i, text in zip(ids, pieces)]
    given = docs.unionByName(spark.createDataFrame(rows, "doc_id LONG, text STRING"), allowMissingColumns=True)
    kept = corpus_pipeline.language(spark, given, TESTDATA).where("doc_id >= 1000000").select("doc_id").collect()
    assert {row.doc_id for row in kept} == {i for i, text in rows if any(c.isalpha() for c in text)}


def test_the_language_stage_rejects_long_texts_of_no_language(spark):
    docs = spark.read.parquet(f"{TESTDATA}/documents.parquet")
    draw = np.random.default_rng(2)
    ids = [i for i in range(10**6, 10**6 + 400) if is_held_out(i)][:40]
    rows = [(i, "".join(map(chr, draw.integers(0x4E00, 0x9000, 300)))) for i in ids]
    given = docs.unionByName(spark.createDataFrame(rows, "doc_id LONG, text STRING"), allowMissingColumns=True)
    kept = corpus_pipeline.language(spark, given, TESTDATA).where("doc_id >= 1000000").count()
    assert kept < len(rows) / 2


def test_the_language_stage_without_languages(spark):
    docs = documents(spark).withColumn("lang", F.lit(None).cast("string"))
    kept = corpus_pipeline.language(spark, docs, TESTDATA).select("doc_id", "text").collect()
    assert plain(kept) == plain(row[:2] for row in EDGES if any(c.isalpha() for c in row[1] or ""))
