from __future__ import annotations

import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from layerline.llm.token_counts import (
    PIECE,
    TokenRollup,
    counts,
    deleted,
    inserted,
    piece_count,
    revised,
    tokenizer_counts,
    unrepeated,
)
from layerline.llm.token_files import write_token_files
from layerline.llm.work import Work
from tests.conftest import TESTDATA
from tests.llm.helpers import EDGES, documents, plain, with_clashes, word_total


def wanted(rows):
    sums = {}
    for row in rows:
        key = (row[3], row[2], "words-1")
        documents, tokens = sums.get(key, (0, 0))
        sums[key] = (documents + 1, tokens + word_total(row[1]))
    return plain((*key, *value) for key, value in sums.items())


@pytest.fixture(autouse=True)
def words(spark, monkeypatch):
    monkeypatch.setitem(globals(), "WORDS", counts(F.col("text"), "words-1"))


@pytest.fixture
def rollup(spark, tmp_path):
    return TokenRollup(spark, f"file://{tmp_path}/rollup")


def test_inserts_deletes_and_revisions_add_up(spark, rollup):
    docs = with_clashes(documents(spark))
    assert rollup.commit("1", inserted(docs, WORDS))
    assert plain(rollup.totals().collect()) == wanted(EDGES)
    gone = docs.where("doc_id IN (2, 6)")
    assert rollup.commit("2", deleted(gone, WORDS))
    left = [row for row in EDGES if row[0] not in (2, 6)]
    assert plain(rollup.totals().collect()) == wanted(left)
    changed = docs.where("doc_id IN (1, 3, 9)")
    assert rollup.commit("3", revised(changed, WORDS, counts(F.lit("three new words"), "words-1")))
    left = [row[:1] + ("three new words",) + row[2:] if row[0] in (1, 3, 9) else row for row in left]
    assert plain(rollup.totals().collect()) == wanted(left)


def test_a_batch_counts_once(spark, rollup, tmp_path):
    changes = inserted(documents(spark), WORDS)
    assert [rollup.commit("load", changes) for _ in range(3)] == [True, False, False]
    assert plain(rollup.totals().collect()) == wanted(EDGES)
    # What a run left that was lost before its commit is no batch.
    rollup.deltas(changes).write.parquet(f"{rollup.folder}/staged/other-1")
    assert plain(rollup.totals().collect()) == wanted(EDGES)


def test_two_runs_of_a_batch_at_once(spark, rollup, monkeypatch):
    """The other run commits after this one has looked."""
    changes, real = inserted(documents(spark), WORDS), rollup.deltas
    other = TokenRollup(spark, rollup.folder)

    def slow(given):
        found = real(given)
        monkeypatch.undo()
        assert other.commit("load", changes)
        return found

    monkeypatch.setattr(rollup, "deltas", slow)
    assert not rollup.commit("load", changes)
    assert plain(rollup.totals().collect()) == wanted(EDGES)


def test_what_is_all_gone_is_left_out(spark, rollup):
    docs = documents(spark)
    rollup.commit("in", inserted(docs, WORDS))
    rollup.commit("out", deleted(docs, WORDS))
    assert rollup.totals().collect() == []


def test_versions_are_kept_apart(spark, rollup):
    docs = documents(spark, [(1, "Ab1 c-d, 23", "en", "a", 1)])
    rollup.commit("1", inserted(docs, counts(F.col("text"))))
    assert plain(rollup.totals().collect()) == [("a", "en", "pieces-1", 1, 8), ("a", "en", "words-1", 1, 3)]
    rollup.commit("2", inserted(docs, {"other": F.lit(5)}))
    assert ("a", "en", "other", 1, 5) in map(tuple, rollup.totals().collect())
    with pytest.raises(KeyError):
        counts(F.col("text"), "unheard-of")
    with pytest.raises(ValueError, match="name"):
        rollup.commit("../x", inserted(docs, WORDS))


def test_pieces(spark):
    texts = ["", None, "Éa ñ'u 12 ½!? 漢字\x0b\x85", "a_b\tc"]
    import regex

    df = spark.createDataFrame([(t,) for t in texts], "t STRING").select(piece_count(F.col("t")))
    assert [row[0] for row in df.collect()] == [len(regex.findall(PIECE, t or "")) for t in texts]


def test_nothing(spark, rollup):
    assert rollup.totals().collect() == []
    assert rollup.commit("empty", inserted(documents(spark, []), WORDS))
    assert rollup.totals().collect() == []


def test_tokens_are_those_of_the_files(spark):
    """Under the tokenizer's own version, totals are what the files hold."""
    path = public_tokenizers.path("word_bpe_49k.json")
    docs = spark.read.parquet(f"{TESTDATA}/documents.parquet").unionByName(documents(spark)).select("doc_id", "source", "text")
    files = Work(spark, "count-files").path("files")
    held = write_token_files(docs, files, path, end_id=2, seq_len=128).agg({"documents": "sum", "tokens": "sum"}).first()
    rows = tokenizer_counts(docs.withColumn("text", F.coalesce("text", F.lit(""))), ["text"], path)
    assert tuple(rows.agg(F.count("*"), F.sum("text")).first()) == tuple(held)


def test_tokens_of_each_text(spark):
    path = public_tokenizers.path("word_bpe_49k.json")
    tokenizer = Tokenizer.from_file(path)
    texts = [(1, "One two", None), (2, None, "x" * 3000), (3, "", "漢字 <|endoftext|> é"), (4, "a\nb\na", "  ")]
    found = tokenizer_counts(spark.createDataFrame(texts, "`my id` INT, t STRING, u STRING"), ["t", "u"], path, end_tokens=0)
    wanted = [(i, *(None if x is None else len(tokenizer.encode(x, add_special_tokens=False).ids) for x in own)) for i, *own in texts]
    assert plain(found.collect()) == plain(wanted)


def test_repeated_lines(spark):
    texts = [("a\nb\na\n\nb", "a\nb\n"), ("a\nb", None), ("", None), (None, None), ("\n\n", "")]
    df = spark.createDataFrame([(t,) for t, _ in texts], "t STRING")
    assert [row[0] for row in df.select(unrepeated(F.col("t"))).collect()] == [wanted for _, wanted in texts]
