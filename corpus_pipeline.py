"""From raw documents to token files: language, near duplicates, benchmark passages, mix, tokens.

Each stage takes all that the one before kept, as Parquet, and calls one operator
of ``layerline.llm``. The last returns a row per document of the token files.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from layerline.llm.decontaminate import without_benchmark
from layerline.llm.language import held_out, learn_languages
from layerline.llm.mixing import mixed_copies
from layerline.llm.simhash import without_near_duplicates
from layerline.llm.token_files import read_documents, write_token_files
from layerline.llm.work import Work, free_names

#: Unrelated vectors of 1,024 dimensions have a cosine of about 0.03 either way; a text below this is like no known language.
LEAST_SCORE = 0.05
#: From so many different n-grams on a text in a learned language stands clear of that (0.19 and more in sf0.1);
#: with fewer, a low cosine says nothing.
LEAST_NGRAMS = 40


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a known language; those without letters, or unlike every language, go.

    Texts too short to tell, and all texts where no language was learned, stay if they have a letter.
    """
    model = learn_languages(docs.where(~held_out(F.col("doc_id"))))
    (name,) = free_names(docs, "found")
    found, own = docs.withColumn(name, model.predict(F.col("text"))), F.col(name)
    known = (own["score"] >= LEAST_SCORE) | (own["ngrams"] < LEAST_NGRAMS) | F.lit(not model.languages)
    return found.where((own["ngrams"] > 0) & known).drop(name)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates, the one with the smallest id."""
    return without_near_duplicates(docs, words=3, radius=2)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of the benchmark."""
    return without_benchmark(docs, spark.read.parquet(f"{sf_dir.rstrip('/')}/benchmark.parquet"))


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it; the one at which a source's budget ends, up to the cut."""
    return mixed_copies(docs, weights=(3, 1, 2), share=1.5, max_epochs=2, seed=20)


def token_output(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Writes the token files and returns what they hold, a row per document."""
    folder = Work(spark, "pipeline-tokens").path("files")
    manifest = write_token_files(docs, folder, public_tokenizers.path("word_bpe_49k.json"), end_id=2, seq_len=2048)
    return read_documents(manifest)


STAGES = [
    ("language", language),
    ("near_dedup", near_dedup),
    ("decontamination", decontamination),
    ("mixing", mixing),
    ("token_output", token_output),
]
#: Fingerprints, learned prototypes and token ids are beyond SQL; tests/llm holds the brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")
    work = Work(spark, "pipeline")
    for name, stage in STAGES[:-1]:
        docs = work.keep(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
