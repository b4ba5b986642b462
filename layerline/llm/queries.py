"""A query per operator over its whole table, with production parameters, and the SQL it must agree with."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from layerline.llm import sql
from layerline.llm.decontaminate import benchmark_overlaps
from layerline.llm.exact_dedup import exact_duplicates
from layerline.llm.language import identify_languages
from layerline.llm.lexical import ranked_documents
from layerline.llm.licences import licence_matches
from layerline.llm.line_dedup import html_lines, without_boilerplate
from layerline.llm.mixing import mix
from layerline.llm.secrets import find_secrets, secret_digests
from layerline.llm.simhash import near_duplicates
from layerline.llm.token_counts import (
    TokenRollup,
    counts,
    deleted,
    inserted,
    revised,
    tokenizer_counts,
    unrepeated,
)
from layerline.llm.token_files import read_documents, write_token_files
from layerline.llm.vector_codes import compress_vectors
from layerline.llm.vector_links import embedding_links
from layerline.llm.work import Work


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def op1_exact_dedup(spark, sf_dir):
    return exact_duplicates(table(spark, sf_dir, "documents")).drop("level", "name")


def op2_token_files(spark, sf_dir):
    files = Work(spark, "token-files").path("files")
    tokenizer = public_tokenizers.path("word_bpe_49k.json")
    manifest = write_token_files(table(spark, sf_dir, "documents"), files, tokenizer, end_id=2, seq_len=2048)
    return read_documents(manifest).drop("path")


def op3_token_counts(spark, sf_dir):
    """Words and pieces by rules that SQL can follow."""
    cleaned = unrepeated(F.col("text"))
    before, after = counts(F.col("text")), {name: F.when(cleaned.isNotNull(), n) for name, n in counts(cleaned).items()}
    return _token_totals(spark, sf_dir, lambda docs: docs.select(
        "doc_id",
        "source",
        "lang",
        *[column.alias(version) for version, column in before.items()],
        *[column.alias(f"cleaned {version}") for version, column in after.items()],
    ), [*before])


def token_counts_word_bpe(spark, sf_dir):
    """The same life of the documents, in tokens of the vocabulary whose files op2 writes, end ids included."""
    version = "word-bpe-49k"
    tokenizer = public_tokenizers.path("word_bpe_49k.json")

    def counted(docs):
        texts = {version: F.coalesce("text", F.lit("")), f"cleaned {version}": unrepeated(F.col("text"))}
        rows = docs.select("doc_id", "source", "lang", *[text.alias(name) for name, text in texts.items()])
        return tokenizer_counts(rows, [*texts], tokenizer)

    return _token_totals(spark, sf_dir, counted, [version])


def _token_totals(spark, sf_dir, counted, versions):
    """All documents come in; toxic ones go; those of low quality lose repeated lines; a batch arrives twice.

    Texts are read once, whatever the batches concern: each document's counts, before and after
    the cleaning, are written down, and the batches are made of these numbers.
    """
    work, labels = Work(spark, "token-counts"), table(spark, sf_dir, "labels")
    rows = work.keep(counted(table(spark, sf_dir, "documents")), "counts")
    toxic = rows.join(labels.where("toxic = 1"), "doc_id", "left_semi")
    poor = rows.join(labels.where("quality = 0"), "doc_id", "left_semi")
    poor = poor.join(labels.where("toxic = 1"), "doc_id", "left_anti")
    before = {version: F.col(f"`{version}`") for version in versions}
    after = {version: F.coalesce(F.col(f"`cleaned {version}`"), before[version]) for version in versions}

    rollup = TokenRollup(spark, work.path("rollup"))
    rollup.commit("load", inserted(rows, before))
    rollup.commit("takedown", deleted(toxic, before))
    rollup.commit("cleaning", revised(poor, before, after))
    rollup.commit("takedown", deleted(toxic, before))
    return rollup.totals()


def op4_language_id(spark, sf_dir):
    return identify_languages(table(spark, sf_dir, "documents"))


def op5_decontamination(spark, sf_dir):
    found = benchmark_overlaps(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.drop("text_hash")


def op6_simhash_near_dedup(spark, sf_dir):
    return near_duplicates(table(spark, sf_dir, "documents"), words=3, radius=2)


def op7_licence_scan(spark, sf_dir):
    return licence_matches(table(spark, sf_dir, "documents"), parts=True)


def op8_line_dedup(spark, sf_dir):
    pages = table(spark, sf_dir, "pages").select("page_id", "url", html_lines(F.col("html")).alias("text"))
    pages = without_boilerplate(pages, text=F.col("text"))
    return pages.select("page_id", "host", "text", "n_lines", "n_dropped")


def op9_secret_scan(spark, sf_dir):
    return secret_digests(find_secrets(table(spark, sf_dir, "documents")))


def op10_source_mixing(spark, sf_dir):
    mixed = mix(table(spark, sf_dir, "documents"), weights=(3, 1, 2), share=1.5, max_epochs=2, seed=20)
    return mixed.select("doc_id", "size", "source_size", F.round("target", 3).alias("target"), "taken")


def op11_embedding_near_dedup(spark, sf_dir):
    return embedding_links(table(spark, sf_dir, "embeddings"), threshold=0.9)


def op12_vector_codes(spark, sf_dir):
    return compress_vectors(table(spark, sf_dir, "embeddings"), parts=16, entries=64, rounds=2, scale=256)


def op13_lexical_search(spark, sf_dir):
    return ranked_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), top=50)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_exact_dedup": op1_exact_dedup,
    "op2_token_files": op2_token_files,
    "op3_token_counts": op3_token_counts,
    "token_counts_word_bpe": token_counts_word_bpe,
    "op4_language_id": op4_language_id,
    "op5_decontamination": op5_decontamination,
    "op6_simhash_near_dedup": op6_simhash_near_dedup,
    "op7_licence_scan": op7_licence_scan,
    "op8_line_dedup": op8_line_dedup,
    "op9_secret_scan": op9_secret_scan,
    "op10_source_mixing": op10_source_mixing,
    "op11_embedding_near_dedup": op11_embedding_near_dedup,
    "op12_vector_codes": op12_vector_codes,
    "op13_lexical_search": op13_lexical_search,
}

ORACLE_SQL: dict[str, str] = {
    "op1_exact_dedup": sql.EXACT_DEDUP,
    "op3_token_counts": sql.TOKEN_COUNTS,
    "op7_licence_scan": sql.LICENCES,
    "op8_line_dedup": sql.LINES,
    "op9_secret_scan": sql.SECRETS,
    "op10_source_mixing": sql.SOURCE_MIXING,
    "op11_embedding_near_dedup": sql.EMBEDDING_LINKS,
    "op12_vector_codes": sql.VECTOR_CODES,
    "op13_lexical_search": sql.RANKED_DOCUMENTS,
}
