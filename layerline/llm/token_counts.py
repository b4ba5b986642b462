"""Token totals by source, language and tokenizer version, kept up to date by deltas.

A batch of changes becomes signed counts: what a document was worth before goes
out, what it is worth now comes in. A batch is reduced to a few rows and written
aside; renaming its folder to the batch's name commits it. A batch whose name is
there already is left alone, so a repeated or parallel run changes nothing.
Totals are the sum of what is committed, and no document is ever counted again.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Callable, Iterator, Mapping

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from layerline.llm.token_files import worker_encoder
from layerline.llm.work import word_count

KEYS = ("source", "lang", "tokenizer")
DELTAS = "source string, lang string, tokenizer string, documents long, tokens long"


PIECE = r"\p{L}+|\p{N}|[^\x20\x09-\x0D\p{L}\p{N}]"


def piece_count(text: Column) -> Column:
    """Runs of letters, single digits and single other marks."""
    return F.coalesce(F.regexp_count(text, F.lit(PIECE)), F.lit(0)).cast("long")


#: Versions of tokenizers; a changed rule is a new version, so old counts stay what they were.
TOKENIZERS: Mapping[str, Callable[[Column], Column]] = {"words-1": word_count, "pieces-1": piece_count}


def counts(text: Column, *versions: str) -> dict[str, Column]:
    """A text's count under each version, by default all; a null text counts as an empty one."""
    return {version: TOKENIZERS[version](text.cast("string")) for version in versions or TOKENIZERS}


def unrepeated(text: Column) -> Column:
    """The text without lines that it has before; NULL where it has none twice, and so is as it was."""
    lines = F.split(text, "\n")
    once = F.array_distinct(lines)
    return F.when(F.size(once) < F.size(lines), F.array_join(once, "\n"))


def tokenizer_counts(docs: DataFrame, texts: list[str], tokenizer_path: str, end_tokens: int = 1) -> DataFrame:
    """The rows with each column of ``texts`` replaced by its number of tokens, null where the text is null.

    Counted are the ids that ``token_files`` writes, ``end_tokens`` of them after each text.
    """
    with open(tokenizer_path, encoding="utf-8") as file:
        settings = docs.sparkSession.sparkContext.broadcast(file.read())
    kept = [name for name in docs.columns if name not in texts]
    types = [docs.schema[name].dataType for name in kept]
    spelled = [f"`{name}` {kind.simpleString()}" for name, kind in zip(kept, types)]
    fields = [(name, to_arrow_type(kind)) for name, kind in zip(kept, types)]
    schema = pa.schema([*fields, *((name, pa.int64()) for name in texts)])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            encoder, columns = worker_encoder(settings.value), batch.columns[: len(kept)]
            for column in batch.columns[len(kept) :]:
                there = column.is_valid().to_pylist()
                some = iter([len(ids) + end_tokens for ids in encoder.texts(column.drop_null())])
                columns.append(pa.array([next(some) if one else None for one in there], pa.int64()))
            yield pa.record_batch(columns, schema=schema)

    rows = docs.select(*kept, *[F.col(name).cast("string").alias(name) for name in texts])
    return rows.mapInArrow(count, ", ".join([*spelled, *(f"`{name}` long" for name in texts)]))


def inserted(docs: DataFrame, after: Mapping[str, Column], **columns: str) -> DataFrame:
    """``after`` has a count per tokenizer version, as ``before`` below; ``columns`` names source and lang."""
    return _change(docs, {}, after, **columns)


def deleted(docs: DataFrame, before: Mapping[str, Column], **columns: str) -> DataFrame:
    return _change(docs, before, {}, **columns)


def revised(docs: DataFrame, before: Mapping[str, Column], after: Mapping[str, Column], **columns: str) -> DataFrame:
    return _change(docs, before, after, **columns)


def _change(docs, before, after, source: str = "source", lang: str = "lang") -> DataFrame:
    """A row per document and version. A side that is null means the document is not there."""
    nothing = F.lit(None)
    sides = [
        F.struct(
            F.lit(version).alias("tokenizer"),
            before.get(version, nothing).cast("long").alias("before"),
            after.get(version, nothing).cast("long").alias("after"),
        )
        for version in sorted({*before, *after})
    ]
    keys = [F.col(source).cast("string").alias("source"), F.col(lang).cast("string").alias("lang")]
    return docs.select(*keys, F.inline(F.array(*sides)))


class TokenRollup:
    """``folder``: on a file system whose renames are atomic."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")

    def deltas(self, changes: DataFrame) -> DataFrame:
        """Signed totals of a batch: source, lang, tokenizer, documents, tokens; null is a value like any other."""
        there = F.col("after").isNotNull().cast("long") - F.col("before").isNotNull().cast("long")
        more = F.coalesce("after", F.lit(0)) - F.coalesce("before", F.lit(0))
        sums = changes.groupBy(*KEYS).agg(F.sum(there).alias("documents"), F.sum(more).alias("tokens"))
        return sums.where("documents <> 0 OR tokens <> 0")

    def commit(self, batch: str, changes: DataFrame) -> bool:
        """Whether this call committed the batch; False if it was committed before."""
        if not re.fullmatch(r"[A-Za-z0-9][A-Za-z0-9._-]*", batch):
            raise ValueError(f"a batch's name is letters, digits and . _ -, not {batch!r}")
        files, target = self._path(f"batches/{batch}")
        if files.exists(target):
            return False
        aside = f"staged/{batch}-{uuid.uuid4().hex}"
        self.deltas(changes).write.parquet(f"{self.folder}/{aside}")
        _, staged = self._path(aside)
        files.mkdirs(target.getParent())
        done = not files.exists(target) and files.rename(staged, target)
        # Where another run was faster, the rename failed or moved this folder into the other's, which totals pass over.
        late = target.suffix(f"/{staged.getName()}")
        if done and not files.exists(late):
            return True
        files.delete(late if done else staged, True)
        return False

    def totals(self) -> DataFrame:
        """The keys with documents and tokens; keys whose documents are all gone are left out. No batch, no rows."""
        files, batches = self._path("batches")
        empty = self.spark.createDataFrame([], DELTAS)
        if not files.exists(batches) or not files.listStatus(batches):
            return empty
        rows = self.spark.read.schema(DELTAS).parquet(f"{self.folder}/batches/*/part-*")
        sums = rows.groupBy(*KEYS).agg(F.sum("documents").alias("documents"), F.sum("tokens").alias("tokens"))
        return sums.where("documents <> 0 OR tokens <> 0")

    def _path(self, name: str):
        path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.folder}/{name}")
        return path.getFileSystem(self.spark._jsc.hadoopConfiguration()), path
