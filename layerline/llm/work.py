"""What the operators share: staged tables, column names that cannot clash, words."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from layerline.sources.folders import staging_folder

#: Words are runs of anything but ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"


class Work:
    """Tables that one run of an operator writes to the folder all executors share.

    A written table cuts the lineage: rows and the ids given to them are settled
    once, so a lost executor later costs a read and never a second numbering.
    """

    def __init__(self, spark: SparkSession, label: str):
        self.spark, self.folder, self.tables = spark, staging_folder(spark, label), 0

    def path(self, name: str) -> str:
        self.tables += 1
        return f"{self.folder}/{self.tables:03d}-{name}"

    def keep(self, df: DataFrame, name: str) -> DataFrame:
        path = self.path(name)
        df.write.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def drop(self, *tables: DataFrame) -> None:
        """Remove staged tables that nothing reads any more."""
        for table in tables:
            for folder in {file.rpartition("/")[0] for file in table.inputFiles()}:
                path = self.spark._jvm.org.apache.hadoop.fs.Path(folder)
                path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)


def free_names(df: DataFrame, *wanted: str) -> list[str]:
    """Names for inner columns that no column of ``df`` has, in any case."""
    taken, found = {name.lower() for name in df.columns}, []
    for name in wanted:
        own = f"__{name}"
        while own.lower() in taken:
            own += "_"
        taken.add(own.lower())
        found.append(own)
    return found


def with_results(docs: DataFrame, results: dict[str, Column]) -> DataFrame:
    """The columns of ``docs`` and the results; a result replaces a column of the same name in any case."""
    names = {name.lower() for name in results}
    kept = [docs[f"`{name}`"] for name in docs.columns if name.lower() not in names]
    return docs.select(*kept, *[column.alias(name) for name, column in results.items()])


def word_count(text: str | Column) -> Column:
    column = F.col(text) if isinstance(text, str) else text
    return F.coalesce(F.regexp_count(column, F.lit(WORD)), F.lit(0)).cast("long")
