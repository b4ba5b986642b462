"""Mix sources to target weights.

Every document gets a random key, a hash of its id. In the order of the keys
each source's documents are taken until the source's budget of words is used up,
from the start again if the budget is more than the source holds. The order is
never gathered: the keys are uniform, so a fixed range of them is a bucket of
about equal size, a running sum over bucket totals finds the bucket in which a
source's budget ends, and only the rows of those buckets are sorted. What comes
out is one cut per source (a key and the words left at it), and each document
compares its own key with its source's cut.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from layerline.llm.work import WORD, Work, free_names, with_results, word_count

#: Hex digits of a key: 60 bits, so that keys stay positive longs.
KEY_DIGITS = 15


def random_key(doc_id: Column, seed: int) -> Column:
    """Also SQL has md5, so the order can be checked there."""
    text = F.concat(F.coalesce(doc_id.cast("string"), F.lit("")), F.lit(f":{seed}"))
    return F.conv(F.substring(F.md5(text), 1, KEY_DIGITS), 16, 10).cast("long")


def source_targets(
    work: Work, sources: DataFrame, weights: Sequence[float], share: float, max_epochs: int
) -> DataFrame:
    """``sources``: source, source_size. Adds each source's target.

    Weights go by the order of the names (code points, null last) and repeat. A
    target stops at ``max_epochs`` times the source; what is above is shared by
    weight among the others until none is above. One row of sums reaches the
    driver per round, however many sources there are.
    """
    spark = work.spark
    ordered = sources.orderBy(F.col("source").asc_nulls_last())
    schema = "source string, source_size long, place long"
    numbered = spark.createDataFrame(ordered.rdd.zipWithIndex().map(lambda x: (x[0][0], x[0][1], x[1])), schema)
    weight = F.element_at(
        F.array(*[F.lit(float(w)) for w in weights]), (F.col("place") % len(weights) + 1).cast("int")
    )
    weighed = work.keep(numbered.select("source", "source_size", weight.alias("weight")), "weights")
    most = F.col("source_size") * F.lit(float(max_epochs))
    total = share * (weighed.agg(F.sum("source_size")).first()[0] or 0)
    level, full = 0.0, -1
    while True:
        above = most < F.col("weight") * F.lit(level)
        row = weighed.agg(
            F.count_if(above).alias("full"),
            F.sum(F.when(above, most).otherwise(0.0)).alias("used"),
            F.sum(F.when(~above, F.col("weight")).otherwise(0.0)).alias("rest"),
        ).first()
        if row.full == full or not row.rest:
            break
        level, full = (total - row.used) / row.rest, row.full
    return weighed.withColumn("target", F.least(most, F.col("weight") * F.lit(level))).drop("weight")


def mix(
    docs: DataFrame,
    *,
    doc_id: str = "doc_id",
    source: str = "source",
    text: str = "text",
    weights: Sequence[float] = (3, 1, 2),
    share: float = 1.5,
    max_epochs: int = 2,
    seed: int = 20,
) -> DataFrame:
    """The documents with ``size``, ``source_size``, ``target`` and ``taken`` (words, repeats counted).

    The targets share ``share`` of all words. A source's taken words add up to
    its target rounded down: the document at which the budget ends is taken in
    part. Null text has no words; null is a source like any other; documents
    with one key (a repeated id) share what is left at the cut by their size;
    rows with a null id share one key. An empty table gives an empty result.
    Columns of ``docs`` that bear a result's name are replaced.
    """
    work = Work(docs.sparkSession, "mix")
    rows = docs.select(
        F.col(source).alias("source"),
        random_key(F.col(doc_id), seed).alias("key"),
        word_count(F.col(text)).alias("size"),
    )
    rows = work.keep(rows, "sizes")
    # As many buckets as rows in one, so that neither the sums nor a bucket's rows are many.
    buckets = math.isqrt(rows.count()) + 1
    rows = rows.withColumn("bucket", F.floor(F.col("key") / F.lit(16**KEY_DIGITS / buckets)).cast("long"))
    sums = work.keep(rows.groupBy("source", "bucket").agg(F.sum("size").alias("words")), "buckets")
    sources = source_targets(
        work, sums.groupBy("source").agg(F.sum("words").alias("source_size")), weights, share, max_epochs
    )

    size, budget = F.col("source_size"), F.floor("target")
    epochs = F.when(size > 0, F.floor(budget / size)).otherwise(0).cast("long")
    sources = sources.withColumn("epochs", epochs).withColumn("left", budget - epochs * size)
    sources = work.keep(sources, "targets")
    before = F.sum("words").over(Window.partitionBy("source").orderBy("bucket")) - F.col("words")
    ends = (
        sums.withColumn("before", before)
        .join(sources.withColumnRenamed("source", "of"), F.col("source").eqNullSafe(F.col("of")))
        .where((F.col("before") <= F.col("left")) & (F.col("left") < F.col("before") + F.col("words")))
        .select("of", F.col("bucket").alias("in"), F.col("left") - F.col("before"))
        .toDF("of", "in", "inside")
    )
    # Rows of one key are one step of the running sum.
    steps = (
        rows.join(ends, F.col("source").eqNullSafe(F.col("of")) & (F.col("bucket") == F.col("in")))
        .groupBy("source", "key", "inside")
        .agg(F.sum("size").alias("words"))
    )
    before = F.sum("words").over(Window.partitionBy("source").orderBy("key")) - F.col("words")
    cuts = (
        steps.withColumn("before", before)
        .where((F.col("before") <= F.col("inside")) & (F.col("inside") < F.col("before") + F.col("words")))
        .select(
            F.col("source").alias("at"),
            F.col("key").alias("cut_key"),
            F.col("words").alias("cut_words"),
            (F.col("inside") - F.col("before")).alias("cut_left"),
        )
    )
    plan = sources.join(cuts, F.col("source").eqNullSafe(F.col("at")), "left").drop("at")
    # Under names that no column of the documents has.
    named = dict(zip(plan.columns, free_names(docs, *plan.columns)))
    own_key, own_size = free_names(docs, "own_key", "own_size")
    plan = work.keep(plan.select([F.col(c).alias(name) for c, name in named.items()]), "cuts")
    of = {c: F.col(name) for c, name in named.items()}

    own, size = F.col(own_key), F.col(own_size)
    share_of_cut = F.floor(of["cut_left"] * size / of["cut_words"])
    once_more = F.when(own < of["cut_key"], size).when(own == of["cut_key"], share_of_cut).otherwise(0)
    keyed = docs.withColumns({own_key: random_key(F.col(doc_id), seed), own_size: word_count(F.col(text))})
    joined = keyed.join(plan, F.col(source).eqNullSafe(of["source"]))
    mixed = with_results(
        joined,
        {
            "size": size,
            "source_size": of["source_size"],
            "target": of["target"],
            "taken": (of["epochs"] * size + once_more).cast("long"),
        },
    )
    return mixed.drop(own_key, own_size, *plan.columns)


def mixed_copies(
    docs: DataFrame, *, doc_id: str = "doc_id", source: str = "source", text: str = "text", **more
) -> DataFrame:
    """``mixed_documents`` of ``mix`` with exactly the columns of ``docs``, also those that bear a result's name."""
    apart = docs.toDF(*[f"__of_{name}" for name in docs.columns])
    mixed = mix(apart, doc_id=f"__of_{doc_id}", source=f"__of_{source}", text=f"__of_{text}", **more)
    return mixed_documents(mixed, f"__of_{text}").toDF(*docs.columns)


def mixed_documents(mixed: DataFrame, text: str = "text") -> DataFrame:
    """``mix``'s documents, each as often as it is taken.

    Whole copies keep their text. The one document of a source at which the
    budget ends keeps the words up to the cut, joined by spaces.
    """
    size, taken = F.col("size"), F.col("taken")
    left = taken - (F.col("__copy") - 1) * size
    words = F.slice(F.regexp_extract_all(F.col(text), F.lit(WORD), F.lit(0)), F.lit(1), left.cast("int"))
    copies = F.sequence(F.lit(1), F.ceil(taken / size).cast("int"))
    repeated = mixed.where(taken > 0).withColumn("__copy", F.explode(copies))
    cut = F.when(left >= size, F.col(text)).otherwise(F.array_join(words, " "))
    return repeated.withColumn(text, cut).drop("__copy", "size", "source_size", "target", "taken")
