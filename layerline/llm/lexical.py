"""Ranked lexical search: NRA over impact-sorted lists.

Terms are runs of ASCII letters and digits and of anything beyond ASCII, with only
A to Z lower-cased. A document's score for an item sums one impact per term they
share; impacts are integers and follow from numbers of the whole collection, so
they are settled before any list is read.

The collection is dealt into shards of whole documents, so a document's score is
settled within one shard. A shard holds a list per term, sorted by impact, and reads
the lists of an item's terms from the top, all of them, deeper by turns and never
by document. What has been read is a document's lower bound; for each list in
which it was not met yet, the next impact of that list is added for the upper one. An
item is done when no unread document can come in, every document that may be among
the best is known to the unit, and ties with it. What a shard gives per item is
bounded by ``top``; a window over these merges the shards.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from functools import reduce
from math import ceil, floor, log

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from layerline.llm.work import Work

#: Octets of a text that are split into terms at a time.
SLICE = 1 << 20
#: Postings of a list that are read first; each later turn reads as many as were read before.
FIRST_READ = 256
#: Postings after which a shard is full, however few documents it has.
SHARD_POSTINGS = 1 << 22

_FOLD = bytes(
    ord(chr(code).lower()) if chr(code).isascii() and chr(code).isalnum() else code if code >= 128 else 32
    for code in range(256)
)


def term_slices(text: bytes | None) -> Iterator[list[bytes]]:
    """The terms of a whole text in order, some at a time. No term is cut."""
    folded, start = (text or b"").translate(_FOLD), 0
    while start < len(folded):
        end = folded.find(b" ", start + SLICE)
        end = len(folded) if end < 0 else end
        yield folded[start:end].split()
        start = end


def term_counts(text: bytes | None) -> Counter:
    found = Counter()
    for terms in term_slices(text):
        found.update(terms)
    return found


class Shard:
    """Lists of one shard, by term: places of documents and their impacts, highest first."""

    def __init__(self, documents: int, terms: np.ndarray, places: np.ndarray, impacts: np.ndarray):
        order = np.lexsort((places, -impacts, terms))
        terms, self.places, self.impacts = terms[order], places[order], impacts[order]
        starts = np.flatnonzero(np.r_[True, terms[1:] != terms[:-1]]) if len(terms) else np.zeros(0, np.int64)
        ends = np.r_[starts[1:], len(terms)]
        self.lists = {int(terms[start]): (int(start), int(end)) for start, end in zip(starts, ends)}
        self.documents = documents

    def best(self, terms: list[int], top: int) -> tuple[np.ndarray, np.ndarray]:
        """Places and scores of all that are among the ``top`` best or tie with the last of them."""
        lists = [self.lists[term] for term in terms if term in self.lists]
        lists = [(self.places[start:end], self.impacts[start:end]) for start, end in lists]
        lower = np.zeros(self.documents, np.int64)
        read = [0] * len(lists)
        #: Lists that can still change the score of some document that may be among the best.
        open_lists = set(range(len(lists)))
        while open_lists:
            for i in open_lists:
                places, impacts = lists[i]
                until = min(len(places), max(FIRST_READ, 2 * read[i]))
                lower[places[read[i] : until]] += impacts[read[i] : until]
                read[i] = until
            # The most that a document may still get from each list in which it was not met.
            ahead = [int(impacts[at]) if at < len(impacts) else 0 for (_, impacts), at in zip(lists, read)]
            rest = sum(ahead[i] for i in open_lists)
            met = int(np.count_nonzero(lower))
            least = int(np.partition(lower, self.documents - top)[self.documents - top]) if met > top else 0
            if met <= top or rest >= least:
                # An unread document may come in; a list read to its end has no more to say.
                open_lists = {i for i in open_lists if ahead[i]}
                continue
            known = np.zeros(self.documents, np.int64)
            for i in open_lists:
                known[lists[i][0][: read[i]]] += ahead[i]
            candidates = (lower > 0) & (lower + rest - known >= least)
            some = np.count_nonzero(candidates)
            open_lists = {
                i for i in open_lists if ahead[i] and np.count_nonzero(candidates[lists[i][0][: read[i]]]) < some
            }
        least = np.partition(lower, self.documents - top)[self.documents - top] if self.documents > top else 0
        found = np.flatnonzero(lower >= max(1, least))
        return found, lower[found]


def _item_groups(items: DataFrame, query_bytes: int) -> list[DataFrame]:
    """The items in groups whose texts come to about ``query_bytes`` each. A single longer text is a group's most."""
    total = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    groups = max(1, ceil(total / query_bytes))
    return [items.where(F.pmod(F.xxhash64("item", F.lit(13)), F.lit(groups)) == i) for i in range(groups)]


def ranked_documents(
    docs: DataFrame,
    items: DataFrame,
    *,
    top: int = 50,
    doc_id: str = "doc_id",
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    shard_documents: int = 16_384,
    query_bytes: int = 16 * 1024 * 1024,
) -> DataFrame:
    """A row per item and ranked document: item_id, rank, doc_id, score.

    All documents are ranked for each item, each row of either a document or item of
    its own; equal scores go by ascending doc_id, null last, and ranks are unique.
    Documents without a shared term, or whose shared terms weigh nothing, have no
    score and no rank; null and empty texts have no terms. Items whose texts exceed
    ``query_bytes`` together are searched in groups, each a pass over the documents, so
    what is sent to the tasks is bounded. Other columns are not read.
    """
    spark = docs.sparkSession
    work = Work(spark, "lexical")
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).cast("string").cast("binary").alias("text"))
    items = items.select(
        F.monotonically_increasing_id().alias("item"),
        F.col(item_id).alias("item_id"),
        F.col(item_text).cast("string").cast("binary").alias("text"),
    )
    items = work.keep(items, "items")
    hits = [
        work.keep(_hits(work, rows, group, top, shard_documents), "hits") for group in _item_groups(items, query_bytes)
    ]
    hits = reduce(DataFrame.unionAll, hits)
    # What the shards give is cut to the best of each task before it moves.
    order = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    ranked = hits.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    return ranked.join(items.select("item", "item_id"), "item").select("item_id", "rank", "doc_id", "score")


def _hits(work: Work, rows: DataFrame, items: DataFrame, top: int, shard_documents: int) -> DataFrame:
    spark = rows.sparkSession
    wanted = [(row.item, [*term_counts(bytes(row.text or b""))]) for row in items.collect()]
    vocabulary: dict[bytes, int] = {}
    wanted = [(item, [vocabulary.setdefault(term, len(vocabulary)) for term in terms]) for item, terms in wanted]
    sent = spark.sparkContext.broadcast(vocabulary)
    id_type = to_arrow_type(rows.schema["doc_id"].dataType)
    counted_schema = pa.schema(
        [("doc_id", id_type), ("n", pa.int64()), ("terms", pa.list_(pa.int32())), ("counts", pa.list_(pa.int64()))]
    )

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place_of = sent.value.get
        for batch in batches:
            sizes, terms, counts = [], [], []
            for one in batch.column(1):
                n, found = 0, Counter()
                for some in term_slices(one.as_py()):
                    n += len(some)
                    found.update(map(place_of, some))
                found.pop(None, None)
                sizes.append(n)
                terms.append([*found.keys()])
                counts.append([*found.values()])
            columns = [pa.array(x, t) for x, t in zip((sizes, terms, counts), counted_schema.types[1:])]
            yield pa.record_batch([batch.column(0).cast(id_type), *columns], schema=counted_schema)

    spelled = f"doc_id {rows.schema['doc_id'].dataType.simpleString()}"
    columns = f"{spelled}, n long, terms array<int>, counts array<long>"
    counted = work.keep(rows.mapInArrow(count, columns), "counts")
    documents, length = counted.where("n > 0").agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()
    # As many rows as the items have terms, which query_bytes bounds.
    frequencies = counted.select(F.explode("terms").alias("term")).groupBy("term").count().collect()
    weights = np.zeros(len(vocabulary), np.int64)
    for term, frequency in frequencies:
        weights[term] = floor(1000 * log((2 * documents + 2) / (2 * frequency + 1)))
    wanted = [(item, [term for term in terms if weights[term] > 0]) for item, terms in wanted]
    searched = spark.sparkContext.broadcast((wanted, weights))
    hit_schema = pa.schema([("item", pa.int64()), ("doc_id", id_type), ("score", pa.int64())])

    def searched_shard(batches: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items, weight = searched.value
        table = pa.Table.from_batches(batches)
        ids, lists, tf = (table.column(i).combine_chunks() for i in (0, 2, 3))
        term = lists.flatten().to_numpy().astype(np.int64)
        tf = tf.flatten().to_numpy()
        spans = lists.value_lengths().to_numpy()
        place = np.repeat(np.arange(len(ids)), spans)
        m = np.array([50 + 50 * n * documents // length for n in table.column(1).to_pylist()], np.int64)
        impact = weight[term] * (1_000_000_000 * tf // (1000 * tf + 20 * m[place]))
        some = impact > 0
        shard = Shard(len(ids), term[some], place[some], impact[some])
        names = ids.to_pylist()
        found = []
        for item, terms in items:
            places, scores = shard.best(terms, top)
            best = [(-score, names[at] is None, names[at], at) for at, score in zip(places.tolist(), scores.tolist())]
            best.sort(key=lambda one: (one[0], one[1], [] if one[1] else [one[2]], one[3]))
            found += [(item, name, -score) for score, _, name, _ in best[:top]]
        if found:
            yield pa.record_batch([pa.array(x, t) for x, t in zip(zip(*found), hit_schema.types)], schema=hit_schema)

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, documents_held, postings_held = [], 0, 0
        for batch in batches:
            step = max(1, shard_documents // 4)
            for at in range(0, batch.num_rows, step):
                piece = batch.slice(at, step)
                postings = len(piece.column(2).flatten())
                full = documents_held + piece.num_rows > shard_documents or postings_held + postings > SHARD_POSTINGS
                if held and full:
                    yield from searched_shard(held)
                    held, documents_held, postings_held = [], 0, 0
                held.append(piece)
                documents_held += piece.num_rows
                postings_held += postings
        if held:
            yield from searched_shard(held)

    return counted.where(F.size("terms") > 0).mapInArrow(search, f"item long, {spelled}, score long")
