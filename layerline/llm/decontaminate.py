"""Benchmark passages in documents, found with spaced seeds.

A seed is a window of words of which a fixed mask ignores some, so that a copy
with changed words still shares seeds with its original. The benchmark's seeds and
the documents' are hashed and joined on the hash; around each hit the two texts
are laid over one another and the stretch of agreement is verified word by word.

Most windows of the documents match nothing. A Bloom filter of the benchmark's
hashes, of at most 32 MB however large the benchmark is, drops them
where the documents are read; the join then decides on what is left. Windows that
pass are gathered into regions with some context, so the verification reads
regions and never the documents again.

Items of a few words would make seeds of a word or two, the most frequent there are.
They are matched as whole lines, by one hash, and the other short items share masks.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections.abc import Iterator, Sequence
from functools import reduce
from itertools import combinations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from layerline.llm.work import Work, free_names

#: 1 counts, 0 is ignored. Found by search: whichever fifth of 12 to 23 words in a row differs, one of these fits
#: somewhere on the others. A longer stretch holds one of these lengths that is as alike, so each that counts shares a seed.
MASKS = ("10100001111", "1111011", "11101101", "1110010011001")
#: For short items: at most so many masks, searched as long as no more than so many ways to differ are to be covered.
SHORT_MASKS, SHORT_PATTERNS = 4, 500
#: Items shorter than these share no masks with others, since a mask fits into all that it serves.
LEAST_SHARED = 7
#: The filter's size: so many bits per hash, within these bounds, twice.
BITS_PER_HASH, LEAST_BITS, FILTER_BITS, PROBES = 64, 1 << 16, 1 << 27, 5
#: Octets of the filter that come to the driver in one row.
BLOCK = 1 << 16
#: Words before and after a hit that go with it.
CONTEXT = 256
#: How many items of a seed are tried on a region at a time: at first, and times so many each time that none was in it.
FIRST_TRIED, MORE_TRIED = 1, 8
REMEMBERED_WORDS = 400_000
WORDS = re.compile(r"[^\W_]+")


class WordHashes(dict):
    def __missing__(self, word: str) -> int:
        if len(self) >= REMEMBERED_WORDS:
            self.clear()
        self[word] = found = xxhash.xxh64_intdigest(word, 5)
        return found

    def of(self, text: str | None) -> np.ndarray:
        """Hashes of the lower-cased words: runs of letters and digits of any alphabet."""
        words = WORDS.findall((text or "").lower())
        return np.fromiter(map(self.__getitem__, words), dtype=np.uint64, count=len(words))


def _least(words: int, least_words: int, similarity: float) -> int:
    """The words that a stretch needs of an item of so many."""
    return max(1, min(least_words, math.ceil(round(words * similarity, 9))))


def short_masks(sizes: Sequence[int], similarity: float) -> tuple[str, ...]:
    """For stretches of these sizes, too short for the masks of long ones: whichever words of one that counts differ, one fits.

    The heaviest masks of which a few cover every such stretch. Where the ways to differ are too many to
    search, the longest run of agreeing words that none of them can avoid.
    """
    changes = {size: math.floor(round(size * (1 - similarity), 9)) for size in sizes}
    run = max(1, min(-(-(size - changed) // (changed + 1)) for size, changed in changes.items()))
    if sum(math.comb(size, changed) for size, changed in changes.items()) > SHORT_PATTERNS:
        return ("1" * run,)
    patterns = []
    for size, changed in changes.items():
        patterns += [(size, sum(1 << i for i in set(range(size)) - set(gone))) for gone in combinations(range(size), changed)]
    for weight in range(min(alike.bit_count() for _, alike in patterns), run, -1):
        covers = {}
        for span in range(weight, max(changes) + 1):
            for gaps in combinations(range(1, span - 1), span - weight):
                mask = sum(1 << i for i in set(range(span)) - set(gaps))
                fits = [any(alike >> at & mask == mask for at in range(size - span + 1)) for size, alike in patterns]
                covers["".join("01"[mask >> i & 1] for i in range(span))] = sum(1 << i for i, fit in enumerate(fits) if fit)
        found, left = [], (1 << len(patterns)) - 1
        while left and len(found) < SHORT_MASKS:
            found.append(max(covers, key=lambda mask: (covers[mask] & left).bit_count()))
            left &= ~covers[found[-1]]
        if not left:
            return tuple(found)
    return ("1" * run,)


def masks_by_length(
    lengths: Sequence[int], masks: Sequence[str], least_words: int, similarity: float, least_item_words: int
) -> dict[int, tuple[str, ...]]:
    """The masks of items of so many words, for the lengths that are here; none for those matched as lines."""
    found, shared = {}, []
    for words in lengths:
        least = _least(words, least_words, similarity)
        if words < least_item_words:
            found[words] = ()
        elif least >= least_words:
            found[words] = tuple(masks)
        elif least >= LEAST_SHARED:
            shared.append(words)
        else:
            found[words] = short_masks(range(least, words + 1), similarity)
    if shared:
        sizes = range(_least(min(shared), least_words, similarity), max(shared) + 1)
        found |= dict.fromkeys(shared, short_masks(sizes, similarity))
    return found


def _factor(place: int) -> np.uint64:
    return np.uint64(xxhash.xxh64_intdigest(f"place {place}", 6) | 1)


class Seeds:
    """Hashes of a text's windows under any mask: the sum of its counted words, each times a factor of its place."""

    def __init__(self, words: np.ndarray):
        self.words, self.placed = words, {}

    def of(self, mask: str) -> np.ndarray:
        """A hash for each place at which the mask fits."""
        count = max(0, len(self.words) - len(mask) + 1)
        found = np.full(count, xxhash.xxh64_intdigest(mask, 6), dtype=np.uint64)
        for place, counts in enumerate(mask):
            if counts == "1":
                if place not in self.placed:
                    self.placed[place] = self.words * _factor(place)
                found += self.placed[place][place : place + count]
        found ^= found >> np.uint64(29)
        return found * np.uint64(0x9E3779B97F4A7C15)


class Bloom:
    """``first`` has a byte per entry and is looked up by a hash's top bits; few hashes get on to the other probes."""

    def __init__(self, first: np.ndarray, octets: np.ndarray):
        self.first, self.octets = first, octets

    @classmethod
    def empty(cls, bits: int) -> Bloom:
        return cls(np.zeros(bits // 8, dtype=bool), np.zeros(bits // 8, dtype=np.uint8))

    def first_place(self, hashes: np.ndarray) -> np.ndarray:
        return hashes >> np.uint64(65 - len(self.first).bit_length())

    def probe(self, hashes: np.ndarray, i: int) -> np.ndarray:
        mixed = hashes * np.uint64(2 * i + 0xD6E8FEB86659FD93)
        return (mixed >> np.uint64(20)) & np.uint64(len(self.octets) * 8 - 1)

    def passing(self, hashes: np.ndarray) -> np.ndarray:
        """The places of the hashes that may be in the set."""
        places = np.flatnonzero(self.first[self.first_place(hashes)])
        for i in range(PROBES):
            at = self.probe(hashes[places], i)
            places = places[(self.octets[at >> np.uint64(3)] >> (at & np.uint64(7)).astype(np.uint8)) & 1 == 1]
        return places


#: Parts the hash of a whole line from that of the same words elsewhere.
_LINE = np.uint64(0x5851F42D4C957F2D)


def line_seed(words: np.ndarray) -> np.ndarray:
    return Seeds(words).of("1" * len(words)) ^ _LINE


def _item_seeds(batches: Iterator[pd.DataFrame], masks: dict[int, tuple[str, ...]]) -> Iterator[pd.DataFrame]:
    hashes = WordHashes()
    for batch in batches:
        out = []
        for item, text in zip(batch["item"], batch["text"]):
            words = hashes.of(text)
            hashed = Seeds(words)
            seeds = [hashed.of(mask) for mask in masks.get(len(words), ())]
            if 0 < len(words) and not seeds:
                seeds = [line_seed(words)]
            for one in seeds:
                out += [(item, place, seed) for place, seed in enumerate(one.view(np.int64).tolist())]
        yield pd.DataFrame(out, columns=["item", "place", "seed"]).astype({"place": "int32", "seed": "int64"})


def _lengths(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        yield pd.DataFrame({"words": [len(WORDS.findall(text.lower())) for text in batch["text"]]})


def _filter(hashes: DataFrame) -> Bloom:
    """A filter of the hashes. Spark puts its bytes together; what comes here is bounded by its size."""
    bits = 1 << max(LEAST_BITS, min(FILTER_BITS, hashes.count() * BITS_PER_HASH)).bit_length() - 1

    def parts(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        bloom = Bloom.empty(bits)
        for batch in batches:
            own = batch["seed"].to_numpy().view(np.uint64)
            at = np.concatenate([bloom.probe(own, i) for i in range(PROBES)])
            octets = np.concatenate([bloom.first_place(own), at >> np.uint64(3)]).astype("int64")
            bit = np.concatenate([np.zeros(len(own), "int32"), np.left_shift(1, (at & np.uint64(7)).astype("int32"))])
            yield pd.DataFrame({"first": bit == 0, "octet": octets, "bit": np.maximum(bit, 1).astype("int32")})

    found = hashes.mapInPandas(parts, "first boolean, octet long, bit int")
    found = found.groupBy("first", "octet").agg(F.bit_or("bit").alias("bits"))

    def block(rows: pd.DataFrame) -> pd.DataFrame:
        octets = np.zeros(BLOCK, np.uint8)
        octets[rows["octet"].to_numpy() % BLOCK] = rows["bits"].to_numpy()
        return pd.DataFrame({"first": rows["first"].iloc[:1], "block": rows["octet"].iloc[0] // BLOCK, "octets": octets.tobytes()})

    blocks = found.groupBy("first", F.floor(F.col("octet") / BLOCK)).applyInPandas(block, "first boolean, block long, octets binary")
    bloom = Bloom.empty(bits)
    # At most 32 MB, in one job; an iterator would start one for each shuffle partition.
    for row in blocks.collect():
        part = slice(row.block * BLOCK, (row.block + 1) * BLOCK)
        octets = np.frombuffer(row.octets, np.uint8)[: len(bloom.octets) - row.block * BLOCK]
        if row.first:
            bloom.first[part] = octets > 0
        else:
            bloom.octets[part] = octets
    return bloom


def _regions(hit: np.ndarray, words: int, span: int) -> Iterator[tuple[int, int, int, int]]:
    """(first hit, last hit, start, end) of stretches of hits whose contexts touch, in words."""
    if not len(hit):
        return
    first = previous = int(hit[0])
    for place in [*hit[1:].tolist(), None]:
        if place is None or place - previous > 2 * CONTEXT:
            yield first, previous, max(0, first - CONTEXT), min(words, previous + span + CONTEXT)
            first = place
        previous = place


class _Search:
    """What the documents and the benchmark have in common by seeds: regions of documents, and hits in them."""

    def __init__(self, docs, benchmark, doc_id, text, item_id, item_text, masks, least_words, similarity, least_item_words):
        spark, self.work = docs.sparkSession, Work(docs.sparkSession, "decontaminate")
        self.least_words, self.similarity = least_words, similarity
        items = benchmark.select(F.col(item_id).alias("item"), F.col(item_text).cast("string").alias("text"))
        items = items.where("text IS NOT NULL").withColumn("item_key", F.monotonically_increasing_id())
        self.items = self.work.keep(items, "items")
        self.keyed = self.items.select(F.col("item_key").alias("item"), "text")

        # The lengths that call for masks of their own are few; all others have those of long items.
        lengths = self.keyed.mapInPandas(_lengths, "words int").distinct().where("words > 0")
        long = math.ceil(least_words / similarity) + least_item_words
        short = [row.words for row in lengths.where(F.col("words") < long).collect()]
        some_long = not lengths.where(F.col("words") >= long).isEmpty()
        by_length = masks_by_length(sorted(short), masks, least_words, similarity, least_item_words)
        longest = max([span_of(masks), *short, 0])
        used = list(dict.fromkeys([*(mask for own in by_length.values() for mask in own), *(masks if some_long else ())]))
        lines = max([words for words, own in by_length.items() if not own], default=0)
        long_masks = tuple(masks)

        def item_seeds(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            yield from _item_seeds(batches, _Defaults(long_masks, by_length))

        self.seeds = self.work.keep(self.keyed.mapInPandas(item_seeds, "item long, place int, seed long"), "item-seeds")
        bloom = _filter(self.seeds.select("seed").distinct())
        bloom = spark.sparkContext.broadcast((bloom.first, bloom.octets))

        def hits(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            hashes, known = WordHashes(), Bloom(*bloom.value)
            for batch in batches:
                out = []
                for one, content in zip(batch["id"], batch["text"]):
                    words, begins, seeds = _document_seeds(hashes, content, used, lines)
                    passed = known.passing(seeds)
                    if not len(passed):
                        continue
                    places, own = begins[passed], seeds[passed]
                    order = np.argsort(places, kind="stable")
                    places, own = places[order].astype(np.int32), own[order].view(np.int64)
                    digest = hashlib.sha256(content.encode()).hexdigest()
                    for first, last, start, end in _regions(np.unique(places), len(words), longest):
                        inside = slice(np.searchsorted(places, first), np.searchsorted(places, last, "right"))
                        out.append((one, digest, start, words[start:end].view(np.int64), places[inside], own[inside]))
                names = ["id", "text_hash", "start", "words", "places", "seeds"]
                yield pd.DataFrame(out, columns=names).astype({"start": "int32"})

        rows = docs.select(F.col(doc_id).alias("id"), F.col(text).cast("string").alias("text"))
        id_type = docs.schema[doc_id].dataType.simpleString()
        schema = f"id {id_type}, text_hash string, start int, words array<long>, places array<int>, seeds array<long>"
        regions = rows.mapInPandas(hits, schema).withColumn("region", F.monotonically_increasing_id())
        self.regions = self.work.keep(regions, "regions")
        hit = self.regions.select("region", F.explode(F.arrays_zip("places", "seeds")).alias("hit"))
        self.hits = hit.select("region", F.col("hit.places").alias("doc_place"), F.col("hit.seeds").alias("seed"))

    def overlays(self, hits: DataFrame, seeds: DataFrame) -> DataFrame:
        """Overlaps by the seeds' distance between the texts: all hits of one overlay are one candidate."""
        overlay = hits.join(seeds.select("item", "place", "seed"), "seed")
        return overlay.select("region", "item", (F.col("doc_place") - F.col("place")).alias("shift")).distinct()

    def verified(self, overlays: DataFrame) -> DataFrame:
        """The overlays with a stretch that counts: region, id, text_hash, item and the best ``stretch``."""
        item_words = self.keyed.mapInPandas(_item_words, "item long, item_words array<long>")
        least = F.least(F.lit(self.least_words), F.ceil(F.size("item_words") * self.similarity).cast("int"))
        shift = F.col("shift") - F.col("start")
        best = _best_stretch(F.col("words"), F.col("item_words"), shift, F.col("least"), self.similarity)
        rows = overlays.join(item_words, "item").join(self.regions.drop("places", "seeds"), "region")
        rows = rows.withColumn("least", least).withColumn("best", best).where(F.col("best.balance") >= -1e-6)
        stretch = F.struct(
            F.col("best.matches").alias("matches"),
            (-(F.col("best.begin") + F.col("shift"))).alias("earlier"),
            F.col("best.begin").alias("item_place"),
            (F.col("best.end") - F.col("best.begin")).alias("words"),
        )
        return rows.select("region", "id", "text_hash", "item", stretch.alias("stretch"))


class _Defaults(dict):
    """Masks by an item's length; items of lengths that are not named are long."""

    def __init__(self, long_masks: tuple[str, ...], by_length: dict[int, tuple[str, ...]]):
        super().__init__(by_length)
        self.long_masks = long_masks

    def get(self, words: int, nothing=()) -> tuple[str, ...]:
        return self[words] if words in self else self.long_masks if words else nothing


def span_of(masks: Sequence[str]) -> int:
    return max(map(len, [*masks, ""]))


def _document_seeds(
    hashes: WordHashes, content: str | None, masks: Sequence[str], lines: int
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """A text's words, and its seeds with the places at which they begin; also of whole lines of up to ``lines`` words."""
    found, begins = [], []
    if lines:
        # No word reaches across a line's end.
        parted = [hashes.of(line) for line in (content or "").split("\n")]
        words, at = np.concatenate(parted), 0
        for line in parted:
            if 0 < len(line) <= lines:
                found.append(line_seed(line))
                begins.append(np.array([at]))
            at += len(line)
    else:
        words = hashes.of(content)
    hashed = Seeds(words)
    for mask in masks:
        found.append(hashed.of(mask))
        begins.append(np.arange(len(found[-1])))
    nothing = np.zeros(0, np.int64)
    return words, np.concatenate([*begins, nothing]), np.concatenate([*found, nothing.view(np.uint64)])


def benchmark_overlaps(
    docs: DataFrame,
    benchmark: DataFrame,
    *,
    doc_id: str = "doc_id",
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    masks: Sequence[str] = MASKS,
    least_words: int = 12,
    similarity: float = 0.8,
    least_item_words: int = 8,
) -> DataFrame:
    """Documents that hold a passage of a benchmark item: a row per document and item, with the best stretch.

    Columns: doc_id, item_id, doc_place and item_place (words before the
    stretch), words (its length), matches, similarity, text_hash (of the
    document's text). A stretch counts if at least ``similarity`` of its words
    agree, place by place, and if it has ``least_words`` words or, of a shorter
    item, at least ``similarity`` of its words. An item of fewer than ``least_item_words``
    counts where a whole line has its words and no others. Words are lower-cased runs of
    letters and digits, so case, punctuation and spacing do not matter. Texts
    that are null, empty or without words hold nothing and are held by nothing.
    The default masks miss nothing at 12 words or more and 0.8 or more; less needs others.
    Rows that repeat an id and text are one row here; null ids come back as null.
    """
    search = _Search(docs, benchmark, doc_id, text, item_id, item_text, masks, least_words, similarity, least_item_words)
    overlays = search.work.keep(search.overlays(search.hits, search.seeds), "overlays")
    best = search.verified(overlays).groupBy("id", "text_hash", "item").agg(F.max("stretch").alias("stretch"))
    named = best.join(search.items.select(F.col("item_key").alias("item"), F.col("item").alias("name")), "item")
    return named.select(
        F.col("id").alias("doc_id"),
        F.col("name").alias("item_id"),
        (-F.col("stretch.earlier")).cast("int").alias("doc_place"),
        F.col("stretch.item_place").cast("int").alias("item_place"),
        F.col("stretch.words").cast("int").alias("words"),
        F.col("stretch.matches").cast("int").alias("matches"),
        (F.col("stretch.matches") / F.col("stretch.words")).alias("similarity"),
        "text_hash",
    )


def contaminated(
    docs: DataFrame,
    benchmark: DataFrame,
    *,
    doc_id: str = "doc_id",
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    masks: Sequence[str] = MASKS,
    least_words: int = 12,
    similarity: float = 0.8,
    least_item_words: int = 8,
) -> DataFrame:
    """``id`` and ``text_hash`` of the documents that ``benchmark_overlaps`` would list, whichever item they hold.

    Where many items share a passage, as they do an instruction, a document that holds it need not be compared
    with each of them. One item of every seed is tried on a region first; only where none was in it are more, eight
    times as many each time, until all were tried or one was found.
    """
    search = _Search(docs, benchmark, doc_id, text, item_id, item_text, masks, least_words, similarity, least_item_words)
    order = F.row_number().over(Window.partitionBy("seed").orderBy("item", "place"))
    # Seeds of no document are left out, so what is numbered is what the documents may need.
    met = search.hits.select("seed").distinct()
    seeds = search.work.keep(search.seeds.join(met, "seed", "left_semi").withColumn("rank", order), "seeds")
    most = seeds.agg(F.max("rank")).first()[0] or 0
    found, hits, tried, until = [], search.hits, 0, FIRST_TRIED
    while tried < most:
        some = seeds.where((F.col("rank") > tried) & (F.col("rank") <= until))
        overlays = search.work.keep(search.overlays(hits, some), "overlays")
        now = search.work.keep(search.verified(overlays).select("region", "id", "text_hash").distinct(), "found")
        found.append(now.select("id", "text_hash"))
        tried, until = until, until * MORE_TRIED
        if tried < most:
            hits = search.work.keep(hits.join(now.select("region"), "region", "left_anti"), "hits")
    if not found:
        return search.regions.select("id", "text_hash").where("false")
    return reduce(DataFrame.unionAll, found).distinct()


def _item_words(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    hashes = WordHashes()
    for batch in batches:
        words = [hashes.of(text).view(np.int64) for text in batch["text"]]
        yield pd.DataFrame({"item": batch["item"], "item_words": words})


def _best_stretch(
    words: Column, item_words: Column, shift: Column, least: Column, similarity: float
) -> Column:
    """balance, begin, end (places in the item) and matches of the best stretch of ``least`` words or more.

    Word q of the item lies over word q + shift. A match gains 1, a mismatch costs
    what makes the balance even at the wanted similarity: a stretch has it if its
    balance is not negative. The balance of a stretch is that of all words up to its
    end less that up to its begin; the lowest of those far enough back is kept.
    """
    cost = round(similarity / (1 - similarity), 9)
    low = F.greatest(F.lit(0), -shift)
    high = F.least(F.size(item_words), F.size(words) - shift) - 1

    def is_same(q: Column) -> Column:
        return F.coalesce(F.get(item_words, q) == F.get(words, q + shift), F.lit(False))

    def gain(same: Column) -> Column:
        return F.when(same, F.lit(1.0)).otherwise(F.lit(-cost))

    def step(state: Column, q: Column) -> Column:
        same, left = is_same(q), is_same(q - least)
        leaves = q - least >= low
        lead = state["lead"] + gain(same)
        matches = state["matches"] + F.when(same, 1).otherwise(0)
        lag = state["lag"] + F.when(leaves, gain(left)).otherwise(F.lit(0.0))
        lag_matches = state["lag_matches"] + F.when(leaves & left, 1).otherwise(0)
        reaches = q + 1 - least >= low
        lower = reaches & (state["low"]["balance"].isNull() | (lag < state["low"]["balance"]))
        here = F.struct(lag.alias("balance"), (q + 1 - least).alias("begin"), lag_matches.alias("matches"))
        lowest = F.when(lower, here).otherwise(state["low"])
        balance = lead - lowest["balance"]
        better = reaches & (state["top"]["balance"].isNull() | (balance > state["top"]["balance"]))
        found = F.struct(
            balance.alias("balance"),
            lowest["begin"].alias("begin"),
            (q + 1).alias("end"),
            (matches - lowest["matches"]).alias("matches"),
        )
        return F.struct(
            lead.alias("lead"),
            matches.alias("matches"),
            lag.alias("lag"),
            lag_matches.alias("lag_matches"),
            lowest.alias("low"),
            F.when(better, found).otherwise(state["top"]).alias("top"),
        )

    start = F.lit(None).cast(
        "struct<lead:double,matches:int,lag:double,lag_matches:int,low:struct<balance:double,begin:int,matches:int>,"
        "top:struct<balance:double,begin:int,end:int,matches:int>>"
    )
    zero = F.struct(
        F.lit(0.0).alias("lead"),
        F.lit(0).alias("matches"),
        F.lit(0.0).alias("lag"),
        F.lit(0).alias("lag_matches"),
        start["low"].alias("low"),
        start["top"].alias("top"),
    )
    places = F.when(low <= high, F.sequence(low, high)).otherwise(F.array().cast("array<int>"))
    return F.aggregate(places, zero, step, lambda state: state["top"])


def without_benchmark(
    docs: DataFrame, benchmark: DataFrame, *, doc_id: str = "doc_id", text: str = "text", **more
) -> DataFrame:
    """The documents that hold no benchmark passage, as they were; rows are matched by id and text."""
    found = contaminated(docs, benchmark, doc_id=doc_id, text=text, **more)
    one, other = free_names(docs, "id", "hash")
    found = found.toDF(one, other)
    found = Work(docs.sparkSession, "decontaminate-found").keep(found, "found")
    own = F.sha2(F.col(text).cast("string").cast("binary"), 256)
    same = (own == F.col(other)) & F.col(doc_id).eqNullSafe(F.col(one))
    # Merged at every size: how many documents are found depends on the data.
    return docs.join(found.hint("merge"), same, "left_anti")
