"""Language identification with hyperdimensional profiles.

Every letter has a random vector of +1 and -1, drawn from its code point, so no
table of letters is kept. An n-gram binds the vectors of its letters, each
permuted (rotated) by its place: for "abc" twice-rotated a times once-rotated b
times c. A text bundles its n-grams: their sum. The sum over the sampled texts of a
language is its prototype, and a text's language is that of the prototype at
the smallest angle.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

UNKNOWN = "und"
#: Texts counted together: at most so many, and no further text once they have so many characters.
SLICE_TEXTS, SLICE_CHARACTERS = 256, 1 << 20
#: Kinds of n-grams whose vectors are made at a time.
KINDS = 2048


class Profiles:
    """Vectors of texts. ``letters`` fills up as letters are met; 0 stands for what parts words."""

    def __init__(self, dimensions: int, ngram: int, seed: int):
        self.dimensions, self.ngram, self.seed = dimensions, ngram, seed
        self.place = np.full(0x110000, -1, dtype=np.int32)
        self.letters, self.known = self._draw(0)[None], 1

    def _draw(self, code: int) -> np.ndarray:
        return np.random.default_rng([self.seed, code]).integers(0, 2, self.dimensions, dtype=np.int8) * 2 - 1

    def _places(self, codes: np.ndarray) -> np.ndarray:
        places = self.place[codes]
        if (places < 0).any():
            for code in np.unique(codes[places < 0]).tolist():
                self.place[code] = self.known if chr(code).isalpha() else 0
                if self.place[code]:
                    if self.known == len(self.letters):
                        self.letters = np.concatenate([self.letters, np.zeros_like(self.letters)])
                    self.letters[self.known] = self._draw(code)
                    self.known += 1
            places = self.place[codes]
        return places

    def of(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """A row per text, and whether the text has a letter. Runs of other characters count as one, as do both ends."""
        return self.measured(texts)[:2]

    def measured(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The same, and how many different n-grams each text has.

        Characters are taken some at a time, and n-grams bound some kinds at a time, so memory is
        that of the text and its kinds' numbers, not of their vectors. The sums are whole numbers and
        the same whatever the pieces.
        """
        vectors = np.zeros((len(texts), self.dimensions))
        has_letter = np.zeros(len(texts), dtype=bool)
        padded = [f" {text.lower()} " if text else "  " for text in texts]
        ends = np.cumsum([len(text) for text in padded])
        joined = "".join(padded)
        del padded

        def pieces() -> Iterator[tuple[int, np.ndarray]]:
            for start in range(0, len(joined), SLICE_CHARACTERS):
                piece = joined[start : start + SLICE_CHARACTERS]
                yield start, np.frombuffer(piece.encode("utf-32-le", "surrogatepass"), dtype="<u4")

        # All letters first: an n-gram's number depends on how many there are.
        for _, codes in pieces():
            self._places(codes)
        n, seen = self.ngram, []
        last_place, last_text = 1, -1
        places, text_of = np.zeros(0, np.int64), np.zeros(0, np.int64)
        for start, codes in pieces():
            own = self._places(codes)
            inside = np.diff(np.clip(np.r_[0, ends], start, start + len(codes)))
            text = np.repeat(np.arange(len(texts)), inside)
            first = text != np.r_[last_text, text[:-1]]
            keep = (own > 0) | first | (np.r_[last_place, own[:-1]] > 0)
            last_place, last_text = own[-1], text[-1]
            has_letter[text[own > 0]] = True
            # N-grams that begin in one piece end in the next.
            places, text_of = np.r_[places, own[keep].astype(np.int64)], np.r_[text_of, text[keep]]
            size = max(0, len(places) - n + 1)
            grams = np.zeros(size, dtype=np.int64)
            for i in range(n):
                grams = grams * self.known + places[i : i + size]
            within = text_of[:size] == text_of[n - 1 : n - 1 + size]
            if not within.all():
                grams, owner = grams[within], text_of[:size][within]
            else:
                owner = text_of[:size]
            seen.append(self._add(grams, owner, vectors))
            places, text_of = places[size:], text_of[size:]
        return vectors, has_letter, self._different(seen, len(texts))

    def _add(self, grams: np.ndarray, owner: np.ndarray, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Adds the n-grams to their texts' vectors; returns the different ones and their texts."""
        texts = len(vectors)
        if self.known**self.ngram * texts < 2**62:
            pairs, counts = np.unique(grams * texts + owner, return_counts=True)
            grams, owner = pairs // texts, pairs % texts
        else:
            (grams, owner), counts = np.unique(np.stack([grams, owner]), axis=1, return_counts=True)
        counts = counts.astype(np.float32)
        starts = np.flatnonzero(np.r_[True, grams[1:] != grams[:-1]][: len(grams)])
        kinds, starts = grams[starts], np.r_[starts, len(grams)]
        for low in range(0, len(kinds), KINDS):
            some = kinds[low : low + KINDS]
            inside = slice(starts[low], starts[min(low + KINDS, len(kinds))])
            kind = np.repeat(np.arange(len(some)), np.diff(starts[low : low + KINDS + 1]))
            weights = np.zeros((texts, len(some)), np.float32)
            weights[owner[inside], kind] = counts[inside]
            vectors += weights @ self._bound(some)
        return grams, owner

    def _different(self, seen: list[tuple[np.ndarray, np.ndarray]], texts: int) -> np.ndarray:
        if len(seen) > 1:
            # A text that lies in several pieces may have an n-gram in each.
            pairs = np.unique(np.stack([np.concatenate(x) for x in zip(*seen)], axis=1), axis=0)
            return np.bincount(pairs[:, 1], minlength=texts)
        return np.bincount(seen[0][1], minlength=texts) if seen else np.zeros(texts, np.int64)

    def _bound(self, kinds: np.ndarray) -> np.ndarray:
        bound = np.ones((len(kinds), self.dimensions), dtype=np.int8)
        for shift in range(self.ngram):
            bound *= np.roll(self.letters[kinds % self.known], shift, axis=1)
            kinds = kinds // self.known
        return bound.astype(np.float32)


def slices(texts: list[str | None]) -> Iterator[tuple[int, list[str | None]]]:
    start, size = 0, 0
    for i, text in enumerate(texts):
        size += len(text or "")
        if i + 1 - start >= SLICE_TEXTS or size >= SLICE_CHARACTERS or i + 1 == len(texts):
            yield start, texts[start : i + 1]
            start, size = i + 1, 0


def held_out(doc_id: Column, folds: int = 3, fold: int = 1) -> Column:
    """Whether crc32 of the id as text falls into the fold. A null id is in none, and nothing is learned from it."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % folds == fold, F.lit(False))


class LanguageModel:
    def __init__(self, languages: list[str], prototypes: np.ndarray, dimensions: int, ngram: int, seed: int):
        self.languages, self.prototypes = languages, prototypes
        self.settings = (dimensions, ngram, seed)

    def predict(self, text: Column) -> Column:
        """A struct of ``lang``, ``score``, the cosine to the language's prototype, 0 at least, and ``ngrams``.

        ``und`` and 0 for a text that is null or has no letter, and where nothing
        was learned. Of equal cosines the first language by name counts. ``ngrams``
        is how many different n-grams the text has, 0 if it has no letter: the
        cosine's noise is the same for any text, but that of few n-grams is low.
        """
        languages, prototypes, settings = self.languages, self.prototypes, self.settings

        @F.pandas_udf("lang string, score double, ngrams long")
        def predicted(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
            profiles = Profiles(*settings)
            for batch in batches:
                names, scores, ngrams = [], [], []
                for _, texts in slices(batch.tolist()):
                    vectors, has_letter, different = profiles.measured(texts)
                    ngrams += np.where(has_letter, different, 0).tolist()
                    if not languages:
                        has_letter[:] = False
                    length = np.maximum(np.linalg.norm(vectors.astype(np.float64), axis=1), 1e-12)
                    cosine = (vectors.astype(np.float32) @ prototypes.T) / length[:, None] if languages else np.zeros((len(texts), 1))
                    best = cosine.argmax(axis=1)
                    names += [languages[b] if ok else UNKNOWN for b, ok in zip(best.tolist(), has_letter.tolist())]
                    scores += np.where(has_letter, cosine.max(axis=1).clip(0, 1), 0.0).tolist()
                scores, ngrams = pd.Series(scores, dtype="float64"), pd.Series(ngrams, dtype="int64")
                yield pd.DataFrame({"lang": names, "score": scores, "ngrams": ngrams})

        return predicted(text.cast("string"))


def learn_languages(
    labelled: DataFrame,
    *,
    doc_id: str = "doc_id",
    text: str = "text",
    lang: str = "lang",
    per_language: int = 1_000,
    dimensions: int = 1024,
    ngram: int = 3,
    seed: int = 4,
) -> LanguageModel:
    """Prototypes from at most ``per_language`` whole texts of each non-null language, chosen by a hash of the id.

    What reaches the driver is the number of languages and, for each of them,
    one vector per task of that bounded sample.
    """
    rows = labelled.select(F.col(doc_id).alias("id"), F.col(text).cast("string").alias("text"), F.col(lang).alias("lang"))
    rows = rows.where("id IS NOT NULL AND lang IS NOT NULL").withColumn("order", F.xxhash64("id", F.lit(seed)))
    counts = {row.lang: row["count"] for row in rows.groupBy("lang").count().collect()}
    if not counts:
        return LanguageModel([], np.zeros((0, dimensions), dtype=np.float32), dimensions, ngram, seed)
    # A share of the hash range that holds the sample with room to spare; the rank then cuts it to size.
    shares = spark_map({name: min(1.0, (1.5 * per_language + 50) / n) for name, n in counts.items()})
    chosen = rows.where(F.abs(F.col("order") / 2.0**63) <= shares[F.col("lang")])
    rank = F.row_number().over(Window.partitionBy("lang").orderBy("order", "id"))
    chosen = chosen.withColumn("rank", rank).where(F.col("rank") <= per_language).select("lang", "text")

    def bundle(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        profiles, sums = Profiles(dimensions, ngram, seed), {}
        for batch in batches:
            names = batch["lang"].to_numpy()
            for start, texts in slices(batch["text"].tolist()):
                vectors, _ = profiles.of(texts)
                for name, vector in zip(names[start : start + len(texts)], vectors.astype(np.float64)):
                    sums[name] = sums.get(name, 0) + vector
        if sums:
            yield pd.DataFrame({"lang": list(sums), "bundle": list(sums.values())})

    totals: dict[str, np.ndarray] = {}
    # Sums of whole numbers: the same in any order.
    for row in chosen.mapInPandas(bundle, "lang string, bundle array<double>").toLocalIterator():
        totals[row.lang] = totals.get(row.lang, 0) + np.array(row.bundle)
    names = sorted(totals)
    prototypes = np.array([totals[n] / max(np.linalg.norm(totals[n]), 1e-12) for n in names], dtype=np.float32)
    return LanguageModel(names, prototypes, dimensions, ngram, seed)


def spark_map(values: dict[str, float]) -> Column:
    return F.create_map(*[F.lit(x) for pair in values.items() for x in pair])


def identify_languages(
    docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", lang: str = "lang", **more
) -> DataFrame:
    """The documents' ids with held_out, lang_pred and score (see ``LanguageModel.predict``).

    Learns from texts and languages of documents that are not held out. A row
    per row of ``docs``, repeated ones too; other columns are not read.
    """
    model = learn_languages(docs.where(~held_out(F.col(doc_id))), doc_id=doc_id, text=text, lang=lang, **more)
    found = docs.select(
        F.col(doc_id).alias("doc_id"),
        held_out(F.col(doc_id)).alias("held_out"),
        model.predict(F.col(text)).alias("found"),
    )
    return found.select("doc_id", "held_out", F.col("found.lang").alias("lang_pred"), "found.score")
