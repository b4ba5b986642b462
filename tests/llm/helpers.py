"""Small documents with everything that may go wrong in them, and plain versions of what the operators do."""

from __future__ import annotations

import re
from collections import Counter

import numpy as np
import xxhash

SCHEMA = "doc_id LONG, text STRING, lang STRING, source STRING, n_chars LONG"
LONG = " ".join(f"word{i % 977}" for i in range(6_000))
#: Null and repeated ids, null, empty and very long texts, ties, repeated rows, nulls in every column.
EDGES = [
    (1, "Same text, twice.", "en", "a", 17),
    (2, "Same text, twice.", "en", "a", 17),
    (2, "Same text, twice.", "en", "a", 17),
    (2, "The same id with another text", None, "b", None),
    (3, None, "en", "a", None),
    (4, "", "de", None, 0),
    (5, "  \t\n ", None, None, None),
    (6, LONG, "en", "b", len(LONG)),
    (7, LONG, "en", "b", len(LONG)),
    (8, LONG + " end", "de", "a", len(LONG) + 4),
    (None, "No id here", "fr", "c", 10),
    (None, "Same text, twice.", "en", "c", 17),
    (9, "Éa ñu ß 漢字 😀 İ", "es", "c", 14),
    (None, None, None, None, None),
]
#: Names that results or inner columns bear.
CLASHES = ("__source", "__cut_key", "__key", "__SIZE", "__target", "__epochs", "__own_key", "__found", "__lines", "__keys", "row", "name", "hash", "print", "size", "target", "taken", "key", "bucket", "id", "KEPT", "found", "words", "host")


def documents(spark, rows=EDGES):
    return spark.createDataFrame(rows, SCHEMA)


def with_clashes(df):
    for name in CLASHES:
        df = df.withColumn(name, df["n_chars"] + 1)
    return df


def plain(rows):
    return sorted((tuple(row) for row in rows), key=repr)


def fingerprint(text, words=3):
    parts = (text or "").encode().lower().split()
    if not parts:
        return 0
    shingles = [b" ".join(parts[i : i + words]) for i in range(max(1, len(parts) - words + 1))]
    hashes = [xxhash.xxh64(one, seed=42).intdigest() for one in shingles]
    return sum(1 << bit for bit in range(64) if 2 * sum(one >> bit & 1 for one in hashes) > len(hashes))


def components(prints, radius=2):
    """The place of the first member of each one's component."""
    root = list(range(len(prints)))

    def top(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(prints)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= radius:
                a, b = top(i), top(j)
                root[max(a, b)] = min(a, b)
    return [top(i) for i in range(len(prints))]


def words_of(text):
    return re.findall(r"[^\W_]+", (text or "").lower())


def overlaps(text, item, least=12, similarity=0.8, least_item=8):
    """Whether some stretch of the two, laid over each other, agrees enough; every shift and stretch is tried."""
    a, b = words_of(text), words_of(item)
    if len(b) < least_item:
        return bool(b) and any(words_of(line) == b for line in (text or "").split("\n"))
    needed = min(least, int(np.ceil(len(b) * similarity - 1e-9)))
    if sum((Counter(a) & Counter(b)).values()) < similarity * needed:
        return False
    for shift in range(-len(b) + 1, len(a)):
        same = [a[i + shift] == b[i] for i in range(len(b)) if 0 <= i + shift < len(a)]
        sums = np.concatenate([[0], np.cumsum(same)])
        gain = sums - similarity * np.arange(len(sums))
        for i in range(len(sums) - max(1, needed)):
            if (gain[i + max(1, needed) :] >= gain[i] - 1e-9).any():
                return True
    return False


def word_total(text):
    return len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))


def targets(sizes, weights=(3, 1, 2), share=1.5, most=2):
    """Targets by source; None last."""
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {name: weights[i % len(weights)] for i, name in enumerate(names)}
    total, capped = share * sum(sizes.values()), set()
    while True:
        rest = sum(weight[n] for n in names if n not in capped)
        level = (total - sum(most * sizes[n] for n in capped)) / rest if rest else 0
        more = {n for n in names if n not in capped and weight[n] * level > most * sizes[n]}
        if not more:
            return {n: float(most * sizes[n]) if n in capped else weight[n] * level for n in names}
        capped |= more


def profile(text, dimensions=1024, seed=4, ngram=3):
    """The bundle of a text's n-grams, one by one."""

    def letter(code):
        return np.random.default_rng([seed, code]).integers(0, 2, dimensions, dtype=np.int8).astype(int) * 2 - 1

    vectors = {}
    spelled = re.sub(r"\x00+", "\x00", "".join(c if c.isalpha() else "\x00" for c in f" {text.lower()} "))
    bundle, grams = np.zeros(dimensions, dtype=np.int64), {}
    for i in range(len(spelled) - ngram + 1):
        grams[spelled[i : i + ngram]] = grams.get(spelled[i : i + ngram], 0) + 1
    for gram, count in grams.items():
        bound = np.ones(dimensions, dtype=int)
        for i, c in enumerate(gram):
            if c not in vectors:
                vectors[c] = letter(0 if c == "\x00" else ord(c))
            bound = bound * np.roll(vectors[c], ngram - 1 - i)
        bundle += count * bound
    return bundle
