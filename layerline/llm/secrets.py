"""Secrets in texts, by patterns and by entropy. DataFrame functions only.

Three kinds are patterns. The method adds strings that look random: over each
candidate string slides a window, the counts of its characters are kept up to date by
the character that enters and the one that leaves, and with them the window's
Shannon entropy. What lies under windows at or above the class's threshold is a
span. No window covers what is on the allow-list: it parts a candidate into pieces,
each judged by itself.

Positions come from the text between the matches: what ``split`` leaves and what
``regexp_extract_all`` finds alternate, so their lengths add up to places.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The patterns of the base kinds. For access and hex a match's length
# is the only condition and a run's longest match starts first, so it is in the pattern.
ASSIGN = r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{16,}"
HEX = r"[0-9a-f]{24,}"
LEAST_VALUE = 6
BASE_KINDS = ("assign", "access", "hex")


@dataclass(frozen=True)
class CharacterClass:
    kind: str
    alphabet: str
    #: A run of the alphabet that may be random, as a pattern that matches whole runs only.
    candidate: str
    #: Bits per character that a window must reach.
    threshold: float


def _run(characters: str, least: int, *must_have: str) -> str:
    conditions = "".join(f"(?=[{characters}]*?[{one}])" for one in must_have)
    return f"(?<![{characters}]){conditions}[{characters}]{{{least},}}"


WINDOW = 20
#: Words are letters only; keys mix digits and letters, in base64 of both cases.
CLASSES = (
    CharacterClass("entropy_hex", "0123456789abcdefABCDEF", _run("0-9a-fA-F", WINDOW, "0-9", "a-fA-F"), 3.05),
    CharacterClass(
        "entropy_base64",
        "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_-",
        _run("A-Za-z0-9+/_-", WINDOW, "0-9", "a-z", "A-Z"),
        3.65,
    ),
)
LETTERS = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"


def _word(characters: str, *must_have: str, beside: str = "A-Za-z0-9") -> str:
    """A run with no letter or digit beside it. What it must have is looked for within the run."""
    conditions = "".join(f"(?=[{characters}]*?{one})" for one in must_have)
    return f"(?<![{beside}]){conditions}[{characters}]{{{WINDOW},}}(?![{beside}])"


#: Digits on both sides of letters, twice: names and dates written with hyphens do not have it.
ALTERNATING = "[0-9][a-z]{1,3}[0-9]+[a-z]{1,3}[0-9]"
#: Random strings that lack one of the three. Hex is left to its class and AKIA to its pattern. Words followed by a
#: number have one group of digits, and words written together have few one or two small letters between capitals.
FURTHER_CLASSES = (
    CharacterClass("entropy_lower", "abcdefghijklmnopqrstuvwxyz0123456789", _word("a-z0-9", "[0-9]", "[g-z]"), 3.65),
    CharacterClass(
        "entropy_upper",
        "ABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789",
        f"(?!AKIA)(?:{_word('A-Z2-7', '[2-7]', '[G-Z]')}|{_word('A-Z0-9', '[0-9][A-Z]+[0-9]', '[G-Z]')})",
        3.65,
    ),
    CharacterClass("entropy_mixed", LETTERS, _word("A-Za-z", "[A-Z][a-z]{1,2}[A-Z][A-Za-z]*?[A-Z][a-z]{1,2}[A-Z]"), 3.8),
    CharacterClass(
        "entropy_parted",
        "abcdefghijklmnopqrstuvwxyz0123456789_-",
        _word("a-z0-9_-", "[_-]", "[g-z]", ALTERNATING, beside="A-Za-z0-9_-"),
        3.65,
    ),
)
#: Known not to be secrets: keys of documentation (they end so), words of it, counting strings, UUIDs.
ALLOWED = (
    r"^[A-Za-z0-9+/_-]*EXAMPLE(?:KEY)?$",
    r"(?i:example|sample|dummy|changeme|placeholder|your[_-]?(?:key|token|secret))",
    r"(?i:0123456789|abcdefghij)",
    r"(?i:[0-9a-f]{8}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{12})",
)


def _matches(text: Column, pattern: str, value_group: int = 0) -> Column:
    """An array of start, end and value (a group) of each match, in code points."""
    between = F.split(text, pattern, -1)
    whole = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    value = F.regexp_extract_all(text, F.lit(pattern), F.lit(value_group))
    pieces = F.arrays_zip(whole.alias("whole"), value.alias("value"), F.slice(between, F.lit(1), F.size(whole)).alias("gap"))
    nothing = F.array().cast("array<struct<start:int,end:int,value:string>>")

    def step(state: Column, piece: Column) -> Column:
        start = state["at"] + F.length(piece["gap"])
        end = start + F.length(piece["whole"])
        one = F.struct(start.alias("start"), end.alias("end"), piece["value"].alias("value"))
        return F.struct(end.alias("at"), F.concat(state["found"], F.array(one)).alias("found"))

    first = F.struct(F.lit(0).alias("at"), nothing.alias("found"))
    found = F.aggregate(pieces, first, step, lambda state: state["found"])
    return F.when(text.rlike(pattern), found).otherwise(nothing)


def _spans(matches: Column, kind: str, order: int) -> Column:
    return F.transform(
        matches,
        lambda m: F.struct(
            m["start"].alias("start"), F.lit(order).alias("order"), m["end"].alias("end"), F.lit(kind).alias("kind")
        ),
    )


def _bits(count: Column) -> Column:
    return F.when(count > 0, count * F.log2(count.cast("double"))).otherwise(F.lit(0.0))


def _random_stretch(candidate: Column, kind: CharacterClass, window: int) -> Column:
    """first and last: the first and the last window at or above the threshold, -1 if none."""
    places = F.transform(F.split(candidate, ""), lambda c: F.instr(F.lit(kind.alphabet), c) - 1)
    places = F.filter(places, lambda p: p >= 0)

    def step(state: Column, i: Column) -> Column:
        enters, counts = F.get(state["places"], i), state["counts"]
        leaves = F.when(i >= window, F.get(state["places"], i - window)).otherwise(F.lit(-1))
        grown = F.get(counts, enters)
        shrunk = F.get(counts, leaves) + F.when(leaves == enters, 1).otherwise(0)
        total = state["total"] + _bits(grown + 1) - _bits(grown)
        total = total + F.when(leaves >= 0, _bits(shrunk - 1) - _bits(shrunk)).otherwise(F.lit(0.0))
        entropy = F.log2(F.lit(float(window))) - total / window
        high = (i >= window - 1) & (entropy >= kind.threshold)
        start = i - (window - 1)
        return F.struct(
            state["places"].alias("places"),
            F.transform(
                counts, lambda c, k: c + F.when(k == enters, 1).otherwise(0) - F.when(k == leaves, 1).otherwise(0)
            ).alias("counts"),
            total.alias("total"),
            F.when(high & (state["first"] < 0), start).otherwise(state["first"]).alias("first"),
            F.when(high, start).otherwise(state["last"]).alias("last"),
        )

    begin = F.struct(
        places.alias("places"),
        F.array_repeat(F.lit(0), len(kind.alphabet)).alias("counts"),
        F.lit(0.0).alias("total"),
        F.lit(-1).alias("first"),
        F.lit(-1).alias("last"),
    )
    return F.aggregate(
        F.sequence(F.lit(0), F.length(candidate) - 1),
        begin,
        step,
        lambda s: F.struct(s["first"].alias("first"), s["last"].alias("last")),
    )


def either(patterns: Sequence[str]) -> str:
    return "|".join(f"(?:{one})" for one in patterns)


def _pieces(candidate: Column, allowed: str) -> Column:
    """An array of start and value of each stretch between what the pattern finds in a candidate."""
    value = candidate["value"]
    whole = F.regexp_extract_all(value, F.lit(allowed), F.lit(0))
    zipped = F.arrays_zip(F.split(value, allowed, -1).alias("gap"), whole.alias("whole"))
    nothing = F.array().cast("array<struct<start:int,value:string>>")

    def step(state: Column, piece: Column) -> Column:
        one = F.struct(state["at"].alias("start"), piece["gap"].alias("value"))
        after = state["at"] + F.length(piece["gap"]) + F.coalesce(F.length(piece["whole"]), F.lit(0))
        return F.struct(after.alias("at"), F.concat(state["found"], F.array(one)).alias("found"))

    first = F.struct(candidate["start"].alias("at"), nothing.alias("found"))
    parted = F.aggregate(zipped, first, step, lambda state: state["found"])
    itself = F.array(F.struct(candidate["start"].alias("start"), value.alias("value")))
    return F.when(value.rlike(allowed), parted).otherwise(itself)


def _random_spans(
    text: Column, kind: CharacterClass, order: int, window: int, allowed: Sequence[str]
) -> Column:
    candidates = _matches(text, kind.candidate)
    if allowed:
        candidates = F.flatten(F.transform(candidates, lambda m: _pieces(m, either(allowed))))
        candidates = F.filter(candidates, lambda m: m["value"].rlike(kind.candidate))
    judged = F.transform(
        candidates,
        lambda m: F.struct(m["start"].alias("start"), _random_stretch(m["value"], kind, window).alias("windows")),
    )
    judged = F.filter(judged, lambda m: m["windows"]["first"] >= 0)
    found = F.transform(
        judged,
        lambda m: F.struct(
            (m["start"] + m["windows"]["first"]).alias("start"),
            (m["start"] + m["windows"]["last"] + window).alias("end"),
        ),
    )
    return _spans(found, kind.kind, order)


def _joined(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def find_secrets(
    docs: DataFrame,
    *,
    doc_id: str = "doc_id",
    text: str = "text",
    window: int = WINDOW,
    classes: Sequence[CharacterClass] = (*CLASSES, *FURTHER_CLASSES),
    allowed: Sequence[str] = ALLOWED,
) -> DataFrame:
    """A row per document: doc_id, found (an array of start, order, end and kind, sorted by start and kind).

    Places are code points, the end exclusive. Null and empty texts have no
    spans. What is allow-listed is only spared by entropy; what a base pattern
    finds stays. Rows that repeat come back each; other columns are not
    read; no documents give no rows.
    """
    content = F.coalesce(F.col(text).cast("string"), F.lit(""))
    rows = docs.select(F.col(doc_id).alias("doc_id"), content.alias("content"))
    content = F.col("content")
    assign = F.filter(_matches(content, ASSIGN, 2), lambda m: F.length(m["value"]) >= LEAST_VALUE)
    spans = [_spans(assign, "assign", 0), _spans(_matches(content, ACCESS), "access", 1)]
    spans.append(_spans(_matches(content, HEX), "hex", 2))
    for order, kind in enumerate(classes, start=len(BASE_KINDS)):
        spans.append(_random_spans(content, kind, order, window, allowed))
    return rows.select("doc_id", F.array_sort(F.concat(*spans)).alias("found"))


def secret_digests(found: DataFrame) -> DataFrame:
    """``find_secrets``'s rows as doc_id, a count per base kind, base_sha256 and spans as text."""
    base = F.filter("found", lambda s: s["order"] < len(BASE_KINDS))

    def count(kind: str) -> Column:
        return F.size(F.filter("found", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return found.select(
        "doc_id", *map(count, BASE_KINDS), F.sha2(_joined(base).cast("binary"), 256).alias("base_sha256"), _joined(F.col("found")).alias("spans")
    )
