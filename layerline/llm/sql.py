"""What the queries must return, in DuckDB's SQL, where SQL can say it."""

from __future__ import annotations

from layerline.llm.licences import APART, TEMPLATES
from layerline.llm.line_dedup import BLOCK_TAGS
from layerline.llm.secrets import (
    ACCESS,
    ALLOWED,
    ALTERNATING,
    ASSIGN,
    BASE_KINDS,
    CLASSES,
    FURTHER_CLASSES,
    HEX,
    LEAST_VALUE,
    WINDOW,
    either,
)
from layerline.llm.token_counts import PIECE
from layerline.llm.work import WORD


def quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


EXACT_DEDUP = """
SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
       doc_id = max(doc_id) OVER same AS kept, sha256(coalesce(text, '')) AS text_sha256
FROM documents WINDOW same AS (PARTITION BY coalesce(text, ''))"""

_WORDS = f"len(regexp_extract_all(coalesce(TEXT, ''), {quoted(WORD)}))"
_PIECES = f"len(regexp_extract_all(coalesce(TEXT, ''), {quoted(PIECE)}))"
_UNREPEATED = r"array_to_string(list_distinct(string_split(text, chr(10))), chr(10))"

TOKEN_COUNTS = f"""
WITH there AS (
    SELECT source, lang, CASE WHEN doc_id IN (SELECT doc_id FROM labels WHERE quality = 0)
                              THEN {_UNREPEATED} ELSE text END AS text
    FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels WHERE toxic = 1)),
counted AS (
    SELECT source, lang, 'words-1' AS tokenizer, {_WORDS.replace("TEXT", "text")} AS n FROM there
    UNION ALL SELECT source, lang, 'pieces-1', {_PIECES.replace("TEXT", "text")} FROM there)
SELECT source, lang, tokenizer, count(*) AS documents, CAST(sum(n) AS BIGINT) AS tokens
FROM counted GROUP BY source, lang, tokenizer"""

SOURCE_MIXING = f"""
WITH sized AS (
    SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), {quoted(WORD)})) AS size,
           CAST('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), '') || ':20'), 1, 15) AS BIGINT) AS key
    FROM documents),
sources AS (
    SELECT source, CAST(sum(size) AS BIGINT) AS source_size, 2.0 * sum(size) AS most,
           [3.0, 1.0, 2.0][1 + (row_number() OVER (ORDER BY encode(source) NULLS LAST) - 1) % 3] AS weight
    FROM sized GROUP BY source),
-- In the order in which targets reach their limit, the first level that does not reach its own is the level of all.
filled AS (
    SELECT *, most / weight AS reach,
           (1.5 * sum(source_size) OVER () - coalesce(sum(most) OVER (ORDER BY most / weight, source
                ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
           / sum(weight) OVER (ORDER BY most / weight, source ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
    FROM sources),
targets AS (
    SELECT source, source_size,
           least(most, weight * coalesce((SELECT level FROM filled WHERE level <= reach ORDER BY reach, source LIMIT 1), 0)) AS target FROM filled),
ordered AS (
    SELECT doc_id, size, source_size, target, CAST(floor(target) AS BIGINT) AS budget,
           sum(size) OVER (PARTITION BY sized.source ORDER BY key) - size AS before
    FROM sized JOIN targets ON sized.source IS NOT DISTINCT FROM targets.source)
SELECT doc_id, CAST(size AS BIGINT) AS size, source_size, round(target, 3) AS target,
       CAST(CASE WHEN source_size = 0 THEN 0 ELSE
            size * (budget // source_size) + greatest(0, least(size, budget % source_size - before)) END AS BIGINT) AS taken
FROM ordered"""

_TEMPLATES = ", ".join(f"({quoted(name)}, {quoted(body)})" for name, body in TEMPLATES.items())

LICENCES = rf"""
WITH bodies(template, body) AS (VALUES {_TEMPLATES}),
template_words AS (
    SELECT template, string_split(trim(regexp_replace(lower(body), '[^\p{{L}}\p{{N}}]+', ' ', 'g')), ' ') AS w FROM bodies),
template_grams AS (
    SELECT template, gram, count(*) AS times, sum(count(*)) OVER (PARTITION BY template) AS size
    FROM (SELECT template, unnest(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) AS gram
          FROM template_words) GROUP BY template, gram),
content AS (
    SELECT doc_id, regexp_replace(lower(coalesce(text, '')), '[^\p{{L}}\p{{N}}\n]+', ' ', 'g') AS c FROM documents),
blocks AS (SELECT doc_id, c, string_split_regex(c, '\n *\n[ \n]*') AS b FROM content),
units AS (
    SELECT doc_id, 'line' AS unit, generate_subscripts(l, 1) - 1 AS place, unnest(l) AS x
    FROM (SELECT doc_id, string_split(c, chr(10)) AS l FROM content)
    UNION ALL SELECT doc_id, unit, place, x FROM (
        SELECT doc_id, 'paragraph' AS unit, generate_subscripts(b, 1) - 1 AS place, unnest(b) AS x FROM blocks)
        WHERE contains(trim(trim(x), chr(10)), chr(10)) AND contains(trim(x), chr(10))
    UNION ALL SELECT doc_id, 'text', 0, c FROM blocks WHERE len(b) > 1),
words AS (
    SELECT row_number() OVER () AS id, doc_id, unit, place,
           string_split(trim(regexp_replace(x, '\s+', ' ', 'g')), ' ') AS w FROM units),
grams AS (
    SELECT id, doc_id, unit, place, len(w) - 1 AS size,
           unnest(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) AS gram FROM words),
shared AS (
    SELECT id, doc_id, unit, place, template, g.size AS size, any_value(t.size) AS template_size,
           least(count(*), any_value(times)) AS n
    FROM grams g JOIN template_grams t USING (gram) GROUP BY id, doc_id, unit, place, g.size, template, gram),
alike AS (
    SELECT id, doc_id, unit, place, template,
           2 * sum(n)::BIGINT / (any_value(size) + any_value(template_size)::BIGINT) AS dice
    FROM shared GROUP BY id, doc_id, unit, place, template),
other AS (
    SELECT id, template FROM words, template_words
    WHERE len(list_filter([{", ".join(map(quoted, APART))}], lambda x: list_contains(words.w, x) AND NOT list_contains(template_words.w, x))) > 0)
SELECT doc_id, unit, CAST(place AS INTEGER) AS place, template, dice
FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY dice DESC, template) AS r
      FROM alike ANTI JOIN other USING (id, template) WHERE dice >= 0.8) WHERE r = 1"""

LINES = rf"""
WITH stripped AS (
    SELECT page_id, nullif(regexp_extract(lower(url), '^[a-z][a-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:@]+)', 1), '') AS host,
           regexp_replace(regexp_replace(regexp_replace(regexp_replace(coalesce(html, ''),
               '(?is)<script.*?</script>|<style.*?</style>|<!--.*?-->', ' ', 'g'), '[\r\n]+', ' ', 'g'),
               '(?i)</?(?:{BLOCK_TAGS})(?:[ \t/][^>]*)?>', chr(10), 'g'), '<[^>]*>', '', 'g') AS t FROM pages),
plain AS (
    SELECT row_number() OVER () AS id, page_id, host,
           replace(replace(replace(replace(replace(replace(t, '&lt;', '<'), '&gt;', '>'), '&quot;', '"'), '&#39;', ''''),
                   '&nbsp;', ' '), '&amp;', '&') AS t FROM stripped),
lines AS (
    SELECT id, page_id, host, list_filter(list_transform(string_split(t, chr(10)),
           lambda x: trim(regexp_replace(x, '[ \t]+', ' ', 'g'))), lambda x: x <> '') AS l FROM plain),
counted AS (
    SELECT host, line, count(*) AS n FROM (SELECT DISTINCT id, host, unnest(l) AS line FROM lines) GROUP BY host, line),
hosts AS (SELECT host, count(*) AS n FROM lines WHERE host IS NOT NULL GROUP BY host),
frequent AS (
    SELECT c.host, list(c.line) AS dropped FROM counted c JOIN hosts h ON c.host = h.host
    WHERE c.n >= 2 AND c.n > 0.3 * h.n GROUP BY c.host)
SELECT page_id, lines.host, array_to_string(kept, chr(10)) AS text, CAST(len(l) AS INTEGER) AS n_lines,
       CAST(len(l) - len(kept) AS INTEGER) AS n_dropped
FROM (SELECT lines.*, list_filter(l, lambda x: dropped IS NULL OR NOT list_contains(dropped, x)) AS kept
      FROM lines LEFT JOIN frequent ON lines.host = frequent.host) lines"""


def _spans(kind: str, order: int, pattern: str, value: str) -> str:
    """start, end and value of each match: what lies between the matches and the matches alternate."""
    return f"""
    SELECT id, {order} AS kind_order, {quoted(kind)} AS kind, value,
           CAST(coalesce(list_sum(list_transform(gaps[:i], lambda x: length(x))), 0)
              + coalesce(list_sum(list_transform(whole[:i - 1], lambda x: length(x))), 0) AS BIGINT) AS first, length(whole[i]) AS n
    FROM (SELECT id, whole, gaps, unnest(range(1, len(whole) + 1)) AS i, unnest({value}) AS value
          FROM (SELECT id, regexp_extract_all(t, {quoted(pattern)}) AS whole, string_split_regex(t, {quoted(pattern)}) AS gaps, t
                FROM texts WHERE regexp_matches(t, {quoted(pattern)})))"""


def _random(order: int, kind: str, run: str, conditions: str, threshold: float) -> str:
    allowed = quoted(either(ALLOWED))
    entropy = f"list_aggregate(string_split(substr(value, j, {WINDOW}), ''), 'entropy')"
    return f"""
    SELECT id, {order} AS kind_order, {quoted(kind)} AS kind, first + min(j) - 1 AS first, first + max(j) - 1 + {WINDOW} AS last
    FROM (SELECT *, unnest(range(1, length(value) - {WINDOW} + 2)) AS j
          FROM (SELECT id, gaps[i] AS value,
                       first + CAST(coalesce(list_sum(list_transform(gaps[:i - 1], lambda x: length(x))), 0)
                                  + coalesce(list_sum(list_transform(whole[:i - 1], lambda x: length(x))), 0) AS BIGINT) AS first
                FROM (SELECT id, first, gaps, whole, unnest(range(1, len(gaps) + 1)) AS i
                      FROM (SELECT id, first, string_split_regex(value, {allowed}) AS gaps,
                                   regexp_extract_all(value, {allowed}) AS whole
                            FROM ({_spans(kind, order, run, f"regexp_extract_all(t, {quoted(run)})")}) WHERE {conditions})))
          WHERE length(value) >= {WINDOW} AND {conditions})
    WHERE {entropy} >= {threshold} GROUP BY id, first, value"""


def _has(*patterns: str) -> str:
    return "(" + " AND ".join(f"regexp_matches(value, {quoted(one)})" for one in patterns) + ")"


_RUNS = {
    "entropy_hex": ("[0-9a-fA-F]{20,}", _has("[0-9]", "[a-fA-F]")),
    "entropy_base64": ("[A-Za-z0-9+/_-]{20,}", _has("[0-9]", "[a-z]", "[A-Z]")),
    "entropy_lower": ("[A-Za-z0-9]{20,}", _has("^[a-z0-9]+$", "[0-9]", "[g-z]")),
    "entropy_upper": (
        "[A-Za-z0-9]{20,}",
        f"NOT {_has('^AKIA')} AND ({_has('^[A-Z2-7]+$', '[2-7]', '[G-Z]')}"
        f" OR {_has('^[A-Z0-9]+$', '[0-9][A-Z]+[0-9]', '[G-Z]')})",
    ),
    "entropy_mixed": ("[A-Za-z0-9]{20,}", _has("^[A-Za-z]+$", "[A-Z][a-z]{1,2}[A-Z][A-Za-z]*?[A-Z][a-z]{1,2}[A-Z]")),
    "entropy_parted": ("[A-Za-z0-9_-]{20,}", _has("^[a-z0-9_-]+$", "[_-]", "[g-z]", ALTERNATING)),
}
_RANDOM = " UNION ALL ".join(
    _random(len(BASE_KINDS) + i, c.kind, *_RUNS[c.kind], c.threshold) for i, c in enumerate((*CLASSES, *FURTHER_CLASSES))
)

SECRETS = f"""
WITH texts AS (SELECT row_number() OVER () AS id, doc_id, coalesce(text, '') AS t FROM documents),
assigned AS ({_spans("assign", 0, ASSIGN, f"regexp_extract_all(t, {quoted(ASSIGN)}, 2)")}),
accesses AS ({_spans("access", 1, ACCESS, f"regexp_extract_all(t, {quoted(ACCESS)})")}),
hexes AS ({_spans("hex", 2, HEX, f"regexp_extract_all(t, {quoted(HEX)})")}),
spans AS (
    SELECT id, kind_order, kind, first, first + n AS last FROM assigned WHERE length(value) >= {LEAST_VALUE}
    UNION ALL SELECT id, kind_order, kind, first, first + n FROM accesses
    UNION ALL SELECT id, kind_order, kind, first, first + n FROM hexes
    UNION ALL {_RANDOM}),
lists AS (
    SELECT id, count(*) FILTER (kind = 'assign') AS n_assign, count(*) FILTER (kind = 'access') AS n_access,
           count(*) FILTER (kind = 'hex') AS n_hex,
           string_agg(kind || ':' || first || ':' || last, ',' ORDER BY first, kind_order) FILTER (kind_order < 3) AS base,
           string_agg(kind || ':' || first || ':' || last, ',' ORDER BY first, kind_order) AS spans
    FROM spans GROUP BY id)
SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
       sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM texts LEFT JOIN lists USING (id)"""


EMBEDDING_LINKS = """
WITH RECURSIVE rows AS (
    SELECT row_number() OVER () AS id, vec_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings),
vectors AS (
    SELECT * FROM rows WHERE len(v) > 0 AND len(list_filter(v, lambda x: x IS NULL OR NOT isfinite(x))) = 0
                         AND len(list_filter(v, lambda x: x <> 0)) > 0),
links AS (
    SELECT a.id AS u, b.id AS v FROM vectors a JOIN vectors b
    ON a.id <> b.id AND list_cosine_similarity(a.v, b.v) >= 0.9),
reached AS (SELECT id, id AS other FROM rows UNION SELECT reached.id, links.v FROM reached JOIN links ON other = u),
least AS (SELECT reached.id, min(vec_id) AS component_id FROM reached JOIN rows ON other = rows.id GROUP BY reached.id),
counted AS (SELECT u, count(*) AS n FROM links GROUP BY u)
SELECT vec_id, coalesce(n, 0) AS n_links, component_id, vec_id IS NOT DISTINCT FROM component_id AS kept
FROM rows JOIN least USING (id) LEFT JOIN counted ON id = u"""

_GAPS = "+".join(f"(p.v[{i}] - b.v[{i}]) * (p.v[{i}] - b.v[{i}])" for i in range(1, 5))


def _round(i: int) -> str:
    return f"""
near{i} AS (
    SELECT id, part, any_value(p.v) AS v, min(({_GAPS}) * 64 + entry) AS nearest
    FROM pieces p JOIN book{i} b USING (part) GROUP BY id, part)"""


def _book(i: int) -> str:
    means = ", ".join(f"CAST(floor(sum(v[{k}])::DOUBLE / count(*)) AS BIGINT)" for k in range(1, 5))
    return f"""{_round(i - 1)},
mean{i} AS (SELECT part, nearest % 64 AS entry, [{means}] AS v FROM near{i - 1} GROUP BY ALL),
book{i} AS (
    SELECT part, entry, coalesce(mean{i}.v, old.v) AS v FROM book{i - 1} old LEFT JOIN mean{i} USING (part, entry))"""


# For vectors of 64 components, as the table has them: parts of four.
VECTOR_CODES = f"""
WITH kept AS (
    SELECT row_number() OVER (ORDER BY vec_id) - 1 AS id, vec_id, label,
           list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
    FROM embeddings WHERE embedding IS NOT NULL
                      AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
pieces AS (SELECT id, part, v[4 * part + 1 : 4 * part + 4] AS v FROM kept, range(16) parts(part)),
book0 AS (SELECT part, id AS entry, v FROM pieces WHERE id < 64),{_book(1)},{_book(2)},{_round(2)},
coded AS (
    SELECT id, string_agg(printf('%02x', nearest % 64), '' ORDER BY part) AS code,
           CAST(sum(nearest // 64) AS BIGINT) AS error
    FROM near2 GROUP BY id),
books AS (
    SELECT sha256(string_agg(array_to_string(v, ','), ',' ORDER BY part, entry)) AS codebooks_sha256 FROM book2)
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, codebooks_sha256
FROM kept JOIN coded USING (id), books"""

_TERMS = r"""regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"""

RANKED_DOCUMENTS = f"""
WITH split AS (SELECT row_number() OVER () AS id, doc_id, {_TERMS} AS terms FROM documents),
whole AS (SELECT count(*) AS docs, CAST(sum(len(terms)) AS BIGINT) AS length FROM split WHERE len(terms) > 0),
counted AS (
    SELECT id, any_value(doc_id) AS doc_id, any_value(n) AS n, term, count(*) AS tf
    FROM (SELECT id, doc_id, len(terms) AS n, unnest(terms) AS term FROM split) GROUP BY id, term),
weights AS (
    SELECT term, CAST(floor(1000 * ln((2 * any_value(docs) + 2) / (2 * count(*) + 1))) AS BIGINT) AS w
    FROM counted, whole GROUP BY term),
items AS (SELECT DISTINCT item, item_id, unnest(terms) AS term
          FROM (SELECT row_number() OVER () AS item, item_id, {_TERMS} AS terms FROM benchmark)),
scored AS (
    SELECT item, any_value(item_id) AS item_id, id, any_value(doc_id) AS doc_id,
           CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 20 * (50 + (50 * n * docs) // length)))) AS BIGINT) AS score
    FROM items JOIN counted USING (term) JOIN weights USING (term), whole GROUP BY item, id),
ranked AS (
    SELECT *, row_number() OVER (PARTITION BY item ORDER BY score DESC, doc_id NULLS LAST) AS rank FROM scored WHERE score > 0)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score FROM ranked WHERE rank <= 50"""
