"""DuckDB SQL for the queries that SQL can express, written from their contracts and not from the operators."""

from __future__ import annotations

from tallycube.llm import licences, near, quality, ranked, sharding

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
VISIBLE = r"[^\x20\x09-\x0D]+"
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
# Rows are numbered, so that repeated ids keep apart.
DOCS = "docs AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t, lang FROM documents)"


def _lower(text: str) -> str:
    return f"translate({text}, '{UPPER}', '{LOWER}')"


DECONTAMINATION = f"""
WITH {DOCS},
d AS (SELECT r, doc_id, regexp_extract_all({_lower("t")}, '{WORD}') AS w FROM docs),
i AS (SELECT coalesce(CAST(item_id AS VARCHAR), 'null') AS item_id, regexp_extract_all({_lower("coalesce(text, '')")}, '{WORD}') AS w FROM benchmark),
windows AS (
    SELECT DISTINCT item_id, n, array_to_string(w[k:k + n - 1], ' ') AS s
    FROM (SELECT item_id, w, n, unnest(range(1, len(w) - n + 2)) AS k FROM (SELECT *, least(10, len(w)) AS n FROM i) WHERE n > 0)
),
places AS (
    SELECT r, n, k, array_to_string(w[k:k + n - 1], ' ') AS s
    FROM (SELECT r, w, n, unnest(range(1, len(w) - n + 2)) AS k FROM d, (SELECT DISTINCT n FROM windows) WHERE len(w) >= n)
),
hits AS (SELECT r, n, k, item_id FROM places JOIN windows USING (n, s)),
words AS (SELECT r, count(DISTINCT p) AS n_hit FROM (SELECT r, unnest(range(k, k + n)) AS p FROM hits) GROUP BY r),
items AS (SELECT r, count(DISTINCT item_id) AS n_items, string_agg(DISTINCT item_id, ',' ORDER BY item_id) AS ids FROM hits GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
    sha256(coalesce(ids, '')) AS items_sha256, n_hit IS NOT NULL AS contaminated
FROM d LEFT JOIN words USING (r) LEFT JOIN items USING (r)
"""

JACCARD = f"""
WITH RECURSIVE {DOCS},
d AS (SELECT r, doc_id, regexp_extract_all({_lower("t")}, '{VISIBLE}') AS w FROM docs),
sets AS (
    SELECT r, doc_id, CASE WHEN len(w) >= {near.SIZE}
        THEN list_distinct(list_transform(range(1, len(w) - {near.SIZE - 2}), lambda k: array_to_string(w[k:k + {near.SIZE - 1}], ' ')))
        WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END AS s
    FROM d
),
entries AS (SELECT r, len(s) AS n, unnest(s) AS g FROM sets),
links AS (
    SELECT a.r AS a, b.r AS b FROM entries a JOIN entries b ON a.g = b.g AND a.r <> b.r
    GROUP BY a.r, b.r, a.n, b.n HAVING 100 * count(*) >= {near.SIMILARITY} * (a.n + b.n - count(*))
),
reach AS (SELECT r AS a, r AS b FROM sets UNION SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a),
smallest AS (SELECT reach.a AS r, min(doc_id) AS component_id FROM reach JOIN sets ON reach.b = sets.r GROUP BY reach.a)
SELECT doc_id, CAST(len(s) AS BIGINT) AS n_shingles, component_id FROM sets JOIN smallest USING (r)
"""

_CLASS_SETS = {"lower": "a-z", "upper": "A-Z", "digit": "0-9", "space": r"\x20\x09-\x0D", "symbol": "#*$%&|<>", "mark": r".,;:!?''\x22()\-"}
_COUNTED = {k: f"length(t) - length(regexp_replace(t, '[{s}]', '', 'g'))" for k, s in _CLASS_SETS.items()}
_WIDE = r"length(regexp_replace(t, '[\x00-\x7F]', '', 'g'))"
_OTHER = f"length(t) - {_WIDE} - ({' + '.join(f'({c})' for c in _COUNTED.values())})"


def _distance(table: str) -> str:
    """Distance per text of `table` (r, lang, bin, n, total, ref, ref_total)."""
    part = lambda a, b: f"sum(CASE WHEN {a} > 0 THEN {a} * log2(2 * {a} / ({a} + {b})) ELSE 0 END)"
    return f"""SELECT r, sqrt(greatest(({part('p', 'q')} + {part('q', 'p')}) / 2, 0)) AS distance
        FROM (SELECT r, CAST(n AS DOUBLE) / total AS p, CAST(ref AS DOUBLE) / ref_total AS q FROM {table}) GROUP BY r"""


QUALITY = f"""
WITH {DOCS},
d AS (SELECT *, regexp_extract_all(t, '{VISIBLE}') AS w FROM docs),
windows AS (SELECT r, k, w[k] || ' ' || w[k + 1] || ' ' || w[k + 2] AS g FROM (SELECT r, w, unnest(range(1, len(w) - 1)) AS k FROM d WHERE len(w) > 2)),
often AS (SELECT r, k FROM (SELECT *, count(*) OVER (PARTITION BY r, g) AS c FROM windows) WHERE c > 1),
repeated AS (SELECT r, count(DISTINCT p) AS n FROM (SELECT r, unnest(range(k, k + 3)) AS p FROM often) GROUP BY r),
lines AS (SELECT r, list_filter(string_split(t, chr(10)), lambda l: regexp_matches(l, '{VISIBLE}')) AS l FROM d),
base AS (
    SELECT d.r, doc_id, lang, t, w, CAST(len(w) AS BIGINT) AS n_words, CAST(length(t) - ({_COUNTED['space']}) AS BIGINT) AS word_chars,
        CAST({_COUNTED['symbol']} AS BIGINT) AS n_symbols, CAST(len(l) - len(list_distinct(l)) AS BIGINT) AS n_dup_lines,
        CAST(coalesce(n, 0) AS BIGINT) AS n_repeat_words
    FROM d JOIN lines ON d.r = lines.r LEFT JOIN repeated ON d.r = repeated.r
),
judged AS (SELECT *, n_words < {quality.MIN_WORDS} OR 100 * n_repeat_words > {quality.MAX_REPEATED} * n_words AS base_failed FROM base),
classes AS (
    SELECT r, lang, base_failed, length(t) AS total, unnest([{', '.join(repr(k) for k in [*_COUNTED, 'other', 'wide'])}]) AS bin,
        unnest([{', '.join([*_COUNTED.values(), _OTHER, _WIDE])}]) AS n
    FROM judged
),
class_refs AS (SELECT lang, bin, sum(n) AS ref, sum(sum(n)) OVER (PARTITION BY lang) AS ref_total FROM classes WHERE NOT base_failed GROUP BY lang, bin),
class_rows AS (
    SELECT c.r, c.n, c.total, ref, ref_total FROM classes c JOIN class_refs f ON c.bin = f.bin AND c.lang IS NOT DISTINCT FROM f.lang
    WHERE total >= {quality.MIN_CHARS} AND ref_total > 0
),
class_distance AS ({_distance('class_rows')}),
spoken AS (SELECT r, trim({_lower('word')}, '.,;:!?') AS word FROM (SELECT r, unnest(w) AS word FROM judged)),
bins AS (SELECT unnest([{', '.join(f"'{w}'" for w in quality.WORDS)}]) AS bin UNION ALL SELECT ''),
counted AS (SELECT r, CASE WHEN word IN (SELECT bin FROM bins) THEN word ELSE '' END AS bin, count(*) AS n FROM spoken GROUP BY ALL),
word_counts AS (
    SELECT j.r, lang, base_failed, n_words AS total, b.bin, coalesce(c.n, 0) AS n
    FROM judged j CROSS JOIN bins b LEFT JOIN counted c ON c.r = j.r AND c.bin = b.bin
),
word_refs AS (SELECT lang, bin, sum(n) AS ref, sum(sum(n)) OVER (PARTITION BY lang) AS ref_total FROM word_counts WHERE NOT base_failed GROUP BY lang, bin),
word_rows AS (
    SELECT c.r, c.n, c.total, ref, ref_total FROM word_counts c JOIN word_refs f ON c.bin = f.bin AND c.lang = f.lang
    WHERE total >= {quality.MIN_WORDS_COMPARED} AND ref_total > 0 AND c.lang IN ({', '.join(f"'{k}'" for k in quality.COMMON_WORDS)})
),
word_distance AS ({_distance('word_rows')})
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
    NOT base_failed AND coalesce(c.distance <= {quality.MAX_CLASS_DISTANCE}, true) AND coalesce(w.distance <= {quality.MAX_WORD_DISTANCE}, true) AS kept,
    round(c.distance, 6) AS class_distance
FROM judged j LEFT JOIN class_distance c ON j.r = c.r LEFT JOIN word_distance w ON j.r = w.r
"""

SUFFIXES = """
WITH docs AS (SELECT row_number() OVER () AS r, doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
strings AS (SELECT r, doc_id, k, substr(h, CAST(2 * k + 1 AS BIGINT), 100) AS s FROM (SELECT *, unnest(range(0, len(h) // 2 - 49)) AS k FROM docs WHERE len(h) >= 100)),
gone AS (SELECT r, k FROM (SELECT r, k, doc_id, min(doc_id) OVER (PARTITION BY s) AS least FROM strings) WHERE doc_id > least),
runs AS (SELECT r, k, sum(fresh) OVER (PARTITION BY r ORDER BY k) AS run FROM (
    SELECT r, k, CASE WHEN k > lag(k) OVER (PARTITION BY r ORDER BY k) + 50 THEN 1 ELSE 0 END AS fresh FROM gone)),
spans AS (SELECT r, min(k) AS a, max(k) + 50 AS b FROM runs GROUP BY r, run),
cuts AS (SELECT r, a, coalesce(lag(b) OVER (PARTITION BY r ORDER BY a), 0) AS before, b, count(*) OVER (PARTITION BY r) AS n, max(b) OVER (PARTITION BY r) AS last FROM spans),
kept AS (
    SELECT c.r, max(n) AS n_spans, sum(b - a) AS n_removed,
        string_agg(substr(h, CAST(2 * before + 1 AS BIGINT), CAST(2 * (a - before) AS BIGINT)), '' ORDER BY a) || substr(any_value(h), CAST(2 * max(last) + 1 AS BIGINT)) AS h
    FROM cuts c JOIN docs ON c.r = docs.r GROUP BY c.r
)
SELECT doc_id, CAST(len(d.h) // 2 AS BIGINT) AS n_bytes, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed, CAST(coalesce(n_spans, 0) AS BIGINT) AS n_spans,
    sha256(unhex(coalesce(k.h, d.h))) AS kept_sha256
FROM docs d LEFT JOIN kept k ON d.r = k.r
"""

_HASHES = ", ".join(f"sha256(coalesce(CAST(doc_id AS VARCHAR), '') || '/{k}') AS h{k}" for k in range(5))


def _winner(shards: int) -> str:
    """The shard with the smallest waiting time; shards of weight 1."""
    draw = lambda j: f"(CAST('0x' || substr(h{j // 4}, {1 + 13 * (j % 4)}, 13) AS BIGINT) + 0.5::DOUBLE) / {16**13}::DOUBLE"
    times = ", ".join(f"-ln({draw(j)})" for j in range(shards))
    return f"CAST(list_position([{times}], list_aggregate([{times}], 'min')) - 1 AS INTEGER)"


def _crc_table() -> str:
    """The table of the reflected polynomial of CRC-32, by its rule."""
    step = lambda c: c >> 1 ^ (0xEDB88320 if c & 1 else 0)
    table = list(range(256))
    for _ in range(8):
        table = list(map(step, table))
    return f"[{', '.join(map(str, table))}]::UINTEGER[]"


SHARDING = f"""
WITH d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h, octet_length(encode(coalesce(text, ''))) AS n, {_HASHES} FROM documents),
placed AS (
    SELECT doc_id, CAST(n + 1 AS BIGINT) AS size,
        list_transform(range(0, n), lambda i: CAST('0x' || substr(h, CAST(2 * i + 1 AS BIGINT), 2) AS UINTEGER)) AS bytes,
        {_winner(sharding.SHARDS)} AS shard, {_winner(sharding.SHARDS + 1)} AS grown_shard
    FROM d
),
summed AS (
    SELECT doc_id, size, shard, grown_shard, CAST(xor(4294967295::UINTEGER, list_reduce(
        list_prepend(4294967295::UINTEGER, bytes), lambda c, v: xor(c >> 8, ({_crc_table()})[1 + (xor(c, v) & 255)])
    )) AS BIGINT) AS text_crc32
    FROM placed
)
SELECT doc_id, size, text_crc32, '{sharding.LAW}' AS law, shard, grown_shard,
    row_number() OVER (PARTITION BY shard ORDER BY doc_id NULLS FIRST, size, text_crc32) - 1 AS slot
FROM summed
"""

RANKED = f"""
WITH {DOCS.replace(", lang", "")},
d AS (SELECT r, doc_id, regexp_extract_all({_lower("t")}, '{WORD}') AS w FROM docs),
stats AS (SELECT count(*) AS n, CAST(sum(len(w)) AS BIGINT) AS l FROM d WHERE len(w) > 0),
i AS (SELECT row_number() OVER () AS q, item_id, regexp_extract_all({_lower("coalesce(text, '')")}, '{WORD}') AS w FROM benchmark),
terms AS (SELECT q, t, count(*) AS times FROM (SELECT q, unnest(w) AS t FROM i) GROUP BY q, t),
tf AS (SELECT r, t, count(*) AS tf FROM (SELECT r, unnest(w) AS t FROM d) WHERE t IN (SELECT t FROM terms) GROUP BY r, t),
weights AS (SELECT t, CAST(floor(1000 * ln(CAST(2 * any_value(n) + 2 AS DOUBLE) / CAST(2 * count(*) + 1 AS DOUBLE))) AS BIGINT) AS weight FROM tf, stats GROUP BY t),
impacts AS (
    SELECT r, t, (1000000000 * tf) // (1000 * tf + 12 * (75 + (25 * len(w) * n) // l)) AS impact
    FROM tf JOIN d USING (r), stats
),
scores AS (SELECT q, r, CAST(sum(times * weight * impact) AS BIGINT) AS score FROM terms JOIN impacts USING (t) JOIN weights USING (t) GROUP BY q, r),
ranked AS (SELECT *, row_number() OVER (PARTITION BY q ORDER BY score DESC, doc_id ASC NULLS LAST) AS rank FROM scores JOIN d USING (r) WHERE score > 0)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score FROM ranked JOIN i USING (q) WHERE rank <= {ranked.BEST}
"""

SQL = {
    "op6_decontamination": DECONTAMINATION,
    "op7_licences": licences.sql(),
    "op8_jaccard_join": JACCARD,
    "op9_quality_rules": QUALITY,
    "op10_suffix_dedup": SUFFIXES,
    "op11_sharding": SHARDING,
    "op12_ranked_search": RANKED,
}
