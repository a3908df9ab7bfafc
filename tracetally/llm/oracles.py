"""DuckDB SQL for the operators that SQL can express, written from their contracts alone."""

from __future__ import annotations

_LOWER = (
    "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
)

_OP1 = rf"""
WITH doc_words AS (
  SELECT doc_id, regexp_extract_all({_LOWER.format("coalesce(text, '')")},
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents
), item_words AS (
  SELECT item_id, regexp_extract_all({_LOWER.format("coalesce(text, '')")},
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark
), windows AS (
  SELECT DISTINCT item_id, w[pos + 1 : pos + least(10, len(w))] AS win
  FROM (SELECT *, unnest(range(greatest(1, len(w) - 9))) AS pos FROM item_words WHERE len(w) > 0)
), widths AS (SELECT DISTINCT len(win) AS n FROM windows),
runs AS (
  SELECT doc_id, n, w, unnest(range(len(w) - n + 1)) AS pos
  FROM doc_words, widths WHERE len(w) >= n
), hits AS (
  SELECT doc_id, item_id, pos, n FROM runs JOIN windows ON win = w[pos + 1 : pos + n]
), words_hit AS (
  SELECT doc_id, count(DISTINCT place) AS n_hit
  FROM (SELECT doc_id, unnest(range(pos, pos + n)) AS place FROM hits) GROUP BY doc_id
), items AS (
  SELECT doc_id, count(*) AS n_items, string_agg(id, ',' ORDER BY id) AS ids
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS id FROM hits) GROUP BY doc_id
)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words,
  CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit, CAST(coalesce(n_items, 0) AS BIGINT) AS n_items,
  sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM doc_words LEFT JOIN words_hit USING (doc_id) LEFT JOIN items USING (doc_id)
"""

# Kinds in their order with pattern, group and least length of the group.
_KINDS = (
    (
        "assign",
        r"""(?:[pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]|[tT][oO][kK][eE][nN]|[aA][pP][iI]_?[kK][eE][yY])["'']?\x20*[:=]\x20*["'']?([A-Za-z0-9+/_.=-]+)""",
        1,
        12,
    ),
    ("access", "AKIA[A-Z0-9]+", 0, 18),
    ("hex", "[0-9a-f]+", 0, 16),
    ("github", "gh[opsur]_[A-Za-z0-9]{36,}", 0, 0),
    ("pem", "-----BEGIN (?:[A-Z]+ )?PRIVATE KEY-----", 0, 0),
)
_FOUND = "\nUNION ALL\n".join(
    f"""
  SELECT doc_id, {at} AS k, '{kind}' AS kind, stop - length(whole) AS start, stop
  FROM (
    SELECT *, CAST(sum(length(gap) + coalesce(length(whole), 0))
      OVER (PARTITION BY doc_id ORDER BY n) AS BIGINT) AS stop
    FROM (
      SELECT doc_id, unnest(string_split_regex(t, '{pattern}')) AS gap,
        unnest(regexp_extract_all(t, '{pattern}')) AS whole,
        unnest(regexp_extract_all(t, '{pattern}', {group})) AS part,
        generate_subscripts(string_split_regex(t, '{pattern}'), 1) AS n
      FROM texts WHERE regexp_matches(t, '{pattern}')
    )
  ) WHERE whole IS NOT NULL AND length(part) >= {least}"""
    for at, (kind, pattern, group, least) in enumerate(_KINDS)
)
_OP3 = f"""
WITH texts AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
found AS ({_FOUND}),
listed AS (
  SELECT doc_id, count(*) FILTER (k = 0) AS n_assign, count(*) FILTER (k = 1) AS n_access,
    count(*) FILTER (k = 2) AS n_hex,
    string_agg(concat_ws(':', kind, start, stop), ',' ORDER BY start, k) FILTER (k < 3) AS base,
    string_agg(concat_ws(':', kind, start, stop), ',' ORDER BY start, k) AS spans
  FROM found GROUP BY doc_id
)
SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access,
  coalesce(n_hex, 0) AS n_hex, sha256(coalesce(base, '')) AS base_sha256,
  coalesce(spans, '') AS spans
FROM texts LEFT JOIN listed USING (doc_id)
"""

_OP5 = rf"""
WITH rules(verdict, host, path) AS (VALUES
  ('allow', 'com', '/'), ('block', 'example.com', '/en/'), ('allow', 'www.example.com', '/en/'),
  ('block', 'net', '/es/'), ('block', 'net', '/fr/')
), rest AS (
  SELECT page_id, CASE WHEN strpos(url, '://') > 0
    THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS r FROM pages
), urls AS (
  SELECT page_id, {_LOWER.format("regexp_extract(r, '^[^/?#]*')")} AS host,
    regexp_extract(r, '^[^/?#]*([^?#]*)', 1) AS path FROM rest
), fitting AS (
  SELECT u.page_id, r.host || r.path AS rule, r.verdict
  FROM urls u JOIN rules r ON (u.host = r.host OR suffix(u.host, '.' || r.host))
    AND starts_with(u.path, r.path)
  QUALIFY row_number() OVER (PARTITION BY u.page_id
    ORDER BY length(r.host || r.path) DESC, length(r.host) DESC) = 1
)
SELECT page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict
FROM urls LEFT JOIN fitting USING (page_id)
"""

_OP6 = rf"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all({_LOWER.format("coalesce(text, '')")},
    '[^\x20\x09-\x0D]+') AS w FROM documents
), shingles AS (
  SELECT DISTINCT doc_id, w[pos + 1 : pos + 5] AS shingle
  FROM (SELECT *, unnest(range(greatest(1, len(w) - 4))) AS pos FROM words WHERE len(w) > 0)
), sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
links AS (
  SELECT a.doc_id AS u, b.doc_id AS v
  FROM shingles a JOIN shingles b ON a.shingle = b.shingle AND a.doc_id <> b.doc_id
    JOIN sizes m ON m.doc_id = a.doc_id JOIN sizes n ON n.doc_id = b.doc_id
  GROUP BY ALL HAVING 100 * count(*) >= 85 * (any_value(m.n) + any_value(n.n) - count(*))
), reach AS (
  SELECT doc_id AS root, doc_id AS node FROM documents
  UNION SELECT root, v FROM reach JOIN links ON node = u
), classes AS (SELECT root AS doc_id, min(node) AS component_id FROM reach GROUP BY root)
SELECT doc_id, CAST(coalesce(n, 0) AS BIGINT) AS n_shingles, component_id,
  doc_id = component_id AS kept
FROM classes LEFT JOIN sizes USING (doc_id)
"""

_OP8 = r"""
WITH texts AS (
  SELECT doc_id, coalesce(text, '') AS t,
    regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents
), triples AS (
  SELECT doc_id, pos, w[pos + 1 : pos + 3] AS three
  FROM (SELECT doc_id, w, unnest(range(len(w) - 2)) AS pos FROM texts WHERE len(w) > 2)
), twice AS (
  SELECT doc_id, pos FROM triples
  QUALIFY count(*) OVER (PARTITION BY doc_id, three) > 1
), repeated AS (
  SELECT doc_id, count(DISTINCT place) AS n_repeat_words
  FROM (SELECT doc_id, unnest(range(pos, pos + 3)) AS place FROM twice) GROUP BY doc_id
), lines AS (
  SELECT doc_id, count(*) AS n_lines, count(*) - count(DISTINCT line) AS n_dup_lines
  FROM (SELECT doc_id, unnest(string_split(t, chr(10))) AS line FROM texts)
  WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY doc_id
), stops AS (
  SELECT doc_id, count(*) AS n_stops
  FROM (SELECT doc_id, lower(rtrim(unnest(w), ',.;:')) AS word FROM texts)
  WHERE word IN ('the', 'be', 'to', 'of', 'and', 'that', 'have', 'with', 'in', 'a', 'is', 'was',
    'for', 'it', 'le', 'la', 'les', 'de', 'des', 'et', 'un', 'une', 'dans', 'est', 'que', 'der',
    'die', 'das', 'und', 'den', 'dem', 'zu', 'ein', 'eine', 'ist', 'mit', 'von', 'im', 'el', 'los',
    'las', 'y', 'en', 'por', 'del', 'se') GROUP BY doc_id
), measured AS (
  SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words,
    CAST(length(array_to_string(w, '')) AS BIGINT) AS word_chars,
    CAST(length(t) - length(translate(t, '#*$%&|<>', '')) AS BIGINT) AS n_symbols,
    coalesce(n_dup_lines, 0) AS n_dup_lines, coalesce(n_repeat_words, 0) AS n_repeat_words,
    coalesce(n_lines, 0) AS n_lines, coalesce(n_stops, 0) AS n_stops
  FROM texts LEFT JOIN repeated USING (doc_id) LEFT JOIN lines USING (doc_id)
    LEFT JOIN stops USING (doc_id)
), judged AS (
  SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM measured
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed AND word_chars >= 2 * n_words AND word_chars <= 15 * n_words
    AND 10 * n_symbols <= word_chars AND 100 * n_stops >= 2 * n_words
    AND 2 * n_dup_lines <= n_lines AS kept
FROM judged
"""

_OP10 = """
WITH payloads AS (
  SELECT page_id, encode(coalesce(html, '')) AS body FROM pages
), sums AS (
  SELECT page_id, CAST(octet_length(body) AS BIGINT) AS payload_bytes,
    sha1(body) AS payload_digest FROM payloads
), lasts AS (
  SELECT *, max(page_id) OVER (PARTITION BY payload_digest, payload_bytes) AS last FROM sums
)
SELECT page_id, payload_bytes, payload_digest,
  CASE WHEN payload_bytes >= 1000 AND page_id <> last THEN 'revisit' ELSE 'response' END
    AS record_type,
  CASE WHEN payload_bytes >= 1000 AND page_id <> last THEN last END AS refers_to
FROM lasts
"""

_OP11 = rf"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang,
    unnest(string_split_regex({_LOWER.format("coalesce(text, '')")}, '[.,;:!?\x0A-\x0D]')) AS piece
  FROM documents
), words AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces),
grams AS (
  SELECT lang, array_to_string(w[pos : pos + size - 1], ' ') AS phrase, size
  FROM (SELECT *, unnest(range(1, len(w) - size + 2)) AS pos
        FROM words, (SELECT unnest([1, 2, 3]) AS size) WHERE len(w) >= size)
), f AS (SELECT lang, phrase, size, count(*) AS a FROM grams GROUP BY ALL),
totals AS (SELECT lang, CAST(sum(a) AS BIGINT) AS n FROM f WHERE size = 1 GROUP BY lang),
candidates AS (
  SELECT lang, phrase, size, a, string_split(phrase, ' ') AS w FROM f WHERE size > 1 AND a >= 10
), cuts AS (
  SELECT c.lang, c.phrase, c.size, c.a, k, l.a AS l, r.a AS r,
    CAST(1000000 AS HUGEINT) * c.a * c.a // (CAST(l.a AS HUGEINT) * r.a) AS score
  FROM (SELECT *, unnest(range(1, size)) AS k FROM candidates) c
  JOIN f l ON l.lang = c.lang AND l.phrase = array_to_string(c.w[1:k], ' ')
  JOIN f r ON r.lang = c.lang AND r.phrase = array_to_string(c.w[k + 1:], ' ')
), lowest AS (
  SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1
), covered AS (
  SELECT lang, array_to_string(w[k : k + 1], ' ') AS phrase, max(a) AS longer
  FROM candidates, (SELECT unnest([1, 2]) AS k) WHERE size = 3 GROUP BY ALL
)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, encode(phrase)) AS rank,
  phrase, a, l, r, n, CAST(score AS BIGINT) AS score
FROM lowest LEFT JOIN covered USING (lang, phrase) JOIN totals USING (lang)
WHERE longer IS NULL OR 100 * longer < 50 * a
QUALIFY rank <= 2000
"""

_DRAWN = "CAST('0x' || substr(h, {}, 8) AS BIGINT)"
_OP12 = rf"""
WITH units AS (
  SELECT doc_id, coalesce(text, '') AS t, sha256('42:' || doc_id) AS h,
    regexp_extract_all(coalesce(text, ''),
      '[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+') AS w
  FROM documents
), drawn AS (
  SELECT *, {_DRAWN.format(1)} % (len(w) + 1) AS x, {_DRAWN.format(9)} % (len(w) + 1) AS y,
    CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>')
        OR {_DRAWN.format(17)} % 100 >= 50 THEN 'plain'
      WHEN {_DRAWN.format(25)} % 100 < 80 THEN 'spm' ELSE 'psm' END AS form
  FROM units
), cut AS (
  SELECT *, array_to_string(w[: least(x, y)], '') AS prefix,
    array_to_string(w[least(x, y) + 1 : greatest(x, y)], '') AS middle,
    array_to_string(w[greatest(x, y) + 1 :], '') AS suffix
  FROM drawn
)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n, form,
  CASE WHEN form <> 'plain' THEN CAST(length(prefix) AS BIGINT) END AS prefix_chars,
  CASE WHEN form <> 'plain' THEN CAST(length(middle) AS BIGINT) END AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
    ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256,
  sha256(t) AS restored_sha256
FROM cut
"""


def oracle_sql() -> dict[str, str]:
    return {
        "op1_decontamination": _OP1,
        "op3_secrets": _OP3,
        "op5_urls": _OP5,
        "op6_neardup": _OP6,
        "op8_rules": _OP8,
        "op10_warc": _OP10,
        "op11_collocations": _OP11,
        "op12_middle": _OP12,
    }
