"""DuckDB SQL for the queries of this subpackage that SQL can express."""

from cohortmill.llm.licenses import COPYRIGHT_LINE, KNOWN, SPELLINGS

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

DECONTAMINATION = rf"""
WITH item_words AS (
  SELECT DISTINCT item_id::VARCHAR AS item,
         regexp_extract_all(translate(text, '{UPPER}', '{LOWER}'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM benchmark WHERE text IS NOT NULL AND item_id IS NOT NULL),
item_windows AS (
  SELECT DISTINCT item, least(10, len(w)) AS m, list_slice(w, i, i + least(10, len(w)) - 1) AS win
  FROM item_words, unnest(range(1, greatest(1, len(w) - 9) + 1)) AS t(i) WHERE len(w) > 0),
doc_words AS (
  SELECT doc_id,
         regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM documents),
doc_windows AS (
  SELECT doc_id, i, m, list_slice(w, i, i + m - 1) AS win
  FROM doc_words, (SELECT DISTINCT m FROM item_windows), unnest(range(1, len(w) - m + 2)) AS t(i)
  WHERE len(w) >= m),
found AS (SELECT doc_id, i, m, item FROM doc_windows JOIN item_windows USING (m, win)),
hits AS (
  SELECT doc_id, count(DISTINCT p) AS n_hit
  FROM (SELECT doc_id, unnest(range(i, i + m)) AS p FROM (SELECT DISTINCT doc_id, i, m FROM found))
  GROUP BY doc_id),
items AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS ids
  FROM (SELECT DISTINCT doc_id, item FROM found) GROUP BY doc_id)
SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM doc_words LEFT JOIN hits USING (doc_id) LEFT JOIN items USING (doc_id)
"""

NEAR_DEDUP = rf"""
WITH RECURSIVE words AS MATERIALIZED (
  SELECT doc_id,
         regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[^\x20\x09-\x0D]+') AS w
  FROM documents),
shingles AS MATERIALIZED (
  SELECT DISTINCT doc_id, CASE WHEN len(w) = 1 THEN w[1] ELSE w[i] || ' ' || w[i + 1] END AS s
  FROM words, unnest(range(1, greatest(2, len(w)))) AS t(i) WHERE len(w) > 0),
sizes AS MATERIALIZED (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
links AS MATERIALIZED (
  SELECT a, b FROM (
    SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS c
    FROM shingles x JOIN shingles y ON x.s = y.s AND x.doc_id <> y.doc_id GROUP BY 1, 2)
  JOIN sizes na ON na.doc_id = a JOIN sizes nb ON nb.doc_id = b
  WHERE 100 * c >= 80 * (na.n + nb.n - c)),
reach AS (
  SELECT doc_id, doc_id AS r FROM documents
  UNION
  SELECT reach.doc_id, links.b FROM reach JOIN links ON links.a = reach.r)
SELECT doc_id, coalesce(any_value(n), 0) AS n_shingles, min(r) AS component_id, doc_id = min(r) AS kept
FROM reach LEFT JOIN sizes USING (doc_id) GROUP BY doc_id
"""

# Every 400-byte window of every text by digest; windows seen twice are merged into spans.
SUFFIX_DEDUP = """
WITH texts AS MATERIALIZED (
  SELECT doc_id, hex(encode(coalesce(text, ''))) AS hx, octet_length(encode(coalesce(text, ''))) AS n FROM documents),
windows AS (
  SELECT doc_id, i, md5(substr(hx, 2 * i + 1, 800)) AS h FROM texts, unnest(range(0, n - 399)) AS t(i) WHERE n >= 400),
twice AS (SELECT doc_id, i FROM windows SEMI JOIN (SELECT h FROM windows GROUP BY h HAVING count(*) > 1) USING (h)),
marked AS (
  SELECT doc_id, i, CASE WHEN i <= lag(i) OVER (PARTITION BY doc_id ORDER BY i) + 400 THEN 0 ELSE 1 END AS fresh FROM twice),
numbered AS (SELECT doc_id, i, sum(fresh) OVER (PARTITION BY doc_id ORDER BY i) AS span FROM marked),
spans AS (SELECT doc_id, span, min(i) AS a, max(i) + 400 AS z FROM numbered GROUP BY doc_id, span),
gaps AS (
  SELECT doc_id, span, substr(hx, 2 * coalesce(lag(z) OVER (PARTITION BY doc_id ORDER BY a), 0) + 1,
         2 * (a - coalesce(lag(z) OVER (PARTITION BY doc_id ORDER BY a), 0))) AS part
  FROM spans JOIN texts USING (doc_id)),
removed AS (
  SELECT doc_id, sum(z - a) AS n_removed, count(*) AS n_spans, max(z) AS last FROM spans GROUP BY doc_id),
kept AS (SELECT doc_id, string_agg(part, '' ORDER BY span) AS parts FROM gaps GROUP BY doc_id)
SELECT doc_id, n::BIGINT AS n_bytes, coalesce(n_removed, 0)::BIGINT AS n_removed, coalesce(n_spans, 0)::BIGINT AS n_spans,
       sha256(unhex(CASE WHEN n_spans IS NULL THEN hx ELSE parts || substr(hx, 2 * last + 1) END)) AS kept_sha256
FROM texts LEFT JOIN removed USING (doc_id) LEFT JOIN kept USING (doc_id)
"""

# CRC-32 by its table: the entry of a byte is eight shift steps with the reflected polynomial.
SHARDING = """
WITH RECURSIVE steps(b, k, c) AS (
  SELECT range, 0, range FROM range(256)
  UNION ALL
  SELECT b, k + 1, CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END FROM steps WHERE k < 8),
crc AS (SELECT list(c ORDER BY b) AS t FROM steps WHERE k = 8),
texts AS MATERIALIZED (
  SELECT doc_id, text, octet_length(encode(coalesce(text, ''))) + 1 AS size, hex(encode(coalesce(text, ''))) AS hx FROM documents),
placed AS (
  SELECT *, min(doc_id) OVER (PARTITION BY text) AS leader, sum(size) OVER (PARTITION BY text) AS group_bytes,
         count(*) OVER (PARTITION BY text) AS members, sum(size) OVER () AS everything
  FROM texts),
begun AS (
  SELECT *, sum(size) OVER (ORDER BY leader, doc_id) - size AS begins FROM placed),
sharded AS (
  SELECT *, least(floor((CASE WHEN members > 1 AND group_bytes <= everything * (0.01 / 16)
                   THEN min(begins) OVER (PARTITION BY leader) ELSE begins END) * 16 / everything), 15)::INTEGER AS shard
  FROM begun)
SELECT doc_id, size::BIGINT AS size,
       xor(list_reduce(list_prepend(4294967295, list_transform(range(size - 1),
           lambda i: ('0x' || substr(hx, 2 * i + 1, 2))::BIGINT)),
           lambda c, b: xor(c >> 8, t[xor(c & 255, b) + 1])), 4294967295)::BIGINT AS text_crc32,
       'bytes' AS law, shard,
       row_number() OVER (PARTITION BY shard ORDER BY leader, doc_id) - 1 AS slot, NULL::INTEGER AS grown_shard
FROM sharded, crc
"""


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _canonical(column: str) -> str:
    out = f"trim(regexp_replace(lower({column}), '[^\\p{{L}}\\p{{N}}]+', ' ', 'g'))"
    for spelling, usual in SPELLINGS:
        out = f"regexp_replace({out}, '\\b{spelling}\\b', '{usual}', 'g')"
    return out


# Lines by themselves; paragraphs are runs of lines that are not blank, numbered by the blank lines before them.
LICENSES = f"""
WITH known AS (
  SELECT DISTINCT license, {_canonical('body')} AS canonical
  FROM (VALUES {', '.join(f'({_quoted(name)}, {_quoted(body)})' for name, body in KNOWN)}) AS t(license, body)),
split AS (SELECT row_number() OVER () AS rid, doc_id, string_split(text, chr(10)) AS p FROM documents WHERE text IS NOT NULL),
lines AS (
  SELECT rid, doc_id, i - 1 AS part, len(p) AS n_lines, regexp_matches(p[i], '^\\s*$') AS blank,
         CASE WHEN regexp_matches(p[i], {_quoted(COPYRIGHT_LINE)}) THEN '' ELSE {_canonical('p[i]')} END AS body
  FROM split, unnest(range(1, len(p) + 1)) AS t(i)),
runs AS (
  SELECT *, sum(begins) OVER (PARTITION BY rid ORDER BY part) - 1 AS paragraph
  FROM (SELECT *, CASE WHEN NOT blank AND coalesce(lag(blank) OVER (PARTITION BY rid ORDER BY part), true) THEN 1 ELSE 0 END AS begins
        FROM lines)),
paragraphs AS (
  SELECT rid, doc_id, paragraph AS part, count(*) OVER (PARTITION BY rid) AS n,
         coalesce(string_agg(body, ' ' ORDER BY part) FILTER (WHERE body <> ''), '') AS body
  FROM runs WHERE NOT blank GROUP BY rid, doc_id, paragraph),
units AS (
  SELECT doc_id, 'text' AS unit, 0::BIGINT AS part, coalesce(string_agg(body, ' ' ORDER BY part) FILTER (WHERE body <> ''), '') AS body
  FROM lines GROUP BY rid, doc_id
  UNION ALL SELECT doc_id, 'paragraph', part::BIGINT, body FROM paragraphs WHERE n > 1
  UNION ALL SELECT doc_id, 'line', part, body FROM lines WHERE n_lines > 1)
SELECT doc_id, unit, part, license FROM units JOIN known ON body = canonical
"""

QUALITY = r"""
WITH texts AS MATERIALIZED (
  SELECT doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
windows AS (SELECT doc_id, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] AS g
            FROM texts, unnest(range(1, len(w) - 1)) AS t(i) WHERE len(w) > 2),
twice AS (SELECT doc_id, i FROM windows SEMI JOIN (
            SELECT doc_id, g FROM windows GROUP BY doc_id, g HAVING count(*) > 1) USING (doc_id, g)),
covered AS (SELECT doc_id, count(DISTINCT p) AS n FROM (SELECT doc_id, unnest([i, i + 1, i + 2]) AS p FROM twice) GROUP BY doc_id),
lines AS (
  SELECT doc_id, count(*) - count(DISTINCT line) AS n
  FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM texts)
  WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY doc_id),
measured AS (
  SELECT doc_id, text, len(w)::BIGINT AS n_words,
         length(regexp_replace(text, '[\x20\x09-\x0D]', '', 'g'))::BIGINT AS word_chars,
         length(regexp_replace(text, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols,
         coalesce(lines.n, 0)::BIGINT AS n_dup_lines, coalesce(covered.n, 0)::BIGINT AS n_repeat_words
  FROM texts LEFT JOIN lines USING (doc_id) LEFT JOIN covered USING (doc_id)),
judged AS (
  SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
         n_symbols * 10 > n_words * 3
      OR word_chars < 2 * n_words OR word_chars > 15 * n_words
      OR n_dup_lines * 10 > 3 * greatest(10, len(string_split(text, chr(10))))
      OR 2 * length(regexp_replace(text, '[^A-Z]', '', 'g')) > word_chars
      OR 4 * length(regexp_replace(text, '[^!]', '', 'g')) > n_words * 3
      OR 2 * length(regexp_replace(text, '[^\p{L}]', '', 'g')) < word_chars
      OR 5 * len(list_distinct(regexp_extract_all(lower(text), '[^\x20\x09-\x0D]+'))) < least(n_words, 200) AS failed
  FROM measured)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND NOT failed AS kept
FROM judged
"""

# Neighbours by their texts with one code point left out: of equal length they agree without the
# same place, else the shorter one is the longer one without some place.
SPELLING = f"""
WITH RECURSIVE steps(b, k, c) AS (
  SELECT range, 0, range FROM range(256)
  UNION ALL
  SELECT b, k + 1, CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END FROM steps WHERE k < 8),
crc AS MATERIALIZED (SELECT list(c ORDER BY b) AS t FROM steps WHERE k = 8),
runs AS MATERIALIZED (
  SELECT coalesce(doc_id::VARCHAR, '') || ':' || run AS owned, run
  FROM (SELECT doc_id, unnest(regexp_extract_all(translate(text, '{UPPER}', '{LOWER}'), '[A-Za-zÀ-ÿ]+')) AS run FROM documents)
  WHERE length(run) >= 7),
digested AS (
  SELECT run, xor(list_reduce(list_prepend(4294967295, list_transform(range(octet_length(encode(owned))),
           lambda i: ('0x' || substr(hex(encode(owned)), 2 * i + 1, 2))::BIGINT)),
           lambda c, b: xor(c >> 8, t[xor(c & 255, b) + 1])), 4294967295)::BIGINT AS h
  FROM runs, crc),
words AS MATERIALIZED (
  SELECT word, count(*) AS n
  FROM (SELECT CASE WHEN h % 31 = 0 THEN substr(run, 1, (h % length(run))::INT) || substr(run, (h % length(run))::INT + 2)
                    ELSE run END AS word FROM digested)
  WHERE length(word) >= 7 GROUP BY word HAVING count(*) >= 2),
shorter AS MATERIALIZED (
  SELECT word, n, i, substr(word, 1, i::INT) || substr(word, i::INT + 2) AS rest
  FROM words, unnest(range(length(word))) AS t(i)),
pairs AS (
  SELECT a.word, a.n, b.word AS near, b.n AS near_n FROM shorter a JOIN shorter b USING (rest, i) WHERE a.word <> b.word
  UNION SELECT a.word, a.n, w.word, w.n FROM shorter a JOIN words w ON a.rest = w.word
  UNION SELECT w.word, w.n, a.word, a.n FROM shorter a JOIN words w ON a.rest = w.word),
best AS MATERIALIZED (
  SELECT word, count(*) AS n_near,
         CASE WHEN max(near_n) >= 10 * any_value(n) THEN first(near ORDER BY near_n DESC, near) END AS form,
         CASE WHEN max(near_n) >= 10 * any_value(n) THEN max(near_n) END AS form_n
  FROM pairs GROUP BY word),
chains(word, root, depth) AS (
  SELECT word, word, 0 FROM words
  UNION ALL SELECT chains.word, best.form, depth + 1 FROM chains JOIN best ON best.word = chains.root WHERE best.form IS NOT NULL),
roots AS (SELECT word, last(root ORDER BY depth) AS root FROM chains GROUP BY word)
SELECT word, form, root, n::BIGINT AS n, coalesce(n_near, 0)::BIGINT AS n_near, form_n::BIGINT AS form_n
FROM words LEFT JOIN best USING (word) JOIN roots USING (word)
"""

ORACLES: dict[str, str] = {
    "op1_minhash_near_dedup": NEAR_DEDUP,
    "op4_sharding": SHARDING,
    "op5_suffix_array_dedup": SUFFIX_DEDUP,
    "op6_license_scans": LICENSES,
    "op7_benchmark_decontamination": DECONTAMINATION,
    "op10_quality_rules": QUALITY,
    "op13_spelling_variant_grouping": SPELLING,
}
