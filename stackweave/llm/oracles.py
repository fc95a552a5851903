"""The SQL that DuckDB runs next to the queries of this subpackage, where SQL can express them."""

EXACT_DEDUP = r"""
WITH d AS (
  SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) AS text_sha256,
         regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS norm
  FROM documents)
SELECT doc_id, min(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
       doc_id = min(doc_id) OVER w AS kept, text_sha256
FROM d WINDOW w AS (PARTITION BY norm)
"""

_NORMAL_KEY = "md5('9|' || coalesce(CAST(doc_id AS VARCHAR), '') || '|' || coalesce(source, ''))"

MIX = rf"""
WITH d AS (
  SELECT doc_id, source, CASE WHEN text IS NULL THEN 0 ELSE len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')) END AS size,
         -ln((CAST('0x' || substr({_NORMAL_KEY}, 1, 12) AS BIGINT) + CAST(0.5 AS DOUBLE)) / CAST(281474976710656 AS DOUBLE))
           / greatest(coalesce(CAST(1 AS DOUBLE) - CAST(0.75 AS DOUBLE) * (length(regexp_replace(text, '[A-Za-z ]+', '', 'g')) / CAST(nullif(length(text), 0) AS DOUBLE)), 0.25), 1e-6) AS key
  FROM documents),
s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY source),
w AS (SELECT *, CAST([5, 2, 1][(row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1] AS DOUBLE) AS weight, CAST(3 * source_size AS DOUBLE) AS full_size FROM s),
f AS (SELECT *, row_number() OVER o AS place, sum(source_size) OVER () - coalesce(sum(full_size) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS room,
        sum(weight) OVER () - coalesce(sum(weight) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS rest
      FROM w WINDOW o AS (ORDER BY full_size / weight, source NULLS LAST)),
l AS (SELECT arg_min(room / rest, place) AS level FROM f WHERE room * weight <= full_size * rest),
g AS (SELECT source, source_size, coalesce(least(full_size, level * weight), full_size) AS target FROM f CROSS JOIN l),
p AS (SELECT d.*, g.source_size, g.target, coalesce(floor(g.target / nullif(g.source_size, 0)), 0) AS epochs,
        coalesce(sum(d.size) OVER (PARTITION BY d.source ORDER BY key, doc_id, d.size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
      FROM d JOIN g ON d.source IS NOT DISTINCT FROM g.source)
SELECT doc_id, source, CAST(size AS BIGINT) AS size, source_size, target,
       CAST(epochs * size + greatest(0, least(size, round(target - epochs * source_size) - before)) AS BIGINT) AS taken
FROM p
"""


def _base32_sql(digest: str) -> str:
    """Base32 of 40 hexadecimal digits: five of them are four signs."""
    signs = []
    for k in range(8):
        part = f"CAST('0x' || substr({digest}, {5 * k + 1}, 5) AS BIGINT)"
        signs += [f"substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', CAST((({part} >> {shift}) & 31) + 1 AS BIGINT), 1)" for shift in (15, 10, 5, 0)]
    return " || ".join(signs)


WARC = f"""
WITH p AS (SELECT page_id, coalesce(html, '') AS html, max(page_id) OVER (PARTITION BY coalesce(html, '')) AS owner, sha1(coalesce(html, '')) AS sha FROM pages)
SELECT page_id, CAST(strlen(html) AS BIGINT) AS payload_bytes, {_base32_sql('sha')} AS payload_digest,
       CASE WHEN page_id = owner OR owner IS NULL THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id = owner OR owner IS NULL THEN NULL ELSE owner END AS refers_to
FROM p
"""


def _spans_sql(kind: str, rank: int, pattern: str, least: int, value: str) -> str:
    pattern = pattern.replace("'", "''")
    return f"""SELECT n, doc_id, owner, '{kind}' AS kind, {rank} AS rank, pos, pos + length(m) AS stop, {value} AS v FROM (
      SELECT n, doc_id, owner, c[2 * k] AS m, CAST(list_sum(list_transform(c[1:2 * k - 1], lambda x: length(x))) AS BIGINT) AS pos FROM (
        SELECT n, doc_id, owner, c, unnest(generate_series(1, len(c) // 2)) AS k FROM (
          SELECT n, doc_id, owner, string_split(regexp_replace(text, '({pattern})', chr(1) || '\\1' || chr(1), 'g'), chr(1)) AS c FROM d)))
      WHERE length({value}) >= {least}"""


_NAMES = "|".join("".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in word) for word in ("password", "passwd", "secret", "token", "api_?key"))
_ASSIGN = rf"""(?:{_NAMES})["']?\x20*[:=]\x20*["']?[A-Za-z0-9+/_.=-]+"""
_VALUE = r"""regexp_extract(m, '^[A-Za-z_]+["'']?\x20*[:=]\x20*["'']?(.*)$', 1)"""

SECRETS = f"""
WITH d AS (SELECT row_number() OVER () AS n, doc_id, coalesce(source, '') AS owner, replace(coalesce(text, ''), chr(1), chr(2)) AS text FROM documents),
spans AS ({_spans_sql('assign', 0, _ASSIGN, 12, _VALUE)}
  UNION ALL {_spans_sql('access', 1, 'AKIA[A-Z0-9]+', 18, 'm')} UNION ALL {_spans_sql('hex', 2, '[0-9a-f]+', 16, 'm')}),
held AS (SELECT v, CASE WHEN count(DISTINCT owner) >= 3 THEN 'example' WHEN regexp_matches(v, '[0-9]') AND regexp_matches(v, '[A-Za-z]')
    AND len(list_distinct(string_split(v, ''))) >= 8 THEN 'live' ELSE 'weak' END AS verdict FROM spans GROUP BY v),
added AS (SELECT DISTINCT n, verdict AS kind, 3 AS rank, stop - length(v) AS pos, stop FROM spans JOIN held USING (v)),
base AS (SELECT n, count(*) FILTER (kind = 'assign') AS n_assign, count(*) FILTER (kind = 'access') AS n_access, count(*) FILTER (kind = 'hex') AS n_hex,
    string_agg(kind || ':' || pos || ':' || stop, ',' ORDER BY pos, rank) AS line FROM spans GROUP BY n),
everything AS (SELECT n, string_agg(kind || ':' || pos || ':' || stop, ',' ORDER BY pos, rank, stop, kind) AS line,
    count(*) FILTER (kind = 'live') AS n_live, count(*) FILTER (kind = 'example') AS n_example
  FROM (SELECT n, kind, rank, pos, stop FROM spans UNION ALL SELECT n, kind, rank, pos, stop FROM added) GROUP BY n)
SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex, sha256(coalesce(b.line, '')) AS base_sha256,
       coalesce(e.line, '') AS spans, coalesce(n_live, 0) AS n_live, coalesce(n_example, 0) AS n_example
FROM d LEFT JOIN base b USING (n) LEFT JOIN everything e USING (n)
"""

DIVERGENCE = r"""
WITH d AS (SELECT row_number() OVER () AS n, coalesce(lang, '') AS lang, coalesce(source, '') AS source, coalesce(text, '') AS text FROM documents),
t AS (SELECT n, lang, source, unnest(list_transform(regexp_extract_all(text, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+'),
        lambda w: translate(w, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'))) AS term FROM d),
k AS (SELECT lang, term, count(*) AS n FROM t GROUP BY lang, term HAVING count(DISTINCT t.n) >= 10),
c AS (SELECT lang, source, term, count(*) AS n FROM t SEMI JOIN k USING (lang, term) GROUP BY lang, source, term),
v AS (SELECT lang, count(*) AS terms, sum(n) AS total FROM k GROUP BY lang),
g AS (SELECT DISTINCT lang, source FROM d),
s AS (SELECT lang, source, sum(n) AS total FROM c GROUP BY lang, source),
p AS (SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n, k.n AS in_lang, v.terms, v.total AS lang_total,
        1 + (CAST(1000000000 AS HUGEINT) * (coalesce(c.n, 0) + 2)) // (coalesce(s.total, 0) + 2 * v.terms) AS p
      FROM g JOIN k USING (lang) JOIN v USING (lang) LEFT JOIN s USING (lang, source) LEFT JOIN c USING (lang, source, term)),
q AS (SELECT *, 1 + (CAST(1000000000 AS HUGEINT) * (in_lang + 2)) // (lang_total + 2 * terms) AS q FROM p WHERE n > 0),
own AS (SELECT lang, source, 'term' AS part, term AS item, CAST(((p - q) * (p - q)) // (p + q) AS BIGINT) AS value FROM q WHERE p > q),
joint AS (SELECT a.lang, a.source, b.source AS item, sum(((a.p - b.p) * (a.p - b.p)) // (a.p + b.p)) AS value
         FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY a.lang, a.source, b.source),
pairs AS (SELECT a.lang, a.source, 'pair' AS part, b.source AS item, CAST(coalesce(x.value, 0) AS BIGINT) AS value
          FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source LEFT JOIN joint x ON x.lang = a.lang AND x.source = a.source AND x.item = b.source)
SELECT lang, source, part, item, value, CAST(row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS INT) AS rank
FROM (SELECT * FROM own UNION ALL SELECT * FROM pairs) QUALIFY part = 'pair' OR rank <= 10
"""

FILTER_AUDIT = r"""
WITH d AS (SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS text,
             regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents),
l AS (SELECT doc_id, coalesce(bool_or(quality = 1), false) AS good, coalesce(bool_or(toxic = 1), false) AS toxic FROM labels GROUP BY doc_id),
f AS (SELECT part, coalesce(good, false) AS good, coalesce(toxic, false) AS toxic,
        CAST(len(words) < 200 AS INT) + 2 * CAST(100 * len(list_distinct(words)) < 50 * len(words) AS INT)
        + 4 * CAST(100 * length(regexp_replace(text, '[^A-Z]', '', 'g')) > 2 * length(text) AS INT)
        + 8 * CAST(regexp_matches(text, '[#$%&*|]') AS INT)
        + 16 * CAST(coalesce(min(doc_id) OVER (PARTITION BY text) < doc_id, false) AS INT) AS fails
      FROM d LEFT JOIN l USING (doc_id)),
m AS (SELECT part, fails, count(*) AS n, count(*) FILTER (good) AS good, count(*) FILTER (toxic) AS toxic FROM f GROUP BY part, fails),
e AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS f),
o AS (SELECT a.f || b.f || c.f || d.f || e5.f AS filter_order FROM e a JOIN e b ON b.f <> a.f JOIN e c ON c.f NOT IN (a.f, b.f)
      JOIN e d ON d.f NOT IN (a.f, b.f, c.f) JOIN e e5 ON e5.f NOT IN (a.f, b.f, c.f, d.f)),
s AS (SELECT filter_order, CAST(step AS INT) AS step, substr(filter_order, step, 1) AS f,
        CAST(1 << (ascii(substr(filter_order, step, 1)) - 65) AS INT) AS bit,
        CAST(list_sum(list_transform(range(1, step), lambda i: 1 << (ascii(substr(filter_order, i, 1)) - 65))) AS INT) AS before
      FROM o CROSS JOIN (SELECT CAST(unnest([1, 2, 3, 4, 5]) AS BIGINT) AS step)),
r AS (SELECT part, filter_order, step, f,
        sum(n) FILTER (fails & (coalesce(before, 0) | bit) = 0) AS kept,
        sum(n) FILTER (fails & bit > 0 AND fails & coalesce(before, 0) = 0) AS removed,
        sum(n) FILTER (fails & bit > 0 AND fails & coalesce(before, 0) > 0) AS redundant,
        sum(n) FILTER (fails = bit) AS unique_fails,
        sum(good) FILTER (fails & bit > 0 AND fails & coalesce(before, 0) = 0) AS good_lost,
        sum(toxic) FILTER (fails & bit > 0 AND fails & coalesce(before, 0) = 0) AS toxic_lost
      FROM m CROSS JOIN s GROUP BY part, filter_order, step, f)
SELECT part, filter_order, step, CAST(coalesce(kept, 0) AS BIGINT) AS kept, CAST(coalesce(removed, 0) AS BIGINT) AS removed,
  CAST(coalesce(redundant, 0) AS BIGINT) AS redundant, CAST(coalesce(unique_fails, 0) AS BIGINT) AS unique_fails,
  CAST(coalesce(good_lost, 0) AS BIGINT) AS good_lost, CAST(coalesce(toxic_lost, 0) AS BIGINT) AS toxic_lost,
  CAST(sum(coalesce(removed, 0)) OVER (PARTITION BY part, f) AS BIGINT) AS shapley
FROM r
"""
