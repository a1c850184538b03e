"""DuckDB statements for the queries that SQL can express."""

from __future__ import annotations

BLANK = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
UPPER, LOWER = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ'", "'abcdefghijklmnopqrstuvwxyz'"

EMBEDDING_DEDUP = """
WITH RECURSIVE good AS (
  SELECT vec_id, label, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0
), unit AS (
  SELECT vec_id, label, v, sqrt(list_dot_product(v, v)) AS norm FROM good
), link AS (
  SELECT a.vec_id AS u, b.vec_id AS v FROM unit a JOIN unit b ON a.label = b.label AND a.vec_id <> b.vec_id
  WHERE len(a.v) = len(b.v) AND list_dot_product(a.v, b.v) / a.norm / b.norm >= 0.98
), reach AS (
  SELECT vec_id AS node, vec_id AS low FROM embeddings
  UNION SELECT l.v, r.low FROM reach r JOIN link l ON l.u = r.node
), component AS (SELECT node, min(low) AS component_id FROM reach GROUP BY node),
counted AS (SELECT u, count(*) AS n FROM link GROUP BY u)
SELECT e.vec_id, coalesce(n, 0) AS n_links, component_id, component_id = e.vec_id AS kept
FROM embeddings e JOIN component c ON c.node = e.vec_id LEFT JOIN counted ON u = e.vec_id
"""

LINE_DEDUP = f"""
WITH line AS (
  SELECT doc_id, pos, lines[pos] AS line, translate(trim(lines[pos], {BLANK}), {UPPER}, {LOWER}) AS key
  FROM (SELECT doc_id, lines, unnest(range(1, len(lines) + 1)) AS pos
        FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents))
), often AS (SELECT key FROM line GROUP BY key HAVING count(DISTINCT doc_id) >= 10 AND length(key) >= 1),
marked AS (SELECT line.*, often.key IS NOT NULL AS gone FROM line LEFT JOIN often ON line.key = often.key)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT gone), '')) AS kept_sha256
FROM marked GROUP BY doc_id
"""

URL_FILTER = f"""
WITH page AS (
  SELECT page_id,
         translate(regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)', 1), {UPPER}, {LOWER}) AS host,
         regexp_extract(coalesce(url, ''), '(?s)^.*?://[^/?#]*([^?#]*)', 1) AS path
  FROM pages
), rules(verdict, rule_host, rule_path) AS (VALUES
  ('allow', 'org', '/'), ('block', 'example.org', '/es/'), ('block', 'example.org', '/en/1'),
  ('allow', 'com', '/fr/'), ('block', 'com', '/de/')
), ruled AS (
  SELECT page_id, arg_max(rule_host || rule_path, length(rule_host || rule_path)) AS rule,
         arg_max(verdict, length(rule_host || rule_path)) AS ruled
  FROM page JOIN rules ON (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path)
  GROUP BY page_id
), seen AS (
  SELECT page.*, rule, ruled, string_split(host, '.') AS parts FROM page LEFT JOIN ruled USING (page_id)
), placed AS (
  SELECT *, CASE WHEN list_aggregate(parts[greatest(len(parts) - 1, 1):], 'string_agg', '.') IN ('co.uk', 'com.au', 'co.jp', 'com.br')
            THEN list_aggregate(parts[greatest(len(parts) - 2, 1):], 'string_agg', '.')
            ELSE list_aggregate(parts[greatest(len(parts) - 1, 1):], 'string_agg', '.') END AS domain
  FROM seen
), full_rows AS (
  SELECT *, CASE WHEN contains(domain, '.') THEN regexp_extract(domain, '^[^.]*\\.(.*)$', 1) ELSE domain END AS suffix FROM placed
), label AS (SELECT host, domain, suffix, CAST(ruled = 'block' AS INT) AS bad FROM full_rows WHERE ruled IS NOT NULL),
top AS (SELECT (coalesce(sum(bad), 0) + 1.0) / (count(*) + 2.0) AS mean FROM label),
suffix_sum AS (SELECT suffix, CAST(count(*) AS DOUBLE) AS n, CAST(sum(bad) AS DOUBLE) AS bad, (SELECT mean FROM top) AS up FROM label GROUP BY suffix),
suffix_s AS (SELECT {{strength}} AS s FROM suffix_sum),
suffix_post AS (SELECT suffix, (up * s + bad) / (s + n) AS mean, n + s AS weight FROM suffix_sum, suffix_s),
domain_sum AS (SELECT domain, suffix, n, bad, mean AS up FROM
  (SELECT domain, suffix, CAST(count(*) AS DOUBLE) AS n, CAST(sum(bad) AS DOUBLE) AS bad FROM label GROUP BY domain, suffix) JOIN suffix_post USING (suffix)),
domain_s AS (SELECT {{strength}} AS s FROM domain_sum),
domain_post AS (SELECT domain, (up * s + bad) / (s + n) AS mean, n + s AS weight FROM domain_sum, domain_s),
host_sum AS (SELECT host, domain, n, bad, mean AS up FROM
  (SELECT host, domain, CAST(count(*) AS DOUBLE) AS n, CAST(sum(bad) AS DOUBLE) AS bad FROM label GROUP BY host, domain) JOIN domain_post USING (domain)),
host_s AS (SELECT {{strength}} AS s FROM host_sum),
host_post AS (SELECT host, (up * s + bad) / (s + n) AS mean, n + s AS weight FROM host_sum, host_s),
judged AS (
  SELECT f.*, coalesce(h.mean, d.mean, x.mean, (SELECT mean FROM top)) AS m, coalesce(h.weight, (SELECT coalesce(s, 1000) FROM host_s)) AS w
  FROM full_rows f LEFT JOIN host_post h USING (host) LEFT JOIN domain_post d ON d.domain = f.domain LEFT JOIN suffix_post x ON x.suffix = f.suffix
)
SELECT page_id, host, path, rule,
       coalesce(ruled, CASE WHEN m - sqrt(m * (1 - m) / (w + 1)) > 0.5 THEN 'block' ELSE 'allow' END) AS verdict
FROM judged
""".replace("{strength}", """coalesce(least(greatest(
  (sum(n * up * (1 - up)) / sum(n)) / greatest(sum(n * (bad / n - up) ** 2) / sum(n) - sum(up * (1 - up)) / sum(n), 1e-9) - 1, 1.0), 1000.0), 1000.0)""")

SOURCE_MIXING = """
WITH sized AS (
  SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS BIGINT) AS size FROM documents
), per AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM sized GROUP BY source),
weighed AS (
  SELECT *, 2.0 * source_size AS cap, [3.0, 1.0, 2.0][1 + (row_number() OVER (ORDER BY source IS NULL, encode(source)) - 1) % 3] AS weight FROM per
), filled AS (
  -- sources reach their caps in the order of cap / weight; the level rises until the first that does not
  SELECT *, coalesce(sum(cap) OVER before, 0) AS held, sum(weight) OVER rest AS free, 1.5 * sum(source_size) OVER () AS total FROM weighed
  WINDOW before AS (ORDER BY cap / weight, source IS NULL, source ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING),
         rest AS (ORDER BY cap / weight, source IS NULL, source ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)
), level AS (
  SELECT max((total - held) / free) AS level FROM filled
), aimed AS (SELECT source, source_size, least(cap, weight * level) AS target FROM weighed, level),
drawn AS (
  SELECT doc_id, size, source_size, target,
         CASE WHEN source_size > 0 THEN least(target / source_size, 2.0) ELSE 1.0 END AS rate,
         CAST('0x' || substr(md5('17|' || coalesce(CAST(doc_id AS VARCHAR), '')), 1, 13) AS BIGINT) / 4503599627370496.0 AS draw
  FROM sized JOIN aimed ON sized.source IS NOT DISTINCT FROM aimed.source
)
SELECT doc_id, size, source_size, target, CAST(size * (floor(rate) + CASE WHEN draw < rate - floor(rate) THEN 1 ELSE 0 END) AS BIGINT) AS taken
FROM drawn
"""

FILTER_AUDIT = """
WITH doc AS (SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS t FROM documents),
low AS (SELECT t, min(doc_id) AS first FROM doc GROUP BY t),
word AS (
  SELECT doc.*, regexp_extract_all(t, '[^\\x20\\x09-\\x0D]+') AS ws, coalesce(doc_id > first, false) AS copy FROM doc JOIN low USING (t)
), label AS (
  SELECT doc_id, bool_or(quality = 1) AS good, bool_or(toxic = 1) AS toxic FROM labels WHERE doc_id IS NOT NULL GROUP BY doc_id
), failed AS (
  SELECT part, CAST(len(ws) < 200 AS INTEGER) + 2 * CAST(100 * len(list_distinct(ws)) < 50 * len(ws) AS INTEGER)
    + 4 * CAST(100 * len(regexp_extract_all(t, '[A-Z]')) > 2 * length(t) AS INTEGER)
    + 8 * CAST(regexp_matches(t, '[#$%&*|]') AS INTEGER) + 16 * CAST(copy AS INTEGER) AS mask, good, toxic
  FROM word LEFT JOIN label USING (doc_id)
), combo AS (
  SELECT part, mask, count(*) AS n, count(*) FILTER (WHERE good) AS good, count(*) FILTER (WHERE toxic) AS toxic FROM failed GROUP BY part, mask
), letter AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS l, unnest([1, 2, 4, 8, 16]) AS bit),
ordered AS (
  SELECT a.l || b.l || c.l || d.l || e.l AS filter_order, [a.bit, b.bit, c.bit, d.bit, e.bit] AS bits
  FROM letter a, letter b, letter c, letter d, letter e WHERE a.bit + b.bit + c.bit + d.bit + e.bit = 31
    AND len(list_distinct([a.bit, b.bit, c.bit, d.bit, e.bit])) = 5
), stepped AS (
  SELECT filter_order, step, bits[step] AS f, coalesce(list_sum(bits[1:step - 1]), 0)::INTEGER AS before
  FROM ordered, (SELECT unnest(range(1, 6)) AS step)
), counted AS (
  SELECT part, filter_order, step, f,
    coalesce(sum(n) FILTER (WHERE mask & (f | before) = 0), 0) AS kept,
    coalesce(sum(n) FILTER (WHERE mask & f > 0 AND mask & before = 0), 0) AS removed,
    coalesce(sum(n) FILTER (WHERE mask & f > 0 AND mask & before > 0), 0) AS redundant,
    coalesce(sum(n) FILTER (WHERE mask = f), 0) AS unique_fails,
    coalesce(sum(good) FILTER (WHERE mask & f > 0 AND mask & before = 0), 0) AS good_lost,
    coalesce(sum(toxic) FILTER (WHERE mask & f > 0 AND mask & before = 0), 0) AS toxic_lost
  FROM combo, stepped GROUP BY part, filter_order, step, f
)
SELECT part, filter_order, CAST(step AS INTEGER) AS step, CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed,
  CAST(redundant AS BIGINT) AS redundant, CAST(unique_fails AS BIGINT) AS unique_fails, CAST(good_lost AS BIGINT) AS good_lost,
  CAST(toxic_lost AS BIGINT) AS toxic_lost, CAST(sum(removed) OVER (PARTITION BY part, f) AS BIGINT) AS shapley
FROM counted
"""

COLLOCATIONS = f"""
WITH piece AS (
  SELECT lang, regexp_extract_all(piece, '[^\\x20\\x09]+') AS ws FROM (
    SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(translate(coalesce(text, ''), {UPPER}, {LOWER}), '[.,;:!?\\x0A-\\x0D]')) AS piece
    FROM documents)
), sized AS (SELECT lang, ws, unnest([1, 2, 3, 4]) AS m FROM piece),
gram AS (
  SELECT lang, m, array_to_string(ws[i:i + m - 1], ' ') AS phrase
  FROM (SELECT lang, ws, m, unnest(range(1, len(ws) - m + 2)) AS i FROM sized WHERE len(ws) >= m)
), total AS (SELECT lang, count(*) AS n FROM gram WHERE m = 1 GROUP BY lang),
often AS (SELECT lang, m, phrase, count(*) AS f FROM gram GROUP BY lang, m, phrase HAVING count(*) >= 30),
candidate AS (SELECT *, string_split(phrase, ' ') AS ws FROM often WHERE m > 1),
cut AS (
  SELECT c.lang, c.phrase, c.f AS a, c.k, x.f AS l, y.f AS r, CAST(2000000::HUGEINT * c.f // (x.f + y.f) AS BIGINT) AS score
  FROM (SELECT *, unnest(range(1, m)) AS k FROM candidate) c
  JOIN often x ON x.lang = c.lang AND x.phrase = array_to_string(ws[1:k], ' ')
  JOIN often y ON y.lang = c.lang AND y.phrase = array_to_string(ws[k + 1:], ' ')
), lowest AS (SELECT * FROM cut QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
inside AS (
  SELECT lang, array_to_string(ws[s:s + j - 1], ' ') AS phrase, max(f) AS longer
  FROM (SELECT *, unnest(range(1, m - j + 2)) AS s FROM (SELECT *, unnest(range(2, m)) AS j FROM candidate WHERE m > 2))
  GROUP BY ALL
), kept AS (
  SELECT b.* FROM lowest b LEFT JOIN inside i ON i.lang = b.lang AND i.phrase = b.phrase WHERE NOT coalesce(100 * longer >= 80 * a, false)
)
SELECT k.lang, row_number() OVER (PARTITION BY k.lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score
FROM kept k JOIN total t ON t.lang = k.lang QUALIFY rank <= 2000
"""

ORACLES = {
    "op3_embedding_dedup": EMBEDDING_DEDUP,
    "op4_line_dedup": LINE_DEDUP,
    "op5_url_filter": URL_FILTER,
    "op7_source_mixing": SOURCE_MIXING,
    "op11_filter_audit": FILTER_AUDIT,
    "op12_phrase_collocations": COLLOCATIONS,
}
