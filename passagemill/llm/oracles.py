"""DuckDB SQL of the registered queries that SQL can express."""

_WORDS = "regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')"

OP1 = f"""
WITH t AS (SELECT doc_id, source, coalesce(text, '') AS text, {_WORDS} AS words FROM documents),
lines AS (SELECT doc_id, source, unnest(string_split(text, chr(10))) AS line FROM t),
filled AS (
  SELECT doc_id, source, line,
         lower(array_to_string(regexp_extract_all(regexp_replace(line, '[0-9]+', '0', 'g'), '[^\\x20\\x09-\\x0D]+'), ' ')) AS norm,
         len(regexp_extract_all(line, '[^\\x20\\x09-\\x0D]+')) AS words
  FROM lines WHERE regexp_matches(line, '[^\\x20\\x09-\\x0D]')),
hosts AS (SELECT source, count(DISTINCT doc_id) AS size FROM documents GROUP BY source),
heavy AS (
  SELECT f.source, norm FROM filled f JOIN hosts h ON f.source IS NOT DISTINCT FROM h.source
  GROUP BY f.source, norm, size HAVING count(DISTINCT doc_id) >= 20 AND (count(DISTINCT doc_id) > 0.1 * size OR count(DISTINCT doc_id) >= 200)),
gone AS (
  SELECT doc_id, sum(words) AS n FROM filled f
  WHERE EXISTS (SELECT 1 FROM heavy h WHERE h.source IS NOT DISTINCT FROM f.source AND h.norm = f.norm) GROUP BY doc_id),
dups AS (SELECT doc_id, count(*) - count(DISTINCT line) AS n FROM filled GROUP BY doc_id),
wins AS (
  SELECT doc_id, i, array_to_string(words[i:i + 7], ' ') AS w
  FROM (SELECT doc_id, words, unnest(range(1, len(words) - 6)) AS i FROM t WHERE len(words) >= 8)),
again AS (SELECT doc_id, w FROM wins GROUP BY doc_id, w HAVING count(*) > 1),
covered AS (SELECT doc_id, count(DISTINCT p) AS n FROM (
  SELECT w.doc_id, unnest(range(i, i + 8)) AS p FROM wins w JOIN again a ON w.doc_id = a.doc_id AND w.w = a.w) GROUP BY doc_id),
base AS (
  SELECT t.doc_id, len(words)::BIGINT AS n_words,
         coalesce(list_sum(list_transform(words, lambda x: length(x))), 0)::BIGINT AS word_chars,
         length(regexp_replace(text, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols,
         coalesce(d.n, 0)::BIGINT AS n_dup_lines, coalesce(c.n, 0)::BIGINT AS n_repeat_words,
         coalesce(g.n, 0)::BIGINT AS n_removed_words
  FROM t LEFT JOIN dups d ON t.doc_id = d.doc_id LEFT JOIN covered c ON t.doc_id = c.doc_id LEFT JOIN gone g ON t.doc_id = g.doc_id)
SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed,
       NOT (n_words < 20 OR 100 * n_repeat_words > 30 * n_words OR n_removed_words > 0.5 * n_words) AS kept
FROM base
"""

OP4 = f"""
WITH t AS (SELECT doc_id, {_WORDS} AS words FROM documents),
wins AS (
  SELECT doc_id, i, md5(array_to_string(words[i:i + 49], ' ')) AS w
  FROM (SELECT doc_id, words, unnest(range(1, len(words) - 48)) AS i FROM t WHERE len(words) >= 50)),
firsts AS (SELECT w, min(doc_id) AS first FROM wins GROUP BY w),
gone AS (
  SELECT DISTINCT doc_id, unnest(range(i, i + 50)) AS p FROM wins JOIN firsts USING (w) WHERE first < doc_id),
left_over AS (
  SELECT a.doc_id, string_agg(word, ' ' ORDER BY a.p) AS kept, count(*) AS n
  FROM (SELECT doc_id, unnest(words) AS word, unnest(range(1, len(words) + 1)) AS p FROM t) a
  LEFT JOIN gone g ON a.doc_id = g.doc_id AND a.p = g.p WHERE g.p IS NULL GROUP BY a.doc_id)
SELECT t.doc_id, len(words)::BIGINT AS n_words, (len(words) - coalesce(n, 0))::BIGINT AS n_removed,
       sha256(coalesce(kept, '')) AS kept_sha256
FROM t LEFT JOIN left_over l ON t.doc_id = l.doc_id
"""

OP8 = """
WITH rules(rule_host, rule_path, rule_verdict) AS (VALUES
  ('com', '/', 'allow'), ('example.com', '/en/', 'block'), ('www.example.com', '/en/', 'allow'),
  ('net', '/es/', 'block'), ('net', '/fr/', 'block')),
rest AS (SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS r FROM pages),
parts AS (
  SELECT page_id, translate(regexp_extract(r, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(r, '^[^/?#]*([^?#]*)', 1) AS path FROM rest),
met AS (
  SELECT p.*, rule_host || rule_path AS rule, rule_verdict,
         row_number() OVER (PARTITION BY page_id ORDER BY length(rule_host || rule_path) DESC NULLS LAST, rule_verdict DESC) AS k
  FROM parts p LEFT JOIN rules ON (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path))
SELECT page_id, host, path, rule, coalesce(rule_verdict, 'allow') AS verdict FROM met WHERE k = 1
"""

_BENCH_WORDS = "regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"

OP10 = f"""
WITH i AS (SELECT item_id, {_BENCH_WORDS} AS words FROM benchmark),
d AS (SELECT doc_id, {_BENCH_WORDS} AS words FROM documents),
iw AS (
  SELECT DISTINCT item_id, least(len(words), 13) AS n, array_to_string(words[a:a + 12], ' ') AS w
  FROM (SELECT item_id, words, unnest(range(1, greatest(len(words) - 12, 1) + 1)) AS a FROM i WHERE len(words) > 0)),
sizes AS (SELECT DISTINCT n FROM iw),
dw AS (
  SELECT doc_id, n, a, array_to_string(words[a:a + n - 1], ' ') AS w
  FROM (SELECT doc_id, words, n, unnest(range(1, len(words) - n + 2)) AS a FROM d JOIN sizes ON len(words) >= n)),
hits AS (SELECT doc_id, a, dw.n, item_id FROM dw JOIN iw ON dw.n = iw.n AND dw.w = iw.w),
hit AS (SELECT doc_id, count(DISTINCT p) AS n FROM (SELECT doc_id, unnest(range(a, a + n)) AS p FROM hits) GROUP BY doc_id),
items AS (
  SELECT doc_id, count(*) AS n, string_agg(item, ',' ORDER BY item) AS list
  FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS item FROM hits) GROUP BY doc_id)
SELECT d.doc_id, len(words)::BIGINT AS n_words, coalesce(h.n, 0)::BIGINT AS n_hit, coalesce(s.n, 0)::BIGINT AS n_items,
       sha256(coalesce(list, '')) AS items_sha256,
       coalesce(h.n, 0) > 0 AND 20 * coalesce(h.n, 0) >= len(words) AS contaminated
FROM d LEFT JOIN hit h ON d.doc_id = h.doc_id LEFT JOIN items s ON d.doc_id = s.doc_id
"""

_TERMS = "regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+')"

OP13 = f"""
WITH i AS (SELECT DISTINCT item_id, unnest({_TERMS}) AS term FROM benchmark),
d AS (SELECT doc_id, {_TERMS} AS terms FROM documents),
total AS (SELECT count(*)::BIGINT AS big_n, sum(len(terms))::BIGINT AS big_l FROM d WHERE len(terms) > 0),
tf AS (
  SELECT doc_id, n, term, count(*)::BIGINT AS tf FROM (SELECT doc_id, len(terms)::BIGINT AS n, unnest(terms) AS term FROM d)
  WHERE term IN (SELECT term FROM i) GROUP BY doc_id, n, term),
df AS (SELECT term, count(*)::BIGINT AS df FROM tf GROUP BY term),
w AS (SELECT term, floor(1000 * ln((2 * big_n + 2) / (2 * df + 1)))::BIGINT AS w FROM df, total),
s AS (
  SELECT item_id, doc_id, sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (10 + (90 * n * big_n) // big_l))))::BIGINT AS score
  FROM i JOIN tf USING (term) JOIN w USING (term), total GROUP BY item_id, doc_id),
r AS (SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id)::INTEGER AS rank, doc_id, score FROM s WHERE score > 0)
SELECT * FROM r WHERE rank <= 10
"""

ORACLES = {"op1_quality_rules": OP1, "op4_countmin_dedup": OP4, "op8_url_filter": OP8, "op10_decontamination": OP10, "op13_lexical_search": OP13}
