"""Checks of the operators' queries, as DuckDB reads them."""

URLS = r"""
WITH parts AS (
  SELECT page_id, CASE WHEN contains(url, '://') THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest
  FROM pages
), pages_of AS (
  SELECT page_id,
         translate(regexp_extract(rest, '^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path
  FROM parts
), rules(host, path, verdict) AS (
  VALUES ('com', '/', 'allow'), ('example.com', '/en/', 'block'), ('www.example.com', '/en/', 'allow'),
         ('net', '/es/', 'block'), ('net', '/fr/', 'block')
), hits AS (
  SELECT page_id, arg_max(r.host || r.path, length(r.host || r.path)) AS rule,
         arg_max(r.verdict, length(r.host || r.path)) AS verdict
  FROM pages_of p JOIN rules r
    ON (p.host = r.host OR ends_with(p.host, '.' || r.host)) AND starts_with(p.path, r.path)
  GROUP BY page_id
)
SELECT page_id, host, path, h.rule AS rule, coalesce(h.verdict, 'allow') AS verdict
FROM pages_of LEFT JOIN hits h USING (page_id)
"""

RULES = r"""
WITH words AS (
  SELECT doc_id, coalesce(text, '') AS t,
         list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w,
         list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS l
  FROM documents
), windows AS (
  SELECT doc_id, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] AS gram
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 1, 1))) AS i FROM words)
), repeated AS (
  SELECT doc_id, count(DISTINCT i + d) AS n
  FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, gram) AS c FROM windows), range(0, 3) AS r(d)
  WHERE c > 1 GROUP BY doc_id
), base AS (
  SELECT doc_id, len(w) AS n_words,
         coalesce(list_sum(list_transform(w, lambda x: length(x))), 0)::BIGINT AS word_chars,
         length(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) AS n_symbols,
         (len(l) - len(list_distinct(l)))::BIGINT AS n_dup_lines,
         coalesce(r.n, 0) AS n_repeat_words, len(l) AS n_lines,
         len(list_filter(w, lambda x: regexp_matches(x, '^[^a-z]*[A-Z][^a-z]*[A-Z][^a-z]*$'))) AS n_capital
  FROM words LEFT JOIN repeated r USING (doc_id)
), judged AS (
  SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM base
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND NOT (n_symbols * 4 > n_words OR n_capital * 100 > n_words * 60
                                OR n_dup_lines * 100 > n_lines * 40) AS kept
FROM judged
"""

NEAR_COPIES = r"""
WITH RECURSIVE words AS (
  SELECT doc_id, list_filter(regexp_split_to_array(
           translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w
  FROM documents
), sets AS (
  SELECT doc_id, CASE WHEN len(w) > 1
                      THEN list_distinct(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]))
                      ELSE w END AS s
  FROM words
), items AS (SELECT doc_id, len(s) AS n, unnest(s) AS x FROM sets),
links AS (
  SELECT a.doc_id AS u, b.doc_id AS v
  FROM items a JOIN items b ON a.x = b.x AND a.doc_id <> b.doc_id
  GROUP BY a.doc_id, b.doc_id, a.n, b.n
  HAVING 100 * count(*) >= 80 * (a.n + b.n - count(*))
), reach(u, v) AS (
  SELECT u, v FROM links
  UNION
  SELECT r.u, l.v FROM reach r JOIN links l ON r.v = l.u
), least AS (SELECT u, min(v) AS m FROM reach GROUP BY u)
SELECT doc_id, len(s)::BIGINT AS n_shingles, least(doc_id, coalesce(m, doc_id)) AS component_id,
       doc_id = least(doc_id, coalesce(m, doc_id)) AS kept
FROM sets LEFT JOIN least ON u = doc_id
"""
