"""DuckDB SQL for the queries that SQL can express; the others (tokenizers,
trained models) are tested against brute force and held-out accuracy."""

_FOLD = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

OP2 = """
WITH p AS (
  SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha1(coalesce(html, '')) AS payload_digest FROM pages
), q AS (
  SELECT *, CASE WHEN payload_bytes >= 1000 THEN max(page_id) OVER (PARTITION BY payload_digest) ELSE page_id END AS last FROM p
)
SELECT page_id, payload_bytes, payload_digest,
  CASE WHEN last = page_id THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN last <> page_id THEN last END AS refers_to
FROM q
"""

OP5 = f"""
WITH u AS (
  SELECT page_id,
    coalesce({_FOLD.format("regexp_extract(url, '://([^/?#]*)', 1)")}, '') AS host,
    coalesce(regexp_extract(url, '://[^/?#]*([^?#]*)', 1), '') AS path
  FROM pages
), r(verdict, h, p) AS (
  VALUES ('allow', 'org', '/'), ('block', 'example.org', '/es/'), ('block', 'example.org', '/en/1'),
         ('allow', 'com', '/fr/'), ('block', 'com', '/de/')
), best AS (
  SELECT page_id, host, path, arg_max(h || p, length(h || p)) AS rule, arg_max(verdict, length(h || p)) AS verdict
  FROM u JOIN r ON (host = h OR ends_with(host, '.' || h)) AND starts_with(path, p)
  GROUP BY page_id, host, path
)
SELECT u.page_id, u.host, u.path, best.rule, coalesce(best.verdict, 'allow') AS verdict
FROM u LEFT JOIN best USING (page_id, host, path)
"""

OP6 = r"""
WITH d AS (
  SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) AS text_sha256 FROM documents
)
SELECT doc_id, min(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size,
  doc_id = min(doc_id) OVER g AS kept, text_sha256
FROM d WINDOW g AS (PARTITION BY text_sha256)
"""

OP8 = rf"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all({_FOLD.format("coalesce(text, '')")}, '[^\x20\x09-\x0D]+') AS w FROM documents
), s AS (
  SELECT doc_id, CASE WHEN len(w) >= 2 THEN list_distinct([w[i] || ' ' || w[i + 1] for i in range(1, len(w))])
    WHEN len(w) = 1 THEN [w[1]] ELSE [] END AS s FROM w
), e AS (
  SELECT doc_id, len(s) AS n, unnest(s) AS x FROM s
), links AS (
  SELECT a.doc_id AS a, b.doc_id AS b FROM e a JOIN e b ON a.x = b.x AND a.doc_id <> b.doc_id
    AND least(a.n, b.n) * 100 >= greatest(a.n, b.n) * 80
  GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 80 * (a.n + b.n - count(*))
), reach AS (
  SELECT DISTINCT a AS doc_id, a AS other FROM links
  UNION
  SELECT reach.doc_id, links.b FROM reach JOIN links ON links.a = reach.other
), c AS (
  SELECT doc_id, min(other) AS component_id FROM reach GROUP BY doc_id
)
SELECT s.doc_id, CAST(len(s) AS BIGINT) AS n_shingles, coalesce(component_id, s.doc_id) AS component_id,
  coalesce(component_id, s.doc_id) = s.doc_id AS kept
FROM s LEFT JOIN c ON c.doc_id = s.doc_id
"""


def _words(table: str, key: str) -> str:
    scripts = r"\p{Han}\p{Hiragana}\p{Katakana}\p{Thai}\p{Lao}\p{Khmer}\p{Myanmar}"
    spaced = f"regexp_replace(lower(nfc_normalize(coalesce(text, ''))), '([{scripts}])', ' \\1 ', 'g')"
    return rf"SELECT {key}, regexp_extract_all({spaced}, '[\p{{L}}\p{{M}}\p{{N}}]+') AS w FROM {table}"


def _five(source: str, key: str) -> str:
    return f"""SELECT {key}, unnest(CASE WHEN len(w) >= 5
      THEN list_distinct([array_to_string(w[i:i + 4], ' ') for i in range(1, len(w) - 3)])
      WHEN len(w) > 0 THEN ['whole: ' || array_to_string(w, ' ')] ELSE [] END) AS x FROM {source}"""


OP10 = f"""
WITH dw AS ({_words("documents", "doc_id")}), iw AS ({_words("benchmark", "item_id")}),
d AS ({_five("dw", "doc_id")}), i AS ({_five("iw", "item_id")}),
n AS (SELECT item_id, count(*) AS n_item FROM i GROUP BY item_id)
SELECT doc_id, item_id, n_item, count(*) AS n_shared
FROM d JOIN i USING (x) JOIN n USING (item_id)
GROUP BY doc_id, item_id, n_item HAVING 100 * count(*) >= 80 * n_item
"""

OP12 = rf"""
WITH l AS (
  SELECT doc_id, generate_subscripts(l, 1) AS i, unnest(l) AS line
  FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS l FROM documents)
), k AS (
  SELECT *, {_FOLD.format("trim(line, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13))")} AS key FROM l
), r AS (
  SELECT key, max(doc_id) AS keeper FROM k WHERE length(key) >= 20 GROUP BY key HAVING count(DISTINCT doc_id) >= 3
)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE keeper <> doc_id) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (WHERE keeper IS NULL OR keeper = doc_id), '')) AS kept_sha256
FROM k LEFT JOIN r USING (key) GROUP BY doc_id
"""

ORACLE = {
    "op2_warc_members": OP2,
    "op5_url_rules": OP5,
    "op6_exact_dedup": OP6,
    "op8_near_dedup": OP8,
    "op10_decontamination": OP10,
    "op12_line_dedup": OP12,
}
