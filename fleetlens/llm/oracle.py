"""DuckDB twins of the queries that SQL can express: plain statements of the
results, with none of the operators' methods."""

# Entropy of a window as the operator compares it, from the histogram of each
# window by itself.
ENTROPY = "sum(CAST(round(1048576 * n * log2(n)) AS BIGINT))"


def _limit(bits: str) -> str:
    return f"floor(1048576 * 20 * (log2(20) - {bits}))"


ORACLE: dict[str, str] = {
    "op7_exact_dedup": r"""
WITH t AS (
  SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[ \t-\r]+', ' ', 'g')) AS text_sha256
  FROM documents),
g AS (
  SELECT *, min(doc_id) OVER (PARTITION BY text_sha256) AS keep_id,
         count(*) OVER (PARTITION BY text_sha256) AS group_size
  FROM t)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, text_sha256 FROM g
""",
    "op11_source_divergence": r"""
WITH d AS (
  SELECT row_number() OVER () AS row, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
    unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term
  FROM documents),
kept AS (SELECT lang, term FROM d GROUP BY ALL HAVING count(DISTINCT row) >= 10),
v AS (SELECT lang, count(*) AS v FROM kept GROUP BY lang),
groups AS (SELECT DISTINCT coalesce(lang, '') AS lang, coalesce(source, '') AS source FROM documents),
uses AS (SELECT lang, source, term, count(*) AS n FROM d JOIN kept USING (lang, term) GROUP BY ALL),
total AS (SELECT lang, source, sum(n) AS total FROM uses GROUP BY ALL),
whole AS (SELECT lang, sum(n) AS total FROM uses GROUP BY ALL),
p AS (
  SELECT g.lang, g.source, k.term, coalesce(u.n, 0) AS n,
    CAST(1 + 1000000000::HUGEINT * (coalesce(u.n, 0) + 2) // (coalesce(t.total, 0) + 2 * v.v) AS BIGINT) AS p
  FROM groups g JOIN kept k USING (lang) JOIN v USING (lang) LEFT JOIN total t ON t.lang = g.lang AND t.source = g.source
    LEFT JOIN uses u ON u.lang = g.lang AND u.source = g.source AND u.term = k.term),
q AS (
  SELECT lang, term, CAST(1 + 1000000000::HUGEINT * (sum(n) + 2) // (w.total + 2 * v.v) AS BIGINT) AS q
  FROM uses JOIN whole w USING (lang) JOIN v USING (lang) GROUP BY lang, term, w.total, v.v),
gaps AS (
  SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // (a.p + b.p)) AS value
  FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
pairs AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, CAST(coalesce(value, 0) AS BIGINT) AS value
  FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source
    LEFT JOIN gaps g ON g.lang = a.lang AND g.source = a.source AND g.item = b.source),
terms AS (
  SELECT lang, source, 'term' AS part, term AS item, (p - q) * (p - q) // (p + q) AS value
  FROM p JOIN q USING (lang, term) WHERE n > 0 AND p > q),
ranked AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS INT) AS rank
  FROM (FROM pairs UNION ALL FROM terms))
SELECT lang, source, part, item, value, rank FROM ranked WHERE part = 'pair' OR rank <= 10
""",
    "op13_secret_scan": rf"""
WITH d AS (SELECT row_number() OVER () AS row, doc_id, coalesce(text, '') AS text FROM documents),
form(kind, name, pattern) AS (VALUES
  (0, 'assign', '(?:[Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["'']?\x20*[:=]\x20*["'']?([A-Za-z0-9+/_.=-]+)'),
  (1, 'access', '(AKIA[A-Z0-9]+)'), (2, 'hex', '([0-9a-f]+)'), (3, 'entropy', '([A-Za-z0-9+/_=-]{{20,}})')),
found AS (
  SELECT row, kind, name, regexp_extract_all(text, pattern) AS matches, regexp_extract_all(text, pattern, 1) AS cores,
    string_split_regex(text, pattern) AS gaps
  FROM d, form WHERE regexp_matches(text, pattern)),
listed AS (
  SELECT row, kind, name, unnest(matches) AS match, unnest(cores) AS core, unnest(gaps[:-2]) AS gap,
    generate_subscripts(matches, 1) AS i FROM found),
placed AS (
  SELECT row, kind, name, match, core,
    CAST(sum(length(gap) + length(match)) OVER (PARTITION BY row, kind ORDER BY i) AS BIGINT) AS stop FROM listed),
spans AS (
  SELECT row, kind, name, match, stop - length(match) AS start, stop FROM placed
  WHERE length(core) >= CASE kind WHEN 0 THEN 6 WHEN 2 THEN 24 ELSE 20 END),
shut AS (
  SELECT * FROM spans c WHERE kind = 3
    AND NOT regexp_matches(match, '^[0-9]+$') AND NOT regexp_matches(match, '^(?:[A-Z]?[a-z]+|[A-Z]+)$')
    AND NOT regexp_matches(match, '^(?:[A-Z]?[a-z]{{2,}})+[0-9]{{0,4}}$')
    AND NOT regexp_matches(match, '^[-_/+=]*(?:[A-Za-z]+|[0-9]{{1,8}})(?:[-_/+=]+(?:[A-Za-z]+|[0-9]{{1,8}}))*[-_/+=]*$')
    AND NOT regexp_matches(match, '^[0-9a-fA-F]{{8}}-(?:[0-9a-fA-F]{{4}}-){{3}}[0-9a-fA-F]{{12}}$')
    AND NOT regexp_matches(match, '(?i)example|sample|placeholder|changeme|dummy|x{{6}}|0{{8}}|1234567')
    AND NOT EXISTS (FROM spans b WHERE b.row = c.row AND b.kind < 3 AND b.start <= c.start AND b.stop >= c.stop)),
windows AS (SELECT row, start, match, unnest(range(1, length(match) - 18)) AS w FROM shut),
letters AS (SELECT row, start, match, w, unnest(range(0, 20)) AS o FROM windows),
counts AS (SELECT row, start, match, w, match[w + o] AS c, count(*) AS n FROM letters GROUP BY ALL),
sums AS (SELECT row, start, match, w, {ENTROPY} AS s FROM counts GROUP BY ALL),
dense AS (
  SELECT row, start FROM sums GROUP BY row, start, match
  HAVING min(s) <= CASE WHEN regexp_matches(match, '^[0-9a-fA-F]+$') THEN {_limit('3.0')}
    WHEN regexp_matches(match, '^[A-Za-z0-9]+$') THEN {_limit('3.7')} ELSE {_limit('3.8')} END),
kept AS (
  SELECT row, kind, start, concat(name, ':', start, ':', stop) AS line FROM spans s
  WHERE kind < 3 OR EXISTS (FROM dense e WHERE e.row = s.row AND e.start = s.start))
SELECT doc_id, count(*) FILTER (kind = 0) AS n_assign, count(*) FILTER (kind = 1) AS n_access,
  count(*) FILTER (kind = 2) AS n_hex,
  sha256(coalesce(string_agg(line, ',' ORDER BY start, kind) FILTER (kind < 3), '')) AS base_sha256,
  coalesce(string_agg(line, ',' ORDER BY start, kind), '') AS spans
FROM (SELECT d.row, doc_id, kind, start, line FROM d LEFT JOIN kept USING (row)) GROUP BY row, doc_id
""",
}
