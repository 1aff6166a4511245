"""SQL counterparts of the corpus queries that SQL can express."""

URL_REPUTATION = """
WITH parts AS (
  SELECT page_id,
    translate(coalesce(regexp_extract(url, '^.*?://([^/?#]*)', 1, 's'), ''),
      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    coalesce(regexp_extract(url, '^.*?://[^/?#]*([^?#]*)', 1, 's'), '') AS path
  FROM pages
), ruled AS (
  SELECT *, CASE
    WHEN (host = 'example.org' OR ends_with(host, '.example.org')) AND starts_with(path, '/en/1') THEN 'example.org/en/1'
    WHEN (host = 'example.org' OR ends_with(host, '.example.org')) AND starts_with(path, '/es/') THEN 'example.org/es/'
    WHEN (host = 'com' OR ends_with(host, '.com')) AND starts_with(path, '/de/') THEN 'com/de/'
    WHEN (host = 'com' OR ends_with(host, '.com')) AND starts_with(path, '/fr/') THEN 'com/fr/'
    WHEN (host = 'org' OR ends_with(host, '.org')) AND starts_with(path, '/') THEN 'org/' END AS rule
  FROM parts
), said AS (
  SELECT *, CASE WHEN rule IN ('example.org/en/1', 'example.org/es/', 'com/de/') THEN 'block'
    WHEN rule IS NOT NULL THEN 'allow' END AS by_rule FROM ruled
), hosts AS (
  SELECT host, split_part(host, '.', -1) AS suffix, split_part(host, '.', -2) || '.' || split_part(host, '.', -1) AS domain,
    count(by_rule)::DOUBLE AS n, count(*) FILTER (by_rule = 'block')::DOUBLE AS bad
  FROM said GROUP BY host
), total AS (SELECT (sum(bad) + 1) / (sum(n) + 2) AS share FROM hosts
), units AS (
  SELECT 'suffix' AS level, suffix AS unit, sum(n) AS n, sum(bad) AS bad FROM hosts GROUP BY suffix HAVING sum(n) > 0
  UNION ALL SELECT 'domain', domain, sum(n), sum(bad) FROM hosts GROUP BY domain HAVING sum(n) > 0
  UNION ALL SELECT 'host', host, n, bad FROM hosts WHERE n > 0
), sums AS (
  SELECT level, sum(n) AS n, count(*) AS k, sum(bad) / sum(n) AS mean, sum(bad * bad / n) AS q, sum(n * n) AS squares
  FROM units GROUP BY level
), moments AS (
  SELECT level, k, mean * (1 - mean) AS inside,
    (q - n * mean * mean - (k - 1) * mean * (1 - mean)) / CASE WHEN k < 2 THEN 1 ELSE n - squares / n END AS between
  FROM sums
), levels(level) AS (VALUES ('suffix'), ('domain'), ('host')
), strengths AS (
  SELECT level, CASE WHEN k IS NULL OR k < 2 OR between <= 0 OR inside = 0 THEN 1000.0
    ELSE least(1000.0, greatest(1.0, inside / between - 1)) END AS s
  FROM levels LEFT JOIN moments USING (level)
), by_suffix AS (
  SELECT suffix, (s * share + sum(bad)) / (s + sum(n)) AS share
  FROM hosts, total, strengths WHERE level = 'suffix' GROUP BY suffix, s, share
), by_domain AS (
  SELECT domain, (s * b.share + sum(bad)) / (s + sum(n)) AS share
  FROM hosts JOIN by_suffix b USING (suffix), strengths WHERE level = 'domain' GROUP BY domain, s, b.share
), by_host AS (
  SELECT host, s * d.share + bad AS a, s * (1 - d.share) + n - bad AS b
  FROM hosts JOIN by_domain d USING (domain), strengths WHERE level = 'host'
), bounds AS (
  SELECT host, a / (a + b) - 1.6448536269514722 * sqrt(a / (a + b) * (b / (a + b)) / (a + b + 1)) AS low FROM by_host
)
SELECT page_id, host, path, rule,
  coalesce(by_rule, CASE WHEN low > 0.5 THEN 'block' ELSE 'allow' END) AS verdict
FROM said LEFT JOIN bounds USING (host)
"""
