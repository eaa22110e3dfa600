"""DuckDB statements of the registered queries that SQL can express."""

from __future__ import annotations

ORACLES: dict[str, str] = {}

#: The four rules are spelled out; the longest that fits wins.
ORACLES["op6_url_rules"] = r"""
WITH u AS (
  SELECT page_id, CASE WHEN contains(url, '://') THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages
), p AS (
  SELECT page_id,
         translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path
  FROM u
), r(rhost, rpath, verdict) AS (
  VALUES ('net', '/', 'block'), ('example.net', '/en/', 'allow'), ('example.com', '/de/', 'block'), ('org', '/fr/', 'allow')
), m AS (
  SELECT p.page_id, max_by(rhost || rpath, length(rhost || rpath)) AS rule, max_by(verdict, length(rhost || rpath)) AS verdict
  FROM p JOIN r ON (host = rhost OR ends_with(host, '.' || rhost)) AND starts_with(path, rpath)
  GROUP BY p.page_id
)
SELECT p.page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict FROM p LEFT JOIN m ON p.page_id = m.page_id
"""
