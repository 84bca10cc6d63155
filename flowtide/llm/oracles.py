"""The queries in SQL, where SQL can express them."""

OP1 = r"""
WITH d AS (
    SELECT doc_id, source, md5('mix ' || coalesce(doc_id::VARCHAR, 'null')) AS key,
           coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size
    FROM documents
), s AS (
    SELECT source, sum(size)::HUGEINT AS source_size FROM d GROUP BY source
), w AS (
    SELECT *, 3 * source_size AS cap, (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS weight,
           row_number() OVER (ORDER BY source NULLS LAST) AS place
    FROM s
), o AS (
    SELECT *, row_number() OVER o AS step, sum(cap) OVER o - cap AS below,
           sum(weight) OVER () - sum(weight) OVER o + weight AS heavier, sum(source_size) OVER () AS everything
    FROM w WINDOW o AS (ORDER BY cap::DOUBLE / weight, place)
), f AS (
    SELECT step, below, heavier, everything FROM o
    WHERE cap::DOUBLE / weight >= (everything - below)::DOUBLE / heavier ORDER BY step LIMIT 1
), g AS (
    SELECT o.source, o.source_size,
           CASE WHEN o.step < f.step THEN o.cap::DOUBLE
                ELSE least((f.everything - f.below)::DOUBLE * o.weight::DOUBLE / f.heavier::DOUBLE, o.cap::DOUBLE)
           END AS target
    FROM o, f
), b AS (
    SELECT *, floor(target)::HUGEINT AS budget,
           CASE WHEN source_size > 0 THEN floor(floor(target) / source_size::DOUBLE)::HUGEINT ELSE 0 END AS epochs
    FROM g
), r AS (
    SELECT d.*, b.source_size, b.target, b.epochs, b.budget - b.epochs * b.source_size AS rest,
           sum(d.size) OVER (PARTITION BY d.source ORDER BY d.key) AS upto,
           sum(d.size) OVER (PARTITION BY d.source, d.key) AS alike
    FROM d JOIN b ON d.source IS NOT DISTINCT FROM b.source
)
SELECT doc_id, size, source_size::BIGINT AS source_size, target,
       (epochs * size + CASE WHEN upto <= rest THEN size
                             WHEN upto - alike >= rest THEN 0
                             ELSE floor((size * (rest - upto + alike))::DOUBLE / alike::DOUBLE) END)::BIGINT AS taken
FROM r
"""

# The method spreads blocks over names of a page. Here a recursion walks from every
# address that a rule blocks to all that it is linked with.
OP7 = r"""
WITH RECURSIVE u AS (
    SELECT page_id, coalesce(url, '') AS url, coalesce(html, '') AS html FROM pages
), parts AS (
    SELECT page_id, url, html,
           translate(regexp_extract(url, '(?s)^.*?://([^/?#]*)([^?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
           regexp_extract(url, '(?s)^.*?://([^/?#]*)([^?#]*)', 2) AS path
    FROM u
), named AS (
    SELECT *, CASE WHEN host <> '' THEN host || path || regexp_extract(url, '(?s)^[^?#]*(\?[^#]*)', 1) END AS address FROM parts
), split AS (
    SELECT address,
           regexp_replace(regexp_replace(regexp_extract(address, '(?s)\?(.*)$', 1), '(?:^|&)(?:utm_[^&=]*|ref|fbclid|gclid)=[^&]*', '', 'g'), '^&', '') AS query,
           regexp_replace(regexp_replace(regexp_extract(address, '(?s)^[^?]*'), '^(?:www|m|amp)\.', ''), '/(?:index\.html?)?$', '') AS place
    FROM named WHERE address IS NOT NULL
), tags AS (
    SELECT address, url, host, path,
           unnest(regexp_extract_all(html, '(?is)<(?:link|meta)\b[^>]*>')) AS tag
    FROM named WHERE address IS NOT NULL
), targets AS (
    SELECT address, url, host, path, replace(regexp_extract(tag, CASE
               WHEN tag[2:5] ILIKE 'link' THEN '(?is)\bhref\s*=\s*[\x22'']?([^\x22''\s>]+)'
               ELSE '(?is)\burl\s*=\s*[\x22'']?([^\x22''\s>]+)' END, 1), '&amp;', '&') AS target
    FROM tags
    WHERE (tag[2:5] ILIKE 'link' AND regexp_matches(tag, '(?is)\brel\s*=\s*[\x22'']?canonical\b'))
       OR (tag[2:5] ILIKE 'meta' AND regexp_matches(tag, '(?is)\bhttp-equiv\s*=\s*[\x22'']?refresh\b'))
), absolute AS (
    SELECT address, CASE
        WHEN regexp_matches(target, '^[A-Za-z][A-Za-z0-9+.-]*://') THEN target
        WHEN target LIKE '//%' THEN regexp_extract(url, '(?s)^(.*?)://', 1) || ':' || target
        WHEN target LIKE '/%' THEN 'x://' || host || target
        WHEN target LIKE '#%' THEN url
        ELSE 'x://' || host || CASE WHEN regexp_extract(path, '(?s)^(.*/)', 1) = '' THEN '/' ELSE regexp_extract(path, '(?s)^(.*/)', 1) END || target
        END AS goal
    FROM targets WHERE target <> ''
), links AS (
    SELECT address AS a, place || CASE WHEN query <> '' THEN '?' || query ELSE '' END AS b FROM split
    UNION
    SELECT address, translate(regexp_extract(goal, '(?s)^.*?://([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')
           || regexp_extract(goal, '(?s)^.*?://[^/?#]*([^?#]*)', 1) || regexp_extract(goal, '(?s)^[^?#]*(\?[^#]*)', 1)
    FROM absolute
), pairs AS (
    SELECT a, b FROM links WHERE a <> b UNION SELECT b, a FROM links WHERE a <> b
), rules(verdict, host, start) AS (
    VALUES ('allow', 'org', '/'), ('block', 'example.org', '/es/'), ('block', 'example.org', '/en/1'),
           ('allow', 'com', '/fr/'), ('block', 'com', '/de/')
), nodes AS (
    SELECT DISTINCT a AS node, regexp_extract(a, '(?s)^[^/?]*') AS host, regexp_extract(a, '(?s)^[^/?]*([^?]*)', 1) AS path FROM pairs
), judged AS (
    SELECT node, (SELECT verdict FROM rules r
                  WHERE (n.host = r.host OR ends_with(n.host, '.' || r.host)) AND starts_with(n.path, r.start)
                  ORDER BY length(r.host || r.start) DESC, verdict LIMIT 1) AS verdict
    FROM nodes n
), blocked(node) AS (
    SELECT node FROM judged WHERE verdict = 'block'
    UNION
    SELECT pairs.b FROM blocked JOIN pairs ON blocked.node = pairs.a
)
SELECT page_id, host, path,
       (SELECT r.host || r.start FROM rules r
        WHERE (n.host = r.host OR ends_with(n.host, '.' || r.host)) AND starts_with(n.path, r.start)
        ORDER BY length(r.host || r.start) DESC, verdict LIMIT 1) AS rule,
       coalesce((SELECT verdict FROM rules r
                 WHERE (n.host = r.host OR ends_with(n.host, '.' || r.host)) AND starts_with(n.path, r.start)
                 ORDER BY length(r.host || r.start) DESC, verdict LIMIT 1),
                CASE WHEN n.address IN (SELECT node FROM blocked) THEN 'block' ELSE 'allow' END) AS verdict
FROM named n
"""

ORACLES = {"op1_mix_sources": OP1, "op7_url_filter": OP7}
