"""DuckDB SQL of the corpus queries that SQL can express over whole tables.

Written from the definitions: the similarity query joins all documents on shared shingles, the
neighbour search ranks all pairs, the placement table is filled here by a plain loop.  The other
queries (packing, language scores, token ids, spans of the randomness tests, hashes that DuckDB
lacks, fuzzy lines within the check's time) are tested against brute force in ``tests/llm``.
"""

from __future__ import annotations

import hashlib

_NEAR_DUPLICATES = r"""
WITH RECURSIVE words AS MATERIALIZED (
  SELECT doc_id, regexp_extract_all(
      translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
  FROM documents),
shingles AS MATERIALIZED (
  SELECT DISTINCT doc_id, s FROM (
    SELECT doc_id, unnest(CASE WHEN len(w) >= 2 THEN list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])
                               WHEN len(w) = 1 THEN [w[1]] ELSE [] END) AS s FROM words)),
sizes AS MATERIALIZED (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
links AS MATERIALIZED (
  SELECT a, b FROM (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS common
                    FROM shingles x JOIN shingles y ON x.s = y.s AND x.doc_id <> y.doc_id GROUP BY ALL) p
  JOIN sizes sa ON sa.doc_id = a JOIN sizes sb ON sb.doc_id = b
  WHERE 100 * common >= 80 * (sa.n + sb.n - common)),
reach AS (
  SELECT DISTINCT a AS doc_id, a AS other FROM links
  UNION
  SELECT r.doc_id, l.b FROM reach r JOIN links l ON l.a = r.other)
SELECT d.doc_id, coalesce(s.n, 0) AS n_shingles, coalesce(c.least, d.doc_id) AS component_id,
       d.doc_id = coalesce(c.least, d.doc_id) AS kept
FROM documents d LEFT JOIN sizes s USING (doc_id)
LEFT JOIN (SELECT doc_id, min(other) AS least FROM reach GROUP BY doc_id) c USING (doc_id)
"""

_NEIGHBOURS = """
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: x::DOUBLE) AS e FROM embeddings
           WHERE len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
             AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
d AS (SELECT q.vec_id AS query_id, c.vec_id, sqrt(list_reduce(list_transform(range(1, len(q.e) + 1),
             lambda i: (q.e[i] - c.e[i]) * (q.e[i] - c.e[i])), lambda a, x: a + x)) AS score
      FROM v q JOIN v c ON q.vec_id % 100 = 0 AND c.vec_id <> q.vec_id AND len(c.e) = len(q.e)),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score, vec_id) AS rank FROM d)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM r WHERE rank <= 10
"""


def _level(units: str, out: str) -> str:
    """Strength of the priors at one level, from the spread of its units' rates."""
    return f"""{out}_level AS (
  SELECT CASE WHEN coalesce(sum(n), 0) = 0 OR sum(n * prior * (1 - prior)) <= 0
                   OR sum(n * (k / n - prior) ** 2) - sum(prior * (1 - prior)) <= 0 THEN 200.0
              ELSE least(greatest(sum(n * prior * (1 - prior))
                   / (sum(n * (k / n - prior) ** 2) - sum(prior * (1 - prior))) - 1, 2.0), 200.0) END AS level
  FROM {units} WHERE n > 0),
{out} AS (SELECT u.*, least(level, prior_weight) AS strength FROM {units} u, {out}_level)"""


def _prior(parent: str) -> str:
    w = f"({parent}.n - c.n + {parent}.strength)"
    return f"({parent}.k - c.k + {parent}.prior * {parent}.strength) / {w} AS prior, {w} AS prior_weight"


_URLS = rf"""
WITH parts AS (
  SELECT page_id, regexp_replace(html, '(?is)<script.*?(</script>|\z)|<style.*?(</style>|\z)|<!--.*?(-->|\z)|<[^<>]*>', ' ', 'g') AS body,
         translate(coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1), ''),
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         coalesce(regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1), '') AS path
  FROM pages),
ruled AS (
  SELECT *, CASE
      WHEN (host = 'www.example.com' OR suffix(host, '.www.example.com')) AND prefix(path, '/en/') THEN 'www.example.com/en/'
      WHEN (host = 'example.com' OR suffix(host, '.example.com')) AND prefix(path, '/en/') THEN 'example.com/en/'
      WHEN (host = 'net' OR suffix(host, '.net')) AND prefix(path, '/es/') THEN 'net/es/'
      WHEN (host = 'net' OR suffix(host, '.net')) AND prefix(path, '/fr/') THEN 'net/fr/'
      WHEN (host = 'com' OR suffix(host, '.com')) AND prefix(path, '/') THEN 'com/' END AS rule
  FROM parts),
counts AS (
  SELECT *, len(regexp_extract_all(body, '[^ \t-\r]+')) AS words, len(regexp_extract_all(body, '[#$%*|]+')) AS symbols FROM ruled),
marked AS (SELECT *, CASE WHEN words > 0 THEN CAST(symbols / words > 0.1 AS INTEGER) END AS bad FROM counts),
hosts AS (
  SELECT host, count(bad)::DOUBLE AS n, coalesce(sum(bad), 0)::DOUBLE AS k,
         regexp_extract(host, '([^.]*[.])?' || suffix || '$', 0) AS domain, suffix
  FROM (SELECT *, regexp_extract(host, '((co|org|ac|gov)[.]uk|com[.](au|br)|co[.](jp|nz|in)|[^.]*)$', 0) AS suffix FROM
        (SELECT host, bad FROM marked)) GROUP BY host, suffix),
corpus AS (SELECT sum(n) AS n, sum(k) AS k, 0.5 AS prior, 2.0 AS strength FROM hosts),
s0 AS (SELECT c.*, {_prior('p')} FROM (SELECT suffix, sum(n) AS n, sum(k) AS k FROM hosts GROUP BY suffix) c, corpus p),
{_level('s0', 's1_seen')},
s1 AS (SELECT * REPLACE (CASE WHEN n > 0 THEN strength ELSE least(strength, 2.0) END AS strength) FROM s1_seen),
d0 AS (SELECT c.*, {_prior('p')} FROM (SELECT suffix, domain, sum(n) AS n, sum(k) AS k FROM hosts GROUP BY ALL) c JOIN s1 p USING (suffix)),
{_level('d0', 'd1')},
h0 AS (SELECT c.*, {_prior('p')} FROM hosts c JOIN d1 p USING (suffix, domain)),
{_level('h0', 'h1')},
post AS (SELECT host, (k + prior * strength) / (n + strength) AS m, n + strength AS w FROM h1),
bound AS (SELECT host, round(m, 9) AS bad_rate,
                 round((2 * w * m + z2 - sqrt(z2) * sqrt(z2 + 4 * w * m * (1 - m))) / (2 * (w + z2)), 9) AS bad_lower
          FROM post, (SELECT 2.326::DOUBLE ** 2 AS z2))
SELECT page_id, host, path, rule,
       CASE WHEN rule IN ('com/', 'www.example.com/en/') THEN 'allow' WHEN rule IS NOT NULL THEN 'block'
            WHEN bad_lower > 0.5 THEN 'block' ELSE 'allow' END AS verdict,
       bad_rate, bad_lower
FROM marked JOIN bound USING (host)
"""


def _placement(shards: int = 64, size: int = 65_537) -> str:
    """The table is a text of two characters a slot, filled by turns."""
    number = lambda text: int(hashlib.md5(text.encode()).hexdigest()[:15], 16)
    names = [f"shard-{i:05d}" for i in range(shards)]
    at = [number(f"offset:{n}") % size for n in names]
    skip = [number(f"skip:{n}") % (size - 1) + 1 for n in names]
    owner: dict[int, int] = {}
    while len(owner) < size:
        for i in range(shards):
            while at[i] in owner:
                at[i] = (at[i] + skip[i]) % size
            owner[at[i]] = i
            if len(owner) == size:
                break
    filled = "".join(f"{owner[s]:02d}" for s in range(size))
    return f"""
SELECT doc_id, slot, CAST(substr('{filled}', CAST(2 * slot + 1 AS BIGINT), 2) AS INTEGER) AS shard
FROM (SELECT doc_id, CAST(concat('0x', substr(md5(coalesce(CAST(doc_id AS VARCHAR), '')), 1, 15)) AS BIGINT) % {size} AS slot
      FROM documents)
"""


_DIVERGENCE = r"""
WITH d AS MATERIALIZED (
  SELECT row_number() OVER () AS i, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS w
  FROM documents),
uses AS MATERIALIZED (SELECT i, lang, source, unnest(w) AS term FROM d),
kept AS MATERIALIZED (SELECT lang, term FROM uses GROUP BY lang, term HAVING count(DISTINCT i) >= 30),
groups AS MATERIALIZED (SELECT DISTINCT lang, source FROM d),
c AS (SELECT lang, source, term, count(*) AS n FROM uses GROUP BY ALL),
dense AS MATERIALIZED (
  SELECT g.lang, g.source, k.term, coalesce(c.n, 0)::HUGEINT AS n
  FROM groups g JOIN kept k ON k.lang = g.lang
  LEFT JOIN c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term),
shares AS MATERIALIZED (
  SELECT lang, source, term, n,
         1 + (1000000000 * (n + 5)) // (sum(n) OVER (PARTITION BY lang, source) + 5 * count(*) OVER (PARTITION BY lang, source)) AS p
  FROM dense),
whole AS (
  SELECT lang, term, 1 + (1000000000 * (n + 5)) // (sum(n) OVER (PARTITION BY lang) + 5 * count(*) OVER (PARTITION BY lang)) AS q
  FROM (SELECT lang, term, sum(n) AS n FROM dense GROUP BY lang, term)),
apart AS (
  SELECT a.lang, a.source, b.source AS item, sum(abs(a.p - b.p)) AS value
  FROM shares a JOIN shares b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
pairs AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(x.value, 0) AS value
  FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN apart x ON x.lang = a.lang AND x.source = a.source AND x.item = b.source),
terms AS (
  SELECT lang, source, 'term' AS part, term AS item, p - q AS value
  FROM shares JOIN whole USING (lang, term) WHERE n > 0 AND p > q),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank
  FROM (SELECT * FROM pairs UNION ALL SELECT * FROM terms))
SELECT lang, source, part, item, value::BIGINT AS value, rank::INTEGER AS rank FROM ranked WHERE part = 'pair' OR rank <= 50
"""


_INTERACTIONS = r"""
WITH words AS (
  SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS t,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w
  FROM documents),
judged AS (
  SELECT part,
         list_filter(['A', 'B', 'C', 'D', 'E'], lambda f: CASE f
             WHEN 'A' THEN len(w) < 200
             WHEN 'B' THEN 2 * len(list_distinct(w)) < len(w)
             WHEN 'C' THEN 100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 3 * length(t)
             WHEN 'D' THEN regexp_matches(t, '[#$%&*|]')
             ELSE coalesce(doc_id > min(doc_id) OVER (PARTITION BY t), false) END) AS failed,
         EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id AND quality = 1) AS good,
         EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id AND toxic = 1) AS toxic
  FROM words d),
kinds AS MATERIALIZED (
  SELECT part, failed, count(*) AS n, count(*) FILTER (good) AS good, count(*) FILTER (toxic) AS toxic
  FROM judged GROUP BY ALL),
letters AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS f),
orders AS MATERIALIZED (
  SELECT a.f || b.f || c.f || d.f || e.f AS filter_order
  FROM letters a, letters b, letters c, letters d, letters e
  WHERE len(list_distinct([a.f, b.f, c.f, d.f, e.f])) = 5),
steps AS (SELECT filter_order, step::INTEGER AS step, filter_order[step] AS f, string_split(filter_order[1:step - 1], '') AS earlier
          FROM orders, range(1, 6) r(step)),
met AS (
  SELECT part, filter_order, step, f, n, good, toxic, len(failed) AS fails, list_contains(failed, f) AS now,
         len(list_intersect(failed, earlier)) > 0 AS gone
  FROM kinds, steps),
counted AS (
  SELECT part, filter_order, step, f,
         coalesce(sum(n) FILTER (NOT now AND NOT gone), 0)::BIGINT AS kept,
         coalesce(sum(n) FILTER (now AND NOT gone), 0)::BIGINT AS removed,
         coalesce(sum(n) FILTER (now AND gone), 0)::BIGINT AS redundant,
         coalesce(sum(n) FILTER (now AND fails = 1), 0)::BIGINT AS unique_fails,
         coalesce(sum(good) FILTER (now AND NOT gone), 0)::BIGINT AS good_lost,
         coalesce(sum(toxic) FILTER (now AND NOT gone), 0)::BIGINT AS toxic_lost
  FROM met GROUP BY part, filter_order, step, f)
SELECT part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
       (sum(removed) OVER (PARTITION BY part, f))::BIGINT AS shapley
FROM counted
"""


SQL: dict[str, str] = {
    "op3_minhash": _NEAR_DUPLICATES,
    "op6_neighbours": _NEIGHBOURS,
    "op9_url_filter": _URLS,
    "op10_sharding": _placement(),
    "op11_source_divergence": _DIVERGENCE,
    "op12_filter_interactions": _INTERACTIONS,
}
