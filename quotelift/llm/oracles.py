"""DuckDB SQL for the operators that SQL can express."""

from __future__ import annotations

from quotelift.llm.fair_mix import SHARE, WEIGHTS
from quotelift.llm.queries import LISTED_HOSTS
from quotelift.llm.shard_table import SHARDS, SLOTS
from quotelift.llm.url_filter import RULES

#: The shards' turns one by one; a slot list grows until every slot has an owner.
OP5 = f"""
WITH RECURSIVE shards AS (
  SELECT s, ('0x' || substr(md5(s || ':offset'), 1, 8))::BIGINT % {SLOTS} AS place,
         ('0x' || substr(md5(s || ':skip'), 1, 8))::BIGINT % {SLOTS - 1} + 1 AS skip
  FROM range({SHARDS}) r(s)
),
turns AS (
  SELECT 0 AS turn, list_transform(range({SLOTS}), lambda i: -1) AS owners
  UNION ALL
  SELECT turn + 1,
         list_concat(list_concat(owners[:free], [s::INTEGER]), owners[free + 2:])
  FROM (
    SELECT turn, owners, s,
           list_filter(list_transform(range({SLOTS}), lambda j: (place + j * skip) % {SLOTS}),
                       lambda p: owners[p + 1] = -1)[1] AS free
    FROM turns JOIN shards ON s = turn % {SHARDS}
    WHERE turn < {SLOTS}
  )
),
owners AS (SELECT owners FROM turns WHERE turn = {SLOTS})
SELECT doc_id, slot::INTEGER AS slot, owners[slot + 1]::INTEGER AS shard
FROM (
  SELECT doc_id,
         ('0x' || substr(md5(coalesce(doc_id::VARCHAR, '')), 1, 15))::BIGINT % {SLOTS} AS slot
  FROM documents
), owners
"""

#: Sources are capped in the order of their cap per weight; the level is where that stops.
OP6 = f"""
WITH sizes AS (
  SELECT doc_id, source, md5('mix:' || coalesce(doc_id::VARCHAR, '')) AS key,
         coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size
  FROM documents
),
sources AS (
  SELECT source, sum(size)::BIGINT AS s,
         [{", ".join(map(str, WEIGHTS))}][(row_number() OVER (ORDER BY source NULLS LAST) - 1) % {len(WEIGHTS)} + 1] AS w
  FROM sizes GROUP BY source
),
steps AS (
  SELECT coalesce(sum(2 * s) OVER before, 0) AS full_, sum(w) OVER () - coalesce(sum(w) OVER before, 0) AS rest,
         2 * s / w::DOUBLE AS cap, (SELECT sum(s) FROM sources) * {SHARE} AS budget
  FROM sources
  WINDOW before AS (ORDER BY 2 * s / w::DOUBLE, source ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
),
level AS (SELECT (budget - full_) / rest AS l FROM steps WHERE (budget - full_) / rest <= cap ORDER BY cap LIMIT 1),
goals AS (SELECT source, s, least(w * l, 2.0::DOUBLE * s) AS target FROM sources, level),
placed AS (
  SELECT doc_id, size, g.s AS source_size, target,
         sum(size) OVER (PARTITION BY d.source ORDER BY key, doc_id, size ROWS UNBOUNDED PRECEDING) - size AS start
  FROM sizes d JOIN goals g ON d.source IS NOT DISTINCT FROM g.source
)
SELECT doc_id, size, source_size, target::DOUBLE AS target,
       (greatest(0, least(size, round(target)::BIGINT - start))
        + greatest(0, least(size, round(target)::BIGINT - start - source_size)))::BIGINT AS taken
FROM placed
"""

_HOST = "regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1)"
_LOWER = f"translate(coalesce({_HOST}, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_PATH = "coalesce(regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1), '')"
_QUERY = """regexp_replace(regexp_replace(
  coalesce(regexp_extract(url, '(?s)^.*?://[^?#]*\\?([^#]*)', 1), ''),
  '(^|&)(utm_[^=&]*|ref)=[^&]*', '', 'g'), '^&', '')"""
_FITS = " ".join(
    f"WHEN (host = '{r.host}' OR ends_with(host, '.{r.host}')) AND starts_with(path, '{r.path}') THEN '{r.text}'"
    for r in sorted(RULES, key=lambda r: (len(r.text), r.text), reverse=True)
)
_VERDICTS = " ".join(f"WHEN '{r.text}' THEN '{r.verdict}'" for r in RULES)
OP10 = f"""
WITH parts AS (
  SELECT page_id, {_LOWER} AS host, {_PATH} AS path, {_QUERY} AS query FROM pages
),
named AS (
  SELECT page_id, host, path,
         host || regexp_replace(path, '/+$', '') || CASE WHEN query = '' THEN '' ELSE '?' || query END AS canon,
         CASE {_FITS} END AS rule
  FROM parts
),
judged AS (
  SELECT *, canon <> '' AND canon IN (SELECT canon FROM named WHERE regexp_matches(host, '{LISTED_HOSTS}')) AS listed
  FROM named
)
SELECT page_id, host, path, rule, listed,
       coalesce(CASE rule {_VERDICTS} END, CASE WHEN listed THEN 'block' ELSE 'allow' END) AS verdict
FROM judged
"""

_AZ = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'"
_WORDS = f"regexp_extract_all(translate(coalesce(text, ''), {_AZ}), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"

#: Every window of every text as one string of words.
OP13 = f"""
WITH items AS (
  SELECT item, w, least(10, len(w)) AS n
  FROM (SELECT coalesce(item_id::VARCHAR, '') AS item, {_WORDS} AS w FROM benchmark) WHERE len(w) > 0
),
grams AS (
  SELECT DISTINCT item, n, array_to_string(w[i:i + n - 1], ' ') AS gram
  FROM (SELECT item, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM items)
),
docs AS (SELECT row_number() OVER () AS r, doc_id, {_WORDS} AS w FROM documents),
spans AS (
  SELECT r, i, n, array_to_string(w[i:i + n - 1], ' ') AS gram
  FROM (SELECT r, w, n, unnest(range(1, len(w) - n + 2)) AS i
        FROM docs, (SELECT DISTINCT n FROM grams) WHERE len(w) >= n)
),
found AS (SELECT r, i, g.n, item FROM spans s JOIN grams g ON s.n = g.n AND s.gram = g.gram),
hit AS (SELECT r, count(DISTINCT p) AS n_hit FROM (SELECT r, unnest(range(i, i + n)) AS p FROM found) GROUP BY r),
named AS (
  SELECT r, count(*) AS n_items, sha256(string_agg(item, ',' ORDER BY item)) AS items_sha256
  FROM (SELECT DISTINCT r, item FROM found) GROUP BY r
)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit,
       coalesce(n_items, 0)::BIGINT AS n_items, coalesce(items_sha256, sha256('')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AS contaminated
FROM docs LEFT JOIN hit USING (r) LEFT JOIN named USING (r)
"""

#: crc32 of a short text; ``crc`` holds the table with an entry for each byte value.
_CRC_TABLE = """SELECT list_transform(range(256), lambda n: list_reduce(list_concat([n], range(8)),
  lambda c, k: xor(c >> 1, CASE WHEN c & 1 = 1 THEN 3988292384 ELSE 0 END))) AS entries"""
_CRC = """xor(list_reduce(list_concat([4294967295], list_transform(string_split(conv_id::VARCHAR, ''), lambda x: ascii(x)::BIGINT)),
  lambda c, b: xor(c >> 8, entries[(xor(c, b) & 255) + 1])), 4294967295)"""

#: A path is the list of digests to it. A node's totals are sums over the conversations through it:
#: whether one owns a leaf at its end, and the tokens saved at the nodes it owns (as smallest member).
OP11 = f"""
WITH crc AS ({_CRC_TABLE}),
turns AS (
  SELECT conv_id, sha256(length(role) || ':' || role || text) AS digest,
         len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')) AS words,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, sha256(length(role) || ':' || role || text)) AS pos
  FROM (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations WHERE conv_id IS NOT NULL)
),
convs AS (SELECT conv_id, conv_id - conv_id % 20 AS first, {_CRC} % 4 AS h FROM (SELECT DISTINCT conv_id FROM turns), crc),
rows_ AS (
  SELECT c.conv_id, 0 AS part, 0 AS pos, '' AS digest, 0 AS words FROM convs c
  UNION ALL SELECT c.conv_id, 1, t.pos, t.digest, t.words FROM convs c JOIN turns t ON t.conv_id = c.first AND t.pos <= c.h
  UNION ALL SELECT c.conv_id, 2, t.pos, t.digest, t.words FROM convs c JOIN turns t ON t.conv_id = c.conv_id AND t.pos > c.h
),
placed AS (
  SELECT conv_id AS c, words, row_number() OVER o - 1 AS d,
         string_agg(digest, ',') OVER (PARTITION BY conv_id ORDER BY part, pos ROWS UNBOUNDED PRECEDING) AS path,
         count(*) OVER (PARTITION BY conv_id) - 1 AS len
  FROM rows_ WINDOW o AS (PARTITION BY conv_id ORDER BY part, pos)
),
steps AS (SELECT *, lag(path) OVER (PARTITION BY c ORDER BY d) AS above FROM placed),
nodes AS (
  SELECT path, any_value(d) AS d, any_value(above) AS above, min(c) AS owner, count(*) AS n, any_value(words) AS words,
         max(len) > any_value(d) AS has_children,
         sha256(coalesce(string_agg(c::VARCHAR, ',' ORDER BY c) FILTER (len = d), '')) AS ends
  FROM steps GROUP BY path
),
gains AS (
  SELECT s.path,
         sum(CASE WHEN n.owner = s.c THEN (n.n - 1) * n.words ELSE 0 END) OVER (PARTITION BY s.c ORDER BY s.d DESC) AS saved,
         max(CASE WHEN n.owner = s.c AND NOT n.has_children THEN 1 ELSE 0 END) OVER (PARTITION BY s.c) AS leaf
  FROM steps s JOIN nodes n ON n.path = s.path
),
totals AS (SELECT path, sum(leaf)::BIGINT AS leaves, sum(saved)::BIGINT AS saved FROM gains GROUP BY path),
children AS (SELECT above AS path, count(*) AS n FROM nodes WHERE above IS NOT NULL GROUP BY above)
SELECT n.owner AS conv_id, n.d::BIGINT AS depth, p.owner AS parent_conv_id, n.n::BIGINT AS n_convs,
       coalesce(k.n, 0)::BIGINT AS n_children, t.leaves AS n_leaves, t.saved AS saved_tokens, n.ends AS ends_sha256
FROM nodes n JOIN totals t ON t.path = n.path LEFT JOIN nodes p ON p.path = n.above LEFT JOIN children k ON k.path = n.path
"""

_TERMS = f"regexp_extract_all(translate(coalesce(text, ''), {_AZ}), '[^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+')"

OP12 = f"""
WITH docs AS (
  SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source, {_TERMS} AS w FROM documents
),
words AS (SELECT r, lang, source, unnest(w) AS term FROM docs),
kept AS (SELECT lang, term FROM words GROUP BY ALL HAVING count(DISTINCT r) >= 30),
vocab AS (SELECT lang, count(*)::HUGEINT AS v FROM kept GROUP BY lang),
groups AS (SELECT DISTINCT lang, source FROM docs),
counts AS (SELECT lang, source, term, count(*)::HUGEINT AS n FROM words JOIN kept USING (lang, term) GROUP BY ALL),
cells AS (
  SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n
  FROM groups g JOIN kept k ON k.lang = g.lang
  LEFT JOIN counts c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term
),
shares AS (
  SELECT lang, source, term, n,
         1 + (1000000000 * (n + 5)) // (sum(n) OVER (PARTITION BY lang, source) + 5 * v) AS p,
         1 + (1000000000 * (sum(n) OVER (PARTITION BY lang, term) + 5)) // (sum(n) OVER (PARTITION BY lang) + 5 * v) AS q
  FROM cells JOIN vocab USING (lang)
),
apart AS (
  SELECT a.lang, a.source, b.source AS item, sum(abs(a.p - b.p)) AS value
  FROM shares a JOIN shares b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL
),
pairs AS (
  SELECT a.lang, a.source, b.source AS item, coalesce(value, 0) AS value
  FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN apart d ON d.lang = a.lang AND d.source = a.source AND d.item = b.source
),
parts AS (
  SELECT lang, source, 'pair' AS part, item, value FROM pairs
  UNION ALL SELECT lang, source, 'term', term, p - q FROM shares WHERE n > 0 AND p > q
),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, encode(item)) AS place FROM parts
)
SELECT lang, source, part, item, value::BIGINT AS value, place::INTEGER AS rank
FROM ranked WHERE part = 'pair' OR place <= 50
"""

ORACLES = {"op5_shard_table": OP5, "op6_fair_mix": OP6, "op10_url_filter": OP10, "op11_prefix_trie": OP11, "op12_divergence": OP12, "op13_winnow": OP13}
