"""Reference SQL for the queries that SQL can express; valid for DuckDB."""

from __future__ import annotations

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

#: All pairs that share a shingle, then everything reachable from each document.
JACCARD = f"""
WITH RECURSIVE w AS (
  SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS ws
  FROM documents),
s AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(ws) = 0 THEN [] WHEN len(ws) < 3 THEN [array_to_string(ws, ' ')]
    ELSE list_transform(range(1, len(ws) - 1), lambda i: ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2]) END) AS g FROM w),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS i FROM s a JOIN s b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY 1, 2),
e AS (SELECT x, y FROM p JOIN n nx ON nx.doc_id = x JOIN n ny ON ny.doc_id = y WHERE 100 * i >= 90 * (nx.n + ny.n - i)),
sides AS (SELECT x, y FROM e UNION SELECT y, x FROM e),
reach(doc_id, seen) AS (SELECT doc_id, doc_id FROM documents UNION SELECT reach.doc_id, sides.y FROM reach JOIN sides ON sides.x = reach.seen)
SELECT doc_id, coalesce(n.n, 0) AS n_shingles, min(seen) AS component_id FROM reach LEFT JOIN n USING (doc_id) GROUP BY doc_id, n.n"""

#: Every query against every other row.
NEAREST = """
WITH v AS (
  SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
s AS (SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.e, c.e) AS score FROM v q JOIN v c ON c.vec_id <> q.vec_id WHERE q.vec_id % 20 = 0),
r AS (SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score FROM s)
SELECT * FROM r WHERE rank <= 20"""


def _address(url: str) -> str:
    rest = f"substr({url}, instr({url}, '://') + 3)"
    host = f"translate(regexp_extract({rest}, '^[^/?#]*'), '{UPPER}', '{LOWER}')"
    path = f"regexp_replace(regexp_extract({rest}, '^[^/?#]*([^?#]*)', 1), '/+$', '')"
    kept = (
        f"list_sort(list_filter(string_split(regexp_extract({rest}, '^[^?#]*\\?([^#]*)', 1), '&'),"
        " lambda p: p <> '' AND NOT regexp_matches(p, '^(utm_[^=]*|ref|fbclid|gclid)(=|$)')))"
    )
    query = f"CASE WHEN len({kept}) > 0 THEN '?' || array_to_string({kept}, '&') ELSE '' END"
    return f"CASE WHEN instr({url}, '://') > 0 THEN {host} || {path} || {query} END"


def _target(pattern: str) -> str:
    found = f"regexp_extract(coalesce(html, ''), '{pattern}', 1, 's')"
    folder = "CASE WHEN regexp_replace(path, '[^/]*$', '') = '' THEN '/' ELSE regexp_replace(path, '[^/]*$', '') END"
    return (
        f"CASE WHEN {found} = '' THEN NULL WHEN instr({found}, '://') > 0 THEN {found} WHEN starts_with({found}, '//') THEN 'http:' || {found}"
        f" WHEN starts_with({found}, '/') THEN 'http://' || host || {found} ELSE 'http://' || host || {folder} || {found} END"
    )


# This dialect has no look-ahead, so the attribute may stand before or after the address.
_CANONICAL = r"""(?i)<link\b[^>]*\brel\s*=\s*["'']?canonical\b[^>]*\bhref\s*=\s*["'']?([^"''\s>]+)"""
_CANONICAL_LAST = r"""(?i)<link\b[^>]*\bhref\s*=\s*["'']?([^"''\s>]+)[^>]*\brel\s*=\s*["'']?canonical\b"""
_REFRESH = r"""(?i)<meta\b[^>]*\bhttp-equiv\s*=\s*["'']?refresh\b[^>]*\burl\s*=\s*["'']?([^"''\s>]+)"""

#: Rules by the contract; blocks reach whatever the alias edges join.
URLS = rf"""
WITH RECURSIVE u AS (
  SELECT page_id, url, html, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) END AS rest FROM pages),
h AS (
  SELECT page_id, url, html, coalesce(translate(regexp_extract(rest, '^[^/?#]*'), '{UPPER}', '{LOWER}'), '') AS host,
         coalesce(regexp_extract(rest, '^[^/?#]*([^?#]*)', 1), '') AS path FROM u),
f AS (
  SELECT *, CASE WHEN '.' || host LIKE '%.www.example.com' AND starts_with(path, '/en/') THEN 'www.example.com/en/'
                 WHEN '.' || host LIKE '%.example.com' AND starts_with(path, '/en/') THEN 'example.com/en/'
                 WHEN '.' || host LIKE '%.net' AND starts_with(path, '/es/') THEN 'net/es/'
                 WHEN '.' || host LIKE '%.net' AND starts_with(path, '/fr/') THEN 'net/fr/'
                 WHEN '.' || host LIKE '%.com' AND starts_with(path, '/') THEN 'com/' END AS rule,
         {_address("url")} AS address, {_target(_CANONICAL)} AS c1, {_target(_CANONICAL_LAST)} AS c2, {_target(_REFRESH)} AS c3 FROM h),
l AS (SELECT address, unnest([c1, c2, c3]) AS target FROM f),
e AS (SELECT DISTINCT address AS x, {_address("target")} AS y FROM l WHERE target IS NOT NULL AND address IS NOT NULL),
sides AS (SELECT x, y FROM e WHERE y IS NOT NULL UNION SELECT y, x FROM e WHERE y IS NOT NULL),
bad(address) AS (
  SELECT address FROM f WHERE address IS NOT NULL AND rule IN ('example.com/en/', 'net/es/', 'net/fr/')
  UNION SELECT sides.y FROM bad JOIN sides ON sides.x = bad.address)
SELECT page_id, host, path, rule,
       CASE WHEN rule IN ('com/', 'www.example.com/en/') THEN 'allow' WHEN rule IS NOT NULL THEN 'block'
            WHEN address IN (SELECT address FROM bad) THEN 'block' ELSE 'allow' END AS verdict,
       CASE WHEN rule IS NOT NULL THEN 'rule' WHEN address IN (SELECT address FROM bad) THEN 'alias' ELSE 'default' END AS via
FROM f"""


def _parts(url: str) -> tuple[str, str]:
    """Host and path of an address by the contract."""
    rest = f"CASE WHEN instr({url}, '://') > 0 THEN substr({url}, instr({url}, '://') + 3) END"
    return f"coalesce(translate(regexp_extract({rest}, '^[^/?#]*'), '{UPPER}', '{LOWER}'), '')", f"coalesce(regexp_extract({rest}, '^[^/?#]*([^?#]*)', 1), '')"


def _rule(url: str) -> str:
    host, path = _parts(url)
    return (
        f"CASE WHEN '.' || {host} LIKE '%.www.example.com' AND starts_with({path}, '/en/') THEN 'www.example.com/en/'"
        f" WHEN '.' || {host} LIKE '%.example.com' AND starts_with({path}, '/en/') THEN 'example.com/en/'"
        f" WHEN '.' || {host} LIKE '%.net' AND starts_with({path}, '/es/') THEN 'net/es/' WHEN '.' || {host} LIKE '%.net' AND starts_with({path}, '/fr/') THEN 'net/fr/'"
        f" WHEN '.' || {host} LIKE '%.com' AND starts_with({path}, '/') THEN 'com/' END"
    )


_BLOCKED = "('example.com/en/', 'net/es/', 'net/fr/')"
#: The link of a page in the table of links that the alias query derives, and the redirects beside it.
LINK = """CASE page_id % 5 WHEN 0 THEN 'http://hub' || CAST(page_id % 40 AS VARCHAR(20)) || '.org/c' WHEN 1 THEN 'http://mirror' || CAST(page_id % 30 AS VARCHAR(20)) || '.net/es/1'
  WHEN 2 THEN 'http://hub' || CAST((page_id + 3) % 40 AS VARCHAR(20)) || '.org/c/' WHEN 3 THEN 'http://lone.org/' || CAST(page_id AS VARCHAR(20)) END"""
REDIRECTS = """SELECT DISTINCT 'http://hub' || CAST(page_id % 40 AS VARCHAR(20)) || '.org/c' AS src, 'http://mirror' || CAST(page_id % 8 AS VARCHAR(20)) || '.net/fr/2' AS dst
  FROM pages WHERE page_id % 40 IN (3, 13, 27)"""

#: Every end of a link is judged, with a page or without one; blocks reach all that links join.
ALIASES = f"""
WITH RECURSIVE p AS (SELECT page_id, url, {_address("url")} AS address, {_rule("url")} AS rule, {LINK} AS target FROM pages),
given AS (SELECT src, dst FROM ({REDIRECTS}) UNION SELECT url, target FROM p WHERE target IS NOT NULL AND instr(url, '://') > 0),
e AS (SELECT DISTINCT {_address("src")} AS x, {_address("dst")} AS y, {_rule("src")} AS rx, {_rule("dst")} AS ry FROM given),
sides AS (SELECT x, y FROM e UNION SELECT y, x FROM e),
bad(address) AS (
  SELECT address FROM (SELECT address, rule FROM p UNION SELECT x, rx FROM e UNION SELECT y, ry FROM e) WHERE rule IN {_BLOCKED} AND address IS NOT NULL
  UNION SELECT sides.y FROM bad JOIN sides ON sides.x = bad.address)
SELECT page_id, {_parts("url")[0]} AS host, {_parts("url")[1]} AS path, rule,
       CASE WHEN rule IN {_BLOCKED} THEN 'block' WHEN rule IS NOT NULL THEN 'allow' WHEN address IN (SELECT address FROM bad) THEN 'block' ELSE 'allow' END AS verdict,
       CASE WHEN rule IS NOT NULL THEN 'rule' WHEN address IN (SELECT address FROM bad) THEN 'alias' ELSE 'default' END AS via
FROM p"""


def _words(text: str) -> str:
    """Runs of digits, a-z and non-ASCII characters, after A-Z are lower-cased."""
    return f"list_filter(regexp_split_to_array(translate(coalesce({text}, ''), '{UPPER}', '{LOWER}'), '[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+'), lambda x: x <> '')"


#: crc32 by its byte table, which follows from the polynomial.
_CRC_TABLE = """
bits(i, r, k) AS (
  SELECT CAST(range AS UBIGINT), CAST(range AS UBIGINT), 0 FROM range(256)
  UNION ALL SELECT i, CASE WHEN r % 2 = 1 THEN xor(r // 2, CAST(3988292384 AS UBIGINT)) ELSE r // 2 END, k + 1 FROM bits WHERE k < 8),
crc_table AS (SELECT list(r ORDER BY i) AS t FROM bits WHERE k = 8)"""


def _crc(text: str) -> str:
    """crc32 of a text's UTF-8 bytes, with ``t`` the byte table."""
    codes = f"list_transform(range(0, strlen({text})), lambda i: CAST('0x' || substr(hex({text}), 2 * i + 1, 2) AS UBIGINT))"
    fold = f"list_reduce(list_prepend(CAST(4294967295 AS UBIGINT), {codes}), lambda c, b: xor(c // 256, t[CAST(xor(c % 256, b) AS BIGINT) + 1]))"
    return f"xor({fold}, CAST(4294967295 AS UBIGINT))"


#: Features counted by text, each distinct one sent to its bucket once.
RESAMPLING = f"""
WITH RECURSIVE {_CRC_TABLE},
w AS (
  SELECT 0 AS side, doc_id AS id, row_number() OVER () AS k, {_words("text")} AS ws FROM documents
  UNION ALL SELECT 1, NULL, -row_number() OVER (), {_words("text")} FROM benchmark),
f AS (
  SELECT side, k, unnest(ws) AS g FROM w
  UNION ALL SELECT side, k, unnest(list_transform(range(1, len(ws)), lambda i: ws[i] || ' ' || ws[i + 1])) FROM w),
c AS (SELECT side, k, g, count(*) AS n FROM f GROUP BY ALL),
b AS (SELECT g, {_crc("g")} % 10000 AS bucket FROM (SELECT DISTINCT g FROM c), crc_table),
h AS (SELECT side, bucket, CAST(sum(n) AS DOUBLE) AS n FROM c JOIN b USING (g) GROUP BY ALL),
total AS (SELECT coalesce(sum(n) FILTER (side = 0), 0) AS s, coalesce(sum(n) FILTER (side = 1), 0) AS t FROM h),
gains AS (
  SELECT bucket, CAST(floor(1000 * ln((coalesce(sum(n) FILTER (side = 1), 0) + 1) * (s + 10000) / ((coalesce(sum(n) FILTER (side = 0), 0) + 1) * (t + 10000)))) AS BIGINT) AS gain
  FROM h, total GROUP BY bucket, s, t),
d AS (SELECT k, CAST(sum(n) AS BIGINT) AS n_features, CAST(sum(n * gain) AS DOUBLE) AS total FROM c JOIN b USING (g) JOIN gains USING (bucket) WHERE side = 0 GROUP BY k),
r AS (
  SELECT w.id AS doc_id, len(ws) AS n_words, coalesce(n_features, 0) AS n_features, coalesce(CAST(floor(total / n_features) AS BIGINT), 0) AS weight,
         CAST(('0x' || substr(sha256('7:' || coalesce(CAST(w.id AS VARCHAR), '')), 1, 8)) AS UBIGINT) AS h
  FROM w LEFT JOIN d USING (k) WHERE side = 0),
scored AS (SELECT doc_id, n_words, n_features, weight, weight + CAST(floor(-1000 * ln(-ln((h + 0.5::DOUBLE) / 4294967296::DOUBLE))) AS BIGINT) AS score FROM r),
placed AS (
  SELECT *, CASE WHEN n_words >= 20 THEN row_number() OVER (PARTITION BY n_words >= 20 ORDER BY score DESC, doc_id NULLS LAST, n_features) END AS place,
         25 * count(*) FILTER (n_words >= 20) OVER () // 100 AS drawn FROM scored)
SELECT doc_id, n_features, weight, score, CASE WHEN place <= drawn THEN place END AS rank FROM placed"""

#: Every window of every document against every window of the items.
CONTAMINATION = f"""
WITH d AS (SELECT row_number() OVER () AS k, doc_id, {_words("text")} AS ws FROM documents),
i AS (SELECT coalesce(CAST(item_id AS VARCHAR), '') AS item, {_words("text")} AS ws FROM benchmark),
iw AS (
  SELECT DISTINCT item, least(10, len(ws)) AS width, array_to_string(ws[p : p + least(10, len(ws)) - 1], ' ') AS win
  FROM (SELECT *, unnest(range(1, len(ws) - least(10, len(ws)) + 2)) AS p FROM i WHERE len(ws) > 0)),
dw AS (
  SELECT k, p, width, array_to_string(ws[p : p + width - 1], ' ') AS win
  FROM (SELECT *, unnest(range(1, len(ws) - width + 2)) AS p FROM d, (SELECT DISTINCT width FROM iw))),
hit AS (SELECT DISTINCT k, p, width, item FROM dw JOIN iw USING (width, win)),
words AS (SELECT k, count(*) AS n_hit FROM (SELECT DISTINCT k, unnest(range(p, p + width)) AS at FROM hit) GROUP BY k),
items AS (SELECT k, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS ids FROM (SELECT DISTINCT k, item FROM hit) GROUP BY k)
SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN words USING (k) LEFT JOIN items USING (k)"""


def _field(value: str) -> str:
    return f"coalesce(strlen({value}) || ':' || {value}, '-')"


def _leaf(text: str) -> str:
    return "sha256(" + " || ".join(_field(v) for v in ("CAST(doc_id AS VARCHAR)", "source", "lang", "CAST(n_chars AS VARCHAR)", text)) + ")"


#: Levels as lists of digests, one list per tree and level; the last tree's leaves are the other trees' roots.
MANIFEST = f"""
WITH RECURSIVE {_CRC_TABLE},
d AS (
  SELECT row_number() OVER () AS k, doc_id, lang, {_leaf("text")} AS leaf,
         CASE WHEN text IS NOT NULL AND {_crc("CAST(doc_id AS VARCHAR)")} % 3 = 0 THEN {_leaf(f"translate(text, '{UPPER}', '{LOWER}')")} END AS other
  FROM documents, crc_table),
p AS (
  SELECT *, dense_rank() OVER (ORDER BY lang NULLS FIRST) - 1 AS tree,
         row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos FROM d),
l(tree, level, nodes) AS (
  SELECT tree, 0, list(leaf ORDER BY pos) FROM p GROUP BY tree
  UNION ALL SELECT tree, level + 1, list_transform(range(0, (len(nodes) + 7) // 8), lambda i: sha256(array_to_string(nodes[8 * i + 1 : 8 * i + 8], ''))) FROM l WHERE len(nodes) > 1),
subroots AS (SELECT tree, nodes[1] AS subroot, level AS height FROM l WHERE len(nodes) = 1),
u(level, nodes) AS (
  SELECT 0, list(subroot ORDER BY tree) FROM subroots HAVING count(*) > 0
  UNION ALL SELECT level + 1, list_transform(range(0, (len(nodes) + 7) // 8), lambda i: sha256(array_to_string(nodes[8 * i + 1 : 8 * i + 8], ''))) FROM u WHERE len(nodes) > 1),
f(k, tree, height, level, pos, node, proof) AS (
  SELECT k, tree, height, 0, pos, coalesce(other, leaf), '' FROM p JOIN subroots USING (tree)
  UNION ALL
  SELECT k, f.tree, height, f.level + 1, CASE WHEN f.level + 1 = height THEN f.tree ELSE pos // 8 END,
         sha256(array_to_string(run[: pos % 8] || [node] || run[pos % 8 + 2 :], '')), proof || array_to_string(run[: pos % 8] || run[pos % 8 + 2 :], '')
  FROM (
    SELECT f.*, coalesce(l.nodes, u.nodes)[f.pos // 8 * 8 + 1 : f.pos // 8 * 8 + 8] AS run
    FROM (SELECT k, tree, height, level, CASE WHEN level = height THEN tree ELSE pos END AS pos, node, proof FROM f) f
    LEFT JOIN l ON l.tree = f.tree AND l.level = f.level AND f.level < height LEFT JOIN u ON u.level = f.level - height AND f.level >= height
    WHERE coalesce(len(l.nodes), len(u.nodes)) > 1) f)
SELECT doc_id, leaf, subroot, root, sha256(proof) AS proof_sha256, node AS folded_root, node = root AS verified
FROM p JOIN subroots USING (tree) JOIN (SELECT k, arg_max(node, level) AS node, arg_max(proof, level) AS proof FROM f GROUP BY k) USING (k),
     (SELECT nodes[1] AS root FROM u WHERE len(nodes) = 1)"""
