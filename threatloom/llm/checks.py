"""SQL checks of the operators that SQL can express, written from their definitions and run over the whole tables."""

from __future__ import annotations

SQL: dict[str, str] = {}
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _words(table_name: str, key: str) -> str:
    lower = f"translate(coalesce(text, ''), '{UPPER}', '{LOWER}')"
    return rf"SELECT {key}, regexp_extract_all({lower}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM {table_name}"


SQL["op7_decontaminate"] = f"""
WITH d AS ({_words("documents", "doc_id")}),
i AS ({_words("benchmark", "CAST(item_id AS VARCHAR) AS item_id")}),
win AS (SELECT item_id, least(13, len(w)) AS n, k AS pos, array_to_string(w[k:k + least(13, len(w)) - 1], ' ') AS s
  FROM i, unnest(range(1, len(w) - least(13, len(w)) + 2)) t(k) WHERE len(w) > 0),
widths AS (SELECT DISTINCT n FROM win),
docwin AS (SELECT doc_id, k, n, array_to_string(w[k:k + n - 1], ' ') AS s FROM d, widths, unnest(range(1, len(w) - n + 2)) t(k)),
hits AS (SELECT DISTINCT doc_id, k, n, item_id, pos FROM docwin JOIN win USING (n, s)),
places AS (SELECT doc_id, count(DISTINCT k + j) AS n_hit FROM hits, unnest(range(0, n)) u(j) GROUP BY doc_id),
items AS (SELECT doc_id, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS s
  FROM (SELECT DISTINCT doc_id, item_id FROM hits) GROUP BY doc_id),
runs AS (SELECT doc_id, n, k - row_number() OVER (PARTITION BY doc_id, item_id, k - pos ORDER BY k) AS run, item_id, k - pos AS gap FROM hits),
longest AS (SELECT doc_id, max(words) AS longest_match
  FROM (SELECT doc_id, count(*) + max(n) - 1 AS words FROM runs GROUP BY doc_id, item_id, gap, run) GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(s, '')) AS items_sha256, CAST(coalesce(longest_match, 0) AS BIGINT) AS longest_match,
  coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN places USING (doc_id) LEFT JOIN items USING (doc_id) LEFT JOIN longest USING (doc_id)
""".strip()

# Components of a table ``links`` (a, b), by spreading the smallest name until nothing changes.
_REACHED = """reached AS (SELECT a AS node, a AS other FROM both_ways UNION SELECT r.node, l.b FROM reached r JOIN both_ways l ON l.a = r.other),
parts AS (SELECT node, min(other) AS component FROM reached GROUP BY node)"""

SQL["op2_embedding_dedup"] = f"""
WITH RECURSIVE v AS (SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings),
valid AS (SELECT vec_id, label, e FROM v WHERE label IS NOT NULL AND e IS NOT NULL AND len(e) > 0
  AND len(list_filter(e, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND list_dot_product(e, e) > 0),
both_ways AS (SELECT x.vec_id AS a, y.vec_id AS b FROM valid x JOIN valid y
  ON x.label = y.label AND len(x.e) = len(y.e) AND x.vec_id <> y.vec_id
  WHERE list_dot_product(x.e, y.e) >= CAST(0.98 AS DOUBLE) * sqrt(list_dot_product(x.e, x.e)) * sqrt(list_dot_product(y.e, y.e))),
{_REACHED},
counts AS (SELECT a AS node, count(*) AS n FROM both_ways GROUP BY a)
SELECT vec_id, coalesce(n, 0) AS n_links, coalesce(component, vec_id) AS component_id,
  vec_id = coalesce(component, vec_id) AS kept
FROM v LEFT JOIN counts ON counts.node = vec_id LEFT JOIN parts ON parts.node = vec_id
""".strip()

SQL["op4_url_filter"] = f"""
WITH RECURSIVE cut AS (SELECT page_id, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS r FROM pages),
parsed AS (SELECT page_id, translate(regexp_extract(r, '^[^/?#]*'), '{UPPER}', '{LOWER}') AS host,
  regexp_extract(r, '^[^/?#]*([^?#]*)', 1) AS path FROM cut),
shaped AS (SELECT *, coalesce(array_to_string(list_filter(string_split(regexp_replace(path, '[0-9]+', '#', 'g'), '/'), lambda x: x <> ''), '/'), '') AS shape
  FROM parsed),
marked AS (SELECT doc_id AS page_id, count(*) AS labels, sum(1 - quality) AS bad FROM labels
  WHERE doc_id IS NOT NULL AND quality IS NOT NULL GROUP BY doc_id),
counted AS (SELECT host, shape, count(*) AS pages, coalesce(sum(labels), 0) AS labels, coalesce(sum(bad), 0) AS bad
  FROM shaped LEFT JOIN marked USING (page_id) GROUP BY host, shape),
split AS (SELECT *, CASE WHEN shape = '' THEN [] ELSE string_split(shape, '/') END AS segments FROM counted),
nodes AS (SELECT host, shape, pages, i AS depth, segments[i] AS segment, segments[1:i - 1] AS parent
  FROM split, unnest(range(1, len(segments) + 1)) t(i)),
children AS (SELECT host, parent, segment, sum(pages) AS own FROM nodes GROUP BY ALL),
levels AS (SELECT host, parent, count(*) AS children, sum(own) AS whole FROM children GROUP BY ALL),
rare AS (SELECT host, parent, segment FROM children JOIN levels USING (host, parent)
  WHERE children > 20 AND CAST(own AS DOUBLE) < CAST(0.05 AS DOUBLE) * CAST(whole AS DOUBLE)),
general AS (SELECT n.host, n.shape, list(CASE WHEN rare.segment IS NULL THEN n.segment ELSE '?' END ORDER BY n.depth) AS parts
  FROM nodes n LEFT JOIN rare USING (host, parent, segment) GROUP BY n.host, n.shape),
total AS (SELECT coalesce(CAST(sum(bad) AS DOUBLE) / CAST(sum(labels) AS DOUBLE), 0) AS rate FROM marked),
named AS (SELECT host, shape, CAST(labels AS DOUBLE) AS labels, CAST(bad AS DOUBLE) AS bad,
  list_append(CASE WHEN len(parts) > 8 THEN list_append(parts[1:7], array_to_string(parts[8:], '/')) ELSE coalesce(parts, []) END, '') AS parts
  FROM counted LEFT JOIN general USING (host, shape)),
tree AS (
  SELECT host, shape, labels, bad, parts, '' AS template, 0 AS depth,
    (sum(bad) OVER (PARTITION BY host) + CAST(10 AS DOUBLE) * rate) / (sum(labels) OVER (PARTITION BY host) + CAST(10 AS DOUBLE)) AS purity FROM named, total
  UNION ALL
  SELECT host, shape, labels, bad, parts, template || '/' || kept, depth + 1,
    (sum(bad) OVER branch + CAST(10 AS DOUBLE) * purity) / (sum(labels) OVER branch + CAST(10 AS DOUBLE))
  FROM (
    SELECT *, CASE WHEN segment = '' THEN '' WHEN coalesce(abs(b - n * share) > CAST(1.96 AS DOUBLE) * sqrt(n * share * (1 - share)), false) THEN segment ELSE '?' END AS kept
    FROM (
      SELECT *, sum(labels) OVER child AS n, sum(bad) OVER child AS b,
        sum(bad) FILTER (segment <> '') OVER parent / nullif(sum(labels) FILTER (segment <> '') OVER parent, 0) AS share
      FROM (SELECT *, parts[depth + 1] AS segment FROM tree WHERE depth < len(parts))
      WINDOW child AS (PARTITION BY host, template, segment), parent AS (PARTITION BY host, template)))
  WINDOW branch AS (PARTITION BY host, template, kept)),
pooled AS (SELECT host, shape, template, purity FROM tree WHERE depth = len(parts)),
ruled AS (SELECT *, CASE
    WHEN (host = 'example.net' OR ends_with(host, '.example.net')) AND starts_with(path, '/en/') THEN 'example.net/en/'
    WHEN (host = 'example.com' OR ends_with(host, '.example.com')) AND starts_with(path, '/de/') THEN 'example.com/de/'
    WHEN (host = 'org' OR ends_with(host, '.org')) AND starts_with(path, '/fr/') THEN 'org/fr/'
    WHEN (host = 'net' OR ends_with(host, '.net')) AND starts_with(path, '/') THEN 'net/' END AS rule FROM shaped)
SELECT page_id, host, path, rule,
  CASE WHEN rule IN ('example.net/en/', 'org/fr/') THEN 'allow' WHEN rule IS NOT NULL OR purity > CAST(0.5 AS DOUBLE) THEN 'block' ELSE 'allow' END AS verdict,
  template, purity
FROM ruled JOIN pooled USING (host, shape)
""".strip()

SQL["op9_minhash"] = f"""
WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
s AS (SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) = 1 THEN w
  ELSE list_distinct(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) END AS shingles FROM w),
sized AS (SELECT doc_id, len(shingles) AS n, shingles FROM s),
classes AS (SELECT min(doc_id) AS first_id, n, sorted FROM (SELECT doc_id, n, list_sort(shingles) AS sorted FROM sized WHERE n > 0) GROUP BY n, sorted),
apart AS (SELECT first_id, n, unnest(sorted) AS shingle FROM classes),
links AS (SELECT x.first_id AS a, y.first_id AS b FROM apart x JOIN apart y
  ON x.shingle = y.shingle AND x.first_id < y.first_id AND 100 * least(x.n, y.n) >= 80 * greatest(x.n, y.n)
  GROUP BY x.first_id, y.first_id, x.n, y.n HAVING 100 * count(*) >= 80 * (x.n + y.n - count(*))),
both_ways AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
{_REACHED},
found AS (SELECT z.doc_id, z.n, coalesce(p.component, c.first_id, z.doc_id) AS component_id
  FROM sized z LEFT JOIN classes c ON c.n = z.n AND c.sorted = list_sort(z.shingles) LEFT JOIN parts p ON p.node = c.first_id)
SELECT doc_id, n AS n_shingles, component_id, doc_id = component_id AS kept FROM found
""".strip()

# Kind, its place in the list, pattern, and what has a least length: the second group or the whole match.
_ASSIGN = "(?i:(?:password|passwd|secret|token|api_?key))[\"'']?\\x20*[:=]\\x20*[\"'']?([A-Za-z0-9+/_.=-]+)"
_SECRETS = [
    ("assign", _ASSIGN, f"length(regexp_extract(m[i], '{_ASSIGN}', 1)) >= 8"),
    ("access", "AKIA[A-Z0-9]+", "length(m[i]) >= 16"),
    ("hex", "[0-9a-f]+", "length(m[i]) >= 32"),
    ("pem", "-----BEGIN [A-Z ]*PRIVATE KEY-----", "true"),
    ("github", "gh[pousr]_[A-Za-z0-9]+", "length(m[i]) >= 40"),
]


def _secret_spans(place: int, kind: str, pattern: str, enough: str) -> str:
    """Spans of one kind: what lies between matches, and the matches, alternate; their lengths add up to positions."""
    lengths = "[0] || list_transform({0}, lambda x: length(x))"
    return f"""SELECT doc_id, '{kind}' AS kind, {place} AS place, list_sum(between_[1:i + 1]) + list_sum(inside[1:i]) AS first, length(m[i]) AS n
FROM (SELECT doc_id, m, {lengths.format("regexp_split_to_array(text, '" + pattern + "')")} AS between_, {lengths.format("m")} AS inside
  FROM (SELECT doc_id, text, regexp_extract_all(text, '{pattern}') AS m FROM documents WHERE text IS NOT NULL)), unnest(range(1, len(m) + 1)) t(i)
WHERE {enough}"""


SQL["op10_secrets"] = f"""
WITH found AS ({" UNION ALL ".join(_secret_spans(i, *rule) for i, rule in enumerate(_SECRETS))}),
told AS (SELECT doc_id, kind, place, first, kind || ':' || CAST(first AS BIGINT) || ':' || CAST(first + n AS BIGINT) AS span FROM found),
summed AS (SELECT doc_id, count(*) FILTER (kind = 'assign') AS n_assign, count(*) FILTER (kind = 'access') AS n_access, count(*) FILTER (kind = 'hex') AS n_hex,
  string_agg(span, ',' ORDER BY first, place) FILTER (place < 3) AS base, string_agg(span, ',' ORDER BY first, place) AS spans FROM told GROUP BY doc_id)
SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
  sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM documents LEFT JOIN summed USING (doc_id)
""".strip()

# The checksum over the digits of an id, bit by bit: per byte one exclusive or, then eight shifts (marked -1).
_CRC32 = """xor(list_reduce([4294967295::BIGINT] || flatten(list_transform(string_split({0}::VARCHAR, ''),
  lambda c: [ord(c)::BIGINT, -1, -1, -1, -1, -1, -1, -1, -1])),
  lambda s, x: CASE WHEN x >= 0 THEN xor(s, x) WHEN s & 1 = 1 THEN xor(s >> 1, 3988292384) ELSE s >> 1 END), 4294967295)"""

SQL["op11_periodic_runs"] = rf"""
WITH d AS (SELECT doc_id, {_CRC32.format("doc_id")} AS h, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
g AS (SELECT *, len(w) AS n, h // 10 AS g FROM d),
a AS (SELECT *, CASE WHEN n > 0 AND h % 10 = 0 THEN g % n END AS a FROM g),
p AS (SELECT *, 1 + (n - a) // (3 + g % 8) AS p FROM a),
made AS (SELECT doc_id, n, CASE WHEN a IS NULL THEN w ELSE list_transform(range(0, n), lambda i: w[1 + CASE WHEN i < a THEN i ELSE a + (i - a) % p END]) END AS w FROM p),
words AS (SELECT doc_id, n, i, w[i + 1] AS word FROM made, unnest(range(0, n)) t(i)),
pairs AS (SELECT x.doc_id, y.i - x.i AS q, x.i FROM words x JOIN words y ON x.doc_id = y.doc_id AND x.word = y.word AND y.i > x.i AND 4 * (y.i - x.i) <= x.n),
stretches AS (SELECT doc_id, q, min(i) AS start, count(*) + q AS length
  FROM (SELECT *, i - row_number() OVER (PARTITION BY doc_id, q ORDER BY i) AS island FROM pairs) GROUP BY doc_id, q, island
  HAVING count(*) + q >= greatest(6, 4 * q)),
runs AS (SELECT * FROM stretches r WHERE NOT EXISTS (SELECT 1 FROM stretches s WHERE s.doc_id = r.doc_id AND s.q < r.q AND s.start <= r.start AND s.start + s.length >= r.start + r.length)),
summed AS (SELECT doc_id, count(*) AS n_runs, string_agg(start || ',' || length || ',' || q || chr(10), '' ORDER BY start, q) AS s FROM runs GROUP BY doc_id),
best AS (SELECT doc_id, start, length, q FROM (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY length::DOUBLE / q DESC, start, q) AS place FROM runs) WHERE place = 1),
gone AS (SELECT DISTINCT doc_id, unnest(range(start + q, start + length)) AS i FROM runs),
kept AS (SELECT doc_id, string_agg(word, ' ' ORDER BY i) AS s FROM words ANTI JOIN gone USING (doc_id, i) GROUP BY doc_id)
SELECT doc_id, coalesce(n_runs, 0) AS n_runs, start, length, q AS period, 1000 * length // q AS exponent_milli,
  sha256(coalesce(summed.s, '')) AS runs_sha256, sha256(coalesce(kept.s, '')) AS collapsed_sha256
FROM d LEFT JOIN summed USING (doc_id) LEFT JOIN best USING (doc_id) LEFT JOIN kept USING (doc_id)
""".strip()

SQL["op12_source_divergence"] = rf"""
WITH d AS (SELECT row_number() OVER () AS row_id, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
  regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS w FROM documents),
words AS (SELECT row_id, lang, source, unnest(w) AS term FROM d),
vocabulary AS (SELECT lang, term FROM words GROUP BY lang, term HAVING count(DISTINCT row_id) >= 30),
sizes AS (SELECT lang, count(*) AS v FROM vocabulary GROUP BY lang),
groups AS (SELECT DISTINCT lang, source FROM d),
counted AS (SELECT lang, source, term, count(*) AS n FROM words JOIN vocabulary USING (lang, term) GROUP BY lang, source, term),
full_counts AS (SELECT g.lang, g.source, v.term, CAST(coalesce(n, 0) AS HUGEINT) AS n
  FROM groups g JOIN vocabulary v USING (lang) LEFT JOIN counted c ON c.lang = g.lang AND c.source = g.source AND c.term = v.term),
shares AS (SELECT lang, source, term, n, 1 + (1000000000 * (n + 5)) // (sum(n) OVER (PARTITION BY lang, source) + 5 * v) AS p FROM full_counts JOIN sizes USING (lang)),
whole AS (SELECT lang, term, sum(n) AS n FROM full_counts GROUP BY lang, term),
usual AS (SELECT lang, term, 1 + (1000000000 * (n + 5)) // (sum(n) OVER (PARTITION BY lang) + 5 * v) AS q FROM whole JOIN sizes USING (lang)),
found AS (SELECT a.lang, a.source, 'pair' AS part, b.source AS item,
    coalesce((SELECT sum(abs(x.p - y.p)) FROM shares x JOIN shares y USING (lang, term) WHERE x.lang = a.lang AND x.source = a.source AND y.source = b.source), 0) AS value
  FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source
  UNION ALL SELECT lang, source, 'term', term, p - q FROM shares JOIN usual USING (lang, term) WHERE n > 0 AND p > q),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS place FROM found)
SELECT lang, source, part, item, CAST(value AS BIGINT) AS value, CAST(place AS INTEGER) AS rank FROM ranked WHERE part = 'pair' OR place <= 50
""".strip()
