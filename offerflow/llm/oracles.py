"""DuckDB SQL with the same result, for the corpus queries that SQL can express."""

from __future__ import annotations

ORACLES: dict[str, str] = {}

ORACLES["op3_mix"] = r"""
WITH sized AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size FROM documents),
sources AS (
  SELECT source, sum(size)::BIGINT AS source_size,
    [5, 2, 1][((row_number() OVER (ORDER BY source ASC NULLS LAST) - 1) % 3 + 1)::INT] AS weight,
    row_number() OVER (ORDER BY source ASC NULLS LAST) AS place
  FROM sized GROUP BY source),
turns AS (
  SELECT *, 3 * source_size AS full_size,
    coalesce(sum(3 * source_size) OVER w, 0)::BIGINT AS full_before, coalesce(sum(weight) OVER w, 0)::BIGINT AS weight_before
  FROM sources
  WINDOW w AS (ORDER BY (3 * source_size)::DOUBLE / weight::DOUBLE, place ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
level AS (
  SELECT max(((SELECT sum(source_size)::BIGINT FROM sources) - full_before)::DOUBLE
    / ((SELECT sum(weight)::BIGINT FROM sources) - weight_before)::DOUBLE) AS level FROM turns),
aimed AS (
  SELECT source, source_size, least(full_size::DOUBLE, weight::DOUBLE * level) AS target,
    CASE WHEN source_size > 0 THEN least(full_size::DOUBLE, weight::DOUBLE * level) / source_size::DOUBLE ELSE 0.0 END AS expected,
    ('0x' || substr(md5('mix' || coalesce(source, chr(10))), 1, 8))::BIGINT::DOUBLE / 4294967296.0::DOUBLE AS shift
  FROM turns, level),
placed AS (
  SELECT *, (row_number() OVER (PARTITION BY source ORDER BY size, doc_id NULLS FIRST) - 1)::DOUBLE AS before FROM sized)
SELECT p.doc_id, p.size, a.source_size, a.target,
  (least(floor((before + 1) * expected + shift) - floor(before * expected + shift), 3) * p.size)::BIGINT AS taken
FROM placed p JOIN aimed a ON p.source IS NOT DISTINCT FROM a.source
"""

# Patterns as DuckDB reads them; spans are found by splitting at a pattern and adding up lengths.
_SECRETS = (
    ("assign", r"""((?i:password|passwd|secret|token|api_?key))["'']?\x20*[:=]\x20*["'']?([A-Za-z0-9+/_.=-]+)""", 2, 6),
    ("access", r"AKIA[A-Z0-9]+", 0, 20),
    ("hex", r"[0-9a-f]{24,}", 0, 24),
    ("private_key", r"-----BEGIN [A-Z ]*PRIVATE KEY-----", 0, 1),
    ("github", r"gh[pousr]_[A-Za-z0-9]{36,}", 0, 1),
    ("slack", r"xox[abprs]-[A-Za-z0-9-]{10,}", 0, 1),
    ("google", r"AIza[0-9A-Za-z_-]{35}", 0, 1),
    ("stripe", r"[sr]k_live_[A-Za-z0-9]{16,}", 0, 1),
    ("jwt", r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}", 0, 1),
    ("url_login", r"[A-Za-z][A-Za-z0-9+.-]*://[^\x20\x09-\x0D/:@]+:[^\x20\x09-\x0D/@]+@", 0, 1),
)
_FOUND = ",\n  ".join(
    f"regexp_split_to_array(t, '{p}') AS b{i}, regexp_extract_all(t, '{p}') AS m{i}, regexp_extract_all(t, '{p}', {g}) AS g{i}"
    for i, (_, p, g, _) in enumerate(_SECRETS))
_PLACED = ",\n  ".join(
    f"""list_filter(list_transform(range(1, len(m{i}) + 1), lambda k: {{
    'a': (list_sum(list_transform(b{i}[1:k], lambda x: length(x))) + coalesce(list_sum(list_transform(m{i}[1:k - 1], lambda x: length(x))), 0))::BIGINT,
    'o': {i}, 'kind': '{kind}', 'n': length(m{i}[k]), 'g': length(g{i}[k])}}), lambda s: s.g >= {least}) AS s{i}"""
    for i, (kind, _, _, least) in enumerate(_SECRETS))
_LIST = "array_to_string(list_transform(list_sort({}), lambda s: s.kind || ':' || s.a || ':' || (s.a + s.n)), ',')"
_ALL = "list_concat(" * (len(_SECRETS) - 1) + "s0" + "".join(f", s{i})" for i in range(1, len(_SECRETS)))

ORACLES["op5_secrets"] = f"""
WITH texts AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
found AS (SELECT doc_id,
  {_FOUND}
  FROM texts),
placed AS (SELECT doc_id,
  {_PLACED}
  FROM found)
SELECT doc_id, len(s0)::BIGINT AS n_assign, len(s1)::BIGINT AS n_access, len(s2)::BIGINT AS n_hex,
  sha256({_LIST.format("list_concat(list_concat(s0, s1), s2)")}) AS base_sha256, {_LIST.format(_ALL)} AS spans
FROM placed
"""

ORACLES["op11_negatives"] = r"""
WITH rows AS (
  SELECT DISTINCT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
  SELECT a.vec_id AS anchor_id, b.vec_id AS other_id, a.label = b.label AS same, list_dot_product(a.v, b.v)::BIGINT AS score
  FROM rows a JOIN rows b ON a.vec_id % 50 = 0 AND a.vec_id <> b.vec_id),
positives AS (
  SELECT anchor_id, other_id AS positive_id, score AS positive_score FROM scored WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other_id) <= 5),
ranked AS (
  SELECT p.*, s.other_id AS negative_id, s.score AS negative_score,
    row_number() OVER (PARTITION BY p.anchor_id, p.positive_id ORDER BY s.score DESC, s.other_id)::INT AS rank
  FROM positives p JOIN scored s ON s.anchor_id = p.anchor_id AND NOT s.same
    AND 50 * positive_score <= 100 * s.score AND 100 * s.score <= 95 * positive_score)
SELECT anchor_id, positive_id, rank, negative_id, positive_score, negative_score FROM ranked WHERE rank <= 3
"""

# crc32 of a decimal number, bit by bit: the polynomial reversed is 3988292384
_CRC32 = """xor(list_reduce(list_transform(range(1, length({0}) + 1), lambda i: ascii(substr({0}, i, 1))::BIGINT),
    lambda c, b: list_reduce(range(8)::BIGINT[], lambda x, k: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END, xor(c, b)),
    4294967295::BIGINT), 4294967295)"""

ORACLES["op12_trie"] = f"""
WITH own AS (
  SELECT conv_id, list({{'role': role, 'text': text}} ORDER BY turn NULLS FIRST, sha256(length(role) || ':' || role || text)) AS turns
  FROM (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations WHERE conv_id IS NOT NULL)
  GROUP BY conv_id),
shared AS (SELECT *, {_CRC32.format("conv_id::VARCHAR")} % 6 AS h FROM own),
built AS (
  SELECT s.conv_id, list_concat(coalesce(b.turns, [])[1:h], s.turns[h + 1:]) AS turns
  FROM shared s LEFT JOIN own b ON b.conv_id = s.conv_id - s.conv_id % 100),
steps AS (
  SELECT conv_id, turns[1:d] AS path, d AS depth, d = len(turns) AS ended
  FROM (SELECT *, unnest(range(0, len(turns) + 1)) AS d FROM built)),
nodes AS (
  SELECT path, depth, min(conv_id) AS conv_id, count(*) AS n_convs,
    sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (ended), '')) AS ends_sha256
  FROM steps GROUP BY path, depth),
children AS (SELECT path[1:depth - 1] AS path, count(*) AS n FROM nodes WHERE depth > 0 GROUP BY 1),
counted AS (SELECT n.*, coalesce(c.n, 0) AS n_children FROM nodes n LEFT JOIN children c ON c.path = n.path),
subtrees AS (
  SELECT path[1:top] AS path, count(*) FILTER (n_children = 0) AS n_leaves,
    sum((n_convs - 1) * CASE WHEN depth > 0 THEN length(path[depth].text) ELSE 0 END)::BIGINT AS saved_tokens
  FROM (SELECT *, unnest(range(0, depth + 1)) AS top FROM counted) GROUP BY 1)
SELECT c.conv_id, c.depth, p.conv_id AS parent_conv_id, c.n_convs, c.n_children, s.n_leaves, s.saved_tokens, c.ends_sha256
FROM counted c JOIN subtrees s ON s.path = c.path
  LEFT JOIN counted p ON c.depth > 0 AND p.path = c.path[1:c.depth - 1]
"""
