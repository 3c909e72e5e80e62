"""DuckDB SQL for the training-data queries that SQL can express."""

from __future__ import annotations

from parcelscope.llm.url_rules import GENERAL

_WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"

_MIXING = rf"""
WITH sized AS (
  SELECT doc_id, source, len({_WORDS}) AS size,
         md5(concat_ws('|', 'mix-1', coalesce(doc_id::VARCHAR, ''), md5(coalesce(text, '')))) AS key
  FROM documents),
per AS (
  SELECT source, sum(size)::BIGINT AS source_size, 2 * sum(size)::BIGINT AS most,
         [5, 2, 1][(row_number() OVER (ORDER BY encode(source) NULLS LAST) - 1)::BIGINT % 3 + 1]::DOUBLE AS weight
  FROM sized GROUP BY source),
levels AS (
  SELECT *, ((SELECT sum(source_size)::DOUBLE * 150 / 100 FROM per)
             - coalesce(sum(most) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::DOUBLE)
            / sum(weight) OVER (o ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level,
         row_number() OVER o AS nth
  FROM per WINDOW o AS (ORDER BY most::DOUBLE / weight, encode(source) NULLS LAST)),
goals AS (
  SELECT source, source_size,
         least((SELECT arg_min(level, nth) FROM levels WHERE level * weight <= most) * weight, most::DOUBLE) AS target
  FROM levels),
streams AS (
  SELECT s.*, g.source_size, g.target,
         CASE WHEN g.source_size > 0 THEN floor(g.target / g.source_size)::BIGINT ELSE 0 END AS epochs,
         sum(size) OVER (PARTITION BY s.source ORDER BY key, doc_id) - size AS before
  FROM sized s JOIN goals g ON s.source IS NOT DISTINCT FROM g.source)
SELECT doc_id, source, size::BIGINT AS size, source_size, target,
       (epochs * size + greatest(0, least(size, floor(target - epochs * source_size)::BIGINT - before)))::BIGINT AS taken
FROM streams
"""

_GENERAL = ", ".join(f"({n}, '{rule.action}', '{rule.text}')" for n, rule in enumerate(GENERAL))

_URL_RULES = rf"""
WITH parts AS (
  SELECT page_id, url,
         translate(regexp_extract(coalesce(url, ''), '^.*?://([^/?#]*)', 1, 's'),
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(coalesce(url, ''), '^.*?://[^/?#]*([^?#]*)', 1, 's') AS path
  FROM pages),
rules(host_rule, path_rule, action) AS (
  VALUES ('net', '/', 'block'), ('example.net', '/en/', 'allow'), ('example.com', '/de/', 'block'), ('org', '/fr/', 'allow')),
fits AS (
  SELECT host, path, arg_max(host_rule || path_rule, len(host_rule || path_rule)) AS rule,
         arg_max(action, len(host_rule || path_rule)) AS action
  FROM (SELECT DISTINCT host, path FROM parts) JOIN rules
    ON (host = host_rule OR ends_with(host, '.' || host_rule)) AND starts_with(path, path_rule)
  GROUP BY host, path),
general(number, action, pattern) AS (VALUES {_GENERAL}),
written AS (
  SELECT number, action, length(pattern) AS size,
         replace(replace(replace(pattern, '.', '\.'), '*', '.*'), '^', '(^|$|[./]|[^A-Za-z0-9_%.-])') AS regex
  FROM general),
own AS (
  SELECT host, path, arg_min(action, [-size, number]) AS action
  FROM (SELECT DISTINCT host, path FROM parts) JOIN written ON regexp_matches(host || path, regex, 's')
  GROUP BY host, path)
SELECT page_id, p.host, p.path, rule, coalesce(f.action, o.action, 'allow') AS verdict
FROM parts p
LEFT JOIN fits f ON p.host = f.host AND p.path = f.path
LEFT JOIN own o ON p.host = o.host AND p.path = o.path
"""

_CHAT = r"""
WITH rows AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL VALUES (-7, 0, 'user', '\### Assistant: </turn> ok'), (-7, 1, 'assistant', '\### Assistant: </turn> ok'))
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
       coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
       sum(length('### ' || role || ': ' || regexp_replace(text, '(\\*)(###|</turn>)', '\\\1\2', 'g')) + 9)::BIGINT
         AS formatted_chars
FROM rows GROUP BY conv_id
"""



_TAIL = (75, 90, 95, 98, 99)


def _reach(distances: str) -> str:
    """Twice the distance of the outermost quantile in reach of those before it, and the floor."""
    return f"list_reduce({distances}[2:], lambda r, d: CASE WHEN d <= r THEN 2 * d + floor ELSE r END, 2 * {distances}[1] + floor)"


def _at(percent: int) -> str:
    return f"min(bucket) FILTER (upto * 100 >= total * {percent})"


_QUALITY = rf"""
WITH docs AS (
  SELECT row_number() OVER () AS r, doc_id, lang, source, coalesce(text, '') AS t, {_WORDS} AS w FROM documents),
lines AS (
  SELECT r, count(*) AS n_lines, count(*) - count(DISTINCT line) AS n_dup_lines
  FROM (SELECT r, unnest(string_split(t, chr(10))) AS line FROM docs)
  WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY r),
windows AS (
  SELECT r, i, array_to_string(w[i:i + 7], ' ') AS k
  FROM (SELECT r, w, unnest(range(1, len(w) - 6)) AS i FROM docs WHERE len(w) >= 8)),
often AS (SELECT r, i FROM windows QUALIFY count(*) OVER (PARTITION BY r, k) > 1),
covered AS (
  SELECT r, sum(least(8, coalesce(following - i, 8))) AS n
  FROM (SELECT r, i, lead(i) OVER (PARTITION BY r ORDER BY i) AS following FROM often) GROUP BY r),
base AS (
  SELECT d.r, doc_id, lang, source, len(w)::BIGINT AS n_words, length(array_to_string(w, ''))::BIGINT AS word_chars,
         length(regexp_replace(t, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols, n_lines,
         coalesce(n_dup_lines, 0)::BIGINT AS n_dup_lines, coalesce(c.n, 0)::BIGINT AS n_repeat_words,
         len(w) < 20 OR 100 * coalesce(c.n, 0) > 30 * len(w) AS base_failed
  FROM docs d LEFT JOIN lines l ON d.r = l.r LEFT JOIN covered c ON d.r = c.r),
measured AS (
  SELECT r, lang, source, unnest([
    {{'m': 'symbols', 'v': n_symbols * 1000 // n_words, 'floor': 30, 'low': false}},
    {{'m': 'dup_lines', 'v': n_dup_lines * 1000 // n_lines, 'floor': 150, 'low': false}},
    {{'m': 'repeats', 'v': n_repeat_words * 1000 // n_words, 'floor': 120, 'low': false}},
    {{'m': 'word_length', 'v': word_chars * 100 // n_words, 'floor': 60, 'low': true}}]) AS x
  FROM base WHERE NOT base_failed),
tall AS (
  SELECT r, lang, source, x.m AS measure, x.v AS v, x.floor AS floor, x.low AS low,
         (x.v >> greatest(length(bin(x.v)) - 6, 0)::BIGINT) << greatest(length(bin(x.v)) - 6, 0)::BIGINT AS bucket
  FROM measured),
c AS (SELECT measure, floor, bucket, count(*)::HUGEINT AS c FROM tall GROUP BY ALL),
l AS (SELECT lang, measure, bucket, count(*)::HUGEINT AS l FROM tall GROUP BY ALL),
g AS (SELECT lang, source, measure, bucket, count(*)::HUGEINT AS g FROM tall GROUP BY ALL),
weighed AS (
  SELECT k.lang, k.source, k.measure, floor, c.bucket,
         coalesce(g, 0) * (l_all + 100) * c_all + 100 * (coalesce(l, 0) * c_all + 100 * c) AS weight
  FROM (SELECT DISTINCT lang, source, measure FROM g) k
  JOIN c ON c.measure = k.measure
  JOIN (SELECT measure, sum(c)::HUGEINT AS c_all FROM c GROUP BY ALL) ca ON ca.measure = k.measure
  JOIN (SELECT lang, measure, sum(l)::HUGEINT AS l_all FROM l GROUP BY ALL) la
    ON la.measure = k.measure AND la.lang IS NOT DISTINCT FROM k.lang
  LEFT JOIN l ON l.measure = k.measure AND l.lang IS NOT DISTINCT FROM k.lang AND l.bucket = c.bucket
  LEFT JOIN g ON g.measure = k.measure AND g.lang IS NOT DISTINCT FROM k.lang AND g.source IS NOT DISTINCT FROM k.source
             AND g.bucket = c.bucket),
tails AS (
  SELECT lang, source, measure, floor, {_at(50)} AS mid, [{', '.join(_at(p) for p in _TAIL)}] AS upper,
         [{', '.join(_at(100 - p) for p in _TAIL)}] AS lower
  FROM (SELECT *, sum(weight) OVER (PARTITION BY lang, source, measure ORDER BY bucket) AS upto,
               sum(weight) OVER (PARTITION BY lang, source, measure) AS total FROM weighed)
  GROUP BY ALL),
away AS (
  SELECT *, list_transform(upper, lambda q: q - mid) AS above, list_transform(lower, lambda q: mid - q) AS below FROM tails),
fences AS (SELECT lang, source, measure, mid + {_reach('above')} AS high, mid - {_reach('below')} AS lowest FROM away),
inside AS (
  SELECT r, bool_and(t.bucket <= high AND (NOT low OR t.bucket >= lowest)) AS kept
  FROM tall t JOIN fences f
    ON t.lang IS NOT DISTINCT FROM f.lang AND t.source IS NOT DISTINCT FROM f.source AND t.measure = f.measure
  GROUP BY r)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, coalesce(kept, false) AS kept
FROM base b LEFT JOIN inside i ON b.r = i.r
"""

_NEGATIVES = """
WITH coded AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS code
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
  SELECT a.vec_id AS anchor_id, c.vec_id AS other, a.label = c.label AS same,
         list_inner_product(a.code, c.code)::BIGINT AS score
  FROM coded a JOIN coded c ON a.vec_id <> c.vec_id WHERE a.vec_id % 50 = 0),
positives AS (
  SELECT anchor_id, other AS positive_id, score AS positive_score FROM scored WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other) <= 5)
SELECT anchor_id, positive_id,
       row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, other)::INTEGER AS rank,
       other AS negative_id, positive_score, score AS negative_score
FROM positives JOIN scored USING (anchor_id)
WHERE NOT same AND 50 * positive_score <= 100 * score AND 100 * score <= 95 * positive_score
QUALIFY rank <= 3
"""


def _field(column: str, text: str | None = None) -> str:
    value = text or f"{column}::VARCHAR"
    return f"CASE WHEN {column} IS NULL THEN '-' ELSE octet_length(encode({value}))::VARCHAR || ':' || {value} END"


def _leaf(text: str | None = None) -> str:
    parts = [_field(c) for c in ("doc_id", "source", "lang", "n_chars")] + [_field("text", text)]
    return f"sha256({' || '.join(parts)})"


def _climb(name: str, foot: str, levels: int) -> str:
    """Tables ``<name>0`` .. of (tree, pos, n, digest), sixteen nodes to one, from the ``foot`` up; a tree of
    one node keeps it."""
    tables = [f"{name}0 AS ({foot})"]
    for k in range(1, levels + 1):
        tables.append(
            f"""{name}{k} AS (
  SELECT tree, pos // 16 AS pos, any_value((n + 15) // 16) AS n,
         CASE WHEN any_value(n) = 1 THEN any_value(digest) ELSE sha256(string_agg(digest, '' ORDER BY pos)) END AS digest
  FROM {name}{k - 1} GROUP BY tree, pos // 16)"""
        )
    return ",\n".join(tables)


def _steps(name: str, levels: int) -> str:
    """Siblings left and right of every node of ``<name>k``, as ``<name>step<k>``."""
    return ",\n".join(
        f"""{name}step{k} AS (
  SELECT a.tree, a.pos, any_value(a.n) > 1 AS real,
         coalesce(string_agg(b.digest, '' ORDER BY b.pos) FILTER (WHERE b.pos < a.pos), '') AS l,
         coalesce(string_agg(b.digest, '' ORDER BY b.pos) FILTER (WHERE b.pos > a.pos), '') AS r
  FROM {name}{k} a JOIN {name}{k} b ON a.tree = b.tree AND a.pos // 16 = b.pos // 16 GROUP BY a.tree, a.pos)"""
        for k in range(levels)
    )


def _merkle(levels: int = 6, tops: int = 4) -> str:
    """Manifest and proofs of groups of up to 16 ** levels documents and up to 16 ** tops groups."""
    shifted = "list_reduce(range(8), lambda c, i: xor(c >> 1, 3988292384 * (c & 1)), xor(crc, x))"
    letters = "list_transform(string_split(doc_id::VARCHAR, ''), lambda x: ord(x)::BIGINT)"
    crc = f"list_reduce({letters}, lambda crc, x: {shifted}, 4294967295::BIGINT)"
    lowered = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    path = [("t", "tree", "pos", k) for k in range(levels)] + [("g", "0", "tree", k) for k in range(tops)]
    joins = "\n".join(
        f"JOIN {name}step{k} {name}_{k} ON {name}_{k}.tree = d.{tree} AND {name}_{k}.pos = d.{at} // {16**k}"
        if tree != "0"
        else f"JOIN {name}step{k} {name}_{k} ON {name}_{k}.pos = d.{at} // {16**k}"
        for name, tree, at, k in path
    )
    proof, folds = "", []
    for n, (name, _, _, k) in enumerate(path):
        step = f"{name}_{k}"
        proof += f"{' || ' if proof else ''}CASE WHEN {step}.real THEN {step}.l || {step}.r ELSE '' END"
        folds.append(f"{step}.real AS real{n}, {step}.l AS l{n}, {step}.r AS r{n}")
    turns = ["f0 AS (SELECT *, claimed AS f FROM paths)"]
    for n in range(len(path)):
        turns.append(
            f"f{n + 1} AS (SELECT * REPLACE (CASE WHEN real{n} THEN sha256(l{n} || f || r{n}) ELSE f END AS f) FROM f{n})"
        )
    return f"""
WITH hashed AS (
  SELECT doc_id, source, {_leaf()} AS leaf,
         CASE WHEN xor({crc}, 4294967295) % 5 = 0 THEN {_leaf(lowered)} ELSE {_leaf()} END AS claimed
  FROM documents),
sources AS (
  SELECT source, row_number() OVER (ORDER BY encode(source) NULLS FIRST) - 1 AS tree
  FROM (SELECT DISTINCT source FROM hashed)),
d AS (
  SELECT doc_id, tree, leaf, claimed,
         row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos,
         count(*) OVER (PARTITION BY tree) AS n
  FROM hashed JOIN sources ON hashed.source IS NOT DISTINCT FROM sources.source),
{_climb('t', 'SELECT tree, pos, n, leaf AS digest FROM d', levels)},
{_climb('g', f'SELECT 0 AS tree, tree AS pos, count(*) OVER () AS n, digest FROM t{levels}', tops)},
{_steps('t', levels)},
{_steps('g', tops)},
paths AS (
  SELECT d.doc_id, d.leaf, d.claimed, t{levels}.digest AS subroot, g{tops}.digest AS root,
         sha256({proof}) AS proof_sha256, {', '.join(folds)}
  FROM d JOIN t{levels} ON t{levels}.tree = d.tree CROSS JOIN g{tops}
  {joins}),
{', '.join(turns)}
SELECT doc_id, leaf, subroot, root, proof_sha256, f AS folded_root, f = root AS verified FROM f{len(path)}
"""


ORACLES: dict[str, str] = {
    "op4_quality": _QUALITY,
    "op1_url_rules": _URL_RULES,
    "op6_chat": _CHAT,
    "op7_mixing": _MIXING,
    "op11_merkle": _merkle(),
    "op13_negatives": _NEGATIVES,
}
