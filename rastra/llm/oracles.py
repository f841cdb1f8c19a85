"""DuckDB SQL of the corpus queries that SQL can express."""

from __future__ import annotations

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_WORD = r"[^\x20\x09-\x0D]+"
_BENCHMARK_WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"

SUBSTRINGS = rf"""
WITH d AS (SELECT doc_id, coalesce(regexp_extract_all(text, '{_WORD}'), []) AS w FROM documents),
placed AS (
  SELECT doc_id, w[i] AS word, i, CASE WHEN i + 49 <= len(w) THEN array_to_string(w[i:i + 49], ' ') END AS passage
  FROM d, unnest(range(1, len(w) + 1)) AS t(i)
),
firsts AS (SELECT passage, min(doc_id) AS first_id FROM placed WHERE passage IS NOT NULL GROUP BY passage HAVING min(doc_id) < max(doc_id)),
judged AS (
  SELECT doc_id, i, word, max(coalesce(doc_id > first_id, false)) OVER (PARTITION BY doc_id ORDER BY i ROWS 49 PRECEDING) AS gone
  FROM placed LEFT JOIN firsts USING (passage)
),
cut AS (
  SELECT doc_id, count(*) FILTER (gone) AS n_removed, string_agg(word, ' ' ORDER BY i) FILTER (NOT gone) AS kept
  FROM judged GROUP BY doc_id
)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_removed, 0) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
FROM d LEFT JOIN cut USING (doc_id)
"""

DECONTAMINATION = rf"""
WITH d AS (SELECT doc_id, coalesce(regexp_extract_all(translate(text, '{_UPPER}', '{_LOWER}'), '{_BENCHMARK_WORD}'), []) AS w FROM documents),
b AS (SELECT item_id, regexp_extract_all(translate(text, '{_UPPER}', '{_LOWER}'), '{_BENCHMARK_WORD}') AS w FROM benchmark),
listed AS (
  SELECT DISTINCT CAST(item_id AS VARCHAR) AS item_id, n, array_to_string(w[i:i + n - 1], ' ') AS passage
  FROM (SELECT *, least(len(w), 10) AS n FROM b WHERE len(w) > 0), unnest(range(1, len(w) - n + 2)) AS t(i)
),
hits AS (
  SELECT doc_id, i, x.n, item_id
  FROM (
    SELECT doc_id, i, n, array_to_string(w[i:i + n - 1], ' ') AS passage
    FROM d, (SELECT DISTINCT n FROM listed), unnest(range(1, len(w) - n + 2)) AS t(i)
  ) AS x JOIN listed AS y ON x.n = y.n AND x.passage = y.passage
),
covered AS (
  SELECT doc_id, count(DISTINCT place) AS n_hit
  FROM (SELECT doc_id, unnest(range(i, i + n)) AS place FROM (SELECT DISTINCT doc_id, i, n FROM hits)) GROUP BY doc_id
),
found AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS items
  FROM (SELECT DISTINCT doc_id, item_id FROM hits) GROUP BY doc_id
)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN covered USING (doc_id) LEFT JOIN found USING (doc_id)
"""

URL_FILTER = rf"""
WITH rules(rule_host, rule_path, action) AS (
  VALUES ('com', '/', 'allow'), ('example.com', '/en/', 'block'), ('www.example.com', '/en/', 'allow'), ('net', '/es/', 'block'), ('net', '/fr/', 'block')
),
p AS (
  SELECT page_id,
         translate(coalesce(regexp_extract(url, '(?s)\A.*?://([^/?#]*)', 1), ''), '{_UPPER}', '{_LOWER}') AS host,
         coalesce(regexp_extract(url, '(?s)\A.*?://[^/?#]*([^?#]*)', 1), '') AS path
  FROM pages
),
best AS (
  SELECT host, path, max_by(rule_host || rule_path, length(rule_host || rule_path)) AS rule, max_by(action, length(rule_host || rule_path)) AS action
  FROM (SELECT DISTINCT host, path FROM p) JOIN rules
    ON (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path)
  GROUP BY host, path
)
SELECT page_id, host, path, rule, coalesce(action, 'allow') AS verdict FROM p LEFT JOIN best USING (host, path)
"""


_WHITE = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"

LINE_DEDUP = f"""
WITH d AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS l FROM documents),
lines AS (
  SELECT doc_id, i, l[i] AS line, translate(trim(l[i], {_WHITE}), '{_UPPER}', '{_LOWER}') AS key
  FROM d, unnest(range(1, len(l) + 1)) AS t(i)
),
firsts AS (SELECT key, min(doc_id) AS first_id FROM lines WHERE length(key) >= 10 GROUP BY key HAVING min(doc_id) < max(doc_id)),
judged AS (SELECT doc_id, i, line, coalesce(doc_id > first_id, false) AS gone FROM lines LEFT JOIN firsts USING (key))
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (NOT gone), '')) AS kept_sha256
FROM judged GROUP BY doc_id
"""


def _vector_codes(parts: int = 8, entries: int = 16, rounds: int = 6) -> str:
    """Every round as its own tables: the nearest entry of each part, then the entries' means rounded down."""
    steps = [
        f"""
v AS (
  SELECT vec_id, label, list_transform(embedding, lambda x: CAST(floor(4096 * CAST(x AS DOUBLE)) AS BIGINT)) AS w FROM embeddings
  WHERE embedding IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
),
x AS (
  SELECT vec_id, (i - 1) // (len(w) // {parts}) AS part, (i - 1) % (len(w) // {parts}) AS place, w[i] AS x
  FROM v, unnest(range(1, len(w) + 1)) AS t(i)
),
f AS (SELECT vec_id, row_number() OVER (ORDER BY vec_id) - 1 AS entry FROM v ORDER BY vec_id LIMIT {entries}),
b0 AS (SELECT part, entry, place, x AS b FROM x JOIN f USING (vec_id))"""
    ]
    for r in range(rounds + 1):
        steps.append(f"""
d{r} AS (SELECT vec_id, part, entry, sum((x - b) * (x - b)) AS d FROM x JOIN b{r} USING (part, place) GROUP BY vec_id, part, entry),
a{r} AS (
  SELECT vec_id, part, entry, d FROM (SELECT *, row_number() OVER (PARTITION BY vec_id, part ORDER BY d, entry) AS nth FROM d{r}) WHERE nth = 1
)""")
        if r < rounds:
            steps.append(f"""
m{r} AS (SELECT part, entry, place, sum(x) AS s, count(*) AS n FROM x JOIN a{r} USING (vec_id, part) GROUP BY part, entry, place),
b{r + 1} AS (SELECT part, entry, place, coalesce((s - ((s % n) + n) % n) // n, b) AS b FROM b{r} LEFT JOIN m{r} USING (part, entry, place))""")
    return f"""
WITH {",".join(steps)},
c AS (SELECT vec_id, string_agg(printf('%02x', entry), '' ORDER BY part) AS code, CAST(sum(d) AS BIGINT) AS error FROM a{rounds} GROUP BY vec_id),
g AS (SELECT label, CAST(sum(error) AS BIGINT) AS label_error FROM c JOIN v USING (vec_id) GROUP BY label),
h AS (SELECT sha256(string_agg(CAST(b AS VARCHAR), ',' ORDER BY part, entry, place)) AS codebooks_sha256 FROM b{rounds})
SELECT vec_id, code, error, label_error, codebooks_sha256
FROM c JOIN v USING (vec_id) JOIN g ON v.label IS NOT DISTINCT FROM g.label, h
"""


def _merkle(levels: int = 6, fanout: int = 16) -> str:
    """Trees of up to ``fanout ** levels`` leaves: at each level nodes, their siblings, and the way of the altered leaf."""
    field = "coalesce(strlen({0}) || ':' || {0}, '-')"
    leaf = lambda text: "sha256(" + " || ".join(field.format(x) for x in ("CAST(doc_id AS VARCHAR)", "source", "lang", "CAST(n_chars AS VARCHAR)", text)) + ")"
    lowered = f"translate(text, '{_UPPER}', '{_LOWER}')"

    def tree(name: str, key: str) -> str:
        """From ``{name}0`` (key, i, d) the levels up to ``{name}{levels}``: a level of one node is passed on as it is."""
        return ",".join(
            f"""
{name}{k + 1} AS (
  SELECT {key}, i // {fanout} AS i, CASE WHEN any_value(n) = 1 THEN min(d) ELSE sha256(string_agg(d, '' ORDER BY i)) END AS d
  FROM (SELECT *, count(*) OVER (PARTITION BY {key}) AS n FROM {name}{k}) GROUP BY {key}, i // {fanout}
)"""
            for k in range(levels)
        )

    def way(name: str, key: str, start: str, at: str) -> str:
        """From ``start`` (a document's place, ``folded`` and ``proof``) a level at a time: siblings left and right of the node on the way."""
        return ",".join(
            f"""
{name}s{k} AS (
  SELECT {key}, i, coalesce(string_agg(d, '') OVER (PARTITION BY {key}, i // {fanout} ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS l,
         coalesce(string_agg(d, '') OVER (PARTITION BY {key}, i // {fanout} ORDER BY i ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS r,
         count(*) OVER (PARTITION BY {key}) AS n
  FROM {name}{k}
),
{name}w{k + 1} AS (
  SELECT w.* EXCLUDE ({at}, folded, proof), w.{at} // {fanout} AS {at}, CASE WHEN n = 1 THEN folded ELSE sha256(l || folded || r) END AS folded, proof || l || r AS proof
  FROM {start if k == 0 else f"{name}w{k}"} AS w JOIN {name}s{k} AS s ON w.{key} = s.{key} AND w.{at} = s.i
)"""
            for k in range(levels)
        )

    return f"""
WITH leaves AS (
  SELECT doc_id, coalesce('=' || source, '') AS tree, {leaf("text")} AS leaf, CASE WHEN crc % 5 = 0 THEN {leaf(lowered)} ELSE {leaf("text")} END AS altered
  FROM documents JOIN ({_crc("CAST(doc_id AS VARCHAR)")}) USING (doc_id)
),
placed AS (SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos FROM leaves),
t0 AS (SELECT tree, pos AS i, leaf AS d FROM placed),{tree("t", "tree")},
u0 AS (SELECT 0 AS one, row_number() OVER (ORDER BY encode(tree)) - 1 AS i, d, tree FROM t{levels}),{tree("u", "one")},
start AS (SELECT doc_id, leaf, tree, pos, altered AS folded, '' AS proof FROM placed),{way("t", "tree", "start", "pos")},
risen AS (SELECT doc_id, leaf, w.tree, d AS subroot, folded, proof, 0 AS one, i AS up FROM tw{levels} AS w JOIN u0 ON w.tree = u0.tree),{way("u", "one", "risen", "up")}
SELECT doc_id, leaf, subroot, u.d AS root, sha256(proof) AS proof_sha256, folded AS folded_root, folded = u.d AS verified
FROM uw{levels} JOIN u{levels} AS u USING (one)
"""


def _crc(text: str) -> str:
    """CRC-32 of short ASCII texts, a bit at a time: ``doc_id, crc``."""
    byte = lambda i: f"xor(c, ascii(substr(t, {i}, 1)))"
    bits = "list_reduce([{0}, 0, 0, 0, 0, 0, 0, 0, 0], lambda a, b: CASE WHEN a & 1 = 1 THEN xor(a >> 1, 3988292384) ELSE a >> 1 END)"
    return f"""
    WITH RECURSIVE r(doc_id, t, k, c) AS (
      SELECT doc_id, {text}, 1, CAST(4294967295 AS BIGINT) FROM documents
      UNION ALL SELECT doc_id, t, k + 1, {bits.format(byte("k"))} FROM r WHERE k <= length(t)
    )
    SELECT doc_id, xor(c, 4294967295) AS crc FROM r WHERE k = length(t) + 1
    """


def oracle_sql() -> dict[str, str]:
    return {
        "op6_substrings": SUBSTRINGS,
        "op7_decontamination": DECONTAMINATION,
        "op9_url_filter": URL_FILTER,
        "op11_line_dedup": LINE_DEDUP,
        "op12_vector_codes": _vector_codes(),
        "op13_merkle": _merkle(),
    }
