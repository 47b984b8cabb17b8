"""The queries of this package that SQL can express, for DuckDB over the same tables."""

from __future__ import annotations

_PART = r"regexp_extract(url, '://([^/?#]*)([^?#]*)', {0})"


def _strength(groups: str) -> str:
    """Prior strength of a level by the analysis of variance; columns n, good and prior."""
    return f"""(
        SELECT 1 / CASE WHEN k > 1 AND total > k AND b + (size - 1) * w > 0
                        THEN least(greatest((b - w) / (b + (size - 1) * w), 0.001), 0.9) ELSE 0.9 END - 1
        FROM (SELECT k, total, between_ / (k - 1) AS b, within_ / (total - k) AS w, (total - squares / total) / (k - 1) AS size
              FROM (SELECT count(*)::DOUBLE AS k, sum(n) AS total, sum(n * n) AS squares,
                           sum(n * (good / n - prior) * (good / n - prior)) AS between_,
                           sum(n * (good / n) * (1 - good / n)) AS within_
                    FROM {groups} WHERE n > 0)))"""


_URL_FILTERS = f"""
WITH parts AS (
    SELECT page_id,
           coalesce(translate({_PART.format(1)}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '') AS host,
           coalesce({_PART.format(2)}, '') AS path
    FROM pages),
outcomes AS (
    SELECT host, good FROM parts
    LEFT JOIN (SELECT doc_id, max(quality) AS good FROM labels GROUP BY doc_id) ON doc_id = page_id),
names AS (
    SELECT host, coalesce(sum(good), 0)::DOUBLE AS good, count(good)::DOUBLE AS n,
           regexp_replace(regexp_replace(host, '^.*@', ''), ':[0-9]*$', '') AS name
    FROM outcomes GROUP BY host),
hosts AS (
    SELECT host, good, n,
           CASE WHEN regexp_matches(name, '^[0-9.]+$') THEN name
                ELSE array_to_string(string_split(name, '.')[greatest(len(string_split(name, '.')) - 1, 1):], '.') END AS domain,
           CASE WHEN regexp_matches(name, '^[0-9.]+$') THEN name ELSE string_split(name, '.')[-1] END AS suffix
    FROM names),
s0 AS (
    SELECT suffix, sum(good) AS good, sum(n) AS n,
           (SELECT CASE WHEN sum(n) > 0 THEN sum(good) / sum(n) ELSE 0.5 END FROM hosts) AS prior
    FROM hosts GROUP BY suffix),
s1 AS (SELECT suffix, (good + strength * prior) / (n + strength) AS mean FROM (SELECT *, {_strength("s0")} AS strength FROM s0)),
d0 AS (
    SELECT d.*, s1.mean AS prior FROM (SELECT domain, suffix, sum(good) AS good, sum(n) AS n FROM hosts GROUP BY ALL) d
    JOIN s1 USING (suffix)),
d1 AS (SELECT domain, suffix, (good + strength * prior) / (n + strength) AS mean FROM (SELECT *, {_strength("d0")} AS strength FROM d0)),
h0 AS (SELECT hosts.*, d1.mean AS prior FROM hosts JOIN d1 USING (domain, suffix)),
h1 AS (
    SELECT host, (good + strength * prior) / (n + strength) AS mean, n + strength AS weight
    FROM (SELECT *, {_strength("h0")} AS strength FROM h0)),
judged AS (
    SELECT page_id, host, path, mean + 1.645 * sqrt(mean * (1 - mean) / (weight + 1)) AS bound,
           CASE WHEN (host = 'www.example.com' OR host LIKE '%.www.example.com') AND path LIKE '/en/%' THEN 'www.example.com/en/'
                WHEN (host = 'example.com' OR host LIKE '%.example.com') AND path LIKE '/en/%' THEN 'example.com/en/'
                WHEN (host = 'net' OR host LIKE '%.net') AND path LIKE '/es/%' THEN 'net/es/'
                WHEN (host = 'net' OR host LIKE '%.net') AND path LIKE '/fr/%' THEN 'net/fr/'
                WHEN (host = 'com' OR host LIKE '%.com') AND path LIKE '/%' THEN 'com/' END AS rule
    FROM parts JOIN h1 USING (host))
SELECT page_id, host, path, rule,
       CASE WHEN rule IN ('com/', 'www.example.com/en/') THEN 'allow' WHEN rule IS NOT NULL THEN 'block'
            WHEN bound < 0.5 THEN 'block' ELSE 'allow' END AS verdict
FROM judged
"""

_CHAT = """
WITH known AS (
    SELECT DISTINCT conv_id, coalesce(floor(turn / 256)::BIGINT, -1) AS part, turn, coalesce(role, 'unknown') AS role,
           replace(coalesce(text, ''), '<|', '<\\|') AS said, role IS NOT NULL AS named
    FROM conversations WHERE conv_id IS NOT NULL),
speakers AS (SELECT DISTINCT conv_id, role AS speaker FROM known WHERE named AND role <> 'system'),
numbers AS (SELECT conv_id, count(DISTINCT part) AS n_parts FROM known GROUP BY conv_id),
shown AS (
    SELECT conv_id, speaker, part, turn, role, said, named, named AND role = speaker AS mine,
           '<|im_start|>' || CASE WHEN named AND role = speaker THEN 'assistant' WHEN NOT named OR role = 'system' THEN role
                                  ELSE 'user name=' || replace(replace(role, '<|', '<\\|'), chr(10), ' ') END || chr(10) AS head,
           said || '<|im_end|>' || chr(10) AS body
    FROM known JOIN speakers USING (conv_id)),
placed AS (
    SELECT *, coalesce(sum(length(head) + length(body)) OVER (
                  PARTITION BY conv_id, speaker, part ORDER BY turn NULLS FIRST, role, said, named
                  ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS begins
    FROM shown)
SELECT conv_id, speaker, part, any_value(n_parts) AS n_parts, count(*) AS n_turns,
       string_agg(head || body, '' ORDER BY turn NULLS FIRST, role, said, named) AS text,
       coalesce(string_agg((begins + length(head))::BIGINT || ':' || length(body), ',' ORDER BY turn NULLS FIRST, role, said, named)
           FILTER (WHERE mine), '') AS mask
FROM placed JOIN numbers USING (conv_id) GROUP BY conv_id, speaker, part
"""

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

_DIVERGENCE = rf"""
WITH docs AS (
    SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
           translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}') AS said
    FROM documents),
words AS (
    SELECT r, lang, source, unnest(regexp_extract_all(said, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM docs),
kept AS (SELECT lang, term, count(*) AS n FROM words GROUP BY ALL HAVING count(DISTINCT r) >= 3),
langs AS (
    SELECT lang, count(term) AS v, coalesce(sum(n), 0) AS n FROM (SELECT DISTINCT lang FROM docs) LEFT JOIN kept USING (lang) GROUP BY lang),
counts AS (SELECT lang, source, term, count(*) AS n FROM words SEMI JOIN kept USING (lang, term) GROUP BY ALL),
groups AS (
    SELECT lang, source, coalesce(sum(n), 0) AS n FROM (SELECT DISTINCT lang, source FROM docs) LEFT JOIN counts USING (lang, source) GROUP BY ALL),
chances AS (
    SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n,
           1 + (1000000000::HUGEINT * (coalesce(c.n, 0) + 1)) // (g.n + l.v)::HUGEINT AS p,
           1 + (1000000000::HUGEINT * (k.n + 1)) // (l.n + l.v)::HUGEINT AS q
    FROM groups g JOIN langs l USING (lang) JOIN kept k USING (lang)
    LEFT JOIN counts c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term),
pairs AS (
    SELECT g.lang, g.source, 'pair' AS part, h.source AS item, coalesce(sum((a.p - b.p) * (a.p - b.p) // b.p), 0)::BIGINT AS value
    FROM groups g JOIN groups h ON g.lang = h.lang AND g.source <> h.source
    LEFT JOIN chances a ON a.lang = g.lang AND a.source = g.source
    LEFT JOIN chances b ON b.lang = g.lang AND b.source = h.source AND b.term = a.term
    GROUP BY ALL),
terms AS (
    SELECT lang, source, 'term' AS part, term AS item, ((p - q) * (p - q) // q)::BIGINT AS value FROM chances WHERE n > 0 AND p > q)
SELECT lang, source, part, item, value, rank::INTEGER AS rank
FROM (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank
      FROM (SELECT * FROM pairs UNION ALL SELECT * FROM terms))
WHERE part = 'pair' OR rank <= 200
"""

def _leaf(text: str) -> str:
    fields = ["doc_id::VARCHAR", "source", "lang", "n_chars::VARCHAR", text]
    return "sha256(" + " || ".join(f"coalesce(strlen({f}) || ':' || {f}, '-')" for f in fields) + ")"


# The checksum of an id's digits: eight shifts a byte, from a register of ones.
_CRC32 = """xor(4294967295, list_reduce(
    list_prepend(4294967295::BIGINT, list_transform(range(1, strlen(doc_id::VARCHAR) + 1), lambda i: ord(substr(doc_id::VARCHAR, i, 1))::BIGINT)),
    lambda c, b: list_reduce(list_prepend(xor(c, b), [0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[]), lambda x, y: xor(x >> 1, (x & 1) * 3988292384))))"""


def _climb(name: str, levels: int) -> str:
    """Nodes of ``name``0 (g, idx, hash, width) run by run, a level at a time; trees that have ended stay as they are."""
    return ",".join(
        f"""
{name}{i + 1} AS (
    SELECT g, idx // 16 AS idx, list(hash ORDER BY idx) AS run, any_value(width) AS below, (any_value(width) + 15) // 16 AS width,
           CASE WHEN any_value(width) > 1 THEN sha256(string_agg(hash, '' ORDER BY idx)) ELSE any_value(hash) END AS hash
    FROM {name}{i} GROUP BY g, idx // 16)"""
        for i in range(levels)
    )


def _fold(name: str, first: str, nodes: str, group: str, place: str, levels: int) -> str:
    """Rows of ``first`` with ``h`` and ``proof`` led through the runs of all levels."""
    out = [f"\n{name}0 AS (SELECT *, {place} AS spot FROM {first})"]
    for i in range(levels):
        out.append(f"""
{name}{i + 1} AS (
    SELECT f.* REPLACE (
        f.spot // 16 AS spot,
        CASE WHEN n.below > 1 THEN sha256(array_to_string(n.run[1:f.spot % 16], '') || f.h || array_to_string(n.run[f.spot % 16 + 2:], '')) ELSE f.h END AS h,
        f.proof || array_to_string(n.run[1:f.spot % 16], '') || array_to_string(n.run[f.spot % 16 + 2:], '') AS proof)
    FROM {name}{i} f JOIN {nodes}{i + 1} n ON n.g = {group} AND n.idx = f.spot // 16)""")
    return ",".join(out)


#: Up to 16^6 rows of a source and 16^4 sources.
_DEEP, _WIDE = 6, 4

_MANIFEST = f"""
WITH hashed AS (
    SELECT doc_id, CASE WHEN source IS NULL THEN '' ELSE '=' || source END AS g, {_leaf("text")} AS leaf,
           CASE WHEN {_CRC32} % 5 = 0 THEN {_leaf(f"translate(text, '{_UPPER}', '{_LOWER}')")} END AS other
    FROM documents),
leaves AS (
    SELECT *, row_number() OVER (PARTITION BY g ORDER BY doc_id NULLS FIRST, leaf) - 1 AS place, coalesce(other, leaf) AS h, '' AS proof FROM hashed),
n0 AS (SELECT g, place AS idx, leaf AS hash, count(*) OVER (PARTITION BY g) AS width FROM leaves),{_climb("n", _DEEP)},
t0 AS (SELECT 'top' AS g, row_number() OVER (ORDER BY g) - 1 AS idx, hash, count(*) OVER () AS width, g AS tree FROM n{_DEEP}),{_climb("t", _WIDE)},
{_fold("f", "leaves", "n", "f.g", "place", _DEEP)},
placed AS (SELECT f.* EXCLUDE (spot), t0.idx AS spot_of_tree, t0.hash AS subroot FROM f{_DEEP} f JOIN t0 ON t0.tree = f.g),
{_fold("u", "placed", "t", "'top'", "spot_of_tree", _WIDE)}
SELECT doc_id, leaf, subroot, t{_WIDE}.hash AS root, sha256(proof) AS proof_sha256, h AS folded_root, h = t{_WIDE}.hash AS verified
FROM u{_WIDE}, t{_WIDE}
"""

ORACLE: dict[str, str] = {
    "op4_url_filters": _URL_FILTERS,
    "op8_chat_formatting": _CHAT,
    "op12_source_divergence": _DIVERGENCE,
    "op13_merkle_manifest": _MANIFEST,
}
