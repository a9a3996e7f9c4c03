"""SQL for the operators' queries, where SQL can express them."""

from __future__ import annotations

from beforeafter.llm import licenses

ORACLE: dict[str, str] = {}

ORACLE["op1_url_filter"] = r"""
WITH parts AS (
    SELECT page_id, CASE WHEN contains(url, '://') THEN url[strpos(url, '://') + 3:] ELSE '' END AS rest FROM pages
), split AS (
    SELECT page_id,
        translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
        regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path
    FROM parts
), ruled AS (
    SELECT page_id, host, path, CASE
        WHEN ('.' || host) LIKE '%.example.net' AND path LIKE '/en/%' THEN 'example.net/en/'
        WHEN ('.' || host) LIKE '%.example.com' AND path LIKE '/de/%' THEN 'example.com/de/'
        WHEN ('.' || host) LIKE '%.org' AND path LIKE '/fr/%' THEN 'org/fr/'
        WHEN ('.' || host) LIKE '%.net' AND path LIKE '/%' THEN 'net/'
    END AS rule FROM split
)
SELECT page_id, host, path, rule,
    CASE WHEN rule IN ('net/', 'example.com/de/') THEN 'block' ELSE 'allow' END AS verdict
FROM ruled
"""

#: CRC-32 of a list of bytes, by its table: ``table`` lies in ``crc``.
_CRC = r"""crc AS (
    SELECT list(v ORDER BY b) AS tab FROM (
        SELECT b, list_reduce([b::UBIGINT, 0, 0, 0, 0, 0, 0, 0, 0], lambda x, z: xor(x >> 1, 3988292384 * (x & 1))) AS v
        FROM range(256) r(b)
    )
)"""


def _crc32(listed: str) -> str:
    """SQL for the CRC-32 of a list of byte numbers."""
    step = "xor(c >> 8, tab[((xor(c, y) & 255) + 1)::INT])"
    return f"xor(list_reduce([4294967295::UBIGINT] || {listed}, lambda c, y: {step}), 4294967295::UBIGINT)"


ORACLE["op11_conversation_trie"] = rf"""
WITH {_CRC}, turns AS (
    SELECT conv_id, sha256(strlen(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')) AS k,
        len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS w, turn
    FROM conversations WHERE conv_id IS NOT NULL
), own AS (
    SELECT conv_id, list({{'k': k, 'w': w}} ORDER BY turn NULLS FIRST, k) AS l FROM turns GROUP BY conv_id
), headed AS (
    SELECT conv_id, l, conv_id - conv_id % 20 AS base,
        ({_crc32("list_transform(string_split(conv_id::VARCHAR, ''), lambda ch: ord(ch)::UBIGINT)")} % 4)::INT AS h
    FROM own, crc
), rebuilt AS (
    SELECT a.conv_id, coalesce(b.l[1:a.h], []) || a.l[a.h + 1:] AS l FROM headed a LEFT JOIN own b ON b.conv_id = a.base
), prefixes AS (
    SELECT conv_id, d, d = len(l) AS at_end, coalesce(l[d].w, 0) AS w,
        md5(d || '|' || array_to_string(list_transform(l[1:d], lambda x: x.k), ',')) AS node
    FROM (SELECT conv_id, l, unnest(range(0, len(l) + 1))::INT AS d FROM rebuilt)
), nodes AS (
    SELECT node, any_value(d) AS d, min(conv_id) AS conv_id, count(*) AS n, any_value(w) AS w,
        coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (WHERE at_end), '') AS ends
    FROM prefixes GROUP BY node
), linked AS (
    SELECT c.*, p.node AS up, u.conv_id AS parent_conv_id
    FROM nodes c LEFT JOIN prefixes p ON p.conv_id = c.conv_id AND p.d = c.d - 1 LEFT JOIN nodes u ON u.node = p.node
), kids AS (
    SELECT up AS node, count(*) AS n_children FROM linked WHERE up IS NOT NULL GROUP BY up
), sums AS (
    SELECT a.node, sum((c.n - 1) * c.w) AS saved, count(*) FILTER (WHERE k.node IS NULL) AS leaves
    FROM linked c JOIN prefixes a ON a.conv_id = c.conv_id AND a.d <= c.d LEFT JOIN kids k ON k.node = c.node
    GROUP BY a.node
)
SELECT l.conv_id, l.d::BIGINT AS depth, l.parent_conv_id, l.n AS n_convs, coalesce(k.n_children, 0) AS n_children,
    s.leaves AS n_leaves, s.saved::BIGINT AS saved_tokens, sha256(l.ends) AS ends_sha256
FROM linked l JOIN sums s USING (node) LEFT JOIN kids k USING (node)
"""


def _license_sql() -> str:
    """Each template's places by comparing every word, and its score by its words."""
    columns, scores = [], []
    for number, template in enumerate(licenses.BASE + licenses.NOTICES):
        found = licenses.postings(template)
        must = [p for p in found if p.mandatory]
        start = must[0].at
        same = " AND ".join(f"w[i + {p.at - start + 1}] = '{p.word}'" for p in must)
        columns.append(f"list_filter(range(0, len(w)), lambda i: {same}) AS s{number}")
        weights = [f"idf['{p.word}']" for p in must]
        for p in found:
            if not p.mandatory:
                at = p.at - start
                seen = f"list_filter(s{number}, lambda i: i + {at} >= 0 AND w[i + {at} + 1] = '{p.word}')"
                weights.append(f"CASE WHEN len({seen}) > 0 THEN idf['{p.word}'] ELSE 0 END")
        whole = " + ".join(f"idf['{p.word}']" for p in found)
        scores.append(f"CASE WHEN len(s{number}) > 0 THEN least(1.0, ({' + '.join(weights)}) / ({whole})) ELSE 0 END")
    vocabulary = sorted({p.word for t in licenses.BASE + licenses.NOTICES for p in licenses.postings(t)})
    listed = ", ".join(f"'{w}'" for w in vocabulary)

    def labels(templates) -> str:
        named = ", ".join(f"CASE WHEN len(s{n}) > 0 THEN '{t.label}' END" for n, t in templates)
        return f"coalesce(array_to_string(list_sort(list_distinct([{named}])), ','), '')"

    all_of = list(enumerate(licenses.BASE + licenses.NOTICES))
    base = [(n, t) for n, t in all_of if t.base]
    every = " || ".join(f"s{n}" for n, _ in base)
    return rf"""
WITH cut AS (
    SELECT doc_id, regexp_extract_all(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{licenses.WORD}'
    ) AS w FROM documents
), held AS (
    SELECT word, count(*) AS n FROM (SELECT unnest(list_distinct(w)) AS word FROM cut) WHERE word IN ({listed}) GROUP BY word
), weighed AS (
    SELECT map(list(v.word), list(ln((1 + t.n) / (1 + coalesce(held.n, 0))) + 1)) AS idf
    FROM (SELECT unnest([{listed}]) AS word) v LEFT JOIN held USING (word), (SELECT count(*) AS n FROM cut) t
), placed AS (
    SELECT doc_id, w, idf, {", ".join(columns)} FROM cut, weighed
)
SELECT doc_id, len(w) AS n_words, len({every}) AS n_base, list_min({every}) AS first_word, list_max({every}) AS last_word,
    {labels(base)} AS base_labels, {labels(all_of)} AS labels, round(greatest(0.0, {", ".join(scores)}), 6) AS score
FROM placed
"""


ORACLE["op12_license_scan"] = _license_sql()

_SLIP = _crc32(
    "list_transform(string_split(doc || ':', ''), lambda ch: ord(ch)::UBIGINT) || "
    "flatten(list_transform(string_split(run, ''), lambda ch: CASE WHEN ord(ch) < 128 THEN [ord(ch)::UBIGINT] "
    "ELSE [195::UBIGINT, (ord(ch) - 64)::UBIGINT] END))"
)

ORACLE["op13_spelling"] = rf"""
WITH RECURSIVE {_CRC}, runs AS (
    SELECT doc, run, count(*) AS n FROM (
        SELECT coalesce(doc_id::VARCHAR, '') AS doc, unnest(regexp_extract_all(
            translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[a-z\x{{C0}}-\x{{FF}}]+'
        )) AS run FROM documents
    ) WHERE length(run) >= 6 GROUP BY doc, run
), hashed AS (
    SELECT run, n, {_SLIP}::BIGINT AS h FROM runs, crc
), counted AS (
    SELECT CASE WHEN h % 199 = 0 THEN substr(run, 1, (h % length(run))::INT) || substr(run, (h % length(run))::INT + 2)
        ELSE run END AS word, sum(n)::BIGINT AS n
    FROM hashed GROUP BY 1
), words AS MATERIALIZED (
    SELECT word, n FROM counted WHERE length(word) >= 6 AND n >= 5
), cut AS (
    SELECT word, i, substr(word, 1, i - 1) || substr(word, i + 1) AS rest
    FROM (SELECT word, unnest(range(1, length(word) + 1))::INT AS i FROM words)
), near AS (
    SELECT a.word, b.word AS other FROM cut a JOIN cut b ON a.i = b.i AND a.rest = b.rest AND a.word <> b.word
    UNION SELECT w.word, c.word FROM words w JOIN cut c ON c.rest = w.word
    UNION SELECT c.word, w.word FROM words w JOIN cut c ON c.rest = w.word
), ranked AS (
    SELECT near.word, other, o.n AS other_n, count(*) OVER (PARTITION BY near.word) AS n_near,
        row_number() OVER (PARTITION BY near.word ORDER BY o.n DESC, other) AS r
    FROM near JOIN words o ON o.word = other
), formed AS MATERIALIZED (
    SELECT w.word, CASE WHEN other_n >= 5 * w.n THEN other END AS form, w.n, coalesce(n_near, 0) AS n_near,
        CASE WHEN other_n >= 5 * w.n THEN other_n END AS form_n
    FROM words w LEFT JOIN ranked r ON r.word = w.word AND r.r = 1
), followed AS (
    SELECT word, word AS at FROM formed
    UNION ALL SELECT f.word, n.form FROM followed f JOIN formed n ON n.word = f.at WHERE n.form IS NOT NULL
)
SELECT formed.word, formed.form, followed.at AS root, formed.n, formed.n_near, formed.form_n
FROM formed JOIN followed USING (word) JOIN formed e ON e.word = followed.at AND e.form IS NULL
"""
