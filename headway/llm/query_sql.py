"""DuckDB SQL for the queries that SQL can express."""

from headway.llm import license_scan

_WORD = r"'[^\x20\x09-\x0D]+'"
_LOWER = (
    "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', "
    "'abcdefghijklmnopqrstuvwxyz')"
)

_NEAR = f"""
WITH RECURSIVE
worded AS (
    SELECT doc_id, regexp_extract_all({_LOWER}, {_WORD}) AS ws FROM documents
),
sets AS (
    SELECT doc_id, list_distinct(CASE
        WHEN len(ws) >= 2 THEN
            list_transform(range(1, len(ws)), lambda i: ws[i] || ' ' || ws[i + 1])
        ELSE ws END) AS shingles
    FROM worded
),
spread AS (
    SELECT doc_id, len(shingles) AS n, unnest(shingles) AS shingle FROM sets
),
shared AS (
    SELECT a.doc_id AS a, b.doc_id AS b, a.n AS na, b.n AS nb, count(*) AS common
    FROM spread a JOIN spread b
        ON a.shingle = b.shingle AND a.doc_id <> b.doc_id
        AND 100 * least(a.n, b.n) >= 80 * greatest(a.n, b.n)
    GROUP BY ALL
),
links AS (
    SELECT a, b FROM shared WHERE 100 * common >= 80 * (na + nb - common)
),
reach(doc_id, other) AS (
    SELECT doc_id, doc_id FROM documents
    UNION
    SELECT r.doc_id, l.b FROM reach r JOIN links l ON r.other = l.a
),
least_id AS (
    SELECT doc_id, min(other) AS component_id FROM reach GROUP BY doc_id
)
SELECT doc_id, CAST(len(shingles) AS BIGINT) AS n_shingles, component_id,
    doc_id = component_id AS kept
FROM sets JOIN least_id USING (doc_id)
"""

_URLS = r"""
WITH parts AS (
    SELECT page_id, url,
        CASE WHEN contains(url, '://')
            THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest
    FROM pages
),
named AS (
    SELECT page_id, url,
        translate(regexp_extract(rest, '^([^/?#]*)', 1),
            'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
        coalesce(regexp_extract(rest, '^[^/?#]*([^?#]*)', 1), '') AS path
    FROM parts
),
canon AS (
    SELECT *, regexp_replace(host, '^www\.', '')
        || regexp_replace(path, '/+$', '') AS canonical
    FROM named
),
listed AS (
    SELECT DISTINCT canonical FROM canon
    WHERE regexp_matches(url, '[?&]utm_') AND canonical <> ''
),
ruled AS (
    SELECT *, CASE
        WHEN (host = 'example.org' OR host LIKE '%.example.org')
            AND path LIKE '/en/1%' THEN 'example.org/en/1'
        WHEN (host = 'example.org' OR host LIKE '%.example.org')
            AND path LIKE '/es/%' THEN 'example.org/es/'
        WHEN (host = 'com' OR host LIKE '%.com')
            AND path LIKE '/fr/%' THEN 'com/fr/'
        WHEN (host = 'com' OR host LIKE '%.com')
            AND path LIKE '/de/%' THEN 'com/de/'
        WHEN (host = 'org' OR host LIKE '%.org') AND path LIKE '/%' THEN 'org/'
        END AS rule
    FROM canon
)
SELECT page_id, host, path, rule, CASE
    WHEN rule IN ('example.org/en/1', 'example.org/es/', 'com/de/') THEN 'block'
    WHEN rule IN ('com/fr/', 'org/') THEN 'allow'
    WHEN canonical IN (SELECT canonical FROM listed) THEN 'block'
    ELSE 'allow' END AS verdict
FROM ruled
"""

_RULES = f"""
WITH worded AS (
    SELECT doc_id, coalesce(text, '') AS body,
        regexp_extract_all(coalesce(text, ''), {_WORD}) AS ws
    FROM documents
),
counted AS (
    SELECT doc_id, body, len(ws) AS n_words,
        CAST(coalesce(list_sum(list_transform(ws, lambda w: length(w))), 0) AS BIGINT)
            AS word_chars,
        len(regexp_extract_all(body, '[#*$%&|<>]')) AS n_symbols,
        list_filter(string_split(body, chr(10)),
            lambda l: regexp_matches(l, '[^\\x20\\x09-\\x0D]')) AS lines,
        list_transform(range(1, len(ws) - 3),
            lambda i: array_to_string(ws[i:i + 4], ' ')) AS windows
    FROM worded
),
placed AS (
    SELECT doc_id, unnest(windows) AS w, generate_subscripts(windows, 1) AS i
    FROM counted
),
twice AS (
    SELECT doc_id, i FROM placed
    QUALIFY count(*) OVER (PARTITION BY doc_id, w) > 1
),
covered AS (
    SELECT doc_id, count(DISTINCT i + k) AS n
    FROM twice, range(5) r(k) GROUP BY doc_id
),
measured AS (
    SELECT doc_id, body, CAST(n_words AS BIGINT) AS n_words, word_chars,
        CAST(n_symbols AS BIGINT) AS n_symbols,
        CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines,
        CAST(coalesce(n, 0) AS BIGINT) AS n_repeat_words
    FROM counted LEFT JOIN covered USING (doc_id)
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
    n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed,
    NOT (n_words < 10 OR 100 * n_repeat_words > 20 * n_words
        OR word_chars < 2 * n_words
        OR word_chars > 20 * n_words
        OR 20 * n_symbols > word_chars
        OR 2 * n_dup_lines > len(string_split(body, chr(10)))
        OR 2 * length(regexp_replace(body, '[^\\p{{L}}]+', '', 'g')) < word_chars
    ) AS kept
FROM measured
"""

_WARC = """
WITH named AS (
    SELECT page_id, coalesce(html, '') AS payload,
        sha256(coalesce(html, '')) AS payload_digest,
        CAST(strlen(coalesce(html, '')) AS BIGINT) AS payload_bytes
    FROM pages
),
placed AS (
    SELECT *, CASE WHEN payload_bytes >= 100
        THEN min(page_id) OVER (PARTITION BY payload_digest) END AS first
    FROM named
)
SELECT page_id, payload_bytes, payload_digest,
    CASE WHEN first <> page_id THEN 'revisit' ELSE 'response' END AS record_type,
    CASE WHEN first <> page_id THEN first END AS refers_to
FROM placed
"""



def _checksum(value: str) -> str:
    """Unsigned CRC-32 of the decimal digits of a number."""
    return f"""xor(4294967295, list_reduce(
        list_transform(string_split(CAST({value} AS VARCHAR), ''),
            lambda c: CAST(ascii(c) AS BIGINT)),
        lambda so_far, byte: list_reduce(CAST(range(8) AS BIGINT[]),
            lambda x, k: CASE WHEN x % 2 = 1 THEN xor(x >> 1, 3988292384)
                ELSE x >> 1 END,
            xor(so_far, byte)),
        CAST(4294967295 AS BIGINT)))"""


_RUNS = f"""
WITH worded AS (
    SELECT doc_id, regexp_extract_all(coalesce(text, ''), {_WORD}) AS ws,
        {_checksum("doc_id")} AS h
    FROM documents
),
shaped AS (
    SELECT doc_id, ws, len(ws) AS n, h % 10 = 0 AND len(ws) > 0 AS planted,
        CASE WHEN len(ws) > 0 THEN (h // 10) % len(ws) END AS a, h // 10 AS g
    FROM worded
),
changed AS (
    SELECT doc_id, n, CASE WHEN planted THEN list_transform(range(n), lambda i:
        ws[1 + CASE WHEN i < a THEN i
            ELSE a + (i - a) % (1 + (n - a) // (3 + g % 8)) END]) ELSE ws END AS ws
    FROM shaped
),
placed AS (
    SELECT doc_id, n, unnest(ws) AS w, generate_subscripts(ws, 1) - 1 AS i
    FROM changed
),
equal_words AS (
    SELECT a.doc_id, a.i, b.i - a.i AS q
    FROM placed a JOIN placed b
        ON a.doc_id = b.doc_id AND a.w = b.w AND a.i < b.i
        AND 3 * (b.i - a.i) <= a.n
),
numbered AS (
    SELECT *, i - row_number() OVER (PARTITION BY doc_id, q ORDER BY i) AS stretch
    FROM equal_words
),
stretches AS (
    SELECT doc_id, q, min(i) AS start, count(*) + q AS length
    FROM numbered GROUP BY doc_id, q, stretch
    HAVING count(*) + q >= greatest(24, 3 * q)
),
runs AS (
    SELECT doc_id, CAST(start AS BIGINT) AS start, CAST(length AS BIGINT) AS length,
        CAST(min(q) AS BIGINT) AS period
    FROM stretches GROUP BY ALL
),
best AS (
    SELECT * FROM runs r
    QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY
        (SELECT count(*) FROM runs o WHERE o.doc_id = r.doc_id
            AND o.length * r.period > r.length * o.period), start, period) = 1
),
listed AS (
    SELECT doc_id, count(*) AS n_runs,
        string_agg(start || ',' || length || ',' || period || chr(10), ''
            ORDER BY start, period) AS lines
    FROM runs GROUP BY doc_id
),
dropped AS (
    SELECT DISTINCT doc_id, unnest(range(start + period, start + length)) AS i FROM runs
),
collapsed AS (
    SELECT doc_id, string_agg(w, ' ' ORDER BY i) AS body
    FROM placed ANTI JOIN dropped USING (doc_id, i) GROUP BY doc_id
)
SELECT doc_id, CAST(coalesce(n_runs, 0) AS BIGINT) AS n_runs, start, length, period,
    CAST(1000 * length // period AS BIGINT) AS exponent_milli,
    sha256(coalesce(lines, '')) AS runs_sha256,
    sha256(coalesce(body, '')) AS collapsed_sha256
FROM documents LEFT JOIN best USING (doc_id) LEFT JOIN listed USING (doc_id)
    LEFT JOIN collapsed USING (doc_id)
"""

_TRIE = f"""
WITH turns AS (
    SELECT conv_id, row_number() OVER (PARTITION BY conv_id
            ORDER BY turn NULLS FIRST, coalesce(role, ''), sha256(coalesce(text, ''))) - 1 AS i,
        coalesce(role, '') AS role, coalesce(text, '') AS text
    FROM conversations WHERE conv_id IS NOT NULL
),
convs AS (
    SELECT DISTINCT conv_id, {_checksum("conv_id")} % 4 AS h,
        conv_id - conv_id % 20 AS base
    FROM turns
),
rebuilt AS (
    SELECT c.conv_id, -1 AS own, t.i, t.role, t.text
    FROM convs c JOIN turns t ON t.conv_id = c.base AND t.i < c.h
    UNION ALL
    SELECT c.conv_id, 0, t.i, t.role, t.text
    FROM convs c JOIN turns t ON t.conv_id = c.conv_id AND t.i >= c.h
),
placed AS (
    SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY own, i) AS depth,
        {{'role': role, 'text': text}} AS said,
        len(regexp_extract_all(text, {_WORD})) AS words
    FROM rebuilt
),
prefixes AS (
    SELECT conv_id, depth, words, list(said) OVER (PARTITION BY conv_id
            ORDER BY depth ROWS UNBOUNDED PRECEDING) AS said
    FROM placed
    UNION ALL
    SELECT conv_id, 0, 0, [] FROM convs
),
named AS (
    SELECT *, min(conv_id) OVER (PARTITION BY said) AS node,
        depth = max(depth) OVER (PARTITION BY conv_id) AS ends
    FROM prefixes
),
nodes AS (
    SELECT node, depth, count(*) AS n_convs, max(words) AS words,
        sha256(coalesce(string_agg(CASE WHEN ends THEN conv_id END, ','
            ORDER BY conv_id), '')) AS ends_sha256
    FROM named GROUP BY node, depth
),
ways AS (
    SELECT DISTINCT low.node, low.depth, up.node AS up, up.depth AS up_depth
    FROM named low JOIN named up ON up.conv_id = low.node AND up.depth <= low.depth
    WHERE low.conv_id = low.node
),
parents AS (
    SELECT w.node, w.depth, w.up AS parent FROM ways w WHERE w.up_depth = w.depth - 1
),
children AS (
    SELECT parent AS node, depth - 1 AS depth, count(*) AS n_children
    FROM parents GROUP BY ALL
),
sums AS (
    SELECT w.up AS node, w.up_depth AS depth,
        count(*) FILTER (c.n_children IS NULL) AS n_leaves,
        sum((n.n_convs - 1) * n.words) AS saved
    FROM ways w JOIN nodes n USING (node, depth)
        LEFT JOIN children c USING (node, depth)
    GROUP BY ALL
)
SELECT n.node AS conv_id, n.depth, p.parent AS parent_conv_id, n_convs,
    coalesce(n_children, 0) AS n_children, n_leaves,
    CAST(saved AS BIGINT) AS saved_tokens, ends_sha256
FROM nodes n JOIN sums USING (node, depth) LEFT JOIN parents p USING (node, depth)
    LEFT JOIN children USING (node, depth)
"""

# The templates of the license scan: number, label, width and wording.
_TEMPLATES = ", ".join(
    f"({k}, '{t.label}', {license_scan.width_of(t)}, '{t.text.lower()}')"
    for k, t in enumerate(license_scan.TEMPLATES)
)
_SPELLED = r"'[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'"
_PHRASES = ", ".join(
    f"(['{"', '".join(phrase.split())}'], '{label}')"
    for phrase, label in license_scan.PHRASES
)

_LICENSES = f"""
WITH worded AS (
    SELECT doc_id, regexp_extract_all({_LOWER}, {_SPELLED}) AS ws FROM documents
),
phrases(phrase, label) AS (VALUES {_PHRASES}),
places AS (
    SELECT doc_id, label, unnest(list_filter(range(len(ws)),
        lambda i: ws[i + 1:i + len(phrase)] = phrase)) AS place
    FROM worded, phrases
),
base AS (
    SELECT doc_id, count(*) AS n_base, min(place) AS first_word,
        max(place) AS last_word, string_agg(DISTINCT label, ',' ORDER BY label) AS labels
    FROM places GROUP BY doc_id
),
templates AS (
    SELECT k, label, width, list_distinct(regexp_extract_all(wording, {_SPELLED})) AS held
    FROM (VALUES {_TEMPLATES}) t(k, label, width, wording)
),
windows AS (
    SELECT doc_id, width, start, list_distinct(ws[start + 1:start + 2 * width]) AS held
    FROM (
        SELECT doc_id, width, ws, unnest(range(0, len(ws), width)) AS start
        FROM worded, (SELECT DISTINCT width FROM templates)
    )
),
shares AS (
    SELECT doc_id, width, start, label, len(t.held) AS size,
        len(list_intersect(w.held, t.held)) AS shared
    FROM windows w JOIN templates t USING (width)
),
links AS (
    SELECT * FROM shares WHERE 100 * shared >= {license_scan.PERCENT} * size
),
named AS (
    SELECT doc_id, label FROM links
    QUALIFY shared = max(shared) OVER (PARTITION BY doc_id, width, start)
    UNION SELECT doc_id, label FROM places
),
every AS (
    SELECT doc_id, string_agg(DISTINCT label, ',' ORDER BY label) AS labels
    FROM named GROUP BY doc_id
),
best AS (
    SELECT doc_id, max(CAST(shared AS DOUBLE) / size) AS share, count(*) AS n_blocks
    FROM links GROUP BY doc_id
)
SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_words,
    CAST(coalesce(n_base, 0) AS BIGINT) AS n_base,
    first_word, last_word, coalesce(b.labels, '') AS base_labels,
    coalesce(e.labels, '') AS labels,
    CASE WHEN n_base > 0 THEN 1.0::DOUBLE ELSE coalesce(share, 0.0::DOUBLE) END AS score,
    CAST(coalesce(n_blocks, 0) AS BIGINT) AS n_blocks
FROM worded LEFT JOIN base b USING (doc_id) LEFT JOIN every e USING (doc_id)
    LEFT JOIN best USING (doc_id)
"""

ORACLES = {
    "op5_near_duplicates": _NEAR,
    "op6_url_filter": _URLS,
    "op9_quality_rules": _RULES,
    "op10_warc_round_trip": _WARC,
    "op11_prefix_trie": _TRIE,
    "op12_license_scan": _LICENSES,
    "op13_periodic_runs": _RUNS,
}
