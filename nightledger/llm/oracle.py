"""DuckDB SQL for the operators that SQL can express, over the views `documents`, `pages` and `labels`."""

from __future__ import annotations

#: ASCII white space, as a character class.
BLANK = r"[\x20\x09-\x0D]"
NOT_BLANK = r"[^\x20\x09-\x0D]+"

WARC = """
WITH payloads AS (
    SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha1(coalesce(html, '')) AS payload_digest FROM pages
), groups AS (
    SELECT payload_digest, max(page_id) AS last_id FROM payloads WHERE payload_bytes >= 1000 GROUP BY payload_digest
)
SELECT page_id, payload_bytes, payload_digest,
    CASE WHEN page_id < last_id THEN 'revisit' ELSE 'response' END AS record_type,
    CASE WHEN page_id < last_id THEN last_id END AS refers_to
FROM payloads LEFT JOIN groups USING (payload_digest)
"""

EXACT_DEDUP = rf"""
WITH texts AS (
    SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '{BLANK}+', ' ', 'g')) AS text_sha256 FROM documents
), groups AS (
    SELECT text_sha256, min(doc_id) AS keep_id, count(*) AS group_size FROM texts GROUP BY ALL
)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, text_sha256 FROM texts JOIN groups USING (text_sha256)
"""

NEAR_DUPLICATES = rf"""
WITH RECURSIVE tokens AS (
    SELECT doc_id, regexp_extract_all(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{NOT_BLANK}') AS words
    FROM documents
), sets AS (
    SELECT doc_id, CASE WHEN len(words) = 0 THEN [] WHEN len(words) < 5 THEN [array_to_string(words, ' ')]
        ELSE list_distinct([array_to_string(words[i : i + 4], ' ') FOR i IN range(1, len(words) - 3)]) END AS shingles
    FROM tokens
), ranked AS (
    SELECT doc_id, len(shingles) AS n, shingle, count(*) OVER (PARTITION BY shingle) AS df
    FROM sets, unnest(shingles) AS t(shingle)
), ordered AS (
    SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY df, shingle) AS pos FROM ranked
), prefixes AS (
    SELECT doc_id, n, shingle FROM ordered WHERE pos <= n - ceil(0.85 * n) + 1
), candidates AS (
    SELECT DISTINCT p.doc_id AS a, q.doc_id AS b FROM prefixes p JOIN prefixes q USING (shingle)
    WHERE p.doc_id < q.doc_id AND 100 * least(p.n, q.n) >= 85 * greatest(p.n, q.n)
), links AS (
    SELECT a, b FROM (
        SELECT a, b, len(list_intersect(x.shingles, y.shingles)) AS common, len(x.shingles) + len(y.shingles) AS both_sizes
        FROM candidates JOIN sets x ON x.doc_id = a JOIN sets y ON y.doc_id = b
    ) WHERE 100 * common >= 85 * (both_sizes - common)
), edges AS (
    SELECT a, b FROM links UNION ALL SELECT b, a FROM links
), reach AS (
    SELECT doc_id, doc_id AS seen FROM sets
    UNION
    SELECT r.doc_id, e.b FROM reach r JOIN edges e ON e.a = r.seen
), found AS (
    SELECT doc_id, min(seen) AS component_id FROM reach GROUP BY doc_id
)
SELECT doc_id, len(shingles) AS n_shingles, component_id, doc_id = component_id AS kept FROM sets JOIN found USING (doc_id)
"""

LINE_DEDUP = """
WITH lines AS (
    SELECT doc_id, unnest(list) AS line, generate_subscripts(list, 1) AS line_no
    FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS list FROM documents)
), keyed AS (
    SELECT *, translate(trim(line, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
    FROM lines
), firsts AS (
    SELECT key, min(doc_id) AS first_id FROM keyed WHERE length(key) >= 10 GROUP BY key
), marked AS (
    SELECT doc_id, line, line_no, coalesce(first_id < doc_id, false) AS gone FROM keyed LEFT JOIN firsts USING (key)
)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
    sha256(coalesce(string_agg(line, chr(10) ORDER BY line_no) FILTER (NOT gone), '')) AS kept_sha256
FROM marked GROUP BY doc_id
"""


def _code_round(number: int) -> str:
    """Assignment to the codebook of this round, and the codebook after it."""
    return f"""
near{number} AS MATERIALIZED (
    SELECT rid, p, any_value(x) AS x, arg_min(e, d * 16 + e) AS e, min(d) AS d FROM (
        SELECT rid, a.p, a.x, e, CAST(list_inner_product(a.x, a.x) + list_inner_product(c, c)
            - 2 * list_inner_product(a.x, c) AS BIGINT) AS d
        FROM points a JOIN book{number} b ON a.p = b.p
    ) GROUP BY rid, p
), means{number} AS (
    SELECT p, e, list(m ORDER BY j) AS c FROM (
        SELECT p, e, j, floor(sum(x[j]) / count(*)) AS m FROM near{number}, range(1, 1 + len(x)) t(j) GROUP BY p, e, j
    ) GROUP BY p, e
), book{number + 1} AS MATERIALIZED (
    SELECT b.p, b.e, coalesce(m.c, b.c) AS c FROM book{number} b LEFT JOIN means{number} m ON m.p = b.p AND m.e = b.e
)"""


VECTOR_CODES = f"""
WITH kept AS MATERIALIZED (
    SELECT row_number() OVER (ORDER BY vec_id) AS rid, vec_id, label,
        list_transform(embedding, lambda x: floor(4096 * CAST(x AS DOUBLE))) AS v
    FROM embeddings
    WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), points AS MATERIALIZED (
    SELECT rid, p, v[p * (len(v) // 8) + 1 : (p + 1) * (len(v) // 8)] AS x FROM kept, range(8) t(p)
), book0 AS MATERIALIZED (
    SELECT p, rid - 1 AS e, x AS c FROM points WHERE rid <= 16
), {",".join(_code_round(number) for number in range(7))}
, codes AS (
    SELECT vec_id, any_value(label) AS label, string_agg(printf('%02x', CAST(e AS INTEGER)), '' ORDER BY p) AS code,
        CAST(sum(d) AS BIGINT) AS error
    FROM near6 JOIN kept USING (rid) GROUP BY rid, vec_id
), books AS (
    SELECT sha256(string_agg(CAST(CAST(c[j] AS BIGINT) AS VARCHAR), ',' ORDER BY p, e, j)) AS codebooks_sha256
    FROM book6, range(1, 1 + len(c)) t(j)
)
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, codebooks_sha256
FROM codes, books
"""


def _dearer(value: str, cost: str, edits: str) -> str:
    """A path (nine digits of cost, then edits) with more cost and edits; null stays null."""
    return f"(lpad(CAST(CAST({value}[1:9] AS BIGINT) + {cost} AS VARCHAR), 9, '0') || {value}[10:] || '{edits}')"


#: Paths after inserts before the next turn, by state: nothing yet, after s, after u, after a.
_W2 = f"least(v2, {_dearer('v0', '2', 'I')}, {_dearer('v1', '2', 'I')}, {_dearer('v3', '2', 'I')})"
_W3 = f"least(v3, {_dearer('w2', '2', 'I')})"

CONVERSATIONS = rf"""
WITH RECURSIVE crc_table AS (
    SELECT list(c ORDER BY n) AS codes FROM (
        SELECT n, list_reduce(list_prepend(n, [0, 0, 0, 0, 0, 0, 0, 0]),
            lambda c, x: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS c
        FROM range(256) t(n)
    )
), harmed AS (
    SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
        xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT),
            list_transform(string_split(coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' '), ''),
                lambda x: CAST(ascii(x) AS BIGINT))),
            lambda c, b: xor(c >> 8, codes[(xor(c, b) & 255) + 1])), 4294967295) % 20 AS harm
    FROM conversations, crc_table
), turns AS (
    SELECT conv_id, turn, CASE WHEN harm = 4 THEN 'user' ELSE role END AS role,
        CASE harm WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text
    FROM harmed, range(2) copies(copy) WHERE harm != 0 AND (copy = 0 OR harm = 3)
), ordered AS (
    SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, sha256(text)) AS i,
        rtrim(text, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS trimmed
    FROM turns
), told AS (
    SELECT *, row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 AS repeated FROM ordered
), faulty AS (
    SELECT *, CASE WHEN trimmed = '' THEN 'blank' WHEN repeated THEN 'duplicate'
        WHEN right(trimmed, 1) NOT IN ('.', '!', '?') THEN 'truncated' ELSE '' END AS fault,
        lag(left(role, 1)) OVER (PARTITION BY conv_id ORDER BY i) || left(role, 1) AS pair
    FROM told
), facts AS (
    SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
        count(*) FILTER (fault = 'blank') AS blank, count(*) FILTER (fault = 'duplicate') AS duplicate,
        count(*) FILTER (fault = 'truncated') AS truncated, count(*) FILTER (pair NOT IN ('su', 'ua', 'au')) AS illegal,
        count(*) AS n
    FROM faulty GROUP BY conv_id
), paths AS (
    SELECT conv_id, CAST(0 AS BIGINT) AS pos, '000000000' AS v0, CAST(NULL AS VARCHAR) AS v1, CAST(NULL AS VARCHAR) AS v2,
        CAST(NULL AS VARCHAR) AS v3
    FROM facts
    UNION ALL
    SELECT conv_id, i, {_dearer('v0', '3', 'D')},
        least({_dearer('v1', '3', 'D')}, CASE WHEN stays AND initial = 's' THEN {_dearer('v0', 'more', 'K')} END),
        least({_dearer('w2', '3', 'D')},
            CASE WHEN stays AND initial = 'u' THEN
                least({_dearer('v0', 'more', 'K')}, {_dearer('v1', 'more', 'K')}, {_dearer('w3', 'more', 'K')}) END,
            CASE WHEN stays THEN
                least({_dearer('v0', '2 + more', 'R')}, {_dearer('v1', '2 + more', 'R')}, {_dearer('w3', '2 + more', 'R')}) END),
        least({_dearer('w3', '3', 'D')},
            CASE WHEN stays AND initial = 'a' THEN {_dearer('w2', 'more', 'K')} END,
            CASE WHEN stays THEN {_dearer('w2', '2 + more', 'R')} END)
    FROM (
        SELECT *, {_W3} AS w3 FROM (
            SELECT p.*, {_W2} AS w2, f.i, fault NOT IN ('blank', 'duplicate') AS stays, left(role, 1) AS initial,
                CASE WHEN fault = 'truncated' THEN 1 ELSE 0 END AS more
            FROM paths p JOIN faulty f ON f.conv_id IS NOT DISTINCT FROM p.conv_id AND f.i = p.pos + 1
        )
    )
), best AS (
    SELECT conv_id, CAST(path[1:9] AS BIGINT) AS cost, path[10:] AS audit FROM (
        SELECT conv_id, least(v0, {_W3}) AS path FROM (SELECT *, {_W2} AS w2 FROM paths) JOIN facts USING (conv_id) WHERE pos = n
    )
), replay AS (
    SELECT conv_id, audit, CAST(0 AS BIGINT) AS pos, 0 AS state, CAST([] AS VARCHAR[]) AS lines FROM best
    UNION ALL
    SELECT r.conv_id, audit[2:], CASE WHEN audit[1] = 'I' THEN r.pos ELSE r.pos + 1 END,
        CASE audit[1] WHEN 'D' THEN state WHEN 'K' THEN CASE left(role, 1) WHEN 's' THEN 1 WHEN 'u' THEN 2 ELSE 3 END
            ELSE CASE state WHEN 2 THEN 3 ELSE 2 END END,
        CASE audit[1] WHEN 'D' THEN lines WHEN 'K' THEN list_append(lines, role || ':' || text)
            ELSE list_append(lines, CASE state WHEN 2 THEN 'assistant:' ELSE 'user:' END || CASE audit[1] WHEN 'R' THEN text ELSE '' END) END
    FROM replay r LEFT JOIN ordered o ON o.conv_id IS NOT DISTINCT FROM r.conv_id AND o.i = r.pos + 1
    WHERE audit != ''
), repaired AS (
    SELECT conv_id, sha256(array_to_string(lines, chr(10))) AS repaired_sha256 FROM replay WHERE audit = ''
), ids AS (
    SELECT DISTINCT conv_id FROM conversations
)
SELECT i.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
    coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, coalesce(cost, 0) AS cost,
    coalesce(audit, '') AS audit, coalesce(repaired_sha256, sha256('')) AS repaired_sha256
FROM ids i LEFT JOIN facts f ON f.conv_id IS NOT DISTINCT FROM i.conv_id
LEFT JOIN best b ON b.conv_id IS NOT DISTINCT FROM i.conv_id
LEFT JOIN repaired r ON r.conv_id IS NOT DISTINCT FROM i.conv_id
"""
