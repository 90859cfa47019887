"""DuckDB SQL for the queries that SQL can express over whole tables."""

from __future__ import annotations

from rateflow.llm.license_scan import COPYRIGHT_LINE, EQUIVALENT, KNOWN_TEXTS, SIGNS


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _replaced(expression: str, pattern: str, instead: str) -> str:
    instead = instead.replace("$", "\\")
    return f"regexp_replace({expression}, {_quoted(pattern)}, {_quoted(instead)}, 'g')"


def _spelled(expression: str) -> str:
    for pattern, instead in EQUIVALENT:
        expression = _replaced(expression, pattern, instead)
    return expression


def _license_scan() -> str:
    lines = _spelled(_replaced(_replaced("lower(text)", COPYRIGHT_LINE, ""), SIGNS, " "))
    whole = f"trim({_spelled(_replaced('form', '[ \\n]+', ' '))})"
    known = ", ".join(f"({_quoted(name)}, {_quoted(text)})" for name, text in KNOWN_TEXTS)
    return f"""
WITH known AS (
    SELECT sha256({whole}) AS digest, min(license) AS license
    FROM (SELECT license, {lines} AS form FROM (VALUES {known}) AS k(license, text))
    GROUP BY 1
), forms AS (
    SELECT doc_id, {lines} AS form
    FROM (SELECT doc_id, coalesce(text, '') AS text FROM documents)
), whole AS (
    SELECT doc_id, sha256({whole}) AS digest, count(*) AS n_rows FROM forms GROUP BY 1, 2
), lines AS (
    SELECT doc_id, sha256(trim(line)) AS digest
    FROM (SELECT doc_id, unnest(string_split(form, chr(10))) AS line FROM forms)
), notices AS (
    SELECT doc_id, count(*) AS n_notices,
        array_to_string(list_sort(list(DISTINCT license)), ',') AS notices
    FROM lines JOIN known USING (digest) GROUP BY 1
)
SELECT doc_id, n_rows, digest, license, coalesce(n_notices, 0) AS n_notices,
    coalesce(notices, '') AS notices
FROM whole LEFT JOIN known USING (digest) LEFT JOIN notices USING (doc_id)
"""


# All pairs of a label, then components by the smallest id over shortest walks.
_EMBEDDING_DEDUP = """
WITH RECURSIVE usable AS (
    SELECT vec_id, label, embedding::DOUBLE[] AS v
    FROM embeddings
    WHERE vec_id IS NOT NULL AND label IS NOT NULL AND len(embedding) > 0
        AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
        AND len(list_filter(embedding, lambda x: x <> 0)) > 0
), links AS (
    SELECT a.vec_id AS a, b.vec_id AS b
    FROM usable a JOIN usable b ON a.label = b.label AND a.vec_id <> b.vec_id
        AND len(a.v) = len(b.v)
    WHERE list_cosine_similarity(a.v, b.v) >= 0.98
), reach(a, b) AS (
    SELECT vec_id, vec_id FROM embeddings
    UNION
    SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a
), counted AS (
    SELECT a, count(*) AS n FROM links GROUP BY a
), lowest AS (
    SELECT a, min(b) AS component_id FROM reach GROUP BY a
)
SELECT vec_id, coalesce(n, 0) AS n_links, component_id, vec_id = component_id AS kept
FROM embeddings JOIN lowest ON vec_id = lowest.a LEFT JOIN counted ON vec_id = counted.a
"""


# formatted_chars by the template: marks, role, escaped text. The escape doubles
# backslashes and adds one for each place where a control string begins.
_CHAT_FORMAT = r"""
WITH turns AS (
    SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
    UNION ALL VALUES (-7, 0, 'user', '</s>[INST] ok [/INST]'),
        (-7, 1, 'assistant', '</s>[INST] ok [/INST]')
), sized AS (
    SELECT *, length(role) + length(text)
        + length(text) - length(replace(text, '\', ''))
        + len(regexp_extract_all(text, '(?i)<\||\|>|</?s>|\[/?INST\]|<</?SYS>>|<(start|end)_of_turn>'
            || '|<(unk|pad|bos|eos)>|\[(PAD|SEP|CLS|UNK|MASK)\]'))
        + length('<|im_start|>') + 1 + length('<|im_end|>') + 1 AS n
    FROM turns
)
SELECT conv_id, count(*) AS n_turns,
    sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn)) AS turns_sha256,
    coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
    sha256(coalesce(string_agg(text, '' ORDER BY turn) FILTER (role = 'assistant'), '')) AS loss_sha256,
    sum(n)::BIGINT AS formatted_chars
FROM sized GROUP BY conv_id
"""


_WARC_BUNDLES = """
WITH payloads AS (
    SELECT page_id, octet_length(encode(coalesce(html, ''))) AS payload_bytes,
        sha256(coalesce(html, '')) AS payload_digest
    FROM pages
), firsts AS (
    SELECT payload_digest, min(page_id) AS first_id
    FROM payloads WHERE payload_bytes >= 100 GROUP BY 1
)
SELECT page_id, payload_bytes, payload_digest,
    CASE WHEN first_id IS DISTINCT FROM page_id AND first_id IS NOT NULL
        THEN 'revisit' ELSE 'response' END AS record_type,
    CASE WHEN first_id IS DISTINCT FROM page_id THEN first_id END AS refers_to
FROM payloads LEFT JOIN firsts USING (payload_digest)
"""


ORACLE_SQL: dict[str, str] = {
    "op1_embedding_near_dedup": _EMBEDDING_DEDUP,
    "op8_chat_formatting": _CHAT_FORMAT,
    "op10_license_scans": _license_scan(),
    "op12_warc_bundles": _WARC_BUNDLES,
}
