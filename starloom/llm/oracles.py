"""DuckDB SQL for the operators, or the columns of operators, that SQL can express."""

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

# CRC-32 of every distinct word, folded over its bytes with the usual table, which the
# first statement makes from the polynomial.
OP11 = rf"""
WITH RECURSIVE
steps(b, k, c) AS (
    SELECT b, 0, b FROM (SELECT range AS b FROM range(256))
    UNION ALL
    SELECT b, k + 1, CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END
    FROM steps WHERE k < 8
),
crc_table AS (SELECT list(c ORDER BY b) AS own FROM steps WHERE k = 8),
words AS (
    SELECT 0 AS target, doc_id, unnest(regexp_extract_all(translate(text, '{_UPPER}', '{_LOWER}'),
        '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) AS word FROM documents
    UNION ALL
    SELECT 1, NULL, unnest(regexp_extract_all(translate(text, '{_UPPER}', '{_LOWER}'),
        '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) FROM benchmark
),
bytes AS (
    SELECT word, list_transform(string_split(rtrim(regexp_replace(hex(encode(word)), '(..)', '\1 ', 'g')), ' '),
        lambda x: CAST('0x' || x AS BIGINT)) AS own
    FROM (SELECT DISTINCT word FROM words)
),
buckets AS (
    SELECT word, xor(list_reduce(list_prepend(4294967295::BIGINT, bytes.own),
        lambda c, x: xor(c >> 8, crc_table.own[xor(c & 255, x) + 1])), 4294967295) % 10000 AS bucket
    FROM bytes, crc_table
),
features AS (SELECT target, doc_id, bucket FROM words JOIN buckets USING (word)),
counts AS (
    SELECT b.range AS bucket,
        coalesce(count(*) FILTER (target = 0), 0)::DOUBLE AS s,
        coalesce(count(*) FILTER (target = 1), 0)::DOUBLE AS t
    FROM range(10000) b LEFT JOIN features f ON f.bucket = b.range GROUP BY b.range
),
gains AS (
    SELECT bucket, floor(1000 * ln((t + 1) * (sum(s) OVER () + 10000)
        / ((s + 1) * (sum(t) OVER () + 10000))))::BIGINT AS gain FROM counts
),
weighed AS (
    SELECT d.doc_id, coalesce(w.n_features, 0) AS n_features, coalesce(w.weight, 0) AS weight
    FROM documents d LEFT JOIN (
        SELECT doc_id, count(*) AS n_features,
            (sum(gain) - (((sum(gain) % count(*)) + count(*)) % count(*))) // count(*) AS weight
        FROM features JOIN gains USING (bucket) WHERE target = 0 GROUP BY doc_id
    ) w USING (doc_id)
),
scored AS (
    SELECT *, weight + floor(-1000 * ln(-ln((
        CAST('0x' || substr(sha256('2024:' || doc_id), 1, 8) AS BIGINT) + 0.5::DOUBLE) / 4294967296)))::BIGINT AS score
    FROM weighed
),
placed AS (
    SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS place,
        10 * count(*) OVER () // 100 AS size
    FROM scored WHERE n_features >= 20
)
SELECT doc_id, n_features::BIGINT AS n_features, weight::BIGINT AS weight, score::BIGINT AS score,
    CASE WHEN place <= size THEN place END::BIGINT AS rank
FROM scored LEFT JOIN placed USING (doc_id)
"""

OP12 = r"""
WITH cut AS (
    SELECT doc_id, coalesce(text, '') AS whole, sha256('1:' || doc_id) AS h,
        regexp_extract_all(coalesce(text, ''), '[A-Za-z]+|[^A-Za-z]') AS units FROM documents
),
drawn AS (
    SELECT *, len(units) AS n,
        CAST('0x' || substr(h, 1, 8) AS BIGINT) % (len(units) + 1) AS a,
        CAST('0x' || substr(h, 9, 8) AS BIGINT) % (len(units) + 1) AS b,
        CAST('0x' || substr(h, 17, 8) AS BIGINT) % 100 AS c,
        CAST('0x' || substr(h, 25, 8) AS BIGINT) % 100 AS d
    FROM cut
),
formed AS (
    SELECT *, CASE WHEN whole = '' OR contains(whole, '<P>') OR contains(whole, '<S>')
            OR contains(whole, '<M>') OR c >= 90 THEN 'plain'
        WHEN d < 20 THEN 'spm' ELSE 'psm' END AS form,
        array_to_string(units[1 : least(a, b)], '') AS prefix,
        array_to_string(units[least(a, b) + 1 : greatest(a, b)], '') AS middle,
        array_to_string(units[greatest(a, b) + 1 : len(units)], '') AS suffix
    FROM drawn
)
SELECT doc_id, n::BIGINT AS n, form,
    CASE WHEN form <> 'plain' THEN length(prefix) END::BIGINT AS prefix_chars,
    CASE WHEN form <> 'plain' THEN length(middle) END::BIGINT AS middle_chars,
    sha256(CASE form WHEN 'plain' THEN whole
        WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
        ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256,
    sha256(whole) AS restored_sha256
FROM formed
"""

# The base patterns' names stand in either case as classes, as case folding is wider here.
_NAMES = "|".join(
    "".join(f"[{x.upper()}{x}]" if x.isalpha() else x for x in name)
    for name in ("password", "passwd", "secret", "token", "api_?key")
)
_VALUE = "[A-Za-z0-9+/_.=-]+"
_PATTERNS = (
    (0, "assign", rf"(?:{_NAMES})[\"'']?\x20*[:=]\x20*[\"'']?{_VALUE}"),
    (1, "access", "AKIA[A-Z0-9]+"),
    (2, "hex", "[0-9a-f]+"),
)


def _marked(number: int, kind: str, pattern: str) -> str:
    """Matches between U+E000 and U+E001, split there, so that places can be added up."""
    value = f"length(regexp_extract(own, '(?:{_NAMES})[\"'']?\\x20*[:=]\\x20*[\"'']?({_VALUE})', 1)) >= 6"
    able = {"assign": value, "access": "length(own) >= 20", "hex": "length(own) >= 24"}[kind]
    return f"""
    SELECT doc_id, {number} AS place, '{kind}' AS kind, start, start + length(own) AS stop FROM (
        SELECT doc_id, string_split(piece, chr(57345))[1] AS own,
            sum(length(replace(piece, chr(57345), ''))) OVER (PARTITION BY doc_id ORDER BY k
                ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)::BIGINT AS start, k
        FROM (
            SELECT doc_id, unnest(pieces) AS piece, generate_subscripts(pieces, 1) AS k FROM (
                SELECT doc_id, string_split(regexp_replace(text, '({pattern})',
                    chr(57344) || '\\1' || chr(57345), 'g'), chr(57344)) AS pieces FROM documents
            )
        )
    ) WHERE k > 1 AND {able}"""


SECRET_BASE = f"""
WITH spans AS ({" UNION ALL ".join(_marked(*p) for p in _PATTERNS)}),
listed AS (
    SELECT doc_id, string_agg(kind || ':' || start || ':' || stop, ',' ORDER BY start, place) AS own,
        count(*) FILTER (place = 0) AS n_assign, count(*) FILTER (place = 1) AS n_access,
        count(*) FILTER (place = 2) AS n_hex
    FROM spans GROUP BY doc_id
)
SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access,
    coalesce(n_hex, 0) AS n_hex, sha256(coalesce(own, '')) AS base_sha256
FROM documents LEFT JOIN listed USING (doc_id)
"""

# Forty hexadecimal digits as 32 of base 32, five by five.
_BASE32 = " || ".join(
    f"substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', "
    f"CAST((CAST('0x' || substr(digest, {5 * k + 1}, 5) AS BIGINT) >> {shift}) & 31 AS INTEGER) + 1, 1)"
    for k in range(8)
    for shift in (15, 10, 5, 0)
)
OP6 = f"""
WITH payloads AS (
    SELECT page_id, url, coalesce(html, '') AS payload, sha1(coalesce(html, '')) AS digest FROM pages
),
firsts AS (SELECT *, min(page_id) OVER (PARTITION BY payload) AS first FROM payloads)
SELECT page_id, octet_length(encode(payload))::BIGINT AS payload_bytes, {_BASE32} AS payload_digest,
    CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
    CASE WHEN page_id <> first THEN first END AS refers_to, url
FROM firsts
"""

_WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"
QUALITY_BASE = rf"""
WITH texts AS (SELECT doc_id, coalesce(text, '') AS text, {_WORDS} AS words FROM documents),
windows AS (
    SELECT doc_id, k, words[k : k + 2] AS own
    FROM (SELECT doc_id, words, unnest(range(1, greatest(len(words) - 1, 1))) AS k FROM texts)
),
repeated AS (
    SELECT doc_id, count(DISTINCT place) AS n FROM (
        SELECT doc_id, unnest([k, k + 1, k + 2]) AS place FROM (
            SELECT doc_id, k, count(*) OVER (PARTITION BY doc_id, own) AS times FROM windows
        ) WHERE times > 1
    ) GROUP BY doc_id
),
lines AS (
    SELECT doc_id, count(*) - count(DISTINCT line) AS n FROM (
        SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM texts
    ) WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY doc_id
),
counted AS (
    SELECT doc_id, len(words)::BIGINT AS n_words,
        length(array_to_string(words, ''))::BIGINT AS word_chars,
        length(regexp_replace(text, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols,
        coalesce(l.n, 0)::BIGINT AS n_dup_lines, coalesce(r.n, 0)::BIGINT AS n_repeat_words
    FROM texts LEFT JOIN lines l USING (doc_id) LEFT JOIN repeated r USING (doc_id)
)
SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM counted
"""

MIX_SIZES = rf"""
SELECT doc_id, len({_WORDS})::BIGINT AS size,
    sum(len({_WORDS})) OVER (PARTITION BY source)::BIGINT AS source_size FROM documents
"""

ORACLES: dict[str, str] = {
    "op6_warc": OP6,
    "op11_importance": OP11,
    "op12_fill_middle": OP12,
    "secret_base_spans": SECRET_BASE,
    "quality_base_counts": QUALITY_BASE,
    "mix_sizes": MIX_SIZES,
}
