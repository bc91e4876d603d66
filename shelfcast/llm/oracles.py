"""DuckDB SQL for those queries that SQL can express."""

from __future__ import annotations

#: ``crc_table``: the 256 entries of CRC-32, from its polynomial.
_CRC_TABLE = """
crc_table AS (
  SELECT list(list_reduce(range(0, 9)::BIGINT[], lambda c, k:
           CASE WHEN k = 0 THEN c
                WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, b::BIGINT)
         ORDER BY b) AS entries
  FROM range(256) t(b))"""


def crc32_of(text: str) -> str:
    """SQL for the unsigned CRC-32 of a text's UTF-8 bytes; needs ``crc_table`` in the FROM clause."""
    digits = f"hex(encode({text}))"
    byte = f"('0x' || substr({digits}, 2 * i + 1, 2))::BIGINT"
    return f"""xor(4294967295, list_reduce(
        list_transform(range(0, octet_length(encode({text}))), lambda i: {byte}),
        lambda c, b: xor(c >> 8, entries[(xor(c, b) & 255) + 1]), 4294967295::BIGINT))"""


def _winner(shards: int) -> str:
    """SQL for the shard with the highest rendezvous score, all weights equal."""
    unit = "('0x' || substr(md5(record || '#' || j), 1, 13))::BIGINT + 0.5"
    return f"""list_reduce(list_transform(range(0, {shards}), lambda j:
        {{'s': -1.0 / ln(({unit}) / 4503599627370496.0), 'i': -j}}), lambda a, b: greatest(a, b))"""


_OP7 = f"""
WITH {_CRC_TABLE.strip()},
keyed AS (
  SELECT doc_id, coalesce(text, '') AS text, coalesce('=' || doc_id, '-') AS record FROM documents),
placed AS (
  SELECT doc_id, (octet_length(encode(text)) + 8)::BIGINT AS size,
    ({crc32_of("text")})::BIGINT AS text_crc32,
    ({_winner(24)}).i * -1 AS shard, ({_winner(25)}).i * -1 AS grown_shard
  FROM keyed, crc_table)
SELECT doc_id, size, text_crc32, 'key' AS law, shard::INTEGER AS shard,
  row_number() OVER (PARTITION BY shard ORDER BY
    md5(coalesce('=' || doc_id, '-') || chr(31) || '=' || text_crc32 || chr(31) || '=' || size)[:13],
    doc_id, text_crc32, size) - 1 AS slot,
  grown_shard::INTEGER AS grown_shard
FROM placed
"""

_SPACE = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"

_OP3 = f"""
WITH lines AS (
  SELECT row_number() OVER () AS doc, doc_id, string_split(coalesce(text, ''), chr(10)) AS parts FROM documents),
split AS (
  SELECT doc, doc_id, unnest(parts) AS line, generate_subscripts(parts, 1) AS position FROM lines),
keyed AS (
  SELECT *, translate(trim(line, {_SPACE}), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
  FROM split),
common AS (
  SELECT key, max(doc_id) AS largest FROM keyed WHERE length(key) >= 20
  GROUP BY key HAVING count(DISTINCT doc_id) >= 3),
decided AS (
  SELECT k.*, c.key IS NOT NULL AND k.doc_id <> c.largest AS gone FROM keyed k LEFT JOIN common c USING (key))
SELECT doc_id, count(*)::BIGINT AS n_lines, count(*) FILTER (WHERE gone)::BIGINT AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY position) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM decided GROUP BY doc, doc_id
"""

_OP13 = r"""
WITH docs AS (
  SELECT row_number() OVER () AS id, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
    coalesce(text, '') AS text FROM documents),
words AS (
  SELECT id, lang, source, translate(unnest(regexp_extract_all(text, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS term FROM docs),
counts AS (SELECT lang, source, term, count(*) AS n FROM words GROUP BY ALL),
kept AS (
  SELECT lang, term, count(*) AS lang_n FROM words GROUP BY lang, term HAVING count(DISTINCT id) >= 3),
languages AS (SELECT lang, count(*)::HUGEINT AS v, sum(lang_n)::HUGEINT AS lang_total FROM kept GROUP BY lang),
groups AS (SELECT DISTINCT lang, source FROM docs),
cells AS (
  SELECT g.lang, g.source, k.term, k.lang_n, coalesce(c.n, 0)::HUGEINT AS n
  FROM groups g JOIN kept k ON g.lang = k.lang
  LEFT JOIN counts c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term),
smoothed AS (
  SELECT lang, source, term, n,
    1 + (1000000000 * (n + 1)) // (sum(n) OVER (PARTITION BY lang, source) + v) AS p,
    1 + (1000000000::HUGEINT * (lang_n + 1)) // (lang_total + v) AS q
  FROM cells JOIN languages USING (lang)),
pairs AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item,
    coalesce(s.value, 0)::BIGINT AS value
  FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN (
    SELECT x.lang, x.source, y.source AS item, sum(((x.p - y.p) * (x.p - y.p)) // y.p) AS value
    FROM smoothed x JOIN smoothed y ON x.lang = y.lang AND x.term = y.term AND x.source <> y.source
    GROUP BY ALL) s ON s.lang = a.lang AND s.source = a.source AND s.item = b.source),
terms AS (
  SELECT lang, source, 'term' AS part, term AS item, (((p - q) * (p - q)) // q)::BIGINT AS value
  FROM smoothed WHERE n > 0 AND p > q),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item)::INTEGER AS rank
  FROM (SELECT * FROM pairs UNION ALL SELECT * FROM terms))
SELECT lang, source, part, item, value, rank FROM ranked WHERE part = 'pair' OR rank <= 200
"""

ORACLES: dict[str, str] = {
    "op3_line_dedup": _OP3,
    "op7_rendezvous_sharding": _OP7,
    "op13_source_divergence": _OP13,
}
