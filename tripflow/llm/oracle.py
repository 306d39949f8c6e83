"""DuckDB SQL for the operators that SQL can express."""

from __future__ import annotations

from tripflow.llm import line_dedup, mixing, near_dedup, quality_rules, resampling, warc

_WORDS = r"regexp_extract_all(coalesce({}, ''), '[^\x20\x09-\x0D]+')"
_BLANKS = r"chr(32)||chr(9)||chr(10)||chr(11)||chr(12)||chr(13)"

OP1 = f"""
WITH lines AS (
  SELECT doc_id, text, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
         generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS nr
  FROM documents
), held AS (
  SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY nr) - 1 AS pos
  FROM lines WHERE length(translate(line, {_BLANKS}, '')) > 0
), runs AS (
  SELECT doc_id, pos, {line_dedup.WINDOW} AS n, list(line) OVER w AS body, count(*) OVER w AS have
  FROM held WINDOW w AS (PARTITION BY doc_id ORDER BY pos ROWS BETWEEN CURRENT ROW AND {line_dedup.WINDOW - 1} FOLLOWING)
  UNION ALL
  SELECT doc_id, pos, 1, [line], {line_dedup.WINDOW} FROM held
  WHERE len({_WORDS.format("line")}) >= {line_dedup.LONG_LINE_WORDS}
), marked AS (
  SELECT *, row_number() OVER (PARTITION BY n, body ORDER BY doc_id, pos) > 1 AS again
  FROM runs WHERE have = {line_dedup.WINDOW}
), gone AS (
  SELECT DISTINCT doc_id, pos + k AS pos FROM (
    SELECT doc_id, pos, unnest(range(n)) AS k FROM marked WHERE again)
), kept AS (
  SELECT h.doc_id, count(g.pos) AS n_deleted, count(*) AS n_lines,
         coalesce(string_agg(CASE WHEN g.pos IS NULL THEN line END, chr(10) ORDER BY h.pos), '') AS left_text
  FROM held h LEFT JOIN gone g ON g.doc_id = h.doc_id AND g.pos = h.pos GROUP BY h.doc_id
)
SELECT d.doc_id, coalesce(n_lines, 0) AS n_lines, coalesce(n_deleted, 0) AS n_deleted,
       CASE WHEN coalesce(n_deleted, 0) = 0 THEN text ELSE left_text END AS text
FROM documents d LEFT JOIN kept k ON k.doc_id = d.doc_id
"""

OP2 = f"""
WITH sized AS (
  SELECT doc_id, source, len({_WORDS.format("text")})::BIGINT AS size,
         ('0x' || substr(md5('{mixing.SEED}|' || coalesce(doc_id::VARCHAR, '') || '|' || coalesce(text, '')), 1, 15))::BIGINT AS h
  FROM documents
), totals AS (
  SELECT source, sum(size)::BIGINT AS source_size,
         [5, 2, 1][((row_number() OVER (ORDER BY source NULLS LAST)) - 1)::INT % 3 + 1] AS w
  FROM sized GROUP BY source
), running AS (
  SELECT *, 2 * source_size AS cap, sum(source_size) OVER () * 1.5::DOUBLE AS total,
         coalesce(sum(2 * source_size) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS below,
         sum(w) OVER (o ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS rest
  FROM totals WINDOW o AS (ORDER BY (2 * source_size)::DOUBLE / w, source NULLS LAST)
), filled AS (
  SELECT *, below * w + cap * rest <= total * w AS is_full FROM running
), targets AS (
  SELECT source, source_size, CASE WHEN is_full THEN cap::DOUBLE ELSE
    (total - coalesce(sum(CASE WHEN is_full THEN cap END) OVER (), 0)::DOUBLE)
      / sum(CASE WHEN NOT is_full THEN w END) OVER ()::DOUBLE * w END AS target
  FROM filled
), summed AS (
  SELECT s.*, source_size, target,
         sum(size) OVER (PARTITION BY s.source ORDER BY h RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS upto,
         sum(size) OVER (PARTITION BY s.source, h) AS same
  FROM sized s JOIN targets t ON s.source IS NOT DISTINCT FROM t.source
)
SELECT doc_id, size, source_size, target, (size * (
    (greatest(0, target) >= source_size OR upto * 2 - same <= 2 * greatest(0, target))::INT
  + (greatest(0, target - source_size) >= source_size OR upto * 2 - same <= 2 * greatest(0, target - source_size))::INT
  ))::BIGINT AS taken
FROM summed
"""

_BASE32 = " || ".join(f"to_base(('0x' || substr(s, {1 + 5 * k}, 5))::BIGINT, 32, 4)" for k in range(8))
_DIGITS = "'0123456789ABCDEFGHIJKLMNOPQRSTUV', 'ABCDEFGHIJKLMNOPQRSTUVWXYZ234567'"
OP3 = f"""
WITH data AS (
  SELECT page_id, url, coalesce(html, '') AS html, encode(coalesce(html, '')) AS body, sha1(coalesce(html, '')) AS s FROM pages
), firsts AS (
  SELECT *, min(page_id) OVER (PARTITION BY body) AS first_id FROM data
), described AS (
  SELECT page_id, url, html, octet_length(body)::BIGINT AS payload_bytes,
         translate(upper({_BASE32}), {_DIGITS}) AS payload_digest,
         CASE WHEN page_id = first_id THEN 'response' ELSE 'revisit' END AS record_type,
         CASE WHEN page_id <> first_id THEN first_id END AS refers_to
  FROM firsts
)
SELECT page_id, payload_bytes, payload_digest, record_type, refers_to,
       sha256(concat(
         E'WARC/1.1\\r\\nWARC-Type: ', record_type,
         E'\\r\\nWARC-Record-ID: <urn:page:', page_id, E':1>\\r\\nWARC-Date: {warc.DATE}\\r\\nWARC-Target-URI: ',
         replace(replace(coalesce(url, ''), E'\\r', '%0D'), E'\\n', '%0A'),
         E'\\r\\nWARC-Payload-Digest: sha1:', payload_digest,
         CASE WHEN refers_to IS NULL THEN E'\\r\\nContent-Type: text/html; charset=utf-8'
              ELSE concat(E'\\r\\nWARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest',
                          E'\\r\\nWARC-Refers-To: <urn:page:', refers_to, ':1>') END,
         E'\\r\\nContent-Length: ', CASE WHEN refers_to IS NULL THEN payload_bytes ELSE 0 END, E'\\r\\n\\r\\n',
         CASE WHEN refers_to IS NULL THEN html ELSE '' END, E'\\r\\n\\r\\n')) AS record_sha256
FROM described
"""

_N = near_dedup.SHINGLE_WORDS
OP4 = f"""
WITH RECURSIVE words AS (
  SELECT doc_id, {_WORDS.format("translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')")} AS w
  FROM documents
), shingles AS (
  SELECT DISTINCT doc_id, array_to_string(w[i : i + {_N - 1}], ' ') AS s
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - {_N - 2}, 2))) AS i FROM words WHERE len(w) > 0)
), sizes AS (
  SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id
), common AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS n
  FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY ALL
), links AS (
  SELECT a, b FROM common c JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b
  WHERE 100 * c.n >= {near_dedup.PERCENT} * (x.n + y.n - c.n)
), sides AS (SELECT a, b FROM links UNION SELECT b, a FROM links),
reach AS (
  SELECT a AS doc_id, b AS other FROM sides
  UNION SELECT r.doc_id, e.b FROM reach r JOIN sides e ON e.a = r.other
), least_id AS (SELECT doc_id, min(other) AS m FROM reach GROUP BY doc_id)
SELECT d.doc_id, coalesce(n, 0) AS n_shingles, least(d.doc_id, coalesce(m, d.doc_id)) AS component_id,
       least(d.doc_id, coalesce(m, d.doc_id)) = d.doc_id AS kept
FROM documents d LEFT JOIN sizes USING (doc_id) LEFT JOIN least_id USING (doc_id)
"""

_STOPS = ", ".join(f"'{w}'" for w in dict.fromkeys(quality_rules.STOP_WORDS))
_RATIOS = {
    "mean_word_chars": "word_chars / n_words",
    "symbol_ratio": "n_symbols / n_words",
    "stop_word_ratio": "n_stop / n_words",
    "dup_line_ratio": "n_dup_lines / n_lines",
}
_BROKEN = " OR ".join(
    f"coalesce({_RATIOS[measure]} {sign} {bound}, false)"
    for _, measure, least, most in quality_rules.RULES
    for sign, bound in (("<", least), (">", most))
    if bound is not None
)
OP7 = f"""
WITH base AS (
  SELECT doc_id, coalesce(text, '') AS t, {_WORDS.format("text")} AS w,
         list_filter(string_split(coalesce(text, ''), chr(10)), lambda l: length(translate(l, {_BLANKS}, '')) > 0) AS ls
  FROM documents
), windows AS (
  SELECT doc_id, i, w[i] AS x, w[i + 1] AS y, w[i + 2] AS z
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 1)) AS i FROM base WHERE len(w) >= 3)
), again AS (
  SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, x, y, z) AS n FROM windows) WHERE n > 1
), covered AS (
  SELECT doc_id, count(DISTINCT i + k) AS n FROM (SELECT doc_id, i, unnest([0, 1, 2]) AS k FROM again) GROUP BY doc_id
), counted AS (
  SELECT b.doc_id, len(w)::BIGINT AS n_words, length(translate(t, {_BLANKS}, ''))::BIGINT AS word_chars,
         (length(t) - length(translate(t, '{quality_rules.SYMBOLS}', '')))::BIGINT AS n_symbols,
         (len(ls) - len(list_distinct(ls)))::BIGINT AS n_dup_lines, len(ls)::BIGINT AS n_lines,
         coalesce(n, 0)::BIGINT AS n_repeat_words,
         len(list_filter(w, lambda x: lower(x) IN ({_STOPS})))::BIGINT AS n_stop
  FROM base b LEFT JOIN covered c ON c.doc_id = b.doc_id
), judged AS (
  SELECT *, n_words < {quality_rules.MIN_WORDS}
         OR 100 * n_repeat_words > {quality_rules.MAX_REPEAT_PERCENT} * n_words AS base_failed
  FROM counted
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND NOT ({_BROKEN}) AS kept
FROM judged
"""

# CRC-32 by its table: 8 shifts make the step of a byte, the steps of a word's bytes its checksum.
OP11 = rf"""
WITH RECURSIVE texts AS (
  SELECT 's' AS kind, doc_id, text FROM documents UNION ALL SELECT 't', NULL, text FROM benchmark
), words AS (
  SELECT kind, doc_id, unnest(regexp_extract_all(translate(coalesce(text, ''),
           'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) AS word
  FROM texts
), shifts AS (
  SELECT b, 0 AS k, b::BIGINT AS c FROM range(256) AS r(b)
  UNION ALL
  SELECT b, k + 1, xor(c >> 1, 3988292384 * (c & 1)) FROM shifts WHERE k < 8
), steps AS (
  SELECT list(c ORDER BY b) AS step FROM shifts WHERE k = 8
), coded AS (
  SELECT word, xor(list_reduce(list_transform(range(octet_length(encode(word))),
             lambda i: ('0x' || substr(hex(encode(word)), 2 * i + 1, 2))::BIGINT),
           lambda c, b: xor(c >> 8, step[xor(c & 255, b) + 1]), 4294967295::BIGINT), 4294967295) % {resampling.BUCKETS} AS bucket
  FROM (SELECT DISTINCT word FROM words), steps
), counts AS (
  SELECT kind, bucket, count(*)::DOUBLE AS n FROM words JOIN coded USING (word) GROUP BY ALL
), gains AS (
  SELECT bucket, floor(1000 * ln((t + 1) * (all_s + {resampling.BUCKETS}) / ((s + 1) * (all_t + {resampling.BUCKETS}))))::BIGINT AS gain
  FROM (SELECT bucket, sum(n) FILTER (kind = 's') AS s, coalesce(sum(n) FILTER (kind = 't'), 0) AS t FROM counts GROUP BY bucket),
       (SELECT coalesce(sum(n) FILTER (kind = 's'), 0) AS all_s, coalesce(sum(n) FILTER (kind = 't'), 0) AS all_t FROM counts)
  WHERE s IS NOT NULL
), weights AS (
  SELECT doc_id, count(*) AS n_features, sum(gain)::BIGINT AS gain
  FROM words JOIN coded USING (word) JOIN gains USING (bucket) WHERE kind = 's' GROUP BY doc_id
), scored AS (
  SELECT d.doc_id, coalesce(n_features, 0) AS n_features,
         CASE WHEN n_features > 0 THEN (gain - ((gain % n_features) + n_features) % n_features) // n_features ELSE 0 END AS weight,
         ('0x' || substr(sha256('{resampling.SEED}:' || d.doc_id), 1, 8))::BIGINT AS h
  FROM documents d LEFT JOIN weights w ON w.doc_id = d.doc_id
), noisy AS (
  SELECT *, (weight + floor(-1000 * ln(-ln((h + 0.5::DOUBLE) / 4294967296))))::BIGINT AS score FROM scored
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY n_features >= {resampling.LEAST_WORDS} ORDER BY score DESC, doc_id) AS place,
         count(*) FILTER (n_features >= {resampling.LEAST_WORDS}) OVER () AS eligible
  FROM noisy
)
SELECT doc_id, n_features::BIGINT AS n_features, weight::BIGINT AS weight, score,
       CASE WHEN n_features >= {resampling.LEAST_WORDS} AND place <= {resampling.PERCENT} * eligible // 100 THEN place END AS rank
FROM ranked
"""

ORACLES = {
    "op1_line_dedup": OP1,
    "op2_mixing": OP2,
    "op3_warc": OP3,
    "op4_near_dedup": OP4,
    "op7_quality_rules": OP7,
    "op11_importance_resampling": OP11,
}
