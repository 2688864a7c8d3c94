"""DuckDB twins of the queries over decontamination, resampling and periodic runs."""

from __future__ import annotations

_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def _plain_words(text: str = "text") -> str:
    low = f"translate(coalesce({text}, ''), '{_UPPER}', '{_UPPER.lower()}')"
    return rf"regexp_extract_all({low}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"


# The table of the usual CRC-32 from its polynomial, for use by _crc.
_CRC_TABLE = """crc_table AS (
  SELECT list(list_reduce([i, 0, 1, 2, 3, 4, 5, 6, 7],
                          lambda c, k: IF(c & 1 = 1, xor(c >> 1, 3988292384), c >> 1)) ORDER BY i) AS steps
  FROM range(256) r(i))"""


def _crc(text: str) -> str:
    """CRC-32 of a text's UTF-8 bytes, where ``steps`` of crc_table is in scope."""
    octet = f"('0x' || substr(hex(encode({text})), 2 * i - 1, 2))::BIGINT"
    octets = f"list_transform(range(1, 1 + octet_length(encode({text}))), lambda i: {octet})"
    step = "xor(c >> 8, steps[1 + (xor(c, b) & 255)])"
    return f"xor(list_reduce(list_prepend(4294967295::BIGINT, {octets}), lambda c, b: {step}), 4294967295)"


DECONTAMINATION = f"""
WITH d AS (SELECT doc_id, row_number() OVER () AS r, {_plain_words()} AS words FROM documents),
p AS (SELECT r, unnest(words) AS word, generate_subscripts(words, 1) AS k FROM d),
i AS (SELECT item_id, row_number() OVER () AS r, {_plain_words()} AS words FROM benchmark),
q AS (SELECT r, item_id, least(len(words), 10) AS n, unnest(words) AS word, generate_subscripts(words, 1) AS k FROM i),
w AS (SELECT DISTINCT item_id, n, t FROM (
        SELECT item_id, n, string_agg(word, ' ') OVER o AS t, count(*) OVER o AS c FROM q
        WINDOW o AS (PARTITION BY r ORDER BY k ROWS BETWEEN CURRENT ROW AND n - 1 FOLLOWING)) WHERE c = n),
g AS (SELECT r, k, n, string_agg(word, ' ') OVER o AS t, count(*) OVER o AS c
      FROM p, (SELECT DISTINCT n FROM w)
      WINDOW o AS (PARTITION BY r, n ORDER BY k ROWS BETWEEN CURRENT ROW AND n - 1 FOLLOWING)),
m AS (SELECT r, k, n, t FROM g WHERE c = n AND t IN (SELECT t FROM w)),
h AS (SELECT r, count(DISTINCT spot) AS n_hit FROM (SELECT r, unnest(range(k, k + n)) AS spot FROM m) GROUP BY r),
f AS (SELECT r, list_sort(list(DISTINCT item_id::VARCHAR)) AS ids FROM m JOIN w USING (t) GROUP BY r)
SELECT doc_id, len(words)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit,
       coalesce(len(ids), 0)::BIGINT AS n_items, sha256(coalesce(array_to_string(ids, ','), '')) AS items_sha256,
       n_hit IS NOT NULL AS contaminated
FROM d LEFT JOIN h USING (r) LEFT JOIN f USING (r)
"""

RESAMPLING = f"""
WITH {_CRC_TABLE},
d AS (SELECT doc_id, row_number() OVER () AS r, {_plain_words()} AS words FROM documents),
p AS (SELECT r, unnest(words) AS word FROM d),
q AS (SELECT unnest({_plain_words()}) AS word FROM benchmark),
v AS (SELECT word, {_crc("word")} % 10000 AS bucket
      FROM (SELECT word FROM p UNION SELECT word FROM q), crc_table),
s AS (SELECT bucket, count(*) AS n FROM p JOIN v USING (word) GROUP BY bucket),
t AS (SELECT bucket, count(*) AS n FROM q JOIN v USING (word) GROUP BY bucket),
gain AS (
  SELECT v.bucket, floor(1000 * ln((any_value(coalesce(t.n, 0)) + 1)::DOUBLE * ((SELECT count(*) FROM p) + 10000)::DOUBLE
           / ((any_value(coalesce(s.n, 0)) + 1)::DOUBLE * ((SELECT count(*) FROM q) + 10000)::DOUBLE)))::BIGINT AS gain
  FROM v LEFT JOIN s USING (bucket) LEFT JOIN t USING (bucket) GROUP BY v.bucket),
weight AS (SELECT r, sum(gain)::BIGINT AS weight FROM p JOIN v USING (word) JOIN gain USING (bucket) GROUP BY r),
scored AS (
  SELECT r, doc_id, len(words)::BIGINT AS n_features, coalesce(weight, 0)::BIGINT AS weight,
         coalesce(weight, 0)::BIGINT + floor(-1000 * ln(-ln(
           (('0x' || substr(sha256('2024:' || doc_id), 1, 8))::BIGINT::DOUBLE + 0.5::DOUBLE) / 4294967296::DOUBLE)))::BIGINT AS score
  FROM d LEFT JOIN weight USING (r)),
able AS (SELECT r, row_number() OVER (ORDER BY score DESC, doc_id) AS place, count(*) OVER () AS n
         FROM scored WHERE n_features >= 20)
SELECT doc_id, n_features, weight, score, CASE WHEN place <= 10 * n // 100 THEN place END AS rank
FROM scored LEFT JOIN able USING (r)
"""

# Words q apart are equal over a stretch: an island of places. Where a smaller period divides q, its stretch holds this one.
PERIODIC = rf"""
WITH {_CRC_TABLE},
d AS (SELECT doc_id, row_number() OVER () AS r, {_crc("doc_id::VARCHAR")} AS h,
             regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents, crc_table),
e AS (SELECT *, len(words) AS n, h // 10 AS g FROM d),
f AS (SELECT *, CASE WHEN h % 10 = 0 AND n > 0 THEN g % n ELSE n END AS a,
             CASE WHEN h % 10 = 0 AND n > 0 THEN 1 + (n - g % n) // (3 + g % 8) ELSE 1 END AS p FROM e),
w AS (SELECT r, n, i, words[1 + CASE WHEN i < a THEN i ELSE a + (i - a) % p END] AS word
      FROM (SELECT *, unnest(range(n)) AS i FROM f)),
same AS (SELECT x.r, y.i - x.i AS q, x.i FROM w x JOIN w y ON x.r = y.r AND x.word = y.word AND y.i > x.i
         WHERE 4 * (y.i - x.i) <= x.n),
island AS (SELECT r, q, i, i - row_number() OVER (PARTITION BY r, q ORDER BY i) AS z FROM same),
stretch AS (SELECT r, q, min(i) AS s, count(*) + q AS len FROM island GROUP BY r, q, z HAVING count(*) + q >= greatest(6, 4 * q)),
run AS (SELECT * FROM stretch x WHERE NOT EXISTS (
          SELECT 1 FROM stretch y WHERE y.r = x.r AND y.q < x.q AND x.q % y.q = 0 AND y.s <= x.s AND y.s + y.len >= x.s + x.len)),
digest AS (SELECT r, count(*) AS n_runs, sha256(string_agg(s || ',' || len || ',' || q || chr(10), '' ORDER BY s, q)) AS runs_sha256
           FROM run GROUP BY r),
best AS (SELECT * FROM run QUALIFY row_number() OVER (PARTITION BY r ORDER BY len DESC, s, q) = 1),
dropped AS (SELECT DISTINCT r, unnest(range(s + q, s + len)) AS i FROM run),
kept AS (SELECT r, string_agg(word, ' ' ORDER BY i) AS t FROM w ANTI JOIN dropped USING (r, i) GROUP BY r)
SELECT doc_id, coalesce(n_runs, 0)::BIGINT AS n_runs, s::BIGINT AS start, len::BIGINT AS length, q::BIGINT AS period,
       (1000 * len // q)::BIGINT AS exponent_milli, coalesce(runs_sha256, sha256('')) AS runs_sha256,
       sha256(coalesce(t, '')) AS collapsed_sha256
FROM d LEFT JOIN digest USING (r) LEFT JOIN best USING (r) LEFT JOIN kept USING (r)
"""
