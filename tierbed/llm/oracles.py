"""DuckDB SQL for the queries that SQL can express."""

SPACES = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"

LINE_DEDUP = f"""
WITH lines AS (
  SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
         generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS i
  FROM documents),
keyed AS (SELECT *, translate(trim(line, {SPACES}), '{UPPER}', '{UPPER.lower()}') AS k FROM lines),
owners AS (SELECT k, min(doc_id) AS owner FROM keyed WHERE length(k) >= 10
           GROUP BY k HAVING count(DISTINCT doc_id) > 1),
marked AS (SELECT doc_id, i, line, owner IS NOT NULL AND owner <> doc_id AS dropped
           FROM keyed LEFT JOIN owners USING (k))
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE dropped) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (WHERE NOT dropped), '')) AS kept_sha256
FROM marked GROUP BY doc_id"""


def quality_rules(min_docs: int, share: float, depletion: float, min_words: int, percent: int) -> str:
    """The rules of ``quality_rules`` with lines compared by their text."""
    above = f"held >= {min_docs} AND held > host_docs * {share}"
    return rf"""
WITH docs AS (SELECT doc_id, coalesce(text, '') AS text, source FROM documents),
words AS (SELECT doc_id, unnest(regexp_extract_all(text, '[^\x20\x09-\x0D]+')) AS w,
                 generate_subscripts(regexp_extract_all(text, '[^\x20\x09-\x0D]+'), 1) AS i FROM docs),
windows AS (SELECT doc_id, i, w, CASE WHEN lead(w, 7) OVER o IS NOT NULL THEN concat_ws(' ', w,
              lead(w, 1) OVER o, lead(w, 2) OVER o, lead(w, 3) OVER o, lead(w, 4) OVER o,
              lead(w, 5) OVER o, lead(w, 6) OVER o, lead(w, 7) OVER o) END AS w8
            FROM words WINDOW o AS (PARTITION BY doc_id ORDER BY i)),
repeated AS (SELECT doc_id, i, w, CASE WHEN w8 IS NOT NULL AND count(*) OVER (PARTITION BY doc_id, w8) > 1
             THEN 1 ELSE 0 END AS r FROM windows),
covered AS (SELECT doc_id, w, max(r) OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN 7 PRECEDING
            AND CURRENT ROW) AS c FROM repeated),
by_word AS (SELECT doc_id, count(*) AS n_words, sum(length(w)) AS word_chars, sum(c) AS n_repeat_words
            FROM covered GROUP BY doc_id),
lines AS (SELECT doc_id, source, unnest(string_split(text, chr(10))) AS line FROM docs),
by_line AS (SELECT doc_id, count(*) - count(DISTINCT line) AS n_dup_lines FROM lines
            WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY doc_id),
plain AS (SELECT doc_id, source, trim(regexp_replace(lower(line),
                 '[\x20\x09\x0B-\x0D]+', ' ', 'g')) AS l FROM lines),
held_lines AS (SELECT doc_id, source, l, count(*) * len(string_split(l, ' ')) AS n FROM plain
               WHERE l <> '' GROUP BY doc_id, source, l),
hosts AS (SELECT source, count(*) AS host_docs FROM docs GROUP BY source),
frequent AS (SELECT h.* FROM held_lines h JOIN (
    SELECT source, l FROM (SELECT source, l, count(*) AS held FROM held_lines GROUP BY source, l) c
    JOIN hosts USING (source) WHERE {above}) f USING (source, l)),
ends AS (SELECT DISTINCT source, l, array_to_string(w[1:3], ' ') AS a, array_to_string(w[-3:], ' ') AS b
         FROM (SELECT source, l, string_split(l, ' ') AS w FROM held_lines) t WHERE len(w) > 3),
listed AS (SELECT source, l, a, b FROM (SELECT DISTINCT source, l FROM frequent) f JOIN ends USING (source, l)),
others AS (SELECT h.doc_id, h.source, h.l, a, b FROM held_lines h
           LEFT JOIN ends e ON e.source = h.source AND e.l = h.l
           WHERE h.doc_id IN (SELECT doc_id FROM frequent)
           AND NOT EXISTS (SELECT 1 FROM frequent f WHERE f.doc_id = h.doc_id AND f.l = h.l)),
by_first AS (SELECT source, a, arg_min(l, md5(l)) AS x FROM listed GROUP BY source, a),
by_last AS (SELECT source, b, arg_min(l, md5(l)) AS y FROM listed GROUP BY source, b),
parts AS (SELECT doc_id, l AS common, NULL AS own FROM frequent UNION ALL
          SELECT doc_id, coalesce(x, y), CASE WHEN coalesce(x, y) IS NULL THEN l END
          FROM others LEFT JOIN by_first USING (source, a) LEFT JOIN by_last USING (source, b)),
classes AS (SELECT doc_id, coalesce('own' || string_agg(DISTINCT own, chr(10) ORDER BY own),
                                    string_agg(DISTINCT common, chr(10) ORDER BY common)) AS c
            FROM parts GROUP BY doc_id),
boilerplate AS (SELECT source, l FROM (SELECT source, l, count(DISTINCT c) AS held
                FROM frequent JOIN classes USING (doc_id) GROUP BY source, l) c JOIN hosts USING (source) WHERE {above}),
depleted AS (SELECT doc_id FROM (SELECT doc_id, sum(n) AS lost FROM frequent JOIN boilerplate USING (source, l)
             GROUP BY doc_id) a JOIN (SELECT doc_id, sum(n) AS total FROM held_lines GROUP BY doc_id) b
             USING (doc_id) WHERE lost >= total * {depletion}),
stats AS (SELECT doc_id, CAST(coalesce(n_words, 0) AS BIGINT) AS n_words,
                 CAST(coalesce(word_chars, 0) AS BIGINT) AS word_chars,
                 CAST(length(regexp_replace(text, '[^#*$%&|<>]+', '', 'g')) AS BIGINT) AS n_symbols,
                 CAST(coalesce(n_dup_lines, 0) AS BIGINT) AS n_dup_lines,
                 CAST(coalesce(n_repeat_words, 0) AS BIGINT) AS n_repeat_words
          FROM docs LEFT JOIN by_word USING (doc_id) LEFT JOIN by_line USING (doc_id))
SELECT *, n_words < {min_words} OR 100 * n_repeat_words > {percent} * n_words AS base_failed,
       NOT (n_words < {min_words} OR 100 * n_repeat_words > {percent} * n_words)
       AND doc_id NOT IN (SELECT doc_id FROM depleted) AS kept
FROM stats"""


# Five hexadecimal digits are four base-32 digits.
ARC_TO_WARC = """
WITH p AS (SELECT page_id, coalesce(html, '') AS body, sha1(coalesce(html, '')) AS h FROM pages),
firsts AS (SELECT h, min(page_id) AS first_id FROM p GROUP BY h),
digests AS (SELECT h, string_agg(substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', CAST(
              (CAST('0x' || substr(h, CAST(5 * (j // 4) + 1 AS INTEGER), 5) AS BIGINT)
               >> CAST(15 - 5 * (j % 4) AS INTEGER)) & 31 AS INTEGER) + 1, 1), '' ORDER BY j) AS digest
            FROM firsts, range(32) t(j) GROUP BY h)
SELECT page_id, CAST(octet_length(encode(body)) AS BIGINT) AS payload_bytes,
       digest AS payload_digest,
       CASE WHEN page_id = first_id THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> first_id THEN first_id END AS refers_to
FROM p JOIN firsts USING (h) JOIN digests USING (h)"""


FAIR_MIXING = r"""
WITH d AS (
  SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size,
         CAST('0x' || substr(md5(concat_ws(':', '7', coalesce(CAST(doc_id AS VARCHAR), ''),
              coalesce(source, ''), coalesce(text, ''))), 1, 15) AS BIGINT) AS shuffle
  FROM documents),
s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
             row_number() OVER (ORDER BY source NULLS LAST) - 1 AS rank FROM d GROUP BY source),
w AS (SELECT *, rank % 3 + 1 AS weight, 3 * source_size AS most, 3 * source_size / (rank % 3 + 1) AS dry FROM s),
l AS (SELECT *, CAST(sum(source_size) OVER () AS BIGINT) AS budget,
             coalesce(CAST(sum(most) OVER o AS BIGINT), 0) AS given,
             CAST(sum(weight) OVER () AS BIGINT) - coalesce(CAST(sum(weight) OVER o AS BIGINT), 0) AS open_weight
      FROM w WINDOW o AS (ORDER BY dry, rank ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
level AS (SELECT (budget - given) / open_weight AS height FROM l
          WHERE (budget - given) / open_weight <= dry ORDER BY dry, rank LIMIT 1),
t AS (SELECT source, source_size, weight, budget, least(CAST(most AS DOUBLE), weight * height) AS target
      FROM l, level),
q AS (SELECT d.*, source_size, weight, budget, target,
             CAST(sum(size) OVER (PARTITION BY d.source ORDER BY shuffle) AS BIGINT) AS queued
      FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source),
e AS (SELECT q.*, epoch, (source_size * epoch + queued) / weight AS finish FROM q, range(3) r(epoch)),
c AS (SELECT *, sum(size) OVER (ORDER BY finish, shuffle, epoch) AS total FROM e)
SELECT doc_id, size, source_size, target,
       CAST(sum(CASE WHEN total <= budget THEN size ELSE 0 END) AS BIGINT) AS taken
FROM c GROUP BY doc_id, size, source_size, target"""


# Arithmetic in 128 bits; pieces end at [.,;:!?\x0A-\x0D], words at blanks and tabs.
COLLOCATIONS = rf"""
WITH pieces AS (SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(
       translate(coalesce(text, ''), '{UPPER}', '{UPPER.lower()}'), '[.,;:!?\x0A-\x0D]')) AS piece FROM documents),
lists AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces),
found AS (SELECT lang, size, unnest(list_transform(range(1, len(w) - size + 2),
            lambda i: array_to_string(w[i:i + size - 1], ' '))) AS phrase
          FROM lists, range(1, 4) s(size) WHERE len(w) >= size),
f AS (SELECT lang, size, phrase, count(*) AS f FROM found GROUP BY ALL),
totals AS (SELECT lang, CAST(sum(f) AS BIGINT) AS n FROM f WHERE size = 1 GROUP BY lang),
candidates AS (SELECT lang, size, phrase, string_split(phrase, ' ') AS w, f AS a FROM f WHERE size > 1 AND f >= 10),
inner_phrases AS (SELECT lang, a, array_to_string(w[i:i + 1], ' ') AS phrase FROM candidates, range(1, 3) t(i)
                  WHERE size = 3),
kept AS (SELECT * FROM candidates c WHERE NOT EXISTS (SELECT 1 FROM inner_phrases i
         WHERE i.lang = c.lang AND i.phrase = c.phrase AND 100 * i.a >= 50 * c.a)),
cuts AS (SELECT lang, phrase, a, k, array_to_string(w[1:k], ' ') AS x, array_to_string(w[k + 1:], ' ') AS y
         FROM kept, range(1, 3) t(k) WHERE k < size),
scored AS (SELECT c.lang, c.phrase, a, k, l.f AS l, r.f AS r,
             CAST((1000000::HUGEINT * a * a) // (l.f::HUGEINT * r.f) AS BIGINT) AS score
           FROM cuts c JOIN f l ON l.lang = c.lang AND l.phrase = c.x JOIN f r ON r.lang = c.lang AND r.phrase = c.y),
lowest AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM lowest)
SELECT lang, rank, phrase, a, l, r, n, score FROM ranked JOIN totals USING (lang) WHERE rank <= 2000"""
