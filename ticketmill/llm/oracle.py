"""DuckDB SQL for the results of the operators that SQL can express on whole tables."""

from __future__ import annotations

FILL_IN_MIDDLE_SQL = r"""
WITH cut AS (
  SELECT doc_id, coalesce(text, '') AS whole, regexp_extract_all(coalesce(text, ''), '[A-Za-z]+|[^A-Za-z]') AS tokens,
         sha256('1:' || coalesce(CAST(doc_id AS varchar), '')) AS digest
  FROM documents
), drawn AS (
  SELECT *, len(tokens) AS n,
         CAST('0x' || substr(digest, 1, 8) AS bigint) % (len(tokens) + 1) AS one,
         CAST('0x' || substr(digest, 9, 8) AS bigint) % (len(tokens) + 1) AS two,
         CASE WHEN whole = '' OR regexp_matches(whole, '<[PSM]>')
                OR CAST('0x' || substr(digest, 17, 8) AS bigint) % 100 >= 90 THEN 'plain'
              WHEN CAST('0x' || substr(digest, 25, 8) AS bigint) % 100 < 20 THEN 'spm' ELSE 'psm' END AS form
  FROM cut
), parts AS (
  SELECT *, array_to_string(tokens[1:least(one, two)], '') AS prefix,
         array_to_string(tokens[least(one, two) + 1:greatest(one, two)], '') AS middle,
         array_to_string(tokens[greatest(one, two) + 1:], '') AS suffix
  FROM drawn
)
SELECT doc_id, n, form,
       CASE WHEN form <> 'plain' THEN length(prefix) END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN length(middle) END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN whole
                        WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
                        ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256,
       sha256(prefix || middle || suffix) AS restored_sha256
FROM parts
"""

# CRC-32 by its table of 256 values, which the first subquery makes.
CONVERSATION_TRIE_SQL = r"""
WITH crc_table AS (
  SELECT [list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0], lambda c, z: CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END)
          FOR i IN range(256)] AS crcs
), own AS (
  SELECT conv_id, md5(strlen(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')) AS id,
         length(coalesce(text, '')) AS chars,
         row_number() OVER (PARTITION BY conv_id
                            ORDER BY turn NULLS FIRST, md5(strlen(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, ''))) AS n
  FROM conversations WHERE conv_id IS NOT NULL
), convs AS (
  SELECT conv_id, xor(list_reduce(list_prepend(4294967295, [ascii(d) FOR d IN string_split(CAST(conv_id AS varchar), '')]),
                                  lambda c, b: xor(c // 256, crcs[xor(c, b) % 256 + 1])), 4294967295) % 6 AS h
  FROM (SELECT DISTINCT conv_id FROM own), crc_table
), turns AS (
  SELECT conv_id, id, chars, row_number() OVER (PARTITION BY conv_id ORDER BY part, n) AS n
  FROM (SELECT c.conv_id, 0 AS part, o.n, o.id, o.chars FROM convs c JOIN own o ON o.conv_id = c.conv_id - c.conv_id % 100 AND o.n <= c.h
        UNION ALL
        SELECT c.conv_id, 1, o.n, o.id, o.chars FROM convs c JOIN own o ON o.conv_id = c.conv_id AND o.n > c.h)
), members AS (
  SELECT conv_id, 0 AS depth, '' AS path, 0 AS chars FROM convs
  UNION ALL
  SELECT conv_id, n, string_agg(id, '') OVER (PARTITION BY conv_id ORDER BY n), chars FROM turns
), lengths AS (
  SELECT conv_id, max(depth) AS depth FROM members GROUP BY conv_id
), nodes AS (
  SELECT path, any_value(m.depth) AS depth, min(m.conv_id) AS conv_id, count(*) AS n_convs, (count(*) - 1) * any_value(chars) AS saved,
         sha256(coalesce(string_agg(CAST(m.conv_id AS varchar), ',' ORDER BY m.conv_id) FILTER (l.depth = m.depth), '')) AS ends_sha256
  FROM members m JOIN lengths l USING (conv_id) GROUP BY path
), families AS (
  SELECT left(path, len(path) - 32) AS path, count(*) AS n_children FROM nodes WHERE depth > 0 GROUP BY 1
), subtrees AS (
  SELECT left(n.path, 32 * up) AS path, sum(n.saved) AS saved_tokens, count(*) FILTER (f.n_children IS NULL) AS n_leaves
  FROM nodes n LEFT JOIN families f USING (path), unnest(range(0, n.depth + 1)) AS ups(up) GROUP BY 1
)
SELECT n.conv_id, CAST(n.depth AS bigint) AS depth, p.conv_id AS parent_conv_id, n.n_convs,
       CAST(coalesce(f.n_children, 0) AS bigint) AS n_children, CAST(s.n_leaves AS bigint) AS n_leaves,
       CAST(s.saved_tokens AS bigint) AS saved_tokens, n.ends_sha256
FROM nodes n JOIN subtrees s USING (path) LEFT JOIN families f USING (path)
     LEFT JOIN nodes p ON n.depth > 0 AND p.path = left(n.path, len(n.path) - 32)
"""

QUALITY_RULES_SQL = r"""
WITH numbered AS (
  SELECT row_number() OVER () AS row_id, doc_id, coalesce(text, '') AS whole FROM documents
), cut AS (
  SELECT *, list_filter(string_split_regex(whole, '[\x20\x09-\x0D]+'), lambda w: w <> '') AS words,
         list_filter(string_split(whole, chr(10)), lambda l: regexp_matches(l, '[^\x20\x09-\x0D]')) AS lines
  FROM numbered
), windows AS (
  SELECT row_id, spot, count(*) OVER (PARTITION BY row_id, words[spot], words[spot + 1], words[spot + 2]) AS met
  FROM cut, unnest(range(1, len(words) - 1)) AS places(spot)
), covered AS (
  SELECT row_id, count(DISTINCT place) AS n_repeat_words
  FROM windows, unnest([spot, spot + 1, spot + 2]) AS covers(place) WHERE met > 1 GROUP BY row_id
), counts AS (
  SELECT doc_id, row_id, CAST(len(words) AS bigint) AS n_words, CAST(length(array_to_string(words, '')) AS bigint) AS word_chars,
         CAST(len(regexp_extract_all(whole, '[#*$%&|<>]')) AS bigint) AS n_symbols,
         CAST(len(lines) - len(list_distinct(lines)) AS bigint) AS n_dup_lines,
         coalesce(n_repeat_words, 0) AS n_repeat_words
  FROM cut LEFT JOIN covered USING (row_id)
), judged AS (
  SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
         CASE WHEN n_words >= 250 THEN 1 WHEN n_words >= 50 THEN 0 END AS stratum,
         [n_symbols / greatest(n_words, 1), word_chars / greatest(n_words, 1), -(word_chars / greatest(n_words, 1)),
          n_dup_lines / greatest(n_words, 1), n_repeat_words / greatest(n_words, 1)] AS rates
  FROM counts
), labelled AS (
  SELECT stratum, rates, label, CAST('0x' || substr(md5(CAST(doc_id AS varchar)), 1, 7) AS bigint) % 3 <> 0 AS holdout
  FROM judged JOIN (SELECT doc_id, max(quality) AS label FROM labels WHERE quality IN (0, 1) GROUP BY doc_id) USING (doc_id)
  WHERE NOT base_failed AND stratum IS NOT NULL
), usual AS (
  SELECT list(middle ORDER BY spot) AS middles, list(greatest(least_spread, high - low) ORDER BY spot) AS spreads
  FROM (SELECT spot, quantile_disc(rates[spot], 0.25) AS low, quantile_disc(rates[spot], 0.5) AS middle,
               quantile_disc(rates[spot], 0.75) AS high, [0.02, 0.25, 0.25, 0.01, 0.05][spot] AS least_spread
        FROM labelled, range(1, 6) AS rate(spot) WHERE label = 1 AND NOT holdout GROUP BY spot)
), scored AS (
  SELECT l.*, list_max([(rates[k] - middles[k]) / spreads[k] FOR k IN range(1, 6)]) AS excess FROM labelled l, usual
), cutoffs AS (
  SELECT spot AS turn, [40.0, 30.0, 24.0, 20.0, 16.0, 13.0, 10.0, 8.0, 6.5, 5.0, 4.0, 3.0][spot] AS cutoff FROM range(1, 13) AS turns(spot)
), tried AS (
  SELECT stratum, turn, cutoff, count(*) FILTER (label = 1 AND holdout) AS n,
         count(*) FILTER (label = 1 AND holdout AND excess > cutoff) AS k,
         coalesce(count(*) FILTER (label = 0 AND NOT holdout AND excess > cutoff)
                  / nullif(count(*) FILTER (label = 0 AND NOT holdout), 0), 0)
         - coalesce(count(*) FILTER (label = 1 AND NOT holdout AND excess > cutoff)
                    / nullif(count(*) FILTER (label = 1 AND NOT holdout), 0), 0) AS gain
  FROM scored, cutoffs GROUP BY stratum, turn, cutoff
), tails AS (
  SELECT stratum, turn, cutoff, gain,
         CASE WHEN n = 0 THEN 1.0 ELSE
           (SELECT sum(exp(lgamma(n + 1) - lgamma(i + 1) - lgamma(n - i + 1) + i * ln(0.05) + (n - i) * ln(0.95)))
            FROM range(0, k + 1) AS hits(i)) END AS tail
  FROM tried
), tested AS (
  SELECT *, bool_and(tail <= 0.05 / 2) OVER (PARTITION BY stratum ORDER BY turn) AS certified,
         first_value(turn) OVER (PARTITION BY stratum ORDER BY gain DESC, turn) AS proposed
  FROM tails
), chosen AS (
  SELECT stratum, min(cutoff) AS cutoff FROM tested WHERE certified AND turn <= proposed GROUP BY stratum
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND coalesce(list_max([(rates[k] - middles[k]) / spreads[k] FOR k IN range(1, 6)]) <= cutoff, true) AS kept
FROM judged LEFT JOIN chosen USING (stratum), usual
"""
