"""SQL for the queries of this folder that SQL can express; for checking only."""

from __future__ import annotations

_LOWER = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

OP11 = rf"""
WITH docs AS (
    SELECT row_number() OVER () AS r, doc_id, coalesce(regexp_extract_all({_LOWER}, '[0-9a-z\x{{80}}-\x{{10FFFF}}]+'), []) AS words FROM documents
), items AS (
    SELECT item_id, coalesce(regexp_extract_all({_LOWER}, '[0-9a-z\x{{80}}-\x{{10FFFF}}]+'), []) AS words FROM benchmark
), item_windows AS (
    SELECT DISTINCT item_id, span, array_to_string(list_slice(words, p + 1, p + span), ' ') AS passage
    FROM (SELECT item_id, words, least(10, len(words)) AS span, unnest(range(0, len(words) - least(10, len(words)) + 1)) AS p
          FROM items WHERE len(words) > 0)
), lengths AS (SELECT DISTINCT span FROM item_windows
), doc_windows AS (
    SELECT r, p, span, array_to_string(list_slice(words, p + 1, p + span), ' ') AS passage
    FROM (SELECT r, words, span, unnest(range(0, len(words) - span + 1)) AS p FROM docs, lengths WHERE len(words) >= span)
), hits AS (
    SELECT r, p, span, item_id FROM doc_windows JOIN item_windows USING (span, passage)
), words_hit AS (
    SELECT r, count(DISTINCT place) AS n_hit FROM (SELECT r, unnest(range(p, p + span)) AS place FROM hits) GROUP BY r
), items_hit AS (
    SELECT r, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS list
    FROM (SELECT DISTINCT r, CAST(item_id AS VARCHAR) AS item FROM hits) GROUP BY r
)
SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit, CAST(coalesce(n_items, 0) AS BIGINT) AS n_items,
       sha256(coalesce(list, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM docs LEFT JOIN words_hit USING (r) LEFT JOIN items_hit USING (r)
"""

#: The crc32 is written out: a table of 256 values by its rule, then one step per byte of the UTF-8 text.
OP12 = rf"""
WITH RECURSIVE crc_table AS (
    SELECT list_transform(range(0, 256), lambda i: list_reduce(list_concat([i], [0, 0, 0, 0, 0, 0, 0, 0]),
           lambda c, x: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS steps
), texts AS (
    SELECT doc_id, unnest(regexp_extract_all({_LOWER}, '[a-z\x{{C0}}-\x{{FF}}]+')) AS run FROM documents
), runs AS (
    SELECT coalesce(CAST(doc_id AS VARCHAR), '') AS id, run, count(*) AS n FROM texts WHERE length(run) >= 5 GROUP BY ALL
), bytes AS (
    SELECT run, n, flatten(list_transform(string_split(id || ':' || run, ''), lambda c:
           CASE WHEN unicode(c) < 128 THEN [CAST(unicode(c) AS BIGINT)] ELSE [195, CAST(unicode(c) AS BIGINT) - 64] END)) AS b FROM runs
), hashed AS (
    SELECT run, n, xor(list_reduce(list_concat([4294967295], b), lambda c, x: xor(c >> 8, steps[(xor(c, x) & 255) + 1])), 4294967295) AS h
    FROM bytes, crc_table
), noisy AS (
    SELECT n, CASE WHEN h % 97 = 0 THEN substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word FROM hashed
), words AS (
    SELECT word, CAST(sum(n) AS BIGINT) AS n FROM noisy WHERE length(word) >= 5 GROUP BY word HAVING sum(n) >= 3
), cuts AS (
    SELECT word, n, i, substr(word, 1, i) || substr(word, i + 2) AS cut FROM (SELECT word, n, unnest(range(0, length(word))) AS i FROM words)
), pairs AS (
    SELECT a.word, b.word AS near, b.n AS near_n FROM cuts a JOIN cuts b ON a.cut = b.cut AND a.i = b.i AND a.word <> b.word
    UNION SELECT a.word, b.word, b.n FROM cuts a JOIN words b ON a.cut = b.word
    UNION SELECT b.word, a.word, a.n FROM cuts a JOIN words b ON a.cut = b.word
), best AS (
    SELECT word, count(*) AS n_near, max(near_n) AS best_n FROM pairs GROUP BY word
), firsts AS (
    SELECT word, min(near) AS best FROM pairs JOIN best USING (word) WHERE near_n = best_n GROUP BY word
), forms AS (
    SELECT word, n, coalesce(n_near, 0) AS n_near, CASE WHEN best_n >= 2 * n THEN best END AS form, CASE WHEN best_n >= 2 * n THEN best_n END AS form_n
    FROM words LEFT JOIN best USING (word) LEFT JOIN firsts USING (word)
), chain AS (
    SELECT word, word AS at_word, form FROM forms
    UNION ALL
    SELECT c.word, f.word, f.form FROM chain c JOIN forms f ON f.word = c.form
)
SELECT word, f.form, at_word AS root, n, CAST(n_near AS BIGINT) AS n_near, CAST(form_n AS BIGINT) AS form_n
FROM forms f JOIN (SELECT word, at_word FROM chain WHERE form IS NULL) USING (word)
"""

OP13 = rf"""
WITH docs AS (
    SELECT row_number() OVER () AS r, doc_id, coalesce(regexp_extract_all({_LOWER}, '[0-9a-z\x{{80}}-\x{{10FFFF}}]+'), []) AS terms FROM documents
), counted AS (
    SELECT r, doc_id, len(terms) AS n, terms FROM docs WHERE len(terms) > 0
), totals AS (
    SELECT count(*) AS big_n, CAST(sum(n) AS BIGINT) AS big_l FROM counted
), lengths AS (
    SELECT r, doc_id, 100 - 50 + (50 * n * big_n) // big_l AS m FROM counted, totals
), item_terms AS (
    SELECT DISTINCT item_id, unnest(regexp_extract_all({_LOWER}, '[0-9a-z\x{{80}}-\x{{10FFFF}}]+')) AS term FROM benchmark
), tfs AS (
    SELECT r, term, count(*) AS tf FROM (SELECT r, unnest(terms) AS term FROM counted) WHERE term IN (SELECT term FROM item_terms) GROUP BY r, term
), weights AS (
    SELECT term, CAST(floor(1000 * ln(CAST(2 * big_n + 2 AS DOUBLE) / (2 * count(*) + 1))) AS BIGINT) AS w FROM tfs, totals GROUP BY term, big_n
), scores AS (
    SELECT item_id, r, CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 20 * m))) AS BIGINT) AS score
    FROM item_terms JOIN weights USING (term) JOIN tfs USING (term) JOIN lengths USING (r) GROUP BY item_id, r
), ranked AS (
    SELECT item_id, doc_id, score, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id NULLS LAST) AS place
    FROM scores JOIN lengths USING (r) WHERE score > 0
)
SELECT item_id, CAST(place AS INTEGER) AS rank, doc_id, score FROM ranked WHERE place <= 50
"""

SQL: dict[str, str] = {"op11_benchmark_decontamination": OP11, "op12_spelling_variants": OP12, "op13_ranked_search": OP13}
