"""DuckDB SQL for the queries that SQL can express."""

OP1 = r"""
WITH doc_words AS (
    SELECT doc_id, unnest(words) AS word, generate_subscripts(words, 1) AS pos
    FROM (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                            '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words FROM documents)
), items AS (
    SELECT CAST(item_id AS VARCHAR) AS item,
           regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                              '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words FROM benchmark
), windows AS (
    SELECT DISTINCT item, least(10, len(words)) AS n, array_to_string(words[i : i + least(10, len(words)) - 1], ' ') AS gram
    FROM items, unnest(range(1, greatest(len(words) - 9, 1) + 1)) AS t(i) WHERE len(words) > 0
), grams AS (
    SELECT doc_id, pos, n, string_agg(word, ' ') OVER w AS gram, count(*) OVER w AS have
    FROM doc_words, (SELECT DISTINCT n FROM windows)
    WINDOW w AS (PARTITION BY doc_id, n ORDER BY pos ROWS BETWEEN CURRENT ROW AND n - 1 FOLLOWING)
), hits AS (
    SELECT doc_id, pos, n, item FROM grams JOIN windows USING (n, gram) WHERE have = n
), hit_words AS (
    SELECT doc_id, count(DISTINCT pos + k) AS n_hit FROM hits, unnest(range(0, n)) AS t(k) GROUP BY doc_id
), hit_items AS (
    SELECT doc_id, count(DISTINCT item) AS n_items, string_agg(DISTINCT item, ',' ORDER BY item) AS names FROM hits GROUP BY doc_id
), totals AS (
    SELECT doc_id, count(*) AS n_words FROM doc_words GROUP BY doc_id
)
SELECT doc_id, coalesce(n_words, 0) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(names, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM documents LEFT JOIN totals USING (doc_id) LEFT JOIN hit_words USING (doc_id) LEFT JOIN hit_items USING (doc_id)
"""

_SYMBOLS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
_BASE32 = " || ".join(
    f"substr('{_SYMBOLS}', 1 + ((CAST('0x' || substr(sha1(payload), {5 * chunk + 1}, 5) AS INTEGER) >> {shift}) & 31), 1)"
    for chunk in range(8) for shift in (15, 10, 5, 0)
)

OP8 = f"""
WITH payloads AS (
    SELECT page_id, encode(coalesce(html, '')) AS payload FROM pages
), digests AS (
    SELECT page_id, octet_length(payload) AS payload_bytes, {_BASE32} AS payload_digest FROM payloads
), newest AS (
    SELECT *, max(page_id) OVER (PARTITION BY payload_digest) AS top FROM digests
)
SELECT page_id, CAST(payload_bytes AS BIGINT) AS payload_bytes, payload_digest,
       CASE WHEN page_id = top THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> top THEN top END AS refers_to, TRUE AS complete
FROM newest
"""

OP2 = r"""
WITH texts AS (
    SELECT doc_id, lang, source, coalesce(text, '') AS text,
           regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words,
           list_filter(string_split(coalesce(text, ''), chr(10)), lambda line: regexp_matches(line, '[^\x20\x09-\x0D]')) AS lines
    FROM documents
), grams AS (
    SELECT doc_id, unnest(range(1, len(words) - 1)) AS i, words FROM texts WHERE len(words) >= 3
), windows AS (
    SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, words[i : i + 2]) AS n FROM grams
), repeats AS (
    SELECT doc_id, count(DISTINCT i + k) AS n_repeat_words FROM windows, (SELECT unnest([0, 1, 2]) AS k) WHERE n > 1 GROUP BY doc_id
), counts AS (
    SELECT doc_id, lang, source, len(words) AS n_words, CAST(length(array_to_string(words, '')) AS BIGINT) AS word_chars,
           CAST(length(regexp_replace(text, '[^#*$%&|<>]+', '', 'g')) AS BIGINT) AS n_symbols,
           len(lines) - len(list_distinct(lines)) AS n_dup_lines, coalesce(n_repeat_words, 0) AS n_repeat_words,
           len(lines) AS n_lines, CAST(length(regexp_replace(text, '[^\p{Lu}]+', '', 'g')) AS BIGINT) AS n_capitals,
           CAST(length(regexp_replace(text, '[^!?]+', '', 'g')) AS BIGINT) AS n_marks
    FROM texts LEFT JOIN repeats USING (doc_id)
), judged AS (
    SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM counts
), measures AS (
    SELECT doc_id, lang, source, unnest([
        {'measure': 'word_length', 'value': 1000000 * word_chars // n_words, 'spread': 125000, 'both': TRUE},
        {'measure': 'symbols', 'value': 1000000 * n_symbols // word_chars, 'spread': 2500, 'both': FALSE},
        {'measure': 'capitals', 'value': 1000000 * n_capitals // word_chars, 'spread': 10000, 'both': FALSE},
        {'measure': 'marks', 'value': 1000000 * n_marks // word_chars, 'spread': 2500, 'both': FALSE},
        {'measure': 'dup_lines', 'value': 1000000 * n_dup_lines // n_lines, 'spread': 62500, 'both': FALSE},
        {'measure': 'repeats', 'value': 1000000 * n_repeat_words // n_words, 'spread': 50000, 'both': FALSE}], recursive := true)
    FROM judged WHERE NOT base_failed
), buckets AS (
    SELECT *, 32 * greatest(length(bin(value)) - 6, 0) + (value >> greatest(length(bin(value)) - 6, 0)) AS bucket FROM measures
), of_source AS (
    SELECT lang, source, measure, bucket, count(*) AS n, any_value(spread) AS spread, any_value("both") AS "both",
           sum(count(*)) OVER (PARTITION BY lang, source, measure) AS total FROM buckets GROUP BY lang, source, measure, bucket
), of_lang AS (
    SELECT lang, measure, bucket, count(*) AS n, sum(count(*)) OVER (PARTITION BY lang, measure) AS total FROM buckets GROUP BY lang, measure, bucket
), of_all AS (
    SELECT measure, bucket, count(*) AS n, sum(count(*)) OVER (PARTITION BY measure) AS total FROM buckets GROUP BY measure, bucket
), full_lang AS (
    SELECT lang, measure, bucket, n FROM of_lang WHERE total >= 200
    UNION ALL
    SELECT l.lang, l.measure, l.bucket, l.n * (SELECT max(total) FROM of_all a WHERE a.measure = l.measure) FROM of_lang l WHERE total < 200
    UNION ALL
    SELECT l.lang, l.measure, a.bucket, (200 - l.total) * a.n
    FROM (SELECT DISTINCT lang, measure, total FROM of_lang WHERE total < 200) l JOIN of_all a USING (measure)
), lang_total AS (
    SELECT lang, measure, sum(n) AS total FROM full_lang GROUP BY lang, measure
), full_source AS (
    SELECT lang, source, measure, bucket, n FROM of_source WHERE total >= 200
    UNION ALL
    SELECT s.lang, s.source, s.measure, s.bucket, s.n * t.total
    FROM of_source s JOIN lang_total t ON s.measure = t.measure AND s.lang IS NOT DISTINCT FROM t.lang WHERE s.total < 200
    UNION ALL
    SELECT s.lang, s.source, s.measure, l.bucket, (200 - s.total) * l.n
    FROM (SELECT DISTINCT lang, source, measure, total FROM of_source WHERE total < 200) s
    JOIN full_lang l ON s.measure = l.measure AND s.lang IS NOT DISTINCT FROM l.lang
), histogram AS (
    SELECT lang, source, measure, bucket, sum(n) AS n FROM full_source GROUP BY lang, source, measure, bucket
), ranked AS (
    SELECT *, sum(n) OVER (PARTITION BY lang, source, measure) AS total,
           sum(n) OVER (PARTITION BY lang, source, measure ORDER BY bucket) AS upto,
           (bucket - 32 * greatest(bucket // 32 - 1, 0)) << greatest(bucket // 32 - 1, 0) AS value
    FROM histogram
), quartiles AS (
    SELECT lang, source, measure, min(value) FILTER (100 * upto >= 25 * total) AS q25, min(value) FILTER (100 * upto >= 50 * total) AS q50,
           min(value) FILTER (100 * upto >= 75 * total) AS q75
    FROM ranked GROUP BY lang, source, measure
), inside AS (
    SELECT doc_id, bool_and(value <= q50 + 9 * greatest(q50 - q25, q50 // 16, spread)
                            AND (NOT "both" OR value >= q50 - 9 * greatest(q75 - q50, q50 // 16, spread))) AS inside
    FROM measures m
    JOIN quartiles q ON q.measure = m.measure AND q.lang IS NOT DISTINCT FROM m.lang AND q.source IS NOT DISTINCT FROM m.source
    GROUP BY doc_id
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, coalesce(inside, FALSE) AS kept
FROM judged LEFT JOIN inside USING (doc_id)
"""

OP12 = r"""
WITH good_ids AS (
    SELECT doc_id, max(CAST(quality = 1 AS INT)) AS good, max(CAST(toxic = 1 AS INT)) AS toxic FROM labels GROUP BY doc_id
), texts AS (
    SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS text,
           regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents
), judged AS (
    SELECT doc_id, part, [len(words) < 200,
                          100 * len(list_distinct(words)) < 50 * len(words),
                          100 * length(regexp_replace(text, '[^A-Z]+', '', 'g')) > 2 * length(text),
                          regexp_matches(text, '[#$%&*|]'),
                          coalesce(doc_id > min(doc_id) OVER (PARTITION BY text), FALSE)] AS fails
    FROM texts
), counted AS (
    SELECT part, fails, coalesce(good, 0) AS good, coalesce(toxic, 0) AS toxic, count(*) AS n
    FROM judged LEFT JOIN good_ids USING (doc_id) GROUP BY ALL
), letters AS (
    SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS letter
), orders AS (
    SELECT a.letter || b.letter || c.letter || d.letter || e.letter AS filter_order
    FROM letters a, letters b, letters c, letters d, letters e
    WHERE len(list_distinct([a.letter, b.letter, c.letter, d.letter, e.letter])) = 5
), steps AS (
    SELECT filter_order, step, [instr('ABCDE', x) FOR x IN string_split(filter_order, '')] AS places
    FROM orders, (SELECT unnest([1, 2, 3, 4, 5]) AS step)
), outcomes AS (
    SELECT *, fails[places[step]] AS here, list_bool_or([fails[x] FOR x IN places[1 : step - 1]]) AS earlier,
           len(list_filter(fails, lambda x: x)) AS failed
    FROM counted, steps
), summed AS (
    SELECT part, filter_order, step,
           coalesce(sum(n) FILTER (NOT coalesce(earlier, FALSE) AND NOT here), 0) AS kept,
           coalesce(sum(n) FILTER (NOT coalesce(earlier, FALSE) AND here), 0) AS removed,
           coalesce(sum(n) FILTER (earlier AND here), 0) AS redundant,
           coalesce(sum(n) FILTER (here AND failed = 1), 0) AS unique_fails,
           coalesce(sum(n) FILTER (NOT coalesce(earlier, FALSE) AND here AND good = 1), 0) AS good_lost,
           coalesce(sum(n) FILTER (NOT coalesce(earlier, FALSE) AND here AND toxic = 1), 0) AS toxic_lost
    FROM outcomes GROUP BY part, filter_order, step
)
SELECT part, filter_order, CAST(step AS INTEGER) AS step, CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed,
       CAST(redundant AS BIGINT) AS redundant, CAST(unique_fails AS BIGINT) AS unique_fails,
       CAST(good_lost AS BIGINT) AS good_lost, CAST(toxic_lost AS BIGINT) AS toxic_lost,
       CAST(sum(removed) OVER (PARTITION BY part, substr(filter_order, step, 1)) AS BIGINT) AS shapley
FROM summed
"""

OP13 = r"""
WITH docs AS (
    SELECT row_number() OVER () AS doc, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
           regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                              '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS terms FROM documents
), words AS (
    SELECT doc, lang, source, unnest(terms) AS term FROM docs
), vocabulary AS (
    SELECT lang, term, count(*) AS n FROM words GROUP BY lang, term HAVING count(DISTINCT doc) >= 10
), counts AS (
    SELECT lang, source, term, count(*) AS n FROM words JOIN vocabulary USING (lang, term) GROUP BY ALL
), langs AS (
    SELECT lang, count(*) AS v, sum(n) AS total FROM vocabulary GROUP BY lang
), groups AS (
    SELECT g.lang, g.source, coalesce(l.v, 0) AS v, coalesce(c.total, 0) AS total
    FROM (SELECT DISTINCT lang, source FROM docs) g LEFT JOIN langs l USING (lang)
    LEFT JOIN (SELECT lang, source, sum(n) AS total FROM counts GROUP BY lang, source) c USING (lang, source)
), shares AS (
    SELECT g.lang, g.source, w.term, coalesce(c.n, 0) AS n,
           1 + (1000000000::HUGEINT * (coalesce(c.n, 0) + 2)) // (g.total + 2 * g.v) AS p,
           1 + (1000000000::HUGEINT * (w.n + 2)) // (l.total + 2 * l.v) AS q
    FROM groups g JOIN vocabulary w USING (lang) JOIN langs l USING (lang) LEFT JOIN counts c USING (lang, source, term)
), pairs AS (
    SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // (a.p + b.p)) AS value
    FROM shares a JOIN shares b USING (lang, term) WHERE a.source <> b.source GROUP BY ALL
), found AS (
    SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(value, 0) AS value
    FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source
    LEFT JOIN pairs p ON p.lang = a.lang AND p.source = a.source AND p.item = b.source
    UNION ALL
    SELECT lang, source, 'term', term, (p - q) * (p - q) // (p + q) FROM shares WHERE n > 0 AND p > q
), ranked AS (
    SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank FROM found
)
SELECT lang, source, part, item, CAST(value AS BIGINT) AS value, CAST(rank AS INTEGER) AS rank FROM ranked WHERE part = 'pair' OR rank <= 10
"""

SQL = {"op2_quality_rules": OP2, "op8_warc": OP8, "op1_decontamination": OP1, "op12_filter_audit": OP12, "op13_source_divergence": OP13}
