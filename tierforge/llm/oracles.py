"""DuckDB SQL for the queries that SQL can express; the others are held against brute force in tests/llm."""

OP1_QUALITY_RULES = r"""
WITH docs AS (
  SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text FROM documents
), split AS (
  SELECT r, doc_id, text, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS words,
         list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines
  FROM docs
), windows AS (
  SELECT r, unnest(range(1, len(words) - 1)) AS i, words FROM split WHERE len(words) >= 3
), grams AS (
  SELECT r, i, count(*) OVER (PARTITION BY r, words[i], words[i + 1], words[i + 2]) AS n FROM windows
), hit AS (
  SELECT r, count(DISTINCT p) AS n_repeat_words
  FROM (SELECT r, unnest([i, i + 1, i + 2]) AS p FROM grams WHERE n > 1) GROUP BY r
), top AS (
  SELECT r, max(c) AS n_top FROM (SELECT r, w, count(*) AS c FROM (SELECT r, unnest(words) AS w FROM split) GROUP BY r, w) GROUP BY r
), counted AS (
  SELECT doc_id, len(words)::BIGINT AS n_words,
         coalesce(list_sum(list_transform(words, lambda w: length(w))), 0)::BIGINT AS word_chars,
         (length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols,
         (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines, len(lines) AS n_lines,
         coalesce(n_repeat_words, 0)::BIGINT AS n_repeat_words, coalesce(n_top, 0) AS n_top,
         length(text) - length(regexp_replace(text, '[A-Z]', '', 'g')) AS n_upper,
         length(text) - length(replace(text, '!', '')) AS n_exclaims
  FROM split LEFT JOIN hit USING (r) LEFT JOIN top USING (r)
), based AS (
  SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM counted
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND NOT (10 * n_symbols > n_words) AND NOT (2 * n_dup_lines > n_lines)
       AND NOT (word_chars < 2 * n_words OR word_chars > 12 * n_words) AND NOT (10 * n_top > 3 * n_words)
       AND NOT (10 * n_upper > 4 * word_chars) AND NOT (2 * n_exclaims > n_words) AS kept
FROM based
"""

OP2_PII = r"""
WITH docs AS (
  SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t FROM documents
), kinds(kind, name, pat) AS (
  VALUES (0, 'email', '[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+'), (1, 'ip', '[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)'),
         (2, 'card', '[0-9]([\x20-]?[0-9])+'), (3, 'phone', '\+[0-9][\x20().0-9-]+[0-9]')
), hits AS (
  SELECT r, kind, name, regexp_extract_all(t, pat) AS ms, string_split_regex(t, pat) AS gaps FROM docs, kinds WHERE regexp_matches(t, pat)
), each AS (
  SELECT r, kind, name, i, gaps[i] AS gap, ms[i] AS v FROM (SELECT *, unnest(range(1, len(ms) + 1)) AS i FROM hits)
), placed AS (
  SELECT r, kind, name, v, sum(length(gap) + length(v)) OVER (PARTITION BY r, kind ORDER BY i) AS e, regexp_replace(v, '[^0-9]', '', 'g') AS d FROM each
), base AS (
  SELECT r, kind, name, v, d, (e - length(v))::BIGINT AS s, e::BIGINT AS e FROM placed
  WHERE CASE kind
    WHEN 0 THEN true
    WHEN 1 THEN len(list_filter(string_split(v, '.'), lambda x: length(ltrim(x, '0')) > 3 OR try_cast(ltrim(x, '0') AS INTEGER) > 255)) = 0
    WHEN 2 THEN length(d) BETWEEN 14 AND 19 AND list_sum(list_transform(range(1, length(d) + 1), lambda i:
      CASE WHEN i % 2 = 1 THEN d[length(d) + 1 - i]::INTEGER WHEN d[length(d) + 1 - i]::INTEGER > 4 THEN 2 * d[length(d) + 1 - i]::INTEGER - 9
           ELSE 2 * d[length(d) + 1 - i]::INTEGER END)) % 10 = 0
    ELSE length(d) BETWEEN 10 AND 15 END
), mentions AS (
  SELECT row_number() OVER () AS m, r, name || ':' || CASE kind WHEN 0 THEN lower(v) WHEN 1 THEN v ELSE d END AS entity, e AS high, greatest(s - 100, 0) AS low0,
         substr(t, greatest(s - 100, 0) + 1, s - greatest(s - 100, 0)) AS left0,
         CASE WHEN e + 100 < length(t) THEN regexp_replace(substr(t, e + 1, 100), '\p{L}+$', '') ELSE substr(t, e + 1, 100) END AS rgt
  FROM base JOIN docs USING (r)
), around AS (
  SELECT r, entity, substr(left0, CASE WHEN low0 > 0 THEN length(regexp_extract(left0, '^\p{L}+')) ELSE 0 END + 1) AS lft, rgt FROM mentions
), runs AS (
  SELECT r, regexp_extract_all(t, '\p{L}{2,}') AS ms, string_split_regex(t, '\p{L}{2,}') AS gaps FROM docs WHERE r IN (SELECT r FROM base)
), terms AS (
  SELECT r, lower(v) AS term, length(v) AS n, sum(length(gap) + length(v)) OVER (PARTITION BY r ORDER BY i) AS e
  FROM (SELECT r, i, ms[i] AS v, gaps[i] AS gap FROM (SELECT *, unnest(range(1, len(ms) + 1)) AS i FROM runs))
), free AS (
  SELECT r, term, (e - n)::BIGINT AS s, e::BIGINT AS e FROM terms
  WHERE NOT EXISTS (SELECT 1 FROM base b WHERE b.r = terms.r AND b.s < terms.e AND b.e > terms.e - terms.n)
), held AS (
  SELECT DISTINCT r, term FROM free
), pairs AS (
  SELECT entity, term, count(DISTINCT r) AS both_n FROM around JOIN held USING (r) GROUP BY entity, term HAVING count(DISTINCT (lft, rgt)) >= 3
), entities AS (
  SELECT entity, count(DISTINCT r) AS e_n FROM mentions GROUP BY entity
), words AS (
  SELECT term, count(*) AS t_n FROM (SELECT r, unnest(list_distinct(list_transform(regexp_extract_all(t, '\p{L}{2,}'), lambda x: lower(x)))) AS term FROM docs) GROUP BY term
), strong AS (
  SELECT entity, term FROM pairs JOIN entities USING (entity) JOIN words USING (term), (SELECT greatest(1, count(*))::DOUBLE AS n FROM docs)
  WHERE e_n < n AND log2(both_n * n / (e_n * t_n)) / log2(n / e_n) >= 0.9
), found AS (
  SELECT r, kind, name, s, e FROM base
  UNION ALL SELECT DISTINCT r, 4, 'term', s, e FROM free JOIN (SELECT DISTINCT r, entity FROM mentions) USING (r) JOIN strong USING (entity, term)
), summed AS (
  SELECT r, string_agg(name || ':' || s || ':' || e, ',' ORDER BY s, kind, e) AS spans,
         coalesce(string_agg(name || ':' || s || ':' || e, ',' ORDER BY s, kind, e) FILTER (kind < 4), '') AS base_spans,
         count(*) FILTER (kind = 0) AS n_email, count(*) FILTER (kind = 1) AS n_ip, count(*) FILTER (kind = 2) AS n_card,
         count(*) FILTER (kind = 3) AS n_phone, count(*) FILTER (kind = 4) AS n_term
  FROM found GROUP BY r
)
SELECT doc_id, coalesce(n_email, 0) AS n_email, coalesce(n_ip, 0) AS n_ip, coalesce(n_card, 0) AS n_card, coalesce(n_phone, 0) AS n_phone,
       sha256(coalesce(base_spans, '')) AS base_sha256, coalesce(spans, '') AS spans, coalesce(n_term, 0) AS n_term
FROM docs LEFT JOIN summed USING (r)
"""



def _above(z: str) -> str:
    """SQL for the chance of a standard normal value above ``z``."""
    x = f"(abs({z}) / sqrt(2))"
    t = f"(1 / (1 + 0.5 * {x}))"
    # fixed values: Chebyshev fit of the complementary error function
    poly = "-1.26551223"
    for i, c in enumerate((1.00002368, 0.37409196, 0.09678418, -0.18628806, 0.27886807, -1.13520398, 1.48851587, -0.82215223, 0.17087277)):
        poly += f" + {t} * ({c}"
    half = f"(0.5 * {t} * exp({poly}{')' * (i + 1)} - {x} * {x}))"
    return f"(CASE WHEN {z} >= 0 THEN {half} ELSE 1 - {half} END)"


OP11_SECRET_SCAN = rf"""
WITH docs AS (
  SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t FROM documents
), kinds(kind, name, pat) AS (
  VALUES (0, 'assign', '([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["'']?\x20*[:=]\x20*["'']?([A-Za-z0-9+/_.=-]+)'),
         (1, 'access', 'AKIA[A-Z0-9]+'), (2, 'hex', '[0-9a-f]+'), (3, 'random', '[A-Za-z0-9+/_-]{{16,}}={{0,2}}')
), hits AS (
  SELECT r, kind, name, pat, regexp_extract_all(t, pat) AS ms, string_split_regex(t, pat) AS gaps FROM docs, kinds WHERE regexp_matches(t, pat)
), each AS (
  SELECT r, kind, name, pat, i, gaps[i] AS gap, ms[i] AS v FROM (SELECT *, unnest(range(1, len(ms) + 1)) AS i FROM hits)
), placed AS (
  SELECT r, kind, name, pat, v, sum(length(gap) + length(v)) OVER (PARTITION BY r, kind ORDER BY i) AS e FROM each
), spans AS (
  SELECT r, kind, name, v, (e - length(v))::BIGINT AS s, e::BIGINT AS e FROM placed
  WHERE CASE kind WHEN 0 THEN length(regexp_extract(v, pat, 2)) >= 8 WHEN 1 THEN length(v) >= 16 WHEN 2 THEN length(v) >= 32 ELSE true END
), sets(size, encoding, symbols) AS (
  SELECT row_number() OVER (), a, b FROM (VALUES
    ('decimal', '0123456789'), ('hex', '0123456789abcdef'), ('HEX', '0123456789ABCDEF'), ('lower', 'abcdefghijklmnopqrstuvwxyz'),
    ('upper', 'ABCDEFGHIJKLMNOPQRSTUVWXYZ'), ('base32', 'ABCDEFGHIJKLMNOPQRSTUVWXYZ234567'), ('base36', '0123456789abcdefghijklmnopqrstuvwxyz'),
    ('BASE36', '0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZ'), ('letters', 'ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz'),
    ('base62', '0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz'),
    ('base64', 'ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/'),
    ('base64url', 'ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789-_'),
    ('mixed', 'ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/-_')) x(a, b)
), letters AS (
  SELECT c, count(*)::DOUBLE AS m FROM (SELECT unnest(string_split(t, '')) AS c FROM docs) WHERE regexp_full_match(c, '[A-Za-z0-9+/_-]') GROUP BY c
), cased AS (
  SELECT c, m, false AS folded FROM letters UNION ALL SELECT lower(c), sum(m), true FROM letters GROUP BY lower(c)
), moments AS (
  SELECT encoding, coalesce(sum(m * m) / (sum(m) * sum(m)), 1) AS two, coalesce(sum(m * m * m) / pow(sum(m), 3), 1) AS three
  FROM sets LEFT JOIN cased ON folded = (symbols IN (lower(symbols), upper(symbols))) AND contains(CASE WHEN folded THEN lower(symbols) ELSE symbols END, c)
  GROUP BY encoding
), tokens AS (
  SELECT v, regexp_replace(v, '=+$', '') AS s FROM (SELECT DISTINCT v FROM spans WHERE kind = 3)
), coded AS (
  SELECT v, s, arg_min(encoding, size) AS encoding, arg_min(symbols, size) AS symbols
  FROM tokens, sets WHERE translate(s, symbols, '') = '' GROUP BY v, s
), halved AS (
  SELECT *, length(s)::DOUBLE AS n, length(symbols)::DOUBLE AS k, list_transform(string_split(s, ''), lambda c: instr(symbols, c)) AS places,
         translate(s, symbols, repeat('0', length(symbols) // 2) || repeat('1', length(symbols) - length(symbols) // 2)) AS side
  FROM coded
), counted AS (
  SELECT v, encoding, n, k, list_sum(list_transform(string_split(symbols, ''), lambda c: (length(s) - length(replace(s, c, ''))) ** 2))::DOUBLE AS squares,
         (n - length(replace(side, '01', ''))) / 2 + (n - length(replace(side, '10', ''))) / 2 AS turns, length(replace(side, '0', ''))::DOUBLE AS ones,
         list_sum(places)::DOUBLE AS total, list_sum(list_transform(places, lambda x: x * x))::DOUBLE AS own,
         list_sum(list_transform(range(1, len(places) + 1), lambda i: places[i] * places[i % len(places) + 1]))::DOUBLE AS nxt
  FROM halved
), varied AS (
  SELECT *, 2 * ones * (n - ones) / n + 1 AS mean, n * own - total * total AS size, n * (n - 1) / 2 AS pairs,
         n * (n - 1) / 2 * (two - two * two) + n * (n - 1) * (n - 2) * (three - two * two) AS spread
  FROM counted JOIN moments USING (encoding)
), scored AS (
  SELECT *, (pow((k * squares / n - n) / (k - 1), 1 / 3.0::DOUBLE) - (1 - 2 / (9 * (k - 1)))) / sqrt(2 / (9 * (k - 1))) AS z_even,
         CASE WHEN (mean - 1) * (mean - 2) > 0 THEN abs(1 + turns - mean) / sqrt((mean - 1) * (mean - 2) / (n - 1)) END AS z_runs,
         CASE WHEN size > 0 THEN abs((n * nxt - total * total) / size + 1 / (n - 1)) / sqrt(n * n / ((n - 1) * (n - 1) * (n - 2))) END AS z_serial,
         CASE WHEN spread > 0 THEN -((squares - n) / 2 - pairs * two) / sqrt(spread) END AS z_text
  FROM varied
), tested AS (
  SELECT v, length(bin(n::BIGINT)) AS class, least(floor(-100 * log10(greatest(CASE
      WHEN {_above("z_even")} >= 0.001 / 3 AND coalesce(2 * {_above("z_runs")}, 0) >= 0.001 / 3 AND coalesce(2 * {_above("z_serial")}, 0) >= 0.001 / 3
      THEN coalesce({_above("z_text")}, 1) ELSE 1 END, 1e-300))), 30000) AS place
  FROM scored
), ranked AS (
  SELECT class, place, count(*) OVER (PARTITION BY class) AS m, count(*) OVER (PARTITION BY class ORDER BY place DESC RANGE UNBOUNDED PRECEDING) AS as_small FROM tested
), cuts AS (
  SELECT class, min(place) AS cut FROM ranked WHERE pow(10, -place / 100.0::DOUBLE) <= 0.01 * as_small / m GROUP BY class
), strange AS (
  SELECT v FROM tested JOIN cuts USING (class) WHERE place >= cut
), found AS (
  SELECT r, kind, name, s, e FROM spans WHERE kind < 3 OR v IN (SELECT v FROM strange)
), summed AS (
  SELECT r, string_agg(name || ':' || s || ':' || e, ',' ORDER BY s, kind) AS spans,
         string_agg(name || ':' || s || ':' || e, ',' ORDER BY s, kind) FILTER (kind < 3) AS base,
         count(*) FILTER (kind = 0) AS n_assign, count(*) FILTER (kind = 1) AS n_access, count(*) FILTER (kind = 2) AS n_hex, count(*) FILTER (kind = 3) AS n_random
  FROM found GROUP BY r
)
SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex, coalesce(n_random, 0) AS n_random,
       sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM docs LEFT JOIN summed USING (r)
"""

OP12_LEXICAL_SEARCH = r"""
WITH docs AS (
  SELECT row_number() OVER () AS r, doc_id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS words
  FROM documents
), items AS (
  SELECT row_number() OVER () AS q, item_id,
         list_distinct(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS words
  FROM benchmark
), totals AS (
  SELECT count(*) FILTER (len(words) > 0)::BIGINT AS n_all, sum(len(words))::BIGINT AS n_terms FROM docs
), tfs AS (
  SELECT r, term, count(*)::BIGINT AS tf FROM (SELECT r, unnest(words) AS term FROM docs) GROUP BY r, term
), weights AS (
  SELECT term, floor(1000 * ln((2.0::DOUBLE * n_all + 2) / (2.0::DOUBLE * df + 1)))::BIGINT AS w
  FROM (SELECT term, count(*) AS df FROM tfs GROUP BY term), totals
), scores AS (
  SELECT q, item_id, r, doc_id, sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (100 - 90 + ((90 * len(docs.words) * n_all) // n_terms)))))::BIGINT AS score
  FROM (SELECT q, item_id, unnest(words) AS term FROM items) JOIN tfs USING (term) JOIN weights USING (term) JOIN docs USING (r), totals
  GROUP BY q, item_id, r, doc_id
), placed AS (
  SELECT item_id, doc_id, score, row_number() OVER (PARTITION BY q ORDER BY score DESC, doc_id NULLS LAST)::INTEGER AS rank FROM scores WHERE score > 0
)
SELECT item_id, rank, doc_id, score FROM placed WHERE rank <= 10
"""

OP13_FILTER_AUDIT = r"""
WITH texts AS (
  SELECT doc_id, coalesce(text, '') AS t, coalesce(lang, '') AS part, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents
), lows AS (
  SELECT t, min(doc_id) AS low FROM texts GROUP BY t
), good AS (
  SELECT DISTINCT doc_id FROM labels WHERE quality = 1
), toxic AS (
  SELECT DISTINCT doc_id FROM labels WHERE toxic = 1
), marked AS (
  SELECT part, good.doc_id IS NOT NULL AS is_good, toxic.doc_id IS NOT NULL AS is_toxic, MAP {
    'A': len(w) < 100, 'B': 100 * len(list_distinct(w)) < 80 * len(w),
    'C': 100 * (length(t) - length(regexp_replace(t, '[A-Z]', '', 'g'))) > 10 * length(t),
    'D': regexp_matches(t, '[#$%&*|]'), 'E': coalesce(low < doc_id, false)} AS fails
  FROM texts JOIN lows USING (t) LEFT JOIN good USING (doc_id) LEFT JOIN toxic USING (doc_id)
), letters(x) AS (VALUES ('A'), ('B'), ('C'), ('D'), ('E')
), orders AS (
  SELECT a.x || b.x || c.x || d.x || e.x AS filter_order FROM letters a, letters b, letters c, letters d, letters e
  WHERE len(list_distinct([a.x, b.x, c.x, d.x, e.x])) = 5
), groups AS (
  SELECT part, fails, count(*) AS n, count(*) FILTER (is_good) AS good, count(*) FILTER (is_toxic) AS toxic FROM marked GROUP BY part, fails
), steps AS (
  SELECT part, filter_order, step, filter_order[step] AS f, n, good, toxic, fails[filter_order[step]] AS hit,
         len(list_filter(string_split(filter_order[1:step - 1], ''), lambda y: y <> '' AND fails[y])) > 0 AS gone,
         len(list_filter(map_values(fails), lambda v: v)) AS n_failed
  FROM groups, orders, (SELECT unnest(range(1, 6)) AS step)
), counted AS (
  SELECT part, filter_order, step::INTEGER AS step, f,
         coalesce(sum(n) FILTER (NOT hit AND NOT gone), 0)::BIGINT AS kept, coalesce(sum(n) FILTER (hit AND NOT gone), 0)::BIGINT AS removed,
         coalesce(sum(n) FILTER (hit AND gone), 0)::BIGINT AS redundant, coalesce(sum(n) FILTER (hit AND n_failed = 1), 0)::BIGINT AS unique_fails,
         coalesce(sum(good) FILTER (hit AND NOT gone), 0)::BIGINT AS good_lost, coalesce(sum(toxic) FILTER (hit AND NOT gone), 0)::BIGINT AS toxic_lost
  FROM steps GROUP BY part, filter_order, step, f
)
SELECT * EXCLUDE (f), sum(removed) OVER (PARTITION BY part, f)::BIGINT AS shapley FROM counted
"""

ORACLES: dict[str, str] = {
    "op1_quality_rules": OP1_QUALITY_RULES, "op2_pii": OP2_PII, "op11_secret_scan": OP11_SECRET_SCAN,
    "op12_lexical_search": OP12_LEXICAL_SEARCH, "op13_filter_audit": OP13_FILTER_AUDIT,
}
