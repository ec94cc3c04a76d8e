"""SQL that states the results of the operators' queries independently of the Spark code."""

MIXING = r"""
WITH RECURSIVE d AS (
  SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size
  FROM documents),
s AS (
  SELECT source, CAST(sum(size) AS DOUBLE) AS words, count(*) AS n,
         [5.0, 2.0, 1.0][1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3]::DOUBLE AS weight
  FROM d GROUP BY source),
ratios AS (
  -- sources in the order in which a rising level fills them
  SELECT *, 2 * words AS cap, 2 * words / weight AS ratio FROM s),
levels AS (
  SELECT r.ratio,
         (SELECT (1.5 * (SELECT sum(words) FROM s) - coalesce(sum(CASE WHEN x.ratio < r.ratio THEN x.cap END), 0))
                 / sum(CASE WHEN x.ratio >= r.ratio THEN x.weight END) FROM ratios x) AS level
  FROM ratios r),
level AS (SELECT arg_min(level, ratio) FILTER (WHERE level <= ratio) AS level FROM levels),
t AS (
  SELECT source, words, CASE WHEN weight * level >= cap THEN cap ELSE weight * level END AS target
  FROM ratios, level),
p AS (
  SELECT *, CASE WHEN words > 0 THEN floor(target / words) ELSE 0 END AS whole FROM t),
o AS (
  SELECT d.*, p.words, p.target, p.whole, md5('mix:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS ticket
  FROM d JOIN p ON d.source IS NOT DISTINCT FROM p.source),
c AS (
  SELECT *, coalesce(sum(size) OVER (PARTITION BY source ORDER BY ticket ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)
            AS before
  FROM o)
SELECT doc_id, size, CAST(words AS BIGINT) AS source_size, target,
       CAST(size * (whole + CASE WHEN before + size / 2.0 <= target - whole * words THEN 1 ELSE 0 END) AS BIGINT) AS taken
FROM c
"""

LINE_DEDUP = r"""
WITH lines AS (
  SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
         generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS pos
  FROM documents),
keyed AS (
  SELECT *, translate(regexp_replace(line, '^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$', '', 'g'),
                      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
  FROM lines),
held AS (
  SELECT key, min(doc_id) AS holder FROM keyed WHERE length(key) >= 10 GROUP BY key HAVING count(DISTINCT doc_id) > 1),
marked AS (
  SELECT k.doc_id, k.pos, k.line, (h.holder IS NOT NULL AND h.holder <> k.doc_id) AS gone
  FROM keyed k LEFT JOIN held h ON k.key = h.key)
SELECT doc_id, CAST(count(*) AS BIGINT) AS n_lines, CAST(sum(CASE WHEN gone THEN 1 ELSE 0 END) AS BIGINT) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM marked GROUP BY doc_id
"""

SECRETS = r"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
patterns(kind, pattern, grp, least) AS (VALUES
  ('assign', '([pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]|[tT][oO][kK][eE][nN]|[aA][pP][iI]_?[kK][eE][yY])["'']?\x20*[:=]\x20*["'']?([A-Za-z0-9+/_.=-]+)', 2, 6),
  ('access', 'AKIA[A-Z0-9]+', 0, 20),
  ('hex', '[0-9a-f]+', 0, 24),
  ('run', '[A-Za-z0-9+/_=-]+', 0, 20)),
hits AS (
  SELECT doc_id, 'assign' AS kind, regexp_split_to_array(text, p.pattern) AS gaps, regexp_extract_all(text, p.pattern) AS found,
         regexp_extract_all(text, p.pattern, 2) AS vals, 6 AS least
  FROM d, (SELECT pattern FROM patterns WHERE kind = 'assign') p
  UNION ALL
  SELECT doc_id, kind, regexp_split_to_array(text, pattern), regexp_extract_all(text, pattern), regexp_extract_all(text, pattern), least
  FROM d, patterns WHERE kind <> 'assign'),
each AS (
  SELECT doc_id, kind, least, unnest(found) AS hit, unnest(vals) AS val, unnest(gaps[1:len(found)]) AS gap,
         generate_subscripts(found, 1) AS nth
  FROM hits WHERE len(found) > 0),
placed AS (
  SELECT *, sum(length(gap) + length(hit)) OVER (PARTITION BY doc_id, kind ORDER BY nth) AS stop FROM each),
spans AS (
  SELECT doc_id, kind, CAST(stop - length(hit) AS BIGINT) AS start, CAST(stop AS BIGINT) AS stop, hit
  FROM placed WHERE length(val) >= least),
base AS (SELECT * FROM spans WHERE kind <> 'run'),
allowed AS (SELECT '(?:[/\n](?:(?:[a-z]{2,}(?:[_-][a-z]+)*|[A-Z][a-z]+|[0-9]{2,})[/\n])+)|(?:\n)|(?:[0-9a-fA-F]{8}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{12})|(?:[0-9]{4}-[0-9]{2}-[0-9]{2})|(?:[eE][xX][aA][mM][pP][lL][eE]|[sS][aA][mM][pP][lL][eE]|[pP][lL][aA][cC][eE][hH][oO][lL][dD]|[xX]{4}|[tT][eE][sS][tT])' AS pattern),
cut AS (
  SELECT doc_id, start, regexp_split_to_array(chr(10) || hit || chr(10), pattern) AS gaps,
         list_concat(regexp_extract_all(chr(10) || hit || chr(10), pattern), ['']) AS parts
  FROM spans, allowed WHERE kind = 'run'),
pieces AS (
  SELECT doc_id, start AS run, unnest(gaps) AS hit, unnest(parts) AS part, generate_subscripts(gaps, 1) AS nth FROM cut),
between AS (
  SELECT doc_id, hit,
         run - 1 + sum(length(hit) + length(part)) OVER (PARTITION BY doc_id, run ORDER BY nth) - length(part) - length(hit) AS start
  FROM pieces),
runs AS (
  SELECT doc_id, CAST(start AS BIGINT) AS start, hit,
         CASE WHEN regexp_full_match(hit, '[0-9a-fA-F]+') THEN 2.95 WHEN regexp_full_match(hit, '[a-z0-9]+|[A-Z0-9]+') THEN 3.4 ELSE 3.68 END AS bits
  FROM between WHERE length(hit) >= 20 AND regexp_matches(hit, '[0-9]') AND regexp_matches(hit, '[A-Za-z]')),
windows AS (
  SELECT doc_id, start, hit, bits, unnest(range(0, length(hit) - 19)) AS off FROM runs),
peaks AS (
  SELECT doc_id, start, min(off) AS first, max(off) AS last
  FROM windows WHERE list_aggregate(string_split(substring(hit, CAST(off AS INTEGER) + 1, 20), ''), 'entropy') >= bits
  GROUP BY doc_id, start, hit),
extra AS (
  SELECT doc_id, 'entropy' AS kind, start + first AS start, start + last + 20 AS stop FROM peaks p
  WHERE NOT EXISTS (SELECT 1 FROM base b WHERE b.doc_id = p.doc_id AND b.start <= p.start + p.first AND b.stop >= p.start + p.last + 20)),
every AS (
  SELECT doc_id, kind, start, stop FROM base UNION ALL SELECT doc_id, kind, start, stop FROM extra),
ordered AS (
  SELECT doc_id, kind, kind || ':' || start || ':' || stop AS span, start,
         list_position(['assign', 'access', 'hex', 'entropy'], kind) AS nth
  FROM every),
joined AS (
  SELECT doc_id, count(*) FILTER (WHERE kind = 'assign') AS n_assign, count(*) FILTER (WHERE kind = 'access') AS n_access,
         count(*) FILTER (WHERE kind = 'hex') AS n_hex,
         string_agg(span, ',' ORDER BY start, nth) FILTER (WHERE kind <> 'entropy') AS base,
         string_agg(span, ',' ORDER BY start, nth) AS spans
  FROM ordered GROUP BY doc_id)
SELECT d.doc_id, CAST(coalesce(n_assign, 0) AS BIGINT) AS n_assign, CAST(coalesce(n_access, 0) AS BIGINT) AS n_access,
       CAST(coalesce(n_hex, 0) AS BIGINT) AS n_hex, sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM d LEFT JOIN joined j ON d.doc_id = j.doc_id
"""

NEAR_DUPLICATES = r"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x20\x09-\x0D]+') AS w
  FROM documents),
shingles AS (
  SELECT DISTINCT doc_id, array_to_string(w[i:i + 4], ' ') AS s
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS i FROM words WHERE len(w) > 0)),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
common AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c
  FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id <> b.doc_id GROUP BY 1, 2),
links AS (
  SELECT a, b FROM common JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b WHERE 100 * c >= 85 * (x.n + y.n - c)),
reached AS (
  SELECT a AS doc_id, a AS other FROM links UNION SELECT r.doc_id, l.b FROM reached r JOIN links l ON r.other = l.a)
SELECT w.doc_id, CAST(coalesce(n, 0) AS BIGINT) AS n_shingles, coalesce(c, w.doc_id) AS component_id,
       coalesce(c, w.doc_id) = w.doc_id AS kept
FROM words w LEFT JOIN sizes s ON s.doc_id = w.doc_id
LEFT JOIN (SELECT doc_id, min(other) AS c FROM reached GROUP BY doc_id) r ON r.doc_id = w.doc_id
"""

TOP_K = r"""
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_dot_product(q.v, c.v) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 50 = 0),
r AS (
  SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score
  FROM s)
SELECT * FROM r WHERE rank <= 5
"""

PREFIX_TRIE = r"""
WITH crc AS (
  -- the table of the reflected polynomial 0xEDB88320
  SELECT list_transform(range(256), lambda i: list_reduce(list_concat([i], range(8)),
           lambda v, x: CASE WHEN v & 1 = 1 THEN xor(3988292384, v >> 1) ELSE v >> 1 END)) AS t),
turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations WHERE conv_id IS NOT NULL),
c AS (
  SELECT conv_id, list({'role': role, 'text': text} ORDER BY turn NULLS FIRST, role, md5(strlen(role) || ':' || role || text)) AS ts
  FROM turns GROUP BY conv_id),
h AS (
  SELECT conv_id, ts, xor(4294967295, list_reduce(
           list_concat([4294967295], list_transform(string_split(CAST(conv_id AS VARCHAR), ''), lambda x: CAST(ascii(x) AS BIGINT))),
           lambda v, x: xor(t[1 + (xor(v, x) & 255)], v >> 8))) % 9 AS h
  FROM c, crc),
r AS (
  SELECT h.conv_id, list_concat(coalesce(b.ts[1:h], []), h.ts[h + 1:]) AS ts
  FROM h LEFT JOIN c b ON b.conv_id = h.conv_id - h.conv_id % 5),
p AS (
  SELECT conv_id, len(ts) AS length, d AS depth, ts[1:d] AS key, coalesce(strlen(ts[d].text), 0) AS bytes
  FROM (SELECT *, unnest(range(0, len(ts) + 1)) AS d FROM r)),
n AS (
  SELECT depth, key, min(conv_id) AS conv_id, count(*) AS n_convs, max(bytes) AS bytes,
         string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (WHERE length = depth) AS ends
  FROM p GROUP BY depth, key),
children AS (SELECT key[1:depth - 1] AS key, depth - 1 AS depth, count(*) AS n_children FROM n WHERE depth > 0 GROUP BY 1, 2),
k AS (SELECT n.*, coalesce(n_children, 0) AS n_children FROM n LEFT JOIN children c ON n.depth = c.depth AND n.key = c.key),
s AS (
  SELECT key[1:d] AS key, d AS depth, sum((n_convs - 1) * bytes) AS saved, count(*) FILTER (WHERE n_children = 0) AS leaves
  FROM (SELECT *, unnest(range(0, depth + 1)) AS d FROM k) GROUP BY 1, 2)
SELECT CAST(k.conv_id AS BIGINT) AS conv_id, CAST(k.depth AS BIGINT) AS depth, CAST(up.conv_id AS BIGINT) AS parent_conv_id,
       CAST(k.n_convs AS BIGINT) AS n_convs, CAST(k.n_children AS BIGINT) AS n_children, CAST(s.leaves AS BIGINT) AS n_leaves,
       CAST(s.saved AS BIGINT) AS saved_tokens, sha256(coalesce(k.ends, '')) AS ends_sha256
FROM k JOIN s ON k.depth = s.depth AND k.key = s.key
LEFT JOIN n up ON up.depth = k.depth - 1 AND up.key = k.key[1:k.depth - 1]
"""

HARD_NEGATIVES = r"""
WITH e AS (
  SELECT vec_id, CAST(CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS BIGINT) AS label,
         list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
pairs AS (
  SELECT a.vec_id AS anchor_id, b.vec_id AS other_id, a.label = b.label AS same,
         CAST(list_dot_product(a.v, b.v) AS BIGINT) AS score
  FROM e a JOIN e b ON a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id),
positives AS (
  SELECT anchor_id, other_id AS positive_id, score AS positive_score FROM pairs WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other_id) <= 5),
negatives AS (
  SELECT p.*, n.other_id AS negative_id, n.score AS negative_score,
         row_number() OVER (PARTITION BY p.anchor_id, positive_id ORDER BY n.score DESC, n.other_id) AS rank
  FROM positives p JOIN pairs n ON n.anchor_id = p.anchor_id AND NOT n.same
   AND 30 * positive_score <= 100 * n.score AND 100 * n.score <= 90 * positive_score)
SELECT anchor_id, positive_id, CAST(rank AS INTEGER) AS rank, negative_id, positive_score, negative_score
FROM negatives WHERE rank <= 10
"""
