"""DuckDB SQL of the queries, written from the contracts and not from the operators."""

from shardlog.llm.licenses import TEMPLATES

_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_WORDS = rf"regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

DECONTAMINATION = f"""
WITH item AS (SELECT item_id, {_WORDS} AS w FROM benchmark),
item_windows AS (
  SELECT DISTINCT item_id, n, array_to_string(w[i:i + n - 1], ' ') AS win FROM (
    SELECT item_id, w, least(13, len(w)) AS n, unnest(range(1, len(w) - least(13, len(w)) + 2)) AS i FROM item WHERE len(w) > 0)),
doc AS (SELECT doc_id, {_WORDS} AS w FROM documents),
sizes AS (SELECT DISTINCT n FROM item_windows),
hits AS (
  SELECT doc_id, i, win, n FROM (
    SELECT doc_id, n, i, array_to_string(w[i:i + n - 1], ' ') AS win FROM (
      SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM doc, sizes WHERE len(w) >= n))
  SEMI JOIN item_windows USING (n, win)),
words AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM hits) GROUP BY doc_id),
items AS (
  SELECT doc_id, count(*) AS n_items, string_agg(id, ',' ORDER BY id) AS ids FROM (
    SELECT DISTINCT doc_id, item_id::VARCHAR AS id FROM hits JOIN item_windows USING (n, win)) GROUP BY doc_id)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
  sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM doc LEFT JOIN words USING (doc_id) LEFT JOIN items USING (doc_id)
"""

LINE_DEDUP = r"""
WITH line AS (
  SELECT doc_id, unnest(string_split(text, chr(10))) AS line, unnest(range(len(string_split(text, chr(10))))) AS pos FROM documents),
win AS (
  SELECT doc_id, pos, line || chr(10) || lead(line, 1) OVER w || chr(10) || lead(line, 2) OVER w AS win FROM line
  WINDOW w AS (PARTITION BY doc_id ORDER BY pos)),
later AS (
  SELECT doc_id, pos FROM (
    SELECT doc_id, pos, row_number() OVER (PARTITION BY win ORDER BY doc_id, pos) AS nth FROM win
    WHERE win IS NOT NULL AND regexp_matches(win, '[^ \n\t\r]')) WHERE nth > 1),
covered AS (SELECT DISTINCT doc_id, unnest([pos, pos + 1, pos + 2]) AS pos FROM later)
SELECT doc_id, count(*) AS n_lines, count(c.pos) AS n_removed,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY l.pos) FILTER (c.pos IS NULL), '')) AS kept_sha256
FROM line l LEFT JOIN covered c USING (doc_id, pos) GROUP BY doc_id
"""

WARC = """
WITH page AS (SELECT page_id, strlen(coalesce(html, '')) AS n, sha256(coalesce(html, '')) AS digest FROM pages),
first AS (SELECT digest, min(page_id) AS first FROM page WHERE n >= 100 GROUP BY digest)
SELECT page_id, n::BIGINT AS payload_bytes, digest AS payload_digest,
  CASE WHEN first <> page_id THEN 'revisit' ELSE 'response' END AS record_type, CASE WHEN first <> page_id THEN first END AS refers_to
FROM page LEFT JOIN first USING (digest)
"""

TOP_K = """
WITH vec AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.v, c.v)::BIGINT AS score
  FROM vec q JOIN vec c ON q.vec_id % 50 = 0 AND q.vec_id <> c.vec_id)
SELECT query_id, rank::INTEGER AS rank, vec_id, score FROM (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM scored) WHERE rank <= 5
"""

_TEMPLATE_ROWS = ", ".join("('{}', '{}')".format(name, text.replace("'", "''")) for name, text in TEMPLATES)
_PLAIN_WORDS = r"list_filter(regexp_split_to_array(lower(coalesce(text, '')), '[^\p{L}\p{N}]+'), lambda w: w <> '')"
_SHINGLES = "[array_to_string(w[i:i + 4], ' ') for i in range(1, len(w) - 3)]"

LICENSE_SCAN = f"""
WITH template AS (
  SELECT license, list_distinct({_SHINGLES}) AS own FROM (SELECT license, {_PLAIN_WORDS} AS w FROM (VALUES {_TEMPLATE_ROWS}) t(license, text))),
doc AS (SELECT doc_id, unnest({_SHINGLES}) AS s, unnest(range(len({_SHINGLES}))) AS place FROM (SELECT doc_id, {_PLAIN_WORDS} AS w FROM documents)),
wanted AS (SELECT license, unnest(own) AS s, len(own) AS n FROM template)
SELECT doc_id, license, any_value(n)::BIGINT AS n_shingles, count(DISTINCT s) AS n_found, min(place)::BIGINT AS first_shingle
FROM doc JOIN wanted USING (s) GROUP BY doc_id, license HAVING count(DISTINCT s) >= 0.8 * any_value(n)
"""

PHRASES = f"""
WITH piece AS (
  SELECT coalesce(lang, 'und') AS lang, regexp_extract_all(unnest(regexp_split_to_array({_LOWER}, '[.,;:!?\\x0A-\\x0D]')), '[^ \\t]+') AS w FROM documents),
gram AS (SELECT lang, k, array_to_string(w[i:i + k - 1], ' ') AS phrase FROM (
  SELECT lang, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM piece, range(1, 6) t(k) WHERE len(w) >= k)),
f AS (SELECT lang, k, phrase, count(*) AS c FROM gram GROUP BY ALL),
total AS (SELECT lang, sum(c)::BIGINT AS n FROM f WHERE k = 1 GROUP BY lang),
cand AS (SELECT lang, k, phrase, string_split(phrase, ' ') AS w, c AS a FROM f WHERE k > 1 AND c >= 100),
part AS (SELECT lang, a, array_to_string(w[i:i + m - 1], ' ') AS phrase FROM (
  SELECT lang, a, w, m, unnest(range(1, k - m + 2)) AS i FROM cand, range(2, 5) t(m) WHERE m < k)),
covered AS (SELECT lang, phrase, max(a) AS longer FROM part GROUP BY ALL),
kept AS (SELECT cand.* FROM cand LEFT JOIN covered USING (lang, phrase) WHERE longer IS NULL OR 100 * longer < 100 * a),
cut AS (SELECT *, array_to_string(w[:i], ' ') AS left_part, array_to_string(w[i + 1:], ' ') AS right_part FROM (SELECT *, unnest(range(1, k)) AS i FROM kept)),
scored AS (
  SELECT cut.lang, cut.phrase, a, i, lf.c AS l, rf.c AS r, n, (1000::HUGEINT * a * n) // (lf.c::HUGEINT * rf.c) AS score
  FROM cut JOIN f lf ON lf.lang = cut.lang AND lf.phrase = left_part JOIN f rf ON rf.lang = cut.lang AND rf.phrase = right_part JOIN total ON total.lang = cut.lang),
least AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, i) = 1),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, encode(phrase)) AS rank FROM least)
SELECT lang, rank, phrase, a, l, r, n, score::BIGINT AS score FROM ranked WHERE rank <= 2000
"""

# CRC-32 of the UTF-8 bytes, bit by bit for its table and byte by byte for a text.
SPELLING = f"""
WITH RECURSIVE bits(b, c, k) AS (
  SELECT b, b::BIGINT, 0 FROM range(256) t(b)
  UNION ALL SELECT b, CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, k + 1 FROM bits WHERE k < 8),
crc AS (SELECT list(c ORDER BY b) AS tab FROM bits WHERE k = 8),
run AS (
  SELECT doc_id, run, count(*) AS times FROM (
    SELECT doc_id, unnest(regexp_extract_all({_LOWER}, '[a-zÀ-ÿ]{{7,}}')) AS run FROM documents) GROUP BY ALL),
coded AS (
  SELECT run, times, flatten(list_transform(string_split(doc_id || ':' || run, ''), lambda x:
    CASE WHEN unicode(x) < 128 THEN [unicode(x)::BIGINT] ELSE [192 + (unicode(x) >> 6)::BIGINT, 128 + (unicode(x) & 63)::BIGINT] END)) AS bytes FROM run),
hashed AS (
  SELECT run, times, xor(list_reduce(list_prepend(4294967295::BIGINT, bytes), lambda h, b: xor(h >> 8, tab[xor(h & 255, b) + 1])), 4294967295) AS h
  FROM coded, crc),
slipped AS (SELECT times, CASE WHEN h % 31 = 0 THEN run[:h % length(run)] || run[h % length(run) + 2:] ELSE run END AS word FROM hashed),
word AS (SELECT word, sum(times)::BIGINT AS n FROM slipped WHERE length(word) >= 7 GROUP BY word HAVING sum(times) >= 2),
short AS (SELECT word, n, length(word) AS size, i, word[:i - 1] || word[i + 1:] AS rest FROM (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM word)),
near AS (
  SELECT a.word, b.word AS other, b.n AS other_n FROM short a JOIN short b ON a.rest = b.rest AND a.i = b.i AND a.size = b.size AND a.word <> b.word
  UNION SELECT a.word, b.word, b.n FROM short a JOIN word b ON a.rest = b.word
  UNION SELECT b.word, a.word, a.n FROM short a JOIN word b ON a.rest = b.word),
best AS (
  SELECT word, count(*) OVER (PARTITION BY word) AS n_near, other, other_n FROM near
  QUALIFY row_number() OVER (PARTITION BY word ORDER BY other_n DESC, encode(other)) = 1),
formed AS (
  SELECT word, n, coalesce(n_near, 0) AS n_near, CASE WHEN other_n >= 10 * n THEN other END AS form, CASE WHEN other_n >= 10 * n THEN other_n END AS form_n
  FROM word LEFT JOIN best USING (word)),
walk(word, root) AS (
  SELECT word, word FROM formed
  UNION ALL SELECT walk.word, formed.form FROM walk JOIN formed ON formed.word = walk.root WHERE formed.form IS NOT NULL),
last AS (SELECT walk.word, root FROM walk JOIN formed ON formed.word = walk.root WHERE formed.form IS NULL)
SELECT word, form, root, n, n_near::BIGINT AS n_near, form_n FROM formed JOIN last USING (word)
"""
