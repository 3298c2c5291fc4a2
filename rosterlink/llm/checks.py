"""DuckDB SQL for the operators that SQL can express over whole tables."""

# The white space of words and lines, and letters that count as lower case.
_SPACES = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
_LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

OP8 = f"""
WITH lines AS (
    SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
        generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS place
    FROM documents),
keyed AS (SELECT *, {_LOWER.format(f"trim(line, {_SPACES})")} AS key FROM lines),
repeated AS (
    SELECT key, max(doc_id) AS keeper FROM keyed WHERE length(key) >= 40
    GROUP BY key HAVING count(DISTINCT doc_id) >= 5),
judged AS (
    SELECT k.*, r.keeper IS NOT NULL AND r.keeper <> k.doc_id AS dropped
    FROM keyed k LEFT JOIN repeated r ON k.key = r.key)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE dropped) AS n_dropped,
    sha256(coalesce(string_agg(line, chr(10) ORDER BY place) FILTER (WHERE NOT dropped), '')) AS kept_sha256
FROM judged GROUP BY doc_id
"""

OP5 = """
WITH vectors AS (
    SELECT vec_id, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)::BIGINT) AS numbers
    FROM embeddings WHERE embedding IS NOT NULL
        AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = len(embedding)),
scored AS (
    SELECT q.vec_id AS query_id, v.vec_id,
        list_sum(list_transform(list_zip(q.numbers, v.numbers), lambda z: z[1] * z[2]))::BIGINT AS score
    FROM vectors q JOIN vectors v ON q.vec_id % 100 = 0 AND q.vec_id <> v.vec_id),
ranked AS (
    SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank, vec_id, score
    FROM scored)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 10
"""

OP1 = """
WITH RECURSIVE vectors AS (
    SELECT vec_id, embedding::DOUBLE[] AS e FROM embeddings WHERE embedding IS NOT NULL
        AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = len(embedding)
        AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
links AS (
    SELECT a.vec_id AS a, b.vec_id AS b FROM vectors a JOIN vectors b
        ON a.vec_id <> b.vec_id AND list_cosine_similarity(a.e, b.e) >= 0.95),
reached AS (
    SELECT a, b FROM links UNION SELECT r.a, l.b FROM reached r JOIN links l ON r.b = l.a),
least AS (SELECT a, min(b) AS b FROM reached GROUP BY a),
counts AS (SELECT a, count(*) AS n FROM links GROUP BY a)
SELECT v.vec_id, coalesce(c.n, 0) AS n_links, least(v.vec_id, coalesce(l.b, v.vec_id)) AS component_id,
    v.vec_id = least(v.vec_id, coalesce(l.b, v.vec_id)) AS kept
FROM embeddings v LEFT JOIN counts c ON c.a = v.vec_id LEFT JOIN least l ON l.a = v.vec_id
"""

OP9 = rf"""
WITH RECURSIVE words AS (
    SELECT doc_id, regexp_extract_all({_LOWER.format("coalesce(text, '')")}, '[^\x20\x09-\x0D]+') AS w FROM documents),
shingles AS (
    SELECT DISTINCT doc_id, array_to_string(w[i : i + 2], ' ') AS s
    FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 2, 1) + 1)) AS i FROM words WHERE len(w) > 0)),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
shared AS (
    SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS n FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id <> b.doc_id
    GROUP BY ALL),
links AS (
    SELECT a, b FROM shared s JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b
    WHERE 100 * s.n >= 90 * (x.n + y.n - s.n)),
reached AS (SELECT a, b FROM links UNION SELECT r.a, l.b FROM reached r JOIN links l ON r.b = l.a),
least AS (SELECT a, min(b) AS b FROM reached GROUP BY a)
SELECT d.doc_id, coalesce(z.n, 0) AS n_shingles, least(d.doc_id, coalesce(l.b, d.doc_id)) AS component_id
FROM documents d LEFT JOIN sizes z ON z.doc_id = d.doc_id LEFT JOIN least l ON l.a = d.doc_id
"""

# Length of a turn: its text, a backslash for each mark in it, and the marks and blanks around it.
_MARK = r"[<\[]\\*(?:/?(?:INST|SYS|ROLE|TEXT)\]|/?s>)"
_OP12_MARKS = f"len(regexp_extract_all({{}}, '{_MARK}'))"
OP12 = f"""
WITH rows AS (
    SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
    UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]'
    UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]')
SELECT conv_id, count(*) AS n_turns,
    sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
    coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0)::BIGINT AS loss_chars,
    sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
    sum(length(text) + {_OP12_MARKS.format('text')} + CASE role WHEN 'system' THEN 13 WHEN 'user' THEN 15 WHEN 'assistant' THEN 9
        ELSE 23 + length(role) + {_OP12_MARKS.format('role')} END)::BIGINT AS formatted_chars
FROM rows GROUP BY conv_id
"""

OP11 = rf"""
WITH pieces AS (
    SELECT coalesce(lang, 'und') AS lang,
        unnest(regexp_split_to_array({_LOWER.format("coalesce(text, '')")}, '[.,;:!?\x0A-\x0D]')) AS piece FROM documents),
words AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces),
runs AS (
    SELECT lang, k, array_to_string(w[i : i + k - 1], ' ') AS phrase
    FROM (SELECT lang, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM words, (SELECT unnest([1, 2, 3]) AS k))),
counts AS (SELECT lang, k, phrase, count(*) AS f FROM runs GROUP BY ALL HAVING count(*) >= 10),
sizes AS (SELECT lang, sum(len(w))::BIGINT AS n FROM words GROUP BY lang),
cuts AS (
    SELECT c.lang, c.phrase, c.f AS a, cut, x.f AS l, y.f AS r,
        (1000000::HUGEINT * c.f * c.f // (x.f::HUGEINT * y.f))::BIGINT AS score
    FROM (SELECT *, unnest(range(1, k)) AS cut, string_split(phrase, ' ') AS w FROM counts WHERE k > 1) c
    JOIN counts x ON x.lang = c.lang AND x.phrase = array_to_string(c.w[1 : cut], ' ')
    JOIN counts y ON y.lang = c.lang AND y.phrase = array_to_string(c.w[cut + 1 : c.k], ' ')),
lowest AS (SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1),
inner_runs AS (
    SELECT lang, unnest([array_to_string(w[1 : 2], ' '), array_to_string(w[2 : 3], ' ')]) AS phrase, f
    FROM (SELECT *, string_split(phrase, ' ') AS w FROM counts WHERE k = 3)),
longer AS (SELECT lang, phrase, max(f) AS f FROM inner_runs GROUP BY ALL),
ranked AS (
    SELECT c.*, row_number() OVER (PARTITION BY c.lang ORDER BY score DESC, a DESC, encode(c.phrase)) AS rank
    FROM lowest c LEFT JOIN longer g ON g.lang = c.lang AND g.phrase = c.phrase WHERE g.f IS NULL OR 100 * g.f < 50 * a)
SELECT lang, rank, phrase, a, l, r, n, score FROM ranked JOIN sizes USING (lang) WHERE rank <= 2000
"""

# crc32 byte by byte: the table of its 256 remainders, then one step for each byte.
_CRC_STEP = "xor(c >> 1, CASE WHEN c & 1 = 1 THEN 3988292384 ELSE 0 END)::UBIGINT"
OP13 = rf"""
WITH RECURSIVE remainders(i, c, step) AS (
    SELECT i::UBIGINT, i::UBIGINT, 0 FROM range(256) t(i)
    UNION ALL SELECT i, {_CRC_STEP}, step + 1 FROM remainders WHERE step < 8),
crc AS (SELECT list(c ORDER BY i) AS t FROM remainders WHERE step = 8),
runs AS (
    SELECT doc_id, {_LOWER.format("unnest(regexp_extract_all(text, '[A-Za-z\u00C0-\u00FF]+'))")} AS run FROM documents),
counted AS (SELECT doc_id, run, count(*) AS n FROM runs WHERE length(run) >= 7 GROUP BY ALL),
spelt AS (SELECT *, hex(encode(coalesce(doc_id::VARCHAR, '') || ':' || run)) AS h FROM counted),
summed AS (
    SELECT run, n, xor(list_reduce(
        list_transform(range(len(h) // 2), lambda k: ('0x' || substr(h, 2 * k + 1, 2))::UBIGINT),
        lambda c, b: xor(c >> 8, t[((xor(c, b) & 255) + 1)::BIGINT])::UBIGINT, 4294967295::UBIGINT), 4294967295::UBIGINT) AS h
    FROM spelt, crc),
results AS (
    SELECT n, CASE WHEN h % 31 = 0 THEN substr(run, 1, (h % length(run))::BIGINT) || substr(run, (h % length(run))::BIGINT + 2) ELSE run END AS word
    FROM summed),
words AS (SELECT word, sum(n)::BIGINT AS n FROM results WHERE length(word) >= 7 GROUP BY word HAVING sum(n) >= 2),
gone AS (
    SELECT word, n, i, substr(word, 1, i) || substr(word, i + 2) AS rest
    FROM (SELECT *, unnest(range(length(word))) AS i FROM words)),
near AS (
    SELECT a.word, b.word AS other, b.n FROM gone a JOIN gone b ON a.rest = b.rest AND a.i = b.i AND a.word <> b.word
    UNION SELECT a.word, b.word, b.n FROM gone a JOIN words b ON a.rest = b.word
    UNION SELECT b.word, a.word, a.n FROM gone a JOIN words b ON a.rest = b.word),
best AS (
    SELECT word, count(*) AS n_near, first(other ORDER BY n DESC, encode(other)) AS other, max(n) AS n FROM near GROUP BY word),
judged AS (
    SELECT w.word, w.n, coalesce(b.n_near, 0) AS n_near, CASE WHEN b.n >= 10 * w.n THEN b.other END AS form,
        CASE WHEN b.n >= 10 * w.n THEN b.n END AS form_n
    FROM words w LEFT JOIN best b ON b.word = w.word),
ways(word, spot) AS (
    SELECT word, word FROM judged UNION ALL SELECT w.word, j.form FROM ways w JOIN judged j ON j.word = w.spot WHERE j.form IS NOT NULL),
roots AS (SELECT w.word, w.spot AS root FROM ways w JOIN judged j ON j.word = w.spot WHERE j.form IS NULL)
SELECT word, form, root, n, n_near, form_n FROM judged JOIN roots USING (word)
"""
