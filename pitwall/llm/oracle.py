"""DuckDB equivalents of the queries that SQL can express."""

ORACLE_SQL: dict[str, str] = {}

ORACLE_SQL["op5_warc"] = """
WITH hashed AS (SELECT page_id, coalesce(html, '') AS html, sha1(coalesce(html, '')) AS hex FROM pages),
last AS (SELECT html, max(page_id) AS kept FROM hashed GROUP BY html)
SELECT page_id, strlen(h.html)::BIGINT AS payload_bytes,
  array_to_string(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + CAST(((
      16 * (instr('0123456789abcdef', substr(hex, 1 + CAST(5 * i // 4 AS INT), 1)) - 1)
      + greatest(0, instr('0123456789abcdef', nullif(substr(hex, 2 + CAST(5 * i // 4 AS INT), 1), '')) - 1)
    ) >> (3 - CAST(5 * i % 4 AS INT))) & 31 AS INT), 1)), '') AS payload_digest,
  CASE WHEN page_id = kept THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id <> kept THEN kept END AS refers_to
FROM hashed h JOIN last USING (html)
"""

ORACLE_SQL["op2_repeats"] = r"""
WITH doc AS (
  SELECT doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda w: w <> '') AS words
  FROM documents
), word AS (
  SELECT doc_id, unnest(words) AS word, unnest(range(1, len(words) + 1)) AS pos FROM doc
), win AS (
  SELECT doc_id, pos, array_to_string(words[pos : pos + 19], ' ') AS w
  FROM (SELECT doc_id, words, unnest(range(1, len(words) - 18)) AS pos FROM doc WHERE len(words) >= 20)
), later AS (
  SELECT doc_id, pos FROM (
    SELECT doc_id, pos, row_number() OVER (PARTITION BY w ORDER BY doc_id, pos) AS n FROM win) WHERE n > 1
), covered AS (
  SELECT DISTINCT doc_id, unnest(range(pos, pos + 20)) AS pos FROM later
), kept AS (
  SELECT word.doc_id, string_agg(word, ' ' ORDER BY pos) AS text, count(*) AS n
  FROM word ANTI JOIN covered USING (doc_id, pos) GROUP BY word.doc_id
)
SELECT doc_id, len(words)::BIGINT AS n_words, (len(words) - coalesce(n, 0))::BIGINT AS n_removed,
  sha256(coalesce(kept.text, '')) AS kept_sha256
FROM doc LEFT JOIN kept USING (doc_id)
"""

ORACLE_SQL["op7_minhash"] = r"""
WITH RECURSIVE doc AS (
  SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda w: w <> '') AS words
  FROM documents
), shingle AS (
  SELECT DISTINCT doc_id, array_to_string(words[pos : pos + 4], ' ') AS s
  FROM (SELECT doc_id, words, unnest(range(1, greatest(2, len(words) - 3))) AS pos FROM doc WHERE len(words) > 0)
), size AS (
  SELECT doc_id, count(*) AS n FROM shingle GROUP BY doc_id
), shared AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS n
  FROM shingle a JOIN shingle b ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY ALL
), link AS (
  SELECT a, b FROM shared JOIN size x ON x.doc_id = a JOIN size y ON y.doc_id = b
  WHERE 100 * shared.n >= 75 * (x.n + y.n - shared.n)
), near AS (
  SELECT a, b FROM link UNION ALL SELECT b, a FROM link
), reach AS (
  SELECT doc_id AS node, doc_id AS root FROM doc
  UNION
  SELECT b, root FROM reach JOIN near ON a = node
), component AS (
  SELECT node, min(root) AS root FROM reach GROUP BY node
)
SELECT doc_id, coalesce(size.n, 0)::BIGINT AS n_shingles, root AS component_id, root = doc_id AS kept
FROM doc LEFT JOIN size USING (doc_id) JOIN component ON node = doc_id
"""

ORACLE_SQL["op8_winnow"] = r"""
WITH doc AS (
  SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda w: w <> '') AS words FROM documents
), item AS (
  SELECT item_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda w: w <> '') AS words FROM benchmark
), item_window AS (
  SELECT DISTINCT item_id, n, array_to_string(words[pos : pos + n - 1], ' ') AS w FROM (
    SELECT item_id, words, least(13, len(words)) AS n, unnest(range(1, len(words) - least(13, len(words)) + 2)) AS pos
    FROM item WHERE len(words) > 0)
), lengths AS (
  SELECT DISTINCT n FROM item_window
), doc_window AS (
  SELECT doc_id, n, pos, array_to_string(words[pos : pos + n - 1], ' ') AS w FROM (
    SELECT doc_id, n, words, unnest(range(1, len(words) - n + 2)) AS pos FROM doc, lengths WHERE len(words) >= n)
), hit AS (
  SELECT doc_id, item_id, pos, n FROM doc_window JOIN item_window USING (n, w)
), covered AS (
  SELECT doc_id, count(DISTINCT place) AS n_hit FROM (
    SELECT doc_id, unnest(range(pos, pos + n)) AS place FROM hit) GROUP BY doc_id
), items AS (
  SELECT doc_id, count(*) AS n_items, string_agg(id, ',' ORDER BY id) AS ids FROM (
    SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS id FROM hit) GROUP BY doc_id
)
SELECT doc_id, len(words)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit,
  coalesce(n_items, 0)::BIGINT AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(words) AS contaminated
FROM doc LEFT JOIN covered USING (doc_id) LEFT JOIN items USING (doc_id)
"""

ORACLE_SQL["op6_lattice"] = """
WITH RECURSIVE vec AS (
  SELECT vec_id, label, embedding::DOUBLE[] AS e FROM embeddings
), usable AS (
  SELECT vec_id, label, e, sqrt(list_inner_product(e, e)) AS norm FROM vec
  WHERE label IS NOT NULL AND len(e) > 0 AND list_bool_and(list_transform(e, lambda x: x IS NOT NULL AND isfinite(x)))
    AND list_bool_or(list_transform(e, lambda x: x <> 0))
), near AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM usable a JOIN usable b
    ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.e) = len(b.e)
  WHERE list_inner_product(a.e, b.e) / (a.norm * b.norm) >= 0.93
), reach AS (
  SELECT vec_id AS node, vec_id AS root FROM vec
  UNION
  SELECT b, root FROM reach JOIN near ON a = node
), component AS (
  SELECT node, min(root) AS root FROM reach GROUP BY node
)
SELECT vec_id, (SELECT count(*) FROM near WHERE a = vec_id)::BIGINT AS n_links, root AS component_id,
  root = vec_id AS kept
FROM vec JOIN component ON node = vec_id
"""

ORACLE_SQL["op11_collocation"] = r"""
WITH piece AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
  FROM documents
), word AS (
  SELECT lang, words, len(words) AS n FROM (
    SELECT lang, list_filter(regexp_split_to_array(piece, '[\x20\x09]+'), lambda w: w <> '') AS words FROM piece)
), total AS (
  SELECT lang, sum(n)::BIGINT AS n FROM word GROUP BY lang
), gram AS (
  SELECT lang, k, array_to_string(words[pos : pos + k - 1], ' ') AS phrase FROM (
    SELECT lang, words, k, unnest(range(1, n - k + 2)) AS pos FROM word, range(1, 6) AS t(k) WHERE n >= k)
), freq AS (
  SELECT lang, k, phrase, string_split(phrase, ' ') AS words, count(*) AS f FROM gram GROUP BY ALL HAVING count(*) >= 100
), inside AS (
  SELECT lang, array_to_string(words[i : j], ' ') AS phrase, max(f) AS f FROM (
    SELECT lang, words, k, f, i, unnest(range(i + 1, k + 1)) AS j FROM (
      SELECT lang, words, k, f, unnest(range(1, k)) AS i FROM freq WHERE k > 2)) WHERE j - i + 1 < k GROUP BY ALL
), cut AS (
  SELECT lang, phrase, k, words, f AS a, unnest(range(1, k)) AS c FROM freq WHERE k > 1
), scored AS (
  SELECT cut.lang, cut.phrase, a, c, x.f AS l, y.f AS r, n,
    ((1000::HUGEINT * a * n) // (x.f::HUGEINT * y.f))::BIGINT AS score
  FROM cut JOIN total USING (lang)
    JOIN freq x ON x.lang = cut.lang AND x.phrase = array_to_string(cut.words[1 : c], ' ')
    JOIN freq y ON y.lang = cut.lang AND y.phrase = array_to_string(cut.words[c + 1 :], ' ')
), best AS (
  SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, c) = 1
)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score
FROM best LEFT JOIN inside USING (lang, phrase) WHERE inside.f IS NULL OR 100 * inside.f < 100 * a
QUALIFY rank <= 2000
"""

ORACLE_SQL["op12_trie"] = r"""
WITH turn AS (
  SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS k,
    struct_pack(role := coalesce(role, ''), text := coalesce(text, '')) AS t
  FROM conversations WHERE conv_id IS NOT NULL
), own AS (
  SELECT conv_id, list(t ORDER BY k) AS turns FROM turn GROUP BY conv_id
), head AS (
  SELECT conv_id, turns, xor(list_reduce(
      flatten(list_transform(string_split(conv_id::VARCHAR, ''), lambda x: [ord(x)::BIGINT, 0, 0, 0, 0, 0, 0, 0])),
      lambda a, b: xor(xor(a, b) >> 1, CASE WHEN xor(a, b) & 1 = 1 THEN 3988292384 ELSE 0 END),
      4294967295::BIGINT), 4294967295) % 9 AS h
  FROM own
), whole AS (
  SELECT c.conv_id, list_concat(coalesce(b.turns[1 : h], []), c.turns[h + 1 :]) AS turns
  FROM head c LEFT JOIN own b ON b.conv_id = c.conv_id - c.conv_id % 5
), prefix AS (
  SELECT conv_id, len(turns) AS n, unnest(range(0, len(turns) + 1)) AS depth, turns FROM whole
), node AS (
  SELECT depth, turns[1 : depth] AS path, min(conv_id) AS conv_id, count(*) AS n_convs,
    sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (WHERE n = depth), '')) AS ends_sha256
  FROM prefix GROUP BY ALL
), child AS (
  SELECT a.depth, a.path, count(b.depth) AS n_children, any_value(a.conv_id) AS conv_id
  FROM node a LEFT JOIN node b ON b.depth = a.depth + 1 AND b.path[1 : a.depth] = a.path GROUP BY ALL
), own_part AS (
  SELECT depth, path, n_children, CASE WHEN n_children = 0 THEN 1 ELSE 0 END AS leaf,
    CASE WHEN depth > 0 THEN (n_convs - 1) * strlen(path[depth].text) ELSE 0 END AS saved
  FROM node JOIN child USING (depth, path)
), below AS (
  SELECT path[1 : d] AS path, sum(leaf)::BIGINT AS n_leaves, sum(saved)::BIGINT AS saved_tokens
  FROM (SELECT path, leaf, saved, unnest(range(0, depth + 1)) AS d FROM own_part) GROUP BY ALL
)
SELECT node.conv_id, node.depth, parent.conv_id AS parent_conv_id, node.n_convs, o.n_children, n_leaves, saved_tokens, node.ends_sha256
FROM node JOIN own_part o ON o.path = node.path JOIN below ON below.path = node.path
  LEFT JOIN node parent ON parent.depth = node.depth - 1 AND parent.path = node.path[1 : node.depth - 1]
"""
