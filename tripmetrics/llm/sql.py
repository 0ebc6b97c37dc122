"""DuckDB SQL for the operators that plain SQL can express."""

WORDS = r"""list_filter(regexp_split_to_array(coalesce({text}, ''), '[\x20\x09-\x0D]+'), lambda w: w <> '')"""
LOWER = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

NEAR_DEDUP = f"""
WITH RECURSIVE w AS (
  SELECT doc_id, {WORDS.format(text=LOWER)} AS ws FROM documents
), pos AS (
  SELECT doc_id, ws, unnest(range(1, greatest(len(ws), 2)::BIGINT)) AS i FROM w WHERE len(ws) > 0
), sh AS (
  SELECT DISTINCT doc_id, CASE WHEN len(ws) = 1 THEN ws[1] ELSE ws[i] || ' ' || ws[i + 1] END AS g FROM pos
), n AS (
  SELECT doc_id, count(*) AS n FROM sh GROUP BY doc_id
), both_ AS (
  SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c
  FROM sh a JOIN sh b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY ALL
), e AS (
  SELECT x, y FROM both_ JOIN n p ON p.doc_id = x JOIN n q ON q.doc_id = y
  WHERE 100 * c >= 80 * (p.n + q.n - c)
), two AS (
  SELECT x, y FROM e UNION ALL SELECT y, x FROM e
), reach(doc_id, r) AS (
  SELECT doc_id, doc_id FROM documents
  UNION
  SELECT two.y, reach.r FROM reach JOIN two ON two.x = reach.doc_id
), c AS (
  SELECT doc_id, min(r) AS component_id FROM reach GROUP BY doc_id
)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, c.component_id, d.doc_id = c.component_id AS kept
FROM documents d LEFT JOIN n USING (doc_id) JOIN c USING (doc_id)
"""

SUBSTRING_DEDUP = f"""
WITH w AS (
  SELECT row_number() OVER () AS r, doc_id, {WORDS.format(text="text")} AS ws FROM documents
), win AS (
  SELECT r, i, hash(array_to_string(ws[i:i + 34], ' ')) AS h, md5(array_to_string(ws[i:i + 34], ' ')) AS m
  FROM (SELECT r, ws, unnest(range(1, len(ws) - 33)) AS i FROM w WHERE len(ws) >= 35)
), rep AS (
  SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY h, m) AS c FROM win) WHERE c > 1
), gone AS (
  SELECT r, list_distinct(flatten(list(range(i, i + 35)))) AS g FROM rep GROUP BY r
), kept AS (
  SELECT w.doc_id, len(ws) AS n_words,
         CASE WHEN g IS NULL THEN ws
              ELSE list_transform(list_sort(list_where(range(1, len(ws) + 1),
                     list_transform(range(1, len(ws) + 1), lambda i: NOT list_contains(g, i)))), lambda i: ws[i]) END AS k
  FROM w LEFT JOIN gone USING (r)
)
SELECT doc_id, n_words, n_words - len(k) AS n_removed, sha256(array_to_string(k, ' ')) AS kept_sha256 FROM kept
"""

WARC = """
WITH p AS (
  SELECT page_id, octet_length(encode(coalesce(html, ''))) AS payload_bytes, upper(sha1(coalesce(html, ''))) AS hex
  FROM pages
), d AS (
  SELECT page_id, payload_bytes, array_to_string(flatten(list_transform(range(0, 8), lambda g:
           list_transform([15, 10, 5, 0], lambda s:
             substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
                    1 + ((('0x' || substr(hex, 1 + 5 * g, 5))::INT >> s::INT) & 31), 1)))), '') AS payload_digest
  FROM p
), f AS (
  SELECT *, min(page_id) OVER (PARTITION BY payload_digest) AS first_id FROM d
)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN page_id = first_id THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> first_id THEN first_id END AS refers_to
FROM f
"""

JACCARD_JOIN = f"""
WITH RECURSIVE w AS (
  SELECT doc_id, {WORDS.format(text=LOWER)} AS ws FROM documents
), pos AS (
  SELECT doc_id, ws, unnest(range(1, greatest(len(ws) - 3, 2)::BIGINT)) AS i FROM w WHERE len(ws) > 0
), sh AS (
  SELECT DISTINCT doc_id, hash(array_to_string(ws[i:i + 4], ' ')) AS h, md5(array_to_string(ws[i:i + 4], ' ')) AS m FROM pos
), n AS (
  SELECT doc_id, count(*) AS n FROM sh GROUP BY doc_id
), both_ AS (
  SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c
  FROM sh a JOIN sh b ON a.h = b.h AND a.m = b.m AND a.doc_id < b.doc_id GROUP BY ALL
), e AS (
  SELECT x, y FROM both_ JOIN n p ON p.doc_id = x JOIN n q ON q.doc_id = y
  WHERE 100 * c >= 80 * (p.n + q.n - c)
), two AS (
  SELECT x, y FROM e UNION ALL SELECT y, x FROM e
), reach(doc_id, r) AS (
  SELECT doc_id, doc_id FROM documents
  UNION
  SELECT two.y, reach.r FROM reach JOIN two ON two.x = reach.doc_id
), c AS (
  SELECT doc_id, min(r) AS component_id FROM reach GROUP BY doc_id
)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, c.component_id
FROM documents d LEFT JOIN n USING (doc_id) JOIN c USING (doc_id)
"""

# crc32 byte by byte, with a table of 256 entries made by eight shifts
VARIANTS = r"""
WITH RECURSIVE shift(i, c, k) AS (
  SELECT range, range::BIGINT, 0 FROM range(256)
  UNION ALL
  SELECT i, CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384::BIGINT) ELSE c >> 1 END, k + 1 FROM shift WHERE k < 8
), tab AS (
  SELECT list(c ORDER BY i) AS t FROM shift WHERE k = 8
), runs AS (
  SELECT coalesce(doc_id::VARCHAR, '') || ':' AS id,
         unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[a-z\x{C0}-\x{FF}]+')) AS run
  FROM documents
), seen AS (
  SELECT id, run, count(*) AS c, hex(encode(id || run)) AS x FROM runs WHERE length(run) >= 7 GROUP BY id, run
), hashed AS (
  SELECT run, c, xor(4294967295::BIGINT, list_reduce(
           list_prepend(4294967295::BIGINT, list_transform(range(0, length(x) // 2), lambda j: ('0x' || substr(x, 1 + 2 * j, 2))::BIGINT)),
           lambda h, b: xor(h >> 8, t[1 + (xor(h, b) & 255)]))) AS h
  FROM seen, tab
), word AS (
  SELECT CASE WHEN h % 31 = 0 THEN substr(run, 1, (h % length(run))::INT) || substr(run, (h % length(run))::INT + 2) ELSE run END AS word, c
  FROM hashed
), v AS (
  SELECT word, sum(c)::BIGINT AS n FROM word WHERE length(word) >= 7 GROUP BY word HAVING sum(c) >= 2
), del AS (
  SELECT word, i, substr(word, 1, i - 1) || substr(word, i + 1) AS d
  FROM (SELECT word, unnest(range(1, length(word) + 1))::INT AS i FROM v)
), near AS (
  SELECT DISTINCT del.word AS a, v.word AS b FROM del JOIN v ON del.d = v.word
  UNION SELECT DISTINCT v.word, del.word FROM del JOIN v ON del.d = v.word
  UNION SELECT x.word, y.word FROM del x JOIN del y ON x.d = y.d AND x.i = y.i AND x.word <> y.word
), best AS (
  SELECT a, count(*) AS n_near, first(b ORDER BY v.n DESC, encode(b)) AS b, max(v.n) AS m
  FROM near JOIN v ON v.word = b GROUP BY a
), f AS (
  SELECT v.word, v.n, coalesce(n_near, 0) AS n_near, CASE WHEN m >= 10 * v.n THEN b END AS form, CASE WHEN m >= 10 * v.n THEN m END AS form_n
  FROM v LEFT JOIN best ON best.a = v.word
), walk(word, here, k) AS (
  SELECT word, word, 0 FROM f
  UNION ALL
  SELECT walk.word, f.form, k + 1 FROM walk JOIN f ON f.word = walk.here WHERE f.form IS NOT NULL
), root AS (
  SELECT word, arg_max(here, k) AS root FROM walk GROUP BY word
)
SELECT word, form, root, n, n_near, form_n FROM f JOIN root USING (word)
"""

_ASSIGN = """d{r} AS (
  SELECT vec_id, row, j, sum((p.x - c.x) * (p.x - c.x))::BIGINT AS d FROM p JOIN c{r} c USING (i) GROUP BY vec_id, row, j
), a{r} AS (
  SELECT vec_id, row, arg_min(j, (d, j)) AS j, min(d) AS d FROM d{r} GROUP BY vec_id, row
)"""
_MOVE = """c{s} AS (
  SELECT c.j, c.i, coalesce(m.x, c.x) AS x
  FROM c{r} c LEFT JOIN (
    SELECT a.j, p.i, ((sum(p.x) - ((sum(p.x) % count(*)) + count(*)) % count(*)) // count(*))::BIGINT AS x
    FROM a{r} a JOIN p USING (row) GROUP BY a.j, p.i) m USING (j, i)
)"""
CLUSTERS = """
WITH kept AS (
  SELECT row_number() OVER () AS row, vec_id, list_transform(embedding, lambda x: floor(64 * x::DOUBLE)::BIGINT) AS v
  FROM embeddings
  WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = 64
), p AS (
  SELECT vec_id, row, unnest(range(64)) AS i, unnest(v) AS x FROM kept
), s AS (
  SELECT v, row_number() OVER (ORDER BY sha256('1:' || vec_id::VARCHAR), v) - 1 AS j FROM kept WHERE vec_id IS NOT NULL
), c0 AS (
  SELECT j, unnest(range(64)) AS i, unnest(v) AS x FROM s WHERE j < 16
), """ + ", ".join(
    part for r in range(4) for part in ([_ASSIGN.format(r=r)] + ([_MOVE.format(r=r, s=r + 1)] if r < 3 else []))
) + """, digest AS (
  SELECT j, sha256(string_agg(x::VARCHAR, ',' ORDER BY i)) AS h FROM c3 GROUP BY j
)
SELECT a.vec_id, a.j::INT AS cluster, a.d AS distance, sum(a.d) OVER (PARTITION BY a.j)::BIGINT AS cluster_inertia,
       sum(a.d) OVER ()::BIGINT AS inertia, h AS centroid_sha256
FROM a3 a JOIN digest USING (j)
"""
