"""SQL (DuckDB) for the queries that it can express."""

#: White space of the word contracts, as a class.
GAP = "[\\x20\\x09-\\x0D]"

ORACLE = {
    "op1_topk_search": """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS vector FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
  SELECT q.vec_id AS query_id, c.vec_id AS vec_id,
    CAST(list_sum(list_transform(list_zip(q.vector, c.vector), lambda p: p[1] * p[2])) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id % 100 = 0 AND q.vec_id <> c.vec_id AND len(q.vector) = len(c.vector)
), ranked AS (
  SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score FROM scored
)
SELECT * FROM ranked WHERE rank <= 10
""",
    "op6_ngram_jaccard": f"""
WITH RECURSIVE words AS (
  SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '{GAP}+'), lambda w: w <> '') AS w FROM documents
), shingles AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 4 THEN [array_to_string(w, ' ')]
    ELSE list_transform(range(1, len(w) - 2), lambda i: array_to_string(w[i:i + 3], ' ')) END) AS s FROM words
), sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
shared_counts AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS n FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY 1, 2
), links AS (
  SELECT a, b FROM shared_counts o JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b
  WHERE 100 * o.n >= 85 * (x.n + y.n - o.n)
), ends AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reach(node, seen) AS (
  SELECT a, a FROM (SELECT DISTINCT a FROM ends)
  UNION
  SELECT ends.b, reach.seen FROM reach JOIN ends ON ends.a = reach.node
)
SELECT d.doc_id, CAST(coalesce(n, 0) AS BIGINT) AS n_shingles, coalesce(r.least, d.doc_id) AS component_id
FROM documents d LEFT JOIN sizes s ON s.doc_id = d.doc_id
LEFT JOIN (SELECT node, min(seen) AS least FROM reach GROUP BY node) r ON r.node = d.doc_id
""",
    "op7_exact_dedup": f"""
WITH n AS (
  SELECT doc_id, length(coalesce(text, '')) AS chars, regexp_replace(coalesce(text, ''), '{GAP}', '', 'g') AS body FROM documents
)
SELECT doc_id, first_value(doc_id) OVER best AS keep_id, count(*) OVER (PARTITION BY body) AS group_size,
  doc_id = first_value(doc_id) OVER best AS kept, sha256(body) AS text_sha256
FROM n WINDOW best AS (PARTITION BY body ORDER BY chars DESC, doc_id)
""",
    "op8_substring_dedup": f"""
WITH words AS (
  SELECT doc_id, list_filter(string_split_regex(coalesce(text, ''), '{GAP}+'), lambda w: w <> '') AS w FROM documents
), windows AS (
  SELECT doc_id, unnest(range(1, len(w) - 11)) AS i, unnest(list_transform(range(1, len(w) - 11), lambda i: array_to_string(w[i:i + 12], ' '))) AS s
  FROM words WHERE len(w) >= 13
), first_seen AS (SELECT s, min(doc_id) AS least FROM windows GROUP BY s),
gone AS (
  SELECT doc_id, list(i) AS starts FROM windows JOIN first_seen USING (s) WHERE least < doc_id GROUP BY doc_id
), covered AS (
  SELECT doc_id, list_distinct(flatten(list_transform(starts, lambda i: range(i, i + 13)))) AS places FROM gone
), kept AS (
  SELECT doc_id, w, list_sort(list_filter(range(1, len(w) + 1), lambda i: NOT list_contains(coalesce(places, []), i))) AS stay
  FROM words LEFT JOIN covered USING (doc_id)
)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(len(w) - len(stay) AS BIGINT) AS n_removed,
  sha256(array_to_string(list_transform(stay, lambda i: w[i]), ' ')) AS kept_sha256
FROM kept
""",
    "op9_warc_revisits": r"""
WITH c AS (
  SELECT page_id * 3 + step AS record_id, page_id, step, page_id * 10 + step * 35 AS at_, url, md5(coalesce(html, '')) AS tag,
    regexp_replace(regexp_replace(url, '^[A-Za-z][A-Za-z0-9+.-]*://', ''), '(?s)[?#].*$', '') AS rest
  FROM pages, (SELECT unnest([0, 1, 2]) AS step)
), k AS (
  SELECT record_id, page_id, step, at_, tag, url IS NOT NULL AS usable,
    regexp_replace(regexp_replace(lower(regexp_extract(rest, '^([^/]*)', 1)), ':(80|443)$', ''), '^(www|m)\.', '')
      || regexp_replace(regexp_extract(rest, '(?s)^[^/]*(/.*)$', 1), '(/index)?(\.html?)?/*$', '') AS url,
    CASE WHEN step = 2 AND page_id % 4 = 0 THEN reverse(tag) ELSE tag END AS etag
  FROM c
), r AS (SELECT * FROM k WHERE step = 0),
paired AS (
  SELECT v.record_id, v.page_id, v.url, v.at_, v.etag, r.record_id AS found, r.page_id AS found_page, r.tag AS found_tag,
    row_number() OVER (PARTITION BY v.record_id ORDER BY r.at_ DESC NULLS LAST, r.record_id DESC) AS place
  FROM k v LEFT JOIN r ON r.url = v.url AND r.at_ < v.at_ WHERE v.step > 0 AND v.usable
)
SELECT record_id, url, CAST(at_ AS BIGINT) AS "at", CASE WHEN etag = found_tag THEN found END AS refers_to,
  CASE WHEN found IS NULL THEN 'no_response' WHEN etag = found_tag THEN 'resolved' ELSE 'changed' END AS verdict,
  CASE WHEN etag = found_tag THEN 'content-type=text/html;date=r' || page_id || ';etag=' || found_tag
       ELSE 'content-type=text/plain;date=r' || page_id END AS headers
FROM paired WHERE place = 1
UNION ALL
SELECT record_id, url, CAST(at_ AS BIGINT), NULL, 'not_a_capture', NULL FROM k WHERE NOT usable
""",
    "op11_collocations": r"""
WITH piece_list AS (
  SELECT doc_id, coalesce(lang, 'und') AS lang, string_split_regex(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]') AS p
  FROM documents
), pieces AS (SELECT lang, unnest(p) AS piece FROM piece_list),
words AS (SELECT lang, list_filter(string_split_regex(piece, '[\x20\x09]+'), lambda w: w <> '') AS w FROM pieces),
grams AS (
  SELECT lang, 1 AS k, unnest(w) AS phrase FROM words
  UNION ALL SELECT lang, 2, unnest(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) FROM words
  UNION ALL SELECT lang, 3, unnest(list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2])) FROM words
), f AS (SELECT lang, k, phrase, count(*) AS a FROM grams GROUP BY lang, k, phrase HAVING count(*) >= 10),
sizes AS (SELECT lang, CAST(sum(len(w)) AS BIGINT) AS n FROM words GROUP BY lang),
cuts AS (
  SELECT c.lang, c.k AS length, c.phrase, c.a, cut.k AS k,
    array_to_string(string_split(c.phrase, ' ')[:cut.k], ' ') AS first_part, array_to_string(string_split(c.phrase, ' ')[cut.k + 1:], ' ') AS last_part
  FROM f c, (SELECT unnest([1, 2]) AS k) cut WHERE c.k > cut.k
), scored AS (
  SELECT c.lang, c.length, c.phrase, c.a, c.k, x.a AS l, y.a AS r,
    CAST((CAST(1000000 AS HUGEINT) * c.a * c.a) // (CAST(x.a AS HUGEINT) * y.a) AS BIGINT) AS score
  FROM cuts c JOIN f x ON x.lang = c.lang AND x.phrase = c.first_part JOIN f y ON y.lang = c.lang AND y.phrase = c.last_part
), chosen AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
held AS (
  SELECT lang, phrase, max(a) AS most FROM (
    SELECT lang, array_to_string(string_split(phrase, ' ')[:2], ' ') AS phrase, a FROM f WHERE k = 3
    UNION ALL SELECT lang, array_to_string(string_split(phrase, ' ')[2:], ' '), a FROM f WHERE k = 3
  ) GROUP BY lang, phrase
), ranked AS (
  SELECT c.lang, row_number() OVER (PARTITION BY c.lang ORDER BY c.score DESC, c.a DESC, c.phrase) AS rank, c.phrase, c.a, c.l, c.r, c.score
  FROM chosen c LEFT JOIN held h ON h.lang = c.lang AND h.phrase = c.phrase WHERE h.most IS NULL OR 100 * h.most < 50 * c.a
)
SELECT r.lang, r.rank, r.phrase, r.a, r.l, r.r, s.n, r.score FROM ranked r JOIN sizes s ON s.lang = r.lang WHERE r.rank <= 2000
""",
    "op12_byte_dedup": r"""
WITH d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
starts AS (SELECT doc_id, unnest(range(0, length(h) // 2 - 399)) AS i, h FROM d WHERE length(h) >= 800),
strings AS (SELECT doc_id, i, md5(substr(h, 2 * i + 1, 800)) AS s FROM starts),
again AS (SELECT s FROM strings GROUP BY s HAVING count(*) > 1),
gone AS (SELECT doc_id, i FROM strings JOIN again USING (s)),
marked AS (SELECT doc_id, i, CASE WHEN i <= lag(i) OVER w + 400 THEN 0 ELSE 1 END AS new FROM gone WINDOW w AS (PARTITION BY doc_id ORDER BY i)),
numbered AS (SELECT doc_id, i, sum(new) OVER (PARTITION BY doc_id ORDER BY i) AS span FROM marked),
spans AS (SELECT doc_id, span, min(i) AS a, max(i) + 400 AS b FROM numbered GROUP BY doc_id, span),
listed AS (SELECT doc_id, list(a ORDER BY a) AS a, list(b ORDER BY a) AS b FROM spans GROUP BY doc_id),
cut AS (SELECT d.doc_id, h, coalesce(a, []) AS a, coalesce(b, []) AS b FROM d LEFT JOIN listed l ON l.doc_id = d.doc_id)
SELECT doc_id, CAST(length(h) // 2 AS BIGINT) AS n_bytes,
  CAST(coalesce(list_sum(b) - list_sum(a), 0) AS BIGINT) AS n_removed, CAST(len(a) AS BIGINT) AS n_spans,
  sha256(unhex(array_to_string(list_transform(range(0, len(a) + 1), lambda k:
    substr(h, 2 * (CASE WHEN k = 0 THEN 0 ELSE b[k] END) + 1, CASE WHEN k = len(a) THEN length(h) ELSE 2 * (a[k + 1] - CASE WHEN k = 0 THEN 0 ELSE b[k] END) END)), ''))) AS kept_sha256
FROM cut
""",
    "op13_spelling_variants": r"""
WITH RECURSIVE t8 AS (  -- the table of crc32, by its rule
  SELECT list_transform(range(256), lambda b: list_reduce([b] || [0, 0, 0, 0, 0, 0, 0, 0], lambda c, i: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS t
), runs AS (
  SELECT doc_id, unnest(regexp_extract_all(text, '[A-Za-z\x{00C0}-\x{00FF}]+')) AS run FROM documents WHERE text IS NOT NULL
), lowered AS (SELECT doc_id, translate(run, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run FROM runs WHERE length(run) >= 6),
counted AS (SELECT doc_id, run, count(*) AS c FROM lowered GROUP BY doc_id, run),
hashed AS (
  SELECT run, c, xor(list_reduce([4294967295] || flatten(list_transform(string_split(coalesce(CAST(doc_id AS VARCHAR), '') || ':' || run, ''),
    lambda x: CASE WHEN unicode(x) < 128 THEN [CAST(unicode(x) AS BIGINT)] ELSE [192 + (unicode(x) >> 6), 128 + (unicode(x) & 63)] END)),
    lambda h, b: xor(h >> 8, t[CAST(xor(h & 255, b) AS BIGINT) + 1])), 4294967295) AS h
  FROM counted, t8
), words AS (
  SELECT CASE WHEN h % 199 = 0 THEN left(run, CAST(h % length(run) AS BIGINT)) || substr(run, CAST(h % length(run) AS BIGINT) + 2) ELSE run END AS word, c FROM hashed
), v AS (SELECT word, CAST(sum(c) AS BIGINT) AS n FROM words WHERE length(word) >= 6 GROUP BY word HAVING sum(c) >= 5),
cuts AS (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM v),
less AS (SELECT word, n, i, left(word, i - 1) || substr(word, i + 1) AS rest FROM cuts),
near AS (
  SELECT DISTINCT a.word, b.word AS other, b.n AS other_n FROM less a JOIN less b ON a.rest = b.rest AND a.i = b.i AND a.word <> b.word
  UNION SELECT a.word, b.word, b.n FROM v a JOIN less b ON a.word = b.rest
  UNION SELECT b.word, a.word, a.n FROM v a JOIN less b ON a.word = b.rest
), best AS (
  SELECT word, count(*) OVER (PARTITION BY word) AS n_near, other, other_n FROM near
  QUALIFY row_number() OVER (PARTITION BY word ORDER BY other_n DESC, other) = 1
), formed AS (
  SELECT v.word, v.n, coalesce(n_near, 0) AS n_near, CASE WHEN other_n >= 5 * v.n THEN other END AS form, CASE WHEN other_n >= 5 * v.n THEN other_n END AS form_n
  FROM v LEFT JOIN best USING (word)
), chain(word, last) AS (
  SELECT word, word FROM formed
  UNION ALL SELECT chain.word, f.form FROM chain JOIN formed f ON f.word = chain.last WHERE f.form IS NOT NULL
), ends AS (SELECT chain.word, last AS root FROM chain JOIN formed f ON f.word = chain.last WHERE f.form IS NULL)
SELECT f.word, f.n, f.n_near, f.form, f.form_n, e.root FROM formed f JOIN ends e ON e.word = f.word
""",
}
