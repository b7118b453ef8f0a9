"""SQL counterparts of the queries that SQL can express."""

#: crc32 (reflected, polynomial edb88320) byte by byte; shards by the middle of each row's byte range in the order of the operator.
SHARDING = """
WITH tbl AS (SELECT list_transform(range(256), lambda i: list_reduce(range(8), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(3988292384, c >> 1) ELSE c >> 1 END, i)) AS t),
b AS (SELECT doc_id, coalesce(octet_length(encode(text)), 0) + 1 AS size,
    xor(list_reduce(list_transform(regexp_extract_all(hex(encode(coalesce(text, ''))), '..'), lambda h: ('0x' || h)::BIGINT), lambda c, x: xor(c >> 8, t[(xor(c, x) & 255) + 1]), 4294967295), 4294967295) AS crc
  FROM documents, tbl),
o AS (SELECT *, sum(size) OVER (ORDER BY doc_id NULLS FIRST, crc, size ROWS UNBOUNDED PRECEDING) - size AS before, sum(size) OVER () AS total, row_number() OVER (ORDER BY doc_id NULLS FIRST, crc, size) AS n FROM b),
s AS (SELECT *, CAST(least((2 * before + size) * 16 // (2 * total), 15) AS INTEGER) AS shard FROM o)
SELECT doc_id, CAST(size AS BIGINT) AS size, crc AS text_crc32, 'bytes' AS law, shard, n - min(n) OVER (PARTITION BY shard) AS slot, CAST(NULL AS INTEGER) AS grown_shard FROM s
"""

#: All pairs that share a shingle, counted by a join on it; classes by a walk over the links.
JACCARD = r"""
WITH RECURSIVE d AS (SELECT coalesce(text, '') AS text, min(doc_id) AS least, count(*) AS n_copies FROM documents GROUP BY 1),
w AS (SELECT text, regexp_extract_all(text, '[^ \t\n\x0B\f\r]+') AS w FROM d),
g AS (SELECT text, unnest(list_distinct(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
  ELSE list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) END)) AS s FROM w),
n AS (SELECT text, count(*) AS n FROM g GROUP BY 1),
p AS (SELECT a.text AS x, b.text AS y, count(*) AS c FROM g a JOIN g b ON a.s = b.s AND a.text <> b.text GROUP BY 1, 2),
l AS (SELECT x, y FROM p JOIN n m ON m.text = x JOIN n k ON k.text = y WHERE 5 * c >= 4 * (m.n + k.n - c)),
r(x, y) AS (SELECT text, text FROM d UNION SELECT r.x, l.y FROM r JOIN l ON r.y = l.x),
c AS (SELECT r.x AS text, min(d.least) AS class_id FROM r JOIN d ON d.text = r.y GROUP BY 1)
SELECT doc_id, class_id, (SELECT count(*) FROM l WHERE l.x = c.text) AS n_links, n_copies FROM documents o JOIN c ON c.text = coalesce(o.text, '') JOIN d ON d.text = c.text
"""


def _centroids(rounds: int = 3) -> str:
    """Every vector against every centroid in each round; means by exact floors."""
    near = """a{i} AS (SELECT r, CAST(min(16 * list_sum(list_transform(list_zip(v.v, c.v), lambda z: (z[1] - z[2]) * (z[1] - z[2]))) + k) AS BIGINT) AS m
  FROM v, c{i} c GROUP BY r)"""
    mean = """s{i} AS (SELECT m % 16 AS k, unnest(v) AS x, generate_subscripts(v, 1) AS j FROM a{i} JOIN v USING (r)),
m{i} AS (SELECT k, j, CAST(sum(x) AS BIGINT) AS s, count(*) AS n FROM s{i} GROUP BY k, j),
n{i} AS (SELECT k, list((s - ((s % n) + n) % n) // n ORDER BY j) AS v FROM m{i} GROUP BY k),
c{n} AS (SELECT c{i}.k, coalesce(n{i}.v, c{i}.v) AS v FROM c{i} LEFT JOIN n{i} USING (k))"""
    steps = [x for i in range(rounds) for x in (near.format(i=i), mean.format(i=i, n=i + 1))] + [near.format(i=rounds)]
    return f"""
WITH v AS (SELECT vec_id, row_number() OVER (ORDER BY sha256('1:' || vec_id)) - 1 AS r,
    list_transform(embedding, lambda x: CAST(floor(64 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings WHERE len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = 64 AND len(embedding) = 64),
c0 AS (SELECT r AS k, v FROM v WHERE r < 16),
{", ".join(steps)},
d AS (SELECT vec_id, m % 16 AS k, m // 16 AS distance FROM a{rounds} JOIN v USING (r))
SELECT vec_id, CAST(k AS INTEGER) AS cluster, distance, CAST(sum(distance) OVER (PARTITION BY k) AS BIGINT) AS cluster_inertia, CAST(sum(distance) OVER () AS BIGINT) AS inertia,
  sha256(array_to_string(c.v, ',')) AS centroid_sha256
FROM d JOIN c{rounds} c USING (k)
"""


CENTROIDS = _centroids()

#: Windows of eight words that a text holds twice or more, and the words in them.
COUNTS = r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t FROM documents),
w AS (SELECT *, regexp_extract_all(t, '[^ \t\n\x0B\f\r]+') AS w, list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^ \t\n\x0B\f\r]')) AS lines FROM d),
g AS (SELECT r, unnest(range(1, len(w) - 6)) AS i, unnest(list_transform(range(1, len(w) - 6), lambda i: array_to_string(w[i:i + 7], ' '))) AS g FROM w WHERE len(w) > 7),
h AS (SELECT r, i FROM g QUALIFY count(*) OVER (PARTITION BY r, g) > 1),
c AS (SELECT r, count(DISTINCT i + k) AS n FROM h, range(8) AS x(k) GROUP BY r)
SELECT doc_id, len(w) AS n_words, CAST(coalesce(list_sum(list_transform(w, lambda x: length(x))), 0) AS BIGINT) AS word_chars, len(regexp_extract_all(t, '[#*$%&|<>]')) AS n_symbols,
  len(lines) - len(list_distinct(lines)) AS n_dup_lines, coalesce(n, 0) AS n_repeat_words, len(w) < 20 OR 100 * coalesce(n, 0) > 30 * len(w) AS base_failed
FROM w LEFT JOIN c USING (r)
"""

#: Words and an end for every text; the texts of nine ids in ten, by crc32, are counted.
BASE_SCORES = r"""
WITH tbl AS (SELECT list_transform(range(256), lambda i: list_reduce(range(8), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(3988292384, c >> 1) ELSE c >> 1 END, i)) AS t),
d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(doc_id IS NULL OR
    xor(list_reduce(list_transform(regexp_extract_all(hex(encode(CAST(doc_id AS VARCHAR))), '..'), lambda h: ('0x' || h)::BIGINT), lambda c, x: xor(c >> 8, t[(xor(c, x) & 255) + 1]), 4294967295), 4294967295) % 10 = 0, true) AS held_out,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^ \t\n\x0B\f\r]+') AS w
  FROM documents, tbl),
k AS (SELECT r, held_out, unnest(list_append(w, '')) AS word FROM d),
c AS (SELECT word, count(*) AS c FROM k WHERE NOT held_out GROUP BY word),
s AS (SELECT CAST(sum(c) AS BIGINT) AS n, count(*) AS v FROM c),
x AS (SELECT r, count(*) AS n_tokens, count(c) AS n_known, sum(log10((coalesce(c, 0) + 0.1::DOUBLE) / (n + 0.1::DOUBLE * (v + 1)))) AS b FROM k LEFT JOIN c USING (word), s GROUP BY r)
SELECT doc_id, held_out, n_tokens, n_known, n AS train_tokens, round(b, 4) AS base_score FROM x JOIN d USING (r), s
"""
