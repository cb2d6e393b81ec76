"""DuckDB SQL of the queries that SQL can express, stated from the definitions."""

from __future__ import annotations

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_WORD = r"[^\x20\x09-\x0D]+"

_JACCARD = rf"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '{_WORD}') AS w FROM documents),
shingles AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) = 0 THEN []
    WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
    ELSE list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) END) AS s FROM words),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY 1),
held AS (SELECT doc_id, s, n FROM shingles JOIN sizes USING (doc_id)),
common AS (
  SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c, any_value(a.n) AS nx, any_value(b.n) AS ny
  FROM held a JOIN held b ON a.s = b.s AND a.doc_id <> b.doc_id AND 100 * b.n >= 75 * a.n AND 100 * a.n >= 75 * b.n GROUP BY 1, 2),
links AS (SELECT x, y FROM common WHERE 100 * c >= 75 * (nx + ny - c)),
reach AS (SELECT doc_id AS x, doc_id AS y FROM documents UNION SELECT reach.x, links.y FROM reach JOIN links ON reach.y = links.x)
SELECT d.doc_id, coalesce(any_value(s.n), 0)::BIGINT AS n_shingles, min(r.y) AS component_id
FROM documents d JOIN reach r ON r.x = d.doc_id LEFT JOIN sizes s ON s.doc_id = d.doc_id GROUP BY d.doc_id
"""

_VECTORS = """
WITH RECURSIVE sound AS (
  SELECT vec_id, label, list_transform(embedding, lambda x: x::DOUBLE) AS e FROM embeddings
  WHERE label IS NOT NULL AND len(list_filter(embedding, lambda x: x <> 0)) > 0
    AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = len(embedding)),
links AS (
  SELECT a.vec_id AS x, b.vec_id AS y FROM sound a JOIN sound b ON a.label = b.label AND len(a.e) = len(b.e) AND a.vec_id <> b.vec_id
  WHERE list_cosine_similarity(a.e, b.e) >= 0.98),
reach AS (SELECT vec_id AS x, vec_id AS y FROM embeddings UNION SELECT reach.x, links.y FROM reach JOIN links ON reach.y = links.x)
SELECT v.vec_id, coalesce(any_value(n.n), 0)::BIGINT AS n_links, min(r.y) AS component_id, v.vec_id = min(r.y) AS kept
FROM embeddings v JOIN reach r ON r.x = v.vec_id LEFT JOIN (SELECT x, count(*) AS n FROM links GROUP BY x) n ON n.x = v.vec_id GROUP BY v.vec_id
"""

# Five hex digits are four signs of base32.
_SIGNS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
_BASE32 = f"""array_to_string(list_transform(range(0, 32), lambda i: substr('{_SIGNS}',
  (((('0x' || substr(h, (i // 4 * 5 + 1)::INT, 5))::INT) >> (15 - i % 4 * 5)::INT) & 31) + 1, 1)), '')"""

_WARC = f"""
WITH hashed AS (SELECT page_id, coalesce(html, '') AS body, sha1(coalesce(html, '')) AS h FROM pages),
first AS (SELECT body, min(page_id) AS first_id FROM hashed GROUP BY body)
SELECT page_id, strlen(body)::BIGINT AS payload_bytes, {_BASE32} AS payload_digest,
  CASE WHEN page_id = first_id THEN 'response' ELSE 'revisit' END AS record_type, CASE WHEN page_id <> first_id THEN first_id END AS refers_to
FROM hashed JOIN first USING (body)
"""


def _rounds(rounds: int, k: int) -> str:
    """Centroids 0 to k - 1 and their means, round after round; a tie goes to the smaller number."""
    parts = []
    for i in range(rounds + 1):
        parts.append(f"""
near{i} AS (SELECT vec_id, p, arg_min(c.number, d * {k} + c.number) AS number, min(d) AS d FROM (
  SELECT v.vec_id, v.p, c.number, list_sum(list_transform(range(1, 65), lambda i: (v.p[i] - c.p[i]) * (v.p[i] - c.p[i])))::BIGINT AS d
  FROM whole v JOIN centroids{i} c ON true) AS c GROUP BY vec_id, p)""")
        if i < rounds:
            parts.append(f"""
sums{i} AS (SELECT number, i, sum(p[i])::BIGINT AS s, count(*) AS n FROM near{i}, range(1, 65) r(i) GROUP BY 1, 2),
means{i} AS (SELECT number, list((s - ((s % n) + n) % n) // n ORDER BY i) AS p FROM sums{i} GROUP BY 1),
centroids{i + 1} AS (SELECT number, coalesce(m.p, c.p) AS p FROM centroids{i} c LEFT JOIN means{i} m USING (number))""")
    return ",".join(parts)


_CLUSTERS = f"""
WITH whole AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(64 * x::DOUBLE)::BIGINT) AS p FROM embeddings
  WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = 64),
centroids0 AS (
  SELECT row_number() OVER (ORDER BY sha256('1:' || vec_id), p) - 1 AS number, p FROM whole WHERE vec_id IS NOT NULL
  ORDER BY sha256('1:' || vec_id), p LIMIT 16),{_rounds(3, 16)},
named AS (SELECT number, sha256(array_to_string(p, ',')) AS h FROM centroids3)
SELECT vec_id, number::INTEGER AS cluster, d AS distance, sum(d) OVER (PARTITION BY number)::BIGINT AS cluster_inertia,
  sum(d) OVER ()::BIGINT AS inertia, h AS centroid_sha256
FROM near3 JOIN named USING (number)
"""

# A checksum of a text's bytes: eight steps of the polynomial for each of the 256 bytes, then one step a byte.
_SPELLING = rf"""
WITH RECURSIVE step AS (SELECT b, b::BIGINT AS c, 0 AS i FROM range(256) r(b)
  UNION ALL SELECT b, CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, i + 1 FROM step WHERE i < 8),
codes AS (SELECT list(c ORDER BY b) AS t FROM step WHERE i = 8),
runs AS (
  SELECT doc_id, translate(unnest(regexp_extract_all(text, '[A-Za-z\x{{00C0}}-\x{{00FF}}]+')), '{_UPPER}', '{_LOWER}') AS run FROM documents),
own AS (SELECT doc_id, run, count(*) AS n FROM runs WHERE length(run) >= 7 GROUP BY 1, 2),
bytes AS (SELECT doc_id, run, n, hex(encode(doc_id || ':' || run)) AS x FROM own),
summed AS (SELECT doc_id, run, n, xor(4294967295, list_reduce(
  list_prepend(4294967295::BIGINT, list_transform(range(0, length(x) // 2), lambda i: ('0x' || substr(x, (2 * i + 1)::INT, 2))::BIGINT)),
  lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1]))) AS h FROM bytes, codes),
spelled AS (SELECT CASE WHEN h % 31 = 0 THEN left(run, (h % length(run))::INT) || substr(run, (h % length(run) + 2)::INT) ELSE run END AS word, n FROM summed),
vocab AS (SELECT word, sum(n)::BIGINT AS n FROM spelled WHERE length(word) >= 7 GROUP BY 1 HAVING sum(n) >= 2),
less AS (SELECT word, i, left(word, i - 1) || substr(word, i + 1) AS v FROM (SELECT word, unnest(range(1, length(word) + 1))::INT AS i FROM vocab)),
pairs AS (
  SELECT a.word AS x, b.word AS y FROM less a JOIN less b ON a.v = b.v AND a.i = b.i AND a.word <> b.word
  UNION SELECT less.word, vocab.word FROM less JOIN vocab ON less.v = vocab.word
  UNION SELECT vocab.word, less.word FROM less JOIN vocab ON less.v = vocab.word),
ranked AS (SELECT x, y, m.n AS m, count(*) OVER (PARTITION BY x) AS n_near, row_number() OVER (PARTITION BY x ORDER BY m.n DESC, y) AS turn
  FROM pairs JOIN vocab m ON m.word = y),
forms AS (SELECT word, n, coalesce(n_near, 0)::BIGINT AS n_near, CASE WHEN m >= 10 * n THEN y END AS form, CASE WHEN m >= 10 * n THEN m END AS form_n
  FROM vocab LEFT JOIN ranked ON x = word AND turn = 1),
path AS (SELECT word, word AS root FROM forms UNION ALL SELECT path.word, forms.form FROM path JOIN forms ON forms.word = path.root WHERE forms.form IS NOT NULL),
last AS (SELECT path.word, path.root FROM path JOIN forms ON forms.word = path.root WHERE forms.form IS NULL)
SELECT word, form, root, n, n_near, form_n FROM forms JOIN last USING (word)
"""

_EXACT = """
SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size, doc_id = max(doc_id) OVER same AS kept, sha256(t) AS text_sha256
FROM (SELECT doc_id, coalesce(text, '') AS t FROM documents) WINDOW same AS (PARTITION BY t)
"""

SQL: dict[str, str] = {
    "op1_ngram_jaccard": _JACCARD,
    "op2_grid_order_join": _VECTORS,
    "op8_warc": _WARC,
    "op11_mean_variance_clusters": _CLUSTERS,
    "op12_spelling_variants": _SPELLING,
    "op13_exact_dedup": _EXACT,
}
