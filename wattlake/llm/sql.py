"""DuckDB SQL of the operators that SQL can express."""


def orchard_sql(k: int = 8, dims: int = 64, rounds: int = 10, scale: int = 1024, seed: int = 3) -> str:
    """Integer k-means by comparing every vector with every centroid, one pair of tables a round."""
    parts = [f"""kept AS MATERIALIZED (
  SELECT row_number() OVER () AS rn, vec_id,
    list_transform(embedding, lambda x: floor({scale} * x::DOUBLE)::BIGINT) AS v
  FROM embeddings WHERE len(embedding) = {dims}
    AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = {dims})""", f"""c0 AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY sha256('{seed}:' || vec_id) NULLS LAST, v) - 1 AS c, v AS p
  FROM kept ORDER BY c LIMIT {k})"""]
    for r in range(rounds + 1):
        parts.append(f"""a{r} AS MATERIALIZED (
  SELECT rn, unnest(min(struct_pack(d := d, c := c))) FROM (
    SELECT rn, c, list_sum(list_transform(range(1, {dims + 1}), lambda i: (v[i] - p[i]) * (v[i] - p[i])))::BIGINT AS d
    FROM kept CROSS JOIN c{r}) GROUP BY rn)""")
        if r < rounds:
            parts.append(f"""c{r + 1} AS MATERIALIZED (
  SELECT c{r}.c, coalesce(m.p, c{r}.p) AS p FROM c{r} LEFT JOIN (
    SELECT c, list((s - ((s % n) + n) % n)::HUGEINT // n ORDER BY i)::BIGINT[] AS p FROM (
      SELECT c, i, sum(v[i])::HUGEINT AS s, count(*)::HUGEINT AS n
      FROM kept JOIN a{r} USING (rn) CROSS JOIN range(1, {dims + 1}) t(i) GROUP BY c, i) GROUP BY c) m
  ON c{r}.c = m.c)""")
    return "WITH " + ",\n".join(parts) + f"""
SELECT vec_id, a{rounds}.c::INTEGER AS cluster, d AS distance,
  (sum(d) OVER (PARTITION BY a{rounds}.c))::BIGINT AS cluster_inertia, (sum(d) OVER ())::BIGINT AS inertia,
  sha256(array_to_string(p, ',')) AS centroid_sha256
FROM a{rounds} JOIN kept USING (rn) JOIN c{rounds} ON a{rounds}.c = c{rounds}.c"""


SQL = {
    "op1_warc_merge": r"""
WITH p AS (
  SELECT page_id, coalesce(url, '') AS url, coalesce(html, '') AS html, sha1(coalesce(html, '')) AS h FROM pages),
d AS (
  SELECT *, max(page_id) OVER (PARTITION BY h) AS last_id, array_to_string(list_transform(range(32), lambda i:
      substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
             ((('0x' || substr(h, 5 * (i // 4)::INT + 1, 5))::INTEGER >> (15 - 5 * (i % 4))::INT) & 31) + 1, 1)), '')
      AS payload_digest,
    regexp_replace(regexp_replace(regexp_replace(lower(url), '^[a-z][a-z0-9+.-]*://', ''), '#.*$', '', 's'),
                   '^www\.', '') AS rest
  FROM p)
SELECT page_id, strlen(html) AS payload_bytes, payload_digest,
  CASE WHEN page_id IS DISTINCT FROM last_id THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN page_id IS DISTINCT FROM last_id THEN last_id END AS refers_to,
  CASE WHEN rest = '' THEN '' ELSE
    array_to_string(list_reverse(string_split(regexp_extract(rest, '^[^/?]*'), '.')), ',') || ')'
    || substr(rest, length(regexp_extract(rest, '^[^/?]*')) + 1) END AS urlkey,
  strftime(make_timestamp((1577836800 + coalesce(page_id, 0)) * 1000000), '%Y-%m-%dT%H:%M:%SZ') AS captured_at
FROM d""",
    "op4_source_mix": r"""
WITH RECURSIVE w AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size,
    ('0x' || substr(md5('mix:' || coalesce(doc_id::VARCHAR, '')), 1, 15))::BIGINT AS key
  FROM documents),
s AS (SELECT source, sum(size)::BIGINT AS source_size FROM w GROUP BY source),
r AS (
  SELECT *, 2.0 * source_size AS cap, CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3
    WHEN 0 THEN 5.0 WHEN 1 THEN 2.0 ELSE 1.0 END::DOUBLE AS weight FROM s),
o AS (
  SELECT *, row_number() OVER (ORDER BY cap / weight, source NULLS LAST) AS k FROM r),
l AS (
  SELECT *, (1.5 * sum(source_size) OVER ()::DOUBLE - coalesce(sum(cap) OVER (ORDER BY k ROWS BETWEEN
      UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::DOUBLE)
    / (sum(weight) OVER () - coalesce(sum(weight) OVER (ORDER BY k ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
    AS level FROM o),
f AS (SELECT min_by(level, k) AS level FROM l WHERE level * weight <= cap),
t AS (
  SELECT source, source_size, CASE WHEN f.level IS NULL OR f.level * weight > cap THEN cap
      ELSE f.level * weight END::DOUBLE AS target FROM l CROSS JOIN f),
b AS (
  SELECT *, CASE WHEN source_size > 0 THEN floor(target)::BIGINT // source_size ELSE 0 END AS epochs FROM t),
c AS (SELECT *, floor(target)::BIGINT - epochs * source_size AS rest FROM b),
x AS (
  SELECT w.*, source_size, target, epochs, rest,
    (sum(w.size) OVER (PARTITION BY w.source ORDER BY key, w.doc_id NULLS FIRST, w.size
                       RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))::BIGINT AS after,
    count(*) OVER (PARTITION BY w.source, key, w.doc_id, w.size) AS ties
  FROM w JOIN c ON w.source IS NOT DISTINCT FROM c.source)
SELECT doc_id, source, size, source_size, target,
  (epochs * size + CASE WHEN after <= rest THEN size
     WHEN after - size * ties < rest THEN (rest - (after - size * ties)) // ties ELSE 0 END)::BIGINT AS taken
FROM x""",
    "op11_orchard": orchard_sql(),
    "op13_spelling": r"""
WITH t AS (
  SELECT coalesce(doc_id::VARCHAR, '') AS id,
    translate(unnest(regexp_extract_all(text, '[A-Za-z\x{00C0}-\x{00FF}]+')), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
              'abcdefghijklmnopqrstuvwxyz') AS run
  FROM documents),
r AS (SELECT id, run, count(*) AS n FROM t GROUP BY ALL),
b AS (
  SELECT id, run, n, flatten(list_transform(range(octet_length(encode(id || ':' || run))),
    lambda i: list_transform(range(8), lambda j:
      (('0x' || substr(hex(encode(id || ':' || run)), 2 * i + 1, 2))::INTEGER >> j::INTEGER) & 1)))::BIGINT[] AS bits
  FROM r),
h AS (
  SELECT id, run, n, xor(list_reduce(list_prepend(4294967295::BIGINT, bits), lambda c, x:
    xor(c >> 1, (xor(c, x) & 1) * 3988292384)), 4294967295) AS h FROM b),
w AS (
  SELECT CASE WHEN h % 199 = 0 THEN substr(run, 1, (h % length(run))::BIGINT) || substr(run, (h % length(run))::BIGINT + 2)
    ELSE run END AS word, sum(n)::BIGINT AS n
  FROM h GROUP BY word HAVING length(word) >= 6 AND sum(n) >= 5),
c AS (
  SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM w),
d AS (SELECT word, n, i, substr(word, 1, i - 1) || substr(word, i + 1) AS cut FROM c),
p AS (
  SELECT a.word, b.word AS near, b.n AS m FROM d a JOIN d b ON a.cut = b.cut AND a.i = b.i AND a.word <> b.word
  UNION SELECT a.word, b.word, b.n FROM d a JOIN w b ON a.cut = b.word
  UNION SELECT b.word, a.word, a.n FROM d a JOIN w b ON a.cut = b.word),
o AS (
  SELECT *, row_number() OVER (PARTITION BY word ORDER BY m DESC, encode(near)) AS k,
    count(*) OVER (PARTITION BY word) AS n_near FROM p),
f AS (
  SELECT w.word, CASE WHEN m >= 5 * n THEN near END AS form, n, coalesce(n_near, 0)::BIGINT AS n_near,
    CASE WHEN m >= 5 * n THEN m END::BIGINT AS form_n
  FROM w LEFT JOIN o ON w.word = o.word AND k = 1),
e AS (
  WITH RECURSIVE u AS (
    SELECT word, word AS root FROM f
    UNION ALL SELECT u.word, f.form FROM u JOIN f ON u.root = f.word WHERE f.form IS NOT NULL)
  SELECT u.word, u.root FROM u JOIN f ON u.root = f.word WHERE f.form IS NULL)
SELECT f.word, form, root, n, n_near, form_n FROM f JOIN e ON f.word = e.word""",
}
