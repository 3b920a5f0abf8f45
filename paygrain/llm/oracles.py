"""DuckDB SQL for the queries that SQL can express; each compares everything with everything."""

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

_REACH = """
reach AS (SELECT id AS a, id AS b FROM nodes UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a),
low AS (SELECT a AS id, min(b) AS component_id FROM reach GROUP BY 1)"""

op1_minhash = f"""
WITH RECURSIVE texts AS MATERIALIZED (SELECT doc_id, regexp_extract_all(
    translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
shingles AS MATERIALIZED (SELECT doc_id, unnest(list_distinct(CASE WHEN len(w) = 1 THEN w ELSE list_transform(
    range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]) END)) AS s FROM texts WHERE len(w) > 0),
sizes AS MATERIALIZED (SELECT doc_id, count(*) AS n FROM shingles GROUP BY 1),
shared AS MATERIALIZED (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS k
    FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY 1, 2),
near AS MATERIALIZED (SELECT x, y FROM shared JOIN sizes p ON p.doc_id = x JOIN sizes q ON q.doc_id = y
    WHERE 100 * k >= 80 * (p.n + q.n - k)),
links AS MATERIALIZED (SELECT x AS a, y AS b FROM near UNION ALL SELECT y, x FROM near),
nodes AS (SELECT doc_id AS id FROM documents),{_REACH}
SELECT d.doc_id, coalesce(n, 0) AS n_shingles, component_id, d.doc_id = component_id AS kept
FROM documents d JOIN low ON low.id = d.doc_id LEFT JOIN sizes s ON s.doc_id = d.doc_id"""

_RULES = (
    (
        "assign",
        """((?i:password|passwd|secret|token|api_?key))["'']?\\x20*[:=]\\x20*["'']?([A-Za-z0-9+/_.=-]+)""",
        2,
        12,
    ),
    ("access", "AKIA[A-Z0-9]+", 0, 18),
    ("hex", "[0-9a-f]+", 0, 16),
)
_FOUND = " UNION ALL ".join(
    f"""SELECT doc_id, '{kind}' AS kind, {i} AS place, {least} AS least, string_split_regex(t, '{pattern}') AS gaps,
    regexp_extract_all(t, '{pattern}', 0) AS alls, regexp_extract_all(t, '{pattern}', {group}) AS vals FROM texts"""
    for i, (kind, pattern, group, least) in enumerate(_RULES)
)
op2_secrets = f"""
WITH texts AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
found AS ({_FOUND}),
each AS (SELECT doc_id, kind, place, least, unnest(range(1, len(alls) + 1)) AS i, gaps, alls, vals FROM found),
spans AS (SELECT doc_id, kind, place, i, length(alls[i]) AS n, CAST(
    list_sum(list_transform(gaps[1:i], lambda x: length(x)))
    + coalesce(list_sum(list_transform(alls[1:i - 1], lambda x: length(x))), 0) AS BIGINT) AS s
    FROM each WHERE length(vals[i]) >= least),
joined AS (SELECT doc_id, count(*) FILTER (WHERE kind = 'assign') AS a, count(*) FILTER (WHERE kind = 'access') AS c,
    count(*) FILTER (WHERE kind = 'hex') AS h,
    string_agg(kind || ':' || s || ':' || (s + n), ',' ORDER BY s, place) AS spans FROM spans GROUP BY 1)
SELECT d.doc_id, coalesce(a, 0) AS n_assign, coalesce(c, 0) AS n_access, coalesce(h, 0) AS n_hex,
    sha256(coalesce(spans, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM documents d LEFT JOIN joined j ON j.doc_id = d.doc_id"""

op6_embedding = f"""
WITH RECURSIVE good AS MATERIALIZED (SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
    WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
      AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
links AS MATERIALIZED (SELECT p.vec_id AS a, q.vec_id AS b FROM good p JOIN good q
    ON p.label = q.label AND len(p.e) = len(q.e) AND p.vec_id <> q.vec_id
    WHERE list_dot_product(p.e, q.e) / (sqrt(list_dot_product(p.e, p.e)) * sqrt(list_dot_product(q.e, q.e))) >= 0.98),
nodes AS (SELECT vec_id AS id FROM embeddings),{_REACH},
times AS (SELECT a, count(*) AS n FROM links GROUP BY 1)
SELECT id AS vec_id, coalesce(n, 0) AS n_links, component_id, id = component_id AS kept
FROM low LEFT JOIN times ON times.a = id"""

op10_suffix_dedup = """
WITH bytes AS MATERIALIZED (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h,
    CAST(strlen(coalesce(text, '')) AS BIGINT) AS n FROM documents),
windows AS MATERIALIZED (SELECT doc_id, i, md5_number(substr(h, 2 * i + 1, 100)) AS w
    FROM (SELECT doc_id, h, unnest(range(0, n - 49)) AS i FROM bytes)),
first AS (SELECT w, min(doc_id) AS f FROM windows GROUP BY 1),
gone AS (SELECT doc_id, i, coalesce(i - lag(i) OVER (PARTITION BY doc_id ORDER BY i) > 50, TRUE) AS fresh
    FROM windows JOIN first USING (w) WHERE f < doc_id),
runs AS (SELECT doc_id, i, sum(CAST(fresh AS INT)) OVER (PARTITION BY doc_id ORDER BY i) AS run FROM gone),
spans AS MATERIALIZED (SELECT doc_id, run, min(i) AS s, max(i) + 50 AS e FROM runs GROUP BY 1, 2),
pieces AS (SELECT doc_id, e AS s, coalesce(lead(s) OVER (PARTITION BY doc_id ORDER BY s), n) AS e FROM (
    SELECT doc_id, s, e FROM spans UNION ALL SELECT doc_id, -1, 0 FROM bytes) JOIN bytes USING (doc_id)),
kept AS (SELECT doc_id, sha256(unhex(string_agg(substr(h, 2 * s + 1, 2 * (e - s)), '' ORDER BY s))) AS kept_sha256
    FROM pieces JOIN bytes USING (doc_id) GROUP BY 1),
sums AS (SELECT doc_id, CAST(sum(e - s) AS BIGINT) AS removed, count(*) AS k FROM spans GROUP BY 1)
SELECT doc_id, n AS n_bytes, coalesce(removed, 0) AS n_removed, coalesce(k, 0) AS n_spans, kept_sha256
FROM bytes JOIN kept USING (doc_id) LEFT JOIN sums USING (doc_id)"""

op11_spelling = f"""
WITH RECURSIVE bits AS (SELECT list_transform(range(256), lambda i: list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0],
    lambda c, z: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS t),
runs AS (SELECT doc_id, translate(r, '{UPPER}', '{LOWER}') AS w, count(*) AS k FROM (SELECT doc_id, unnest(
    regexp_extract_all(coalesce(text, ''), '[A-Za-z\\x{{C0}}-\\x{{FF}}]+')) AS r FROM documents) WHERE length(r) >= 7 GROUP BY 1, 2),
coded AS (SELECT w, k, hex(encode(doc_id || ':' || w)) AS x FROM runs),
hashed AS (SELECT w, k, xor(4294967295, list_reduce(list_concat([4294967295], list_transform(range(length(x) // 2),
    lambda i: CAST('0x' || substr(x, 2 * i + 1, 2) AS BIGINT))), lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1]))) AS h
    FROM coded, bits),
spelt AS (SELECT CASE WHEN h % 31 = 0 THEN substr(w, 1, h % length(w)) || substr(w, h % length(w) + 2) ELSE w END AS word, k
    FROM hashed),
words AS MATERIALIZED (SELECT word, CAST(sum(k) AS BIGINT) AS n FROM spelt WHERE length(word) >= 7 GROUP BY 1 HAVING sum(k) >= 2),
shorter AS MATERIALIZED (SELECT word, n, j, substr(word, 1, j - 1) || substr(word, j + 1) AS r
    FROM (SELECT word, n, unnest(range(1, length(word) + 1)) AS j FROM words)),
near AS (SELECT a.word, b.word AS o, b.n AS m FROM shorter a JOIN shorter b ON a.j = b.j AND a.r = b.r AND a.word <> b.word
    UNION SELECT s.word, w.word, w.n FROM shorter s JOIN words w ON s.r = w.word
    UNION SELECT w.word, s.word, s.n FROM shorter s JOIN words w ON s.r = w.word),
ranked AS (SELECT word, o, m, count(*) OVER (PARTITION BY word) AS c,
    row_number() OVER (PARTITION BY word ORDER BY m DESC, o) AS place FROM near),
forms AS MATERIALIZED (SELECT w.word, w.n, coalesce(c, 0) AS n_near, CASE WHEN m >= 10 * w.n THEN o END AS form,
    CASE WHEN m >= 10 * w.n THEN m END AS form_n FROM words w LEFT JOIN ranked r ON r.word = w.word AND place = 1),
way AS (SELECT word, word AS root FROM forms UNION ALL
    SELECT way.word, f.form FROM way JOIN forms f ON f.word = way.root WHERE f.form IS NOT NULL)
SELECT f.word, f.form, root, f.n, f.n_near, f.form_n
FROM forms f JOIN way ON way.word = f.word JOIN forms l ON l.word = root AND l.form IS NULL"""

op13_fill_middle = """
WITH texts AS (SELECT doc_id, coalesce(text, '') AS text, sha256('7:' || doc_id) AS h,
    regexp_extract_all(coalesce(text, ''), '[^\\n]*\\n|[^\\n]+') AS u FROM documents),
numbers AS (SELECT *, CAST(len(u) AS BIGINT) AS n, CAST('0x' || h[1:8] AS BIGINT) % (len(u) + 1) AS x,
    CAST('0x' || h[9:16] AS BIGINT) % (len(u) + 1) AS y, CAST('0x' || h[25:32] AS BIGINT) AS h4 FROM texts),
parts AS (SELECT doc_id, n, text, array_to_string(u[1:least(x, y)], '') AS p,
    array_to_string(u[least(x, y) + 1:greatest(x, y)], '') AS m, array_to_string(u[greatest(x, y) + 1:], '') AS s,
    CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') THEN 'plain'
         WHEN h4 % 100 < 50 THEN 'spm' ELSE 'psm' END AS form FROM numbers)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(p) END AS prefix_chars,
    CASE WHEN form <> 'plain' THEN length(m) END AS middle_chars,
    sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m
           ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256, sha256(text) AS restored_sha256
FROM parts"""

ORACLES = {
    name: globals()[name]
    for name in (
        "op1_minhash",
        "op2_secrets",
        "op6_embedding",
        "op10_suffix_dedup",
        "op11_spelling",
        "op13_fill_middle",
    )
}
