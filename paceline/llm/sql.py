"""DuckDB SQL for the corpus queries that SQL can express."""

WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"

OP1 = rf"""
WITH w AS (SELECT doc_id, {WORDS} AS ws FROM documents),
win AS (SELECT doc_id, i, array_to_string(ws[i:i + 12], ' ') AS k FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 11)) AS i FROM w WHERE len(ws) >= 13)),
least AS (SELECT k, min(doc_id) AS first_doc FROM win GROUP BY k),
hit AS (SELECT win.doc_id, i FROM win JOIN least USING (k) WHERE first_doc < win.doc_id),
gone AS (SELECT DISTINCT doc_id, i + j AS p FROM hit, range(13) AS r(j)),
pos AS (SELECT doc_id, unnest(ws) AS word, unnest(range(1, len(ws) + 1)) AS p FROM w),
kept AS (SELECT pos.doc_id, string_agg(word, ' ' ORDER BY pos.p) AS kept, count(*) AS n FROM pos ANTI JOIN gone ON pos.doc_id = gone.doc_id AND pos.p = gone.p GROUP BY pos.doc_id)
SELECT w.doc_id, len(ws)::BIGINT AS n_words, (len(ws) - coalesce(n, 0))::BIGINT AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
FROM w LEFT JOIN kept ON w.doc_id = kept.doc_id
"""

OP2 = """
WITH RECURSIVE sizes AS (SELECT source, count(*) AS size FROM documents GROUP BY source),
sums AS (SELECT sum(pow(size::DOUBLE, 0.7)) AS shares, sum(size)::DOUBLE AS n FROM sizes),
rates AS (SELECT source, pow(size::DOUBLE, 0.7) / shares * n / size AS rate FROM sizes, sums),
parts AS (SELECT source, greatest(1, ceil(rate / 32.0))::INTEGER AS parts, rate / greatest(1, ceil(rate / 32.0)) AS lam FROM rates),
cdf AS (
  SELECT source, lam, 0 AS k, exp(-lam) AS term, exp(-lam) AS total FROM parts
  UNION ALL SELECT source, lam, k + 1, term * lam / (k + 1), total + term * lam / (k + 1) FROM cdf WHERE k < ceil(lam + 12 * sqrt(lam) + 20)
),
draws AS (
  SELECT doc_id, d.source, ('0x' || substr(md5('11|' || doc_id || '|' || j), 1, 13))::UBIGINT::DOUBLE / 4503599627370496 AS u
  FROM (SELECT doc_id, source, unnest(range(1, parts + 1)) AS j FROM documents JOIN parts USING (source)) AS d
),
counts AS (SELECT doc_id, count(k) AS n FROM draws LEFT JOIN cdf ON draws.source = cdf.source AND total <= u GROUP BY doc_id)
SELECT doc_id, text, lang, source, n_chars, copy::INTEGER AS copy
FROM (SELECT d.*, unnest(range(1, n + 1)) AS copy FROM documents AS d JOIN counts USING (doc_id))
"""

_QUARTERS = " || ".join(f"substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', ((('0x' || substr(h, {5 * k + 1}, 5))::INTEGER >> {15 - 5 * j}) & 31) + 1, 1)" for k in range(8) for j in range(4))

OP6 = f"""
WITH p AS (SELECT page_id, coalesce(html, '') AS html, sha1(coalesce(html, '')) AS h FROM pages),
f AS (SELECT *, min(page_id) OVER (PARTITION BY h) AS first_page FROM p)
SELECT page_id, strlen(html)::BIGINT AS payload_bytes, {_QUARTERS} AS payload_digest,
  CASE WHEN page_id = first_page THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id <> first_page THEN first_page END AS refers_to
FROM f
"""

def _rounds(rounds: int) -> str:
    """Rounds of Lloyd's algorithm one after the other: a0 assigns to c0, c1 has the floored means of a0, and so on."""
    out = []
    for r in range(rounds + 1):
        out.append(f"""a{r} AS MATERIALIZED (SELECT vec_id, any_value(q) AS q, min({{'d': d, 'c': c}}) AS best
  FROM (SELECT v.vec_id, v.q, c, list_sum(list_transform(list_zip(v.q, c{r}.q), lambda z: (z[1] - z[2]) * (z[1] - z[2])))::BIGINT AS d FROM v, c{r}) GROUP BY vec_id)""")
        if r < rounds:
            out.append(f"""c{r + 1} AS MATERIALIZED (SELECT c, coalesce(m.q, c{r}.q) AS q FROM c{r} LEFT JOIN (
  SELECT c, list((s - ((s % n) + n) % n) // n ORDER BY i) AS q
  FROM (SELECT best.c AS c, i, sum(x)::BIGINT AS s, count(*) AS n FROM (SELECT best, unnest(q) AS x, unnest(range(1, 65)) AS i FROM a{r}) GROUP BY best.c, i) GROUP BY c) AS m USING (c))""")
    return ",\n".join(out)


OP12 = f"""
WITH v AS MATERIALIZED (SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS q FROM embeddings
  WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = 64),
c0 AS MATERIALIZED (SELECT row_number() OVER (ORDER BY h) - 1 AS c, q FROM (SELECT sha256('2:' || vec_id) AS h, q FROM v ORDER BY h LIMIT 40)),
{_rounds(5)},
size AS (SELECT best.c AS c, sum(best.d)::BIGINT AS cluster_inertia FROM a5 GROUP BY best.c),
copies AS (SELECT q, count(*) AS weight FROM v GROUP BY q)
SELECT vec_id, best.c::INTEGER AS cluster, best.d AS distance, cluster_inertia, (SELECT sum(best.d)::BIGINT FROM a5) AS inertia,
  sha256(list_aggregate(list_transform(c5.q, lambda x: x::VARCHAR), 'string_agg', ',')) AS centroid_sha256, weight
FROM a5 JOIN size ON best.c = size.c JOIN c5 ON best.c = c5.c JOIN copies ON a5.q = copies.q
"""

#: CRC-32 of a decimal number, bit by bit: a byte is folded in, then eight shifts follow.
_CRC32 = "xor(list_reduce(list_prepend(4294967295, flatten(list_transform(string_split(conv_id::VARCHAR, ''), lambda c: [ascii(c)::BIGINT, -1, -1, -1, -1, -1, -1, -1, -1]))), lambda s, x: CASE WHEN x >= 0 THEN xor(s, x) ELSE xor(s >> 1, 3988292384 * (s & 1)) END), 4294967295)"

OP13 = f"""
WITH own AS (
  SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), sha256(coalesce(text, ''))) AS i
  FROM conversations WHERE conv_id IS NOT NULL),
convs AS (SELECT conv_id, conv_id - conv_id % 5 AS base, {_CRC32} % 9 AS h FROM (SELECT DISTINCT conv_id FROM own)),
turns AS (
  SELECT c.conv_id, 0 AS part, i, role, text FROM convs AS c JOIN own ON own.conv_id = c.base AND i <= h
  UNION ALL SELECT conv_id, 1, i, role, text FROM own JOIN convs USING (conv_id) WHERE i > h),
paths AS (SELECT conv_id, coalesce(list({{'r': role, 't': text}} ORDER BY part, i) FILTER (i IS NOT NULL), []) AS p FROM convs LEFT JOIN turns USING (conv_id) GROUP BY conv_id),
seen AS (SELECT conv_id, len(p) AS n, d, p[1:d] AS k, CASE WHEN d > 0 THEN strlen(p[d].t) ELSE 0 END AS bytes FROM (SELECT *, unnest(range(0, len(p) + 1)) AS d FROM paths)),
nodes AS (
  SELECT k, d, min(conv_id) AS conv_id, count(*) AS n_convs, any_value(bytes) AS bytes, coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (n = d), '') AS ends
  FROM seen GROUP BY k, d),
kids AS (SELECT k[1:d - 1] AS k, count(*) AS n_children FROM nodes WHERE d > 0 GROUP BY 1),
below AS (
  SELECT k[1:j] AS k, sum(saved) AS saved_tokens, sum(leaf) AS n_leaves
  FROM (SELECT nodes.k, (n_convs - 1) * bytes AS saved, (n_children IS NULL)::INTEGER AS leaf, unnest(range(0, d + 1)) AS j FROM nodes LEFT JOIN kids USING (k)) GROUP BY 1)
SELECT nodes.conv_id, nodes.d::BIGINT AS depth, up.conv_id AS parent_conv_id, nodes.n_convs, coalesce(n_children, 0)::BIGINT AS n_children,
  n_leaves::BIGINT AS n_leaves, saved_tokens::BIGINT AS saved_tokens, sha256(nodes.ends) AS ends_sha256
FROM nodes JOIN below USING (k) LEFT JOIN kids USING (k) LEFT JOIN nodes AS up ON nodes.d > 0 AND up.k = nodes.k[1:nodes.d - 1]
"""

ORACLES: dict[str, str] = {"op1_substring_dedup": OP1, "op2_source_mixing": OP2, "op6_warc_assembly": OP6, "op12_centroid_clustering": OP12, "op13_conversation_trie": OP13}
