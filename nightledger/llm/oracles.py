"""DuckDB SQL for the operators that SQL can express, over whole tables and texts."""

ALNUM_WORDS = ("list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', "
               "'abcdefghijklmnopqrstuvwxyz'), '[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+'), lambda x: x <> '')")

# Windows are joined as space-separated strings; window lengths other than 13 come from items shorter than 13 words.
OP10 = f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, {ALNUM_WORDS} AS w FROM documents),
b AS (SELECT item_id, {ALNUM_WORDS} AS w FROM benchmark),
bw AS (SELECT DISTINCT item_id, least(13, len(w)) AS n, array_to_string(w[i:i + least(13, len(w)) - 1], ' ') AS win
       FROM (SELECT item_id, w, unnest(range(1, len(w) - least(13, len(w)) + 2)) AS i FROM b WHERE len(w) > 0)),
sizes AS (SELECT DISTINCT n FROM bw),
dw AS (SELECT r, n, i, array_to_string(w[i:i + n - 1], ' ') AS win
       FROM (SELECT r, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d, sizes WHERE len(w) >= n)),
hit AS (SELECT r, i, bw.n, item_id FROM dw JOIN bw ON dw.win = bw.win AND dw.n = bw.n),
pos AS (SELECT r, count(DISTINCT p) AS n_hit FROM (SELECT r, unnest(range(i, i + n)) AS p FROM hit) GROUP BY r),
its AS (SELECT r, count(DISTINCT item_id) AS n_items,
               sha256(string_agg(DISTINCT CAST(item_id AS VARCHAR), ',' ORDER BY CAST(item_id AS VARCHAR))) AS h
        FROM hit GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, coalesce(h, sha256('')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN pos USING (r) LEFT JOIN its USING (r)
"""

OP6 = """
WITH p AS (SELECT page_id, coalesce(html, '') AS h, octet_length(encode(coalesce(html, ''))) AS n FROM pages),
f AS (SELECT page_id, h, n, CASE WHEN n >= 100 THEN min(page_id) OVER (PARTITION BY h) ELSE page_id END AS first_id FROM p)
SELECT page_id, CAST(n AS BIGINT) AS payload_bytes, sha256(h) AS payload_digest,
       CASE WHEN first_id <> page_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN first_id <> page_id THEN first_id END AS refers_to
FROM f
"""


def op9(limit: int) -> str:
    """Each document's shard is the shortest hash prefix whose documents fit ``limit``; copies of one
    document that exceed it alone are dealt to numbered overflow shards."""
    return f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
r AS (SELECT doc_id, octet_length(encode(t)) AS n_bytes,
             lpad(bin(CAST('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), '') || ':' || t), 1, 16) AS UBIGINT)), 64, '0') AS bits
      FROM d),
c AS (SELECT *, sum(n_bytes) OVER (PARTITION BY bits) AS own,
             row_number() OVER (PARTITION BY doc_id, bits, n_bytes) - 1 AS copy,
             greatest({limit} // greatest(n_bytes, 1), 1) AS per, count(*) OVER (PARTITION BY doc_id, bits, n_bytes) AS n FROM r),
h AS (SELECT bits, any_value(own) AS b FROM c WHERE own <= {limit} GROUP BY bits),
s AS (SELECT bits, k, sum(b) OVER (PARTITION BY k, left(bits, k)) AS total FROM h, (SELECT unnest(range(0, 64)) AS k)),
leaf AS (SELECT bits, min(k) AS depth FROM s WHERE total <= {limit} GROUP BY bits)
SELECT doc_id, CASE WHEN depth IS NOT NULL THEN left(bits, depth)
                    WHEN n > per THEN bits || '+' || CAST(copy // per AS VARCHAR) ELSE bits END AS shard,
       CAST(coalesce(depth, 64) AS INTEGER) AS depth, CAST(n_bytes AS BIGINT) AS n_bytes, n_bytes > {limit} AS oversized
FROM c LEFT JOIN leaf USING (bits)
"""


# Operator 12: the level of the targets from sums over sources in order of size by weight.
OP12 = r"""
WITH sized AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS size,
         md5('17:' || coalesce(CAST(doc_id AS VARCHAR), '') || ':' || coalesce(text, '')) AS key
  FROM documents),
sources AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS s, [5, 2, 1][(row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1] AS w
  FROM sized GROUP BY source),
filled AS (
  SELECT *, 3 * sum(s) OVER () - 2 * 2 * (sum(s) OVER up - s) AS num, 2 * (sum(w) OVER () - sum(w) OVER up + w) AS den
  FROM sources WINDOW up AS (ORDER BY 2.0 * s / w, source NULLS LAST)),
lowest AS (SELECT num, den FROM filled WHERE 2 * s * den >= w * num ORDER BY 2.0 * s / w, source NULLS LAST LIMIT 1),
targets AS (
  SELECT source, s, CASE WHEN num IS NULL OR 2 * s * den < w * num THEN CAST(2 * s AS DOUBLE)
                         ELSE CAST(w * num AS DOUBLE) / CAST(den AS DOUBLE) END AS target
  FROM sources LEFT JOIN lowest ON TRUE),
placed AS (
  SELECT z.doc_id, z.size, t.s, t.target, CAST(floor(t.target + 0.5) AS BIGINT) AS budget,
         CAST(sum(z.size) OVER (PARTITION BY z.source ORDER BY z.key ROWS UNBOUNDED PRECEDING) AS BIGINT) - z.size AS before
  FROM sized z JOIN targets t ON z.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, CAST(size AS BIGINT) AS size, s AS source_size, target,
       CASE WHEN s = 0 THEN 0 ELSE budget // s * size + greatest(0, least(size, budget % s - before)) END AS taken
FROM placed"""


def op13(levels: int = 11, top_levels: int = 6) -> str:
    """Operator 13 with one query a level: up to 3^levels documents of a source, 3^top_levels sources."""
    field = lambda c: f"coalesce(strlen(CAST({c} AS VARCHAR)) || ':' || CAST({c} AS VARCHAR), '-')"
    leaf = lambda text: "sha256(" + " || ".join(field(c) for c in ("doc_id", "source", "lang", "n_chars")) + f" || {field(text)})"
    crc = ("xor(list_reduce(list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda c: CAST(ord(c) AS BIGINT)), "
           "lambda a, b: list_reduce(range(8), lambda x, _: xor(x >> 1, (x & 1) * 3988292384), xor(a, b)), "
           "CAST(4294967295 AS BIGINT)), 4294967295)")
    ctes = [f"""leaves AS (SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf) - 1 AS i,
      count(*) OVER (PARTITION BY tree) AS n
    FROM (SELECT doc_id, coalesce('s' || source, 'n') AS tree, {leaf('text')} AS leaf,
            CASE WHEN {crc} % 2 = 0 THEN {leaf("replace(text, chr(10), '')")} ELSE {leaf('text')} END AS seen
          FROM documents))""",
            "t0 AS (SELECT tree, i, n, leaf AS d FROM leaves)", "p0 AS (SELECT *, seen AS f, '' AS sib FROM leaves)"]

    def climb(t: str, p: str, levels: int) -> None:
        for k in range(levels):
            ctes.append(f"{t}r{k} AS (SELECT tree, i // 3 AS up, n, list(d ORDER BY i) AS ds FROM {t}{k} GROUP BY ALL)")
            ctes.append(f"{t}{k + 1} AS (SELECT tree, up AS i, (n + 2) // 3 AS n, CASE WHEN n = 1 THEN ds[1] ELSE sha256(array_to_string(ds, '')) END AS d FROM {t}r{k})")
            ctes.append(f"""{p}{k + 1} AS (SELECT * EXCLUDE (l, r), CASE WHEN old = 1 THEN g ELSE sha256(l || g || r) END AS f, before || l || r AS sib FROM (
      SELECT p.* EXCLUDE (i, n, f, sib), p.i // 3 AS i, (p.n + 2) // 3 AS n, p.n AS old, p.f AS g, p.sib AS before,
             array_to_string(ds[1:p.i % 3], '') AS l, array_to_string(ds[p.i % 3 + 2:3], '') AS r
      FROM {p}{k} p JOIN {t}r{k} r ON p.tree = r.tree AND p.i // 3 = r.up))""".replace("EXCLUDE (l, r)", "EXCLUDE (l, r, old, g, before)"))

    climb("t", "p", levels)
    ctes.append(f"subs AS (SELECT tree AS sub, d AS subroot, row_number() OVER (ORDER BY tree) - 1 AS i, count(*) OVER () AS n FROM t{levels})")
    ctes.append("u0 AS (SELECT '' AS tree, i, n, subroot AS d FROM subs)")
    ctes.append(f"""q0 AS (SELECT '' AS tree, p.doc_id, p.leaf, s.subroot, s.i, s.n, p.f, p.sib FROM p{levels} p JOIN subs s ON p.tree = s.sub)""")
    climb("u", "q", top_levels)
    return "WITH " + ",\n".join(ctes) + f"""
SELECT doc_id, leaf, subroot, d AS root, sha256(sib) AS proof_sha256, f AS folded_root, f = d AS verified
FROM q{top_levels} JOIN (SELECT d FROM u{top_levels}) ON TRUE"""
