"""SQL for the queries that SQL can express, over the same tables."""

from __future__ import annotations

CHAT = r"""
WITH told AS (
  SELECT conv_id, turn, coalesce(role, 'unknown') AS who, replace(coalesce(text, ''), '<|', '< |') AS said,
         CAST(floor(coalesce(turn, 0) / 512) AS BIGINT) AS block
  FROM conversations
), speakers AS (
  SELECT DISTINCT conv_id, who AS speaker FROM told WHERE who <> 'system'
), seen AS (
  SELECT t.*, s.speaker,
         CASE WHEN who = 'system' THEN '<|im_start|>system' || chr(10)
              WHEN who = s.speaker THEN '<|im_start|>assistant' || chr(10)
              ELSE '<|im_start|>user name=' || translate(replace(who, '<|', '< |'), chr(10) || chr(13), '  ') || chr(10) END AS head
  FROM told t JOIN speakers s ON t.conv_id IS NOT DISTINCT FROM s.conv_id
), placed AS (
  SELECT *, head || said || '<|im_end|>' || chr(10) AS piece, length(said) + 11 AS rest,
         coalesce(sum(length(head) + length(said) + 11) OVER (
           PARTITION BY conv_id, speaker, block ORDER BY turn NULLS FIRST, who, said
           ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) + length(head) AS start
  FROM seen
)
SELECT conv_id, speaker, block,
       string_agg(piece, '' ORDER BY turn NULLS FIRST, who, said) AS text,
       coalesce(string_agg(CASE WHEN who = speaker THEN CAST(start AS BIGINT) || ':' || CAST(start + rest AS BIGINT) END, ','
                           ORDER BY turn NULLS FIRST, who, said), '') AS mask,
       count(*) AS n_turns,
       CAST(coalesce(sum(CASE WHEN who = speaker THEN rest END), 0) AS BIGINT) AS n_target_chars
FROM placed GROUP BY conv_id, speaker, block
"""

FILL = r"""
WITH drawn AS (
  SELECT doc_id, coalesce(text, '') AS t, sha256('1:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h FROM documents
), numbers AS (
  SELECT doc_id, t, CAST(length(t) AS BIGINT) AS n,
         CAST('0x' || substr(h, 1, 8) AS BIGINT) AS h1, CAST('0x' || substr(h, 9, 8) AS BIGINT) AS h2,
         CAST('0x' || substr(h, 17, 8) AS BIGINT) AS h3, CAST('0x' || substr(h, 25, 8) AS BIGINT) AS h4
  FROM drawn
), cut AS (
  SELECT *, least(h1 % (n + 1), h2 % (n + 1)) AS a, greatest(h1 % (n + 1), h2 % (n + 1)) AS b,
         CASE WHEN n = 0 OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR h3 % 100 >= 90 THEN 'plain'
              WHEN h4 % 100 < 20 THEN 'spm' ELSE 'psm' END AS form
  FROM numbers
), pieces AS (
  SELECT *, substr(t, 1, a) AS p, substr(t, a + 1, b - a) AS m, substr(t, b + 1) AS s FROM cut
)
SELECT doc_id, n, form,
       CASE WHEN form <> 'plain' THEN a END AS prefix_chars, CASE WHEN form <> 'plain' THEN b - a END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m
                        ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256,
       sha256(t) AS restored_sha256
FROM pieces
"""

#: Clusters: whole vectors, first centroids, then one CTE for the assignment and one for the centroids of each round.
VECTORS = """
vectors AS MATERIALIZED (
  SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings
  WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = 64
), centroids0 AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY sha256('3:' || CAST(vec_id AS VARCHAR)) NULLS LAST, v) - 1 AS c, v AS m FROM vectors
  ORDER BY c LIMIT 8
)"""
ASSIGNED = """, assigned{k} AS MATERIALIZED (
  SELECT r, any_value(vec_id) AS vec_id, any_value(v) AS v, min(struct_pack(d := d, c := c)) AS best
  FROM (SELECT r, vec_id, v, c, list_sum(list_transform(list_zip(v, m), lambda x: (x[1] - x[2]) * (x[1] - x[2]))) AS d
        FROM vectors CROSS JOIN centroids{k})
  GROUP BY r
)"""
MOVED = """, sums{n} AS (
  SELECT c, i, sum(x) AS s, count(*) AS w
  FROM (SELECT best.c AS c, unnest(v) AS x, generate_subscripts(v, 1) AS i FROM assigned{k})
  GROUP BY c, i
), centroids{n} AS MATERIALIZED (
  SELECT o.c, coalesce(g.m, o.m) AS m FROM centroids{k} o LEFT JOIN (
    SELECT c, list(CAST((s - ((s % w) + w) % w) // w AS BIGINT) ORDER BY i) AS m FROM sums{n} GROUP BY c) g ON o.c = g.c
)"""
CLUSTERS_OUT = """
SELECT vec_id, CAST(best.c AS INTEGER) AS cluster, CAST(best.d AS BIGINT) AS distance,
       CAST(sum(best.d) OVER (PARTITION BY best.c) AS BIGINT) AS cluster_inertia, CAST(sum(best.d) OVER () AS BIGINT) AS inertia,
       sha256(array_to_string(m, ',')) AS centroid_sha256
FROM assigned10 JOIN centroids10 ON best.c = c
"""

#: Places of matches: what stands between them, and they, added up.
MATCHES = """{kind} AS (
  SELECT d, {rank} AS k, '{kind}' AS kind, m,
         CAST(sum(length(p)) OVER w + coalesce(sum(length(m)) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS a
  FROM (SELECT d, unnest(string_split_regex(t, {pattern})) AS p, unnest(regexp_extract_all(t, {pattern}, 0)) AS m,
               unnest(range(len(string_split_regex(t, {pattern})))) AS i FROM texts WHERE regexp_matches(t, {pattern}))
  WINDOW w AS (PARTITION BY d ORDER BY i)
)"""


def _either_case(*words: str) -> str:
    return "|".join("".join(f"[{c}{c.upper()}]" if c.isalpha() else c for c in word) for word in words)


def _secrets() -> str:
    words = _either_case("password", "passwd", "secret", "token", "api_?key")
    before = rf"""({words})["'']?\x20*[:=]\x20*["'']?"""
    rules = {  # pattern, and what is measured of a match, and the least of that
        "assign": (before + "[A-Za-z0-9+/_.=-]+", f"length(regexp_extract(m, '^{before}([A-Za-z0-9+/_.=-]+)', 2))", 8),
        "access": ("AKIA[A-Z0-9]+", "length(m)", 16),
        "hex": ("[0-9a-f]{32,}", "length(m)", 32),
        "pem": (r"-----BEGIN [A-Z ]*PRIVATE KEY-----[A-Za-z0-9+/=\x20\x09-\x0D]*", "length(m)", 64),
        "bearer": (r"[Bb]earer\x20[A-Za-z0-9._~+/=-]+", "length(m)", 32),
        "forge": ("gh[pousr]_[A-Za-z0-9]+", "length(m)", 40),
    }
    found = [MATCHES.format(kind=kind, rank=k, pattern=f"'{rule[0]}'") for k, (kind, rule) in enumerate(rules.items())]
    kept = [f"SELECT d, k, kind, a, a + length(m) AS b FROM {kind} WHERE m IS NOT NULL AND {size} >= {least}" for kind, (_, size, least) in rules.items()]
    counts = ", ".join(f"count(*) FILTER (kind = '{kind}') AS n_{kind}" for kind in ("assign", "access", "hex"))
    told = "coalesce(string_agg(kind || ':' || a || ':' || b, ',' ORDER BY a, k)"
    texts = "texts AS MATERIALIZED (SELECT row_number() OVER () AS d, doc_id, coalesce(text, '') AS t FROM documents)"
    return (
        f"WITH {', '.join([texts, *found])}, spans AS ({' UNION ALL '.join(kept)})\n"
        f"SELECT any_value(doc_id) AS doc_id, {counts}, sha256({told} FILTER (k < 3), '')) AS base_sha256, {told} FILTER (kind IS NOT NULL), '') AS spans\n"
        "FROM texts LEFT JOIN spans USING (d) GROUP BY d"
    )


def statements() -> dict[str, str]:
    steps = "".join(ASSIGNED.format(k=k) + MOVED.format(k=k, n=k + 1) for k in range(10)) + ASSIGNED.format(k=10)
    return {
        "op6_chat_format": CHAT,
        "op11_fill_middle": FILL,
        "op12_vantage_kmeans": f"WITH {VECTORS}{steps}{CLUSTERS_OUT}",
        "op13_secret_ledger": _secrets(),
    }
