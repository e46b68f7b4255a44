"""SQL for the training-data queries that SQL can express, over the same tables."""

from __future__ import annotations

_OP2 = r"""
WITH prints AS (
  SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) AS text_sha256
  FROM documents)
SELECT doc_id, min(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
       doc_id = min(doc_id) OVER w AS kept, text_sha256
FROM prints WINDOW w AS (PARTITION BY text_sha256)
"""

# Spans of one kind: lengths of the pieces between matches and of the matches, added up.
_KIND = r"""
  SELECT doc_id, source, {number} AS kind, n, ends[n] - len(matches[n]) AS start_at, ends[n] AS end_at,
         sha256(vals[n]) AS value_hash
  FROM (
    SELECT doc_id, source, matches, vals, unnest(range(1, len(matches) + 1)) AS n,
           list_transform(range(1, len(matches) + 1), lambda i: list_sum(list_transform(gaps[1:i], lambda g: len(g)))
                          + list_sum(list_transform(matches[1:i], lambda m: len(m))))::BIGINT[] AS ends
    FROM (SELECT doc_id, source, regexp_split_to_array(text, {pattern}) AS gaps,
                 regexp_extract_all(text, {pattern}) AS matches, regexp_extract_all(text, {pattern}, {group}) AS vals
          FROM documents WHERE regexp_matches(text, {pattern})))
  WHERE {good}
"""

_ASSIGN = (r"'(?:(?i:password|passwd|secret|token|api_?key))[\"'']?\x20*[:=]\x20*[\"'']?([A-Za-z0-9+/_.=-]+)'")
_KINDS = "\n  UNION ALL\n".join(
    _KIND.format(number=number, pattern=pattern, group=group, good=good) for number, pattern, group, good in (
        (0, _ASSIGN, 1, "len(vals[n]) >= 6"),
        (1, "'AKIA[A-Z0-9]+'", 0, "len(vals[n]) >= 20"),
        (2, "'[0-9a-f]{24,}'", 0, "len(vals[n]) >= 24"),
        (3, "'[A-Za-z0-9+/_-]{20,}'", 0, "regexp_matches(vals[n], '[0-9]') AND regexp_matches(vals[n], '[a-z]') "
                                         "AND regexp_matches(vals[n], '[A-Z]')")))

_OP9 = f"""
WITH found AS ({_KINDS}),
classes AS (
  SELECT value_hash, CASE WHEN count(DISTINCT coalesce('s' || source, '')) = 1 THEN 'live'
                          WHEN count(DISTINCT coalesce('s' || source, '')) >= 3 OR count(DISTINCT doc_id) >= 20
                          THEN 'example' ELSE 'shared' END AS class
  FROM found GROUP BY value_hash),
spans AS (
  SELECT f.doc_id, f.kind, f.start_at, f.end_at, c.class,
         ['assign', 'access', 'hex', 'owned'][f.kind + 1] || ':' || f.start_at || ':' || f.end_at AS label
  FROM found f JOIN classes c USING (value_hash)
  WHERE f.kind < 3 OR (c.class = 'live' AND NOT EXISTS (
    SELECT 1 FROM found b WHERE b.doc_id = f.doc_id AND b.kind < 3 AND b.start_at < f.end_at
                            AND f.start_at < b.end_at))),
listed AS (
  SELECT doc_id, count(*) FILTER (kind = 0) AS n_assign, count(*) FILTER (kind = 1) AS n_access,
         count(*) FILTER (kind = 2) AS n_hex, count(*) FILTER (kind = 3) AS n_owned,
         count(*) FILTER (class = 'live') AS n_live, count(*) FILTER (class = 'example') AS n_example,
         string_agg(label, ',' ORDER BY start_at, kind) FILTER (kind < 3) AS base,
         string_agg(label, ',' ORDER BY start_at, kind) AS spans
  FROM spans GROUP BY doc_id)
SELECT d.doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
       sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans, coalesce(n_owned, 0) AS n_owned,
       coalesce(n_live, 0) AS n_live, coalesce(n_example, 0) AS n_example
FROM documents d LEFT JOIN listed l ON l.doc_id = d.doc_id
"""

_OP10 = r"""
WITH scored AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size,
         -ln((CAST('0x' || substr(md5('7:' || doc_id), 1, 13) AS BIGINT)::DOUBLE + 0.5) / 4503599627370496.0)
         / (1.0 / (1.0 + 20.0 * (len(regexp_extract_all(coalesce(text, ''), '[#$%&*+<=>@\\^_|~{}\[\]]'))::DOUBLE
                                / greatest(len(coalesce(text, '')), 1)))) AS key
  FROM documents),
sources AS (SELECT source, sum(size)::BIGINT AS source_size FROM scored GROUP BY source),
weighed AS (
  SELECT source, source_size, 3 * source_size AS cap,
         [5, 2, 1][1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3] AS weight
  FROM sources),
levels AS (
  SELECT *, row_number() OVER w AS place,
         (sum(source_size) OVER () - coalesce(sum(cap) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
         ::DOUBLE / sum(weight) OVER (w ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
  FROM weighed WINDOW w AS (ORDER BY cap::DOUBLE / weight, source NULLS LAST)),
targets AS (
  SELECT source, source_size, least(cap::DOUBLE, coalesce(
           (SELECT arg_min(level, place) FROM levels WHERE cap::DOUBLE / weight >= level) * weight, cap)) AS target
  FROM levels),
budgets AS (
  SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size)::BIGINT ELSE 1 END AS epochs FROM targets),
placed AS (
  SELECT s.doc_id, s.size, b.source_size, b.target, b.epochs, b.target - b.epochs * b.source_size AS budget,
         sum(s.size) OVER (PARTITION BY s.source ORDER BY s.key RANGE UNBOUNDED PRECEDING) AS through,
         sum(s.size) OVER (PARTITION BY s.source, s.key) AS tied
  FROM scored s JOIN budgets b ON s.source IS NOT DISTINCT FROM b.source)
SELECT doc_id, size, source_size, target,
       (least(epochs + CASE WHEN 2 * through - tied <= 2 * budget THEN 1 ELSE 0 END, 3) * size)::BIGINT AS taken
FROM placed
"""

_OP3 = r"""
WITH payloads AS (
  SELECT page_id, octet_length(encode(coalesce(html, ''))) AS payload_bytes, sha1(coalesce(html, '')) AS payload_digest
  FROM pages),
kept AS (SELECT *, max(page_id) OVER (PARTITION BY payload_digest) AS last_page FROM payloads)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN payload_bytes >= 1000 AND page_id <> last_page THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN payload_bytes >= 1000 AND page_id <> last_page THEN last_page END AS refers_to
FROM kept
"""

_OP4 = r"""
WITH RECURSIVE links AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM embeddings a JOIN embeddings b ON a.vec_id <> b.vec_id
  WHERE list_cosine_similarity(a.embedding::DOUBLE[], b.embedding::DOUBLE[]) >= 0.95),
reach AS (
  SELECT vec_id, vec_id AS reached FROM embeddings
  UNION SELECT r.vec_id, l.b FROM reach r JOIN links l ON l.a = r.reached),
counts AS (SELECT a, count(*) AS n FROM links GROUP BY a)
SELECT vec_id, coalesce(any_value(n), 0) AS n_links, min(reached) AS component_id, vec_id = min(reached) AS kept
FROM reach LEFT JOIN counts ON a = vec_id GROUP BY vec_id
"""

_OP12 = r"""
WITH texts AS (
  SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS text,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words,
         min(doc_id) OVER (PARTITION BY coalesce(text, '')) AS first_id FROM documents),
marked AS (
  SELECT part, len(words) < 50 AS a, 100 * len(list_distinct(words)) < 65 * len(words) AS b,
         100 * len(regexp_extract_all(text, '[A-Z]')) > 5 * len(text) AS c, regexp_matches(text, '[#$%&*|]') AS d,
         doc_id > first_id AS e,
         EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = texts.doc_id AND quality = 1) AS good,
         EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = texts.doc_id AND toxic = 1) AS toxic FROM texts),
counted AS (
  SELECT part, (CASE WHEN a THEN 'A' ELSE '' END) || (CASE WHEN b THEN 'B' ELSE '' END) || (CASE WHEN c THEN 'C' ELSE '' END)
         || (CASE WHEN d THEN 'D' ELSE '' END) || (CASE WHEN coalesce(e, false) THEN 'E' ELSE '' END) AS fails, count(*) AS n,
         count(*) FILTER (good) AS good, count(*) FILTER (toxic) AS toxic FROM marked GROUP BY ALL),
orders AS (
  SELECT v.x || w.x || x.x || y.x || z.x AS filter_order
  FROM (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x) v, (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x) w,
       (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x) x, (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x) y,
       (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x) z
  WHERE len(list_distinct([v.x, w.x, x.x, y.x, z.x])) = 5),
placed AS (
  SELECT c.part, o.filter_order, s.step, o.filter_order[s.step] AS f, c.fails, n, good, toxic,
         len(regexp_replace(c.fails, '[^' || substr(o.filter_order, 1, s.step) || ']', '', 'g')) > 0 AS gone,
         s.step > 1 AND len(regexp_replace(c.fails, '[^' || substr(o.filter_order, 1, s.step - 1) || '_]', '', 'g')) > 0
         AS gone_before
  FROM counted c, orders o, (SELECT unnest(range(1, 6)) AS step) s),
steps AS (
  SELECT part, filter_order, step, f, sum(CASE WHEN NOT gone THEN n ELSE 0 END) AS kept,
         sum(CASE WHEN gone AND NOT gone_before THEN n ELSE 0 END) AS removed,
         sum(CASE WHEN contains(fails, f) AND gone_before THEN n ELSE 0 END) AS redundant,
         sum(CASE WHEN fails = f THEN n ELSE 0 END) AS unique_fails,
         sum(CASE WHEN gone AND NOT gone_before THEN good ELSE 0 END) AS good_lost,
         sum(CASE WHEN gone AND NOT gone_before THEN toxic ELSE 0 END) AS toxic_lost
  FROM placed GROUP BY part, filter_order, step, f)
SELECT part, filter_order, step::INTEGER AS step, kept::BIGINT AS kept, removed::BIGINT AS removed,
       redundant::BIGINT AS redundant, unique_fails::BIGINT AS unique_fails, good_lost::BIGINT AS good_lost,
       toxic_lost::BIGINT AS toxic_lost, (sum(removed) OVER (PARTITION BY part, f))::BIGINT AS shapley
FROM steps
"""

# CRC-32 of the decimal id, byte by byte; each byte's eight shifts are undone one by one.
_CRC = """xor(list_reduce(list_transform(range(1, len({0}) + 1), lambda i: ord({0}[i]))::BIGINT[],
    lambda crc, byte: list_reduce([0, 1, 2, 3, 4, 5, 6, 7]::BIGINT[], lambda c, bit: CASE WHEN c % 2 = 1
      THEN xor(c // 2, 3988292384) ELSE c // 2 END, xor(crc, byte)), 4294967295), 4294967295)"""

_OP13 = r"""
WITH RECURSIVE fields AS (
  SELECT doc_id, lang, crc % 7 = 0 AS hit, n_chars,
         octet_length(encode(doc_id::VARCHAR)) || ':' || doc_id
         || coalesce(octet_length(encode(source)) || ':' || source, '-')
         || coalesce(octet_length(encode(lang)) || ':' || lang, '-') AS head,
         coalesce(octet_length(encode(text)) || ':' || text, '-') AS tail
  FROM (SELECT *, CRC_OF_ID AS crc FROM documents)),
leaves AS (
  SELECT doc_id, lang, row_number() OVER (PARTITION BY lang ORDER BY doc_id) - 1 AS place,
         sha256(head || coalesce(len(n_chars::VARCHAR) || ':' || n_chars, '-') || tail) AS leaf,
         CASE WHEN hit THEN sha256(head || coalesce(len((n_chars + 1)::VARCHAR) || ':' || (n_chars + 1), '-') || tail) END
           AS tampered FROM fields),
lower_levels AS (
  SELECT lang, 0 AS level, list(leaf ORDER BY place) AS nodes FROM leaves GROUP BY lang
  UNION ALL
  SELECT lang, level + 1, list_transform(range((len(nodes) + 1) // 2), lambda i:
         sha256(nodes[2 * i + 1] || coalesce(nodes[2 * i + 2], ''))) FROM lower_levels WHERE len(nodes) > 1),
subroots AS (
  SELECT lang, nodes[1] AS subroot, level AS height, row_number() OVER (ORDER BY encode(lang) NULLS FIRST) - 1 AS place
  FROM lower_levels WHERE len(nodes) = 1),
upper_levels AS (
  SELECT 0 AS level, list(subroot ORDER BY place) AS nodes FROM subroots
  UNION ALL
  SELECT level + 1, list_transform(range((len(nodes) + 1) // 2), lambda i:
         sha256(nodes[2 * i + 1] || coalesce(nodes[2 * i + 2], ''))) FROM upper_levels WHERE len(nodes) > 1),
sides AS (
  SELECT l.doc_id, t.level, (l.place >> t.level) % 2 = 1 AS second,
         coalesce(t.nodes[xor(l.place >> t.level, 1) + 1], '') AS sibling
  FROM leaves l JOIN lower_levels t ON l.lang IS NOT DISTINCT FROM t.lang WHERE len(t.nodes) > 1
  UNION ALL
  SELECT l.doc_id, s.height + u.level, (s.place >> u.level) % 2 = 1,
         coalesce(u.nodes[xor(s.place >> u.level, 1) + 1], '')
  FROM leaves l JOIN subroots s ON l.lang IS NOT DISTINCT FROM s.lang, upper_levels u WHERE len(u.nodes) > 1),
proofs AS (
  SELECT doc_id, list(CASE WHEN second THEN sibling ELSE '' END ORDER BY level) AS lefts,
         list(CASE WHEN second THEN '' ELSE sibling END ORDER BY level) AS rights FROM sides GROUP BY doc_id),
folds AS (
  SELECT doc_id, 0 AS level, coalesce(tampered, leaf) AS node FROM leaves
  UNION ALL
  SELECT f.doc_id, f.level + 1, sha256(p.lefts[f.level + 1] || f.node || p.rights[f.level + 1])
  FROM folds f JOIN proofs p USING (doc_id) WHERE f.level < len(p.lefts))
SELECT l.doc_id, l.leaf, s.subroot, u.nodes[1] AS root,
       sha256(coalesce(array_to_string(list_transform(p.lefts, lambda x, i: x || p.rights[i]), ''), '')) AS proof_sha256,
       f.node AS folded_root, f.node = u.nodes[1] AS verified
FROM leaves l JOIN subroots s ON l.lang IS NOT DISTINCT FROM s.lang JOIN upper_levels u ON len(u.nodes) = 1
LEFT JOIN proofs p ON p.doc_id = l.doc_id JOIN folds f ON f.doc_id = l.doc_id AND f.level = coalesce(len(p.lefts), 0)
""".replace("CRC_OF_ID", _CRC.format("(doc_id::VARCHAR)"))

ORACLES = {"op4_near_vectors": _OP4, "op3_warc_captures": _OP3, "op2_exact_dedup": _OP2, "op9_secret_scan": _OP9,
           "op10_mix_sources": _OP10, "op12_filter_audit": _OP12, "op13_merkle_manifest": _OP13}
