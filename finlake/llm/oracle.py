"""DuckDB SQL for the operators that SQL can express, as plain statements."""

from __future__ import annotations

OP4 = r"""
WITH d AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size
  FROM documents
), s AS (
  SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source
), w AS (
  SELECT source, source_size,
         [5, 2, 1][((row_number() OVER (ORDER BY source IS NULL, source) - 1) % 3 + 1)::INT] AS weight FROM s
), ranked AS (
  SELECT *, row_number() OVER (ORDER BY source_size / weight, source IS NULL, source) AS k FROM w
), level AS (
  -- the k-th source and all behind it share what the k - 1 sources before it leave at their caps
  SELECT r.*, ((SELECT sum(source_size) FROM w) - 3.0::DOUBLE * coalesce((SELECT sum(b.source_size) FROM ranked b WHERE b.k < r.k), 0))
              / ((SELECT sum(weight) FROM w) - coalesce((SELECT sum(b.weight) FROM ranked b WHERE b.k < r.k), 0)) AS lvl
  FROM ranked r
), goal AS (
  SELECT source, source_size, 3.0::DOUBLE * source_size AS cap, weight,
         (SELECT max(lvl) FROM level l WHERE l.lvl * l.weight <= 3.0::DOUBLE * l.source_size) AS common
  FROM level
), t AS (
  SELECT source, source_size, coalesce(least(common * weight, cap), cap) AS target,
         ('0x' || substr(md5('17:' || coalesce('s' || source, 'n')), 1, 8))::BIGINT / 4294967296.0::DOUBLE AS u
  FROM goal
), p AS (
  SELECT d.doc_id, d.size, t.source_size, t.target, t.u,
         CASE WHEN t.source_size > 0 THEN t.target / t.source_size ELSE 0 END AS rate,
         row_number() OVER (PARTITION BY d.source ORDER BY d.size, d.doc_id NULLS LAST) AS k
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source
)
SELECT doc_id, size, source_size, target,
       (least(floor(k * rate + u) - floor((k - 1) * rate + u), 3) * size)::BIGINT AS taken
FROM p
"""

OP9 = r"""
WITH l AS (
  SELECT doc_id, text, unnest(string_split(text, chr(10))) AS line,
         generate_subscripts(string_split(text, chr(10)), 1) AS i
  FROM documents WHERE text IS NOT NULL
), w AS (
  SELECT doc_id, i, line, lead(line, 1) OVER d AS b, lead(line, 2) OVER d AS c
  FROM l WINDOW d AS (PARTITION BY doc_id ORDER BY i)
), full_w AS (
  SELECT * FROM w WHERE c IS NOT NULL AND regexp_matches(line || b || c, '[^\x20\x09-\x0D]')
), seen AS (
  SELECT doc_id, i, row_number() OVER (PARTITION BY line, b, c ORDER BY doc_id, i) AS k FROM full_w
), gone AS (
  SELECT DISTINCT doc_id, i + j AS i FROM seen, (VALUES (0), (1), (2)) o(j) WHERE k > 1
), kept AS (
  SELECT l.doc_id, count(*) AS n_lines, count(g.i) AS n_removed,
         string_agg(l.line, chr(10) ORDER BY l.i) FILTER (WHERE g.i IS NULL) AS left_text
  FROM l LEFT JOIN gone g ON g.doc_id = l.doc_id AND g.i = l.i GROUP BY l.doc_id
)
SELECT d.doc_id, CASE WHEN d.text IS NULL THEN NULL ELSE coalesce(k.left_text, '') END AS text,
       coalesce(k.n_lines, 0) AS n_lines, coalesce(k.n_removed, 0) AS n_removed
FROM documents d LEFT JOIN kept k USING (doc_id)
"""


OP6 = r"""
WITH t AS (
  SELECT row_number() OVER () AS k, doc_id, coalesce(text, '') AS text,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w
  FROM documents
), lines AS (
  SELECT k, count(*) AS n_lines, count(*) - count(DISTINCT line) AS n_dup_lines
  FROM (SELECT k, unnest(string_split(text, chr(10))) AS line FROM t)
  WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY k
), windows AS (
  SELECT k, i, count(*) OVER (PARTITION BY k, five) AS n
  FROM (SELECT k, i, array_to_string(w[i:i + 4], ' ') AS five
        FROM (SELECT k, w, unnest(range(1, len(w) - 3)) AS i FROM t WHERE len(w) >= 5))
), repeats AS (
  SELECT k, count(DISTINCT i + j) AS n_repeat_words
  FROM windows, (VALUES (0), (1), (2), (3), (4)) o(j) WHERE n > 1 GROUP BY k
), m AS (
  SELECT t.k, doc_id, text, w, len(w) AS n_words,
         length(regexp_replace(text, '[\x20\x09-\x0D]', '', 'g')) AS word_chars,
         length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS n_symbols,
         coalesce(n_dup_lines, 0) AS n_dup_lines, coalesce(n_repeat_words, 0) AS n_repeat_words,
         coalesce(n_lines, 0) AS n_lines
  FROM t LEFT JOIN lines USING (k) LEFT JOIN repeats USING (k)
), b AS (
  SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed FROM m
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       CASE WHEN base_failed THEN false ELSE NOT (
         n_symbols > 0.2 * n_words
         OR word_chars < 2 * n_words OR word_chars > 20 * n_words
         OR length(regexp_replace(text, '[^!]', '', 'g')) > 0.3 * n_words
         OR n_dup_lines > 0.5 * n_lines
         OR len(list_filter(w, lambda x: regexp_matches(x, '[A-Z]') AND NOT regexp_matches(x, '[a-z]')
                                         AND strlen(x) > 1)) > 0.3 * n_words
         OR len(list_filter(range(1, n_words), lambda i: w[i] = w[i + 1])) > 0.3 * n_words
         OR length(regexp_replace(text, '[^\p{L}]', '', 'g')) < 0.5 * word_chars) END AS kept
FROM b
"""

OP10 = r"""
WITH d AS (
  SELECT doc_id, hex(encode(coalesce(text, ''))) AS h, strlen(coalesce(text, '')) AS n_bytes FROM documents
), windows AS (
  SELECT doc_id, i, substr(h, 2 * i + 1, 200) AS win
  FROM (SELECT doc_id, h, unnest(range(0, n_bytes - 99)) AS i FROM d WHERE n_bytes >= 100)
), repeats AS (
  SELECT doc_id, i FROM (
    SELECT doc_id, i, row_number() OVER (PARTITION BY win ORDER BY doc_id, i) AS k FROM windows) WHERE k > 1
), marked AS (
  -- a run of removed bytes ends where the next repeat starts behind it
  SELECT doc_id, i, coalesce(i > lag(i) OVER (PARTITION BY doc_id ORDER BY i) + 100, true) AS fresh FROM repeats
), runs AS (
  SELECT doc_id, min(i) AS a, max(i) + 100 AS b
  FROM (SELECT doc_id, i, sum(fresh::INT) OVER (PARTITION BY doc_id ORDER BY i) AS run FROM marked)
  GROUP BY doc_id, run
), gaps AS (
  SELECT doc_id, coalesce(lag(b) OVER (PARTITION BY doc_id ORDER BY a), 0) AS a, a AS b FROM runs
  UNION ALL SELECT d.doc_id, coalesce(max(r.b), 0), d.n_bytes FROM d LEFT JOIN runs r USING (doc_id)
            GROUP BY d.doc_id, d.n_bytes
), kept AS (
  SELECT doc_id, string_agg(substr(h, 2 * a + 1, 2 * (b - a)), '' ORDER BY a) AS h FROM gaps JOIN d USING (doc_id)
  GROUP BY doc_id
)
SELECT d.doc_id, d.n_bytes, coalesce(x.n_removed, 0)::BIGINT AS n_removed, coalesce(x.n_spans, 0) AS n_spans,
       sha256(unhex(k.h)) AS kept_sha256
FROM d JOIN kept k USING (doc_id)
LEFT JOIN (SELECT doc_id, sum(b - a) AS n_removed, count(*) AS n_spans FROM runs GROUP BY doc_id) x USING (doc_id)
"""

#: unsigned crc32 of the decimal digits of every ``{c}`` of ``{rows}``, bit by bit: ``{c}, crc``
CRCS = """crcs AS (
  WITH RECURSIVE r AS (
    SELECT {c}, {c}::VARCHAR AS s, 0 AS i, 4294967295::BIGINT AS x FROM (SELECT DISTINCT {c} FROM {rows} WHERE {c} IS NOT NULL)
    UNION ALL
    SELECT {c}, s, i + 1, CASE WHEN y & 1 = 1 THEN xor(y >> 1, 3988292384::BIGINT) ELSE y >> 1 END
    FROM (SELECT *, CASE WHEN i % 8 = 0 THEN xor(x, ascii(substr(s, (i // 8 + 1)::BIGINT, 1))::BIGINT) ELSE x END AS y
          FROM r WHERE i < 8 * length(s))
  ) SELECT {c}, xor(x, 4294967295::BIGINT) AS crc FROM r WHERE i = 8 * length(s)
)"""

OP11 = "WITH " + CRCS.format(c="conv_id", rows="conversations") + r""", t AS (
  SELECT conv_id AS c, coalesce(role, '') AS role, coalesce(text, '') AS text,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), md5(coalesce(text, ''))) AS k
  FROM conversations WHERE conv_id IS NOT NULL
), hash_bits AS (
  SELECT conv_id AS c, crc % 6 AS h FROM crcs
), seqs AS (
  SELECT b.c, list(struct_pack(role := t.role, text := t.text) ORDER BY t.c <> b.c - b.c % 100, t.k) AS seq
  FROM hash_bits b JOIN t ON (t.c = b.c - b.c % 100 AND t.k <= b.h) OR (t.c = b.c AND t.k > b.h)
  GROUP BY b.c
), convs AS (
  SELECT b.c, coalesce(s.seq, []) AS seq, list_transform(coalesce(s.seq, []), lambda x: md5(x.role || chr(0) || x.text)) AS ids
  FROM hash_bits b LEFT JOIN seqs s USING (c)
), paths AS (
  SELECT c, d, array_to_string(ids[1:d], '') AS p, CASE WHEN d > 0 THEN length(seq[d].text) ELSE 0 END AS n, d = len(ids) AS ended
  FROM (SELECT c, seq, ids, unnest(range(0, len(ids) + 1)) AS d FROM convs)
), node AS (
  SELECT p, d, min(c) AS conv_id, count(*) AS n_convs, (count(*) - 1) * any_value(n) AS own,
         sha256(coalesce(string_agg(c::VARCHAR, ',' ORDER BY c) FILTER (WHERE ended), '')) AS ends_sha256
  FROM paths GROUP BY p, d
), kids AS (
  SELECT substr(p, 1, 32 * (d - 1)) AS p, count(*) AS n_children FROM node WHERE d > 0 GROUP BY 1
), below AS (
  SELECT substr(n.p, 1, 32 * n.e) AS p, count(*) FILTER (WHERE k.p IS NULL) AS n_leaves, sum(n.own) AS saved_tokens
  FROM (SELECT *, unnest(range(0, d + 1)) AS e FROM node) n LEFT JOIN kids k ON k.p = n.p
  GROUP BY 1
)
SELECT n.conv_id, n.d AS depth, u.conv_id AS parent_conv_id, n.n_convs, coalesce(k.n_children, 0) AS n_children,
       b.n_leaves, b.saved_tokens::BIGINT AS saved_tokens, n.ends_sha256
FROM node n JOIN below b ON b.p = n.p LEFT JOIN kids k ON k.p = n.p
LEFT JOIN node u ON n.d > 0 AND u.p = substr(n.p, 1, 32 * (n.d - 1))
"""

OP12 = r"""
SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
       row_number() OVER (PARTITION BY coalesce(text, '') ORDER BY doc_id DESC NULLS LAST) = 1 AS kept,
       sha256(coalesce(text, '')) AS text_sha256
FROM documents WINDOW same AS (PARTITION BY coalesce(text, ''))
"""


def _field(name: str) -> str:
    return f"CASE WHEN {name} IS NULL THEN '-' ELSE strlen({name}::VARCHAR) || ':' || {name}::VARCHAR END"


def _op13(levels: int, top: int) -> str:
    """Level by level, for at most 8 ** levels rows a language and 8 ** top languages."""
    fixed = " || ".join(_field(c) for c in ("doc_id", "source", "lang", "n_chars"))
    lower = _field("translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')")
    parts = [f"""
{CRCS.format(c="doc_id", rows="documents")}, l AS (
  SELECT d.doc_id, coalesce('v' || lang, 'n') AS g, sha256({fixed} || {_field("text")}) AS leaf,
         CASE WHEN crc % 3 = 0 THEN sha256({fixed} || {lower}) END AS changed
  FROM documents d LEFT JOIN crcs USING (doc_id)
), a0 AS (
  SELECT doc_id, g, leaf, coalesce(changed, leaf) AS f, '' AS way,
         row_number() OVER (PARTITION BY g ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos FROM l
), n0 AS (SELECT g, pos, leaf AS h, count(*) OVER (PARTITION BY g) AS n FROM a0)"""]

    def level(n: str, k: int) -> str:
        """The nodes of the next level, and each node's siblings before and behind it."""
        return f"""
{n}{k + 1} AS (
  SELECT g, pos, h, count(*) OVER (PARTITION BY g) AS n FROM (
    SELECT g, pos // 8 AS pos, CASE WHEN max(n) = 1 THEN min(h) ELSE sha256(string_agg(h, '' ORDER BY pos)) END AS h
    FROM {n}{k} GROUP BY g, pos // 8)
), {n}s{k} AS (
  SELECT x.g, x.pos, any_value(x.n) AS n, coalesce(string_agg(y.h, '' ORDER BY y.pos) FILTER (WHERE y.pos < x.pos), '') AS pre,
         coalesce(string_agg(y.h, '' ORDER BY y.pos) FILTER (WHERE y.pos > x.pos), '') AS post
  FROM {n}{k} x JOIN {n}{k} y ON x.g = y.g AND x.pos // 8 = y.pos // 8 GROUP BY x.g, x.pos
)"""

    for k in range(levels):
        parts.append(level("n", k))
        parts.append(f"""
a{k + 1} AS (
  SELECT doc_id, a.g, leaf, CASE WHEN n = 1 THEN f ELSE sha256(pre || f || post) END AS f, way || pre || post AS way, a.pos // 8 AS pos
  FROM a{k} a JOIN ns{k} s ON s.g = a.g AND s.pos = a.pos
)""")
    parts.append(f"""
subs AS (SELECT g AS lang, h FROM n{levels}
), t0 AS (SELECT 'all' AS g, row_number() OVER (ORDER BY lang) - 1 AS pos, h, count(*) OVER () AS n, lang FROM (
  SELECT lang, h FROM subs)
), b0 AS (
  SELECT doc_id, leaf, t0.h AS subroot, f, way, t0.pos FROM a{levels} a JOIN t0 ON t0.lang = a.g)""")
    for k in range(top):
        parts.append(level("t", k))
        parts.append(f"""
b{k + 1} AS (
  SELECT doc_id, leaf, subroot, CASE WHEN n = 1 THEN f ELSE sha256(pre || f || post) END AS f, way || pre || post AS way, b.pos // 8 AS pos
  FROM b{k} b JOIN ts{k} s ON s.pos = b.pos
)""")
    return "WITH " + ",".join(parts) + f"""
SELECT doc_id, leaf, subroot, r.h AS root, sha256(way) AS proof_sha256, f AS folded_root, f = r.h AS verified
FROM b{top}, (SELECT h FROM t{top}) r
"""


def oracle_sql() -> dict[str, str]:
    return {"op4_mix_sources": OP4, "op6_quality_cascade": OP6, "op9_line_windows": OP9, "op10_suffix_dedup": OP10,
            "op11_conversation_trie": OP11, "op12_exact_dedup": OP12, "op13_merkle_manifest": _op13(5, 2)}
