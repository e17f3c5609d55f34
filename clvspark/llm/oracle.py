"""DuckDB SQL of the queries that SQL expresses, written from the contracts."""

from __future__ import annotations

_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_WORD = r"'[^\x20\x09-\x0D]+'"
_LOWER = f"translate(%s, '{_UPPER}', '{_UPPER.lower()}')"


def _components(links: str, nodes: str) -> str:
    """Recursive reachability: r(x, c) has every node c reachable from x, x included."""
    return f"""r(x, c) AS (
  SELECT x, x FROM {nodes}
  UNION SELECT r.x, l.y FROM r JOIN {links} l ON r.c = l.x),
comp AS (SELECT x, min(c) AS component_id FROM r GROUP BY x)"""


OP2 = f"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all({_LOWER % "coalesce(text, '')"}, {_WORD}) AS ws FROM documents),
s AS (
  SELECT DISTINCT doc_id, unnest(list_transform(range(1, greatest(len(ws) - 1, 2)),
                                                lambda i: array_to_string(ws[i:i + 2], ' '))) AS g
  FROM w WHERE len(ws) > 0),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c
      FROM s a JOIN s b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY 1, 2),
l AS (SELECT x, y FROM p JOIN n n1 ON n1.doc_id = x JOIN n n2 ON n2.doc_id = y
      WHERE 100 * c >= 85 * (n1.n + n2.n - c)),
nodes AS (SELECT DISTINCT doc_id AS x FROM documents),
{_components("l", "nodes")}
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, component_id, d.doc_id = component_id AS kept
FROM documents d JOIN comp ON comp.x = d.doc_id LEFT JOIN n ON n.doc_id = d.doc_id"""

OP3 = f"""
WITH RECURSIVE v AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings),
ok AS (SELECT vec_id, e FROM v
       WHERE e IS NOT NULL AND len(list_filter(e, lambda q: q IS NULL OR NOT isfinite(q))) = 0
         AND len(list_filter(e, lambda q: q <> 0)) > 0),
l AS (SELECT a.vec_id AS x, b.vec_id AS y FROM ok a JOIN ok b
        ON a.vec_id <> b.vec_id AND len(a.e) = len(b.e) AND list_cosine_similarity(a.e, b.e) >= 0.95),
nodes AS (SELECT DISTINCT vec_id AS x FROM v),
{_components("l", "nodes")},
m AS (SELECT x, count(*) AS n FROM l GROUP BY x)
SELECT v.vec_id, coalesce(m.n, 0) AS n_links, component_id, v.vec_id = component_id AS kept
FROM v JOIN comp ON comp.x = v.vec_id LEFT JOIN m ON m.x = v.vec_id"""

OP7 = f"""
WITH d AS (SELECT doc_id, source AS host, coalesce(text, '') AS t FROM documents),
w AS (SELECT doc_id, regexp_extract_all(t, {_WORD}) AS ws FROM d),
grams AS (SELECT doc_id, unnest(range(1, greatest(len(ws) - 6, 1))) AS i, ws FROM w),
windows AS (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, ws[i:i + 7]) AS c FROM grams),
repeated AS (SELECT doc_id, count(DISTINCT i + k) AS n FROM windows, range(0, 8) o(k) WHERE c > 1 GROUP BY doc_id),
raw AS (SELECT doc_id, host, md5(t) AS digest, unnest(string_split(t, chr(10))) AS line FROM d),
lines AS (SELECT doc_id, host, digest, line, regexp_extract_all(line, {_WORD}) AS ws FROM raw),
solid AS (SELECT doc_id, host, digest, line, {_LOWER % "array_to_string(ws, ' ')"} AS norm,
                 length(array_to_string(ws, '')) AS chars FROM lines WHERE len(ws) > 0),
dup AS (SELECT doc_id, count(*) - count(DISTINCT line) AS n FROM solid GROUP BY doc_id),
sizes AS (SELECT host, count(DISTINCT md5(t)) AS documents FROM d GROUP BY host),
frequent AS (SELECT s.host, norm FROM solid s JOIN sizes z ON s.host IS NOT DISTINCT FROM z.host
             GROUP BY s.host, norm, documents
             HAVING count(DISTINCT digest) > 10 AND count(DISTINCT digest) > 0.01 * documents),
gone AS (SELECT doc_id, sum(chars) AS n FROM solid s JOIN frequent f
           ON s.host IS NOT DISTINCT FROM f.host AND s.norm = f.norm GROUP BY doc_id),
b AS (
  SELECT d.doc_id, len(ws) AS n_words, length(array_to_string(ws, '')) AS word_chars,
         length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS n_symbols,
         coalesce(dup.n, 0) AS n_dup_lines, coalesce(repeated.n, 0) AS n_repeat_words,
         CAST(coalesce(gone.n, 0) AS BIGINT) AS boilerplate_chars
  FROM d JOIN w USING (doc_id) LEFT JOIN dup USING (doc_id) LEFT JOIN repeated USING (doc_id) LEFT JOIN gone USING (doc_id))
SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed,
       NOT (n_words < 20 OR 100 * n_repeat_words > 30 * n_words) AND boilerplate_chars <= 0.8 * word_chars AS kept
FROM b"""

_HASHED = ", ".join(f"CAST('0x' || substr(d, {8 * i + 1}, 8) AS BIGINT) AS h{i + 1}" for i in range(4))

OP11 = f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t, sha256('7:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS d FROM documents),
u AS (SELECT doc_id, t, regexp_extract_all(t, '[^\n]*\n|[^\n]+') AS units, {_HASHED} FROM d),
c AS (SELECT *, len(units) AS n, least(h1 % (len(units) + 1), h2 % (len(units) + 1)) AS a,
             greatest(h1 % (len(units) + 1), h2 % (len(units) + 1)) AS b FROM u),
p AS (SELECT *, array_to_string(units[1:a], '') AS prefix, array_to_string(units[a + 1:b], '') AS middle,
             array_to_string(units[b + 1:], '') AS suffix,
             CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR h3 % 100 >= 100 THEN 'plain'
                  WHEN h4 % 100 < 50 THEN 'spm' ELSE 'psm' END AS form FROM c)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(prefix) END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN length(middle) END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN t WHEN 'spm' THEN '<S>' || suffix || '<P>' || prefix || '<M>' || middle
              ELSE '<P>' || prefix || '<S>' || suffix || '<M>' || middle END) AS output_sha256, sha256(t) AS restored_sha256
FROM p"""

_TERM = r"'[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+'"

OP13 = f"""
WITH raw AS (SELECT doc_id, unnest(regexp_extract_all({_LOWER % "coalesce(text, '')"}, {_TERM})) AS term FROM documents),
tf AS (SELECT doc_id, term, count(*) AS tf FROM raw GROUP BY ALL),
size AS (SELECT doc_id, count(*) AS n FROM raw GROUP BY ALL),
total AS (SELECT count(*) AS docs, CAST(sum(n) AS BIGINT) AS terms FROM size),
m AS (SELECT doc_id, 75 + (25 * n * docs) // terms AS m FROM size, total),
w AS (SELECT term, CAST(floor(1000 * ln((2.0 * docs + 2) / CAST(2 * count(*) + 1 AS DOUBLE))) AS BIGINT) AS w
      FROM tf, total GROUP BY term, docs),
asked AS (SELECT item_id, unnest(regexp_extract_all({_LOWER % "coalesce(text, '')"}, {_TERM})) AS term FROM benchmark),
scored AS (SELECT item_id, doc_id, CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 12 * m))) AS BIGINT) AS score
           FROM asked JOIN tf USING (term) JOIN w USING (term) JOIN m USING (doc_id) GROUP BY ALL HAVING score > 0),
ranked AS (SELECT *, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INT) AS rank FROM scored)
SELECT item_id, rank, doc_id, score FROM ranked WHERE rank <= 20"""

ORACLE = {"op2_minhash": OP2, "op3_pivot_index": OP3, "op7_quality_rules": OP7, "op11_fill_in_middle": OP11,
          "op13_ranked_search": OP13}
