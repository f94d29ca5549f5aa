"""SQL counterparts of the operators that SQL can express, for another engine to run on the same tables.

They are written from the definitions of the results, with all patterns and limits spelled out, and share nothing with the operators.
Windows are compared as texts, and every window that starts at word or byte ``i`` covers ``i`` up to ``i`` plus its length.
"""

from __future__ import annotations

ORACLES: dict[str, str] = {}

ORACLES["op4_decontamination"] = r"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (
  SELECT CAST(item_id AS VARCHAR) AS item, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
phrase AS (
  SELECT DISTINCT item, least(10, len(w)) AS n, array_to_string(w[i:i + least(10, len(w)) - 1], ' ') AS k
  FROM (SELECT item, w, unnest(range(1, greatest(len(w) - 8, 2))) AS i FROM b WHERE len(w) > 0)),
width AS (SELECT DISTINCT n FROM phrase),
place AS (
  SELECT doc_id, n, i, array_to_string(w[i:i + n - 1], ' ') AS k
  FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d, width WHERE len(w) >= n)),
hit AS (SELECT DISTINCT doc_id, i, n, item FROM place JOIN phrase USING (n, k)),
word AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM (SELECT DISTINCT doc_id, i, n FROM hit)) GROUP BY doc_id),
found AS (SELECT doc_id, count(DISTINCT item) AS n_items, string_agg(DISTINCT item, ',' ORDER BY item) AS ids FROM hit GROUP BY doc_id)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit, CAST(coalesce(n_items, 0) AS BIGINT) AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN word USING (doc_id) LEFT JOIN found USING (doc_id)
"""

ORACLES["op7_near_dedup"] = r"""
WITH RECURSIVE d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[^\x20\x09-\x0D]+') AS w FROM documents),
shingle AS (
  SELECT DISTINCT doc_id, md5(array_to_string(w[i:i + 4], ' ')) AS s
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 3, 2))) AS i FROM d WHERE len(w) > 0)),
size AS (SELECT doc_id, count(*) AS n FROM shingle GROUP BY doc_id),
common AS (
  SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS c
  FROM shingle x JOIN shingle y ON x.s = y.s AND x.doc_id < y.doc_id GROUP BY ALL),
link AS (
  SELECT a, b FROM common JOIN size p ON p.doc_id = a JOIN size q ON q.doc_id = b WHERE 100 * c >= 85 * (p.n + q.n - c)),
edge AS (SELECT a, b FROM link UNION SELECT b, a FROM link),
reach AS (
  SELECT a, b FROM edge
  UNION
  SELECT reach.a, edge.b FROM reach JOIN edge ON reach.b = edge.a),
least_of AS (SELECT a, min(b) AS m FROM reach GROUP BY a)
SELECT d.doc_id, CAST(coalesce(size.n, 0) AS BIGINT) AS n_shingles, least(d.doc_id, coalesce(m, d.doc_id)) AS component_id,
       d.doc_id <= coalesce(m, d.doc_id) AS kept
FROM d LEFT JOIN size USING (doc_id) LEFT JOIN least_of ON least_of.a = d.doc_id
"""

ORACLES["op8_quality_rules"] = r"""
WITH t AS (
  SELECT doc_id, coalesce(text, '') AS x, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w,
         regexp_replace(coalesce(text, ''), '[\x09-\x0D]', ' ', 'g') AS one,
         list_filter(string_split(coalesce(text, ''), chr(10)), lambda y: regexp_matches(y, '[^\x20\x09-\x0D]')) AS lines FROM documents),
triple AS (
  SELECT doc_id, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] AS k FROM (SELECT doc_id, w, unnest(range(1, len(w) - 1)) AS i FROM t WHERE len(w) > 2)),
twice AS (SELECT doc_id, i FROM triple QUALIFY count(*) OVER (PARTITION BY doc_id, k) > 1),
again AS (SELECT doc_id, count(DISTINCT p) AS n FROM (SELECT doc_id, unnest([i, i + 1, i + 2]) AS p FROM twice) GROUP BY doc_id),
base AS (
  SELECT t.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(length(array_to_string(w, '')) AS BIGINT) AS word_chars,
         CAST(len(regexp_extract_all(x, '[#*$%&|<>]')) AS BIGINT) AS n_symbols, CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines,
         CAST(coalesce(again.n, 0) AS BIGINT) AS n_repeat_words, len(lines) AS n_lines,
         len(regexp_extract_all(x, '[0-9]')) AS n_digits, len(regexp_extract_all(x, '[A-Z]')) AS n_capitals,
         len(list_filter(lines, lambda y: regexp_matches(y, '(\.\.\.|…)[\x20\x09-\x0D]*$'))) AS n_ellipsis,
         len(list_filter(lines, lambda y: regexp_matches(y, '^[\x20\x09-\x0D]*[-*•]'))) AS n_bullets,
         len(list_filter(string_split('the and of that with this is for der die das und ist nicht mit den le les et des est une dans pour que los las del por con una para', ' '),
                         lambda s: contains(one, ' ' || s || ' '))) AS n_stops
  FROM t LEFT JOIN again USING (doc_id)),
judged AS (
  SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
         word_chars / greatest(n_words, 1) BETWEEN 2 AND 12 AND n_symbols / greatest(n_words, 1) <= 0.1 AND n_dup_lines / greatest(n_lines, 1) <= 0.5
         AND n_stops >= 2 AND n_digits / greatest(word_chars, 1) <= 0.3 AND n_capitals / greatest(word_chars, 1) <= 0.5
         AND n_ellipsis / greatest(n_lines, 1) <= 0.3 AND n_bullets / greatest(n_lines, 1) <= 0.9 AS fits FROM base)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, NOT base_failed AND fits AS kept FROM judged
"""

ORACLES["op9_suffix_dedup"] = r"""
WITH t AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
place AS (
  SELECT doc_id, i, md5(substr(h, 2 * i + 1, 100)) AS k
  FROM (SELECT doc_id, h, unnest(range(0, length(h) // 2 - 49)) AS i FROM t WHERE length(h) >= 100)),
hit AS (SELECT doc_id, i FROM place QUALIFY min(doc_id) OVER (PARTITION BY k) < doc_id),
marked AS (SELECT doc_id, i, CAST(i - lag(i) OVER (PARTITION BY doc_id ORDER BY i) <= 50 AS INT) AS joins FROM hit),
numbered AS (SELECT doc_id, i, sum(1 - coalesce(joins, 0)) OVER (PARTITION BY doc_id ORDER BY i) AS run FROM marked),
run AS (SELECT doc_id, run, min(i) AS lo, max(i) + 50 AS hi FROM numbered GROUP BY doc_id, run),
piece AS (
  SELECT t.doc_id, run.hi AS lo, lead(run.lo, 1, length(h) // 2) OVER (PARTITION BY t.doc_id ORDER BY run.hi) AS hi, h
  FROM t JOIN (SELECT doc_id, lo, hi FROM run UNION ALL SELECT doc_id, -1, 0 FROM t) run USING (doc_id)),
kept AS (SELECT doc_id, string_agg(substr(h, 2 * lo + 1, 2 * (hi - lo)), '' ORDER BY lo, hi) AS k FROM piece GROUP BY doc_id),
gone AS (SELECT doc_id, sum(hi - lo) AS n, count(*) AS spans FROM run GROUP BY doc_id)
SELECT t.doc_id, CAST(length(h) // 2 AS BIGINT) AS n_bytes, CAST(coalesce(gone.n, 0) AS BIGINT) AS n_removed,
       CAST(coalesce(spans, 0) AS BIGINT) AS n_spans, sha256(unhex(kept.k)) AS kept_sha256
FROM t JOIN kept USING (doc_id) LEFT JOIN gone USING (doc_id)
"""

ORACLES["op10_substring_dedup"] = r"""
WITH t AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
place AS (
  SELECT doc_id, i, md5(array_to_string(w[i:i + 49], ' ')) AS k
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 48)) AS i FROM t WHERE len(w) >= 50)),
hit AS (SELECT doc_id, i FROM place QUALIFY min(doc_id) OVER (PARTITION BY k) < doc_id),
gone AS (SELECT DISTINCT doc_id, unnest(range(i, i + 50)) AS p FROM hit),
word AS (SELECT doc_id, unnest(range(1, len(w) + 1)) AS p, unnest(w) AS x FROM t),
kept AS (SELECT doc_id, count(*) AS n, string_agg(x, ' ' ORDER BY p) AS k FROM word ANTI JOIN gone USING (doc_id, p) GROUP BY doc_id)
SELECT t.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(len(w) - coalesce(kept.n, 0) AS BIGINT) AS n_removed, sha256(coalesce(kept.k, '')) AS kept_sha256
FROM t LEFT JOIN kept USING (doc_id)
"""

ORACLES["op11_phrase_collocations"] = r"""
WITH t AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[.,;:!?\x0A-\x0D]')) AS piece FROM documents),
w AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM t),
f AS (
  SELECT lang, k, array_to_string(w[i:i + k - 1], ' ') AS p, count(*) AS f
  FROM (SELECT lang, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM w, (VALUES (1), (2), (3)) s(k)) GROUP BY ALL),
total AS (SELECT lang, CAST(sum(f) AS BIGINT) AS n FROM f WHERE k = 1 GROUP BY lang),
candidate AS (SELECT lang, k, p, f AS a, string_split(p, ' ') AS w FROM f WHERE k > 1 AND f >= 10),
cut AS (
  SELECT c.lang, c.k, p, a, w, j, array_to_string(w[1:j], ' ') AS head, array_to_string(w[j + 1:k], ' ') AS rest
  FROM candidate c, (VALUES (1), (2)) s(j) WHERE j < c.k),
score AS (
  SELECT cut.lang, cut.k, cut.p, a, w, h.f AS l, t.f AS r,
         CAST(CAST(1000000 AS HUGEINT) * a * a // (CAST(h.f AS HUGEINT) * t.f) AS BIGINT) AS score
  FROM cut JOIN f h ON h.lang = cut.lang AND h.p = head JOIN f t ON t.lang = cut.lang AND t.p = rest
  QUALIFY row_number() OVER (PARTITION BY cut.lang, cut.p ORDER BY score, j) = 1),
part AS (
  SELECT DISTINCT lang, p AS whole, a AS of_whole, array_to_string(w[i:i + 1], ' ') AS p
  FROM candidate, (VALUES (1), (2)) s(i) WHERE k = 3),
covered AS (SELECT DISTINCT s.lang, s.p FROM score s JOIN part USING (lang, p) WHERE 100 * of_whole >= 50 * a),
placed AS (
  SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, p) AS rank, p AS phrase, a, l, r, score
  FROM score ANTI JOIN covered USING (lang, p))
SELECT lang, rank, phrase, a, l, r, n, score FROM placed JOIN total USING (lang) WHERE rank <= 2000
"""


def _clustering_rounds() -> str:
    """Three rounds and the last assignment, each from the one before."""
    out = []
    for i in range(4):
        out.append(f"""
away{i} AS (SELECT v.vec_id, c.c, sum((v.x - c.x) * (v.x - c.x)) AS dist FROM v JOIN c{i} c USING (d) GROUP BY v.vec_id, c.c),
near{i} AS (SELECT vec_id, c, dist FROM away{i} QUALIFY row_number() OVER (PARTITION BY vec_id ORDER BY dist, c) = 1)""")
        if i < 3:
            out.append(f"""
mean{i} AS (SELECT c, d, CAST(sum(x) AS BIGINT) AS s, count(*) AS n FROM v JOIN near{i} USING (vec_id) GROUP BY c, d),
c{i + 1} AS (
  SELECT c{i}.c, c{i}.d, CASE WHEN n IS NULL THEN c{i}.x WHEN s % n < 0 THEN s // n - 1 ELSE s // n END AS x
  FROM c{i} LEFT JOIN mean{i} ON mean{i}.c = c{i}.c AND mean{i}.d = c{i}.d)""")
    return ",".join(out)


ORACLES["op12_centroid_clustering"] = f"""
WITH e AS (
  SELECT vec_id, list_transform(embedding, lambda y: CAST(floor(64 * CAST(y AS DOUBLE)) AS BIGINT)) AS q FROM embeddings
  WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda y: y IS NOT NULL AND isfinite(y))) = 64),
v AS (SELECT vec_id, unnest(range(1, 65)) AS d, unnest(q) AS x FROM e),
first AS (
  SELECT vec_id, CAST(row_number() OVER (ORDER BY sha256('1:' || CAST(vec_id AS VARCHAR))) - 1 AS INT) AS c
  FROM e QUALIFY c < 16),
c0 AS (SELECT c, d, x FROM v JOIN first USING (vec_id)),{_clustering_rounds()},
digest AS (SELECT c, sha256(string_agg(CAST(x AS VARCHAR), ',' ORDER BY d)) AS k FROM c3 GROUP BY c)
SELECT vec_id, c AS cluster, CAST(dist AS BIGINT) AS distance, CAST(sum(dist) OVER (PARTITION BY c) AS BIGINT) AS cluster_inertia,
       CAST(sum(dist) OVER () AS BIGINT) AS inertia, k AS centroid_sha256
FROM near3 JOIN digest USING (c)
"""
