"""DuckDB SQL for the text operators' rows, over the whole tables.

SQL can't tell languages, merge pieces, parse pages or bound edit distances as operators 3, 4, 8 and 10 do, and has no
CRC and no hash of operator 6's draws; tests compare those with plain Python or the library instead.
"""

from __future__ import annotations

from tallyloom.llm import secrets

SPACE = r"[\x20\x09-\x0D]"
DOCS = "docs AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS t FROM documents)"
#: Only A-Z get small letters.
LOW = "translate(t, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def words(text: str) -> str:
    return f"list_filter(regexp_split_to_array({text}, '{SPACE}+'), lambda w: w <> '')"


def _spans(rank: int, rule: secrets.SecretRule) -> str:
    regex = rule.regex.replace("'", "''")
    return f"""SELECT rid, {rank} AS rank, '{rule.name}' AS kind, unnest(range(len(m))) AS i, unnest(m) AS m, unnest(c) AS c, unnest(b[1:len(m)]) AS b, {rule.least} AS least
      FROM (SELECT rid, regexp_extract_all(t, '{regex}', 0) AS m, regexp_extract_all(t, '{regex}', {rule.group}) AS c, string_split_regex(t, '{regex}') AS b FROM docs)"""


_KINDS = ", ".join(f"count(*) FILTER (kind = '{r.name}') AS n_{r.name}" for r in secrets.RULES)
OP2 = f"""WITH {DOCS}, hits AS ({" UNION ALL ".join(_spans(i, r) for i, r in enumerate(secrets.RULES))}),
ends AS (SELECT *, sum(length(b) + length(m)) OVER (PARTITION BY rid, kind ORDER BY i)::BIGINT AS stop FROM hits),
spans AS (SELECT rid, kind, rank, stop - length(m) AS start, stop FROM ends WHERE length(c) >= least),
lines AS (SELECT rid, string_agg(kind || ':' || start || ':' || stop, ',' ORDER BY start, rank) AS spans, {_KINDS} FROM spans GROUP BY rid)
SELECT doc_id, {", ".join(f"coalesce(n_{r.name}, 0) AS n_{r.name}" for r in secrets.RULES)}, coalesce(spans, '') AS spans, sha256(coalesce(spans, '')) AS base_sha256
FROM docs LEFT JOIN lines USING (rid)"""

OP7 = rf"""WITH {DOCS}, cut AS (SELECT rid, doc_id, t, {words("t")} AS w, list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS l,
  list_filter(regexp_extract_all(t, '\p{{L}}+'), lambda x: length(x) > 2) AS runs FROM docs),
heads AS (SELECT rid, unnest(range(len(w))) AS i, unnest(w) AS x FROM cut),
eights AS (SELECT rid, i, concat_ws(' ', x, {", ".join(f"lead(x, {k}) OVER o" for k in range(1, 8))}) AS s, lead(x, 7) OVER o AS last FROM heads WINDOW o AS (PARTITION BY rid ORDER BY i)),
windows AS (SELECT rid, i, count(*) OVER (PARTITION BY rid, s) AS n FROM eights WHERE last IS NOT NULL),
repeats AS (SELECT rid, sum(least(8, coalesce(after - i, 8)))::BIGINT AS n FROM (SELECT rid, i, lead(i) OVER (PARTITION BY rid ORDER BY i) AS after FROM windows WHERE n > 1) GROUP BY rid),
measures AS (SELECT doc_id, len(w)::BIGINT AS n_words, length(array_to_string(w, ''))::BIGINT AS word_chars, length(regexp_replace(t, '[^#*$%&|<>]+', '', 'g'))::BIGINT AS n_symbols,
  (len(l) - len(list_distinct(l)))::BIGINT AS n_dup_lines, coalesce(n, 0) AS n_repeat_words, len(l) AS lines, length(regexp_replace(t, '[^\p{{L}}]+', '', 'g')) AS letters,
  len(runs) AS runs, len(list_filter(runs, lambda x: regexp_full_match(x, '\p{{Lu}}+'))) AS shouts FROM cut LEFT JOIN repeats USING (rid)),
based AS (SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed FROM measures)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT (base_failed OR 100 * n_symbols > 10 * n_words OR 10 * n_dup_lines > 4 * lines OR word_chars < 2 * n_words OR word_chars > 14 * n_words
    OR 2 * letters < word_chars OR (shouts > 0 AND 2 * shouts > runs)) AS kept FROM based"""

OP5 = f"""WITH RECURSIVE {DOCS}, cut AS (SELECT rid, doc_id, {words(LOW)} AS w FROM docs),
shingles AS (SELECT DISTINCT rid, array_to_string(w[i:i + 4], ' ') AS s FROM (SELECT rid, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS i FROM cut WHERE len(w) > 0)),
sizes AS (SELECT rid, count(*) AS n FROM shingles GROUP BY rid),
sets AS (SELECT rid, n, doc_id, md5(string_agg(s, '|' ORDER BY s)) AS k FROM shingles JOIN sizes USING (rid) JOIN docs USING (rid) GROUP BY ALL),
firsts AS (SELECT k, min(rid) AS rid, any_value(n) AS n FROM sets WHERE doc_id IS NOT NULL GROUP BY k),
known AS (SELECT f.k, f.n, s.s FROM firsts f JOIN shingles s USING (rid)),
pairs AS (SELECT a.k AS a, b.k AS b FROM known a JOIN known b ON a.s = b.s AND a.k < b.k GROUP BY a.k, b.k, a.n, b.n HAVING 100 * count(*) >= 75 * (a.n + b.n - count(*))),
edges AS (SELECT a, b FROM pairs UNION ALL SELECT b, a FROM pairs),
reach AS (SELECT k AS a, k AS b FROM firsts UNION SELECT r.a, e.b FROM reach r JOIN edges e ON r.b = e.a),
least AS (SELECT r.a AS k, min(s.doc_id) AS component_id FROM reach r JOIN sets s ON s.k = r.b GROUP BY r.a)
SELECT d.doc_id, coalesce(n, 0) AS n_shingles, CASE WHEN d.doc_id IS NOT NULL THEN coalesce(component_id, d.doc_id) END AS component_id
FROM docs d LEFT JOIN sets s USING (rid) LEFT JOIN least USING (k)"""

OP9 = f"""WITH {DOCS}, cut AS (SELECT doc_id, {words(LOW)} AS w FROM docs WHERE doc_id IS NOT NULL),
passages AS (SELECT doc_id, i, md5(array_to_string(w[i + 1:i + 50], ' ')) AS p FROM (SELECT doc_id, w, unnest(range(len(w) - 49)) AS i FROM cut WHERE len(w) >= 50)),
shared AS (SELECT p, min(doc_id) AS low FROM passages GROUP BY p HAVING min(doc_id) < max(doc_id)),
hits AS (SELECT DISTINCT doc_id, i, min(low) OVER (PARTITION BY doc_id, i) AS low FROM passages JOIN shared USING (p)),
apart AS (SELECT *, CASE WHEN i > lag(i) OVER w + 50 THEN 1 ELSE 0 END AS new FROM hits WINDOW w AS (PARTITION BY doc_id ORDER BY i)),
islands AS (SELECT *, sum(new) OVER (PARTITION BY doc_id ORDER BY i) AS island FROM apart)
SELECT doc_id, min(i) AS start, max(i) + 50 AS "end", max(i) + 50 - min(i) AS n_words, min(low) AS first_doc_id FROM islands GROUP BY doc_id, island"""

OP11 = """WITH taken AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v
  FROM embeddings WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (SELECT a.vec_id AS anchor_id, b.vec_id AS id, a.label = b.label AS same, list_dot_product(a.v, b.v)::BIGINT AS score
  FROM taken a JOIN taken b ON a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id),
positives AS (SELECT * FROM scored WHERE same QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= 5)
SELECT p.anchor_id, p.id AS positive_id, (row_number() OVER w)::INT AS rank, n.id AS negative_id, p.score AS positive_score, n.score AS negative_score
FROM positives p JOIN scored n ON p.anchor_id = n.anchor_id AND NOT n.same AND 100 * n.score BETWEEN 30 * p.score AND 90 * p.score
WINDOW w AS (PARTITION BY p.anchor_id, p.id ORDER BY n.score DESC, n.id) QUALIFY row_number() OVER w <= 10"""

#: Restoring is the test's matter; here it is the text itself.
OP12 = """WITH docs AS (SELECT doc_id, coalesce(text, '') AS t, sha256('1:' || coalesce(doc_id::VARCHAR, '')) AS d FROM documents),
drawn AS (SELECT doc_id, t, length(t) AS n, ('0x' || d[1:8])::BIGINT AS h1, ('0x' || d[9:16])::BIGINT AS h2, ('0x' || d[17:24])::BIGINT AS h3, ('0x' || d[25:32])::BIGINT AS h4 FROM docs),
cuts AS (SELECT *, least(h1 % (n + 1), h2 % (n + 1)) AS a, greatest(h1 % (n + 1), h2 % (n + 1)) AS b,
  CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR h3 % 100 >= 90 THEN 'plain' WHEN h4 % 100 < 20 THEN 'spm' ELSE 'psm' END AS form FROM drawn),
parts AS (SELECT *, substring(t, 1, a) AS p, substring(t, a + 1, b - a) AS m, substring(t, b + 1) AS s FROM cuts)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN a END AS prefix_chars, CASE WHEN form <> 'plain' THEN b - a END AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256,
  sha256(t) AS restored_sha256 FROM parts"""

ORACLES = {"op2_trigram_secret_scan": OP2, "op5_tiled_jaccard_join": OP5, "op7_rule_cascade": OP7, "op9_sparse_suffix_repeats": OP9,
           "op11_secondary_sort_negatives": OP11, "op12_fill_in_middle": OP12}
