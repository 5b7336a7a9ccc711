"""DuckDB SQL of those queries that SQL can express."""

from __future__ import annotations

from barsmith.llm.common import ASCII_UPPER

_LOWER = f"'{ASCII_UPPER}', '{ASCII_UPPER.lower()}'"
_WHITE = "chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"


def url_filter(rules: list[tuple[str, str]]) -> str:
    values = ", ".join(f"('{r}', '{r.partition('/')[0]}', '{r[r.index('/'):]}', '{v}')" for v, r in rules)
    return f"""
WITH u AS (SELECT page_id, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) END AS rest FROM pages),
p AS (SELECT page_id, coalesce(translate(regexp_extract(rest, '^[^/?#]*'), {_LOWER}), '') AS host,
             coalesce(regexp_extract(rest, '^[^/?#]*([^?#]*)', 1), '') AS path FROM u),
r(rule, rhost, rpath, rverdict) AS (VALUES {values}),
f AS (SELECT DISTINCT host, path, rule, rverdict FROM p JOIN r
      ON (host = rhost OR suffix(host, '.' || rhost)) AND prefix(path, rpath)),
b AS (SELECT host, path, arg_max(rule, length(rule)) AS rule, arg_max(rverdict, length(rule)) AS rverdict FROM f GROUP BY host, path),
j AS (SELECT page_id, p.host, p.path, rule, rverdict, p.host || regexp_replace(p.path, '(/index)?(\\.html?)?/*$', '') AS canonical
      FROM p LEFT JOIN b ON p.host = b.host AND p.path = b.path),
l AS (SELECT DISTINCT canonical FROM j WHERE rverdict = 'block')
SELECT page_id, host, path, rule,
  coalesce(rverdict, CASE WHEN canonical IN (SELECT canonical FROM l) THEN 'block' ELSE 'allow' END) AS verdict
FROM j"""


def ngram_jaccard() -> str:
    return f"""
WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), {_LOWER}), '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
s AS (SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
        ELSE list_distinct(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))) END AS s FROM w),
g AS (SELECT doc_id, len(s) AS n, unnest(s) AS g FROM s),
c AS (SELECT a.doc_id AS a, b.doc_id AS b, a.n AS na, b.n AS nb, count(*) AS c FROM g a JOIN g b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY ALL),
l AS (SELECT a, b FROM c WHERE 100 * c >= 80 * (na + nb - c) UNION ALL SELECT b, a FROM c WHERE 100 * c >= 80 * (na + nb - c)),
reach(doc_id, other) AS (SELECT doc_id, doc_id FROM documents UNION SELECT r.doc_id, l.b FROM reach r JOIN l ON r.other = l.a)
SELECT s.doc_id, CAST(len(s.s) AS BIGINT) AS n_shingles, m.component_id
FROM s JOIN (SELECT doc_id, min(other) AS component_id FROM reach GROUP BY doc_id) m ON s.doc_id = m.doc_id"""


def embedding_dedup() -> str:
    return """
WITH RECURSIVE v AS (
  SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
  WHERE label IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
l AS (SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.e) = len(b.e)
      WHERE list_cosine_similarity(a.e, b.e) >= 0.98),
reach(vec_id, other) AS (SELECT vec_id, vec_id FROM embeddings UNION SELECT r.vec_id, l.b FROM reach r JOIN l ON r.other = l.a),
m AS (SELECT vec_id, min(other) AS component_id FROM reach GROUP BY vec_id),
n AS (SELECT a AS vec_id, count(*) AS n FROM l GROUP BY a)
SELECT m.vec_id, CAST(coalesce(n.n, 0) AS BIGINT) AS n_links, m.component_id, m.vec_id = m.component_id AS kept
FROM m LEFT JOIN n ON m.vec_id = n.vec_id"""


def line_dedup() -> str:
    return f"""
WITH x AS (SELECT doc_id, text, string_split(text, chr(10)) AS ls FROM documents),
a AS (SELECT doc_id, unnest(ls) AS line, generate_subscripts(ls, 1) AS i FROM x),
f AS (SELECT doc_id, i, trim(line, {_WHITE}) AS t, row_number() OVER w AS r, count(*) OVER (PARTITION BY doc_id) AS n
      FROM a WHERE trim(line, {_WHITE}) <> '' WINDOW w AS (PARTITION BY doc_id ORDER BY i)),
k AS (SELECT doc_id, i AS s, r, n,
        CASE WHEN n >= 3 THEN lead(i, 2) OVER w WHEN n = 2 THEN lead(i) OVER w ELSE i END AS e,
        CASE WHEN n >= 3 THEN t || chr(10) || lead(t) OVER w || chr(10) || lead(t, 2) OVER w
             WHEN n = 2 THEN t || chr(10) || lead(t) OVER w ELSE t END AS win
      FROM f WINDOW w AS (PARTITION BY doc_id ORDER BY i)),
o AS (SELECT doc_id, s, e, row_number() OVER (PARTITION BY win ORDER BY doc_id, s) AS o FROM k WHERE r <= greatest(n - 2, 1)),
cut AS (SELECT DISTINCT a.doc_id, a.i FROM a JOIN o ON a.doc_id = o.doc_id AND a.i BETWEEN o.s AND o.e WHERE o.o > 1),
kept AS (SELECT a.doc_id, string_agg(a.line, chr(10) ORDER BY a.i) AS text FROM a ANTI JOIN cut ON a.doc_id = cut.doc_id AND a.i = cut.i GROUP BY a.doc_id),
cnt AS (SELECT f.doc_id, count(*) AS n, count(cut.i) AS c FROM f LEFT JOIN cut ON f.doc_id = cut.doc_id AND f.i = cut.i GROUP BY f.doc_id)
SELECT x.doc_id, CAST(coalesce(cnt.n, 0) AS BIGINT) AS n_lines, CAST(coalesce(cnt.c, 0) AS BIGINT) AS n_removed,
  CASE WHEN x.text IS NOT NULL THEN coalesce(kept.text, '') END AS text
FROM x LEFT JOIN cnt ON x.doc_id = cnt.doc_id LEFT JOIN kept ON x.doc_id = kept.doc_id"""


def quality_rules(steps: int = 40) -> str:
    """The rules and their estimation; R = 8 rules."""
    r = 8
    bad_good = [
        ("word_chars < 2 * n OR word_chars > 20 * n", "word_chars >= 3 * n AND word_chars <= 12 * n"),
        ("10 * n_symbols > n", "50 * n_symbols <= n"),
        ("2 * n_dup_lines > n_lines", "n_dup_lines = 0 AND n_lines > 2"),
        ("10 * n_repeat_words > 3 * n", "20 * n_repeat_words <= n"),
        ("10 * n_other > word_chars", "16 * n_other <= word_chars"),
        ("10 * n_upper > 3 * word_chars", "10 * n_upper <= word_chars"),
        ("5 * n_marks > n", "20 * n_marks <= n"),
        ("5 * n_alone > n", "20 * n_alone <= n")]
    votes = ", ".join(f"CASE WHEN {b} THEN -1 WHEN {g} THEN 1 ELSE 0 END" for b, g in bad_good)
    state = ["(sum(n * q) + 1) / (sum(n) + 2)"]
    for q in ("q", "(1 - q)"):
        for v in (1, -1):
            state += [f"(sum(CASE WHEN v[{k + 1}] = {v} THEN n * {q} ELSE 0 END) + 1) / (sum(n * {q}) + 3)" for k in range(r)]
    # a state is [share, good's P(1) x 8, good's P(-1) x 8, bad's P(1) x 8, bad's P(-1) x 8], 1-based here
    log = lambda k, at: f"ln(CASE v[{k}] WHEN 1 THEN st[{at + k}] WHEN -1 THEN st[{at + r + k}] ELSE 1 - st[{at + k}] - st[{at + r + k}] END)"
    good = " + ".join(["ln(st[1])", *(log(k, 1) for k in range(1, r + 1))])
    bad = " + ".join(["ln(1 - st[1])", *(log(k, 1 + 2 * r) for k in range(1, r + 1))])
    posterior = f"1 / (1 + exp(least(({bad}) - ({good}), 500)))"
    begin = "1 / (1 + exp(least(4.0 * len(list_filter(v, lambda x: x = -1)) - len(list_filter(v, lambda x: x = 1)), 500)))"
    next_state = f"[{', '.join(state)}]"
    white = "[\\x20\\x09-\\x0D]"
    return f"""
WITH RECURSIVE d AS (
  SELECT doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS w,
    regexp_replace(coalesce(text, ''), '{white}+', '', 'g') AS dense,
    list_filter(string_split(coalesce(text, ''), chr(10)), lambda s: regexp_matches(s, '[^\\x20\\x09-\\x0D]')) AS ls FROM documents),
g AS (SELECT doc_id, unnest(range(1, len(w) - 1)) AS p, unnest(list_transform(range(1, len(w) - 1), lambda i: array_to_string(w[i:i + 2], ' '))) AS win
      FROM d WHERE len(w) >= 3),
many AS (SELECT doc_id, p FROM g QUALIFY count(*) OVER (PARTITION BY doc_id, win) > 1),
rep AS (SELECT doc_id, count(DISTINCT p + o) AS n FROM many, range(3) t(o) GROUP BY doc_id),
c AS (SELECT d.doc_id, len(w) AS n, length(dense) AS word_chars, length(t) - length(translate(t, '#*$%&|<>', '')) AS n_symbols, len(ls) AS n_lines,
        len(ls) - len(list_distinct(ls)) AS n_dup_lines, coalesce(rep.n, 0) AS n_repeat_words, length(regexp_replace(dense, '\\p{{L}}+', '', 'g')) AS n_other,
        length(t) - length(translate(t, '{ASCII_UPPER}', '')) AS n_upper, length(t) - length(translate(t, '!?', '')) AS n_marks,
        len(list_filter(w, lambda x: NOT regexp_matches(x, '\\p{{L}}'))) AS n_alone
      FROM d LEFT JOIN rep ON d.doc_id = rep.doc_id),
k AS (SELECT *, [{votes}] AS v FROM c),
pats AS (SELECT v, CAST(count(*) AS DOUBLE) AS n FROM k GROUP BY v),
em(it, st) AS (
  SELECT 0, {next_state} FROM (SELECT v, n, {begin} AS q FROM pats)
  UNION ALL
  SELECT it + 1, {next_state} FROM (SELECT it, v, n, {posterior} AS q FROM em, pats WHERE it < {steps}) GROUP BY it),
post AS (SELECT v, {posterior} AS q FROM pats, em WHERE it = {steps})
SELECT doc_id, CAST(n AS BIGINT) AS n_words, CAST(word_chars AS BIGINT) AS word_chars, CAST(n_symbols AS BIGINT) AS n_symbols,
  CAST(n_dup_lines AS BIGINT) AS n_dup_lines, CAST(n_repeat_words AS BIGINT) AS n_repeat_words,
  n < 50 OR 100 * n_repeat_words > 50 * n AS base_failed, NOT (n < 50 OR 100 * n_repeat_words > 50 * n) AND q >= 0.5 AS kept
FROM k JOIN post ON k.v = post.v"""
