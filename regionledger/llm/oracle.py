"""SQL twins of the queries that SQL can express, for DuckDB over the same tables."""

from __future__ import annotations

from regionledger.llm import mixing, secrets, substring

_WORD = r"'[^\x20\x09-\x0D]+'"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def token_counts() -> str:
    return f"SELECT doc_id, CAST(len(regexp_extract_all(coalesce(text, ''), {_WORD})) AS BIGINT) AS n_tokens, true AS closed FROM documents"


def substring_dedup(k: int = substring.WINDOW) -> str:
    return f"""
WITH w AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), {_WORD}) AS ws FROM documents),
windows AS (SELECT doc_id, i, array_to_string(ws[i : i + {k - 1}], ' ') AS k FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - {k - 2})) AS i FROM w WHERE len(ws) >= {k})),
earliest AS (SELECT k, min(doc_id) AS least FROM windows GROUP BY k),
gone AS (SELECT DISTINCT doc_id, unnest(range(i, i + {k})) AS p FROM windows JOIN earliest USING (k) WHERE least < doc_id),
words AS (SELECT doc_id, unnest(ws) AS word, unnest(range(1, len(ws) + 1)) AS p FROM w),
kept AS (SELECT doc_id, string_agg(word, ' ' ORDER BY p) AS kept, count(*) AS n FROM words ANTI JOIN gone USING (doc_id, p) GROUP BY doc_id)
SELECT w.doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(len(ws) - coalesce(n, 0) AS BIGINT) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
FROM w LEFT JOIN kept USING (doc_id)"""


def jaccard_join(k: int = 4, num: int = 85, den: int = 100) -> str:
    return f"""
WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), {_WORD}) AS ws FROM documents),
starts AS (SELECT doc_id, ws, unnest(range(1, greatest(len(ws) - {k - 2}, 2))) AS i FROM w WHERE len(ws) > 0),
shingles AS (SELECT DISTINCT doc_id, array_to_string(ws[i : i + {k - 1}], ' ') AS s FROM starts),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
common AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id <> b.doc_id GROUP BY ALL),
links AS (SELECT x, y FROM common JOIN sizes p ON p.doc_id = x JOIN sizes q ON q.doc_id = y WHERE {den} * c >= {num} * (p.n + q.n - c)),
reach AS (SELECT doc_id AS d, doc_id AS r FROM w UNION SELECT y, r FROM reach JOIN links ON x = d)
SELECT w.doc_id, coalesce(n, 0) AS n_shingles, min(r) AS component_id
FROM w LEFT JOIN sizes USING (doc_id) JOIN reach ON d = w.doc_id GROUP BY ALL"""


def temperature_mix(limit: float, seed: int = 7) -> str:
    return f"""
WITH RECURSIVE keyed AS (SELECT *, substr(md5(concat_ws('|', '{seed}', src, substr(own, 1, 2))), 1, 8) || own AS key FROM (
  SELECT doc_id, source, coalesce('=' || source, '') AS src, len(regexp_extract_all(coalesce(text, ''), {_WORD})) AS tokens,
    substr(md5(concat_ws('|', coalesce(CAST(doc_id AS VARCHAR), ''), coalesce(text, ''))), 1, 12) AS own FROM documents)),
sources AS (SELECT src, sum(tokens) AS t FROM keyed GROUP BY src),
ends AS (SELECT max(CAST(t AS DOUBLE)) AS most, min(CAST(t AS DOUBLE)) AS least FROM sources WHERE t > 0),
halves AS (SELECT 0 AS step, 0.0::DOUBLE AS lo, 1.0::DOUBLE AS hi UNION ALL
  SELECT step + 1, CASE WHEN fits THEN lo ELSE (lo + hi) / 2 END, CASE WHEN fits THEN (lo + hi) / 2 ELSE hi END
  FROM (SELECT *, pow(most / least, 1 - (lo + hi) / 2) <= {limit!r} AS fits FROM halves, ends) WHERE step < {mixing.STEPS}),
raised AS (SELECT src, t, CASE WHEN t > 0 THEN pow(CAST(t AS DOUBLE), hi) ELSE 0 END AS x FROM sources, halves WHERE step = {mixing.STEPS}),
shares AS (SELECT src, t, CASE WHEN t > 0 THEN x * (SELECT max(t / x) FROM raised WHERE t > 0) / t ELSE 1 END AS passes FROM raised),
plan AS (SELECT src, floor(passes + 1e-9) AS whole, greatest(round((passes - floor(passes + 1e-9)) * t), 0) AS rest FROM shares),
placed AS (SELECT *, sum(tokens) OVER (PARTITION BY src ORDER BY key RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) - sum(tokens) OVER (PARTITION BY src, key) AS before FROM keyed),
passes AS (SELECT doc_id, source, substr(key, 1, 8) AS block, CAST(whole + CASE WHEN before < rest THEN 1 ELSE 0 END AS BIGINT) AS n FROM placed JOIN plan USING (src))
SELECT doc_id, source, CAST(unnest(range(0, n)) AS INTEGER) AS epoch, block FROM passes"""


def secret_scan(scope: int = secrets.SCOPE) -> str:
    quoted = lambda p: "'" + p.replace("'", "''") + "'"
    found = " UNION ALL ".join(
        f"SELECT doc_id, {n} AS kind, '{p.kind}' AS name, '{p.role}' AS role, {str(p.strong).lower()} AS strong, {p.least} AS least, string_split_regex(t, {quoted(p.pattern)}) AS g,"
        f" regexp_extract_all(t, {quoted(p.pattern)}) AS m, regexp_extract_all(t, {quoted(p.pattern)}, {p.group}) AS v FROM d WHERE regexp_matches(t, {quoted(p.pattern)})"
        for n, p in enumerate(secrets.PARTS)
    )
    listed = lambda which: f"coalesce(string_agg(name || ':' || a || ':' || b, ',' ORDER BY a, kind){which}, '')"
    near = f"EXISTS (SELECT 1 FROM free o WHERE o.doc_id = p.doc_id AND o.role = '%s' AND o.a <= p.b + {scope} AND o.b >= p.a - {scope})"
    name, secret = near % "name", near % "secret"
    return f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
found AS ({found}),
each AS (SELECT doc_id, kind, name, role, strong, least, unnest(g) AS gap, unnest(m) AS hit, unnest(v) AS part, unnest(range(0, len(g))) AS i FROM found),
placed AS (SELECT *, sum(length(gap) + coalesce(length(hit), 0)) OVER (PARTITION BY doc_id, kind ORDER BY i) AS b FROM each),
parts AS (SELECT doc_id, kind, name, role, strong, CAST(b - length(hit) AS BIGINT) AS a, CAST(b AS BIGINT) AS b FROM placed WHERE length(part) >= least),
free AS (SELECT * FROM parts p WHERE strong OR NOT EXISTS (SELECT 1 FROM parts s WHERE s.doc_id = p.doc_id AND s.strong AND s.a < p.b AND s.b > p.a)),
spans AS (SELECT * FROM free p WHERE strong OR CASE role WHEN 'name' THEN {secret} WHEN 'secret' THEN {name} ELSE {name} AND {secret} END)
SELECT d.doc_id, count(*) FILTER (kind = 0) AS n_assign, count(*) FILTER (kind = 1) AS n_access, count(*) FILTER (kind = 2) AS n_hex,
  sha256({listed(' FILTER (kind < 3)')}) AS base_sha256, {listed('')} AS spans
FROM d LEFT JOIN spans USING (doc_id) GROUP BY d.doc_id"""


def vector_codes(parts: int = 8, entries: int = 16, rounds: int = 6, scale: int = 4096) -> str:
    """Integer k-means of op11, one CTE per round; components in long form (row, part, position)."""
    steps = []
    for t in range(rounds + 1):
        steps.append(
            f"d{t} AS (SELECT v.r, v.p, b.k, sum((v.v - b.c) * (v.v - b.c)) AS dist FROM comp v JOIN cb{t} b ON v.p = b.p AND v.j = b.j GROUP BY ALL),\n"
            f"a{t} AS (SELECT r, p, first(k ORDER BY dist, k) AS k, min(dist) AS dist FROM d{t} GROUP BY r, p)"
        )
        if t < rounds:
            steps.append(
                f"cb{t + 1} AS (SELECT o.p, o.k, o.j, coalesce(n.c, o.c) AS c FROM cb{t} o LEFT JOIN ("
                f"SELECT a.p, a.k, v.j, CAST((sum(v.v) - ((sum(v.v) % count(*)) + count(*)) % count(*)) // count(*) AS BIGINT) AS c"
                f" FROM a{t} a JOIN comp v USING (r, p) GROUP BY ALL) n USING (p, k, j))"
            )
    return f"""
WITH kept AS (SELECT vec_id, label, list_transform(embedding, lambda x: CAST(floor({scale} * CAST(x AS DOUBLE)) AS BIGINT)) AS ints, row_number() OVER () AS r
  FROM embeddings WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
dim AS (SELECT CAST(ceil(max(len(ints)) / {parts}) AS BIGINT) AS m FROM kept),
comp AS (SELECT r, CAST(i // m AS INTEGER) AS p, CAST(i % m AS INTEGER) AS j, coalesce(ints[i + 1], 0) AS v
  FROM (SELECT r, ints, m, unnest(range(0, {parts} * m)) AS i FROM kept, dim)),
seeds AS (SELECT r, row_number() OVER (ORDER BY vec_id NULLS LAST, ints) - 1 AS k FROM kept QUALIFY k < {entries}),
cb0 AS (SELECT p, k, j, v AS c FROM comp JOIN seeds USING (r)),
{",\n".join(steps)},
res AS (SELECT r, string_agg(printf('%02x', k), '' ORDER BY p) AS code, CAST(sum(dist) AS BIGINT) AS error FROM a{rounds} GROUP BY r)
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error,
  (SELECT sha256(string_agg(CAST(c AS VARCHAR), ',' ORDER BY p, k, j)) FROM cb{rounds}) AS codebooks_sha256
FROM res JOIN kept USING (r)"""


def ranked_search(top: int = 10) -> str:
    term = r"'[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+'"
    return f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), {term}) AS ts FROM documents),
stats AS (SELECT count(*) FILTER (len(ts) > 0) AS big_n, sum(len(ts)) AS big_l FROM d),
it AS (SELECT DISTINCT item_id, unnest(regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), {term})) AS term FROM benchmark),
tf AS (SELECT r, term, count(*) AS tf FROM (SELECT r, unnest(ts) AS term FROM d) WHERE term IN (SELECT term FROM it) GROUP BY ALL),
w AS (SELECT term, CAST(floor(1000 * ln(CAST(2 * big_n + 2 AS DOUBLE) / CAST(2 * count(*) + 1 AS DOUBLE))) AS BIGINT) AS w FROM tf, stats GROUP BY term, big_n),
m AS (SELECT r, doc_id, 10 + (90 * CAST(len(ts) AS HUGEINT) * big_n) // big_l AS m FROM d, stats WHERE len(ts) > 0),
sc AS (SELECT item_id, r, doc_id, sum(w * ((1000000000 * tf) // (1000 * tf + 8 * m))) AS score FROM it JOIN tf USING (term) JOIN w USING (term) JOIN m USING (r) GROUP BY ALL)
SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id NULLS LAST) AS INTEGER) AS rank, doc_id, CAST(score AS BIGINT) AS score
FROM sc WHERE score > 0 QUALIFY rank <= {top}"""
