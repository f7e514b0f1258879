"""DuckDB SQL for the training-data queries that SQL can express.

Operators 1, 3 and 10 need the tokenizer libraries, 2 an expression parser, 4 and 8 trained models, 13 every lag of texts of
20,000 words: those, and the pipeline, are held against brute force in tests/llm.
"""

from __future__ import annotations

from seatloom.llm.host_trust import ANCHOR, DAMPING, RULES, SCALE, STEPS
from seatloom.llm.line_dedup import MIN_WORDS

_LOWER = "translate({0}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_ALNUM = "regexp_extract_all(" + _LOWER + r", '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
_NONSPACE = "regexp_extract_all(" + _LOWER + r", '[^\x20\x09-\x0D]+')"

OP5 = f"""
WITH d AS (SELECT doc_id, {_ALNUM.format("coalesce(text, '')")} AS w FROM documents),
i AS (SELECT item_id, {_ALNUM.format("coalesce(text, '')")} AS w FROM benchmark),
iwin AS (SELECT DISTINCT item_id, n, array_to_string(w[p : p + n - 1], ' ') AS g FROM (SELECT item_id, w, n, unnest(range(1, len(w) - n + 2)) AS p FROM (SELECT *, least(len(w), 13) AS n FROM i WHERE len(w) > 0))),
dwin AS (SELECT doc_id, n, p, array_to_string(w[p : p + n - 1], ' ') AS g FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS p FROM d, (SELECT DISTINCT n FROM iwin))),
hit AS (SELECT doc_id, p, n, item_id FROM dwin JOIN iwin USING (n, g)),
words AS (SELECT doc_id, count(DISTINCT q) AS n_hit FROM (SELECT doc_id, unnest(range(p, p + n)) AS q FROM hit) GROUP BY doc_id),
items AS (SELECT doc_id, count(*) AS n_items, string_agg(id, ',' ORDER BY id) AS ids FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS id FROM hit) GROUP BY doc_id)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items, sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN words USING (doc_id) LEFT JOIN items USING (doc_id)
"""

OP6 = f"""
WITH RECURSIVE w AS (SELECT doc_id, {_NONSPACE.format("coalesce(text, '')")} AS w FROM documents),
s AS (SELECT DISTINCT doc_id, array_to_string(w[p : p + 4], ' ') AS g FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 3, 2))) AS p FROM w WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
links AS (SELECT a.doc_id AS u, b.doc_id AS v FROM s a JOIN s b USING (g) JOIN n na ON na.doc_id = a.doc_id JOIN n nb ON nb.doc_id = b.doc_id WHERE a.doc_id <> b.doc_id GROUP BY u, v, na.n, nb.n HAVING 100 * count(*) >= 75 * (na.n + nb.n - count(*))),
reach AS (SELECT doc_id AS u, doc_id AS v FROM n UNION SELECT reach.u, links.v FROM reach JOIN links ON links.u = reach.v),
least AS (SELECT u AS doc_id, min(v) AS component_id FROM reach GROUP BY u)
SELECT w.doc_id, coalesce(n, 0) AS n_shingles, coalesce(component_id, w.doc_id) AS component_id, coalesce(component_id, w.doc_id) = w.doc_id AS kept
FROM w LEFT JOIN n USING (doc_id) LEFT JOIN least USING (doc_id)
"""

# every run of up to MIN_WORDS lines with words that holds MIN_WORDS words: its lines go if it occurs earlier
_FIRSTS = f"""
WITH l AS (SELECT doc_id, no, array_to_string(w, ' ') AS line, len(w) AS n, row_number() OVER (PARTITION BY doc_id ORDER BY no) AS place FROM (
  SELECT doc_id, no, {_NONSPACE.format("lines[no + 1]")} AS w FROM (SELECT doc_id, lines, unnest(range(0, len(lines))) AS no FROM (SELECT doc_id, string_split(text, chr(10)) AS lines FROM documents WHERE text IS NOT NULL))) WHERE len(w) > 0),
runs AS ({" UNION ALL ".join(f"SELECT doc_id, place, {m} AS m, " + " || chr(10) || ".join(f"lead(line, {i}) OVER o" for i in range(m)) + " AS g, " + " + ".join(f"lead(n, {i}) OVER o" for i in range(m)) + f" AS words, greatest(n, lead(n, {m - 1}) OVER o) AS end_words FROM l WINDOW o AS (PARTITION BY doc_id ORDER BY place)" for m in range(1, MIN_WORDS + 1))}),
firsts AS (SELECT *, min((doc_id, place)) OVER (PARTITION BY g, m) AS first FROM runs WHERE g IS NOT NULL AND words >= {MIN_WORDS})
"""

OP7 = f"""
{_FIRSTS},
gone AS (SELECT DISTINCT doc_id, unnest(range(place, place + m)) AS place FROM firsts WHERE first < (doc_id, place)),
dropped AS (SELECT doc_id, list(no) AS nos FROM gone JOIN l USING (doc_id, place) GROUP BY doc_id),
d AS (SELECT doc_id, string_split(text, chr(10)) AS lines, text, coalesce(nos, []) AS nos FROM documents LEFT JOIN dropped USING (doc_id)),
k AS (SELECT *, list_filter(lines, lambda x, i: NOT list_contains(nos, i - 1)) AS kept FROM d)
SELECT doc_id, coalesce(len(lines), 0)::BIGINT AS n_lines, len(nos)::BIGINT AS n_deleted, len(nos) > 0 AND regexp_full_match(array_to_string(kept, ' '), '[\\x20\\x09-\\x0D]*') AS emptied, CASE WHEN text IS NOT NULL THEN array_to_string(kept, chr(10)) END AS text FROM k
"""

# every pair of equal lines, the second earlier; on a diagonal, pairs one apart extend each other to the end of their island
LINE_RUNS = f"""
WITH x AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line, unnest(range(len(string_split(text, chr(10))))) AS no FROM documents WHERE text IS NOT NULL),
w AS (SELECT doc_id, no, {_NONSPACE.format("line")} AS w FROM x),
l AS (SELECT doc_id, no, row_number() OVER (PARTITION BY doc_id ORDER BY no) AS place, array_to_string(w, ' ') AS line, len(w) AS n FROM w WHERE len(w) > 0),
m AS (SELECT p.doc_id, p.place, q.doc_id AS d, q.place AS f, p.place - q.place AS shift FROM l p JOIN l q ON p.line = q.line AND (q.doc_id, q.place) < (p.doc_id, p.place)),
i AS (SELECT *, place - row_number() OVER (PARTITION BY doc_id, d, shift ORDER BY place) AS island FROM m),
e AS (SELECT doc_id, place, d, f, max(place) OVER (PARTITION BY doc_id, d, shift, island) - place + 1 AS n_lines FROM i),
longest AS (SELECT doc_id, place, max(n_lines) AS n_lines, arg_min((d, f), (-n_lines, d, f)) AS first FROM e GROUP BY doc_id, place),
r AS (SELECT *, coalesce(lag(n_lines) OVER (PARTITION BY doc_id ORDER BY place), 0) AS n_before, coalesce(lag(place) OVER (PARTITION BY doc_id ORDER BY place), -1) AS before FROM longest),
k AS (SELECT doc_id, place, n_lines, first[1] AS first_doc_id, first[2] AS f FROM r WHERE before <> place - 1 OR n_before <= n_lines),
s AS (SELECT k.doc_id, k.place, k.n_lines, first_doc_id, f, sum(l.n)::BIGINT AS n_words FROM k JOIN l ON l.doc_id = k.doc_id AND l.place BETWEEN k.place AND k.place + k.n_lines - 1 GROUP BY ALL HAVING sum(l.n) >= {MIN_WORDS})
SELECT s.doc_id, a.no::INTEGER AS line, n_lines, n_words, first_doc_id, b.no::INTEGER AS first_line FROM s JOIN l a ON a.doc_id = s.doc_id AND a.place = s.place JOIN l b ON b.doc_id = first_doc_id AND b.place = s.f
"""

OP9 = """
WITH v AS MATERIALIZED (SELECT vec_id, row_number() OVER () AS n, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS e FROM embeddings WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
p AS (SELECT q.vec_id AS query_id, q.n, v.vec_id, list_inner_product(q.e, v.e)::BIGINT AS score FROM v q JOIN v ON q.n <> v.n WHERE q.vec_id % 50 = 0)
SELECT * FROM (SELECT query_id, (row_number() OVER (PARTITION BY n ORDER BY score DESC, vec_id))::INTEGER AS rank, vec_id, score FROM p) WHERE rank <= 5
"""

# the edits by layers of whole rows instead of a search: of each state the cheapest way there, the audit as text
_WAYS = ["", "s", "u", "a"]


def _more(way: str, edit: str, cost: str) -> str:
    return f"CASE WHEN {way} IS NOT NULL THEN {{'c': {way}.c + {cost}, 'e': {way}.e || '{edit}'}} END"


def _layer(into: dict[str, list[str]], source: str) -> str:
    """Of each state the least of the ways into it, then up to three inserted turns."""
    text = "SELECT conv_id, i, " + ", ".join(f"list_min([{', '.join(into[s])}]) AS w_{s}" for s in _WAYS) + f" FROM {source}"
    put = lambda *ways: ", ".join(_more(w, "I", "3") for w in ways)
    for _ in range(3):
        text = f"SELECT conv_id, i, w_, w_s, list_min([w_u, {put('w_', 'w_s', 'w_a')}]) AS w_u, list_min([w_a, {put('w_u')}]) AS w_a FROM ({text})"
    return text


def _op11() -> str:
    stays = lambda cond, way: f"CASE WHEN {cond} AND NOT must THEN {way} END"
    into = {s: [_more(f"p_{s}", "D", "4")] for s in _WAYS}
    for s in _WAYS:
        into["a" if s == "u" else "u"].append(stays("true", _more(f"p_{s}", "R", "3 + more")))
    into["s"].append(stays("letter = 's'", _more("p_", "K", "more")))
    into["u"] += [stays("letter = 'u'", _more(f"p_{s}", "K", "more")) for s in ("", "s", "a")]
    into["a"].append(stays("letter = 'a'", _more("p_u", "K", "more")))
    nothing = {s: ["{'c': 0::BIGINT, 'e': ''}" if s == "" else "NULL::STRUCT(c BIGINT, e VARCHAR)"] for s in _WAYS}
    begin = _layer(nothing, "(SELECT DISTINCT conv_id, 0::BIGINT AS i FROM hurt)")
    go = _layer(into, "(SELECT w.conv_id, h.i, h.letter, h.must, h.more, " + ", ".join(f"w.w_{s} AS p_{s}" for s in _WAYS) + " FROM ways w JOIN hurt h ON h.conv_id IS NOT DISTINCT FROM w.conv_id AND h.i = w.i + 1)")
    cols = ", ".join(f"w_{s}" for s in _WAYS)
    return f"""
WITH RECURSIVE k(t) AS MATERIALIZED (SELECT list(v ORDER BY i) FROM (SELECT i, list_reduce(range(8), lambda c, x: CASE WHEN c % 2 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, i) AS v FROM range(256) r(i))),
told AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text, coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ') AS key FROM conversations),
sums AS (SELECT conv_id, turn, role, text, xor(list_reduce(list_transform(string_split(key, ''), lambda x: ascii(x)::BIGINT), lambda c, b: xor(c >> 8, t[(xor(c, b) % 256) + 1]), 4294967295), 4294967295) % 20 AS what FROM told, k),
hit AS (SELECT conv_id, turn, CASE WHEN what = 4 THEN 'user' ELSE role END AS role, CASE what WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text, unnest(range(CASE what WHEN 0 THEN 0 WHEN 3 THEN 2 ELSE 1 END)) FROM sums),
placed AS (SELECT conv_id, turn, role, text, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, sha256(length(role) || ':' || role || text)) AS i FROM hit),
faults AS (SELECT *, substr(role, 1, 1) AS letter, rtrim(text, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS body, row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) AS nth FROM placed),
hurt AS (SELECT *, CASE WHEN body = '' THEN 'blank' WHEN nth > 1 THEN 'duplicate' WHEN right(body, 1) NOT IN ('.', '!', '?') THEN 'truncated' ELSE '' END AS fault, body = '' OR nth > 1 AS must, CASE WHEN body <> '' AND nth = 1 AND right(body, 1) NOT IN ('.', '!', '?') THEN 3 ELSE 0 END AS more, lead(substr(role, 1, 1)) OVER (PARTITION BY conv_id ORDER BY i) AS next FROM faults),
ways AS (SELECT conv_id, 0::BIGINT AS i, {cols} FROM ({begin}) UNION ALL SELECT conv_id, i, {cols} FROM ({go})),
best AS (SELECT conv_id, list_min([w_, w_a]) AS b FROM ways QUALIFY i = max(i) OVER (PARTITION BY conv_id)),
marks AS (SELECT conv_id, b.e AS audit, p, substr(b.e, p, 1) AS edit, length(replace(substr(b.e, 1, p), 'I', '')) AS i, row_number() OVER (PARTITION BY conv_id ORDER BY p) AS n FROM (SELECT conv_id, b, unnest(range(1, length(b.e) + 1)) AS p FROM best)),
stay AS (SELECT m.conv_id, m.p, m.edit, h.role, h.text, row_number() OVER (PARTITION BY m.conv_id ORDER BY p) AS k, max(CASE WHEN h.letter = 's' AND m.edit = 'K' THEN 1 ELSE 0 END) OVER (PARTITION BY m.conv_id) AS s FROM marks m LEFT JOIN hurt h ON h.conv_id IS NOT DISTINCT FROM m.conv_id AND h.i = m.i WHERE m.edit <> 'D'),
texts AS (SELECT conv_id, string_agg(CASE WHEN edit = 'K' THEN role WHEN (k - s) % 2 = 1 THEN 'user' ELSE 'assistant' END || ':' || CASE WHEN edit = 'I' THEN '' ELSE text END, chr(10) ORDER BY p) AS t FROM stay GROUP BY conv_id),
counts AS (SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (WHERE fault = 'blank') AS blank, count(*) FILTER (WHERE fault = 'duplicate') AS duplicate, count(*) FILTER (WHERE fault = 'truncated') AS truncated, count(*) FILTER (WHERE next IS NOT NULL AND letter || next NOT IN ('su', 'ua', 'au')) AS illegal FROM hurt GROUP BY conv_id)
SELECT o.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, coalesce(b.c, 0) AS cost, coalesce(b.e, '') AS audit, sha256(coalesce(t, '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) o LEFT JOIN counts c ON c.conv_id IS NOT DISTINCT FROM o.conv_id LEFT JOIN best ON best.conv_id IS NOT DISTINCT FROM o.conv_id LEFT JOIN texts x ON x.conv_id IS NOT DISTINCT FROM o.conv_id
"""


def _op12() -> str:
    rest = "CASE WHEN contains(url, '://') THEN substr(url, strpos(url, '://') + 3) ELSE '' END"
    lower = _LOWER.format("{0}")
    fits = " ".join(f"WHEN (host = '{r.host}' OR ends_with(host, '.{r.host}')) AND starts_with(path, '{r.path}') THEN '{{0}}'".replace("{0}", f"{r.verdict} {r.host}{r.path}") for r in sorted(RULES, key=lambda r: -len(r.host + r.path)))
    anchor = ANCHOR.replace("'", "''")
    steps, name = [], "start"
    for k in range(STEPS):
        steps.append(f"n{k} AS MATERIALIZED (SELECT kind, host, sum(amount)::BIGINT AS amount FROM (SELECT n.kind, e.dst AS host, (n.amount::HUGEINT * e.weight * {DAMPING}) // (e.total * 100) AS amount FROM {name} n JOIN e ON e.kind = n.kind AND e.src = n.host UNION ALL SELECT kind, host, (amount * {100 - DAMPING}) // 100 FROM start) GROUP BY kind, host)")
        name = f"n{k}"
    return f"""
WITH u AS (SELECT page_id, html, regexp_extract(rest, '^([^/?#]*)', 1) AS h, rest FROM (SELECT page_id, html, coalesce({rest}, '') AS rest FROM pages)),
p AS (SELECT *, CASE {fits} END AS fit FROM (SELECT page_id, html, {lower.format('h')} AS host, regexp_extract(substr(rest, length(h) + 1), '^([^?#]*)', 1) AS path FROM u)),
seeds AS (SELECT host, count(*) FILTER (WHERE fit LIKE 'allow%') AS allowed, count(*) FILTER (WHERE fit LIKE 'block%') AS blocked FROM p WHERE fit IS NOT NULL GROUP BY host),
a AS (SELECT src, dst, count(*) AS weight FROM (SELECT DISTINCT page, src, dst FROM (SELECT row_number() OVER () AS page, host AS src, unnest(list_transform(regexp_extract_all(html, '{anchor}', 1), lambda x: {lower.format('x')})) AS dst FROM p WHERE host <> '')) WHERE dst <> '' AND dst <> src GROUP BY src, dst),
h AS (SELECT host FROM p WHERE host <> '' UNION SELECT dst FROM a),
s AS (SELECT x.host AS src, y.host AS dst FROM h x JOIN h y ON y.host = substr(x.host, strpos(x.host, '.') + 1) WHERE contains(x.host, '.')),
l AS (SELECT src, dst, sum(weight)::BIGINT AS weight FROM (SELECT * FROM a UNION ALL SELECT src, dst, 1 FROM s UNION ALL SELECT dst, src, 1 FROM s) GROUP BY src, dst),
e AS MATERIALIZED (SELECT *, (sum(weight) OVER (PARTITION BY kind, src))::BIGINT AS total FROM (SELECT 0 AS kind, src, dst, weight FROM l UNION ALL SELECT 1, dst, src, weight FROM l)),
start AS MATERIALIZED (SELECT kind, host, (pages::HUGEINT * {SCALE} // (SELECT sum(allowed + blocked) FROM seeds))::BIGINT AS amount FROM (SELECT 0 AS kind, host, allowed AS pages FROM seeds UNION ALL SELECT 1, host, blocked FROM seeds) WHERE pages > 0),
{", ".join(steps)},
known AS (SELECT host, coalesce(sum(amount) FILTER (WHERE kind = 0), 0)::BIGINT AS trust, coalesce(sum(amount) FILTER (WHERE kind = 1), 0)::BIGINT AS distrust FROM {name} GROUP BY host)
SELECT page_id, p.host, path, substr(fit, 7) AS rule, coalesce(substr(fit, 1, 5), CASE WHEN distrust > trust THEN 'block' ELSE 'allow' END) AS verdict, coalesce(trust, 0) AS trust, coalesce(distrust, 0) AS distrust FROM p LEFT JOIN known ON known.host = p.host
"""


ORACLE: dict[str, str] = {"op11_conversations": _op11(), "op12_url_filter": _op12(), "op5_decontaminate": OP5, "op6_near_dedup": OP6, "op7_line_dedup": OP7, "line_runs": LINE_RUNS, "op9_topk": OP9}
