"""DuckDB SQL for the vote queries."""

from __future__ import annotations

from seatloom.functions.colors import NO_DATA, PALETTES, STEEPNESS
from seatloom.operators.extract import BAD_VOTES, NO_SCRIPT, NOT_JSON, UNBALANCED
from seatloom.sources.tables import BLOCS, PAGE_CUSTOMERS

_VOTES = """votes AS (
  SELECT n_nationkey::BIGINT AS seat_pos, n_nationkey::VARCHAR AS seat_id, n_nationkey::VARCHAR AS seat_number, n_name AS seat_name, c_custkey AS res_pos, c_custkey::VARCHAR AS diid, v.votes,
    CASE WHEN c_custkey % 7 = 0 THEN 'Unknown' ELSE c_name END AS candidate_name, CASE WHEN c_custkey % 7 = 0 THEN 'UNKNOWN' ELSE c_mktsegment END AS party
  FROM customer JOIN (SELECT o_custkey, count(*) AS votes FROM orders GROUP BY o_custkey) v ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey WHERE n_nationkey % 10 <> 9)"""
_SEATS = "seats AS (SELECT n_nationkey::BIGINT AS seat_pos, n_nationkey::VARCHAR AS seat_id, n_nationkey::VARCHAR AS seat_number, n_name AS seat_name FROM nation)"
_PARTIES = ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY", "UNKNOWN"]


def _text(words: str) -> str:
    return "'" + words.replace("'", "''") + "'"


def _in(bloc) -> str:
    return "(" + (" OR ".join(f"lower(party) LIKE '%{k}%'" for k in bloc.keywords) or "false") + ")"


_TOP = """top AS (SELECT seat_id, rank, candidate_name, party, votes, votes / total * 100 AS share FROM (
  SELECT *, row_number() OVER (PARTITION BY seat_id ORDER BY votes DESC, res_pos) AS rank, (sum(votes) OVER (PARTITION BY seat_id))::BIGINT AS total FROM votes) WHERE rank <= 3 AND total > 0)"""
_TEXTS = """texts AS (SELECT seat_id, string_agg(candidate_name || ' (' || party || ') ' || printf('%.1f', share) || '%', ', ' ORDER BY rank) AS top_three_candidates,
  string_agg(party || ' (' || printf('%.1f', share) || '%)', ', ' ORDER BY rank) AS top_three FROM top GROUP BY seat_id)"""
_SUMS = "sums AS (SELECT seat_id, sum(votes)::BIGINT AS total_votes, " + ", ".join(f"coalesce(sum(votes) FILTER (WHERE {_in(b)}), 0)::BIGINT AS {b.code}_votes" for b in BLOCS) + " FROM votes GROUP BY seat_id)"
_BLOCS = "blocs AS (SELECT seats.seat_id, coalesce(total_votes, 0) AS total_votes, " + ", ".join(f"coalesce({b.code}_votes, 0) AS {b.code}_votes, CASE WHEN coalesce(total_votes, 0) = 0 THEN 0.0::DOUBLE ELSE {b.code}_votes / total_votes END AS {b.code}_ratio" for b in BLOCS) + " FROM seats LEFT JOIN sums USING (seat_id))"
_WIDE = "wide AS (SELECT seats.seat_id, " + ", ".join(f"coalesce(sum(votes) FILTER (WHERE party = '{p}'), 0)::BIGINT AS \"{p}\"" for p in _PARTIES) + " FROM seats LEFT JOIN votes USING (seat_id) GROUP BY seats.seat_id)"
_PAIR = "CASE WHEN alpha_ratio <= 0 OR beta_ratio <= 0 THEN 0.0::DOUBLE ELSE alpha_ratio / (alpha_ratio + beta_ratio) END"
_PAIR_DEFINED = "alpha_ratio > 0 AND beta_ratio > 0"
_KEY = "regexp_replace(regexp_replace({0}, '[^a-z0-9\\- ]', '', 'g'), ' +', ' ', 'g')"
_FEATURES = """features AS (SELECT feature_pos, raw_name, own_name, """ + _KEY.format("lower(own_name)") + """ AS seat_key FROM (SELECT *, trim(raw_name, E' \\t') AS own_name FROM (
  SELECT n_nationkey::BIGINT AS feature_pos, CASE WHEN n_nationkey % 9 = 8 THEN 'Elsewhere ' || n_nationkey WHEN n_nationkey % 5 = 0 THEN E' \\t' || lower(n_name) || ' '
    WHEN n_nationkey % 5 = 1 THEN substr(n_name, 1, 2) || '.' || substr(n_name, 3) WHEN n_nationkey % 5 = 2 THEN n_name || '''!' ELSE n_name END AS raw_name FROM nation)))"""
_SHARES = "shares AS (" + " UNION ALL ".join(
    f"SELECT '{b.code}' AS code, {_KEY.format('lower(seat_name)')} AS seat_key, {_PAIR if b.pair else f'{b.code}_ratio'} AS ratio, {_PAIR_DEFINED if b.pair else 'true'} AS ratio_defined, seat_name, coalesce(top_three_candidates, '') AS top_three FROM seats JOIN blocs USING (seat_id) LEFT JOIN texts USING (seat_id)"
    for b in BLOCS
) + ")"
_JOINED = "codes AS (SELECT unnest([" + ", ".join(f"'{b.code}'" for b in BLOCS) + """]) AS code), joined AS (SELECT feature_pos, c.code, f.seat_key, s.code IS NOT NULL AS has_data, coalesce(ratio, 0) AS ratio, coalesce(ratio_defined, false) AS ratio_defined,
  CASE WHEN s.code IS NOT NULL THEN s.seat_name ELSE f.own_name END AS seat_name, coalesce(s.top_three, '') AS top_three FROM features f CROSS JOIN codes c LEFT JOIN shares s ON s.code = c.code AND s.seat_key = f.seat_key WHERE f.seat_key <> '')"""
_MAP = f"WITH {_VOTES}, {_SEATS}, {_TOP}, {_TEXTS}, {_SUMS}, {_BLOCS}, {_FEATURES}, {_SHARES}, {_JOINED} "


def _rgb(color: str) -> list[int]:
    return [int(color[i : i + 2], 16) for i in (1, 3, 5)]


def _mixed(start: str, end: str, t: str, whole: str, form: str) -> str:
    parts = ", ".join(f"{whole.format(f'({a} + ({b - a}) * least(1.0, greatest(0.0, {t})))')}::INTEGER" for a, b in zip(_rgb(start), _rgb(end), strict=True))
    return f"printf('#{form}{form}{form}', {parts})"


def _contrast(t: str) -> str:
    curve = lambda x: f"(1 / (1 + exp(-{STEEPNESS} * ({x} - 0.5))))"
    return f"round(({curve(f'least(1.0, greatest(0.0, {t}))')} - {curve('0.0')}) / ({curve('1.0')} - {curve('0.0')}), 12)"


def _palette_rows() -> str:
    out = []
    for name in ("default", *PALETTES):
        fills = " ".join(f"WHEN code = '{b.code}' THEN {_mixed(*(b.gradient if name == 'default' else PALETTES[name]), 't', 'floor({} + 0.5)', '%02x')}" for b in BLOCS)
        out.append(f"SELECT feature_pos, code, '{name}' AS palette, CASE WHEN ratio <= 0 OR NOT ratio_defined THEN '{NO_DATA}' {fills} END AS shown_fill FROM curved")
    return " UNION ALL ".join(out)


_CONFIG = """config AS (SELECT n_regionkey AS page, row_number() OVER (PARTITION BY n_regionkey ORDER BY n_nationkey) - 1 AS place, 'n' || n_nationkey AS code,
  CASE WHEN n_nationkey % 6 = 5 THEN 'n' || n_nationkey ELSE upper(n_name[1]) || lower(n_name[2:]) END AS display_name, CASE WHEN n_nationkey % 4 = 0 THEN '' ELSE lower(n_name) || ',of ' || n_regionkey END AS keywords,
  CASE WHEN n_nationkey % 3 = 0 THEN '#FFFFCC' ELSE '#f0f9e8' END AS low, CASE WHEN n_nationkey % 3 = 0 THEN '#0060C9' ELSE '#0868ac' END AS high,
  CASE WHEN n_nationkey % 5 = 2 THEN 'n' || (n_nationkey - 1) || '/n' || (n_nationkey + 1) ELSE '' END AS pair FROM nation)"""
_LEGEND = f"""WITH {_CONFIG}, p AS (SELECT c.*, coalesce(a.display_name, split_part(c.pair, '/', 1)) AS part, coalesce(b.display_name, split_part(c.pair, '/', 2)) AS other FROM config c
  LEFT JOIN config a ON a.page = c.page AND a.code = split_part(c.pair, '/', 1) LEFT JOIN config b ON b.page = c.page AND b.code = split_part(c.pair, '/', 2))
SELECT page, code, display_name AS title, CASE WHEN pair = '' THEN 'Percentage of total votes cast in each constituency' ELSE 'Share of ' || part || ' in the votes of ' || part || ' and ' || other END AS subtitle,
  CASE WHEN pair = '' THEN 'No candidates nominated' ELSE 'At least one group missing data' END AS no_data, CASE WHEN pair = '' THEN 'Weaker support (0%)' ELSE other || ' dominated' END AS low_label,
  CASE WHEN pair = '' THEN 'Stronger support (100%)' ELSE part || ' dominated' END AS high_label, low, high FROM p"""


_PLACES = "['Chattogram-', 'Barishal-', 'Chapai  Nawabganj-', 'Jhalakathi-', 'Moulvibazar-', 'Netrokona-', 'Parbatya Khagrachhari', 'Parbatya Bandarban-']"
_SPELT = "replace(replace(replace(replace(replace(replace(replace(lower(trim(raw_name)), 'chattogram', 'chittagong'), 'barishal', 'barisal'), 'chapai nawabganj', 'chapai nababganj'), 'jhalakathi', 'jhalokathi'), 'moulvibazar', 'maulvibazar'), 'netrokona', 'netrakona'), 'khagrachhari', 'khagrachari')"
_SPACE = "' ' || chr(9) || chr(160)"

_PAGES = """held AS (SELECT c_custkey, c_name, c_mktsegment, c_nationkey AS n, n_name, c_custkey // {0} AS block, c_custkey % 4 AS seat, v.votes, (c_nationkey + c_custkey // {0}) % 7 AS fault
  FROM customer JOIN (SELECT o_custkey, count(*) AS votes FROM orders GROUP BY o_custkey) v ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey),
  seats AS (SELECT DISTINCT 'nation/' || n || '/' || block AS page, s::BIGINT AS seat_pos, s::VARCHAR AS seat_id, s::VARCHAR AS seat_number, n_name || '-' || s AS seat_name FROM held, range(4) r(s) WHERE fault NOT IN (3, 5, 6)),
  votes AS (SELECT 'nation/' || n || '/' || block AS page, seat::BIGINT AS seat_pos, seat::VARCHAR AS seat_id, seat::VARCHAR AS seat_number, n_name || '-' || seat AS seat_name,
    row_number() OVER (PARTITION BY n, block, seat ORDER BY c_custkey) - 1 AS res_pos, c_custkey::VARCHAR AS diid, CASE WHEN c_custkey % 29 = 28 THEN -1 WHEN c_custkey % 3 <> 0 THEN held.votes END AS votes,
    CASE WHEN c_custkey % 7 = 0 THEN 'Unknown' ELSE c_name END AS candidate_name, CASE WHEN c_custkey % 7 = 0 OR c_custkey % 11 = 0 THEN 'UNKNOWN' ELSE c_mktsegment END AS party
  FROM held WHERE seat < 2 AND fault NOT IN (3, 5, 6))""".format(PAGE_CUSTOMERS)
_GOOD = _PAGES + ", good AS (SELECT * FROM votes WHERE votes >= 0)"


def _page_results() -> str:
    sums = ", ".join(f"coalesce(sum(votes) FILTER (WHERE {_in(b)}), 0)::BIGINT AS {b.code}_votes" for b in BLOCS)
    ratios = ", ".join(f"coalesce({b.code}_votes, 0) AS {b.code}_votes, coalesce({b.code}_votes / total, 0.0)::DOUBLE AS {b.code}_ratio" for b in BLOCS)
    parties = ", ".join(f"coalesce(\"{p}\", 0) AS \"{p}\"" for p in _PARTIES)
    own = ", ".join(f"sum(votes) FILTER (WHERE party = '{p}')::BIGINT AS \"{p}\"" for p in _PARTIES)
    return f"""WITH {_GOOD}, s AS (SELECT page, seat_id, sum(votes)::BIGINT AS total, {sums}, {own} FROM good GROUP BY ALL),
  t AS (SELECT page, seat_id, string_agg(candidate_name || ' (' || party || ') ' || printf('%.1f', votes / total * 100) || '%', ', ' ORDER BY rank) AS people, string_agg(party || ' (' || printf('%.1f', votes / total * 100) || '%)', ', ' ORDER BY rank) AS parties
    FROM (SELECT *, row_number() OVER (PARTITION BY page, seat_id ORDER BY votes DESC, res_pos) AS rank, sum(votes) OVER (PARTITION BY page, seat_id) AS total FROM good) WHERE rank <= 3 AND total > 0 GROUP BY ALL)
  SELECT page, seat_id, seat_number, seat_name, coalesce(total, 0) AS total_votes, coalesce(people, '') AS top_three_candidates, coalesce(parties, '') AS top_three, {ratios}, {parties} FROM seats LEFT JOIN s USING (page, seat_id) LEFT JOIN t USING (page, seat_id)"""


def _same_keys() -> str:
    share = lambda n, code: f"SELECT '{code}' AS code, seat_key, n_nationkey / {n} AS ratio, true AS ratio_defined, seat_name, top_three FROM last"
    pair = "SELECT 'alpha_vs_beta', seat_key, CASE WHEN n_nationkey = 0 THEN 0.0::DOUBLE ELSE (n_nationkey / 32) / (n_nationkey / 32 + n_nationkey / 33) END, n_nationkey > 0, seat_name, top_three FROM last"
    last = "WITH last AS (SELECT max(n_nationkey)::DOUBLE AS n_nationkey, 'region ' || n_regionkey AS seat_key, arg_max('Region ' || n_regionkey || ['', '!', chr(39), '..'][n_nationkey % 4 + 1], n_nationkey) AS seat_name, arg_max(n_name || ' (x) 1.0%', n_nationkey) AS top_three FROM nation GROUP BY n_regionkey) "
    return last + " UNION ALL ".join([*[share(n, b.code) for n, b in enumerate(BLOCS[:3], 32)], pair])


_KEYWORDS = "k AS (SELECT r_name AS code, substr(party, r_regionkey + 1, r_regionkey % 4 + 1) AS keyword FROM (SELECT DISTINCT c_mktsegment AS party FROM customer) JOIN region ON length(party) % 2 = r_regionkey % 2)"
_SEAT_RESULTS = f"WITH {_VOTES}, {_SEATS}, {_TOP}, {_TEXTS}, {_SUMS}, {_BLOCS}, {_WIDE} SELECT seat_id, seat_number, seat_name, blocs.* EXCLUDE (seat_id), {{0}} AS top_three_candidates, {{1}} AS top_three, wide.* EXCLUDE (seat_id) FROM seats JOIN blocs USING (seat_id) LEFT JOIN texts USING (seat_id) JOIN wide USING (seat_id)"

ORACLE: dict[str, str] = {
    "vote_rows": f"WITH {_VOTES} SELECT seat_id, seat_name, res_pos, diid, votes, candidate_name, party FROM votes",
    "null_votes_filtered": "SELECT c_nationkey::VARCHAR AS seat_id, c_custkey AS res_pos, CASE WHEN c_custkey % 5 = 0 THEN 0 ELSE v.votes END AS votes FROM customer JOIN (SELECT o_custkey, count(*) AS votes FROM orders GROUP BY o_custkey) v ON o_custkey = c_custkey WHERE c_nationkey % 10 <> 9 AND c_custkey % 3 <> 0",
    "candidate_last_wins": "SELECT c_nationkey::VARCHAR AS seat_id, CASE WHEN c_custkey % 4 = 3 THEN 'None' ELSE (c_custkey % 4)::VARCHAR END AS diid, arg_max(c_name, c_custkey) AS candidate_name, arg_max(c_mktsegment, c_custkey) AS party FROM customer GROUP BY 1, 2",
    "party_by_seat": f"WITH {_VOTES} SELECT seat_pos, res_pos, seat_id, seat_number, seat_name, party, votes FROM votes",
    "party_totals": f"WITH {_VOTES} SELECT party, sum(votes)::BIGINT AS votes, min(seat_pos) AS first_seat, arg_min(res_pos, (seat_pos, res_pos)) AS first_result FROM votes GROUP BY party",
    "top_parties": f"WITH {_VOTES} SELECT party, sum(votes)::BIGINT AS votes, format('{{:,}}', sum(votes)::BIGINT) AS shown FROM votes GROUP BY party ORDER BY votes DESC, min((seat_pos, res_pos)) LIMIT 15",
    "distinct_parties": f"WITH {_VOTES} SELECT DISTINCT party FROM votes",
    "seat_totals": f"WITH {_VOTES}, {_SEATS} SELECT seats.seat_id, seats.seat_name, coalesce(sum(votes), 0)::BIGINT AS total_votes FROM seats LEFT JOIN votes USING (seat_id) GROUP BY 1, 2",
    "seat_party_long": f"WITH {_VOTES}, {_SEATS}, p AS (SELECT DISTINCT party FROM votes) SELECT seats.seat_id, p.party, coalesce(sum(votes.votes), 0)::BIGINT AS votes FROM seats CROSS JOIN p LEFT JOIN votes ON votes.seat_id = seats.seat_id AND votes.party = p.party GROUP BY 1, 2",
    "seat_party_wide": f"WITH {_VOTES}, {_SEATS}, {_WIDE} SELECT * FROM wide",
    "party_bloc_match": f"WITH {_VOTES}, p AS (SELECT DISTINCT party FROM votes) " + " UNION ALL ".join(f"SELECT party, '{b.code}' AS code FROM p WHERE {_in(b)}" for b in BLOCS),
    "seat_bloc_votes": f"WITH {_VOTES}, {_SEATS}, {_SUMS}, {_BLOCS} SELECT * FROM blocs",
    "seat_rank_top3": f"WITH {_VOTES}, {_TOP} SELECT * FROM top",
    "seat_top3_candidates": f"WITH {_VOTES}, {_TOP}, {_TEXTS} SELECT seat_id, top_three_candidates FROM texts",
    "seat_top3_parties": f"WITH {_VOTES}, {_TOP}, {_TEXTS} SELECT seat_id, top_three FROM texts",
    "seat_results": _SEAT_RESULTS.format("coalesce(top_three_candidates, '')", "coalesce(top_three, '')"),
    "script_payload": "SELECT page_id, list_filter(regexp_extract_all(html, '(?is)<script\\b[^>]*>(.*?)</script\\s*>', 1), lambda s: contains(s, 'track('))[1] AS script FROM pages",
    "page_guard": "SELECT page_id, length(html) AS characters FROM pages WHERE length(html) > 10000",
    "brace_slice": "SELECT page_id, regexp_extract(html, '\\{[^{}]*\\}') AS first_object, '{\"a\": {\"b\": {' || page_id || '}}, c}' AS nested_object FROM pages",
    "props_votes": "SELECT (user_id % 25)::VARCHAR AS seat_id, event_type AS party, sum((props->>'k')::BIGINT)::BIGINT AS votes, count(*) AS n FROM events WHERE (props->>'k') IS NOT NULL GROUP BY 1, 2",
    "seat_keys": f"SELECT n_nationkey, raw_name, {_KEY.format('spelt')} AS seat_key FROM (SELECT *, CASE WHEN starts_with(s, 'parbatya ') THEN substr(s, 10) || CASE WHEN contains(substr(s, 10), '-') THEN '' ELSE '-1' END ELSE s END AS spelt FROM (SELECT *, {_SPELT} AS s FROM (SELECT n_nationkey, ' ' || {_PLACES}[n_nationkey % 8 + 1] || CASE WHEN n_nationkey % 3 = 0 THEN '' ELSE (n_nationkey % 3)::VARCHAR END || ' (' || n_name || ') ' AS raw_name FROM nation)))",
    "pair_share": f"WITH {_VOTES}, {_SEATS}, {_SUMS}, {_BLOCS} SELECT seat_id, {_PAIR} AS share, {_PAIR_DEFINED} AS defined FROM blocs",
    "feature_join": _MAP + "SELECT * FROM joined",
    "feature_join_stored": _MAP + "SELECT * FROM joined",
    "fill_linear": _MAP + "SELECT feature_pos, code, CASE WHEN ratio <= 0 OR NOT ratio_defined THEN '" + NO_DATA + "' " + " ".join(f"WHEN code = '{b.code}' THEN {_mixed(*b.gradient, 'ratio', 'trunc({})', '%02X')}" for b in BLOCS) + " END AS fill FROM joined",
    "fill_palette": _MAP + f", curved AS (SELECT *, {_contrast('ratio')} AS t FROM joined) " + _palette_rows(),
    "tooltip_html": _MAP + """SELECT feature_pos, CASE WHEN NOT has_data THEN '<div class="tooltip-title">' || seat_name || '</div><div class="tooltip-empty">No data</div>'
      ELSE '<div class="tooltip-title">' || seat_name || '</div><div class="tooltip-subtitle">Top three candidates</div>' || CASE WHEN top_three = '' THEN '<div class="tooltip-empty">No candidate data</div>'
      ELSE '<ol class="tooltip-list">' || array_to_string(list_transform(string_split(top_three, ','), lambda x: '<li>' || trim(x) || '</li>'), '') || '</ol>' END END AS html FROM joined WHERE code = 'alpha'""",
    "legend": _LEGEND,
    "candidate_name": f"SELECT c_custkey, CASE WHEN c_custkey % 5 < 3 THEN trim(c_name, {_SPACE}) ELSE 'Unknown' END AS candidate_name FROM customer",
    "keyword_documents": "SELECT source, count(*) AS documents, " + ", ".join(f"count(*) FILTER (WHERE {_in(b).replace('party', 'text')}) AS {b.code}" for b in BLOCS[:3]) + " FROM documents GROUP BY source",
    "csv_round_trip": "SELECT *, seat_id::BIGINT AS place, count(*) OVER () AS written FROM (" + _SEAT_RESULTS.format("top_three_candidates", "top_three") + ")",
    "csv_round_trip_votes": f"WITH {_VOTES}, n AS (SELECT party, sum(votes)::BIGINT AS votes, min((seat_pos, res_pos)) AS first FROM votes GROUP BY party) SELECT 'party_totals' AS result, NULL::VARCHAR AS seat_id, NULL::VARCHAR AS seat_name, party, votes, row_number() OVER (ORDER BY votes DESC, first) - 1 AS place, count(*) OVER () AS written FROM n UNION ALL SELECT 'party_by_seat', seat_id, seat_name, party, votes, row_number() OVER (ORDER BY seat_pos, res_pos) - 1, count(*) OVER () FROM votes",
    "page_votes": f"WITH {_GOOD} SELECT * FROM good",
    "page_seats": f"WITH {_PAGES} SELECT * FROM seats",
    "page_results": _page_results(),
    "page_errors": f"""WITH {_PAGES} SELECT DISTINCT 'nation/' || n || '/' || block AS page, NULL::VARCHAR AS seat_id, CASE fault WHEN 3 THEN {_text(UNBALANCED)} WHEN 5 THEN {_text(NO_SCRIPT)} ELSE {_text(NOT_JSON)} END AS error FROM held WHERE fault IN (3, 5, 6)
      UNION ALL SELECT page, seat_id, {_text(BAD_VOTES)} || seat_id FROM votes WHERE votes < 0""",
    "marked_objects": "SELECT n_nationkey, '{\"a\":{\"b\":{\"k\":' || n_nationkey || ',\"n\":\"' || n_name || '\"},\"l\":[{\"c\":' || n_nationkey || '}]},\"r\":' || n_regionkey || '}' AS found FROM nation",
    "same_seat_keys": _same_keys(),
    "boundary_features": f"SELECT c_custkey // {PAGE_CUSTOMERS} AS source, row_number() OVER (PARTITION BY c_custkey // {PAGE_CUSTOMERS} ORDER BY c_custkey) - 1 AS feature_pos, CASE c_custkey % 6 WHEN 5 THEN 'None' WHEN 4 THEN '' ELSE c_name END AS raw_name, c_custkey::VARCHAR AS cst, CASE WHEN c_custkey % 6 = 4 THEN 1 ELSE 2 END::BIGINT AS n_properties, '{{\"type\":\"Point\",\"coordinates\":[' || c_custkey || ',23]}}' AS geometry FROM customer",
    "bloc_config": f"WITH {_CONFIG} SELECT * FROM config",
    "seat_code_votes": f"WITH {_VOTES}, {_KEYWORDS}, m AS (SELECT DISTINCT party, code FROM (SELECT DISTINCT party FROM votes) JOIN k ON contains(lower(party), lower(keyword))), t AS (SELECT seat_id, sum(votes)::BIGINT AS total FROM votes GROUP BY seat_id) SELECT seat_id, code, sum(votes)::BIGINT AS votes, sum(votes)::BIGINT / any_value(total) AS ratio FROM votes JOIN m USING (party) JOIN t USING (seat_id) GROUP BY seat_id, code",
    "keyword_table_documents": "WITH k AS (SELECT DISTINCT code, lower(w[i] || ' ' || w[i + 1]) AS keyword FROM (SELECT item_id AS code, w, unnest(range(1, len(w))) AS i FROM (SELECT item_id, string_split(text, ' ') AS w FROM benchmark))), d AS (SELECT doc_id, lower(text) AS text FROM documents), h AS (SELECT DISTINCT keyword, doc_id FROM (SELECT DISTINCT keyword FROM k) JOIN d ON contains(text, keyword)) SELECT code, count(DISTINCT doc_id) AS documents FROM h JOIN k USING (keyword) GROUP BY code",
}
