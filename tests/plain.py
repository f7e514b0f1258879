"""What the vote analytics should give, stated over tables in SQL, for differential tests."""

import duckdb
import pandas as pd

#: The names of a candidate by the order in which the first filled one counts.
NAMED = ["candidate_name", "name", "candidate", "full_name", "candidateName"]


def mixed(a, b, t, whole, form):
    t = max(0.0, min(1.0, t))
    return "#" + "".join(form % int(whole(int(a[i : i + 2], 16) + (int(b[i : i + 2], 16) - int(a[i : i + 2], 16)) * t)) for i in (1, 3, 5))


def _frame(rows, **columns):
    kinds = {str: "string", int: "Int64"}
    return pd.DataFrame(rows, columns=list(columns)).astype({c: kinds[k] for c, k in columns.items()})


def tables(document):
    """The document as three flat tables: seats, results, candidates."""
    seats = [(i, k, str(s["seat_number"]), s["seat_name"]) for i, (k, s) in enumerate(document["constituencies"].items())]
    found = {k: s.get("election_results") for k, s in document["constituencies"].items()}
    results = [(k, i, diid, r.get("votes")) for k, f in found.items() if isinstance(f, dict) for i, (diid, r) in enumerate(f.items())]
    people = [(k, i, str(c.get("diid")), c.get("party"), *[c.get(n) for n in NAMED]) for k, cs in document["candidates"].items() for i, c in enumerate(cs)]
    return (
        _frame(seats, seat_pos=int, seat_id=str, seat_number=str, seat_name=str),
        _frame(results, seat_id=str, res_pos=int, diid=str, votes=int),
        _frame(people, seat_id=str, place=int, diid=str, party=str, **dict.fromkeys(NAMED, str)),
    )


LONG = f"""CREATE VIEW long AS
SELECT s.*, res_pos, votes, coalesce(nullif(p.party, ''), 'UNKNOWN') AS party, coalesce(p.shown, 'Unknown') AS shown
FROM seats s JOIN results r USING (seat_id)
LEFT JOIN (SELECT *, trim(coalesce({", ".join(f"nullif({n}, '')" for n in NAMED)}, 'Unknown')) AS shown FROM people QUALIFY row_number() OVER (PARTITION BY seat_id, diid ORDER BY place DESC) = 1) p ON p.seat_id = r.seat_id AND p.diid = r.diid
WHERE votes IS NOT NULL"""

SEATS = """SELECT seats.seat_id, seats.seat_number, seats.seat_name, coalesce(sum(votes), 0)::BIGINT AS total_votes,
  coalesce(string_agg(shown || ' (' || party || ') ' || share || '%', ', ' ORDER BY rank) FILTER (WHERE rank <= 3 AND total > 0), '') AS top_three_candidates,
  coalesce(string_agg(party || ' (' || share || '%)', ', ' ORDER BY rank) FILTER (WHERE rank <= 3 AND total > 0), '') AS top_three {blocs}
FROM seats LEFT JOIN (SELECT *, row_number() OVER (PARTITION BY seat_id ORDER BY votes DESC, res_pos) AS rank, sum(votes) OVER (PARTITION BY seat_id) AS total,
  printf('%.1f', votes / nullif(total, 0) * 100) AS share FROM long) l USING (seat_id)
GROUP BY ALL ORDER BY min(seats.seat_pos)"""


def election(document, blocs):
    """(seat rows as dictionaries, (party, votes) by rank, long rows) of a document."""
    con = duckdb.connect()
    for name, frame in zip(("seats", "results", "people"), tables(document), strict=True):
        con.register(name, frame)
    con.execute(LONG)
    con.execute("CREATE TABLE words (code VARCHAR, word VARCHAR)")
    con.executemany("INSERT INTO words VALUES (?, ?)", [("", ""), *[(b.code, k) for b in blocs for k in b.keywords]])
    inside = "coalesce(sum(votes) FILTER (WHERE EXISTS (SELECT 1 FROM words WHERE code = '{0}' AND contains(lower(party), word))), 0)::BIGINT"
    columns = "".join(f", {inside.format(b.code)} AS \"{b.code}_votes\", coalesce({inside.format(b.code)} / nullif(sum(votes), 0), 0.0)::DOUBLE AS \"{b.code}_ratio\"" for b in blocs)
    got = con.execute(SEATS.format(blocs=columns))
    names = [d[0] for d in got.description]
    seats = [dict(zip(names, row, strict=True)) for row in got.fetchall()]
    by_party = con.execute("SELECT party, seat_id, sum(votes)::BIGINT FROM long GROUP BY ALL").fetchall()
    for party in sorted({p for p, _, _ in by_party}):
        own = {s: v for p, s, v in by_party if p == party}
        for row in seats:
            row[party] = own.get(row["seat_id"], 0)  # one named like a fixed column takes its place
    nation = con.execute("SELECT party, sum(votes)::BIGINT FROM long GROUP BY party ORDER BY 2 DESC, min((seat_pos, res_pos))").fetchall()
    long = con.execute("SELECT seat_id, seat_number, seat_name, party, votes FROM long ORDER BY seat_pos, res_pos").fetchall()
    return seats, nation, long
