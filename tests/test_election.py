"""Pages of random elections against the plain statement; every branch of extraction."""

import json
import random

import pytest
from pyspark.sql import functions as F

from seatloom.operators import extract, results
from seatloom.sources.blocs import parse_blocs
from tests import plain

CONFIG = json.dumps({
    "one": {"display_name": "One", "keywords": ["Front", "ALLIANCE"], "color_scale": ["#FFFFCC", "#0060C9"]},
    "two": {"display_name": "Two", "keywords": ["front", "Party of"], "color_scale": ["#FFFFCC"]},
    "none": {"display_name": "None", "keywords": []},
    "missing": {"display_name": "Missing"},
    "pair": {"display_name": "One against Two", "derived": ["one", "two"]},
})
BLOCS = parse_blocs(CONFIG)


def page(document, before="", after=";"):
    text = document if isinstance(document, str) else json.dumps(document, ensure_ascii=False)
    return f'<html><script>var x="</p>";</script>{before}<script type="a">window.d = {{"k": 1, "election2026" : {text}}}{after}</script><script>"election2026": {{"z": 1}}</script></html>'


def run(spark, html):
    spark.conf.set("spark.sql.caseSensitive", "true")
    return extract.election(spark.createDataFrame([("u", html)], "url string, html string"))


def random_election(r):
    parties = ["Front A", "Alliance of B", "Party of C", "Independent", "", None, "total_votes", "A.B", "bnp", "BNP", "with, comma", "tick`s", "one_votes"]
    seats, people = {}, {}
    for s in r.sample(range(100), r.randrange(1, 12)):
        ids = r.sample(range(60), r.randrange(0, 9))
        found = {str(i): r.choice([{"votes": r.choice([0, 1, 5, 5, 5, 80, 1234])}, {"votes": None}, {}, {"votes": 5, "other": "x"}]) for i in ids}
        seats[str(s)] = {"seat_number": s, "seat_name": r.choice([f"Seat {s}", None, "Ünï-1"]), "election_results": r.choice([found, found, found, []])}
        if r.random() < 0.1:
            del seats[str(s)]["election_results"]
        listed = [{"diid": r.choice([i, str(i)]), "party": r.choice(parties), r.choice(["candidate_name", "name", "full_name", "candidateName", "candidate"]): r.choice(["Ann", "  Bo ", "", None, " ", "Çé"])} for i in ids if r.random() < 0.85]
        listed += [dict(r.choice(listed), party="Last one") for _ in range(r.randrange(2)) if listed] + [{"party": "no id"}]
        if r.random() < 0.9:
            people[str(s)] = listed
    return {"constituencies": seats, "candidates": people, "unused": [1, {"a": {}}]}


def as_text(row):
    return {k: str(v) if k == "seat_number" and v is not None else v for k, v in row.items()}


@pytest.mark.parametrize("seed", range(6))
def test_random_elections(spark, seed):
    document = random_election(random.Random(seed))
    seats, votes = (x.cache() for x in run(spark, page(document, after="; trailing } text")))
    want_seats, want_parties, want_long = plain.election(document, BLOCS)
    table = results.seat_results(seats, votes, BLOCS)
    got = [r.asDict() for r in table.collect()]
    # a party named like a fixed column overwrites it, as a later key does in the plain rows
    assert [as_text(w) for w in want_seats] == [as_text(g) for g in got]
    assert list(want_seats[0]) == table.columns
    assert [(r.party, r.votes) for r in results.ranked_parties(votes).collect()] == want_parties
    rows = results.party_by_seat(votes).orderBy("seat_pos", "res_pos").collect()
    assert [(r.seat_id, r.seat_number, r.seat_name, r.party, r.votes) for r in rows] == want_long


def test_repeated_keys_keep_first_place_and_last_value(spark):
    text = '{"constituencies": {"9": {"seat_name": "x", "election_results": {"9": {"votes": 1}, "10": {"votes": 4}, "9": {"votes": 4}}}, "2": {"seat_name": "y"}}, "candidates": {"9": []}}'
    seats, votes = run(spark, page(text))
    assert [(r.seat_id, r.seat_pos) for r in seats.orderBy("seat_pos").collect()] == [("9", 0), ("2", 1)]
    top = results.seat_top(votes).orderBy("rank").collect()
    assert [(r.votes, r.candidate_name, r.party) for r in top] == [(4, "Unknown", "UNKNOWN")] * 2
    assert [r.diid for r in votes.orderBy("res_pos").collect()] == ["9", "10"]


def test_braces_in_strings_count(spark):
    with pytest.raises(Exception, match="(?i)json|parse|malformed"):
        run(spark, page('{"constituencies": {}, "note": "}", "candidates": {}}'))[1].collect()


@pytest.mark.parametrize("html", ["<html><script>nothing</script></html>", page("{")[:90] + "</script>"])
def test_pages_without_data_fail(spark, html):
    with pytest.raises(Exception, match="script|balance"):
        run(spark, html)[1].collect()


@pytest.mark.parametrize("votes", ['"12"', "1.5"])
def test_votes_must_be_whole_numbers(spark, votes):
    text = f'{{"constituencies": {{"1": {{"election_results": {{"5": {{"votes": {votes}}}}}}}}}, "candidates": {{}}}}'
    with pytest.raises(Exception, match="whole number"):
        run(spark, page(text))[1].collect()


def test_balanced_object_on_random_strings(spark):
    r = random.Random(3)
    texts = ["{" + "".join(r.choice("{}ab") for _ in range(r.randrange(12))) for _ in range(800)]

    def want(s):
        depth = 0
        for i, c in enumerate(s):
            depth += (c == "{") - (c == "}")
            if depth == 0:
                return s[: i + 1]
        return None

    rows = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string").orderBy("i").select(extract.balanced_object(F.col("t"))).collect()
    assert [x[0] for x in rows] == [want(t) for t in texts]


def test_rounding_and_bloc_overlap(spark):
    document = {"constituencies": {"1": {"election_results": {"1": {"votes": 1}, "2": {"votes": 15}}}}, "candidates": {"1": [{"diid": 1, "party": "Front Alliance"}, {"diid": 2, "party": "x"}]}}
    seats, votes = run(spark, page(document))
    row = results.seat_results(seats, votes, BLOCS).first()
    assert row.top_three == "x (93.8%), Front Alliance (6.2%)" and row.one_ratio == row.two_ratio == 1 / 16
    assert row.none_votes == row.missing_votes == 0
    assert sorted((r.party, r.code) for r in results.party_blocs(votes, BLOCS).collect()) == [("Front Alliance", "one"), ("Front Alliance", "two")]


def test_many_pages_and_what_is_wrong_with_them(spark):
    """Pages with the same seat ids: each gives what it gives alone; those that can't be read are told, the others go on."""
    made = {f"p{i}": random_election(random.Random(100 + i)) for i in range(4)}
    bad = {"cut": page("{")[:90] + "</script>", "none": "<html><script>nothing</script></html>", "text": page('{"constituencies": {,}}'), "shape": page('{"constituencies": [1], "candidates": {}}'), "null": None}
    odd = '{"constituencies": {"7": {"seat_name": "n", "election_results": {"1": {"votes": 3}, "2": {"votes": "12"}, "3": {"votes": 1.5}}}}, "candidates": {}}'
    table = [*[(u, page(d)) for u, d in made.items()], *bad.items(), ("odd", page(odd))]
    seats, votes, errors = (x.cache() for x in extract.elections(spark.createDataFrame(table, "url string, html string").repartition(4)))
    whole = results.seat_results(seats, votes, BLOCS).collect()
    for url, document in made.items():
        want, _, long = plain.election(document, BLOCS)
        # parties named like a fixed column take its place in the whole table, on whichever page they are
        shown = [k for k in want[0] if k not in ("total_votes", "one_votes")]
        assert [as_text({k: r[k] for k in shown}) for r in whole if r.page == url] == [as_text({k: w[k] for k in shown}) for w in want]
        rows = results.party_by_seat(votes).where(F.col("page") == url).orderBy("seat_pos", "res_pos").collect()
        assert [(r.seat_id, r.seat_number, r.seat_name, r.party, r.votes) for r in rows] == long
    told = sorted((r.page, r.seat_id, r.error) for r in errors.collect() if r.page is not None)
    assert told == sorted([("cut", None, extract.UNBALANCED), ("none", None, extract.NO_SCRIPT), ("null", None, extract.NO_SCRIPT), ("odd", "7", extract.BAD_VOTES + "7"), ("odd", "7", extract.BAD_VOTES + "7"), ("shape", None, extract.NOT_JSON), ("text", None, extract.NOT_JSON)], key=lambda x: (x[0], x[1] or "", x[2]))
    assert [(r.votes, r.page) for r in votes.where("page = 'odd'").collect()] == [(3, "odd")]
    long = {(r.page, r.seat_id, r.party): r.votes for r in results.seat_party(seats, votes).collect()}
    assert len(long) == seats.count() * votes.select("party").distinct().count() and sum(long.values()) == votes.agg(F.sum("votes")).first()[0]
    assert extract.elections(spark.createDataFrame([], "url string, html string"))[2].count() == 0
