"""Keywords as a table, against every text and keyword."""

import random

from seatloom.operators import keywords, results
from seatloom.sources.blocs import Bloc


def brute(texts, table):
    return sorted({(i, c) for i, t in texts if t for c, k in table if k is not None and k.lower() in t.lower()}, key=repr)


def test_random_keywords(spark):
    r = random.Random(7)
    word = lambda n: "".join(r.choice("abÉçA. 𝔘") for _ in range(n))
    texts = [(i % 150 if i % 10 else None, r.choice([None, "", word(r.randrange(1, 40)), word(3)])) for i in range(300)]
    table = [(f"c{r.randrange(30)}", word(r.randrange(1, 7))) for _ in range(200)] + [("empty", ""), ("none", None), ("all", "a"), ("never", "zzz"), ("same", texts[7][1] or "b")]
    got = keywords.text_codes(spark.createDataFrame(texts, "id int, text string"), spark.createDataFrame(table, "code string, keyword string"))
    assert sorted(map(tuple, got.collect()), key=repr) == brute(texts, table)
    for some in (table[-5:-4], table[-4:-3], []):
        got = keywords.text_codes(spark.createDataFrame(texts, "id int, text string"), spark.createDataFrame(some, "code string, keyword string"))
        assert sorted(map(tuple, got.collect()), key=repr) == brute(texts, some)


def test_many_keywords_without_nested_loops(spark):
    """Ten thousand keywords: the plan has neither a nested loop nor any of them, and no Python."""
    r = random.Random(1)
    texts = [(i, " ".join(f"w{r.randrange(4000)}" for _ in range(60))) for i in range(400)]
    table = [(f"c{i % 50}", f"w{i}") for i in range(10_000)]
    got = keywords.text_codes(spark.createDataFrame(texts, "id int, text string"), spark.createDataFrame(table, "code string, keyword string"))
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan and "Python" not in plan and "w9999" not in plan
    assert sorted(map(tuple, got.collect()), key=repr) == brute(texts, table)


def test_as_bloc_conditions_say(spark):
    blocs = [Bloc("one", "One", ("front", "alliance")), Bloc("two", "Two", ("FRONT", "x")), Bloc("none", "None", ())]
    votes = spark.createDataFrame([(str(i % 3), p, i) for i, p in enumerate(["Front A", "Alliance of B", "x", "", "Independent", "front alliance"] * 3)], "seat_id string, party string, votes long")
    got = {(r.seat_id, r.code): (r.votes, r.ratio) for r in keywords.seat_code_votes(votes, keywords.keyword_table(spark, blocs)).collect()}
    want = {}
    lowered = [Bloc(b.code, b.display_name, tuple(k.lower() for k in b.keywords)) for b in blocs]
    for r in results.seat_blocs(votes.select("seat_id").distinct(), votes, lowered).collect():
        for b in blocs:
            if r[f"{b.code}_votes"]:
                want[r.seat_id, b.code] = (r[f"{b.code}_votes"], r[f"{b.code}_ratio"])
    assert got == want


def test_texts_meet_only_keywords_beside_their_blanks(spark, monkeypatch):
    """Keywords of one blank or more: no three-character piece of a text is made, pairs of words that hold no keyword's blank
    bring nothing to verify, and texts of one task are searched by several."""
    monkeypatch.setattr(keywords, "_piece_hits", None)
    r = random.Random(4)
    word = lambda: "".join(r.choice("abcd") for _ in range(r.randrange(6)))
    texts = [(i % 90 if i % 9 else None, r.choice(["", " "]) + " ".join(word() for _ in range(r.randrange(30)))) for i in range(200)]
    table = [(f"c{i % 20}", " ".join(word() for _ in range(r.choice([2, 2, 3, 4])))) for i in range(150)] + [("blank", " "), ("blanks", "  "), ("ends", "ab "), ("begins", " ab")]
    rows = spark.createDataFrame(texts, "id int, text string").coalesce(1)
    for some in (table, [x for x in table if x[1].count(" ") == 1]):
        got = keywords.text_codes(rows, spark.createDataFrame(some, "code string, keyword string"))
        assert sorted(map(tuple, got.collect()), key=repr) == brute(texts, some)
        assert "hashpartitioning(id#" in got._jdf.queryExecution().executedPlan().toString()
