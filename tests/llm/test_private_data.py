import hashlib
import random
import re
from itertools import combinations

import numpy as np

from pyspark.sql import functions as F

from seatloom.llm import private_data

PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": "[0-9]([\x20-]?[0-9])+",
    "phone": "\\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(d):
    return sum(x if i % 2 == 0 else (2 * x - 9 if x > 4 else 2 * x) for i, x in enumerate(map(int, reversed(d)))) % 10 == 0


def brute(text):
    out = []
    for kind, p in PATTERNS.items():
        for m in re.finditer(p, text or ""):
            digits = re.sub("[^0-9]", "", m.group())
            ok = {"email": lambda: True, "ip": lambda: all(int(x) <= 255 for x in m.group().split(".")), "card": lambda: 16 <= len(digits) <= 19 and luhn(digits), "phone": lambda: 8 <= len(digits) <= 15}[kind]()  # noqa: B023
            if ok:
                out.append((kind, m.start(), m.end()))
    return out


def check(spark, texts):
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").withColumn("spans", F.lit("clash")).withColumn("base", F.lit(1))
    rows = private_data.private_spans(docs).collect()
    assert len(rows) == len(texts)
    for r in rows:
        want = brute(texts[r.doc_id])
        shown = ",".join(f"{k}:{a}:{b}" for k, a, b in want)
        assert r.base_sha256 == hashlib.sha256(shown.encode()).hexdigest(), (texts[r.doc_id], r.spans, shown)
        assert (r.n_email, r.n_ip, r.n_card, r.n_phone) == tuple(sum(k == x[0] for x in want) for k in PATTERNS)
        assert r.spans.startswith(shown) and r.spans.count(":") == 2 * (len(want) + r.n_added)
    return {r.doc_id: r for r in rows}


def test_base_spans(spark):
    r = random.Random(9)
    texts = [None, "", "a@b.c.d@e.f_g@h.i", "1.2.3.4.5.6.7.8.9.10.11.12", "300.1.1.1 0255.001.0.00 1.2.3", "a@b@c.d ..@x.y é@ü.z a@b.", "4111 1111 1111 1111", "4111-1111-1111-1111-1", "+1 (017) 555-7713.", "++1-2-3-4-5-6-7-8-9 +1 2", "x" * 3000 + "@" + "y." * 3000, "1." * 5000, "5 " * 4000, "日本 a@b.co 😀 +49 (30) 123456"]
    alphabet = ["@", ".", "-", " ", "+", "(", ")", "1", "2", "55", "255", "256", "a", "b_", "%", "é", "😀", "\n", "4111111111111111", "0"]
    texts += ["".join(r.choice(alphabet) for _ in range(r.randrange(1, 40))) for _ in range(1500)]
    check(spark, texts)


def test_added_spans(spark):
    r = random.Random(2)
    word = lambda: "".join(r.choice("abcdefghij") for _ in range(r.randrange(3, 9)))
    hexa = lambda: "".join(r.choice("0123456789abcdef") for _ in range(40))
    texts = []
    for i in range(120):
        parts = [word() for _ in range(20)]
        if i % 3 == 0:
            parts.insert(7, f'token = "{hexa()}"')
        if i % 3 == 1:
            parts.insert(5, "".join(word() for _ in range(7)) + "abcdefghij")
        texts.append(" ".join(parts))
    rows = check(spark, texts)
    assert all(rows[i].n_added == (1 if i % 3 == 0 else 0) for i in range(120)), [(i, rows[i].spans) for i in range(120)]
    span = rows[0].spans.split(":")
    assert span[0] == "secret" and re.fullmatch("[0-9a-f]{40}", texts[0][int(span[1]) : int(span[2])])


def iban(r):
    bban = "".join(r.choice("0123456789") for _ in range(18))
    check = 98 - int(bban + "131400") % 97
    return f"DE{check:02d}{bban}"


def planted(r):
    """kind, text before, value, text after: spans that are personal data, and decoys (kind None)."""
    number = lambda n: "".join(r.choice("123456789") for _ in range(n))
    word = lambda: "".join(r.choice("abcdefghij") for _ in range(r.randrange(3, 9)))
    group = lambda: f"{r.randrange(100, 660)}-{r.randrange(10, 99)}-{r.randrange(1000, 9999)}"
    given, family = r.choice(private_data.GIVEN), r.choice(private_data.FAMILY)
    return [
        ("ssn", "SSN ", group(), ""), ("ssn", "my social security number is ", group(), ", thanks"), (None, "part ", group(), " fits"), (None, "call lot ", group(), ""),
        ("iban", "IBAN: ", iban(r), ""), ("iban", "pay to bank ", iban(r), " today"), (None, "model ", "AB12" + number(16), " in stock"), (None, "ref ", "XY99" + number(12), ""),
        ("account", "account number ", number(10), ""), ("account", "the account that I opened in the long and rainy spring of that year is ", number(11), ""), (None, "about ", number(10), " items"), (None, "build ", number(14), ""),
        ("handle", "follow me on twitter ", f"@{word()}_{number(2)}", ""), ("handle", "instagram: ", f"@{word()}", ""), (None, "", "@Override", " public void run"), (None, "the ", "@media", " rule"),
        ("name", "met ", f"Mr. {given} {family}", " there"), ("name", "", f"{given} {family}", " said so"), (None, "asked ", "Mr. President", " again"), (None, "at ", f"{given} Park", " on foot"),
        ("password", "", f'{word()}{number(3)}', '"'), (None, "", "required", ""), ("secret", 'api key = "', "".join(r.choice("0123456789abcdef") for _ in range(40)), '"'), (None, "see ", "".join(word() for _ in range(9)) + "abcdefghij", ""),
    ]


def test_planted_with_decoys(spark):
    r = random.Random(17)
    word = lambda: "".join(r.choice("klmnopqrst") for _ in range(r.randrange(3, 9)))
    texts, want = [" ".join(word() for _ in range(30)) for _ in range(300)], {}
    for _ in range(25):
        for n, (kind, before, value, after) in enumerate(planted(r)):
            if n in (20, 21):  # the cue stands in the pattern
                before = 'password: "' if n == 20 else "password: "
            head = " ".join(word() for _ in range(12)) + ". " + before
            want[len(texts)] = (kind, len(head), len(head) + len(value))
            texts.append(head + value + after + " " + word())
    rows = check(spark, texts)
    kinds = ["ssn", "iban", "account", "handle", "name", "password", "secret"]
    got = {i: [x.split(":") for x in r.spans.split(",") if x and x.split(":")[0] in kinds] for i, r in rows.items()}
    for kind in kinds:
        hits = sum(k == kind and [kind, str(a), str(b)] in got[i] for i, (k, a, b) in want.items())
        false = sum(x[0] == kind and (i not in want or want[i][0] != kind) for i, found in got.items() for x in found)
        asked = sum(k == kind for k, _, _ in want.values())
        assert hits >= 0.9 * asked and false <= 0.1 * hits, (kind, hits, asked, false)


def test_one_of_each_among_many(spark):
    """Single spans, beside many texts without any."""
    plants = ["my SSN 123-45-6789 is it", "IBAN: DE89370400440532013000", "account number 9876543210", "follow me on twitter @jane_doe", 'password: "hunter2xyz"', "Mr. John Smith", "key sk_live4f9a8b7c6d5e4f3a2b1c0d9e"]
    kinds = ["ssn", "iban", "account", "handle", "password", "name", "secret"]
    rows = check(spark, plants + ["some words stand here and nothing else"] * 500)
    assert [rows[i].spans.split(":")[0] for i in range(len(plants))] == kinds
    assert all(rows[i].n_added == 0 for i in range(len(plants), len(plants) + 500))


def test_estimates_and_weights_by_numpy(spark):
    r = random.Random(5)
    texts = [before + value + after for _ in range(12) for kind, before, value, after in planted(r)] + ['password: "abc12345"', "password: none"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    spans = private_data.spans_of(docs)
    c = F.col("c")
    rows = spans.select(F.explode("candidates").alias("c")).select(c["kind"].alias("kind"), F.array(*private_data.votes(c)).alias("v"), private_data.features(c).alias("f")).collect()
    weights = private_data.train(spans)
    assert {private_data.KINDS[x.kind] for x in rows} == set(private_data.MORE)
    counts = spark.createDataFrame([(x.kind, x.v, 1) for x in rows], "kind int, v array<int>, n long").groupBy("kind", "v").agg(F.sum("n").alias("n"))
    theta = {x.kind: x.theta for x in private_data.estimate(counts).collect()}
    s = private_data.SMOOTH
    for kind in theta:
        mine = [x for x in rows if x.kind == kind]
        votes = np.array([x.v for x in mine])
        w = max(private_data.LEAST, len(mine))
        alike = (votes == votes[0]).all(0)
        belief = np.array(private_data.BELIEFS)
        first = private_data.PRIORS[private_data.KINDS[kind]]
        prior, told = first, belief

        def posterior(prior, told, votes=votes):
            gain = np.where(votes == 1, np.log(told[:, 0] / told[:, 1]), np.where(votes == 0, np.log((1 - told[:, 0]) / (1 - told[:, 1])), 0))
            return 1 / (1 + np.exp(-(np.log(prior / (1 - prior)) + gain.sum(1))))

        for _ in range(private_data.ROUNDS):
            p = posterior(prior, told)
            both = np.stack([p, 1 - p], 1)
            prior = (p.sum() + w * first) / (len(mine) + w)
            told = np.where(alike[:, None], belief, ((votes == 1).T @ both + w * belief) / ((votes >= 0).T @ both + w))
        assert np.allclose(theta[kind], [prior, *told.ravel()], atol=1e-9)
        p = posterior(prior, told)
        rate = (p.sum() + s) / (len(p) + 2 * s)
        assert np.isclose(weights[(kind + 1) * private_data.SLOTS - 1], np.log(rate / (1 - rate)))
        for f in {f for x in mine for f in x.f}:
            has = np.array([f in x.f for x in mine])
            assert np.isclose(weights[f], np.log((p[has].sum() + s * rate) / ((1 - p)[has].sum() + s * (1 - rate))) - np.log(rate / (1 - rate)), atol=1e-9)


def test_disjoint(spark):
    r = random.Random(3)
    cases = [sorted((a, a + r.randrange(1, 9), r.randrange(4, 11), float(r.randrange(1, 4))) for a in (r.randrange(40) for _ in range(r.randrange(9)))) for _ in range(200)]
    table = spark.createDataFrame([(i, x) for i, x in enumerate(cases)], "i int, x array<struct<start:int,end:int,kind:int,odds:double>>")
    for row in table.select("i", private_data.disjoint(F.col("x")).alias("kept")).collect():
        kept = []
        for x in cases[row.i]:
            if not kept or kept[-1][1] <= x[0]:
                kept.append(x)
            elif x[3] > kept[-1][3]:
                kept[-1] = x
        assert [tuple(k) for k in row.kept] == sorted((k, a, b) for a, b, k, _ in kept)
        assert all(a[2] <= b[1] or b[2] <= a[1] for a, b in combinations(row.kept, 2))


def test_gazetteer_is_a_parameter(spark):
    docs = spark.createDataFrame([(1, "then Zorblax Smith came"), (2, "then John Smith came")], "doc_id long, text string")
    found = lambda **k: {r.doc_id: r.spans for r in private_data.private_spans(docs, **k).collect()}
    assert found() == {1: "", 2: "name:5:15"} and found(given=["Zorblax"]) == {1: "name:5:18", 2: ""}
    assert found(given=[]) == {1: "", 2: ""}


def test_plan_is_native(spark):
    docs = spark.createDataFrame([(1, 'key = "0123456789abcdef0123456789abcdef" x@y.zz')], "doc_id long, text string")
    plan = private_data.spans_of(docs)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
    assert private_data.private_spans(docs.limit(0)).count() == 0
