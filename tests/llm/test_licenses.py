import random
import re

from pyspark.sql import functions as F

from seatloom.llm import licenses


def brute(text):
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", lower)
    places = [(i, label) for phrase, label in licenses.BASE.items() for i in range(len(words)) if words[i : i + len(phrase.split())] == phrase.split()]
    return len(words), len(places), min((p[0] for p in places), default=None), max((p[0] for p in places), default=None), ",".join(sorted({p[1] for p in places}))


def test_base_places(spark):
    r = random.Random(1)
    vocabulary = ["cc", "by", "CC", "BY-NC", "all", "Rights", "reserved.", "general", "PUBLIC", "license", "éa", "x1", "\n", "--", "gnu", "日本"]
    texts = [None, "", "...", "cc", "cc by", "CC BY-CC by", "generalpublic license"] + [" ".join(r.choice(vocabulary) for _ in range(r.randrange(60))) for _ in range(300)] + ["all rights reserved " * 20000]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").withColumn("labels", F.lit("clash"))
    rows = licenses.scan_licenses(docs).collect()
    assert len(rows) == len(texts)
    for row in rows:
        assert (row.n_words, row.n_base, row.first_word, row.last_word, row.base_labels) == brute(texts[row.doc_id])
        assert set(filter(None, row.base_labels.split(","))) <= set(filter(None, row.labels.split(",")))
        assert 0 <= row.score <= 1 and (row.score > 0) == bool(row.labels)
    assert licenses.scan_licenses(docs.limit(0)).count() == 0


def test_every_phrase_by_plain_search(spark):
    """Labels and places of all phrases, by looking for each one at every word."""
    r = random.Random(4)
    phrases = licenses.BASE | licenses.NOTICES
    texts = []
    for _ in range(200):
        parts = [r.choice(list(phrases)) if r.random() < 0.4 else r.choice(["license", "public", "general", "the", "cc", "by", "version 2", "apache", "mit"]) for _ in range(r.randrange(25))]
        texts.append(r.choice([" ", ", ", "-"]).join(p.title() if r.random() < 0.3 else p for p in parts))
    rows = licenses.scan_licenses(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()
    for row in rows:
        words = re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", texts[row.doc_id].lower())
        want = sorted((label, i, i + len(p.split())) for table in (licenses.BASE, licenses.NOTICES) for p, label in table.items() for i in range(len(words)) if words[i : i + len(p.split())] == p.split())
        assert sorted((x.label, x.start, x.end) for x in row.places) == want
        assert row.labels == ",".join(sorted({x[0] for x in want}))
        doubt = 1.0
        for label in {x[0] for x in want}:
            doubt *= 0.5 ** (max(e - s for name, s, e in want if name == label) / 2)
        assert abs(row.score - (1 - doubt)) < 1e-9


NAMES = ["MIT", "Apache-2.0", "GPL-2.0-only", "GPL-3.0+", "LGPL-2.1-or-later", "Zlib", "CC-BY-4.0", "LicenseRef-own", "Nonsense-9"]


def tree(r, depth):
    """A random expression: (text, whether it can be met permissively, labels, in brackets, binding of its top)."""
    if depth == 0 or r.random() < 0.3:
        name = r.choice(NAMES)
        label = {"LicenseRef-own": "licenseref", "Nonsense-9": "unlisted"}.get(name, name.lower())
        ok = name in ("MIT", "Apache-2.0", "Zlib", "CC-BY-4.0")
        if r.random() < 0.2:
            listed = r.random() < 0.7
            extra = "Classpath-exception-2.0" if listed else "odd-exception"
            labels = {f"{label}-with-classpath-exception-2.0"} if listed else {label, "unlisted"}
            return f"{name} WITH {extra}", ok, labels, f"{name.lower()} with {extra.lower()}", 3
        return name, ok, {label}, name.lower(), 4
    op, binds = r.choice([("AND", 2), ("OR", 1)])
    a, b = tree(r, depth - 1), tree(r, depth - 1)
    # on the right an equal operator needs brackets as well, since chains group to the left
    left = f"({a[0]})" if a[4] < binds or r.random() < 0.2 else a[0]
    right = f"({b[0]})" if b[4] <= binds or r.random() < 0.2 else b[0]
    return f"{left} {op} {right}", (a[1] and b[1]) if op == "AND" else (a[1] or b[1]), a[2] | b[2], f"({a[3]} {op.lower()} {b[3]})", binds


def test_expressions_by_construction():
    r = random.Random(9)
    for _ in range(3000):
        text, ok, labels, shown, _ = tree(r, r.randrange(5))
        tail = r.choice(["", " */", " -->", ", see LICENSE", " and some prose", " or later", "  licence text"])
        got = licenses.evaluate(licenses.parse(text + tail))
        assert got[:3] == (labels, ok, shown), text + tail


def test_expressions():
    shown = lambda line: licenses.evaluate(licenses.parse(line))[2]
    assert shown("MIT OR Apache-2.0 AND Zlib") == "(mit or (apache-2.0 and zlib))"
    assert shown("(MIT OR Apache-2.0) AND GPL-2.0-only WITH Classpath-exception-2.0 */") == "((mit or apache-2.0) and gpl-2.0-only with classpath-exception-2.0)"
    assert shown("MIT and then some text") == "mit" and shown("MIT license") == "mit" and shown("GPL-2.0 or later") == "gpl-2.0-or-later"
    assert shown("MIT OR") == "mit" and shown("(MIT OR Zlib") == "" and shown(") MIT") == "" and shown("") == ""
    assert licenses.evaluate(licenses.parse("MIT AND GPL-3.0-only"))[1] is False
    assert licenses.evaluate(licenses.parse("MIT OR GPL-3.0-only"))[1] is True
    assert licenses.evaluate(licenses.parse("MIT OR whatever"))[3] == {"whatever"}
    assert all(map(licenses.listed, ["mit", "gpl-2.0", "gpl-2.0+", "lgpl-2.1-or-later", "apache-2.0+"])) and not any(map(licenses.listed, ["gpl", "gpl-9.0", "gpl-2.0-only+", "later", "then", ""]))


def test_tags():
    found = licenses.scan("# SPDX-License-Identifier: MIT OR GPL-2.0-only\n code under CC BY-SA 4.0")
    assert found["labels"] == "cc-by,cc-by-sa,gpl-2.0-only,mit" and found["allowed"] and found["base_labels"] == "cc-by"
    assert licenses.scan("SPDX-License-Identifier: ???")["labels"] == "identifier"
    assert licenses.scan("SPDX-License-Identifier: Whatever AND MIT")["labels"] == "mit,unlisted"
    assert licenses.scan("SPDX-License-Identifier: MIT and then some text")["labels"] == "mit"
    assert licenses.scan("released under the mit license")["labels"] == "mit"


def test_lower_case_operators_and_later_versions(spark):
    shown = lambda line, more=frozenset(): licenses.evaluate(licenses.parse(line, more), more=more)[2]
    assert shown("mit or apache-2.0") == "(mit or apache-2.0)" and shown("mit and (zlib or isc), see below") == "(mit and (zlib or isc))"
    assert shown("gpl-2.0 with classpath-exception-2.0 and mit") == "(gpl-2.0 with classpath-exception-2.0 and mit)"
    assert shown("mit and more") == "mit" and shown("mit with care") == "mit" and shown("mit or") == "mit" and shown("or mit") == "or"
    assert shown("mit or own-1.0") == "mit" and shown("mit or own-1.0", frozenset(["own-1.0"])) == "(mit or own-1.0)"
    assert shown("GPL-3.0 or any later version OR MIT") == "(gpl-3.0-or-later or mit)" and shown("(LGPL-2.1 OR later) and MIT") == "(lgpl-2.1-or-later and mit)"
    assert shown("GPL-2.0 or later-ish") == "gpl-2.0" and shown("GPL-2.0-only or later") == "gpl-2.0-only" and shown("MIT or later") == "mit"
    assert all(map(licenses.listed, ["mit-feh", "mit-khronos-old", "bsd-3-clause-lbnl"])) and len(licenses.IDENTIFIERS) <= 200
    docs = spark.createDataFrame([(1, "SPDX-License-Identifier: Own-1.0 or mit"), (2, None)], "doc_id long, text string")
    labels = lambda **k: [r.labels for r in licenses.scan_licenses(docs, **k).orderBy("doc_id").collect()]
    assert labels() == ["mit,unlisted", ""] and labels(identifiers=["Own-1.0"]) == ["mit,own-1.0", ""]
