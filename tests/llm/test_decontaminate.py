import hashlib
import random
import re

from pyspark.sql import functions as F

from seatloom.llm import decontaminate


def words_of(text):
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", lower)


def brute(text, items):
    w = words_of(text)
    hit, ids = set(), set()
    for item_id, item in items:
        iw = words_of(item)
        size = min(13, len(iw))
        wins = {tuple(iw[i : i + size]) for i in range(len(iw) - size + 1)} if iw else set()
        for i in range(len(w) - size + 1):
            if tuple(w[i : i + size]) in wins:
                hit |= set(range(i, i + size))
                ids.add(str(item_id))
    return len(w), len(hit), len(ids), hashlib.sha256(",".join(sorted(ids)).encode()).hexdigest(), bool(hit) and 20 * len(hit) >= len(w)


def check(spark, docs, items):
    frame = spark.createDataFrame(docs, "doc_id long, text string").repartition(3).withColumn("row", F.lit("x")).withColumn("h", F.lit(1))
    bench = spark.createDataFrame(items, "item_id long, text string").withColumn("words", F.lit("clash"))
    rows = decontaminate.contamination(frame, bench).collect()
    assert len(rows) == len(docs)
    got = sorted((r.doc_id, r.n_words, r.n_hit, r.n_items, r.items_sha256, r.contaminated) for r in rows)
    assert got == sorted((d, *brute(t, items)) for d, t in docs)
    return got


def test_random_overlaps(spark):
    r = random.Random(3)
    few, many = [f"w{i}" for i in range(4)], [f"Wörd{i}" for i in range(300)]
    items = [(i, " ".join(r.choice(few if i % 2 else many) for _ in range(r.choice([1, 2, 3, 5, 8, 12, 13, 14, 20, 40])))) for i in range(60)] + [(900, None), (901, "..."), (3, "other text of the same id")]
    docs = []
    for d in range(150):
        parts = [r.choice(few if d % 2 else many) for _ in range(r.randrange(80))]
        for _ in range(r.randrange(3)):
            iw = words_of(r.choice(items)[1])
            a = r.randrange(len(iw) + 1)
            at = r.randrange(len(parts) + 1)
            parts[at:at] = iw[a:]
        docs.append((d, r.choice([" ", ", ", "\n- "]).join(parts)))
    docs += [(1000, None), (1001, ""), (1002, docs[5][1]), (1002, docs[5][1]), (1003, " ".join(r.choice(many) for _ in range(30000)) + " " + items[0][1])]
    got = check(spark, docs, items)
    assert any(g[5] for g in got) and not all(g[5] for g in got)


def test_long_items_only_and_empty(spark):
    r = random.Random(4)
    word = lambda: "".join(r.choice("abcdef") for _ in range(3))
    items = [(i, " ".join(word() for _ in range(30))) for i in range(20)]
    docs = [(d, " ".join(word() for _ in range(40)) + " " + " ".join(words_of(items[d % 20][1])[d % 11 : d % 11 + 8 + d % 9]) + " " + word()) for d in range(120)]
    check(spark, docs, items)
    check(spark, docs[:3], [])
    assert decontaminate.contamination(spark.createDataFrame([], "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")).count() == 0


def test_drop(spark):
    item = " ".join(f"q{i}" for i in range(20))
    docs = spark.createDataFrame([(1, item), (2, "clean words"), (None, None), (3, item + " x" * 500)], "doc_id long, text string")
    kept = decontaminate.drop_contaminated(docs, spark.createDataFrame([(7, item)], "item_id long, text string"))
    assert sorted(r.doc_id or 0 for r in kept.collect()) == [0, 2, 3]


def test_drop_judges_each_row(spark):
    """Clean documents stay though a contaminated one shares their doc_id or has none either."""
    item = " ".join(f"q{i}" for i in range(20))
    rows = [(None, item, 1), (None, "clean words", 2), (None, "other words", 3), (None, None, 4), (5, item, 5), (5, "clean words", 6), (5, "clean words", 7), (6, item, 8), (6, item, 9)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, digest int").repartition(3)
    kept = decontaminate.drop_contaminated(docs, spark.createDataFrame([(7, item)], "item_id long, text string"))
    assert kept.columns == docs.columns
    assert sorted(r.digest for r in kept.collect()) == [2, 3, 4, 6, 7]
