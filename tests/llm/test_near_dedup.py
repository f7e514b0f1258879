import random
import re

import numpy as np
from pyspark.sql import functions as F

from seatloom.llm import near_dedup
from seatloom.llm.components import components, forest


def shingles(text):
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    w = re.findall("[^\x20\x09-\x0d]+", lower)
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())


def brute(docs):
    sets = [shingles(t) for _, t in docs]
    pairs = [(i, j) for i in range(len(docs)) for j in range(i) if docs[i][0] is not None and docs[j][0] is not None and sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= 75 * len(sets[i] | sets[j])]
    root = forest([(i, i) for i in range(len(docs))] + pairs)
    least = {}
    for i, (d, _) in enumerate(docs):
        if d is not None:
            least[root[i]] = min(least.get(root[i], d), d)
    return sorted((d if d is not None else -1, len(sets[i]), least[root[i]] if d is not None else -1) for i, (d, _) in enumerate(docs))


def check(spark, docs):
    frame = spark.createDataFrame(docs, "doc_id long, text string").repartition(4).withColumn("node", F.lit("clash")).withColumn("n", F.lit(0))
    rows = near_dedup.near_duplicates(frame).collect()
    assert all(r.kept == (r.doc_id == r.component_id or r.doc_id is None) for r in rows)
    got = sorted((r.doc_id if r.doc_id is not None else -1, r.n_shingles, r.component_id if r.doc_id is not None else -1) for r in rows)
    assert got == brute(docs)


def edited(r, words, share):
    return [w if r.random() > share else f"e{r.randrange(10**6)}" for w in words]


def test_groups_near_the_threshold(spark):
    r = random.Random(2)
    docs = []
    for g in range(40):
        base = [f"w{r.randrange(3000)}" for _ in range(r.choice([3, 6, 12, 40, 150]))]
        for _ in range(r.randrange(1, 7)):
            docs.append((r.randrange(10**6), r.choice([" ", "\n"]).join(edited(r, base, r.choice([0, 0.01, 0.03, 0.05, 0.08])))))
    docs += [(10**7 + i, t) for i, t in enumerate([None, "", " \t", "One", "one", "one two three four", "ONE two three four", "a b c d e", "a b c d e", "\x00 \x1f x"])]
    docs += [(None, "a b c d e"), (10**7 + 8, "a b c d e")]
    check(spark, docs)


def test_crowded_buckets(spark):
    """Many texts around one shared passage, some of them linked in chains, beyond what is paired directly."""
    r = random.Random(8)
    passage = [f"p{i}" for i in range(90)]
    docs = []
    for d in range(260):
        own = [f"d{d}x{i}" for i in range(r.randrange(28, 60))]
        docs.append((d, " ".join(passage + own)))
        if d % 7 == 0:
            docs.append((1000 + d, " ".join(passage + own[:-4] + ["z", "y"])))
    check(spark, docs)


def test_empty_and_unlinked(spark):
    assert near_dedup.near_duplicates(spark.createDataFrame([], "doc_id long, text string")).count() == 0
    check(spark, [(1, "only one document here today"), (2, "and one that is quite different")])


def test_signature_estimates_similarity():
    r = np.random.default_rng(0)
    shared, a, b = (np.unique(r.integers(0, 1 << 62, n).astype(np.uint64)) for n in (300, 100, 100))
    got = []
    for k in range(40):
        salt = np.uint64(k * 7919)
        s = near_dedup.super_minhash([np.r_[shared, a] ^ salt, np.r_[shared, b] ^ salt])
        got.append((s[0] == s[1]).mean())
    assert abs(np.mean(got) - 0.6) < 0.02
    small = near_dedup.super_minhash([np.arange(3, dtype=np.uint64)])
    assert (small >> np.uint64(32) < near_dedup.SLOTS).all()


def test_components(spark):
    r = random.Random(1)
    edges = [(r.randrange(400), r.randrange(400)) for _ in range(220)] + [(i, i + 1) for i in range(1000, 1300)]
    frame = spark.createDataFrame(edges, "u long, v long").repartition(7)
    want = {x: c for x, c in forest([e for e in edges if e[0] != e[1]]).items()}
    assert {x.node: x.component for x in components(frame).collect()} == want


def test_keep_one_judges_each_row(spark):
    """Of each group one row stays; texts of their own stay whatever their doc_id; copies without doc_id go."""
    base = [f"w{i}" for i in range(60)]
    a, near, b, c = " ".join(base), " ".join([*base[:-1], "z"]), "a text that is like no other one", "some words without any id at all"
    rows = [
        (3, a, 0), (7, near, 1), (7, b, 2), (3, near, 3), (3, a, 4),  # one of a, near; b
        (None, c, 5), (None, c, 6), (None, c + " more", 7), (None, near, 8),  # one of the first three; near goes
        (None, None, 9), (None, None, 10), (4, "", 11), (4, "", 12), (None, "alone and without an id here", 13),
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string, node int").repartition(3)
    out = near_dedup.keep_one(docs)
    assert out.columns == docs.columns
    got = out.collect()
    kept = {r.node for r in got}
    assert len(got) == len(kept) == 8 and {2, 9, 10, 11, 12, 13} < kept
    assert len(kept & {0, 3, 4}) == 1 and not kept & {1, 8} and len(kept & {5, 6, 7}) == 1


def test_second_texts(spark):
    """Documents whose texts were cut are linked by what they were, too; a doc_id that isn't alone has no second text."""
    base = [f"w{i}" for i in range(80)]
    a, near = " ".join(base), " ".join([*base[:-1], "z"])
    rows = [(1, "w1 w2 w3 w4 w5 w6", 0), (2, "z", 1), (3, "a rest of its own in here", 2), (3, "another rest of its own here", 3), (4, a + " x", 4), (5, "unlike all others it stays whole", 5), (None, "z y x w v u t s", 6)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, node int").repartition(3)
    also = spark.createDataFrame([(1, a), (2, near), (3, near), (5, "unlike all others it stays whole"), (6, near), (None, near), (4, a + " x")], "doc_id long, text string")
    assert {r.node for r in near_dedup.keep_one(docs).collect()} == {0, 1, 2, 3, 4, 5, 6}
    assert {r.node for r in near_dedup.keep_one(docs, also).collect()} == {0, 2, 3, 5, 6}
    assert near_dedup.keep_one(docs.limit(0), also).count() == 0 and near_dedup.keep_one(docs, also.limit(0)).count() == 7
