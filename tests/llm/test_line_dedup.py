import random
import re

from pyspark.sql import functions as F

from seatloom.llm import line_dedup


def norm(line):
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in line)
    return tuple(re.findall("[^\x20\x09-\x0d]+", lower))


def brute(docs, least):
    """Every run of consecutive lines with words, of at least `least` words, that occurs earlier: its lines go."""
    docs = sorted(set(docs), key=lambda x: x[0])
    seen, gone = {}, {}
    for d, t in docs:
        lines = [(i, norm(x)) for i, x in enumerate((t or "").split("\n")) if norm(x)] if t is not None else []
        gone[d, t] = set()
        runs = [(s, e) for s in range(len(lines)) for e in range(s + 1, len(lines) + 1) if sum(len(x[1]) for x in lines[s:e]) >= least]
        for s, e in runs:
            key = tuple(x[1] for x in lines[s:e])
            if seen.setdefault(key, (d, s)) < (d, s):
                gone[d, t] |= {x[0] for x in lines[s:e]}
    return {k: "\n".join(x for i, x in enumerate(k[1].split("\n")) if i not in v) if k[1] is not None else None for k, v in gone.items()}


def check(spark, docs, least=line_dedup.MIN_WORDS):
    frame = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    frame = frame.withColumn("n_lines", F.lit("clash")).withColumn("line", F.lit(1)).withColumn("at", F.col("text")).withColumn("kept", F.col("text"))
    rows = line_dedup.dedup_lines(frame, least).collect()
    want = brute(docs, least)
    assert len(rows) == len(docs)
    for r in rows:
        assert r.text == want[r.doc_id, r.kept], (r.doc_id, r.kept)
        assert r.n_deleted == (0 if r.kept is None else len(r.kept.split("\n")) - (len(r.text.split("\n")) if r.text or r.n_deleted < len(r.kept.split("\n")) else 0))
    return rows


def test_random_runs(spark):
    r = random.Random(6)
    pool = ["a", "b", "A b", "c d e", "f  g h i", "j k l m n", "o p q r s t u", "", " \t", "é ü", "x y"]
    docs = [(d, "\n".join(r.choice(pool) for _ in range(r.randrange(14)))) for d in range(120)]
    docs += [(200, None), (201, ""), (202, "\n\n"), (203, docs[7][1]), (203, docs[7][1]), (204, "j k l m n"), (205, "\n".join(["same line again and again"] * 300))]
    rows = check(spark, docs)
    assert any(x.emptied for x in rows) and not all(x.emptied for x in rows)
    check(spark, docs[:60], 9)
    check(spark, docs[:40], 1)


def test_clean_documents_stay(spark):
    docs = [(d, f"first line of document {d}\nshort\nlast line of document {d}") for d in range(20)]
    assert all(r.n_deleted == 0 for r in check(spark, docs))
    assert line_dedup.deduplicated(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_suffix_ranks(spark):
    """Ranks order suffixes as their sequences of first ranks do; each level's classes are those that share so many lines."""
    r = random.Random(12)
    pool = ["a b", "c", "d e f", "g", "same line", "h i j k"]
    docs = [(d, "\n".join(r.choice(pool[: r.choice([2, 4, 6])]) for _ in range(r.randrange(12)))) for d in range(60)]
    docs += [(100 + d, "\n".join(pool * 4)) for d in range(5)] + [(200, "\n".join(["same line"] * 70)), (201, "once\nonly\nonce")]
    lines = line_dedup.repeated_lines(line_dedup.numbered(spark.createDataFrame(docs, "doc_id long, text string").repartition(3)))
    ranks, levels = line_dedup.suffix_ranks(lines)
    first = {x.pos: (x.rank, x.more) for x in lines.collect()}
    suffix = {p: tuple(first[p + i][0] for i in range(more)) for p, (_, more) in first.items()}
    got = {x.pos: x.rank for x in ranks.collect()}
    assert got.keys() == suffix.keys()
    order = sorted(suffix, key=lambda p: suffix[p])
    assert all(got[p] <= got[q] and (got[p] == got[q]) == (suffix[p] == suffix[q]) for p, q in zip(order, order[1:]))
    assert max(levels) >= 64  # the doubling goes on until suffixes are settled
    for span, level in levels.items():
        classes = {}
        for x in level.collect():
            classes.setdefault(x.rank, set()).add(x.pos)
        want = {}
        for p, s in suffix.items():
            if len(s) >= span:
                want.setdefault(s[:span], set()).add(p)
        assert sorted(map(sorted, classes.values())) == sorted(sorted(v) for v in want.values() if len(v) > 1)


def runs(spark, docs, least=line_dedup.MIN_WORDS):
    frame = spark.createDataFrame(docs, "doc_id long, text string").repartition(3).withColumn("line", F.lit("clash")).withColumn("n", F.lit(1)).withColumn("first", F.lit(None))
    low = lambda d: -1 if d is None else d
    return sorted((low(r.doc_id), r.line, r.n_lines, r.n_words, low(r.first_doc_id), r.first_line) for r in line_dedup.copied_runs(frame, least).collect())


def brute_runs(docs, least):
    """By comparing every place with every earlier one: the longest earlier run, unless the place before it holds it."""
    docs = sorted({(-1 if d is None else d, t) for d, t in docs if t is not None})
    lines = [[(i, norm(x)) for i, x in enumerate(t.split("\n")) if norm(x)] for _, t in docs]
    places = [(d, i) for d, x in enumerate(lines) for i in range(len(x))]
    longest = {}
    for p, (d, i) in enumerate(places):
        for e, j in places[:p]:
            n = 0
            while i + n < len(lines[d]) and j + n < len(lines[e]) and lines[d][i + n][1] == lines[e][j + n][1]:
                n += 1
            if n > longest.get((d, i), (0,))[0]:
                longest[d, i] = (n, e, j)
    out = []
    for (d, i), (n, e, j) in longest.items():
        words = sum(len(x[1]) for x in lines[d][i : i + n])
        if words >= least and longest.get((d, i - 1), (0,))[0] <= n:
            out.append((docs[d][0], lines[d][i][0], n, words, docs[e][0], lines[e][j][0]))
    return sorted(out)


def test_copied_runs(spark):
    a, b, c = "one two three", "four five", "six seven eight nine ten"
    docs = [(1, f"{a}\n\n{b}\n{c}\nalone here"), (2, f"x\n{a}\n{b}\n \n{c}"), (3, f"{c}\nown words of three"), (None, f"{b}\n{c}")]
    # documents without doc_id come first; all three lines of document 2 come from document 1
    assert runs(spark, docs) == [(1, 2, 2, 7, -1, 0), (2, 1, 3, 10, 1, 0), (3, 0, 1, 5, -1, 1)]


def test_runs_are_maximal(spark):
    a, b = "one two three four five six", "seven eight nine ten eleven twelve"
    got = runs(spark, [(1, a), (2, b), (3, f"{a}\n{b}"), (4, f"{a}\n{b}")])
    assert got == [(3, 0, 1, 6, 1, 0), (3, 1, 1, 6, 2, 0), (4, 0, 2, 12, 3, 0)]


def test_runs_by_brute_force(spark):
    r = random.Random(21)
    pool = ["a b c d e f", "b", "C  d", "e f g", "same line here", "h i j k l m n", "o p"]
    docs = [(d, "\n".join(r.choice(pool[: r.choice([2, 4, 7])]) if r.random() < 0.9 else f"own {d} {r.random()}" for _ in range(r.randrange(16)))) for d in range(50)]
    whole = "\n".join(r.choice(pool) for _ in range(45))
    docs += [(100, whole), (101, whole), (102, "start\n" + whole[5:] + "\nend"), (103, whole + "\n" + whole), (104, "\n".join(["same line here"] * 70)), (105, "\n".join(pool * 6))]
    docs += [(None, docs[3][1]), (None, None), (106, ""), (107, " \n\n"), (108, docs[5][1]), (108, docs[5][1]), (109, None)]
    assert runs(spark, docs) == brute_runs(docs, 5)
    assert runs(spark, docs[20:45], 1) == brute_runs(docs[20:45], 1)
    assert runs(spark, [(1, "once\nonly"), (2, "other")]) == [] and line_dedup.copied_runs(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_four_doublings_a_round(spark, monkeypatch):
    """A run of 300 lines takes three rounds, each with one table of keys, and the bisection one table for each doubling that a
    copy reaches; keys are made a few suffixes at a time."""
    made, whole = [], line_dedup.cut
    monkeypatch.setattr(line_dedup, "cut", lambda df: made.append(df.columns) or whole(df))
    monkeypatch.setattr(line_dedup, "KEYS", 50)
    r = random.Random(3)
    text = "\n".join(r.choice(["a b c", "d e", "f g h i", "j"]) for _ in range(300))
    docs = [(1, text), (2, "own line here\n" + text), (3, text[9:] + "\nmore of it")]
    lines = line_dedup.repeated_lines(line_dedup.numbered(spark.createDataFrame(docs, "doc_id long, text string").repartition(3)))
    made.clear()
    levels = line_dedup.suffix_ranks(lines)[1]
    assert len(made) <= 6 and sorted(levels) == [1 << k for k in range(13)]
    made.clear()
    found = line_dedup.longest_copies(levels).collect()
    assert len(made) <= 9 and max(x.n for x in found) == 300
    assert line_dedup.suffix_ranks(lines, 6)[1].keys() == {1, 2, 4}
