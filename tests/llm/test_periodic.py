"""Operator 13: the scan against a plain one over every lag and place, long texts by ranges of lags, and the defined cases."""

import hashlib
import random
import re
import zlib

import duckdb
import numpy as np
import pytest

from seatloom.llm import periodic
from seatloom.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def plain_runs(words):
    """Every lag, every place; a stretch whose words have a shorter period (tried one by one) is none."""
    kinds = {}
    x = np.array([kinds.setdefault(w, len(kinds)) for w in words], np.int64)
    n, out = len(x), []
    for q in range(1, n // 3 + 1):
        same = np.r_[False, x[:-q] == x[q:], False]
        edges = np.flatnonzero(same[1:] != same[:-1])
        for s, e in zip(edges[::2], edges[1::2] + q, strict=True):
            if e - s >= max(24, 3 * q) and not any((x[s : e - p] == x[s + p : e]).all() for p in range(1, q)):
                out.append((int(s), int(e - s), q))
    return sorted(out, key=lambda r: (r[0], r[2]))


def plain_digest(doc_id, text):
    words = WORD.findall(text or "")
    n, h = len(words), zlib.crc32(str(doc_id).encode())
    if doc_id is not None and h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
    runs = plain_runs(words)
    gone = {i for s, length, q in runs for i in range(s + q, s + length)}
    best = min(runs, key=lambda r: (-r[1] / r[2], r[0], r[2])) if runs else (None,) * 3
    sha = lambda x: hashlib.sha256(x.encode()).hexdigest()
    return (len(runs), *best, 1000 * best[1] // best[2] if runs else None, sha("".join(f"{a},{b},{c}\n" for a, b, c in runs)), sha(" ".join(w for i, w in enumerate(words) if i not in gone)))


def runs_of_words(words, low=1, high=1 << 62):
    text = " ".join(words).encode()
    made = periodic.Words(np.frombuffer(text, np.uint8), np.array([0, len(text)]), periodic.RAW)
    return periodic.runs_of(made, low, high)[0]


@pytest.mark.parametrize("seed", range(6))
def test_scan_of_random_words(seed):
    rng = random.Random(seed)
    for _ in range(40):
        words = []
        while len(words) < rng.randrange(1, 400):
            block = [rng.choice("abcd"[: rng.randrange(1, 5)]) for _ in range(rng.randrange(1, 40))]
            words += (block * 12)[: rng.randrange(1, 12 * len(block))] if rng.random() < 0.6 else block
        assert runs_of_words(words) == plain_runs(words)


def test_scan_of_two_letters_fibonacci_and_squares():
    fib = "a", "ab"
    while len(fib[1]) < 900:
        fib = fib[1], fib[1] + fib[0]
    for words in (fib[1], "ab" * 300, "a" * 500, "aab" * 90 + "b" + "aab" * 90, ("a" * 70 + "b") * 9, ("ab" * 45 + "c") * 5 + "x" + "ab" * 60):
        assert runs_of_words(list(words)) == plain_runs(list(words))


def test_ranges_of_lags_cover_every_lag_once_and_give_the_same_runs(spark):
    for n in (3, 100, 5000, 1 << 20, 40 << 20):
        ranges = spark.range(1).select(periodic.lag_ranges(periodic.F.lit(n)).alias("r")).first().r
        assert ranges[0].low == 1 and ranges[-1].high > (n // 2 + 1) // 3 and all(a.high == b.low for a, b in zip(ranges, ranges[1:], strict=False))
        assert len(ranges) < 60 + 1 + n // (6 * periodic.LAGS) + 60
    rng = random.Random(4)
    words = [rng.choice("abcdefgh") for _ in range(700)]
    words = words + words[600:] * 4 + ["z"] * 30 + words[:200] * 3
    parts = sorted((r for low, high in ((1, 40), (40, 100), (100, 101), (101, 5000)) for r in runs_of_words(words, low, high)), key=lambda r: (r[0], r[2]))
    assert parts == plain_runs(words) and len(parts) >= 3


def test_query_over_the_smallest_table(spark):
    texts = dict(duckdb.connect().execute(f"SELECT doc_id, text FROM '{SF}/documents.parquet'").fetchall())
    rows = QUERIES["op13_periodic_runs"](spark, SF).collect()
    assert len(rows) == len(texts) and sum(r.n_runs > 0 for r in rows) > 10
    for r in rows:
        assert (r.n_runs, r.start, r.length, r.period, r.exponent_milli, r.runs_sha256, r.collapsed_sha256) == plain_digest(r.doc_id, texts[r.doc_id]), r.doc_id


def test_defined_cases(spark):
    again = "x y z " * 9
    table = [(None, again), (1, None), (2, ""), (3, " \t\n"), (4, again), (4, again), (5, "A a " * 13), (6, "\x85é " * 30), (7, "a " * 23 + "\x0b a"), (8, "one")]
    rows = spark.createDataFrame(table, "doc_id long, text string")
    got = sorted(map(tuple, periodic.digest_runs(rows).collect()), key=repr)
    assert got == sorted(((d, *plain_digest(d, t)) for d, t in table), key=repr)
    wide = rows.selectExpr("*", "1 AS h", "2 AS a", "3 AS w", "4 AS digest", "5 AS runs", "6 AS n_words")
    assert sorted(map(tuple, periodic.digest_runs(wide).collect()), key=repr) == got
    assert periodic.digest_runs(spark.createDataFrame([], "doc_id long, text string")).count() == 0
    one = {r.doc_id: r for r in periodic.periodic_runs(rows).collect()}
    assert one[4].collapsed == "x y z" and one[8].collapsed == "one" and one[1].n_words == 0


def test_long_texts_go_by_ranges_of_lags(spark, monkeypatch):
    """Texts over the bound, equal ones among them, give what short ones give."""
    rng = random.Random(2)
    table = []
    for d in range(12):
        words = [rng.choice(["an", "be", "see", "dee"]) for _ in range(rng.randrange(200, 900))]
        table.append((d, " ".join((words[:30] * 7 + words) if d % 2 else words + ["be"] * 60)))
    table += [table[1], (99, table[1][1]), (None, table[2][1])]
    rows = spark.createDataFrame(table, "doc_id long, text string")
    want = sorted(((d, *plain_digest(d, t)) for d, t in table), key=repr)
    for long, lags, compared in ((200, 16, 200), (1500, 50, 1000), (1 << 20, 1 << 14, 1 << 24)):
        monkeypatch.setattr(periodic, "LONG", long)
        monkeypatch.setattr(periodic, "LAGS", lags)
        monkeypatch.setattr(periodic, "COMPARED", compared)
        assert sorted(map(tuple, periodic.digest_runs(rows).collect()), key=repr) == want


def test_time_in_proportion_to_words_times_log(spark):
    """One word over and over is a run at every lag, and a text of a hundred thousand words has 33,000 lags."""
    assert runs_of_words(["a"] * 100_000) == [(0, 100_000, 1)]
    rng = random.Random(8)
    words = [str(rng.randrange(50_000)) for _ in range(100_000)]
    assert runs_of_words(words + words[:20_000] * 0 + words[99_000:] * 3) == [(99_000, 4000, 1000)]
