import numpy as np
import pytest
from pyspark.sql import functions as F

from seatloom.llm import quality

SF = "/root/testdata"


def test_gradients_by_differences():
    net = quality.Network(3)
    net.p = {k: v.astype(np.float64) for k, v in net.p.items()}
    texts, labels, weights = [b"some words of a text " * 30, b"***", "längere Wörter".encode() * 40], np.array([1.0, 0.0, 1.0]), np.array([0.5, 2.0, 1.0])
    _, g = net.gradients(texts, labels, weights)
    r = np.random.default_rng(0)
    for name, v in net.p.items():
        for _ in range(6):
            at = tuple(r.integers(0, n) for n in v.shape)
            if name == "embed":
                at = (int(texts[0][r.integers(0, 20)]), at[1])
            old, eps = v[at], 1e-5
            v[at] = old + eps
            up, _ = net.gradients(texts, labels, weights)
            v[at] = old - eps
            down, _ = net.gradients(texts, labels, weights)
            v[at] = old
            assert abs((up - down) / (2 * eps) - g[name][at]) < 1e-4


def test_long_texts_score_alike_in_stretches():
    net = quality.Network(1)
    text = b"over and over " * 18000 + bytes(np.random.default_rng(1).integers(32, 120, 2 * quality.SLICE + 777).astype(np.uint8))
    assert net.long(quality.padded([text])[0]) == pytest.approx(float(net.forward(*quality.padded([text]))[0]), abs=1e-4)
    texts = [b"", b"ab", text, b"ab", b"end"]
    one = quality.logits([net, quality.Network(2)], texts)
    assert np.allclose(one, np.concatenate([quality.logits([net, quality.Network(2)], [t]) for t in texts], 1), atol=1e-5)


def test_symbols():
    """Each byte's kind of distance to the last place of the four bytes that end at it, by looking at all of them."""
    text = b"say it, say it again and again; one more time"
    data, _ = quality.padded([text])
    for i, s in enumerate(data[quality.LEAD : quality.LEAD + len(text)].tolist()):
        four = text[i - 3 : i + 1]
        lags = [lag for lag in range(1, min(i - 3, quality.REACH) + 1) if text[i - 3 - lag : i + 1 - lag] == four] if i >= 3 else []
        assert s == text[i] + 256 * (1 + sum(min(lags) > n for n in quality.NEAR) if lags else 0)


def test_calibration():
    r = np.random.default_rng(5)
    labels = (r.random(4000) < 0.5).astype(float)
    scale, shift = quality.calibrated(np.where(labels == 1, 8.0, -4.0) + 6 * r.standard_normal(4000), labels)
    assert abs(scale - 1 / 3) < 0.05 and abs(shift + 2 / 3) < 0.15


@pytest.mark.parametrize("sf", ["sf0.01", "sf0.1"])
def test_held_out_recall(spark, sf):
    docs, labels = spark.read.parquet(f"{SF}/{sf}/documents.parquet"), spark.read.parquet(f"{SF}/{sf}/labels.parquet")
    rows = quality.classify(docs, labels).join(labels, "doc_id").collect()
    assert all(r.held_out == quality.held_out(r.doc_id) and 0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in rows)
    held = [r for r in rows if r.held_out]
    recall = {q: np.mean([r.predicted == q for r in held if r.quality == q]) for q in (0, 1)}
    assert len(held) > 40 and recall[0] >= 0.9 and recall[1] >= 0.95, recall


def test_repeated_ids_have_one_text(spark, monkeypatch):
    """Whatever the order of the rows, the same text of a doc_id is learned from. Scores are sums of 32-bit numbers, whose last
    bits follow which texts a batch lays out together."""
    rows = [(i % 7, f"text {i} " * 5) for i in range(21)]
    labels = spark.createDataFrame([(i, i % 2) for i in range(7)], "doc_id long, quality int")
    got, learned, train = [], [], quality.train
    monkeypatch.setattr(quality, "train", lambda texts, marks, seed=7: learned.append((texts, marks.tolist())) or train(texts, marks, seed))
    for order in (rows, rows[::-1]):
        docs = spark.createDataFrame(order, "doc_id long, text string").repartition(3)
        got.append(sorted((r.doc_id, r.score) for r in quality.classify(docs.where("doc_id < 7"), labels).collect()))
    assert learned[0] == learned[1] and [d for d, _ in got[0]] == [d for d, _ in got[1]]
    assert np.allclose([x for _, x in got[0]], [x for _, x in got[1]], rtol=0, atol=1e-6)


def test_odd_rows(spark):
    docs = spark.createDataFrame([(1, None), (2, ""), (None, "x"), (3, "a b"), (3, "a b")], "doc_id long, text string").withColumn("score", F.lit("clash")).withColumn("quality", F.lit(5))
    labels = spark.createDataFrame([(3, 1, 0), (3, 1, 0), (77, 0, 0), (2, None, 0), (None, 1, 0)], "doc_id long, quality int, toxic int")
    rows = quality.classify(docs, labels).collect()
    assert len(rows) == 5 and len({r.score for r in rows if r.doc_id in (1, 2)}) == 1
    assert quality.classify(docs.limit(0), labels).count() == 0
    assert quality.classify(docs, labels.limit(0)).first().score == 0.5


def test_long_labelled_documents_are_read_by_stretches(spark, monkeypatch):
    """No labelled document is left out for its length: one over the bound teaches by stretches from all over it."""
    seen = []
    monkeypatch.setattr(quality, "LONGEST", 6400)
    monkeypatch.setattr(quality, "train", lambda texts, labels, seed=7: seen.append((texts, labels)) or quality.Constant(0.5))
    ids = [i for i in range(60) if not quality.held_out(i)][:6]
    long = "".join(f"{k:05d}é" for k in range(5000))
    docs = spark.createDataFrame([(i, long if n < 2 else f"short {i}") for n, i in enumerate(ids)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, n % 2) for n, i in enumerate(ids)], "doc_id long, quality int")
    quality.fit(docs, labels)
    (texts, marks), = seen
    assert len(texts) == len(marks) == 2 * quality.PIECES + 4
    pieces = [t.decode() for t in texts if len(t) > 10]
    assert len(pieces) == 2 * quality.PIECES and sum(map(len, texts)) <= 2 * 6400 + 60 and pieces[0].startswith("00000é") and pieces[quality.PIECES - 1].endswith("04999é")
    assert all(p in long for p in pieces) and len(set(pieces)) == quality.PIECES
