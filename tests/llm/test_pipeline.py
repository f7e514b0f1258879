"""run() against the stages done by hand, each by a plain version, on a small corpus."""

import random

import public_tokenizers
import pytest

import corpus_pipeline
from seatloom.llm import near_dedup, quality
from seatloom.llm.components import forest
from tests.llm import test_decontaminate, test_line_dedup, test_near_dedup


@pytest.fixture(scope="module")
def corpus(spark, tmp_path_factory):
    r = random.Random(11)
    word = lambda: "".join(r.choice(["th", "er", "on", "an", "re", "en", "in", "es"]) for _ in range(r.randrange(1, 5)))
    line = lambda: " ".join(word() for _ in range(r.randrange(3, 14))) + "."
    good = [[line() for _ in range(r.randrange(2, 9))] for _ in range(90)]
    items = [(i, " ".join(word() for _ in range(18))) for i in range(4)]
    docs = [(i, "\n".join(x)) for i, x in enumerate(good)]
    for i in range(90, 110):  # repeated runs, copies, edited copies
        a = list(r.choice(good))
        docs.append((i, "\n".join([*a[:2], line(), *a[2:]])))
    docs.append((110, docs[3][1]))
    docs += [(111 + i, " ".join(w + ("x" if k % 30 == 29 else "") for k, w in enumerate(docs[5 + i][1].replace("\n", " ").split()))) for i in range(5)]
    docs += [(120 + i, line() + " " + items[i % 4][1] + " " + line()) for i in range(6)]
    docs += [(130 + i, " ".join(f"{word()}{r.choice(['***', '%%%', '&&&'])}" for _ in range(60))) for i in range(40)]
    docs += [(200, None), (201, ""), (202, "\n")]
    path = tmp_path_factory.mktemp("corpus")
    frame = spark.createDataFrame([(i, t, "en", "s", len(t or ""), "odd") for i, t in docs], "doc_id long, text string, lang string, source string, n_chars long, score string")
    frame.repartition(3).write.parquet(f"{path}/documents.parquet")
    labels = [(i, 0 if 130 <= i < 170 else 1, 0) for i, _ in docs if i < 170]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    return str(path), docs, items


def one_of_each(left, before):
    """Of the documents linked by their texts or by those before lines were cut, the smallest doc_id stays."""
    groups = [test_near_dedup.brute(sorted(texts)) for texts in (left, [(d, before[d]) for d, _ in left])]
    root = forest([(d, c) for group in groups for d, _, c in group])
    return [(d, t) for d, t in left if root[d] == d]


def test_run(spark, corpus):
    import sentencepiece

    path, docs, items = corpus
    read = spark.read.parquet(f"{path}/documents.parquet")
    net = quality.fit(read, spark.read.parquet(f"{path}/labels.parquet"))
    keep = [s >= quality.THRESHOLD for s in net.score([(t or "").encode() for _, t in docs])]
    left = [d for d, k in zip(docs, keep, strict=True) if k]
    assert not any(130 <= d < 170 for d, _ in left) and sum(d < 120 for d, _ in left) > 100
    cut = test_line_dedup.brute(left, 5)
    left = [(d, cut[d, t]) for d, t in left if not (t and t != cut[d, t] and not (cut[d, t] or "").strip())]
    left = one_of_each(left, dict(docs))
    left = [(d, t) for d, t in left if not test_decontaminate.brute(t, items)[4]]
    sp = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    rows = corpus_pipeline.run(spark, path).collect()
    assert sorted((r.doc_id, r.text, r.ids) for r in rows) == sorted((d, t, sp.encode(t or "")) for d, t in left)
    assert all(r.round_trip == True and r.score == "odd" and r.n_chars == len(r.text or "") for r in rows)  # noqa: E712
    assert {200, 201, 202} & {r.doc_id for r in rows} == {d for d, _ in left if d >= 200}


def test_no_copy_outlives_its_cut(spark, tmp_path):
    """Of each group that near_dedup finds in what the quality stage keeps, one document at most is left at the end."""
    d = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{d}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES[:3]:
        stage(spark, docs, d).write.parquet(f"{tmp_path}/{name}")
        docs = spark.read.parquet(f"{tmp_path}/{name}")
    groups = {r.doc_id: r.component_id for r in near_dedup.near_duplicates(spark.read.parquet(f"{tmp_path}/quality")).collect()}
    left = [groups[r.doc_id] for r in docs.select("doc_id").collect()]
    assert len(left) == len(set(left)) and len(set(groups.values())) < len(groups) - 50


def test_stages_on_empty_tables(spark, corpus, tmp_path):
    path, _, _ = corpus
    for name in ("documents", "labels", "benchmark"):
        spark.read.parquet(f"{path}/{name}.parquet").limit(0).write.parquet(f"{tmp_path}/{name}.parquet")
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, str(tmp_path))
        assert out.count() == 0 and (name == "sentencepiece" or out.columns == docs.columns)


def test_links_of_rows_that_share_a_doc_id(spark, tmp_path):
    """Copies that the cut makes unlike each other are one group, whatever other rows have their doc_id, or none."""
    r = random.Random(5)
    line = lambda n=9: " ".join("".join(r.choice("bcdfghklmnprst") + r.choice("aeiou") for _ in range(3)) for _ in range(n))
    body = [line() for _ in range(12)]
    first, second = "\n".join([*body, "one end of it"]), "\n".join([*body, "another end here"])
    fillers = [(10 + i, "\n".join(line() for _ in range(6))) for i in range(20)]
    for ids in ((1, 2, 1), (1, 2, 2), (1, None, None)):
        table = [(ids[0], first, 0), (ids[1], second, 1), (ids[2], "\n".join(line() for _ in range(5)), 2), *[(i, t, i) for i, t in fillers]]
        d = f"{tmp_path}/{ids[1]}-{ids[2]}"
        docs = spark.createDataFrame(table, "doc_id long, text string, row int")
        docs.write.parquet(f"{d}/documents.parquet")
        cut = f"{d}/cut"
        corpus_pipeline.line_dedup_stage(spark, spark.read.parquet(f"{d}/documents.parquet"), d).write.parquet(cut)
        kept = {x.row for x in corpus_pipeline.near_dedup_stage(spark, spark.read.parquet(cut), d).collect()}
        assert kept == {0, 2, *range(10, 30)}, ids


def test_tables_between_the_steps_are_gone(spark, tmp_path):
    """A stage leaves what its result still reads; when that is written inside a step, nothing."""
    from pathlib import Path

    from seatloom.llm import common

    common.shared_root(spark)
    folder = Path(spark.sparkContext._jsc.sc().getCheckpointDir().get().removeprefix("file:"))
    count = lambda: len([x for x in folder.iterdir() if x.name.startswith("rdd-")])
    docs = spark.createDataFrame([(i, " ".join(f"w{(i // 3) * 50 + k}" for k in range(40)) + f" x{i}") for i in range(60)], "doc_id long, text string")
    before, setting = count(), spark.conf.get(common._CLEANUP, "false")
    assert near_dedup.keep_one(docs).count() == 20 and count() - before == 1
    with common.step(spark):
        assert near_dedup.near_duplicates(docs).where("kept").count() == 20 and count() - before == 4
    assert count() - before == 1 and spark.conf.get(common._CLEANUP) == setting
