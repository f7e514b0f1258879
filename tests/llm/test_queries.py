"""The registered operator queries over the whole smallest tables: against SQL, or the libraries and plain code."""

import zlib

import duckdb
import numpy as np
import public_tokenizers
import pytest

from seatloom.llm.oracle import ORACLE
from seatloom.llm.queries import QUERIES
from tests import duck
from tests.llm import test_licenses, test_private_data

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def texts():
    return dict(duckdb.connect().execute(f"SELECT doc_id, text FROM '{SF}/documents.parquet'").fetchall())


def test_names():
    assert [sum(n.startswith(f"op{k}_") for n in QUERIES) for k in range(1, 14)] == [1] * 13 and "pipeline" in QUERIES and set(ORACLE) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_against_sql(spark, name):
    assert duck.rows(QUERIES[name](spark, SF).toPandas()) == duck.rows(duck.connect(SF).execute(ORACLE[name]).df())


def test_op1(spark, texts):
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    got = {r.doc_id: r for r in QUERIES["op1_token_store"](spark, SF).collect()}
    start = 0
    for d in sorted(texts):
        ids = np.array([*tok.encode(texts[d] or "", add_special_tokens=False).ids, 2], "<u4")
        assert (got[d].start, got[d].n_tokens, got[d].ids_crc32) == (start, len(ids), zlib.crc32(ids.tobytes()))
        start += len(ids)
    assert len(got) == len(texts)


def test_op2(spark, texts):
    rows = QUERIES["op2_licenses"](spark, SF).collect()
    assert len(rows) == len(texts)
    for r in rows:
        assert (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) == test_licenses.brute(texts[r.doc_id])


def test_op3(spark, texts):
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    rows = QUERIES["op3_pieces"](spark, SF).collect()
    assert len(rows) == len(texts) and all(r.ids == sp.encode(texts[r.doc_id] or "") and r.round_trip for r in rows)


def test_op3_as_unigram(spark, texts):
    """The Viterbi over the whole table, on the file read as a unigram model: every word's path sums to what the library's
    lattice finds best, and no document's to less than its fast encoder's (which isn't always the best path)."""
    import sentencepiece
    from sentencepiece import sentencepiece_model_pb2

    model = sentencepiece_model_pb2.ModelProto()
    with open(public_tokenizers.path("piece_bpe_32k.model"), "rb") as f:
        model.ParseFromString(f.read())
    model.trainer_spec.model_type = 1
    sp = sentencepiece.SentencePieceProcessor(model_proto=model.SerializeToString())
    total = lambda ids: sum(sp.get_score(i) for i in ids)
    rows = QUERIES["pieces_unigram"](spark, SF).collect()
    assert len(rows) == len(texts)
    words = {}
    for r in rows:
        assert sp.decode(r.ids) == (texts[r.doc_id] or "") and r.round_trip and total(r.ids) >= total(sp.encode(texts[r.doc_id] or "")) - 1e-6
        for k, i in enumerate(r.ids):
            if k == 0 or sp.id_to_piece(i).startswith("\u2581"):
                word = []
                words.setdefault(r.doc_id, []).append(word)
            word.append(i)
    distinct = {tuple(w) for ws in words.values() for w in ws if len(w) < 20 and not any(sp.is_byte(i) or set(sp.id_to_piece(i)) == {"\u2581"} for i in w)}
    assert len(distinct) > 3000
    for w in sorted(distinct)[::3]:
        best = sp.nbest_encode_as_ids(sp.decode(list(w)), 2)[0]
        assert abs(total(w) - total(best)) < 1e-3, (w, best)


def test_op4(spark, texts):
    rows = QUERIES["op4_private_data"](spark, SF).collect()
    assert len(rows) == len(texts)
    for r in rows:
        base = ",".join(f"{k}:{a}:{b}" for k, a, b in test_private_data.brute(texts[r.doc_id]))
        assert r.spans.startswith(base) and r.spans.count(":") == 2 * (r.n_email + r.n_ip + r.n_card + r.n_phone + r.n_added)


def test_op8(spark, texts):
    rows = QUERIES["op8_quality"](spark, SF).collect()
    assert {r.doc_id for r in rows} == set(texts) and all(r.predicted == int(r.score >= 0.3) for r in rows)


def test_op10(spark, texts):
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    for r in QUERIES["op10_token_counts"](spark, SF).collect():
        n = len(tok.encode(texts[r.doc_id] or "", add_special_tokens=False).ids)
        assert (r.n_bytes, r.n_tokens, r.over_limit) == (len((texts[r.doc_id] or "").encode()), n, n > 1024)
