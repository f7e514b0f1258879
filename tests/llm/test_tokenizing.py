"""Operators 1, 3 and 10: ids, round trips and counts against the libraries and brute force."""

import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from seatloom.llm import pieces, token_counts, token_store

WORD_BPE, BYTE_BPE, PIECES = (public_tokenizers.path(n) for n in ("word_bpe_49k.json", "byte_bpe_50k.json", "piece_bpe_32k.model"))
TEXTS = [
    "", "  ", "a", "Hello, World! it's 12,345 o'clock", "tabs\tand\n\nnewlines \n mixed   runs ", "ÉTÉ über straße Ñandú ½ ² ª", "日本語のテキスト and العربية", "é combining İstanbul ΟΔΥΣΣΕΥΣ",
    "x<|endoftext|>y  <|endoftext|>", "<s> </s> <unk> ▁ under_score", "\x00\x1c\x85\xa0 controls", "emoji 👩‍👩‍👧 🤖", "aaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaa", "'re we'll they've 're're !!'s", "no" * 400, "a b " * 900,
    "spaces   before  words", "trailing newline\n", "\n leading", "end <|endof", "loud <|ENDOFTEXT|> and <|startOfText|>x", "http://x.y/z?q=1&r=%20 ##### *** --- ===",
]
ODD = [(1, None), (2, ""), (3, "same same"), (3, "same same"), (None, "no key"), (4, "naïve Text")]


def some_texts(n=150, seed=5):
    r = random.Random(seed)
    alphabet = "abcdeé \n\t.,'’1½ß日<|>▁ "
    return TEXTS + ["".join(r.choice(alphabet) for _ in range(r.randrange(60))) for _ in range(n)]


def table(spark, rows, schema="doc_id long, text string"):
    return spark.createDataFrame(rows, schema)


def test_store_against_library(spark, tmp_path):
    texts = some_texts()
    docs = table(spark, [(i * 7 - 50, t) for i, t in enumerate(texts)]).repartition(5).withColumn("key", F.lit("clash")).withColumn("shard", F.lit(9))
    path = str(tmp_path / "shards")
    token_store.write(docs, path, WORD_BPE, 2)
    got = {r.key: r for r in token_store.with_starts(token_store.records(spark, path)).collect()}
    tok = token_store.load_tokenizer(WORD_BPE)
    start = 0
    for i, t in enumerate(texts):
        ids = np.array([*tok.encode(t, add_special_tokens=False).ids, 2], "<u4")
        r = got[i * 7 - 50]
        assert (r.start, r.n_tokens, r.ids_crc32, r.last_id) == (start, len(ids), zlib.crc32(ids.tobytes()), 2), t
        start += len(ids)
    asked = spark.createDataFrame([(-50,), (0,), (-1,), (20,), (20,), (None,)], "doc_id long")
    found = {r.key: r.ids for r in token_store.lookup(spark, path, asked).collect()}
    assert set(found) == {-50, 20, -1} and found[20] == [*tok.encode(texts[10], add_special_tokens=False).ids, 2]


def test_store_odd_rows(spark, tmp_path):
    rows = token_store.encode_and_read(table(spark, ODD), WORD_BPE).orderBy("start").collect()
    assert [r.doc_id for r in rows] == [None, 1, 2, 3, 3, 4]
    assert [r.n_tokens for r in rows][1:3] == [1, 1] and rows[3].ids_crc32 == rows[4].ids_crc32
    assert rows[3].start + rows[3].n_tokens == rows[4].start
    assert token_store.encode_and_read(table(spark, []), WORD_BPE).count() == 0


def test_lookup_without_shards(spark, tmp_path):
    path = str(tmp_path / "none")
    token_store.write(table(spark, []), path, WORD_BPE, 2)
    assert token_store.lookup(spark, path, table(spark, [(1, "x")])).count() == 0 and token_store.records(spark, path).count() == 0


def test_fast_path_is_read_from_the_file():
    tok = token_store.load_tokenizer(WORD_BPE)
    told = tok.to_str()
    other = lambda a, b: token_store.drops_white_space(type(tok).from_str(told.replace(a, b)))
    assert token_store.drops_white_space(tok) and not token_store.drops_white_space(token_store.load_tokenizer(BYTE_BPE))
    assert told.count('"Removed"') == 1 and not other('"Removed"', '"Isolated"')
    assert "|[\\\\p{N}]|" in told and not other("|[\\\\p{N}]|", "|[\\\\p{N}\\\\s]|") and not other("|[\\\\p{N}]|", "| ?[\\\\p{N}]|")


def test_pretokens_are_encoded_once_and_as_in_the_text():
    """Words that differ in letters' case or in what stands beside them cost no further encoding, and every character of the
    range that is parted in Python gives the library's ids."""
    own, tok = token_store.WordEncoder(WORD_BPE, np.dtype("<u2")), token_store.load_tokenizer(WORD_BPE)
    own.encode(["Thear, (thear) THEAR. thear", "thear's 1thear2"])
    assert set(own.pretokens.number) == {"thear", ",", "(", ")", ".", "'s", "1", "2"}
    assert token_store.PretokenModel.of(token_store.load_tokenizer(BYTE_BPE)) is None
    letters = [c for c in map(chr, range(0x250)) if token_store._LETTERWISE.fullmatch(c)]
    texts = [f"a{c}b {c} '{c}s {c}{c}7{c}. '{c}{d}" for c, d in zip(letters, letters[1:] + letters[:1], strict=True)]
    texts += ["'s'S 'Re're's ''ve d'd'LL 'mm", "", " ", "x" * 5000, "9" * 300 + "!?" * 300, " ".join(f"w{i}q" for i in range(9000))]
    for t, got in zip(texts, own.encode(texts), strict=True):
        assert np.frombuffer(got, "<u2").tolist() == tok.encode(t, add_special_tokens=False).ids, t
    own.words.most = own.pretokens.most = 3  # tables that are full forget, and nothing changes
    assert [own.encode([t]) for t in texts[:50]] == [[x] for x in token_store.WordEncoder(WORD_BPE, np.dtype("<u2")).encode(texts[:50])]


@pytest.mark.parametrize("n", [0, 1, 2, 3, 64, 65, 5000])
def test_perfect_hash(n):
    r = np.random.default_rng(n)
    keys = np.unique(r.integers(-(1 << 60), 1 << 60, n))
    levels = token_store.build_levels(keys)
    h = token_store.PerfectHash(levels, token_store.rank_words(levels))
    assert sorted(h.slots(keys)) == list(range(len(keys)))


def test_piece_ids_are_the_library_s():
    import sentencepiece

    sp, own = sentencepiece.SentencePieceProcessor(model_file=PIECES), pieces.load(PIECES)
    for t in some_texts(400):
        assert np.frombuffer(own.encode([t])[0], "<i4").tolist() == sp.encode(t), t
        assert own.decode(np.array(sp.encode(t), int)) == sp.decode(sp.encode(t)), t


def test_pieces_share_the_pass_over_what_they_begin_with(monkeypatch):
    """Stretches of one batch take a step of the automaton for each distinct prefix, not for each character; the ids are the
    library's, also when full tables forget."""
    import sentencepiece

    sp, own = sentencepiece.SentencePieceProcessor(model_file=PIECES), pieces.Pieces(PIECES)
    steps, outputs = [], own.bpe.automaton.outputs
    monkeypatch.setattr(own.bpe.automaton, "outputs", lambda node: steps.append(node) or outputs(node))
    monkeypatch.setattr(own.bpe.automaton, "found", [None] * (1 << 20))  # no output is remembered outside
    words = ["anderbleinea" + x for x in ("", "n", "nd", "nds", "t", "ti", "tion")]
    texts = [" ".join(words), " ".join(words[::-1])]
    assert [np.frombuffer(b, "<i4").tolist() for b in own.encode(texts)] == [sp.encode(t) for t in texts]
    assert len(steps) == len({w[:i] for w in words for i in range(1, len(w) + 1)}) + 1  # and the blank before
    own.words.most = own.parts.most = 3
    for t in some_texts(100):
        assert np.frombuffer(own.encode([t])[0], "<i4").tolist() == sp.encode(t), t


def test_unigram_viterbi_is_the_library_s():
    import sentencepiece
    from sentencepiece import sentencepiece_model_pb2

    model = sentencepiece_model_pb2.ModelProto()
    model.ParseFromString(open(PIECES, "rb").read())
    model.trainer_spec.model_type = pieces.UNIGRAM
    sp, own = sentencepiece.SentencePieceProcessor(model_proto=model.SerializeToString()), pieces.load(PIECES, pieces.UNIGRAM)
    for t in ["Hello, World! it's 12,345", "straße über été", "several ordinary words in a row", "日本語", "abc"]:
        assert np.frombuffer(own.encode([t])[0], "<i4").tolist() == sp.encode(t), t


def test_piece_rows(spark):
    rows = pieces.encode(table(spark, [*ODD, (9, "▁")]).withColumn("ids", F.lit("clash")), PIECES).collect()
    by = {(r.doc_id, r.n_ids): r for r in rows}
    assert len(rows) == 7 and by[1, 0].ids == [] and by[2, 0].round_trip
    assert all(r.round_trip for r in rows if r.doc_id != 9)
    back = {r.doc_id: r.text for r in pieces.decode(spark.createDataFrame(rows), PIECES).collect()}
    assert back[4] == "naïve Text" and back[1] == ""
    assert pieces.encode(table(spark, []), PIECES).count() == 0


def test_counts_are_the_library_s(spark):
    texts = some_texts(400)
    tok = token_store.load_tokenizer(BYTE_BPE)
    rows = token_counts.count_tokens(table(spark, list(enumerate(texts))).withColumn("n_tokens", F.lit(-1)), BYTE_BPE, 20).collect()
    for r in rows:
        t = texts[r.doc_id]
        assert (r.n_bytes, r.n_tokens) == (len(t.encode()), len(tok.encode(t, add_special_tokens=False).ids)), t
        assert r.over_limit == (r.n_tokens > 20)
        assert r.kept_bytes == len(t.encode()) or len(tok.encode(t.encode()[: r.kept_bytes].decode(), add_special_tokens=False).ids) <= 20
    assert {r.n_tokens for r in token_counts.count_tokens(table(spark, ODD[:2]), BYTE_BPE).collect()} == {0}
    assert token_counts.count_tokens(table(spark, []), BYTE_BPE).count() == 0


def test_counts_at_every_prefix(spark):
    tok, own = token_store.load_tokenizer(BYTE_BPE), token_counts.load(BYTE_BPE)
    for t in [t for t in some_texts(120) if len(t) < 200]:
        want = [len(tok.encode(t[:i], add_special_tokens=False).ids) for i in range(len(t) + 1)]
        assert own.prefix_counts(t) == want, t
    row = token_counts.prefix_counts(table(spark, [(1, "ab c")]), BYTE_BPE).collect()[0]
    assert row.counts == own.prefix_counts("ab c") and len(row.counts) == 5


def test_cuts_read_the_stored_prefix_counts(monkeypatch):
    """Once the parts of a text are counted, where it is cut is read from the table without running BPE again."""
    bpe = token_counts.ByteBpe(BYTE_BPE)
    text = "antidisestablishmentarianism of " + "zqx" * 200 + " straightforwardly"
    parts = bpe.parts(text)
    counts = bpe.part_counts([parts])[0]
    want = bpe.prefix_counts(text)
    monkeypatch.setattr(bpe.bpe, "last_tokens", lambda word: pytest.fail("BPE was run again"))
    for limit in range(sum(counts)):
        kept = bpe.cut(parts, counts, limit)
        assert want[kept] <= limit
