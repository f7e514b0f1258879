"""Token-id output: documents as raw ids in shard files with a minimal perfect hash index (operator 1).

A shard file is written by one Spark task through Spark's own committed text writer, so a lost executor
leaves no half file, and any file system that Spark writes to will do::

    ids of record 0 | gap | ids of record 1 | gap | ... | index | gap | footer | gap

Ids are little-endian, 16 bits wide where the vocabulary allows and 32 otherwise; a gap is one id of zero
bytes (the writer's record separator). Records stand in ascending key order. The index holds, for n records
and m distinct keys: the keys, the byte offset and the token count of each record; the levels of a minimal
perfect hash over the keys (each level a bit set; a key's slot is the number of set bits before its own), with the
number of set bits before each 64-bit word, so that nothing is counted when a shard is opened;
and by slot a 32-bit fingerprint, the first record of that key and its number of records. A probe hashes
the key, reads a bit or a few, compares one fingerprint: constant time, whatever the shard's size.

Defined cases: null or empty text gives a record of the end id alone. Null keys sort first, are counted in
the footer and are not in the hash. Equal keys (repeated rows) are neighbours, ordered by a hash of their
text; a lookup returns all of them. Extra columns are not read. An empty table gives no shard and no rows.
"""

from __future__ import annotations

import functools
import json
import re
import struct
import zlib
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from seatloom.llm.common import IdTable, bound_batches, cut, fields, mix, partitions_for, scratch_path, sums, tidy

MAGIC = b"SLTOKEN2"
#: index offset, index length, records, distinct keys, null-key records, tokens, first key, last key, shard, id bytes
FOOTER = struct.Struct("<QQQQQQqqII8s")
SHARD_TEXT_BYTES = 48 << 20
CACHE_WORDS = 400_000

# ---------------------------------------------------------------- encoding

#: Latin text for which the normaliser works letter by letter, so that its pretokens are found in Python by the file's
#: pattern, with the letters and numbers of this range (lowered) spelt out. Any other text goes through the library whole.
_LETTERWISE = re.compile("[\\t\\n\\r\\x20-\\x7e\\xa1-\\xac\\xae-\\u012f\\u0131-\\u024f]*")
_LETTERS, _NUMBERS = "a-z\xaa\xb5\xba\xdf-\xf6\xf8-\u02af\u2c65\u2c66", "0-9\xb2\xb3\xb9\xbc-\xbe"
#: Pretokens and texts that are taken at a time.
CALL_WORDS, CALL_TEXTS = 4000, 100


class WordEncoder:
    """Ids of whole texts by the tokenizers library. Where the tokenizer's file says that white space is dropped and no token
    stands across it, each distinct pretoken is encoded once, many in a call, by the file's model alone; else texts go through
    the library whole."""

    def __init__(self, path: str, dtype: np.dtype):
        self.tok, self.dtype = load_tokenizer(path), dtype
        self.model = PretokenModel.of(self.tok)
        self.added = [t.content.lower() for t in self.tok.get_added_tokens_decoder().values()]
        self.words, self.pretokens = IdTable(self._of_words, dtype, CACHE_WORDS), IdTable(self._of_pretokens, dtype, CACHE_WORDS)

    def _library(self, texts: list[str]) -> list[bytes]:
        return [np.array(e.ids, self.dtype).tobytes() for e in self.tok.encode_batch_fast(texts, add_special_tokens=False)]

    def _of_pretokens(self, pretokens: list[str]) -> tuple[np.ndarray, np.ndarray]:
        made = [self.model.ids(pretokens[i : i + CALL_WORDS], self.dtype) for i in range(0, len(pretokens), CALL_WORDS)]
        return np.concatenate([ids for ids, _ in made]), np.concatenate([sizes for _, sizes in made])

    def _of_words(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        parts = list(map(self.model.parts, words))
        ids, sizes = self.pretokens.take(list(chain.from_iterable(parts)))
        return ids, sums(sizes, list(map(len, parts)))

    def encode(self, texts: list[str]) -> list[bytes]:
        # added strings are found before letters are lowered, so texts that may hold one aren't parted
        lower = [t.lower() for t in texts]
        whole = [i for i, t in enumerate(texts) if not (self.model and _LETTERWISE.fullmatch(t)) or any(a in lower[i] for a in self.added)]
        out: list[bytes] = [b""] * len(texts)
        for i in range(0, len(whole), 64):
            for k, ids in zip(whole[i : i + 64], self._library([texts[k] for k in whole[i : i + 64]]), strict=True):
                out[k] = ids
        rest = sorted(set(range(len(texts))) - set(whole))
        for i in range(0, len(rest), CALL_TEXTS):
            lists = [lower[k].split() for k in rest[i : i + CALL_TEXTS]]
            ids, sizes = self.words.take(list(chain.from_iterable(lists)))
            data, at = ids.tobytes(), 0
            for k, size in zip(rest[i : i + CALL_TEXTS], sums(sizes, list(map(len, lists))).tolist(), strict=True):
                out[k] = data[at : at + size * self.dtype.itemsize]
                at += size * self.dtype.itemsize
        return out


class PretokenModel:
    """The library's model for pretokens that are already in lower case: normaliser and pattern, which take more time than the
    model, have nothing left to do. Every pretoken's last id, and no other, is of a piece with the file's end-of-word suffix,
    so the ids of many in one call part there."""

    def __init__(self, told: dict, type_):
        pattern = told["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"]
        self.parts = re.compile(pattern.replace("\\p{L}", _LETTERS).replace("\\p{N}", _NUMBERS)).findall
        suffix = told["model"]["end_of_word_suffix"]
        self.ends = np.zeros(1 + max(told["model"]["vocab"].values()), bool)
        self.ends[[i for piece, i in told["model"]["vocab"].items() if piece.endswith(suffix)]] = True
        self.tok = type_.from_str(json.dumps(told | {"normalizer": None, "added_tokens": [], "pre_tokenizer": {"type": "CharDelimiterSplit", "delimiter": " "}}))

    @classmethod
    def of(cls, tok) -> PretokenModel | None:
        """None where the file isn't of this kind."""
        told = json.loads(tok.to_str())
        model, suffix = told["model"], told["model"].get("end_of_word_suffix")
        if not drops_white_space(tok) or told["pre_tokenizer"]["type"] != "Sequence" or model["type"] != "BPE" or not suffix or model.get("continuing_subword_prefix") or model.get("ignore_merges"):
            return None
        split, *rest = told["pre_tokenizer"]["pretokenizers"]
        plain = set(re.findall(r"\\p\{\w+\}", split["pattern"]["Regex"])) <= {"\\p{L}", "\\p{N}"}
        covered = all(c in model["vocab"] and c + suffix in model["vocab"] for b, c in _byte_letters().items() if b != 0x20)
        return cls(told, type(tok)) if len(rest) == 1 and plain and covered else None

    def ids(self, words: list[str], dtype: np.dtype) -> tuple[np.ndarray, np.ndarray]:
        """Ids of these pretokens end to end, and how many each has."""
        text = " ".join(words)
        if not text.isascii():  # the byte-level alphabet, which printable ASCII is its own part of
            text = text.encode().decode("latin-1").translate(_byte_letters())
        ids = np.array(self.tok.encode_batch_fast([text], add_special_tokens=False)[0].ids, dtype)
        stops = np.flatnonzero(self.ends[ids]) + 1
        if len(stops) != len(words):
            raise ValueError("a pretoken isn't covered by the tokenizer's pieces")
        return ids, np.diff(stops, prepend=0)


@functools.lru_cache(1)
def _byte_letters() -> dict[int, str]:
    """The characters that stand for bytes at the byte level; a blank stays, as it parts the pretokens."""
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in own]
    return {b: chr(b) for b in own} | {b: chr(256 + i) for i, b in enumerate(others)} | {0x20: " "}


@functools.lru_cache(4)
def load_tokenizer(path: str):
    import os

    from tokenizers import Tokenizer

    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark runs the tasks side by side
    tok = Tokenizer.from_file(path)
    tok.no_truncation()
    tok.no_padding()
    return tok


#: Alternatives of a splitting pattern that match no white space: a literal, or a class without it, once or more.
_NO_SPACE = re.compile(r"[A-Za-z'0-9]+|\[(?:\\p\{[LN][a-z]?\})+\]\+?|\[\^\\s(?:\\p\{[LN][a-z]?\})*\]\+?")


def drops_white_space(tok) -> bool:
    """Whether a text's ids are those of its white-space words in lower case, end to end, as the tokenizer's file has it: letters
    composed, white space made one blank, letters lowered, and nothing kept but the matches of a pattern that has no white space."""
    told = json.loads(tok.to_str())
    steps = lambda entry, name: [] if entry is None else entry[name] if entry["type"] == "Sequence" else [entry]
    normal, split = steps(told["normalizer"], "normalizers"), steps(told["pre_tokenizer"], "pretokenizers")
    kinds = [x["type"] for x in normal]
    lowers = kinds in (["NFC", "Lowercase"], ["NFC", "Replace", "Lowercase"]) and all(x["pattern"] == {"Regex": "\\s+"} and x["content"] == " " for x in normal if x["type"] == "Replace")
    if not lowers or not split or split[0]["type"] != "Split" or told["post_processor"] is not None:
        return False
    parts = split[0]["behavior"] == "Removed" and split[0]["invert"] and all(_NO_SPACE.fullmatch(x) for x in split[0]["pattern"].get("Regex", " ").split("|"))
    alone = all(x["type"] == "ByteLevel" and not x["add_prefix_space"] and not x["use_regex"] for x in split[1:])
    return bool(parts and alone and not told["model"].get("dropout"))


@functools.lru_cache(4)
def _encoder(path: str, width: int) -> WordEncoder:
    return WordEncoder(path, np.dtype(f"<u{width}"))


# ---------------------------------------------------------------- minimal perfect hash


def key_hash(keys: np.ndarray, seed: int) -> np.ndarray:
    return mix(keys.astype(np.int64).view(np.uint64) + np.uint64((seed + 1) * 0x9E3779B97F4A7C15 % (1 << 64)))


def fingerprints(keys: np.ndarray) -> np.ndarray:
    return (key_hash(keys, 999) >> np.uint64(32)).astype(np.uint32)


def build_levels(keys: np.ndarray) -> list[np.ndarray]:
    """Bit sets, level by level: a key that alone hits a bit stays there, keys that collide go a level down."""
    levels, left = [], keys
    while len(left):
        bits = max(64, -(-2 * len(left) // 64) * 64)
        at = (key_hash(left, len(levels)) % np.uint64(bits)).astype(np.int64)
        alone = np.bincount(at, minlength=bits) == 1
        levels.append(np.packbits(alone, bitorder="little").view("<u8"))
        left = left[~alone[at]]
        if len(levels) > 500:
            raise ValueError("keys are not distinct")
    return levels


def rank_words(levels: list[np.ndarray]) -> np.ndarray:
    """For each 64-bit word of the levels, end to end, the number of set bits before it: stored beside them, so that opening
    an index counts nothing and a probe counts within one word."""
    words = np.concatenate([np.zeros(0, "<u8"), *levels])
    return (np.cumsum(np.bitwise_count(words), dtype=np.int64) - np.bitwise_count(words)).astype("<u4")


class PerfectHash:
    """Slots 0 to n - 1 of n distinct keys; other keys get a slot or -1, which the fingerprint then refutes."""

    def __init__(self, levels: list[np.ndarray], ranks: np.ndarray):
        self.levels, self.ranks = levels, ranks

    def slots(self, keys: np.ndarray) -> np.ndarray:
        out, open_, start = np.full(len(keys), -1, np.int64), np.arange(len(keys)), 0
        for level, words in enumerate(self.levels):
            if not len(open_):
                break
            at = key_hash(keys[open_], level) % np.uint64(64 * len(words))
            place, bit = (at >> np.uint64(6)).astype(np.int64), np.uint64(1) << (at & np.uint64(63))
            word = words[place]
            hit = (word & bit) != 0
            below = np.bitwise_count(word & (bit - np.uint64(1)))
            out[open_[hit]] = self.ranks[start + place[hit]].astype(np.int64) + below[hit]
            open_, start = open_[~hit], start + len(words)
        return out


# ---------------------------------------------------------------- one shard


def shard_trailer(keys: list, offsets: list[int], tokens: list[int], width: int, shard: int) -> tuple[bytes, bytes]:
    """Index block and footer of a shard whose records are in key order, null keys first."""
    n_null = sum(k is None for k in keys)
    own = np.array([0 if k is None else k for k in keys], "<i8")
    distinct, first, count = np.unique(own[n_null:], return_index=True, return_counts=True)
    levels = build_levels(distinct)
    ranks = rank_words(levels)
    slot = PerfectHash(levels, ranks).slots(distinct)
    table = np.zeros(len(distinct), np.dtype([("fingerprint", "<u4"), ("first", "<u4"), ("count", "<u4")]))
    table["fingerprint"][slot], table["first"][slot], table["count"][slot] = fingerprints(distinct), first + n_null, count
    index = b"".join(
        [own.tobytes(), np.array(offsets, "<u8").tobytes(), np.array(tokens, "<u4").tobytes(), struct.pack("<I", len(levels)), np.array([len(x) for x in levels], "<u4").tobytes(), *[x.tobytes() for x in levels], ranks.tobytes(), table.tobytes()]
    )
    at = offsets[-1] + tokens[-1] * width + width
    low, high = (int(distinct[0]), int(distinct[-1])) if len(distinct) else (0, -1)
    return index, FOOTER.pack(at, len(index), len(keys), len(distinct), n_null, sum(tokens), low, high, shard, width, MAGIC)


class Shard:
    """A shard file's bytes, opened by its footer."""

    def __init__(self, content):
        self.data = memoryview(content)
        for width in (2, 4):
            foot = FOOTER.unpack(self.data[len(self.data) - width - FOOTER.size : len(self.data) - width])
            if foot[-1] == MAGIC and foot[-2] == width:
                break
        else:
            raise ValueError("not a token shard")
        at, _, n, m, self.n_null, self.n_tokens, self.low, self.high, self.number, self.width, _ = foot
        take = lambda kind, count: self._take(kind, count)
        self._at = at
        self.keys, self.offsets, self.tokens = take("<i8", n), take("<u8", n).astype(np.int64), take("<u4", n).astype(np.int64)
        sizes = take("<u4", int(take("<u4", 1)[0]))
        self.hash = PerfectHash([take("<u8", int(s)) for s in sizes], take("<u4", int(sizes.sum())))
        self.slots = take([("fingerprint", "<u4"), ("first", "<u4"), ("count", "<u4")], m)

    def _take(self, kind, count: int) -> np.ndarray:
        kind = np.dtype(kind)
        out = np.frombuffer(self.data, kind, count, self._at)
        self._at += kind.itemsize * count
        return out

    def ids(self, record: int) -> np.ndarray:
        return np.frombuffer(self.data, f"<u{self.width}", int(self.tokens[record]), int(self.offsets[record]))

    def find(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """First record and number of records of each key (0 where it isn't here)."""
        if not len(self.slots):
            return np.zeros(len(keys), np.int64), np.zeros(len(keys), np.int64)
        slot = self.hash.slots(keys)
        row = self.slots[np.maximum(slot, 0)]
        here = (slot >= 0) & (row["fingerprint"] == fingerprints(keys)) & (keys >= self.low) & (keys <= self.high)
        here &= self.keys[np.minimum(row["first"], len(self.keys) - 1)] == keys  # a fingerprint may agree by chance
        return row["first"].astype(np.int64), np.where(here, row["count"], 0).astype(np.int64)


# ---------------------------------------------------------------- Spark


def write(docs: DataFrame, path: str, tokenizer: str, end_id: int, key: str = "doc_id") -> None:
    """Encode every text, append end_id, and write shards under path in ascending key order.

    One range shuffle of the texts; then each task streams its rows through the encoder into its file, holding
    only a batch and the index entries of one shard. The hash of the text and the row's place part a key
    that very many rows share, so that no key has to fit one shard.
    """
    spark = docs.sparkSession
    bound_batches(spark)
    width = 2 if max(load_tokenizer(tokenizer).get_vocab_size(), end_id + 1) <= 1 << 16 else 4
    end = end_id.to_bytes(width, "little")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, keys, offsets, tokens, at = _encoder(tokenizer, width), [], [], [], 0
        give = lambda rows: pa.RecordBatch.from_arrays([pa.array(rows, pa.binary())], ["row"])
        for batch in batches:
            rows = [ids + end for ids in encoder.encode([t or "" for t in batch.column("text").to_pylist()])]
            keys += batch.column("k").to_pylist()
            for row in rows:
                offsets.append(at)
                tokens.append(len(row) // width)
                at += len(row) + width
            for i in range(0, len(rows), 500):
                yield give(rows[i : i + 500])
        if keys:
            yield give(list(shard_trailer(keys, offsets, tokens, width, TaskContext.get().partitionId())))

    rows = fields(docs, key, "text").select(F.col(f"`{key}`").cast("long").alias("k"), F.col("text").cast("string"))
    order = ["k", F.xxhash64("text"), F.monotonically_increasing_id()]
    n = partitions_for(rows, SHARD_TEXT_BYTES)
    ranged = rows.repartitionByRange(n, *order).sortWithinPartitions("k", F.xxhash64("text"))
    (ranged.mapInArrow(tidy(run), "row binary").select(F.col("row").cast("string").alias("value"))
        .write.option("lineSep", "\0" * width).option("compression", "none").text(path))


def _files(spark: SparkSession, path: str) -> DataFrame:
    bound_batches(spark)
    return spark.read.format("binaryFile").load(path).where("length > 0").select("content")


def records(spark: SparkSession, path: str) -> DataFrame:
    """One row per record, read from the files through their index: key, shard, token count, crc32 of the ids as
    32-bit little-endian integers, first and last id, and the number of ids before it in its shard."""

    def run(batches):
        for batch in batches:
            for content in batch.column("content"):
                shard = Shard(content.as_buffer())
                first, count = shard.find(shard.keys[shard.n_null :])
                if not (count > 0).all():
                    raise ValueError("a key isn't in its shard's index")
                # nulls stand first; the others come by their own probe, repeated rows one after another
                nth = np.arange(shard.n_null, len(shard.keys)) - first
                order = np.r_[np.arange(shard.n_null), first + nth].astype(np.int64)
                before = np.r_[0, np.cumsum(shard.tokens)]
                for i in range(0, len(order), 5000):
                    part = order[i : i + 5000]
                    ids = [shard.ids(r).astype("<u4") for r in part]
                    yield pa.RecordBatch.from_pydict({
                        "key": pa.array([None if r < shard.n_null else int(shard.keys[r]) for r in part], pa.int64()),
                        "shard": pa.array([shard.number] * len(part), pa.int32()),
                        "before": pa.array(before[part], pa.int64()),
                        "n_tokens": pa.array(shard.tokens[part], pa.int64()),
                        "ids_crc32": pa.array([zlib.crc32(x.data) for x in ids], pa.int64()),
                        "first_id": pa.array([int(x[0]) for x in ids], pa.int64()),
                        "last_id": pa.array([int(x[-1]) for x in ids], pa.int64()),
                    })

    return _files(spark, path).mapInArrow(tidy(run), "key long, shard int, before long, n_tokens long, ids_crc32 long, first_id long, last_id long")


def lookup(spark: SparkSession, path: str, keys: DataFrame, key: str = "doc_id") -> DataFrame:
    """Ids by key: (key, ids) for each record of each distinct key asked for; unknown keys give no row.

    Keys are sent to the shards whose range holds them (the shards' ranges are joined, not broadcast whole files),
    and each shard answers its own keys from its hash.
    """

    def ranges(batches):
        for batch in batches:
            for content in batch.column("content"):
                s = Shard(content.as_buffer())
                yield pa.RecordBatch.from_pydict({"shard": pa.array([s.number], pa.int32()), "low": pa.array([s.low], pa.int64()), "high": pa.array([s.high], pa.int64())})

    def numbered(batches):
        for batch in batches:
            for content in batch.column("content"):
                yield pa.RecordBatch.from_pydict({"shard": pa.array([Shard(content.as_buffer()).number], pa.int32()), "content": pa.array([content.as_py()], pa.large_binary())})

    def answer(group, files: pa.Table, asked: pa.Table) -> pa.Table:
        out_key, out_ids = [], []
        want = np.array(asked.column("key").to_pylist(), np.int64)
        for content in files.column("content"):
            shard = Shard(content.as_buffer())
            for k, first, count in zip(want, *shard.find(want), strict=True):
                for r in range(first, first + count):
                    out_key.append(int(k))
                    out_ids.append(shard.ids(r).astype(np.int64))
        return pa.table({"key": pa.array(out_key, pa.int64()), "ids": pa.array(out_ids, pa.list_(pa.int64()))})

    files = _files(spark, path)
    span = files.mapInArrow(tidy(ranges), "shard int, low long, high long")
    wanted = fields(keys, key).select(F.col(f"`{key}`").cast("long").alias("key")).where("key is not null").distinct()
    routed = wanted.join(span, (wanted.key >= span.low) & (wanted.key <= span.high)).select("shard", "key")
    return (files.mapInArrow(tidy(numbered), "shard int, content binary").groupBy("shard")
            .cogroup(routed.groupBy("shard")).applyInArrow(answer, "key long, ids array<long>"))


def with_starts(rows: DataFrame) -> DataFrame:
    """Add start: the number of ids in all records before. A window over one row a shard gives the shards' bases."""
    rows = cut(rows)
    totals = rows.groupBy("shard").agg(F.sum("n_tokens").alias("total"))
    base = totals.select("shard", (F.sum("total").over(Window.orderBy("shard")) - F.col("total")).alias("base"))
    return rows.join(base, "shard").withColumn("start", F.col("base") + F.col("before"))


def encode_and_read(docs: DataFrame, tokenizer: str, end_id: int = 2, path: str | None = None) -> DataFrame:
    """The contract's digest of what stands in the files: doc_id, start, n_tokens, ids_crc32, first_id, last_id."""
    spark = docs.sparkSession
    path = path or scratch_path(spark, "token-shards")
    write(docs, path, tokenizer, end_id)
    rows = with_starts(records(spark, path))
    return rows.select(F.col("key").alias("doc_id"), "start", "n_tokens", "ids_crc32", "first_id", "last_id")
