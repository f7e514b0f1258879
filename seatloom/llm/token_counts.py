"""Token counts by prefix dynamic programming over byte-level BPE (operator 10).

For every prefix of a pretoken the table holds BPE's last token and its exact number of tokens; the count at a
prefix is one more than the count where that token begins (``automaton.PrefixBpe``). Summed over a text's
pretokens this gives the count at every prefix of the text, so how long a text is in tokens, whether it passes a
limit and where it must be cut are read from the table without encoding anything again.

Texts are parted where the pretokeniser must part them: at single blanks between other characters. Each
distinct part is worked out once per worker (a bounded dictionary). Latin text is split into pretokens by
the tokenizer's published pattern; text with other characters by the library's own pretokeniser, so that no
difference in Unicode tables can show. The added special strings of the file count one token each, as the
library takes them by default.

Defined cases: null or empty text has 0 bytes and 0 tokens, limits hold, and the cut is 0. A text of one very
long pretoken costs time in proportion to its length. Repeated rows give equal rows; extra columns are not read.
"""

from __future__ import annotations

import functools
import json
import re
from array import array
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from seatloom.llm.automaton import PrefixBpe
from seatloom.llm.common import TwoGenerations, bound_batches, fields, tidy
from seatloom.llm.token_store import load_tokenizer

CACHE_WORDS = 400_000
_LETTER, _NUMBER = "A-Za-z\xaa\xb5\xba\xc0-\xd6\xd8-\xf6\xf8-ɏ", "0-9\xb2\xb3\xb9\xbc-\xbe"
#: Text for which the pattern below splits as the published one does, whatever the Unicode tables.
_LATIN = re.compile("[\\t\\n\\r\\x20-\\x7e\\xa1-\\xac\\xae-\\u024f]*")
_SPLIT = re.compile(f"'s|'t|'re|'ve|'m|'ll|'d| ?[{_LETTER}]+| ?[{_NUMBER}]+| ?[^\\s{_LETTER}{_NUMBER}]+|\\s+(?!\\S)|\\s+")
_SHORT = ("'re", "'ve", "'ll")  # a prefix of these splits otherwise than they do


def byte_letters() -> dict[int, str]:
    """The printable stand-in of each byte in byte-level vocabularies: itself, or the next code point from 256 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    other = [b for b in range(256) if b not in plain]
    return {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(other)}


class ByteBpe:
    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model, pre = spec["model"], spec["pre_tokenizer"]
        if model["type"] != "BPE" or pre["type"] != "ByteLevel" or pre["add_prefix_space"] or spec["normalizer"] or model.get("ignore_merges"):
            raise ValueError(f"not a plain byte-level BPE file: {path}")
        byte_of = {c: b for b, c in byte_letters().items()}
        raw = lambda s: bytes(byte_of[c] for c in s)
        vocab = {raw(t): i for t, i in model["vocab"].items() if all(c in byte_of for c in t)}
        pairs = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        self.rank = {(raw(a), raw(b)): i for i, (a, b) in enumerate(pairs)}
        self.bpe = PrefixBpe([(t, i) for t, i in vocab.items()], self._merge)
        self.library = load_tokenizer(path)
        added = [t["content"] for t in spec["added_tokens"]]
        self.special = re.compile("|".join(map(re.escape, sorted(added, key=len, reverse=True)))) if added else None
        self.added = set(added)
        self.words, self.pretokens = TwoGenerations(CACHE_WORDS), TwoGenerations(CACHE_WORDS)

    def _merge(self, text: bytes) -> list[bytes]:
        """BPE by its rule: merge the pair of lowest rank, leftmost first, until no pair has one."""
        symbols = [text[i : i + 1] for i in range(len(text))]
        while len(symbols) > 1:
            best = min((self.rank.get(p, 1 << 40), i) for i, p in enumerate(zip(symbols, symbols[1:], strict=False)))
            if best[0] == 1 << 40:
                break
            i = best[1]
            symbols[i : i + 2] = [symbols[i] + symbols[i + 1]]
        return symbols

    # -- pretokens

    def split(self, text: str) -> list[str]:
        """Pretokens of a stretch without special strings."""
        if _LATIN.fullmatch(text):
            return _SPLIT.findall(text)
        return [text[a:b] for _, (a, b) in self.library.pre_tokenizer.pre_tokenize_str(text)]

    def stretches(self, text: str) -> Iterator[tuple[str, bool]]:
        """(stretch, whether it is an added special string), end to end."""
        at = 0
        for m in self.special.finditer(text) if self.special else ():
            if m.start() > at:
                yield text[at : m.start()], False
            yield m.group(), True
            at = m.end()
        if at < len(text):
            yield text[at:], False

    def parts(self, text: str) -> list[str]:
        """Parts that split into pretokens alike alone or in the text: words with the single blank before them."""
        out: list[str] = []
        for stretch, special in self.stretches(text):
            if special:
                out.append(stretch)
                continue
            words = stretch.split(" ")
            if "" in words or "\n " in stretch or " \n" in stretch or not _LATIN.fullmatch(stretch) or re.search("[\\t\\r] | [\\t\\r]", stretch):
                out += self.split(stretch)
            else:
                out.append(words[0])
                out += [" " + w for w in words[1:]]
        return out

    # -- counts

    def pretoken_counts(self, pretoken: str) -> Sequence[int]:
        """The stored counts at the byte prefixes of a pretoken, from the empty one on."""
        got = self.pretokens.new.get(pretoken)
        if got is None:
            counts = self.bpe.run(pretoken.encode())[1]
            got = self.pretokens.new[pretoken] = bytes(counts) if max(counts) < 256 else array("q", counts)
        return got

    def pretoken_count(self, pretoken: str) -> int:
        return self.pretoken_counts(pretoken)[-1]

    def part_counts(self, lists: list[list[str]]) -> list[list[int]]:
        """Token counts of the parts of each text."""
        known, missing = self.words.take(set().union(*lists))
        fresh = {w: 1 if w in self.added else sum(map(self.pretoken_count, self.split(w))) for w in missing}
        self.words.new.update(fresh)
        known |= fresh
        get = known.__getitem__
        out = [list(map(get, ws)) for ws in lists]
        self.words.settle()
        self.pretokens.settle()
        return out

    def count(self, text: str) -> int:
        """Token count of a whole text."""
        return sum(self.part_counts([self.parts(text)])[0])

    def within(self, before: str, pretoken: str) -> list[int]:
        """Counts at the code-point prefixes 1 to len(pretoken), beyond those of what precedes it.

        before: the pretoken before it, if that is white space: the two are one run while only white space follows.
        """
        if pretoken in _SHORT:
            tail = self.pretoken_count(pretoken[1:-1])
            return [1, 1 + tail, self.pretoken_count(pretoken)]
        counts = self.pretoken_counts(pretoken)
        ends = np.cumsum([len(c.encode()) for c in pretoken])
        out = [counts[e] for e in ends]
        if before:
            for i, c in enumerate(pretoken):
                if not c.isspace():
                    break
                out[i] = self.pretoken_count(before + pretoken[: i + 1]) - self.pretoken_count(before)
        return out

    def prefix_counts(self, text: str) -> list[int]:
        """Exact token count of text[:i] for i = 0 to len(text)."""
        out = [0]
        for stretch, special in self.stretches(text):
            if special:  # its proper prefixes are ordinary text that joins what stands before
                begin = text[: len(out) - 1]
                out += [self.count(begin + stretch[:i]) for i in range(1, len(stretch))]
                out.append(self.count(begin) + 1)
                continue
            base, before = out[-1], ""
            for pretoken in self.split(stretch):
                out += [base + n for n in self.within(before, pretoken)]
                base += self.pretoken_count(pretoken)
                out[-1] = base if not pretoken.isspace() or not before else out[-1]
                before = pretoken if pretoken.isspace() else ""
        return out

    def cut(self, parts: list[str], counts: list[int], limit: int) -> int:
        """UTF-8 bytes of the longest prefix in which no part passes limit tokens, from the stored counts."""
        total = np.cumsum(counts)
        i = int(np.searchsorted(total, limit, "right"))
        kept = sum(len(p.encode()) for p in parts[:i])
        if i < len(parts) and parts[i] not in self.added:
            room = limit - (int(total[i - 1]) if i else 0)
            for pretoken in self.split(parts[i]):
                n = self.pretoken_count(pretoken)
                if n <= room:
                    room -= n
                    kept += len(pretoken.encode())
                    continue
                fit = [j for j, c in enumerate(self.within("", pretoken), 1) if c <= room]
                kept += len(pretoken[: max(fit, default=0)].encode())
                break
        return kept


@functools.lru_cache(4)
def load(path: str) -> ByteBpe:
    return ByteBpe(path)


def count_tokens(docs: DataFrame, tokenizer: str, limit: int = 1024) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit, kept_bytes (where the text is cut to fit the limit)."""
    bound_batches(docs.sparkSession)
    rows = fields(docs, "doc_id", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = load(tokenizer)
        for whole in batches:
            for i in range(0, len(whole), 500):
                batch = whole.slice(i, 500)
                texts = [t or "" for t in batch.column("text").to_pylist()]
                lists = [bpe.parts(t) for t in texts]
                counts = bpe.part_counts(lists)
                sizes = [len(t.encode()) for t in texts]
                totals = [sum(c) for c in counts]
                kept = [n if total <= limit else bpe.cut(p, c, limit) for n, total, p, c in zip(sizes, totals, lists, counts, strict=True)]
                yield pa.RecordBatch.from_pydict({
                    "doc_id": batch.column("doc_id"), "n_bytes": pa.array(sizes, pa.int64()), "n_tokens": pa.array(totals, pa.int64()),
                    "over_limit": pa.array([t > limit for t in totals], pa.bool_()), "kept_bytes": pa.array(kept, pa.int64()),
                })

    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(tidy(run), f"doc_id {kind}, n_bytes long, n_tokens long, over_limit boolean, kept_bytes long")


def prefix_counts(docs: DataFrame, tokenizer: str) -> DataFrame:
    """doc_id and counts: the token count of every code-point prefix, from the empty one to the whole text."""
    bound_batches(docs.sparkSession)
    rows = fields(docs, "doc_id", "text")

    def run(batches):
        bpe = load(tokenizer)
        for batch in batches:
            for i in range(len(batch)):
                one = batch.slice(i, 1)
                yield pa.RecordBatch.from_pydict({"doc_id": one.column("doc_id"), "counts": pa.array([bpe.prefix_counts(one.column("text")[0].as_py() or "")], pa.list_(pa.int32()))})

    return rows.mapInArrow(tidy(run), f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, counts array<int>")
