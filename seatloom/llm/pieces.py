"""SentencePiece encoding and decoding: one pass of a Viterbi over an Aho-Corasick automaton (operator 3).

At each position of a text the automaton's output links give the pieces that end there, longest first, and the
best way to this position is relaxed over them. What "best" means is the model file's own kind:

* a unigram model: the highest sum of piece scores, as in the library's lattice search (ties: the longest last piece);
  the library's fast encoder sometimes ends with a lower sum;
* a BPE model: the sum of its scores (merge ranks, negated) is not what BPE maximises, and a plain Viterbi over it
  gives other ids than the library for most texts. So the relaxation keeps, of the pieces that end here, the one
  that BPE leaves apart from the last piece before it (``automaton.PrefixBpe``); there is exactly one.

White space is a piece character; no piece holds one after another character
(checked at load), so words between blanks decode on their own and each distinct word is encoded once. Inside a
word the text is also cut wherever no piece has the two characters side by side.

Defined cases: null or empty text gives no ids and decodes to ''. The character U+2581 stands for a blank in the
vocabulary and so decodes as one, as in the library; round_trip is then false. Characters outside the vocabulary
become byte pieces if the model has them, else its unknown id. Repeated rows give equal rows; extra columns
are not read.
"""

from __future__ import annotations

import functools
import re
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from seatloom.llm.automaton import AhoCorasick, PrefixBpe
from seatloom.llm.common import IdTable, bound_batches, fields, sums, tidy

BLANK = "▁"
NORMAL, UNKNOWN, CONTROL, BYTE = 1, 2, 3, 6  # piece types of the model format
UNIGRAM, BPE = 1, 2  # model types
UNKNOWN_PENALTY = 10.0
#: Words and their stretches that are remembered. A stretch not remembered costs a pass, a word only its cutting.
CACHE_WORDS, CACHE_PARTS = 120_000, 350_000


class Pieces:
    def __init__(self, path: str, kind: int | None = None):
        from sentencepiece import sentencepiece_model_pb2

        model = sentencepiece_model_pb2.ModelProto()
        with open(path, "rb") as f:
            model.ParseFromString(f.read())
        self.kind = kind or model.trainer_spec.model_type
        norm = model.normalizer_spec
        types = {p.type for p in model.pieces}
        if self.kind not in (UNIGRAM, BPE) or types - {NORMAL, UNKNOWN, CONTROL, BYTE} or norm.precompiled_charsmap or norm.remove_extra_whitespaces:
            raise ValueError(f"this model's kind, pieces or normaliser aren't handled: {path}")
        self.prefix = norm.add_dummy_prefix
        self.surface = [p.piece for p in model.pieces]
        self.unknown = next(i for i, p in enumerate(model.pieces) if p.type == UNKNOWN)
        self.unknown_surface = model.trainer_spec.unk_surface
        byte_ids = {int(p.piece[3:5], 16): i for i, p in enumerate(model.pieces) if p.type == BYTE}
        self.byte_ids = [byte_ids[b] for b in range(256)] if len(byte_ids) == 256 else None
        self.byte_of = {i: b for b, i in byte_ids.items()}
        self.hidden = {i for i, p in enumerate(model.pieces) if p.type == CONTROL}
        self.score = {i: p.score for i, p in enumerate(model.pieces) if p.type == NORMAL}
        own = [(p.piece, i) for i, p in enumerate(model.pieces) if p.type == NORMAL]
        self.joined = {pair for p, _ in own for pair in zip(p, p[1:], strict=False)}
        if any(j[1] == BLANK and j[0] != BLANK for j in self.joined):
            raise ValueError("a piece has a blank after another character")
        self.rank = {p: self.score[i] for p, i in own}
        self.bpe = PrefixBpe(own, self._merge) if self.kind == BPE else None
        self.automaton = AhoCorasick(own) if self.kind == UNIGRAM else None
        self.lone = {p for p, _ in own if len(p) == 1}
        self.unknown_score = min(self.score.values()) - UNKNOWN_PENALTY
        self.words, self.parts = IdTable(self._of_words, np.dtype("<i4"), CACHE_WORDS), IdTable(self._of_parts, np.dtype("<i4"), CACHE_PARTS)
        self.shown = [s.replace(BLANK, " ") for s in self.surface]
        self.special = np.zeros(len(self.surface), bool)  # ids that don't decode to their surface
        self.special[[self.unknown, *self.byte_of, *self.hidden]] = True

    def _merge(self, text: str) -> list[str]:
        """BPE by its rule: merge the best-scored neighbours, leftmost first, until none make a piece."""
        symbols = list(text)
        while len(symbols) > 1:
            best = max(((self.rank.get(a + b, -np.inf), -i) for i, (a, b) in enumerate(zip(symbols, symbols[1:], strict=False))))
            if best[0] == -np.inf:
                break
            i = -best[1]
            symbols[i : i + 2] = [symbols[i] + symbols[i + 1]]
        return symbols

    # -- one pass over a stretch of text that no piece leaves

    def _viterbi(self, text: str) -> list[tuple[int, int]]:
        """(start, piece or -1) of the best path by summed scores."""
        best, back = [0.0], [(0, -1)]
        node = 0
        for e, c in enumerate(text, 1):
            node = self.automaton.step(node, c)
            top, at = -np.inf, (e - 1, -1)
            for length, piece in self.automaton.outputs(node):
                s = best[e - length] + self.score[piece]
                if s > top:
                    top, at = s, (e - length, piece)
            if c not in self.lone and best[e - 1] + self.unknown_score > top:
                top, at = best[e - 1] + self.unknown_score, (e - 1, -1)
            best.append(top)
            back.append(at)
        path, e = [], len(text)
        while e:
            path.append(back[e])
            e = back[e][0]
        return path[::-1]

    def _ids(self, text: str, tokens: list[int] | None) -> list[int]:
        """Ids of a stretch, for a BPE model from its tokens."""
        if self.kind == UNIGRAM:
            found = self._viterbi(text)
        else:
            if -1 not in tokens:
                return tokens
            found, at = [], 0
            for p in tokens:
                found.append((at, p))
                at += len(self.surface[p]) if p != -1 else 1
        ids: list[int] = []
        unknown_run = False
        for s, p in found:
            if p != -1:
                ids.append(p)
            elif self.byte_ids:
                ids += [self.byte_ids[b] for b in text[s].encode()]
            elif not unknown_run:  # the library makes one unknown of neighbours
                ids.append(self.unknown)
            unknown_run = p == -1
        return ids

    def _of_parts(self, parts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of stretches end to end and how many each has. In order, stretches share the pass over what they begin with."""
        order = sorted(range(len(parts)), key=parts.__getitem__)
        tokens = self.bpe.tokens_of_sorted([parts[i] for i in order]) if self.kind == BPE else [None] * len(parts)
        made: list[list[int]] = [[]] * len(parts)
        for i, t in zip(order, tokens, strict=True):
            made[i] = self._ids(parts[i], t)
        return np.array(list(chain.from_iterable(made)), "<i4"), np.array(list(map(len, made)), np.int64)

    def _of_words(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        cuts = list(map(self._cuts, words))
        ids, sizes = self.parts.take(list(chain.from_iterable(cuts)))
        return ids, sums(sizes, list(map(len, cuts)))

    def _cuts(self, word: str) -> list[str]:
        """The stretches of a word between characters that stand side by side in no piece."""
        joined = self.joined
        if not self.byte_ids or joined.issuperset(zip(word, word[1:], strict=False)):
            return [word]  # without byte pieces, neighbours outside the vocabulary must stay together
        at = [0, *[i for i, pair in enumerate(zip(word, word[1:], strict=False), 1) if pair not in joined], len(word)]
        return [word[a:b] for a, b in zip(at, at[1:], strict=False)]

    _CHUNK = re.compile(f"{BLANK}+[^{BLANK}]*|[^{BLANK}]+")

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each text as little-endian 32-bit integers."""
        lists = []
        for t in texts:
            if not t:
                lists.append([])
                continue
            if self.prefix:
                t = " " + t
            if "  " in t or BLANK in t or t[0] != " " or t[-1] == " ":
                lists.append(self._CHUNK.findall(t.replace(" ", BLANK)))
            else:  # single blanks only: each word has one before it
                lists.append([BLANK + w for w in t[1:].split(" ")])
        ids, sizes = self.words.take(list(chain.from_iterable(lists)))
        stops = (np.cumsum(sums(sizes, list(map(len, lists)))) * 4).tolist()
        data = ids.tobytes()
        return [data[a:b] for a, b in zip([0, *stops], stops, strict=False)]

    def decode(self, ids: np.ndarray) -> str:
        """Text of ids: pieces end to end, runs of byte pieces as UTF-8, blanks for their mark."""
        text, byte_of, surface = [], self.byte_of, self.shown
        if not self.special[ids].any():
            out = "".join(map(surface.__getitem__, ids.tolist()))
            return out[1:] if self.prefix and out.startswith(" ") else out
        run = bytearray()
        for i in ids.tolist():
            if i in byte_of:
                run.append(byte_of[i])
                continue
            if run:
                text.append(run.decode("utf-8", "replace"))
                run.clear()
            if i == self.unknown:
                text.append(self.unknown_surface)
            elif i not in self.hidden:
                text.append(surface[i])
        if run:
            text.append(run.decode("utf-8", "replace"))
        out = "".join(text).replace(BLANK, " ")
        return out[1:] if self.prefix and out.startswith(" ") else out


@functools.lru_cache(4)
def load(path: str, kind: int | None = None) -> Pieces:
    return Pieces(path, kind)


def encode(docs: DataFrame, model: str, *, keep: tuple[str, ...] = (), kind: int | None = None) -> DataFrame:
    """doc_id, the columns of keep, n_ids, ids (array of int) and round_trip (the ids decode to the text)."""
    bound_batches(docs.sparkSession)
    rows = fields(docs, *dict.fromkeys(("doc_id", "text", *keep)))
    kept = [f for f in rows.schema.fields if f.name in ("doc_id", *keep)]
    out_schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept) + ", n_ids long, ids array<int>, round_trip boolean"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = load(model, kind)
        for whole in batches:
            for i in range(0, len(whole), 200):
                batch = whole.slice(i, 200)
                texts = [t or "" for t in batch.column("text").to_pylist()]
                ids = [np.frombuffer(b, "<i4") for b in pieces.encode(texts)]
                sizes = np.array([len(x) for x in ids], np.int64)
                values = np.concatenate(ids) if ids else np.zeros(0, np.int32)
                lists = pa.ListArray.from_arrays(pa.array(np.r_[0, np.cumsum(sizes)], pa.int32()), pa.array(values, pa.int32()))
                same = pa.array([pieces.decode(x) == t for x, t in zip(ids, texts, strict=True)])
                yield pa.RecordBatch.from_arrays([*[batch.column(f.name) for f in kept], pa.array(sizes), lists, same], [*[f.name for f in kept], "n_ids", "ids", "round_trip"])

    return rows.mapInArrow(tidy(run), out_schema)


def decode(encoded: DataFrame, model: str) -> DataFrame:
    """doc_id and text of rows with ids (null ids: empty text)."""
    bound_batches(encoded.sparkSession)

    def run(batches):
        pieces = load(model)
        for batch in batches:
            texts = [pieces.decode(np.array(x or [], np.int64)) for x in batch.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(texts, pa.string())], ["doc_id", "text"])

    rows = fields(encoded, "doc_id", "ids")
    return rows.mapInArrow(tidy(run), f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, text string")
