"""Periodic runs in the words of documents by comparing them with themselves at every lag (operator 13).

A run is a stretch of consecutive words with smallest period q (words q apart are identical) and at least
max(LEAST, EXPONENT * q) words that no neighbouring word extends keeping period q. A run of period q is a stretch of
places at which the words and the words q on are equal, so every lag up to n / EXPONENT is looked at.

* A task takes the documents of a slice of its batch as one array of word numbers (numbered by document, so that no
  two documents share one), longest first; at each lag only the documents that are long enough take part.
* At lag q a stretch needs max(LEAST - q, (EXPONENT - 1) * q) equal places. The comparison is made at every fourth part of
  that length first: a stretch that is long enough holds four such places in a row. Where four agree, the words between
  them and around them are compared one by one, and their true stretches run-length coded. So a lag costs no more than
  its documents' words over q, and all lags of n words together about n * log(n).
* A stretch at lag q whose words also have a period p < q has gcd(p, q) as one (it is longer than p + q), so it is tried at
  the lags q / r for the primes r that divide q, and dropped if one fits. In long repetitions of a short period most
  stretches are told by the periods up to SHORT without that trial.
* Documents of more than LONG bytes are taken apart by ranges of lags, each a row of its own, dealt to the machines; ranges
  are of like cost. Their runs meet again by document. All other documents stay where they are read.

Words are compared by 64-bit hashes. Defined cases: null or empty text has no words and no runs; equal rows are
documents of their own with equal results; ties for the strongest run go to the smaller start, then period. An empty
table gives no rows. Extra columns are not read, whatever their names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from seatloom.llm.common import SLICE_BYTES, Words, bound_batches, fields, raw_bytes, tidy

LEAST, EXPONENT = 24, 3
#: Lags whose runs tell which stretches at longer lags have a shorter period.
SHORT = 64
#: Texts of more bytes are taken apart by ranges of lags; in each, so many lags at least, and what they compare.
LONG, LAGS, COMPARED = 1 << 20, 1 << 14, 1 << 24
WORD = "[^\\x20\\x09-\\x0D]+"

RAW = np.arange(256, dtype=np.uint8)
RAW[0x09:0x0E] = 0x20
_RUNS = "array<struct<start:bigint,length:bigint,period:bigint>>"


# ---------------------------------------------------------------- the scan


def _true_stretches(flags: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Begins and ends of the stretches of true."""
    edges = np.flatnonzero(np.diff(np.r_[False, flags, False].view(np.int8)))
    return edges[::2], edges[1::2]


def _primes(q: int) -> list[int]:
    out, r = [], 2
    while r * r <= q:
        if q % r == 0:
            out.append(r)
            while q % r == 0:
                q //= r
        r += 1
    return [*out, q] if q > 1 else out


class Lags:
    """Runs of a sequence of word numbers (in which documents share none), lag by lag."""

    def __init__(self, words: np.ndarray):
        self.words = words
        #: (begin, end, period) of runs of short periods, by period
        self.short: dict[int, tuple[np.ndarray, np.ndarray]] = {}

    def at(self, q: int, n: int) -> list[tuple[int, int, int]]:
        """(begin, end, q): the runs of period q in the first n words."""
        need = max(LEAST - q, (EXPONENT - 1) * q)
        x = self.words
        if n - q < need:
            return []
        step = max(1, need // 4)
        same = x[0 : n - q : step] == x[q:n:step]
        four = same[:-3] & same[1:-2] & same[2:-1] & same[3:]
        if not four.any():
            return []
        # neighbouring fours are one region; a stretch that holds it ends within a step of it
        begins, ends = _true_stretches(four)
        out = []
        for i, j in zip(begins.tolist(), ends.tolist(), strict=True):
            if self._known(i * step, (j + 2) * step, q):
                continue
            low, high = max(0, (i - 1) * step), min(n - q, (j + 3) * step)
            a, b = _true_stretches(x[low:high] == x[low + q : high + q])
            for s, e in zip((a + low).tolist(), (b + low).tolist(), strict=True):
                if e - s >= need and not self._shorter(s, e + q, q):
                    out.append((s, e + q, q))
        return out

    def _known(self, low: int, high: int, q: int) -> bool:
        """Whether equal places low to high lie in a run of a short period that divides q: then that is their period."""
        for p, (begin, end) in self.short.items():
            if p < q and q % p == 0:
                k = int(np.searchsorted(begin, low, "right")) - 1
                if k >= 0 and high + q < end[k]:
                    return True
        return False

    def _shorter(self, s: int, e: int, q: int) -> bool:
        """Whether words s to e, of period q, have a shorter one, which then divides q."""
        return any(np.array_equal(self.words[s : e - q // r], self.words[s + q // r : e]) for r in _primes(q))

    def runs(self, sizes: np.ndarray, low: int, high: int) -> list[tuple[int, int, int]]:
        """Runs of the periods low to high - 1. sizes: words of each document, longest first."""
        total, out = np.cumsum(sizes), []
        top = int(sizes[0]) // EXPONENT if len(sizes) else 0
        for q in [*range(1, min(SHORT, top) + 1), *range(max(low, SHORT + 1), min(high, top + 1))]:
            long_enough = int(np.searchsorted(-sizes, -max(LEAST, EXPONENT * q), "right"))
            if not long_enough:
                break
            found = self.at(q, int(total[long_enough - 1]))
            if q <= SHORT and found:
                self.short[q] = (np.array([s for s, _, _ in found]), np.array([e for _, e, _ in found]))
            if low <= q < high:
                out += found
        return out


def runs_of(words: Words, low: int = 1, high: int = 1 << 62) -> list[list[tuple[int, int, int]]]:
    """For each row its runs (start, length, period) of the periods low to high - 1, in order of start, then period."""
    sizes = np.diff(words.first)
    order = np.argsort(-sizes, kind="stable")
    kept = order[sizes[order] >= LEAST]
    out: list[list[tuple[int, int, int]]] = [[] for _ in sizes]
    if not len(kept):
        return out
    hashes = words.hashes()
    joined = np.concatenate([hashes[words.first[r] : words.first[r + 1]] for r in kept])
    owner = np.repeat(np.arange(len(kept)), sizes[kept])
    # numbers that tell words of one document apart, and documents
    _, kinds = np.unique(joined, return_inverse=True)
    _, numbers = np.unique(owner * (int(kinds.max()) + 1) + kinds, return_inverse=True)
    begin = np.r_[0, np.cumsum(sizes[kept])]
    for s, e, q in Lags(numbers.astype(np.int32)).runs(sizes[kept], low, high):
        d = int(owner[s])
        out[kept[d]].append((s - int(begin[d]), e - s, q))
    for found in out:
        found.sort(key=lambda x: (x[0], x[2]))
    return out


def kept_words(n: int, runs: list[tuple[int, int, int]]) -> np.ndarray:
    """Which of n words stay: not those after the first period of a run."""
    change = np.zeros(n + 1, np.int64)
    for start, length, period in runs:
        change[start + period] += 1
        change[start + length] -= 1
    return np.cumsum(change[:-1]) == 0


# ---------------------------------------------------------------- tables


def _named(docs: DataFrame) -> DataFrame:
    return fields(docs, "doc_id", "text").select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))


def _slices(texts: pa.Array) -> Iterator[tuple[int, int, Words]]:
    """Runs of rows of about SLICE_BYTES of text, their words in their own letters."""
    data, offsets = raw_bytes(texts)
    i, n = 0, len(offsets) - 1
    while i < n:
        j = min(n, max(i + 1, int(np.searchsorted(offsets, offsets[i] + SLICE_BYTES, "right")) - 1))
        yield i, j, Words(data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i], RAW)
        i = j


def _run_lists(found: list[list[tuple[int, int, int]]]) -> pa.Array:
    flat = [x for row in found for x in row]
    columns = list(zip(*flat, strict=True)) or [(), (), ()]
    runs = pa.StructArray.from_arrays([pa.array(c, pa.int64()) for c in columns], ["start", "length", "period"])
    return pa.ListArray.from_arrays(pa.array(np.r_[0, np.cumsum([len(x) for x in found])], pa.int32()), runs)


def _collapsed(words: Words, r: int, runs: list[tuple[int, int, int]]) -> str:
    keep = np.flatnonzero(kept_words(int(words.first[r + 1] - words.first[r]), runs)) + words.first[r]
    return b" ".join(words.bytes[a:b].tobytes() for a, b in zip(words.start[keep].tolist(), words.end[keep].tolist(), strict=True)).decode()


def lag_ranges(n_bytes: Column) -> Column:
    """An array of (low, high): the lags that a text of so many bytes may have runs at, in ranges of like cost. Ranges end at
    LAGS lags, or where their comparisons (four times the words over the lag, each) come to COMPARED."""
    words = n_bytes / 2 + 1
    # lags from a to b compare about 2 * words * log(b / a); the first ranges are short, later ones LAGS long
    factor = F.exp(F.least(F.lit(float(COMPARED)) / (2 * words), F.lit(20.0)))
    turn = F.least(F.greatest(F.ceil(F.lit(LAGS) / (factor - 1)), F.lit(1)), words.cast("long"))
    steps = F.greatest(F.ceil(F.log(turn.cast("double")) / F.log(factor)), F.lit(0)).cast("int")
    early = F.transform(F.sequence(F.lit(0), steps), lambda k: F.ceil(F.pow(factor, k)).cast("long"))
    late = F.sequence(turn.cast("long"), F.greatest((words / EXPONENT).cast("long") + LAGS, turn.cast("long") + LAGS), F.lit(LAGS).cast("long"))
    ends = F.array_sort(F.array_distinct(F.concat(F.filter(early, lambda e: e <= turn), late)))
    return F.zip_with(F.slice(ends, F.lit(1), F.size(ends) - 1), F.slice(ends, F.lit(2), F.size(ends) - 1), lambda a, b: F.struct(a.alias("low"), b.alias("high")))


def periodic_runs(docs: DataFrame) -> DataFrame:
    """doc_id, n_words, runs (start, length, period; in order of start, then period) and collapsed: the words that stay when a
    run's words after its first period go, joined by blanks. A row for each of docs."""
    bound_batches(docs.sparkSession)
    rows = _named(docs)
    size = F.octet_length("text")

    def told(ids: pa.Array, found: list, words: Words) -> pa.RecordBatch:
        texts = [_collapsed(words, r, runs) for r, runs in enumerate(found)]
        return pa.RecordBatch.from_arrays([ids, pa.array(np.diff(words.first)), _run_lists(found), pa.array(texts, pa.string())], ["doc_id", "n_words", "runs", "collapsed"])

    def short(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, j, words in _slices(batch.column("text")):
                yield told(batch.column("doc_id").slice(i, j - i), runs_of(words), words)

    def ranged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lows, highs = batch.column("low").to_pylist(), batch.column("high").to_pylist()
            for r in range(len(batch)):
                (_, _, words), = _slices(batch.column("text").slice(r, 1))
                yield pa.RecordBatch.from_arrays([batch.column("digest").slice(r, 1), _run_lists(runs_of(words, lows[r], highs[r]))], ["digest", "runs"])

    def collapsed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r, runs in enumerate(batch.column("runs").to_pylist()):
                (_, _, words), = _slices(batch.column("text").slice(r, 1))
                yield told(batch.column("doc_id").slice(r, 1), [[(x["start"], x["length"], x["period"]) for x in runs or ()]], words)

    schema = f"doc_id long, n_words long, runs {_RUNS}, collapsed string"
    few = rows.where(size <= LONG).mapInArrow(tidy(short), schema)
    # long texts: a row for each text and range of lags, dealt out; equal texts have equal runs
    long = rows.where(size > LONG).withColumn("digest", F.sha2(F.col("text").cast("binary"), 256))
    ranges = long.select("digest", "text", F.explode(lag_ranges(size)).alias("lags")).select("digest", "text", "lags.low", "lags.high").dropDuplicates(["digest", "low"])
    found = ranges.repartition("digest", "low").mapInArrow(tidy(ranged), f"digest string, runs {_RUNS}")
    found = found.groupBy("digest").agg(F.array_sort(F.flatten(F.collect_list("runs")), lambda a, b: F.when(a["start"] != b["start"], F.signum(a["start"] - b["start"])).otherwise(F.signum(a["period"] - b["period"])).cast("int")).alias("runs"))
    return few.union(long.join(found, "digest", "left").select("doc_id", "text", "runs").mapInArrow(tidy(collapsed), schema))


# ---------------------------------------------------------------- the query's repetitions and digest


def repeat_words(docs: DataFrame) -> DataFrame:
    """docs (doc_id, text) with the words of every tenth document (by a checksum h of its number) made periodic: with n words
    and g = h / 10, from word a = g % n on, with period 1 + (n - a) / (3 + g % 8). Other texts stay as they are."""
    h = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary"))
    rows = _named(docs).withColumn("h", h)
    picked = (F.col("h") % 10 == 0) & F.col("doc_id").isNotNull()
    rows = rows.withColumn("w", F.when(picked, F.regexp_extract_all("text", F.lit(WORD), F.lit(0))))
    n, g = F.size("w").cast("long"), F.floor(F.col("h") / 10)
    rows = rows.withColumns({"a": F.when(n > 0, g % n), "g": g})
    rows = rows.withColumn("p", 1 + F.floor((n - F.col("a")) / (3 + F.col("g") % 8)))
    a, p = F.col("a").cast("int"), F.col("p").cast("int")
    again = F.flatten(F.array_repeat(F.slice("w", a + 1, p), (4 + F.col("g") % 8).cast("int")))
    made = F.concat(F.slice("w", F.lit(1), a), F.slice(again, F.lit(1), F.size("w") - a))
    return rows.select("doc_id", F.when(F.size("w") > 0, F.array_join(made, " ")).otherwise(F.col("text")).alias("text"))


def digest_runs(docs: DataFrame) -> DataFrame:
    """The query: of documents with repeat_words() the number of runs, the strongest one (four nulls if there is none) and
    hashes of all runs and of the collapsed text."""
    rows = periodic_runs(repeat_words(docs))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            best, sums = [], []
            for runs in batch.column("runs").to_pylist():
                top = None
                for x in runs:
                    # exact comparison of length / period; the first of equals has the smaller start, then period
                    if top is None or x["length"] * top["period"] > top["length"] * x["period"]:
                        top = x
                best.append((top["start"], top["length"], top["period"], 1000 * top["length"] // top["period"]) if top else (None,) * 4)
                sums.append(hashlib.sha256("".join(f"{x['start']},{x['length']},{x['period']}\n" for x in runs).encode()).hexdigest())
            texts = [hashlib.sha256(x.encode()).hexdigest() for x in batch.column("collapsed").to_pylist()]
            counts = pa.array(np.diff(batch.column("runs").offsets.to_numpy()).astype(np.int64))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), counts, *[pa.array(c, pa.int64()) for c in (zip(*best, strict=True) if best else ([],) * 4)], pa.array(sums, pa.string()), pa.array(texts, pa.string())], ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"])

    return rows.mapInArrow(tidy(run), "doc_id long, n_runs long, start long, length long, period long, exponent_milli long, runs_sha256 string, collapsed_sha256 string")

