"""Shared pieces of the training-data operators: scratch space, Arrow batches, words as arrays.

Words are found on UTF-8 bytes with numpy, a bounded slice of a batch at a time, so that neither the
number of rows in a batch nor one very long text decides how much memory a task takes.
"""

from __future__ import annotations

import ctypes
import re
import threading
from collections import defaultdict
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from itertools import count, islice

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from seatloom.sources.files import scratch, shared_root

#: Bytes of text that are turned into arrays at a time (one longer text is taken alone).
SLICE_BYTES = 1 << 20
#: Arrow batches end at this many rows or bytes, whichever comes first.
BATCH_ROWS, BATCH_BYTES = 1000, 8 << 20


def scratch_path(spark: SparkSession, name: str) -> str:
    return scratch(spark, name)


class _Steps(threading.local):
    """Of each open step, the innermost last, the paths of the tables that were cut in it."""

    def __init__(self):
        self.open: list[list[str]] = []


_steps = _Steps()
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def cut(df: DataFrame) -> DataFrame:
    """Materialise in the shared checkpoint folder: computed once, and a lost executor costs no recompute. Inside a step()
    the table goes with the step."""
    shared_root(df.sparkSession)
    out = df.checkpoint(eager=True)
    if _steps.open:
        _steps.open[-1].append(_written_at(out))
    return out


def _written_at(table: DataFrame) -> str:
    """Where cut() has put a table."""
    return table._jdf.queryExecution().analyzed().rdd().getCheckpointFile().get()


def _delete(spark: SparkSession, path: str) -> None:
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


@contextmanager
def step(spark: SparkSession) -> Iterator[None]:
    """A part of a job that needs disk of its own: the tables cut in it are deleted at its end, but for those handed to keep();
    a query's shuffle files are deleted when it has run."""
    before = spark.conf.get(_CLEANUP, "false")
    spark.conf.set(_CLEANUP, "true")
    _steps.open.append([])
    try:
        yield
    finally:
        for path in _steps.open.pop():
            _delete(spark, path)
        spark.conf.set(_CLEANUP, before)


def keep(table: DataFrame) -> DataFrame:
    """A table that was cut in the innermost step belongs to the step around it (or to nobody) from now on."""
    path = _written_at(table)
    if _steps.open and path in _steps.open[-1]:
        _steps.open[-1].remove(path)
        if len(_steps.open) > 1:
            _steps.open[-2].append(path)
    return table


def drop(*tables: DataFrame) -> None:
    """Delete tables that were cut and that nothing will read again."""
    for table in tables:
        path = _written_at(table)
        for made in _steps.open:
            if path in made:
                made.remove(path)
        _delete(table.sparkSession, path)


def bound_batches(spark: SparkSession) -> None:
    """Keep Arrow batches small whatever the length of texts: the session's two settings are lowered to these bounds where
    they are above them (plans read them only when they run, so they can't be put back), and never raised."""
    for name, most in (("maxRecordsPerBatch", BATCH_ROWS), ("maxBytesPerBatch", BATCH_BYTES)):
        name = f"spark.sql.execution.arrow.{name}"
        now = _bytes(spark.conf.get(name))
        if not 0 < now <= most:
            spark.conf.set(name, str(most))


def _bytes(text: str) -> int:
    """A size setting as a number; 0 for one that isn't a plain number with a usual ending."""
    m = re.fullmatch(r"(\d+)([kmg]?)b?", text.strip().lower())
    return int(m[1]) << {"": 0, "k": 10, "m": 20, "g": 30}[m[2]] if m else 0


def tidy(run):
    """The same function over batches, which gives freed memory back when its task ends: Python workers are used again by
    later tasks, and what each keeps counts against its executor."""

    def tidied(batches):
        try:
            yield from run(batches)
        finally:
            pa.default_memory_pool().release_unused()
            trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # where the C library has it
            if trim:
                trim(0)

    return tidied


def partitions_for(df: DataFrame, target_bytes: int) -> int:
    """Partitions of about target_bytes each by Spark's own size estimate, at least the session's shuffle count."""
    spark = df.sparkSession
    estimate = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    least = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return max(least, -(-estimate // target_bytes)) if estimate < 1 << 60 else least


def fields(df: DataFrame, *names: str) -> DataFrame:
    """Only these columns, so that others (whatever their names) never reach an operator."""
    return df.select(*[F.col(f"`{n}`") for n in names])


def small_side(df: DataFrame, most: int = 1 << 17) -> DataFrame:
    """A materialised table of ids or digests, with the hint to broadcast it if it has at most `most` rows (some MB):
    the other side, which carries texts, then isn't shuffled. A larger table is joined by a shuffle."""
    return F.broadcast(df) if df.count() <= most else df


def text_digest(name: str = "text") -> Column:
    """A digest that tells texts apart; null for null."""
    return F.sha2(F.col(f"`{name}`").cast("string").cast("binary"), 256)


def text_or_empty(name: str = "text") -> Column:
    return F.coalesce(F.col(f"`{name}`").cast("string"), F.lit("")).alias("text")


# ---------------------------------------------------------------- words on bytes


def byte_table(word: str) -> np.ndarray:
    """256 entries: the lower-case byte where it belongs to a word, else a blank.

    "alnum": words are ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` after A-Z are lower-cased;
    "nonspace": words are ``[^\\x20\\x09-\\x0D]+`` after A-Z are lower-cased.
    All bytes from 0x80 on belong to words in both, so code points never split.
    """
    t = np.arange(256, dtype=np.uint8)
    t[0x41:0x5B] += 0x20
    blank = np.zeros(256, bool)
    if word == "alnum":
        blank[0x00:0x30] = blank[0x3A:0x41] = blank[0x5B:0x61] = blank[0x7B:0x80] = True
    else:
        blank[[0x20, *range(0x09, 0x0E)]] = True
    t[blank] = 0x20
    return t


ALNUM, NONSPACE = byte_table("alnum"), byte_table("nonspace")


def raw_bytes(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string column and the n + 1 places where its rows begin (null rows are empty)."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    if col.null_count:
        col = col.fill_null("")
    large = pa.types.is_large_string(col.type)
    _, at, data = col.buffers()
    offsets = np.frombuffer(at, np.int64 if large else np.int32)[col.offset : col.offset + len(col) + 1].astype(np.int64)
    whole = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return whole[offsets[0] : offsets[-1]], offsets - offsets[0]


class Words:
    """Words of consecutive texts: bytes (lower-cased), start and end of each, row of each, first word of each row."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, table: np.ndarray):
        self.raw, self.offsets = data, offsets
        self.bytes = table[data]
        word = self.bytes != 0x20
        begins, ends = word.copy(), word.copy()
        if len(word):
            begins[1:] &= ~word[:-1]
            ends[:-1] &= ~word[1:]
            cuts = offsets[1:-1][(offsets[1:-1] > 0) & (offsets[1:-1] < len(word))]
            begins[cuts] |= word[cuts]
            ends[cuts - 1] |= word[cuts - 1]
        self.start = np.flatnonzero(begins)
        self.end = np.flatnonzero(ends) + 1
        #: word numbers at which rows begin, n + 1 of them
        self.first = np.searchsorted(self.start, offsets)
        self.row = np.repeat(np.arange(len(offsets) - 1), np.diff(self.first))

    def __len__(self) -> int:
        return len(self.start)

    def text(self, i: int, j: int) -> bytes:
        """Words i to j - 1, joined by blanks."""
        return b" ".join(self.bytes[a:b].tobytes() for a, b in zip(self.start[i:j], self.end[i:j], strict=True))

    def hashes(self) -> np.ndarray:
        """A 64-bit hash of each word: a polynomial over its bytes by prefix sums, then mixed with its length."""
        out = np.empty(len(self), np.uint64)
        i = 0
        while i < len(self):
            j = max(i + 1, int(np.searchsorted(self.end, self.start[i] + SLICE_BYTES, "right")))
            base, stop = self.start[i], self.end[j - 1]
            power, inverse = _powers(int(stop - base))
            sums = np.zeros(stop - base + 1, np.uint64)
            np.cumsum((self.bytes[base:stop].astype(np.uint64) + np.uint64(1)) * power[: stop - base], out=sums[1:])
            a, b = self.start[i:j] - base, self.end[i:j] - base
            out[i:j] = mix((sums[b] - sums[a]) * inverse[a] + (b - a).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
            i = j
        return out


def slices(batch: pa.RecordBatch, column: str, table: np.ndarray) -> Iterator[tuple[int, int, Words]]:
    """(first row, row after the last, words) for runs of rows that hold about SLICE_BYTES of text."""
    data, offsets = raw_bytes(batch.column(column))
    i, n = 0, len(offsets) - 1
    while i < n:
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + SLICE_BYTES, "right")) - 1)
        j = min(j, n)
        yield i, j, Words(data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i], table)
        i = j


def mix(x: np.ndarray) -> np.ndarray:
    """The splitmix64 finaliser."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_BASE = 0x5851F42D4C957F2D
_tables: dict[str, np.ndarray] = {}


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """_BASE and its inverse modulo 2^64, to the powers 0 to n (made once for a slice, anew for a longer word)."""
    if len(_tables.get("up", ())) > n:
        return _tables["up"], _tables["down"]
    made = [np.cumprod(np.r_[np.uint64(1), np.full(max(n, SLICE_BYTES), b, np.uint64)], dtype=np.uint64) for b in (_BASE, pow(_BASE, -1, 1 << 64))]
    if n <= SLICE_BYTES:
        _tables["up"], _tables["down"] = made
    return made[0], made[1]


def windows(values: np.ndarray, first: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash and start of every run of k values that stays inside its row."""
    n = len(values)
    if n < k:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    h = np.zeros(n - k + 1, np.uint64)
    factor = 1
    for i in range(k):
        factor = factor * 0xD1342543DE82EF95 % (1 << 64)
        h += values[i : n - k + 1 + i] * np.uint64(factor)
    last = np.repeat(first[1:], np.diff(first))  # of each value: the value after its row
    at = np.flatnonzero(np.arange(n - k + 1) + k <= last[: n - k + 1])
    return mix(h[at]), at


class TwoGenerations:
    """A bounded dictionary: the older half is forgotten when the newer is full."""

    def __init__(self, limit: int):
        self.limit, self.new, self.old = limit, {}, {}

    def settle(self) -> None:
        if len(self.new) >= self.limit:
            self.old, self.new = self.new, {}

    def take(self, keys: set) -> tuple[dict, list]:
        """What is known of keys, and which keys are missing."""
        new, old = self.new, self.old
        known = {k: new[k] for k in keys if k in new}
        missing = [k for k in keys if k not in known]
        if old and missing:
            found = {k: old[k] for k in missing if k in old}
            if found:
                new.update(found)
                known.update(found)
                missing = [k for k in missing if k not in found]
        return known, missing


class IdTable:
    """Ids of strings. Each distinct string is numbered when it is met first, and its ids are made then and kept in an array;
    all are forgotten when they are too many. make(strings) -> (ids end to end, how many of each)."""

    def __init__(self, make: Callable[[list[str]], tuple[np.ndarray, np.ndarray]], dtype: np.dtype, most: int):
        self.make, self.dtype, self.most = make, dtype, most
        self.clear()

    def clear(self) -> None:
        self.number: dict[str, int] = defaultdict(count().__next__)
        self.ids, self.at = np.zeros(0, self.dtype), np.zeros(1, np.int64)

    def take(self, strings: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of these strings end to end, and how many each has."""
        if len(self.number) >= self.most:
            self.clear()
        known = len(self.number)
        n = np.fromiter(map(self.number.__getitem__, strings), np.int64, len(strings))
        if len(self.number) > known:
            ids, sizes = self.make(list(islice(reversed(self.number), len(self.number) - known))[::-1])
            self.ids, self.at = np.concatenate([self.ids, ids]), np.concatenate([self.at, self.at[-1] + np.cumsum(sizes)])
        begin, sizes = self.at[n], self.at[n + 1] - self.at[n]
        done = np.cumsum(sizes)
        return self.ids[np.repeat(begin - done + sizes, sizes) + np.arange(done[-1] if len(done) else 0)], sizes


def sums(values: np.ndarray, sizes: list[int]) -> np.ndarray:
    """Sums of consecutive groups of these sizes."""
    before, at = np.concatenate([[0], np.cumsum(values)]), np.concatenate([[0], np.cumsum(sizes, dtype=np.int64)])
    return before[at[1:]] - before[at[:-1]]
