"""Deletion of repeated line runs by a suffix array over line-id sequences (operator 7).

The corpus is the sequence of its documents' lines, in doc_id order; no run leaves its document. A run of consecutive
lines with at least MIN_WORDS words together that also occurs earlier is a copy, and its lines are deleted; the first
occurrence stays. Lines are equal if their words are (A-Z as a-z, white space apart); lines without words are no
part of the sequence and stay.

1. Every line gets a position, a number that grows along the corpus and by one along a document. Only lines that occur
   twice or more go on. Their suffixes end before the next line that occurs once, and with their document.
2. Suffix array by distributed prefix doubling, four doublings a round: a suffix's rank is one more than the number of
   suffixes before it by their first 16^k lines. Ranks for 16^(k + 1) lines come from the sixteen ranks at a position and
   every 16^k lines on, which stand in its document: such keys are counted (pre-aggregated before they are shuffled), the
   counts summed up in order inside each old rank, in buckets, so that one line that a third of all documents hold is
   spread. The first two, four and eight ranks of a key give the classes of the doublings between. Suffixes whose rank is theirs
   alone, or that have ended, are settled and leave; the doubling ends when all have (``suffix_ranks``).
3. A class of suffixes that share their first n lines and no more is an interval of the array, n its longest common prefix.
   A suffix's deepest interval that it isn't the first place of is the longest run from there on that occurs earlier, and
   that interval's first place is the first copy. The doubling gives each suffix's deepest such class by 2^k lines; n is
   bisected from there, a bit at a time: a class splits by the ranks of the 2^j lines that come next. Of each part only the
   first place stays in the class itself, as it is nearer to the corpus' begin than the rest of its part and shares as
   much with anyone outside, so that rows don't multiply (``longest_copies``).
4. A run from a place is maximal if the one from the place before doesn't hold it; it can't be extended to either side and
   still be a copy. Maximal runs of MIN_WORDS words are told (``copied_runs``), and their lines deleted.

Defined cases: null text stays null with 0 lines; empty text has one line and nothing to delete. Rows equal in doc_id
and text are one document and are treated alike; null doc_ids come first in order. Extra columns are carried by
``dedup_lines`` untouched whatever their names; ``copied_runs`` doesn't read them. Of equal copies the one that comes first
is the first copy. An empty table gives no rows.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from seatloom.llm.common import NONSPACE, bound_batches, cut, fields, keep, mix, partitions_for, slices, step, tidy

MIN_WORDS = 5
#: Text bytes whose documents one partition numbers.
PART_BYTES = 64 << 20
#: Buckets in which the pairs of one old rank are summed up, and those of the first ranks.
SPREAD, FIRST_SPREAD = 64, 4096
#: Ranks that one round of the doubling puts together, a power of two, and the suffixes whose keys a task makes at a time.
WIDTH, KEYS = 16, 1 << 16
_LINES = "array<struct<line:int,words:int,h1:bigint,h2:bigint>>"


def text_key() -> Column:
    return F.xxhash64(F.col("text"), F.length("text")).alias("text_key")


def numbered(docs: DataFrame) -> DataFrame:
    """(doc, doc_id, text_key, lines): the lines with words of each distinct document, and the position of its first line.

    Positions count inside a partition of documents in order, above the partition's number; one stays free after each
    document, so that positions one apart are of one document. Materialised: texts are read once."""
    rows = fields(docs, "doc_id", "text").select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).where("text is not null")
    rows = rows.select("doc_id", text_key(), "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, j, words in slices(batch, "text", NONSPACE):
                breaks = np.flatnonzero(words.raw == 0x0A)
                line = np.searchsorted(breaks, words.start)  # of each word, over all rows of the slice
                base = np.searchsorted(breaks, words.offsets[:-1])  # breaks before each row
                new = np.ones(len(line), bool)
                new[1:] = (line[1:] != line[:-1]) | (words.row[1:] != words.row[:-1])
                begin = np.flatnonzero(new)  # first word of each line
                nth = np.arange(len(line)) - np.repeat(begin, np.diff(np.r_[begin, len(line)]))
                hashes, sums = words.hashes(), []
                for seed in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F):
                    mixed = mix(hashes ^ mix((nth.astype(np.uint64) + np.uint64(1)) * np.uint64(seed)))
                    sums.append(np.add.reduceat(mixed, begin).view(np.int64) if len(begin) else np.zeros(0, np.int64))
                row = words.row[begin]
                at = np.searchsorted(row, np.arange(j - i + 1))
                lines = pa.StructArray.from_arrays(
                    [pa.array((line[begin] - base[row]).astype(np.int32)), pa.array(np.diff(np.r_[begin, len(line)]).astype(np.int32)), *map(pa.array, sums)], ["line", "words", "h1", "h2"]
                )
                part = batch.slice(i, j - i)
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), part.column("text_key"), pa.ListArray.from_arrays(pa.array(at, pa.int32()), lines)], ["doc_id", "text_key", "lines"])

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at = TaskContext.get().partitionId() << 44
        for batch in batches:
            sizes = np.diff(batch.column("lines").offsets.to_numpy()).astype(np.int64) + 1
            yield pa.RecordBatch.from_arrays([pa.array(at + np.r_[0, np.cumsum(sizes)[:-1]]), *batch.columns], ["doc", "doc_id", "text_key", "lines"])
            at += int(sizes.sum())

    found = rows.mapInArrow(tidy(run), f"doc_id long, text_key long, lines {_LINES}").where("size(lines) > 0").dropDuplicates(["doc_id", "text_key"])
    ranged = found.repartitionByRange(partitions_for(rows, PART_BYTES), "doc_id", "text_key").sortWithinPartitions("doc_id", "text_key")
    return cut(ranged.mapInArrow(tidy(number), f"doc long, doc_id long, text_key long, lines {_LINES}"))


# ---------------------------------------------------------------- repeated lines and their first ranks


def _by_document(run: Callable[[pa.Table], Iterator[pa.RecordBatch]]):
    """A function over whole documents' rows as one over batches of rows in order of documents."""

    def go(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []  # the last document may go on in the next batch
        for batch in batches:
            if not len(batch):
                continue
            doc = batch.column("doc").to_numpy()
            if held and held[-1].column("doc")[-1].as_py() != doc[0]:
                yield from run(pa.Table.from_batches(held).combine_chunks())
                held = []
            last = int(np.flatnonzero(np.r_[True, doc[1:] != doc[:-1]])[-1])
            if last:
                yield from run(pa.Table.from_batches([*held, batch.slice(0, last)]).combine_chunks())
                held = []
            held.append(batch.slice(last))
        if held:
            yield from run(pa.Table.from_batches(held).combine_chunks())

    return tidy(go)


def _columns(table: pa.Table, *names: str) -> list[pa.Array]:
    return [table.column(n).chunk(0) for n in names]


def repeated_lines(owners: DataFrame) -> DataFrame:
    """(doc, pos, line, words, rank, first, more): the lines that occur twice or more, in `more` of a row from this one on, and
    where each one's like is first. Materialised."""
    lines = owners.select("doc", F.posexplode("lines").alias("at", "x")).select("doc", (F.col("doc") + F.col("at")).alias("pos"), "x.*")
    kinds = lines.groupBy("h1", "h2").agg(F.count("*").alias("c"), F.min("pos").alias("first")).where("c > 1").withColumn("b", F.shiftrightunsigned("h1", 64 - FIRST_SPREAD.bit_length() + 1))
    # a line's rank: how many repeated lines stand before it in the order of hashes; the buckets' totals are few
    kinds = cut(kinds.withColumn("inner", F.sum("c").over(Window.partitionBy("b").orderBy("h1", "h2")) - F.col("c")))
    outer = kinds.groupBy("b").agg(F.sum("c").alias("t")).select("b", (F.sum("t").over(Window.orderBy("b")) - F.col("t")).alias("outer"))
    kinds = cut(kinds.join(outer, "b").select("h1", "h2", (F.col("inner") + F.col("outer") + 1).alias("rank"), "first"))
    rows = lines.join(kinds, ["h1", "h2"]).select("doc", "pos", "line", "words", "rank", "first")
    rows = rows.repartition("doc").sortWithinPartitions("doc", "pos")

    def run(table: pa.Table) -> Iterator[pa.RecordBatch]:
        columns = _columns(table, "doc", "pos", "line", "words", "rank", "first")
        pos = columns[1].to_numpy()
        new = np.r_[True, np.diff(pos) != 1]
        stop = np.r_[np.flatnonzero(new)[1:], len(pos)][np.cumsum(new) - 1]
        yield pa.RecordBatch.from_arrays([*columns, pa.array((stop - np.arange(len(pos))).astype(np.int32))], ["doc", "pos", "line", "words", "rank", "first", "more"])

    return cut(rows.mapInArrow(_by_document(run), "doc long, pos long, line int, words int, rank long, first long, more int"))


# ---------------------------------------------------------------- suffix ranks


def _binary(rows: np.ndarray) -> pa.Array:
    """Rows of numbers as bytes that are in order as the rows are."""
    data, (n, width) = rows.astype(">i8").tobytes(), rows.shape
    return pa.Array.from_buffers(pa.binary(), n, [None, pa.py_buffer(np.arange(n + 1, dtype=np.int32) * np.int32(8 * width)), pa.py_buffer(data)])


def _keys(known: DataFrame, span: int, width: int, total: int) -> DataFrame:
    """(doc, pos, more, width, rank, b, key), of known (doc, pos, more, rank, open) that has all suffixes, ranked by `span` lines: for
    each open one the ranks at its place and every span lines on, `width` of them (0 after its end), and their first 2, 4, ...
    where it has as many. b: a bucket, in order, by the second."""
    names = ["doc", "pos", "more", "width", "rank", "b", "key"]

    def run(table: pa.Table) -> Iterator[pa.RecordBatch]:
        doc, pos, more, rank, going = (x.to_numpy(zero_copy_only=False) for x in _columns(table, "doc", "pos", "more", "rank", "open"))
        ahead, where = np.arange(width) * span, np.flatnonzero(going)
        for i in range(0, len(where), KEYS):
            at = where[i : i + KEYS]
            there = ahead < more[at, None]  # until then the rows that follow are the lines that follow
            ranks = np.where(there, rank[np.where(there, at[:, None] + ahead, 0)], 0)
            bucket = (ranks[:, 1] * SPREAD // (total + 1)).astype(np.int32)
            n = width
            while n > 1:
                has = np.arange(len(at)) if n == width else np.flatnonzero(more[at] >= n * span)
                own = at[has]
                columns = [doc[own], pos[own], more[own], np.full(len(own), n, np.int32), rank[own], bucket[has]]
                yield pa.RecordBatch.from_arrays([*map(pa.array, columns), _binary(ranks[has, :n])], names)
                n //= 2

    known = known.repartition("doc").sortWithinPartitions("doc", "pos")
    return cut(known.mapInArrow(_by_document(run), "doc long, pos long, more int, width int, rank long, b int, key binary"))


def suffix_ranks(lines: DataFrame, most: int | None = None) -> tuple[DataFrame, dict[int, DataFrame]]:
    """(pos, rank) of all suffixes of repeated_lines() when they are settled (or ranked by `most` lines), and by number
    of lines 1, 2, 4, ... the classes (pos, rank, first) of those suffixes that share so many lines with another: a number that
    tells the class, and where the first of it is."""
    total = lines.count()
    levels = {1: lines.select("pos", "rank", "first")}
    settled, open_, span = [], lines.select("doc", "pos", "more", "rank"), 1
    while not open_.isEmpty():
        width = WIDTH if most is None else min(WIDTH, 1 << max(0, (most // span).bit_length() - 1))
        if width < 2:
            break
        known = reduce(DataFrame.union, [x.withColumn("open", F.lit(False)) for x in settled], open_.withColumn("open", F.lit(True)))
        t, own = _keys(known, span, width, total), ["width", "rank", "b", "key"]
        classes = t.groupBy(*own).agg(F.count("*").alias("c"), F.min("pos").alias("first"))
        # of suffixes with one rank, those with a smaller key come before; keys stand in buckets by their order
        pairs = classes.where(F.col("width") == width).withColumn("inner", F.sum("c").over(Window.partitionBy("rank", "b").orderBy("key")) - F.col("c"))
        sums = pairs.groupBy("rank", "b").agg(F.sum("c").alias("t"))
        outer = sums.select("rank", "b", (F.sum("t").over(Window.partitionBy("rank").orderBy("b")) - F.col("t")).alias("outer"))
        finer = pairs.join(outer, ["rank", "b"]).select(*own, "c", "first", (F.col("rank") + F.col("inner") + F.col("outer")).alias("finer"))
        classes = finer.union(classes.where((F.col("width") < width) & (F.col("c") > 1)).select(*own, "c", "first", F.col("first").alias("finer")))
        t = cut(t.join(classes, own).select("doc", "pos", "more", "width", F.col("finer").alias("rank"), "c", "first"))
        shared = (F.col("c") > 1) & (F.col("more") >= F.col("width") * span)
        for k in range(1, width.bit_length()):
            levels[span << k] = t.where(shared & (F.col("width") == 1 << k)).select("pos", "rank", "first")
        t, span = t.where(F.col("width") == width).select("doc", "pos", "more", "rank", shared.alias("going")), span * width
        settled.append(t.where("not going").drop("going"))
        open_ = t.where("going").drop("going")
    return reduce(DataFrame.union, settled, open_).select("pos", "rank"), levels


# ---------------------------------------------------------------- intervals and copies


def longest_copies(levels: dict[int, DataFrame]) -> DataFrame:
    """(pos, n, first): of each place the longest run from there on that occurs earlier, in lines, and its first place in the
    corpus; no row where nothing does. levels: as suffix_ranks() gives them."""
    spans = sorted(levels)
    copies = reduce(DataFrame.union, [levels[s].where("first < pos").select(F.lit(k).alias("k"), "pos", "first") for k, s in enumerate(spans)])
    # deeper classes are parts of the others, so their first places come no earlier
    deepest = cut(copies.groupBy("pos").agg(F.max("k").alias("k"), F.max("first").alias("first")))
    spans = spans[: 1 + (deepest.agg(F.max("k")).first()[0] or 0)]  # of the last round's, those that no copy reaches have no part
    # rows (first, n, pos): places that share n lines, told by the first place of all that do; that one is among them
    rows = deepest.where("false").select("first", F.lit(0).alias("n"), "pos")
    for j in reversed(range(len(spans) - 1)):
        own = deepest.where(F.col("k") == j + 1).select("first", F.lit(spans[j + 1]).alias("n"), "pos")
        rows = rows.union(own).union(own.select("first", "n", F.col("first").alias("pos")).distinct())
        ahead = levels[spans[j]].select(F.col("pos").alias("e"), F.col("rank").alias("key"))
        rows = rows.withColumn("e", F.col("pos") + F.col("n")).join(ahead, "e", "left").drop("e")
        parts = rows.where("key is not null").groupBy("first", "n", "key").agg(F.min("pos").alias("least"), F.count("*").alias("c")).where("c > 1").drop("c")
        rows = cut(rows.join(parts, ["first", "n", "key"], "left"))
        longer = rows.where("least is not null").select(F.col("least").alias("first"), (F.col("n") + spans[j]).alias("n"), "pos")
        rows = longer.union(rows.where("least is null or least = pos").select("first", "n", "pos"))
    return rows.union(deepest.where("k = 0").select("first", F.lit(1).alias("n"), "pos")).where("first < pos").select("pos", "n", "first")


def _marked(lines: DataFrame, min_words: int) -> DataFrame:
    """(doc, pos, line, n, n_words, first): the lines to delete; n, n_words and first where a maximal run begins."""
    found = longest_copies(suffix_ranks(lines)[1])
    rows = lines.select("doc", "pos", "line", "words").join(found, "pos", "left").repartition("doc").sortWithinPartitions("doc", "pos")

    def run(table: pa.Table) -> Iterator[pa.RecordBatch]:
        pos, words, n = (x.fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64) for x in _columns(table, "pos", "words", "n"))
        i, before = np.arange(len(pos)), np.r_[0, np.cumsum(words)]
        last = np.r_[0, np.where(np.diff(pos) == 1, n[:-1], 0)]  # the run from the line before
        held = before[i + n] - before[i]
        begins = (n > 0) & (last <= n) & (held >= min_words)
        depth = np.cumsum(np.bincount(i[begins], minlength=len(pos) + 1) - np.bincount((i + n)[begins], minlength=len(pos) + 1))[:-1]
        one = pa.RecordBatch.from_arrays([*_columns(table, "doc", "pos", "line", "n"), pa.array(held), *_columns(table, "first"), pa.array(begins)], ["doc", "pos", "line", "n", "n_words", "first", "begins"])
        yield one.filter(pa.array(depth > 0))

    rows = rows.mapInArrow(_by_document(run), "doc long, pos long, line int, n int, n_words long, first long, begins boolean")
    told = [F.when(F.col("begins"), F.col(c)).alias(c) for c in ("n", "n_words", "first")]
    return rows.select("doc", "pos", "line", *told)


def deleted_lines(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """(doc_id, text_key, gone): the numbers, from 0, of the lines to delete in each document that has any."""
    bound_batches(docs.sparkSession)
    with step(docs.sparkSession):
        owners = numbered(docs)
        gone = _marked(repeated_lines(owners), min_words).groupBy("doc").agg(F.array_sort(F.collect_list("line")).alias("gone"))
        return keep(cut(gone.join(owners.select("doc", "doc_id", "text_key"), "doc").select("doc_id", "text_key", "gone")))


def copied_runs(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """The maximal runs that are copies: doc_id, line (its first, from 0), n_lines (those with words), n_words, and the
    first copy's first_doc_id and first_line. Runs may overlap; none lies in another."""
    bound_batches(docs.sparkSession)
    with step(docs.sparkSession):
        owners = numbered(docs)
        lines = repeated_lines(owners)
        runs = _marked(lines, min_words).where("n is not null").withColumnRenamed("n", "n_lines")
        here = owners.select("doc", "doc_id")
        there = lines.join(here, "doc").select(F.col("pos").alias("first"), F.col("line").alias("first_line"), F.col("doc_id").alias("first_doc_id"))
        rows = runs.join(here, "doc").join(there, "first")
        return keep(cut(rows.select("doc_id", "line", F.col("n_lines").cast("long").alias("n_lines"), "n_words", "first_doc_id", "first_line")))


def dedup_lines(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """docs with repeated line runs cut out of text, and three more columns: n_lines, n_deleted, emptied (lines
    with words were there and all of them went). The texts are shuffled once, to meet the lists of their lines."""
    gone, key = deleted_lines(docs, min_words), f"_key_{uuid.uuid4().hex[:8]}"
    d, t, g = f"{key}_d", f"{key}_t", f"{key}_g"
    gone = gone.select(F.col("doc_id").alias(d), F.col("text_key").alias(t), F.col("gone").alias(g)).hint("shuffle_hash")
    rows = docs.withColumn(key, F.xxhash64(F.col("text").cast("string"), F.length(F.col("text").cast("string"))))
    rows = rows.join(gone, F.col("doc_id").cast("long").eqNullSafe(F.col(d)) & (F.col(key) == F.col(t)), "left").drop(d, t, key)
    names = [c for c in docs.columns if c not in ("n_lines", "n_deleted", "emptied")]
    rows = rows.select(*[F.col(f"`{c}`") for c in names], F.col(g))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, counts, cuts, empty = [], [], [], []
            for text, out in zip(batch.column("text").to_pylist(), batch.column(g).to_pylist(), strict=True):
                lines = text.split("\n") if text is not None else []
                drop = set(out or ())
                kept = [x for i, x in enumerate(lines) if i not in drop]
                texts.append(None if text is None else text if not drop else "\n".join(kept))
                counts.append(len(lines))
                cuts.append(len(drop))
                empty.append(bool(drop) and not any(x.strip(" \t\n\r\x0b\x0c") for x in kept))
            columns = [pa.array(texts, pa.string()) if n == "text" else batch.column(n) for n in names]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(counts, pa.int64()), pa.array(cuts, pa.int64()), pa.array(empty, pa.bool_())], [*names, "n_lines", "n_deleted", "emptied"])

    kinds = ", ".join(f"`{n}` {'string' if n == 'text' else rows.schema[n].dataType.simpleString()}" for n in names)
    return rows.mapInArrow(tidy(run), f"{kinds}, n_lines long, n_deleted long, emptied boolean")


def deduplicated(docs: DataFrame) -> DataFrame:
    """The query's digest: doc_id, n_lines, n_deleted, emptied and the text that stays."""
    return dedup_lines(fields(docs, "doc_id", "text")).select("doc_id", "n_lines", "n_deleted", "emptied", "text")
