"""Benchmark decontamination by winnowing (operator 5).

A k-gram hash is kept where it is the least of w neighbouring ones (the last of equals), for documents and for
benchmark items alike, so any w + k - 1 = 13 words that both hold keep the same k-gram in both. Kept hashes are joined;
each hit is then extended word by word to both sides, and a run of 13 equal words or more is marked. The words that
a hit carries beside it (8 to each side) reach over every 13-word window it stands for, so the union of all
extended hits is every word of every shared window: nothing is missed and nothing is guessed.

Items of fewer than 13 words are one window each. They keep their least k-gram (k at most 5), which documents look up
at every place, not only at kept ones. A k-gram of fewer than 5 words is such an item whole: a document brings it once,
with all its places and no words around it, so that a common short item costs a document one row.

Scale: the benchmark's hashes go to the tasks as a bit set of fixed size (8 MB), so a document's kept hashes
leave its task only if some item may hold them; those few are joined by a shuffle, salted so that a passage in
very many documents is spread. Texts are never shuffled.

Defined cases: null or empty texts have no words; a document without words isn't contaminated; an item without
words has no window; hits of items whose id is null count as hit words but not as items; items of equal ids count
once; repeated documents give equal rows. Extra columns are not read. With no items nothing is hit.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seatloom.llm.common import ALNUM, bound_batches, cut, fields, slices, small_side, text_digest, tidy, windows

WINDOW, GRAM = 13, 5
SIDE = WINDOW - GRAM  # words that a hit carries to each side
BITS = 1 << 26
SALTS = 16


def kept_grams(grams: np.ndarray, at: np.ndarray, first: np.ndarray, span: int) -> np.ndarray:
    """Places of the k-grams that are least in some run of span neighbours of one row, the last of equals."""
    if len(at) < span:
        return np.zeros(0, np.int64)
    runs = np.lib.stride_tricks.sliding_window_view(grams, span)
    begin, end = at[: len(at) - span + 1], at[span - 1 :]
    whole = np.flatnonzero(end - begin == span - 1)  # neighbours: no row ends between
    picked = np.zeros(len(grams), bool)
    for i in range(0, len(whole), 1 << 16):
        part = whole[i : i + (1 << 16)]
        picked[part + span - 1 - runs[part][:, ::-1].argmin(1)] = True
    return np.flatnonzero(picked)


def _signed(h: np.ndarray) -> np.ndarray:
    return h.view(np.int64)


def item_marks(items: DataFrame) -> DataFrame:
    """(h, item_id, gram, left, words, need): what each item keeps, with the words around it."""
    rows = fields(items, "item_id", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column("item_id").to_pylist()
            for i, j, words in slices(batch, "text", ALNUM):
                out = {n: [] for n in ("h", "item_id", "gram", "left", "words", "need")}
                hashes, counts = words.hashes(), np.diff(words.first)

                def keep(row, place, k, h, low, high, need, out=out, ids=ids, i=i, words=words):
                    for name, v in zip(out, (h, ids[i + row], k, place - low, words.text(low, high).decode("utf-8", "replace"), need), strict=True):
                        out[name].append(v)

                grams, at = windows(hashes, words.first, GRAM)
                for g in kept_grams(grams, at, words.first, WINDOW - GRAM + 1):
                    row = words.row[at[g]]
                    low, high = max(words.first[row], at[g] - SIDE), min(words.first[row + 1], at[g] + GRAM + SIDE)
                    keep(row, at[g], GRAM, int(_signed(grams[g : g + 1])[0]), low, high, WINDOW)
                for row in np.flatnonzero((counts > 0) & (counts < WINDOW)):
                    low, high = words.first[row], words.first[row + 1]
                    k = min(GRAM, int(high - low))
                    own, places = windows(hashes[low:high], np.array([0, high - low]), k)
                    best = len(own) - 1 - int(own[::-1].argmin())
                    keep(row, low + places[best], k, int(_signed(own[best : best + 1])[0]), low, high, int(high - low))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(out["h"], pa.int64()), pa.array(out["item_id"], batch.schema.field("item_id").type), *[pa.array([int(x) for x in out[n]], pa.int32()) for n in ("gram", "left")], pa.array(out["words"], pa.string()), pa.array(out["need"], pa.int32())],
                    list(out),
                )

    kind = rows.schema["item_id"].dataType.simpleString()
    return rows.mapInArrow(tidy(run), f"h long, item_id {kind}, gram int, left int, words string, need int")


def bit_set(hashes: DataFrame) -> np.ndarray:
    """BITS bits, set where some hash of column h falls: at most BITS / 64 rows reach the driver, whatever the input."""
    place = F.pmod(F.col("h"), F.lit(BITS))
    cells = hashes.select(F.floor(place / 64).cast("int").alias("cell"), F.expr(f"shiftleft(1L, cast(pmod(h, {BITS}) % 64 as int))").alias("bit"))
    got = cells.groupBy("cell").agg(F.bit_or("bit").alias("bits")).toPandas()
    out = np.zeros(BITS // 64, np.int64)
    out[got["cell"].to_numpy(np.int64)] = got["bits"].to_numpy(np.int64)
    return out.view(np.uint64)


def may_hold(bits: np.ndarray, h: np.ndarray) -> np.ndarray:
    place = h % np.uint64(BITS)  # equals pmod of the signed value, as BITS divides 2^64
    return (bits[(place >> np.uint64(6)).astype(np.int64)] >> (place & np.uint64(63))) & np.uint64(1) == 1


def document_hits(docs: DataFrame, bits, short: list[int]) -> DataFrame:
    """One row a document: its number, doc_id, n_words, and its hashes that the bit set may hold, with words around."""
    rows = fields(docs, "doc_id", "text").withColumn("row", F.monotonically_increasing_id())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = bits.value
        for batch in batches:
            for i, j, words in slices(batch, "text", ALNUM):
                hashes, hits, whole = words.hashes(), [], {}
                for k in sorted({GRAM, *short}):
                    grams, at = windows(hashes, words.first, k)
                    wanted = may_hold(held, grams)
                    if k not in short:  # long items only: their k-grams are kept ones
                        kept = np.zeros(len(grams), bool)
                        kept[kept_grams(grams, at, words.first, WINDOW - GRAM + 1)] = True
                        wanted &= kept
                    for g in np.flatnonzero(wanted):
                        row = int(words.row[at[g]])
                        h, place = int(_signed(grams[g : g + 1])[0]), int(at[g] - words.first[row])
                        if k < GRAM:
                            # equal hashes of other words are told apart by the words
                            whole.setdefault((row, h, words.text(at[g], at[g] + k)), []).append(place)
                            continue
                        low, high = max(words.first[row], at[g] - SIDE), min(words.first[row + 1], at[g] + k + SIDE)
                        hits.append((row, h, [place], int(at[g] - low), words.text(low, high).decode("utf-8", "replace")))
                hits += [(row, h, places, 0, text.decode("utf-8", "replace")) for (row, h, text), places in whole.items()]
                hits.sort(key=lambda x: x[0])
                per_row = np.searchsorted([x[0] for x in hits], np.arange(j - i + 1)) if hits else np.zeros(j - i + 1, np.int64)
                found = pa.StructArray.from_arrays([pa.array([x[n] for x in hits], t) for n, t in ((1, pa.int64()), (2, pa.list_(pa.int32())), (3, pa.int32()), (4, pa.string()))], ["h", "places", "left", "words"])
                part = batch.slice(i, j - i)
                yield pa.RecordBatch.from_arrays(
                    [part.column("row"), part.column("doc_id"), pa.array(np.diff(words.first), pa.int64()), pa.ListArray.from_arrays(pa.array(per_row, pa.int32()), found)],
                    ["row", "doc_id", "n_words", "hits"],
                )

    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(tidy(run), f"row long, doc_id {kind}, n_words long, hits array<struct<h:bigint,places:array<int>,left:int,words:string>>")


def extended(a: list[str], i: int, b: list[str], j: int, gram: int) -> tuple[int, int]:
    """How many words agree to the left and to the right of the k-grams at a[i] and b[j]; -1 if they differ."""
    if a[i : i + gram] != b[j : j + gram]:
        return -1, 0
    left = 0
    while left < min(i, j) and a[i - left - 1] == b[j - left - 1]:
        left += 1
    right = 0
    while right < min(len(a) - i, len(b) - j) - gram and a[i + gram + right] == b[j + gram + right]:
        right += 1
    return left, right


def _extend(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        keep, begin, size = [], [], []
        columns = [batch.column(n).to_pylist() for n in ("left", "words", "item_left", "item_words", "gram", "need")]
        places = batch.column("places")
        for n, (left, words, item_left, item_words, gram, need) in enumerate(zip(*columns, strict=True)):
            before, after = extended(words.split(" "), left, item_words.split(" "), item_left, gram)
            if before >= 0 and before + gram + after >= need:
                keep.append(n)
                begin.append(places[n].values.to_numpy() - before)
                size.append(before + gram + after)
        kept = batch.take(pa.array(keep, pa.int32()))
        yield pa.RecordBatch.from_arrays([kept.column("row"), kept.column("item_id"), pa.array(begin, pa.list_(pa.int32())), pa.array(size, pa.int32())], ["row", "item_id", "begins", "size"])


def contamination(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items_sha256, contaminated: a document is contaminated if a twentieth
    of its words or more are hit."""
    spark = docs.sparkSession
    bound_batches(spark)
    marks = cut(item_marks(benchmark))
    short = sorted(r.gram for r in marks.where(f"need < {WINDOW}").select("gram").distinct().collect())  # of 1 to 5
    bits = spark.sparkContext.broadcast(bit_set(marks.select("h")))
    base = cut(document_hits(docs, bits, short))
    hits = base.select("row", F.explode("hits").alias("x")).select("row", "x.*", F.pmod("row", F.lit(SALTS)).alias("salt"))
    sown = marks.withColumnsRenamed({"left": "item_left", "words": "item_words"}).withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    joined = hits.join(sown, ["h", "salt"]).select("row", "places", "left", "words", "item_id", "item_left", "item_words", "gram", "need")
    kind = marks.schema["item_id"].dataType.simpleString()
    runs = joined.mapInArrow(tidy(_extend), f"row long, item_id {kind}, begins array<int>, size int")
    # words under a union of runs: the runs of one document, in order, each adding what the ones before don't reach
    union = F.aggregate(
        F.array_sort("runs"), F.struct(F.lit(0).cast("long").alias("n"), F.lit(0).alias("reach")),
        lambda acc, r: F.struct((acc["n"] + F.greatest(r["end"] - F.greatest(r["begin"], acc["reach"]), F.lit(0))).alias("n"), F.greatest(acc["reach"], r["end"]).alias("reach")),
    )["n"]
    spans = F.transform("begins", lambda b: F.struct(b.alias("begin"), (b + F.col("size")).alias("end")))
    found = runs.groupBy("row").agg(F.array_distinct(F.flatten(F.collect_list(spans))).alias("runs"), F.collect_set(F.col("item_id").cast("string")).alias("items"))
    found = found.select("row", union.alias("n_hit"), F.array_sort("items").alias("items"))
    rows = base.select("row", "doc_id", "n_words").join(found, "row", "left")
    n_hit, items = F.coalesce("n_hit", F.lit(0).cast("long")), F.coalesce("items", F.array().cast("array<string>"))
    return rows.select(
        "doc_id", "n_words", n_hit.alias("n_hit"), F.size(items).cast("long").alias("n_items"),
        F.sha2(F.array_join(items, ",").cast("binary"), 256).alias("items_sha256"),
        ((n_hit > 0) & (20 * n_hit >= F.col("n_words"))).alias("contaminated"),
    )


def drop_contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents that aren't contaminated. Each row is judged by its own text, whether or not others share its
    doc_id or have none; rows of equal doc_id and text are judged alike."""
    key = f"_key_{uuid.uuid4().hex[:8]}"
    named = docs.select(F.struct(F.col("doc_id"), text_digest().alias("digest")).alias("doc_id"), "text")
    bad = cut(contamination(named, benchmark).where("contaminated").select(F.col("doc_id.doc_id").alias(f"{key}_d"), F.col("doc_id.digest").alias(f"{key}_t")).distinct())
    rows, bad = docs.withColumn(key, text_digest()), small_side(bad)
    return rows.join(bad, rows["doc_id"].eqNullSafe(bad[f"{key}_d"]) & (rows[key] == bad[f"{key}_t"]), "left_anti").drop(key)
