"""Near-duplicate documents: SuperMinHash signatures, banding, verification on full sets, union-find (operator 6).

1. Each text becomes its set of distinct five-word shingles (64-bit hashes) and a SuperMinHash signature: per element
   a random permutation of the slots, one step at a time, its j-th step offering j + a fraction to the slot drawn;
   a text stops as soon as no slot can improve. Texts of equal sets (by 128 bits of digest) are one node from here on;
   copies are brought together by a pre-aggregated group, never paired.
2. The signature's 128 ranks make 32 bands of 4. At a similarity of 0.75 a pair agrees in at least one band
   with probability 1 - 5e-6.
3. Candidates are verified on full sets, a bucket's members first against its most crowded one (a star,
   linear in the bucket); links are united; then only buckets that still hold several components are looked at again.
4. In those, all pairs between different components are verified if the bucket has at most PAIRED members. The
   documents of larger ones go through an exact filter: only shingles that another component holds too can be in
   an overlap, which rules most documents out; what is left meets by prefix filtering, rare shingles first.

Texts are read twice (signatures; sets of candidates only, told by a bit set of fixed size) and never shuffled. Joins with
many rows a key have a materialised side with one row a key, so adaptive execution can split hot keys.

A document may be known by a second text (``keep_one``'s `also`): the text it had before lines were cut out of it.
It is linked by both, so copies that the cut has made unlike each other are still found. Which text was whose is told by
doc_ids, or row by row where rows share a doc_id or have none.

Tables between the steps are deleted when nothing reads them any more, shuffle files when their query has run.

Defined cases: null or empty text has no shingles and is linked with nothing; one to four words are one shingle.
Rows that share a doc_id are documents of their own. In ``near_duplicates`` a null doc_id links nothing, has a null
component and is kept; ``keep_one`` links rows without doc_id like others. Extra columns are not read. An empty table
gives no rows.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from seatloom.llm.common import NONSPACE, bound_batches, cut, drop, fields, keep, mix, slices, small_side, step, text_digest, tidy, windows
from seatloom.llm.components import components
from seatloom.llm.decontaminate import bit_set, may_hold

WORDS = 5
BANDS, ROWS = 32, 4
SLOTS = BANDS * ROWS
PAIRED = 24
#: 64-bit words of the bit maps that bound an overlap.
MARKS = 16
#: A shingle of more nodes than this comes last in the order of prefixes.
COMMON = 16
#: Shingles that are permuted at a time.
ELEMENTS = 1 << 17
PERCENT = 75


def shingle_sets(words) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of each row."""
    hashes = words.hashes()
    grams, at = windows(hashes, words.first, WORDS)
    first = np.searchsorted(at, words.first)  # a row's shingles start inside it
    out = []
    for r, n in enumerate(np.diff(words.first)):
        if n >= WORDS:
            out.append(np.unique(grams[first[r] : first[r + 1]]))
        elif n:
            own = hashes[words.first[r] : words.first[r + 1]]
            out.append(windows(own, np.array([0, n]), int(n))[0])
        else:
            out.append(np.zeros(0, np.uint64))
    return out


def super_minhash(sets: list[np.ndarray], slots: int = SLOTS) -> np.ndarray:
    """Signatures, a row a set: of each slot the least step (high 32 bits) and fraction (low 32 bits) offered."""
    signature = np.full((len(sets), slots), np.uint64(slots) << np.uint64(32), np.uint64)
    rows = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    elements = np.concatenate(sets) if sets else np.zeros(0, np.uint64)
    flat = signature.reshape(-1)
    for i in range(0, len(elements), ELEMENTS):
        row, element = rows[i : i + ELEMENTS], elements[i : i + ELEMENTS]
        order = np.broadcast_to(np.arange(slots, dtype=np.uint8 if slots <= 256 else np.uint16), (len(element), slots)).copy()
        for step in range(slots):
            draw = mix(element + np.uint64((step + 1) * 0x9E3779B97F4A7C15 % (1 << 64)))
            target = step + ((draw & np.uint64(0xFFFFFFFF)) % np.uint64(slots - step)).astype(np.int64)
            n = np.arange(len(element))
            slot = order[n, target]
            order[n, target] = order[:, step]
            np.minimum.at(flat, row * slots + slot, (np.uint64(step) << np.uint64(32)) | (draw >> np.uint64(32)))
            live = ((signature.max(1) >> np.uint64(32)) > step)[row]  # some slot may still get less from a later step
            if not live.any():
                break
            if not live.all():
                row, element, order = row[live], element[live], order[live]
    return signature


def band_keys(signature: np.ndarray) -> np.ndarray:
    """A hash of each band's ranks and its number: sets x BANDS."""
    ranks = signature.reshape(len(signature), BANDS, ROWS)
    h = mix(np.arange(1, BANDS + 1, dtype=np.uint64) * np.uint64(0xD1342543DE82EF95))[None, :]
    for i in range(ROWS):
        h = mix(h + ranks[:, :, i] * np.uint64(0x9E3779B97F4A7C15) + np.uint64(i + 1))
    return h


def digests(sets: list[np.ndarray]) -> list[np.ndarray]:
    """Two order-free 64-bit digests of each set."""
    return [np.array([mix(s ^ np.uint64(c)).sum(dtype=np.uint64) for s in sets], np.uint64).view(np.int64) for c in (0x243F6A8885A308D3, 0x13198A2E03707344)]


def signatures(docs: DataFrame, *carried: str, bits=None) -> DataFrame:
    """doc_id, n_shingles, two digests of the set, and the band keys; the columns named come along. With bits, only the
    rows whose id the bit set may hold."""
    rows = fields(docs, "doc_id", "text", *carried).withColumn("doc_id", F.col("doc_id").cast("long"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if bits is not None:
                batch = batch.filter(pa.array(may_hold(bits.value, _hash_ids(batch.column("doc_id")))))
            for i, j, words in slices(batch, "text", NONSPACE):
                sets = shingle_sets(words)
                n = np.array([len(s) for s in sets], np.int64)
                keys = band_keys(super_minhash(sets)).view(np.int64)
                keys = keys[n > 0].reshape(-1)
                lists = pa.ListArray.from_arrays(pa.array(np.r_[0, np.cumsum((n > 0) * BANDS)], pa.int32()), pa.array(keys))
                part = batch.slice(i, j - i)
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(n), *map(pa.array, digests(sets)), lists, *map(part.column, carried)], ["doc_id", "n_shingles", "d1", "d2", "bands", *carried])

    return rows.mapInArrow(tidy(run), "doc_id long, n_shingles long, d1 long, d2 long, bands array<long>" + "".join(f", {k} {rows.schema[k].dataType.simpleString()}" for k in carried))


def candidate_sets(docs: DataFrame, heads: DataFrame) -> DataFrame:
    """(node, shingles) of the nodes of heads (node, d1, d2, doc_id), a materialised table. Two bit sets of fixed size tell
    which documents to look at and which of their sets to hand on."""
    shared = docs.sparkSession.sparkContext.broadcast((bit_set(_id_hashes(heads.select("doc_id"))), bit_set(heads.select(F.col("d1").alias("h")))))
    rows = fields(docs, "doc_id", "text").select(F.col("doc_id").cast("long").alias("doc_id"), "text").where("doc_id is not null")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, wanted = shared.value
        for whole in batches:
            batch = whole.filter(pa.array(may_hold(ids, _hash_ids(whole.column("doc_id")))))
            for _, _, words in slices(batch, "text", NONSPACE):
                sets = [s for s in shingle_sets(words) if len(s)]
                d1, d2 = digests(sets)
                kept = np.flatnonzero(may_hold(wanted, d1.view(np.uint64)))
                sets = [sets[i] for i in kept]
                at = np.r_[0, np.cumsum([len(s) for s in sets], dtype=np.int64)]
                values = np.concatenate(sets) if sets else np.zeros(0, np.uint64)
                yield pa.RecordBatch.from_arrays([pa.array(d1[kept]), pa.array(d2[kept]), pa.ListArray.from_arrays(pa.array(at, pa.int32()), pa.array(values.view(np.int64)))], ["d1", "d2", "shingles"])

    sets = rows.mapInArrow(tidy(run), "d1 long, d2 long, shingles array<long>").dropDuplicates(["d1", "d2"])
    return sets.join(heads.select("d1", "d2", "node"), ["d1", "d2"]).select("node", "shingles")


def _hash_ids(ids: pa.Array) -> np.ndarray:
    return mix(ids.to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64))


def _id_hashes(ids: DataFrame) -> DataFrame:
    def run(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array(_hash_ids(batch.column("doc_id")).view(np.int64))], ["h"])

    return ids.mapInArrow(tidy(run), "h long")


def _alike(a: Column, b: Column) -> Column:
    """Whether set sizes allow the similarity."""
    return F.least(a, b) * 100 >= F.greatest(a, b) * PERCENT


def verified(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs (u, v), a materialised table, whose full sets reach the similarity. Where the pairs are few, they go to the
    sets of v, which then move once, to those of u; sets that are in no pair stay where they are."""
    heads = small_side(cut(pairs.select(F.col("u").alias("node")).distinct()))
    a = sets.join(heads, "node", "left_semi").select(F.col("node").alias("u"), F.col("shingles").alias("su"))
    b = sets.select(F.col("node").alias("v"), F.col("shingles").alias("sv")).join(small_side(pairs), "v")
    both = F.size(F.array_intersect("su", "sv"))
    return b.join(a, "u").where(100 * both >= PERCENT * (F.size("su") + F.size("sv") - both)).select("u", "v")


class Links:
    """Verified links so far and the components they make."""

    def __init__(self):
        self.sets = self.parts = None

    def labelled(self, rows: DataFrame, name: str, out: str) -> DataFrame:
        """rows with the component of the node in column name (itself if it has no link)."""
        if self.parts is None:
            return rows.withColumn(out, F.col(name))
        parts = self.parts.select(F.col("node").alias(name), F.col("component").alias("_part"))
        return rows.join(parts, name, "left").withColumn(out, F.coalesce("_part", name)).drop("_part")

    def verify(self, pairs: DataFrame) -> None:
        """Verify the pairs (u, v) that are in different components, and unite what is linked."""
        pairs = pairs.where("u <> v").select(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v")).distinct()
        if self.parts is not None:
            pairs = self.labelled(self.labelled(pairs, "u", "pu"), "v", "pv").where("pu <> pv").select("u", "v")
        with step(pairs.sparkSession):
            pairs = cut(pairs)
            if not pairs.isEmpty():
                self.unite(cut(verified(pairs, self.sets)))

    def unite(self, found: DataFrame) -> None:
        """Add links (u, v), a materialised table."""
        if found.isEmpty():
            return
        old, edges = self.parts, found
        if old is not None:
            edges = old.where("node <> component").select(F.col("node").alias("u"), F.col("component").alias("v")).union(found)
        self.parts = keep(components(edges))
        if old is not None:
            drop(old)

    def unsettled(self, rows: DataFrame) -> DataFrame:
        """Of bucket rows (key, node, n): those of buckets that hold several components, with part and the bucket's size."""
        rows = self.labelled(rows, "node", "part")
        keys = rows.groupBy("key").agg(F.min("part").alias("low"), F.max("part").alias("high"), F.count("*").alias("members")).where("low <> high").select("key", "members")
        keys = cut(keys)
        return cut(rows.join(keys, "key"))


def across(rows: DataFrame) -> DataFrame:
    """Pairs of one bucket's rows from different components and of sizes that allow a link."""
    a, b = (rows.select("key", F.col("node").alias(x), F.col("n").alias(f"n{x}"), F.col("part").alias(f"p{x}")) for x in "uv")
    fits = (F.col("u") < F.col("v")) & (F.col("pu") != F.col("pv")) & _alike(F.col("nu"), F.col("nv"))
    return a.join(b, (a["key"] == b["key"]) & fits).select("u", "v").distinct()


def star(rows: DataFrame) -> DataFrame:
    """Each row's node with the most crowded of its bucket (u), where sizes allow a link.

    A node's crowd is how many rows share its buckets: the text that a family of copies was made from is near all of
    them, so it has the largest and heads the buckets of its family."""
    head = cut(rows.groupBy("key").agg(F.max(F.struct("crowd", "node", "n")).alias("head")))
    return rows.join(head, "key").where((F.col("head.node") != F.col("node")) & _alike(F.col("head.n"), F.col("n"))).select(F.col("head.node").alias("u"), F.col("node").alias("v"))


def _ceil(a: int, b: int) -> int:
    return -(-a // b)


def prefix_rows(rows: DataFrame, sets: DataFrame) -> DataFrame:
    """(key, node, n, part, theirs, small, m0...): of each node the shingles by which it may meet a similar one of
    another component; no rows for a node that has none.

    Which shingles several components hold, and which of them many nodes hold, reaches the tasks as two bit sets of
    fixed size. A shingle that a bit set holds by chance only weakens the filter; the order is the same for all.
    """
    spark = rows.sparkSession
    held = sets.join(rows.select("node", "part").distinct(), "node")
    each = held.select("part", F.explode("shingles").alias("h")).groupBy("h").agg(F.count("*").alias("holders"), F.min("part").alias("low"), F.max("part").alias("high"))
    each = cut(each.where("low <> high").select("h", "holders"))
    bits = spark.sparkContext.broadcast((bit_set(each.select("h")), bit_set(each.where(F.col("holders") > COMMON).select("h"))))
    masks = [f"m{i}" for i in range(MARKS)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        outside, common = bits.value
        for batch in batches:
            columns = {name: [] for name in ("key", "node", "n", "part", "theirs", "small", *masks)}
            for node, part, shingles in zip(batch.column("node").to_pylist(), batch.column("part").to_pylist(), batch.column("shingles"), strict=True):
                whole = shingles.values.to_numpy().view(np.uint64)
                theirs, n = whole[may_hold(outside, whole)], len(whole)
                first, nearer = len(theirs) - _ceil(n * PERCENT, 100) + 1, len(theirs) - _ceil(2 * n * PERCENT, 100 + PERCENT) + 1
                if first <= 0:
                    continue
                marks = np.zeros(MARKS, np.uint64)
                np.bitwise_or.at(marks, ((theirs >> np.uint64(6)) % np.uint64(MARKS)).astype(np.int64), np.uint64(1) << (theirs & np.uint64(63)))
                picked = theirs[np.lexsort((theirs, may_hold(common, theirs)))[:first]]
                columns["key"].append(picked.view(np.int64))
                columns["small"].append(np.arange(first) < nearer)
                for name, v in (("node", node), ("n", n), ("part", part), ("theirs", len(theirs)), *zip(masks, marks.view(np.int64), strict=True)):
                    columns[name].append(np.full(first, v, np.int64))
            flat = [np.concatenate(v) if v else np.zeros(0, bool if name == "small" else np.int64) for name, v in columns.items()]
            yield pa.RecordBatch.from_arrays([pa.array(v) for v in flat], list(columns))

    return held.select("node", "part", "shingles").mapInArrow(tidy(run), "key long, node long, n long, part long, theirs long, small boolean, " + ", ".join(f"{m} long" for m in masks))


def prefix_pairs(rows: DataFrame, sets: DataFrame) -> DataFrame:
    """Pairs from different components among the nodes of rows that may be similar, by exact filters.

    Two sets of sizes m <= n need an overlap of PERCENT / (100 + PERCENT) * (m + n): at least 6/7 of m and 3/4 of n. Only
    shingles that some node of another component holds can be in it. They are ordered, those of many nodes last; if the
    overlap is large enough, one of the first (theirs - 6/7 m + 1) of the smaller set is among the first
    (theirs - 3/4 n + 1) of the larger. Pairs that meet so must also pass a bound: each set marks its shingles in a small
    bit map, and a mark that the other set lacks is a shingle that it lacks. Copies of one text with edits of their
    own all meet at its shingles, but the bound comes so near the overlap that few wrong pairs pass.
    """
    masks = [f"m{i}" for i in range(MARKS)]
    ranked = cut(prefix_rows(rows, sets))
    a, b = (ranked.select("key", F.col("node").alias(x), *[F.col(c).alias(c + x) for c in ("n", "part", "theirs", *masks)], "small") for x in "uv")
    missing = lambda x, y: sum(F.bit_count(F.col(m + x).bitwiseAND(F.bitwise_not(m + y))) for m in masks)
    bound = F.least(F.col("theirsu") - missing("u", "v"), F.col("theirsv") - missing("v", "u"))
    fits = (F.col("partu") != F.col("partv")) & _alike(F.col("nu"), F.col("nv")) & ((F.col("nu") < F.col("nv")) | (F.col("nu") == F.col("nv")) & (F.col("u") < F.col("v")))
    fits &= bound * (100 + PERCENT) >= (F.col("nu") + F.col("nv")) * PERCENT
    return a.where("small").drop("small").join(b.drop("small"), (a["key"] == b["key"]) & fits).select("u", "v").distinct()


def bucket_rows(heads: DataFrame, keys: DataFrame) -> DataFrame:
    """(key, node, n): the bands of heads whose key is one of keys, materialised. A bit set of fixed size drops most others
    before they are shuffled."""
    shared = heads.sparkSession.sparkContext.broadcast(bit_set(keys.select(F.col("key").alias("h"))))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bands = batch.column("bands")
            flat = bands.flatten().to_numpy()
            row = np.repeat(np.arange(len(batch)), np.diff(bands.offsets.to_numpy()))
            kept = np.flatnonzero(may_hold(shared.value, flat.view(np.uint64)))
            rows = batch.take(pa.array(row[kept]))
            yield pa.RecordBatch.from_arrays([pa.array(flat[kept]), rows.column("node"), rows.column("n")], ["key", "node", "n"])

    rows = heads.select("node", "n", "bands").mapInArrow(tidy(run), "key long, node long, n long")
    return cut(rows.join(small_side(keys), "key"))


def _told_apart(heads: DataFrame, links: Links) -> DataFrame:
    """(key, node, n, members): the rows of buckets that hold several components, materialised. Buckets of one alone, such as
    the two texts of one document, have nothing to tell."""
    keyed = links.labelled(heads.select("node", "n", "bands"), "node", "part")
    ends = keyed.select("part", F.explode("bands").alias("key")).groupBy("key").agg(F.min("part").alias("low"), F.max("part").alias("high"))
    with step(heads.sparkSession):
        rows = bucket_rows(heads, cut(ends.where("low < high").select("key")))
        return keep(cut(rows.join(rows.groupBy("key").agg(F.count("*").alias("members")), "key")))


def linked_components(docs: DataFrame, base: DataFrame, ties: DataFrame | None = None) -> DataFrame | None:
    """(d1, d2, c1, c2): of each set that is linked with others, the least digests of its component (None: no links).

    base: signatures() of docs, materialised. ties: pairs of sets (a1, a2, b1, b2) that belong together anyway."""
    known = base.where("n_shingles > 0 and doc_id is not null")
    heads = known.groupBy("d1", "d2").agg(F.min("doc_id").alias("doc_id"), F.first("n_shingles").alias("n"), F.first("bands").alias("bands"))
    with step(docs.sparkSession):
        heads = cut(heads.withColumn("node", F.monotonically_increasing_id()))
        links = Links()
        if ties is not None:
            named = lambda x, y: heads.select(F.col("d1").alias(f"{x}1"), F.col("d2").alias(f"{x}2"), F.col("node").alias(y))
            links.unite(cut(ties.join(named("a", "u"), ["a1", "a2"]).join(named("b", "v"), ["b1", "b2"]).select("u", "v").distinct()))
        rows = _told_apart(heads, links)
        crowd = cut(rows.groupBy("node").agg(F.sum("members").alias("crowd")))
        alike = cut(heads.join(crowd, "node").select("node", "d1", "d2", "doc_id"))
        names = cut(heads.select("node", "d1", "d2"))
        drop(heads)  # the bands, of which rows has what matters
        links.sets = cut(candidate_sets(docs, alike))
        drop(alike)
        rows = rows.select("key", "node", "n")
        pairs = cut(star(rows.join(crowd, "node")).groupBy("u", "v").agg(F.count("*").alias("bands")))
        # of each node the bucket head it shares most bands with comes first: that settles nearly all
        links.verify(pairs.groupBy("v").agg(F.max_by("u", F.struct("bands", "u")).alias("u")).select("u", "v"))
        links.verify(pairs.select("u", "v"))
        drop(pairs)
        left = links.unsettled(rows)
        if not left.isEmpty():
            links.verify(across(left.where(F.col("members") <= PAIRED)))
            large = left.where(F.col("members") > PAIRED).drop("part")
            if not large.isEmpty():
                large = links.unsettled(large.select("key", "node", "n"))
                links.verify(prefix_pairs(large, links.sets))
        if links.parts is None:
            return None
        members = cut(links.parts.join(names, "node").select("component", "d1", "d2"))
        least = cut(members.groupBy("component").agg(F.min(F.struct("d1", "d2")).alias("c")))
        return keep(cut(members.join(least, "component").select("d1", "d2", F.col("c.d1").alias("c1"), F.col("c.d2").alias("c2"))))


def _in_components(rows: DataFrame, parts: DataFrame | None) -> DataFrame:
    """rows with c1, c2: the component of their set, itself if it has no links."""
    if parts is None:
        return rows.withColumns({"c1": F.col("d1"), "c2": F.col("d2")})
    return rows.join(parts, ["d1", "d2"], "left").withColumns({"c1": F.coalesce("c1", "d1"), "c2": F.coalesce("c2", "d2")})


def near_duplicates(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, component_id (the smallest doc_id reachable over links), kept (it is that one)."""
    bound_batches(docs.sparkSession)
    with step(docs.sparkSession):
        base = cut(signatures(docs))
        parts = linked_components(docs, base)
        rows = keep(cut(base.select("doc_id", "n_shingles", "d1", "d2")))
        full = _in_components(rows.where("n_shingles > 0"), None if parts is None else keep(parts))
        least = keep(cut(full.groupBy("c1", "c2").agg(F.min("doc_id").alias("component_id"))))
    full = full.join(least, ["c1", "c2"]).select("doc_id", "n_shingles", F.when(F.col("doc_id").isNotNull(), F.col("component_id")).alias("component_id"))
    rows = full.union(rows.where("n_shingles = 0").select("doc_id", "n_shingles", F.col("doc_id").alias("component_id")))
    return rows.withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))


def row_number_of(text: str = "text") -> Column:
    """What a row is known by beside its text: its doc_id, or without one a number made from the text."""
    return F.coalesce(F.col("doc_id").cast("long"), F.xxhash64(F.col(text).cast("string")))


def _pairs_by_id(named: DataFrame, other: DataFrame) -> DataFrame:
    """(a_id, t, b_id, s): texts (by digest) of one doc_id that one row in either table has."""
    alone = lambda rows, x: rows.where("own_id is not null").groupBy("own_id").agg(F.count("*").alias("n"), F.min("digest").alias(x)).where("n = 1").drop("n")
    return alone(named, "t").join(alone(other, "s"), "own_id").select(F.col("own_id").alias("a_id"), "t", F.col("own_id").alias("b_id"), "s")


def _named(docs: DataFrame) -> DataFrame:
    return docs.select(row_number_of().alias("doc_id"), F.col("text").cast("string").alias("text"), F.col("doc_id").cast("long").alias("own_id"), text_digest().alias("digest"))


def keep_one(docs: DataFrame, also: DataFrame | None = None, pairs: DataFrame | None = None) -> DataFrame:
    """One row of each group of near duplicates stays, that with the smallest doc_id (of equal ones, by a digest of the
    text; rows without doc_id come last). Rows are told apart by doc_id and text; of rows equal in both one stays.

    also: (doc_id, text), second texts of the documents. Whose they are is told by doc_ids that one row here and one row there
    have, and for others by pairs (a_id, t, b_id, s): row_number_of() and text_digest() of a row here and of one there."""
    spark = docs.sparkSession
    bound_batches(spark)
    named = _named(docs)
    with step(spark):
        base = cut(signatures(named, "own_id", "digest"))
        texts, known, ties = named.select("doc_id", "text"), base.drop("own_id", "digest"), None  # of texts, only those of known sets are looked at
        if also is not None:
            other = _named(also)
            both = _pairs_by_id(named, other)
            both = cut((both if pairs is None else both.union(pairs.select("a_id", "t", "b_id", "s"))).where("t <> s").distinct())
            bits = spark.sparkContext.broadcast(bit_set(_id_hashes(both.select(F.col("b_id").alias("doc_id")))))
            theirs = both.select(F.col("b_id").alias("doc_id"), F.col("s").alias("digest")).distinct()
            seen = cut(signatures(other, "digest", bits=bits).join(theirs, ["doc_id", "digest"], "left_semi").where("n_shingles > 0"))
            own = base.where("n_shingles > 0").select(F.col("doc_id").alias("a_id"), F.col("digest").alias("t"), F.col("d1").alias("a1"), F.col("d2").alias("a2"))
            ties = own.join(both, ["a_id", "t"]).join(seen.select(F.col("doc_id").alias("b_id"), F.col("digest").alias("s"), F.col("d1").alias("b1"), F.col("d2").alias("b2")), ["b_id", "s"]).select("a1", "a2", "b1", "b2")
            texts, known = texts.union(other.select("doc_id", "text")), known.union(seen.drop("digest"))
        parts = linked_components(texts, known, ties)
        rows = base.where("n_shingles > 0").select("d1", "d2", F.struct(F.col("own_id").isNull().alias("none"), "own_id", "digest").alias("name"))
        # a row for each (doc_id, text) before the join, so that no number of equal rows weighs there
        rows = rows.groupBy("d1", "d2", "name").agg(F.count("*").alias("copies"))
        rows = cut(_in_components(rows, parts).select("c1", "c2", "name", "copies"))
        least = cut(rows.groupBy("c1", "c2").agg(F.min("name").alias("first")))
        judged = keep(cut(rows.join(least, ["c1", "c2"]).select("name", "copies", (F.col("name") == F.col("first")).alias("kept")).where("not kept or copies > 1")))

    key = f"_key_{uuid.uuid4().hex[:8]}"
    whole = docs.withColumn(key, text_digest())
    named_so = lambda found: whole["doc_id"].cast("long").eqNullSafe(found[f"{key}_d"]) & (whole[key] == found[f"{key}_t"])
    found = judged.select(F.col("name.own_id").alias(f"{key}_d"), F.col("name.digest").alias(f"{key}_t"), "kept")
    gone = small_side(found)
    out = whole.join(gone, named_so(gone), "left_anti").drop(key)
    repeated = found.where("kept").drop("kept")
    if repeated.isEmpty():
        return out
    return out.union(whole.join(repeated, named_so(repeated), "left_semi").dropDuplicates(["doc_id", key]).drop(key))
