"""Quality classifier: a byte-level convolutional network in numpy (operator 8).

A text's UTF-8 bytes are embedded, each together with how far back the four bytes that end there stood last (within REACH
bytes), so that filters see words said over and over. Learned filters, WIDTH bytes wide and moved by STEP, run over all
of it. Their outputs are max-pooled over chunks of two blocks each, neighbouring chunks overlapping by one block, so the chunks cover the
whole document. A hidden layer reads each chunk; its units are pooled over all chunks (maximum and mean) and combined
by a logistic unit into one probability. The text is the only input.

Training runs on a bounded sample of labelled rows: at most SAMPLE documents, those whose ids hash lowest, taken in that
order while they hold at most SAMPLE_BYTES together; each is read whole, but one of more than LONGEST bytes by PIECES
stretches spread evenly over it, which come to LONGEST bytes at most. Rows whose crc32(doc_id as text) leaves 0 modulo FOLDS are held out. Two networks learn, each from three quarters
of the sample, with the two kinds of label weighing alike; their mean logit is scaled and shifted as fits the quarters that
each hasn't seen. Every other time a text is met, a random stretch of it stands in for it. Scoring reads whole texts, a bounded slice at a time.

Defined cases: null or empty text is scored as padding alone; its score is that of an empty text. Labels that are
null or of unknown documents are not used; a doc_id labelled more than once counts once, by its largest label, and one
with several texts by that of the smallest hash. Without labels of both kinds the score is the share of label 1 (0.5
without any). Repeated rows give equal rows; extra columns aren't read.
"""

from __future__ import annotations

import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from seatloom.llm.common import bound_batches, cut, fields, raw_bytes, tidy

WIDTH, STEP, BLOCK = 8, 4, 128
#: How far back a byte looks for its like; as many zeros stand before each text, so none looks into another.
REACH = LEAD = 32
#: Kinds of distance: none, then up to these.
NEAR = (6, 12, REACH)
KINDS = 1 + len(NEAR)
EMBED, FILTERS, HIDDEN = 8, 32, 24
SAMPLE, SAMPLE_BYTES, LONGEST, FOLDS = 4000, 64 << 20, 4 << 20, 5
PIECES = 16
STEPS, BATCH, RATE, DECAY = 1000, 32, 3e-3, 1e-4
THRESHOLD = 0.3
SLICE = 1 << 18


def symbols(data: np.ndarray) -> np.ndarray:
    """Each byte with its kind of distance to the last place of the four bytes that end there: byte + 256 * kind."""
    out = data.astype(np.uint16)
    if len(data) <= 4:
        return out
    four = data[3:].astype(np.uint32)
    for i in (1, 2, 3):
        four = four << np.uint32(8) | data[3 - i : -i]
    kind = np.zeros(len(four), np.uint16)
    for lag in range(REACH, 0, -1):  # the nearest is written last
        np.putmask(kind[lag:], four[lag:] == four[:-lag], 1 + sum(lag > n for n in NEAR))
    kind[four == 0] = 0
    out[3:] += kind << 8
    return out


def padded(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """All bytes, each text after LEAD zeros and filled with zeros to whole blocks (two at least), and where each text's
    blocks begin. A filter that reaches past a text's last block sees only the zeros before the next one."""
    blocks = np.array([max(2, -(-(len(t) + LEAD) // BLOCK)) for t in texts], np.int64)
    at = np.r_[0, np.cumsum(blocks)]
    data = np.zeros(at[-1] * BLOCK + WIDTH, np.uint8)
    for t, a in zip(texts, at[:-1], strict=True):
        data[a * BLOCK + LEAD : a * BLOCK + LEAD + len(t)] = np.frombuffer(t, np.uint8)
    return symbols(data), at


class Network:
    """Parameters: embedding, filters, chunk layer, output."""

    def __init__(self, seed: int = 7):
        r = np.random.default_rng(seed)
        draw = lambda *shape, scale: (r.standard_normal(shape) * scale).astype(np.float32)
        self.p = {
            "embed": draw(256, EMBED, scale=0.5), "near": draw(KINDS, EMBED, scale=0.5), "w1": draw(WIDTH * EMBED, FILTERS, scale=(2 / (WIDTH * EMBED)) ** 0.5), "b1": np.zeros(FILTERS, np.float32),
            "w2": draw(FILTERS, HIDDEN, scale=(2 / FILTERS) ** 0.5), "b2": np.zeros(HIDDEN, np.float32), "w3": draw(2 * HIDDEN, scale=0.1), "b3": np.zeros(1, np.float32),
        }

    def _windows(self, data: np.ndarray) -> np.ndarray:
        """Embedded bytes of every filter place: places x (WIDTH * EMBED)."""
        x = (self.p["near"][:, None] + self.p["embed"][None]).reshape(-1, EMBED)[data]
        n = (len(data) - WIDTH) // STEP
        s = x.strides
        return np.lib.stride_tricks.as_strided(x, (n, WIDTH, EMBED), (STEP * s[0], s[0], s[1])).reshape(n, WIDTH * EMBED)

    def forward(self, data: np.ndarray, at: np.ndarray, keep: bool = False):
        """Logits of the texts that padded() has laid out so."""
        p = self.p
        texts = range(len(at) - 1)
        places = self._windows(data)
        responses = (places @ p["w1"] + p["b1"]).reshape(at[-1], BLOCK // STEP, FILTERS)
        best = responses.max(1)
        block = np.maximum(best, 0)
        inner = np.ones(at[-1], bool)
        inner[at[1:] - 1] = False  # a text's last block begins no chunk
        left = np.flatnonzero(inner)
        chunk = np.maximum(block[left], block[left + 1])
        hidden = np.maximum(chunk @ p["w2"] + p["b2"], 0)
        first = at[:-1] - np.arange(len(texts))  # a text has one chunk less than blocks
        count = np.diff(at) - 1
        top, mean = np.maximum.reduceat(hidden, first), np.add.reduceat(hidden, first) / count[:, None]
        pooled = np.concatenate([top, mean], 1)
        logit = pooled @ p["w3"] + p["b3"][0]
        if keep:
            return logit, (data, at, places, responses, best, block, left, chunk, hidden, count, top, pooled)
        return logit

    def gradients(self, texts: list[bytes], labels: np.ndarray, weights: np.ndarray) -> tuple[float, dict[str, np.ndarray]]:
        """Weighted mean log loss and its gradients; a maximum hands its share to the place it came from."""
        p = self.p
        logit, (data, at, places, responses, best, block, left, chunk, hidden, count, top, pooled) = self.forward(*padded(texts), True)
        prob = 1 / (1 + np.exp(-logit))
        d = ((prob - labels) * weights / len(labels)).astype(np.float32)
        g = {"w3": pooled.T @ d, "b3": np.array([d.sum()], np.float32)}
        text = np.repeat(np.arange(len(count)), count)
        d_hidden = (d[:, None] * p["w3"][HIDDEN:] / count[:, None])[text]
        is_top = hidden == top[text]
        share = np.add.reduceat(is_top.astype(np.float32), at[:-1] - np.arange(len(texts)))
        d_hidden += is_top * (d[:, None] * p["w3"][:HIDDEN] / share)[text]
        d_hidden *= hidden > 0
        g["w2"], g["b2"] = chunk.T @ d_hidden, d_hidden.sum(0)
        d_chunk = d_hidden @ p["w2"].T
        from_left = block[left] >= block[left + 1]
        d_block = np.zeros_like(block)
        d_block[left] += d_chunk * from_left
        np.add.at(d_block, left + 1, d_chunk * ~from_left)
        d_block *= best > 0
        g["b1"] = d_block.sum(0)
        # a filter's response is the sum of what each byte of its window adds: gradients of those, per place in the window
        where = (responses.argmax(1) + np.arange(len(best))[:, None] * (BLOCK // STEP)) * STEP  # blocks x filters: first byte
        live = np.flatnonzero(d_block)
        first, share, number = where.reshape(-1)[live], d_block.reshape(-1)[live], live % FILTERS
        adds = np.stack([np.bincount(data[first + o].astype(np.int64) * FILTERS + number, share, KINDS * 256 * FILTERS) for o in range(WIDTH)]).astype(np.float32)
        adds = adds.reshape(WIDTH, KINDS, 256, FILTERS)
        byte, near = adds.sum(1), adds.sum(2)
        g["w1"] = (np.matmul(p["embed"].T, byte) + np.matmul(p["near"].T, near)).reshape(WIDTH * EMBED, FILTERS)
        back = p["w1"].reshape(WIDTH, EMBED, FILTERS).transpose(0, 2, 1)
        g["embed"], g["near"] = np.matmul(byte, back).sum(0), np.matmul(near, back).sum(0)
        loss = float(np.mean(weights * (np.logaddexp(0, logit) - labels * logit)))
        return loss, g

    def long(self, whole: np.ndarray) -> float:
        """The logit of one text, stretch by stretch, with the same chunks as at once."""
        p, tops, total, n, last = self.p, [], 0.0, 0, None
        step = SLICE // BLOCK * BLOCK
        size = len(whole) - WIDTH
        for a in range(0, size, step):
            part = whole[a : min(a + step, size) + WIDTH]
            block = np.maximum((self._windows(part) @ p["w1"] + p["b1"]).reshape(-1, BLOCK // STEP, FILTERS).max(1), 0)
            joined = block if last is None else np.concatenate([last[None], block])
            last = block[-1]
            if len(joined) < 2:
                continue
            hidden = np.maximum(np.maximum(joined[:-1], joined[1:]) @ p["w2"] + p["b2"], 0)
            tops.append(hidden.max(0))
            total, n = total + hidden.sum(0), n + len(hidden)
        return float(np.concatenate([np.max(tops, 0), total / n]) @ p["w3"] + p["b3"][0])


def logits(networks: list[Network], texts: list[bytes]) -> np.ndarray:
    """Networks x texts. About SLICE bytes are laid out at a time; a longer text alone is read in stretches."""
    out = np.empty((len(networks), len(texts)))
    i = 0
    while i < len(texts):
        j, size = i, 0
        while j < len(texts) and (j == i or size + len(texts[j]) <= SLICE):
            size += len(texts[j]) + 2 * BLOCK
            j += 1
        data, at = padded(texts[i:j])
        for k, net in enumerate(networks):
            out[k, i:j] = net.forward(data, at) if size <= 2 * SLICE else net.long(data)
        i = j
    return out


class Pair:
    """Networks with one scale and shift of their mean logit."""

    def __init__(self, networks: list[Network], scale: float, shift: float):
        self.networks, self.scale, self.shift = networks, scale, shift

    def score(self, texts: list[bytes]) -> np.ndarray:
        mean = logits(self.networks, texts).mean(0)
        return 1 / (1 + np.exp(-np.clip(self.scale * mean + self.shift, -500, 500)))


class Constant:
    """What stands in when there is nothing to tell apart."""

    def __init__(self, share: float):
        self.share = share

    def score(self, texts: list[bytes]) -> np.ndarray:
        return np.full(len(texts), self.share)


def _alike(labels: np.ndarray) -> np.ndarray:
    """Weights by which both kinds of label count the same."""
    return np.where(labels == 1, 0.5 / labels.mean(), 0.5 / (1 - labels.mean())).astype(np.float32)


def _part(text: bytes, r: np.random.Generator) -> bytes:
    """The whole text, or every other time a stretch of it, so that few long documents also teach short ones."""
    size = int(len(text) * r.uniform(0.05, 1)) if r.random() < 0.5 else len(text)
    begin = int(r.integers(0, len(text) - size + 1))
    return text[begin : begin + size]


def _learn(texts: list[bytes], labels: np.ndarray, seed: int) -> Network:
    """A network after STEPS steps of Adam on batches of whole texts."""
    net, r = Network(seed), np.random.default_rng(seed)
    labels = labels.astype(np.float32)
    weights = _alike(labels)
    first, second = {k: np.zeros_like(v) for k, v in net.p.items()}, {k: np.zeros_like(v) for k, v in net.p.items()}
    order = np.zeros(0, np.int64)
    for t in range(1, STEPS + 1):
        if len(order) < BATCH:
            order = np.r_[order, r.permutation(len(texts))]
        pick, order = order[:BATCH], order[BATCH:]
        _, g = net.gradients([_part(texts[k], r) for k in pick], labels[pick], weights[pick])
        rate = RATE * min(1, t / 50) * 0.5 * (1 + np.cos(np.pi * t / STEPS))
        for k, v in net.p.items():
            grad = g[k] + DECAY * v
            first[k] = 0.9 * first[k] + 0.1 * grad
            second[k] = 0.999 * second[k] + 0.001 * grad * grad
            v -= (rate * (first[k] / (1 - 0.9**t)) / (np.sqrt(second[k] / (1 - 0.999**t)) + 1e-8)).astype(np.float32)
    return net


def calibrated(logits: np.ndarray, labels: np.ndarray) -> tuple[float, float]:
    """Scale and shift by logistic regression with both kinds weighing alike, on targets a little inside 0 and 1."""
    n = np.array([(labels == 0).sum(), (labels == 1).sum()])
    target, weight = np.where(labels == 1, (n[1] + 1) / (n[1] + 2), 1 / (n[0] + 2)), _alike(labels)
    w, x = np.array([1.0, 0.0]), np.stack([logits, np.ones_like(logits)], 1)
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -500, 500)))
        slope = x.T @ (weight * (p - target)) + 1e-3 * w
        bend = (x * (weight * p * (1 - p))[:, None]).T @ x + 1e-3 * np.eye(2)
        w = w - np.clip(np.linalg.solve(bend, slope), -1, 1)
    return float(max(w[0], 1e-3)), float(w[1])


def train(texts: list[bytes], labels: np.ndarray, seed: int = 7) -> Pair | Constant:
    if len(set(labels.tolist())) < 2:
        return Constant(float(labels.mean()) if len(labels) else 0.5)
    quarter = np.zeros(len(texts), np.int64)  # each kind of label is dealt to the quarters in turn
    order = np.random.default_rng(seed).permutation(len(texts))
    for kind in (0, 1):
        own = order[labels[order] == kind]
        quarter[own] = np.arange(len(own)) % 4
    nets, unseen, truth = [], [], []
    for q in (0, 1):
        apart = np.flatnonzero(quarter == q)
        rest = np.flatnonzero(quarter != q)
        if len(set(labels[rest].tolist())) < 2:
            rest = np.arange(len(texts))
        nets.append(_learn([texts[i] for i in rest], labels[rest], seed + q))
        unseen.append(logits(nets[-1:], [texts[i] for i in apart])[0])
        truth.append(labels[apart])
    unseen, truth = np.concatenate(unseen), np.concatenate(truth)
    return Pair(nets, *(calibrated(unseen, truth) if len(set(truth.tolist())) == 2 else (1.0, 0.0)))


def fold(doc_id: Column) -> Column:
    return F.crc32(doc_id.cast("string")) % FOLDS


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Pair | Constant:
    """Train on the labelled documents outside the held-out fold, at most `sample` of them: those whose ids hash lowest.

    The ids are picked first, by ids, lengths and hashes; only their texts come to the driver."""
    bound_batches(docs.sparkSession)
    known = fields(labels, "doc_id", "quality").where(F.col("quality").isin(0, 1) & F.col("doc_id").isNotNull() & (fold(F.col("doc_id")) != 0))
    known = known.groupBy("doc_id").agg(F.max("quality").alias("quality"))
    rows = fields(docs, "doc_id", "text").select("doc_id", F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    marks = rows.select("doc_id", F.struct(F.xxhash64("text").alias("hash"), F.octet_length("text").alias("size")).alias("mark"))
    here = marks.join(known, "doc_id").groupBy("doc_id", "quality").agg(F.min("mark").alias("mark")).select("doc_id", "quality", "mark.*")
    picked = here.orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)
    # a window over at most `sample` rows of numbers
    total = F.sum(F.least("size", F.lit(LONGEST))).over(Window.orderBy(F.xxhash64("doc_id"), "doc_id"))
    picked = cut(picked.withColumn("total", total).where(F.col("total") <= SAMPLE_BYTES).drop("total"))
    joined = rows.join(F.broadcast(picked), "doc_id").where((F.xxhash64("text") == F.col("hash")) & (F.octet_length("text") == F.col("size")))
    # a character has four bytes at most
    length, stretch = F.length("text"), max(1, LONGEST // PIECES // 4)
    pieces = F.transform(F.sequence(F.lit(0), F.lit(PIECES - 1)), lambda i: F.substring(F.col("text"), (F.floor(i * (length - stretch) / (PIECES - 1)) + 1).cast("int"), F.lit(stretch)))
    read = joined.withColumn("texts", F.when(F.col("size") > LONGEST, pieces).otherwise(F.array("text")))
    got = read.groupBy("doc_id").agg(F.max("quality").alias("quality"), F.min("texts").alias("texts")).toPandas().sort_values("doc_id")
    each = [(t.encode(), q) for texts, q in zip(got["texts"], got["quality"], strict=True) for t in texts]
    return train([t for t, _ in each], np.array([q for _, q in each], np.float32))


def score(docs: DataFrame, net: Pair | Constant) -> DataFrame:
    """docs with a column score; the other columns are carried."""
    spark = docs.sparkSession
    bound_batches(spark)
    shared = spark.sparkContext.broadcast(net)
    names = [c for c in docs.columns if c != "score"]
    rows = docs.select(*[F.col(f"`{c}`") for c in names])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, at = raw_bytes(batch.column("text"))
            texts = [data[a:b].tobytes() for a, b in zip(at[:-1], at[1:], strict=True)]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(shared.value.score(texts), pa.float64())], [*names, "score"])

    kinds = ", ".join(f"`{n}` {rows.schema[n].dataType.simpleString()}" for n in names)
    return rows.mapInArrow(tidy(run), f"{kinds}, score double")


def keep_good(docs: DataFrame, net: Pair | Constant) -> DataFrame:
    """The documents whose score reaches THRESHOLD, with all their columns."""
    name = f"_score_{uuid.uuid4().hex[:8]}"
    named = docs.withColumnRenamed("score", name) if "score" in docs.columns else docs
    kept = score(named, net).where(F.col("score") >= THRESHOLD).drop("score")
    return kept.withColumnRenamed(name, "score").select(*[F.col(f"`{c}`") for c in docs.columns])


def classify(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted (1 from THRESHOLD on)."""
    scored = score(fields(docs, "doc_id", "text"), fit(docs, labels))
    held = F.coalesce(fold(F.col("doc_id")) == 0, F.lit(False))
    return scored.select("doc_id", held.alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))


def held_out(doc_id: int) -> bool:
    return zlib.crc32(str(doc_id).encode()) % FOLDS == 0
