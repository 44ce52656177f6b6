"""Quality classifier: a byte-level convolutional network in numpy.

A text's UTF-8 bytes are read in chunks of 512 bytes, one at every 256, that cover all of
it, so neighbouring chunks overlap by half; each filter looks at eight bytes and moves by
four, and past its chunk's end. In each chunk a filter keeps its maximum. The document is
the mean and the maximum of its chunks' maxima, and a small dense layer turns both into
one probability.

Training runs on the driver over a bounded sample of labelled rows, each a whole text: in
the order of a hash of doc_id at most ``SAMPLE`` documents of at most ``SAMPLE_TEXT`` bytes
each and ``SAMPLE_BYTES`` together. Scoring reads every byte of every document. Only documents
whose crc32 of doc_id is not a multiple of five are trained on, and only their bytes.

Defined results: a null text is an empty one; an empty text is one chunk of zeros
and gets a score; repeated rows get a row each and equal scores; null ``doc_id``
rows are scored and not held out; without a usable label of both kinds the model is
untrained and every score is 0.5; of labels that differ for one doc_id the higher is
taken, and of texts that differ the one with the lowest hash; an empty table gives no
rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from claimloom.llm.common import OWN, portions, text_of, utf8

CHUNK, HALF, STEP, WIDTH = 512, 256, 4, 8
DIM, FILTERS, HIDDEN = 8, 32, 16
#: The bound of the training sample: documents, bytes of each, and bytes in all.
SAMPLE, SAMPLE_TEXT, SAMPLE_BYTES = 2400, 1 << 17, 1 << 23
EPOCHS, BATCH = 14, 32
THRESHOLD = 0.3
#: Bytes scored at a time; a longer text is scored in portions that see each other's edges.
PORTION = 1 << 18
_SCORES = "doc_id bigint, held_out boolean, score double, predicted int"


def held_out() -> Column:
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 5 == 0, F.lit(False))


def _classes() -> np.ndarray:
    """Fixed features of a byte: capital, small letter, digit, white space, other ASCII sign, part of another character."""
    b = np.arange(256)
    capital, small, digit = (b >= 65) & (b <= 90), (b >= 97) & (b <= 122), (b >= 48) & (b <= 57)
    white = (b == 32) | ((b >= 9) & (b <= 13))
    sign = (b > 32) & (b < 127) & ~capital & ~small & ~digit
    return np.stack([capital, small, digit, white, sign, b >= 128], axis=1).astype(np.float32)


def _next(found: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """The half chunk after each one, zeros after a text's last."""
    after = np.concatenate([found[1:], np.zeros_like(found[:1])])
    after[starts[1:] - 1] = 0
    return after


@dataclass
class Network:
    embed: np.ndarray  # 256 x DIM
    filters: np.ndarray  # 2 x (STEP * DIM) x FILTERS: the first and the last four bytes of a window
    bias: np.ndarray  # FILTERS
    dense: np.ndarray  # 2 * FILTERS x HIDDEN
    dense_bias: np.ndarray
    out: np.ndarray  # HIDDEN
    out_bias: np.ndarray  # 1
    mean: np.ndarray  # of the pooled features
    scale: np.ndarray

    @classmethod
    def fresh(cls, seed: int = 7) -> Network:
        r = np.random.default_rng(seed)
        f = lambda *shape, s: r.normal(0, s, shape).astype(np.float32)
        embed = np.concatenate([_classes(), f(256, DIM - 6, s=0.5)], axis=1)
        embed[0] = 0
        return cls(embed, f(2, STEP * DIM, FILTERS, s=0.35), f(FILTERS, s=0.1), f(2 * FILTERS, HIDDEN, s=0.2), np.zeros(HIDDEN, np.float32), f(HIDDEN, s=0.3), np.zeros(1, np.float32), np.zeros(2 * FILTERS, np.float32), np.ones(2 * FILTERS, np.float32))

    def weights(self) -> list[np.ndarray]:
        return [self.embed, self.filters, self.bias, self.dense, self.dense_bias, self.out, self.out_bias]

    def responses(self, data: np.ndarray, starts: np.ndarray) -> np.ndarray:
        """Filter responses at every fourth byte of ``data``: positions x FILTERS.

        ``starts`` are the half chunks with which texts start; zeros follow a text's end.
        """
        blocks = self.embed[data].reshape(-1, STEP * DIM)
        first, last = blocks @ self.filters[0], blocks @ self.filters[1]
        last[starts * (HALF // STEP)] = 0
        first[:-1] += last[1:]
        return first + self.bias

    def pooled(self, data: np.ndarray, starts: np.ndarray) -> np.ndarray:
        """Chunk maxima of the responses, none below zero: a chunk at each half chunk x FILTERS."""
        found = self.responses(data, starts).reshape(-1, HALF // STEP, FILTERS)
        found = np.maximum(found.max(axis=1), 0)
        return np.maximum(found, _next(found, starts))

    def probability(self, features: np.ndarray) -> np.ndarray:
        hidden = np.maximum(((features - self.mean) / self.scale) @ self.dense + self.dense_bias, 0)
        return 1 / (1 + np.exp(-np.clip(hidden @ self.out + self.out_bias[0], -30, 30)))

    def score(self, texts: list[bytes]) -> np.ndarray:
        """The probabilities of whole texts, a portion of bytes at a time."""
        maxima, sums, counts, owner = [], [], [], []
        held: list[tuple[bytes, int]] = []  # padded bytes, and how many of their half chunks count

        def flush() -> None:
            if held:
                sizes = np.array([len(h) // HALF for h, _ in held])
                starts = np.concatenate([[0], np.cumsum(sizes)[:-1]])
                used = np.array([n for _, n in held])
                ends = np.stack([starts, starts + used], axis=1).ravel()
                found = self.pooled(np.frombuffer(b"".join(h for h, _ in held), np.uint8), starts)
                found = np.concatenate([found, np.zeros((1, FILTERS), np.float32)])
                maxima.append(np.maximum.reduceat(found, ends)[::2])
                sums.append(np.add.reduceat(found, ends, dtype=np.float64)[::2])
                counts.append(used)
                held.clear()

        size = 0
        for n, text in enumerate(texts):
            for at in range(0, max(1, len(text)), PORTION):
                part = text[at : at + PORTION + CHUNK]  # the next chunk is seen, not counted
                padded = part + bytes(-len(part) % HALF if part else HALF)
                held.append((padded, min(len(padded), PORTION) // HALF))
                owner.append(n)
                size += len(padded)
                if size >= PORTION:
                    flush()
                    size = 0
        flush()
        if not owner:
            return np.zeros(0)
        starts = np.concatenate([[0], 1 + np.flatnonzero(np.diff(owner))])
        most = np.maximum.reduceat(np.concatenate(maxima), starts)
        mean = np.add.reduceat(np.concatenate(sums), starts) / np.add.reduceat(np.concatenate(counts), starts)[:, None]
        return self.probability(np.concatenate([mean, most], axis=1).astype(np.float32))


def train(samples: list[bytes], labels: np.ndarray, epochs: int = EPOCHS, seed: int = 7) -> Network:
    """Adam over the logistic loss. Each sample is whole half chunks."""
    net = Network.fresh(seed)
    if len(set(labels.tolist())) < 2:
        net.out[:] = 0
        return net
    rng = np.random.default_rng(seed)
    first = [net.pooled(np.frombuffer(s, np.uint8), np.zeros(1, int)) for s in samples[:400]]
    features = np.array([np.concatenate([x.mean(axis=0), x.max(axis=0)]) for x in first])
    net.mean, net.scale = features.mean(axis=0), features.std(axis=0) + 0.1
    moments = [(np.zeros_like(w), np.zeros_like(w)) for w in net.weights()]
    weight = np.where(labels == 1, 0.5 / labels.mean(), 0.5 / (1 - labels.mean())) ** 0.5
    done = 0
    for epoch in range(epochs):
        rate = 0.004 * (1 - epoch / epochs) + 0.0003
        order = rng.permutation(len(samples))
        for at in range(0, len(order), BATCH):
            own = order[at : at + BATCH]
            done += 1
            for w, g, (m, v) in zip(net.weights(), _gradients(net, [samples[i] for i in own], labels[own], weight[own]), moments, strict=True):
                m += 0.1 * (g - m)
                v += 0.001 * (g * g - v)
                w -= rate * (m / (1 - 0.9**done)) / (np.sqrt(v / (1 - 0.999**done)) + 1e-8)
    return net


def _gradients(net: Network, samples: list[bytes], labels: np.ndarray, weight: np.ndarray) -> list[np.ndarray]:
    counts = np.array([len(s) // HALF for s in samples])
    starts = np.concatenate([[0], np.cumsum(counts)[:-1]])
    data = np.frombuffer(b"".join(samples), np.uint8)
    found = net.responses(data, starts).reshape(-1, HALF // STEP, FILTERS)
    where = found.argmax(axis=1)
    top = np.take_along_axis(found, where[:, None, :], axis=1)[:, 0]
    active = top > 0
    top = np.maximum(top, 0)
    after = _next(top, starts)
    owner = np.repeat(np.arange(len(samples)), counts)
    mean = np.add.reduceat(np.maximum(top, after), starts) / counts[:, None]
    most = np.maximum.reduceat(top, starts)
    z = (np.concatenate([mean, most], axis=1) - net.mean) / net.scale
    before = z @ net.dense + net.dense_bias
    hidden = np.maximum(before, 0)
    p = 1 / (1 + np.exp(-np.clip(hidden @ net.out + net.out_bias[0], -30, 30)))
    g = ((p - labels) * weight / len(samples)).astype(np.float32)
    g_hidden = np.outer(g, net.out) * (before > 0)
    g_z = (g_hidden @ net.dense.T) / net.scale
    is_most = (top == most[owner]) & active
    g_chunk = g_z[owner, :FILTERS] / counts[owner, None]
    from_after = g_chunk * (after > top)  # the chunk's maximum lies in its second half
    g_top = g_chunk - from_after
    g_top[1:] += from_after[:-1]
    g_top = g_top * active + g_z[owner, FILTERS:] * is_most
    # Each maximum reaches back to the eight bytes of its window.
    chunk, filt = np.nonzero(g_top)
    block = chunk * (HALF // STEP) + where[chunk, filt]
    at = block[:, None] * STEP + np.arange(WIDTH)
    ends = np.isin(block + 1, np.append(starts, counts.sum()) * (HALF // STEP))
    inside = ~ends[:, None] | (np.arange(WIDTH) < STEP)
    seen = np.where(inside, data[np.minimum(at, len(data) - 1)], 0)
    value = g_top[chunk, filt].astype(np.float32)
    window = (net.embed[seen] * inside[:, :, None]).reshape(len(chunk), WIDTH * DIM)
    g_filters = np.zeros((FILTERS, WIDTH * DIM), np.float32)
    np.add.at(g_filters, filt, window * value[:, None])
    both = np.concatenate([net.filters[0], net.filters[1]], axis=0)  # WIDTH * DIM x FILTERS
    g_window = (both.T[filt] * value[:, None]).reshape(-1, DIM) * inside.reshape(-1, 1)
    g_embed = np.zeros_like(net.embed)
    np.add.at(g_embed, seen.ravel(), g_window)
    g_embed[0] = 0
    g_filters = g_filters.T.reshape(2, STEP * DIM, FILTERS)
    return [g_embed, g_filters, g_top.sum(axis=0), z.T @ g_hidden, g_hidden.sum(axis=0), hidden.T @ g, g.sum(keepdims=True)]


def whole(text: bytes) -> bytes:
    """The text as whole half chunks, one of zeros at least."""
    return text + bytes(-len(text) % HALF if text else HALF)


def training_rows(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, text_bytes: int = SAMPLE_TEXT, total_bytes: int = SAMPLE_BYTES) -> tuple[list[bytes], np.ndarray]:
    """The bounded sample: whole texts and their labels, in the order of a hash of doc_id."""
    order = [F.xxhash64(f"{OWN}id"), F.col(f"{OWN}id")]
    chosen = (
        labels.select(F.col("doc_id").cast("bigint").alias(f"{OWN}id"), F.col("quality").cast("int").alias("quality"))
        .filter(f"{OWN}id IS NOT NULL AND quality IN (0, 1) AND crc32(cast({OWN}id AS string)) % 5 <> 0")
        .groupBy(f"{OWN}id")
        .agg(F.max("quality").alias("quality"))
        .orderBy(*order)
        .limit(sample)
    )
    texts = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), text_of().alias("text")).filter(F.octet_length("text") <= text_bytes)
    joined = texts.join(F.broadcast(chosen), F.col("doc_id") == F.col(f"{OWN}id"))  # ``sample`` rows at most
    one = joined.groupBy(f"{OWN}id", "quality").agg(F.min(F.struct(F.xxhash64("text").alias("hash"), "text")).getField("text").alias("text"))
    before = F.sum(F.octet_length("text")).over(Window.orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow))
    rows = one.withColumn("bytes", before).filter(F.col("bytes") <= total_bytes).orderBy(*order).collect()
    return [whole(r.text.encode()) for r in rows], np.array([r.quality for r in rows], dtype=np.float32)


def fit(docs: DataFrame, labels: DataFrame) -> Network:
    return train(*training_rows(docs, labels))


def score(docs: DataFrame, net: Network, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, held_out, score and predicted for every document."""
    shared = docs.sparkSession.sparkContext.broadcast(net)  # some 40 kB, whatever the input

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in portions(batches):
            found = shared.value.score(utf8(batch.column(2))).astype(np.float64)
            columns = [batch.column(0), batch.column(1), pa.array(found), pa.array((found >= threshold).astype(np.int32))]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "held_out", "score", "predicted"])

    source = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), held_out().alias("held_out"), text_of().alias("text"))
    return source.mapInArrow(rows, _SCORES)


def classify(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Trains on the labelled sample of ``docs`` and scores all of them."""
    return score(docs, fit(docs, labels))


def accepted(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs``, unchanged, that the classifier does not reject."""
    shared = docs.sparkSession.sparkContext.broadcast(fit(docs, labels))
    place = docs.columns.index("text")

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in portions(batches):
            texts = [t or b"" for t in utf8(batch.column(place))]
            yield batch.filter(pa.array(shared.value.score(texts) >= threshold))

    return docs.mapInArrow(rows, docs.schema)
