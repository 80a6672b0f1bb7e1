"""Quality classifier: a byte-level convolutional network in numpy.

A text's UTF-8 bytes are covered by overlapping chunks.  Bytes are embedded,
learned filters slide over every chunk, each filter's largest answer in a chunk
is kept, and the mean and the maximum of these over all chunks of the text are
combined into one probability.  The filters are trained by back-propagation
through the places of the maxima.

Fitting takes a bounded sample of labelled rows (``SAMPLE_ROWS``, in the order
of a hash of the id), whole texts of them as scoring does.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from vitrine.llm import common as C

CHUNK, OVERLAP = 512, 64
WIDTH, STRIDE = 12, 4
EMBED, FILTERS = 8, 24
SAMPLE_ROWS = 3000
EPOCHS, BATCH, RATE = 10, 64, 0.004
PLACES = (CHUNK - WIDTH) // STRIDE + 1
#: Chunks that go through the filters at once.
STEP = 256


def chunk_starts(size: int) -> np.ndarray:
    """Where the chunks of a text of ``size`` bytes begin; an empty text has one empty chunk."""
    return np.arange(0, max(size - OVERLAP, 1), CHUNK - OVERLAP)


def chunks_of(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """The bytes of chunks as rows; what lies behind a text's end is 0."""
    at = start[:, None] + np.arange(CHUNK)
    return np.where(at < end[:, None], data[np.minimum(at, max(len(data) - 1, 0))] if len(data) else 0, 0).astype(np.uint8)


class Network:
    """Parameters of the network; small enough to travel with every task."""

    def __init__(self, seed: int = 3):
        rng = np.random.default_rng(seed)
        self.embed = rng.normal(0, 0.5, (256, EMBED)).astype(np.float32)
        self.filters = rng.normal(0, (WIDTH * EMBED) ** -0.5, (WIDTH * EMBED, FILTERS)).astype(np.float32)
        self.bias = np.zeros(FILTERS, np.float32)
        self.out = np.zeros(2 * FILTERS, np.float32)
        self.base = np.zeros(1, np.float32)

    def names(self):
        return ("embed", "filters", "bias", "out", "base")

    def pooled(self, chunks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Largest answer of every filter in every chunk, and at which place."""
        x = self.embed[chunks].reshape(len(chunks), CHUNK * EMBED)
        step = x.strides[1]
        view = np.lib.stride_tricks.as_strided(
            x, (len(chunks), PLACES, WIDTH * EMBED), (x.strides[0], STRIDE * EMBED * step, step))
        answers = np.ascontiguousarray(view).reshape(-1, WIDTH * EMBED) @ self.filters
        answers = answers.reshape(len(chunks), PLACES, FILTERS)
        place = answers.argmax(1)
        top = np.take_along_axis(answers, place[:, None], 1)[:, 0] + self.bias
        return np.maximum(top, 0), place

    def probability(self, top: np.ndarray, first: np.ndarray) -> np.ndarray:
        """Of texts whose chunks' answers begin at ``first``."""
        count = np.diff(np.append(first, len(top)))
        mean = np.add.reduceat(top, first) / count[:, None]
        z = np.hstack((mean, np.maximum.reduceat(top, first))) @ self.out + self.base
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))

    def gradients(self, chunks: np.ndarray, first: np.ndarray, label: np.ndarray) -> dict:
        pooled = [self.pooled(chunks[a:a + STEP]) for a in range(0, len(chunks), STEP)]
        top, place = (np.concatenate(x) for x in zip(*pooled))
        count = np.diff(np.append(first, len(top)))
        text = np.repeat(np.arange(len(first)), count)
        mean = np.add.reduceat(top, first) / count[:, None]
        most = np.maximum.reduceat(top, first)
        joined = np.hstack((mean, most))
        miss = (1 / (1 + np.exp(-np.clip(joined @ self.out + self.base, -30, 30))) - label) / len(label)
        grad = {"out": joined.T @ miss + 1e-4 * self.out, "base": np.array([miss.sum()])}
        back = np.outer(miss, self.out)
        at_most = top == most[text]
        ties = np.add.reduceat(at_most.astype(np.float32), first)
        d_top = back[text, :FILTERS] / count[text][:, None] + back[text, FILTERS:] * at_most / ties[text]
        d_top = (d_top * (top > 0)).astype(np.float32)
        grad["bias"] = d_top.sum(0)
        grad["filters"], grad["embed"] = np.zeros_like(self.filters), np.zeros_like(self.embed)
        for a in range(0, len(chunks), STEP):
            self._back(chunks[a:a + STEP], place[a:a + STEP], d_top[a:a + STEP], grad)
        return grad

    def _back(self, chunks: np.ndarray, place: np.ndarray, d_top: np.ndarray, grad: dict) -> None:
        """Adds the gradients of filters and embedding that come through some chunks' maxima."""
        bytes_at = place[:, :, None] * STRIDE + np.arange(WIDTH)
        seen = np.take_along_axis(chunks, bytes_at.reshape(len(chunks), -1), 1).reshape(len(chunks), FILTERS, WIDTH)
        patch = self.embed[seen].reshape(len(chunks), FILTERS, -1)
        grad["filters"] += np.einsum("cf,cfk->kf", d_top, patch)
        d_patch = (d_top[:, :, None] * self.filters.T[None]).reshape(-1, EMBED)
        order = np.argsort(seen.ravel(), kind="stable")
        found, cut = np.unique(seen.ravel()[order], return_index=True)
        grad["embed"][found] += np.add.reduceat(d_patch[order], cut)

    def fit(self, bags: list[np.ndarray], labels: np.ndarray, seed: int = 5) -> "Network":
        """Adam over batches of texts in a seeded order."""
        rng = np.random.default_rng(seed)
        share = float(np.clip(labels.mean(), 0.01, 0.99))
        self.base[:] = np.log(share / (1 - share))
        first, second, t = {n: 0.0 for n in self.names()}, {n: 0.0 for n in self.names()}, 0
        total = EPOCHS * -(-len(bags) // BATCH)
        for _ in range(EPOCHS):
            order = rng.permutation(len(bags))
            for a in range(0, len(order), BATCH):
                mine = [bags[i] for i in order[a:a + BATCH]]
                begin = np.cumsum([0, *[len(b) for b in mine[:-1]]])
                grad = self.gradients(np.concatenate(mine), begin, labels[order[a:a + BATCH]])
                t += 1
                rate = RATE * min(1, 2 * (1 - t / (total + 1)))
                for n in self.names():
                    first[n] = 0.9 * first[n] + 0.1 * grad[n]
                    second[n] = 0.999 * second[n] + 0.001 * grad[n] ** 2
                    step = first[n] / (1 - 0.9 ** t) / (np.sqrt(second[n] / (1 - 0.999 ** t)) + 1e-8)
                    setattr(self, n, (getattr(self, n) - rate * step).astype(np.float32))
        return self

    def score(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Probability of every text that lies between two offsets."""
        starts = [chunk_starts(n) for n in np.diff(offsets)]
        count = np.array([len(s) for s in starts])
        first = np.cumsum(count) - count
        row = np.repeat(np.arange(len(count)), count)
        begin, end = np.concatenate(starts) + offsets[row], offsets[row + 1]
        top = np.concatenate([self.pooled(chunks_of(data, begin[a:a + STEP], end[a:a + STEP]))[0]
                              for a in range(0, len(begin), STEP)])
        return self.probability(top, first)


def _bags(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in C.pieces(batch, "text"):
            data, offsets = C.text_bytes(part.column("text"))
            bags = []
            for a, b in zip(offsets[:-1], offsets[1:]):
                starts = chunk_starts(b - a)
                bags.append(chunks_of(data, starts + a, np.full(len(starts), b)).tobytes())
            yield C.rows({"doc_id": part.column("doc_id"), "quality": part.column("quality"),
                          "bag": pa.array(bags, pa.binary())})


def fit(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS) -> Network | None:
    """A network for ``labels`` (doc_id, quality) of ``docs`` (doc_id, text); None without two classes.

    Rows with a null id or label teach nothing; an id with several labels has
    their maximum.  At most ``sample_rows`` labels are taken, and of their rows
    (an id may be repeated) the first ``sample_rows`` by id and text.
    """
    chosen = (labels.filter("doc_id is not null and quality is not null").groupBy("doc_id")
              .agg(F.max("quality").cast("int").alias("quality"))
              .orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample_rows))
    texts = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").join(
        F.broadcast(chosen.select(F.col("doc_id").cast("bigint").alias("doc_id"), "quality")), "doc_id")
    taken = texts.orderBy("doc_id", F.xxhash64("text"), "text").limit(sample_rows)
    rows = taken.mapInArrow(_bags, "doc_id bigint, quality int, bag binary").collect()
    rows.sort(key=lambda r: (r.doc_id, r.bag))
    label = np.array([float(r.quality == 1) for r in rows], np.float32)
    if len(set(label.tolist())) < 2:
        return None
    return Network().fit([np.frombuffer(r.bag, np.uint8).reshape(-1, CHUNK) for r in rows], label)


def score(docs: DataFrame, network: Network | None, fallback: float = 0.5) -> DataFrame:
    """``docs`` (doc_id, text, and others) with ``score``, the probability of quality 1.

    Null and empty texts are scored as an empty chunk.  Without a network every
    score is ``fallback``.  A column named score that ``docs`` has is replaced.
    Repeated rows and null ids are rows like others; an empty table gives an
    empty table.
    """
    docs = docs.drop("score")
    if network is None:
        return docs.withColumn("score", F.lit(float(fallback)))
    names = [f.name for f in docs.schema]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in C.pieces(batch, "text"):
                got = network.score(*C.text_bytes(part.column("text")))
                yield C.rows({n: part.column(n) for n in names} | {"score": pa.array(got.astype(np.float64))})

    kinds = ", ".join(f"`{n}` {docs.schema[n].dataType.simpleString()}" for n in names)
    return docs.mapInArrow(run, kinds + ", score double")
