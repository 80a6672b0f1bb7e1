"""Benchmark decontamination by latent semantic retrieval.

Words are runs of bytes other than ASCII white space and punctuation, A-Z in
lower case.  Passages are cut into 16-word chunks; two neighbouring chunks make
a window.  For a block of benchmark items

1. every chunk of the corpus counts towards the document frequencies of the
   items' words;
2. a randomised range finder is pushed through the TF-IDF chunks of the whole
   corpus (each task folds its own), the block's own passages weighing as much
   as all of it, and gives the leading right singular vectors;
3. every window of every text is folded into that space, and items whose
   passages have a cosine near enough become candidates;
4. a candidate is confirmed by the longest common subsequence of the item's
   words and the words around the window: nearly all of the item, or most of
   it with its answer (its last words).

Blocks hold a bounded number of items; a larger benchmark takes more blocks.
Only sums per item word leave the tasks.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from vitrine.llm import common as C

CHUNK_WORDS = 16
#: Words of the benchmark in one block, and leading singular vectors.
BLOCK_WORDS = 40_000
RANK, EXTRA = 128, 16
#: A word in more than this share of the chunks carries no content.
COMMON = 0.002
#: Rarest words of a passage that always count as content.
RAREST = 6
#: Share of an item's own latent cosine that makes a candidate.
NEAR = 0.5
#: LCS share that proves a copy, and the one that does together with the answer.
COPY, PARAPHRASE, ANSWER = 0.8, 0.6, 0.8
ANSWER_WORDS = 5

U = np.uint64
_FOLD = C.LOWER.copy()
_FOLD[[b for b in range(128) if chr(b) in "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"]] = 0x20


def word_hashes(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every word, and each row's first word (one more at the end)."""
    data = _FOLD[data]
    start, end, first = C.word_spans(data, offsets)
    return C.unit_hash(data, start, end), first


def common_subsequence(item: list, words: list) -> int:
    """Length of the longest common subsequence, 64 and more positions at a time."""
    where: dict = {}
    for i, w in enumerate(item):
        where[w] = where.get(w, 0) | 1 << i
    full = (1 << len(item)) - 1
    free = full
    for w in words:
        hit = free & where.get(w, 0)
        if hit:
            free = ((free + hit) | (free - hit)) & full
    return len(item) - free.bit_count()


def passage_starts(n_words: int) -> range:
    return range(0, max(n_words - CHUNK_WORDS, 1), CHUNK_WORDS)


class Block:
    """Items of a block, their words, and what the passes learn about them."""

    def __init__(self, ids: list, words: list[np.ndarray]):
        self.ids, self.words = ids, words
        self.vocabulary = np.unique(np.concatenate(words))
        self.columns = min(RANK + EXTRA, len(self.vocabulary))
        self.probe = np.random.default_rng(17).normal(
            size=(len(self.vocabulary), self.columns)).astype(np.float32)

    def find(self, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places of the words of the vocabulary in ``h``, and which they are."""
        at = np.minimum(np.searchsorted(self.vocabulary, h), len(self.vocabulary) - 1)
        hit = np.flatnonzero(self.vocabulary[at] == h)
        return hit, at[hit]

    def weigh(self, df: np.ndarray, chunks: int) -> None:
        idf = np.log((1 + chunks) / (1 + df))
        content = df <= COMMON * chunks
        for w in self.words:
            at = np.searchsorted(self.vocabulary, w)
            for a in passage_starts(len(w)):
                mine = np.unique(at[a:a + 2 * CHUNK_WORDS])
                content[mine[np.argsort(df[mine], kind="stable")[:RAREST]]] = True
        self.weight = np.where(content, np.maximum(idf, 0.1), 0).astype(np.float32)

    def passages(self) -> tuple[np.ndarray, np.ndarray]:
        """Weighted word vectors of the items' windows, and each one's item."""
        found, of = [], []
        for i, w in enumerate(self.words):
            at = np.searchsorted(self.vocabulary, w)
            for a in passage_starts(len(w)):
                row = np.zeros(len(self.vocabulary), np.float32)
                np.add.at(row, at[a:a + 2 * CHUNK_WORDS], self.weight[at[a:a + 2 * CHUNK_WORDS]])
                found.append(row)
                of.append(i)
        return np.array(found), np.array(of)

    def learn(self, pushed: np.ndarray, energy: float) -> None:
        """The latent space from the corpus's share ``pushed`` of (A'A) times the probe."""
        rows, self.item = self.passages()
        own = float((rows ** 2).sum())
        mass = pushed / max(energy, 1e-9) + rows.T @ (rows @ self.probe) / max(own, 1e-9)
        # Eigenvectors of A'A from its one-pass sketch.
        shift = 1e-6 * np.linalg.norm(mass)
        mass = mass + shift * self.probe
        core = self.probe.T @ mass
        core = (core + core.T) / 2
        value, vector = np.linalg.eigh(core)
        good = value > value.max() * 1e-7
        half = mass @ (vector[:, good] / np.sqrt(value[good]))
        left, _, _ = np.linalg.svd(half, full_matrices=False)
        self.space = (left[:, :RANK] * self.weight[:, None]).astype(np.float32)
        latent = rows @ left[:, :RANK]
        size = np.maximum(np.linalg.norm(rows, axis=1), 1e-9)
        self.latent = (latent / size[:, None]).astype(np.float32)
        self.enough = NEAR * np.maximum((self.latent ** 2).sum(1), 1e-3)
        self.masks = [w.tolist() for w in self.words]


def _hits(block: Block, part: pa.RecordBatch):
    h, first = word_hashes(*C.text_bytes(part.column("text")))
    hit, which = block.find(h)
    count = np.diff(first)
    chunks = -(-count // CHUNK_WORDS)
    chunk_of = np.cumsum(chunks) - chunks
    row = np.searchsorted(first, hit, "right") - 1
    return h, first, hit, which, row, chunk_of[row] + (hit - first[row]) // CHUNK_WORDS, int(chunks.sum()), chunk_of


def _frequencies(block: Block):
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        df, total = np.zeros(len(block.vocabulary), np.int64), 0
        for batch in batches:
            for part in C.pieces(batch, "text"):
                _, _, _, which, _, chunk, n, _ = _hits(block, part)
                total += n
                once = np.unique(chunk * len(df) + which) % len(df) if len(which) else which
                df += np.bincount(once, minlength=len(df))
        some = np.flatnonzero(df)
        yield C.rows({"word": pa.array(np.append(some, -1)), "n": pa.array(np.append(df[some], total))})
    return count


def _pusher(block: Block):
    def push(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        width = block.columns
        out = np.zeros((len(block.vocabulary), width), np.float32)
        energy = 0.0
        probe = block.probe * block.weight[:, None]
        for batch in batches:
            for part in C.pieces(batch, "text"):
                _, _, _, which, _, chunk, _, _ = _hits(block, part)
                keep = block.weight[which] > 0
                which, chunk = which[keep], chunk[keep]
                if not len(which):
                    continue
                energy += float((block.weight[which] ** 2).sum())
                cut = np.flatnonzero(np.diff(chunk, prepend=-1))
                sums = np.add.reduceat(probe[which], cut)
                back = np.repeat(np.arange(len(cut)), np.diff(np.append(cut, len(which))))
                order = np.argsort(which, kind="stable")
                found, begin = np.unique(which[order], return_index=True)
                out[found] += np.add.reduceat(sums[back[order]], begin)
        out *= block.weight[:, None]
        some = np.flatnonzero(np.abs(out).sum(1))
        yield C.rows({"word": pa.array(np.append(some, -1))} | {
            f"c{j}": pa.array(np.append(out[some, j], energy if j == 0 else 0).astype(np.float64)) for j in range(width)})
    return push


def _blocks(benchmark: DataFrame) -> Iterator[Block]:
    """The benchmark block by block, in the order of its ids."""
    ids, words, size = [], [], 0
    rows = (benchmark.select(F.col("item_id").cast("string").alias("item_id"), F.col("text").cast("string").alias("text"))
            .distinct().coalesce(1).sortWithinPartitions("item_id", "text").toLocalIterator())
    for r in rows:
        h, _ = word_hashes(*C.text_bytes(pa.array([r.text], pa.string())))
        if not len(h):
            continue
        if ids and size + len(h) > BLOCK_WORDS:
            yield Block(ids, words)
            ids, words, size = [], [], 0
        ids.append(r.item_id)
        words.append(h)
        size += len(h)
    if ids:
        yield Block(ids, words)


def learned(docs: DataFrame, block: Block) -> Block:
    """``block`` with its weights and latent space, from two passes over ``docs``."""
    texts = docs.select(F.col("text").cast("string").alias("text"))
    counted = texts.mapInArrow(_frequencies(block), "word bigint, n bigint").groupBy("word").agg(F.sum("n").alias("n"))
    df, chunks = np.zeros(len(block.vocabulary)), 0
    for word, n in counted.collect():
        if word < 0:
            chunks = n
        else:
            df[word] = n
    block.weigh(df, chunks)
    names = [f"c{j}" for j in range(block.columns)]
    pushed = texts.mapInArrow(_pusher(block), "word bigint, " + ", ".join(f"{n} double" for n in names))
    table = pushed.groupBy("word").agg(*[F.sum(n).alias(n) for n in names]).toArrow()
    total, energy = np.zeros((len(block.vocabulary), block.columns), np.float32), 0.0
    if table.num_rows:
        word = np.asarray(table.column("word").combine_chunks())
        value = np.stack([np.asarray(table.column(n).combine_chunks()) for n in names], 1)
        energy = float(value[word < 0, 0].sum())
        total[word[word >= 0]] = value[word >= 0]
    block.learn(total, energy)
    return block


def _confirm(block: Block, i: int, words: list) -> float:
    """LCS share of item i in ``words`` if it is a copy or an answered paraphrase, else 0."""
    item, there = block.masks[i], set(words)
    # No common subsequence is longer than the item's words that are there at all.
    if sum(w in there for w in item) < PARAPHRASE * len(item):
        return 0.0
    share = common_subsequence(item, words) / len(item)
    if share >= COPY:
        return share
    if share >= PARAPHRASE:
        answer = item[-ANSWER_WORDS:]
        if sum(w in there for w in answer) >= ANSWER * len(answer):
            return share
    return 0.0


def search(block: Block, part: pa.RecordBatch) -> list[tuple[str | None, float]]:
    """The best confirmed item of every text, and its LCS share."""
    best: list = [(None, 0.0)] * part.num_rows
    h, first, hit, which, row, chunk, n_chunks, chunk_of = _hits(block, part)
    keep = block.weight[which] > 0
    which, row, chunk = which[keep], row[keep], chunk[keep]
    if not len(which):
        return best
    cut = np.flatnonzero(np.diff(chunk, prepend=-1))
    here, text = chunk[cut], row[cut]
    weight2 = np.add.reduceat(block.weight[which] ** 2, cut)
    # Window j is chunk j and the next one of the same text, if that has content too.
    follows = np.zeros(len(cut), bool)
    follows[:-1] = (here[1:] == here[:-1] + 1) & (text[1:] == text[:-1])
    nxt = np.minimum(np.arange(len(cut)) + 1, len(cut) - 1)
    size = np.sqrt(weight2 + np.where(follows, weight2[nxt], 0))
    ends = np.append(cut, len(which))
    for a in range(0, len(cut), 20_000):
        some = np.arange(a, min(a + 20_000, len(cut)))
        high = min(int(some[-1]) + 2, len(cut))
        sums = np.add.reduceat(block.space[which[cut[a]:ends[high]]], cut[a:high] - cut[a])
        vector = sums[some - a]
        both = np.flatnonzero(follows[some])
        vector[both] += sums[both + 1]
        near = (vector @ block.latent.T) / size[some, None] >= block.enough
        window, passage = np.nonzero(near)
        for w, p in zip(window.tolist(), passage.tolist()):
            i = int(block.item[p])
            w = int(some[w])
            r = int(text[w])
            if best[r][1] >= 1.0:
                continue
            m = len(block.masks[i])
            at = first[r] + int(here[w] - chunk_of[r]) * CHUNK_WORDS
            lo, hi = max(first[r], at - m), min(first[r + 1], at + 2 * CHUNK_WORDS + m)
            share = _confirm(block, i, h[lo:hi].tolist())
            if share > best[r][1] or (share == best[r][1] > 0 and block.ids[i] < best[r][0]):
                best[r] = (block.ids[i], share)
    return best


def contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``docs`` with contaminated, item_id and overlap (the LCS share), one row per row.

    Null and blank texts, and texts without an item's words, are clean: false,
    null, 0.  Items without words match nothing; an empty benchmark leaves all
    clean.  Of equal shares the least item_id stands.  Columns of these names
    that ``docs`` has are replaced.  Repeated rows are rows like others; an
    empty table gives an empty table.
    """
    docs = docs.drop("contaminated", "item_id", "overlap")
    names = docs.columns
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema)
    out = docs.withColumn("item_id", F.lit(None).cast("string")).withColumn("overlap", F.lit(0.0))

    def searcher(sent):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for part in C.pieces(batch, "text"):
                    got = search(sent.value, part)
                    old = zip(part.column("item_id").to_pylist(), part.column("overlap").to_pylist())
                    item, share = zip(*[g if g[1] > o[1] else o for g, o in zip(got, old)])
                    yield C.rows({n: part.column(n) for n in names} | {
                        "item_id": pa.array(item, pa.string()), "overlap": pa.array(share, pa.float64())})
        return run

    for block in _blocks(benchmark):
        sent = docs.sparkSession.sparkContext.broadcast(learned(docs, block))
        out = out.mapInArrow(searcher(sent), kinds + ", item_id string, overlap double")
    return out.withColumn("contaminated", F.col("overlap") > 0)
