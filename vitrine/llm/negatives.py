"""Hard negatives of anchors, by a secondary-sort shuffle of packed pair keys.

A pair of an anchor and another row is one key of 33 bytes: anchor, descending
score, a bit that puts positives first, and id.  The shuffle brings an anchor's keys to one partition in sorted
order (``repartition`` and ``sortWithinPartitions``, the DataFrame form of
``repartitionAndSortWithinPartitions``), and an iterator reads them in a
stream: an anchor's first same-label rows are its positives, each opens a
window of scores, and every negative that follows goes to the windows that it
fits.  Of an anchor the stream holds its open windows and nothing else.

Most pairs can't be in any result, so tasks leave them out before the shuffle,
as a combiner does: of the rows of one slice only the best ``positives`` of an
anchor can be among its best, and once those are known over all slices, only
the first ``negatives`` rows in each of its windows.  What is shuffled is thus
bounded by a number of keys per anchor and slice.

Anchors go to the tasks in blocks of at most ``BLOCK_BYTES``; every block is
scored against all rows, a slice at a time, by one matrix product.  Scores are
exact integers: in doubles while all sums stay below 2**53, in 64-bit integers
beyond; vectors whose scores could leave those raise an ArithmeticError.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from vitrine.llm import common as C
from vitrine.session import cut_lineage

#: Anchors' components in one broadcast, and scores that a task holds at a time.
BLOCK_BYTES, SCORES = 32 << 20, 1 << 21
#: Bounds of a window in hundredths: low * positive <= 100 * negative <= high * positive.
LOW, HIGH = 50, 95
KEY = "vec_id bigint, mark bigint, key binary, kind int, id bigint, score bigint"
FOUND = "anchor_id bigint, positive_id bigint, rank int, negative_id bigint, positive_score bigint, negative_score bigint"


def clean(rows: DataFrame, label: Column | str = "label", scale: int = 256) -> DataFrame:
    """(vec_id, label, vector) with whole components; rows that lack anything take no part.

    That is rows with a null id, label or vector, or with a null or
    non-finite component.  A component x becomes floor(scale * x).
    """
    label = F.col(label) if isinstance(label, str) else label
    whole = F.transform("embedding", lambda x: F.floor(x.cast("double") * F.lit(float(scale))))
    bad = F.exists("embedding", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == F.lit(float("inf"))))
    return (rows.filter(F.col("vec_id").isNotNull() & F.col("embedding").isNotNull() & ~bad)
            .select(F.col("vec_id").cast("bigint").alias("vec_id"), label.cast("bigint").alias("label"),
                    whole.alias("vector")).filter("label is not null"))


def _matrices(vectors: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Rows of each length, and their components as one matrix."""
    vectors = vectors.combine_chunks() if isinstance(vectors, pa.ChunkedArray) else vectors
    offsets = np.asarray(vectors.offsets)
    flat = np.asarray(vectors.values, np.int64)
    size = np.diff(offsets)
    for n in np.unique(size).tolist():
        at = np.flatnonzero(size == n)
        yield at, flat[offsets[at][:, None] + np.arange(n)]


def _scores(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Inner products of the rows of both, exactly."""
    if not a.size or not b.size:
        return np.zeros((len(a), len(b)), np.int64)
    most = a.shape[1] * max(int(a.max()), -int(a.min())) * max(int(b.max()), -int(b.min()))
    if most >= 1 << 57:  # a hundred times a score must fit in 64 bits, too
        raise ArithmeticError("scores of these vectors do not fit in a long")
    if most < 1 << 53:
        return (a.astype(np.float64) @ b.astype(np.float64).T).astype(np.int64)
    return a @ b.T


def _order(x: np.ndarray) -> np.ndarray:
    """Big-endian unsigned words that sort as the signed values do."""
    return (x.astype(np.int64).view(np.uint64) ^ np.uint64(1 << 63)).astype(">u8")


def _keys(anchor: np.ndarray, mark: np.ndarray, score: np.ndarray, negative: np.ndarray, ids: np.ndarray) -> dict:
    """Packed keys: (anchor, its content), descending score, positives first, ascending id."""
    packed = np.zeros(len(ids), [("a", ">u8"), ("m", ">u8"), ("s", ">u8"), ("k", "u1"), ("i", ">u8")])
    packed["a"], packed["m"], packed["s"], packed["k"], packed["i"] = (
        _order(anchor), mark.view(np.uint64), ~_order(score).astype(np.uint64), negative, _order(ids))
    return {"vec_id": pa.array(anchor), "mark": pa.array(mark),
            "key": C.binary_rows(packed.view(np.uint8), np.arange(len(ids) + 1) * packed.itemsize),
            "kind": pa.array(negative, pa.int32()), "id": pa.array(ids), "score": pa.array(score)}


def _best(score: np.ndarray, allowed: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """(row, column) of the n highest allowed scores of every row; of equal ones the first columns."""
    held = np.where(allowed, score, np.iinfo(np.int64).min)
    every, rows, columns = np.arange(len(held)), [], []
    for _ in range(min(n, held.shape[1])):
        at = held.argmax(1)
        some = allowed[every, at] & (held[every, at] != np.iinfo(np.int64).min)
        if not some.any():
            break
        rows.append(every[some])
        columns.append(at[some])
        held[every, at] = np.iinfo(np.int64).min
    none = np.zeros(0, np.int64)
    return np.concatenate(rows) if rows else none, np.concatenate(columns) if columns else none


class _Anchors:
    """A block of anchors: ids, marks of their contents, labels, matrices by length, and windows."""

    def __init__(self, rows: pa.Table, windows: pa.Table | None = None):
        self.ids = rows.column("vec_id").to_numpy()
        self.mark = rows.column("mark").to_numpy()
        self.label = rows.column("label").to_numpy()
        self.parts = {m.shape[1]: (at, m) for at, m in _matrices(rows.column("vector"))} if len(rows) else {}
        self.positive = None
        if windows is not None:
            # The positives' scores, as many columns as the anchor with most has.
            place = {k: i for i, k in enumerate(zip(self.ids.tolist(), self.mark.tolist()))}
            lists: list = [[] for _ in place]
            for key, mark, score in zip(*(windows.column(c).to_pylist() for c in ("vec_id", "mark", "score"))):
                if (key, mark) in place:
                    lists[place[key, mark]].append(score)
            self.positive = [np.unique(np.array(x, np.int64)) for x in lists]


def _scorer(block, positives: int, negatives: int):
    """Keys of the pairs of a block's anchors and a slice's rows that can be in a result."""
    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        anchors: _Anchors = block.value
        for batch in batches:
            if not batch.num_rows:
                continue
            order = np.argsort(batch.column("vec_id").to_numpy(), kind="stable")
            batch = batch.take(pa.array(order))
            ids, label = batch.column("vec_id").to_numpy(), batch.column("label").to_numpy()
            for at, matrix in _matrices(batch.column("vector")):
                mine, theirs = anchors.parts.get(matrix.shape[1], (None, None))
                step = max(1, SCORES // len(at))
                for a in range(0, 0 if mine is None else len(mine), step):
                    who = mine[a:a + step]
                    yield from pairs(anchors, who, _scores(theirs[a:a + step], matrix), ids[at], label[at])

    def pairs(anchors, who, s, ids, label):
        alike = anchors.label[who][:, None] == label
        if anchors.positive is None:
            row, column = _best(s, alike & (anchors.ids[who][:, None] != ids), positives)
            kind = 0
        else:
            row, column, kind = [], [], 1
            most = max((len(anchors.positive[i]) for i in who), default=0)
            for k in range(most):
                # An anchor with fewer windows has an empty one here.
                p = np.array([anchors.positive[i][k] if k < len(anchors.positive[i]) else -1 for i in who], np.int64)[:, None]
                fits = (LOW * p <= 100 * s) & (100 * s <= HIGH * p) & ~alike
                r, c = _best(s, fits, negatives)
                row.append(r)
                column.append(c)
            both = np.unique(np.concatenate([r * len(ids) + c for r, c in zip(row, column)])) if most else np.zeros(0, np.int64)
            row, column = both // len(ids), both % len(ids)
        if len(row):
            owner = who[row]
            yield C.rows(_keys(anchors.ids[owner], anchors.mark[owner], s[row, column],
                               np.full(len(row), kind, np.uint8), ids[column]))
    return score


def _stream(positives: int, negatives: int):
    """Reads sorted keys; the first positives of an anchor open windows, negatives fill them."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        anchor, opened, out = None, [], []
        for batch in batches:
            for name, mark, kind, who, score in zip(*(batch.column(c).to_pylist() for c in ("vec_id", "mark", "kind", "id", "score"))):
                if (name, mark) != anchor:
                    anchor, opened = (name, mark), []
                if kind == 0:
                    if len(opened) < positives:
                        opened.append([who, score, 0])
                    continue
                for window in opened:
                    if window[2] < negatives and LOW * window[1] <= 100 * score <= HIGH * window[1]:
                        window[2] += 1
                        out.append((name, window[0], window[2], who, window[1], score))
            if len(out) >= 1 << 14:
                yield table(out)
                out = []
        yield table(out)

    def table(out):
        columns = list(zip(*out)) or [()] * 6
        kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]
        names = ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
        return C.rows({n: pa.array(c, k) for n, c, k in zip(names, columns, kinds)})
    return run


def _sorted_keys(keys: DataFrame) -> DataFrame:
    parts = int(keys.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return keys.repartition(parts, "vec_id", "mark").sortWithinPartitions("key")


def _first(positives: int):
    """The first keys of every anchor, of sorted ones."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        anchor, n = None, 0
        for batch in batches:
            keep = np.zeros(batch.num_rows, bool)
            for i, a in enumerate(zip(batch.column("vec_id").to_pylist(), batch.column("mark").to_pylist())):
                anchor, n = (anchor, n + 1) if a == anchor else (a, 1)
                keep[i] = n <= positives
            yield batch.filter(pa.array(keep))
    return run


def mine(rows: DataFrame, is_anchor: Column, positives: int = 5, negatives: int = 3) -> DataFrame:
    """Hard negatives of the anchors among ``rows`` (vec_id, label, vector of whole numbers; see ``clean``).

    An anchor's positives are its first ``positives`` other rows of its label
    by descending score, ties by id; with each, the first ``negatives`` rows
    of other labels whose score lies in the positive's window are returned.

    A row is no partner of rows that bear its id.  Repeated rows are partners
    as often as they are there; equal anchors ask once, and anchors that share
    an id but nothing else ask each for itself.  Vectors of different lengths
    have no score.  Anchors without positives, or positives without negatives,
    give no rows; an empty table gives an empty table.  Other columns are
    ignored.
    """
    spark = rows.sparkSession
    rows = rows.select("vec_id", "label", "vector")
    mark = F.xxhash64("label", "vector")
    anchors = rows.filter(is_anchor).distinct().withColumn("mark", mark)
    size = anchors.agg(F.coalesce(F.sum(F.size("vector") * 8 + 24), F.lit(0))).first()[0]
    blocks = max(1, -(-int(size) // BLOCK_BYTES))
    anchors = cut_lineage(anchors.withColumn("block", F.pmod(F.xxhash64("vec_id"), F.lit(blocks))))

    def scored(windows: DataFrame | None) -> DataFrame:
        found = []
        for b in range(blocks):
            mine = anchors.filter(F.col("block") == b).toArrow()
            theirs = windows.filter(F.col("block") == b).toArrow() if windows is not None else None
            block = spark.sparkContext.broadcast(_Anchors(mine, theirs))
            found.append(rows.mapInArrow(_scorer(block, positives, negatives), KEY))
        return reduce(DataFrame.union, found)

    best = cut_lineage(_sorted_keys(scored(None)).mapInArrow(_first(positives), KEY))
    windows = best.select("vec_id", "mark", "score").distinct().withColumn("block", F.pmod(F.xxhash64("vec_id"), F.lit(blocks)))
    return _sorted_keys(best.union(scored(windows))).mapInArrow(_stream(positives, negatives), FOUND)
