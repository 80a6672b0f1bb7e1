"""Small helpers of the corpus operators: tables, Arrow batches, byte hashing."""

from __future__ import annotations

import hashlib
import heapq
import itertools
import uuid
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from vitrine.session import shared_folder

#: Bytes of text that one numpy step works on; bounds a task's memory.
STEP_BYTES = 1 << 20

U64 = np.uint64
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
_powers: list[np.ndarray] = [np.ones(1, U64), np.ones(1, U64)]
_BYTE = np.random.default_rng(20_011).integers(1, 2**63, 256, dtype=np.uint64) * U64(2) + U64(1)

SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    # Python workers import this package from where the driver did, unless told otherwise.
    spark.sparkContext.environment.setdefault("PYTHONPATH", str(Path(__file__).resolve().parents[2]))
    return spark.read.parquet(f"{folder}/{name}.parquet")


def stored(df: DataFrame) -> DataFrame:
    """``df`` written as a table in the folder all executors share, and read back.

    Like a checkpoint it cuts lineage and outlives lost executors; columnar
    and compressed, it takes a fraction of one's space where rows are many.
    """
    path = f"{shared_folder(df.sparkSession)}/stored-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def words(text: Column | str) -> Column:
    """Number of runs of other bytes than ASCII white space; null counts 0."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("bigint")


def remainder(doc_id: Column | str, by: int) -> Column:
    """crc32 of the decimal text of an id, mod ``by``; a null id counts as ''."""
    return F.crc32(F.coalesce(F.col(doc_id) if isinstance(doc_id, str) else doc_id,
                              F.lit("")).cast("string").cast("binary")) % by


def pieces(batch: pa.RecordBatch, column: str, most: int = STEP_BYTES) -> Iterator[pa.RecordBatch]:
    """Row slices of a batch with about ``most`` bytes in ``column`` each."""
    if batch.num_rows == 0:
        return
    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
    part = np.cumsum(sizes) // most
    cuts = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), batch.num_rows]
    for a, b in zip(cuts, cuts[1:]):
        yield batch.slice(a, b - a)


def text_bytes(array: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a string column and where each row starts; null is empty."""
    array = pc.fill_null(array, "").cast(pa.large_binary())
    offsets = np.frombuffer(array.buffers()[1], np.int64)[array.offset:array.offset + len(array) + 1]
    data = array.buffers()[2]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[offsets[0]:offsets[-1]], offsets - offsets[0]


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first n powers of the hash base and of its inverse, mod 2**64."""
    if len(_powers[0]) < n:
        n = 1 << max(20, (n - 1).bit_length())
        for i, base in enumerate((_BASE, _INVERSE)):
            steps = np.full(n, base, U64)
            steps[0] = 1
            _powers[i] = np.cumprod(steps, dtype=U64)
    return _powers[0], _powers[1]


def prefix_hash(data: np.ndarray) -> np.ndarray:
    """Running polynomial hash; ``span_hash`` reads any span from it."""
    up, _ = powers(len(data) + 1)
    out = np.zeros(len(data) + 1, U64)
    np.cumsum(_BYTE[data] * up[:len(data)], dtype=U64, out=out[1:])
    return out


def mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> U64(32))) * U64(0xD6E8FEB86659FD93)
    h = (h ^ (h >> U64(32))) * U64(0xD6E8FEB86659FD93)
    return h ^ (h >> U64(32))


def span_hash(prefix: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    _, down = powers(len(prefix))
    return mix((prefix[end] - prefix[start]) * down[start] + end.astype(U64) - start.astype(U64))


#: Above this length spans of a mirrored make (abba baab ...) collide in any polynomial mod 2**64.
_LONG_SPAN = 128


def unit_hash(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hashes of spans that are taken for equal when these are; long spans get a cryptographic one."""
    h = span_hash(prefix_hash(data), start, end)
    for i in np.flatnonzero(end - start > _LONG_SPAN).tolist():
        digest = hashlib.blake2b(data[start[i]:end[i]].tobytes(), digest_size=8).digest()
        h[i] = int.from_bytes(digest, "little")
    return h


def word_spans(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end of every word, and for each row its first word (one more at the end)."""
    inside = ~SPACE[data]
    before = np.zeros(len(data) + 1, bool)
    before[1:] = inside
    before[offsets] = False  # a word never goes on in the next row
    after = np.zeros(len(data) + 1, bool)
    after[:-1] = inside
    after[offsets] = False
    start = np.flatnonzero(inside & ~before[:-1])
    end = np.flatnonzero(inside & ~after[1:]) + 1
    return start, end, np.searchsorted(start, offsets)


def shingles(data: np.ndarray, offsets: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all ``width``-word shingles of lower-cased rows, and where each row's begin.

    A row with fewer words has its whole sequence as one shingle; a row
    without words has none.
    """
    data = LOWER[data]
    start, end, first = word_spans(data, offsets)
    h = unit_hash(data, start, end)
    count = np.diff(first)
    salt = mix(np.arange(1, width + 1, dtype=U64) * U64(_BASE))
    n = len(h)
    whole = np.zeros(max(n - width + 1, 0), U64)
    for i in range(width):
        whole += h[i:n - width + 1 + i] * (salt[i] | U64(1)) if n >= width else 0
    number = np.where(count >= width, count - width + 1, np.minimum(count, 1))
    begin = np.zeros(len(number) + 1, np.int64)
    np.cumsum(number, out=begin[1:])
    row = np.repeat(np.arange(len(number)), number)
    at = np.arange(begin[-1]) - begin[row] + first[row]
    out = np.zeros(begin[-1], U64)
    long = count[row] >= width
    out[long] = mix(whole[at[long]])
    for i in np.flatnonzero((count > 0) & (count < width)):
        ws = h[first[i]:first[i + 1]]
        out[begin[i]] = mix(np.array([(ws * (salt[:len(ws)] | U64(1))).sum(dtype=U64) + U64(len(ws))]))[0]
    return out, begin


def arrow_column(values, kind: pa.DataType) -> pa.Array:
    return pa.array(values, kind)


def rows(columns: dict[str, pa.Array]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(list(columns.values()), list(columns))


def binary_rows(flat: np.ndarray, begin: np.ndarray) -> pa.Array:
    """A binary column whose row i holds flat[begin[i]:begin[i + 1]]."""
    flat = np.ascontiguousarray(flat)
    return pa.LargeBinaryArray.from_buffers(
        pa.large_binary(), len(begin) - 1,
        [None, pa.py_buffer((begin * flat.itemsize).astype(np.int64)), pa.py_buffer(flat)]).cast(pa.binary())


def ranges(begin: np.ndarray, size: np.ndarray) -> np.ndarray:
    """begin[0], begin[0] + 1, ... for size[0] of them, then the next."""
    ends = np.cumsum(size)
    total = int(ends[-1]) if len(ends) else 0
    return np.arange(total) + np.repeat(begin - (ends - size), size)


def pack(*arrays: np.ndarray) -> bytes:
    """Columns of whole numbers, compressed; ascending ones as differences."""
    import zstandard
    out = [np.array([len(x) for x in arrays], "<i8").tobytes()]
    for x in arrays:
        x = x.astype(np.int64)
        steps = np.diff(x, prepend=0)
        rising = bool((steps >= 0).all())
        out.append(bytes([rising]) + (steps if rising else x).astype("<i8").view("<u1").reshape(-1, 8).T.tobytes())
    return zstandard.ZstdCompressor(level=1).compress(b"".join(out))


def unpack(blob: bytes, columns: int) -> list[np.ndarray]:
    import zstandard
    raw = zstandard.ZstdDecompressor().decompress(blob)
    at, out = 8 * columns, []
    for n in np.frombuffer(raw[:at], "<i8").tolist():
        x = np.frombuffer(raw, "<u1", 8 * n, at + 1).reshape(8, n).T.copy().view("<i8").ravel()
        out.append(np.cumsum(x) if raw[at] else x)
        at += 8 * n + 1
    return out


def heap_merge(blocks: Iterator[tuple[int, np.ndarray, np.ndarray]]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """K-way merge of sorted blocks (first key, keys, values) that come by first key.

    Before a block is opened, all keys below its first one are taken from the
    blocks that are open, those with the least next key first; so all entries
    of one key come out together, in ascending order of keys.
    """
    heap: list = []
    ticket = itertools.count()

    def taken(below: int | None):
        keys, values = [], []
        while heap and (below is None or heap[0][0] < below):
            _, _, k, v = heapq.heappop(heap)
            to = len(k) if below is None else int(np.searchsorted(k, below))
            keys.append(k[:to])
            values.append(v[:to])
            if to < len(k):
                heapq.heappush(heap, (int(k[to]), next(ticket), k[to:], v[to:]))
        if keys:
            k, v = np.concatenate(keys), np.concatenate(values)
            order = np.argsort(k, kind="stable")
            yield k[order], v[order]
    for first, keys, values in blocks:
        yield from taken(first)
        heapq.heappush(heap, (first, next(ticket), keys, values))
    yield from taken(None)


def heads(sorted_keys: np.ndarray) -> np.ndarray:
    """Where each run of equal keys begins."""
    return np.flatnonzero(np.append(True, sorted_keys[1:] != sorted_keys[:-1]))[:len(sorted_keys)]
