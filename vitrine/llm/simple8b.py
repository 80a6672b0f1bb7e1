"""Token ids as Simple-8b words, in blocks of ascending documents.

A 64-bit word holds a selector in its four highest bits and as many ids of one
width as fit in the other 60.  Selectors 0-13 stand for the widths below, 14
for a run of one value, 15 for an escape: the next word is one value of up to 64
bits as it is.

A block covers the documents of one stretch of a shard.  It carries the number
of ids and the first word of every document, so any document is decoded alone,
and all words of one selector are decoded in one numpy step.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from vitrine.llm import common as C

#: Bits of an id by selector, and how many fit in 60 bits.
WIDTHS = np.array([1, 2, 3, 4, 5, 6, 7, 8, 10, 12, 15, 20, 30, 60], np.int64)
FITS = 60 // WIDTHS
RUN, ESCAPE = 14, 15
RUN_COUNT_BITS = 28
U = np.uint64
#: Documents in a block; blocks also end after some megabytes of text.
BLOCK_ROWS = 512
#: Bytes of text encoded at once; what a step needs besides is some hundred times that.
PIECE = 1 << 19


_SHORT = np.searchsorted(WIDTHS, [int(i).bit_length() for i in range(1 << 16)]).astype(np.uint8)


def _width_class(values: np.ndarray) -> np.ndarray:
    """Selector of the narrowest width that holds each value."""
    out = _SHORT[np.minimum(values, U(0xFFFF)).astype(np.int64)]
    large = np.flatnonzero(values > U(0xFFFF))
    if len(large):
        out[large] = np.searchsorted((U(1) << WIDTHS[:-1].astype(U)) - U(1), values[large])
    return out


def _all_of_next(fits: np.ndarray, k: int) -> np.ndarray:
    """Whether all of the k entries from each place on are set (places near the end are not)."""
    done, span = fits, 1
    while span < k:
        step = min(span, k - span)
        done = done[:len(done) - step] & done[step:]
        span += step
    out = np.zeros(len(fits), bool)
    out[:len(done)] = done
    return out


def encode_lists(values: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Simple-8b words of lists of ids that lie end to end, and each list's number of words.

    A word takes as many of the list's next ids as any selector allows.  A
    list's last word may take fewer: the reader knows the list's length.
    """
    values = np.ascontiguousarray(values, U)
    # Every list is followed by room for the widest count, where anything fits.
    room = int(FITS[0])
    start = np.concatenate(([0], np.cumsum(lengths + room)))
    n = int(start[-1])
    at = np.arange(len(values)) + np.repeat(np.arange(len(lengths)) * room, lengths)
    need = np.zeros(n, np.uint8)
    wide = values >> U(60) != 0
    need[at] = np.where(wide, 255, _width_class(np.where(wide, U(0), values)))
    padded = np.zeros(n, U)
    padded[at] = values
    best = np.full(n, len(WIDTHS) - 1, np.uint8)
    for s in range(len(WIDTHS) - 2, -1, -1):
        fits = need <= s
        best[_all_of_next(fits, int(FITS[s]))] = s
    take = FITS[np.minimum(best, len(WIDTHS) - 1)].astype(np.int64)
    best[at[wide]], take[at[wide]] = ESCAPE, 1
    same = np.zeros(n, bool)
    same[:-1] = padded[1:] == padded[:-1]
    inside = np.zeros(n, bool)
    inside[at] = True
    same[:-1] &= inside[1:] & inside[:-1]
    if _all_of_next(same, room).any():
        stop = np.flatnonzero(~same)
        run = stop[np.searchsorted(stop, np.arange(n))] - np.arange(n) + 1
        runs = (run > np.maximum(take, room)) & (padded < (U(1) << U(32))) & inside
        best[runs] = RUN
        take[runs] = np.minimum(run[runs], (1 << RUN_COUNT_BITS) - 1)
    # A word starts where the one before ends.
    jump, starts, words = (np.arange(n) + take).tolist(), [], []
    for i, stop in zip(start[:-1].tolist(), (start[:-1] + lengths).tolist()):
        before = len(starts)
        while i < stop:
            starts.append(i)
            i = jump[i]
        words.append(len(starts) - before)
    starts = np.array(starts, np.int64)
    kind, count = best[starts], take[starts]
    out = kind.astype(U) << U(60)
    words = np.array(words, np.int64)
    escapes = np.flatnonzero(kind == ESCAPE)
    for s in np.unique(kind).tolist():
        mine = np.flatnonzero(kind == s)
        if s == ESCAPE:
            continue
        if s == RUN:
            out[mine] |= (padded[starts[mine]] << U(RUN_COUNT_BITS)) | count[mine].astype(U)
            continue
        first = starts[mine]
        packed = out[mine]
        for k in range(int(FITS[s])):
            packed |= padded[np.minimum(first + k, n - 1)] << U(k * WIDTHS[s])
        out[mine] = packed
    if len(escapes):
        ends = np.cumsum(words)
        words = words + np.bincount(np.searchsorted(ends, escapes, "right"), minlength=len(words))
        out = np.insert(out, escapes + 1, padded[starts[escapes]])
    return out, words


def encode(values: np.ndarray) -> np.ndarray:
    """Simple-8b words of one list of ids."""
    return encode_lists(np.asarray(values), np.array([len(values)], np.int64))[0]


def decode(words: np.ndarray, lengths: np.ndarray, first: np.ndarray) -> np.ndarray:
    """All ids of a block: ``lengths`` ids per document, whose words begin at ``first``."""
    words = np.ascontiguousarray(words, U)
    kind = (words >> U(60)).astype(np.int64)
    raw: list[int] = []  # places of words that an escape stands before; those may look like escapes
    for i in np.flatnonzero(kind == ESCAPE).tolist():
        if not raw or raw[-1] != i:
            raw.append(i + 1)
    if raw:
        if raw[-1] >= len(words):
            raise ValueError("a block ends with an escape")
        plain = np.ones(len(words), bool)
        plain[raw] = False
        values = words[raw]
        first = first - np.searchsorted(raw, first)
        words, kind = words[plain], kind[plain]
    holds = FITS[np.minimum(kind, len(WIDTHS) - 1)].copy()
    holds[kind == ESCAPE] = 1
    run = kind == RUN
    holds[run] = (words[run] & U((1 << RUN_COUNT_BITS) - 1)).astype(np.int64)
    ends = np.append(first[1:], len(words))
    document = np.repeat(np.arange(len(lengths)), ends - first)
    before = np.cumsum(holds) - holds
    offset = np.cumsum(lengths) - lengths
    # A document's last word may hold fewer ids than its selector allows.
    local = before - before[np.minimum(first, max(len(words) - 1, 0))][document] if len(words) else before
    real = np.minimum(holds, lengths[document] - local)
    if np.any(real <= 0) or real.sum() != lengths.sum():
        raise ValueError("a block's words and lengths disagree")
    out = np.zeros(int(lengths.sum()), U)
    to = offset[document] + local
    for s in np.unique(kind):
        mine = np.flatnonzero(kind == s)
        if s == ESCAPE:
            out[to[mine]] = values
            continue
        if s == RUN:
            for i in mine:
                out[to[i]:to[i] + real[i]] = (words[i] & U((1 << 60) - 1)) >> U(RUN_COUNT_BITS)
            continue
        keep = (U(1) << U(WIDTHS[s])) - U(1)
        for k in range(FITS[s]):
            has = mine[real[mine] > k]
            out[to[has] + k] = (words[has] >> U(k * WIDTHS[s])) & keep
    return out


# Texts in which the units below might be cut otherwise than the tokenizer does.
_ODD = "[\x00\x1c-\x1f\x85\xa0\u1680\u180e\u2000-\u200f\u2028-\u202f\u205f-\u206f\u3000\ufeff]|<[|]"


class Encoder:
    """Whole texts to ids, every distinct unit through the tokenizer once.

    A unit is a run of non-space bytes with the one space before it, or the
    white space between: the byte-level pre-tokenizer never joins what lies in
    two units, so a text's ids are those of its units in turn.  A text with
    other white space than ASCII's, or with a special token's spelling, is
    given to the tokenizer whole.  Known units are kept per process, sorted by
    hash, and let go when they have more than ``most`` ids.
    """

    def __init__(self, path: str, most: int = 10_000_000):
        import os
        import re
        from tokenizers import Tokenizer
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # Spark's tasks are the parallelism
        self.tokenizer, self.most, self.odd = Tokenizer.from_file(path), most, re.compile(_ODD)
        self.kind = np.min_scalar_type(max(self.tokenizer.get_vocab().values()))
        self.line_end = self.tokenizer.encode("\n", add_special_tokens=False).ids[-1]
        self._clear()

    def _clear(self):
        # Ids of the vocabulary and places in the pool in as few bytes as hold them.
        self.key, self.begin, self.size = np.zeros(0, U), np.zeros(0, np.uint32), np.zeros(0, np.uint32)
        self.pool, self.used = np.zeros(0, self.kind), 0

    def _units(self, data, offsets):
        start, end, first = C.word_spans(data, offsets)
        row = np.searchsorted(offsets, start, "right") - 1
        gap_from = np.concatenate(([0], end)) if len(end) else np.zeros(1, np.int64)
        opens = np.maximum(offsets[row], gap_from[:-1]) if len(end) else start
        spaced = (start > opens)
        spaced[spaced] = data[start[spaced] - 1] == 0x20
        head = start - spaced
        # White space before a unit: all but its last byte, and that byte.
        last = head > opens
        bare = last & ~spaced
        rest_end = np.where(bare, head - 1, head)
        more = rest_end > opens
        # White space at the end of a row is one unit.
        ends = offsets[1:]
        n_of = np.diff(first)
        tail_from = np.where(n_of > 0, end[np.maximum(first[1:] - 1, 0)] if len(end) else 0, offsets[:-1])
        tail = tail_from < ends
        a = np.concatenate((head, opens[more], head[bare] - 1, tail_from[tail]))
        b = np.concatenate((end, rest_end[more], head[bare], ends[tail]))
        order = np.argsort(a, kind="stable")
        return a[order], b[order]

    def _tokens(self, units: list[str]) -> tuple[list, np.ndarray, np.ndarray]:
        """Order in which units were taken, their ids end to end, and how many each has.

        Units with other characters than white space are tokenized many at a
        time, between line ends, which no such unit holds."""
        solid = [i for i, u in enumerate(units) if not u.isspace()]
        blank = [i for i, u in enumerate(units) if u.isspace()]
        flat, size = [], []
        for a in range(0, len(solid), 4096):
            mine = solid[a:a + 4096]
            joined = "\n" + "\n".join([units[i] for i in mine])
            ids = np.array(self.tokenizer.encode_batch_fast([joined], add_special_tokens=False)[0].ids, np.uint32)
            ends = np.flatnonzero(ids == self.line_end)
            if len(ends) != len(mine):
                raise ValueError("the tokenizer joins units over line ends")
            size.append(np.diff(np.append(ends, len(ids))) - 1)
            flat.append(ids[ids != self.line_end])
        for i in blank:
            flat.append(np.array(self.tokenizer.encode(units[i], add_special_tokens=False).ids, np.uint32))
            size.append(np.array([len(flat[-1])]))
        return solid + blank, np.concatenate(flat), np.concatenate(size)

    def _learn(self, key, units):
        order, flat, size = self._tokens(units)
        begin = self.used + np.cumsum(size) - size
        end = self.used + len(flat)
        if end > len(self.pool):
            # A fourth of room to spare, so that the pool is seldom moved.
            pool = np.empty(end + end // 4, self.kind)
            pool[:self.used] = self.pool[:self.used]
            self.pool = pool
        self.pool[self.used:end] = flat
        self.used = end
        key = key[order]
        sort = np.argsort(key)
        key, begin, size = key[sort], begin[sort], size[sort]
        place = np.searchsorted(self.key, key) + np.arange(len(key))
        old = np.ones(len(self.key) + len(key), bool)
        old[place] = False
        for name, new in (("key", key), ("begin", begin), ("size", size)):
            was = getattr(self, name)
            both = np.empty(len(old), was.dtype)
            both[old], both[place] = was, new
            setattr(self, name, both)

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts end to end, and how many each has; null is the empty text."""
        strings = texts.to_pylist()
        odd = [i for i, t in enumerate(strings) if t and self.odd.search(t)]
        if odd:
            # Not with if_else, which reads a slice's texts at wrong offsets.
            whole = set(odd)
            texts = pa.array([None if i in whole else t for i, t in enumerate(strings)], texts.type)
        data, offsets = C.text_bytes(texts)
        a, b = self._units(data, offsets)
        h = C.unit_hash(data, a, b)
        distinct, one, back = np.unique(h, return_index=True, return_inverse=True)
        if self.used > self.most:
            self._clear()
        new = ~self._has(distinct)
        if new.any():
            raw, one = data.tobytes(), one[new]
            self._learn(distinct[new], [raw[x:y].decode() for x, y in zip(a[one].tolist(), b[one].tolist())])
        at = np.searchsorted(self.key, distinct)
        size = self.size[at].astype(np.int64)[back]
        flat = self.pool[_ranges(self.begin[at].astype(np.int64)[back], size)] if len(a) else np.zeros(0, self.kind)
        cut = np.concatenate(([0], np.cumsum(size)))[np.searchsorted(a, offsets)]
        if not odd:
            return flat, np.diff(cut)
        lists = [flat[x:y] for x, y in zip(cut[:-1], cut[1:])]
        for i in odd:
            lists[i] = np.array(self.tokenizer.encode(strings[i], add_special_tokens=False).ids, np.uint32)
        return np.concatenate(lists), np.array([len(x) for x in lists], np.int64)

    def _has(self, keys: np.ndarray) -> np.ndarray:
        if not len(self.key):
            return np.zeros(len(keys), bool)
        return self.key[np.minimum(np.searchsorted(self.key, keys), len(self.key) - 1)] == keys


def _ranges(begin: np.ndarray, size: np.ndarray) -> np.ndarray:
    """begin[0], begin[0] + 1, ... for size[0] of them, then the next."""
    total = int(size.sum())
    if total == 0:
        return np.zeros(0, np.int64)
    shift = np.repeat(begin - (np.cumsum(size) - size), size)
    return np.arange(total) + shift


_encoders: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]


BLOCK = ("shard int, block int, doc_id array<bigint>, n_tokens array<bigint>, first_word array<bigint>, "
         "words binary")


def write_blocks(docs: DataFrame, path: str, tokenizer_path: str, end_id: int = 0) -> None:
    """Writes documents (doc_id, text) to ``path`` in ascending doc_id order.

    A shard is one range of ids; its blocks follow each other.  Every
    document's ids end with ``end_id``; a null text is that id alone.  Null
    ids come first.  Ties are ordered by a hash of the text, so rows of one id
    may lie in several shards.
    """
    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        shard, number, known = TaskContext.get().partitionId(), 0, encoder(tokenizer_path)
        # A worker may still hold what the tasks of earlier stages let go.
        pa.default_memory_pool().release_unused()
        for batch in batches:
            for part in C.pieces(batch, "text", PIECE):
                ids, size = known.encode(part.column("text"))
                # Every document ends with the end id.
                begin = np.cumsum(size) - size
                ids = np.insert(ids.astype(U), begin + size, end_id)
                size = size + 1
                words, packed = encode_lists(ids, size)
                names, edge = part.column("doc_id"), np.concatenate(([0], np.cumsum(packed)))
                for a in range(0, part.num_rows, BLOCK_ROWS):
                    b = min(a + BLOCK_ROWS, part.num_rows)
                    yield C.rows({
                        "shard": pa.array([shard], pa.int32()), "block": pa.array([number], pa.int32()),
                        "doc_id": pa.array([names.slice(a, b - a).to_pylist()], pa.list_(pa.int64())),
                        "n_tokens": pa.array([size[a:b].tolist()], pa.list_(pa.int64())),
                        "first_word": pa.array([(edge[a:b] - edge[a]).tolist()], pa.list_(pa.int64())),
                        "words": pa.array([words[edge[a]:edge[b]].astype("<u8").tobytes()], pa.binary())})
                    number += 1

    count = max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), 1)
    ordered = (docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
               .withColumn("__tie", F.xxhash64("text"))
               .repartitionByRange(count, "doc_id", "__tie").sortWithinPartitions("doc_id", "__tie", "text").drop("__tie"))
    ordered.mapInArrow(blocks, BLOCK).write.mode("overwrite").parquet(path)


DECODED = "shard int, block int, at int, doc_id bigint, n_tokens bigint, ids_crc32 bigint"


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row in batch.to_pylist():
            lengths = np.array(row["n_tokens"], np.int64)
            ids = decode(np.frombuffer(row["words"], "<u8"), lengths, np.array(row["first_word"], np.int64))
            raw, stop = ids.astype("<u4").tobytes(), np.cumsum(lengths)
            sums = [zlib.crc32(raw[4 * (b - n):4 * b]) for b, n in zip(stop.tolist(), lengths.tolist())]
            n = len(lengths)
            yield C.rows({"shard": pa.array([row["shard"]] * n, pa.int32()),
                          "block": pa.array([row["block"]] * n, pa.int32()),
                          "at": pa.array(range(n), pa.int32()), "doc_id": pa.array(row["doc_id"], pa.int64()),
                          "n_tokens": pa.array(lengths), "ids_crc32": pa.array(sums, pa.int64())})


def read_digests(spark, path: str) -> DataFrame:
    """Per document of the blocks in ``path``: doc_id, start, n_tokens, ids_crc32.

    ``start`` counts the ids of all documents before it.  Running sums are
    taken over blocks of a shard and over shards, never over all documents.
    """
    rows = (spark.read.schema(BLOCK).parquet(path)
            .mapInArrow(_digests, DECODED))
    sizes = spark.read.schema(BLOCK).parquet(path).select(
        F.col("shard").alias("s"), F.col("block").alias("b"),
        F.aggregate("n_tokens", F.lit(0).cast("bigint"), lambda x, y: x + y).alias("n"))
    shards = sizes.groupBy(F.col("s").alias("t")).agg(F.sum("n").alias("n_all"))
    earlier = Window.orderBy("t").rowsBetween(Window.unboundedPreceding, -1)
    shards = shards.select("t", F.coalesce(F.sum("n_all").over(earlier), F.lit(0)).alias("shard_start"))
    inside = Window.partitionBy("s").orderBy("b").rowsBetween(Window.unboundedPreceding, -1)
    blocks = (sizes.withColumn("in_shard", F.coalesce(F.sum("n").over(inside), F.lit(0)))
              .join(shards, F.col("s") == F.col("t"))
              .select("s", "b", (F.col("in_shard") + F.col("shard_start")).alias("block_start")))
    placed = rows.join(blocks, (F.col("shard") == F.col("s")) & (F.col("block") == F.col("b")))
    within = Window.partitionBy("shard", "block").orderBy("at").rowsBetween(Window.unboundedPreceding, -1)
    return placed.select(
        "doc_id", (F.col("block_start") + F.coalesce(F.sum("n_tokens").over(within), F.lit(0))).alias("start"),
        "n_tokens", "ids_crc32")
