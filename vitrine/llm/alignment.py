"""Alignment of two tokenizers' ids over a corpus, with pair counts by external spill counting.

Every text is cut into bytes by both tokenizers.  Offsets where tokens of both
end cut it into groups; every two tokens whose byte ranges overlap are a link,
and the ids of a link are a pair.

* Map tasks gather links, sort them by (B id, A id, document), fold repeats
  and spill them as runs: blocks of zstd-compressed columns, partitioned by a
  radix of the B id and written as a table in the shared folder.
* The blocks of a radix come sorted by their first pair and go through a k-way
  heap merge, which sums the counts of each pair over all runs.  A radix whose
  runs are large (one B id may be in every document) is dealt to chunks by run,
  whose sums meet in one more merge of the same kind.
* Pairs come in B-major order, so a B id's highest count is known as soon as
  the next one begins.  The runs are then read once more beside the counts,
  and each document's shares are streamed back to the run it came in.

Nothing is held whole: a map task holds one run, a merge the blocks that are
open, and a reader of runs the counts of one radix, whose number is bounded by
the pairs of ids that occur and not by the corpus.
"""

from __future__ import annotations

import hashlib
import itertools
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from vitrine.llm import common as C

#: Radix partitions, links of a run, documents of a run, records of a block.
RADIX, RUN_LINKS, RUN_DOCS, BLOCK = 64, 1 << 22, 1 << 20, 1 << 16
#: Compressed bytes of one radix that are merged together; more go to chunks.
CHUNK_BYTES = 32 << 20
A_BITS, B_BITS, DOC_BITS = 20, 20, 20
U = np.uint64

_SPACE = np.zeros(256, bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C]] = True
# White space that units are not cut at, but a tokenizer may join with what is next to it.
_ODD = re.compile("[\r\x1c-\x1f\x85\xa0\u1680\u180e\u2000-\u200f\u2028-\u202f\u205f-\u206f\u3000\ufeff]")


def byte_vocabulary(tokenizer) -> list[bytes]:
    """The bytes of every id of a byte-level tokenizer, whose entries spell bytes as printable letters."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    other = [b for b in range(256) if b not in plain]
    spelt = {chr(b): b for b in plain} | {chr(0x100 + i): b for i, b in enumerate(other)}
    names = tokenizer.get_vocab(with_added_tokens=True)
    out = [b""] * (max(names.values(), default=-1) + 1)
    for name, i in names.items():
        out[i] = bytes(spelt[c] for c in name) if all(c in spelt for c in name) else name.encode()
    return out


def piece_vocabulary(pieces) -> list[bytes]:
    """The bytes of every id of a sentence-piece model."""
    def spelt(i):
        name = pieces.id_to_piece(i)
        return bytes([int(name[3:5], 16)]) if pieces.is_byte(i) else name.replace("▁", " ").encode()
    return [spelt(i) for i in range(pieces.get_piece_size())]


def overlaps(ends_a: np.ndarray, ends_b: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(token of A, token of B, where it ends) of all overlapping tokens of two cuts of one range of bytes."""
    edge = np.union1d(ends_a, ends_b)
    return np.searchsorted(ends_a, edge), np.searchsorted(ends_b, edge), edge


class Aligner:
    """Whole texts to links and groups; every distinct unit is tokenized once.

    A unit is a run of white space and the run of other bytes after it.  The
    byte-level tokenizer never joins what lies in two units, nor does the
    piece model if none of its pieces has white space behind other characters
    (else, and for texts with unusual white space, a whole text is one unit).
    Both cuts end where a unit ends, so groups and links lie within units.
    Known units are kept per process and let go beyond ``most`` links.
    """

    def __init__(self, byte_path: str, piece_path: str, most: int = 6_000_000):
        import os
        import sentencepiece
        from tokenizers import Tokenizer
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # Spark's tasks are the parallelism
        self.a = Tokenizer.from_file(byte_path)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=piece_path)
        self.words_a, self.words_b = byte_vocabulary(self.a), piece_vocabulary(self.b)
        if len(self.words_a) >= 1 << A_BITS or len(self.words_b) >= 1 << B_BITS:
            raise ValueError("a vocabulary has more ids than a pair key holds")
        self.size_a = np.array([len(w) for w in self.words_a], np.int64)
        self.size_b = np.array([len(w) for w in self.words_b], np.int64)
        across = re.compile(rb"[^ \t\n\x0b\x0c][ \t\n\x0b\x0c]")
        self.apart = not any(across.search(w) for w in self.words_b)
        self.lead = self.b.encode("x")
        self.most = most
        self._clear()

    def _clear(self):
        none = np.zeros(0, np.int64)
        self.key = np.zeros(0, U)
        self.place = none
        self.number = np.zeros((0, 4), np.int64)  # A tokens, B tokens, groups, links; -1 where bytes do not join
        self.begin = none
        self.pool = np.zeros(0, U)
        self.names: list[str] = []

    def _cut(self, units: list[bytes], whole: bool) -> tuple[np.ndarray, np.ndarray, list[str]]:
        """Numbers, pair keys end to end and group texts of units."""
        texts = [u.decode() for u in units]
        ids_a = [e.ids for e in self.a.encode_batch_fast(texts, add_special_tokens=False)]
        if whole:  # the model itself puts the first space
            ids_b = self.b.encode([t[1:] for t in texts], num_threads=1)
        else:
            ids_b = [x[len(self.lead):] for x in self.b.encode(["x" + t for t in texts], num_threads=1)]
        join, wa, wb = b"".join, self.words_a.__getitem__, self.words_b.__getitem__
        good = np.array([join(map(wa, x)) == u == join(map(wb, y)) for u, x, y in zip(units, ids_a, ids_b)], bool)
        number = np.full((len(units), 4), -1, np.int64)
        some = np.flatnonzero(good).tolist()
        if not some:
            return number, np.zeros(0, U), [""] * len(units)
        na, nb = (np.array([len(ids[i]) for i in some], np.int64) for ids in (ids_a, ids_b))
        fa, fb = (np.fromiter(itertools.chain.from_iterable(ids[i] for i in some), np.int64) for ids in (ids_a, ids_b))
        ends_a, ends_b = np.cumsum(self.size_a[fa]), np.cumsum(self.size_b[fb])
        ia, ib, edge = overlaps(ends_a, ends_b)
        stop = np.cumsum([len(units[i]) for i in some])
        of = np.searchsorted(stop, edge)
        both = (ends_a[ia] == edge) & (ends_b[ib] == edge)
        number[some] = np.stack((na, nb, np.bincount(of[both], minlength=len(some)), np.bincount(of, minlength=len(some))), 1)
        joint = edge[both]
        # Group texts: where a token follows one of its own group there is a comma.
        said_a, said_b = (_said(ids, np.searchsorted(joint, ends)) for ids, ends in ((fa, ends_a), (fb, ends_b)))
        groups = [f"{x}|{y}" for x, y in zip(said_a, said_b)]
        cut = np.concatenate(([0], np.cumsum(number[some, 2]))).tolist()
        names = [""] * len(units)
        for k, i in enumerate(some):
            names[i] = ";".join(groups[cut[k]:cut[k + 1]])
        return number, (fb[ib].astype(U) << U(A_BITS)) | fa[ia].astype(U), names

    def _learn(self, key: np.ndarray, units: list[bytes]):
        number, pairs, names = self._cut(units, False)
        links = np.maximum(number[:, 3], 0)
        begin = len(self.pool) + np.cumsum(links) - links
        sort = np.argsort(key)
        at = np.searchsorted(self.key, key[sort])
        self.key = np.insert(self.key, at, key[sort])
        self.place = np.insert(self.place, at, len(self.names) + sort)
        self.number = np.concatenate((self.number, number))
        self.begin = np.concatenate((self.begin, begin))
        self.pool = np.concatenate((self.pool, pairs))
        self.names += names

    def _places(self, key: np.ndarray) -> np.ndarray:
        return self.place[np.searchsorted(self.key, key)]

    def align(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, list[str]]:
        """Of every text A tokens, B tokens, groups and links; all pair keys, the text of each, and groups as text.

        Null and empty texts, and those whose bytes either tokenizer does not
        give back, have none.
        """
        texts = pc.fill_null(texts.cast(pa.large_string()), "")
        strings = texts.to_pylist()
        odd = [i for i, t in enumerate(strings) if t and (not self.apart or _ODD.search(t))]
        plain = np.array([bool(t) for t in strings], bool)
        plain[odd] = False
        spaced = pc.if_else(pa.array(plain), pc.binary_join_element_wise(pa.scalar(" ", pa.large_string()), texts,
                            pa.scalar("", pa.large_string())), pa.scalar("", pa.large_string()))
        data, offsets = C.text_bytes(spaced)
        space = _SPACE[data]
        opens = np.zeros(len(data) + 1, bool)
        opens[1:-1] = space[1:] & ~space[:-1]
        opens[offsets[:-1]] = True
        opens[-1] = False
        start = np.flatnonzero(opens)
        row = np.searchsorted(offsets, start, "right") - 1
        stop = np.append(start[1:], len(data)) if len(start) else start
        h = C.unit_hash(data, start, stop)
        distinct, one = np.unique(h, return_index=True)
        if len(self.pool) > self.most:
            self._clear()
        known = np.searchsorted(self.key, distinct)
        new = np.ones(len(distinct), bool)
        if len(self.key):
            new = self.key[np.minimum(known, len(self.key) - 1)] != distinct
        if new.any():
            raw, one = data.tobytes(), one[new]
            self._learn(distinct[new], [raw[x:y] for x, y in zip(start[one].tolist(), stop[one].tolist())])
        at = self._places(h) if len(h) else np.zeros(0, np.int64)
        number = self.number[at]
        n = len(strings)
        bad = np.zeros(n, bool)
        bad[row[number[:, 0] < 0]] = True
        fine = ~bad[row]
        at, row, number = at[fine], row[fine], number[fine]
        total = np.zeros((n, 4), np.int64)
        cut = np.searchsorted(row, np.arange(n + 1))
        sums = np.concatenate((np.zeros((1, 4), np.int64), np.cumsum(number, 0)))
        total += sums[cut[1:]] - sums[cut[:-1]]
        size = number[:, 3]
        pairs = self.pool[C.ranges(self.begin[at], size)]
        owner = np.repeat(row, size)
        names = list(map(self.names.__getitem__, at.tolist()))
        said = [";".join(names[x:y]) for x, y in zip(cut[:-1].tolist(), cut[1:].tolist())]
        for i in odd:
            one_number, keys, name = self._cut([b" " + strings[i].encode()], True)
            if one_number[0, 0] >= 0:
                total[i], said[i] = one_number[0], name[0]
                pairs = np.concatenate((pairs, keys))
                owner = np.concatenate((owner, np.full(len(keys), i)))
        return total, pairs, owner, said


def _said(ids: np.ndarray, group: np.ndarray) -> list[str]:
    """The ids of every group, with commas between; ids lie in the order of their groups."""
    out: list[str] = []
    last = -1
    for i, g in zip(ids.tolist(), group.tolist()):
        if g == last:
            out[-1] += f",{i}"
        else:
            out.append(str(i))
            last = g
    return out


_aligners: dict[tuple[str, str], Aligner] = {}


def aligner(byte_path: str, piece_path: str) -> Aligner:
    if (byte_path, piece_path) not in _aligners:
        _aligners[byte_path, piece_path] = Aligner(byte_path, piece_path)
    return _aligners[byte_path, piece_path]


#: One table for both: blocks of runs (radix >= 0), and a row per document (radix -1).
SPILLED = ("radix int, run bigint, first bigint, pairs binary, shares binary, at int, doc_id bigint, n_a bigint, "
           "n_b bigint, n_groups bigint, n_links bigint, groups string")
_KINDS = {"radix": pa.int32(), "run": pa.int64(), "first": pa.int64(), "pairs": pa.binary(), "shares": pa.binary(),
          "at": pa.int32(), "doc_id": pa.int64(), "n_a": pa.int64(), "n_b": pa.int64(), "n_groups": pa.int64(),
          "n_links": pa.int64(), "groups": pa.string()}


def _rows(n: int, **given) -> pa.RecordBatch:
    return C.rows({c: (v if isinstance(v := given[c], pa.Array) else pa.array(v, k)) if c in given else pa.nulls(n, k)
                   for c, k in _KINDS.items()})


def radix_of(pairs: np.ndarray) -> np.ndarray:
    """Radix of the B id of pair keys."""
    return (C.mix(pairs >> U(A_BITS)) % U(RADIX)).astype(np.uint8)


def spilled(held: list[np.ndarray], run: int) -> Iterator[pa.RecordBatch]:
    """The blocks of a run: links (pair and document in one number) sorted, folded, radix-partitioned."""
    links = np.sort(np.concatenate(held)) if held else np.zeros(0, U)
    if not len(links):
        return
    first = C.heads(links)
    times = np.diff(np.append(first, len(links)))
    links = links[first]
    pair, doc = links >> U(DOC_BITS), (links & U((1 << DOC_BITS) - 1)).astype(np.int64)
    radix = radix_of(pair)
    order = np.argsort(radix, kind="stable")
    edges = np.searchsorted(radix[order], np.arange(RADIX + 1))
    for r in range(RADIX):
        for x in range(int(edges[r]), int(edges[r + 1]), BLOCK):
            mine = order[x:min(x + BLOCK, int(edges[r + 1]))]
            p, d, t = pair[mine], doc[mine], times[mine]
            head = C.heads(p)
            yield _rows(1, radix=[r], run=[run], first=[int(p[0])], pairs=[C.pack(p[head], np.add.reduceat(t, head))],
                        shares=[C.pack(np.diff(np.append(head, len(p))), d, t)])


def _spiller(byte_path: str, piece_path: str, keep_groups: bool):
    def spill(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        made = itertools.count(TaskContext.get().partitionId() << 32)
        run, known = next(made), aligner(byte_path, piece_path)
        held: list = []
        size = docs = 0
        for batch in batches:
            for part in C.pieces(batch, "text"):
                if held and (size >= RUN_LINKS or docs + part.num_rows > RUN_DOCS):
                    yield from spilled(held, run)
                    run, held, size, docs = next(made), [], 0, 0
                total, pairs, owner, said = known.align(part.column("text"))
                held.append((pairs << U(DOC_BITS)) | (owner + docs).astype(U))
                if not keep_groups:
                    said = [hashlib.sha256(x.encode()).hexdigest() if x else "" for x in said]
                n = part.num_rows
                yield _rows(n, radix=[-1] * n, run=[run] * n, at=pa.array(np.arange(docs, docs + n), pa.int32()),
                            doc_id=part.column("doc_id"), groups=said, **{
                                c: pa.array(total[:, i]) for i, c in enumerate(("n_a", "n_b", "n_groups", "n_links"))})
                size, docs = size + len(pairs), docs + n
        yield from spilled(held, run)
    return spill


def merged(blocks: Iterator[tuple[int, np.ndarray, np.ndarray]]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Ascending keys and their summed counts, of sorted blocks (first key, keys, counts) that come by first key."""
    for keys, counts in C.heap_merge(blocks):
        head = C.heads(keys)
        yield keys[head], np.add.reduceat(counts, head)


def _by_group(batches: Iterator[pa.RecordBatch], *columns: str) -> Iterator[tuple[tuple, Iterator[tuple]]]:
    """Rows of sorted batches by their first two columns."""
    rows = (row for b in batches for row in zip(*(b.column(c).to_pylist() for c in columns)))
    return itertools.groupby(rows, key=lambda r: r[:2])


COUNTED = "radix int, chunk bigint, first bigint, pairs binary"


def _table(rows: list[tuple]) -> pa.RecordBatch:
    radix, chunk, first, pairs = zip(*rows)
    return C.rows({"radix": pa.array(radix, pa.int32()), "chunk": pa.array(chunk, pa.int64()),
                   "first": pa.array(first, pa.int64()), "pairs": pa.array(pairs, pa.binary())})


def _in_blocks(found: Iterator[tuple[np.ndarray, ...]]) -> Iterator[list[np.ndarray]]:
    held, size = [], 0
    for part in found:
        held.append(part)
        size += len(part[0])
        if size >= BLOCK:
            yield [np.concatenate(x) for x in zip(*held)]
            held, size = [], 0
    if held:
        yield [np.concatenate(x) for x in zip(*held)]


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sums of every pair over the blocks of a radix and chunk."""
    for (radix, chunk), rows in _by_group(batches, "radix", "chunk", "first", "pairs"):
        for keys, counts in _in_blocks(merged((r[2], *C.unpack(r[3], 2)) for r in rows)):
            yield _table([(radix, chunk, int(keys[0]), C.pack(keys, counts))])


def with_best(found: Iterator[tuple[np.ndarray, np.ndarray]]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Adds to ascending pairs whether their count is their B id's highest; a B id is let out when it is whole."""
    rest = (np.zeros(0, np.int64), np.zeros(0, np.int64))

    def marked(keys, counts):
        side = keys >> A_BITS
        head = C.heads(side)
        most = np.maximum.reduceat(counts, head)
        return keys, counts, (counts == np.repeat(most, np.diff(np.append(head, len(keys))))).astype(np.int64)
    for keys, counts in found:
        keys, counts = np.concatenate((rest[0], keys)), np.concatenate((rest[1], counts))
        whole = int(np.searchsorted(keys, keys[-1] >> A_BITS << A_BITS))
        if whole:
            yield marked(keys[:whole], counts[:whole])
        rest = keys[whole:], counts[whole:]
    if len(rest[0]):
        yield marked(*rest)


def _maxima(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for (radix, _), rows in _by_group(batches, "radix", "radix", "first", "pairs"):
        for keys, counts, best in _in_blocks(with_best(merged((r[2], *C.unpack(r[3], 2)) for r in rows))):
            yield _table([(radix, 0, int(keys[0]), C.pack(keys, counts, best))])


def _give_back(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per block of a run, the shares of its documents; a radix's counts come before its blocks."""
    for _, rows in _by_group(batches, "radix", "chunk", "run", "pairs", "shares"):
        counts: list = []
        known = None
        for _, _, run, pairs, shares in rows:
            if run is None:
                counts.append(C.unpack(pairs, 3))
                continue
            known = known or [np.concatenate(x) for x in zip(*counts)]
            keys, _ = C.unpack(pairs, 2)
            number, doc, times = C.unpack(shares, 3)
            at = np.repeat(np.searchsorted(known[0], keys), number)
            docs, back = np.unique(doc, return_inverse=True)
            share, best = np.zeros((2, len(docs)), np.int64)
            np.add.at(share, back, times * known[1][at])
            np.add.at(best, back, times * known[2][at])
            yield C.rows({"run": pa.array([run], pa.int64()), "shares": pa.array([C.pack(docs, share, best)], pa.binary())})


def _gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sums of the shares of a run's documents."""
    for (run, _), rows in _by_group(batches, "run", "run", "shares"):
        total = np.zeros((2, 0), np.int64)
        for row in rows:
            docs, share, best = C.unpack(row[2], 3)
            if docs[-1] >= total.shape[1]:
                total = np.pad(total, ((0, 0), (0, int(docs[-1]) + 1 - total.shape[1])))
            total[0, docs] += share
            total[1, docs] += best
        n = total.shape[1]
        yield C.rows({"run": pa.array([run] * n, pa.int64()), "at": pa.array(np.arange(n), pa.int32()),
                      "count_sum": pa.array(total[0]), "n_best": pa.array(total[1])})


def _sorted(df: DataFrame, keys: list[str], order: list) -> DataFrame:
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return df.repartition(parts, *keys).sortWithinPartitions(*order)


def runs(docs: DataFrame, byte_path: str, piece_path: str, keep_groups: bool = False) -> DataFrame:
    """Rows of documents and blocks of runs, written to the shared folder."""
    keyed = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return C.stored(keyed.mapInArrow(_spiller(byte_path, piece_path, keep_groups), SPILLED))


def _chunked(blocks: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Blocks with their chunk, and how many chunks each radix has."""
    many = blocks.groupBy(F.col("radix").alias("r")).agg(
        F.ceil(F.sum(F.length("pairs") + F.length("shares")) / F.lit(CHUNK_BYTES)).alias("chunks"))
    # At most RADIX rows: how many chunks each radix is dealt to.
    found = dict(many.collect())
    chunks = F.element_at(F.array(*[F.lit(found.get(r, 1)).cast("bigint") for r in range(RADIX)]), F.col("radix") + 1)
    each = blocks.sparkSession.range(RADIX).select(F.col("id").cast("int").alias("radix")).select(
        "radix", F.explode(F.sequence(F.lit(0).cast("bigint"), chunks - 1)).alias("chunk"))
    return blocks.withColumn("chunk", F.pmod(F.xxhash64("run"), chunks)), each


def _counted(blocks: DataFrame) -> DataFrame:
    sums = _sorted(blocks.select("radix", "chunk", "first", "pairs"), ["radix", "chunk"],
                   ["radix", "chunk", "first"]).mapInArrow(_count, COUNTED)
    return _sorted(sums, ["radix"], ["radix", "first"]).mapInArrow(_maxima, COUNTED)


def _opened(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for blob in batch.column("pairs").to_pylist():
            keys, counts, best = C.unpack(blob, 3)
            yield C.rows({"a": pa.array(keys & ((1 << A_BITS) - 1)), "b": pa.array(keys >> A_BITS),
                          "n_links": pa.array(counts), "best": pa.array(best == 1)})


def pair_counts(docs: DataFrame, byte_path: str, piece_path: str) -> DataFrame:
    """(a, b, n_links, best): how many links of the corpus hold each pair of ids, and whether that is b's highest."""
    blocks, _ = _chunked(runs(docs, byte_path, piece_path).filter("radix >= 0"))
    return _counted(blocks).mapInArrow(_opened, "a bigint, b bigint, n_links bigint, best boolean")


def align(docs: DataFrame, byte_path: str, piece_path: str, keep_groups: bool = False) -> DataFrame:
    """Alignment of every row of ``docs`` (doc_id, text), one row each.

    Returns doc_id, n_a and n_b (tokens), n_groups, n_links, n_best (links
    whose count is their B id's highest in the corpus, ties included),
    count_sum (of the counts of all links) and groups: `a1,a2|b1;a3|b2,b3` as
    text, or its SHA-256.  Tokenizer A reads a space and the text, B the text.
    Null and empty texts, and texts whose bytes either tokenizer does not give
    back, have no tokens: zeros and ''.  Rows with one id, or none, are rows
    like others; other columns are ignored; an empty table gives an empty one.
    """
    made = runs(docs, byte_path, piece_path, keep_groups)
    blocks, chunks = _chunked(made.filter("radix >= 0"))
    counts = _counted(blocks)
    none = F.lit(None)
    both = (counts.drop("chunk").join(chunks, "radix").select(
        "radix", "chunk", F.lit(0).alias("kind"), none.cast("bigint").alias("run"), "first", "pairs", none.cast("binary").alias("shares"))
        .union(blocks.select("radix", "chunk", F.lit(1), "run", "first", "pairs", "shares")))
    back = _sorted(both, ["radix", "chunk"], ["radix", "chunk", "kind", "first"]).mapInArrow(
        _give_back, "run bigint, shares binary")
    sums = _sorted(back, ["run"], ["run"]).mapInArrow(_gather, "run bigint, at int, count_sum bigint, n_best bigint")
    rows = made.filter("radix < 0").select("run", "at", "doc_id", "n_a", "n_b", "n_groups", "n_links", "groups")
    return rows.join(sums, ["run", "at"], "left").select(
        "doc_id", "n_a", "n_b", "n_groups", "n_links", F.coalesce("n_best", F.lit(0).cast("bigint")).alias("n_best"),
        F.coalesce("count_sum", F.lit(0).cast("bigint")).alias("count_sum"), "groups")
