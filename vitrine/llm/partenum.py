"""Jaccard join of word shingles by partition-and-enumerate signatures, exact.

Sizes are cut into bands.  A pair whose smaller set lies in band j differs in
at most K(j) features, so the feature domain is cut into n1 partitions, one of
which holds at most k2 = ceil((K + 1) / n1) - 1 of the differences.  Each is
cut into n2 parts, and every subset of n2 - k2 parts gives a signature: one
subset is free of differences, so two similar sets share a signature.  No
randomness decides whether a pair is found; hashes only decide what else
shares a signature.  A set signs for its own band and, if it can be the larger
of a pair, for the band before.

Subsets that are empty in both sets say nothing.  There are some partitions
more than the count above needs, and a set only signs its empty subsets if so
many of its partitions have one that a partner's agreement could lie there
alone.

* Map tasks sort signatures and send them as compressed blocks, dealt by a
  radix of the signature; a k-way merge finds the classes that share one.
  Signatures that one run alone has ``LARGE`` times are dealt out as plain rows
  instead, and grouped by aggregates and joins that Spark can split.
* Classes (of equal sets) that share a signature are compared with the least of
  them; cell counts, whose distance never exceeds the sets' own, are compared
  before full sets are.
* Where a signature's classes are not one component yet, all pairs of different
  components are compared by their cell counts, in place if few, else in tiles
  of bounded size; the pairs left, once each, by their full sets.
"""

from __future__ import annotations

import functools
import itertools
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from vitrine.llm import common as C, neardup
from vitrine.llm.components import components

#: Signatures of a run, entries of a block, repeats in a run that make a signature large.
RUN, BLOCK, LARGE = 1 << 21, 1 << 15, 256
#: Signatures that a set of a small band may have; larger bands have a fifth more than differences.
FEW_SIGNATURES = 40
U = np.uint64
_LARGE_MARK = -1

SIGNED = "doc_id bigint, tk bigint, n_shingles bigint, cid bigint, cells binary, coarse binary"
#: Cells of the coarse counts that go to tiles, and rounds in which classes are compared with hubs.
COARSE, ROUNDS = 64, 3
SPILLED = "radix int, first bigint, large boolean, sigs binary, cids binary"
MET = "sig bigint, node bigint, n bigint, hub bigint, cid bigint"


@functools.lru_cache
def shape(differences: int) -> tuple[int, int, int]:
    """(n1, n2, k2) for at most so many differences.

    Of all shapes with few enough signatures the one whose signatures cover
    the largest share of a set: that is, meet by chance least often.  Small
    bands take subsets of several parts, large ones of one partition each.
    """
    most = max(FEW_SIGNATURES, 1.2 * (differences + 1))
    best = (0.0, 0, (differences + 1, 1, 0))
    for k2 in range(min(differences, 5) + 1):
        n1 = differences // (k2 + 1) + 1
        for n2 in range(k2 + 1, k2 + 7 if k2 else 2):
            count = n1 * math.comb(n2, k2)
            if count <= most:
                best = max(best, ((n2 - k2) / (n2 * n1), -count, (n1, n2, k2)))
    return best[2]


class Bands:
    """Sizes l..r of the smaller set of a pair, the larger one's greatest, and the differences allowed."""

    def __init__(self, percent: int, most: int):
        low, self.right, self.largest, self.differ = 1, [], [], []
        while low <= max(most, 1):
            right = low * 100 // percent
            largest = right * 100 // percent
            self.right.append(right)
            self.largest.append(largest)
            self.differ.append((right + largest) * (100 - percent) // (100 + percent))
            low = right + 1
        self.right, self.largest, self.differ = (np.array(x, np.int64) for x in (self.right, self.largest, self.differ))


def signatures(flat: np.ndarray, begin: np.ndarray, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """(signature, row) of all sets that lie end to end in ``flat``; 48-bit signatures.

    Signatures that are alike by chance only cost a comparison.

    Sets that are only similar to equal ones have none.
    """
    size = np.diff(begin)
    bands = Bands(percent, int(size.max(initial=0)))
    own = np.searchsorted(bands.right, size)
    sigs, rows = [], []
    for band in np.unique(np.concatenate((own, own - 1))).tolist():
        if band < 0 or not bands.differ[band]:
            continue
        mine = np.flatnonzero(((own == band) | (own == band + 1)) & (size <= bands.largest[band]) & (size > 0))
        if len(mine):
            s, r = _signed(flat, begin, mine, band, int(bands.differ[band]))
            sigs.append(s)
            rows.append(r)
    none = np.zeros(0, np.int64)
    return (np.concatenate(sigs), np.concatenate(rows)) if sigs else (none, none)


def _signed(flat, begin, mine, band: int, differences: int) -> tuple[np.ndarray, np.ndarray]:
    n1, n2, k2 = shape(differences)
    needed = differences // (k2 + 1)  # so many partitions can have more than k2 differences
    n1 += 2 + n1 // 12 if n1 >= 8 else 0
    size = begin[mine + 1] - begin[mine]
    features = flat[C.ranges(begin[mine], size)]
    h = C.mix(features ^ U(0x51ED270B9F65A4C3))
    part = (h >> U(32)) * U(n1) >> U(32)
    cell = (part * U(n2) + ((h & U(0xFFFFFFFF)) * U(n2) >> U(32))).astype(np.int64) + np.repeat(
        np.arange(len(mine)) * (n1 * n2), size)
    total = np.zeros(len(mine) * n1 * n2, U)
    np.add.at(total, cell, C.mix(features + U(0x2F9BE6CC6A09E667)))
    total = total.reshape(-1, n2)
    held = np.bincount(cell, minlength=total.size).reshape(-1, n2)
    subsets = list(itertools.combinations(range(n2), n2 - k2))
    sums = np.stack([total[:, s].sum(1, dtype=U) for s in map(list, subsets)], 1)
    some = np.stack([held[:, s].any(1) for s in map(list, subsets)], 1)
    hollow = (~some.all(1)).reshape(len(mine), n1).sum(1)
    keep = some.reshape(len(mine), n1, -1) | (hollow >= n1 - needed)[:, None, None]
    tag = C.mix((U(band) << U(40)) + np.arange(n1 * len(subsets), dtype=U)).reshape(1, n1, len(subsets))
    sig = C.mix(sums.reshape(len(mine), n1, -1) ^ tag) >> U(16)
    at, _, _ = np.nonzero(keep)
    return sig[keep].astype(np.int64), mine[at]


def cells(flat: np.ndarray, begin: np.ndarray) -> list[bytes]:
    """Of every set the number of features in each of 2**t cells, about one cell for every two features."""
    out = []
    h = C.mix(flat ^ U(0x7F4A7C15F39CC060))
    for a, b in zip(begin[:-1].tolist(), begin[1:].tolist()):
        t = max((b - a).bit_length() - 1, 0)
        count = np.bincount((h[a:b] >> U(64 - t)).astype(np.int64) if t else np.zeros(b - a, np.int64), minlength=1 << t)
        out.append(np.minimum(count, 255).astype(np.uint8).tobytes())
    return out


def coarse(counts: bytes) -> bytes:
    """Cell counts summed to ``COARSE`` cells at most, of two bytes each."""
    x = np.frombuffer(counts, np.uint8).astype(np.int64)
    known = x.max() < 255
    x = x.reshape(min(len(x), COARSE), -1).sum(1) if known else np.full(1, 65535)
    return np.minimum(x, 65535).astype("<u2").tobytes()


def _signer(width: int):
    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in C.pieces(batch, "text"):
                flat, begin = neardup.sets_of(part.column("text"), width)
                size, counts = np.diff(begin), cells(flat, begin)
                yield C.rows({
                    "doc_id": part.column("doc_id"), "tk": part.column("tk"), "n_shingles": pa.array(size),
                    "cid": pa.array(neardup.class_ids(flat, begin).view(np.int64), mask=size == 0),
                    "cells": pa.array(counts, pa.binary()), "coarse": pa.array([coarse(c) for c in counts], pa.binary())})
    return sign


def _spiller(width: int, percent: int, radixes: int):
    """Blocks of (signature, class), sorted and dealt by the signature's radix."""
    def block(sig, cid, large=False):
        names, at = np.unique(cid, return_inverse=True)
        return C.rows({"radix": pa.array([int(sig[0]) * radixes >> 48], pa.int32()),
                       "first": pa.array([int(sig[0])], pa.int64()), "large": pa.array([large]),
                       "sigs": pa.array([C.pack(sig[:1] if large else sig)], pa.binary()),
                       "cids": pa.array([C.pack(names, at)], pa.binary())})

    def run_of(sigs, cids):
        sig, cid = np.concatenate(sigs), np.concatenate(cids)
        order = np.lexsort((cid, sig))
        sig, cid = sig[order], cid[order]
        once = np.append(True, (sig[1:] != sig[:-1]) | (cid[1:] != cid[:-1]))[:len(sig)]
        sig, cid = sig[once], cid[once]
        head = C.heads(sig)
        times = np.diff(np.append(head, len(sig)))
        for a, n in zip(head[times > LARGE].tolist(), times[times > LARGE].tolist()):
            for x in range(a, a + n, BLOCK):
                yield block(sig[x:min(x + BLOCK, a + n)], cid[x:min(x + BLOCK, a + n)], True)
        small = np.repeat(times <= LARGE, times)
        sig, cid = sig[small], cid[small]
        radix = sig * radixes >> 48
        edges = np.searchsorted(radix, np.arange(radixes + 1))
        for a, b in zip(edges[:-1].tolist(), edges[1:].tolist()):
            for x in range(a, b, BLOCK):
                yield block(sig[x:min(x + BLOCK, b)], cid[x:min(x + BLOCK, b)])

    def spill(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sigs, cids, size = [], [], 0
        for batch in batches:
            for part in C.pieces(batch, "text"):
                flat, begin = neardup.sets_of(part.column("text"), width)
                sig, row = signatures(flat, begin, percent)
                sigs.append(sig)
                cids.append(neardup.class_ids(flat, begin).view(np.int64)[row])
                size += len(sig)
                if size >= RUN:
                    yield from run_of(sigs, cids)
                    sigs, cids, size = [], [], 0
        if size:
            yield from run_of(sigs, cids)
    return spill


def _meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Groups of classes that share a signature, of blocks sorted by radix and first signature.

    A group is known by a hash of its members, and has its size and its least
    member; members of large signatures come out one by one.
    """
    plain: list = []

    def opened() -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        for batch in batches:
            for first, large, sigs, cids in zip(*(batch.column(c).to_pylist() for c in ("first", "large", "sigs", "cids"))):
                names, at = C.unpack(cids, 2)
                if large:
                    plain.append((first, names[at]))
                    yield first, np.array([first]), np.array([_LARGE_MARK])
                else:
                    yield first, C.unpack(sigs, 1)[0], names[at]

    def table(sig, node, n, hub, cid):
        none = pa.nulls(len(cid), pa.int64())
        return C.rows({c: none if v is None else pa.array(v, pa.int64())
                       for c, v in (("sig", sig), ("node", node), ("n", n), ("hub", hub), ("cid", cid))})

    for sig, cid in C.heap_merge(opened()):
        while plain:
            first, members = plain.pop()
            yield table(np.full(len(members), first), None, None, None, members)
        order = np.lexsort((cid, sig))
        sig, cid = sig[order], cid[order]
        once = np.append(True, (sig[1:] != sig[:-1]) | (cid[1:] != cid[:-1]))
        sig, cid = sig[once], cid[once]
        head = C.heads(sig)
        n = np.diff(np.append(head, len(sig)))
        marked = np.logical_or.reduceat(cid == _LARGE_MARK, head)
        if marked.any():
            of = np.repeat(marked, n) & (cid != _LARGE_MARK)
            yield table(sig[of], None, None, None, cid[of])
        node = C.mix(np.add.reduceat(C.mix(cid.view(U)), head) + n.astype(U)).view(np.int64)
        chosen = np.flatnonzero((n > 1) & ~marked)
        _, first = np.unique(node[chosen], return_index=True)
        chosen = chosen[first]
        at = C.ranges(head[chosen], n[chosen])
        each = np.repeat(chosen, n[chosen])
        if len(at):
            yield table(None, node[each], n[each], cid[head[each]], cid[at])
    for first, members in plain:
        yield table(np.full(len(members), first), None, None, None, members)


def met(docs: DataFrame, width: int, percent: int) -> DataFrame:
    """(node, n, hub, cid): members of every group of classes that share a signature, stored."""
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    blocks = neardup.keyed(docs).select("text").mapInArrow(_spiller(width, percent, parts), SPILLED)
    found = C.stored(blocks.repartition(parts, "radix").sortWithinPartitions("radix", "first").mapInArrow(_meet, MET))
    small = found.filter("sig is null").select("node", "n", "hub", "cid").distinct()
    large = found.filter("sig is not null").select("sig", "cid").distinct()
    heads = large.groupBy("sig").agg(F.count("*").alias("n"), F.min("cid").alias("hub"))
    large = large.join(heads.filter("n > 1"), "sig").select(F.col("sig").alias("node"), "n", "hub", "cid")
    return C.stored(small.union(large))


def _near_cells(percent: int):
    """Pairs whose cell counts are no further apart than similar sets of their sizes can be."""
    def fold(x: np.ndarray, n: int) -> np.ndarray:
        return x.reshape(n, -1).sum(1)

    def near(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = np.ones(batch.num_rows, bool)
            for i, (x, y) in enumerate(zip(batch.column("ca").to_pylist(), batch.column("cb").to_pylist())):
                x, y = np.frombuffer(x, np.uint8).astype(np.int64), np.frombuffer(y, np.uint8).astype(np.int64)
                n = min(len(x), len(y))
                full = x.max() == 255 or y.max() == 255  # a count that is not known
                keep[i] = full or (100 + percent) * np.abs(fold(x, n) - fold(y, n)).sum() <= (100 - percent) * (x.sum() + y.sum())
            yield batch.select(["a", "b"]).filter(pa.array(keep))
    return near


def _tiler(percent: int, nearest: bool):
    """Pairs of different components within each tile whose coarse counts allow the similarity; rows come sorted by tile.

    With ``nearest`` a class only names the nearest one of each other component.
    """
    def compare(rows: list) -> pa.RecordBatch:
        cids, comps, least, size = (np.array([r[i] for r in rows]) for i in (1, 2, 3, 4))
        counts = [np.frombuffer(r[5], "<u2").astype(np.int64) for r in rows]
        n = min(map(len, counts))
        x = np.stack([c.reshape(n, -1).sum(1) for c in counts])
        unknown = np.array([c.max() == 65535 for c in counts])
        a, b = [], []
        for i in np.flatnonzero(comps != least).tolist():
            apart = np.abs(x - x[i]).sum(1)
            near = (100 + percent) * apart <= (100 - percent) * (size + size[i])
            fits = 100 * np.minimum(size, size[i]) >= percent * np.maximum(size, size[i])
            hit = np.flatnonzero((near | unknown | unknown[i]) & fits & (comps != comps[i]))
            if nearest and len(hit):
                hit = hit[np.lexsort((cids[hit], apart[hit], comps[hit]))]
                hit = hit[C.heads(comps[hit])]
            a.append(np.minimum(cids[i], cids[hit]))
            b.append(np.maximum(cids[i], cids[hit]))
        none = np.zeros(0, np.int64)
        return C.rows({"a": pa.array(np.concatenate(a) if a else none), "b": pa.array(np.concatenate(b) if b else none)})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = (row for b in batches for row in zip(*[b.column(c).to_pylist() for c in (
            "tile", "cid", "comp", "least", "n_shingles", "coarse")]))
        for _, of_tile in itertools.groupby(rows, key=lambda r: r[0]):
            yield compare(list(of_tile))
    return run


def _sieved(pairs: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) that sizes and cell counts leave."""
    sizes = classes.select("cid", "n_shingles")
    for side in ("a", "b"):
        pairs = pairs.join(sizes.select(F.col("cid").alias(side), F.col("n_shingles").alias("n" + side)), side)
    pairs = pairs.filter(F.least("na", "nb") * 100 >= F.greatest("na", "nb") * percent).select("a", "b")
    for side in ("a", "b"):
        pairs = pairs.join(classes.select(F.col("cid").alias(side), F.col("cells").alias("c" + side)), side)
    return pairs.mapInArrow(_near_cells(percent), "a bigint, b bigint")


def _linked(docs: DataFrame, width: int, percent: int) -> tuple[DataFrame, DataFrame]:
    """Signed documents, and the component of every class that has links."""
    signed = C.stored(neardup.keyed(docs).mapInArrow(_signer(width), SIGNED))
    nodes = met(docs, width, percent)
    classes = C.stored(signed.join(nodes.select("cid").distinct(), "cid", "left_semi").groupBy("cid").agg(
        F.min(F.struct("doc_id", "tk")).alias("rep"), F.first("n_shingles").alias("n_shingles"),
        F.first("cells").alias("cells"), F.first("coarse").alias("coarse")))
    sets = C.stored(neardup.full_sets(classes, docs, width))
    # First every class with one hub, then those that a node does not hold in its least component with one of that.
    stars = nodes.filter("hub <> cid").groupBy(F.col("cid").alias("b")).agg(F.min("hub").alias("a")).select("a", "b")
    links, mixed = None, nodes

    def joined(found: DataFrame) -> tuple[DataFrame, DataFrame]:
        """All links so far, and the nodes that still hold several components."""
        both = C.stored(found if links is None else links.union(found))
        comp = C.stored(components(both)).withColumnRenamed("node", "node_c")
        return both, C.stored(neardup.mixed_nodes(mixed.select("node", "cid"), comp))

    for turn in range(ROUNDS):
        links, mixed = joined(neardup.confirmed(_sieved(stars, classes, percent), sets, percent))
        hubs = mixed.filter("comp = least").groupBy("node").agg(F.min_by("cid", F.xxhash64("cid", F.lit(turn))).alias("hub"))
        stars = (mixed.filter("comp <> least").join(hubs, "node").groupBy(F.col("cid").alias("c"))
                 .agg(F.min_by("hub", F.xxhash64("node", F.lit(turn))).alias("h"))
                 .select(F.least("c", "h").alias("a"), F.greatest("c", "h").alias("b")).distinct())

    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def tiled(nearest: bool) -> DataFrame:
        tiles = neardup.tiles_of(mixed.filter(F.col("n") > neardup.SMALL_NODE), classes.select("cid", "n_shingles", "coarse"))
        return (tiles.repartition(parts, "tile").sortWithinPartitions("tile")
                .mapInArrow(_tiler(percent, nearest), "a bigint, b bigint"))
    # Crowds that hang together are joined by their nearest pairs; what is left then is compared without exception.
    links, mixed = joined(neardup.confirmed(_sieved(tiled(True).distinct(), classes, percent), sets, percent))
    pairs = tiled(False).union(neardup.within_small(mixed))
    more = C.stored(neardup.confirmed(_sieved(pairs.distinct(), classes, percent), sets, percent))
    return signed, C.stored(components(links.union(more)))


def jaccard_components(docs: DataFrame, width: int = 5, percent: int = 80) -> DataFrame:
    """(doc_id, n_shingles, component_id), one row per row of ``docs`` (doc_id, text).

    Two documents are linked if ``percent`` of the union of their shingle sets
    is shared; ``component_id`` is the least doc_id that links reach.  Texts
    without words (null, empty, blank) have an empty set and are linked with
    nothing.  Rows with one doc_id are rows like others; a null doc_id names a
    component only if there is no other.  Other columns are ignored; an empty
    table gives an empty table.
    """
    signed, comp = _linked(docs, width, percent)
    named = neardup.with_components(signed.select("doc_id", "n_shingles", "cid"), comp.withColumnRenamed("node", "node_c"))
    least = named.filter("comp is not null").groupBy(F.col("comp").alias("in_comp")).agg(F.min("doc_id").alias("first_id"))
    return named.join(least, F.col("comp") == F.col("in_comp"), "left").select(
        "doc_id", "n_shingles", F.coalesce("first_id", "doc_id").alias("component_id"))
