"""Near-duplicate groups by a chosen-path similarity join on word shingles.

Documents with equal shingle sets are one class.  A class has minwise values of
its set; a tree branches classes by values at coordinates that the node itself
chooses (a hash of its path), so similar sets tend to go the same way and
unlike ones part.  Independent trees are repeated so that every similar pair
meets in some node.

* In every node that holds several classes each is compared with the node's
  least one, and confirmed pairs are joined to components.
* Nodes left with more than one component are compared exhaustively if small:
  the classes outside the least component with the others, inside tiles of
  bounded size, and only what is similar leaves the task.  Larger nodes branch
  on to the last depth along ``SPLITS`` paths each, so that a pair in a crowd
  is hardly likelier to be parted than one elsewhere; there the star step is
  done once more, and what is left is cut into tiles whatever its size.

Pairs pass a 64-bit sketch (one bit of each of the first 64 coordinates) before their full sets are
compared; the sketch's limit lies 6.5 standard deviations beyond the
threshold.  A class is known by a 64-bit hash of its whole set.

All paths draw from the same ``COORDINATES`` minwise values.  Counted with
that, a pair that shares 85 in 100 is apart on all ``TREES`` * ``BRANCHES``
paths at the depth looked at 1.2 times in a million (1.3 in crowds), one that
shares 80 seven times (eight) in 100,000; see ``miss_rate``.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from vitrine.llm import common as C
from vitrine.llm.components import components
from vitrine.session import cut_lineage

COORDINATES, SKETCH_BITS = 256, 64
TREES = 14
#: Children of a root; every other node passes a class on to one child.
BRANCHES = 2
#: Depth at which nodes are looked at, the one crowds branch on to, and the paths of a crowd to there.
FIRST_DEPTH, MAX_DEPTH, SPLITS = 5, 8, 8
#: Classes of a node whose pairs are written out, of one that goes to tiles, and of one block of a tile.
SMALL_NODE, CROWD, BLOCK = 12, 2048, 512

U = np.uint64
_rng = np.random.default_rng(8_675)
_MUL = _rng.integers(1, 2**63, COORDINATES, dtype=np.uint64) * U(2) + U(1)
_ADD = _rng.integers(1, 2**63, COORDINATES, dtype=np.uint64)

SIGNED = "doc_id bigint, tk bigint, n_shingles bigint, cid bigint, sketch bigint, nodes binary"


def sets_of(text: pa.Array, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingle hashes of every row, end to end, and where each row's begin."""
    data, offsets = C.text_bytes(text)
    h, begin = C.shingles(data, offsets, width)
    parts = [np.unique(h[a:b]) for a, b in zip(begin[:-1], begin[1:])]
    sizes = np.array([len(p) for p in parts], np.int64)
    return (np.concatenate(parts) if parts else np.zeros(0, U)), np.concatenate(([0], np.cumsum(sizes)))


def class_ids(flat: np.ndarray, begin: np.ndarray) -> np.ndarray:
    total = np.concatenate((np.zeros(1, U), np.cumsum(C.mix(flat * _MUL[0] + _ADD[1]), dtype=U)))
    size = np.diff(begin).astype(U)
    return C.mix((total[begin[1:]] - total[begin[:-1]]) ^ (size * U(0x9E3779B97F4A7C15)))


def _minwise(flat: np.ndarray, begin: np.ndarray) -> np.ndarray:
    """The minwise values of every row's set; zeros for an empty one."""
    coords = np.zeros((len(begin) - 1, COORDINATES), np.uint32)
    some = np.flatnonzero(np.diff(begin))
    for i in range(COORDINATES if len(some) else 0):
        least = np.minimum.reduceat((flat ^ _ADD[i]) * _MUL[i], begin[:-1][some])
        coords[some, i] = C.mix(least).astype(np.uint32)
    return coords


def _signer(width: int):
    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in C.pieces(batch, "text"):
                flat, begin = sets_of(part.column("text"), width)
                size = np.diff(begin)
                coords = _minwise(flat, begin)
                nodes = np.stack(planted(coords), 1)
                bits = np.packbits((coords[:, :SKETCH_BITS] & 1).astype(np.uint8), axis=1).view(">i8")[:, 0].astype(np.int64)
                empty = size == 0
                yield C.rows({
                    "doc_id": part.column("doc_id"), "tk": part.column("tk"), "n_shingles": pa.array(size),
                    "cid": pa.array(class_ids(flat, begin).view(np.int64), mask=empty),
                    "sketch": pa.array(bits), "nodes": C.binary_rows(
                        nodes.ravel(), np.arange(part.num_rows + 1) * nodes.shape[1])})
    return sign


def signatures(docs: DataFrame, width: int) -> DataFrame:
    """Per document: doc_id, a hash of its text, its set's size, class, sketch and nodes in all trees."""
    return keyed(docs).mapInArrow(_signer(width), SIGNED)


def keyed(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.xxhash64("text").alias("tk"),
                       F.col("text").cast("string").alias("text"))


def _child(node: np.ndarray, branch: int, coords: np.ndarray, row: np.ndarray) -> np.ndarray:
    """The branch-th child of every node: a coordinate chosen by the node, and its value there in a row of ``coords``."""
    # Branches of one node read different coordinates.
    at = ((C.mix(node + U(0x2545F4914F6CDD1D)) + U(branch * 29)) % U(COORDINATES)).astype(np.int64)
    value = coords[row, at].astype(U)
    return C.mix((node ^ (at.astype(U) << U(40))) * U(0xD6E8FEB86659FD93) + value)


def _paths(root: np.ndarray, branches: int, depth: int, coords: np.ndarray, row: np.ndarray) -> list[np.ndarray]:
    """The nodes ``depth`` below each root, one per branch."""
    found = []
    for branch in range(branches):
        node = _child(root, branch, coords, row)
        for _ in range(depth - 1):
            node = _child(node, 0, coords, row)
        found.append(node)
    return found


def planted(coords: np.ndarray) -> list[np.ndarray]:
    """The nodes of the first depth looked at that every row belongs to, over all trees."""
    found, row = [], np.arange(len(coords))
    for tree in range(TREES):
        root = np.full(len(coords), C.mix(np.array([tree + 1], U))[0])
        found += _paths(root, BRANCHES, FIRST_DEPTH, coords, row)
    return found


def miss_rate(likeness: float, crowds: bool = False) -> float:
    """Probability that a pair of sets has no common node, with or without all its nodes being crowds.

    The number of coordinates that agree is binomial; given it, paths are independent.
    """
    total = 0.0
    for k in range(COORDINATES + 1):
        f = k / COORDINATES
        log = (math.lgamma(COORDINATES + 1) - math.lgamma(k + 1) - math.lgamma(COORDINATES - k + 1)
               + k * math.log(likeness) + (COORDINATES - k) * math.log(1 - likeness))
        meet = f ** FIRST_DEPTH * (1 - (1 - f ** (MAX_DEPTH - FIRST_DEPTH)) ** SPLITS if crowds else 1)
        total += math.exp(log) * (1 - meet) ** (TREES * BRANCHES)
    return total


def _plant(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per class and node it belongs to."""
    for batch in batches:
        if batch.num_rows:
            node = np.frombuffer(b"".join(batch.column("nodes").to_pylist()), np.int64)
            cid = np.asarray(batch.column("cid"))
            yield C.rows({"node": pa.array(node), "cid": pa.array(np.repeat(cid, len(node) // len(cid)))})


def _branch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The nodes of the last depth that members of crowded nodes go on to, from their sets."""
    for batch in batches:
        for part in C.pieces(batch, "shingles"):
            sets = part.column("shingles").to_pylist()
            begin = np.concatenate(([0], np.cumsum([len(x) // 8 for x in sets])))
            coords = _minwise(np.frombuffer(b"".join(sets), U), begin)
            crowds = part.column("crowds").to_pylist()
            row = np.repeat(np.arange(len(crowds)), [len(x) for x in crowds])
            node = np.concatenate([np.array(x, np.int64) for x in crowds]).view(U)
            found = _paths(node, SPLITS, MAX_DEPTH - FIRST_DEPTH, coords, row)
            cid = np.asarray(part.column("cid"))[row]
            yield C.rows({"node": pa.array(np.concatenate(found).view(np.int64)),
                          "cid": pa.array(np.tile(cid, SPLITS))})


def sketch_limit(threshold: float) -> int:
    """Bits of a sketch in which a pair at the threshold differs at most."""
    p = (1 - threshold) / 2
    return int(SKETCH_BITS * p + 6.5 * math.sqrt(SKETCH_BITS * p * (1 - p)))


def _sieve(pairs: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """Distinct pairs (a, b) whose sizes and sketches allow the similarity."""
    for side in ("a", "b"):
        pairs = pairs.join(classes.select(F.col("cid").alias(side), F.col("sketch").alias("k" + side),
                                          F.col("n_shingles").alias("n" + side)), side)
    differ = F.bit_count(F.col("ka").bitwiseXOR(F.col("kb")))
    return pairs.filter((differ <= sketch_limit(percent / 100))
                        & (F.least("na", "nb") * 100 >= F.greatest("na", "nb") * percent)).select("a", "b")


def _setter(width: int):
    def to_sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set = set()
        for batch in batches:
            for part in C.pieces(batch, "text"):
                flat, begin = sets_of(part.column("text"), width)
                cids = part.column("cid").to_pylist()
                new = [i for i, c in enumerate(cids) if not (c in seen or seen.add(c))]
                mask = np.zeros(part.num_rows, bool)
                mask[new] = True
                low = [np.unique(flat[a:b].astype(np.uint32)) for a, b in zip(begin[:-1], begin[1:])]
                short = C.binary_rows(np.concatenate(low) if low else np.zeros(0, np.uint32),
                                      np.cumsum([0, *map(len, low)]))
                yield C.rows({"cid": part.column("cid"), "shingles": C.binary_rows(flat, begin),
                              "short": short}).filter(pa.array(mask))
    return to_sets


def _confirmer(percent: int):
    def confirm(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = np.zeros(batch.num_rows, bool)
            for i, (x, y) in enumerate(zip(batch.column("x"), batch.column("y"))):
                x, y = np.frombuffer(x.as_buffer(), U), np.frombuffer(y.as_buffer(), U)
                both = np.concatenate((x, y))
                both.sort(kind="stable")
                shared = int((both[1:] == both[:-1]).sum())
                keep[i] = 100 * shared >= percent * (len(x) + len(y) - shared)
            yield batch.select(["a", "b"]).filter(pa.array(keep))
    return confirm


def full_sets(classes: DataFrame, docs: DataFrame, width: int) -> DataFrame:
    """(cid, shingles, short) of the given classes, from one text of each; short has 32 bits a shingle."""
    chosen = classes.select("cid", F.col("rep.doc_id").alias("r"), F.col("rep.tk").alias("rt"))
    texts = keyed(docs).join(chosen, F.col("doc_id").eqNullSafe(F.col("r")) & (F.col("tk") == F.col("rt")))
    return texts.select("cid", "text").mapInArrow(_setter(width), "cid bigint, shingles binary, short binary")


def confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs whose full sets have the similarity."""
    both = (pairs.join(sets.select(F.col("cid").alias("a"), F.col("shingles").alias("x")), "a")
            .join(sets.select(F.col("cid").alias("b"), F.col("shingles").alias("y")), "b"))
    return both.mapInArrow(_confirmer(percent), "a bigint, b bigint")


def with_components(nodes: DataFrame, comp: DataFrame) -> DataFrame:
    """Adds each class's component; a class without links is its own."""
    return (nodes.join(comp, F.col("cid") == F.col("node_c"), "left")
            .withColumn("comp", F.coalesce("component", "cid")).drop("node_c", "component"))


def mixed_nodes(nodes: DataFrame, comp: DataFrame) -> DataFrame:
    """The rows of nodes that still hold several components, with size and least component."""
    named = with_components(nodes, comp)
    stat = (named.groupBy("node").agg(F.count("*").alias("n"), F.min("comp").alias("least"), F.max("comp").alias("most"))
            .filter(F.col("least") != F.col("most")).drop("most"))
    return named.join(stat, "node")


def _stars(nodes: DataFrame) -> DataFrame:
    """Distinct pairs of every class and the least one of a node it is in; nodes have their hubs."""
    return nodes.filter("hub <> cid").select(F.col("hub").alias("a"), F.col("cid").alias("b")).distinct()


def _with_hubs(nodes: DataFrame) -> DataFrame:
    """The nodes that hold several classes, with the least of them."""
    heads = nodes.groupBy("node").agg(F.count("*").alias("n"), F.min("cid").alias("hub")).filter("n > 1").drop("n")
    return cut_lineage(nodes.join(heads, "node"))


def within_small(mixed: DataFrame) -> DataFrame:
    """All pairs of different components within nodes of at most ``SMALL_NODE`` classes."""
    held = (mixed.filter(F.col("n") <= SMALL_NODE).groupBy("node")
            .agg(F.array_sort(F.collect_set(F.struct("cid", "comp"))).alias("in_node")))
    pair = held.select("in_node", F.explode("in_node").alias("one")).select(
        F.col("one"), F.explode(F.filter("in_node", lambda o: (o["cid"] > F.col("one.cid"))
                                         & (o["comp"] != F.col("one.comp")))).alias("other"))
    return pair.select(F.col("one.cid").alias("a"), F.col("other.cid").alias("b"))


def tiles_of(large: DataFrame, facts: DataFrame) -> DataFrame:
    """Members of crowded nodes with what is known of each class, dealt to tiles of two blocks at most.

    A node of up to ``BLOCK`` classes is one tile.  Of a larger one every two
    blocks meet in one tile.
    """
    blocks = F.ceil(F.col("n") / BLOCK).cast("int")
    mine = F.pmod(F.xxhash64("cid"), blocks).cast("int")
    dealt = large.select("node", "cid", "comp", "least", mine.alias("mine"),
                         F.explode(F.sequence(F.lit(0), blocks - 1)).alias("other"))
    tile = F.xxhash64("node", F.least("mine", "other"), F.greatest("mine", "other"))
    return dealt.select("cid", "comp", "least", tile.alias("tile")).join(facts, "cid")


def tiler(percent: int):
    """Similar pairs of different components within each tile; rows come sorted by tile.

    Shingles are told apart by 32 bits here.  A set's shingles that are alike
    in those count once, so a pair can share more than is seen, by no more
    than what either set has lost; what is found is confirmed on full sets.
    """

    def compare(rows: list) -> pa.RecordBatch:
        cids = np.array([r[1] for r in rows])
        comps = np.array([r[2] for r in rows])
        rest = np.flatnonzero(comps != np.array([r[3] for r in rows]))
        sets = [np.frombuffer(r[4], np.uint32) for r in rows]
        held = np.array([len(x) for x in sets])
        begin = np.cumsum(held) - held
        size = np.array([r[5] for r in rows])
        lost = size - held
        _, flat = np.unique(np.concatenate(sets), return_inverse=True)
        mark = np.zeros(int(flat.max()) + 1, np.int32)
        a, b = [], []
        for i in rest.tolist():
            own = flat[begin[i]:begin[i] + held[i]]
            mark[own] = 1
            shared = np.add.reduceat(mark[flat], begin)
            mark[own] = 0
            shared = shared + np.minimum(lost, lost[i])
            hit = np.flatnonzero((100 * shared >= percent * (size + size[i] - shared)) & (comps != comps[i]))
            a.append(np.minimum(cids[i], cids[hit]))
            b.append(np.maximum(cids[i], cids[hit]))
        none = np.zeros(0, np.int64)
        return C.rows({"a": pa.array(np.concatenate(a) if a else none), "b": pa.array(np.concatenate(b) if b else none)})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list = []
        for batch in batches:
            for row in zip(*[batch.column(c).to_pylist() for c in ("tile", "cid", "comp", "least", "short", "full")]):
                if held and row[0] != held[0][0]:
                    yield compare(held)
                    held = []
                held.append(row)
        if held:
            yield compare(held)
    return run


def _grouped(docs: DataFrame, width: int, percent: int) -> DataFrame:
    """(doc_id, tk, n_shingles, cid, comp) of every row; cid and comp are null for texts without words."""
    signed = cut_lineage(signatures(docs, width))
    rep = F.struct("doc_id", "tk")
    classes = cut_lineage(
        signed.filter("cid is not null").groupBy("cid").agg(
            F.min(rep).alias("rep"), F.first("n_shingles").alias("n_shingles"), F.first("sketch").alias("sketch"),
            F.first("nodes").alias("nodes")))
    nodes = _with_hubs(classes.select("cid", "nodes").mapInArrow(_plant, "node bigint, cid bigint"))
    met = nodes.select("cid").distinct()
    sets = cut_lineage(full_sets(classes.join(met, "cid", "left_semi"), docs, width))
    links = cut_lineage(confirmed(_sieve(_stars(nodes), classes, percent), sets, percent))
    comp = cut_lineage(components(links)).withColumnRenamed("node", "node_c")

    mixed = cut_lineage(mixed_nodes(nodes.select("node", "cid"), comp))
    large = mixed.filter(F.col("n") > CROWD)
    if not large.isEmpty():
        crowds = large.groupBy("cid").agg(F.collect_set("node").alias("crowds"))
        split = _with_hubs(crowds.join(sets.select("cid", "shingles"), "cid")
                           .mapInArrow(_branch, "node bigint, cid bigint"))
        links = cut_lineage(links.union(confirmed(_sieve(_stars(split), classes, percent), sets, percent)))
        comp = cut_lineage(components(links)).withColumnRenamed("node", "node_c")
        kept = mixed.filter(F.col("n") <= CROWD).select("node", "cid").union(split.select("node", "cid"))
        mixed = cut_lineage(mixed_nodes(kept, comp))
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    tiles = tiles_of(mixed.filter(F.col("n") > SMALL_NODE), sets.select("cid", "short", (F.octet_length("shingles") / 8).cast("int").alias("full")))
    pairs = within_small(mixed).union(tiles.repartition(parts, "tile").sortWithinPartitions("tile")
                                       .mapInArrow(tiler(percent), "a bigint, b bigint"))
    more = cut_lineage(confirmed(_sieve(pairs.distinct(), classes, percent), sets, percent))
    comp = cut_lineage(components(links.union(more))).withColumnRenamed("node", "node_c")

    return with_components(signed.select("doc_id", "tk", "n_shingles", "cid"), comp)


def near_components(docs: DataFrame, width: int = 5, percent: int = 80) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept), one row per row of ``docs`` (doc_id, text).

    Two documents are linked if ``percent`` of the union of their shingle sets
    is shared; ``component_id`` is the least doc_id that links reach, ``kept``
    marks the rows that bear it.  Texts without words (null, empty, blank) have
    an empty set and stand alone.  Rows with one doc_id are rows like others; a
    null doc_id is never a component's name unless there is no other, and such
    a row is kept only then.  Other columns are ignored; an empty table gives
    an empty table.
    """
    named = _grouped(docs, width, percent)
    least = named.filter("comp is not null").groupBy(F.col("comp").alias("in_comp")).agg(F.min("doc_id").alias("first_id"))
    out = named.join(least, F.col("comp") == F.col("in_comp"), "left")
    out = out.withColumn("component_id", F.coalesce("first_id", "doc_id"))
    return out.select("doc_id", "n_shingles", "component_id",
                      F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"))


def keep_one(docs: DataFrame, width: int = 5, percent: int = 80) -> DataFrame:
    """``docs`` with one row per near-duplicate group: the one with the least doc_id.

    Groups are of rows, not of ids: rows with one doc_id, or none, stay apart
    unless their texts are near copies.  A null id comes last; among equal ids
    the least hash of the text is taken.  Texts without words all stay.  All
    columns are kept.
    """
    rank = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "tk")
    chosen = (_grouped(docs, width, percent).filter("comp is not null").groupBy("comp").agg(F.min(rank).alias("rank"))
              .select(F.col("rank.doc_id").alias("__id"), F.col("rank.tk").alias("__tk")))
    worded = F.coalesce(F.col("text").cast("string").rlike(r"[^\x20\x09-\x0D]"), F.lit(False))
    keyed = docs.filter(worded).withColumns({"__row_id": F.col("doc_id").cast("bigint"), "__row_tk": F.xxhash64("text")})
    kept = keyed.join(chosen, F.col("__row_id").eqNullSafe(F.col("__id")) & (F.col("__row_tk") == F.col("__tk")), "left_semi")
    # Rows equal in id and text are told apart by their other columns.
    others = [c for c, kind in docs.dtypes if "map<" not in kind]
    one = F.row_number().over(Window.partitionBy("__row_id", "__row_tk").orderBy(F.xxhash64(*others)))
    return (kept.withColumn("__row", one).filter("__row = 1").select(*docs.columns)
            .union(docs.filter(~worded)))
