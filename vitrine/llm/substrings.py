"""Removal of long repeated byte strings by threshold-bounded interval expansion.

A start is a place at which ``length`` bytes of one text begin.  It is repeated
if the same bytes start anywhere else.  To find all repeated starts of a corpus
without bringing it together:

* Each start belongs to one anchor: the place in its bytes whose ``gram``-byte
  hash is least (the first such place).  Equal strings have equal anchors at
  equal distances, so only starts of equal anchors need to be compared.  The
  starts of one anchor in a text lie side by side; with their bytes they are a
  region.
* Equal regions are folded to one with a count.  Anchors with one region are
  settled by its count, single ones drop out.
* Different regions of one anchor meet in a bounded chunk of text.  Its
  Burrows-Wheeler transform is expanded breadth-first: the boundaries between
  suffixes with a common prefix of l bytes give, by backward extension with
  every byte, those of l + 1, until l reaches ``length``.  Suffixes with no
  boundary between them then agree in ``length`` bytes.
* Before that, a region is let go if its bytes next to the anchor, which every
  string of one half of its starts contains, occur in no other region.
* An anchor with more than ``MOST`` different regions is dealt to more chunks:
  sixteen neighbouring starts share a core, and only those with equal cores can
  be equal.  Cores with more than ``MOST`` kinds are dealt by four starts, then
  by one.  Hashes only choose the chunk; the expansion judges there, too.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from vitrine.llm import common as C
from vitrine.session import cut_lineage

LENGTH, GRAM = 400, 128
#: Different regions of an anchor that go through one chunk, and bytes of a chunk.
MOST = 256
CHUNK_BYTES = 256 << 10
#: Bytes of a text that are looked at in one step.
SEGMENT = 8 << 20

U = np.uint64
PLACE_BITS = U(24)


def anchors(data: np.ndarray, prefix: np.ndarray, length: int, gram: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First start, last start and anchor of every region of one text."""
    n = len(data) - length + 1
    at = np.arange(len(data) - gram + 1)
    h = C.span_hash(prefix, at, at + gram)
    key = (h >> PLACE_BITS << PLACE_BITS) | at.astype(U)
    width = length - gram + 1
    # Least key of every window: what is least up to a block's end and from its beginning.
    blocks = -(-len(key) // width)
    square = np.full(blocks * width, U(2**64 - 1))
    square[:len(key)] = key
    square = square.reshape(blocks, width)
    ahead = np.minimum.accumulate(square, axis=1).ravel()
    back = np.minimum.accumulate(square[:, ::-1], axis=1)[:, ::-1].ravel()
    least = np.minimum(back[:n], ahead[width - 1:width - 1 + n])
    place = (least & ((U(1) << PLACE_BITS) - U(1))).astype(np.int64)
    first = np.flatnonzero(np.diff(place, prepend=-1))
    return first, np.append(first[1:], n) - 1, place[first]


REGION = "ah bigint, rh bigint, doc_id bigint, tk bigint, p int, n int, d int"


def _finder(length: int, gram: int):
    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in C.pieces(batch, "text"):
                data, offsets = C.text_bytes(part.column("text"))
                parts, rows = [], []
                for i, (a, b) in enumerate(zip(offsets[:-1].tolist(), offsets[1:].tolist())):
                    for c in range(a, b - length + 1, SEGMENT):
                        mine = data[c:min(b, c + SEGMENT + length - 1)]
                        prefix = C.prefix_hash(mine)
                        p1, p2, at = anchors(mine, prefix, length, gram)
                        ah = C.span_hash(prefix, at, at + gram)
                        # The same bytes at the same distances from the anchor.
                        rh = C.mix(C.span_hash(prefix, p1, p2 + length) + (at - p1).astype(U) * U(0x2545F4914F6CDD1D))
                        parts.append((ah, rh, p1 + (c - a), p2 - p1 + 1, at - p1))
                        rows.append((i, len(ah)))
                if not parts:
                    continue
                ah, rh, p, n, d = (np.concatenate(x) for x in zip(*parts))
                which = pa.array(np.repeat([r for r, _ in rows], [k for _, k in rows]))
                yield C.rows({"ah": pa.array(ah.view(np.int64)), "rh": pa.array(rh.view(np.int64)),
                              "doc_id": part.column("doc_id").take(which), "tk": part.column("tk").take(which),
                              "p": pa.array(p.astype(np.int32)), "n": pa.array(n.astype(np.int32)),
                              "d": pa.array(d.astype(np.int32))})
    return find


def suffix_order(text: np.ndarray, depth: int) -> np.ndarray:
    """Suffixes in the order of their first ``depth`` bytes at least, by doubling."""
    n = len(text)
    padded = np.concatenate((text, np.zeros(8, np.uint8)))
    key = np.zeros(n, U)
    for j in range(8):
        key |= padded[j:j + n].astype(U) << U(8 * (7 - j))
    span = 8
    while True:
        order = np.argsort(key)
        step = np.concatenate(([0], np.cumsum(key[order][1:] != key[order][:-1])))
        if span >= depth or step[-1] == n - 1:
            return order
        rank = np.empty(n, np.int64)
        rank[order] = step + 1
        ahead = np.zeros(n, np.int64)
        ahead[:-span] = rank[span:]
        key = (rank.astype(U) << U(32)) | ahead.astype(U)
        span *= 2


def common_classes(text: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Order of the suffixes of ``text``, and for each the class of those with ``length`` bytes in common.

    ``text`` ends with a byte that is less than all others and occurs once.
    Boundaries are found by increasing common prefix and none of ``length`` or
    more is looked for.
    """
    order = suffix_order(text, length + 1)
    n = len(text)
    before = text[order - 1]
    letters, code = np.unique(before, return_inverse=True)
    count = np.bincount(code)
    smaller = np.cumsum(count) - count
    occurs = np.zeros((len(letters), n + 1), np.int32)
    for c in range(len(letters)):
        np.cumsum(code == c, out=occurs[c, 1:])
        occurs[c] += smaller[c]
    open_ = np.ones(n + 1, bool)
    frontier = smaller.astype(np.int64)
    open_[frontier], open_[n] = False, False
    for _ in range(1, length):
        if not len(frontier):
            break
        reached = occurs[:, frontier].ravel()
        reached = reached[open_[reached]]
        open_[reached] = False
        frontier = np.unique(reached).astype(np.int64)
    return order, np.cumsum(~open_[:n])


def repeated_starts(regions: list[bytes], counts: list[int], length: int) -> list[np.ndarray]:
    """Which starts of every region are repeated; a region that occurs more than once repeats itself."""
    sizes = np.array([len(r) for r in regions])
    begin = np.cumsum(sizes + 1) - sizes - 1
    # Bytes move up by one, so that 0 ends the text and 0xFF, which UTF-8 never has, parts regions.
    text = np.frombuffer(b"\xfe".join(regions), np.uint8) + np.uint8(1)
    order, group = common_classes(np.append(text, np.uint8(0)), length)
    starts = sizes - length + 1
    at = np.concatenate([b + np.arange(s) for b, s in zip(begin, starts)])
    weight = np.repeat(np.minimum(counts, 2), starts)
    of = np.empty(len(order), np.int64)
    of[order] = group
    total = np.bincount(of[at], weight)
    hit = total[of[at]] >= 2
    return np.split(hit, np.cumsum(starts)[:-1])


def _runs(hit: np.ndarray) -> list[dict]:
    """Stretches of set places as {s, e}, e not included."""
    edge = np.flatnonzero(np.diff(np.concatenate(([0], hit.astype(np.int8), [0]))))
    return [{"s": int(a), "e": int(b)} for a, b in zip(edge[::2], edge[1::2])]


_RUNS = pa.list_(pa.struct([("s", pa.int32()), ("e", pa.int32())]))


def _expander(length: int):
    """Regions, sorted by anchor, to their repeated starts, some anchors at a time."""
    def settle(rows: list) -> pa.RecordBatch:
        hits = repeated_starts([r[3] for r in rows], [r[2] for r in rows], length)
        return C.rows({"ah": pa.array([r[0] for r in rows], pa.int64()), "rh": pa.array([r[1] for r in rows], pa.int64()),
                       "runs": pa.array([_runs(h) for h in hits], _RUNS)})

    def expand(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            for row in zip(*[batch.column(c).to_pylist() for c in ("ah", "rh", "c", "bytes")]):
                if size > CHUNK_BYTES and row[0] != held[-1][0]:
                    yield settle(held)
                    held, size = [], 0
                held.append(row)
                size += len(row[3])
        if held:
            yield settle(held)
    return expand


def _cutter(length: int, gram: int):
    """The bytes of the regions that are asked for of every text.

    With them come hashes of their cores: starts up to ``half`` before the
    anchor all contain ``length - half`` bytes from the anchor on, those
    farther away contain as many from ``half`` before it.
    """
    half = (length - gram) // 2

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in C.pieces(batch, "text"):
                out: dict = {n: [] for n in ("ah", "rh", "c", "d", "bytes", "cores")}
                for text, asked in zip(part.column("text"), part.column("asked").to_pylist()):
                    raw = text.as_buffer()
                    data = np.frombuffer(raw, np.uint8)
                    prefix = C.prefix_hash(data)
                    for a in asked:
                        p, n, at = a["p"], a["n"], a["p"] + a["d"]
                        spans = [(at, at + length - half)] if p + n - 1 >= at - half else []
                        if p < at - half:
                            spans.append((at - half, at + length - 2 * half))
                        b, e = np.array(spans).T
                        h = C.mix(C.span_hash(prefix, b, e) + (at - b).astype(U))
                        for name, x in zip(out, (a["ah"], a["rh"], a["c"], a["d"],
                                                 raw[p:p + n + length - 1].to_pybytes(), h.view(np.int64).tolist())):
                            out[name].append(x)
                if out["ah"]:
                    yield C.rows({n: pa.array(out[n], pa.int64()) for n in ("ah", "rh", "c", "d")} | {
                        "bytes": pa.array(out["bytes"], pa.binary()), "cores": pa.array(out["cores"], pa.list_(pa.int64()))})
    return cut


def _hasher(length: int, size: int):
    """Hashes for ``size`` neighbouring starts at a time of the ``pending`` ones of a region.

    ``span`` is of all bytes of these starts, ``core`` of the bytes that every
    start at these distances from the anchor contains.
    """
    def hashes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names = ("ah", "rh", "c", "lo", "n", "core", "span")
            out: dict = {n: [] for n in names}
            for ah, rh, c, d, raw, pending in zip(*[batch.column(x).to_pylist() for x in ("ah", "rh", "c", "d", "bytes", "pending")]):
                data = np.frombuffer(raw, np.uint8)
                prefix = C.prefix_hash(data)
                at = np.concatenate([np.arange(x["lo"], x["lo"] + x["n"]) for x in pending])
                block = (d - at) // size
                cut = np.flatnonzero(np.diff(block, prepend=-1) | (np.diff(at, prepend=at[0] - 2) != 1))
                first, last = at[cut], at[np.append(cut[1:], len(at)) - 1]
                right = d - block[cut] * size
                core = C.span_hash(prefix, right, right - (size - 1) + length)
                span = C.span_hash(prefix, first, last + length)
                key = np.array([ah], np.int64).view(U) * U(0x9E3779B97F4A7C15)
                for name, x in zip(names, (np.full(len(cut), ah), np.full(len(cut), rh), np.full(len(cut), c), first, last - first + 1,
                                           C.mix((core ^ key) + block[cut].astype(U)).view(np.int64),
                                           C.mix((span ^ key) + (d - first).astype(U) * U(4099) + (d - last).astype(U)).view(np.int64))):
                    out[name].append(x)
            if out["ah"]:
                yield C.rows({n: pa.array(np.concatenate(out[n]).astype(np.int32 if n in ("lo", "n") else np.int64)) for n in names})
    return hashes


def _slicer(length: int):
    """The bytes of the asked stretches of starts of a region, as regions of their own."""
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [(a["core"], a["span"], a["t"], raw[a["lo"]:a["lo"] + a["n"] + length - 1])
                    for raw, asked in zip(batch.column("bytes").to_pylist(), batch.column("asked").to_pylist()) for a in asked]
            if rows:
                yield C.rows({n: pa.array(x, pa.binary() if n == "bytes" else pa.int64())
                              for n, x in zip(("ah", "rh", "c", "bytes"), zip(*rows))})
    return cut


def _expanded(regions: DataFrame, length: int) -> DataFrame:
    """(ah, rh, runs) of regions (ah, rh, c, bytes), those of one anchor in one chunk."""
    parts = int(regions.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return (regions.select("ah", "rh", "c", "bytes").repartition(parts, "ah").sortWithinPartitions("ah", "rh")
            .mapInArrow(_expander(length), "ah bigint, rh bigint, runs array<struct<s:int,e:int>>"))


def _crowded(hot: DataFrame, length: int, most: int) -> DataFrame:
    """(ah, rh, runs) for anchors with very many regions (ah, rh, c, d, bytes).

    Sixteen starts at a time are a region of their own, whose partners have
    the same core; what has too many of them is cut finer.
    """
    found = None
    pending = hot.withColumn("pending", F.array(F.struct(
        F.lit(0).alias("lo"), (F.octet_length("bytes") - (length - 1)).cast("int").alias("n"))))
    for size in (16, 4, 1):
        hashed = C.stored(pending.mapInArrow(
            _hasher(length, size), "ah bigint, rh bigint, c bigint, lo int, n int, core bigint, span bigint"))
        kinds = hashed.groupBy("core", "span").agg(F.sum("c").alias("t"), F.min(F.struct("ah", "rh", "lo", "n")).alias("one"))
        groups = C.stored(kinds.groupBy(F.col("core").alias("k")).agg(F.sum("t").alias("u"), F.count("*").alias("kinds")).filter("u > 1"))
        asked = (kinds.join(groups.filter(F.col("kinds") <= most), F.col("core") == F.col("k"), "left_semi")
                 .groupBy(F.col("one.ah").alias("x"), F.col("one.rh").alias("y")).agg(F.collect_list(F.struct(
                     "core", "span", "t", F.col("one.lo").alias("lo"), F.col("one.n").alias("n"))).alias("asked")))
        cut = hot.join(asked, (F.col("ah") == F.col("x")) & (F.col("rh") == F.col("y"))).select("bytes", "asked").mapInArrow(
            _slicer(length), "ah bigint, rh bigint, c bigint, bytes binary")
        verdicts = _expanded(cut, length).filter(F.size("runs") > 0).select(F.col("ah").alias("v"), F.col("rh").alias("w"), "runs")
        hits = hashed.join(verdicts, (F.col("core") == F.col("v")) & (F.col("span") == F.col("w"))).select(
            "ah", "rh", "lo", F.explode("runs").alias("run")).select(
            "ah", "rh", F.struct((F.col("lo") + F.col("run.s")).alias("s"), (F.col("lo") + F.col("run.e")).alias("e")).alias("run"))
        found = hits if found is None else found.unionByName(hits)
        left = (hashed.join(groups.filter(F.col("kinds") > most), F.col("core") == F.col("k"), "left_semi")
                .groupBy(F.col("ah").alias("x"), F.col("rh").alias("y")).agg(
                    F.array_sort(F.collect_list(F.struct("lo", "n"))).alias("pending")))
        pending = hot.join(left, (F.col("ah") == F.col("x")) & (F.col("rh") == F.col("y"))).drop("x", "y")
    return found.groupBy("ah", "rh").agg(F.collect_set("run").alias("runs"))


def _remove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids, sizes, removed, counts, sums = batch.column("doc_id"), [], [], [], []
        for text, spans in zip(batch.column("text"), batch.column("spans").to_pylist()):
            raw = text.as_py().encode() if text.is_valid else b""
            merged: list = []
            for s in sorted((s["s"], s["e"]) for s in spans or ()):
                if merged and s[0] <= merged[-1][1]:
                    merged[-1][1] = max(merged[-1][1], s[1])
                else:
                    merged.append(list(s))
            digest, at = hashlib.sha256(), 0
            for a, b in merged:
                digest.update(raw[at:a])
                at = b
            digest.update(raw[at:])
            sizes.append(len(raw))
            removed.append(sum(b - a for a, b in merged))
            counts.append(len(merged))
            sums.append(digest.hexdigest())
        yield C.rows({"doc_id": ids, "n_bytes": pa.array(sizes, pa.int64()), "n_removed": pa.array(removed, pa.int64()),
                      "n_spans": pa.array(counts, pa.int64()), "kept_sha256": pa.array(sums, pa.string()),
                      "n_kept": pa.array([a - b for a, b in zip(sizes, removed)], pa.int64()),
                      "changed": pa.array([b > 0 for b in removed], pa.bool_())})


def repeated_spans(docs: DataFrame, length: int = LENGTH, gram: int = GRAM, most: int = MOST) -> DataFrame:
    """(doc_id, tk, spans): the covered stretches of every text that has any, unmerged.

    ``tk`` is xxhash64 of the text; with doc_id it names a row, and equal rows
    share their spans.
    """
    keyed = _keyed(docs)
    regions = C.stored(keyed.filter(F.octet_length("text") >= length).mapInArrow(_finder(length, gram), REGION))
    # Stored, so that the join reads two plain shuffles and a hot anchor's rows can be split.
    by_anchor = C.stored(regions.groupBy("ah").agg(F.count("*").alias("total"), F.min("rh").alias("low"), F.max("rh").alias("high"))
                         .filter("total > 1").select(F.col("ah").alias("a"), (F.col("low") != F.col("high")).alias("mixed")))
    met = C.stored(regions.join(by_anchor, F.col("ah") == F.col("a")).drop("a"))
    whole = F.array(F.struct(F.lit(0).alias("s"), F.col("n").alias("e")))
    settled = met.filter(~F.col("mixed")).select("doc_id", "tk", "p", whole.alias("runs"))

    mixed = met.filter("mixed").drop("mixed")
    kinds = cut_lineage(mixed.groupBy("ah", "rh").agg(
        F.count("*").alias("c"), F.min(F.struct("doc_id", "tk", "p", "n", "d")).alias("one")))
    asked = (kinds.groupBy(F.col("one.doc_id").alias("d"), F.col("one.tk").alias("t"))
             .agg(F.collect_list(F.struct("ah", "rh", "c", F.col("one.p").alias("p"), F.col("one.n").alias("n"),
                                         F.col("one.d").alias("d"))).alias("asked")))
    texts = keyed.join(asked, F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("tk") == F.col("t")))
    # Equal rows give the same bytes; one of them is enough.
    cut = C.stored(texts.select("text", "asked").mapInArrow(
        _cutter(length, gram), "ah bigint, rh bigint, c bigint, d bigint, bytes binary, cores array<bigint>"))
    cores = cut.select("ah", "rh", "c", F.explode("cores").alias("core"))
    shared = (cores.groupBy("core").agg(F.count("*").alias("n")).filter("n > 1").select(F.col("core").alias("k")))
    # A region that occurs more than once is settled by itself but meets the others.
    alive = (cores.join(shared, F.col("core") == F.col("k")).select(F.col("ah").alias("a"), F.col("rh").alias("r")).distinct())
    crowd = alive.groupBy(F.col("a").alias("b")).agg(F.count("*").alias("m"))
    alive = alive.join(crowd, F.col("a") == F.col("b")).drop("b")
    cut = C.stored(cut.drop("cores").join(alive, (F.col("ah") == F.col("a")) & (F.col("rh") == F.col("r"))).drop("a", "r"))
    many = mixed.join(kinds.filter("c > 1").select(F.col("ah").alias("a"), F.col("rh").alias("r")),
                      (F.col("ah") == F.col("a")) & (F.col("rh") == F.col("r")), "left_semi")
    settled = settled.unionByName(many.select("doc_id", "tk", "p", whole.alias("runs")))
    expanded = _expanded(cut.filter(F.col("m") <= most), length)
    alone = _crowded(cut.filter(F.col("m") > most), length, most)
    verdicts = expanded.unionByName(alone).select(F.col("ah").alias("a"), F.col("rh").alias("r"), "runs")
    judged = (mixed.join(verdicts, (F.col("ah") == F.col("a")) & (F.col("rh") == F.col("r")))
              .filter(F.size("runs") > 0).select("doc_id", "tk", "p", "runs"))
    # Equal rows have equal spans; each is gathered once.
    found = settled.unionByName(judged).distinct()
    spans = F.flatten(F.collect_list(F.transform("runs", lambda r: F.struct(
        (F.col("p") + r["s"]).alias("s"), (F.col("p") + r["e"] + (length - 1)).alias("e")))))
    return found.groupBy("doc_id", "tk").agg(spans.alias("spans"))


def _keyed(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"),
                       F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")).withColumn("tk", F.xxhash64("text"))


REMOVED = "doc_id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string, n_kept bigint, changed boolean"


def without_repeats(docs: DataFrame, length: int = LENGTH, gram: int = GRAM, most: int = MOST) -> DataFrame:
    """Per row of ``docs`` (doc_id, text): doc_id, n_bytes, n_removed, n_spans, kept_sha256, n_kept, changed.

    Every byte in a string of ``length`` bytes that also starts elsewhere is
    removed, in both places; texts are judged as they come, matches never run
    from one text into the next.  Null and empty texts have no bytes; shorter
    texts lose none; equal rows lose all if long enough.  Null ids are rows
    like others, other columns are ignored, an empty table gives an empty one.
    """
    spans = repeated_spans(docs, length, gram, most).select(F.col("doc_id").alias("d"), F.col("tk").alias("t"), "spans")
    joined = _keyed(docs).join(spans, F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("tk") == F.col("t")), "left")
    return joined.select("doc_id", "text", "spans").mapInArrow(_remove, REMOVED)
