"""Language identification by interpolated Kneser-Ney character models.

One model of ``ORDER`` characters per language, from counts over every learning
row.  Texts are lower-cased, everything but letters and marks becomes one
space, and a gram is its characters packed 16 bits each.  Distinct grams are
counted where the text lies and summed by Spark, every gram by itself: nothing
is pooled or pruned, so the tables sent to the tasks grow with the distinct
grams of the languages (not with the rows).

A table is a sorted array of packed grams with one row of log probabilities,
all languages side by side.  The language with the least cross-entropy per
character wins; its score is the softmax of the cross-entropies at a
temperature fitted on learning rows.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from vitrine.llm import common as C

ORDER = 4
BITS = 16
START = 1
UNKNOWN = "und"
#: Learning rows whose cross-entropies set the temperature and the rejection limit.
CALIBRATION_ROWS = 2000
#: Grams kept apart in a task before they are given to the shuffle.
FLUSH = 2_000_000

U = np.uint64
_kinds: list[np.ndarray] = []


def _kind() -> np.ndarray:
    """By code point: 2 for letters, 1 for marks, 0 for the rest."""
    if not _kinds:
        table = np.zeros(0x110000, np.uint8)
        for i in range(0x110000):
            c = unicodedata.category(chr(i))[0]
            if c in "LM":
                table[i] = 2 if c == "L" else 1
        _kinds.append(table)
    return _kinds[0]


def grams(texts: list) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Packed grams of all texts, where each text's begin, and which texts have a letter.

    One gram ends at every kept character.  Characters beyond 16 bits are
    folded into the private area by a hash.
    """
    kind = _kind()
    lower = [(t or "").lower() for t in texts]
    size = np.array([len(t) for t in lower], np.int64)
    code = np.frombuffer("".join(lower).encode("utf-32-le", "surrogatepass"), np.uint32)
    k = kind[code]
    begin = np.concatenate(([0], np.cumsum(size)))
    letters = np.concatenate(([0], np.cumsum(k == 2)))
    has = letters[begin[1:]] > letters[begin[:-1]]
    symbol = np.where(k > 0, code, 32)
    high = symbol > 0xFFFF
    symbol[high] = 0xE000 + ((symbol[high].astype(U) * U(0x9E3779B1)) >> U(16)).astype(np.uint32) % 0x1900
    blank = symbol == 32
    opening = np.zeros(len(symbol), bool)
    opening[begin[:-1][size > 0]] = True
    keep = ~blank | opening
    keep[1:] |= blank[1:] & ~blank[:-1]
    kept_before = np.concatenate(([0], np.cumsum(keep)))
    n = np.diff(kept_before[begin])
    pad = ORDER - 1
    start = np.cumsum(n + pad) - n  # each text's first symbol, behind its padding
    row = np.repeat(np.arange(len(n)), n)
    flat = np.full(int((n + pad).sum()), START, U)
    at = np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n) + start[row]
    flat[at] = symbol[keep]
    key = np.zeros(len(at), U)
    for i in range(ORDER):
        key |= flat[at - i] << U(BITS * i)
    return key, np.concatenate(([0], np.cumsum(n))), has


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: dict[str, list] = {}
    size = 0

    def out():
        for lang, parts in held.items():
            key, count = _summed(parts)
            yield C.rows({"lang": pa.array([lang] * len(key)), "gram": pa.array(key.view(np.int64)),
                          "n": pa.array(count)})
        held.clear()

    for batch in batches:
        for part in C.pieces(batch, "text"):
            langs = np.array(part.column("lang").to_pylist(), object)
            texts = part.column("text").to_pylist()
            for lang in set(langs.tolist()):
                key, _, _ = grams([t for t, l in zip(texts, langs) if l == lang])
                found, count = np.unique(key, return_counts=True)
                held.setdefault(lang, []).append((found, count))
                if len(held[lang]) > 8:
                    held[lang] = [_summed(held[lang])]
        size = sum(len(k) for parts in held.values() for k, _ in parts)
        if size > FLUSH:
            yield from out()
    yield from out()


def _summed(parts: list) -> tuple[np.ndarray, np.ndarray]:
    key = np.concatenate([k for k, _ in parts])
    found, back = np.unique(key, return_inverse=True)
    return found, np.bincount(back, np.concatenate([c for _, c in parts]), len(found)).astype(np.int64)


def _lookup(table: np.ndarray, key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    if len(table) == 0:
        return np.zeros(len(key), np.int64), np.zeros(len(key), bool)
    at = np.minimum(np.searchsorted(table, key), len(table) - 1)
    return at, table[at] == key


class Models:
    """Sorted gram tables of all languages, order by order."""

    def __init__(self, counts: dict[str, tuple[np.ndarray, np.ndarray]]):
        self.langs = sorted(counts)
        self.temperature, self.limit = 1.0, float("inf")
        self.key = [np.zeros(0, U)] * (ORDER + 1)
        self.log = [np.zeros((0, len(self.langs)), np.float32)] * (ORDER + 1)
        self.context = [np.zeros(0, U)] * (ORDER + 1)
        self.back = [np.zeros((0, len(self.langs)), np.float32)] * (ORDER + 1)
        levels = {l: self._levels(*counts[l]) for l in self.langs}
        symbols = len(np.unique(np.concatenate([levels[l][1][0] for l in self.langs]))) if self.langs else 1
        self.floor = np.float32(-np.log(symbols + 1))
        for order in range(1, ORDER + 1):
            self._add(order, {l: levels[l][order] for l in self.langs})

    @staticmethod
    def _levels(key: np.ndarray, count: np.ndarray) -> dict:
        """Counts of the highest order; below it, in how many grams a suffix ends."""
        levels = {ORDER: (key, count)}
        for order in range(ORDER - 1, 0, -1):
            suffix = levels[order + 1][0] & U((1 << (BITS * order)) - 1)
            levels[order] = np.unique(suffix, return_counts=True)
        return levels

    def _add(self, order: int, tables: dict) -> None:
        keys = np.unique(np.concatenate([t[0] for t in tables.values()])) if tables else np.zeros(0, U)
        contexts = np.unique(keys >> U(BITS))
        seen = np.zeros((len(keys), len(self.langs)), np.float64)
        back = np.zeros((len(contexts), len(self.langs)), np.float64)
        for j, lang in enumerate(self.langs):
            key, count = tables[lang]
            ones, twos = (count == 1).sum(), (count == 2).sum()
            discount = ones / (ones + 2 * twos) if ones and twos else 0.5
            context, which = np.unique(key >> U(BITS), return_inverse=True)
            total = np.bincount(which, count, len(context))
            kinds = np.bincount(which, minlength=len(context))
            seen[np.searchsorted(keys, key), j] = (count - discount) / total[which]
            back[np.searchsorted(contexts, context), j] = np.log(discount * kinds / total)
        # A context that a language has not seen leaves all to the lower order.
        lower = self._lower(order, keys)
        at, _ = _lookup(contexts, keys >> U(BITS))
        self.context[order], self.back[order] = contexts, back.astype(np.float32)
        self.key[order] = keys
        self.log[order] = np.log(seen + np.exp(back[at] + lower)).astype(np.float32)

    def _lower(self, order: int, key: np.ndarray) -> np.ndarray:
        if order == 1:
            return np.full((len(key), len(self.langs)), self.floor, np.float32)
        return self.log_probability(key & U((1 << (BITS * (order - 1))) - 1), order - 1)

    def log_probability(self, key: np.ndarray, order: int = ORDER) -> np.ndarray:
        """Of every gram in every language, backing off where no language has it."""
        at, hit = _lookup(self.key[order], key)
        if hit.all() and len(key):
            return self.log[order][at]
        out = np.empty((len(key), len(self.langs)), np.float32)
        out[hit] = self.log[order][at[hit]]
        miss = key[~hit]
        again, back = np.unique(miss, return_inverse=True)
        got = self._lower(order, again)
        place, known = _lookup(self.context[order], again >> U(BITS))
        got = got + np.where(known[:, None], self.back[order][place] if len(self.context[order]) else 0, 0)
        out[~hit] = got[back]
        return out

    def cross_entropies(self, texts: list) -> tuple[np.ndarray, np.ndarray]:
        """Per text and language, by characters; and whether the text has a letter."""
        key, begin, has = grams(texts)
        logs = self.log_probability(key)
        total = np.zeros((len(key) + 1, len(self.langs)), np.float64)
        np.cumsum(logs, axis=0, out=total[1:])
        return -(total[begin[1:]] - total[begin[:-1]]) / np.maximum(np.diff(begin), 1)[:, None], has

    def calibrate(self, entropies: np.ndarray, langs: list) -> None:
        """Temperature of least loss, and the entropy that one learning row in a thousand exceeds."""
        if not len(entropies):
            return
        mine = np.array([self.langs.index(l) for l in langs])
        losses = []
        for t in 2.0 ** np.arange(-2, 8):
            z = -(entropies - entropies.min(1, keepdims=True)) * t
            losses.append((np.log(np.exp(z).sum(1)) - z[np.arange(len(z)), mine]).mean())
        self.temperature = float(2.0 ** np.arange(-2, 8)[int(np.argmin(losses))])
        self.limit = float(np.quantile(entropies.min(1), 0.999))

    def predict(self, texts: list, reject: bool = False) -> tuple[list, np.ndarray]:
        """Language and score of every text.

        A text without a letter is ``und`` with score 0; with ``reject``, so is
        one whose least cross-entropy lies beyond the limit.
        """
        if not self.langs:
            return [UNKNOWN] * len(texts), np.zeros(len(texts))
        entropies, has = self.cross_entropies(texts)
        best = entropies.argmin(1)
        low = entropies.min(1, keepdims=True)
        score = 1 / np.exp(-(entropies - low) * self.temperature).sum(1)
        if reject:
            has = has & (low[:, 0] <= self.limit)
        return [self.langs[b] if h else UNKNOWN for b, h in zip(best, has)], np.where(has, score, 0.0)


def learn(docs: DataFrame) -> Models:
    """Models of all languages in ``docs`` (text, lang); rows without text or lang teach nothing.

    What reaches the driver is the summed table, one row per language and
    distinct gram, and the cross-entropies of ``CALIBRATION_ROWS`` rows.
    """
    known = docs.filter("text is not null and lang is not null").select(
        F.col("lang").cast("string").alias("lang"), F.col("text").cast("string").alias("text"))
    summed = (known.mapInArrow(_counted, "lang string, gram bigint, n bigint")
              .groupBy("lang", "gram").agg(F.sum("n").alias("n")))
    table = summed.toArrow()
    langs = np.array(table.column("lang").to_pylist(), object)
    gram = np.asarray(table.column("gram").combine_chunks()).view(U) if len(langs) else np.zeros(0, U)
    count = np.asarray(table.column("n").combine_chunks()) if len(langs) else np.zeros(0, np.int64)
    counts = {}
    for lang in set(langs.tolist()):
        mine = langs == lang
        order = np.argsort(gram[mine])
        counts[lang] = (gram[mine][order], count[mine][order])
    models = Models(counts)
    if counts:
        # Only entropies come back; the sample is the rows of the least hashes.
        least = known.select(F.xxhash64("text").alias("h")).distinct().orderBy("h").limit(CALIBRATION_ROWS)
        most = least.agg(F.max("h")).first()[0]
        sample = known.filter(F.xxhash64("text") <= F.lit(most))
        sent = docs.sparkSession.sparkContext.broadcast(models)

        def entropies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for part in C.pieces(batch, "text", 1 << 20):
                    got, _ = sent.value.cross_entropies(part.column("text").to_pylist())
                    yield C.rows({"lang": part.column("lang"), "h": pa.array(got.tolist(), pa.list_(pa.float64()))})

        rows = (sample.mapInArrow(entropies, "lang string, h array<double>").distinct()
                .orderBy("lang", "h").limit(2 * CALIBRATION_ROWS).collect())
        rows.sort(key=lambda r: (r.lang, r.h))
        models.calibrate(np.array([r.h for r in rows]), [r.lang for r in rows])
    return models


def identify(docs: DataFrame, models: Models, reject: bool = False) -> DataFrame:
    """``docs`` (text and others) with lang_pred and score, over whole texts.

    Columns of these names that ``docs`` has are replaced.  Null texts and
    those without a letter are ``und``; repeated rows are rows like others; an
    empty table gives an empty table.
    """
    docs = docs.drop("lang_pred", "score")
    names = [f.name for f in docs.schema]
    sent = docs.sparkSession.sparkContext.broadcast(models)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in C.pieces(batch, "text", 1 << 20):
                langs, score = sent.value.predict(part.column("text").to_pylist(), reject)
                yield C.rows({n: part.column(n) for n in names} | {
                    "lang_pred": pa.array(langs, pa.string()), "score": pa.array(score)})

    kinds = ", ".join(f"`{n}` {docs.schema[n].dataType.simpleString()}" for n in names)
    return docs.mapInArrow(run, kinds + ", lang_pred string, score double")
