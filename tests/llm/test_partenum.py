"""The partition-and-enumerate join against all pairs."""

import collections
import random

import numpy as np
import pytest

from tests.llm.test_operators import crowd, groups
from vitrine.llm import neardup, partenum


def pair_at(rng, size, percent):
    """A set and one that is as far from it as the threshold allows."""
    a = rng.integers(0, 2**63, size, dtype=np.uint64)
    drop = add = 0
    while True:  # one more difference, on either side, while the pair stays similar
        more = (drop + 1, add) if rng.random() < 0.5 else (drop, add + 1)
        if 100 * (size - more[0]) < percent * (size + more[1]):
            break
        drop, add = more
    return np.unique(a), np.unique(np.concatenate((a[drop:], rng.integers(0, 2**63, add, dtype=np.uint64))))


@pytest.mark.parametrize("percent", [80, 85, 60])
def test_similar_sets_share_a_signature(percent):
    rng = np.random.default_rng(percent)
    for size in [*range(1, 40), *rng.integers(40, 900, 60).tolist(), 5000]:
        for _ in range(6):
            pair = pair_at(rng, size, percent)
            both = len(np.intersect1d(*pair))
            assert 100 * both >= percent * (len(pair[0]) + len(pair[1]) - both)
            flat, begin = np.concatenate(pair), np.cumsum([0, *map(len, pair)])
            sig, row = partenum.signatures(flat, begin, percent)
            if neardup.class_ids(flat, begin)[0] != neardup.class_ids(flat, begin)[1]:
                assert set(sig[row == 0].tolist()) & set(sig[row == 1].tolist())
            x, y = (np.frombuffer(c, np.uint8).astype(int) for c in partenum.cells(flat, begin))
            n = min(len(x), len(y))
            assert np.abs(x.reshape(n, -1).sum(1) - y.reshape(n, -1).sum(1)).sum() <= sum(map(len, pair)) - 2 * both


def test_few_signatures_and_few_chance_meetings():
    rng = np.random.default_rng(4)
    sets = [np.unique(rng.integers(0, 2**63, n, dtype=np.uint64)) for n in [50, 300, 300, 301, 310, 2000] * 20]
    flat, begin = np.concatenate(sets), np.cumsum([0, *map(len, sets)])
    sig, row = partenum.signatures(flat, begin, 80)
    assert len(sig) <= len(flat)
    assert len(np.unique(sig)) >= 0.999 * len(sig)


@pytest.mark.parametrize("small", [False, True])
def test_against_all_pairs(spark, monkeypatch, small):
    if small:  # many runs and blocks, large signatures, tiles of several blocks
        for module, name, value in ((partenum, "RUN", 500), (partenum, "BLOCK", 16), (partenum, "LARGE", 3),
                                    (neardup, "SMALL_NODE", 2), (neardup, "BLOCK", 8), (partenum.C, "STEP_BYTES", 3000)):
            monkeypatch.setattr(module, name, value)
    rng = random.Random(3)
    texts = crowd(1, 60) + crowd(2, 30, 40) + crowd(3, 20, 9) + crowd(4, 8, 700)
    lines = [" ".join(f"l{rng.randrange(99)}" for _ in range(30)) for _ in range(3)]
    texts += [rng.choice(lines) + " " + " ".join(f"o{rng.randrange(10 ** 6)}" for _ in range(rng.randrange(80))) for _ in range(60)]
    texts += ["a b", "A  b", "a b c d e f g h i", "a b c d e f g h", "a b c d e f g", "", None, " ", "q", "q"] + texts[:5]
    rows = list(enumerate(texts))
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(4)
    got = partenum.jaccard_components(docs, 5, 80).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == groups(dict(rows), 5, 80)


def test_odd_rows(spark):
    long = " ".join(f"w{i % 701}x{i % 13}" for i in range(6000))
    rows = [(1, None, 5), (2, "", 5), (None, "x y z", 5), (3, long, 5), (4, long, 6), (4, long + " t", 6), (8, "x y z", 5), (None, None, 1)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, n_shingles int")
    got = collections.Counter((r.doc_id, r.component_id) for r in partenum.jaccard_components(docs).collect())
    assert got == collections.Counter([(1, 1), (2, 2), (None, 8), (3, 3), (4, 3), (4, 3), (8, 8), (None, None)])
    assert partenum.jaccard_components(docs.limit(0)).count() == 0
