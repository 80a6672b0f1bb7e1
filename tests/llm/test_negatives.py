"""Hard negatives against a plain version, on made tables with ties, repeats and gaps."""

import math
import random

import pytest
from pyspark.sql import functions as F

from vitrine.llm import negatives

SHAPE = "vec_id bigint, label int, embedding array<float>, score string, mark int"


def plain(rows, is_anchor):
    """Row by row: every anchor against every other row."""
    whole = [(i, l, [math.floor(256 * x) for x in v]) for i, l, v, *_ in rows
             if i is not None and l is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    found = []
    for a, al, av in {(i, l, tuple(v)) for i, l, v in whole if is_anchor(i)}:
        scored = sorted((-sum(x * y for x, y in zip(av, v)), i, l) for i, l, v in whole if i != a and len(v) == len(av))
        for p, i, l in [x for x in scored if x[2] == al][:5]:
            fit = [x for x in scored if x[2] != al and 50 * -p <= 100 * -x[0] <= 95 * -p]
            found += [(a, i, k + 1, n[1], -p, -n[0]) for k, n in enumerate(fit[:3])]
    return sorted(found)


def made(seed, n, dim=4, spread=2):
    rng = random.Random(seed)
    return [(i - 20, rng.randrange(3), [rng.randrange(-spread, spread + 1) / 256 for _ in range(dim)], "x", 1) for i in range(n)]


@pytest.mark.parametrize("seed", [1, 2])
def test_against_plain(spark, monkeypatch, seed):
    monkeypatch.setattr(negatives, "SCORES", 300)
    monkeypatch.setattr(negatives, "BLOCK_BYTES", 200)
    rows = made(seed, 150) + made(seed + 7, 40, dim=3)  # ids of the second repeat some of the first
    rows += [rows[3], rows[3], rows[20]]
    rows += [(None, 1, [0.1] * 4, "x", 1), (900, None, [0.1] * 4, "x", 1), (901, 1, None, "x", 1), (905, 1, [], "x", 1), (910, 2, [], "x", 1),
             (902, 1, [0.1, None, 0.2, 0.1], "x", 1), (903, 1, [float("nan")] * 4, "x", 1), (904, 1, [float("inf")] * 4, "x", 1)]
    df = spark.createDataFrame(rows, SHAPE).repartition(5)
    got = negatives.mine(negatives.clean(df), F.col("vec_id") % 5 == 0).collect()
    assert sorted(map(tuple, got)) == plain(rows, lambda i: i % 5 == 0)


def test_crowd_of_one_vector(spark):
    rows = [(i, i % 2, [0.5, 0.25], "x", 1) for i in range(400)] + [(1000 + i, 1, [0.3, 0.1], "x", 1) for i in range(9)]
    df = spark.createDataFrame(rows, SHAPE)
    got = negatives.mine(negatives.clean(df), F.col("vec_id") % 50 == 0).collect()
    assert sorted(map(tuple, got)) == plain(rows, lambda i: i % 50 == 0)


def test_large_components_and_empty_tables(spark):
    rows = [(i, i % 3, [float(2 ** 18 + 37 * i), float(i)], "x", 1) for i in range(60)]  # products beyond 2**53
    df = spark.createDataFrame(rows, SHAPE)
    got = negatives.mine(negatives.clean(df), F.col("vec_id") % 10 == 0).collect()
    assert sorted(map(tuple, got)) == plain(rows, lambda i: i % 10 == 0)
    assert negatives.mine(negatives.clean(df.limit(0)), F.col("vec_id") % 10 == 0).count() == 0
    assert negatives.mine(negatives.clean(df), F.lit(False)).count() == 0
    far = spark.createDataFrame([(i, 1, [1e30], "x", 1) for i in range(3)], SHAPE)
    with pytest.raises(Exception, match="fit in a long"):
        negatives.mine(negatives.clean(far), F.col("vec_id") == 0).collect()
