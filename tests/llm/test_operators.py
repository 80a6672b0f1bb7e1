"""Corpus operators on small tables, against plain versions and odd rows."""

import collections
import hashlib
import re
import struct
import zlib
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import Row, functions as F

from vitrine.llm import (chat, decontaminate, fingerprint, language, maintext, mixing, neardup, quality, simple8b,
                         stages, substrings)
from vitrine.llm import common as C
from vitrine.llm.components import components

WORD = re.compile(r"[^\x20\x09-\x0d]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"
LONG = " ".join(f"w{i % 701}x{i % 13}" for i in range(6000))
ODD = [(1, None, None, None, None), (2, "", "en", "a", 0), (None, "x y z", "en", "b", 5), (3, LONG, "en", None, len(LONG)),
       (4, LONG, "en", "a", len(LONG)), (4, LONG, "en", "a", len(LONG)), (5, " \t ", "fr", "b", 3), (6, "one", None, "c", 3),
       (7, LONG + " tail", "en", "c", None), (8, "x y z", "en", "b", 5)]


@pytest.fixture(scope="module")
def odd(spark):
    return (spark.createDataFrame(ODD, DOCS).withColumn("score0", F.lit(1))
            .withColumn("overlap_", F.lit("x")).withColumn("size", F.lit(9)))


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], DOCS)


def shingle_set(text, n):
    words = WORD.findall((text or "").translate(LOWER))
    return {tuple(words[i:i + n]) for i in range(max(1, len(words) - n + 1))} if words else set()


def groups(texts: dict, n, percent):
    parent = {d: d for d in texts}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x
    sets = {d: shingle_set(t, n) for d, t in texts.items()}
    for a in texts:
        for b in texts:
            if a < b and sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]):
                x, y = root(a), root(b)
                parent[max(x, y)] = min(x, y)
    return {d: (len(sets[d]), root(d)) for d in texts}


def crowd(seed, size, words=160):
    import random
    rng = random.Random(seed)
    base = [f"b{rng.randrange(10 ** 6)}" for _ in range(words)]
    out = []
    for _ in range(size):
        mine = list(base)
        for _ in range(rng.randrange(0, 9)):
            mine[rng.randrange(words)] = f"n{rng.randrange(10 ** 6)}"
        out.append(" ".join(mine))
    return out


def test_components(spark):
    links = spark.createDataFrame([(1, 2), (3, 2), (9, 8), (5, 5), (7, 6), (6, 5), (10, 7), (1, 2)], "a bigint, b bigint")
    assert dict(components(links).collect()) == {1: 1, 2: 1, 3: 1, 9: 8, 8: 8, 7: 5, 6: 5, 5: 5, 10: 5}
    assert components(links.limit(0)).count() == 0


@pytest.mark.parametrize("small", [True, False])
def test_near_groups(spark, monkeypatch, small):
    if small:  # so that nodes branch, crowds are tiled and tiles have several blocks
        monkeypatch.setattr(neardup, "SMALL_NODE", 2)
        monkeypatch.setattr(neardup, "BLOCK", 8)
    texts = crowd(1, 40) + crowd(2, 30) + crowd(3, 3) + ["a b", "A  b", "", None, "q"]
    rows = [(i, t) for i, t in enumerate(texts)]
    got = neardup.near_components(spark.createDataFrame(rows, "doc_id bigint, text string"), 3, 85).collect()
    want = groups(dict(rows), 3, 85)
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == want
    assert all(r.kept == (r.doc_id == r.component_id) for r in got)


def test_near_pairs_in_crowds(spark, monkeypatch):
    """Pairs just above the threshold among texts that all share a template are not lost for the crowd."""
    import random
    rng = random.Random(12)
    monkeypatch.setattr(neardup, "CROWD", 2)
    template = [f"t{i}" for i in range(160)]
    texts = []
    for _ in range(220):
        own = [f"n{rng.randrange(10 ** 9)}" for _ in range(40)]
        texts.append(" ".join(template + own))
        for i in range(4, 39, 5):
            own[i] = f"m{rng.randrange(10 ** 9)}"
        texts.append(" ".join(template + own))
    rows = list(enumerate(texts))
    got = neardup.near_components(spark.createDataFrame(rows, "doc_id bigint, text string"), 3, 80).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == groups(dict(rows), 3, 80)


def test_near_groups_of_odd_rows(odd, empty):
    got = neardup.near_components(odd, 3, 85).collect()
    assert len(got) == len(ODD)
    comp = collections.defaultdict(set)
    for r in got:
        comp[r.doc_id].add((r.component_id, r.kept))
    assert comp[4] == {(3, False)} and comp[3] == {(3, True)} and comp[7] == {(3, False)}
    assert comp[None] == {(8, False)} and comp[8] == {(8, True)} and comp[1] == {(1, True)}
    kept = neardup.keep_one(odd, 3, 85)
    assert kept.columns == odd.columns and sorted(r.doc_id for r in kept.collect()) == [1, 2, 3, 5, 6, 8]
    assert neardup.near_components(empty).count() == 0 and neardup.keep_one(empty).count() == 0


def test_keep_one_keeps_rows_not_ids(spark):
    one, two, three, four = (" ".join(f"{c}{i}" for i in range(30)) for c in "wxyz")
    rows = [(1, two), (5, one + " a"), (5, two), (None, three), (None, four), (None, three), (None, "l m n"), (7, "l m n"),
            (None, ""), (None, None)]
    kept = neardup.keep_one(spark.createDataFrame(rows, "doc_id bigint, text string"), 3, 85).collect()
    assert sorted(map(str, kept)) == sorted(str(Row(doc_id=d, text=t)) for d, t in [
        (1, two), (5, one + " a"), (None, three), (None, four), (7, "l m n"), (None, ""), (None, None)])


def test_mixing(spark, odd, empty):
    rows = [(i, f"s{i % 7}" if i % 11 else None, (i * 37) % 90) for i in range(900)]
    docs = spark.createDataFrame(rows, "doc_id bigint, source string, size bigint")
    got = mixing.mix(docs, F.col("size")).collect()
    sizes = collections.Counter()
    for _, s, n in rows:
        sizes[s] += n
    names = sorted(s for s in sizes if s is not None) + [None]
    weights = {s: (3, 1, 2)[i % 3] for i, s in enumerate(names)}
    targets = mixing.exact_targets(dict(sizes), weights, Fraction(3, 2), 2)
    taken = collections.Counter()
    for r in got:
        assert r.target == pytest.approx(float(targets[r.source])) and r.source_size == sizes[r.source]
        assert 0 <= r.taken <= 2 * r.size
        taken[r.source] += r.taken
    assert all(abs(taken[s] - targets[s]) <= 0.5 for s in names)
    again = mixing.mix(docs.repartition(5, "size"), F.col("size")).collect()
    assert sorted(map(str, again)) == sorted(map(str, got))
    assert mixing.mix(odd, C.words("text")).count() == len(ODD)
    assert mixing.mix(empty, C.words("text")).count() == 0


def test_token_blocks(spark, odd, empty, tmp_path):
    path = pytest.importorskip("public_tokenizers").path("byte_bpe_50k.json")
    from tokenizers import Tokenizer
    plain = Tokenizer.from_file(path)
    docs = odd.filter("doc_id is null or doc_id <> 4")
    simple8b.write_blocks(docs, f"{tmp_path}/a", path)
    got = sorted(simple8b.read_digests(spark, f"{tmp_path}/a").collect(), key=lambda r: r.start)
    want, start = [], 0
    for d, t in sorted(((r[0], r[1]) for r in ODD if r[0] != 4), key=lambda x: (x[0] is not None, x[0] or 0)):
        ids = plain.encode(t or "", add_special_tokens=False).ids + [0]
        want.append((d, start, len(ids), zlib.crc32(struct.pack(f"<{len(ids)}I", *ids))))
        start += len(ids)
    assert [tuple(r) for r in got] == want
    simple8b.write_blocks(empty, f"{tmp_path}/b", path)
    assert simple8b.read_digests(spark, f"{tmp_path}/b").count() == 0


@pytest.mark.parametrize("most", [256, 2])
def test_repeated_spans(spark, odd, empty, most):
    import random
    rng = random.Random(6)
    parts = ["".join(rng.choice("abcdefé ") for _ in range(700)) for _ in range(4)]
    texts = [parts[0], parts[0] + parts[1], parts[1][:450] + "!" + parts[2], parts[2][100:] + parts[3], parts[3][:399],
             "ab" * 600, "x" + parts[0][200:620], parts[0][10:630] + "?", parts[0], "", None, "z" * 400]
    rows = list(enumerate(texts)) + [(3, texts[3])]
    got = substrings.without_repeats(spark.createDataFrame(rows, "doc_id bigint, text string"), most=most).collect()
    raw = [(t or "").encode() for _, t in rows]
    seen = collections.Counter(b[i:i + 400] for b in raw for i in range(len(b) - 399))
    want = []
    for (d, _), b in zip(rows, raw):
        gone = bytearray(len(b))
        for i in range(len(b) - 399):
            if seen[b[i:i + 400]] > 1:
                gone[i:i + 400] = b"\1" * 400
        kept = bytes(x for x, g in zip(b, gone) if not g)
        want.append((d, len(b), sum(gone), len(re.findall(b"\1+", bytes(gone))), hashlib.sha256(kept).hexdigest(), len(kept), any(gone)))
    assert sorted(map(tuple, got)) == sorted(want)
    if most == 2:
        assert substrings.without_repeats(empty).count() == 0
        assert substrings.without_repeats(odd).count() == len(ODD)


def test_quality(spark, odd, empty):
    rows = [(i, ("Good words of a calm text. " if i % 3 else "BAD!! LOUD!! WORDS!! ") * (i % 7 + 1)) for i in range(300)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    labels = spark.createDataFrame([(i, 1 if i % 3 else 0) for i in range(200)] + [(None, 1), (5, None), (999, 0)],
                                   "doc_id bigint, quality int")
    network = quality.fit(docs, labels)
    got = {r.doc_id: r.score for r in quality.score(docs, network).collect()}
    assert all((got[i] >= 0.5) == (i % 3 != 0) for i in range(300))
    scored = quality.score(odd, network).collect()
    assert len(scored) == len(ODD) and all(0 <= r.score <= 1 for r in scored)
    assert quality.fit(docs, labels.limit(0)) is None and quality.score(empty, None).count() == 0
    assert {r.score for r in quality.score(odd, None).collect()} == {0.5}


def test_language(spark, odd, empty):
    en, de = "the cat and the dog sat on the mat ", "der hund und die katze sitzen auf der matte "
    rows = [(i, (en if i % 2 else de) * (i % 3 + 1), "en" if i % 2 else "de") for i in range(60)] + [(90, "§§ 12", "en"), (91, None, "fr")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string")
    models = language.learn(docs)
    got = {r.doc_id: r for r in language.identify(docs.select("doc_id", "text"), models).collect()}
    assert all(got[i].lang_pred == ("en" if i % 2 else "de") and 0.5 < got[i].score <= 1 for i in range(60))
    assert got[90].lang_pred == got[91].lang_pred == "und"
    far = spark.createDataFrame([(1, "ωψξ ζηθ χφυ ωψξ"), (2, en)], "doc_id bigint, text string")
    assert [r.lang_pred for r in language.identify(far, models, reject=True).sort("doc_id").collect()] == ["und", "en"]
    assert language.identify(odd, models).count() == len(ODD)
    assert language.identify(odd, language.learn(empty)).count() == len(ODD)


def test_every_gram_is_counted_by_itself(spark):
    import random
    rng = random.Random(7)
    texts = ["".join(chr(0x4E00 + rng.randrange(5000)) for _ in range(1500)) for _ in range(60)]
    models = language.learn(spark.createDataFrame([(t, "zh") for t in texts], "text string, lang string"))
    want = np.unique(language.grams(texts)[0])
    assert len(want) > 85_000 and (models.key[language.ORDER] == want).all()


def test_contamination(spark, odd, empty):
    import random
    rng = random.Random(8)
    vocabulary = [f"v{i}" for i in range(900)]

    def text(n):
        return " ".join(rng.choice(vocabulary) for _ in range(n))
    items = [(i, text(rng.randrange(15, 60))) for i in range(20)]
    rows, leaks = [], {}
    for d in range(120):
        words = text(300).split()
        if d % 6 == 0:
            i = d // 6
            passage = items[i][1].split()
            if d % 12 == 0:  # a paraphrase: some words are others, the answer stays
                for k in range(0, len(passage) - 6, 5):
                    passage[k] = "other"
            at = rng.randrange(300)
            words[at:at] = [w.upper() + "," for w in passage]
            leaks[d] = str(i)
        rows.append((d, " ".join(words)))
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    benchmark = spark.createDataFrame(items + [(50, None), (51, " ")], "item_id bigint, text string")
    got = {r.doc_id: r.item_id for r in decontaminate.contaminated(docs, benchmark).collect() if r.contaminated}
    assert got == leaks
    assert decontaminate.contaminated(odd, benchmark).filter("contaminated").count() == 0
    assert decontaminate.contaminated(docs, benchmark.limit(0)).filter("contaminated or item_id is not null").count() == 0
    assert decontaminate.contaminated(empty, benchmark).count() == 0
    whole = decontaminate.contaminated(docs, benchmark).select("doc_id", "contaminated", "overlap").collect()
    old, decontaminate.BLOCK_WORDS = decontaminate.BLOCK_WORDS, 200
    try:  # many blocks, same verdicts
        blocks = decontaminate.contaminated(docs, benchmark).select("doc_id", "contaminated", "overlap").collect()
    finally:
        decontaminate.BLOCK_WORDS = old
    assert sorted(whole) == sorted(blocks)


def test_contamination_by_items_of_frequent_words(spark):
    import random
    rng = random.Random(10)
    usual = [f"u{i}" for i in range(300)]

    def text(n):
        return [rng.choice(usual) for _ in range(n)]
    item = text(120)
    item[::20] = [f"r{i}" for i in range(6)]  # no window of 32 words has three of them
    rows = [(i, " ".join(text(300))) for i in range(150)]
    for i in range(16):
        rows.append((1000 + i, " ".join(text(50 + i) + item + text(60))))
        some = list(item)
        for j in rng.sample(range(115), 42):
            some[j] = f"p{rng.randrange(10 ** 9)}"
        rows.append((2000 + i, " ".join(text(50 + i) + some + text(60))))
    benchmark = spark.createDataFrame([("q", " ".join(item))], "item_id string, text string")
    got = decontaminate.contaminated(spark.createDataFrame(rows, "doc_id bigint, text string"), benchmark).collect()
    assert sorted(r.doc_id for r in got if r.contaminated) == sorted(d for d, _ in rows if d >= 1000)


def test_fingerprints(spark, odd, empty):
    rows = [(i * 3 - 20, " ".join(f"w{(i * k) % 97}" for k in range(i * 7))) for i in range(40)] + [(500, None)]
    got = {r.doc_id: r for r in fingerprint.fingerprints(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()}
    for (d, t), (_, after) in zip(rows, rows[1:] + rows[:1]):
        t, after = t or "", after or ""
        q = len(t) // 4
        edited = t[:len(t) - q] + after[:q]
        assert got[d].n_chars == len(t) and got[d].edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        for found, other in ((got[d].near_edited, edited), (got[d].near_next, after)):
            a, b = shingle_set(t, 5), shingle_set(other, 5)
            exact = len(a & b) / len(a | b) if a | b else 1.0
            small = max(len(a), len(b)) < fingerprint.K
            assert found == pytest.approx(exact, abs=1e-9 if small else 0.2)
    rows = fingerprint.fingerprints(odd).collect()
    assert len(rows) == len(ODD) and len({r.fingerprint for r in rows if r.doc_id in (3, 4)}) == 1
    assert fingerprint.fingerprints(empty).count() == 0


@pytest.mark.parametrize("ids", [[*range(60), 9 * 10 ** 18], [-2 ** 63, -2 ** 62, 5, 2 ** 62, 2 ** 63 - 1], [7] * 90 + [None] * 60 + [1, 2, 3, 1 << 40],
                                 [(i * 0x9E3779B97F4A7C15) % 2 ** 64 - 2 ** 63 for i in range(200)]])
def test_fingerprints_of_spread_and_repeated_ids(spark, ids):
    rows = [(d, f"{i} " + " ".join(f"w{(i * k) % 97}" for k in range(i % 50))) for i, d in enumerate(ids)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string").withColumn("key", F.lit("x")).repartition(3)
    tied = {(r.doc_id, r.text): r.t for r in df.select("doc_id", "text", F.xxhash64("text").alias("t")).collect()}
    order = sorted(rows, key=lambda r: (-2 ** 63 if r[0] is None else r[0], tied[r]))
    want = [(d, hashlib.sha256((t[:len(t) - len(t) // 4] + after[:len(t) // 4]).encode()).hexdigest())
            for (d, t), (_, after) in zip(order, order[1:] + order[:1])]
    got = [(r.doc_id, r.edited_sha256) for r in fingerprint.fingerprints(df).collect()]
    assert sorted(map(str, got)) == sorted(map(str, want))


def test_slices_never_fall_along_the_order(spark):
    rows = [(i // 3 if i % 4 else 50, (i * 0x9E3779B97F4A7C15) % 2 ** 64 - 2 ** 63) for i in range(3000)]
    df = spark.createDataFrame(rows, "k bigint, tie bigint")
    cuts = fingerprint.slice_cuts(F.col("k"), df, 40)
    got = sorted((r.k, r.tie, r.s) for r in df.select("*", fingerprint.slice_of(F.col("k"), F.col("tie"), cuts).alias("s")).collect())
    assert [s for *_, s in got] == sorted(s for *_, s in got)
    sizes = collections.Counter(s for *_, s in got)
    assert len(sizes) >= 30 and max(sizes.values()) < 3 * 3000 / 40


def test_fingerprints_merge(spark):
    a, b = LONG[:20000], LONG[15000:]
    sketch = fingerprint.text_sketch
    row = spark.createDataFrame([(a, b)], "a string, b string").select(
        sketch(F.col("a")).alias("x"), sketch(F.col("b")).alias("y")).select(
        "x", fingerprint.from_text(fingerprint.as_text(F.col("x"))).alias("back"),
        fingerprint.distinct_count(F.col("x")).alias("n"),
        fingerprint.containment(F.col("x"), fingerprint.merge(F.col("x"), F.col("y"))).alias("inside")).first()
    assert row.x == row.back and row.inside > 0.8
    assert row.n == pytest.approx(len(shingle_set(a, 5)), rel=0.3)


def test_chat(spark):
    turns = [(1, 0, "user", "hi"), (1, 1, "assistant", "yo"), (2, 0, "user", "hi"), (2, 1, "assistant", "yo"), (2, 2, "user", "so"),
             (3, 0, "user", "hi"), (4, 5, "user", "hi"), (4, 9, "assistant", "yo"), (4, 11, "user", "so"), (5, 0, None, None),
             (5, None, "user", "first"), (6, 0, "user", "hix"), (None, 0, "user", "n")]
    turns += [(7, i, "user", str(i)) for i in range(600)] + [(8, i, "user", str(i)) for i in range(300)]
    df = spark.createDataFrame(turns, "conv_id bigint, turn bigint, role string, text string").withColumn("n_turns", F.lit("x"))
    got = {(r.conv_id, r.part): (r.n_turns, r.chat) for r in chat.render(df).collect()}
    assert {c for c, _ in got} == {2, 5, 6, 7, None}
    assert got[2, 0] == (3, "<|user|>\nhi<|end|>\n<|assistant|>\nyo<|end|>\n<|user|>\nso<|end|>\n")
    assert got[5, 0][1] == "<|user|>\nfirst<|end|>\n<|user|>\n<|end|>\n"
    assert [got[7, p][1].count("<|user|>") for p in range(3)] == [256, 256, 88]
    assert chat.render(df.limit(0)).count() == 0


def test_main_text(spark):
    pages = [(i, f"u{i}", f"<body><nav><a>{i}</a></nav><article><h1>T{i}</h1>" + "<p>Some words, here. And there.</p>" * 3
              + "</article><footer>c</footer></body>", "x") for i in range(30)] + [(None, None, None, "x"), (1, "u1", "", "x")]
    df = spark.createDataFrame(pages, "page_id bigint, url string, html string, text string")
    got = maintext.extract(df, maintext.fit(df, 20)).collect()
    assert len(got) == 32 and sum(r.n_chars == 0 and r.text == "" for r in got) == 2
    assert next(r for r in got if r.page_id == 7).text == "T7\n" + "\n".join(["Some words, here. And there."] * 3)
    assert maintext.extract(df.limit(0), maintext.fit(df.limit(0))).count() == 0


def test_stage_columns_and_whole_documents(spark, odd):
    mixed = stages.mix_sources(spark, odd, "")
    assert mixed.columns == list(stages.COLUMNS)
    given = collections.Counter((r[0], r[1]) for r in ODD)
    for key, n in collections.Counter((r.doc_id, r.text) for r in mixed.collect()).items():
        assert n <= 2 * given[key]


def test_columns_that_clash_are_replaced(odd):
    given = odd.withColumns({"score": F.lit("x"), "lang_pred": F.lit(1), "contaminated": F.lit("y"), "item_id": F.lit(2), "overlap": F.lit("z")})
    rows = [(i, ("Good words of a calm text. " if i % 3 else "BAD!! LOUD!! WORDS!! ") * (i % 7 + 1)) for i in range(60)]
    spark = odd.sparkSession
    network = quality.fit(spark.createDataFrame(rows, "doc_id bigint, text string"),
                          spark.createDataFrame([(i, 1 if i % 3 else 0) for i in range(60)], "doc_id bigint, quality int"))
    for net in (network, None):
        got = quality.score(given, net)
        assert got.columns[-1] == "score" and got.columns.count("score") == 1
        assert len(got.filter("score between 0 and 1").collect()) == len(ODD)
    models = language.learn(given.select("text", "lang"))
    got = language.identify(given, models)
    assert sorted(got.columns) == sorted(given.columns) and got.filter("score between 0 and 1").count() == len(ODD)
    benchmark = spark.createDataFrame([(1, "x y z w v u")], "item_id bigint, text string")
    got = decontaminate.contaminated(given, benchmark)
    assert sorted(got.columns) == sorted(given.columns) and got.filter("not contaminated").count() == len(ODD)


def test_whole_texts_teach_the_network(spark):
    """What decides stands in one chunk of many, past where a few samples would look."""
    rng = np.random.default_rng(2)
    fill = ["calm plain words of a text", "more of the same quiet words", "and so it goes on and on"]
    rows, labels = [], []
    for i in range(160):
        parts = [fill[int(k)] for k in rng.integers(0, 3, 250)]
        if i % 2:
            parts[int(rng.integers(20, 230))] = "BUY!! NOW!! $$$ CLICK!! " * 8
        rows.append((i, " ".join(parts)))
        labels.append((i, i % 2))
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    network = quality.fit(docs, spark.createDataFrame(labels[:120], "doc_id bigint, quality int"))
    got = {r.doc_id: r.score for r in quality.score(docs, network).collect()}
    assert sum((got[i] >= 0.5) == bool(i % 2) for i in range(120, 160)) >= 38


def test_stages_of_empty_and_odd_tables(spark, odd, empty):
    folder = "/root/testdata/sf0.001"
    for name, stage in stages.STAGES:
        assert stage(spark, empty, folder).count() == 0, name
        rows = stage(spark, odd, folder)
        if name != "tokens":
            assert rows.columns == list(stages.COLUMNS), name
        assert rows.count() <= 2 * len(ODD), name
