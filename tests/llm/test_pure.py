"""Parts of the corpus operators that need no session, against plain versions."""

import collections
import html
import re

import numpy as np
import pyarrow as pa
import pytest

from vitrine.llm import common as C
from vitrine.llm import decontaminate, dom, language, maintext, neardup, quality, simple8b, substrings

WORD = re.compile(rb"[^\x20\x09-\x0d]+")


def test_words_end_with_their_row():
    texts = [None, "", "  ", "a b", "b\tc\n", "ç d", "d"]
    data, offsets = C.text_bytes(pa.array(texts))
    start, end, first = C.word_spans(data, offsets)
    found = [data[a:b].tobytes() for a, b in zip(start, end)]
    assert [found[a:b] for a, b in zip(first[:-1], first[1:])] == [WORD.findall((t or "").encode()) for t in texts]
    h = C.span_hash(C.prefix_hash(data), start, end)
    assert len(set(h.tolist())) == len(set(found))


def test_shingles_are_those_of_the_words():
    texts = ["A b c d", "a B c", "b c d", "a b", "A B", "", None, "a"]
    h, begin = C.shingles(*C.text_bytes(pa.array(texts)), 3)
    sets = [frozenset(h[a:b].tolist()) for a, b in zip(begin[:-1], begin[1:])]
    assert [len(s) for s in sets] == [2, 1, 1, 1, 1, 0, 0, 1]
    assert sets[1] < sets[0] and sets[2] < sets[0] and sets[3] == sets[4] != sets[7]


def test_simple8b_round_trip():
    rng = np.random.default_rng(0)
    for trial in range(60):
        lists = [rng.integers(0, 2 ** int(rng.integers(1, 60)), int(rng.integers(0, 90)), dtype=np.uint64) for _ in range(4)]
        lists.append(np.full(int(rng.integers(0, 500)), int(rng.integers(0, 9)), np.uint64))
        lists.append(np.concatenate([np.zeros(70, np.uint64), np.full(300, 77777, np.uint64)]))
        lengths = np.array([len(x) for x in lists])
        words, counts = simple8b.encode_lists(np.concatenate(lists), lengths)
        assert (simple8b.decode(words, lengths, np.cumsum(counts) - counts) == np.concatenate(lists)).all()
    assert len(simple8b.encode(np.zeros(0, np.uint64))) == 0
    assert len(simple8b.encode(np.full(100_000, 5, np.uint64))) == 1
    with pytest.raises(ValueError):
        simple8b.decode(np.array([5], np.uint64), np.array([200]), np.array([0]))


def test_simple8b_escapes():
    top = 2 ** 64 - 1
    assert simple8b.encode(np.array([1 << 60], np.uint64)).tolist() == [15 << 60, 1 << 60]
    rng = np.random.default_rng(5)
    for _ in range(40):
        lists = [np.where(rng.random(n) < 0.3, rng.integers(2 ** 60, top, n, dtype=np.uint64, endpoint=True),
                          rng.integers(0, 2 ** int(rng.integers(1, 62)), n, dtype=np.uint64)) for n in rng.integers(0, 60, 5)]
        lists += [np.full(9, top, np.uint64), np.full(300, 1 << 62, np.uint64), np.array([15 << 60, 5, 15 << 60], np.uint64)]
        lengths = np.array([len(x) for x in lists])
        words, counts = simple8b.encode_lists(np.concatenate(lists), lengths)
        first = np.cumsum(counts) - counts
        assert (simple8b.decode(words, lengths, first) == np.concatenate(lists)).all()
        one = simple8b.decode(words[first[2]:first[2] + counts[2]], lengths[2:3], np.zeros(1, np.int64))
        assert (one == lists[2]).all()
    with pytest.raises(ValueError):
        simple8b.decode(np.array([15 << 60], np.uint64), np.array([1]), np.array([0]))


def test_ids_are_the_tokenizers_own():
    tokenizers = pytest.importorskip("tokenizers")
    path = pytest.importorskip("public_tokenizers").path("byte_bpe_50k.json")
    texts = [None, "", " ", "\n", "a", " a", "a ", "a  b", "a \n b", "\n\n a\n", "it's 12 o'clock!!", "ça va", "x y",
             "<|endoftext|> z", "a\tb\r\nc", " em", "tab\t", "z" * 3000, "a\x1cb", "日本 語"]
    plain = tokenizers.Tokenizer.from_file(path)
    ids, size = simple8b.Encoder(path).encode(pa.array(texts))
    want = [plain.encode(t or "", add_special_tokens=False).ids for t in texts]
    got = [x.tolist() for x in np.split(ids, np.cumsum(size)[:-1])]
    assert got == want
    small = simple8b.Encoder(path, most=4)  # a table that is emptied all the time
    for t in texts:
        small.encode(pa.array([t], pa.string()))
    assert np.split(small.encode(pa.array(texts))[0], np.cumsum(size)[:-1])[10].tolist() == want[10]


def test_ids_of_slices_and_mirrored_words():
    tokenizers = pytest.importorskip("tokenizers")
    path = pytest.importorskip("public_tokenizers").path("byte_bpe_50k.json")
    a, b = "a", "b"
    for _ in range(11):  # two words that any polynomial mod 2**64 takes for one
        a, b = a + b, b + a
    texts = pa.array(["é", None, "x\xa0y", "日本 語", a, b, "<|endoftext|>", "ab cd"])
    plain, known = tokenizers.Tokenizer.from_file(path), simple8b.Encoder(path)
    for first, last in ((0, 8), (1, 6), (3, 8), (2, 5)):
        part = texts.slice(first, last - first)
        ids, size = known.encode(part)
        got = [x.tolist() for x in np.split(ids, np.cumsum(size)[:-1])]
        assert got == [plain.encode(t or "", add_special_tokens=False).ids for t in part.to_pylist()]


def test_repeated_starts_against_counting():
    rng = np.random.default_rng(1)
    for trial in range(40):
        base = rng.integers(97, 100, 300).astype(np.uint8).tobytes()
        regions = []
        for _ in range(int(rng.integers(2, 7))):
            r = bytearray(base[int(rng.integers(0, 40)):][:int(rng.integers(60, 200))])
            for _ in range(int(rng.integers(0, 3))):
                r[int(rng.integers(0, len(r)))] = int(rng.integers(97, 123))
            regions.append(bytes(r))
        counts = [int(x) for x in rng.integers(1, 3, len(regions))]
        seen = collections.Counter()
        for r, c in zip(regions, counts):
            for i in range(len(r) - 29):
                seen[r[i:i + 30]] += c
        for r, hit in zip(regions, substrings.repeated_starts(regions, counts, 30)):
            assert [seen[r[i:i + 30]] > 1 for i in range(len(r) - 29)] == hit.tolist()


def test_anchors_do_not_depend_on_what_is_around():
    rng = np.random.default_rng(2)
    shared = rng.integers(97, 123, 900).astype(np.uint8)
    found = []
    for pad in (0, 37, 500):
        data = np.concatenate((rng.integers(97, 123, pad).astype(np.uint8), shared, rng.integers(97, 123, 50).astype(np.uint8)))
        first, last, at = substrings.anchors(data, C.prefix_hash(data), 400, 128)
        assert first[0] == 0 and last[-1] == len(data) - 400 and (first[1:] == last[:-1] + 1).all()
        of = np.repeat(at, last - first + 1)
        found.append((of - pad)[pad:pad + 501].tolist())
    assert found[0] == found[1] == found[2]


def test_common_subsequence():
    def plain(a, b):
        row = [0] * (len(b) + 1)
        for x in a:
            new = [0]
            for j, y in enumerate(b):
                new.append(row[j] + 1 if x == y else max(row[j + 1], new[-1]))
            row = new
        return row[-1]
    rng = np.random.default_rng(3)
    for _ in range(80):
        a, b = rng.integers(0, 6, int(rng.integers(1, 90))).tolist(), rng.integers(0, 6, int(rng.integers(0, 120))).tolist()
        assert decontaminate.common_subsequence(a, b) == plain(a, b)


def test_near_pairs_meet_as_often_as_stated():
    rng = np.random.default_rng(9)
    pairs, apart = 60_000, 0
    for _ in range(6):
        coords = rng.integers(0, 2**32, (pairs // 6, neardup.COORDINATES), dtype=np.uint32)
        other = np.where(rng.random(coords.shape) < 0.8, coords, rng.integers(0, 2**32, coords.shape, dtype=np.uint32))
        met = np.stack([a == b for a, b in zip(neardup.planted(coords), neardup.planted(other))]).any(0)
        apart += int((~met).sum())
    assert apart <= 14  # 4.2 are expected at seven in 100,000
    assert neardup.miss_rate(0.85) < 1.3e-6 and neardup.miss_rate(0.85, crowds=True) < 1.4e-6
    assert neardup.miss_rate(0.80) < 7.2e-5 and neardup.miss_rate(0.80, crowds=True) < 8e-5


def test_gram_models_are_distributions():
    texts = {"x": ["abab abba cab"] * 3, "y": ["cdcd dccd acd"] * 2 + ["é"]}
    counts = {l: tuple(np.unique(language.grams(t)[0], return_counts=True)) for l, t in texts.items()}
    models = language.Models(counts)
    context = language.grams(["ab"])[0][-1] << np.uint64(16)
    letters = np.array([ord(c) for c in " abcdé"], np.uint64)
    total = np.exp(models.log_probability(context | letters)).sum(0)
    assert (total <= 1.0001).all() and (total > 0.8).all()
    assert models.predict(["abba", "dcd", "", None, "12 !", "  "])[0] == ["x", "y"] + ["und"] * 4
    assert language.Models({}).predict(["abc", None])[0] == ["und", "und"]


def test_network_gradients():
    rng = np.random.default_rng(4)
    net = quality.Network()
    net.embed, net.filters, net.out = (x.astype(np.float64) for x in (net.embed, net.filters, rng.normal(0, 1, net.out.shape)))
    chunks = rng.integers(0, 256, (5, quality.CHUNK)).astype(np.uint8)
    first, label = np.array([0, 2]), np.array([1.0, 0.0])

    def loss():
        p = net.probability(net.pooled(chunks)[0], first)
        return -(label * np.log(p) + (1 - label) * np.log(1 - p)).mean() + 0.5e-4 * (net.out ** 2).sum()
    grad = net.gradients(chunks, first, label)
    for name in ("out", "filters", "embed"):
        value = getattr(net, name)
        place = np.unravel_index(int(np.abs(grad[name]).argmax()), value.shape)
        old, step = value[place], 1e-5
        value[place] = old + step
        up = loss()
        value[place] = old - step
        down = loss()
        value[place] = old
        assert (up - down) / (2 * step) == pytest.approx(grad[name][place], rel=0.02)


def test_every_byte_is_in_a_chunk():
    for size in (0, 1, 63, 64, 65, 511, 512, 513, 960, 961, 5000):
        starts = quality.chunk_starts(size)
        covered = set()
        for s in starts.tolist():
            covered |= set(range(s, min(s + quality.CHUNK, size)))
        assert len(starts) >= 1 and covered == set(range(size))


PAGE = """<!DOCTYPE html><html><head><title>T</title><script>var t="</p><p>no</p>";</script></head><body class=page>
<!-- <p>no</p> --><p>One &amp; <b>two<br>three</b> &nbsp; four<p>five<ul><li>six<li>seven</ul>
<table><tr><td>a<td>b<tr><td>c</table><style>p{}</style>eight</i> nine<div><span class="x">ten</span> eleven</div></body></html>"""


def test_dom_reads_broken_markup():
    nodes = dom.parse(PAGE)
    assert dom.blocks(nodes, [True] * len(nodes)).split("\n") == [
        "One & two three four", "five", "six", "seven", "a", "b", "c", "eight nine", "ten eleven"]
    for odd in (None, "", "<", "<p", "</p></div>", "<!--", "<a href='x", "a < b & c", "<script>x", "<div>" * 3000 + "deep"):
        dom.blocks(dom.parse(odd), [True] * len(dom.parse(odd)))
    assert dom.blocks(dom.parse("<div>" * 3000 + "deep"), [True] * 3001) == "deep"


def test_decoding_keeps_subtrees_whole():
    nodes = dom.parse("<div><p>" + "a" * 300 + "</p><p>" + "b" * 300 + "</p><p>short</p></div><div><p>" + "c" * 200 + "</p></div>")
    p = np.array([0.5, 0.9, 0.95, 0.9, 0.4, 0.1, 0.2])
    own = np.array([0, 0, 300, 300, 5, 0, 200])
    assert maintext.decode(nodes, p, own)[1:] == [True, True, True, True, False, False]


def test_main_text_of_unseen_layouts():
    rng = np.random.default_rng(5)
    words = ["".join(chr(97 + int(c)) for c in rng.integers(0, 26, int(rng.integers(2, 9)))) for _ in range(400)]

    def text(n):
        return " ".join(words[int(i)] for i in rng.integers(0, 400, n)) + "."
    pages = [f"<html><body><nav><a href=/>{text(2)}</a></nav><div class=ad>{text(8)}</div><article><h1>{text(6)}</h1>"
             + "".join(f"<p>{text(int(rng.integers(5, 90)))}</p>" for _ in range(8)) + f"</article><footer>{text(9)}</footer></body></html>"
             for _ in range(120)]
    made = maintext.Extractor(pages)
    assert made.texts([None, ""]) == ["", ""]
    got = made.texts(pages[:20])
    for page, found in zip(pages, got):
        inner = page[page.index("<article>"):page.index("</article>")]
        assert found.split("\n") == [html.unescape(x) for x in re.findall(r"<(?:h1|p)>([^<]*)", inner)]
    layouts = maintext.Layouts(77, [text(60) for _ in range(40)])
    scores = []
    for _ in range(60):
        page = layouts.page(text(6), [text(int(rng.integers(5, 80))) for _ in range(8)])
        nodes = dom.parse(page)
        want = collections.Counter(dom.blocks(nodes, [g > 0 for g in maintext._gold(nodes)]).split("\n"))
        found = collections.Counter(made.texts([re.sub(r' data-gold="."', "", page)])[0].split("\n"))
        both = sum((want & found).values())
        scores.append((both / sum(found.values()), both / sum(want.values())))
    precision, recall = np.mean(scores, axis=0)
    assert precision > 0.93 and recall > 0.93


def test_tiles_keep_pairs_at_the_threshold_whose_shingles_collide():
    """85 of 100 shared, of which two are alike in 32 bits."""
    shared = np.arange(1, 86, dtype=np.uint64)
    shared[84] = (1 << 40) | 1  # alike with the first
    a = np.concatenate((shared, np.arange(1000, 1008, dtype=np.uint64)))
    b = np.concatenate((shared, np.arange(2000, 2007, dtype=np.uint64)))
    rows = [(7, 1, 1, 1, a), (7, 2, 2, 1, b)]
    batch = C.rows({n: pa.array([r[i] for r in rows]) for i, n in enumerate(("tile", "cid", "comp", "least"))} | {
        "short": pa.array([np.unique(r[4].astype(np.uint32)).tobytes() for r in rows], pa.binary()),
        "full": pa.array([len(r[4]) for r in rows], pa.int32())})
    found = [x for got in neardup.tiler(85)(iter([batch])) for x in zip(got.column("a").to_pylist(), got.column("b").to_pylist())]
    assert found == [(1, 2)]
    assert sum(got.num_rows for got in neardup.tiler(86)(iter([batch]))) == 0


def test_encoder_keeps_its_units_in_few_bytes():
    import public_tokenizers
    known = simple8b.Encoder(public_tokenizers.path("byte_bpe_50k.json"))
    for a in range(0, 6000, 1000):
        texts = [" ".join(f"w{i * 7919 % 5003}x" for i in range(j, j + 9)) + "  \n" for j in range(a, a + 1000)]
        ids, size = known.encode(pa.array(texts))
        plain = [e.ids for e in known.tokenizer.encode_batch(texts, add_special_tokens=False)]
        assert size.tolist() == [len(x) for x in plain] and ids.tolist() == [i for x in plain for i in x]
    assert known.key.nbytes + known.begin.nbytes + known.size.nbytes <= 16 * len(known.key)
    assert known.pool.nbytes <= 2.5 * known.used + 2
    known.most = 100
    again, _ = known.encode(pa.array(texts))
    assert again.tolist() == ids.tolist()
