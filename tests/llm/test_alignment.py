"""Cross-tokenizer alignment against a plain version, token by token."""

import collections
import hashlib
import random

import numpy as np
import pytest

P = pytest.importorskip("public_tokenizers")

from vitrine.llm import alignment, common as C  # noqa: E402

PATHS = P.path("byte_bpe_50k.json"), P.path("piece_bpe_32k.model")
ODD = ["", None, " ", "  two  spaces ", "a\nb\n\n c\t\td", "tabs\t and\r\nreturns;\r\n}\r", "x\u00a0y\u00a0\u00a0 z \u00a0\n\nq", "\u3000wide\u2003 space",
       "caf\u00e9 \u00bd \ufb01ne e\u0301", "\u6f22\u5b57\u3068\u304b\u306a", "\U0001f600 smile\U0001f468\u200d\U0001f469", "null\x00byte", "<s> </s> <unk> <|endoftext|>",
       "under\u2581score", "\u2581", "'s 't I'll we've 're", "12345 67 8.9", "a" * 3000, " " * 50 + "end" + " " * 7, "\x0b\x0c v", "<0x41> A", "\ufeffbom", "\n", "\t\n "]


def plain(texts):
    """Tokens, groups and links of whole texts; counts over all of them."""
    import sentencepiece
    from tokenizers import Tokenizer
    a, b = Tokenizer.from_file(PATHS[0]), sentencepiece.SentencePieceProcessor(model_file=PATHS[1])
    a.encode_special_tokens = True
    letters = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [x for x in range(256) if x not in letters]
    byte = {chr(x): x for x in letters} | {chr(256 + i): x for i, x in enumerate(rest)}
    found, counts = [], collections.Counter()
    for t in texts:
        whole = (" " + (t or "")).encode()
        ia = a.encode(" " + (t or ""), add_special_tokens=False).ids
        ib = b.encode(t or "")
        wa = [bytes(byte[c] for c in a.id_to_token(i)) for i in ia]
        wb = [bytes([int(b.id_to_piece(i)[3:5], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("\u2581", " ").encode() for i in ib]
        if not t or b"".join(wa) != whole or b"".join(wb) != whole:
            found.append(((0, 0, 0, 0), [], ""))
            continue
        ea, eb = np.cumsum([len(w) for w in wa]).tolist(), np.cumsum([len(w) for w in wb]).tolist()
        links, x, y = [], 0, 0
        groups, ga, gb = [], [], []
        while x < len(ia):
            links.append((ia[x], ib[y]))
            if not ga or ga[-1][0] != x:
                ga.append((x, ia[x]))
            if not gb or gb[-1][0] != y:
                gb.append((y, ib[y]))
            end = min(ea[x], eb[y])
            if ea[x] == eb[y]:
                groups.append(",".join(str(i) for _, i in ga) + "|" + ",".join(str(i) for _, i in gb))
                ga, gb = [], []
            x, y = x + (ea[x] == end), y + (eb[y] == end)
        counts.update(links)
        found.append(((len(ia), len(ib), len(groups), len(links)), links, ";".join(groups)))
    best = collections.defaultdict(int)
    for (_, y), n in counts.items():
        best[y] = max(best[y], n)
    return [(*n, sum(counts[p] == best[p[1]] for p in links), sum(counts[p] for p in links), said) for n, links, said in found], counts


def texts_of(n):
    rng = random.Random(5)
    words = ["the", "cat", "sat", "on", "Reoush", "hewh", "na\u00efve", "x1", "don't", "(par)", "\u0442\u0435\u043a\u0441\u0442", "sch\u00f6n", "?!", "a-b"]
    return [rng.choice(["", " ", "\n"]).join(["", ""]) + "".join(rng.choice(words) + rng.choice([" ", " ", " ", "  ", "\n", ". "]) for _ in range(rng.randrange(60))) for _ in range(n)]


@pytest.mark.parametrize("small", [False, True])
def test_against_plain(spark, monkeypatch, small):
    if small:  # many runs, blocks and chunks
        for name, value in (("RUN_LINKS", 200), ("BLOCK", 7), ("CHUNK_BYTES", 300)):
            monkeypatch.setattr(alignment, name, value)
        monkeypatch.setattr(alignment.C, "STEP_BYTES", 400)
    texts = ODD + texts_of(80) + ["the cat sat"] * 3
    rows = [(i if i % 9 else None, t, "x", i) for i, t in enumerate(texts)] + [(7, "the cat", "x", 0)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, groups string, run int").repartition(3)
    want, counts = plain([r[1] for r in rows])
    got = alignment.align(docs, *PATHS, keep_groups=True).collect()
    assert sorted(map(str, (tuple(r) for r in got))) == sorted(str((r[0], *w)) for r, w in zip(rows, want))
    pairs = {(r.a, r.b): (r.n_links, r.best) for r in alignment.pair_counts(docs, *PATHS).collect()}
    assert {k: n for k, (n, _) in pairs.items()} == dict(counts)
    hashed = alignment.align(docs, *PATHS).collect()
    assert sorted(r.groups for r in hashed) == sorted(hashlib.sha256(w[-1].encode()).hexdigest() if w[-1] else "" for w in want)


def test_empty_and_without_tokens(spark):
    docs = spark.createDataFrame([(1, None), (2, ""), (None, "a\u2581b")], "doc_id bigint, text string")
    assert {tuple(r)[1:] for r in alignment.align(docs, *PATHS).collect()} == {(0, 0, 0, 0, 0, 0, "")}
    assert alignment.align(docs.limit(0), *PATHS).count() == 0


def test_blobs_and_merge():
    for x in ([3, 1, 2], [0, 5, 5, 1 << 60], [-4, 7]):
        assert [y.tolist() for y in C.unpack(C.pack(np.array(x), np.array([1])), 2)] == [x, [1]]
    rng = np.random.default_rng(3)
    blocks, want = [], collections.Counter()
    for _ in range(30):
        keys = np.unique(rng.integers(0, 90, 12))
        counts = rng.integers(1, 9, len(keys))
        blocks.append((int(keys[0]), keys, counts))
        want.update(dict(zip(keys.tolist(), counts.tolist())))
    blocks.sort(key=lambda b: b[0])
    got = list(alignment.merged(iter(blocks)))
    keys = np.concatenate([k for k, _ in got])
    assert (np.diff(keys) > 0).all() and dict(zip(keys.tolist(), np.concatenate([n for _, n in got]).tolist())) == want
