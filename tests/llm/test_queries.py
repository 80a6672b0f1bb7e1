"""The registered corpus queries on the smallest tables."""

import collections
import zlib

import duckdb
import pytest

import corpus_pipeline
from vitrine.llm.queries import OP8_SQL, OP11_SQL, QUERIES

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def tables():
    con = duckdb.connect()
    for name in ("documents", "pages", "benchmark", "labels", "conversations", "embeddings"):
        con.sql(f"CREATE VIEW {name} AS SELECT * FROM '{FOLDER}/{name}.parquet'")
    return con


def test_one_query_per_operator():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality", "near_copies", "leaks", "mix", "tokens"]


def test_chat_against_sql(spark, tables):
    got = QUERIES["op8_chat"][0](spark, FOLDER).select("conv_id", "part", "n_turns", "chat").collect()
    assert sorted(map(tuple, got)) == sorted(tables.sql(OP8_SQL).fetchall())


def test_negatives_against_sql(spark, tables):
    got = QUERIES["op11_hard_negatives"][0](spark, FOLDER).collect()
    assert got and sorted(map(tuple, got)) == sorted(tables.sql(OP11_SQL).fetchall())


@pytest.mark.parametrize("name", [n for n in QUERIES if n not in ("op1_main_text", "op8_chat", "op11_hard_negatives")])
def test_one_row_per_document(spark, tables, name):
    rows = QUERIES[name][0](spark, FOLDER).collect()
    ids = [r[0] for r in tables.sql("SELECT doc_id FROM documents").fetchall()]
    assert collections.Counter(r.doc_id for r in rows) == collections.Counter(ids)
    if name == "op3_quality":
        assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) and r.predicted == (r.score >= 0.3) for r in rows)
    if name == "op7_language":
        langs = dict(tables.sql("SELECT doc_id, lang FROM documents").fetchall())
        held = [r for r in rows if r.held_out and langs[r.doc_id]]
        assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in rows)
        assert sum(r.lang_pred == langs[r.doc_id] for r in held) >= 0.9 * len(held)
    if name == "op9_contaminated":
        items = [" ".join(t.lower().split()) for t, in tables.sql("SELECT text FROM benchmark").fetchall()]
        texts = {d: " ".join((t or "").lower().split()) for d, t in tables.sql("SELECT doc_id, text FROM documents").fetchall()}
        assert {r.doc_id for r in rows if r.contaminated} == {d for d, t in texts.items() if any(i in t for i in items)}


def test_pages_have_their_articles(spark, tables):
    import html
    import re
    rows = {r.page_id: r.text for r in QUERIES["op1_main_text"][0](spark, FOLDER).collect()}
    for page, source in tables.sql("SELECT page_id, html FROM pages").fetchall():
        inner = re.split(r"</?(?:p|h1)>", source[source.index("<article>") + 9:source.index("</article>")])
        lines = [" ".join(html.unescape(re.sub("<[^>]+>", "", x)).split()) for x in inner]
        assert rows[page] == "\n".join(x for x in lines if x)


def test_pipeline(spark, tables):
    rows = corpus_pipeline.run(spark, FOLDER).collect()
    known = {r[0] for r in tables.sql("SELECT doc_id FROM documents").fetchall()}
    assert rows and {r.doc_id for r in rows} <= known
    ordered = sorted(rows, key=lambda r: r.start)
    assert [r.doc_id for r in ordered] == sorted(r.doc_id for r in rows)
    assert all(a.start + a.n_tokens == b.start for a, b in zip(ordered, ordered[1:]))
