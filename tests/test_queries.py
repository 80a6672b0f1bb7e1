"""Every registered query against its DuckDB twin on the smallest tables."""

import decimal
import math

import duckdb
import pytest

import __spark_entry__ as entry_module
from vitrine.functions import text as T

FOLDER = "/root/testdata/sf0.001"
TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()
QUERIES, ORACLES = entry_module.queries(), entry_module.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for name in TABLES:
        con.sql(f"CREATE VIEW {name} AS SELECT * FROM '{FOLDER}/{name}.parquet'")
    return con


def _plain(value):
    if isinstance(value, bool):
        return value
    if isinstance(value, decimal.Decimal):
        return float(value)
    if isinstance(value, float):
        return "nan" if math.isnan(value) else value + 0.0
    return value


def test_entry(spark):
    assert entry_module.entry(spark).count() == 1


def _against_sql(spark, folder, name, table):
    """Sorted rows of a query and of its SQL over one table of a folder."""
    con = duckdb.connect()
    con.sql(f"CREATE VIEW {table} AS SELECT * FROM '{folder}/{table}.parquet/*.parquet'")
    df = QUERIES[name](spark, folder)
    columns = ", ".join(f'"{c}"' for c in df.columns)
    want = con.sql(f"SELECT {columns} FROM ({ORACLES[name]})").fetchall()
    return sorted(map(repr, map(tuple, df.collect()))), sorted(map(repr, want))


def test_name_codes_of_long_part_keys(spark, tmp_path):
    part = spark.read.parquet(f"{FOLDER}/part.parquet").limit(3)
    far = part.withColumn("p_partkey", part.p_partkey + 998_998).unionByName(
        part.limit(1).withColumn("p_partkey", part.p_partkey + 12_345_678_901))
    part.unionByName(far).write.parquet(f"{tmp_path}/part.parquet")
    got, want = _against_sql(spark, str(tmp_path), "name_codes", "part")
    assert got == want and len(got) == 7


def test_text_blanks_of_empty_texts(spark, one, tmp_path):
    texts = ["", "   ", "\n\t ", "\u00a0", None, " a  b "]
    spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got, want = _against_sql(spark, str(tmp_path), "text_blanks", "documents")
    assert got == want and len(got) == len(texts)
    assert [one(T.is_blank("c"), c=c) for c in ("", "\n\u00a0", "\u200b", " a ")] == [True, True, False, False]


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query(spark, duck, name):
    df = QUERIES[name](spark, FOLDER)
    columns = sorted(df.columns)
    got = sorted(repr([_plain(r[c]) for c in columns]) for r in df.collect())
    relation = duck.sql(ORACLES[name])
    assert sorted(relation.columns) == columns
    order = [relation.columns.index(c) for c in columns]
    want = sorted(repr([_plain(r[i]) for i in order]) for r in relation.fetchall())
    assert got == want
