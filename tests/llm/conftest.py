import duckdb
import pytest
from pyspark.sql import types as T

SF = "/root/testdata/sf0.001"

# doc_id, text; nulls, empty, blank, one word, ties and repeated rows
EDGES = [
    (9001, None), (9002, ""), (9003, " \t\n "), (9004, "word"), (9005, "word"), (9006, "a a a a a a a a a a a a " * 20),
    (9007, "two words"), (9007, "two words"), (None, "no id at all here but enough words to have a shingle or two"),
    (9008, "é中 文 x <|endoftext|> y's we'll  'tis\r\nnow 12 3 ½ 😀"), (9009, "x" * 30_000), (9010, "tail " * 9000),
]
SCHEMA = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()),
    T.StructField("n_chars", T.LongType()), T.StructField("text_key", T.StringType()), T.StructField("score", T.DoubleType()), T.StructField("mask", T.LongType()),
])  # the last three clash with names that operators use


def rows_of(pairs):
    return [(i, t, None if k % 7 == 3 else "en", "hot" if k % 3 == 0 else f"s{k % 5}", None if t is None else len(t), "own", 0.5, None) for k, (i, t) in enumerate(pairs)]


def given() -> list[tuple]:
    return duckdb.sql(f"select doc_id, text from '{SF}/documents.parquet' order by doc_id").fetchall()


@pytest.fixture(scope="session")
def pairs():
    return given() + EDGES


@pytest.fixture(scope="session")
def docs(spark, pairs):
    return spark.createDataFrame(rows_of(pairs), SCHEMA).repartition(3)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def make(spark):
    return lambda pairs: spark.createDataFrame(rows_of(pairs), SCHEMA)
