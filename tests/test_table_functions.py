"""Table functions of SQL give the rows of the columns' functions."""

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from ranksieve.functions import text as T
from ranksieve.operators import chunking, table_functions

LONG = "word and more words, " * 400
TEXTS = [
    None, "", " \n ", "short", LONG, f"HEADER ONE\n{LONG}\r\nÁRVORE Ç 2\n{'body of it ' * 9} LAST HEAD\u0085{'x' * 60}\x1c{'y' * 70}",
    "\n".join(f"HEAD {'AB' * 3}\n{'l' * 60} {i}" for i in range(250)), "É" * 49 + " 　", "é" * 50, "a" * 2000, "a" * 2001, "ab " * 1900 + "\n\n", "Ǆ ǅ ABC\n" + "z" * 80, "😀" * 2500,
]


@pytest.fixture(scope="module")
def docs(spark):
    table_functions.register(spark)
    rows = [(i, x, None if i % 2 else "k") for i, x in enumerate(TEXTS)] + [(5, TEXTS[5], "k")]
    df = spark.createDataFrame(rows, "doc_id long, Text string, `odd name` string")
    df.createOrReplaceTempView("own_docs")
    return df


def _rows(df):
    return sorted(map(tuple, df.collect()))


def test_chunks(spark, docs):
    want = _rows(chunking.chunks(docs, "doc_id", "Text"))
    assert len(want) > 40
    for sql in (
        "SELECT doc_id, chunk_ord, chunk FROM text_chunks(TABLE(own_docs), 'text')",
        "SELECT doc_id, chunk_ord, chunk FROM text_chunks(TABLE(own_docs) PARTITION BY doc_id)",
        "SELECT doc_id, chunk_ord, chunk FROM own_docs, LATERAL chunks_of(text)",
    ):
        assert _rows(spark.sql(sql)) == want, sql
    out = spark.sql("SELECT * FROM text_chunks(TABLE(own_docs))")
    assert out.columns == ["doc_id", "odd name", "chunk_ord", "chunk"]
    assert "Exchange" not in out._jdf.queryExecution().executedPlan().toString()
    small = spark.sql("SELECT chunk FROM text_chunks(TABLE(SELECT * FROM own_docs WHERE doc_id = 9), 'text', 100, 60)")
    assert [len(r[0]) for r in small.collect()] == [100] * 32 + [80]
    assert spark.sql("SELECT * FROM text_chunks(TABLE(SELECT * FROM own_docs WHERE false))").count() == 0


def test_units(spark, docs):
    marks = [None, "", "x", "# A\n## Aplicações típicas\n- one \n  - two\nno\n## Tecnologias e termos relacionados\n t1, t2\n\n## End\nz", "## Tecnologias e termos relacionados\n \n", "## Aplicações típicas- same\n- b\n### deeper\n- c"]
    spark.createDataFrame([(i, x) for i, x in enumerate(marks)], "id long, markdown string").createOrReplaceTempView("own_profiles")
    want = _rows(spark.table("own_profiles").select("id", F.posexplode(T.profile_units(F.col("markdown")))))
    assert want and _rows(spark.sql("SELECT * FROM profile_units(TABLE(own_profiles))")) == want


@pytest.mark.parametrize("call", [
    "text_chunks(TABLE(own_docs), 'absent')", "text_chunks(TABLE(own_docs), 'doc_id')", "text_chunks(TABLE(SELECT text, 1 AS Chunk FROM own_docs))",
    "text_chunks(TABLE(own_docs), 'text', 0)", "text_chunks('text')",
])
def test_wrong_calls(spark, docs, call):
    with pytest.raises(PySparkException):
        spark.sql(f"SELECT * FROM {call}").collect()
