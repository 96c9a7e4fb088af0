import duckdb
from pyspark.sql import functions as F

import corpus_pipeline
from orderlens.llm.line_dedup import drop_frequent_lines
from orderlens.llm.queries import QUERIES, SQL

#: One document delivered ten times, a line that ten documents hold, one that nine do.
DATA = [(1, "first own line\nsecond own line")] * 10 + [(i, f"held by ten\nline of {i}" + ("\nheld by nine" if i > 2 else "")) for i in range(2, 12)]


def test_repeated_rows_of_an_id_count_once_as_in_the_twin(spark, scratch):
    spark.createDataFrame(DATA, "doc_id long, text string").write.parquet(f"{scratch}/documents.parquet")
    got = QUERIES["op4_line_dedup"](spark, scratch).groupBy("doc_id").agg(F.sum("n_lines"), F.sum("n_dropped")).collect()
    db = duckdb.connect()
    db.execute(f"CREATE VIEW documents AS SELECT * FROM '{scratch}/documents.parquet/*.parquet'")
    want = db.execute(f"SELECT doc_id, n_lines, n_dropped FROM ({SQL['op4_line_dedup']})").fetchall()
    assert sorted(map(tuple, got)) == sorted(want)
    assert (1, 20, 0) in want and (2, 2, 1) in want


def test_pipeline_stage_keeps_a_document_delivered_ten_times(spark, scratch):
    docs = spark.createDataFrame(DATA, "doc_id long, text string")
    out = corpus_pipeline.drop_common_lines(spark, docs, scratch)
    assert [r.text for r in out.where("doc_id = 1").collect()] == [DATA[0][1]] * 10


def test_each_row_with_a_null_id_is_a_document(spark):
    docs = spark.createDataFrame([(None, "same line\nx")] * 3 + [(7, "other line")] * 3, "doc_id long, text string")
    out = sorted(r.text for r in drop_frequent_lines(docs, min_docs=3, by_id=True).collect())
    assert out == [""] * 3 + ["other line"] * 3
