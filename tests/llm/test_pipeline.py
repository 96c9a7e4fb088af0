import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tests.conftest import SF_SMALL
from tests.llm.conftest import rows
from tests.llm.test_line_dedup import brute as lines_brute
from tests.llm.test_ngram_join import brute as join_brute
from tests.llm.test_packing import check_packed, expected_pieces


@pytest.fixture(scope="module")
def stages(spark, scratch_module):
    """Each stage's rows on a table with planted rows: noise, near copies, benchmark passages, odd rows."""
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    item = spark.read.parquet(f"{SF_SMALL}/benchmark.parquet").orderBy("item_id").first().text
    one = docs.where(F.length("text") > 800).orderBy("doc_id").first()
    planted = spark.createDataFrame([
        (10_000, "qxzvk jqwx zzkq vvxq kkjz qqzx " * 40, None, "p", 5),
        (10_001, one.text + " tail", one.lang, "p", 5),
        (10_002, one.text.split("\n")[0] + "\n" + item + "\n" + one.text[::-1][:0] + "unlike words of prose", one.lang, "p", 5),
        (10_003, None, "en", None, None), (10_004, "", None, "p", 0), (10_005, "1234 5678", "en", "p", 9),
    ], docs.schema)
    now, out = docs.unionByName(planted), {}
    out["input"] = now.collect()
    for name, stage in corpus_pipeline.STAGES:
        now = stage(spark, now, SF_SMALL)
        now.write.parquet(f"{scratch_module}/{name}")
        now = spark.read.parquet(f"{scratch_module}/{name}")
        out[name] = now.collect()
        if name != "packing":
            assert now.columns == docs.columns
    return out, one.doc_id


@pytest.fixture(scope="module")
def scratch_module(tmp_path_factory):
    return tmp_path_factory.mktemp("stages")


def ids(found):
    return {r.doc_id for r in found}


def test_language_stage_rejects_noise_and_keeps_the_rest(stages):
    got, _ = stages
    assert ids(got["input"]) - ids(got["language_id"]) == {10_000, 10_003, 10_004, 10_005}
    text = {r.doc_id: r.text for r in got["input"]}
    assert all(r.text == text[r.doc_id] for r in got["language_id"])


def test_line_stage_equals_brute_force(stages):
    got, _ = stages
    want = lines_brute([(r.doc_id, r.text, None) for r in got["language_id"]], 10)
    assert sorted((r.doc_id, r.text) for r in got["line_dedup"]) == sorted((w[0], w[1]) for w in want)
    assert all(r.n_chars == len(r.text) for r in got["line_dedup"])


def test_join_stage_equals_brute_force(stages):
    got, first = stages
    want = join_brute([(r.doc_id, r.text) for r in got["line_dedup"]], 0.8)
    assert ids(got["ngram_join"]) == {c for _, c, _ in want.values()}
    assert 10_001 not in ids(got["ngram_join"]) or first not in ids(got["ngram_join"])


def test_benchmark_stage(stages):
    from tests.llm.test_decontaminate import best_overlap, words

    got, _ = stages
    gone = ids(got["ngram_join"]) - ids(got["decontamination"])
    assert 10_002 in gone
    bench = [words(r.text) for r in _benchmark()]
    text = {r.doc_id: words(r.text) for r in got["ngram_join"]}
    assert all(any(best_overlap(text[i], b) >= min(13, len(b)) for b in bench) for i in gone)


def _benchmark():
    from pyspark.sql import SparkSession

    return SparkSession.active().read.parquet(f"{SF_SMALL}/benchmark.parquet").collect()


def test_packing_stage(stages):
    got, _ = stages
    found = got["packing"]
    assert sorted([tuple(getattr(r, c) for c in ("doc_id", "piece", "start", "length", "ids_crc32")) for r in found], key=repr) == expected_pieces(
        [(r.doc_id, r.text) for r in got["decontamination"]])
    assert check_packed(found, 4096) == -(-sum(r.length for r in found) // 4096)


def test_stages_on_an_empty_table(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, SF_SMALL).count() == 0


def test_odd_rows_pass_all_stages(spark, odd):
    docs = odd.select("doc_id", "text", F.lit(None).cast("string").alias("lang"), F.col("extra").alias("source"),
                      F.lit(1).cast("long").alias("n_chars"), F.lit(2).alias("score"))
    for name, stage in corpus_pipeline.STAGES[1:]:  # without languages the first rejects all
        out = stage(spark, docs, SF_SMALL)
        assert out.count() and (name == "packing" or out.columns == docs.columns)
    assert rows(corpus_pipeline.STAGES[0][1](spark, docs, SF_SMALL)) == []
