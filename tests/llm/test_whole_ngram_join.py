import corpus_pipeline
from orderlens.llm import ngram_join as nj
from tests.llm.conftest import DOCS, prose

BASE = prose(11, 150)
OTHER = prose(12, 150)
DATA = [(1, BASE, "a"), (None, BASE + " tail", "b"), (None, BASE, "c"), (2, prose(13, 90), "d"),
        *[(None, OTHER, f"copy {i}") for i in range(5)], (None, OTHER + " more", "e"), (None, prose(14, 90), "f")]


def test_sets_under_null_ids_are_linked(spark):
    found = nj.jaccard_classes(spark.createDataFrame(DATA, DOCS)).collect()
    got = sorted(((r.doc_id, r.set_id, r.class_id, r.n_links) for r in found), key=repr)
    want = [(1, 1, 1, 1), (None, None, 1, 1), (None, 1, 1, 1), (2, 2, 2, 0), *[(None, None, None, 1)] * 6, (None, None, None, 0)]
    assert got == sorted(want, key=repr)


def test_one_row_of_each_class_stays_with_or_without_ids(spark, scratch):
    docs = spark.createDataFrame(DATA, DOCS)
    out = corpus_pipeline.one_of_near_copies(spark, docs, scratch)
    assert out.columns == docs.columns
    kept = sorted(r.extra for r in out.collect())
    assert len(kept) == 4 and {"a", "d", "f"} < set(kept)
    assert len([x for x in kept if x.startswith("copy") or x == "e"]) == 1
