import numpy as np
import pytest
from pyspark.sql import functions as F

from orderlens.llm import quality
from orderlens.llm.queries import QUERIES
from tests.conftest import SF_MID


def test_held_out_accuracy_and_ranking(spark):
    got = QUERIES["op1_quality"](spark, SF_MID).toPandas().set_index("doc_id")
    truth = spark.read.parquet(f"{SF_MID}/labels.parquet").toPandas().set_index("doc_id")["quality"]
    assert len(got) == spark.read.parquet(f"{SF_MID}/documents.parquet").count()
    held = got[got.held_out].join(truth, how="inner")
    assert len(held) > 50 and (held.predicted == held.quality).mean() > 0.95
    good, bad = held.score[held.quality == 1].to_numpy(), held.score[held.quality == 0].to_numpy()
    assert (good[:, None] > bad[None, :]).mean() > 0.97
    assert got.score.between(0, 1).all() and ((got.score >= 0.7) == (got.predicted == 1)).all()


def test_pairwise_fit_equals_gradient_descent():
    """Newton's weights are the least of the same pairwise loss."""
    rng = np.random.default_rng(3)
    good, bad = rng.normal(0.5, 1, (30, 3)), rng.normal(-0.5, 1, (20, 3))
    w = quality.Ranker._fit(good, bad, 600, np.random.default_rng(1))
    d = (good[:, None, :] - bad[None, :, :]).reshape(-1, 3)  # all 600 pairs

    def loss(w, d):
        return np.mean(np.log1p(np.exp(-d @ w))) + quality.RIDGE / 2 * w @ w

    v = np.zeros(3)
    for _ in range(4000):
        v += 0.5 * ((1 / (1 + np.exp(d @ v))) @ d / len(d) - quality.RIDGE * v)
    # the sampled pairs are not exactly all pairs, so the loss over all is near its least
    assert loss(w, d) - loss(v, d) < 0.01


def test_threshold_is_the_quantile_of_the_bad_share():
    rng = np.random.default_rng(4)
    good = np.arange(400) % 4 != 0
    x = rng.random((400, len(quality.FEATURES)))
    x[:, 5] += good
    score = quality.Ranker(x, good, 0.25).score(x)
    assert abs((score < quality.THRESHOLD).mean() - 0.25) < 0.01


def test_odd_rows(spark, documents, odd, empty):
    labels = spark.read.parquet("/root/testdata/sf0.001/labels.parquet")
    conflict = labels.limit(1).select("doc_id", (1 - F.col("quality")).alias("quality"), "toxic")
    nulls = spark.createDataFrame([(None, 1, 0), (1, None, 0)], labels.schema)
    messy = labels.unionByName(labels).unionByName(conflict).unionByName(nulls)
    docs = documents.select("doc_id", "text", F.col("source").alias("label")).unionByName(
        odd.select("doc_id", "text", F.col("extra").alias("label")))
    out = quality.score_quality(docs, messy)
    assert out.columns == ["doc_id", "text", "label", "score"] and out.count() == docs.count()
    assert out.where("score IS NULL OR score < 0 OR score > 1 OR isnan(score)").count() == 0
    assert quality.score_quality(empty, labels).count() == 0
    assert {r.score for r in quality.score_quality(odd, labels.limit(0)).collect()} == {quality.THRESHOLD}
    with pytest.raises(ValueError):
        quality.score_quality(odd.withColumnRenamed("extra", "Score"), labels)


def test_features_of_a_known_text():
    f = dict(zip(quality.FEATURES, quality.features("Aa bb\nAa bb\nAa 1!"), strict=True))
    assert (f["upper"], f["digit"], f["repeated_lines"], f["top_word"], f["symbol"]) == pytest.approx((3 / 10, 1 / 17, 1 / 3, 3 / 6, 0))
    assert not quality.features(None).any() and not quality.features("").any()
