import math
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from orderlens.llm import language_id as li
from orderlens.llm.queries import QUERIES
from tests.conftest import SF_MID
from tests.llm.conftest import rows


def reduced(text):
    out = [" "]
    for c in text.lower() + " ":
        if c.isalpha():
            out.append(c)
        elif out[-1] != " ":
            out.append(" ")
    return "".join(out)


class PlainModel:
    """Interpolated Kneser-Ney by dictionaries, straight from the definition."""

    def __init__(self, texts, letters):
        self.tables = {}
        counts = Counter()
        for t in texts:
            x = "  " + reduced(t)
            for i in range(3, len(x)):
                counts[x[i - 3:i + 1]] += 1
        for k in (4, 3, 2, 1):
            self.tables[k] = counts
            lower = Counter()
            for g in counts:
                lower[g[1:]] += 1
            counts = lower
        self.uniform = 1 / (len(letters) + 1)

    def p(self, gram):
        if not gram:
            return self.uniform
        table = self.tables[len(gram)]
        same = {g: n for g, n in table.items() if g[:-1] == gram[:-1]}
        total = sum(same.values())
        if not total:
            return self.p(gram[1:])
        return max(same.get(gram, 0) - li.DISCOUNT, 0) / total + li.DISCOUNT * len(same) / total * self.p(gram[1:])


def model_of(texts):
    counts = {}
    for lang, ts in texts.items():
        g = np.concatenate([li.grams(li.letters(t)) for t in ts])
        counts[lang] = np.unique(g, return_counts=True)
    return li.Model(counts)


def test_probabilities_equal_the_definition():
    texts = {"aa": ["the cat sat on the mat", "a cat"], "bb": ["der hund und die katze", "ein Hund!"]}
    model = model_of(texts)
    letters = {c for ts in texts.values() for t in ts for c in reduced(t)}
    plain = {x: PlainModel(ts, letters) for x, ts in texts.items()}
    for probe in ("the dog und katze", "zebra", "Ça", "mat 12 mat", "a"):
        x = "  " + reduced(probe)
        want = [[math.log(plain[lang].p(x[i - 3:i + 1])) for lang in model.langs] for i in range(3, len(x))]
        got = model.log_probs(li.grams(li.letters(probe)))
        assert np.allclose(got, want, atol=1e-4), probe


def test_distribution_sums_to_one():
    model = model_of({"aa": ["abba baab ab"], "bb": ["xyz zyx"]})
    letters = sorted(set(" abxyz"))
    codes = [0 if c == " " else ord(c) for c in letters] + [0x4E2D]  # one letter never seen
    for context in ((0, 0, 0), (97, 98, 98), (120, 121, 122), (5000, 5000, 5000)):
        g = np.array([sum(x << (16 * (3 - i)) for i, x in enumerate((*context, c))) for c in codes], dtype=np.uint64)
        assert np.allclose(np.exp(model.log_probs(g).astype(float)).sum(axis=0), 1, atol=1e-3)


def test_held_out_accuracy_and_no_leak(spark):
    got = QUERIES["op8_language_id"](spark, SF_MID).toPandas().set_index("doc_id")
    truth = spark.read.parquet(f"{SF_MID}/documents.parquet").select("doc_id", "lang").toPandas().set_index("doc_id")["lang"]
    held = got[got.held_out]
    assert len(held) > 100 and (held.lang_pred == truth[held.index]).mean() > 0.99
    assert got.rejected.mean() < 0.01 and got.score.between(0, 1).all()


def test_odd_rows_and_rejection(spark, documents, odd, empty):
    known = documents.select("doc_id", "text", F.lit(None).cast("string").alias("extra"), "lang")
    noise = spark.createDataFrame([(900_001, "qxzvk jqwx zzkq vvxq kkjz qqzx " * 40)], "doc_id long, text string").selectExpr(
        "doc_id", "text", "cast(null as string) extra", "cast(null as string) lang")
    both = known.unionByName(odd.withColumn("lang", F.lit(None).cast("string"))).unionByName(noise)
    out = li.identify(both, F.col("doc_id") < 150, out=("p", "s", "r")).where("extra IS NOT NULL OR doc_id = 2 OR doc_id IS NULL OR doc_id > 900000")
    found = out.where("lang IS NULL")
    assert found.count() == 14
    for r in found.collect():
        if r.text is None or not any(map(str.isalpha, r.text)):
            assert (r.p, r.s, r.r) == ("und", 0.0, True)
        else:
            assert r.p != "und" and 0 <= r.s <= 1
        if r.doc_id == 900_001:
            assert r.r
    assert li.identify(empty.withColumn("lang", F.col("extra")), F.lit(True)).count() == 0
    assert {r.lang_pred for r in li.identify(odd.withColumn("lang", F.lit(None).cast("string")), F.lit(True)).collect()} == {"und"}
    with pytest.raises(ValueError):
        li.identify(odd.withColumn("lang", F.col("extra")).withColumnRenamed("extra", "SCORE"), F.lit(True))


def test_texts_in_two_known_languages_are_kept(spark, documents):
    text = {r.lang: r.text for r in documents.where("length(text) BETWEEN 300 AND 900").collect()}
    mixed = [(10_000 + i, f"{text[a]} {text[b]}") for i, (a, b) in enumerate([("en", "fr"), ("de", "en"), ("fr", "de")])]
    both = documents.select("doc_id", "text", "lang").unionByName(
        spark.createDataFrame(mixed, "doc_id long, text string").selectExpr("*", "cast(null as string) lang"))
    out = li.identify(both, F.col("doc_id") < 10_000)
    assert out.where("rejected").count() == 0


def test_counts_are_whole(spark, documents):
    texts = documents.select("lang", "text")
    want = defaultdict(Counter)
    for r in texts.collect():
        want[r.lang].update(li.grams(li.letters(r.text)).tolist())
    got = {(r.lang, r.gram): r.n for r in li.gram_counts(texts).collect()}
    assert got == {(lang, np.uint64(g).astype(np.int64).item()): n for lang, c in want.items() for g, n in c.items()}
    assert rows(texts.limit(0)) == []
