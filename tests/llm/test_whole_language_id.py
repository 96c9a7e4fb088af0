import base64
import random

import numpy as np

from orderlens.llm import language_id as li
from tests.llm.conftest import rows


def test_parts_score_as_the_whole_model(spark, documents):
    """A model far above the cap of a part keeps every gram: sums of all texts are those of the model in one piece."""
    texts = documents.select("lang", "text").where("length(text) < 3000").limit(80)
    got = texts.collect()
    counts = {}
    for lang in sorted({r.lang for r in got}):
        counts[lang] = np.unique(np.concatenate([li.grams(li.letters(r.text)) for r in got if r.lang == lang]), return_counts=True)
    whole = li.Model(counts)
    model = li.train(texts, max_cells=4000)
    assert len(model.shared) > 5 and model.langs == whole.langs
    probes = [got[0].text, "never seen: ÿŏ zqx 中文", got[1].text + got[2].text]
    total, n, _ = li._judge(model, np.ones((len(model.langs), 3)), probes)
    for i, text in enumerate(probes):
        g = li.grams(li.letters(text))
        assert n[i] == len(g)
        assert np.allclose(total[i], whole.log_probs(g).sum(axis=0, dtype=float), rtol=1e-5)


def test_predictions_do_not_depend_on_the_size_of_a_part(spark, documents):
    short = documents.selectExpr("doc_id + 1000000", "substring(text, 1, 9)", "cast(null as string)")  # scores between 0 and 1
    docs = documents.select("doc_id", "text", "lang").union(short)
    out = [rows(li.identify(docs, li.F.lit(True), max_cells=n).select("doc_id", "lang_pred", "rejected", li.F.round("score", 3)))
           for n in (li.MAX_CELLS, 20_000)]
    assert out[0] == out[1]


def test_texts_half_in_no_known_language_are_rejected(spark, documents):
    rng = random.Random(3)
    text = {r.lang: r.text for r in documents.where("length(text) BETWEEN 500 AND 900").collect()}
    other = {
        "italian": "Il governo ha annunciato ieri nuove misure per sostenere le famiglie e le imprese colpite dalla crisi economica. " * 6,
        "polish": "Rząd ogłosił wczoraj nowe środki wspierające rodziny i przedsiębiorstwa dotknięte kryzysem gospodarczym. " * 6,
        "letters": " ".join("".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=rng.randint(2, 9))) for _ in range(120)),
        "base64": base64.b64encode(rng.randbytes(500)).decode(),
    }
    mixed, want = [], {}
    for lang, known in sorted(text.items()):
        for name, x in other.items():
            mixed.append((f"{lang} {name}", known + " " + x[:len(known)]))
            want[mixed[-1][0]] = True
            mixed.append((f"{lang} and little {name}", known + " " + x[:len(known) // 8]))
            want[mixed[-1][0]] = False
        for b in sorted(text):
            mixed.append((f"{lang} {b}", known + " " + text[b]))
            want[mixed[-1][0]] = False
    docs = documents.selectExpr("cast(doc_id as string) doc_id", "text", "lang")
    probes = spark.createDataFrame(mixed, "doc_id string, text string").selectExpr("*", "cast(null as string) lang")
    out = li.identify(docs.unionByName(probes), li.F.col("lang").isNotNull())
    assert {r.doc_id: r.rejected for r in out.where("lang IS NULL").collect()} == want
    assert out.where("lang IS NOT NULL AND rejected").count() == 0


def test_calibration_is_bounded_and_not_swayed_by_copies(spark, documents):
    texts = documents.select("lang", "text").where("lang IS NOT NULL AND text IS NOT NULL")
    model = li.train(texts)
    copies = texts.unionByName(texts.limit(1).crossJoin(spark.range(500)).select("lang", "text"))
    assert li.calibrate(texts, model) == li.calibrate(copies, model)


def test_every_distinct_text_calibrates(spark):
    """1,500 texts of one language, more than the 1,000 that once were taken."""
    texts = spark.range(1500).selectExpr("'en' lang", "concat('the weather of day ', translate(cast(id as string), '0123456789', 'abcdefghij'), ' was fine') text")
    model = li.train(texts)
    entropy, n = 0.0, 0
    for _, size, total, _ in model.blocks([r.text for r in texts.select("text").collect()]):
        entropy, n = entropy - total[:, 0].sum(), n + size.sum()
    assert abs(li.calibrate(texts, model)["en"][0] - entropy / n) < 1e-6
