import random

import pytest

from orderlens.llm import decontaminate as dc
from tests.llm.conftest import DOCS, rows

CHINESE = "请问世界上最高的山峰叫什么名字并且位于哪个国家"


def test_short_items_are_found_whole(spark):
    rng = random.Random(5)
    filler = lambda: " ".join(f"f{rng.randrange(900)}" for _ in range(30))
    items = [(1, "Who wrote Faust?"), (2, "Goethe"), (3, "one two three four five six seven"), (4, "..."), (5, "who  wrote, FAUST")]
    data = [
        (1, f"{filler()} who wrote faust {filler()} who wrote faust", None), (2, f"{filler()} Goethe, {filler()}", None),
        (3, "One two three four five six seven", None), (4, f"{filler()} one two three four five six {filler()}", None),
        (5, f"who wrote the faust {filler()}", None), (6, "goethes faust", None), (None, "wrote faust who wrote Faust", None), (8, "", None),
    ]
    docs = spark.createDataFrame(data, DOCS)
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = dc.overlaps(docs, bench).select("doc_id", "item_id", "doc_start", "words", "equal_words")
    assert rows(got) == sorted([(1, 1, 30, 3, 3), (2, 2, 30, 1, 1), (3, 3, 0, 7, 7), (None, 1, 2, 3, 3)], key=repr)
    assert {r.doc_id for r in dc.decontaminated(docs, bench).collect()} == {4, 5, 6, 8}


@pytest.mark.parametrize("item", [CHINESE, "東京は日本の首都ですか、それともおおさかですか", "ประเทศไทยมีเมืองหลวงชื่อว่าอะไรและตั้งอยู่ที่ไหน", "最高的山"])
def test_items_of_scripts_without_spaces(spark, item):
    docs = spark.createDataFrame([(1, f"前文{item}后文", None), (2, "文前" + item[::-1], None), (3, "plain words " * 20, None)], DOCS)
    bench = spark.createDataFrame([(1, item)], "item_id long, text string")
    assert rows(dc.overlaps(docs, bench).select("doc_id", "item_id")) == [(1, 1)]


def test_words_of_spaced_scripts_stay_whole():
    from orderlens.llm.common import word_hashes

    text = "Ünïcödé words_1, здравствуй мир  한국어 단어 x-y"
    assert dc.word_hashes(text).tolist() == word_hashes(text).tolist()
    assert len(dc.word_hashes("abc中文def・")) == 4
