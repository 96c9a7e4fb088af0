import random
import re

import numpy as np
import pytest

from orderlens.llm import odd_sketch
from orderlens.llm.queries import QUERIES
from tests.conftest import SF_SMALL
from tests.llm.conftest import DOCS, odd_rows, prose, rows

UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingle_set(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(UPPER))
    return {tuple(words[i:i + 3]) for i in range(max(1, len(words) - 2))} if words else set()


def brute(data):
    sets = [shingle_set(r[1]) for r in data]
    root = list(range(len(data)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            common = len(a & sets[j])
            if a and 100 * common >= 85 * (len(a) + len(sets[j]) - common):
                root[find(i)] = find(j)
    least = {}
    for i, r in enumerate(data):
        ids = [x for x in (r[0], least.get(find(i))) if x is not None]
        least[find(i)] = min(ids) if ids else None
    return sorted(((r[0], len(sets[i]), least[find(i)], r[0] == least[find(i)]) for i, r in enumerate(data)), key=repr)


def edited(text, edits, seed):
    words, rng = text.split(" "), random.Random(seed)
    for _ in range(edits):
        words[rng.randrange(len(words))] = f"edit{rng.randrange(10**6)}"
    return " ".join(words)


def check(spark, data):
    assert rows(odd_sketch.near_duplicates(spark.createDataFrame(data, DOCS).repartition(3))) == brute(data)


def test_odd_rows_equal_brute_force(spark, odd):
    assert rows(odd_sketch.near_duplicates(odd)) == brute(odd_rows())


@pytest.mark.parametrize("seed", [1, 2])
def test_copies_around_the_threshold_equal_brute_force(spark, seed):
    rng = random.Random(seed)
    data, at = [], 0
    for g in range(12):
        base = prose(100 * seed + g, rng.choice([6, 20, 60, 200]))
        for _ in range(rng.randrange(1, 14)):
            at += 1
            data.append((at, edited(base, rng.randrange(0, 6), at), None))
    rng.shuffle(data)
    check(spark, data)


def test_one_large_group_with_members_that_do_not_meet_its_origin(spark, monkeypatch):
    """Small blocks: the open buckets' members meet in many block pairs; chains of links stay whole."""
    monkeypatch.setattr(odd_sketch, "BLOCK", 8)
    base = prose(7, 120)
    data = [(i, edited(base, i % 9, i), None) for i in range(150)]
    chain = base
    for i in range(40):
        chain = edited(chain, 1, 1000 + i)
        data.append((500 + i, chain, None))
    check(spark, data)


def test_words_are_split_at_ascii_blanks_only(spark):
    data = [(1, "A\x0bb\tC", None), (2, "a b c", None), (3, "a\xa0b c d", None), (4, "a b\x1cc", None), (5, "Ä b c", None), (6, "ä b c", None)]
    check(spark, data)


def test_same_sets_with_other_order_and_repeats(spark):
    data = [(3, "a b c a b c a b c", None), (2, "a b c a b", None), (1, "x y", None), (4, "X  y", None), (5, "x", None)]
    check(spark, data)


def test_empty_table_and_clashing_names(spark, empty):
    assert odd_sketch.near_duplicates(empty).count() == 0
    data = [(1, "a b c", "k"), (2, "a b c", "k")]
    df = spark.createDataFrame(data, DOCS).selectExpr("doc_id", "text", "extra AS key", "extra AS h", "extra AS n", "extra AS component_id")
    assert rows(odd_sketch.near_duplicates(df)) == [(1, 1, 1, True), (2, 1, 1, False)]


def test_sketches_estimate_high_similarities():
    rng = np.random.default_rng(3)
    for j in (0.95, 0.9, 0.85):
        errors = []
        for _ in range(40):
            common, own = int(1000 * j), 1000 - int(1000 * j)
            x = rng.integers(0, 2**63, common + own, dtype=np.uint64)
            a, b = x, x[:common]  # b lacks what makes the similarity j
            bits = int(np.bitwise_count(odd_sketch.odd_sketch(odd_sketch.samples(a)) ^ odd_sketch.odd_sketch(odd_sketch.samples(b))).sum())
            assert bits <= odd_sketch.LIMIT
            errors.append(odd_sketch.estimated_similarity(bits) - j)
        assert abs(np.mean(errors)) < 0.02 and np.std(errors) < 0.04
    assert odd_sketch.estimated_similarity(odd_sketch.LIMIT) < 0.8


def test_query_equals_brute_force(spark):
    data = [tuple(r) for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text").collect()]
    assert rows(QUERIES["op11_near_dedup"](spark, SF_SMALL)) == brute(data)
