import random
import re
from itertools import combinations

import pytest

from orderlens.llm import ngram_join as nj
from orderlens.llm.components import components
from orderlens.llm.queries import QUERIES
from tests.conftest import SF_SMALL
from tests.llm.conftest import DOCS, odd_rows, rows


def shingle_set(text):
    w = re.findall(r"\w+", (text or "").lower())
    n = min(5, len(w))
    return frozenset(tuple(w[k:k + n]) for k in range(len(w) - n + 1)) if n else frozenset()


def brute(data, threshold):
    """id -> (set_id, class_id, n_links) over rows with distinct ids."""
    sets = {r[0]: shingle_set(r[1]) for r in data}
    first = {}
    for i in sorted(sets):
        first.setdefault(sets[i], i)
    links = {i: set() for i in first.values()}
    for (a, i), (b, j) in combinations(first.items(), 2):
        if a and b and len(a & b) / len(a | b) >= threshold:
            links[i].add(j)
            links[j].add(i)
    root = {}
    for i in sorted(links):
        todo = [i]
        while todo:
            x = todo.pop()
            if x not in root:
                root[x] = i
                todo += links[x]
    return {i: (first[s], root[first[s]], len(links[first[s]])) for i, s in sets.items()}


def classes(df, **kw):
    return {r.doc_id: (r.set_id, r.class_id, r.n_links) for r in nj.jaccard_classes(df, **kw).collect()}


def near_copies(seed):
    """Groups of copies with a few words changed, some in chains, and exact copies."""
    rng = random.Random(seed)
    data = []
    for g in range(12):
        base = [f"g{g}w{rng.randrange(300)}" for _ in range(rng.randint(30, 160))]
        for _ in range(rng.randint(1, 12)):
            copy = list(base)
            for _ in range(rng.choice([0, 0, 1, 1, 2, 3, 5])):
                copy[rng.randrange(len(copy))] = f"e{rng.randrange(10**6)}"
            data.append((len(data) * 7 % 500, " ".join(copy), None))
            if rng.random() < 0.3:
                base = copy
    return data


@pytest.mark.parametrize(("seed", "block"), [(1, 256), (2, 3)])
def test_near_copies_against_all_pairs(spark, monkeypatch, seed, block):
    monkeypatch.setattr(nj, "BLOCK", block)
    data = near_copies(seed)
    want = brute(data, 0.8)
    assert sum(n for *_, n in want.values()) > 40
    assert classes(spark.createDataFrame(data, DOCS)) == want


def test_query_equals_brute_force(spark, documents):
    want = brute([(r.doc_id, r.text) for r in documents.collect()], 0.8)
    got = {r.doc_id: (r.set_id, r.class_id, r.n_links) for r in QUERIES["op3_ngram_join"](spark, SF_SMALL).collect()}
    assert got == want


def test_recall_of_the_prefix():
    depth = nj.matching_depth(0.8)
    assert nj.recall(0.8, depth) >= nj.RECALL > nj.recall(0.8, depth + 1) and depth < nj.DEPTH
    # measured: pairs of sets with similarity 0.8 that share a node
    import numpy as np

    rng = np.random.default_rng(1)
    hit = 0
    for _ in range(400):
        x = rng.integers(0, 1 << 63, 180).astype(np.uint64)
        a, b = nj.labels(np.sort(x[:160])), nj.labels(np.sort(np.concatenate([x[:144], x[164:180]])))
        # 144 common of 176: similarity 0.818
        hit += any(a[16 * t:16 * t + 2 * depth] == b[16 * t:16 * t + 2 * depth] for t in range(nj.TREES))
    assert hit >= 398


def test_odd_rows(spark, odd, empty):
    found = nj.jaccard_classes(odd.withColumnRenamed("extra", "key")).collect()
    assert len(found) == len(odd_rows())
    by_id = {}
    for r in found:
        by_id.setdefault(r.doc_id, set()).add((r.set_id, r.class_id))
    assert by_id[5] == {(1, 1)} and by_id[1] == {(1, 1)}  # equal texts
    assert by_id[2] == by_id[3] == by_id[8] == {(2, 2)}  # no words
    assert by_id[None] == {(None, None), (2, 2)}  # a text under a null id alone; the empty one
    assert by_id[6] == {(6, 6)}
    kept = nj.one_per_class(odd)
    assert kept.columns == odd.columns
    assert sorted((r.doc_id or 0) for r in kept.collect()) == [0, 0, 1, 2, 6, 6, 7, 9, 10]
    assert nj.jaccard_classes(empty).count() == 0 and nj.one_per_class(empty).count() == 0


def test_one_of_each_class_stays(spark):
    data = near_copies(3)
    want = {c for _, c, _ in brute(data, 0.8).values()}
    assert {r.doc_id for r in nj.one_per_class(spark.createDataFrame(data, DOCS)).collect()} == want


def test_components_of_a_long_path(spark):
    edges = [(i, i + 1) for i in range(60)] + [(100, 101), (102, 101), (200, 200)]
    got = rows(components(spark.createDataFrame(edges, "u long, v long")))
    assert got == sorted([(i, 0) for i in range(61)] + [(i, 100) for i in (100, 101, 102)], key=repr)
