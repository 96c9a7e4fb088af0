import math
import random
import re
from itertools import combinations

import numpy as np
import pytest

from orderlens.llm import decontaminate as dc
from orderlens.llm.common import word_hashes
from orderlens.llm.queries import QUERIES
from tests.conftest import SF_SMALL
from tests.llm.conftest import DOCS, rows


def words(text):
    return re.findall(r"\w+", (text or "").lower())


def best_overlap(doc, item):
    """Over all alignments and all stretches: the longest with enough equal words, equal at both ends."""
    best = 0
    for shift in range(-len(item) + 1, len(doc)):
        a, b = max(0, -shift), min(len(item), len(doc) - shift)
        same = [doc[i + shift] == item[i] for i in range(a, b)]
        total = np.concatenate([[0], np.cumsum(same)])
        for i in range(len(same)):
            if same[i]:
                for j in range(len(same), i + best, -1):
                    if same[j - 1] and total[j] - total[i] >= dc.IDENTITY * (j - i) - 1e-9:
                        best = max(best, j - i)
                        break
    return best


def test_aligned_overlap_against_all_stretches():
    rng = random.Random(1)
    for _ in range(300):
        doc = [rng.choice("abc") for _ in range(rng.randint(1, 30))]
        item = [rng.choice("abc") for _ in range(rng.randint(1, 20))]
        as_array = lambda x: np.array([ord(c) for c in x], dtype=np.uint64)
        got = max(dc.aligned_overlap(as_array(doc), as_array(item), s)[1] for s in range(-len(item) + 1, len(doc)))
        assert got == best_overlap(doc, item)


def test_query_equals_brute_force(spark, documents):
    got = {(r.doc_id, r.item_id): r.words for r in QUERIES["op2_decontamination"](spark, SF_SMALL).collect()}
    items = {r.item_id: words(r.text) for r in spark.read.parquet(f"{SF_SMALL}/benchmark.parquet").collect()}
    grams = {}
    for i, x in items.items():
        for k in range(len(x) - 1):
            grams.setdefault((x[k], x[k + 1]), set()).add(i)
    want = {}
    for r in documents.collect():
        doc = words(r.text)
        # a stretch of 13 words with 4 equal of 5 holds two equal neighbours several times
        count = {}
        for pair in zip(doc, doc[1:], strict=False):
            for i in grams.get(pair, ()):
                count[i] = count.get(i, 0) + 1
        for i, n in count.items():
            if n >= 7:
                found = best_overlap(doc, items[i])
                if found >= min(dc.MIN_WORDS, len(items[i])):
                    want[r.doc_id, i] = found
    assert got == want and want


def test_substitutions_are_tolerated(spark):
    rng = random.Random(2)
    item = [f"item{k}" for k in range(40)]
    data, planted = [], set()
    for n in range(60):
        copy = list(item)
        if n % 3 == 0:  # one word in eight replaced
            for k in range(rng.randrange(8), 40, 8):
                copy[k] = f"other{rng.randrange(999)}"
            planted.add(n)
        elif n % 3 == 1:  # every second word replaced
            copy = [w if k % 2 else f"x{rng.randrange(999)}" for k, w in enumerate(copy)]
        else:  # a short quotation only
            copy = copy[:dc.MIN_WORDS - 1]
        data.append((n, " ".join([*(f"a{rng.randrange(500)}" for _ in range(50)), *copy, *(f"b{rng.randrange(500)}" for _ in range(50))]), None))
    docs = spark.createDataFrame(data, DOCS)
    bench = spark.createDataFrame([(7, " ".join(item)), (9, " ".join(item)), (1, "too short to count"), (None, None)], "item_id long, text string")
    found = dc.overlaps(docs, bench).collect()
    assert {r.doc_id for r in found} == planted and {r.item_id for r in found} == {7}
    assert all(r.doc_start - r.item_start == 50 for r in found)
    kept = dc.decontaminated(docs, bench)
    assert {r.doc_id for r in kept.collect()} == set(range(60)) - planted and kept.columns == docs.columns


def test_odd_rows(spark, odd, empty):
    text = next(r.text for r in odd.collect() if r.doc_id == 6)
    bench = spark.createDataFrame([(1, text), (2, ""), (3, None)], "item_id long, text string")
    docs = odd.withColumnRenamed("extra", "_hit")
    assert rows(dc.overlaps(docs, bench).select("doc_id", "item_id")) == [(6, 1)]
    kept = dc.decontaminated(docs, bench)
    assert rows(kept) == [r for r in rows(docs) if r[1] != text]
    assert rows(dc.decontaminated(docs, bench.limit(0))) == rows(docs)
    assert dc.overlaps(empty, bench).count() == 0


def test_seed_reads_only_its_mask():
    x = word_hashes("a b c d e f g h i j k l")
    for mask, mine in zip(dc.MASKS, dc.seeds(x), strict=True):
        y = x.copy()
        for k, bit in enumerate(mask):
            if bit == "0":
                y[k] += np.uint64(1)
        other = dc.seeds(y)[dc.MASKS.index(mask)]
        assert mine[0] == other[0]
        y[0] += np.uint64(1)
        assert mine[0] != dc.seeds(y)[dc.MASKS.index(mask)][0]


def allowed_substitutions(n):
    """Sets of places in an item of n words that may differ: as many as the identity allows, not at the ends."""
    return list(combinations(range(1, n - 1), n - math.ceil(dc.IDENTITY * n - 1e-9)))


def seeds_hit(words_, copy, n):
    mine, other = (dc.seeds(x) if n >= dc.MIN_WORDS else dc.short_seeds(x, n) for x in (words_, copy))
    return any((a == b).any() for a, b in zip(mine, other, strict=True))


@pytest.mark.parametrize("n", range(1, 17))
def test_recall_over_all_allowed_substitutions(n):
    item = word_hashes(" ".join(f"w{k}" for k in range(n)))
    tried = found = 0
    for places in allowed_substitutions(n):
        copy = item.copy()
        copy[list(places)] += np.uint64(1)
        tried += 1
        found += seeds_hit(item, copy, n)
    assert tried and found >= (1 if n <= 14 else 0.98) * tried, (found, tried)


def test_short_items_with_substitutions_are_found(spark):
    rng = random.Random(8)
    filler = lambda: " ".join(f"f{rng.randrange(900)}" for _ in range(12))
    items, data, planted, clean = [], [], {}, set()
    for n in range(1, 13):
        item = [f"item{n}x{k}" for k in range(n)]
        items.append((n, " ".join(item)))
        for places in allowed_substitutions(n):
            copy = [f"o{rng.randrange(999)}" if k in places else w for k, w in enumerate(item)]
            # the same seeds before it, in a window that lies one substitution too far
            worse = [f"o{rng.randrange(999)}" if k in places or k == n - 1 else w for k, w in enumerate(item)]
            planted[len(data)] = n
            data.append((len(data), " ".join([filler(), *worse, filler(), *copy, filler()]), None))
            clean.add(len(data))
            data.append((len(data), " ".join([filler(), *worse, filler()]), None))
    docs = spark.createDataFrame(data, DOCS)
    got = dc.overlaps(docs, spark.createDataFrame(items, "item_id long, text string")).collect()
    assert {r.doc_id: r.item_id for r in got} == planted and len(got) == len(planted)
    assert all(r.words == r.item_id and r.equal_words >= dc.IDENTITY * r.words - 1e-9 for r in got)
    assert clean.isdisjoint(r.doc_id for r in got)
