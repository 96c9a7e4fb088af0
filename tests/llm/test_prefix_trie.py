import hashlib
import random
from collections import defaultdict

import numpy as np
import pytest

from orderlens.llm import prefix_trie
from orderlens.llm.queries import QUERIES, SQL
from tests.conftest import SF_SMALL
from tests.llm.conftest import rows

KIND = "conv_id long, turn long, role string, text string, depth string, node string"


def turn_id(role, text):
    role, text = role or "", text or ""
    return hashlib.md5(f"{len(role.encode())}:{role}{text}".encode()).hexdigest()


def conversations(turns):
    out = defaultdict(list)
    for conv, turn, role, text, *_ in turns:
        if conv is not None:
            out[conv].append((turn is not None, turn or 0, turn_id(role, text), (role or "", text or "")))
    return {c: tuple(t[3] for t in sorted(ts)) for c, ts in out.items()}


def brute(convs):
    members, ends = defaultdict(list), defaultdict(list)
    for c, path in convs.items():
        for d in range(len(path) + 1):
            members[path[:d]].append(c)
        ends[path].append(c)
    kids = defaultdict(int)
    leaves, saved = defaultdict(int), defaultdict(int)
    for node in members:
        if node:
            kids[node[:-1]] += 1
    for node, inside in members.items():
        for d in range(len(node) + 1):
            leaves[node[:d]] += not kids[node]
            saved[node[:d]] += (len(inside) - 1) * (len(node[-1][1].encode()) if node else 0)
    return sorted(((min(m), len(p), min(members[p[:-1]]) if p else None, len(m), kids[p], leaves[p], saved[p],
                    hashlib.sha256(",".join(map(str, sorted(ends[p]))).encode()).hexdigest()) for p, m in members.items()), key=repr)


def random_turns(seed, convs=60, words=2, longest=6):
    rng = random.Random(seed)
    return [(c * rng.choice([1, 1, -1]) if c % 7 == 0 else c, t, rng.choice(["u", "a"]), "é" * rng.randrange(words), "x", "y")
            for c in range(convs) for t in range(rng.randrange(1, longest))]


def trie(spark, turns, shard=prefix_trie.TURNS):
    return rows(prefix_trie.conversation_trie(spark.createDataFrame(turns, KIND), shard))


@pytest.mark.parametrize("seed,shard", [(1, 100_000), (2, 20), (3, 9), (4, 3)])
def test_random_conversations_equal_brute_force(spark, seed, shard):
    turns = random_turns(seed)
    assert trie(spark, turns, shard) == brute(conversations(turns))


@pytest.mark.parametrize("shard", [100_000, 40])
def test_long_shared_prefixes_need_several_matrices(spark, shard):
    turns = []
    for c, (same, own) in enumerate([(100, 0), (100, 3), (100, 0), (70, 40), (64, 1), (32, 0), (33, 9), (0, 50), (31, 2)]):
        turns += [(c, t, "u", f"common {t}", None, None) for t in range(same)]
        turns += [(c, same + t, "u", f"own {c} {t}", None, None) for t in range(own)]
    assert trie(spark, turns, shard) == brute(conversations(turns))


def test_one_conversation_much_longer_than_the_others(spark):
    turns = random_turns(5, 30) + [(500, t, "u", str(t), None, None) for t in range(20_000)]
    got = prefix_trie.conversation_trie(spark.createDataFrame(turns, KIND), 50)
    convs = conversations(turns)
    assert got.count() == 20_001 + len({p[:d] for c, p in convs.items() if c != 500 for d in range(1, len(p) + 1)} - {convs[500][:d] for d in range(9)})
    assert got.where("conv_id = 500 AND n_children = 0").count() == 1
    assert rows(got.where("depth < 4")) == [r for r in brute({c: p[:12] if c == 500 else p for c, p in convs.items()}) if r[1] < 4]


def test_odd_rows_equal_brute_force(spark):
    turns = [(1, None, None, None, None, None), (1, 0, "", "a", None, None), (1, 0, "", "b", None, None), (2, 0, None, "", None, None),
             (None, 0, "u", "nobody's", None, None), (3, 1, "u", "x" * 100_000, None, None), (4, 1, "u", "x" * 100_000, None, None),
             (5, 2, "u:1", "", None, None), (6, 2, "u", "1:", None, None)] + [(7, 3, "u", "again", None, None)] * 3
    for shard in (100_000, 2):
        assert trie(spark, turns, shard) == brute(conversations(turns))
    assert trie(spark, []) == []


def test_conversations_without_turns_are_in_the_root(spark):
    kind = "conv_id long, turns array<struct<id:string,size:long>>"
    one = [(turn_id("u", "hey"), 3)]
    got = rows(prefix_trie.prefix_trie(spark.createDataFrame([(4, []), (2, []), (9, one)], kind)))
    assert got == brute({4: (), 2: (), 9: (("u", "hey"),)})
    assert rows(prefix_trie.prefix_trie(spark.createDataFrame([(4, []), (2, [])], kind))) == brute({4: (), 2: ()})


def test_a_hot_class_is_hashed_in_pieces(spark):
    turns = [(c, 0, "u", "same", None, None) for c in range(3 * prefix_trie.PIECE + 5)] + [(-3, 0, "u", "other", None, None)]
    assert trie(spark, turns) == brute(conversations(turns))


def test_matrix_order_and_shared_turns():
    rng = np.random.default_rng(1)
    seqs = sorted({tuple(rng.integers(1, 3, rng.integers(0, 90))) for _ in range(300)} | {(1,) * k for k in range(80)})
    mixed = list(seqs)
    random.Random(2).shuffle(mixed)
    length = np.array([len(s) for s in mixed])
    flat = np.array([x for s in mixed for x in s], dtype=np.int64)
    order, shared = prefix_trie.sorted_matrix(flat, np.concatenate([[0], np.cumsum(length)])[:-1], length)
    assert [mixed[i] for i in order] == seqs
    for i in range(1, len(seqs)):
        a, b = seqs[i - 1], seqs[i]
        assert shared[i] == next((k for k in range(min(len(a), len(b))) if a[k] != b[k]), min(len(a), len(b)))


def test_query_equals_sql(spark):
    from tools.oracle_check import compare

    r = compare(spark, SF_SMALL, "op12", QUERIES["op12_prefix_trie"], SQL["op12_prefix_trie"])
    assert r["values_match"] and r["columns_match"], r
