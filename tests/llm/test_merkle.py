import hashlib
import zlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from orderlens.llm import merkle
from orderlens.llm.queries import QUERIES, SQL
from tests.conftest import SF_SMALL
from tests.llm.conftest import prose, rows

KIND = "doc_id long, source string, lang string, n_chars long, text string, digest string, g string, path string"
UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def H(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf_of(row):
    return H(*("-" if v is None else f"{len(str(v).encode())}:{v}" for v in row[:5]))


def runs_up(digests):
    """The levels of a tree, the leaves first."""
    levels = [digests]
    while len(levels[-1]) > 1:
        levels.append([H(*levels[-1][i:i + 8]) for i in range(0, len(levels[-1]), 8)])
    return levels


def siblings(levels, at):
    out = []
    for level in levels[:-1]:
        run = level[at // 8 * 8:at // 8 * 8 + 8]
        out.append((run[:at % 8], run[at % 8 + 1:]))
        at //= 8
    return out


def brute(data, tampered):
    groups = defaultdict(list)
    for row in data:
        groups[row[2]].append(row)
    order = sorted(groups, key=lambda x: (x is not None, (x or "").encode()))
    trees = []
    for lang in order:
        groups[lang].sort(key=lambda r: (r[0] is not None, r[0] or 0, leaf_of(r)))
        trees.append(runs_up([leaf_of(r) for r in groups[lang]]))
    top = runs_up([t[-1][0] for t in trees])
    out = []
    for g, lang in enumerate(order):
        for at, row in enumerate(groups[lang]):
            path = siblings(trees[g], at) + siblings(top, g)
            now = leaf_of((*row[:4], row[4].translate(UPPER))) if tampered(row[0]) and row[4] is not None else leaf_of(row)
            for left, right in path:
                now = H(*left, now, *right)
            out.append((row[0], leaf_of(row), trees[g][-1][0], top[-1][0], H(*(x for left, right in path for x in (*left, *right))), now, now == top[-1][0]))
    return sorted(out, key=repr)


def third(i):
    return i is not None and zlib.crc32(str(i).encode()) % 3 == 0


def check(spark, data):
    df = spark.createDataFrame(data, KIND)
    tampered = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 0
    assert rows(merkle.verified_manifest(df, tampered)) == brute(data, third)


def some(i, lang, text="Some Text"):
    return (i, f"s{i}" if i is None or i % 3 else None, lang, None if i is None else i * 7, text, "taken", "taken", "taken")


def test_groups_of_all_sizes_equal_brute_force(spark):
    data = []
    for g, size in enumerate([1, 2, 7, 8, 9, 64, 65, 73]):
        data += [some(1000 * g + i * 3 % size, f"l{g}", prose(i, 5).title()) for i in range(size)]
    check(spark, data)


def test_odd_rows_equal_brute_force(spark):
    data = [some(None, None, None), some(None, None, "A"), some(5, None, ""), some(5, None, "B"), some(5, None, "B"), some(6, "", None),
            some(7, "ä", "Ünï 中文 \U0001f600"), some(8, "z", prose(1, 50_000)), (9, None, None, None, None, None, None, None)]
    check(spark, data + [some(11, "r", "Same")] * 20)


def test_many_groups_of_one(spark):
    check(spark, [some(i, f"group {i}") for i in range(70)])


def test_one_row_and_no_row(spark):
    check(spark, [some(1, "x")])
    check(spark, [])


def test_requested_leaves_only(spark):
    df = spark.createDataFrame([some(i, f"l{i % 2}") for i in range(150)], KIND)
    tree = merkle.build(df.select(F.col("doc_id").alias("id"), F.col("lang").alias("grp"), merkle.digest(merkle.field_text(F.col("doc_id"))).alias("digest")), "id", "grp")
    all_ = {r.id: r for r in tree.proofs().collect()}
    found = tree.proofs(tree.leaves.where("id IN (0, 17, 149)")).collect()
    assert sorted(r.id for r in found) == [0, 17, 149] and all(all_[r.id].path == r.path for r in found)
    assert tree.records().count() == len({tuple(r.children) for r in tree.records().collect()})


@pytest.mark.parametrize("sf", [SF_SMALL])
def test_query_equals_sql(spark, sf):
    from tools.oracle_check import compare

    r = compare(spark, sf, "op13", QUERIES["op13_merkle_manifest"], SQL["op13_merkle_manifest"])
    assert r["values_match"] and r["columns_match"], r
