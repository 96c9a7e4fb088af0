from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from orderlens.llm.queries import QUERIES
from orderlens.llm.sharding import shuffled_shards, write_shards
from tests.conftest import SF_SMALL
from tests.llm.conftest import odd_rows, rows


def check_law(found, shards):
    """found: (shard, slot) of all rows."""
    counts = Counter(s for s, _ in found)
    sizes = [counts[s] for s in range(shards)]
    assert max(sizes) - min(sizes) <= 1 and sum(sizes) == len(found)
    for s in range(shards):
        assert sorted(x for t, x in found if t == s) == list(range(counts[s]))


@pytest.mark.parametrize("bucket_bytes", [1 << 30, 2000])
def test_odd_rows(odd, bucket_bytes):
    out = shuffled_shards(odd, 4, bucket_bytes=bucket_bytes).collect()
    check_law([(r.shard, r.slot) for r in out], 4)
    assert sorted(((r.doc_id, r.text, r.extra) for r in out), key=repr) == sorted(odd_rows(), key=repr)


def test_seed_decides_the_order(odd):
    at = lambda seed: [(r.shard, r.slot, r.doc_id) for r in shuffled_shards(odd, 2, seed=seed).orderBy("shard", "slot").collect()]
    assert at(1) == at(1) and at(1) != at(2)


def test_more_shards_than_rows_and_empty(odd, empty):
    check_law([(r.shard, r.slot) for r in shuffled_shards(odd, 50).collect()], 50)
    assert shuffled_shards(empty, 8).count() == 0
    with pytest.raises(ValueError):
        shuffled_shards(odd.withColumnRenamed("extra", "Shard"), 8)


def test_copies_are_spread(spark):
    from tests.llm.conftest import DOCS

    data = [(i, "same text" if i % 3 == 0 else f"text {i}", None) for i in range(3000)]
    out = shuffled_shards(spark.createDataFrame(data, DOCS), 8, bucket_bytes=20_000).where("text = 'same text'")
    counts = Counter(r.shard for r in out.collect())
    assert min(counts[s] for s in range(8)) > 80  # 125 each if spread evenly


def test_query_and_written_files(spark, scratch, documents):
    out = QUERIES["op6_sharding"](spark, SF_SMALL)
    assert "Python" not in out._jdf.queryExecution().toString()
    found = out.collect()
    check_law([(r.shard, r.slot) for r in found], 8)
    assert {r.law for r in found} == {"rows"} and all(r.grown_shard is None for r in found)
    write_shards(shuffled_shards(documents, 8), f"{scratch}/shards", rows_per_file=10)
    back = spark.read.parquet(f"{scratch}/shards")
    assert rows(back.select("doc_id", "text")) == rows(documents.select("doc_id", "text"))
    check_law([(r.shard, r.slot) for r in back.select("shard", "slot").collect()], 8)


def test_passes_against_a_plain_version(spark, odd):
    """Buckets end to end, each row in the shard and slot of its place; every bucket in an order of its own."""
    n, shards = 997, 8
    docs = spark.createDataFrame([(i, f"text {i % 300}", None) for i in range(n)], odd.schema)
    out = shuffled_shards(docs, shards, bucket_bytes=8_000).collect()
    place = lambda shard, slot: -(-shard * n // shards) + slot
    order = {place(r.shard, r.slot): r.doc_id for r in out}
    assert sorted(order) == list(range(n)) and sorted(order.values()) == list(range(n))
    assert all(g * shards // n == r.shard for r in out for g in [place(r.shard, r.slot)])
    ids = [order[g] for g in range(n)]
    # pass one by hand: the rows' hashed places give their buckets, which lie end to end
    buckets = -(-sum(len(r.text) + 64 for r in docs.collect()) // 8_000)
    placed = docs.select("doc_id", F.monotonically_increasing_id().alias("rid")).selectExpr("doc_id", f"pmod(xxhash64(42, rid), {buckets}L) AS bucket")
    members = defaultdict(set)
    for r in placed.collect():
        members[r.bucket].add(r.doc_id)
    at = 0
    for b in sorted(members):
        assert set(ids[at:at + len(members[b])]) == members[b]
        at += len(members[b])
    assert buckets > 5 and len(members) == buckets
    # a shuffled sequence rises at about half of its steps and leaves few rows where they were
    rises = sum(a < b for a, b in zip(ids, ids[1:], strict=False))
    assert 0.4 * n < rises < 0.6 * n and sum(i == g for g, i in enumerate(ids)) < 15
