r"""Near-duplicate documents by MinHash bands, odd sketches and exact verification.

Words are runs of anything but ``[\x20\x09-\x0D]`` with A-Z lower-cased; a
document's set has the hashes of its distinct ``WORDS``-word shingles (fewer
words: the whole sequence as one, no words: empty and linked with nothing).
Documents with equal sets are one class by the set's 128-bit hash.

Each class has ``SAMPLES`` min-hashes. The first ``BANDS * ROWS`` make its bands;
classes that share a band are candidates (a pair at 0.85 shares none with
probability 4e-7). All samples are folded into an odd sketch: every (sample,
value) flips one of ``BITS`` bits, so that the population count of the XOR of two
sketches tells how many samples differ. Pairs whose count is over ``LIMIT``,
which a pair at the threshold exceeds with probability ``MISS``, are dropped; the
others are confirmed on their full sets.

No bucket is expanded into its pairs. First every class is checked against the
centre of each of its buckets, the member with the most popular bands (of a
group of near copies: their origin), and components are formed. Only buckets that
still hold several components go on: their members outside the bucket's
largest component meet one another and that component's members in blocks of
sketches, each pair in the first band it shares; blocks return the members with
a promising partner, and those meet again with their full sets, counted by
products of bounded matrices. A task returns links that span what it found.

Defined cases: null texts are empty; equal texts and repeated rows are linked;
ids may repeat, each row comes back; a null id never names a component, a
component without any id has a null component_id and all its rows are kept; ties
at the threshold are links; texts of any length are read whole; empty tables
give an empty result; extra columns are not read.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderlens.llm.common import ChunkCache, keeps, mix64, odd_constants, slices, written
from orderlens.llm.components import components
from orderlens.llm.sieve import Sieve

WORDS = 3
#: Links have PERCENT * union <= 100 * intersection.
PERCENT = 85
BANDS, ROWS = 25, 5
SAMPLES = 384
BITS = 512
MISS = 1e-6
#: Members of one block.
BLOCK = 512
#: Shingles of one block, on average.
BLOCK_SHINGLES = 1 << 19

_MULTIPLIERS = (odd_constants(SAMPLES, 1101) & np.uint64(0xFFFFFFFF)).astype(np.uint32)
_OFFSETS = (odd_constants(SAMPLES, 1202) >> np.uint64(16)).astype(np.uint32)
_SHINGLE = odd_constants(WORDS, 1303)
_BAND = odd_constants(ROWS, 1404)
_PLACE = np.arange(SAMPLES, dtype=np.uint64) << np.uint64(32)
_HASHES = ChunkCache(lambda word: xxhash.xxh64_intdigest(word).to_bytes(8, "little"), 100_000)
keeps("odd-words", _HASHES.forget)


def shingles(text: bytes | None) -> np.ndarray:
    """The sorted set of the text's shingle hashes."""
    words = np.frombuffer(b"".join(map(_HASHES.__getitem__, (text or b"").lower().split())), dtype="<u8")
    if not len(words):
        return np.zeros(0, dtype=np.uint64)
    width = min(len(words), WORDS)
    h = np.full(len(words) - width + 1, width, dtype=np.uint64)
    for k in range(width):
        h += mix64(words[k:len(words) - width + 1 + k] * _SHINGLE[k])
    return np.unique(mix64(h))


def samples(elements: np.ndarray) -> np.ndarray:
    """The min-hashes of a set."""
    low = np.full(SAMPLES, 0xFFFFFFFF, dtype=np.uint32)
    x = (elements >> np.uint64(32)).astype(np.uint32)
    for at in range(0, len(x), 256):
        part = x[at:at + 256, None] * _MULTIPLIERS
        part += _OFFSETS
        part ^= part >> np.uint32(15)
        np.minimum(low, part.min(axis=0), out=low)
    return low


def band_nodes(low: np.ndarray) -> np.ndarray:
    """One 64-bit bucket per band."""
    rows = low[:BANDS * ROWS].reshape(BANDS, ROWS).astype(np.uint64) + np.uint64(1)
    return mix64((rows * _BAND).sum(axis=1, dtype=np.uint64) + mix64(np.arange(1, BANDS + 1, dtype=np.uint64)))


def odd_sketch(low: np.ndarray) -> np.ndarray:
    """The parities of the bits that the samples fall on, as 64-bit words."""
    bit = mix64(_PLACE | low.astype(np.uint64)) % np.uint64(BITS)
    odd = (np.bincount(bit.astype(np.int64), minlength=BITS) & 1).astype(np.uint8)
    return np.packbits(odd, bitorder="little").view("<u8")


def estimated_similarity(different_bits: int) -> float:
    """The similarity that the population count of an XOR stands for."""
    left = max(1e-9, 1 - 2 * different_bits / BITS)
    return 1 + BITS * math.log(left) / 4 / SAMPLES


def most_bits(similarity: float, miss: float) -> int:
    """The least population count that a pair of this similarity exceeds with at most this probability."""
    p = 1 - similarity
    odd = np.zeros(BITS + 1)
    odd[0] = 1.0
    total = np.zeros(BITS + 1)
    k = np.arange(BITS + 1)
    for m in range(SAMPLES + 1):
        log = math.lgamma(SAMPLES + 1) - math.lgamma(m + 1) - math.lgamma(SAMPLES - m + 1) + m * math.log(p) + (SAMPLES - m) * math.log(1 - p)
        total += math.exp(log) * odd
        for _ in range(2):  # a differing sample flips one bit of each sketch
            step = np.zeros(BITS + 1)
            step[1:] += odd[:-1] * (BITS - k[:-1]) / BITS
            step[:-1] += odd[1:] * k[1:] / BITS
            odd = step
    over = np.cumsum(total[::-1])[::-1]
    return int(np.flatnonzero(over <= miss)[0]) - 1


LIMIT = most_bits(PERCENT / 100, MISS)


def _row_hash(id_col: str, text_col: str):
    return F.xxhash64(F.lit(11), id_col, text_col)


def _described(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(id, h, key, n, nodes, sketch) per document; an empty one has no key."""
    def run(batches):
        for batch in slices(batches, "odd-words"):
            sets = [shingles(t) for t in batch.column("text").to_pylist()]
            lows = [samples(x) if len(x) else None for x in sets]
            yield pa.RecordBatch.from_arrays([
                batch.column("id"), batch.column("h"),
                pa.array([xxhash.xxh3_128_digest(x.tobytes()) if len(x) else None for x in sets], pa.binary()),
                pa.array([len(x) for x in sets], pa.int64()),
                pa.array([None if s is None else band_nodes(s).view(np.int64) for s in lows], pa.list_(pa.int64())),
                pa.array([None if s is None else odd_sketch(s).view(np.int64) for s in lows], pa.list_(pa.int64()))],
                names=["id", "h", "key", "n", "nodes", "sketch"])

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(F.col(id_col).alias("id"), _row_hash(id_col, text_col).alias("h"), F.col(text_col).cast("binary").alias("text")).mapInArrow(
        run, f"id {kind}, h long, key binary, n long, nodes array<long>, sketch array<long>")


def _memberships(classes: DataFrame) -> DataFrame:
    """(node, key, members) for every bucket with two classes or more."""
    paths = classes.select("key", "nodes")
    shared = written(paths.select(F.explode("nodes").alias("node")).groupBy("node").agg(F.count(F.lit(1)).alias("members")).where("members > 1"),
                     "odd-buckets")
    sieve = Sieve.share(shared, "node")

    def run(batches):
        for batch in batches:
            nodes = batch.column("nodes").flatten().to_numpy().view(np.uint64)
            at = sieve.value.passes(nodes)
            yield pa.RecordBatch.from_arrays(
                [pa.array(nodes[at].view(np.int64)), batch.column("key").take(pa.array(at // BANDS))], names=["node", "key"])

    return written(paths.mapInArrow(run, "node long, key binary").join(shared.hint("merge"), "node"), "odd-memberships")


def _different_bits(a: str, b: str):
    return F.aggregate(F.zip_with(a, b, lambda x, y: F.bit_count(x.bitwiseXOR(y))), F.lit(0), lambda have, x: have + x)


def _sizes_fit(a: str, b: str):
    return F.least(a, b) * 100 >= F.greatest(a, b) * PERCENT


def _sets(docs: DataFrame, id_col: str, text_col: str, wanted: DataFrame) -> DataFrame:
    """The written (key, elements) of the classes with a (key, h) row in ``wanted``; only their texts leave the scan."""
    sieve = Sieve.share(wanted.select("h").distinct(), "h")

    def run(batches):
        for batch in slices(batches, "odd-words"):
            at = sieve.value.passes(batch.column("h").to_numpy().view(np.uint64))
            if not len(at):
                continue
            rows = batch.take(pa.array(at, pa.int64()))
            found = [shingles(t) for t in rows.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [rows.column("h"), pa.array([xxhash.xxh3_128_digest(x.tobytes()) for x in found], pa.binary()),
                 pa.array([x.tobytes() for x in found], pa.binary())], names=["h", "key", "elements"])

    texts = docs.select(_row_hash(id_col, text_col).alias("h"), F.col(text_col).cast("binary").alias("text"))
    found = texts.mapInArrow(run, "h long, key binary, elements binary")
    return written(found.join(wanted.select("key", F.col("h").alias("_h")).hint("merge"), "key").where("h = _h").select("key", "elements")
                   .dropDuplicates(["key"]), "odd-sets")


def _common(a: np.ndarray, b: np.ndarray) -> int:
    """Number of common elements of two sorted sets."""
    if len(a) > len(b):
        a, b = b, a
    return int((b[np.minimum(np.searchsorted(b, a), len(b) - 1)] == a).sum())


def _linked(common, size_a, size_b):
    return 100 * common >= PERCENT * (size_a + size_b - common)


def _against_centre(batches):
    """(u, v) links from the sorted (u, block, side, key, elements) rows: the centre first, then its block's members."""
    centre, elements = None, None
    for batch in batches:
        us, vs = [], []
        for u, block, side, key, data in zip(*(batch.column(c) for c in ("u", "block", "side", "key", "elements")), strict=True):
            x = np.frombuffer(data.as_buffer(), dtype="<u8")
            if side.as_py() == 0:
                centre, elements = (u.as_py(), block.as_py()), x.copy()
            elif centre == (u.as_py(), block.as_py()) and _linked(_common(elements, x), len(elements), len(x)):
                us.append(centre[0])
                vs.append(key.as_py())
        yield pa.RecordBatch.from_arrays([pa.array(us, pa.binary()), pa.array(vs, pa.binary())], names=["u", "v"])


def _centre_links(edges: DataFrame, sets: DataFrame) -> DataFrame:
    """The links among the (u, v) edges; a popular centre meets its members in several tasks."""
    blocks = edges.groupBy("u").agg(F.ceil(F.count(F.lit(1)) / BLOCK).cast("int").alias("blocks"))
    spread = edges.join(blocks, "u").select("u", "v", F.pmod(F.xxhash64("v"), "blocks").cast("int").alias("block"))
    members = spread.join(sets, spread["v"] == sets["key"]).select("u", "block", F.lit(1).alias("side"), "key", "elements")
    centres = blocks.select("u", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"))
    centres = centres.join(sets, centres["u"] == sets["key"]).select("u", "block", F.lit(0).alias("side"), "key", "elements")
    return centres.unionByName(members).repartition("u", "block").sortWithinPartitions("u", "block", "side").mapInArrow(
        _against_centre, "u binary, v binary")


def _block_rows(members: DataFrame) -> DataFrame:
    """(node, i, j, side, ...) per block pair of the open buckets' (node, key, root, n, ...) members.

    Members of the bucket's largest component meet the others only.
    """
    counts = members.groupBy("node", "root").agg(F.count(F.lit(1)).alias("c"), F.sum("n").alias("s"))
    bucket = counts.groupBy("node").agg(F.max(F.struct("c", "root", "s")).alias("big"), F.sum("c").alias("c"), F.sum("s").alias("s"))
    many = lambda rows, size: F.ceil(F.greatest(rows / BLOCK, size / BLOCK_SHINGLES)).cast("int")
    bucket = bucket.select("node", F.col("big.root").alias("major"), many(F.col("c") - F.col("big.c"), F.col("s") - F.col("big.s")).alias("few"),
                           many(F.col("big.c"), F.col("big.s")).alias("rest")).where("few > 0")
    rows = members.join(bucket, "node")
    at = F.when(F.expr("root <=> major"), F.col("few") + F.pmod(F.xxhash64(F.lit(7), "key"), "rest")).otherwise(F.pmod(F.xxhash64(F.lit(7), "key"), "few")).cast("int")
    rows = rows.withColumn("at", at)
    # blocks 0 .. few - 1 hold the other components, few .. few + rest - 1 the largest
    meets = F.expr("IF(at < few, sequence(0, few + rest - 1), sequence(0, few - 1))")
    return rows.withColumn("other", F.explode(meets)).select(
        "node", F.least("at", "other").alias("i"), F.greatest("at", "other").alias("j"), (F.col("at") > F.col("other")).alias("side"), *[
            c for c in members.columns if c != "node"])


def _grouped(batches, columns):
    """The sorted rows of each (node, i, j) as (node, i, j), lists of the columns."""
    at, rows = None, []
    for batch in batches:
        values = [batch.column(c).to_pylist() for c in ("node", "i", "j", *columns)]
        for node, i, j, *row in zip(*values, strict=True):
            if (node, i, j) != at:
                if rows:
                    yield at, list(zip(*rows, strict=True))
                at, rows = (node, i, j), []
            rows.append(row)
    if rows:
        yield at, list(zip(*rows, strict=True))


def _promising(batches):
    """(node, i, j, key, root) of the members with a partner in their block pair that the sketches can't rule out."""
    for (node, i, j), (side, key, root, n, nodes, sketch) in _grouped(batches, ("side", "key", "root", "n", "nodes", "sketch")):
        words = np.array(sketch, dtype=np.int64).view(np.uint64)
        bands, size, side = np.array(nodes, dtype=np.int64), np.array(n), np.array(side)
        _, component = np.unique(np.array(root, dtype=object), return_inverse=True)
        keep = np.zeros(len(key), dtype=bool)
        for at in range(0, len(key), 128):
            a = np.arange(at, min(at + 128, len(key)))
            bits = np.zeros((len(a), len(key)), dtype=np.uint16)
            for w in range(words.shape[1]):
                bits += np.bitwise_count(words[a, None, w] ^ words[None, :, w])
            may = (bits <= LIMIT) & (component[a, None] != component[None, :])
            may &= np.minimum(size[a, None], size[None, :]) * 100 >= np.maximum(size[a, None], size[None, :]) * PERCENT
            if i != j:
                may &= side[a, None] != side[None, :]
            p, q = np.nonzero(may)
            p = a[p]
            for some in np.array_split(np.arange(len(p)), 1 + len(p) // 50_000):
                first = (bands[p[some]] == bands[q[some]]).argmax(axis=1)
                here = bands[p[some], first] == node  # each pair in the first band it shares
                keep[p[some][here]] = keep[q[some][here]] = True
        some = np.flatnonzero(keep)
        if len(some):
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(some), node)), pa.array(np.full(len(some), i), pa.int32()), pa.array(np.full(len(some), j), pa.int32()),
                 pa.array([key[x] for x in some], pa.binary()), pa.array([root[x] for x in some], pa.binary())], names=["node", "i", "j", "key", "root"])


def _common_counts(elements: list[np.ndarray]) -> np.ndarray:
    """Numbers of common elements of every two sets, by products over the elements that several have."""
    owner = np.repeat(np.arange(len(elements)), [len(x) for x in elements])
    values = np.concatenate(elements)
    order = np.argsort(values, kind="stable")
    values, owner = values[order], owner[order]
    new = np.concatenate([[True], values[1:] != values[:-1]])
    number = np.cumsum(new) - 1
    several = np.bincount(number)[number] > 1
    owner, number = owner[several], number[several]
    out = np.zeros((len(elements), len(elements)), dtype=np.float32)
    number = np.unique(number, return_inverse=True)[1]
    for at in range(0, int(number.max(initial=-1)) + 1, 4096):
        lo, hi = np.searchsorted(number, [at, at + 4096])
        grid = np.zeros((len(elements), 4096), dtype=np.float32)
        grid[owner[lo:hi], number[lo:hi] - at] = 1
        out += grid @ grid.T
    return out.astype(np.int64)


def _spanning(batches):
    """(u, v) links that join what is linked within each block pair."""
    for _, (key, elements) in _grouped(batches, ("key", "elements")):
        sets = [np.frombuffer(x, dtype="<u8") for x in elements]
        size = np.array([len(x) for x in sets])
        linked = np.triu(_linked(_common_counts(sets), size[:, None], size[None, :]), 1)
        root = list(range(len(key)))

        def find(x, root=root):
            while root[x] != x:
                root[x] = root[root[x]]
                x = root[x]
            return x

        us, vs = [], []
        for a, b in zip(*np.nonzero(linked), strict=True):
            x, y = find(int(a)), find(int(b))
            if x != y:
                root[y] = x
                us.append(key[a])
                vs.append(key[b])
        if us:
            yield pa.RecordBatch.from_arrays([pa.array(us, pa.binary()), pa.array(vs, pa.binary())], names=["u", "v"])


def _links(docs: DataFrame, id_col: str, text_col: str, classes: DataFrame) -> DataFrame:
    """(u, v) links of classes whose components are those of all links."""
    member = _memberships(classes)
    popular = member.groupBy("key").agg(F.sum("members").alias("popular"))
    centre = written(member.join(popular, "key").groupBy("node").agg(F.max(F.struct("popular", "key"))["key"].alias("u")), "odd-centres")
    sized = classes.select("key", "n", "sketch", "h")
    side = lambda name: sized.select(F.col("key").alias(name), F.col("n").alias(f"n_{name}"), F.col("sketch").alias(f"sketch_{name}"), F.col("h").alias(f"h_{name}"))
    edges = member.join(centre, "node").where("key != u").select("u", F.col("key").alias("v")).distinct()
    edges = written(edges.join(side("v"), "v").join(side("u"), "u").where(_sizes_fit("n_u", "n_v") & (_different_bits("sketch_u", "sketch_v") <= LIMIT))
                    .select("u", "v", "h_u", "h_v"), "odd-edges")
    wanted = edges.select(F.col("u").alias("key"), F.col("h_u").alias("h")).unionByName(edges.select(F.col("v").alias("key"), F.col("h_v").alias("h"))).distinct()
    near = written(_centre_links(edges.select("u", "v"), _sets(docs, id_col, text_col, wanted)), "odd-links")

    roots = components(near, "odd-components").select(F.col("node").alias("key"), "root")
    left = member.where("members > 2").join(centre, "node").where("key != u").select("node", "key").join(roots, "key", "left").select(
        "node", "key", F.coalesce("root", "key").alias("root"))
    still = left.groupBy("node").agg(F.min("root").alias("a"), F.max("root").alias("b")).where("a != b").select("node")
    left = written(left.join(still, "node"), "odd-open")
    rows = _block_rows(left.join(classes.select("key", "n", "nodes", "sketch"), "key").select("node", "key", "root", "n", "nodes", "sketch"))
    rows = rows.repartition("node", "i", "j").sortWithinPartitions("node", "i", "j")
    some = written(rows.mapInArrow(_promising, "node long, i int, j int, key binary, root binary"), "odd-promising")
    wanted = some.select("key").distinct().join(sized.select("key", "h"), "key")
    full = some.select("node", "i", "j", "key").join(_sets(docs, id_col, text_col, wanted), "key")
    more = full.repartition("node", "i", "j").sortWithinPartitions("node", "i", "j").mapInArrow(_spanning, "u binary, v binary")
    return near.unionByName(written(more, "odd-links"))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: id, n_shingles, component_id (least id of its component), kept (it has that id)."""
    per = written(_described(docs, id_col, text_col), "odd-documents")
    distinct = written(per.where("key IS NOT NULL").groupBy("key").agg(
        F.min("id").alias("id"), F.first("n").alias("n"), F.first("nodes").alias("nodes"), F.first("sketch").alias("sketch"), F.min("h").alias("h")),
        "odd-classes")
    roots = components(_links(docs, id_col, text_col, distinct), "odd-components")
    named = distinct.select("key", "id").join(roots.withColumnRenamed("node", "key"), "key", "left").select(
        "key", "id", F.coalesce("root", "key").alias("root"))
    least = named.groupBy("root").agg(F.min("id").alias("component_id"))
    of_class = named.join(least, "root").select("key", "component_id")
    out = per.where("key IS NOT NULL").select("id", "n", "key").join(of_class, "key").select("id", "n", "component_id").unionByName(
        per.where("key IS NULL").select("id", "n", F.col("id").alias("component_id")))
    return out.select(F.col("id").alias(id_col), F.col("n").alias("n_shingles"), "component_id",
                      F.col("id").eqNullSafe(F.col("component_id")).alias("kept"))
