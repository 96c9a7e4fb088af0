r"""N-gram Jaccard join by a MinHash LSH forest with exact verification.

Every text becomes the set of hashes of its five-word shingles (words are
``\w+`` of the lower-cased text; a text of one to four words is one shingle, a
text without words the empty set). Texts with equal sets are one class, joined
by the set's 128-bit hash; only classes go on.

Forest: each of ``TREES`` tries holds a label of ``DEPTH`` min-hashes per class,
as bytes. It is banding at a depth fixed in advance: the longest prefix by
which a pair at the threshold itself shares a node of some trie with at least
the target recall, 1 - (1 - t^depth)^trees, whatever the data; more similar
pairs are found with more, and min-hashes below that depth aren't read. Classes under one node are tied to the node's least class (a
star, not all pairs), and the connected stars are the candidate groups.

Verification is exact and covers all pairs of a group, so a link that the
tries missed within a group is found as well: groups are cut into blocks of
``BLOCK`` classes by hash and every two blocks meet in one task, which counts
common shingles by a sparse join in numpy and returns one row per class: its
links there and the least class it is linked with. Shingle sets are shipped
for the classes in groups of two or more only.

Links are kept per class, never expanded into pairs: ``n_links`` is the number
of other classes at the threshold or above, ``class_id`` the least id of the
connected component.

Defined cases: null texts are empty; empty texts (no words) are copies of one
another; ids may repeat (each row comes back), a null id gets its set's class
but can't name it: sets found under null ids alone are linked and counted like
others, and a class without any id has a null class_id; ties at the threshold count as links; empty tables give an empty
result; extra columns are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderlens.llm.common import free_name, mix64, odd_constants, slices, word_hashes, written
from orderlens.llm.components import components
from orderlens.llm.sieve import Sieve

WORDS = 5
THRESHOLD = 0.8
TREES = 24
DEPTH = 8
RECALL = 0.999
#: Classes of a candidate group that a task holds from each of two blocks.
BLOCK = 256

_MULTIPLIERS = (odd_constants(TREES * DEPTH, 101) & np.uint64(0xFFFFFFFF)).astype(np.uint32)
_OFFSETS = (odd_constants(TREES * DEPTH, 202) >> np.uint64(16)).astype(np.uint32)
_SHINGLE = odd_constants(WORDS, 303)


def shingles(text: str | None) -> np.ndarray:
    """The sorted set of the text's shingle hashes."""
    words = word_hashes(text)
    n = len(words)
    if not n:
        return np.zeros(0, dtype=np.uint64)
    width = min(n, WORDS)
    h = np.full(n - width + 1, width, dtype=np.uint64)
    for k in range(width):
        h += words[k:n - width + 1 + k] * _SHINGLE[k]
    return np.unique(mix64(h))


def set_key(elements: np.ndarray) -> bytes:
    return xxhash.xxh3_128_digest(elements.tobytes())


def labels(elements: np.ndarray) -> bytes:
    """The labels of all tries: 16 bits per min-hash, DEPTH min-hashes per trie."""
    low = np.full(TREES * DEPTH, 0xFFFFFFFF, dtype=np.uint32)
    x = (elements >> np.uint64(32)).astype(np.uint32)
    for at in range(0, len(x), 512):
        part = x[at:at + 512, None] * _MULTIPLIERS
        part += _OFFSETS
        part ^= part >> np.uint32(15)
        np.minimum(low, part.min(axis=0), out=low)
    mixed = (low * np.uint32(0x85EBCA6B)) >> np.uint32(16)
    return mixed.astype(">u2").tobytes()


def recall(threshold: float, depth: int, trees: int = TREES) -> float:
    """Probability that a pair of this similarity shares a node at this depth in some trie."""
    return 1 - (1 - threshold ** depth) ** trees


def matching_depth(threshold: float, target: float = RECALL) -> int:
    """The longest prefix that reaches the target recall at the threshold, shortened from the whole label."""
    depth = DEPTH
    while depth > 1 and recall(threshold, depth) < target:
        depth -= 1
    return depth


def _sets(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(id, key, labels, row) per document; row is a hash of id and text, of the text alone without an id."""
    def run(batches):
        for batch in slices(batches, "words"):
            found = [shingles(t) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([set_key(x) for x in found], pa.binary()),
                 pa.array([labels(x) if len(x) else None for x in found], pa.binary()), batch.column(2)], names=["id", "key", "labels", "row"])

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), _row_hash(id_col, text_col).alias("row")).mapInArrow(
        run, f"id {kind}, key binary, labels binary, row struct<a:long,b:long>")


def _row_hash(id_col: str, text_col: str):
    return F.struct(F.xxhash64(F.lit(1), id_col, text_col).alias("a"), F.xxhash64(F.lit(2), id_col, text_col).alias("b"))


def _stars(classes: DataFrame, depth: int) -> DataFrame:
    """Edges (u, v) from each class to the least class under each trie node that it shares."""
    tries = F.array(*[F.xxhash64(F.lit(t), F.substring("labels", 1 + 2 * DEPTH * t, 2 * depth)) for t in range(TREES)])
    paths = classes.where("labels IS NOT NULL").select("key", tries.alias("nodes"))
    shared = written(
        paths.select("key", F.explode("nodes").alias("node")).groupBy("node")
        .agg(F.min("key").alias("low"), F.count(F.lit(1)).alias("n")).where("n > 1").select("node", "low"), "trie-nodes")
    sieve = Sieve.share(shared, "node")

    def run(batches):
        for batch in batches:
            nodes = batch.column("nodes").flatten().to_numpy().view(np.uint64)
            at = sieve.value.passes(nodes)
            yield pa.RecordBatch.from_arrays(
                [batch.column("key").take(pa.array(at // TREES)), pa.array(nodes[at].view(np.int64))], names=["key", "node"])

    return paths.mapInArrow(run, "key binary, node long").join(shared.hint("merge"), "node").where("key != low").select(
        F.col("key").alias("u"), F.col("low").alias("v")).distinct()


def _common(elements: list[np.ndarray]) -> np.ndarray:
    """Numbers of common elements of every two sets."""
    n = len(elements)
    owner = np.repeat(np.arange(n), [len(x) for x in elements])
    values = np.concatenate(elements)
    order = np.argsort(values, kind="stable")
    values, owner = values[order], owner[order]
    start = np.flatnonzero(np.concatenate([[True], values[1:] != values[:-1]]))
    size = np.diff(np.append(start, len(values)))
    out = np.zeros((n, n), dtype=np.float32)
    column = np.repeat(np.arange(len(start)), size)
    shared = size[column] > 1
    owner, column = owner[shared], column[shared]
    if len(column):
        column = np.cumsum(np.concatenate([[0], np.diff(column) != 0]))
        for at in range(0, int(column[-1]) + 1, 4096):
            lo, hi = np.searchsorted(column, [at, at + 4096])
            grid = np.zeros((n, min(4096, int(column[-1]) + 1 - at)), dtype=np.float32)
            grid[owner[lo:hi], column[lo:hi] - at] = 1
            out += grid @ grid.T
    return out.astype(np.int64)


def _verify(keys: list[bytes], blocks: np.ndarray, elements: list[np.ndarray], threshold: float, across: bool):
    """(key, least linked key, links) of each set; ``across`` two blocks only pairs between them count."""
    size = np.array([len(x) for x in elements])
    common = _common(elements)
    union = size[:, None] + size[None, :] - common
    linked = common / np.maximum(union, 1) >= threshold
    np.fill_diagonal(linked, False)
    if across:
        linked &= blocks[:, None] != blocks[None, :]
    root = list(range(len(keys)))

    def find(i):
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    for i, j in zip(*np.nonzero(np.triu(linked)), strict=True):
        a, b = find(int(i)), find(int(j))
        if a != b:
            if keys[a] < keys[b]:
                root[b] = a
            else:
                root[a] = b
    return [(keys[i], keys[find(i)], int(n)) for i, n in enumerate(linked.sum(axis=1))]


def _links(sets: DataFrame, threshold: float) -> DataFrame:
    """(key, root, n) rows over the sorted (task, key, block, elements) rows of all block pairs."""
    def run(batches):
        task, keys, blocks, elements = None, [], [], []

        def done():
            rows = _verify(keys, np.array(blocks), elements, threshold, task[1] != task[2]) if len(keys) > 1 else [(keys[0], keys[0], 0)] if keys else []
            return pa.RecordBatch.from_arrays(
                [pa.array([r[0] for r in rows], pa.binary()), pa.array([r[1] for r in rows], pa.binary()),
                 pa.array([r[2] for r in rows], pa.int64())], names=["key", "root", "n"])

        for batch in batches:
            for group, i, j, key, block, data in zip(*(batch.column(c).to_pylist() for c in ("group", "i", "j", "key", "block", "elements")), strict=True):
                if (group, i, j) != task:
                    if keys:
                        yield done()
                    task, keys, blocks, elements = (group, i, j), [], [], []
                if keys and keys[-1] == key:  # a repeated row of the same document
                    continue
                keys.append(key)
                blocks.append(block)
                elements.append(np.frombuffer(data, dtype="<u8"))
        if keys:
            yield done()

    return sets.mapInArrow(run, "key binary, root binary, n long")


def _classes(docs: DataFrame, id_col: str, text_col: str, threshold: float, target_recall: float) -> DataFrame:
    """(id, row, root, set_id, class_id, n_links) per document; root is the least set key of the class."""
    per_doc = written(_sets(docs, id_col, text_col), "shingle-sets")
    classes = written(per_doc.groupBy("key").agg(F.min("id").alias("set_id"), F.first("labels").alias("labels"), F.min("row.a").alias("text_of")), "shingle-classes")
    stars = _stars(classes, matching_depth(threshold, target_recall))
    groups = components(stars, "candidates")

    sizes = groups.groupBy("root").agg(F.ceil(F.count(F.lit(1)) / BLOCK).cast("int").alias("blocks"))
    members = written(
        groups.join(sizes, "root").join(classes.select(F.col("key").alias("node"), "text_of"), "node")
        .select(F.col("node").alias("key"), F.col("root").alias("group"), "blocks", "text_of",
                F.pmod(F.xxhash64(F.lit(5), "node"), "blocks").cast("int").alias("block")), "members")

    wanted = Sieve.share(members, "text_of")

    def again(batches):
        seen: set[int] = set()
        for batch in slices(batches, "words"):
            h = batch.column("h").to_numpy().view(np.uint64)
            at = []
            for i in wanted.value.passes(h).tolist():
                if int(h[i]) not in seen:  # a task sends a repeated row once
                    seen.add(int(h[i]))
                    at.append(i)
            rows = batch.take(pa.array(at, pa.int64()))
            found = [shingles(t) for t in rows.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [pa.array([set_key(x) for x in found], pa.binary()), pa.array([x.tobytes() for x in found], pa.binary())], names=["key", "elements"])

    # only texts of members leave the scan; what the sieve lets pass besides has no partner in the join
    sets = (docs.select(_row_hash(id_col, text_col)["a"].alias("h"), F.col(text_col).alias("text"))
            .mapInArrow(again, "key binary, elements binary").join(members.hint("merge"), "key"))
    pairs = sets.select(
        "group", "key", "block", "elements",
        F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other"))
    meet = (pairs.select("group", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"), "key", "block", "elements")
            .repartition("group", "i", "j").sortWithinPartitions("group", "i", "j", "key"))
    links = written(_links(meet, threshold), "links")

    counts = links.groupBy("key").agg(F.sum("n").alias("n_links"))
    roots = components(links.where("key != root").select(F.col("key").alias("u"), F.col("root").alias("v")), "classes")
    named = (classes.select("key", "set_id").join(roots.withColumnRenamed("node", "key"), "key", "left")
             .select("key", "set_id", F.coalesce("root", "key").alias("root")))
    ids = named.groupBy("root").agg(F.min("set_id").alias("class_id"))
    of_class = named.join(ids, "root").join(counts, "key", "left").select(
        "key", "root", "set_id", "class_id", F.coalesce("n_links", F.lit(0)).alias("n_links"))
    return per_doc.select("id", "key", "row").join(of_class, "key").select("id", "row", "root", "set_id", "class_id", "n_links")


def jaccard_classes(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    threshold: float = THRESHOLD,
    target_recall: float = RECALL,
) -> DataFrame:
    """One row per document: its id, set_id (least id with the same shingles), class_id, n_links (classes at the threshold)."""
    return _classes(docs, id_col, text_col, threshold, target_recall).select(F.col("id").alias(id_col), "set_id", "class_id", "n_links")


def one_per_class(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD,
                  null_ids: bool = False) -> DataFrame:
    """The documents whose id is their class's id, columns as they were.

    Rows with equal id and text are one document and stay or go together. Rows
    with a null id stay, or with ``null_ids`` only one of each class that has
    no row with an id.
    """
    found = _classes(docs, id_col, text_col, threshold, RECALL)
    classes = found.select(F.col("id").alias(id_col), "class_id")
    gone = classes.where(F.col(id_col) != F.col("class_id")).select(id_col).distinct()
    kept = classes.where(F.col(id_col) == F.col("class_id")).select(id_col).distinct()
    # an id with texts of several classes goes only if none of them is its own class
    named = docs.join(gone.join(kept, id_col, "left_anti"), id_col, "left_anti").select(*docs.columns)
    if not null_ids:
        return named
    row = free_name(docs.columns, "_row")
    first = found.where("id IS NULL AND class_id IS NULL").groupBy("root").agg(F.min("row").alias(row)).select(row)
    nameless = docs.where(F.col(id_col).isNull()).withColumn(row, _row_hash(id_col, text_col)).join(first, row, "left_semi")
    return named.where(F.col(id_col).isNotNull()).unionByName(nameless.dropDuplicates([row]).select(*docs.columns))
