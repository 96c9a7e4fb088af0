r"""Conversation prefix trie from sorted turn-id matrices.

A turn's id is the MD5 of its role and text (role length in front), a
conversation the sequence of its turns' ids as one binary value; equal
sequences are one class. Every distinct sequence of first turns is a node.

Shards: classes are range-partitioned by their sequences and written, so that
the rows below one node lie in neighbouring shards. In a shard the ids become
padded matrices of ``COLUMNS`` turns at a time; ``numpy.lexsort`` orders the
rows that are still tied, OR-accumulated column change masks give the length of
the prefix that neighbours share, which marks the row at which each node
starts, and ``reduceat`` aggregates every depth, deepest first. What is below
the last shared turn of a class is a chain and needs no matrix, so a matrix
has as many columns as neighbours share turns and a long conversation costs its
own length.

Boundary nodes: the first and last sequences of neighbouring shards tell which
nodes run across shards. Those give partial rows, which recombine by the hash
of their path; what a boundary node adds to its ancestors is summed up per shard
along the path of its last row. No shard has to hold more than its own
rows, and one row per shard is compared with its neighbour.

Ends: the ids of the conversations of one class are hashed in numeric order:
ranges of (class, id) write pieces of at most ``PIECE`` ids, one stream per class
hashes the pieces. So a class of a third of all conversations is never held in
memory.

Defined cases: null role and text are empty; a null turn comes first, equal
turns follow the order of their ids, repeated rows are repeated turns; rows
without a conversation id belong to no conversation and are not read;
conversations without turns are members of the root; an empty table has no
nodes; long conversations are whole (one conversation's ids, 24 bytes a turn,
must fit a task); extra columns are not read.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from orderlens.llm.common import written

#: Turns in a matrix.
COLUMNS = 32
#: Turns of distinct conversations in a shard, on average.
TURNS = 100_000
#: Conversation ids in a piece that is hashed at once.
PIECE = 4096
ID = 16
_NO_ENDS = hashlib.sha256(b"").hexdigest()

_NODE = pa.schema([
    ("conv_id", pa.int64()), ("depth", pa.int64()), ("parent_conv_id", pa.int64()), ("n_convs", pa.int64()),
    ("n_children", pa.int64()), ("n_leaves", pa.int64()), ("saved_tokens", pa.int64()), ("ends_sha256", pa.string()),
    ("size", pa.int64()), ("node", pa.binary()), ("parent", pa.binary()), ("shard", pa.int64()),
    ("starts", pa.bool_()), ("goes_on", pa.bool_())])
_NODE_DDL = ("conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, "
             "ends_sha256 string, size long, node binary, parent binary, shard long, starts boolean, goes_on boolean")
RESULT = ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")


def sequences(turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
              text_col: str = "text") -> DataFrame:
    """(conv_id, turns): every conversation's (id, size) per turn, in the order of its turns."""
    role, text = F.coalesce(F.col(role_col).cast("string"), F.lit("")), F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    ids = F.md5(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text))
    rows = turns.where(F.col(conv_col).isNotNull()).select(
        F.col(conv_col).cast("long").alias("conv_id"),
        F.struct(F.col(turn_col).alias("turn"), ids.alias("id"), F.octet_length(text).cast("long").alias("size")).alias("t"))
    return rows.groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("t")).select(
        "conv_id", F.transform("t", lambda t: F.struct(t["id"].alias("id"), t["size"].alias("size"))).alias("turns"))


def _pieces(batches):
    """(key, first, n, ids): runs of the sorted (key, conv_id) rows as text."""
    key, ids = None, []

    def piece():
        return key, ids[0], len(ids), ",".join(map(str, ids))

    for batch in batches:
        out = []
        for k, c in zip(batch.column("key").to_pylist(), batch.column("conv_id").to_pylist(), strict=True):
            if ids and (k != key or len(ids) >= PIECE):
                out.append(piece())
                ids = []
            key = k
            ids.append(c)
        if out:
            yield _piece_batch(out)
    if ids:
        yield _piece_batch([piece()])


def _piece_batch(rows):
    keys, first, n, ids = zip(*rows, strict=True)
    return pa.RecordBatch.from_arrays([pa.array(keys, pa.binary()), pa.array(first, pa.int64()), pa.array(n, pa.int64()), pa.array(ids, pa.string())],
                                      names=["key", "first", "n", "ids"])


def _ends(batches):
    """(key, conv_id, n, ends_sha256) from the sorted pieces, one hash at a time."""
    key, low, total, sha = None, 0, 0, None

    def rows_batch(rows):
        return pa.RecordBatch.from_arrays(
            [pa.array([r[0] for r in rows], pa.binary()), pa.array([r[1] for r in rows], pa.int64()),
             pa.array([r[2] for r in rows], pa.int64()), pa.array([r[3] for r in rows], pa.string())],
            names=["key", "conv_id", "n", "ends_sha256"])

    for batch in batches:
        out = []
        for k, first, n, ids in zip(*(batch.column(c).to_pylist() for c in ("key", "first", "n", "ids")), strict=True):
            if k != key:
                if sha is not None:
                    out.append((key, low, total, sha.hexdigest()))
                key, low, total, sha = k, first, 0, hashlib.sha256()
            elif total:
                sha.update(b",")
            sha.update(ids.encode())
            total += n
        if out:
            yield rows_batch(out)
    if sha is not None:
        yield rows_batch([(key, low, total, sha.hexdigest())])


def classes(convs: DataFrame) -> DataFrame:
    """(path, sizes, conv_id, n, ends_sha256) per distinct sequence of the (conv_id, turns) rows."""
    per = written(convs.select(
        "conv_id", F.unhex(F.array_join("turns.id", "")).alias("path"), F.col("turns.size").alias("sizes"),
    ).withColumn("key", F.unhex(F.md5("path"))), "trie-sequences")
    pieces = per.select("key", "conv_id").repartitionByRange("key", "conv_id").sortWithinPartitions("key", "conv_id").mapInArrow(
        _pieces, "key binary, first long, n long, ids string")
    ends = pieces.repartition("key").sortWithinPartitions("key", "first").mapInArrow(
        _ends, "key binary, conv_id long, n long, ends_sha256 string")
    distinct = per.groupBy("key").agg(F.min(F.struct("path", "sizes")).alias("c"))
    return distinct.join(ends, "key").select("c.path", "c.sizes", "conv_id", "n", "ends_sha256")


def shared_turns(a: bytes, b: bytes) -> int:
    """Number of first turns that two sequences have in common."""
    n = min(len(a), len(b)) // ID
    x = np.frombuffer(a, dtype=f"V{ID}", count=n)
    y = np.frombuffer(b, dtype=f"V{ID}", count=n)
    differ = np.flatnonzero(x != y)
    return int(differ[0]) if len(differ) else n


def _neighbours(batches):
    for batch in batches:
        low, high, before, after = (batch.column(c).to_pylist() for c in ("low", "high", "before", "after"))
        yield pa.RecordBatch.from_arrays(
            [batch.column("shard"),
             pa.array([-1 if b is None else shared_turns(x, b) for x, b in zip(low, before, strict=True)], pa.int64()),
             pa.array([-1 if b is None else shared_turns(x, b) for x, b in zip(high, after, strict=True)], pa.int64())],
            names=["shard", "left", "right"])


def sorted_matrix(codes: np.ndarray, offset: np.ndarray, length: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(order, shared): the rows in lexicographic order, and turns shared with the row before (-1 for the first).

    Rows are distinct sequences of codes from 1 on, in one flat array; padding
    is 0. Rows that no neighbour ties with any more leave the next matrix.
    """
    n = len(length)
    place = np.zeros(n, dtype=np.int64)  # of the first row of the tied group
    shared = np.full(n, -1, dtype=np.int64)
    rows, at = np.arange(n), 0
    while len(rows) > 1:
        columns = np.arange(at, at + COLUMNS)
        inside = columns[None, :] < length[rows, None]
        matrix = np.zeros(inside.shape, dtype=np.int64)
        matrix[inside] = codes[(offset[rows, None] + columns[None, :])[inside]]
        order = np.lexsort([*matrix.T[::-1], place[rows]])
        rows, matrix = rows[order], matrix[order]
        group = np.concatenate([[True], place[rows[1:]] != place[rows[:-1]]])
        change = np.concatenate([[[True] * COLUMNS], matrix[1:] != matrix[:-1]])
        change[:, 0] |= group
        np.logical_or.accumulate(change, axis=1, out=change)
        same = COLUMNS - change.sum(axis=1)
        first = np.flatnonzero(group)
        start = np.flatnonzero(change[:, -1])
        base = place[rows[first]] - first  # place of the group, by index among the rows
        size = np.diff(np.append(first, len(rows)))
        new = start + np.repeat(base, size)[start]
        inner = ~group[start]
        shared[new[inner]] = at + same[start[inner]]
        tied = np.diff(np.append(start, len(rows)))
        place[rows] = np.repeat(new, tied)
        rows = rows[np.repeat(tied > 1, tied)]
        at += COLUMNS
    order = np.empty(n, dtype=np.int64)
    order[place] = np.arange(n)
    return order, shared


class _Shard:
    """The nodes of one shard's classes; those that neighbours share as partial rows."""

    def __init__(self, shard: int, left: int, right: int, rows: list[tuple]):
        self.shard, self.left, self.right = shard, left, right
        path, sizes, conv, n, ends = zip(*rows, strict=True)
        length = np.array([len(p) // ID for p in path], dtype=np.int64)
        offset = np.concatenate([[0], np.cumsum(length)])[:-1]
        halves = np.frombuffer(b"".join(path), dtype=">u8").reshape(-1, 2).astype(np.uint64)
        order, self.shared = sorted_matrix(_codes(halves), offset, length)
        self.path = [path[i] for i in order]
        self.length, self.offset = length[order], offset[order]
        flat = np.concatenate([np.asarray(s, dtype=np.int64) for s in sizes]) if len(halves) else np.zeros(0, dtype=np.int64)
        self.flat, self.total = flat, np.concatenate([[0], np.cumsum(flat)])
        self.conv = np.array(conv, dtype=np.int64)[order]
        self.n = np.array(n, dtype=np.int64)[order]
        self.ends = np.array(ends, dtype=object)[order]

    def batches(self):
        count, length, shared = len(self.n), self.length, self.shared
        after = np.append(shared[1:], self.right)
        tied = np.maximum(shared, after)  # depth down to which a neighbour goes along
        tied[0] = max(tied[0], self.left)
        leaf = after < length
        #: contributions of the complete nodes that start at a row, from the present depth down
        below = (self.n - 1) * (self.total[self.offset + length] - self.total[self.offset + np.clip(tied, 0, None)])
        tail_parent = np.full(count, -1, dtype=np.int64)
        tail_split = np.zeros(count, dtype=bool)
        last = None  # the shared nodes one level down, which still need their parents
        for depth in range(int(tied.max(initial=-1)), -1, -1):
            rows = np.flatnonzero(tied >= depth)
            start = np.flatnonzero(shared[rows] < depth)
            top = rows[start]
            split = np.zeros(len(start), dtype=bool)
            split[0] |= top[0] == 0 and self.left >= depth
            goes_on = np.zeros(len(start), dtype=bool)
            goes_on[-1] = rows[-1] == count - 1 and self.right >= depth
            starts = ~split
            split |= goes_on
            members = np.add.reduceat(self.n[rows], start)
            conv = np.minimum.reduceat(self.conv[rows], start)
            child = (length[rows] > depth) & (shared[rows] <= depth)
            children = np.add.reduceat(child.astype(np.int64), start)
            from_left = top[0] == 0 and self.left > depth
            children[0] -= from_left
            if rows[-1] == count - 1 and self.right > depth:
                begin = np.flatnonzero(shared <= depth)[-1]
                children[-1] -= not (begin == 0 and from_left)
            leaves = np.add.reduceat(leaf[rows].astype(np.int64), start)
            size = self.flat[self.offset[top] + depth - 1] if depth else np.zeros(len(top), dtype=np.int64)
            below[top] += np.where(split, 0, (members - 1) * size)
            saved = np.add.reduceat(below[rows], start)
            ended = length[top] == depth
            ends = np.where(ended, self.ends[top], None if split.any() else _NO_ENDS)
            now = {"depth": depth, "top": top, "split": split, "starts": starts, "goes_on": goes_on, "conv": conv, "n": members,
                   "children": children, "leaves": leaves, "saved": saved, "size": size, "ends": ends}
            if last is not None:
                yield self._emit(last, now)
            # chains that leave a node of this depth
            begin = np.flatnonzero((tied == depth) & (length > depth))
            node = np.searchsorted(top, begin, side="right") - 1
            tail_parent[begin], tail_split[begin] = conv[node], split[node]
            last = now
        if last is not None:
            yield self._emit(last, None)
        yield from self._tails(tied, tail_parent, tail_split)

    def _node(self, row: int, depth: int) -> bytes:
        return hashlib.md5(self.path[row][:ID * depth]).digest()

    def _emit(self, at: dict, up: dict | None):
        depth, top, split = at["depth"], at["top"], at["split"]
        if up is None:
            parent, parent_split = np.full(len(top), -1), np.zeros(len(top), dtype=bool)
            no_parent = np.ones(len(top), dtype=bool)
        else:
            node = np.searchsorted(up["top"], top, side="right") - 1
            parent, parent_split, no_parent = up["conv"][node], up["split"][node], up["split"][node]
        ends = [None if s and e is None else e or _NO_ENDS for s, e in zip(split, at["ends"], strict=True)]
        return pa.RecordBatch.from_arrays([
            pa.array(at["conv"]), pa.array(np.full(len(top), depth)), pa.array(parent, pa.int64(), mask=no_parent),
            pa.array(at["n"]), pa.array(at["children"]), pa.array(at["leaves"]), pa.array(at["saved"]), pa.array(ends, pa.string()),
            pa.array(at["size"]),
            pa.array([self._node(int(t), depth) if s else None for t, s in zip(top, split, strict=True)], pa.binary()),
            pa.array([self._node(int(t), depth - 1) if s else None for t, s in zip(top, parent_split, strict=True)], pa.binary()),
            pa.array(np.full(len(top), self.shard)), pa.array(at["starts"]), pa.array(at["goes_on"])], schema=_NODE)

    def _tails(self, tied, tail_parent, tail_split):
        """The chains below the last turn that a neighbour shares, some rows at a time."""
        todo = np.flatnonzero(self.length > tied)
        for chunk in np.array_split(todo, 1 + int((self.length - tied)[todo].sum()) // 200_000) if len(todo) else ():
            if not len(chunk):
                continue
            many = (self.length - tied)[chunk]
            row = np.repeat(chunk, many)
            first = np.concatenate([[0], np.cumsum(many)])[:-1]
            depth = np.arange(len(row)) - np.repeat(first, many) + tied[row] + 1
            end = depth == self.length[row]
            saved = (self.n[row] - 1) * (self.total[self.offset[row] + self.length[row]] - self.total[self.offset[row] + np.clip(depth - 1, 0, None)])
            parent = self.conv[row].copy()
            parent[first] = tail_parent[chunk]
            unknown = np.zeros(len(row), dtype=bool)
            unknown[first] = tail_split[chunk] | (tied[chunk] < 0)
            above = np.full(len(row), None, dtype=object)
            for i in np.flatnonzero(tail_split[chunk]):
                above[first[i]] = self._node(int(chunk[i]), int(tied[chunk[i]]))
            k = len(row)
            yield pa.RecordBatch.from_arrays([
                pa.array(self.conv[row]), pa.array(depth), pa.array(parent, pa.int64(), mask=unknown), pa.array(self.n[row]),
                pa.array(1 - end.astype(np.int64)), pa.array(np.ones(k, dtype=np.int64)), pa.array(saved),
                pa.array(np.where(end, self.ends[row], _NO_ENDS), pa.string()), pa.array(np.zeros(k, dtype=np.int64)),
                pa.nulls(k, pa.binary()), pa.array(above, pa.binary()), pa.array(np.full(k, self.shard)),
                pa.array(np.ones(k, dtype=bool)), pa.array(np.zeros(k, dtype=bool))], schema=_NODE)


def _codes(halves: np.ndarray) -> np.ndarray:
    """Codes from 1 on in the order of the 16-byte ids."""
    if not len(halves):
        return np.zeros(0, dtype=np.int64)
    order = np.lexsort([halves[:, 1], halves[:, 0]])
    ranked = halves[order]
    new = np.concatenate([[True], (ranked[1:] != ranked[:-1]).any(axis=1)])
    codes = np.empty(len(halves), dtype=np.int64)
    codes[order] = np.cumsum(new)
    return codes


def _nodes(batches):
    at, rows = None, []
    for batch in batches:
        for shard, left, right, *row in zip(
                *(batch.column(c).to_pylist() for c in ("shard", "left", "right", "path", "sizes", "conv_id", "n", "ends_sha256")), strict=True):
            if at is not None and shard != at[0]:
                yield from _Shard(*at, rows).batches()
                rows = []
            at = (shard, left, right)
            rows.append(tuple(row))
    if rows:
        yield from _Shard(*at, rows).batches()


def _recombined(split: DataFrame) -> DataFrame:
    """The nodes that run across shards, whole: their partial rows and what their boundary descendants add."""
    whole = split.groupBy("node").agg(
        F.min("conv_id").alias("conv_id"), F.first("depth").alias("depth"), F.sum("n_convs").alias("n_convs"),
        F.sum("n_children").alias("inner"), F.sum("n_leaves").alias("n_leaves"), F.max("ends_sha256").alias("ends_sha256"),
        F.max("size").alias("size"), F.max("parent").alias("parent"))
    own = written(whole.withColumn("own", (F.col("n_convs") - 1) * F.col("size")), "trie-boundary")
    down = Window.partitionBy("shard").orderBy(F.desc("depth")).rangeBetween(Window.unboundedPreceding, Window.currentRow)
    parts = split.join(own.select("node", "own"), "node").withColumn("gained", F.sum(F.when(F.col("starts"), F.col("own")).otherwise(0)).over(down))
    saved = parts.groupBy("node").agg(F.sum(F.col("saved_tokens") + F.when(F.col("goes_on"), F.col("gained")).otherwise(0)).alias("saved_tokens"))
    kids = own.where("parent IS NOT NULL").groupBy(F.col("parent").alias("node")).agg(F.count(F.lit(1)).alias("kids"))
    return own.join(saved, "node").join(kids, "node", "left").select(
        "node", "parent", "conv_id", "depth", "n_convs", (F.col("inner") + F.coalesce("kids", F.lit(0))).alias("n_children"), "n_leaves",
        "saved_tokens", F.coalesce("ends_sha256", F.lit(_NO_ENDS)).alias("ends_sha256"))


def prefix_trie(convs: DataFrame, turns_per_shard: int = TURNS) -> DataFrame:
    """The nodes of the (conv_id, turns) conversations: smallest member, depth, parent, counts, savings and ends."""
    found = written(classes(convs), "trie-classes")
    turns = found.agg(F.sum(F.size("sizes"))).first()[0] or 0
    shards = 1 + turns // turns_per_shard
    placed = written(found.repartitionByRange(shards, "path").withColumn("shard", F.spark_partition_id().cast("long")), "trie-shards")
    order = Window.orderBy("shard")
    edges = placed.groupBy("shard").agg(F.min("path").alias("low"), F.max("path").alias("high")).select(
        "shard", "low", "high", F.lag("high").over(order).alias("before"), F.lead("low").over(order).alias("after"))
    edges = written(edges.mapInArrow(_neighbours, "shard long, left long, right long"), "trie-edges")
    rows = placed.join(edges, "shard").select("shard", "left", "right", "path", "sizes", "conv_id", "n", "ends_sha256")
    nodes = written(rows.repartition("shard").sortWithinPartitions("shard").mapInArrow(_nodes, _NODE_DDL), "trie-nodes")
    whole = written(_recombined(nodes.where("node IS NOT NULL")), "trie-split-nodes")
    known = whole.select(F.col("node").alias("_node"), F.col("conv_id").alias("_parent"))
    out = nodes.where("node IS NULL").select(*RESULT, "parent").unionByName(
        whole.withColumn("parent_conv_id", F.lit(None).cast("long")).select(*RESULT, "parent"))
    return out.join(known, F.col("parent") == F.col("_node"), "left").withColumn(
        "parent_conv_id", F.coalesce("parent_conv_id", "_parent")).select(*RESULT)


def conversation_trie(turns: DataFrame, turns_per_shard: int = TURNS, **columns: str) -> DataFrame:
    """The trie of conversations as they stand in a table of turns."""
    return prefix_trie(sequences(turns, **columns), turns_per_shard)
