"""Suffix-array dedup: bytes covered by a long string seen earlier go.

Prefix doubling over sampled positions. Ranking every position of a corpus
shuffles some twenty times its bytes, so only anchors are ranked first: every
``length``-byte window names the ``length / 2``-byte string with the smallest
fingerprint in it (the leftmost of equals), and the windows that name one
position are a run. Equal windows name equal strings at equal offsets, so they
meet under the same anchor string, wherever they stand.

1. Rank at ``length / 2``: Spark counts the anchor strings. Positions whose
   string is unique drop out, with all windows of their run.
2. Rank past the threshold: the surviving anchors are ranked by the whole
   stretch that their run covers, in one aggregation with map-side partials
   that keeps the earliest position of each stretch. All others repeat it:
   their whole runs are decided.
3. Doubling: where stretches differ around the same anchor string, each window
   of the earliest ones is ranked at ``length`` by the pair of ranks at its
   start and at offset ``length / 2``. Spark sorts those rows by anchor string
   and place and a window that came before is a repeat; anchor strings with
   more than ``HOT`` stretches have their windows ranked one row each, with
   map-side partials, so no group has to fit in a task.

Survivors of a step are found by a bitmap of fixed size (at most ``MAX_BITS``)
sent to the tasks that read the texts; what it lets pass wrongly is sorted out
by the next step, so it bounds memory and never decides.

Ranks are 64- and 128-bit fingerprints of the strings.

Order is by id (nulls first), then place in the document; documents with one
id are ordered by a hash of their text, and rows with equal id and text are one
document (each comes back with the same result).

Defined cases: null texts are empty; texts shorter than ``length`` keep all;
long texts are read in slices, whole; empty tables give an empty result; extra
columns pass through (the four result columns must be new: ValueError).
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, LongType, StructField, StructType

from orderlens.llm.common import free_name, mix64, slices, written
from orderlens.llm.sieve import Sieve

LENGTH = 100
#: Stretches around one anchor string above which windows are ranked one row each.
HOT = 5_000
#: Window starts handled at once.
SLICE = 1 << 18

_BYTE = mix64(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
_BASE = 0x9E3779B97F4A7C15
_POWERS: list[np.ndarray] = []


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse modulo 2^64."""
    if not _POWERS or len(_POWERS[0]) < n:
        size = max(n, 1 << 16)
        _POWERS.clear()
        for base in (_BASE, pow(_BASE, -1, 1 << 64)):
            p = np.full(size, base, dtype=np.uint64)
            p[0] = 1
            _POWERS.append(np.cumprod(p))
    return _POWERS[0][:n], _POWERS[1][:n]


def _sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    w = 1
    while 2 * w <= width:
        x = np.minimum(x[:-w], x[w:])
        w *= 2
    return np.minimum(x[:len(x) - (width - w)], x[width - w:]) if w < width else x


def anchors(data: bytes, length: int):
    """Per slice of the text: arrays (anchor rank, stretch rank, first window start, last window start, anchor place)."""
    half = length // 2
    width = length - half + 1
    raw = np.frombuffer(data, dtype=np.uint8)
    for at in range(0, max(0, len(raw) - length + 1), SLICE):
        part = raw[at:at + SLICE + length - 1]
        n = len(part)
        power, inverse = _powers(n + 1)
        total = np.zeros(n + 1, dtype=np.uint64)
        np.cumsum(_BYTE[part] * power[:n], out=total[1:])
        rank = mix64((total[half:] - total[:-half]) * inverse[:n - half + 1])
        low = np.uint64((1 << 19) - 1)
        place = (_sliding_min((rank & ~low) | np.arange(len(rank), dtype=np.uint64), width) & low).astype(np.int64)
        first = np.flatnonzero(np.concatenate([[True], place[1:] != place[:-1]]))
        last = np.append(first[1:], len(place)) - 1
        anchor = place[first]
        end = last + length
        size = ((end - first) * 1024 + (anchor - first)).astype(np.uint64)
        stretch = mix64(mix64((total[end] - total[first]) * inverse[first]) + size)
        yield rank[anchor], stretch, first + at, last + at, anchor + at


_ANCHOR_COLUMNS = "rank long, stretch long, id {id}, tie long, first long, last long, bytes binary, hot boolean"


def _anchor_rows(texts: DataFrame, length: int, survivors, contested=None, hot=None) -> DataFrame:
    """Rows of the anchors that the survivors' sieve lets pass; with the stretch's bytes where the contested sieve does."""
    kind = texts.schema["id"].dataType.simpleString()

    def run(batches):
        alive = survivors.value
        open_ = contested.value if contested else None
        for batch in slices(batches, "bytes"):
            for i, text in enumerate(batch.column("text").to_pylist()):
                if not text:
                    continue
                data = text.encode("utf-8", "surrogatepass")
                for rank, stretch, first, last, _ in anchors(data, length):
                    keep = alive.passes(rank)
                    if not len(keep):
                        continue
                    rank, stretch, first, last = rank[keep], stretch[keep], first[keep], last[keep]
                    parts: list[bytes | None] = [None] * len(keep)
                    many = np.zeros(len(keep), dtype=bool)
                    if open_ is not None:
                        many[hot.value.passes(rank)] = True
                        for j in open_.passes(rank).tolist():
                            parts[j] = data[first[j]:last[j] + length]
                    same = pa.array([i] * len(keep), pa.int32())
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(rank.view(np.int64)), pa.array(stretch.view(np.int64)), batch.column("id").take(same), batch.column("tie").take(same),
                         pa.array(first), pa.array(last), pa.array(parts, pa.binary()), pa.array(many)],
                        names=["rank", "stretch", "id", "tie", "first", "last", "bytes", "hot"])

    return texts.mapInArrow(_joined(run), _ANCHOR_COLUMNS.format(id=kind))


#: Bytes of the batches that are put together.
JOINED_BYTES = 4 << 20


def _joined(run, size: int = JOINED_BYTES):
    """The same function with its many small batches put together."""
    def bigger(batches):
        held, n = [], 0
        for b in run(batches):
            held.append(b)
            n += b.nbytes
            if n >= size:
                yield from pa.Table.from_batches(held).combine_chunks().to_batches()
                held, n = [], 0
        if held:
            yield from pa.Table.from_batches(held).combine_chunks().to_batches()
    return bigger


def _repeated_ranks(texts: DataFrame, length: int) -> DataFrame:
    """Anchor strings that occur twice or more."""
    def run(batches):
        for batch in slices(batches, "bytes"):
            found = [rank for text in batch.column("text").to_pylist() if text
                     for rank, *_ in anchors(text.encode("utf-8", "surrogatepass"), length)]
            if found:
                rank, n = np.unique(np.concatenate(found), return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(rank.view(np.int64)), pa.array(n.astype(np.int64))], names=["rank", "n"])

    return (texts.select("text").mapInArrow(run, "rank long, n long").groupBy("rank").agg(F.sum("n").alias("n"))
            .where("n > 1").select("rank"))


def _window_repeats(rows: DataFrame, length: int) -> DataFrame:
    """Repeated windows of the contested stretches, group by group of one anchor string, as runs of window starts."""
    def run(batches):
        rank, seen, before = None, set(), None
        for batch in batches:
            out: dict[str, list] = {"i": [], "first": [], "last": []}
            columns = [batch.column(c).to_pylist() for c in ("rank", "id", "tie", "first", "bytes")]
            for i, (r, id_, tie, first, data) in enumerate(zip(*columns, strict=True)):
                if r != rank:
                    rank, seen, before = r, set(), None
                if (id_, tie, first) == before:  # the same document again
                    continue
                before = (id_, tie, first)
                start = None
                for k in range(len(data) - length + 1):
                    window = data[k:k + length]
                    if window in seen:
                        start = k if start is None else start
                    else:
                        seen.add(window)
                        if start is not None:
                            out["i"].append(i)
                            out["first"].append(first + start)
                            out["last"].append(first + k - 1)
                            start = None
                if start is not None:
                    out["i"].append(i)
                    out["first"].append(first + start)
                    out["last"].append(first + len(data) - length)
            at = pa.array(out["i"], pa.int32())
            yield pa.RecordBatch.from_arrays(
                [batch.column("id").take(at), batch.column("tie").take(at), pa.array(out["first"], pa.int64()), pa.array(out["last"], pa.int64())],
                names=["id", "tie", "first", "last"])

    kind = rows.schema["id"].dataType.simpleString()
    return (rows.select("rank", "id", "tie", "first", "bytes").repartition("rank").sortWithinPartitions("rank", "id", "tie", "first")
            .mapInArrow(run, f"id {kind}, tie long, first long, last long"))


def _hot_window_repeats(rows: DataFrame, length: int) -> DataFrame:
    """The same for anchor strings with very many stretches: a row per window, ranked by the pair of its halves' ranks."""
    half = length // 2

    def name(at, size):
        part = F.substring("bytes", at, size) if isinstance(at, int) else F.col("bytes").substr(at, F.lit(size))
        return F.xxhash64(part)

    windows = rows.select("id", "tie", "first", "bytes", F.explode(F.sequence(F.lit(0), F.octet_length("bytes") - length)).alias("k"))
    ranked = windows.select(
        F.struct(name(F.col("k") + 1, half).alias("a"), name(F.col("k") + 1 + half, length - half).alias("b")).alias("pair"),
        F.struct("id", "tie", (F.col("first") + F.col("k")).alias("at")).alias("place"))
    earliest = ranked.groupBy("pair").agg(F.min("place").alias("place0"), F.count(F.lit(1)).alias("n")).where("n > 1")
    return ranked.join(earliest, "pair").where("place != place0").select(
        "place.id", "place.tie", F.col("place.at").alias("first"), F.col("place.at").alias("last"))


def repeated_runs(docs: DataFrame, length: int = LENGTH, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, tie, first, last): runs of window starts whose window also starts earlier."""
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), _tie(text_col).alias("tie"))
    repeated = written(_repeated_ranks(texts, length), "anchor-ranks")
    survivors = Sieve.share(repeated, "rank")

    place = F.struct("id", "tie", "first")
    stretches = written(
        _anchor_rows(texts, length, survivors).groupBy("rank", "stretch")
        .agg(F.min(place).alias("place"), F.count(F.lit(1)).alias("n")), "stretches")
    differ = written(stretches.groupBy("rank").agg(F.count(F.lit(1)).alias("n")).where("n > 1"), "contested")
    contested = Sieve.share(differ, "rank")
    hot = Sieve.share(differ.where(F.col("n") > HOT), "rank")

    earliest = stretches.where("n > 1").select("rank", "stretch", "place")
    decided = written(
        _anchor_rows(texts, length, survivors, contested, hot).join(earliest, ["rank", "stretch"], "left")
        .withColumn("repeat", F.coalesce(F.col("place") != place, F.lit(False)))
        .where("repeat OR bytes IS NOT NULL")
        .select("rank", "id", "tie", "first", "last", "hot", "repeat", F.when(~F.col("repeat"), F.col("bytes")).alias("bytes")), "decided")

    open_ = decided.where("NOT repeat")
    return (decided.where("repeat").select("id", "tie", "first", "last")
            .unionByName(_window_repeats(open_.where("NOT hot"), length))
            .unionByName(_hot_window_repeats(open_.where("hot"), length)))


def _tie(text_col: str):
    return F.xxhash64(F.coalesce(F.col(text_col), F.lit("")))


def remove_repeats(
    docs: DataFrame,
    length: int = LENGTH,
    id_col: str = "doc_id",
    text_col: str = "text",
    out: tuple[str, str, str, str] = ("kept", "n_bytes", "n_removed", "n_spans"),
) -> DataFrame:
    """The documents with the bytes that stay (binary), the bytes they had, those removed, and the removed spans."""
    clash = {x.lower() for x in out} & {c.lower() for c in docs.columns}
    if clash:
        raise ValueError(f"the input has columns named {sorted(clash)}")
    tie, runs, of_id, of_tie = (free_name(docs.columns, x) for x in ("_tie", "_runs", "_of_id", "_of_tie"))
    per_doc = repeated_runs(docs, length, id_col, text_col).groupBy("id", "tie").agg(
        F.collect_list(F.struct("first", "last")).alias(runs)).withColumnsRenamed({"id": of_id, "tie": of_tie})
    joined = docs.withColumn(tie, _tie(text_col)).join(
        per_doc, F.col(id_col).eqNullSafe(F.col(of_id)) & (F.col(tie) == F.col(of_tie)), "left").select(*docs.columns, runs)
    schema = StructType([*docs.schema.fields, StructField(out[0], BinaryType()), *[StructField(x, LongType()) for x in out[1:]]])
    where = docs.columns.index(text_col)

    def run(batches):
        for batch in slices(batches, "bytes"):
            kept, sizes, removed, spans = [], [], [], []
            ranges = batch.column(batch.num_columns - 1)
            for text, found in zip(batch.column(where).to_pylist(), ranges, strict=True):
                data = (text or "").encode("utf-8", "surrogatepass")
                sizes.append(len(data))
                if not found.is_valid:
                    kept.append(data)
                    removed.append(0)
                    spans.append(0)
                    continue
                gone = np.zeros(len(data) + 1, dtype=np.int32)
                np.add.at(gone, found.values.field("first").to_numpy(), 1)
                np.add.at(gone, found.values.field("last").to_numpy() + length, -1)
                stay = np.cumsum(gone)[:-1] == 0
                kept.append(np.frombuffer(data, dtype=np.uint8)[stay].tobytes())
                removed.append(int(len(data) - stay.sum()))
                spans.append(int(np.count_nonzero(~stay[1:] & stay[:-1]) + (not stay[0])))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-1], pa.array(kept, pa.binary()), *[pa.array(x, pa.int64()) for x in (sizes, removed, spans)]], names=schema.names)

    return joined.mapInArrow(run, schema)
