"""Best-fit packing of tokenised documents into sequences of fixed capacity.

Spark tokenises every document into pieces of at most ``capacity`` tokens
(only longer documents are cut) and writes them as narrow rows. Pieces are
dealt at random into groups of a bounded number of rows; each group is packed
by itself by bin completion. Full sequences are final; the pieces of the
others meet again in the next, smaller round, until one bounded group is left.
Once a round fills little, only the least filled sequences meet again: those at
most half full, of which best fit leaves one a group, and as many of the next
fuller ones as one group has room for. So no task ever holds more than about
``GROUP_ROWS`` pieces (small groups may grow to the pieces of two sequences),
and what the groups waste is packed together at the end.

Bin completion (one group): the best-fit-decreasing solution is the first
incumbent. While it has more sequences than the total length demands, a
depth-first search takes the largest piece left, enumerates the undominated
fillings of the space beside it and prunes a branch once its waste exceeds
what one sequence fewer than the incumbent could leave over. A filling is
dominated if a piece left out can stand for one or two of its pieces that take
no more space; a single piece that fills the space exactly dominates all
others. A first search tries the ``WIDTH`` fullest fillings that begin with the
largest pieces, a second one all undominated fillings: it is complete. Both
share a node budget per group; without a better solution the incumbent stands.

Defined cases: a null or empty text is a document of its end id alone (one
piece of length 1); a very long text gives as many pieces as it needs;
repeated rows and null ids are packed like any others, piece by piece; an
empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import json
import math
import unicodedata
import zlib
from bisect import bisect_left, bisect_right, insort
from collections import Counter, defaultdict
from collections.abc import Iterator
from itertools import accumulate

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, IntegerType, LongType, StructField, StructType

from orderlens.llm.common import ChunkCache, keeps, slices, written

CAPACITY = 4096
#: Most pieces that one task packs together.
GROUP_ROWS = 20_000
#: Search nodes of bin completion per piece of a group.
NODES_PER_PIECE = 4
#: Fillings that the first search tries beside one largest piece.
WIDTH = 6

#: Characters that Python splits at and the tokenizers do not.
_SEPARATORS = ("\x1c", "\x1d", "\x1e", "\x1f")


class TokenIds:
    """Token ids of whole texts, little-endian unsigned 32-bit.

    A tokenizer that drops white space encodes each chunk between white space
    on its own. Where its file says that it lower-cases, cuts chunks by one
    pattern and maps bytes, a chunk is cut here by that pattern and each
    distinct piece goes through the tokenizer's model once per worker; a probe
    text must give equal ids both ways, else every chunk is encoded as it is.
    """

    PROBE = "Ab's, 12\u00b2 \u00dcber-e\u0301t\u00e9... ''S don't \u4e2d\u6587 \u0130x $%& we'LL\u03a3 a_b \U0001f600"

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        self.pattern = self._pattern(path)
        self.cache = ChunkCache(self._pieces if self.pattern else self.encode)
        self.ids = ChunkCache(self._model)
        if self.pattern:
            # printable bytes stand for themselves, the others follow from 256 on
            plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
            self.bytes = {b: b for b in plain} | {b: 256 + i for i, b in enumerate(x for x in range(256) if x not in plain)}
            if self(self.PROBE) != self.encode(self.PROBE):
                self.pattern = None
                self.cache = ChunkCache(self.encode)

    @staticmethod
    def _pattern(path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        kinds = [x["type"] for x in (spec.get("normalizer") or {}).get("normalizers", ())]
        steps = (spec.get("pre_tokenizer") or {}).get("pretokenizers", ())
        if kinds != ["NFC", "Replace", "Lowercase"] or [x["type"] for x in steps] != ["Split", "ByteLevel"]:
            return None
        split = steps[0]
        if not (split["invert"] and split["behavior"] == "Removed") or steps[1]["use_regex"]:
            return None
        return regex.compile(split["pattern"]["Regex"])

    def encode(self, text: str) -> bytes:
        return _little(self.tokenizer.encode(text, add_special_tokens=False).ids)

    def _model(self, piece: str) -> bytes:
        mapped = piece.encode().decode("latin-1").translate(self.bytes)
        return _little([t.id for t in self.tokenizer.model.tokenize(mapped)])

    def _pieces(self, chunk: str) -> bytes:
        return b"".join(map(self.ids.__getitem__, self.pattern.findall(chunk)))

    def __call__(self, text: str | None) -> bytes:
        if text and any(x in text for x in _SEPARATORS):
            return self.encode(text)
        if text and self.pattern:
            # lower() alone knows a final sigma
            text = unicodedata.normalize("NFC", text).replace("\u03a3", "\u03c3").lower()
        return self.cache.join(text)


def _little(ids) -> bytes:
    return b"".join(i.to_bytes(4, "little") for i in ids)


_TOKENIZERS: dict[str, TokenIds] = {}
keeps("tokens", _TOKENIZERS.clear)


def token_ids(path: str) -> TokenIds:
    if path not in _TOKENIZERS:
        _TOKENIZERS[path] = TokenIds(path)
    return _TOKENIZERS[path]


def pieces(
    docs: DataFrame,
    tokenizer_path: str,
    capacity: int = CAPACITY,
    end_id: int = 1,
    id_col: str = "doc_id",
    text_col: str = "text",
    with_ids: bool = False,
) -> DataFrame:
    """One row per piece: id, piece, start, length, ids_crc32 (and the ids as bytes)."""
    fields = [docs.schema[id_col], StructField("piece", IntegerType()), StructField("start", LongType()),
              StructField("length", LongType()), StructField("ids_crc32", LongType())]
    if with_ids:
        fields.append(StructField("ids", BinaryType()))
    schema = StructType(fields)
    end = end_id.to_bytes(4, "little")
    step = 4 * capacity

    def run(batches):
        encode = token_ids(tokenizer_path)
        for batch in slices(batches, "tokens"):
            take, rows = [], []
            for i, text in enumerate(batch.column(1).to_pylist()):
                ids = encode(text) + end
                for k, at in enumerate(range(0, len(ids), step)):
                    part = ids[at:at + step]
                    take.append(i)
                    rows.append((k, at // 4, len(part) // 4, zlib.crc32(part), part if with_ids else None))
            columns = [batch.column(0).take(pa.array(take, pa.int64()))]
            kinds = [pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary()]
            for j, kind in enumerate(kinds[: len(fields) - 1]):
                columns.append(pa.array([r[j] for r in rows], kind))
            yield pa.RecordBatch.from_arrays(columns, names=[f.name for f in fields])

    return docs.select(id_col, text_col).mapInArrow(run, schema)


# --- one group ---------------------------------------------------------------

def best_fit(lengths: list[int], capacity: int) -> list[list[int]]:
    """Best-fit decreasing over the lengths; bins as lists of lengths."""
    bins: list[list[int]] = []
    room: dict[int, list[int]] = defaultdict(list)  # by space left
    spaces: list[int] = []  # the spaces that some bin has, ascending
    for x in sorted(lengths, reverse=True):
        k = bisect_left(spaces, x)
        if k < len(spaces):
            space = spaces[k]
            b = room[space].pop()
            if not room[space]:
                del spaces[k]
            bins[b].append(x)
        else:
            space, b = capacity, len(bins)
            bins.append([x])
        left = space - x
        if left:
            if not room[left]:
                insort(spaces, left)
            room[left].append(b)
    return bins


#: No filling is left.
_END = object()


class _Pool:
    """The lengths not yet packed, with counts."""

    def __init__(self, lengths):
        self.count = Counter(lengths)
        self.sizes = sorted(self.count)

    def take(self, x: int) -> None:
        self.count[x] -= 1
        if not self.count[x]:
            del self.sizes[bisect_left(self.sizes, x)]

    def give(self, x: int) -> None:
        if not self.count[x]:
            insort(self.sizes, x)
        self.count[x] += 1

    def below(self, x: int) -> int:
        """Index after the last size that is at most x."""
        return bisect_right(self.sizes, x)


def _fillings(pool: _Pool, space: int) -> list[tuple[int, ...]]:
    """Undominated fillings of the space, fullest first, at most WIDTH.

    Each is maximal: begun with one of the largest pieces that fit, continued
    with the largest that still fits. One that packs the same space with no
    piece larger than another's is dominated and left out.
    """
    k = pool.below(space)
    if not k:
        return [()]
    if pool.sizes[k - 1] == space:
        return [(space,)]
    found: dict[tuple[int, ...], int] = {}
    for first in reversed(pool.sizes[max(0, k - 4 * WIDTH):k]):
        filling, left = [], space
        x = first
        used: Counter = Counter()
        while True:
            filling.append(x)
            used[x] += 1
            left -= x
            j = pool.below(left)
            while j and pool.count[pool.sizes[j - 1]] <= used[pool.sizes[j - 1]]:
                j -= 1
            if not j:
                break
            x = pool.sizes[j - 1]
        found[tuple(sorted(filling, reverse=True))] = left
        if not left:
            break
    ranked = sorted(found, key=lambda f: (found[f], len(f), tuple(-x for x in f)))
    out: list[tuple[int, ...]] = []
    for f in ranked:
        if not any(len(g) <= len(f) and all(a >= b for a, b in zip(g, f, strict=False)) and found[g] <= found[f]
                   and len(g) == len(f) for g in out):
            out.append(f)
        if len(out) == WIDTH:
            break
    return out


def _dominated(chosen: list[int], outside: list[int], left: int) -> bool:
    """Whether a piece left out (sizes ascending) can stand for one or two chosen ones that take no more space."""
    distinct = sorted(set(chosen))
    for y in distinct:
        k = bisect_right(outside, y)
        if k < len(outside) and outside[k] <= y + left:
            return True
    for i, y in enumerate(distinct):
        for z in distinct[i:]:
            if y == z and chosen.count(y) < 2:
                continue
            k = bisect_left(outside, y + z)
            if k < len(outside) and outside[k] <= y + z + left:
                return True
    return False


def _all_fillings(pool: _Pool, space: int, spare: int):
    """Every undominated filling that leaves at most ``spare``, larger pieces first; None for a step without one."""
    sizes = pool.sizes[:pool.below(space)]
    if sizes and sizes[-1] == space:
        yield (space,)
        return
    counts = [pool.count[x] for x in sizes]
    sums = [0, *accumulate(x * n for x, n in zip(sizes, counts, strict=True))]
    used = [0] * len(sizes)
    path: list[int] = []  # indices, falling
    left, j, entered = space, len(sizes) - 1, True
    while True:
        if entered:
            entered = False
            smallest = next((x for x, n, u in zip(sizes, counts, used, strict=True) if u < n), space + 1)
            if smallest > left:  # nothing fits any more
                chosen = [sizes[i] for i in path]
                outside = [x for x, n, u in zip(sizes, counts, used, strict=True) if u < n]
                yield tuple(chosen) if left <= spare and not _dominated(chosen, outside, left) else None
                j = -1
        j = min(j, bisect_right(sizes, left) - 1)
        while j >= 0 and used[j] == counts[j]:
            j -= 1
        if j >= 0 and left - sums[j + 1] <= spare:
            path.append(j)
            used[j] += 1
            left -= sizes[j]
            entered = True
        elif path:
            j = path.pop()
            used[j] -= 1
            left += sizes[j]
            j -= 1
            yield None
        else:
            return


def bin_completion(lengths: list[int], capacity: int, nodes: int | None = None) -> list[list[int]]:
    """As few bins as the search finds, as lists of lengths; the fewest there are if the nodes suffice."""
    best = best_fit(lengths, capacity)
    nodes = NODES_PER_PIECE * len(lengths) + 1000 if nodes is None else nodes
    for complete in (False, True):
        best, nodes = _search(lengths, capacity, best, nodes, complete)
    return best


def _search(lengths: list[int], capacity: int, best: list[list[int]], nodes: int, complete: bool) -> tuple[list[list[int]], int]:
    """The incumbent or a better solution, and the nodes that are left."""
    total = sum(lengths)
    least = -(-total // capacity)
    if len(best) <= least:
        return best, nodes
    pool = _Pool(lengths)
    bins: list[tuple[int, ...]] = []
    waste = 0
    open_nodes: list[tuple[int, Iterator]] = []  # largest piece, fillings still to try

    def spare() -> int:
        """Waste that a solution with one bin fewer than the incumbent can have."""
        return (len(best) - 1) * capacity - total

    def enter():
        largest = pool.sizes[-1]
        pool.take(largest)
        space = capacity - largest
        open_nodes.append((largest, _all_fillings(pool, space, spare() - waste) if complete else iter(_fillings(pool, space))))

    enter()
    while open_nodes and nodes > 0 and len(best) > least:
        largest, todo = open_nodes[-1]
        if len(bins) == len(open_nodes):  # back from below: undo the last filling
            done = bins.pop()
            waste -= capacity - sum(done)
            for x in done[1:]:
                pool.give(x)
        filling = next(todo, _END)
        if filling is _END:
            open_nodes.pop()
            pool.give(largest)
            continue
        nodes -= 1
        if filling is None:
            continue
        left = capacity - largest - sum(filling)
        if waste + left > spare():
            if not complete:  # fullest first: the others waste more
                open_nodes[-1] = (largest, iter(()))
            continue
        for x in filling:
            pool.take(x)
        bins.append((largest, *filling))
        waste += left
        if not pool.sizes:
            best = [list(b) for b in bins]
        else:
            enter()
    return best, nodes


# --- all groups --------------------------------------------------------------

_ASSIGNED = "row long, sequence_id long, offset long, length long, filled int"


def _pack_group(capacity: int, rnd: int):
    def run(key, frame):
        import pandas as pd

        rows = defaultdict(list)
        for row, length in zip(frame["row"].tolist(), frame["length"].tolist(), strict=True):
            rows[length].append(row)
        for x in rows.values():
            x.sort(reverse=True)
        out = []
        for b, lengths in enumerate(bin_completion(frame["length"].tolist(), capacity)):
            seq = (rnd << 56) | (int(key[0]) << 24) | b
            at, filled = 0, sum(lengths)
            for x in lengths:
                out.append((rows[x].pop(), seq, at, x, filled))
                at += x
        return pd.DataFrame(out, columns=["row", "sequence_id", "offset", "length", "filled"])

    return run


def _least_filled(fills, capacity: int, group_rows: int) -> tuple[int, int]:
    """(fill up to which sequences are packed again, their pieces), from the pieces by fill, ascending.

    All up to one half, and fuller ones while one group holds them.
    """
    cutoff, n = capacity // 2, sum(r.n for r in fills if r.filled <= capacity // 2)
    for r in fills:
        if cutoff < r.filled < capacity:
            if n + r.n > group_rows:
                break
            cutoff, n = r.filled, n + r.n
    return cutoff, n


def packed(
    docs: DataFrame,
    tokenizer_path: str,
    capacity: int = CAPACITY,
    end_id: int = 1,
    id_col: str = "doc_id",
    text_col: str = "text",
    with_ids: bool = False,
    group_rows: int = GROUP_ROWS,
) -> DataFrame:
    """One row per piece with its sequence_id and its offset there."""
    cut = pieces(docs, tokenizer_path, capacity, end_id, id_col, text_col, with_ids)
    table = written(cut.withColumn("row", F.monotonically_increasing_id()), "pieces")
    todo = table.select("row", "length")
    left = todo.count()
    final, rnd, settling = [], 0, False
    while True:
        groups = max(1, math.ceil(left / group_rows))
        dealt = todo.withColumn("g", F.pmod(F.xxhash64(F.lit(rnd), F.col("row")), F.lit(groups)))
        done = dealt.groupBy("g").applyInPandas(_pack_group(capacity, rnd), _ASSIGNED)
        if groups == 1:
            final.append(done)
            break
        done = written(done, f"packed-{rnd}")
        fills = done.groupBy("filled").agg(F.count(F.lit(1)).alias("n")).orderBy("filled").collect()  # at most capacity rows
        cutoff = capacity - 1
        settling = settling or sum(r.n for r in fills if r.filled < capacity) > 0.9 * left
        if settling:
            cutoff, n = _least_filled(fills, capacity, group_rows)
            if n > group_rows:  # a group has to hold the pieces of more than one sequence to gain
                group_rows = max(group_rows, min(2 * group_rows, 2 * capacity))
        final.append(done.where(F.col("filled") > cutoff))
        todo = done.where(F.col("filled") <= cutoff).select("row", "length")
        left = sum(r.n for r in fills if r.filled <= cutoff)
        rnd += 1
    placed = final[0]
    for x in final[1:]:
        placed = placed.unionByName(x)
    return table.join(placed.select("row", "sequence_id", "offset"), "row").drop("row")
