r"""Benchmark decontamination by spaced-seed hashing.

A seed is a fixed mask over consecutive words; words under a 0 are ignored, so
a substituted word breaks only the seeds that read it. Both sides are hashed
under all masks. Spark joins the documents' seed hashes with the benchmark's;
each hit fixes how the two texts lie against each other, and around it the
words are compared one by one: the longest stretch on that alignment with at
least ``IDENTITY`` equal words, beginning and ending with equal words, must
have ``MIN_WORDS`` words (or all of a shorter item).

Only seeds that may hit leave the scan of the documents: a bitmap of bounded
size over the benchmark's hashes sifts them, and the join decides. A very large
benchmark sifts less and joins more.

Items under ``MIN_WORDS`` words, one-word items too, must be overlapped whole, so
they have masks of their own length: for each number of words as few masks as
a greedy cover finds, such that every choice of substituted words that the
identity allows (the ends stay equal) lies under the 0s of some mask. Such items
are found with certainty; up to four words no substitution is allowed and the
only mask reads them all. Longer items are found by the four common masks: with
certainty at 13 and 14 words; at 15 and 16 words over 0.98 of the accepted
choices of substituted places (counted by the tests).

Words are ``\w+`` of the lower-cased text; in scripts written without spaces
(Chinese, Japanese, Thai and the like) each letter is a word.

Defined cases: null and empty texts hold no seeds; benchmark items without a
word are left out, equal items are one (the smallest id); null item ids come back null; documents of any length are read
whole; repeated rows are each flagged; empty tables give no hits; extra
columns pass through ``decontaminated`` unchanged.
"""

from __future__ import annotations

import math
import re
from functools import cache
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderlens.llm.common import ChunkCache, _word_bytes, free_name, keeps, mix64, odd_constants, slices, written
from orderlens.llm.sieve import Sieve

#: Fixed masks: weight 6, from contiguous to 12 words wide.
MASKS = ("111111", "11011011", "1101001011", "110010100101")
MIN_WORDS = 13
IDENTITY = 0.8
#: Words that a mask of a short item reads at most.
SHORT_WEIGHT = 6

#: Thai, Lao, Myanmar, Khmer, Tai, kana and Han letters.
_UNSPACED = ("\u0e00-\u0eff\u1000-\u109f\u1780-\u17ff\u1950-\u19df\u1a20-\u1aaf\u3005-\u3007\u3031-\u3035\u303b\u303c\u3040-\u30ff\u31f0-\u31ff"
             "\u3400-\u4dbf\u4e00-\u9fff\ua9e0-\ua9ff\uaa60-\uaadf\uf900-\ufaff\uff66-\uff9f\U0001b000-\U0001b16f\U00020000-\U0003ffff")
_LETTER = re.compile(f"[{_UNSPACED}]")
_WORD = re.compile(rf"(?=\w)[{_UNSPACED}]|[^\W{_UNSPACED}]+")


def _chunk_bytes(chunk: str) -> bytes:
    if chunk.isascii() or not _LETTER.search(chunk):
        return _word_bytes(chunk)
    return b"".join(xxhash.xxh64_intdigest(w).to_bytes(8, "little") for w in _WORD.findall(chunk.lower()))


_WORDS = ChunkCache(_chunk_bytes)
keeps("benchmark-words", _WORDS.forget)


def word_hashes(text: str | None) -> np.ndarray:
    """64-bit hashes of the words, in order."""
    return np.frombuffer(_WORDS.join(text), dtype="<u8")


def seeds(words: np.ndarray) -> list[np.ndarray]:
    """By mask, the seed hash at each word where the mask fits."""
    out = []
    for k, mask in enumerate(MASKS):
        n = len(words) - len(mask) + 1
        if n < 1:
            out.append(np.zeros(0, dtype=np.uint64))
            continue
        at = [i for i, x in enumerate(mask) if x == "1"]
        h = np.full(n, k + 1, dtype=np.uint64)
        for i, c in zip(at, odd_constants(len(at), 17), strict=True):
            h += words[i:i + n] * c
        out.append(mix64(h))
    return out


@cache
def short_masks(n: int) -> tuple[tuple[int, ...], ...]:
    """Masks over n words, as the places they read: any allowed substitutions miss one of them."""
    allowed = n - math.ceil(IDENTITY * n - 1e-9)
    weight = max(1, min(SHORT_WEIGHT, n - allowed)) if allowed else n
    masks = list(combinations(range(n), weight))
    # ends are equal in every stretch, so only words between them may differ
    left = set(combinations(range(1, n - 1), allowed))
    out = []
    while left:
        best = max(masks, key=lambda m: sum(not set(m) & set(x) for x in left))
        out.append(best)
        left = {x for x in left if set(best) & set(x)}
    return tuple(out)


def short_seeds(words: np.ndarray, n: int) -> list[np.ndarray]:
    """By mask of n-word items, the seed hash at each word where n words follow."""
    out = []
    for k, mask in enumerate(short_masks(n)):
        h = np.full(max(0, len(words) - n + 1), len(MASKS) + 1000 * n + k, dtype=np.uint64)
        for i, c in zip(mask, odd_constants(len(mask), 400 + 1000 * n + k), strict=True):
            h += words[i:i + len(h)] * c
        out.append(mix64(h))
    return out


def windows(words: np.ndarray, n: int) -> np.ndarray:
    """A hash of all n words from each word on."""
    h = np.zeros(max(0, len(words) - n + 1), dtype=np.uint64)
    for i, c in enumerate(odd_constants(n, 400)):
        h += words[i:i + len(h)] * c
    return mix64(h)


def aligned_overlap(doc: np.ndarray, item: np.ndarray, shift: int) -> tuple[int, int, int]:
    """(start in the item, words, equal words) of the longest tolerant stretch where item word i lies on doc word i + shift."""
    a, b = max(0, -shift), min(len(item), len(doc) - shift)
    if b <= a:
        return 0, 0, 0
    same = doc[a + shift:b + shift] == item[a:b]
    equal = np.concatenate([[0], np.cumsum(same)])
    # the stretch [i, j) has identity enough if gain[j] >= gain[i]
    gain = equal - IDENTITY * np.arange(len(equal))
    best = (0, 0, 0)
    starts: list[int] = []  # falling gains: other starts are never better
    for i in np.flatnonzero(same):
        if not starts or gain[i] < gain[starts[-1]]:
            starts.append(int(i))
    ends = np.flatnonzero(same)[::-1] + 1
    for j in ends:
        while starts and starts[-1] >= j:
            starts.pop()
        while starts and gain[j] >= gain[starts[-1]] - 1e-9:
            i = starts.pop()
            if j - i > best[1]:
                best = (a + i, int(j - i), int(equal[j] - equal[i]))
    return best


def _items(benchmark: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(item, words): distinct word sequences."""
    def run(batches):
        for batch in batches:
            found = [word_hashes(t) for t in batch.column(1).to_pylist()]
            keep = [i for i, x in enumerate(found) if len(x)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(keep, pa.int64())), pa.array([found[i].tobytes() for i in keep], pa.binary())], names=["item", "words"])

    kind = benchmark.schema[id_col].dataType.simpleString()
    return (benchmark.select(id_col, text_col).mapInArrow(run, f"item {kind}, words binary")
            .groupBy("words").agg(F.min("item").alias("item")))


def _item_seeds(items: DataFrame) -> DataFrame:
    def run(batches):
        for batch in batches:
            at, hashes, places = [], [], []
            for i, words in enumerate(batch.column("words").to_pylist()):
                item = np.frombuffer(words, dtype="<u8")
                for h in seeds(item) if len(item) >= MIN_WORDS else short_seeds(item, len(item)):
                    at += [i] * len(h)
                    hashes.append(h)
                    places += range(len(h))
            h = np.concatenate(hashes) if hashes else np.zeros(0, np.uint64)
            yield pa.RecordBatch.from_arrays(
                [batch.column("key").take(pa.array(at, pa.int64())), pa.array(h.view(np.int64)), pa.array(places, pa.int32())], names=["key", "seed", "place"])

    return items.select("key", "words").mapInArrow(run, "key long, seed long, place int")


def _text_key(text_col: str):
    text = F.coalesce(F.col(text_col), F.lit(""))
    return F.struct(F.xxhash64(F.lit(1), text).alias("a"), F.xxhash64(F.lit(2), text).alias("b"))


def overlaps(
    docs: DataFrame,
    benchmark: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_id_col: str = "item_id",
    item_text_col: str = "text",
) -> DataFrame:
    """Per contaminated document and item: their longest verified overlap.

    Columns: the document's id, text_key, the item's id, doc_start, item_start, words, equal_words.
    """
    items = written(_items(benchmark, item_id_col, item_text_col).withColumn("key", F.monotonically_increasing_id()), "benchmark")
    item_seeds = written(_item_seeds(items), "benchmark-seeds")
    shared = Sieve.share(item_seeds, "seed")
    size = F.octet_length("words") / 8
    short = [int(r["n"]) for r in items.select(size.cast("int").alias("n")).where(F.col("n") < MIN_WORDS).distinct().collect()]
    id_type = docs.schema[id_col].dataType.simpleString()

    def sift(batches):
        sieve = shared.value
        for batch in slices(batches, "benchmark-words"):
            keep, words_, found = [], [], []
            for i, text in enumerate(batch.column(2).to_pylist()):
                words = word_hashes(text)
                hits = []
                masked, whole = seeds(words), [(n, short_seeds(words, n)) for n in short]
                if not len(sieve.passes(np.concatenate([*masked, *(h for _, x in whole for h in x)]))):  # most texts: one look instead of one by mask
                    continue
                for h in masked:
                    at = sieve.passes(h)
                    hits += zip(h[at].view(np.int64).tolist(), at.tolist(), strict=True)
                for n, by_mask in whole:
                    same = None
                    for h in by_mask:
                        at = sieve.passes(h)
                        if len(at):  # places with the same n words are alike: the first
                            same = windows(words, n) if same is None else same
                            at = at[np.unique(same[at], return_index=True)[1]]
                            hits += zip(h[at].view(np.int64).tolist(), at.tolist(), strict=True)
                if hits:
                    keep.append(i)
                    words_.append(words.tobytes())
                    found.append([{"seed": s, "at": a} for s, a in hits])
            rows = batch.take(pa.array(keep, pa.int64()))
            yield pa.RecordBatch.from_arrays(
                [rows.column(0), rows.column(1), pa.array(words_, pa.binary()),
                 pa.array(found, pa.list_(pa.struct([("seed", pa.int64()), ("at", pa.int32())])))], names=["id", "text_key", "words", "seeds"])

    sifted = docs.select(F.col(id_col).alias("id"), _text_key(text_col).alias("text_key"), F.col(text_col).alias("text")).mapInArrow(
        sift, f"id {id_type}, text_key struct<a:long,b:long>, words binary, seeds array<struct<seed:long,at:int>>")
    candidates = written(sifted.withColumn("row", F.monotonically_increasing_id()), "seeded")

    hits = (candidates.select("row", F.explode("seeds").alias("s")).select("row", "s.seed", "s.at")
            .join(item_seeds, "seed")
            .groupBy("row", "key").agg(F.collect_set(F.col("at") - F.col("place")).alias("shifts")))
    pairs = (hits.join(items.select("key", "item", F.col("words").alias("item_words")), "key")
             .join(candidates.select("row", "id", "text_key", "words"), "row")
             .select("id", "text_key", "item", "words", "item_words", "shifts"))
    item_type = items.schema["item"].dataType.simpleString()

    def verify(batches):
        for batch in slices(batches, "benchmark-words", 64):
            keep, out = [], []
            for i, (words, item, shifts) in enumerate(zip(*(batch.column(c).to_pylist() for c in ("words", "item_words", "shifts")), strict=True)):
                doc, item = np.frombuffer(words, dtype="<u8"), np.frombuffer(item, dtype="<u8")
                best = max(((n, equal, -(start + s), start) for s in sorted(shifts) for start, n, equal in [aligned_overlap(doc, item, s)]))
                if best[0] >= min(MIN_WORDS, len(item)):
                    keep.append(i)
                    out.append(best)
            rows = batch.take(pa.array(keep, pa.int64()))
            yield pa.RecordBatch.from_arrays(
                [rows.column("id"), rows.column("text_key"), rows.column("item"), pa.array([-x[2] for x in out], pa.int64()), pa.array([x[3] for x in out], pa.int64()),
                 pa.array([x[0] for x in out], pa.int64()), pa.array([x[1] for x in out], pa.int64())],
                names=[id_col, "text_key", item_id_col, "doc_start", "item_start", "words", "equal_words"])

    return pairs.mapInArrow(verify, f"`{id_col}` {id_type}, text_key struct<a:long,b:long>, `{item_id_col}` {item_type}, "
                                    "doc_start long, item_start long, words long, equal_words long")


def decontaminated(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                   item_id_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """The documents that overlap no benchmark item, columns as they were."""
    found = overlaps(docs, benchmark, id_col, text_col, item_id_col, item_text_col).select("text_key").distinct()
    # a text is contaminated or not whatever its row's other columns are
    name = free_name(docs.columns, "_hit")
    return docs.join(found.withColumnRenamed("text_key", name), _text_key(text_col) == F.col(name), "left_anti")
