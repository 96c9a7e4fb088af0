"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import re
from collections.abc import Callable

import numpy as np
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orderlens.session import scratch_path

WORD = re.compile(r"\w+")


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def written(df: DataFrame, name: str) -> DataFrame:
    """The frame as a Parquet table in the shared work folder.

    Cuts the lineage and fixes the rows: executors lost later cost a re-read,
    never another outcome of an earlier step.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def crc_mod(col: str, n: int):
    """crc32 of the id written as text, modulo n (null id: null)."""
    return F.pmod(F.crc32(F.col(col).cast("string").cast("binary")), F.lit(n))


def held_out(col: str, n: int, remainder: int):
    """Whether that remainder keeps a row out of training. A row without id has none: it isn't held out, nor learned from."""
    return F.coalesce(crc_mod(col, n) == remainder, F.lit(False))


#: Rows of a batch that are taken apart at once.
SLICE_ROWS = 512

_FORGET: dict[str, Callable[[], None]] = {}


def keeps(owner: str, forget: Callable[[], None]) -> None:
    """Names what frees the memory that an operator keeps in a worker between tasks."""
    _FORGET[owner] = forget


def slices(batches, owner: str, rows: int = SLICE_ROWS):
    """The batches in slices of few rows, for the operator that the worker works for now.

    Workers are used again by the next stage: what other operators keep in
    this one is let go. Python objects are made of one slice at a time,
    whatever the size of Spark's batches.
    """
    for other, forget in _FORGET.items():
        if other != owner:
            forget()
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


class ChunkCache(dict):
    """Bytes computed once per distinct chunk of text between white space.

    Holds at most twice ``limit`` entries: a full generation becomes the old
    one, from which entries still in use come back, so a worker's memory is
    bounded whatever the vocabulary.
    """

    def __init__(self, compute, limit: int = 300_000):
        super().__init__()
        self.compute = compute
        self.limit = limit
        self.old: dict[str, bytes] = {}

    def __missing__(self, chunk: str) -> bytes:
        got = self.old.get(chunk)
        if got is None:
            got = self.compute(chunk)
        if len(self) >= self.limit:
            self.old = dict(self)
            self.clear()
        self[chunk] = got
        return got

    def forget(self) -> None:
        self.clear()
        self.old = {}

    def join(self, text: str | None) -> bytes:
        if not text:
            return b""
        return b"".join(map(self.__getitem__, text.split()))


def _word_bytes(chunk: str) -> bytes:
    chunk = chunk.lower()
    words = (chunk,) if chunk.isalnum() else WORD.findall(chunk)
    return b"".join(xxhash.xxh64_intdigest(w).to_bytes(8, "little") for w in words)


_WORDS = ChunkCache(_word_bytes)
keeps("words", _WORDS.forget)


def word_hashes(text: str | None) -> np.ndarray:
    r"""64-bit hashes of the words (``\w+`` of the lower-cased text), in order."""
    return np.frombuffer(_WORDS.join(text), dtype="<u8")


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective finaliser that spreads the bits of 64-bit values."""
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def odd_constants(n: int, seed: int) -> np.ndarray:
    """n odd 64-bit multipliers that depend on the seed only."""
    return mix64(np.arange(1, n + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(seed)) | np.uint64(1)


def free_name(taken, stem: str) -> str:
    """A column name that clashes with none of the taken ones (case ignored)."""
    low = {c.lower() for c in taken}
    name, i = stem, 0
    while name.lower() in low:
        i += 1
        name = f"{stem}_{i}"
    return name
