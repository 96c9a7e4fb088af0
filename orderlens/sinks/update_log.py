"""A log of per-batch updates that is merged in generations.

    <root>/updates/batch_id=N      what micro-batch N wrote; a replay overwrites it
    <root>/live/generation=G       the merged rows that later batches may still change
    <root>/closed/generation=G     rows that are final, each key in one generation
    <root>/pointer/G.json          generation G holds all batches up to `upto`

A merge writes its generation first and its pointer last, in one rename. Until
then readers see the former generation, so a crash in between leaves folders
that the next attempt overwrites. What only the generation before the last one
needs is deleted after that, so a reader that began before a merge can
finish. Reading the live rows costs the live rows and the updates since the
last merge, however long the stream has run.
"""

from __future__ import annotations

import json
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from orderlens.sources.store import delete, exists, names, put_text


@dataclass(frozen=True)
class Pointer:
    generation: int = 0
    upto: int = -1


class UpdateLog:
    """`combine` merges rows of several batches or generations to one per key, columns as in `schema`."""

    def __init__(self, spark: SparkSession, root: str, schema: StructType, combine: Callable[[DataFrame], DataFrame]):
        self.spark, self.root, self.schema, self.combine = spark, root.rstrip("/"), schema, combine

    def pointer(self) -> Pointer:
        known = [int(n[:-5]) for n in names(self.spark, f"{self.root}/pointer") if n.endswith(".json") and n[:-5].isdigit()]
        if not known:
            return Pointer()
        line = self.spark.read.text(f"{self.root}/pointer/{max(known)}.json").first()[0]
        return Pointer(**json.loads(line))

    def write(self, updates: DataFrame, batch_id: int) -> None:
        """A micro-batch's updates; delivered again they replace what was there."""
        updates.select(*self.schema.fieldNames()).write.mode("overwrite").parquet(f"{self.root}/updates/batch_id={batch_id}")

    def _folders(self, kind: str, key: str) -> dict[int, str]:
        return {int(n.split("=")[1]): f"{self.root}/{kind}/{n}" for n in names(self.spark, f"{self.root}/{kind}") if n.startswith(f"{key}=")}

    def _rows(self, folders: list[str]) -> DataFrame:
        if not folders:
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).parquet(*folders)

    def _unmerged(self, at: Pointer, upto: int | None) -> list[str]:
        return [f for n, f in sorted(self._folders("updates", "batch_id").items()) if n > at.upto and (upto is None or n <= upto)]

    def live(self, upto: int | None = None) -> DataFrame:
        """The rows that are not final, with the updates since the last merge (up to a batch)."""
        at = self.pointer()
        merged = [self._folders("live", "generation")[at.generation]] if at.generation else []
        return self.combine(self._rows(merged + self._unmerged(at, upto)))

    def read(self, upto: int | None = None) -> DataFrame:
        """All rows: the final ones and the live ones."""
        at = self.pointer()
        closed = [f for g, f in sorted(self._folders("closed", "generation").items()) if g <= at.generation]
        return self._rows(closed).unionByName(self.live(upto))

    def merge(self, upto: int, final: Column) -> Pointer:
        """Merge the batches up to `upto`; rows for which `final` holds become closed."""
        at = self.pointer()
        if upto <= at.upto:
            return at
        new = Pointer(at.generation + 1, upto)
        merged = self.live(upto).persist()
        try:
            closes = F.coalesce(final, F.lit(False))
            merged.where(~closes).write.mode("overwrite").parquet(f"{self.root}/live/generation={new.generation}")
            merged.where(closes).write.mode("overwrite").parquet(f"{self.root}/closed/generation={new.generation}")
        finally:
            merged.unpersist()
        self._point(new)
        self._drop_before(at)
        return new

    def _point(self, to: Pointer) -> None:
        put_text(self.spark, f"{self.root}/pointer/{to.generation}.json", json.dumps({"generation": to.generation, "upto": to.upto}))

    def _drop_before(self, at: Pointer) -> None:
        """Delete what generation `at` and later ones do not need."""
        for n, folder in self._folders("updates", "batch_id").items():
            if n <= at.upto:
                delete(self.spark, folder)
        for g, folder in self._folders("live", "generation").items():
            if g < at.generation:
                delete(self.spark, folder)
        for name in names(self.spark, f"{self.root}/pointer"):
            if name[:-5].isdigit() and int(name[:-5]) < at.generation:
                delete(self.spark, f"{self.root}/pointer/{name}")


def has_log(spark: SparkSession, root: str) -> bool:
    return exists(spark, f"{root.rstrip('/')}/updates")
