r"""Merkle manifest of a dataset: a content-addressed tree, proofs by descent from its root.

Every row is a leaf, H (lower-case hex SHA-256) of its fields: ``-`` for a null,
else UTF-8 byte count, ``:`` and value. The leaves of one group (a language)
ascend by id; while a group has several nodes, every ``FAN`` consecutive ones
(the last run may be shorter) become the H of their digests. What remains is
the group's subroot; the subroots in the order of their groups (null first)
give the root in the same way.

Build: leaves are ranked without a task per group (range sort by group and id,
then counts per part), a level is one grouping by (group, rank div FAN), and
each level is written as records digest -> children digests. The number of
levels is the logarithm of the largest group, and every level has an eighth of
the rows of the one below.

Proofs: requests for leaves descend from the root. At each level the store
gives the children of a node's digest, the next digit of the requested ranks
picks one of them and the unselected ones become a path segment (left part,
right part). Requests that share a node descend together, so a level moves one
row per requested node, and the longest paths are moved once per run of
``FAN`` leaves. Segments are put in front as the descent goes down, so that
they end up from leaf to root.

Defined cases: null fields are ``-``; a null id sorts first and counts as an id
of its own; equal ids follow the order of their leaf digests, repeated rows are
leaves of their own; null is a group of its own; a lone leaf is its group's
subroot, a lone subroot the root; texts of any length go through one hash and
are not shuffled; an empty table has no root and gives an empty result; columns
are chosen by name and others are not read.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from orderlens.llm.common import written

#: Children of a node.
FAN = 8
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")

_SEGMENT = "array<struct<l:string,r:string>>"


def field_text(value: Column) -> Column:
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def digest(*parts: Column) -> Column:
    return F.sha2(F.concat(*parts), 256)


def ranked(rows: DataFrame, order: list[str], group: str | None = None, name: str = "ranked") -> DataFrame:
    """The rows with ``rank``, the place from 0 within the group, and ``n``, the group's rows.

    A range sort spreads a large group over many parts; only one row per part
    and group is counted up.
    """
    by = [*([group] if group else []), *order]
    mixed = rows.withColumn("_tie", F.monotonically_increasing_id())  # repeated rows are spread as well
    placed = written(
        mixed.repartitionByRange(*by, "_tie").sortWithinPartitions(*by, "_tie").drop("_tie")
        .withColumn("_at", F.monotonically_increasing_id()), name)
    key = F.col(group) if group else F.lit(0)
    parts = placed.groupBy(F.shiftright("_at", 33).alias("_part"), key.alias("_group")).agg(
        F.count(F.lit(1)).alias("_rows"), F.min("_at").alias("_first"))
    whole = Window.partitionBy("_group")
    before = whole.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select("_part", "_group", "_first", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_before"),
                         F.sum("_rows").over(whole).alias("n"))
    joined = placed.join(parts, (F.shiftright("_at", 33) == F.col("_part")) & key.eqNullSafe(F.col("_group")))
    return joined.select(*rows.columns, (F.col("_at") - F.col("_first") + F.col("_before")).alias("rank"), "n")


def _levels(leaves: DataFrame, name: str) -> list[DataFrame]:
    """The written levels above the leaves (g, idx, n, digest), lowest first: g, idx, n, digest, children."""
    out, below = [], leaves
    most = leaves.agg(F.max("n")).first()[0] or 0
    while most > 1:
        most = -(-most // FAN)
        runs = below.where("n > 1").groupBy("g", F.expr(f"idx div {FAN}").alias("idx")).agg(
            F.max("n").alias("n"), F.array_sort(F.collect_list(F.struct("idx", "digest"))).alias("run"))
        below = written(runs.select(
            "g", "idx", F.expr(f"(n + {FAN - 1}) div {FAN}").alias("n"),
            F.sha2(F.array_join("run.digest", ""), 256).alias("digest"), F.col("run.digest").alias("children")), name)
        out.append(below)
    return out


def _tops(leaves: DataFrame, levels: list[DataFrame]) -> DataFrame:
    """(g, digest): the node that remains of each group, whatever its height."""
    out = leaves.where("n = 1").select("g", "digest")
    for level in levels:
        out = out.unionByName(level.where("n = 1").select("g", "digest"))
    return out


def _store(level: DataFrame) -> DataFrame:
    return level.select("digest", "children").dropDuplicates(["digest"])


def _segment(digit: str) -> Column:
    """The path segment of the child at this digit of ``children``, no segment where the node has none."""
    return F.when(F.col("children").isNull(), F.array().cast(_SEGMENT)).otherwise(F.array(F.struct(
        F.array_join(F.expr(f"slice(children, 1, cast({digit} as int))"), "").alias("l"),
        F.array_join(F.expr(f"slice(children, cast({digit} as int) + 2, {FAN})"), "").alias("r"))))


def _descend(nodes: DataFrame, level: DataFrame, wanted: DataFrame) -> DataFrame:
    """One level down: nodes (g, idx, digest, path, ...) to their wanted children (g, idx).

    Nodes of groups that begin further down have no record here and stay.
    """
    rest = [c for c in nodes.columns if c not in ("g", "idx", "digest", "path")]
    found = nodes.join(_store(level), "digest", "left")
    asked = wanted.select(F.col("g").alias("_g"), F.col("idx").alias("_idx"), F.expr(f"idx div {FAN}").alias("_up"))
    found = found.join(asked, (F.col("g") == F.col("_g")) & (F.col("idx") == F.col("_up")))
    digit = f"(_idx % {FAN})"
    return found.select(
        "g", F.col("_idx").alias("idx"), F.coalesce(F.expr(f"children[cast({digit} as int)]"), "digest").alias("digest"),
        F.concat(_segment(digit), "path").alias("path"), *rest)


@dataclass
class Manifest:
    """The written tree: leaves (g, idx, n, digest and the rows' columns), levels, the groups' tree above."""

    leaves: DataFrame
    levels: list[DataFrame]
    groups: DataFrame
    top: list[DataFrame]

    def records(self) -> DataFrame:
        """The store: digest -> children, each node once."""
        tables = [*self.levels, *self.top]
        out = self.leaves.select("digest").limit(0).select("digest", F.array("digest").alias("children"))
        for level in tables:
            out = out.unionByName(level.select("digest", "children"))
        return out.dropDuplicates(["digest"])

    def proofs(self, requests: DataFrame | None = None) -> DataFrame:
        """Requested leaves with ``subroot``, ``root`` and ``path``, the (left, right) siblings from leaf to root.

        ``requests`` are leaf rows (g, idx and any columns); all leaves if None.
        """
        asked = self.leaves if requests is None else requests
        wanted_groups = asked.select("g").distinct()
        nodes = _tops(self.groups, self.top).select(
            F.col("g"), F.lit(0).cast("long").alias("idx"), "digest", F.array().cast(_SEGMENT).alias("path"), F.col("digest").alias("root"))
        for k in range(len(self.top), 0, -1):
            below = wanted_groups.select(F.lit(0).cast("long").alias("g"), F.expr(f"g div {FAN ** (k - 1)}").alias("idx")).distinct()
            nodes = _descend(nodes, self.top[k - 1], below)
        # the leaves of the tree of groups are the groups' subroots
        nodes = nodes.select(F.col("idx").alias("g"), F.lit(0).cast("long").alias("idx"), "digest", "path", "root", F.col("digest").alias("subroot"))
        for k in range(len(self.levels), 1, -1):
            below = asked.select("g", F.expr(f"idx div {FAN ** (k - 1)}").alias("idx")).distinct()
            nodes = written(_descend(nodes, self.levels[k - 1], below), "merkle-paths")
        runs = asked.groupBy("g", F.expr(f"idx div {FAN}").alias("run")).agg(F.collect_list(F.struct("*")).alias("asked"))
        if self.levels:
            nodes = nodes.join(_store(self.levels[0]), "digest", "left")
        else:
            nodes = nodes.withColumn("children", F.lit(None).cast("array<string>"))
        nodes = nodes.select(F.col("g").alias("_g"), F.col("idx").alias("_run"), "path", "root", "subroot", "children")
        found = runs.join(nodes, (F.col("g") == F.col("_g")) & (F.col("run") == F.col("_run"))).select(
            F.explode("asked").alias("leaf"), "path", "root", "subroot", "children")
        return found.select("leaf.*", "root", "subroot", F.concat(_segment(f"(leaf.idx % {FAN})"), "path").alias("path"))


def build(leaves: DataFrame, order_col: str, group_col: str) -> Manifest:
    """The manifest of rows with a ``digest`` column; other columns stay with their leaves."""
    placed = ranked(leaves, [order_col, "digest"], group_col, "merkle-order")
    names = ranked(placed.groupBy(F.col(group_col).alias("name")).agg(F.lit(1).alias("one")), ["name"], name="merkle-groups").select(
        "name", F.col("rank").alias("g"), F.col("n").alias("groups"))
    low = written(placed.join(names.select("name", "g"), F.col(group_col).eqNullSafe(F.col("name"))).select(
        "g", F.col("rank").alias("idx"), "n", *leaves.columns), "merkle-leaves")
    levels = _levels(low, "merkle-level")
    subroots = written(_tops(low, levels).join(names, "g").select(
        F.lit(0).cast("long").alias("g"), F.col("g").alias("idx"), F.col("groups").alias("n"), "digest"), "merkle-subroots")
    return Manifest(low, levels, subroots, _levels(subroots, "merkle-top"))


def proof_digest(path: str = "path") -> Column:
    """H of all siblings, level by level from leaf to root, left to right."""
    return F.sha2(F.array_join(F.transform(path, lambda s: F.concat(s["l"], s["r"])), ""), 256)


def folded(start: Column, path: str = "path") -> Column:
    """The root that a leaf digest and the siblings of a path give."""
    return F.aggregate(path, start, lambda have, s: F.sha2(F.concat(s["l"], have, s["r"]), 256))


def verified_manifest(docs: DataFrame, tampered: Column, fields=FIELDS, id_col: str = "doc_id", text_col: str = "text",
                      group_col: str = "lang") -> DataFrame:
    """Each row's leaf, subroot, root, proof digest and the root folded from what it holds now.

    Rows for which ``tampered`` is true have their text's A-Z lower-cased
    after the manifest was made; the others are as they were.
    """
    lower = F.translate(F.col(text_col).cast("string"), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    changed = F.coalesce(tampered, F.lit(False))
    now = [field_text(F.when(changed, lower).otherwise(F.col(c).cast("string")) if c == text_col else F.col(c)) for c in fields]
    leaves = docs.select(F.col(id_col).alias("id"), F.col(group_col).alias("grp"),
                         digest(*[field_text(F.col(c)) for c in fields]).alias("digest"),
                         F.when(changed, digest(*now)).alias("altered"))
    found = build(leaves, "id", "grp").proofs()
    return found.select(
        F.col("id").alias(id_col), F.col("digest").alias("leaf"), "subroot", "root", proof_digest().alias("proof_sha256"),
        folded(F.coalesce("altered", "digest")).alias("folded_root"),
    ).withColumn("verified", F.col("folded_root") == F.col("root"))
