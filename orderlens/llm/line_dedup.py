"""Line dedup: lines found in many documents go, the rest is reassembled.

DataFrame functions only. Lines are exploded to narrow rows (document key,
position, 128-bit hash of the normalised line); documents are counted per
hash with map-side partial counts, so a line that a third of all documents
hold costs one row per task. ``by_id`` counts distinct ids: the rows are first
made distinct per hash and id, spread by both. The line rows meet the frequent hashes in an
equi-join whose line side adaptive execution can split; flags go back to
their documents by position and the text is filtered in place. The text
itself is shuffled once, in the last join.

Defined cases: a null or empty text is one empty line and comes back as the
empty string; a key shorter than ``min_chars`` code points never counts; with
``by_id`` all rows of an id are one document and each row with a null id is one
of its own, without it each row is one document; every row comes back; extra columns pass through unchanged; an empty
table gives an empty result.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderlens.llm.common import free_name

#: Stripped at both ends of a line before comparing (space, \t \n \v \f \r).
BLANKS = " \t\n\x0b\x0c\r"


def line_key(line: Column) -> Column:
    """The line without outer blanks, A-Z lower-cased (other letters as they are)."""
    return F.btrim(F.translate(line, string.ascii_uppercase, string.ascii_lowercase), F.lit(BLANKS))


def _hash(name: str, *cols: Column) -> Column:
    """128 bits: two hashes with different seeds."""
    return F.struct(F.xxhash64(F.lit(1), *cols).alias("a"), F.xxhash64(F.lit(2), *cols).alias("b")).alias(name)


def drop_frequent_lines(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    min_docs: int = 10,
    min_chars: int = 1,
    counts: tuple[str, str] | None = None,
    by_id: bool = False,
) -> DataFrame:
    """The documents without the lines whose key is in at least ``min_docs`` of them.

    Returns the input's columns, the text replaced. ``counts`` names two more
    columns: the lines before dropping and the lines dropped (long).
    ``by_id`` counts the rows of one id as one document.
    """
    taken = [*docs.columns, *(counts or ())]
    doc, lines, flags, key = (free_name(taken, x) for x in ("_doc", "_lines", "_flags", "_key"))
    text = F.coalesce(F.col(text_col), F.lit(""))
    # rows with the same id and text share a key: their lines have one fate
    base = docs.withColumn(doc, _hash(doc, F.col(id_col), text))

    each = base.select(doc, F.posexplode(F.split(text, "\n")).alias("pos", "line"))
    each = each.select(doc, "pos", line_key(F.col("line")).alias(key))
    each = each.select(doc, "pos", F.char_length(key).alias("n"), _hash("hash", F.col(key)))

    own = F.when(F.col(id_col).isNull(), F.monotonically_increasing_id())
    who = [F.col(id_col).alias("id"), own.alias("own")] if by_id else []
    per_doc = base.select(*who, F.explode(F.array_distinct(F.transform(F.split(text, "\n"), line_key))).alias(key))
    held = per_doc.where(F.char_length(key) >= min_chars).select(*[c for c in ("id", "own") if by_id], _hash("hash", F.col(key)))
    frequent = (
        (held.distinct() if by_id else held)
        .groupBy("hash").agg(F.count(F.lit(1)).alias("docs"))
        .where(F.col("docs") >= min_docs)
        .select("hash", F.lit(True).alias("drop"))
    )
    marked = each.join(frequent, "hash", "left").select(
        doc, F.struct("pos", ((F.col("n") >= min_chars) & F.coalesce("drop", F.lit(False))).alias("drop")).alias("at"))
    # a set, as repeated rows bring each position more than once
    decided = marked.groupBy(doc).agg(F.array_sort(F.collect_set("at"))["drop"].alias(flags))

    out = base.join(decided, doc, "left").withColumn(lines, F.split(text, "\n"))
    kept = F.array_join(F.filter(lines, lambda x, i: ~F.get(F.col(flags), i)), "\n")
    columns = [kept.alias(c) if c == text_col else F.col(c) for c in docs.columns]
    if counts:
        columns += [F.size(lines).cast("long").alias(counts[0]),
                    F.size(F.filter(flags, lambda x: x)).cast("long").alias(counts[1])]
    return out.select(*columns)
