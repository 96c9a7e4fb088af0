"""A training-data pipeline over ``documents``: each stage is one operator.

``STAGES`` lists (name, function); a function takes (spark, docs, sf_dir) and
returns what it keeps with the columns of ``documents``, the last one the
packed pieces. ``run`` writes each stage as a Parquet table in the shared work
folder and reads it again, so a lost executor costs at most one stage.

Nulls and odd rows: documents without text or without a letter are rejected by
the first stage; rows with a null id are kept by the others and packed, but
the join keeps one of each class as with other rows; rows
that repeat an id and a text stay or go together; extra columns pass through
up to the last stage; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orderlens.llm import decontaminate, language_id, line_dedup, ngram_join, packing
from orderlens.llm.common import free_name, read_table, written
from orderlens.llm.queries import tokenizer_path


def keep_known_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose best language model finds them improbable go, and those without a letter."""
    names = tuple(free_name(docs.columns, x) for x in ("_predicted", "_score", "_rejected"))
    out = language_id.identify(docs, F.lit(True), out=names)
    return out.where(~F.col(names[2])).select(*docs.columns)


def drop_common_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines found in 10 documents or more go; n_chars follows the text."""
    out = line_dedup.drop_frequent_lines(docs, min_docs=10, min_chars=1, by_id=True)
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType))
    return out


def one_of_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of five-word shingle similarity 0.8 stays."""
    return ngram_join.one_per_class(docs, threshold=0.8, null_ids=True)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a passage of a benchmark item go."""
    return decontaminate.decontaminated(docs, read_table(spark, sf_dir, "benchmark"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of at most 4096 tokens in as few sequences as can be found."""
    return packing.packed(docs, tokenizer_path())


STAGES = [
    ("language_id", keep_known_languages),
    ("line_dedup", drop_common_lines),
    ("ngram_join", one_of_near_copies),
    ("decontamination", without_benchmark),
    ("packing", pack),
]

#: Several stages are no SQL (language models, sketches, a tokenizer); tests
#: hold each stage against a brute-force version instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = written(docs, f"stage-{name}")
    return docs
