"""The registered queries of this subpackage and their SQL twins."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orderlens.llm import (
    decontaminate, html_extract, language_id, line_dedup, merkle, ngram_join, odd_sketch, packing, prefix_trie, quality, sharding,
    substring_dedup, topk_search,
)
from orderlens.llm.common import crc_mod, held_out, read_table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql:
            SQL[name] = sql
        return fn
    return deco


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


# --- 4: line dedup -----------------------------------------------------------

LINE_DEDUP_SQL = r"""
WITH lines AS (
  SELECT d.doc_id, generate_subscripts(l, 1) AS pos, unnest(l) AS line
  FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS l FROM documents) d
), keyed AS (
  SELECT *, trim(translate(line, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                 ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS key
  FROM lines
), frequent AS (
  SELECT key FROM keyed WHERE length(key) >= 1 GROUP BY key HAVING count(DISTINCT doc_id) >= 10
), marked AS (
  SELECT k.*, f.key IS NOT NULL AS gone FROM keyed k LEFT JOIN frequent f ON k.key = f.key
)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM marked GROUP BY doc_id
"""


@register("op4_line_dedup", LINE_DEDUP_SQL)
def op4_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    out = line_dedup.drop_frequent_lines(docs, min_docs=10, min_chars=1, counts=("n_lines", "n_dropped"), by_id=True)
    return out.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


# --- 6: sharding -------------------------------------------------------------

@register("op6_sharding")
def op6_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    out = sharding.shuffled_shards(docs, shards=8)
    return out.select(
        "doc_id",
        (sharding.text_bytes() + 1).alias("size"),
        F.crc32(F.coalesce("text", F.lit("")).cast("binary")).alias("text_crc32"),
        F.lit("rows").alias("law"),
        "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


# --- 7: best-fit packing -----------------------------------------------------

@register("op7_packing")
def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    return packing.packed(docs, tokenizer_path()).select(
        "doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


# --- 8: language identification ----------------------------------------------

@register("op8_language_id")
def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    out = language_id.identify(docs, crc_mod("doc_id", 5) != 0)
    return out.select("doc_id", held_out("doc_id", 5, 0).alias("held_out"), "lang_pred", "score", "rejected")


# --- 9: HTML extraction ------------------------------------------------------

@register("op9_html_extraction")
def op9_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = read_table(spark, sf_dir, "pages").select("page_id", "url", "html")
    out = html_extract.extract(pages)
    return out.select("page_id", "url", "text", F.char_length("text").cast("long").alias("n_chars"))


# --- 1: quality classifier ---------------------------------------------------

@register("op1_quality")
def op1_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    labels = read_table(spark, sf_dir, "labels")
    out = quality.score_quality(docs, labels, crc_mod("doc_id", 4) != 2)
    return out.select("doc_id", held_out("doc_id", 4, 2).alias("held_out"), "score",
                      (F.col("score") >= quality.THRESHOLD).cast("int").alias("predicted"))


# --- 2: benchmark decontamination --------------------------------------------

@register("op2_decontamination")
def op2_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return decontaminate.overlaps(docs, read_table(spark, sf_dir, "benchmark")).drop("text_key")


# --- 5: suffix-array dedup ---------------------------------------------------

@register("op5_substring_dedup")
def op5_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    out = substring_dedup.remove_repeats(docs, 100)
    return out.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


# --- 3: n-gram Jaccard join --------------------------------------------------

@register("op3_ngram_join")
def op3_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.jaccard_classes(read_table(spark, sf_dir, "documents"))


# --- 10: exact top-k search --------------------------------------------------

TOPK_SQL = r"""
WITH words AS (
  SELECT doc_id, unnest(regexp_extract_all(lower(text), '[\p{L}\p{N}_]+')) AS word FROM documents
), freq AS (
  SELECT doc_id, word, count(*) AS tf FROM words GROUP BY ALL
), size AS (
  SELECT doc_id, sum(tf) AS len FROM freq GROUP BY doc_id
), corpus AS (
  SELECT count(*)::DOUBLE AS n, (SELECT sum(len) FROM size)::DOUBLE / count(*) AS mean FROM documents
), idf AS (
  SELECT word, floor(1000 * ln(1 + (any_value(n) - count(*) + 0.5) / (count(*) + 0.5)) + 0.5)::BIGINT AS w
  FROM freq, corpus GROUP BY word
), part AS (
  SELECT f.doc_id, f.word,
         floor(1000 * f.tf::DOUBLE * (1.2 + 1) / (f.tf::DOUBLE + 1.2 * (1 - 0.75 + 0.75 * s.len::DOUBLE / c.mean)) + 0.5)::BIGINT AS p
  FROM freq f JOIN size s USING (doc_id), corpus c
), scored AS (
  SELECT q.doc_id AS query_id, d.doc_id AS doc_id, sum(i.w * d.p)::DOUBLE / 1e6 AS score
  FROM freq q JOIN idf i USING (word) JOIN part d USING (word)
  WHERE q.doc_id % 20 = 0 GROUP BY ALL
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, doc_id) AS rank FROM scored
)
SELECT query_id, rank::INTEGER AS rank, doc_id, score FROM ranked WHERE rank <= 10
"""


@register("op10_topk_search", TOPK_SQL)
def op10_topk_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    return topk_search.top_k(docs, docs.where("doc_id % 20 = 0"), k=10)


# --- 11: MinHash near-dedup --------------------------------------------------

@register("op11_near_dedup")
def op11_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return odd_sketch.near_duplicates(read_table(spark, sf_dir, "documents"))


# --- 12: conversation prefix trie --------------------------------------------

# crc32 of a short ASCII text, bit by bit: the engine has no such function.
def _crc32_sql(text: str) -> str:
    return f"""xor(list_reduce(list_transform(string_split({text}, ''), lambda c: ascii(c)::BIGINT), lambda crc, byte:
      list_reduce([xor(crc, byte), 0, 0, 0, 0, 0, 0, 0, 0], lambda x, step: xor(x >> 1, 3988292384 * (x & 1))), 4294967295), 4294967295)"""


TRIE_SQL = rf"""
WITH turns AS (
  SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, md5(strlen(coalesce(role, ''))::VARCHAR || ':' || coalesce(role, '') || coalesce(text, ''))) AS pos
  FROM conversations WHERE conv_id IS NOT NULL
), convs AS (
  SELECT conv_id, {_crc32_sql("conv_id::VARCHAR")} % 9 AS h FROM (SELECT DISTINCT conv_id FROM turns)
), rebuilt AS (
  SELECT c.conv_id, t.role, t.text, t.pos FROM convs c JOIN turns t ON t.conv_id = c.conv_id - c.conv_id % 5 AND t.pos <= c.h
  UNION ALL
  SELECT c.conv_id, t.role, t.text, t.pos FROM convs c JOIN turns t ON t.conv_id = c.conv_id AND t.pos > c.h
), hashed AS (
  SELECT conv_id, pos, strlen(text) AS size, md5(strlen(role)::VARCHAR || ':' || role || text) AS id FROM rebuilt
), paths AS (
  SELECT c.conv_id, coalesce(list(h.id ORDER BY h.pos) FILTER (WHERE h.id IS NOT NULL), []) AS ids,
         coalesce(list(h.size ORDER BY h.pos) FILTER (WHERE h.id IS NOT NULL), []) AS sizes
  FROM convs c LEFT JOIN hashed h ON h.conv_id = c.conv_id GROUP BY c.conv_id
), members AS (
  SELECT conv_id, ids, d AS depth, md5(array_to_string(ids[:d], '')) AS node,
         CASE WHEN d > 0 THEN md5(array_to_string(ids[:d - 1], '')) END AS parent,
         CASE WHEN d > 0 THEN sizes[d] ELSE 0 END AS size, len(ids) = d AS ends
  FROM paths, unnest(generate_series(0, len(ids))) AS g(d)
), nodes AS (
  SELECT node, depth, any_value(parent) AS parent, min(conv_id) AS conv_id, count(*) AS n_convs, any_value(size) AS size, min(ids) AS ids,
         sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (WHERE ends), '')) AS ends_sha256
  FROM members GROUP BY node, depth
), kids AS (
  SELECT parent AS node, depth - 1 AS depth, count(*) AS kids FROM nodes WHERE depth > 0 GROUP BY ALL
), below AS (
  SELECT md5(array_to_string(n.ids[:d], '')) AS node, d AS depth, sum((n.n_convs - 1) * n.size) AS saved, count(*) FILTER (WHERE k.kids IS NULL) AS leaves
  FROM nodes n LEFT JOIN kids k USING (node, depth), unnest(generate_series(0, n.depth)) AS g(d) GROUP BY ALL
)
SELECT n.conv_id, n.depth::BIGINT AS depth, p.conv_id AS parent_conv_id, n.n_convs, coalesce(k.kids, 0) AS n_children, b.leaves AS n_leaves,
       b.saved::BIGINT AS saved_tokens, n.ends_sha256
FROM nodes n JOIN below b USING (node, depth) LEFT JOIN kids k USING (node, depth) LEFT JOIN nodes p ON p.node = n.parent AND p.depth = n.depth - 1
"""


def rebuilt_conversations(convs: DataFrame) -> DataFrame:
    """Each (conv_id, turns): the first h turns of conversation c - c % 5, then its own after its first h."""
    heads = convs.where("conv_id % 5 = 0").select(F.col("conv_id").alias("base"), F.slice("turns", 1, 8).alias("head"))
    h = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % 9).cast("int")
    own = convs.withColumn("h", h).join(heads, F.expr("conv_id - conv_id % 5") == F.col("base"), "left")
    return own.select("conv_id", F.concat(
        F.expr("slice(coalesce(head, slice(turns, 1, 0)), 1, h)"), F.expr("slice(turns, h + 1, greatest(size(turns) - h, 0))")).alias("turns"))


@register("op12_prefix_trie", TRIE_SQL)
def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    convs = prefix_trie.sequences(read_table(spark, sf_dir, "conversations"))
    return prefix_trie.prefix_trie(rebuilt_conversations(convs))


# --- 13: Merkle dataset manifest ---------------------------------------------

def _field_sql(value: str) -> str:
    return f"coalesce(strlen(({value})::VARCHAR)::VARCHAR || ':' || ({value})::VARCHAR, '-')"


_LOWER = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_LEAF = "sha256(" + " || ".join(_field_sql(c) for c in ("doc_id", "source", "lang", "n_chars", "{text}")) + ")"

MERKLE_SQL = rf"""
WITH RECURSIVE docs AS (
  SELECT doc_id, lang, {_LEAF.format(text="text")} AS leaf,
         CASE WHEN {_crc32_sql("doc_id::VARCHAR")} % 3 = 0 THEN {_LEAF.format(text=_LOWER)} ELSE {_LEAF.format(text="text")} END AS now
  FROM documents
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS idx, count(*) OVER (PARTITION BY lang) AS n FROM docs
), low AS (
  SELECT lang, 0 AS level, idx, n, leaf AS digest FROM ranked
  UNION ALL
  SELECT lang, level + 1, idx // 8, (max(n) + 7) // 8, sha256(string_agg(digest, '' ORDER BY idx)) FROM low WHERE n > 1 GROUP BY lang, level, idx // 8
), tops AS (
  SELECT lang, level AS height, digest AS subroot, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS g, count(*) OVER () AS n FROM low WHERE n = 1
), high AS (
  SELECT 0 AS level, g AS idx, n, subroot AS digest FROM tops
  UNION ALL
  SELECT level + 1, idx // 8, (max(n) + 7) // 8, sha256(string_agg(digest, '' ORDER BY idx)) FROM high WHERE n > 1 GROUP BY level, idx // 8
), root AS (
  SELECT digest AS root FROM high WHERE n = 1
), side AS (
  SELECT a.lang, a.level, a.idx, string_agg(b.digest, '' ORDER BY b.idx) FILTER (WHERE b.idx < a.idx) AS l,
         string_agg(b.digest, '' ORDER BY b.idx) FILTER (WHERE b.idx > a.idx) AS r
  FROM low a JOIN low b ON a.lang IS NOT DISTINCT FROM b.lang AND a.level = b.level AND a.idx // 8 = b.idx // 8 WHERE a.n > 1 GROUP BY ALL
), high_side AS (
  SELECT a.level, a.idx, string_agg(b.digest, '' ORDER BY b.idx) FILTER (WHERE b.idx < a.idx) AS l,
         string_agg(b.digest, '' ORDER BY b.idx) FILTER (WHERE b.idx > a.idx) AS r
  FROM high a JOIN high b ON a.level = b.level AND a.idx // 8 = b.idx // 8 WHERE a.n > 1 GROUP BY ALL
), steps AS (
  SELECT r.lang, r.idx, s.level, coalesce(s.l, '') AS l, coalesce(s.r, '') AS r
  FROM ranked r JOIN tops t ON r.lang IS NOT DISTINCT FROM t.lang
  JOIN side s ON s.lang IS NOT DISTINCT FROM r.lang AND s.level < t.height AND s.idx = r.idx // (8 ** s.level)::BIGINT
  UNION ALL
  SELECT r.lang, r.idx, 1000 + s.level, coalesce(s.l, ''), coalesce(s.r, '')
  FROM ranked r JOIN tops t ON r.lang IS NOT DISTINCT FROM t.lang JOIN high_side s ON s.idx = t.g // (8 ** s.level)::BIGINT
), paths AS (
  SELECT lang, idx, sha256(string_agg(l || r, '' ORDER BY level)) AS proof, list({{'l': l, 'r': r, 'd': ''}} ORDER BY level) AS path FROM steps GROUP BY lang, idx
), folded AS (
  SELECT r.doc_id, r.leaf, t.subroot, o.root, coalesce(p.proof, sha256('')) AS proof_sha256,
         list_reduce(coalesce(p.path, []), lambda have, s: {{'l': '', 'r': '', 'd': sha256(s.l || have.d || s.r)}}, {{'l': '', 'r': '', 'd': r.now}}).d AS folded_root
  FROM ranked r JOIN tops t ON r.lang IS NOT DISTINCT FROM t.lang CROSS JOIN root o
  LEFT JOIN paths p ON p.lang IS NOT DISTINCT FROM r.lang AND p.idx = r.idx
)
SELECT *, folded_root = root AS verified FROM folded
"""


@register("op13_merkle_manifest", MERKLE_SQL)
def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    return merkle.verified_manifest(docs, crc_mod("doc_id", 3) == 0)
