"""The registered queries of this folder and, where SQL can express them, their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from yieldlens.llm import alignment, ann, bpe, conversation_trie, doc_rules, language, lines, neardup, packing, quality, substrings, topk, urls
from yieldlens.llm.common import held_out


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 5 nearest rows, by cosine, of each vector whose id is divisible by 50."""
    rows = _table(spark, sf_dir, "embeddings")
    return ann.nearest(rows.where(F.col("vec_id") % 50 == 0), rows, k=5)


def op2_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Predicted language of every document; learned from documents that are not held out."""
    docs = _table(spark, sf_dir, "documents")
    found = language.identify(docs, language.train(docs))
    return found.select("doc_id", held_out("doc_id").alias("held_out"), "lang_pred", "score")


def op3_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 10 highest integer inner products of each vector whose id is divisible by 100."""
    rows = _table(spark, sf_dir, "embeddings")
    return topk.top_by_product(rows.where(F.col("vec_id") % 100 == 0), rows, k=10)


OP3_SQL = """
WITH whole AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings
  WHERE embedding IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0
), scored AS (
  SELECT q.vec_id AS query_id, r.vec_id,
         CAST(list_sum(list_transform(list_zip(q.v, r.v), lambda p: p[1] * p[2])) AS BIGINT) AS score
  FROM whole q JOIN whole r ON q.vec_id <> r.vec_id AND len(q.v) = len(r.v)
  WHERE q.vec_id % 100 = 0
), placed AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM scored
)
SELECT query_id, rank, vec_id, score FROM placed WHERE rank <= 10
"""

def op4_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document encoded and decoded again: number of ids and digests."""
    return bpe.round_trip(_table(spark, sf_dir, "documents"))


def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality score of every document; learned from labels that are not held out."""
    docs, labels = _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels")
    found = quality.score(docs, quality.train(docs, labels))
    return found.select(
        "doc_id", held_out("doc_id").alias("held_out"), "score", F.when(F.col("score") >= 0.5, 1).otherwise(0).alias("predicted")
    )


def op6_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is left of every document without passages of 20 words that start earlier too."""
    found = substrings.remove_repeats(_table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


OP6_SQL = r"""
WITH listed AS MATERIALIZED (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents
), spans AS (
  SELECT doc_id, words, unnest(range(1, len(words) - 18)) AS start FROM listed WHERE len(words) >= 20
), windows AS MATERIALIZED (
  SELECT doc_id, start, sha256(array_to_string(words[start : start + 19], ' ')) AS window_text FROM spans
), firsts AS (
  SELECT window_text, min(doc_id) AS first_doc, arg_min(start, (doc_id, start)) AS first_start
  FROM windows GROUP BY window_text HAVING count(*) > 1
), gone AS (
  SELECT DISTINCT doc_id, unnest(range(start, start + 20)) AS place
  FROM windows JOIN firsts USING (window_text) WHERE doc_id <> first_doc OR start <> first_start
), places AS (
  SELECT doc_id, unnest(words) AS word, generate_subscripts(words, 1) AS place FROM listed
), kept AS (
  SELECT p.doc_id, string_agg(p.word, ' ' ORDER BY p.place) AS text, count(*) AS n
  FROM places p ANTI JOIN gone g ON p.doc_id = g.doc_id AND p.place = g.place GROUP BY p.doc_id
)
SELECT l.doc_id, CAST(len(words) AS BIGINT) AS n_words, CAST(len(words) - coalesce(k.n, 0) AS BIGINT) AS n_removed,
       sha256(coalesce(k.text, '')) AS kept_sha256
FROM listed l LEFT JOIN kept k USING (doc_id)
"""


def op7_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without lines that are equal or similar to an earlier one."""
    found = lines.dedupe_lines(_table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select("doc_id", "n_lines", "n_removed", "text")


def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every piece of every document with its place in a sequence of 2048 tokens."""
    return packing.pack(_table(spark, sf_dir, "documents"))


def op9_neardup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with the smallest id of its class of near copies."""
    return neardup.near_duplicates(_table(spark, sf_dir, "documents"))


#: Fixed by the query's contract: host, path, verdict.
URL_RULES = [
    ("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow"),
]


def op10_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Host, path, winning rule and verdict of every page."""
    return urls.judge_urls(_table(spark, sf_dir, "pages"), urls.rule_table(spark, URL_RULES))


OP10_SQL = """
WITH cut AS (
  SELECT page_id, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages
), parts AS (
  SELECT page_id, translate(regexp_extract(rest, '^([^/?#]*)([^?#]*)', 1),
                            'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(rest, '^([^/?#]*)([^?#]*)', 2) AS path
  FROM cut
), judged AS (
  SELECT *, CASE
    WHEN (host = 'example.net' OR ends_with(host, '.example.net')) AND starts_with(path, '/en/') THEN 'example.net/en/'
    WHEN (host = 'example.com' OR ends_with(host, '.example.com')) AND starts_with(path, '/de/') THEN 'example.com/de/'
    WHEN (host = 'org' OR ends_with(host, '.org')) AND starts_with(path, '/fr/') THEN 'org/fr/'
    WHEN (host = 'net' OR ends_with(host, '.net')) AND starts_with(path, '/') THEN 'net/'
  END AS rule FROM parts
)
SELECT page_id, host, path, rule,
       CASE WHEN rule IN ('net/', 'example.com/de/') THEN 'block' ELSE 'allow' END AS verdict
FROM judged
"""

def op11_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every node of the trie of all rebuilt conversations, which share openings."""
    turns = conversation_trie.numbered_turns(_table(spark, sf_dir, "conversations"))
    nodes, ends = conversation_trie.prefix_trie(conversation_trie.share_openings(turns))
    digest = F.coalesce("ends_sha256", F.sha2(F.lit(""), 256)).alias("ends_sha256")
    return nodes.join(conversation_trie.end_digests(ends), ["k1", "k2"], "left").select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", digest
    )


OP11_SQL = """
WITH turns AS MATERIALIZED (
  SELECT conv_id AS c, md5(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')) AS m,
         strlen(coalesce(text, '')) AS bytes,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST,
           md5(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, ''))) AS p
  FROM conversations WHERE conv_id IS NOT NULL
), convs AS MATERIALIZED (
  SELECT c, xor(4294967295::BIGINT, list_reduce(
           list_prepend(4294967295::BIGINT, list_transform(string_split(CAST(c AS VARCHAR), ''), lambda ch: ascii(ch)::BIGINT)),
           lambda crc, b: list_reduce(list_prepend(xor(crc, b), range(8)), lambda x, i: xor(x >> 1, 3988292384 * (x & 1)))
         )) % 9 AS h
  FROM (SELECT DISTINCT c FROM turns)
), rebuilt AS (
  SELECT o.c, 1 AS part, t.p, t.m, t.bytes FROM convs o JOIN turns t ON t.c = o.c AND t.p > o.h
  UNION ALL
  SELECT o.c, 0, t.p, t.m, t.bytes FROM convs o JOIN turns t ON t.c = o.c - o.c % 5 AND t.p <= o.h
), listed AS MATERIALIZED (
  SELECT c, list(m ORDER BY part, p) FILTER (m IS NOT NULL) AS ms, list(bytes ORDER BY part, p) FILTER (m IS NOT NULL) AS bs
  FROM convs LEFT JOIN rebuilt USING (c) GROUP BY c
), paths AS MATERIALIZED (
  SELECT c, d, len(coalesce(ms, [])) AS total, coalesce(array_to_string(ms[1:d], ''), '') AS prefix, coalesce(bs[d], 0) AS bytes
  FROM listed, unnest(range(0, len(coalesce(ms, [])) + 1)) AS u(d)
), nodes AS MATERIALIZED (
  SELECT prefix, d AS depth, min(c) AS conv_id, count(*) AS n_convs, (count(*) - 1) * any_value(bytes) AS saved,
         sha256(coalesce(string_agg(CAST(c AS VARCHAR), ',' ORDER BY c) FILTER (total = d), '')) AS ends_sha256
  FROM paths GROUP BY prefix, d
), above AS (
  SELECT n.conv_id, n.depth, n.saved, p.d AS up, q.conv_id AS up_conv
  FROM nodes n JOIN paths p ON p.c = n.conv_id AND p.d <= n.depth JOIN nodes q ON q.prefix = p.prefix AND q.depth = p.d
), children AS (
  SELECT up_conv AS conv_id, up AS depth, count(*) AS n FROM above WHERE up = depth - 1 GROUP BY ALL
), sums AS (
  SELECT up_conv, up, sum(saved) AS saved, count(*) FILTER (k.n IS NULL) AS leaves
  FROM above a LEFT JOIN children k ON k.conv_id = a.conv_id AND k.depth = a.depth GROUP BY ALL
)
SELECT n.conv_id, n.depth, a.up_conv AS parent_conv_id, n.n_convs, coalesce(k.n, 0) AS n_children,
       s.leaves AS n_leaves, CAST(s.saved AS BIGINT) AS saved_tokens, n.ends_sha256
FROM nodes n JOIN sums s ON s.up_conv = n.conv_id AND s.up = n.depth
LEFT JOIN children k ON k.conv_id = n.conv_id AND k.depth = n.depth
LEFT JOIN above a ON a.conv_id = n.conv_id AND a.depth = n.depth AND a.up = n.depth - 1
"""


def op12_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How the tokens of two tokenizers share every document's bytes, and how common the linked id pairs are."""
    shown = F.when(F.col("groups") == "", "").otherwise(F.sha2("groups", 256)).alias("groups_sha256")
    return alignment.align_corpus(_table(spark, sf_dir, "documents"), groups=shown)


def op13_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Statistics of every document and the verdict of base rules and trees; learned from labels that are not held out."""
    docs, labels = _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels")
    return doc_rules.judge(docs, doc_rules.train(docs, labels))


QUERIES = {
    "op1_ann": op1_ann,
    "op2_language": op2_language,
    "op3_topk": op3_topk,
    "op4_bpe": op4_bpe,
    "op5_quality": op5_quality,
    "op6_substrings": op6_substrings,
    "op7_lines": op7_lines,
    "op8_packing": op8_packing,
    "op9_neardup": op9_neardup,
    "op10_urls": op10_urls,
    "op11_trie": op11_trie,
    "op12_alignment": op12_alignment,
    "op13_rules": op13_rules,
}
ORACLES = {"op3_topk": OP3_SQL, "op6_substrings": OP6_SQL, "op10_urls": OP10_SQL, "op11_trie": OP11_SQL}
